"""Exact top-k search against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import webcorpus.llm.topk_search as module
from webcorpus.llm.topk_search import topk_search

SCHEMA = "vec_id long, embedding array<float>, rank int, id string, score double, `block` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x", 0.5, 1) for i, v in rows], SCHEMA).repartition(5)


def brute(rows, every, k):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, tuple(math.floor(1024 * float(np.float32(x))) for x in v)))
    out = set()
    for i, v in set(whole):
        if i % every == 0:
            score = lambda w: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w))))  # noqa: B023, E731
            found = sorted((-score(w), j) for j, w in whole if j != i)
            for rank, (least, j) in enumerate(found[:k], 1):
                out.add((i, v, rank, j, -least))
    return sorted((i, rank, j, s) for i, _, rank, j, s in out)


def check(spark, rows, every=10, k=10):
    got = topk_search(frame(spark, rows), F.col("vec_id") % every == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, every, k)


def clustered(n, width=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width)) * 3
    return [[float(x) for x in centres[i % 12] + rng.normal(size=width) * 0.05] for i in range(n)]


@pytest.mark.parametrize("block", [1 << 24, 2048])
def test_clusters(spark, monkeypatch, block):
    """Also with many groups of queries, and several blocks of each."""
    monkeypatch.setattr(module, "BLOCK_BYTES", block)
    check(spark, list(enumerate(clustered(900))), every=7)


def test_awkward_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(200)]
    rows += [(0, [0.5, 0.5, 0.5, 0.5]), (10, None), (20, [float("nan"), 1.0, 1.0, 1.0]), (30, [float("inf")] * 4), (500, [None, 1.0, 1.0, 1.0])]
    rows += [(510, [1.0]), (520, []), (520, []), (None, [1.0] * 4), (-10, [1.0] * 4), (-10, [1.0] * 4), (530, [0.0] * 4), (3, [9.0] * 4), (3, [9.0] * 4)]
    check(spark, rows)
    check(spark, rows, k=1)
    check(spark, rows[:6], every=1, k=50)


def test_scores_beyond_doubles(spark):
    rows = [(i, [1e10 * (i + 1), 1.0, float(i % 3)]) for i in range(30)] + [(40, [3e30, 0.0, 0.0]), (50, [-3e30, 0.0, 0.0]), (60, [1e-30, 2.0, 0.0])]
    check(spark, rows)


def test_hot_copies_and_outliers(spark, monkeypatch):
    """A third of the rows equal, others far out; shares of blocks of equal rows stay bounded."""
    monkeypatch.setattr(module, "BLOCK_BYTES", 64 * 50)
    rows = [(3 * i, [1.0] * 8) for i in range(300)] + [(3 * i + 1, v) for i, v in enumerate(clustered(500))]
    rows += [(10_000 + i, [100.0 * i] * 8) for i in range(5)]
    check(spark, rows, every=30, k=4)


def test_bounds_leave_rows_out():
    """On clusters far apart most groups do not need most rows."""
    x = np.floor(np.array(clustered(6000)) * 1024)
    cells = module.Cells(x[:70])
    cell, distance = cells.assign(x)
    rows = [{"cell": int(c), "rings": np.bincount(module.ring_of(distance[cell == c]), minlength=64).tobytes(),
             "near": np.sort(distance[cell == c])[:11].tobytes()} for c in np.unique(cell)]
    plan = module.Plan(cells, rows, rows, 10, 8)
    needed = [(distance >= plan.needed(x[cell == c][:50], np.zeros(50, int))[0][cell]).mean() for c in np.unique(cell) if (cell == c).sum() >= 50]
    assert np.mean(needed) < 0.3


def test_empty(spark):
    assert topk_search(frame(spark, []), F.lit(True)).count() == 0
    assert topk_search(frame(spark, [(1, None), (2, [1.0])]), F.lit(True)).count() == 0
