"""Embedding near-dedup against brute force."""

import math
import random

import numpy as np

import webcorpus.llm.embedding_dedup as module
from webcorpus.llm.embedding_dedup import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, kept int, unit string"


def test_embedding_dedup(spark):
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(60):
            base = rng.standard_normal(16)
            for _ in range(random.Random(n).choice((1, 1, 2, 5))):
                rows.append((n, (base + rng.standard_normal(16) * 0.08).astype(np.float32).tolist(), label))
                n += 1
    hub = rng.standard_normal(16)   # more links than a list holds, and equal vectors
    rows += [(n + i, (hub + rng.standard_normal(16) * (0.1 if i % 3 else 0)).astype(np.float32).tolist(), 1) for i in range(60)]
    n += 60
    odd = [None, [], [0.0] * 16, [math.nan] * 16, [None] * 16, [math.inf] + [0.0] * 15, [1.0]]
    rows += [(n + i, v, 1) for i, v in enumerate(odd)] + [(None, rows[0][1], 0)]
    got = embedding_dedup(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    use = [(i, np.array(v, dtype=np.float64), lab) for i, v, lab in rows if i is not None and lab is not None and v and len(v) == 16
           and None not in v and np.isfinite(v).all() and np.any(v)]
    ids = [u[0] for u in use]
    x = np.array([u[1] / np.linalg.norm(u[1]) for u in use])
    same = np.array([[a[2] == b[2] for b in use] for a in use])
    link = (x @ x.T >= 0.93) & same & ~np.eye(len(use), dtype=bool)
    group = list(range(len(use)))
    for _ in use:
        group = [min([group[k], *(group[j] for j in np.flatnonzero(link[k]))]) for k in range(len(use))]
    want = {i: (int(link[k].sum()), ids[group[k]]) for k, i in enumerate(ids)}
    for r in got:
        n_links, component = want.get(r["vec_id"], (0, r["vec_id"]))
        assert (r["n_links"], r["component_id"]) == (n_links, component)
        assert r["kept"] == (r["vec_id"] == component)


def test_empty(spark):
    assert embedding_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_isolated_pairs_beside_a_hot_group(spark, monkeypatch):
    """Pairs that no cell holds together are found, however many links a hot group has."""
    for name, value in (("TREES", 1), ("CELL", 4), ("ROUNDS", 1), ("BLOCK", 256)):
        monkeypatch.setattr(module, name, value)
    rng = np.random.default_rng(9)
    d, n_pairs = 32, 300
    one = rng.standard_normal((n_pairs, d))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    off = rng.standard_normal((n_pairs, d))
    off -= (off * one).sum(axis=1, keepdims=True) * one
    two = 0.935 * one + np.sqrt(1 - 0.935**2) * off / np.linalg.norm(off, axis=1, keepdims=True)
    hot = rng.standard_normal(d) + rng.standard_normal((700, d)) * 0.1
    x = np.concatenate([one, two, hot, rng.standard_normal((1000, d))])
    rows = [(i, v.tolist(), 1, 1, "x") for i, v in enumerate(x.astype(np.float32))]
    got = {r["vec_id"]: r for r in embedding_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(n_pairs):
        assert (got[i]["n_links"], got[i + n_pairs]["n_links"], got[i + n_pairs]["component_id"]) == (1, 1, i)
    assert all(got[2 * n_pairs + i]["n_links"] == 699 and got[2 * n_pairs + i]["component_id"] == 2 * n_pairs for i in range(700))
    assert all(got[i]["n_links"] == 0 for i in range(2 * n_pairs + 700, len(x)))
