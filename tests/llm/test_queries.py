"""The registered queries: against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from webcorpus.llm.front_coding import as_rows, as_words, decode, encode, merge_runs, prefixes, sort_order
from webcorpus.llm.oracles import ORACLES
from webcorpus.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, sql, name):
    got = QUERIES[name](spark, SF)
    want = sql.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, want.fetchall()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-{k}-{id(docs)}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() > 0 and docs.columns[: len(names)] == names
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


@pytest.mark.parametrize("fan_in", [2, 7, 64])
def test_merge_of_front_coded_runs(fan_in, monkeypatch):
    import numpy as np

    import webcorpus.llm.front_coding as module

    monkeypatch.setattr(module, "FAN_IN", fan_in)
    rng = np.random.default_rng(1)
    runs, starts = [], [0]
    for _ in range(23):
        n = int(rng.integers(0, 300))
        rows = rng.integers(97, 99, (n, 50)).astype(np.uint8)
        rows[: n // 2, :30] = 97
        rows[: n // 4] = 98
        words = as_words(rows)
        words = words[sort_order(words, np.arange(n))]
        shared = prefixes(words, 50)
        assert (decode(encode(words, shared, 50), shared, 50) == words).all()
        runs.append((words, shared))
        starts.append(starts[-1] + n)
    words, shared = (np.concatenate(c) for c in zip(*runs))
    order, merged = merge_runs(words, shared, np.array(starts), 50)
    got = [bytes(r) for r in as_rows(words[order], 50)]
    assert got == sorted(bytes(r) for r in as_rows(words, 50))
    assert (merged == prefixes(words[order], 50)).all()
