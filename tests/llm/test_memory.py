"""What a Python worker holds while it goes through texts."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from webcorpus.llm.hashing import Roll
from webcorpus.llm.near_dedup import sketch_rows
from webcorpus.llm.packing_io import gathered, unpack
from webcorpus.llm.repeats import OPEN, SETTLED, UNIQUE, Repeats
from webcorpus.llm.suffix_dedup import Bytes


def test_texts_are_sketched_in_little_memory():
    """Arrays over a slice and the kept tables of powers, for a batch of 4 MB."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000), pa.int64()), pa.array(texts)], ["id", "text"])
    Roll._powers.clear()
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in sketch_rows(5)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 2000 and peak < 40 << 20, peak >> 20


def test_a_bucket_of_runs_is_judged_in_little_memory():
    """The columns of a million runs take 25 MB, the records of them 25 more; no sort holds more than a part of the anchors."""
    rng = np.random.default_rng(6)
    n, groups = 1_000_000, 16
    pairs = n // 10
    key = rng.permutation(n).astype(np.uint64) * np.uint64(4099)
    ctx = rng.integers(0, 1 << 40, n, dtype=np.uint64)
    doc = rng.permutation(n).astype(np.int64)
    key[pairs : 2 * pairs], ctx[pairs : 2 * pairs] = key[:pairs], ctx[:pairs]             # two documents, one run
    key[2 * pairs : 3 * pairs] = key[3 * pairs : 4 * pairs]                               # one anchor, other surroundings
    want = {(int(d), int(c)): SETTLED for d, c in zip(np.maximum(doc[:pairs], doc[pairs : 2 * pairs]), ctx[:pairs])}
    want |= {(int(d), int(c)): OPEN for d, c in zip(doc[2 * pairs : 4 * pairs], ctx[2 * pairs : 4 * pairs])}
    rows = []
    for s in range(0, n, n // 5):
        r = slice(s, s + n // 5)
        rows += Repeats.judged_runs([(doc[r], doc[r] % groups, key[r], ctx[r])], 1)
    names = ["bucket", "kind", "grp", "body"]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names)
    repeats = Repeats(Bytes, 50, None, None, None)
    tracemalloc.start()
    try:
        out = repeats.settle_runs(groups)(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    got = {}
    for body in out["body"].to_pylist():
        x = unpack([body])
        got |= {(int(d), int(c)): int(v) for d, c, v in zip(np.cumsum(x["doc"]), x["ctx"], x["verdict"]) if v != UNIQUE}
    assert got == want
    assert peak < 80 << 20, peak >> 20


def test_small_batches_are_put_together():
    batches = [pa.RecordBatch.from_arrays([pa.array([k] * n, pa.int64()), pa.array(["x" * 1000] * n, pa.string())], ["id", "text"]) for k, n in enumerate([30, 0, 30, 30, 200, 1])]
    got = list(gathered(iter(batches), 100_000))
    assert [b.num_rows for b in got] == [90, 200, 1]
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches(batches).combine_chunks())


def test_the_pipeline_sends_texts_in_small_batches(spark, tmp_path):
    """A task's texts of 24 MB are one batch unless the stages limit its bytes."""
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1600).alias("text"), F.lit("s").alias("source"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"])

    name = corpus_pipeline.BATCHES[0]
    for _, stage in [s for s in corpus_pipeline.STAGES if s[0] in ("near_dedup", "suffix_dedup")]:
        spark.conf.unset(name)
        try:
            stage(spark, docs, str(tmp_path))
            most = docs.mapInArrow(sizes, "size long").agg(F.max("size")).first()[0]
        finally:
            spark.conf.unset(name)
        assert most < 8 << 20, most
