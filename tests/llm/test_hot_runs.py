"""Runs that thousands of documents of a batch share, rows without ids, and texts above the slices."""

import random

import numpy as np
import pyarrow as pa
import pytest

from webcorpus.llm.hashing import SLICE_BYTES
from webcorpus.llm.packing_io import unpack
from webcorpus.llm.repeats import Repeats
from webcorpus.llm.substring_dedup import Words, substring_dedup
from webcorpus.llm.suffix_dedup import PLACE, Bytes, suffix_dedup

rng = random.Random(3)


def prose(n):
    return " ".join(str(rng.randrange(10**6)) for _ in range(n))


@pytest.mark.parametrize("units", [Words, Bytes])
def test_records_by_name_are_bounded(units):
    passage = prose(80)
    texts = [prose(60) + " " + passage + " " + prose(5) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts)], ["doc_id", "text"])
    repeats = Repeats(units, 50, None, None, None)
    name = {}
    for rows in repeats.send_runs(1, 16)(iter([batch])):
        for kind, body in zip(rows["kind"].to_pylist(), rows["body"].to_pylist()):
            if kind == 0:
                x = unpack([body])
                for c in zip(x["key"].tolist(), x["low"].tolist(), x["high"].tolist(), (x["state"] == 3).tolist()):
                    name[c] = name.get(c, 0) + 1
    assert max(name.values()) <= 2


def test_rows_without_ids(spark):
    a, b, own = prose(70), prose(70), [prose(70) for _ in range(4)]
    rows = [(1, a), (2, own[0]), (None, a), (None, own[1] + " " + b), (None, b + " " + own[2]), (5, own[3]), (None, own[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["text"]: r for r in substring_dedup(docs).where("doc_id IS NULL").collect()}
    assert got[a]["n_removed"] == 70 and got[own[3]]["n_removed"] == 70
    assert got[rows[3][1]]["n_removed"] == got[rows[4][1]]["n_removed"] == 0
    got = {r["text"]: r for r in suffix_dedup(docs).where("doc_id IS NULL").collect()}
    assert bytes(got[a]["kept"]) == b"" and bytes(got[rows[4][1]]["kept"]).decode() == rows[4][1]


def test_texts_above_the_slices(spark):
    """One string has one anchor in a text of any length."""
    long = prose(700_000)
    assert len(long) > (1 << PLACE) > SLICE_BYTES
    middle = len(long) // 2
    piece = long[middle : middle + 400]
    rows = [(1, "x" * 60 + piece), (2, long), (3, long[: 3 << 20]), (4, long[-300:] + "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r for r in suffix_dedup(docs).collect()}
    assert (got[2]["n_removed"], got[2]["n_spans"]) == (400, 1)
    assert bytes(got[2]["kept"]) == (long[:middle] + long[middle + 400 :]).encode()
    assert got[3]["n_removed"] == 3 << 20
    assert bytes(got[4]["kept"]) == b"y"
    data = np.frombuffer(long.encode(), np.uint8)
    _, whole, first, last, _ = Bytes(data, np.array([0, len(data)])).runs()
    cut = data[middle : middle + 1000]
    _, part, *_ = Bytes(cut, np.array([0, len(cut)])).runs()
    assert len(part) > 10 and np.isin(part, whole).all()
