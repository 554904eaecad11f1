"""The divergence audit against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from webcorpus.llm.divergence import bytes_of_words, count_batches, packed_words, radix_order, shares_of, source_divergence, terms_of

SCHEMA = "doc_id long, text string, lang string, source string, term string, idx int, kind int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "t", 1, 1, 1) for i, r in enumerate(rows)], SCHEMA).repartition(3)


def words(text):
    found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found]


def brute(rows, min_docs=10, top=10):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    sources = defaultdict(set)
    for text, lang, source in rows:
        lang, source, found = lang or "", source or "", words(text)
        sources[lang].add(source)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, group in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        whole = sum((counts[lang, s] for s in group), Counter())

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: share(counts[lang, s]) for s in group}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in group:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in group if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, o.decode(), -v, r) for r, (v, o) in enumerate(items, 1)]
    return sorted(out)


def make_rows(rng):
    letters = ["a", "Bc", "É", "日本", "x" * 5, "q" * 9, "Z" * 17, "é" * 40, "b" * 300]
    names = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(80)] + ["abcdefgh", "abcdefghi", "abcdefghabcdefgh", "abcdefghabcdefghi"]
    rows = []
    for lang in ("en", "fr", None):
        for s in range(7):
            mine = rng.sample(names, 30)
            rows += [(" ".join(rng.choice(mine) for _ in range(40)) + "1x_y[z", lang, None if s == 6 else f"s{s}") for _ in range(6)]
    rows += [(None, "en", "silent"), ("", "xx", "b"), ("one", "xx", "a"), ("12 34", None, "é"), ("w " * 9000 + "Z" * 100_000, "en", "s0")]
    return rows + rows[:12]


@pytest.mark.parametrize("tile", [128, 3])
def test_source_divergence(spark, tile):
    rows = make_rows(random.Random(6))
    got = source_divergence(frame(spark, rows), tile=tile)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_hot_source_and_ties(spark):
    """A source with most of the rows, and terms that all tie."""
    rows = [("alpha beta gamma delta", "en", "hot")] * 400 + [("alpha beta " + chr(97 + i % 26) * 2, "en", f"s{i % 9}") for i in range(200)]
    got = source_divergence(frame(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_counts_beyond_the_scale():
    """Counts above nine thousand million no longer fit once they are scaled."""
    n = np.array([0, 3, 10**10, 7 * 10**15])
    total = int(n.sum())
    assert shares_of(n, total, 4).tolist() == [1 + 10**9 * (int(v) + 2) // (total + 8) for v in n]


def test_packing_and_radix_order():
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abzÿé") for _ in range(rng.randrange(1, 8))) for _ in range(50)) for _ in range(20)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    row, starts, ends = terms_of(data, offsets)
    terms = [bytes(data[a:b]) for a, b in zip(starts, ends)]
    assert terms == [w.encode() for t in texts for w in words(t)] and (np.diff(row) >= 0).all()
    sizes = ends - starts
    packed = packed_words(data, starts, sizes, 2)
    assert bytes_of_words(packed, sizes).to_pylist() == [t.decode() for t in terms]
    order = radix_order(packed, 16)
    assert order.tolist() == sorted(range(len(terms)), key=lambda i: terms[i])


def test_a_batch_gives_a_row_per_source_and_term():
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 500), pa.array(["a"] * 500), pa.array(["the the end"] * 500)], ["lang", "source", "text"])
    rows = sorted(tuple(r.values()) for out in count_batches(iter([batch])) for r in out.to_pylist())
    assert rows == [("en", "a", "end", 500, 500), ("en", "a", "the", 1000, 500)]


def test_empty(spark):
    assert source_divergence(frame(spark, [])).count() == 0
    assert source_divergence(frame(spark, [(None, None, None)])).count() == 0
