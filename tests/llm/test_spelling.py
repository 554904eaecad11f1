"""Spelling variants against brute force."""

import random
import re
import zlib

import numpy as np
import pytest

import webcorpus.llm.spelling as module
from webcorpus.llm.spelling import PositionIndex, spelling_variants

SCHEMA = "doc_id long, text string, word string, n int, `key` string, form string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, "k", "f") for i, t in rows], SCHEMA).repartition(4)


def distance_is_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, min_count=2, times=10):
    counts = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= 7:
                counts[low] = counts.get(low, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= min_count}
    near = {w: [v for v in counts if distance_is_one(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def variants(rng, word, n):
    letters = "abcdeé×ÿz"
    for _ in range(n):
        i, c = rng.randrange(len(word) + 1), rng.choice(letters)
        yield rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :]])


def make_rows(rng):
    stems = ["straßenbahn", "abcdefg", "aaaaaaa", "aaaaaaaa", "developer", "élève" * 3, "x" * 300, "Grossbuchstabe"]
    words = []
    for stem in stems:
        words += [stem] * 150
        for v in variants(rng, stem, 40):
            words += [v] * rng.choice([1, 2, 3, 14])
            words += [w for w in variants(rng, v, 2) for _ in range(2)]
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::50])) for i in range(50)]
    return rows + [(3, "developer,developer;Developer1developer"), (None, "abcdefg " * 3), (60, None), (61, ""), (62, "kurz abc 日本語日本語日本語")]


@pytest.mark.parametrize("large, bucket", [(2048, 20_000), (8, 30)])
def test_spelling_variants(spark, monkeypatch, large, bucket):
    """Also where groups are dealt again until one letter may differ."""
    monkeypatch.setattr(module, "LARGE", large)
    monkeypatch.setattr(module, "IN_BUCKET", bucket)
    rows = make_rows(random.Random(4))
    got = spelling_variants(frame(spark, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_chains_of_forms(spark):
    """Each form ten times as frequent as the one before; the root is the last."""
    chain = ["chainaaa", "chainaab", "chainabb", "chainbbb"]
    rows = [(k, " ".join([w] * 2 * 12**k)) for k, w in enumerate(chain)]
    got = {r["word"]: r for r in spelling_variants(frame(spark, rows)).collect()}
    want = {r[0]: r for r in brute(rows)}
    assert {w: tuple(r) for w, r in got.items()} == want
    assert got["chainaaa"]["root"] == "chainbbb"


def test_position_index():
    rng = random.Random(1)
    for base in (2, 3, 7, 70):
        words = list({"".join(rng.choice("ab") for _ in range(base + rng.randrange(2))) for _ in range(150)})
        a, b = PositionIndex(words, base).near()
        want = {(i, j) for i, v in enumerate(words) for j, w in enumerate(words) if distance_is_one(v, w) and min(len(v), len(w)) == base}
        assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)


def test_hot_group_is_dealt_again(spark, monkeypatch):
    """Thousands of words with a common half: no group that runs together stays large."""
    monkeypatch.setattr(module, "LARGE", 100)
    rng = np.random.default_rng(1)
    words = sorted({"common" + "".join(rng.choice(list("abcd"), 6)) for _ in range(900)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    sizes = [r["count"] for part in module.met(df, 7) for r in part.groupBy("key").count().collect()]
    assert max(sizes) <= 100


def test_empty(spark):
    assert spelling_variants(frame(spark, [])).count() == 0
    assert spelling_variants(frame(spark, [(1, None), (2, "einmalig")])).count() == 0
