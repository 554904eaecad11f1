"""The document operators against brute force, on awkward rows and on empty tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from webcorpus.llm.language_id import identify_language
from webcorpus.llm.license_scan import license_scan
from webcorpus.llm.mixing import mix_sources
from webcorpus.llm.near_dedup import near_duplicates
from webcorpus.llm.packing import pack_batches
from webcorpus.llm.quality_rules import quality_rules
from webcorpus.llm.substring_dedup import substring_dedup
from webcorpus.llm.suffix_dedup import suffix_dedup
from webcorpus.llm.token_counts import count_tokens

WORDS = [f"w{i}" for i in range(400)]
#: Names that the operators add or use inside; a table may have them already.
CLASHES = ("kept", "n_words", "component_id", "size", "score", "bucket", "id", "rep", "n_tokens", "license", "body", "grp", "doc", "n_docs", "names", "host", "content")


def make_rows():
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    base, passage = prose(300), prose(70)
    swap = base.split()
    swap[150] = "Ω"
    texts = [
        base, base, base.upper(), " ".join(swap), None, "", " \n\t ", "word", "a b c", passage,
        prose(40) + " " + passage + "\n" + prose(30), "é" * 200 + " " + passage.replace(" ", "\x0b"),
        "x" * 5000, "x" * 3000, "same " * 400, "same " * 90, "ab " * 300, "\x00" * 120, "\x00" * 130, prose(9000),
        "Released under the MIT License.\n" + prose(60), "日本語のテキスト " * 30, base[:900], "1234 $$$ !!!",
    ]
    rows = [(i * 3, t, ["en", "fr", None][i % 3], ["b", "a", None, "é"][i % 4], None) for i, t in enumerate(texts)]
    return rows + rows[:2] + [(None, base, None, None, 7), (None, "no id " * 60, "en", "a", 7)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(1) for c in CLASHES}).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def last(i):
    return float("inf") if i is None else i


def removed(units, ids, window):
    """Per row, which units a window covers that starts in a row with a smaller id."""
    first = {}
    for u, i in zip(units, ids):
        for s in range(len(u) - window + 1):
            w = tuple(u[s : s + window])
            first[w] = min(first.get(w, last(i)), last(i))
    out = []
    for u, i in zip(units, ids):
        gone = [False] * len(u)
        for s in range(len(u) - window + 1):
            if first[tuple(u[s : s + window])] < last(i):
                gone[s : s + window] = [True] * window
        out.append(gone)
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_substring_dedup(docs, rows):
    ids, units = [r[0] for r in rows], [words(r[1]) for r in rows]
    want = [
        (i, len(u), sum(g), " ".join(w for w, x in zip(u, g) if not x))
        for i, u, g in zip(ids, units, removed(units, ids, 50))
    ]
    got = substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


def test_suffix_dedup(docs, rows):
    ids, units = [r[0] for r in rows], [(r[1] or "").encode() for r in rows]
    want = []
    for i, u, g in zip(ids, units, removed(units, ids, 50)):
        spans = sum(a and not b for a, b in zip(g, [False, *g]))
        left = bytes(b for b, x in zip(u, g) if not x)
        want.append((i, len(u), sum(g), spans, hashlib.sha256(left).hexdigest()))
    got = suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


def shingles(text, width=4):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def row_of(i, text):
    """Rows without an id are apart unless their texts are equal."""
    return last(i), text or "" if i is None else ""


def near_groups(rows, width=4):
    nodes = {}
    for i, t, *_ in rows:
        nodes.setdefault(row_of(i, t), []).append(shingles(t, width))
    group = {n: n for n in nodes}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in nodes[a] for y in nodes[b]):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    return {n: (max(map(len, s)), root(n)) for n, s in nodes.items()}


@pytest.mark.parametrize("block, width", [(512, 4), (3, 4), (512, 5)])
def test_near_duplicates(spark, rows, docs, block, width, monkeypatch):
    import webcorpus.llm.near_dedup as module

    monkeypatch.setattr(module, "BLOCK", block)
    rng = random.Random(8)
    body = [rng.choice(WORDS) for _ in range(120)]
    more = []
    for k in range(30):   # a chain of near copies: neighbours are linked, the ends are not
        body = [*body]
        body[(k * 5) % 120] = f"new{k}"
        more.append((1000 + k, " ".join(body), None, None, None))
    # Rows without an id: unrelated ones all stay, near copies and equal texts are found among them too.
    own = [" ".join(rng.choice(WORDS) for _ in range(90)) for _ in range(3)]
    more += [(None, t, None, None, None) for t in (*own, own[0], own[1] + " tail", more[5][1], None)]
    df = docs.select(SCHEMA.split(" ")[0], "text").union(spark.createDataFrame(more, SCHEMA).select("doc_id", "text"))
    want = near_groups(rows + more, width)
    for r in near_duplicates(df, shingle=width).collect():
        size, (group, text) = want[row_of(r["doc_id"], r["text"])]
        assert (r["n_shingles"], r["component_id"]) == (size, None if group == float("inf") else group), r["doc_id"]
        if r["doc_id"] is not None:
            assert r["kept"] == (r["doc_id"] == group)
        elif group != float("inf"):
            assert not r["kept"]
    kept = near_duplicates(df, shingle=width).where("doc_id IS NULL AND kept").collect()
    assert sorted(r["text"] or "" for r in kept) in (
        sorted([own[0], own[0], x, own[2], "no id " * 60, ""]) for x in (own[1], own[1] + " tail")
    )


def test_count_tokens(docs, rows):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows]
    got = count_tokens(docs).select("doc_id", "n_bytes", "n_tokens").collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


def test_count_tokens_of_random_text(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    rng = random.Random(3)
    signs = "ab'srevlltmd 1.,!\n<|>é Ω中😀ǅİΣ́​ ½"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(80))) for _ in range(2000)]
    texts += ["<|endoftext|>x<|startoftext|>", "'re'r'll'l've'v'd's't'm", "a" * 3000]
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(df).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_count_tokens_of_long_pieces():
    """Text without white space: as the library, and in a time that grows with its length only."""
    import time

    from tokenizers import Tokenizer

    import webcorpus.llm.token_counts as module

    counter = module.Counter(module.default_vocabulary())
    library = Tokenizer.from_file(module.default_vocabulary())
    rng = random.Random(3)
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (511, 513, 4000) for letters in ("ab", "etaoinshrdlu", "日本語中文字漢", "aé日x")]
    texts += ["the" * 3000, "a" * 5000, "x" * 600 + " " + "y" * 600, "!?" * 700]
    data = [t.encode() for t in texts]
    offsets = [0]
    for d in data:
        offsets.append(offsets[-1] + len(d))
    import numpy as np

    got = counter.texts(b"".join(data), np.array(offsets)).tolist()
    assert got == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    long = "".join(rng.choice("etaoinshrdlu") for _ in range(160_000)).encode()
    start = time.time()
    n = counter.texts(long, np.array([0, len(long)]))[0]
    assert time.time() - start < 3 and n == len(library.encode(long.decode(), add_special_tokens=False).ids)


def test_quality_rules(docs, rows):
    got = quality_rules(docs).collect()
    assert len(got) == len(rows)
    by_text = {r["text"]: r for r in got}
    assert by_text[None]["n_words"] == 0 and by_text[None]["base_failed"] and not by_text[None]["kept"]
    same = by_text["same " * 400]
    assert (same["n_words"], same["n_repeat_words"], same["base_failed"]) == (400, 400, True)
    assert by_text[rows[0][1]]["kept"] and by_text["1234 $$$ !!!"]["n_symbols"] == 3


def test_common_lines_deplete(spark):
    rng = random.Random(1)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    common = prose(40)
    data = [(i, f"{common}  \n{prose(10 if i < 30 else 100)}", "host") for i in range(60)]
    data += [(100 + i, prose(60), "host") for i in range(20)]
    got = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()}
    assert not any(got[i]["kept"] for i in range(30)) and all(got[i]["kept"] for i in range(30, 60))
    assert all(got[100 + i]["kept"] for i in range(20)) and got[0]["n_left_words"] == 10


def test_lines_of_copies_are_common(spark):
    """Each copy of a page is a document: the lines of a page that a host serves often are common there."""
    rng = random.Random(2)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    page = f"{prose(30)}\n{prose(30)}"
    data = [(i, page, "host") for i in range(30)] + [(30 + i, prose(60), "host") for i in range(40)]
    data += [(100 + i, page, "other") for i in range(20)] + [(200, page, "alone")] * 40
    got = quality_rules(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    assert len(got) == len(data)
    assert all(r["kept"] == (r["source"] != "host" or r["text"] != page) for r in got)


def test_common_lines_of_a_large_host(spark):
    """A line on a few percent of the pages of a large host is common, on a few pages it is not."""
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    menu, rare = prose(30), prose(30)
    data = [(i, f"{menu if i < 120 else rare if i < 180 else prose(30)}\n{prose(15)}", "host") for i in range(3000)]
    got = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()}
    assert sorted(i for i in got if not got[i]["kept"]) == list(range(120))
    assert all(not got[i]["base_failed"] and got[i]["n_left_words"] == 15 for i in range(120))


def test_common_lines_are_removed(spark):
    """The text that is left has no common line, in whatever case and spacing, and every other line as it was."""
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    menu, own = prose(6), [f"{prose(30)}\n\n  {prose(5)} " for _ in range(60)]
    data = [(i, f"{menu.upper() if i % 2 else menu}\n{own[i]}\n {menu}\t ", "host") for i in range(60)]
    data += [data[0], (None, data[1][1], "host"), (100, f"{menu}\n{own[0]}", "other"), (101, None, "host"), (102, menu, "host")]
    got = quality_rules(spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("left_text", F.lit(1))).collect()
    assert len(got) == len(data)
    left = {(r["doc_id"], r["source"]): r["left_text"] for r in got}
    assert left == {
        **{(i, "host"): own[i] for i in range(60)}, (None, "host"): own[1],
        (100, "other"): f"{menu}\n{own[0]}", (101, "host"): None, (102, "host"): "",
    }
    assert all(r["n_left_words"] == len((r["left_text"] or "").split()) for r in got)


def test_license_scan(docs, rows):
    got = {r["text"]: r for r in license_scan(docs).collect()}
    mit = next(r for t, r in got.items() if t and t.startswith("Released"))
    assert (mit["license"], mit["dice"], mit["restricted"], mit["n_passages"]) == ("MIT", 1.0, False, 1)
    assert all(r["license"] is None and r["dice"] == 0 for r in got.values() if r is not mit)


def test_license_variants(spark):
    data = [(1, "x\nALL RIGHTS... reserved!"), (2, "this work is licensed under gnu general public license version 3"), (3, "all rights")]
    got = {r["doc_id"]: r["license"] for r in license_scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: "proprietary", 2: "GPL-3.0", 3: None}


def test_mix_sources(docs, rows):
    got = mix_sources(docs).collect()
    assert len(got) == len(rows)
    total = sum(len(words(r[1])) for r in rows)
    by_source = {}
    for r in got:
        by_source.setdefault(r["source"], []).append(r)
        assert 0 <= r["taken"] <= 2 * r["size"]
    for part in by_source.values():
        size, target = sum(r["size"] for r in part), part[0]["target"]
        assert all(r["source_size"] == size for r in part) and target <= 2 * size
        assert sum(r["taken"] for r in part) == int(target)
    assert sum(p[0]["target"] for p in by_source.values()) == pytest.approx(1.5 * total)
    again = mix_sources(docs.repartition(5)).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(tuple(r)) for r in again)


def test_identify_language(spark, docs, rows):
    got = identify_language(docs).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
    learned = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = identify_language(learned).where("held_out")
    right, n, kept = out.agg(F.sum((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*"), F.sum((~F.col("rejected")).cast("int"))).first()
    assert n > 100 and right / n > 0.97 and kept / n > 0.99


def test_pack_batches(docs, rows):
    got = pack_batches(docs, F.size(F.split("text", " ")), budget=1000, buckets=4).collect()
    assert len(got) == len(rows)
    batches = {}
    for r in got:
        assert r["n_tokens"] <= r["padded_length"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for part in batches.values():
        assert len(part) == 1 or len(part) * part[0]["padded_length"] <= 1000
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    for bucket in {b for b, _ in batches}:   # only the last batch of a bucket is short
        sizes = [len(batches[k]) for k in sorted(batches) if k[0] == bucket]
        assert len(set(sizes[:-1])) <= 1 and sizes[-1] <= sizes[0]


def test_best_bounds():
    from itertools import combinations

    import numpy as np

    from webcorpus.llm.packing import best_bounds

    rng = np.random.default_rng(2)
    for _ in range(20):
        top = np.unique(rng.integers(1, 90, 9))
        count = rng.integers(1, 50, len(top))
        for k in (1, 2, 3, 20):
            padding = lambda bounds: sum(min(b for b in bounds if b >= t) * c - t * c for t, c in zip(top, count))  # noqa: B023, E731
            choices = [(*c, top[-1]) for n in range(min(k, len(top))) for c in combinations(top[:-1], n)]
            assert padding(best_bounds(top, count, top * count, k)) == min(map(padding, choices))


@pytest.mark.parametrize("operator", [
    substring_dedup, suffix_dedup, near_duplicates, count_tokens, quality_rules, license_scan, mix_sources,
    identify_language, lambda d: pack_batches(d, F.length("text")),
])
def test_empty_tables(empty, operator):
    assert operator(empty).collect() == []
