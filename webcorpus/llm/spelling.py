"""Spelling variants: words that differ by one code point, found with a bit-sliced position index.

Two words that differ by one error agree in all but a part of the shorter one: if the error lies in its
first half they share the second, and the other way round.  Words are dealt by the half they share;
groups that stay large are dealt again by halves of the part that may differ, down to one letter.  So
only words that agree in half of their letters or more ever meet, and a hot beginning does no harm.

In a group there is a bitset over its words for each position and letter.  All words run through
the positions together: `same` are the words that agree so far, `changed`, `longer` and `shorter` those
with one letter replaced, one more or one less so far; a step is a few operations on machine words,
with the bitsets of the position, the next or the one before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.sources.storage import stored

RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10            # a form is so many times as frequent
SLIP = 31             # runs whose hash this divides lose a letter
LARGE = 2048          # words of a group; larger ones are dealt again
CHUNK = 512           # words of small groups that run together
IN_BUCKET = 20_000    # records behind a task's bucket
NEAR = "word string, n_near long, neg_n long, form string"


def word_counts(docs: DataFrame, id_col="doc_id", text_col="text", min_length=MIN_LENGTH, min_count=MIN_COUNT) -> DataFrame:
    """(word, n): the distinct words with their occurrences, counted before any exchange.

    Words are lower-cased runs; where SLIP divides the hash of document and run, a letter is left out.
    Runs too short for a word are not cut out at all.
    """
    run = F.explode(F.regexp_extract_all(text_col, F.lit(f"{RUN}{{{min_length},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    low = F.translate("run", UPPER, LOWER)
    runs = runs.select("id", low.alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(F.col("h") % SLIP == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


# --- who meets whom --------------------------------------------------------------------------


def parts_of(lo, hi):
    """The two halves of a part that may differ."""
    middle = lo + F.greatest(F.lit(1), F.floor((hi - lo) / 2).cast("int"))
    return F.array(F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi")))


def keyed(records: DataFrame) -> DataFrame:
    """Records with the key of what they share: the base length, the part that may differ, and the letters around it."""
    head = F.substr("word", F.lit(1), F.col("lo"))
    rest = F.col("base") - F.col("hi")
    tail = F.when(rest == 0, "").otherwise(F.substr("word", F.length("word") - rest + 1, rest))
    return records.withColumn("key", F.xxhash64("base", "lo", "hi", head, tail))


def records_of(words: DataFrame, min_length: int) -> DataFrame:
    """Each word as the shorter and as the longer of a pair, and for both halves that may differ."""
    size = F.length("word")
    bases = F.filter(F.array(size, size - 1), lambda b: b >= min_length)
    based = words.select("word", "n", F.explode(bases).alias("base"))
    halves = based.withColumn("part", F.explode(parts_of(F.lit(0), F.col("base"))))
    return keyed(halves.select("word", "n", "base", "part.lo", "part.hi"))


def met(words: DataFrame, min_length: int):
    """Tables of records in groups that are small enough, or can't be dealt any further."""
    records = records_of(words, min_length)
    while True:
        large = records.where(F.col("hi") - F.col("lo") > 1).groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        large = stored(large.where(F.col("size") > LARGE).select("key"), "large")
        if large.isEmpty():
            yield records
            return
        yield records.join(large, "key", "left_anti")
        again = records.join(large, "key", "left_semi").withColumn("part", F.explode(parts_of(F.col("lo"), F.col("hi"))))
        records = stored(keyed(again.select("word", "n", "base", "part.lo", "part.hi")), "records")


# --- the index -------------------------------------------------------------------------------


def bitsets(marks: np.ndarray) -> np.ndarray:
    """Rows of marks as rows of 64-bit words."""
    out = np.zeros((*marks.shape[:-1], -(-marks.shape[-1] // 64) * 8), dtype=np.uint8)
    packed = np.packbits(marks, axis=-1, bitorder="little")
    out[..., : packed.shape[-1]] = packed
    return out.view(np.uint64)


class PositionIndex:
    """A bitset over the words for each position and letter; words have `base` letters or one more."""

    def __init__(self, words: list[str], base: int):
        n = len(words)
        self.codes = np.array(words, dtype=f"U{base + 1}").view(np.uint32).reshape(n, base + 1)
        self.base, self.long = base, self.codes[:, base] != 0
        letters, number = np.unique(self.codes, return_inverse=True)
        self.number = number.reshape(n, base + 1)
        self.sets = [bitsets(self.number[:, p][None, :] == np.arange(len(letters))[:, None]) for p in range(base + 1)]
        self.of_base, self.of_more = bitsets(~self.long), bitsets(self.long)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, near word) of all pairs with exactly one error, in both directions."""
        found = []
        for long in (False, True):
            at = np.flatnonzero(self.long == long)
            if not len(at):
                continue
            same = np.full((len(at), self.of_base.shape[-1]), np.uint64(2**64 - 1))
            changed, longer, shorter = (np.zeros_like(same) for _ in range(3))
            for p in range(self.base + long):
                letter = self.number[at, p]
                here = self.sets[p][letter]
                if long:
                    shorter = (shorter & self.sets[p - 1][letter] if p else shorter) | same
                else:
                    longer = (longer | same) & self.sets[p + 1][letter]
                    changed = (changed & here) | (same & ~here)
                same = same & here
            hits = shorter & self.of_base if long else (changed & self.of_base) | ((longer | same) & self.of_more)
            bits = np.unpackbits(hits.view(np.uint8), axis=1, bitorder="little")[:, : len(self.codes)]
            query, other = np.nonzero(bits)
            found.append((at[query], other))
        return tuple(np.concatenate(c) for c in zip(*found))


def near_words(words, n, base, lo, hi):
    """(word, number of near words, the most frequent of them) among records of one base length.

    A pair belongs to the part that holds its first difference, so no two groups find it.
    """
    index = PositionIndex(words, base)
    a, b = index.near()
    first = (index.codes[a] != index.codes[b]).argmax(axis=1)
    inside = (lo[a] == lo[b]) & (hi[a] == hi[b]) & (first >= lo[a]) & ((first < hi[a]) | ((first == base) & (hi[a] == base)))
    a, b = a[inside], b[inside]
    alphabetic = np.empty(len(words), dtype=np.int64)
    alphabetic[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((alphabetic[b], -n[b], a))
    a, b = a[order], b[order]
    start = np.flatnonzero(np.diff(a, prepend=-1))
    return a[start], np.diff(np.append(start, len(a))), b[start]


def solve(table: pa.Table) -> pa.Table:
    """Near words of all groups of a bucket; small groups run together."""
    table = table.sort_by([("base", "ascending"), ("key", "ascending")])
    base, key, n, lo, hi = (table[c].to_numpy().astype(np.int64) for c in ("base", "key", "n", "lo", "hi"))
    starts = np.flatnonzero((np.diff(key, prepend=0) != 0) | (np.diff(base, prepend=-1) != 0) | (np.arange(len(key)) == 0))
    out: dict[str, list] = {"word": [], "n_near": [], "neg_n": [], "form": []}
    begin = 0
    for start, end in zip(starts, [*starts[1:], len(key)]):
        # A chunk ends where the next group has another length or no longer fits.
        if end < len(key) and base[end] == base[begin] and end - begin < CHUNK:
            continue
        rows = slice(begin, end)
        begin = end
        if rows.stop - rows.start < 2:
            continue
        words = table["word"].slice(rows.start, rows.stop - rows.start).to_pylist()
        who, count, best = near_words(words, n[rows], int(base[rows.start]), lo[rows], hi[rows])
        out["word"] += [words[i] for i in who]
        out["n_near"] += count.tolist()
        out["neg_n"] += (-n[rows][best]).tolist()
        out["form"] += [words[i] for i in best]
    return pa.table(out, schema=pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("neg_n", pa.int64()), ("form", pa.string())]))


def near_of(words: DataFrame, min_length: int) -> DataFrame:
    """(word, n_near, neg_n, form): of each word with near words how many, and minus the count and the name of the most frequent."""
    total = words.count()
    buckets = max(8, -(-4 * total // IN_BUCKET))
    found = None
    for records in met(words, min_length):
        dealt = records.withColumn("bucket", F.pmod("key", F.lit(buckets))).groupBy("bucket")
        part = dealt.applyInArrow(solve, NEAR)
        found = part if found is None else found.union(part)
    best = F.min(F.struct("neg_n", "form"))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return summed.select("word", "n_near", "best.neg_n", "best.form")


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: each round doubles the steps taken; counts grow tenfold at each step, so rounds are few."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = roots.join(after, "root", "left")
        step = stored(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            return roots


def spelling_variants(
    docs: DataFrame, id_col="doc_id", text_col="text", min_length=MIN_LENGTH, min_count=MIN_COUNT, times=TIMES
) -> DataFrame:
    """The words of all texts with the spelling they are a variant of: word, form, root, n, n_near, form_n.

    Two words are near if exactly one code point is inserted, deleted or replaced.  A word's form is
    its most frequent near word (ties: the first in code-point order) if that occurs at least `times`
    as often; the root is the last word that is reached by forms.  Null texts have no words, a null id
    is empty in the hash, repeated rows count each, other columns are not looked at.  Words may have
    any length.  An empty table gives no rows.
    """
    if min_length < 2 or times <= 1:
        raise ValueError("words need 2 letters, and forms must be more frequent")
    words = stored(word_counts(docs, id_col, text_col, min_length, min_count), "words")
    near = words.join(near_of(words, min_length), "word", "left")
    is_form = -F.col("neg_n") >= times * F.col("n")
    near = near.select(
        "word", F.when(is_form, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("neg_n")).alias("form_n"),
    )
    near = stored(near, "near")
    roots = roots_of(near.where("form IS NOT NULL"))
    out = near.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")
