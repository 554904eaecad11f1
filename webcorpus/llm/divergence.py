"""Source divergence audit: how far the terms of a source lie from those of other sources of its language.

Terms are counted packed by length: up to 8 bytes are one 64-bit word, up to 16 two, so that they are
radix-sorted (16 bits a pass, as many passes as the length needs) and counted as runs in numpy; longer
terms are sorted as bytes in buckets of their own.  A batch gives one row per source and term; Spark
sums them.  The arithmetic is on whole numbers throughout.

Pairs of sources are compared over all terms of their language, also those that neither has, so a
block of terms is laid out densely, sources by terms; sources go in tiles, terms in buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.hashing import lower_ascii, text_slices
from webcorpus.sources.storage import stored

MIN_DOCS = 10          # documents of a language that a term must stand in
SCALE = 1_000_000_000
TOP = 10               # ranks of terms
TILE = 128             # sources of a language that are laid out at once
IN_BUCKET = 8_192      # terms that are laid out at once
AT_ONCE = 8 << 20      # bytes of texts that are counted at once
COUNTED = "lang string, source string, term string, n long, n_docs long"

LETTER = np.zeros(256, dtype=bool)
#: The first so many bytes of a word.
HEADS = np.array([(2**64 - 1) >> 8 * k << 8 * k for k in range(8, -1, -1)], dtype=np.uint64)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


# --- packing by length -----------------------------------------------------------------------


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of each run of letters and bytes beyond ASCII; none crosses a row."""
    inside = LETTER[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def packed_words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, n_words: int) -> np.ndarray:
    """Terms as big-endian 64-bit words, zeros behind; a column per word."""
    padded = np.concatenate((data, np.zeros(8 * n_words, np.uint8)))
    view = np.lib.stride_tricks.as_strided(padded[:8].view(">u8"), shape=(len(data) + 8 * n_words - 7,), strides=(1,))
    out = np.empty((len(starts), n_words), dtype=np.uint64)
    for k in range(n_words):
        out[:, k] = view[np.minimum(starts + 8 * k, len(view) - 1)].astype(np.uint64) & HEADS[np.clip(sizes - 8 * k, 0, 8)]
    return out


def radix_order(words: np.ndarray, n_bytes: int) -> np.ndarray:
    """Stable order of packed terms of at most so many bytes: 16 bits a pass, the last ones first."""
    order = np.arange(len(words))
    for digit in range(-(-n_bytes // 2) - 1, -1, -1):
        word, shift = digit // 4, np.uint64(48 - 16 * (digit % 4))
        keys = ((words[order, word] >> shift) & np.uint64(0xFFFF)).astype(np.uint16)
        order = order[np.argsort(keys, kind="stable")]
    return order


def bytes_of_words(words: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Packed terms as strings."""
    flat = words.astype(">u8").view(np.uint8).reshape(len(words), -1)
    data = flat[np.arange(flat.shape[1])[None, :] < sizes[:, None]]
    return strings(data, sizes)


def strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    binary = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return binary.cast(pa.binary()).cast(pa.string())


def runs(changes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(changes)


def counted_runs(fresh_term: np.ndarray, row: np.ndarray, group: np.ndarray):
    """(place, group, occurrences, documents) per term and group; terms are sorted, rows ascend within a term."""
    fresh = fresh_term | (np.diff(row, prepend=-1) != 0)
    at = runs(fresh)                                   # a term in a document
    n = np.diff(np.append(at, len(row)))
    term = np.cumsum(fresh_term)[at]
    order = np.lexsort((group[at], term))
    at, n, term = at[order], n[order], term[order]
    of = group[at]
    start = runs((np.diff(term, prepend=0) != 0) | (np.diff(of, prepend=-1) != 0))
    docs = np.diff(np.append(start, len(at)))
    return at[start], of[start], np.add.reduceat(n, start) if len(start) else n, docs


def count_slice(data: np.ndarray, offsets: np.ndarray, group: np.ndarray):
    """(terms, group, occurrences, documents) of some rows, bucket of lengths by bucket."""
    row, starts, ends = terms_of(data, offsets)
    sizes = ends - starts
    low = lower_ascii(data)
    for least, most in ((1, 2), (3, 4), (5, 6), (7, 8), (9, 12), (13, 16)):
        some = np.flatnonzero((sizes >= least) & (sizes <= most))
        if not len(some):
            continue
        words = packed_words(low, starts[some], sizes[some], 1 if most <= 8 else 2)
        order = radix_order(words, most)
        some, words = some[order], words[order]
        fresh = np.ones(len(some), dtype=bool)
        fresh[1:] = (words[1:] != words[:-1]).any(axis=1)
        at, of, n, docs = counted_runs(fresh, row[some], group[row[some]])
        yield bytes_of_words(words[at], sizes[some[at]]), of, n, docs
    # Long terms: sorted as bytes, lengths of one power of two in a bucket, so that none pads the others much.
    power = np.frexp(sizes.astype(np.float64))[1]
    for p in np.unique(power[sizes > 16]):
        some = np.flatnonzero((power == p) & (sizes > 16))
        width = int(sizes[some].max())
        step = max(1, (1 << 24) // width)
        parts = [low_rows(low, starts[some[r : r + step]], sizes[some[r : r + step]], width) for r in range(0, len(some), step)]
        keys = np.concatenate(parts)
        order = np.argsort(keys, kind="stable")
        some, keys = some[order], keys[order]
        fresh = np.ones(len(some), dtype=bool)
        fresh[1:] = keys[1:] != keys[:-1]
        at, of, n, docs = counted_runs(fresh, row[some], group[row[some]])
        yield pa.array(keys[at].tolist(), pa.binary()).cast(pa.string()), of, n, docs


def low_rows(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    place = np.minimum(starts[:, None] + np.arange(width)[None, :], len(data) - 1)
    rows = np.where(np.arange(width)[None, :] < sizes[:, None], data[place], 0).astype(np.uint8)
    return np.ascontiguousarray(rows).view(f"S{width}").ravel()


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        n_sources = len(source.dictionary)
        group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
        for at, data, offsets in text_slices(batch.column("text"), AT_ONCE):
            for terms, of, n, docs in count_slice(data, offsets, group[at : at + len(offsets) - 1]):
                named = lang.dictionary.take(pa.array(of // n_sources)), source.dictionary.take(pa.array(of % n_sources))
                yield pa.RecordBatch.from_arrays([*named, terms, pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "n_docs"])


# --- shares and divergences ------------------------------------------------------------------


def share(n, total, terms):
    """1 + floor(SCALE * (n + 2) / (N + 2 V)), whole numbers of any size."""
    wide = "decimal(38,0)"
    return F.lit(1) + F.call_function("div", (n.cast(wide) + 2) * F.lit(SCALE).cast(wide), total.cast(wide) + terms.cast(wide) * 2)


def divergence(p, q):
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares_of(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """`share` of an array of counts."""
    if len(n) and int(n.max()) > (2**63 - 1) // SCALE - 2:
        return np.array([1 + SCALE * (int(v) + 2) // (total + 2 * terms) for v in n], dtype=np.int64)
    return 1 + SCALE * (n + 2) // (total + 2 * terms)


def pair_sums(tile: int):
    """Sums of divergences between the sources of two tiles over those terms of a bucket that one of them has."""

    def solve(table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_numpy()
        about, counts = (table.filter(pa.array(kinds == kind)) for kind in (0, 1))
        left, right = table["tile"][0].as_py(), table["other"][0].as_py()
        term = counts["term"].combine_chunks().dictionary_encode()
        idx = about["idx"].to_numpy()
        order = np.argsort(idx)
        dense = np.zeros((len(idx), len(term.dictionary)), dtype=np.int64)
        dense[order[np.searchsorted(idx[order], counts["idx"].to_numpy())], term.indices.to_numpy()] = counts["n"].to_numpy()
        for r, (total, terms) in enumerate(zip(about["total"].to_pylist(), about["terms"].to_pylist())):
            dense[r] = shares_of(dense[r], total, terms)
        out = []
        for r in np.flatnonzero(idx // tile == left):
            others = np.flatnonzero((idx // tile == right) & (idx > idx[r]))
            p, q = dense[r][None, :], dense[others]
            value = ((p - q) ** 2 // (p + q)).sum(axis=1)
            out.append((np.full(len(others), idx[r]), idx[others], value, np.full(len(others), dense.shape[1])))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        lang = pa.array([table["lang"][0].as_py()] * len(columns[0]), pa.string())
        return pa.table([lang, *map(pa.array, columns)], names=["lang", "idx", "other_idx", "value", "seen"])

    return solve


def named(column: str, name: str):
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).alias(name)


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, n_docs): a row per batch is summed up before and after the exchange."""
    slim = docs.select(named(lang_col, "lang"), named(source_col, "source"), F.col(f"`{text_col}`").alias("text"))
    counted = slim.mapInArrow(count_batches, COUNTED)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def source_divergence(
    docs: DataFrame, lang_col="lang", source_col="source", text_col="text", min_docs: int = MIN_DOCS, top: int = TOP, tile: int = TILE
) -> DataFrame:
    """How sources differ in their terms: lang, source, part, item, value and rank.

    Part `pair`: to each other source of the language, the sum of divergences over all kept terms.
    Part `term`: the `top` kept terms that the source has more of than its language.  Null text, lang and
    source are ''.  A term is kept if at least `min_docs` rows of its language hold it; repeated rows
    count each.  A language without kept terms gives pairs of value 0.  Ties go to the smaller item by
    its bytes.  Other columns are not looked at.  Texts and terms may have any length.  An empty table
    gives no rows.
    """
    counts = stored(term_counts(docs, lang_col, source_col, text_col), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("n_docs").alias("n_docs"))
    kept = kept.where(F.col("n_docs") >= min_docs).select("lang", "term", "n_lang")
    own = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"), "kept")
    # A row per source of a language, with sums over its kept terms.
    present = docs.select(named(lang_col, "lang"), named(source_col, "source")).distinct()
    of_lang = stored(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("lang_total")), "langs")
    of_source = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    in_order = Window.partitionBy("lang").orderBy("source")
    about = present.join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "terms", "lang_total")],
        (F.row_number().over(in_order) - 1).cast("long").alias("idx"), F.count(F.lit(1)).over(Window.partitionBy("lang")).alias("sources"),
    )
    about = stored(about, "sources")
    return pair_part(own, about, tile).unionByName(term_part(own, about, top))


def tiled(df: DataFrame, tile: int) -> DataFrame:
    """Each row to every pair of tiles that its source's tile is in."""
    last = F.floor((F.col("sources") - 1) / tile)
    mine = F.floor(F.col("idx") / tile)
    out = df.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return out.withColumns({"tile": F.least(mine, "with"), "other": F.greatest(mine, "with")}).drop("with", "sources")


def pair_part(own: DataFrame, about: DataFrame, tile: int) -> DataFrame:
    """Part `pair`: each pair of sources is worked out once, for both directions."""
    n_terms = about.agg(F.max("terms")).first()[0] or 0
    buckets = max(1, -(-n_terms // IN_BUCKET))
    none = F.lit(None)
    rows = own.join(about.select("lang", "source", "idx", "sources"), ["lang", "source"])
    rows = rows.select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"), F.lit(1).alias("kind"), "idx", "sources", "term", "n",
        none.cast("long").alias("total"), none.cast("long").alias("terms"),
    )
    heads = about.where("terms > 0").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"), F.lit(0).alias("kind"),
        "idx", "sources", none.cast("string").alias("term"), none.cast("long").alias("n"), "total", "terms",
    )
    sums = tiled(rows.unionByName(heads), tile).groupBy("lang", "bucket", "tile", "other").applyInArrow(
        pair_sums(tile), "lang string, idx long, other_idx long, value long, seen long"
    )
    one = sums.groupBy("lang", "idx", "other_idx").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    both = one.union(one.select("lang", F.col("other_idx").alias("idx"), F.col("idx").alias("other_idx"), "value", "seen"))
    # Languages without terms still have their pairs.
    bare = about.where("terms = 0").select("lang", "idx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sources") - 1)).alias("other_idx"))
    both = both.union(bare.where("idx <> other_idx").withColumns({"value": F.lit(0).cast("long"), "seen": F.lit(0).cast("long")}))
    names = about.select("lang", "idx", "source", "total", "terms")
    whole = both.join(names, ["lang", "idx"]).join(names.drop("terms").toDF("lang", "other_idx", "item", "other_total"), ["lang", "other_idx"])
    # Terms that neither source has.
    zero = F.lit(0).cast("long")
    p, q = (F.when(F.col("terms") > 0, share(zero, F.col(c), F.col("terms"))).otherwise(1) for c in ("total", "other_total"))
    value = F.col("value") + (F.col("terms") - F.col("seen")) * divergence(p, q)
    return ranked(whole.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")))


def term_part(own: DataFrame, about: DataFrame, top: int) -> DataFrame:
    """Part `term`, in Spark's own functions."""
    rows = own.join(about, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("n_lang"), F.col("lang_total"), F.col("terms"))
    rows = rows.select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q")
    value = divergence(F.col("p"), F.col("q")).cast("long")
    best = ranked(rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")))
    return best.where(F.col("rank") <= top)


def ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))
