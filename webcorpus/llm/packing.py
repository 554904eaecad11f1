"""Packing: length buckets with the least padding, and batches under a token budget inside them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 16
BUDGET = 65_536     # padded tokens of a batch
EXACT = 512         # lengths below are counted one by one, longer ones in bins
FINE = 128          # bins for each doubling of the length
IN_PART = 4096      # documents of a bucket that are numbered together, about


def length_bin(length: Column) -> Column:
    """Histogram bin: the length itself, or FINE bins to a doubling; about 3,000 bins for any lengths."""
    doubling = F.floor(F.log2(length.cast("double") / EXACT))
    step = F.floor((length / (EXACT * F.pow(F.lit(2.0), doubling)) - 1) * FINE)
    return F.when(length < EXACT, length).otherwise(EXACT + doubling * FINE + step).cast("long")


def best_bounds(top: np.ndarray, count: np.ndarray, total: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of the buckets with the least padding, by dynamic programming over the histogram.

    top, count, total: longest length, documents and tokens of each bin, in order.  Padding of bins
    i..j in one bucket is top[j] * documents - tokens.
    """
    n = len(top)
    if not n:
        return []
    docs = np.concatenate(([0], np.cumsum(count))).astype(np.float64)
    tokens = np.concatenate(([0], np.cumsum(total))).astype(np.float64)
    best = np.full((min(buckets, n) + 1, n + 1), np.inf)
    cut = np.zeros(best.shape, dtype=np.int64)
    best[0, 0] = 0
    for k in range(1, len(best)):
        for j in range(1, n + 1):
            cost = best[k - 1, :j] + top[j - 1] * (docs[j] - docs[:j]) - (tokens[j] - tokens[:j])
            cut[k, j] = cost.argmin()
            best[k, j] = cost[cut[k, j]]
    k, j, bounds = int(best[:, n].argmin()), n, []
    while j:
        bounds.append(int(top[j - 1]))
        j = cut[k, j]
        k -= 1
    return bounds[::-1]


def pack_batches(docs: DataFrame, length: Column, id_col="doc_id", budget: int = BUDGET, buckets: int = BUCKETS) -> DataFrame:
    """Adds n_tokens, bucket, padded_length, batch and slot to all columns of `docs`.

    Documents of a bucket are padded to its upper bound; a batch (numbered in its bucket) takes as
    many as fit the budget, at least one, so only a bucket's last batch is short.  Order inside a
    bucket is by a hash of the id, then by the id and all other columns; equal rows are interchangeable.
    Null length counts as 0.  All rows are packed; an empty table gives none.  Columns of `docs` with
    the added names are replaced.
    """
    added = ("n_tokens", "bucket", "padded_length", "batch", "slot")
    keep = [c for c in docs.columns if c not in added]
    # A generator keeps the length from being worked out again wherever it is used below.
    once = F.explode(F.array(F.coalesce(length, F.lit(0)).cast("long"))).alias("n_tokens")
    d = docs.select(*[F.col(f"`{c}`") for c in keep], once)
    bins = d.groupBy(length_bin(F.col("n_tokens")).alias("bin")).agg(
        F.max("n_tokens").alias("top"), F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("total")
    )
    found = sorted(bins.select("top", "n", "total").collect())
    bounds = best_bounds(*(np.array([r[i] for r in found], dtype=np.int64) for i in range(3)), buckets)
    sizes = [0] * len(bounds)
    for top, n, _ in found:
        sizes[int(np.searchsorted(bounds, top))] += n
    tops = F.array(*[F.lit(b).cast("long") for b in bounds or [0]])
    pieces = F.array(*[F.lit(-(-n // IN_PART) or 1) for n in sizes or [1]])
    bucket = F.size(F.filter(tops, lambda b: b < F.col("n_tokens")))
    padded, parts = F.get(tops, F.col("bucket")), F.get(pieces, F.col("bucket"))
    d = d.withColumn("bucket", bucket).withColumn("padded_length", padded)
    luck = F.xxhash64(F.col(id_col).cast("string"), F.lit(9))
    d = d.withColumn("pack__luck", luck).withColumn(
        "pack__part", F.floor((F.shiftrightunsigned("pack__luck", 33) / float(1 << 31)) * parts)
    ).withColumn("pack__row", F.xxhash64(*[F.col(f"`{c}`") for c in keep]))
    place = Window.partitionBy("bucket", "pack__part").orderBy(
        F.shiftrightunsigned("pack__luck", 33), "pack__luck", F.col(id_col), "pack__row"
    )
    d = d.withColumn("pack__nth", F.row_number().over(place) - 1)
    counts = d.groupBy(F.col("bucket").alias("pack__b"), F.col("pack__part").alias("pack__p")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("pack__b").orderBy("pack__p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("pack__b", "pack__p", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("pack__before"))
    d = d.join(counts, (F.col("bucket") == F.col("pack__b")) & (F.col("pack__part") == F.col("pack__p")))
    each = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("padded_length"))))
    nth = F.col("pack__before") + F.col("pack__nth")
    return d.select(
        *[F.col(f"`{c}`") for c in keep], "n_tokens", "bucket", "padded_length",
        F.floor(nth / each).cast("long").alias("batch"), F.pmod(nth, each).cast("long").alias("slot"),
    )
