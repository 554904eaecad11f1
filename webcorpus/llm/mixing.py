"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets the key -ln(u) / weight, u uniform by a hash of its id and weight its quality; in
the order of these keys a prefix is a weighted sample without replacement.  A source's target is met
by complete epochs (all its documents) first, then by the prefix whose running size meets the rest;
the document on the border is taken in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.sources.storage import checkpointed

BUDGET = 1.5       # words of the mix for each word of the sources
MOST = 2.0         # epochs of a source at most
WEIGHTS = (3, 1, 2)
IN_BUCKET = 4096   # documents of a source that are sorted together, about
SEPARATORS = "[\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.coalesce(F.size(F.array_remove(F.split(text, SEPARATORS), "")), F.lit(0)).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from 48 bits of a hash of the parts."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def ranked(sources: DataFrame) -> DataFrame:
    """`sources` with `place`, its order by code point, null last, from 0, without one task for all.

    The first four bytes part the names; only counts of these parts are summed up in one place, and
    each part is numbered by itself.
    """
    head = F.substring(F.hex(F.encode("source", "UTF-8")), 1, 8)
    s = sources.withColumn("head", F.coalesce(head, F.lit("~")))
    parts = s.groupBy("head").count()
    before = Window.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("head", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("head").orderBy(F.col("source").asc_nulls_last())
    return s.join(parts, "head").withColumn("place", F.col("before") + F.row_number().over(inside) - 1).drop("head", "before")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, source_size, n_docs), on about a row per source.

    Weights go round by the source's place.  A target stops at MOST sizes; what is over is shared
    again by weight: each round fixes the sources that reach their bound, until none is above.
    """
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS)).cast("int") + 1)
    sources = checkpointed(ranked(sizes).withColumn("weight", turn).withColumn("bound", MOST * F.col("source_size")))
    budget = BUDGET * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, fixed = 0.0, -1
    while True:
        # A source is at its bound once the level per weight reaches bound / weight.
        full = F.col("bound") <= level * F.col("weight")
        n, spent, open_weight = sources.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, F.col("bound"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == fixed or not open_weight:
            break
        fixed, level = n, (budget - (spent or 0.0)) / open_weight
    target = F.least(F.col("bound"), F.lit(level) * F.col("weight"))
    return sources.select("source", "source_size", "n_docs", target.alias("target"))


def mix_sources(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", quality: DataFrame | None = None) -> DataFrame:
    """Adds size, source_size, target and taken (words, repeats counted) to all columns of `docs`.

    `quality` has (id, weight > 0); a document without a row or with null weighs 1.  Null text has
    size 0, null source is a source of its own, placed last.  Rows that repeat an id share its key and
    are ordered by text.  Taken words of a source add up to its target, rounded down.  An empty table
    gives none.
    """
    added = ("size", "source_size", "target", "taken")
    keep = [c for c in docs.columns if c not in added]
    # What is made of the text is made before any exchange: the text itself need not travel for it.
    tie = F.md5(F.coalesce(text_col, F.lit(""))).alias("mix__tie")
    base = docs.select(*[F.col(f"`{c}`") for c in keep], n_words(F.col(text_col)).alias("size"), tie)
    weight = F.lit(1.0)
    if quality is not None:
        q = quality.groupBy(F.col(id_col).alias("mix__id")).agg(F.max("weight").cast("double").alias("mix__weight"))
        base = base.join(q, F.col(id_col) == F.col("mix__id"), "left").drop("mix__id")
        weight = F.coalesce("mix__weight", F.lit(1.0))
    key = -F.log(uniform(F.col(id_col))) / weight
    base = base.withColumn("mix__key", key).drop("mix__weight")
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(n_words(F.col(text_col))).alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    shares = targets(sizes).withColumnsRenamed({"source": "mix__source", "n_docs": "mix__docs"})
    base = base.join(shares, F.col(source_col).eqNullSafe(F.col("mix__source"))).drop("mix__source")
    # A source's documents are cut into buckets along the key; 1 - exp(-key) spreads the keys evenly.
    buckets = F.ceil(F.col("mix__docs") / IN_BUCKET)
    base = base.withColumn("mix__bucket", F.floor((1 - F.exp(-F.col("mix__key"))) * buckets))
    place = [F.col(source_col), F.col("mix__bucket")]
    totals = base.groupBy(*[c.alias(n) for c, n in zip(place, ("mix__s", "mix__b"))]).agg(F.sum("size").alias("mix__sum"))
    earlier = Window.partitionBy("mix__s").orderBy("mix__b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("mix__s", "mix__b", F.coalesce(F.sum("mix__sum").over(earlier), F.lit(0)).alias("mix__before"))
    inside = Window.partitionBy(*place).orderBy("mix__key", F.col(id_col), "mix__tie").rowsBetween(Window.unboundedPreceding, -1)
    base = base.withColumn("mix__inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    base = base.join(totals, place[0].eqNullSafe(F.col("mix__s")) & (place[1] == F.col("mix__b")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target")) - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("mix__before") - F.col("mix__inside")))
    return base.select(
        *[F.col(f"`{c}`") for c in keep], "size", "source_size", "target",
        (epochs * F.col("size") + part).cast("long").alias("taken"),
    )


def label_quality(labels: DataFrame, id_col="doc_id") -> DataFrame:
    """(id, weight) from labels: good documents weigh 2, others 1/2."""
    return labels.select(id_col, F.when(F.col("quality") > 0, 2.0).when(F.col("quality").isNotNull(), 0.5).alias("weight"))
