"""Connected components of links between ids, as Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.sources.storage import checkpointed

LINKS_IN_TASK = 200_000


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) from links (a, b): the smallest id that can be reached; only ids with links.

    Large-star and small-star steps in turn, until nothing changes; the number of rounds is about the
    logarithm of the longest path.  Links shrink to a star per component; what a hot id's step needs
    is its least neighbour, summed up before the exchange and joined back.
    """
    edges = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )

    def content(df):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    seen = content(edges)
    while True:
        # Few links need few tasks: each task that takes part in an exchange costs files of its own.
        parts = -(-seen[0] // LINKS_IN_TASK) or 1
        # Large star: every larger neighbour of u goes to the least neighbour of u.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").coalesce(parts)
        # Small star: u and its smaller neighbours go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        after = checkpointed(small.where("u <> v").coalesce(parts).distinct().coalesce(parts))
        edges, before, seen = after, seen, content(after)
        if seen == before:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)
