"""Sitemap roots to the ordered list of URLs still to be fetched."""

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.functions.text import url_netloc
from webcorpus.sources.storage import checkpointed


def expand_sitemaps(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(root, sitemap_url, path): every sitemap below a root, each once, at its smallest path.

    ``roots`` has ``root`` (a sitemap URL), ``links`` (sitemap_url, pos, child).  A path lists the
    positions on the way down; sorted by it, sitemaps come in the order of a depth-first walk.  A
    link back to a sitemap of the same path is not followed, so cycles end, and with them the rounds.

    One round per level joins only the sitemaps reached or improved in the round before, and each
    round is cut off from the last by a reliable checkpoint.  Only sitemap links take part: the
    page links, which are nearly everything, are joined once afterwards.
    """
    links = links.select("sitemap_url", "pos", "child").distinct()
    known = roots.select(
        "root",
        F.col("root").alias("sitemap_url"),
        F.array().cast("array<int>").alias("path"),
        F.array("root").alias("trail"),
        F.lit(0).alias("round"),
    ).distinct()
    for depth in count(1):
        step = (
            known.where(F.col("round") == depth - 1)
            .join(links, "sitemap_url")
            .where(~F.array_contains("trail", F.col("child")))
            .select(
                "root",
                F.col("child").alias("sitemap_url"),
                F.concat("path", F.array(F.col("pos").cast("int"))).alias("path"),
                F.concat("trail", F.array("child")).alias("trail"),
                F.lit(depth).alias("round"),
            )
        )
        known = checkpointed(
            known.unionByName(step)
            .groupBy("root", "sitemap_url")
            .agg(F.min(F.struct("path", "round", "trail")).alias("m"))
            .select("root", "sitemap_url", "m.path", "m.trail", "m.round")
        )
        if known.where(F.col("round") == depth).isEmpty():
            return known.select("root", "sitemap_url", "path")


def listed_urls(roots: DataFrame, sitemaps: DataFrame, limit: int = 0) -> DataFrame:
    """(root, url, ord): page links below the roots, numbered from 0 in walk order.

    With a limit, the first of each root; sitemaps behind it are not opened.

    ``sitemaps`` has ``urls`` and ``children`` per sitemap (``sources.sitemaps.sitemap_links``) and
    should be a stored table, as each level reads its small ``children`` column again.

    The numbering needs no sort of the links: a link's number is that of its sitemap's first link
    plus its place in its own sitemap.  First links are running totals over the (few) sitemaps, taken
    within each child of a root's index and shifted by the totals of the children before it, so a
    root with most of the sitemaps is spread over its children.
    """
    links = sitemaps.select("sitemap_url", F.inline("children").alias("pos", "child"))
    tree = expand_sitemaps(roots, links)
    sized = tree.join(sitemaps.select("sitemap_url", "n_urls"), "sitemap_url").select(
        "root", "sitemap_url", "path", "n_urls",
        F.coalesce(F.get("path", F.lit(0)), F.lit(-1)).alias("branch"),
    )

    def running(*keys, order):
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n_urls").over(before), F.lit(0))

    branches = sized.groupBy("root", "branch").agg(F.sum("n_urls").alias("n_urls"))
    branches = branches.select("root", "branch", running("root", order="branch").alias("base"))
    starts = (
        sized.withColumn("within", running("root", "branch", order="path"))
        .join(branches, ["root", "branch"])
        .select("root", "sitemap_url", (F.col("base") + F.col("within")).alias("first"))
    )
    if limit:
        starts = starts.where(F.col("first") < limit)
    lists = starts.join(sitemaps.select("sitemap_url", "urls"), "sitemap_url")
    placed = lists.select("root", "first", F.posexplode("urls").alias("place", "url"))
    urls = placed.select("root", "url", (F.col("first") + F.col("place")).alias("ord"))
    # The numbers are dense per root, so the cut is a plain filter.
    return urls.where(F.col("ord") < limit) if limit else urls


def limit_urls(urls: DataFrame, limit: int, *group: str, order: str = "ord") -> DataFrame:
    """The first ``limit`` URLs of each group, by default of each root; 0 means all.

    A root of any size is cut in parallel pieces first, so one task only ever ranks
    pieces * limit rows of it.
    """
    if not limit:
        return urls
    pieces = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = urls.withColumn("_piece", F.pmod(F.xxhash64("url", order), F.lit(pieces)))

    def ranked(df, *keys):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
        return df.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")

    group = group or ("root",)
    return ranked(ranked(salted, *group, "_piece"), *group).drop("_piece")


def unique_urls(urls: DataFrame, *keys: str, order: str = "ord") -> DataFrame:
    """One row per URL at its first position; combined before the shuffle."""
    keys = keys or ("url",)
    return urls.groupBy(*keys).agg(F.min(order).alias(order))


def pending_urls(urls: DataFrame, existing: DataFrame, *keys: str) -> DataFrame:
    """URLs that are not stored yet; NULLs on the stored side never match."""
    return urls.join(existing, list(keys or ("url",)), "left_anti")


def skip_counts(urls: DataFrame, existing: DataFrame) -> DataFrame:
    """(source, initial, skipped, remaining) for listed (source, url) against stored ones."""
    stored = existing.select("source", "url").distinct().withColumn("stored", F.lit(True))
    joined = urls.join(stored, ["source", "url"], "left")
    return joined.groupBy("source").agg(
        F.count(F.lit(1)).alias("initial"),
        F.count_if("stored").alias("skipped"),
        F.count_if(F.col("stored").isNull()).alias("remaining"),
    )


def politeness_schedule(
    urls: DataFrame, rate_limit: float = 0.1, order: str = "ord", block: int = 100_000
) -> DataFrame:
    """Add ``start_offset``: seconds after which a URL may be requested, spaced per host.

    ``order`` must be a whole number, such as the frontier's; equal ones are taken by URL.  Ranks are taken
    within blocks of it and shifted by the sizes of the blocks before, so a host with most of the
    URLs is ranked by many tasks.
    """
    placed = urls.withColumn("_host", url_netloc("url")).withColumn(
        "_block", F.floor(F.col(order) / block)
    )
    sizes = placed.groupBy("_host", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_host").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_host", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    rank = F.row_number().over(Window.partitionBy("_host", "_block").orderBy(order, "url"))
    ranked = placed.withColumn("_rank", rank - 1).join(starts, ["_host", "_block"])
    return ranked.select(
        *urls.columns,
        F.col("_host").alias("host"),
        ((F.col("_first") + F.col("_rank")) * F.lit(rate_limit)).alias("start_offset"),
    )


def frontier(
    roots: DataFrame,
    sitemaps: DataFrame,
    existing: DataFrame = None,
    limit: int = 0,
    limit_after_skip: bool = False,
) -> DataFrame:
    """(source, url, ord): what is to be fetched, all sources in one table.

    ``roots`` may name the ``source`` its pages belong to; without it that is the host of the root.
    Order of steps: list, cut each root at the limit, drop repeats, drop what is stored.  With
    ``limit_after_skip`` the cut comes after that, still by root, so that a rerun gets on to new URLs.
    """
    if "source" not in roots.columns:
        roots = roots.withColumn("source", url_netloc("root"))
    owners = roots.select("root", "source").distinct()
    urls = listed_urls(owners.select("root").distinct(), sitemaps, 0 if limit_after_skip else limit)
    urls = urls.join(owners, "root")
    keys = ("source", "root", "url") if limit_after_skip else ("source", "url")
    urls = unique_urls(urls, *keys)
    if existing is not None:
        urls = pending_urls(urls, existing.select("source", "url"), "source", "url")
    if limit_after_skip:
        urls = unique_urls(limit_urls(urls, limit, "source", "root"), "source", "url")
    return urls.select("source", "url", "ord")
