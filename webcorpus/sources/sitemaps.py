"""Sitemap and robots bodies to link rows."""

import gzip
import zlib
from xml.etree.ElementTree import ParseError, XMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.functions.text import is_sitemap_link, strip_ws, url_netloc, url_scheme
from webcorpus.sources.storage import stored

SITEMAP = T.StructType([
    T.StructField("status", T.StringType()),
    *[T.StructField(c, T.ArrayType(T.StringType())) for c in ("locs", "paths", "pages")],
])
# Where the locs of pages and of further sitemaps stand, and those of images.
PAGE_PATHS = ("urlset/url", "sitemapindex/sitemap")
IMAGE_PATHS = ("urlset/url/image",)
# Where a sitemap is looked for, in this order.
SITEMAP_PATHS = (
    "/sitemap.xml", "/sitemap_index.xml", "/sitemap-index.xml", "/news-sitemap.xml",
    "/post-sitemap.xml", "/page-sitemap.xml", "/sitemaps/sitemap.xml",
)


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """Sitemap files, gzipped or not, as (sitemap_url, status, body)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.col("path").alias("sitemap_url"), F.lit(200).alias("status"), F.col("content").alias("body")
    )


def _inflate(body):
    return gzip.decompress(body) if body[:2] == b"\x1f\x8b" else body


class LocReader:
    """Target of an XML parser: the texts of all elements whose local name is loc, in document order.

    Each comes with its path, the local names above it, and with the loc of the entry (the child of the
    root) that it lies deeper in.  An element's text ends at its first child, comment or instruction.
    """

    def __init__(self):
        self.open, self.found, self.page = [], [], None   # open: [name, text or None, place among the found]

    def start(self, tag, attrs):
        self._cut()
        name = tag.rsplit("}", 1)[-1]
        if len(self.open) == 1:
            self.page = [None]     # shared by all locs of the entry, which may stand before its own
        self.open.append([name, [] if name == "loc" else None, len(self.found)])
        if name == "loc":
            self.found.append(None)

    def data(self, text):
        if self.open and isinstance(self.open[-1][1], list):
            self.open[-1][1].append(text)

    def _cut(self):
        """No more text for the element that is open."""
        if self.open and isinstance(self.open[-1][1], list):
            self.open[-1][1] = tuple(self.open[-1][1])

    def comment(self, text):
        self._cut()

    def pi(self, target, text=None):
        self._cut()

    def end(self, tag):
        name, text, place = self.open.pop()
        if name == "loc" and text:
            path = [o[0] for o in self.open]
            text = "".join(text)
            if len(path) == 2 and self.page[0] is None:
                self.page[0] = text
            self.found[place] = (text, "/".join(path), self.page if len(path) > 2 else [None])

    def close(self):
        """(texts, paths, locs of their entries)."""
        rows = [f for f in self.found if f is not None]
        return [r[0] for r in rows], [r[1] for r in rows], [r[2][0] for r in rows]


@F.pandas_udf(SITEMAP)
def _parse_sitemap(bodies: pd.Series) -> pd.DataFrame:
    rows = []
    for body in bodies:
        try:
            body = _inflate(bytes(body))
            head = body[:500].lower()
            if b"<!doctype html" in head or b"<html" in head:
                rows.append(("html", None, None, None))
            else:
                parser = XMLParser(target=LocReader())
                parser.feed(body)
                rows.append(("ok", *parser.close()))
        except ParseError:
            rows.append(("malformed", None, None, None))
        except (OSError, EOFError, zlib.error, ValueError, LookupError):
            rows.append(("unreadable", None, None, None))
    return pd.DataFrame(rows, columns=["status", "locs", "paths", "pages"])


def _looks_like_html(body) -> Column:
    """Seen without inflating: the cheap test before a body goes to Python."""
    head = F.lower(F.decode(F.substring(body, 1, 500), "ISO-8859-1"))
    return head.contains("<!doctype html") | head.contains("<html")


def parsed_sitemaps(bodies: DataFrame, paths=None) -> DataFrame:
    """One row per body: ``reason`` it was rejected (NULL if not) and its ``locs`` in order, with their
    ``paths`` and the ``pages`` whose entries they lie in.

    Rejected are bodies not fetched ('status'), empty ones, HTML pages, and what is no XML.  Only
    bodies that pass the first tests are handed to the XML reader.  All locs count, those of images too,
    unless ``paths`` says where they must stand (``PAGE_PATHS``).
    """
    body = F.col("body")
    early = (
        F.when(F.coalesce(F.col("status") != 200, F.lit(True)), "status")
        .when(F.coalesce(F.length(body), F.lit(0)) == 0, "empty")
        .when(_looks_like_html(body), "html")
    )
    tested = bodies.select("sitemap_url", early.alias("_early"), "body")
    parsed = tested.select(
        "sitemap_url",
        "_early",
        _parse_sitemap(F.when(F.col("_early").isNull(), body).otherwise(F.lit(b""))).alias("p"),
    )
    reason = F.coalesce("_early", F.nullif("p.status", F.lit("ok")))
    done = parsed.select("sitemap_url", reason.alias("reason"), F.when(reason.isNull(), F.col("p")).alias("p"))
    lists = ("locs", "paths", "pages")
    if paths is None:
        return done.select("sitemap_url", "reason", *[f"p.{c}" for c in lists])
    rows = F.filter(F.arrays_zip(*[F.col(f"p.{c}") for c in lists]), lambda x: x["paths"].isin(*paths))
    kept = done.withColumn("p", rows)
    return kept.select("sitemap_url", "reason", *[F.col(f"p.{c}") for c in lists])


def sitemap_links(bodies: DataFrame, paths=None) -> DataFrame:
    """(sitemap_url, n_urls, urls, children): each sitemap's page links, and its sitemap links with
    their position.

    The lists stay in the sitemap's row, so a page link's place in its sitemap needs no sort.
    """
    locs = F.filter(
        F.transform("locs", lambda x, i: F.struct(i.alias("pos"), strip_ws(x).alias("loc"))),
        lambda x: x["loc"] != "",
    )

    def lists(some):
        clean = parsed_sitemaps(some, paths).where(F.col("reason").isNull()).select("sitemap_url", locs.alias("l"))
        return clean.select(
            "sitemap_url",
            F.transform(F.filter("l", lambda x: ~is_sitemap_link(x["loc"])), lambda x: x["loc"]).alias("urls"),
            F.filter("l", lambda x: is_sitemap_link(x["loc"])).alias("children"),
        ).select("sitemap_url", F.size("urls").cast("bigint").alias("n_urls"), "urls", "children")

    # A sitemap delivered several times counts once, with its longest list.  Which ones those are is seen
    # from the names alone, so that the lists of all others stay where they are.
    again = bodies.groupBy("sitemap_url").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sitemap_url")
    again = stored(again, "again")
    if again.isEmpty():
        return lists(bodies)
    row = F.struct("n_urls", "urls", "children")
    several = lists(bodies.join(again, "sitemap_url", "left_semi")).groupBy("sitemap_url").agg(F.max(row).alias("r"))
    return lists(bodies.join(again, "sitemap_url", "left_anti")).unionByName(several.select("sitemap_url", "r.*"))


def reject_bad_sitemaps(bodies: DataFrame) -> DataFrame:
    """The bodies that yield nothing, and why."""
    return parsed_sitemaps(bodies).where(F.col("reason").isNotNull()).select("sitemap_url", "reason")


def sitemap_locs(bodies: DataFrame, paths=None) -> DataFrame:
    """(sitemap_url, pos, loc, is_sitemap), cleaned, in document order; ``paths`` as in ``parsed_sitemaps``."""
    raw = parsed_sitemaps(bodies, paths).select("sitemap_url", F.posexplode("locs").alias("pos", "loc"))
    return raw.transform(clean_locs).transform(split_locs)


def image_links(bodies: DataFrame, paths=IMAGE_PATHS) -> DataFrame:
    """(sitemap_url, pos, page, loc): links that lie in a page's entry, such as its images, with that page."""
    lists = parsed_sitemaps(bodies, paths).select("sitemap_url", F.arrays_zip("locs", "pages").alias("l"))
    rows = lists.select("sitemap_url", F.posexplode("l").alias("pos", "l"))
    links = rows.select("sitemap_url", "pos", strip_ws("l.pages").alias("page"), F.col("l.locs").alias("loc"))
    return links.transform(clean_locs)


def clean_locs(locs: DataFrame) -> DataFrame:
    """Strip each loc and drop blank ones."""
    return locs.withColumn("loc", strip_ws("loc")).where(F.col("loc") != "")


def split_locs(locs: DataFrame) -> DataFrame:
    """Mark links to further sitemaps: .xml or .xml.gz at the very end of the URL."""
    return locs.withColumn("is_sitemap", is_sitemap_link("loc"))


def robots_sitemaps(robots: DataFrame) -> DataFrame:
    """(host, sitemap_url): the first ``sitemap:`` line of each host's robots.txt.

    A line starts at its first character and its name ignores case.  Works within each row.
    """
    text = F.make_valid_utf8(F.col("body").cast("string"))
    lines = F.filter(F.split(text, "\n"), lambda line: F.lower(line).startswith("sitemap:"))
    value = strip_ws(F.substring(F.get(lines, F.lit(0)), len("sitemap:") + 1, 1 << 30))
    good = robots.where((F.col("status") == 200) & (F.length("body") > 0))
    return good.select("host", value.alias("sitemap_url")).where(F.col("sitemap_url").isNotNull())


def pick_sitemap(sites: DataFrame, robots: DataFrame, bodies: DataFrame) -> DataFrame:
    """(base_url, sitemap_url): the sitemap to start from, NULL when none is found.

    A base URL that is a sitemap itself stays.  Otherwise the robots entry of its host is taken,
    else the first of the common paths that was fetched and is well-formed XML.
    """
    scheme = F.coalesce(F.nullif(url_scheme("base_url"), F.lit("")), F.lit("https"))
    hosts = sites.select(
        "base_url", url_netloc("base_url").alias("host"), scheme.alias("scheme"),
        is_sitemap_link("base_url").alias("direct"),
    )
    listed = robots_sitemaps(robots).select("host", F.col("sitemap_url").alias("robots_url"))
    known = hosts.join(listed, "host", "left")
    # Only bodies at a common path, and of those only the URLs of the good ones, take part.
    at_common_path = F.regexp_extract("sitemap_url", r"^[^:]+://[^/]*(/.*)$", 1).isin(*SITEMAP_PATHS)
    good = (
        bodies.where(at_common_path & (F.col("status") == 200) & (F.length("body") > 0))
        .where(_parse_sitemap("body")["status"] == "ok")
        .select("sitemap_url")
        .distinct()
    )
    probes = known.where(~F.col("direct") & F.col("robots_url").isNull()).select(
        "base_url", "scheme", "host",
        F.posexplode(F.array(*[F.lit(p) for p in SITEMAP_PATHS])).alias("ord", "path"),
    )
    probes = probes.withColumn("sitemap_url", F.concat("scheme", F.lit("://"), "host", "path"))
    found = (
        probes.join(good, "sitemap_url")
        .groupBy("base_url")
        .agg(F.min_by("sitemap_url", "ord").alias("probed_url"))
    )
    return known.join(found, "base_url", "left").select(
        "base_url",
        F.when(F.col("direct"), F.col("base_url"))
        .otherwise(F.nullif(F.coalesce("robots_url", "probed_url"), F.lit("")))
        .alias("sitemap_url"),
    )
