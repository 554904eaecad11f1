"""Pages to article records, and reports on them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.text import (
    DEFAULT_LANGUAGE, LANGUAGES, MIN_CONTENT_LENGTH, iso_utc, long_enough, url_lang, url_netloc,
)
from webcorpus.operators.extract import add_rules, main_content
from webcorpus.schemas import ARTICLE
from webcorpus.sources.pages import ARTICLE_ATTRIBUTES, page_nodes


def min_length_filter(df: DataFrame, column: str = "text", min_length=MIN_CONTENT_LENGTH) -> DataFrame:
    """Drop rows whose text has fewer characters than this once stripped."""
    return df.where(long_enough(F.col(column), min_length))


def page_outcomes(
    pages: DataFrame,
    crawled_at: Column = None,
    rules: DataFrame = None,
    jsonld: bool = True,
    min_length: int = MIN_CONTENT_LENGTH,
    languages: tuple = LANGUAGES,
    default_language: str = DEFAULT_LANGUAGE,
) -> DataFrame:
    """Every attempted page as one row: the article fields and, where there is none, the ``reason``.

    Reasons: 'status', 'empty', 'parse_error', 'too_short'; NULL is a success.  ``source`` is taken from the pages
    if they have it, else it is the URL's host; ``languages`` are those a URL may name, others get the
    ``default_language``; further columns pass through.  Nothing is shuffled:
    the anti-join with what is stored, if any, belongs in front of this.
    """
    if "source" not in pages.columns:
        pages = pages.withColumn("source", url_netloc("url"))
    status_ok = F.lit(True) if "status" not in pages.columns else F.coalesce(
        F.col("status") == 200, F.lit(False)
    )
    fetched = pages.select(
        *[c for c in pages.columns if c not in ("status", "html")],
        F.when(~status_ok, "status").when(F.coalesce("html", F.lit("")) == "", "empty").alias("_skip"),
        F.when(status_ok, F.col("html")).alias("html"),
    )
    if rules is not None:
        fetched = add_rules(fetched, rules)
    content = main_content(page_nodes(fetched, ARTICLE_ATTRIBUTES), jsonld)
    passed = [c for c in pages.columns if c not in ("status", "html", "url", "source")]
    ts = F.current_timestamp() if crawled_at is None else crawled_at
    record = F.struct(
        "url",
        "title",
        F.coalesce("text", F.lit("")).alias("text"),
        "markdown",
        url_lang("url", languages, default_language).alias("lang"),
        "source",
        iso_utc(ts).alias("crawled_at"),
        F.coalesce("word_count", F.lit(0)).alias("word_count"),
        F.lit("success").alias("status"),
        F.coalesce(
            "_skip",
            F.when(F.col("parse_error").isNotNull(), "parse_error"),
            F.when(~F.coalesce(long_enough(F.col("text"), min_length), F.lit(False)), "too_short")
        ).alias("reason"),
        *passed,
    )
    # inline() ends the row's computation: a filter on its result is not pushed into it, where it
    # would work out text and markdown a second time.
    return content.select(F.inline(F.array(record)))


def build_articles(pages: DataFrame, **options) -> DataFrame:
    """Pages to Article records (columns of ``schemas.ARTICLE`` first, then what passed through)."""
    done = page_outcomes(pages, **options).where(F.col("reason").isNull()).drop("reason")
    names = [f.name for f in ARTICLE.fields]
    return done.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in ARTICLE.fields],
        *[c for c in done.columns if c not in names],
    )


def rejected(outcomes: DataFrame) -> DataFrame:
    """Pages that gave no article, and why."""
    return outcomes.where(F.col("reason").isNotNull()).select("url", "source", "reason")


def crawl_summary(outcomes: DataFrame) -> DataFrame:
    """Attempted, succeeded and average words per source; NULL average without a success."""
    ok = F.col("reason").isNull()
    return outcomes.groupBy("source").agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(ok).alias("succeeded"),
        F.avg(F.when(ok, F.col("word_count"))).alias("avg_words"),
    )
