"""Landed pages to stored articles, batch by batch, resumable."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.functions.text import url_netloc
from webcorpus.operators.articles import build_articles
from webcorpus.operators.frontier import pending_urls
from webcorpus.schemas import ARTICLE, PAGES
from webcorpus.sources.article_store import ArticleStore
from webcorpus.sources.storage import numbered, scratch, stored


def ingest_stream(
    spark: SparkSession,
    landing: str,
    store: ArticleStore,
    checkpoint: str,
    files_per_batch: int = 100,
    skip_existing: bool = True,
    schema=PAGES,
    order: str = "page_id",
    flush_every: int = 0,
    **options,
):
    """Start a stream that stores the articles of all pages landed so far, then stops.

    A checkpoint is one writer of the store; its batches follow those that were there when it began.
    A micro-batch that runs again after a failure replaces its own batches, and no other writer's.  With
    ``skip_existing`` URLs stored before the stream was started are dropped before their pages are parsed; only
    the key buckets of the sources that have landed are read.  Several fetches of a URL that land in one run
    are all stored, whichever micro-batches they fall into.

    Without ``flush_every`` a micro-batch is a batch of the store.  With it a batch has exactly so many
    articles, however the pages were landed: articles are numbered as they come, what does not fill a
    batch is held back for the next micro-batch, and ``flush_rest`` stores it at the end.
    """
    pages = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )
    writer, first = _writer(spark, checkpoint, store)
    flushes = Flushes(spark, checkpoint) if flush_every else None
    begun = []   # number of this run's first micro-batch, and the batches of this writer before it

    def save(batch: DataFrame, number: int) -> None:
        start = flushes.batches(number) if flush_every else number
        if not begun:
            begun.extend((number, start))
        if "source" not in batch.columns:
            batch = batch.withColumn("source", url_netloc("url"))
        if skip_existing:
            # What this run has stored, or a micro-batch in an attempt that failed, does not count as stored.
            known = store.stored_keys(of=batch).where((F.col("writer") != writer) | (F.col("batch_id") < first + begun[1]))
            known = known.select("source", "url")
            if flush_every:
                known = known.union(flushes.held(begun[0]).select("source", "url"))
            batch = pending_urls(batch, known, "source", "url")
        articles = build_articles(batch, **options)
        if flush_every:
            fresh = articles.withColumn("pos", F.col(order).cast("bigint")).withColumn("round", F.lit(number).cast("bigint"))
            store_full(fresh.select(*HELD.names), number, start)
        else:
            store.write_articles(articles, first + number, F.col(order), writer)

    def store_full(fresh: DataFrame, number: int, start: int) -> None:
        """Store as many whole batches as there are, and hold back the rest."""
        with scratch(spark, "flush") as folder:
            rows = numbered(flushes.held(number).unionByName(fresh), "round", "pos", "url", under=folder)
            total = rows.count()
            whole = total - total % flush_every
            if whole:
                batch_id = F.lit(first + start) + F.floor(F.col("number") / flush_every)
                store.write_batches(rows.where(F.col("number") < whole), batch_id, F.col("pos"), writer)
            flushes.hold(number + 1, rows.where(F.col("number") >= whole), start + whole // flush_every)

    return (
        pages.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def flush_rest(spark: SparkSession, store: ArticleStore, checkpoint: str) -> None:
    """Store what a stream with ``flush_every`` has held back, as one last, smaller batch."""
    writer, first = _writer(spark, checkpoint, store)
    flushes = Flushes(spark, checkpoint)
    number = flushes.last()
    rest, batches = flushes.held(number), flushes.batches(number)
    if not rest.isEmpty():
        store.write_batches(rest, F.lit(first + batches), F.col("pos"), writer)
        flushes.hold(number, rest.where("false"), batches + 1)


class Flushes:
    """What a stream holds back before each micro-batch, and how many batches it has stored by then."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.path = spark, checkpoint.rstrip("/") + "-flushes"
        for name, schema in (("held", HELD), ("stored", STORED)):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.path}/{name}")

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(f"{self.path}/stored")

    def last(self) -> int:
        return self._stored().agg(F.max("number")).first()[0] or 0

    def batches(self, number: int) -> int:
        return self._stored().where(F.col("number") == number).agg(F.max("batches")).first()[0] or 0

    def held(self, number: int) -> DataFrame:
        schema = T.StructType(HELD.fields + [T.StructField("number", T.LongType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/held").where(F.col("number") == number).drop("number")

    def hold(self, number: int, rows: DataFrame, batches: int) -> None:
        """The rows first, then the count: a micro-batch that fails in between runs again from the state before it."""
        rows = stored(rows.select(*HELD.names), "held")
        rows.write.mode("overwrite").parquet(f"{self.path}/held/number={number}")
        state = self.spark.createDataFrame([(number, batches)], STORED)
        state.coalesce(1).write.mode("append").parquet(f"{self.path}/stored")


HELD = T.StructType([*ARTICLE.fields, T.StructField("pos", T.LongType()), T.StructField("round", T.LongType())])
STORED = T.StructType([T.StructField("number", T.LongType()), T.StructField("batches", T.LongType())])


def _writer(spark, checkpoint, store):
    """(writer, first batch) of a checkpoint: made once and kept beside it."""
    path, schema = checkpoint.rstrip("/") + "-writer", "writer string, first long"
    for mode in ("ignore", "overwrite"):   # the second only where the first was cut off before it wrote
        note = spark.createDataFrame([(uuid.uuid4().hex, store.next_batch())], schema)
        note.coalesce(1).write.mode(mode).parquet(path)
        row = spark.read.schema(schema).parquet(path).first()
        if row is not None:
            return row["writer"], row["first"]
