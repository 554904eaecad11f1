"""Articles on plain parquet: one log that batches are appended to, and a slim table of its keys.

    root/log/part=<batch>-<writer>/source_key=<key>/*.parquet
    root/keys/part=<batch>-<writer>/bucket=<n>/*.parquet

Batches that are written together share a part, ``<first>_<last>-<writer>``.  Both are read as a whole, by partition discovery.  The row of a (source, url) that counts is the last by
(batch_id, writer, pos), whenever it was written and whether or not the log was rewritten in between.  A
batch shows up when its write commits; a batch that its writer writes again is replaced.
"""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.functions.text import source_key
from webcorpus.schemas import ARTICLE, ARTICLE_KEYS, ARTICLE_LOG
from webcorpus.sources.storage import remove, scanned_bytes, stored

KEYS = ("source", "url")
ORDER = ("batch_id", "writer", "pos")


def append_articles(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows and new rows, aligned by column name; their order is in their ``ORDER`` columns."""
    return old.unionByName(new)


def same_key(a: DataFrame, b: DataFrame, columns) -> Column:
    """Equality of columns; NULL equals NULL."""
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


def latest_articles(log: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """One row per key, the last by ``order``, as far as the log has these columns; rows that tie are compared whole.

    A pass over keys and order alone finds the keys that repeat and their last places, and writes them
    down, so that their number is known: while they are few, no text is shuffled at all.  The whole rows
    are read once, unless rows of a key tie for the last place.
    """
    order = [c for c in order if c in log.columns]
    last = log.groupBy(*keys).agg(F.max(F.struct(*order)).alias("last"), F.count(F.lit(1)).alias("n"))
    last = stored(last.where("n > 1").select(*keys, *[f"last.{c}" for c in order]), "repeated")
    repeated = last.count()
    if not repeated:
        return log
    at_last = same_key(log, last, [*keys, *order])
    if log.join(last, at_last, "left_semi").count() == repeated:
        marked = log.join(last.withColumn("_again", F.lit(True)), same_key(log, last, keys), "left")
        is_last = F.col("_again").isNull() | same_key(log, last, order)
        return marked.where(is_last).select(*[log[c] for c in log.columns])
    single = log.join(last, same_key(log, last, keys), "left_anti")
    ties = log.join(last, at_last, "left_semi").groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
    return single.unionByName(ties.agg(F.max(F.struct(*log.columns)).alias("r")).select("r.*"))


def upsert_articles(old: DataFrame, new: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """Old and new rows as one table: the last row of each key, wherever it comes from."""
    return latest_articles(append_articles(old, new), keys, order)


def _part(first, last, writer) -> str:
    """Name of the part that has the batches from ``first`` to ``last``."""
    return f"{first}-{writer}" if first == last else f"{first}_{last}-{writer}"


class ArticleStore:
    """``folders``: hashed folders in a batch, 0 gives each source a folder; ``buckets``: parts of the keys."""

    def __init__(self, spark: SparkSession, root: str, folders: int = 16, buckets: int = 64):
        self.spark, self.root, self.folders, self.buckets = spark, root.rstrip("/"), folders, buckets
        for name, schema in (("log", ARTICLE_LOG), ("keys", ARTICLE_KEYS)):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.root}/{name}")

    def _read(self, name, schema, part=None):
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
        return reader.parquet(f"{self.root}/{name}" + (f"/part={part}" if part else ""))

    def rows(self) -> DataFrame:
        """Every row that was ever appended."""
        return self._read("log", ARTICLE_LOG)

    def batches(self) -> list:
        """(batch_id, writer) of all batches with rows, in order."""
        return sorted(tuple(r) for r in self.rows().select("batch_id", "writer").distinct().collect())

    def next_batch(self) -> int:
        """One more than the last batch; only the small column of batches is read."""
        last = self.rows().agg(F.max("batch_id")).first()[0]
        return 0 if last is None else last + 1

    # --- writing -----------------------------------------------------------------------------

    def _placed(self, articles, batch_id, pos, writer):
        """Articles as rows of the log."""
        return articles.select(
            *[articles[f.name].cast(f.dataType).alias(f.name) for f in ARTICLE.fields],
            (F.lit(0) if pos is None else pos).cast("bigint").alias("pos"),
            batch_id.cast("bigint").alias("batch_id"), F.lit(writer).alias("writer"),
        )

    def _folder(self, source) -> Column:
        """Folder of a source: one of a fixed number, or one of its own."""
        if self.folders:
            return F.format_string("f%03d", F.pmod(F.xxhash64(source), F.lit(self.folders)))
        return F.coalesce(F.nullif(source_key(source), F.lit("")), F.lit("_"))

    def _bucket(self, source) -> Column:
        return F.pmod(F.xxhash64(source), F.lit(self.buckets)).cast("int")

    def _save(self, rows, path, *columns):
        """zstd parquet in folders, in place of what was there."""
        rows.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "static").partitionBy(
            *columns
        ).parquet(path)

    def _gathered(self, rows, *columns) -> DataFrame:
        """Rows of a folder brought together: folders with most rows are split, small ones share a task."""
        return rows.hint("rebalance", *columns)

    def _texts(self, rows, splits=None) -> DataFrame:
        """Articles ready to be written to their folders.

        Those of a small table are gathered, so that it gives few files.  Where the scan is so large that
        each task has so many minimal ``splits``, by default one for each folder, texts stay in the task that reads them.
        """
        conf = self.spark._jsparkSession.sessionState().conf()
        splits = self.folders if splits is None else splits
        filled = self.spark.sparkContext.defaultParallelism * splits * conf.filesOpenCostInBytes()
        return rows if 0 < filled <= scanned_bytes(rows) else self._gathered(rows, "source_key")

    def _keyed(self, rows):
        keys = rows.where(F.col("url").isNotNull()).select(*KEYS, "batch_id", "writer", "part")
        return keys.withColumn("bucket", self._bucket(F.col("source")))

    def _save_part(self, rows, part) -> None:
        """Rows as one part, in place of what it had; the keys are taken from what was written."""
        self._save(rows, f"{self.root}/log/part={part}", "source_key")
        keys = self._keyed(self._read("log", ARTICLE_LOG, part)).drop("part")
        self._save(self._gathered(keys, "bucket"), f"{self.root}/keys/part={part}", "bucket")

    def _parts(self, writer, several) -> list:
        """(part, first batch, last batch) of a writer, or only those parts that have ``several`` batches."""
        names = "part=" + ("*_*-" if several else "*-") + re.sub(r"[^\w.-]", "?", writer)
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/log/{names}")
        files = pattern.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        paths = self.spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.globStatus(pattern)) or ()
        own = [re.fullmatch(rf"part=((-?\d+)(?:_(-?\d+))?-{re.escape(writer)})", path.getName()) for path in paths]
        return [(m[1], int(m[2]), int(m[3] or m[2])) for m in own if m]

    def _cut(self, part, ids, writer) -> None:
        """Take batches out of a part.  Its other batches are written to new parts before it is deleted."""
        rows = self._read("log", ARTICLE_LOG, part)
        hit = rows.join(ids, "batch_id", "left_semi").agg(F.min("batch_id")).first()[0]
        if hit is None:
            return
        rest = rows.join(ids, "batch_id", "left_anti").select(*[c for c in rows.columns if c != "part"])
        for side in (rest.where(F.col("batch_id") < hit), rest.where(F.col("batch_id") > hit)):
            first, last = side.agg(F.min("batch_id"), F.max("batch_id")).first()
            if first is not None:
                self._save_part(self._texts(side), _part(first, last, writer))
        for name in ("keys", "log"):
            remove(self.spark, f"{self.root}/{name}/part={part}")

    def write_articles(
        self, articles: DataFrame, batch_id: int, pos: Column = None, writer: str = "main", append: bool = True
    ) -> None:
        """Write one batch; the same id by the same writer replaces it.

        ``pos`` orders repeats of a URL within the batch.  With ``append=False`` the table is only these
        rows afterwards.  The texts are written once; the keys are taken from what was written.
        """
        part = _part(batch_id, batch_id, writer)
        rows = self._placed(articles, F.lit(batch_id), pos, writer).withColumn("source_key", self._folder(F.col("source")))
        if append:
            for old, first, last in self._parts(writer, several=True):
                if first <= batch_id <= last:
                    self._cut(old, self.spark.range(batch_id, batch_id + 1).toDF("batch_id"), writer)
            self._save_part(self._texts(rows), part)
        else:
            self._save(self._texts(rows.withColumn("part", F.lit(part))), f"{self.root}/log", "part", "source_key")
            self._save(self._gathered(self._keyed(self.rows()), "part", "bucket"), f"{self.root}/keys", "part", "bucket")

    def write_batches(self, articles: DataFrame, batch_id: Column, pos: Column, writer: str) -> None:
        """Write several batches at once, whose ids are a column; each of them replaces the one with its id and writer.

        ``articles`` should be a stored table, so that a second run writes the same rows to the same places.
        The batches share one part, so that the files go by the size of the table and not by the number of batches; with
        a minimal split for each core texts stay in the task that reads them.
        """
        rows = self._placed(articles, batch_id, pos, writer).withColumn("source_key", self._folder(F.col("source")))
        first, last = rows.agg(F.min("batch_id"), F.max("batch_id")).first()
        if first is None:
            return
        part, ids = _part(first, last, writer), rows.select("batch_id").distinct()
        for old, low, high in self._parts(writer, several=False):
            if low <= last and first <= high and (old != part or low < high):
                self._cut(old, ids, writer)
        self._save_part(self._texts(rows, min(1, self.folders)), part)

    def compact(self, root: str) -> "ArticleStore":
        """The current table as a store of its own, in few files; the rows keep their places in the order.

        Batches that come late may be written to the new store: the same rows win as in the old one.
        """
        new = ArticleStore(self.spark, root, self.folders, self.buckets)
        rows = self.articles().withColumns({"source_key": self._folder(F.col("source")), "part": F.lit("compact")})
        self._save(new._texts(rows), f"{new.root}/log", "part", "source_key")
        self._save(self._gathered(new._keyed(new.rows()), "part", "bucket"), f"{new.root}/keys", "part", "bucket")
        return new

    # --- reading -----------------------------------------------------------------------------

    def articles(self) -> DataFrame:
        """The current table: the last appended row of each (source, url)."""
        return latest_articles(self.rows())

    def stored_keys(self, source: str = None, of: DataFrame = None) -> DataFrame:
        """(source, url, batch_id, writer) of stored rows that have a URL, repeats included.

        Only the slim key table is read, and of it one bucket where a ``source`` is given, or the buckets
        of the sources in ``of``, whose (source, url) it is then cut down to.
        """
        keys = self._read("keys", ARTICLE_KEYS)
        if source is not None:
            keys = keys.where((F.col("bucket") == self._bucket(F.lit(source))) & (F.col("source") == source))
        if of is not None:
            wanted = of.select(self._bucket(F.col("source")).alias("bucket")).distinct()
            buckets = sorted(r["bucket"] for r in wanted.collect() if r["bucket"] is not None)   # `buckets` at most
            keys = keys.where(F.col("bucket").isin(buckets)).join(of.select(*KEYS), list(KEYS), "left_semi")
        return keys.select(*KEYS, "batch_id", "writer")

    def existing_urls(self, source: str = None, of: DataFrame = None) -> DataFrame:
        """(source, url) stored, each once."""
        return self.stored_keys(source, of).select(*KEYS).distinct()
