"""Where intermediate tables go."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; a local one only where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="webcorpus-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written, wherever it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A new folder below the shared one, deleted when the block ends."""
    path = work_dir(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)


def scanned_bytes(df: DataFrame) -> int:
    """Size of all tables that a plan reads, as the planner knows it; no job runs.  0 if one of them is unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    unknown = int(df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes())
    return 0 if max(sizes, default=0) >= unknown else sum(sizes)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise reliably and cut the lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def stored(df: DataFrame, name: str, under: str = None) -> DataFrame:
    """Write a table to the shared folder, or ``under`` one, and read it back: computed once, pruned by column."""
    path = f"{under}/{name}-{uuid.uuid4().hex}" if under else work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


MAX_BROADCAST_NUMBERS = 1 << 23   # numbers that each task may hold, of 8 bytes
RUN_BITS = 12                     # 4,096 rows that follow each other share an array of numbers


def numbered(df: DataFrame, *order: str, name: str = "number", under: str = None) -> DataFrame:
    """A stored copy with the place of each row in the order, from 0; rows that tie have the order of the copy.

    Only the columns of the order are dealt by ranges and ranked; a range's first number is the sum of the
    sizes before it, so no task sees more than a range.  The numbers come back to the rows as arrays, one for each run
    of the copy's rows, and no other column is shuffled.  Too many to be broadcast, they are joined one by one.
    """
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), name, under)
    ranged = rows.select(*order, "_row").repartitionByRange(*order, "_row").sortWithinPartitions(*order, "_row")
    ranked = stored(ranged.select("_row", F.monotonically_increasing_id().alias("_at")), "ranked", under)
    ranked = ranked.select("_row", F.shiftright("_at", 33).alias("_range"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_place"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranked.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    places = ranked.join(first, "_range").select("_row", (F.col("_first") + F.col("_place")).alias(name))
    if ranked.count() > MAX_BROADCAST_NUMBERS:
        return rows.join(stored(places, "places", under), "_row").drop("_row")
    run, at = F.shiftright("_row", RUN_BITS).alias("_run"), F.col("_row").bitwiseAND((1 << RUN_BITS) - 1).cast("int")
    runs = places.groupBy(run).agg(F.sort_array(F.collect_list(F.struct("_row", name))).getField(name).alias("_numbers"))
    found = rows.withColumn("_run", run).join(F.broadcast(stored(runs, "places", under)), "_run")
    return found.withColumn(name, F.get("_numbers", at)).drop("_run", "_numbers", "_row")
