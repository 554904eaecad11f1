"""The dataset as published: training shards, their manifest, and its first row."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.schemas import TRAIN_SHARD, cast_schema

MANIFEST = "file_name string, target string, n_rows bigint, n_bytes bigint"


def train_records(df: DataFrame, id: Column) -> DataFrame:
    """(id, text, source, lang), all strings."""
    return cast_schema(df.select(id.alias("id"), "text", "source", "lang"), TRAIN_SHARD)


def write_train_shards(records: DataFrame, path: str, max_records: int = 0) -> None:
    """Write records as parquet shards.

    Shards follow the partitions as they are, so nothing is shuffled; ``max_records`` splits
    larger ones.
    """
    cast_schema(records, TRAIN_SHARD).write.mode("overwrite").option("compression", "zstd").option(
        "maxRecordsPerFile", max_records
    ).parquet(path)


def dataset_manifest(spark: SparkSession, path: str, prefix: str = "data/") -> DataFrame:
    """File by file, sorted: where it is published to, rows and bytes; files without rows too.

    Reads footers only: files are listed without their content, rows are counted by file.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    files = listed.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("n_bytes"))
    counts = spark.read.schema(TRAIN_SHARD).parquet(path).select(F.col("_metadata.file_name").alias("_name"))
    counts = counts.groupBy("_name").agg(F.count(F.lit(1)).alias("n"))
    rows = files.join(counts, F.col("file_name") == F.col("_name"), "left")
    return rows.select(
        "file_name", F.concat(F.lit(prefix), "file_name").alias("target"),
        F.coalesce("n", F.lit(0)).alias("n_rows"), "n_bytes",
    ).orderBy("file_name")


def dataset_first_row(spark: SparkSession, path: str) -> DataFrame:
    """Row 0 of the dataset: the first row of the first file by name.

    A pass over file names finds that file, so only its own columns are read.
    """
    data = spark.read.parquet(path)
    first = data.agg(F.min("_metadata.file_path").alias("f")).first()["f"]
    if first is None:
        return data.limit(0)
    return spark.read.schema(data.schema).parquet(first).where(F.col("_metadata.row_index") == 0)
