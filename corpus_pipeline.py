"""Raw documents to packed training batches: five stages, each written as Parquet and read again."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.llm.language_id import identify_language
from webcorpus.llm.mixing import SEPARATORS, label_quality, mix_sources
from webcorpus.llm.near_dedup import near_duplicates
from webcorpus.llm.packing import pack_batches
from webcorpus.llm.suffix_dedup import suffix_dedup
from webcorpus.llm.token_counts import count_tokens
from webcorpus.sources.storage import stored

#: Texts go to Python workers in batches that fit a buffer of 8 MB: Spark holds a batch twice outside its heap, in
#: buffers that double as they grow, and a worker once more.  The results do not depend on it.
BATCHES = ("spark.sql.execution.arrow.maxBytesPerBatch", "7m")


def columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def in_small_batches(stage):
    """The stage with BATCHES set in its session, which they stay in: the stage's plan runs after it returns."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(*BATCHES)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return identify_language(docs).where(~F.col("rejected")).select(*columns(docs))


@in_small_batches
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words."""
    return near_duplicates(docs, shingle=5).where("kept").select(*columns(docs))


@in_small_batches
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 50 bytes that an earlier document has; characters that a cut has split go too."""
    out = suffix_dedup(docs)
    text = F.col("kept").cast("string")
    whole = F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("�"), F.lit("")))
    out = out.withColumn("text", F.when(F.col("text").isNotNull(), whole))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*columns(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per epoch of each document taken; one that is taken in part is cut to its first words."""
    out = mix_sources(docs, quality=label_quality(spark.read.parquet(f"{sf_dir}/labels.parquet"))).where("taken > 0")
    part = F.col("taken") % F.col("size")
    epochs = F.floor(F.col("taken") / F.col("size"))
    copies = F.concat(
        F.array_repeat(F.lit(0).cast("long"), epochs.cast("int")),
        F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")),
    )
    out = out.withColumn("mix__words", F.explode(copies))
    first = F.array_join(F.slice(F.array_remove(F.split("text", SEPARATORS), ""), 1, F.col("mix__words").cast("int")), " ")
    out = out.withColumn("text", F.when(F.col("mix__words") > 0, first).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*columns(docs))


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its bucket, batch and slot, by the tokens of a public tokenizer, counted once."""
    counted = count_tokens(docs).select(*columns(docs), F.col("n_tokens").alias("pack__tokens"))
    return pack_batches(stored(counted, "counted"), F.col("pack__tokens")).drop("pack__tokens")


STAGES = [
    ("language_id", language),
    ("near_dedup", near_copies),
    ("suffix_dedup", repeated_strings),
    ("mixing", mixture),
    ("packing", packed),
]

#: SQL cannot express the learned language model and the dynamic program.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each one's result is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
