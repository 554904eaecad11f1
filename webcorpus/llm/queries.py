"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.llm.divergence import source_divergence
from webcorpus.llm.embedding_dedup import embedding_dedup
from webcorpus.llm.language_id import identify_language
from webcorpus.llm.license_scan import license_scan
from webcorpus.llm.mixing import label_quality, mix_sources, n_words
from webcorpus.llm.near_dedup import near_duplicates
from webcorpus.llm.packing import pack_batches
from webcorpus.llm.quality_rules import quality_rules
from webcorpus.llm.spelling import spelling_variants
from webcorpus.llm.substring_dedup import substring_dedup
from webcorpus.llm.suffix_dedup import suffix_dedup
from webcorpus.llm.token_counts import count_tokens
from webcorpus.llm.topk_search import topk_search


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark, sf_dir):
    out = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_embedding_dedup(spark, sf_dir):
    out = embedding_dedup(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n_links", "component_id", "kept")


def op3_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mix_sources(docs, quality=label_quality(table(spark, sf_dir, "labels")))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op4_token_counts(spark, sf_dir):
    out = count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op5_near_dedup(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op6_quality_rules(spark, sf_dir):
    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_license_scan(spark, sf_dir):
    out = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "license", "restricted", F.round("dice", 6).alias("dice"), "n_passages")


def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_language(docs).select("doc_id", "held_out", "lang_pred", "score")


def op9_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_batches(docs.select("doc_id", n_words(F.col("text")).alias("length")), F.col("length")).drop("length")


def op10_suffix_dedup(spark, sf_dir):
    out = suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_topk_search(spark, sf_dir):
    return topk_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark, sf_dir):
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_mixing": op3_mixing,
    "op4_token_counts": op4_token_counts,
    "op5_near_dedup": op5_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_license_scan": op7_license_scan,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_topk_search": op11_topk_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_divergence": op13_source_divergence,
}
