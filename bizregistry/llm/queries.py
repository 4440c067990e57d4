"""The operators over the test tables, with their results as digests."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, hash128, read_table
from .hard_negatives import hard_negatives
from .lengths import length_histogram, token_counts
from .lines import dedup_lines
from .ngram_join import similar_texts
from .packing import pack_documents
from .period_runs import period_runs
from .quality import score_quality
from .rules import apply_rules, base_failed, with_stats
from .sharding import shard_documents
from .simhash import near_duplicates
from .substring import repeated_texts, word_digests
from .topk import top_k
from .word_bpe import encoded_digests

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, read_table(spark, sf_dir, "labels")).drop("text")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return apply_rules(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op5 measures of each text, without its verdict, which comes from sketches."""
    stats = with_stats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return stats.drop("n_text_lines").withColumn("base_failed", base_failed())


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("text")
    return token_counts(length_histogram(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    t1, t2 = hash128("text")
    whole = word_digests(docs.select("doc_id", t1.alias("t1"), t2.alias("t2"), "text"))
    kept = word_digests(repeated_texts(docs), "kept").select(
        "t1", "t2", "n_removed", F.col("words_sha256").alias("kept_sha256")
    )
    return whole.join(kept, ["t1", "t2"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha256", "words_sha256").alias("kept_sha256"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; a tenth of the texts are made periodic from some word on, by their ids."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    trimmed = F.btrim("text", F.lit(WHITE))
    words = F.when(F.length(trimmed) > 0, F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    parts = (
        docs.select("doc_id", "text", F.when(crc % 10 == 0, words).alias("words"))
        .withColumn("n", F.size("words").cast("bigint"))
        .withColumn("g", F.floor(crc / 10))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    )
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)
    shuffled = F.concat_ws(
        " ", F.expr("transform(numbers, i -> words[cast(if(i < a, i, a + (i - a) % p) as int)])")
    )
    periodic = parts.withColumn("numbers", F.when(F.col("n") > 0, numbers))
    return periodic.select("doc_id", F.when(F.col("n") > 0, shuffled).otherwise(F.col("text")).alias("text"))


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = period_runs(with_periods(docs))
    line = "concat(r.start, ',', r.length, ',', r.period, '\n')"
    listed = F.concat_ws("", F.expr(f"transform(runs, r -> {line})"))
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_texts(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", wrong))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_top_k": op3_top_k,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_quality_rules": op5_quality_rules,
    "quality_base": quality_base,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_sharding": op8_sharding,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_period_runs": op11_period_runs,
    "op12_ngram_join": op12_ngram_join,
    "op13_hard_negatives": op13_hard_negatives,
}
