"""Token counts from an exact histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import ByteBpe
from .common import shared_folder, written

# Lengths that one task sums up.
BLOCK = 1024


def length_histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``length, n_docs``: how many rows of ``docs`` (``text``) have each number of tokens.

    NULL and empty texts have none. Texts may be of any length. Repeated rows count each, and an empty
    table gives no rows. Tasks send a count per length, not a row per document.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteBpe(tokenizer)
        for part in parts:
            lengths = [encoder.count(text.as_py()) for text in part.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["length"])

    lengths = docs.select("text").mapInArrow(count, "length bigint")
    return lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))


def token_counts(histogram: DataFrame) -> DataFrame:
    """What a context limit of each occurring ``length`` keeps of all documents.

    ``length, n_docs``; ``n_at_most``: documents that fit, hence the rank for quantiles;
    ``n_longer`` and ``tokens_longer``: documents beyond the limit and their tokens;
    ``tokens_truncated``: tokens left if longer ones are cut off there; ``tokens_total``: all.
    Limits between two lengths follow from these (``at_limits``).

    Suffix sums go by blocks of lengths: first over the blocks, of which there are few, then
    within each block, so no task sums up the whole histogram. An empty histogram gives no rows.
    """
    block = (F.col("length") / BLOCK).cast("bigint").alias("block")
    rows = written(histogram.select("length", "n_docs", block), shared_folder(histogram.sparkSession))
    tokens = F.sum(F.col("length") * F.col("n_docs"))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("n"), tokens.alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("n").over(whole).alias("n_total"),
        F.sum("t").over(whole).alias("tokens_total"),
    )
    inside = (
        Window.partitionBy("block")
        .orderBy(F.desc("length"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    n_in = F.coalesce(F.sum("n_docs").over(inside), F.lit(0))
    t_in = F.coalesce(F.sum(F.col("length") * F.col("n_docs")).over(inside), F.lit(0))
    longer = rows.withColumns({"n_in": n_in, "t_in": t_in}).join(blocks, "block")
    n_longer, tokens_longer = F.col("n_in") + F.col("n_above"), F.col("t_in") + F.col("t_above")
    return longer.select(
        "length",
        "n_docs",
        (F.col("n_total") - n_longer).alias("n_at_most"),
        n_longer.alias("n_longer"),
        tokens_longer.alias("tokens_longer"),
        (F.col("tokens_total") - tokens_longer + n_longer * F.col("length")).alias(
            "tokens_truncated"
        ),
        "tokens_total",
    )


def at_limits(counts: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit, n_longer, tokens_truncated, tokens_total`` for any limits.

    A limit takes the row of the greatest length that is not above it; below all lengths, all
    documents are longer.
    """
    total = F.first("tokens_total")
    found = None
    for limit in limits:
        fits = F.when(F.col("length") <= limit, F.struct("length", "n_longer", "tokens_longer"))
        one = counts.agg(F.max(fits).alias("at"), F.sum("n_docs").alias("n"), total.alias("total"))
        n_longer = F.coalesce("at.n_longer", "n")
        cut = F.col("total") - F.coalesce("at.tokens_longer", "total") + n_longer * limit
        one = one.filter("n IS NOT NULL").select(
            F.lit(limit).cast("bigint").alias("context_limit"),
            n_longer.alias("n_longer"),
            cut.alias("tokens_truncated"),
            F.col("total").alias("tokens_total"),
        )
        found = one if found is None else found.unionByName(one)
    return found


def quantile(counts: DataFrame, share: float) -> DataFrame:
    """``length``: the smallest one that at least this share of the documents do not exceed."""
    n = F.col("n_at_most") + F.col("n_longer")
    return counts.filter(F.col("n_at_most") >= share * n).agg(F.min("length").alias("length"))
