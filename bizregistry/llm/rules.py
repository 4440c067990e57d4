"""Quality rules with adaptive thresholds from mergeable quantile sketches."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import WHITE, quoted, shared_folder, unclashing, written
from .substring import RollingHash, WordHashes, cover, split_words

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
# Relative error of a quantile: a value falls into the bucket of its logarithm to this base.
GAMMA = 1.02
# Documents' worth of its language's sketch that each group's gets, and quantiles that stand for it.
WEIGHT = 10.0
POINTS = 50
# A threshold is so many quartile distances beyond the quartile ...
SPREADS = 4.0
# ... and, for metrics that are mostly zero, as far beyond this quantile as that is beyond the upper
# quartile. It is taken over documents of usual word length: within so many quartile distances.
TAIL = 0.99
USUAL = 1.5
LOWER_TOO = ("word_length",)
# Whole numbers, of each text.
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_text_lines")


def text_stats(text: str | None, hashed: WordHashes, rolling: RollingHash) -> tuple[int, ...]:
    """The columns of ``NAMES``; zeros for NULL."""
    text = text or ""
    words = split_words(text)
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    repeated = 0
    if len(words) >= REPEAT_WINDOW:
        windows = rolling.windows(hashed(words), REPEAT_WINDOW)
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[which] > 1)
        repeated = int(cover(len(words), starts, REPEAT_WINDOW).sum())
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
    )


def with_stats(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``NAMES``."""
    others = [c for c in docs.columns if c != "text"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, rolling = WordHashes(), RollingHash(4)
        for part in parts:
            rows = [text_stats(text.as_py(), hashed, rolling) for text in part.column("text")]
            stats = [pa.array(c, pa.int64()) for c in list(zip(*rows)) or [()] * len(NAMES)]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in others), *stats], [*others, *NAMES]
            )

    fields = [docs.schema[c] for c in others] + [StructField(c, LongType()) for c in NAMES]
    return docs.select(*others, "text").mapInArrow(run, StructType(fields))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def metrics() -> dict[str, Column]:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_text_lines", F.lit(1))
    return {
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words,
    }


def sketches(stats: DataFrame, keys: list[str], names: Sequence[str]) -> DataFrame:
    """``keys, metric, usual, bucket, n``: a quantile sketch of some metrics for each group.

    A sketch counts values by the bucket of their logarithm, apart for those rows that are
    ``usual``. Sketches merge by adding counts, in any order, with the same result; tasks do so
    before anything is shuffled. Zero has a bucket of its own, NULL. Buckets are some hundreds for
    each metric, however many documents.
    """
    pairs = [
        F.struct(F.lit(name).alias("metric"), _bucket(metrics()[name]).alias("bucket"))
        for name in names
    ]
    values = stats.select(*keys, "usual", F.explode(F.array(*pairs)).alias("m"))
    counted = values.groupBy(*keys, "m.metric", "usual", "m.bucket")
    return counted.agg(F.count(F.lit(1)).cast("double").alias("n"))


def _bucket(value: Column) -> Column:
    return F.when(value > 0, F.ceil(F.log(value) / math.log(GAMMA)))


def _middle(bucket: str) -> Column:
    middle = 2 * GAMMA ** F.col(bucket) / (1 + GAMMA)
    return F.when(F.col(bucket).isNull(), 0.0).otherwise(middle)


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "metric", "usual", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], **levels: float) -> DataFrame:
    """``keys, metric`` and a column per level, the middle of the quantile's bucket."""
    group = Window.partitionBy(*keys, "metric")
    ranked = (
        sketch.groupBy(*keys, "metric", "bucket")
        .agg(F.sum("n").alias("n"))
        .withColumns(
            {
                "upto": F.sum("n").over(group.orderBy(F.asc_nulls_first("bucket"))),
                "all": F.sum("n").over(group),
            }
        )
    )
    value = _middle("bucket")
    # Counts may be fractions, whose sums differ in the last digits by their order.
    return ranked.groupBy(*keys, "metric").agg(
        *(
            F.min(F.when(F.col("upto") >= q * F.col("all") - 1e-6, value)).alias(k)
            for k, q in levels.items()
        ),
    )


def points(sketch: DataFrame, keys: list[str], weight: float) -> DataFrame:
    """A sketch of a fixed weight and size with the same shape: even quantiles of the given one.

    At most ``POINTS`` buckets for each metric, usual and not, whatever the size of the sketch.
    """
    group = [*keys, "metric", "usual"]
    order = Window.partitionBy(*group).orderBy(F.asc_nulls_first("bucket"))
    ranked = sketch.withColumns(
        {
            "upto": F.sum("n").over(order),
            "part": F.sum("n").over(Window.partitionBy(*group)),
            "all": F.sum("n").over(Window.partitionBy(*keys, "metric")),
        }
    )

    def points_below(count: Column) -> Column:
        return F.floor(POINTS * count / F.col("part") + 0.5 + 1e-9)

    held = points_below(F.col("upto")) - points_below(F.col("upto") - F.col("n"))
    share = F.lit(weight / POINTS) * F.col("part") / F.col("all")
    return ranked.select(*group, "bucket", (held * share).alias("n")).filter("n > 0")


def blended(fine: DataFrame, weight: float) -> DataFrame:
    """Sketches by language and source, each with a fixed weight of that of its language added.

    Languages get the same weight of all documents' sketch first. So a small group is judged
    mostly like its language, a large one by its own documents, and there is no size at which
    the rule changes.
    """
    by_lang = merged(fine, ["g_lang"])
    every = points(merged(fine, []), [], weight)
    # A row per point: bounded by the number of metrics and points.
    listed = [r.asDict() for r in every.collect()]
    kinds = "array<struct<metric string, usual boolean, bucket bigint, n double>>"
    langs = fine.select("g_lang").distinct()
    added = langs.select("g_lang", F.inline(F.from_json(F.lit(json.dumps(listed)), kinds)))
    by_lang = by_lang.unionByName(added)
    seeds = points(merged(by_lang, ["g_lang"]), ["g_lang"], weight)
    seeds = seeds.withColumnRenamed("g_lang", "of_lang")
    groups = fine.select("g_lang", "g_source").distinct()
    seeded = groups.join(seeds, F.col("g_lang").eqNullSafe(F.col("of_lang"))).drop("of_lang")
    return merged(fine.unionByName(seeded), ["g_lang", "g_source"])


def _beside(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    right = right.withColumnsRenamed({k: f"of_{k}" for k in on})
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in on]
    return left.join(right, same, how).drop(*(f"of_{k}" for k in on))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles and their distance, no less than a bucket is wide."""
    return quantiles(sketch, keys, q1=0.25, q2=0.5, q3=0.75).withColumn(
        "spread", F.greatest(F.col("q3") - F.col("q1"), (GAMMA - 1) * F.col("q2"))
    )


def usual_lengths(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, shortest, longest``: the usual word lengths of each group."""
    return _quartiles(sketch, keys).select(
        *keys,
        (F.col("q1") - USUAL * F.col("spread")).alias("shortest"),
        (F.col("q3") + USUAL * F.col("spread")).alias("longest"),
    )


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, low, high``: maps from metric to threshold, for each group.

    All come from the group's sketch. Thresholds lie a bucket further out than the fences, so values
    that differ by less than the sketch can tell are never rejected. Where most values are zero, so
    are the quartiles, and the tail decides. It is taken over documents of usual word length: texts
    that are odd in one respect do not set the limits in another.
    """
    tails = quantiles(sketch.filter("usual"), keys, upper=0.75, tail=TAIL)
    limits = _beside(_quartiles(sketch, keys), tails, [*keys, "metric"])
    low = F.when(
        F.col("metric").isin(*LOWER_TOO), (F.col("q1") - SPREADS * F.col("spread")) / GAMMA
    )
    fence = F.col("q3") + SPREADS * F.col("spread")
    # Without documents of usual length the tail is NULL, which greatest() skips.
    tail = F.when(~F.col("metric").isin(*LOWER_TOO), 2 * F.col("tail") - F.col("upper"))
    entries = F.map_from_entries
    return (
        limits.withColumns({"low": low, "high": F.greatest(fence, tail) * GAMMA})
        .groupBy(*keys)
        .agg(
            entries(F.collect_list(F.struct("metric", "low"))).alias("low"),
            entries(F.collect_list(F.struct("metric", "high"))).alias("high"),
        )
    )


def thresholds(stats: DataFrame, weight: float = WEIGHT) -> DataFrame:
    """``g_lang, g_source, low, high`` for every language and source that occurs.

    Two sketches are made, of the word lengths and then, with the usual ones known, of all metrics.
    """
    folder, keys = shared_folder(stats.sparkSession), ["g_lang", "g_source"]
    passing = stats.filter(~base_failed()).withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    lengths = sketches(passing.withColumn("usual", F.lit(True)), keys, LOWER_TOO)
    usual = usual_lengths(blended(written(lengths, folder), weight), keys)
    length = metrics()["word_length"]
    known = _beside(passing, usual, keys)
    marked = known.withColumn("usual", length.between(F.col("shortest"), F.col("longest")))
    fine = written(sketches(marked, keys, list(metrics())), folder)
    return written(fences(blended(fine, weight), keys), folder)


def apply_rules(docs: DataFrame, *, weight: float = WEIGHT) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``NAMES``, ``base_failed`` and ``kept``.

    ``docs`` needs ``text``, ``lang`` and ``source``. Texts that fail the fixed base are not kept,
    and take no part in the sketches. Of the others, those are kept whose metrics lie within the
    thresholds of their language and source, which ``fences`` reads off the sketches: four quartile
    distances beyond the quartiles, or for metrics that are mostly zero, beyond the tail. Each
    group's sketch has ``weight`` documents of the shape of its language's added, and each language's
    as many of all documents': that is a prior, not a switch, and groups of any size are judged
    by the same rule.

    NULL texts count as empty, hence fail the base. NULL languages and sources are groups like
    others. Repeated rows count each. Texts may be of any length. An empty table gives no rows.
    Input columns named like those added, in any case of letters, are replaced; all others stay.
    """
    rest = unclashing(docs.drop("text"), [*NAMES, "base_failed", "kept"])
    own = [f"c{i}" for i in range(len(rest.columns))]
    plain = docs.select(
        *(F.col(quoted(c)).alias(o) for c, o in zip(rest.columns, own)), "lang", "source", "text"
    )
    stats = written(with_stats(plain), shared_folder(docs.sparkSession))
    limits = thresholds(stats, weight)
    # Only numbers are joined; a hot source is a skewed key, which adaptive execution splits.
    on = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    within = F.lit(True)
    for name, value in metrics().items():
        within &= value <= F.col("high")[name]
        if name in LOWER_TOO:
            within &= value >= F.col("low")[name]
    failed = base_failed()
    judged = stats.join(limits, on, "left").select(
        *own,
        *NAMES,
        failed.alias("base_failed"),
        F.when(failed, False).otherwise(F.coalesce(within, F.lit(True))).alias("kept"),
    )
    return judged.toDF(*rest.columns, *NAMES, "base_failed", "kept")
