"""Line dedup: levelled sorted runs of line hashes, in DataFrame operations only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .common import (
    LOWER,
    UPPER,
    WHITE,
    free_prefix,
    hash128,
    quoted,
    shared_folder,
    unclashing,
    written,
)

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2
HASH = ["h1", "h2"]


def split_lines(text: Column | str) -> Column:
    """Lines of a text; NULL and empty texts hold one empty line."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


class LineRuns:
    """Line hashes with their document counts, kept as levelled sorted runs.

    A run has a row ``h1, h2, n_docs, keeper`` per line hash. It is bucketed by hash and sorted
    within each bucket, so probing or merging it never shuffles it. A batch is aggregated, merge-anti-joined
    with each run in turn, and becomes a run of level 0; what no run holds yet is new and gets its
    keeper here, the rest only adds to the count. ``fanout`` runs of a level are compacted to one
    run of the next, so a hash is rewritten a logarithmic number of times.

    Batches come in falling order of document id: the first to hold a line holds its keeper.
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT) -> None:
        self.spark, self.folder, self.fanout = spark, folder, max(2, fanout)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def add(self, lines: DataFrame) -> None:
        """Add a batch ``h1, h2, doc_id`` with one row per document and line hash."""
        batch = lines.groupBy(*HASH).agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper")
        )
        if runs := self.runs():
            batch = batch.repartition(self.buckets, *HASH)
            fresh = batch
            for run in runs:
                fresh = fresh.join(run.select(*HASH), HASH, "left_anti")
            new = fresh.select(*HASH, "keeper")
            batch = batch.drop("keeper").join(new, HASH, "left")
        self._store(batch.select(*HASH, "n_docs", "keeper"), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def merged(self) -> DataFrame:
        """All runs as one: a row per hash."""
        return self._merge([name for level in self.levels for name in level])

    def drop(self) -> None:
        for level in self.levels:
            for name in level:
                self.spark.sql(f"DROP TABLE {name}")
        self.levels = []

    def _merge(self, names: list[str]) -> DataFrame:
        merged = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).withColumnsRenamed({"n_docs": "n", "keeper": "k"})
            # Bucket by bucket: a union would lose the places of equal hashes.
            merged = merged.join(other, HASH, "full_outer").select(
                *HASH,
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n_docs"),
                F.greatest("keeper", "k").alias("keeper"),
            )
        return merged

    def _compact(self, level: int) -> None:
        names = self.levels[level]
        self._store(self._merge(names), level + 1)
        self.levels[level] = []
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def _store(self, run: DataFrame, level: int) -> None:
        name = f"llm_run_{uuid.uuid4().hex}"
        writer = run.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH)
        writer.sortBy(*HASH).option("path", f"{self.folder}/{name}").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``r1, r2, doc_id, h1, h2, at``: a row per row of ``docs``, eligible key and its places.

    ``r1, r2`` identify a document row by its content; ``at`` lists the line numbers.
    """
    r1, r2 = hash128("doc_id", "text")
    lines = docs.select(
        "doc_id", r1.alias("r1"), r2.alias("r2"), F.posexplode(split_lines("text"))
    ).withColumn("key", line_key(F.col("col")))
    h1, h2 = hash128("key")
    return lines.filter(F.char_length("key") >= min_chars).select(
        "r1", "r2", "doc_id", h1.alias("h1"), h2.alias("h2"), F.col("pos").alias("at")
    )


def batches_of(lines: DataFrame, batches: int) -> list[DataFrame]:
    """Parts of a table by falling ranges of ``doc_id``; NULL ids come last.

    Ids that are no numbers have no quantiles; their table is one part.
    """
    if not isinstance(lines.schema["doc_id"].dataType, NumericType):
        return [lines]
    cuts = lines.select(
        F.percentile_approx("doc_id", [i / batches for i in range(1, batches)])
    ).first()[0]
    # A bounded list: one value per batch.
    edges = sorted(set(cuts or []), reverse=True)
    parts, above = [], F.lit(True)
    for edge in edges:
        parts.append(lines.filter(above & (F.col("doc_id") >= edge)))
        above = F.col("doc_id") < edge
    return [*parts, lines.filter(F.coalesce(above, F.lit(True)) | F.col("doc_id").isNull())]


def dedup_lines(
    docs: DataFrame,
    *,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """Drop lines that many documents share; the document of the largest id keeps them.

    ``docs`` needs ``doc_id`` and ``text``; other columns are kept. ``text`` holds what is left
    and ``n_lines``, ``n_dropped`` are added (input columns so named, in any case of letters, go).
    A line counts by its key: white space stripped, A-Z lower-cased. Keys of ``min_chars`` code
    points or more in ``min_docs`` rows or more are dropped.

    NULL and empty texts hold one empty line and stay as they are. Repeated rows, of equal id and
    text, are one document; rows of equal id and other text are documents of their own. Rows that
    tie for the largest id all keep their lines. Texts, and lines, may be of any length. A NULL id is smaller than any other; where only
    rows with NULL ids hold a key, all of them keep it.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    places = written(line_hashes(docs, min_chars), folder)
    runs = LineRuns(spark, folder, fanout)
    held = places.select("r1", "r2", "doc_id", *HASH).distinct()
    own = free_prefix(docs)
    try:
        for part in batches_of(held.select("doc_id", *HASH), batches):
            runs.add(part)
        common = runs.merged().filter(F.col("n_docs") >= min_docs).select(*HASH, "keeper")
        drops = (
            places.join(common, HASH)
            .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("r1", "r2")
            .agg(F.collect_set("at").alias("drops"))
        )
        drops = written(drops.select(*(F.col(c).alias(own + c) for c in drops.columns)), folder)
    finally:
        # Also where a batch fails: its tables are in the caller's database.
        runs.drop()
    r1, r2 = hash128("doc_id", "text")
    lines, gone = f"{own}lines", f"{own}drops"
    keyed = docs.withColumn(lines, split_lines("text"))
    on = (r1 == drops[f"{own}r1"]) & (r2 == drops[f"{own}r2"])
    # The lines are a column of their own: inside a lambda they would be split again each time.
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)),
        lambda at: F.get(lines, at),
    )
    some = F.col(gone).isNotNull()
    counts = {
        "n_lines": F.size(lines).cast("bigint"),
        "n_dropped": F.when(some, F.size(gone)).otherwise(0).cast("bigint"),
    }
    left = F.when(some, F.array_join(kept, "\n")).otherwise(F.col("text"))
    names = unclashing(docs, counts).columns
    return keyed.join(drops, on, "left").select(
        *((left if c == "text" else F.col(quoted(c))).alias(c) for c in names),
        *(column.alias(name) for name, column in counts.items()),
    )
