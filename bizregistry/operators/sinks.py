"""Table sinks: overwrite as a whole, or some partitions, without losing the old table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.readwriter import DataFrameWriter

# Folders next to a table's own; readers of folders pass over such names.
STAGED, REPLACED = "_staged-", "_replaced-"


def overwrite_table(
    df: DataFrame,
    target: str,
    *,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> None:
    """Replace ``target`` as a whole: a path if it holds a "/", else a table name.

    The new table is written next to the old one, under another name, and takes its place only
    when it is whole. A write that fails, however far it came, leaves the old table as it was, and ``df``
    may read the table that it replaces. The exchange is two renames: of the old table, which is kept
    until the end, and of the new one. If the second fails the first is undone; if the
    driver is lost between them, ``recover_table``, which the next overwrite calls, undoes it. Stores
    without renames copy instead: there the exchange takes longer, and nothing else changes.

    ``sort_by`` orders rows inside each task's output, without a shuffle, so that Parquet
    page statistics can skip data for filters on those columns. With ``partition_by`` rows are
    ordered by partition first, as the writer wants them, so it does not order them anew.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    recover_table(spark, target)
    writer = _writer(df, partition_by, sort_by)
    place = _Folder(spark, target, mark) if "/" in target else _Table(spark, target, mark)
    try:
        place.write(writer.mode("error"))
    except BaseException:
        place.drop(place.staged)
        raise
    replaced = place.exists(target)
    if replaced:
        place.rename(target, place.replaced)
    try:
        place.rename(place.staged, target)
    except BaseException:
        if replaced:
            place.rename(place.replaced, target)
        place.drop(place.staged)
        raise
    if replaced:
        place.drop(place.replaced)


def overwrite_partitions(
    df: DataFrame,
    target: str,
    *,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
) -> None:
    """Replace those partitions of the folder ``target`` that ``df`` has rows of; others stay.

    Files of other partitions are neither read nor written. New files are staged by the writer and
    moved into place when all are whole; a write that fails before that changes nothing.
    """
    writer = _writer(df, partition_by, sort_by).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").save(target)


def recover_table(spark: SparkSession, target: str) -> bool:
    """Put a table back that lost its driver while it was being replaced; was there one?"""
    place = _Folder(spark, target, "") if "/" in target else _Table(spark, target, "")
    if place.exists(target):
        return False
    kept = place.left_behind()
    if kept:
        place.rename(kept[-1], target)
    return bool(kept)


def _writer(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrameWriter:
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.format("parquet")
    return writer.partitionBy(*partition_by) if partition_by else writer


class _Folder:
    """A folder of Parquet files, with room for another next to it."""

    def __init__(self, spark: SparkSession, target: str, mark: str) -> None:
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.target = self.path(target)
        self.store = self.target.getFileSystem(spark._jsc.hadoopConfiguration())
        self.parent, self.name = self.target.getParent(), self.target.getName()
        self.staged = self._beside(STAGED, mark)
        self.replaced = self._beside(REPLACED, mark)

    def _beside(self, kind: str, mark: str) -> str:
        return f"{self.parent.toString().rstrip('/')}/{kind}{self.name}-{mark}"

    def write(self, writer: DataFrameWriter) -> None:
        writer.save(self.staged)

    def exists(self, name: str) -> bool:
        return self.store.exists(self.path(name))

    def rename(self, old: str, new: str) -> None:
        if not self.store.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def drop(self, name: str) -> None:
        self.store.delete(self.path(name), True)

    def left_behind(self) -> list[str]:
        if not self.store.exists(self.parent):
            return []
        start = f"{REPLACED}{self.name}-"
        found = [s for s in self.store.listStatus(self.parent) if s.getPath().getName().startswith(start)]
        found.sort(key=lambda status: status.getModificationTime())
        return [status.getPath().toString() for status in found]


class _Table:
    """A table of the catalog, with others of its database next to it."""

    def __init__(self, spark: SparkSession, target: str, mark: str) -> None:
        self.spark = spark
        *self.database, self.name = target.split(".")
        self.staged = self._beside(STAGED, mark)
        self.replaced = self._beside(REPLACED, mark)

    def _beside(self, kind: str, mark: str) -> str:
        name = f"{kind.strip('_-')}_{self.name}_{mark}"
        return ".".join([*self.database, name])

    def write(self, writer: DataFrameWriter) -> None:
        writer.saveAsTable(self.staged)

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {_quoted(old)} RENAME TO {_quoted(new)}")

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")

    def left_behind(self) -> list[str]:
        start = self._beside(REPLACED, "").rsplit(".", 1)[-1]
        database = ".".join(self.database) or None
        found = [t.name for t in self.spark.catalog.listTables(database)]
        return [".".join([*self.database, name]) for name in found if name.startswith(start.lower())]


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))
