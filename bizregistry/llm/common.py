"""Tables, shared scratch folders and row keys for the operators of this package."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word and line rules: [\x20\x09-\x0D].
WHITE = " \t\n\x0b\f\r"
T = TypeVar("T")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, removed when the application ends.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
    folder = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    return folder


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table to shared storage and read it back: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_prefix(df: DataFrame) -> str:
    """A prefix that no column of a table begins with, for columns of an operator's own."""
    prefix = "_"
    while any(column.startswith(prefix) for column in df.columns):
        prefix += "_"
    return prefix


def hash128(*cols: Column | str) -> tuple[Column, Column]:
    """Two differently seeded 64-bit hashes; never NULL, also where all columns are."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)



def quoted(name: str) -> str:
    """A column name as Spark's expressions want it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def unclashing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The columns that are named like none of ``names``, in any case of letters."""
    taken = {name.lower() for name in names}
    return df.select(*(quoted(c) for c in df.columns if c.lower() not in taken))


def per_worker(kind: str, key: Hashable, make: Callable[[], T]) -> T:
    """An object that the tasks of a Python worker process share, made by the first of them.

    There is one of each kind, that of the last key: another key takes its place. Functions come to
    workers by value, with globals of their own in each task, so it is kept by the interpreter.
    """
    held = sys.__dict__.setdefault("_shared_by_tasks", {})
    if kind not in held or held[kind][0] != key:
        held[kind] = (key, make())
    return held[kind][1]


def file_key(path: str) -> tuple:
    """A file's path, size and time of change."""
    status = os.stat(path)
    return path, status.st_size, status.st_mtime_ns
