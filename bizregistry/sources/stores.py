"""Storage as the driver names it and tasks see it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder with its scheme: tasks know nothing of the session's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString().rstrip("/")


def store_opener():
    def open_store(path: str):
        from pyarrow import fs

        # Listed paths look like "file:/x" or "scheme://authority/x" and are not encoded.
        # S3 goes by Hadoop's names for it.
        scheme, _, rest = path.partition("://" if "://" in path else ":")
        if scheme == "file" or not rest:
            return fs.LocalFileSystem(), rest or path
        authority, _, name = rest.partition("/")
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        store, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
        return store, f"{base.rstrip('/')}/{name}"

    return open_store
