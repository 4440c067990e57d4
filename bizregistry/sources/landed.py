"""Archives landed as plain files in one pass, with a manifest that makes landing incremental."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .archives import (
    MAX_LINE_BYTES,
    _file_opener,
    _glob_regex,
    _line_blocks,
    _spread,
    list_members,
)
from .delimited import ENCODING, read_delimited, with_provenance, with_record
from .stores import qualified, store_opener

CHUNK_BYTES = 256 << 20
# Readers of a folder pass over names that begin with an underscore.
MANIFEST = "_manifest"
_MEMBER = ["archive", "position", "member", "size", "crc"]
_KINDS = (
    "archive string, position int, member string, size bigint, crc bigint, chunk int,"
    " path string, bytes bigint, lines bigint, error string"
)


def land_archives(
    archives: DataFrame,
    target: str,
    *,
    member: str = "*",
    header: bool = True,
    chunk_bytes: int = CHUNK_BYTES,
    max_line_bytes: int = MAX_LINE_BYTES,
    partitions: int | None = None,
    on_bad: str = "raise",
) -> DataFrame:
    """Write the members whose file name matches the glob ``member`` as plain files below ``target``.

    A member is inflated once, by one task, and cut at line ends into files of about
    ``chunk_bytes``, whose names end with the member's. With ``header`` every file begins with the
    member's first record, so ``read_delimited(header=True)`` over the files gives the rows that it
    gives over the unpacked members. A member's files appear under their names only after its size
    and CRC have proved right; names depend on the archive, the place in it and the CRC. So a task
    that is lost, or run twice, leaves the same files. Memory is bounded, as for ``expand_archives``.

    Files count once the manifest lists them, and it grows by one atomic append at the end. A run
    lands only members that are not in it with the same size and CRC: a second run over the same
    archives reads their tables of contents and no data, and one that was cut short is made
    good by the next. Where a member has changed, its new files take the place of the old ones
    in the manifest; ``remove_stale`` deletes those. What is no longer in the archives stays landed.

    Returns the manifest rows of this run, one for each file: ``archive, position, member, size,
    crc, chunk, path, bytes, lines, error``. ``bytes`` and ``lines`` are those taken from the member,
    so they add up to it. A member that is broken raises an error that names it. With
    ``on_bad="skip"`` it gives a row with ``error`` and without a path instead, is tried again by the
    next run, and the rest is landed; so does a file that is no archive, with a NULL member.
    """
    if on_bad not in ("raise", "skip"):
        raise ValueError(f"on_bad must be raise or skip, not {on_bad}")
    spark, strict = archives.sparkSession, on_bad == "raise"
    members = list_members(
        archives, partitions=partitions, on_bad="raise" if strict else "report"
    ).filter(F.col("member").isNull() | F.col("member").rlike(_glob_regex(member)))
    known = landed_files(spark, target).filter("error IS NULL").select(*_MEMBER).distinct()
    same = [members[c].eqNullSafe(known[c]) for c in ("archive", "position", "size", "crc")]
    new = members.join(known, on=_all(same), how="left_anti")
    root = qualified(spark, target)
    # An explicit count, as a row stands for much work; members, not archives, are dealt out.
    landed = _spread(new, partitions).mapInArrow(
        _writer(root, header, chunk_bytes, max_line_bytes, strict), _KINDS
    )
    run = uuid.uuid4().hex
    marked = landed.withColumns({"run": F.lit(run), "landed_at": F.current_timestamp()})
    marked.write.mode("append").parquet(f"{root}/{MANIFEST}")
    return _manifest(spark, target).filter(F.col("run") == run).drop("run", "landed_at")


def landed_files(spark: SparkSession, target: str) -> DataFrame:
    """The manifest: a row for each file of the last landing of each member, and for each error."""
    rows = _manifest(spark, target)
    unit = ["archive", "position"]
    last = rows.groupBy(*unit).agg(F.max(F.struct("landed_at", "run")).alias("last"))
    last = last.withColumnsRenamed({c: f"last_{c}" for c in unit})
    same = [F.col(c).eqNullSafe(F.col(f"last_{c}")) for c in unit]
    current = rows.join(last, _all([*same, F.col("run") == F.col("last.run")]), "left_semi")
    return current.drop("run", "landed_at")


def read_landed(
    spark: SparkSession,
    target: str,
    schema: StructType,
    *,
    member: str = "*",
    header: bool | str = True,
    encoding: str = ENCODING,
    escape: str | None = None,
    provenance: str | None = None,
    record: str | None = None,
) -> DataFrame:
    """Rows of the landed members whose file name matches the glob ``member``.

    Only files that the manifest lists are read. Their names are collected, as the planner would
    list a folder: one for each ``chunk_bytes`` of text. ``provenance`` names a column for their path.
    """
    files = landed_files(spark, target).filter(F.col("path").isNotNull())
    files = files.filter(F.col("member").rlike(_glob_regex(member)))
    paths = [row["path"] for row in files.select("path").orderBy("path").collect()]
    if not paths:
        empty = spark.createDataFrame([], with_record(schema, record))
        return empty if provenance is None else empty.withColumn(provenance, F.lit(None).cast("string"))
    df = read_delimited(
        spark, paths, schema, header=header, encoding=encoding, escape=escape, record=record
    )
    return df if provenance is None else with_provenance(df, provenance)


def remove_stale(spark: SparkSession, target: str) -> int:
    """Delete files that a later landing of their member has replaced; returns their number."""
    every = _manifest(spark, target).filter("path IS NOT NULL").select("path").distinct()
    current = landed_files(spark, target).filter("path IS NOT NULL").select("path")
    stale = every.join(current, "path", "left_anti")
    gone = _spread(stale).mapInArrow(_remover(), "n bigint").agg(F.sum("n")).first()
    return gone[0] or 0


def _all(conditions: list):
    joined = conditions[0]
    for condition in conditions[1:]:
        joined = joined & condition
    return joined


def _manifest(spark: SparkSession, target: str) -> DataFrame:
    kinds = f"{_KINDS}, run string, landed_at timestamp"
    folder = f"{qualified(spark, target)}/{MANIFEST}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(folder)


def _writer(root: str, header: bool, chunk_bytes: int, max_line_bytes: int, strict: bool):
    open_store, open_file = store_opener(), _file_opener()
    whole_lines = _line_blocks(max_line_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import re
        import uuid
        import zipfile
        import zlib

        import pyarrow as pa
        from pyarrow import fs

        store, folder = open_store(root)
        breaks = re.compile(rb"\r\n?|\n")
        first_record = re.compile(rb"[^\r\n]*[^\x00-\x20][^\r\n]*(?:\r\n?|\n|\Z)")
        kinds = {
            "archive": pa.string(), "position": pa.int32(), "member": pa.string(),
            "size": pa.int64(), "crc": pa.int64(), "chunk": pa.int32(), "path": pa.string(),
            "bytes": pa.int64(), "lines": pa.int64(), "error": pa.string(),
        }

        def land(row: dict) -> list[dict]:
            """Write a member's files under names of this attempt, then give them their own."""
            own = {c: row[c] for c in ("archive", "position", "member", "size", "crc")}
            mark = f"{row['archive']}\n{row['position']}\n{row['size']}\n{row['crc']}"
            key = hashlib.blake2b(mark.encode("utf-8"), digest_size=8).hexdigest()
            name, attempt = row["member"].rsplit("/", 1)[-1], uuid.uuid4().hex
            files, out, head, seen = [], None, b"", False
            try:
                with open_file(row["archive"]) as raw, zipfile.ZipFile(raw) as archive:
                    # Reading to the end verifies the CRC.
                    with archive.open(archive.infolist()[row["position"]]) as stream:
                        for _, text in whole_lines(stream, f"{row['archive']}/{row['member']}"):
                            while text:
                                if out is None:
                                    pending = f"{folder}/_pending-{attempt}-{len(files)}"
                                    out = store.open_output_stream(pending)
                                    if seen:
                                        out.write(head)
                                    files.append([pending, 0, 0])
                                room = max(0, chunk_bytes - files[-1][1])
                                cut = len(text)
                                if room < cut:
                                    # The first line end at or beyond the size that was asked for.
                                    end = breaks.search(text, max(0, room - 1))
                                    cut = end.end() if end else cut
                                part, text = text[:cut], text[cut:]
                                if header and not seen and (found := first_record.search(part)):
                                    head, seen = found.group(), True
                                out.write(part)
                                ends = part.count(b"\n") + part.count(b"\r") - part.count(b"\r\n")
                                files[-1][1] += len(part)
                                files[-1][2] += ends + (not part.endswith((b"\n", b"\r")))
                                if files[-1][1] >= chunk_bytes:
                                    out.close()
                                    out = None
                if out is not None:
                    out.close()
                found = sum(size for _, size, _ in files)
                if found != row["size"]:
                    raise zipfile.BadZipFile(f"{found} bytes instead of {row['size']}")
            except (zipfile.BadZipFile, zlib.error, EOFError) as broken:
                if out is not None and not out.closed:
                    out.close()
                for pending, _, _ in files:
                    store.delete_file(pending)
                where = f"{row['archive']}/{row['member']}"
                if strict:
                    raise ValueError(f"broken member {where}: {broken}") from broken
                return [own | {"error": str(broken)}]
            if not files:
                # A member of no bytes is landed, too, or it would be tried again.
                return [own | {"chunk": 0, "bytes": 0, "lines": 0}]
            listed = []
            for chunk, (pending, size, lines) in enumerate(files):
                last = f"{folder}/{key}-{chunk:05d}-{name}"
                try:
                    store.move(pending, last)
                except OSError:
                    # Where a move does not replace: another attempt has put the same file there.
                    if store.get_file_info(last).type != fs.FileType.File:
                        raise
                    store.delete_file(pending)
                path = f"{root}/{key}-{chunk:05d}-{name}"
                listed.append(own | {"chunk": chunk, "path": path, "bytes": size, "lines": lines})
            return listed

        store.create_dir(folder, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                if row["member"] is None:
                    found = [{"archive": row["archive"], "error": "not a whole ZIP archive"}]
                else:
                    found = land(row)
                columns = [pa.array([f.get(c) for f in found], k) for c, k in kinds.items()]
                yield pa.RecordBatch.from_arrays(columns, list(kinds))

    return write


def _remover():
    open_store = store_opener()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for batch in batches:
            gone = 0
            for path in batch.column("path").to_pylist():
                store, name = open_store(path)
                try:
                    store.delete_file(name)
                    gone += 1
                except FileNotFoundError:
                    # Another attempt of this task has deleted it.
                    continue
            yield pa.RecordBatch.from_arrays([pa.array([gone], pa.int64())], ["n"])

    return remove
