"""ZIP archives as a distributed source: list, expand to lines, parse."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .delimited import DELIMITER, ENCODING, csv_options, with_record
from .stores import store_opener

SLICE_BYTES = 256 << 20
# Slices have a task each while they are no more than this; beyond it, tasks are for so many bytes.
MANY_TASKS = 1_000
TASK_BYTES = 32 << 20
# A longer line fails the task that meets it: memory stays bounded, and nothing is lost silently.
MAX_LINE_BYTES = 64 << 20
_LINE_KINDS = {
    "archive": "string",
    "member": "string",
    "line_no": "bigint",
    "first_record": "boolean",
    "line": "string",
}
LINE_COLUMNS = tuple(_LINE_KINDS)


def list_archives(spark: SparkSession, root: str, pattern: str = "*.zip") -> DataFrame:
    """Archives under ``root``, at any depth: ``archive`` (path) and ``length``.

    ``root`` may be a glob; ``pattern`` (with ``*`` and ``?``) is that of the file names. Every
    name counts, hidden ones and files of no bytes too, so that the reader can complain of
    what is no archive. Only file status is read, by a task for each top-level folder.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(path)
    if not found:
        raise FileNotFoundError(f"no such folder or file: {root}")
    roots = [(status.getPath().toString(), status.isDirectory()) for status in found]
    entries = spark.createDataFrame(roots, "path string, folder boolean")
    kinds = "path string, folder boolean, length bigint"
    top = entries.mapInArrow(_file_lister(deep=False), kinds)
    # Folders are dealt out one by one: a row stands for all that lies below it.
    deep = _spread(top.filter("folder").select("path", "folder")).mapInArrow(
        _file_lister(deep=True), kinds
    )
    files = top.filter("NOT folder").unionByName(deep.filter("NOT folder"))
    name = F.substring_index("path", "/", -1)
    return files.filter(name.rlike(_glob_regex(pattern))).select(
        F.col("path").alias("archive"), "length"
    )


def list_members(
    archives: DataFrame, *, partitions: int | None = None, on_bad: str = "report"
) -> DataFrame:
    """Files inside each archive: ``archive, position, member, size, crc``.

    Reads the table of contents at the end of an archive, not its data. A file which is no
    ZIP archive, as one of no bytes or cut off in transfer, gives one row with a NULL member, so
    skipped input can be reported; with ``on_bad="raise"`` it fails the task that meets it, by name.
    """
    return _spread(archives.select("archive"), partitions).mapInArrow(
        _member_lister(on_bad == "raise"),
        "archive string, position int, member string, size bigint, crc bigint",
    )


def skipped_archives(archives: DataFrame) -> DataFrame:
    """Files with an archive name but no archive inside."""
    return list_members(archives).filter(F.col("member").isNull()).select("archive")


def expand_archives(
    archives: DataFrame,
    *,
    member: str = "*",
    encoding: str = ENCODING,
    partitions: int | None = None,
    slice_bytes: int = SLICE_BYTES,
    max_line_bytes: int = MAX_LINE_BYTES,
    on_bad: str = "raise",
    entries: DataFrame | None = None,
    columns: Sequence[str] = LINE_COLUMNS,
) -> DataFrame:
    """Lines of the archive members whose file name matches the glob ``member``.

    Columns: ``archive, member, line_no, first_record, line``, or those of them that ``columns``
    names; the others are not made. ``line_no`` counts from 0 within a member. ``first_record`` is
    true for a member's first line that is not blank, false for later ones and NULL for blank lines.

    Lines end at "\\n", "\\r\\n" or a lone "\\r", as they do for the plain reader.

    The unit of work is a slice of a member, so neither an archive with most of the members
    nor a member with most of the lines ends up in one task. A deflate stream has no entry
    points of its own. With ``entries``, the table that ``index_members`` makes, a slice begins to
    inflate at the last entry point before it. Without, or where a member has changed since, its task
    inflates what precedes it and throws that away: cheap next to parsing for some dozens of
    slices; for larger members index them, land them or raise ``slice_bytes``. Unless ``partitions`` is given, there are tasks in proportion to the bytes inside, which
    one job reads from the tables of contents beforehand; these names and sizes stay cached. Small
    slices share tasks: ``MANY_TASKS`` of them, or one for each ``TASK_BYTES`` where that is more. Then
    neighbours go to one task, which reads those that begin to inflate at the same place in one pass.

    A task opens the archive where it lies on shared storage and streams it in blocks. A line of
    more than ``max_line_bytes`` raises an error that names its member, so memory use is
    bounded, and a lost task just reads again. ``encoding`` must be a superset of ASCII.

    A file that is no archive, or only the first part of one, raises an error that names it.
    With ``on_bad="skip"`` it is left out; ``skipped_archives`` reports such files.
    """
    if on_bad not in ("raise", "skip"):
        raise ValueError(f"on_bad must be raise or skip, not {on_bad}")
    members = list_members(archives, partitions=partitions, on_bad=on_bad).filter(
        "member IS NOT NULL"
    )
    if member != "*":
        members = members.filter(F.col("member").rlike(_glob_regex(member)))
    run_bytes = None
    if partitions is None:
        # Names and sizes, kept by the executors for the second job; lost ones are listed again.
        members = members.persist()
        total = members.agg(F.sum("size")).first()[0] or 0
        wanted, most = task_count(total, slice_bytes), -(-total // slice_bytes)
        partitions = max(_least_tasks(archives.sparkSession), wanted)
        if partitions < most:
            run_bytes = max(slice_bytes, -(-total // partitions))
    # "size - 1" keeps a slice from starting at the very end; an empty member has one slice.
    starts = F.sequence(
        F.lit(0).cast("bigint"), F.greatest("size", F.lit(1)) - 1, F.lit(slice_bytes).cast("bigint")
    )
    own = ["archive", "position", "member", "size", "crc"]
    slices = members.select(*own, F.explode(starts).alias("start"))
    slices = slices.withColumn("stop", F.col("start") + slice_bytes)
    if entries is not None:
        slices = _with_entries(slices, entries)
    kinds = ", ".join(f"{c} {_LINE_KINDS[c]}" for c in columns)
    slices = slices.drop("size", "crc")
    if run_bytes is None:
        dealt = _spread(slices, partitions)
    else:
        run = F.floor(F.col("start") / run_bytes)
        dealt = slices.repartition(partitions, "archive", "position", run)
    return (
        dealt.sortWithinPartitions("archive", "position", "start")
        .mapInArrow(_slice_reader(encoding, max_line_bytes, columns=tuple(columns)), kinds)
    )


def _with_entries(slices: DataFrame, entries: DataFrame) -> DataFrame:
    """Slices with the last entry point before each: one that holds the byte before it, too."""
    unit = ["archive", "position", "size", "crc"]
    # A point serves what begins up to the next one. So points are joined once, and found once.
    later = F.lead("entry").over(Window.partitionBy(*unit).orderBy("entry"))
    points = entries.withColumn("until", later)
    points = points.withColumnsRenamed({c: f"own_{c}" for c in unit})
    begin = F.greatest("start", F.lit(1))
    served = (begin > F.col("entry")) & (F.col("until").isNull() | (begin <= F.col("until")))
    same = [F.col(c) == F.col(f"own_{c}") for c in unit]
    joined = slices.join(points, [*same, served], "left")
    return joined.drop("until", *(f"own_{c}" for c in unit))


def read_archived_delimited(
    archives: DataFrame,
    schema: StructType,
    *,
    member: str = "*",
    header: bool = True,
    encoding: str = ENCODING,
    escape: str | None = None,
    sep: str = DELIMITER,
    provenance: str | None = None,
    partitions: int | None = None,
    slice_bytes: int = SLICE_BYTES,
    on_bad: str = "raise",
    entries: DataFrame | None = None,
    record: str | None = None,
) -> DataFrame:
    """Parse archived delimited files without landing the text first.

    Same rows as ``read_delimited`` over the unpacked files. Quoted line breaks are not
    supported, nor are they by that reader. ``provenance`` names a column for
    ``archive/member``, ``record`` one for records that do not fit, as it does there.
    """
    if not isinstance(header, bool):
        raise ValueError("members have headers or not: they are not probed")
    path = () if provenance is None else ("archive", "member")
    lines = expand_archives(
        archives,
        member=member,
        encoding=encoding,
        partitions=partitions,
        slice_bytes=slice_bytes,
        on_bad=on_bad,
        entries=entries,
        columns=(*path, "first_record", "line"),
    )
    records = lines.filter("NOT first_record" if header else "first_record IS NOT NULL")
    options = csv_options(header=False, escape=escape, sep=sep, record=record)
    ddl = _ddl(with_record(schema, record))
    parsed = F.from_csv("line", F.lit(ddl), options).alias("record")
    if provenance is None:
        return records.select(parsed).select("record.*")
    source = F.concat_ws("/", "archive", "member").alias(provenance)
    return records.select(parsed, source).select("record.*", provenance)


def task_count(total: int, slice_bytes: int) -> int:
    """Tasks for so many bytes in slices: tasks of a few bytes would cost more than their reading."""
    return min(-(-total // slice_bytes), max(MANY_TASKS, -(-total // TASK_BYTES)))


def _least_tasks(spark: SparkSession) -> int:
    return max(
        4 * spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )


def _spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    # The rows are file names that stand for much work. An explicit count keeps adaptive
    # execution from merging them into one task, as it would judge them by their size.
    return df.repartition(partitions or _least_tasks(df.sparkSession))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _glob_regex(glob: str) -> str:
    # Matches the file name: members may sit in folders inside the archive.
    wildcards = {"*": "[^/]*", "?": "[^/]"}
    body = "".join(wildcards.get(c) or (c if c.isalnum() else "\\" + c) for c in glob)
    return f"(^|/){body}$"


# The functions below run in Python workers. They are closures that do not refer to this
# module, so executors need pyarrow and access to the storage, but not this package.


def _file_lister(deep: bool):
    open_store = store_opener()

    def list_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        from pyarrow import fs

        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.bool_(), pa.int64())
            columns = list(zip(*found)) or [()] * 3
            names = ["path", "folder", "length"]
            return pa.RecordBatch.from_arrays([pa.array(*c) for c in zip(columns, kinds)], names)

        for batch in batches:
            for path, folder in zip(*(batch.column(c).to_pylist() for c in ("path", "folder"))):
                store, name = open_store(path)
                below = fs.FileSelector(name, recursive=deep) if folder else [name]
                found = []
                for info in store.get_file_info(below):
                    # Named like the folder it was listed by, scheme and authority included.
                    own = path.rstrip("/") + info.path[len(name.rstrip("/")) :]
                    found.append((own, info.type == fs.FileType.Directory, info.size))
                for at in range(0, len(found), 4096):
                    yield rows(found[at : at + 4096])

    return list_files


def _member_lister(strict: bool):
    open_file = _file_opener()

    def list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        import pyarrow as pa

        for batch in batches:
            for path in batch.column("archive").to_pylist():
                with open_file(path) as raw:
                    if zipfile.is_zipfile(raw):
                        with zipfile.ZipFile(raw) as archive:
                            found = [
                                (position, info.filename, info.file_size, info.CRC)
                                for position, info in enumerate(archive.infolist())
                                if not info.is_dir()
                            ]
                    elif strict:
                        raise ValueError(f"not a whole ZIP archive: {path}")
                    else:
                        found = [(None, None, None, None)]
                for at in range(0, len(found), 4096):
                    part = found[at : at + 4096]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "archive": pa.array([path] * len(part), pa.string()),
                            "position": pa.array([f[0] for f in part], pa.int32()),
                            "member": pa.array([f[1] for f in part], pa.string()),
                            "size": pa.array([f[2] for f in part], pa.int64()),
                            "crc": pa.array([f[3] for f in part], pa.int64()),
                        }
                    )

    return list_batches


def _line_blocks(max_line_bytes: int, block_bytes: int = 4 << 20):
    def whole_lines(stream, name: str, at: int = 0) -> Iterator[tuple[int, bytes]]:
        """(offset, text) blocks that end with a whole line break, but for the last one."""
        tail, waiting, held = [], 0, b""
        while data := stream.read(block_bytes):
            data = held + data
            # A "\r" at the end may be the first half of a break.
            held = b"\r" if data.endswith(b"\r") else b""
            data = data[: len(data) - len(held)]
            # Other breaks, such as U+0085, are legal inside a field.
            cut = max(data.rfind(b"\n"), data.rfind(b"\r")) + 1
            if cut:
                text = b"".join([*tail, data[:cut]])
                yield at, text
                at += len(text)
                tail, waiting = [], 0
            tail.append(data[cut:])
            waiting += len(data) - cut
            if waiting > max_line_bytes:
                raise ValueError(f"a line of more than {max_line_bytes} bytes in {name}")
        if rest := b"".join([*tail, held]):
            yield at, rest

    return whole_lines


def _slice_reader(
    encoding: str,
    max_line_bytes: int,
    block_bytes: int = 4 << 20,
    columns: tuple[str, ...] = LINE_COLUMNS,
):
    open_file = _file_opener()
    open_member = _member_opener()
    whole_lines = _line_blocks(max_line_bytes, block_bytes)
    # What the JVM's String.trim removes: a line of nothing else is not a CSV record.
    blank = "".join(map(chr, range(33)))
    blank_bytes = blank.encode("ascii")

    def begun_before(ends, offset: int, at: int, text: bytes) -> int:
        """Length of the part of a block whose lines begin before a member offset."""
        if offset <= at:
            return 0
        found = ends.search(text, offset - 1 - at)
        return found.end() if found else len(text)

    def slice_lines(stream, name: str, row: dict) -> Iterator[tuple[int, bool, str]]:
        """(number of the first line, was there a record before it, lines) per block."""
        import re

        ends = re.compile(b"\r\n?|\n")
        start, stop = row["start"], row["stop"]
        line_no, seen = row.get("breaks") or 0, row.get("seen") or False
        for at, text in whole_lines(stream, name, row.get("entry") or 0):
            low, high = (begun_before(ends, offset, at, text) for offset in (start, stop))
            breaks = text.count(b"\n", 0, low) + text.count(b"\r", 0, low)
            line_no += breaks - text.count(b"\r\n", 0, low)
            seen = seen or bool(text[:low].strip(blank_bytes))
            if low < high:
                lines = text[low:high].replace(b"\r\n", b"\n").replace(b"\r", b"\n")
                lines = lines.removesuffix(b"\n")
                yield line_no, seen, lines.decode(encoding)
                line_no += lines.count(b"\n") + 1
                seen = seen or bool(lines.strip(blank_bytes))
            if at + len(text) >= stop:
                return

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile
        from contextlib import ExitStack
        from itertools import groupby
        from operator import itemgetter

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def record_marks(seen: bool, lines: pa.Array) -> pa.Array:
            trimmed = pc.ascii_trim(lines, characters=blank)
            empty = np.asarray(pc.equal(pc.binary_length(trimmed), 0))
            marks = np.zeros(len(lines), bool)
            if not seen and not empty.all():
                marks[np.argmin(empty)] = True
            return pa.array(marks, mask=empty)

        slices = (
            dict(zip(batch.schema.names, values))
            for batch in batches
            for values in zip(*(batch.column(c).to_pylist() for c in batch.schema.names))
        )

        def joined(rows: Iterator[dict]) -> Iterator[dict]:
            """Slices that follow on each other and begin to inflate at one place, as one."""
            held = None
            for row in rows:
                if held is None:
                    held = row
                elif held["stop"] == row["start"] and all(
                    held.get(c) == row.get(c) for c in ("archive", "position", "entry")
                ):
                    held = held | {"stop": row["stop"]}
                else:
                    yield held
                    held = row
            if held is not None:
                yield held

        def records(row: dict, stream) -> Iterator[pa.RecordBatch]:
            path, member = row["archive"], row["member"]
            for first, seen, text in slice_lines(stream, f"{path}/{member}", row):
                lines = pc.split_pattern(pa.array([text], pa.string()), "\n").flatten()
                n = len(lines)
                makers = {
                    "archive": lambda: pa.repeat(pa.scalar(path, pa.string()), n),
                    "member": lambda: pa.repeat(pa.scalar(member, pa.string()), n),
                    "line_no": lambda: pa.array(np.arange(first, first + n)),
                    "first_record": lambda: record_marks(seen, lines),
                    "line": lambda: lines,
                }
                made = [makers[c]() for c in columns]
                if made:
                    yield pa.RecordBatch.from_arrays(made, list(columns))
                else:
                    # Rows are counted only.
                    yield pa.RecordBatch.from_struct_array(pa.array([{}] * n, pa.struct([])))

        # Slices come in archive order, so each table of contents is read once per task.
        for path, rows in groupby(joined(slices), key=itemgetter("archive")):
            with ExitStack() as opened:
                raw = opened.enter_context(open_file(path))
                archive = opened.enter_context(zipfile.ZipFile(raw))
                contents = archive.infolist()
                for row in rows:
                    with open_member(archive, raw, contents[row["position"]], row) as stream:
                        yield from records(row, stream)

    return read_batches


def _member_opener():
    class Inflated:
        """A member's text from an entry point on.

        The point is a bit of the deflate stream, so the bytes from there on are shifted to begin at
        a byte; the text before the point serves as dictionary.
        """

        def __init__(self, raw, at: int, end: int, bit: int, window: bytes) -> None:
            import zlib

            self.raw, self.at, self.end, self.shift = raw, at + bit // 8, end, bit % 8
            self.inflate = zlib.decompressobj(-15, zdict=window)
            self.held, self.waiting = b"", b""

        def __enter__(self):
            return self

        def __exit__(self, *_error) -> None:
            pass

        def read(self, n: int) -> bytes:
            while not self.inflate.eof:
                if not self.waiting:
                    self.waiting = self.shifted(1 << 20)
                    if not self.waiting:
                        raise EOFError("the deflate stream ends too early")
                text = self.inflate.decompress(self.waiting, n)
                self.waiting = self.inflate.unconsumed_tail
                if text:
                    return text
            return b""

        def shifted(self, n: int) -> bytes:
            import numpy as np

            # Slices of an archive take turns with its file.
            self.raw.seek(self.at)
            data = self.raw.read(min(n, self.end - self.at))
            self.at += len(data)
            if not self.shift:
                return data
            whole = self.held + data
            if not data:
                self.held = b""
                return bytes([whole[0] >> self.shift]) if whole else b""
            self.held = whole[-1:]
            values = np.frombuffer(whole, np.uint8)
            low, high = values[:-1] >> self.shift, values[1:] << (8 - self.shift)
            return (low | high).tobytes()

    def open_member(archive, raw, info, row: dict):
        """A member, from the entry point of its slice on if it has one."""
        if not row.get("entry"):
            return archive.open(info)
        # The length of the local header is only known from that header.
        raw.seek(info.header_offset + 26)
        sizes = raw.read(4)
        at = info.header_offset + 30 + sum(sizes[0::2]) + 256 * sum(sizes[1::2])
        return Inflated(raw, at, at + info.compress_size, row["bit"], row["window"])

    return open_member


def _file_opener():
    open_store = store_opener()

    class Archive:
        """A file whose seeks stop at its start, as those of a buffer in memory do."""

        def __init__(self, path: str) -> None:
            store, name = open_store(path)
            self.stream = store.open_input_file(name)
            self.read, self.tell = self.stream.read, self.stream.tell

        def seek(self, offset: int, whence: int = 0) -> int:
            base = (0, self.stream.tell(), self.stream.size())[whence]
            return self.stream.seek(max(0, base + offset))

        def seekable(self) -> bool:
            return True

        def close(self) -> None:
            self.stream.close()

        def __enter__(self):
            return self

        def __exit__(self, *_error) -> None:
            self.close()

    return Archive
