"""ZIP archives as a Spark data source: ``spark.read.format("zip_lines")``."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .archives import (
    _LINE_KINDS,
    MAX_LINE_BYTES,
    SLICE_BYTES,
    _file_lister,
    _glob_regex,
    _member_lister,
    _slice_reader,
    task_count,
)
from .delimited import ENCODING

FORMAT = "zip_lines"
# Tables of contents that are read at once.
THREADS = 32
_OPTIONS = {"path", "pattern", "member", "encoding", "slicebytes", "maxlinebytes", "onbad"}


@dataclass
class Slices(InputPartition):
    """(archive, position, member, start, stop) of some slices, in the order of the archives."""

    rows: list[tuple[str, int, str, int, int]]


class ZipLines(DataSource):
    """Lines of archive members, as ``expand_archives`` gives them.

    Options: ``path`` (an archive, or a folder searched at any depth; local without a scheme), ``pattern`` of the archives'
    file names (default ``*.zip``), ``member`` (glob, default ``*``), ``encoding``, ``sliceBytes``,
    ``maxLineBytes`` and ``onBad`` (``raise`` or ``skip``).

    Columns are ``archive, member, line_no, first_record, line``, or those of them, in any order,
    that ``.schema(...)`` asks for: the others are not made, nor sent to the JVM. Listing and the tables
    of contents are read where the query is planned, by some threads: names and sizes, no data. A
    partition holds slices of about ``sliceBytes`` in all, or of more where that would make too many
    partitions (``task_count``), so many small members share a task and a large one feeds many.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ", ".join(f"{c} {kind}" for c, kind in _LINE_KINDS.items())

    def reader(self, schema: StructType) -> DataSourceReader:
        for field in schema.fields:
            if _LINE_KINDS.get(field.name) != field.dataType.simpleString():
                raise ValueError(f"{FORMAT} has no column {field.name} {field.dataType.simpleString()}")
        unknown = {key.lower() for key in self.options} - _OPTIONS
        if unknown:
            raise ValueError(f"{FORMAT} has no option {', '.join(sorted(unknown))}")
        return ZipLinesReader(tuple(schema.names), dict(self.options))


class ZipLinesReader(DataSourceReader):
    def __init__(self, columns: tuple[str, ...], options: dict[str, str]) -> None:
        found = {key.lower(): value for key, value in options.items()}
        if "path" not in found:
            raise ValueError(f"{FORMAT} needs a path")
        path = found["path"]
        has_scheme = "://" in path or path.startswith("file:")
        self.columns, self.path = columns, path if has_scheme else f"file:{path}"
        self.pattern = found.get("pattern", "*.zip")
        self.member = found.get("member", "*")
        self.encoding = found.get("encoding", ENCODING)
        self.slice_bytes = int(found.get("slicebytes", SLICE_BYTES))
        self.max_line_bytes = int(found.get("maxlinebytes", MAX_LINE_BYTES))
        self.on_bad = found.get("onbad", "raise")
        if self.on_bad not in ("raise", "skip") or self.slice_bytes < 1:
            raise ValueError("onBad must be raise or skip, sliceBytes 1 or more")

    def _listed(self) -> list[str]:
        import re

        folder = not re.search(_glob_regex(self.pattern), self.path)
        batch = pa.RecordBatch.from_pydict({"path": [self.path], "folder": [folder]})
        name = re.compile(_glob_regex(self.pattern))
        found = (row for part in _file_lister(deep=True)(iter([batch])) for row in part.to_pylist())
        return sorted(r["path"] for r in found if not r["folder"] and name.search(r["path"]))

    def partitions(self) -> list[Slices]:
        import re

        contents = _member_lister(self.on_bad == "raise")
        name = re.compile(_glob_regex(self.member))

        def members(path: str) -> list[dict]:
            batch = pa.RecordBatch.from_pydict({"archive": [path]})
            rows = [row for part in contents(iter([batch])) for row in part.to_pylist()]
            return [r for r in rows if r["member"] is not None and name.search(r["member"])]

        with ThreadPoolExecutor(THREADS) as pool:
            listed = [row for rows in pool.map(members, self._listed()) for row in rows]
        total = sum(row["size"] for row in listed)
        most = max(self.slice_bytes, -(-total // max(1, task_count(total, self.slice_bytes))))
        parts, held = [Slices([])], 0
        for row in listed:
            for start in range(0, max(1, row["size"]), self.slice_bytes):
                stop = start + self.slice_bytes
                size = min(stop, row["size"]) - start
                if held + size > most and parts[-1].rows:
                    parts.append(Slices([]))
                    held = 0
                parts[-1].rows.append((row["archive"], row["position"], row["member"], start, stop))
                held += size
        return parts

    def read(self, partition: Slices) -> Iterator[pa.RecordBatch]:
        names = ["archive", "position", "member", "start", "stop"]
        if partition.rows:
            batch = pa.RecordBatch.from_pydict(dict(zip(names, zip(*partition.rows))))
            read = _slice_reader(self.encoding, self.max_line_bytes, columns=self.columns)
            yield from read(iter([batch]))


def register_zip_lines(spark: SparkSession) -> SparkSession:
    """Make ``spark.read.format("zip_lines")`` known to a session; executors need this package."""
    spark.dataSource.register(ZipLines)
    return spark
