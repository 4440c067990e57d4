"""Typed delimited text scans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_, or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

DELIMITER = ";"
ENCODING = "ISO-8859-1"


# Of a file's beginning, so much is read to tell whether it has a header.
PROBE_BYTES = 1 << 20


def csv_options(
    *, header: bool, escape: str | None, sep: str = DELIMITER, record: str | None = None
) -> dict[str, str]:
    """Reader options shared by plain files and archive members."""
    options = {"sep": sep, "header": str(header).lower(), "mode": "PERMISSIVE"}
    if escape is not None:
        options["escape"] = escape
    if record is not None:
        options["columnNameOfCorruptRecord"] = record
    return options


def with_record(schema: StructType, record: str | None) -> StructType:
    """The schema with a column for records that do not fit it."""
    return schema if record is None else StructType([*schema.fields, StructField(record, StringType())])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    *,
    header: bool | str = True,
    encoding: str = ENCODING,
    escape: str | None = None,
    sep: str = DELIMITER,
    record: str | None = None,
) -> DataFrame:
    """Scan delimited text under a fixed schema; ``path`` may hold globs.

    There is no schema inference, so the input is read once, and files are split at line
    breaks, so one huge file still feeds many tasks. A field that does not fit its type is
    NULL and the rest of its row survives. ``header=True`` drops the first line of *every*
    file: pass False for files that start with data, or one record per file is lost.

    ``header="detect"`` looks at the first record of each file beforehand, and raises an error that
    names files where some have a header and others do not, or where that cannot be told.
    ``record`` names a column for the text of records of which a field did not fit its type, or that
    have another number of fields.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if header == "detect":
        header = detect_header(spark, paths, schema, encoding=encoding, escape=escape, sep=sep)
    options = csv_options(header=bool(header), escape=escape, sep=sep, record=record)
    reader = spark.read.schema(with_record(schema, record))
    return reader.options(encoding=encoding, **options).csv(paths)


def first_records(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    *,
    encoding: str = ENCODING,
    escape: str | None = None,
    sep: str = DELIMITER,
) -> DataFrame:
    """``file, first, header`` for each file: its first record, and does that look like a header?

    It does if it has the names of the schema's columns, or text where numbers belong and no number
    there; it is data if there is a number. NULL where neither can be said, and for files without a
    record. One narrow job over the files' beginnings.
    """
    paths = [path] if isinstance(path, str) else list(path)
    # The files are listed as for the scan itself; their content is not read.
    files = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"))
    first = files.mapInArrow(_first_line(encoding), "file string, line string")
    texts = ", ".join(f"`{f.name}` string" for f in schema.fields)
    options = csv_options(header=False, escape=escape, sep=sep)
    fields = first.select("file", "line", F.from_csv("line", F.lit(texts), options).alias("f"))
    numeric = [f.name for f in schema.fields if not isinstance(f.dataType, StringType)]

    def value(name: str) -> Column:
        return F.trim(F.col("f")[name])

    def any_of(conditions: list[Column]) -> Column:
        return F.coalesce(reduce(or_, conditions, F.lit(False)), F.lit(False))

    named = [F.coalesce(F.lower(value(n)) == n.lower(), F.lit(False)) for n in schema.names]
    numbers = [F.coalesce(value(n).try_cast("double").isNotNull(), F.lit(False)) for n in numeric]
    texts_there = [F.coalesce(value(n) != "", F.lit(False)) for n in numeric]
    header = (
        F.when(any_of(numbers), False)
        .when(reduce(and_, named, F.lit(True)), True)
        .when(any_of(texts_there), True)
    )
    return fields.select("file", F.col("line").alias("first"), header.alias("header"))


def detect_header(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    *,
    encoding: str = ENCODING,
    escape: str | None = None,
    sep: str = DELIMITER,
) -> bool:
    """Whether files begin with headers; raises where they differ or it cannot be told.

    Files without a record have no say.
    """
    found = first_records(spark, path, schema, encoding=encoding, escape=escape, sep=sep)
    found = found.filter("first IS NOT NULL")
    # A row for each of at most three answers, with one of the files that gave it.
    kinds = found.groupBy("header").agg(F.min("file").alias("file"), F.count("*").alias("n"))
    answers = {row["header"]: row for row in kinds.collect()}
    if None in answers:
        row = answers[None]
        raise ValueError(f"cannot tell whether {row['n']} files have a header, as {row['file']}")
    if len(answers) == 2:
        raise ValueError(
            f"{answers[True]['n']} files have a header, as {answers[True]['file']},"
            f" and {answers[False]['n']} have none, as {answers[False]['file']}"
        )
    return True in answers


def _first_line(encoding: str):
    from .stores import store_opener

    open_store, most = store_opener(), PROBE_BYTES

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import pyarrow as pa

        record = re.compile(rb"[^\r\n]*[^\x00-\x20][^\r\n]*")
        for batch in batches:
            lines = []
            for path in batch.column("file").to_pylist():
                store, name = open_store(path)
                with store.open_input_stream(name) as stream:
                    found = record.search(stream.read(most))
                lines.append(found.group().decode(encoding) if found else None)
            columns = [batch.column("file"), pa.array(lines, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["file", "line"])

    return probe


def with_provenance(df: DataFrame, name: str = "filename") -> DataFrame:
    """Add the path of the file each row came from. Call it directly on a file scan."""
    return df.withColumn(name, F.col("_metadata.file_path"))
