"""The nine curated tables: read a file family, clean it, overwrite the table.

Every builder is a narrow DataFrame -> DataFrame step: no shuffle, no Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from bizregistry.functions import (
    decode_code,
    decode_yyyymmdd,
    in_years,
    parse_decimal_comma,
    parse_int,
    since,
    year_of,
)
from bizregistry.functions.codes import (
    MATRIZ_FILIAL,
    PORTE_EMPRESA,
    SITUACAO_CADASTRAL,
    TIPO_SOCIO,
)
from bizregistry.operators import overwrite_partitions, overwrite_table
from bizregistry.sources import (
    FAMILIES,
    land_archives,
    list_archives,
    read_archived_delimited,
    read_delimited,
    read_landed,
    with_provenance,
)

from .account import ACCOUNT, RECORD, account_rows, counted, flagged

PARTNERS_SINCE = date(2010, 1, 1)


def _decode_dates(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: decode_yyyymmdd(c) for c in columns})


# Columns that builders decode, by table.
DATES = {
    "simples": ("dt_op_simples", "dt_exclusao_simples", "dt_op_mei", "dt_exclusao_mei"),
    "socio": ("dt_entrada_sociedade",),
    "estabelecimento": ("dt_situacao_cadastral", "dt_inicio_atividade", "dt_sit_especial"),
}
DECIMALS = {"empresa": ("capital_social",)}


def build_code_table(df: DataFrame) -> DataFrame:
    """Code tables are kept as read."""
    return df


def build_simples(df: DataFrame) -> DataFrame:
    return _decode_dates(df, *DATES["simples"])


def build_socio(df: DataFrame, first_entry: date = PARTNERS_SINCE) -> DataFrame:
    labelled = df.withColumn("tipo_socio", decode_code("cod_ident_socio", TIPO_SOCIO))
    dated = _decode_dates(labelled, *DATES["socio"])
    return dated.filter(since("dt_entrada_sociedade", first_entry))


def build_empresa(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "capital_social": parse_decimal_comma("capital_social"),
            "porte_empresa": decode_code("cod_porte", PORTE_EMPRESA),
        }
    )


def build_estabelecimento(
    df: DataFrame, matriz_filial: Mapping[int, str] = MATRIZ_FILIAL
) -> DataFrame:
    labelled = df.withColumns(
        {
            "matriz_filial": decode_code("cod_matriz_filial", matriz_filial),
            "situacao_cadastral": decode_code("cod_situacao_cadastral", SITUACAO_CADASTRAL),
        }
    )
    return _decode_dates(labelled, *DATES["estabelecimento"])


BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "simples": build_simples,
    "cnae": build_code_table,
    "municipio": build_code_table,
    "natureza_juridica": build_code_table,
    "pais": build_code_table,
    "qualificacao_socio": build_code_table,
    "socio": build_socio,
    "empresa": build_empresa,
    "estabelecimento": build_estabelecimento,
}

# Rows are ordered by opening date inside each output file. Every question filters on it, and
# Parquet page statistics then let a scan pass over most pages. There is no shuffle for it.
SORT_BY = {"estabelecimento": ["dt_inicio_atividade"]}

# Tables which keep the path each row came from.
WITH_FILENAME = frozenset({"estabelecimento"})


# The table that may be placed by year, its date, and the column of the years.
BY_YEAR = "estabelecimento"
OPENED, YEAR = "dt_inicio_atividade", "ano_inicio"


def place_by_year(df: DataFrame) -> DataFrame:
    """Establishments with ``ano_inicio``, dealt out by opening date.

    The one shuffle of curation, and only where it is asked for. Each task gets a range of dates, so a
    year is few files; a date with very many rows is divided by company.
    """
    placed = df.withColumn(YEAR, year_of(OPENED).cast("int"))
    return placed.repartitionByRange(OPENED, "cnpj_basico")


def read_family(
    spark: SparkSession,
    landing_root: str,
    table: str,
    *,
    archived: bool = False,
    landed: bool = False,
    header: bool | str = True,
    wide: bool = False,
    on_bad: str = "raise",
) -> DataFrame:
    """Rows of one file family: from plain files, ZIP archives or what ``land_archives`` landed.

    ``archived`` skips the landing step: members are parsed while they are inflated, so the
    text is never written out and read back. ``landed`` reads the files that the manifest in
    ``landing_root`` lists. ``wide`` keeps as text the columns which their declared integer type
    would lose; without it they are text during the scan only.
    """
    df = _scan(spark, landing_root, table, FAMILIES[table].wide, archived, landed, header, on_bad)
    return _narrowed(df, table, wide)


def _scan(
    spark: SparkSession,
    landing_root: str,
    table: str,
    schema: StructType,
    archived: bool,
    landed: bool,
    header: bool | str,
    on_bad: str,
    record: str | None = None,
) -> DataFrame:
    family = FAMILIES[table]
    filename = "filename" if table in WITH_FILENAME else None
    if archived:
        return read_archived_delimited(
            list_archives(spark, landing_root),
            schema,
            member=family.glob,
            header=header,
            escape=family.escape,
            provenance=filename,
            on_bad=on_bad,
            record=record,
        )
    if landed:
        return read_landed(
            spark,
            landing_root,
            schema,
            member=family.glob,
            header=header,
            escape=family.escape,
            provenance=filename,
            record=record,
        )
    path = f"{landing_root.rstrip('/')}/{family.glob}"
    df = read_delimited(
        spark, path, schema, header=header, escape=family.escape, record=record
    )
    return df if filename is None else with_provenance(df, filename)


def _narrowed(df: DataFrame, table: str, wide: bool) -> DataFrame:
    family = FAMILIES[table]
    if wide or not family.text:
        return df
    return df.withColumns({column: parse_int(column) for column in family.text})


def curate(
    spark: SparkSession,
    landing_root: str,
    target: Callable[[str], str] | str,
    *,
    tables: Iterable[str] = tuple(BUILDERS),
    archived: bool = False,
    land_in: str | None = None,
    header: bool | str = True,
    wide: bool = False,
    sort_by: Mapping[str, list[str]] = SORT_BY,
    on_bad: str = "raise",
    by_year: bool = False,
    years: tuple[int, int] | None = None,
    account: bool = False,
    builders: Mapping[str, Callable[[DataFrame], DataFrame]] = BUILDERS,
) -> DataFrame | None:
    """Build tables and overwrite each one; an error stops the run and is raised.

    ``target`` is a folder, or a function from table to path or table name. A table keeps its old
    content until the new one is whole. An archive that is not whole stops the run, unless ``on_bad``
    is "skip". ``builders`` gives other readings, such as ``partial(build_socio, first_entry=...)``.

    ``land_in`` names a folder where archives are landed first, those that it lacks only; tables are
    then read from there. ``by_year`` places establishments in a partition for each opening year,
    which the questions prune to those they ask for. With ``years``, the first and the last, only
    these years' partitions are written, and those of other years stay as they are; a year without
    rows keeps its old ones. The target is then a folder.

    With ``account`` returns what the scans lost, as ``table, measure, column, n``: ``rows``,
    ``odd_records`` and ``lost`` values of a column. It is counted while tables are written (with
    ``years``, of the rows of these years); where ``target`` is a folder it is written to ``_account``
    there, too.
    """
    place = target if callable(target) else lambda table: f"{target.rstrip('/')}/{table}"
    if years and not by_year:
        raise ValueError("years need by_year")
    landed = archived and land_in is not None
    tables, counts = list(tables), []
    if landed:
        for table in tables:
            land_archives(
                list_archives(spark, landing_root),
                land_in,
                member=FAMILIES[table].glob,
                header=bool(header),
                on_bad=on_bad,
            )
        landing_root, archived = land_in, False
    for table in tables:
        family, names, observation = FAMILIES[table], None, None
        placed = by_year and table == BY_YEAR
        record = RECORD if account else None
        source = _scan(
            spark, landing_root, table, family.wide, archived, landed, header, on_bad, record
        )
        if account:
            source, names = flagged(
                source,
                family,
                dates=DATES.get(table, ()),
                decimals=DECIMALS.get(table, ()),
                wide=wide,
            )
            if not placed:
                # Before any row is filtered out; nothing is shuffled.
                source, observation = counted(source, names)
        built = builders[table](_narrowed(source, table, wide))
        if placed:
            built = place_by_year(built.filter(in_years(OPENED, *years)) if years else built)
            if account:
                built, observation = counted(built, names)
        order = sort_by.get(table, ())
        if placed and years:
            overwrite_partitions(built, place(table), partition_by=[YEAR], sort_by=order)
        else:
            years_of = [YEAR] if placed else []
            overwrite_table(built, place(table), partition_by=years_of, sort_by=order)
        if observation is not None:
            counts += account_rows(table, observation.get)
    if not account:
        return None
    lost = spark.createDataFrame(counts, ACCOUNT)
    if not callable(target):
        overwrite_table(lost.coalesce(1), f"{target.rstrip('/')}/_account")
    return lost
