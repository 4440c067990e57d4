"""Test tables rendered as register files and archives, for round trips through the readers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizregistry.sources.delimited import DELIMITER, ENCODING
from bizregistry.sources.stores import qualified, store_opener

from .roles import table


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that every executor can reach."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/bizregistry-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="bizregistry-")


# A task writes so many families at once. Rows are wide text, so sorting them would spill most.
FAMILIES_AT_ONCE = 32
_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"
# Compressed files are not split, so none gets more rows.
ROWS_PER_FILE = 1_000_000


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Rows go to the files of their families as they come; beyond so many families, by sorting."""
    before = spark.conf.get(_AT_ONCE)
    spark.conf.set(_AT_ONCE, str(FAMILIES_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(_AT_ONCE, before)


def write_delimited(
    df: DataFrame,
    path: str,
    *,
    header: bool = True,
    escape: str | None = None,
    partition_by: str | None = None,
    compressed: bool = False,
) -> None:
    writer = df.write.mode("overwrite").options(
        sep=DELIMITER, encoding=ENCODING, header=str(header).lower(), quoteAll="true"
    )
    if escape is not None:
        writer = writer.option("escape", escape)
    if compressed:
        writer = writer.options(compression="gzip", maxRecordsPerFile=ROWS_PER_FILE)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    with _unsorted(df.sparkSession):
        writer.csv(path)


def land_family(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Write one file family and return the landing folder."""
    root = scratch_folder(spark)
    if name == "estabelecimento":
        # One folder per line status, each with a name that fits the family's pattern.
        write_delimited(
            _estabelecimento(table(spark, sf_dir, "lineitem")),
            root,
            escape='"',
            partition_by="family",
            compressed=True,
        )
        return root
    source, suffix, columns = _FAMILIES[name]
    rows = table(spark, sf_dir, source).select(*columns())
    write_delimited(rows, f"{root}/T.{suffix}", compressed=True)
    return root


PAGES_PER_ARCHIVE = 16


def zip_pages(pages: DataFrame, root: str) -> None:
    """Pack pages into ZIP archives below ``root``, one per range of page ids, inside the tasks.

    Names depend on the ids only and files appear under their final name once complete, so a
    task that runs again replaces its own archives. Each archive holds the even pages in one member
    and the odd ones in another, and the text of all in a third, without its line breaks. A broken
    file and one of no bytes come with each.
    """
    key = F.floor(F.col("page_id") / PAGES_PER_ARCHIVE).alias("key")
    target = qualified(pages.sparkSession, root)
    packed = pages.select(key, "page_id", "url", "html").groupBy("key").applyInArrow(
        _packer(target), "archive string"
    )
    # Runs the job; one row reaches the driver.
    packed.agg(F.count("archive")).first()


def _packer(root: str):
    open_store = store_opener()

    def pack(group: pa.Table) -> pa.Table:
        import io
        import zipfile

        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        store, folder = open_store(root)
        store.create_dir(folder, recursive=True)

        def write(name: str, data: bytes) -> str:
            pending = f"{folder}/{name}.{task.taskAttemptId()}"
            with store.open_output_stream(pending) as out:
                out.write(data)
            store.move(pending, f"{folder}/{name}")
            return name

        def quoted(text: str | None) -> str:
            line = (text or "").replace("\r", " ").replace("\n", " ")
            return '"' + line.replace('"', '""') + '"'

        rows = sorted(group.to_pylist(), key=lambda row: row["page_id"])
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
            for odd, member in enumerate(("a.PAGES", "sub/b.PAGES")):
                part = [row for row in rows if row["page_id"] % 2 == odd]
                text = "".join(f"{r['page_id']};{r['url']}\r\n" for r in part)
                archive.writestr(member, ("page_id;url\r\n" + text).encode("latin-1"))
            lines = (f"{r['page_id']};{quoted(r['html'])}\n" for r in rows)
            archive.writestr("html/c.HTML", ("page_id;html\n" + "".join(lines)).encode("utf-8"))
        files = {"p": data.getvalue(), "_broken-": data.getvalue()[:-30], "empty-": b""}
        number = rows[0]["key"]
        written = [write(f"{kind}{number}.zip", content) for kind, content in files.items()]
        return pa.table({"archive": pa.array(written, pa.string())})

    return pack


def zero_padded(col: Column | str, width: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.lpad(c.cast("string"), width, "0")


def day_number(col: Column | str) -> Column:
    return F.date_format(col, "yyyyMMdd")


def decimal_comma(col: str) -> Column:
    return F.replace(F.col(col).cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


def choice(col: str, otherwise: str, **values: str) -> Column:
    expr = F
    for value, result in values.items():
        expr = expr.when(F.col(col) == value, result)
    return expr.otherwise(otherwise)


def _simples() -> list[Column]:
    opened = day_number("o_orderdate")
    return [
        zero_padded("o_orderkey", 8).alias("cnpj_basico"),
        choice("o_orderstatus", "N", F="S").alias("idc_op_simples"),
        opened.alias("dt_op_simples"),
        F.when(F.col("o_orderstatus") == "O", opened)
        .otherwise(choice("o_orderstatus", "00000000", P="20190230"))
        .alias("dt_exclusao_simples"),
        choice("o_orderstatus", "N", O="S").alias("idc_op_mei"),
        F.when(F.col("o_orderstatus") == "O", opened).otherwise("0").alias("dt_op_mei"),
        F.when(F.col("o_orderstatus") == "P", opened)
        .when(F.col("o_orderpriority") == "5-LOW", "sem data")
        .otherwise("00000000")
        .alias("dt_exclusao_mei"),
    ]


def _socio() -> list[Column]:
    # Twelve years later, so that the entry dates lie on both sides of 2010.
    entered = day_number(F.add_months("o_orderdate", 144))
    return [
        zero_padded("o_orderkey", 8).alias("cnpj_basico"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", "3")
        .otherwise(choice("o_orderstatus", "9", F="1", O="2"))
        .alias("cod_ident_socio"),
        F.concat(F.lit("SÓCIO "), F.col("o_custkey").cast("string")).alias("nom_socio"),
        F.lit("***123456**").alias("cnpj_cpf_socio"),
        F.lit("49").alias("cod_qualif_socio"),
        F.when(F.col("o_orderpriority") == "5-LOW", "00000000")
        .otherwise(entered)
        .alias("dt_entrada_sociedade"),
        F.col("o_custkey").cast("string").alias("cod_pais"),
        F.when(F.col("o_orderstatus") == "F", "***123456**")
        .otherwise(zero_padded("o_custkey", 9))
        .alias("cpf_representante"),
        F.lit("JOSÉ").alias("nom_representante"),
        F.lit("00").alias("cod_qualif_representante"),
        F.lit("5").alias("cod_faixa_etaria"),
        F.concat(F.lit("RAZÃO "), "o_orderpriority").alias("razao_social"),
    ]


def _empresa() -> list[Column]:
    return [
        zero_padded("o_orderkey", 8).alias("cnpj_basico"),
        F.concat(F.lit("COMÉRCIO "), F.col("o_custkey").cast("string")).alias("razao_social"),
        zero_padded("o_custkey", 8).alias("cod_nat_juridica"),
        F.lit("49").alias("cod_qualif_socio"),
        F.when(F.col("o_orderstatus") == "P", "1.234,56")
        .otherwise(decimal_comma("o_totalprice"))
        .alias("capital_social"),
        F.concat(F.lit("0"), F.substring("o_orderpriority", 1, 1)).alias("cod_porte"),
        F.when(F.col("o_orderstatus") == "P", "99999999999")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("ente_federativo"),
    ]


def _code_table(code: str, label: str, names: tuple[str, str]):
    return lambda: [F.col(code).alias(names[0]), F.col(label).alias(names[1])]


_FAMILIES = {
    "simples": ("orders", "SIMPLES.CSV", _simples),
    "cnae": ("part", "CNAECSV", _code_table("p_partkey", "p_name", ("cod_cnae", "nom_cnae"))),
    "municipio": (
        "supplier",
        "MUNICCSV",
        _code_table("s_suppkey", "s_name", ("cod_municipio", "nom_municipio")),
    ),
    "natureza_juridica": (
        "region",
        "NATJUCSV",
        _code_table("r_regionkey", "r_name", ("cod_nat_juridica", "nom_nat_juridica")),
    ),
    "pais": ("nation", "PAISCSV", _code_table("n_nationkey", "n_name", ("cod_pais", "nom_pais"))),
    "qualificacao_socio": (
        "customer",
        "QUALSCSV",
        _code_table("c_custkey", "c_mktsegment", ("cod_qualif_socio", "nom_qualif_socio")),
    ),
    "socio": ("orders", "SOCIOCSV", _socio),
    "empresa": ("orders", "EMPRECSV", _empresa),
}


def _estabelecimento(lineitem: DataFrame) -> DataFrame:
    shipped = day_number("l_shipdate")
    text = {c: F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey")}
    line = F.col("l_linenumber").cast("string")
    return lineitem.select(
        zero_padded("l_orderkey", 8).alias("cnpj_basico"),
        zero_padded("l_linenumber", 4).alias("cnpj_origem"),
        zero_padded("l_linenumber", 2).alias("cnpj_dv"),
        line.alias("cod_matriz_filial"),
        F.concat(F.lit('SALA "'), "l_returnflag", F.lit('" Ç')).alias("nom_fantasia"),
        F.when(F.col("l_linenumber") <= 4, zero_padded("l_linenumber", 2))
        .otherwise(choice("l_returnflag", "09", N="08"))
        .alias("cod_situacao_cadastral"),
        F.when(F.col("l_linestatus") == "O", shipped)
        .otherwise("00000000")
        .alias("dt_situacao_cadastral"),
        F.lit("00").alias("cod_motivo_situcao_cadastral"),
        F.lit("-").alias("nom_cidade_exterior"),
        line.alias("cod_pais"),
        shipped.alias("dt_inicio_atividade"),
        text["l_partkey"].alias("cod_cnae_principal"),
        F.when(F.col("l_linenumber") <= 2, text["l_partkey"])
        .otherwise(F.concat_ws(",", text["l_partkey"], text["l_suppkey"]))
        .alias("cod_cnae_secundario"),
        F.lit("RUA").alias("tipo_logradouro"),
        F.concat(F.lit("SÃO "), text["l_suppkey"]).alias("logradouro"),
        F.when(F.col("l_linenumber") > 4, "S/N").otherwise(line).alias("numero"),
        F.lit("BARRA \\").alias("complemento"),
        F.concat(F.lit("CENTRO; "), "l_linestatus").alias("bairro"),
        zero_padded("l_suppkey", 8).alias("cep"),
        F.col("l_returnflag").alias("uf"),
        text["l_suppkey"].alias("cod_municipio"),
        line.alias("ddd_1"),
        text["l_orderkey"].alias("telefone_1"),
        F.lit("21").alias("ddd_2"),
        text["l_partkey"].alias("telefone_2"),
        F.lit("31").alias("ddd_fax"),
        F.when(F.col("l_linenumber") == 7, "99999999999")
        .otherwise(text["l_partkey"])
        .alias("fax"),
        F.concat(text["l_orderkey"], F.lit("@example.com")).alias("email"),
        F.lit("-").alias("sit_especial"),
        F.when(F.col("l_returnflag") == "R", shipped)
        .otherwise("20190230")
        .alias("dt_sit_especial"),
        F.concat("l_linestatus", F.lit(".ESTABELE")).alias("family"),
    )
