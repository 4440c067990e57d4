"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizregistry import functions as fn
from bizregistry import plans, sources
from bizregistry.functions import codes
from bizregistry.operators import (
    Lookup,
    attach,
    average_by,
    count_sets,
    distinct_sets,
    merge_sets,
    opening_counts,
    overwrite_partitions,
    overwrite_table,
    top_n,
)
from bizregistry.sources.schemas import FAMILIES, schema_of

from . import landing
from .roles import (
    ACTIVE,
    AS_OF,
    CLOSED,
    COMMERCE_PCT,
    FOREIGN,
    HIGHER_EDUCATION_PCT,
    INDUSTRY_PCT,
    MEDIUM,
    YEARS,
    code_range,
    register,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _mean(column: str):
    return F.round(column, 2).alias(column)


# Questions


def _openings(plan, pct, lookups, spark: SparkSession, sf_dir: str, **other) -> DataFrame:
    options = {"years": YEARS, "foreign": FOREIGN, **other}
    if pct is not None:
        options["codes"] = code_range(spark, sf_dir, pct)
    return plan(register(spark, sf_dir, "estabelecimento", "pais", *lookups), **options)


_REGIMES = ("simples", "municipio")
QUERIES["q1_industry_openings"] = partial(
    _openings, plans.industry_openings, INDUSTRY_PCT, _REGIMES
)
QUERIES["q2_commerce_openings"] = partial(
    _openings, plans.commerce_openings, COMMERCE_PCT, _REGIMES
)
# Closures, by the date of the status.
QUERIES["q2_commerce_closures"] = partial(
    _openings,
    plans.commerce_openings,
    COMMERCE_PCT,
    _REGIMES,
    status=CLOSED,
    date_col="dt_situacao_cadastral",
)
QUERIES["q3_new_registrations"] = partial(_openings, plans.new_registrations, None, _REGIMES)
# Other readings of the questions: active only, and companies instead of establishments.
QUERIES["q1_active_industries"] = partial(
    _openings, plans.industry_openings, INDUSTRY_PCT, _REGIMES, status=ACTIVE
)
QUERIES["q3_new_companies"] = partial(
    _openings, plans.new_registrations, None, _REGIMES, distinct=True
)
QUERIES["q4_openings_by_state"] = partial(
    _openings, plans.higher_education_openings, HIGHER_EDUCATION_PCT, ()
)


@query
def q5_top_mean_capital(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = register(spark, sf_dir, "estabelecimento", "empresa", "cnae")
    top = plans.top_mean_capital(tables, as_of=AS_OF, foreign=FOREIGN)
    return top.select("nom_cnae", _mean("capital_social"))


@query
def q6_mean_capital_by_nature(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = register(spark, sf_dir, "estabelecimento", "empresa", "natureza_juridica")
    means = plans.mean_capital_by_nature(tables, as_of=AS_OF, size=MEDIUM)
    return means.select("cod_nat_juridica", _mean("media_capital_social"))


@query
def q6_mean_capital_by_named_nature(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = register(spark, sf_dir, "estabelecimento", "empresa", "natureza_juridica")
    means = plans.mean_capital_by_nature(tables, as_of=AS_OF, size=MEDIUM, label=True)
    return means.select("cod_nat_juridica", "nom_nat_juridica", _mean("media_capital_social"))


# Scans


def _round_trip(
    df: DataFrame, *, schema: str, header: bool = True, escape: str | None = None
) -> DataFrame:
    folder = landing.scratch_folder(df.sparkSession)
    path = f"{folder}/F.TEXT"
    landing.write_delimited(df, path, header=header, escape=escape)
    return sources.read_delimited(
        df.sparkSession, path, schema_of(schema), header=header, escape=escape
    )


@query
def scan_typed_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("AÇÃO "), "o_orderpriority").alias("note"), "o_totalprice"
    )
    schema = "o_orderkey bigint, note string, o_totalprice double"
    return _round_trip(orders, schema=schema)


@query
def scan_header_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real headers, one in each part file, are all dropped."""
    folder = landing.scratch_folder(spark)
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.concat(F.col("s_nationkey"), F.lit(".TEXT")).alias("family")
    )
    landing.write_delimited(supplier, folder, partition_by="family")
    schema = schema_of("s_suppkey bigint, s_name string")
    return sources.read_delimited(spark, f"{folder}/*.TEXT", schema)


@query
def scan_header_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with headers, and others without, each found out by a look at their beginnings."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    found = []
    for header in (True, False):
        folder = landing.scratch_folder(spark)
        landing.write_delimited(supplier.repartition(3), f"{folder}/F.TEXT", header=header)
        schema = schema_of("s_suppkey bigint, s_name string")
        read = sources.read_delimited(spark, f"{folder}/*.TEXT", schema, header="detect")
        found.append(read.withColumn("header", F.lit(header)))
    return found[0].unionByName(found[1])


@query
def scan_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What curating one table loses, counted while it is written."""
    root = landing.land_family(spark, sf_dir, "simples")
    lost = plans.curate(
        spark, root, landing.scratch_folder(spark), tables=["simples"], account=True
    )
    return lost.withColumn("column", F.coalesce("column", F.lit("-")))


@query
def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders fit the pattern and one does not."""
    folder = landing.scratch_folder(spark)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        landing.choice("o_orderstatus", "X.OTHER", F="F.WANTED", O="O.WANTED").alias("family"),
    )
    landing.write_delimited(orders, folder, partition_by="family")
    return sources.read_delimited(spark, f"{folder}/*.WANTED", schema_of("o_orderkey bigint"))


@query
def scan_escaped_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    quoted = nation.select(
        "n_nationkey",
        F.concat(F.lit('SALA "'), "n_name", F.lit('"; 2')).alias("quoted"),
        F.concat("n_name", F.lit(" \\")).alias("slash"),
        F.lit("next").alias("after"),
    )
    schema = "n_nationkey int, quoted string, slash string, after string"
    return _round_trip(quoted, schema=schema, escape='"')


@query
def scan_malformed_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text in an integer column is NULL; the rest of the row survives."""
    lineitem = table(spark, sf_dir, "lineitem")
    numbers = lineitem.select(
        F.when(F.col("l_linenumber") > 4, "S/N")
        .otherwise(F.col("l_linenumber").cast("string"))
        .alias("numero"),
        F.col("l_orderkey").alias("after"),
    )
    scanned = _round_trip(numbers, schema="numero int, after bigint")
    return scanned.groupBy(F.coalesce("numero", F.lit(-1)).alias("numero")).agg(
        F.count("*").alias("n"), F.sum("after").alias("after")
    )


@query
def scan_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = landing.scratch_folder(spark)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat("o_orderstatus", F.lit(".TEXT")).alias("family")
    )
    landing.write_delimited(orders, folder, partition_by="family")
    scanned = sources.read_delimited(spark, f"{folder}/*.TEXT", schema_of("o_orderkey bigint"))
    # Part-file names are random; the folder is not.
    folder_name = F.regexp_extract("filename", "/family=([^/]+)/[^/]+$", 1)
    return sources.with_provenance(scanned).withColumn("filename", folder_name)


def _links(pattern: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return sources.extract_links(pages, pattern)


QUERIES["extract_links"] = partial(_links, "")
# The pages link to no archives, so another pattern with a "any character" in it.
QUERIES["extract_links_matching"] = partial(_links, "th.")


def _archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = landing.scratch_folder(spark)
    landing.zip_pages(table(spark, sf_dir, "pages"), folder)
    return sources.list_archives(spark, folder)


@query
def list_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every archive with its members; broken and empty files have none."""
    listed = _archives(spark, sf_dir)
    members = sources.list_members(listed).select("archive", "member", "size")
    name = F.substring_index("archive", "/", -1).alias("archive")
    return listed.join(members, "archive").select(
        name, "member", F.coalesce("size", F.lit(-1)).alias("size"), (F.col("length") > 0).alias("has_bytes")
    )


@query
def expand_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Small slices, so that members are read in several parts.
    lines = sources.expand_archives(
        _archives(spark, sf_dir), member="*.PAGES", slice_bytes=2000, on_bad="skip"
    )
    return lines.filter("NOT first_record").select("line")


@query
def read_archived_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_archived_delimited(
        _archives(spark, sf_dir),
        schema_of("page_id bigint, url string"),
        member="*.PAGES",
        on_bad="skip",
    )


@query
def read_archived_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the pages out of archives, in small slices that begin at entry points."""
    whole = _archives(spark, sf_dir).filter("length > 0 AND archive NOT LIKE '%/_broken-%'")
    return sources.read_archived_delimited(
        whole,
        schema_of("page_id bigint, html string"),
        member="*.HTML",
        encoding="utf-8",
        escape='"',
        slice_bytes=5000,
        entries=sources.index_members(whole, member="*.HTML", every=2000),
    )


@query
def land_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the pages landed as plain files, by two runs of which the second finds none new."""
    archives, target = _archives(spark, sf_dir), landing.scratch_folder(spark)
    for _ in range(2):
        done = sources.land_archives(
            archives, target, member="*.HTML", chunk_bytes=20_000, on_bad="skip"
        )
    assert done.filter("error IS NULL").isEmpty()
    return sources.read_landed(
        spark,
        target,
        schema_of("page_id bigint, html string"),
        member="*.HTML",
        encoding="utf-8",
        escape='"',
    )


@query
def land_archives_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes landed of each member, and the files that are no archives."""
    archives, target = _archives(spark, sf_dir), landing.scratch_folder(spark)
    sources.land_archives(archives, target, chunk_bytes=2000, member="*.PAGES", on_bad="skip")
    name = F.substring_index("archive", "/", -1).alias("archive")
    size = F.coalesce(F.sum("bytes"), F.lit(-1)).alias("size")
    manifest = sources.landed_files(spark, target)
    return manifest.groupBy(name, "member").agg(size, (F.count("error") > 0).alias("bad"))


@query
def archive_lines_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = landing.scratch_folder(spark)
    landing.zip_pages(table(spark, sf_dir, "pages"), folder)
    reader = sources.register_zip_lines(spark).read.format("zip_lines").option("onBad", "skip")
    lines = reader.option("member", "*.PAGES").option("sliceBytes", "2000")
    lines = lines.schema("line string, first_record boolean").load(folder)
    return lines.filter("NOT first_record").select("line")


# Sink


@query
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{landing.scratch_folder(spark)}/table"
    orders = table(spark, sf_dir, "orders")
    overwrite_table(orders.filter("o_orderstatus = 'F'").select("o_orderkey"), target)
    overwrite_table(orders.select("o_orderkey", "o_orderstatus"), target)
    return spark.read.parquet(target)


@query
def sink_overwrite_of_its_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by what is read from it, partitions and all."""
    target = f"{landing.scratch_folder(spark)}/table"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    overwrite_table(orders, target, partition_by=["o_orderstatus"])
    old = spark.read.parquet(target).filter("o_orderstatus <> 'F'")
    overwrite_table(old, target, partition_by=["o_orderstatus"], sort_by=["o_orderkey"])
    return spark.read.parquet(target)


@query
def sink_replace_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Establishments placed by year; one year's are replaced, the others stay."""
    target = f"{landing.scratch_folder(spark)}/table"
    opened = register(spark, sf_dir, "estabelecimento").estabelecimento
    opened = opened.select("cnpj_basico", "dt_inicio_atividade", "uf")
    overwrite_table(plans.place_by_year(opened), target, partition_by=["ano_inicio"])
    first = opened.filter(fn.in_years("dt_inicio_atividade", YEARS[0], YEARS[0]) & (F.col("uf") == FOREIGN))
    overwrite_partitions(plans.place_by_year(first), target, partition_by=["ano_inicio"])
    return spark.read.parquet(target).groupBy("ano_inicio", "uf").agg(F.count("*").alias("n"))


@query
def q4_openings_of_placed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 over establishments that are placed by year: it opens the files of the years it asks for."""
    target = f"{landing.scratch_folder(spark)}/table"
    tables = register(spark, sf_dir, "estabelecimento", "pais")
    placed = plans.place_by_year(tables.estabelecimento)
    overwrite_table(placed, target, partition_by=["ano_inicio"])
    read = replace(tables, estabelecimento=spark.read.parquet(target))
    codes = code_range(spark, sf_dir, HIGHER_EDUCATION_PCT)
    return plans.higher_education_openings(read, years=YEARS, foreign=FOREIGN, codes=codes)


# Projections


def _decoded(spark: SparkSession, sf_dir: str, column: str, text, kind: str) -> DataFrame:
    """``o_orderkey`` and a register-style column, written as text and read back."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias(column))
    return _round_trip(orders, schema=f"o_orderkey bigint, {column} {kind}")


@query
def project_sentinel_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "F", "00000000")
        .when((status == "P") & (F.col("o_orderpriority") == "5-LOW"), "20190230")
        .otherwise(landing.day_number("o_orderdate"))
    )
    read = _decoded(spark, sf_dir, "day", text, "int")
    return read.withColumn("day", fn.decode_yyyymmdd("day").cast("string"))


@query
def project_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "F", "1.234,56").otherwise(
        landing.decimal_comma("o_totalprice")
    )
    read = _decoded(spark, sf_dir, "capital_social", text, "string")
    return read.withColumn("capital_social", fn.parse_decimal_comma("capital_social"))


@query
def project_code_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("0"), F.substring("o_orderpriority", 1, 1))
    read = _decoded(spark, sf_dir, "cod_porte", text, "int")
    return read.withColumn("porte_empresa", fn.decode_code("cod_porte", codes.PORTE_EMPRESA))


@query
def project_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.year_of("o_orderdate").alias("ano"),
        fn.month_of("o_orderdate").alias("mes"),
    )


@query
def project_year_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.year_start(F.col("o_orderdate")).cast("string").alias("year_start")
    )


# Filters


def _lines(spark: SparkSession, sf_dir: str, condition) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").filter(condition)
    return lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query
def filter_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, fn.since("l_shipdate", "1999-01-01"))


@query
def filter_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, fn.in_years("l_shipdate", *YEARS))


@query
def filter_exclude_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, fn.exclude_value("l_returnflag", FOREIGN))


@query
def filter_code_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = code_range(spark, sf_dir, INDUSTRY_PCT)
    return _lines(spark, sf_dir, fn.code_range("l_partkey", *bounds))


@query
def filter_any_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    simples = register(spark, sf_dir, "simples").simples
    return simples.filter(fn.any_flag(["idc_op_mei", "idc_op_simples"]))


@query
def filter_right_side_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = register(spark, sf_dir, "estabelecimento", "empresa")
    companies = Lookup(tables.empresa, "cnpj_basico", columns=["cod_porte"])
    attached = attach(tables.estabelecimento, companies)
    return attached.filter(fn.has_code("cod_porte", MEDIUM)).select(
        "cnpj_basico", "cod_pais", "cod_porte"
    )


@query
def filter_year_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, fn.year_to_date("l_shipdate", AS_OF))


# Joins


@query
def join_inner_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = register(spark, sf_dir, "estabelecimento", "simples")
    joined = tables.estabelecimento.join(tables.simples, "cnpj_basico")
    return joined.select("cnpj_basico", "cod_pais", "idc_op_mei", "idc_op_simples")


@query
def join_left_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = register(spark, sf_dir, "estabelecimento", "municipio")
    cities = Lookup(tables.municipio, "cod_municipio", columns=["nom_municipio"])
    return attach(tables.estabelecimento, cities).select(
        "cnpj_basico", "cod_municipio", "nom_municipio"
    )


@query
def join_left_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = register(spark, sf_dir, "estabelecimento", "cnae")
    activities = Lookup(tables.cnae, "cod_cnae_principal", "cod_cnae", columns=["nom_cnae"])
    return attach(tables.estabelecimento, activities).select(
        "cnpj_basico", "cod_cnae_principal", "nom_cnae"
    )


@query
def join_left_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the companies are missing: their establishments have no capital."""
    tables = register(spark, sf_dir, "estabelecimento", "empresa")
    known = tables.empresa.filter("capital_social >= 250000")
    companies = Lookup(known, "cnpj_basico", columns=["capital_social"])
    return attach(tables.estabelecimento, companies).select(
        "cnpj_basico", "cod_pais", "capital_social"
    )


@query
def join_left_nature(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = register(spark, sf_dir, "empresa", "natureza_juridica")
    natures = Lookup(
        tables.natureza_juridica, "cod_nat_juridica", columns=["nom_nat_juridica"]
    )
    return attach(tables.empresa, natures).select(
        "cnpj_basico", "cod_nat_juridica", "nom_nat_juridica"
    )


@query
def join_left_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the code table is missing: its rows get a NULL label."""
    tables = register(spark, sf_dir, "estabelecimento", "pais")
    countries = Lookup(
        tables.pais.filter("cod_pais <= 3"), "cod_pais", columns=["nom_pais"]
    )
    return attach(tables.estabelecimento, countries).select(
        "cnpj_basico", "cod_pais", "nom_pais"
    )


@query
def join_left_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join that gives no column still multiplies rows on a duplicate key."""
    tables = register(spark, sf_dir, "estabelecimento", "pais")
    doubled = tables.pais.unionAll(tables.pais.filter("cod_pais = 2"))
    return opening_counts(
        tables.estabelecimento,
        keys={"uf": F.col("uf")},
        lookups=[Lookup(doubled, "cod_pais")],
        count="cnpj_basico",
    )


# Aggregates and top-n


@query
def agg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = register(spark, sf_dir, "estabelecimento").estabelecimento
    # NULL values are not counted.
    fact = fact.withColumn("city", F.when(F.col("uf") != "A", F.col("cod_municipio")))
    return opening_counts(fact, keys={"uf": F.col("uf")}, count="city")


@query
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = register(spark, sf_dir, "estabelecimento").estabelecimento
    keys = {"ano": fn.year_of("dt_inicio_atividade"), "uf": F.col("uf")}
    return opening_counts(fact, keys=keys, count="cnpj_basico", distinct=True)


@query
def agg_distinct_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies by year, from sets by month that are merged."""
    lines = table(spark, sf_dir, "lineitem").select(
        landing.zero_padded("l_orderkey", 8).alias("company"),
        fn.year_of("l_shipdate").alias("ano"),
        fn.month_of("l_shipdate").alias("mes"),
    )
    months = distinct_sets(lines, ["ano", "mes"], "company")
    return count_sets(merge_sets(months, ["ano"]), ["ano"], "qtd_empresas")


@query
def agg_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = register(spark, sf_dir, "empresa").empresa
    means = average_by(companies, by=["cod_porte"], value="capital_social", name="media")
    return means.select("cod_porte", _mean("media"))


@query
def agg_avg_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = register(spark, sf_dir, "estabelecimento", "empresa", "cnae")
    means = plans.questions.mean_capital_by_activity(tables, as_of=AS_OF, foreign=FOREIGN)
    return means.select("nom_cnae", _mean("capital_social"))


QUERIES["top_n"] = lambda spark, sf_dir: top_n(
    table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
    "o_totalprice",
    10,
    tie_break=["o_orderkey"],
)


# Curated tables


# Integer columns with NULLs between numbers, which some clients turn into floating point.
_WITH_GAPS = {"cod_cnae_secundario", "cpf_representante", "ente_federativo", "fax", "numero"}


def _curated(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing.land_family(spark, sf_dir, name)
    built = plans.BUILDERS[name](plans.read_family(spark, root, name))
    shown = {
        c: F.col(c).cast("string")
        for c, kind in built.dtypes
        if kind == "date" or c in _WITH_GAPS
    }
    if "filename" in built.columns:
        shown["filename"] = F.regexp_extract("filename", "/family=([^/]+)/[^/]+$", 1)
    return built.withColumns(shown) if shown else built


for _name in FAMILIES:
    QUERIES[f"table_{_name}"] = partial(_curated, _name)
