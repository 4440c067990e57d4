"""Test tables in the roles of the register's tables.

Only renames and constant-size expressions, so filters and column pruning still reach the
Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizregistry.plans import Register

YEARS = (1996, 2000)
FOREIGN = "R"
ACTIVE = "F"
CLOSED = "O"
# A status dates from so many days after the opening.
STATUS_DAYS = 45
MEDIUM = "3-MEDIUM"
AS_OF = "2000-06-01"

# Activity ranges in percent of the highest part key, so they hold at every scale.
INDUSTRY_PCT = (25, 70)
COMMERCE_PCT = (70, 90)
HIGHER_EDUCATION_PCT = (5, 30)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, *tables: str) -> Register:
    """The named register tables; others are left out, as opening a file costs a job."""
    return Register(**{name: _ROLES[name](spark, sf_dir) for name in tables})


def _estabelecimento(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return _renamed(
        lines.withColumn("status_date", F.date_add("l_shipdate", STATUS_DAYS)),
        cnpj_basico="l_orderkey",
        dt_situacao_cadastral="status_date",
        dt_inicio_atividade="l_shipdate",
        uf="l_returnflag",
        cod_cnae_principal="l_partkey",
        cod_municipio="l_suppkey",
        cod_pais="l_linenumber",
        cod_situacao_cadastral="l_linestatus",
    )


def _simples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("cnpj_basico"),
        _flag(F.col("o_orderstatus") == "F").alias("idc_op_mei"),
        _flag(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("idc_op_simples"),
    )


def _empresa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(
        table(spark, sf_dir, "orders"),
        cnpj_basico="o_orderkey",
        capital_social="o_totalprice",
        cod_porte="o_orderpriority",
        cod_nat_juridica="o_orderstatus",
    )


def _pais(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return _renamed(nation, cod_pais="n_nationkey", nom_pais="n_name")


def _municipio(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return _renamed(supplier, cod_municipio="s_suppkey", nom_municipio="s_name")


def _cnae(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(table(spark, sf_dir, "part"), cod_cnae="p_partkey", nom_cnae="p_name")


def _natureza_juridica(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = table(spark, sf_dir, "orders").select("o_orderstatus").distinct()
    return status.select(
        F.col("o_orderstatus").alias("cod_nat_juridica"),
        F.concat(F.lit("NATURE "), "o_orderstatus").alias("nom_nat_juridica"),
    )


_ROLES = {
    "estabelecimento": _estabelecimento,
    "simples": _simples,
    "empresa": _empresa,
    "pais": _pais,
    "municipio": _municipio,
    "cnae": _cnae,
    "natureza_juridica": _natureza_juridica,
}


def code_range(spark: SparkSession, sf_dir: str, pct: tuple[int, int]) -> tuple[Column, Column]:
    """Bounds as scalar subqueries: nothing is fetched to the driver to build the plan."""
    highest = table(spark, sf_dir, "part").agg(F.max("p_partkey").alias("k"))
    low, high = (highest.selectExpr(f"k * {p} div 100").scalar() for p in pct)
    return low, high


def _renamed(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*(F.col(old).alias(new) for new, old in columns.items()))


def _flag(condition: Column) -> Column:
    return F.when(condition, "S").otherwise("N")
