"""The six named questions over the curated tables.

Defaults reproduce the questions as they were written, and arguments give the readings
their wording suggests. ``as_of`` stands in for the wall clock, so results can be repeated.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizregistry.functions import (
    any_flag,
    code_range,
    exclude_value,
    has_code,
    in_years,
    month_of,
    year_of,
    year_start,
    year_to_date,
)
from bizregistry.functions.codes import (
    COMMERCE,
    FOREIGN_STATE,
    HIGHER_EDUCATION,
    INDUSTRY,
    SMALL_FIRM,
)
from bizregistry.operators import Lookup, attach, average_by, opening_counts, top_n

from .tables import OPENED, YEAR

FIRST_YEAR, LAST_YEAR = 2010, 2021

CodeRange = tuple[Column | int, Column | int]


@dataclass(frozen=True)
class Register:
    """The curated tables the questions read. A question needs only the ones it joins."""

    estabelecimento: DataFrame | None = None
    simples: DataFrame | None = None
    empresa: DataFrame | None = None
    pais: DataFrame | None = None
    municipio: DataFrame | None = None
    cnae: DataFrame | None = None
    natureza_juridica: DataFrame | None = None

    @classmethod
    def load(
        cls, spark: SparkSession, root: str, tables: Iterable[str] | None = None
    ) -> Register:
        """Tables written by ``curate``: below a folder, or in a database if there is no "/".

        ``tables`` names those that a question joins; others need not exist.
        """

        def read(name: str) -> DataFrame:
            if "/" in root:
                return spark.read.parquet(f"{root.rstrip('/')}/{name}")
            return spark.table(f"{root}.{name}")

        return cls(**{n: read(n) for n in (tables or cls.__dataclass_fields__)})


def _openings(
    register: Register,
    *,
    years: tuple[int, int],
    codes: CodeRange | None,
    foreign: object,
    date_col: str,
    status: int | None,
) -> DataFrame:
    """Domestic establishments opened in ``years``. All conditions reach the scan."""
    df = register.estabelecimento.filter(in_years(date_col, *years))
    if date_col == OPENED:
        df = _of_years(df, *years)
    df = df.filter(exclude_value("uf", foreign))
    if codes is not None:
        df = df.filter(code_range("cod_cnae_principal", *codes))
    if status is not None:
        df = df.filter(has_code("cod_situacao_cadastral", status))
    return df


def _of_years(
    df: DataFrame, first: int | Column | None = None, last: int | Column | None = None
) -> DataFrame:
    """Prunes a table that is placed by year to the years asked for; the dates are filtered anyway."""
    if YEAR not in df.columns:
        return df
    if first is not None:
        df = df.filter(F.col(YEAR) >= first)
    return df if last is None else df.filter(F.col(YEAR) <= last)


def openings_by_municipality(
    register: Register,
    *,
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR),
    codes: CodeRange | None = None,
    distinct: bool = False,
    foreign: object = FOREIGN_STATE,
    date_col: str = "dt_inicio_atividade",
    status: int | None = None,
    drop_unused: bool = False,
) -> DataFrame:
    """Openings per year, month, municipality and tax regime, for firms in a special regime.

    ``distinct`` counts companies instead of establishments. The country table gives no
    column: joining it only matters if its key has duplicates, and ``drop_unused`` is for
    callers who know that it has none.
    """
    openings = _openings(
        register, years=years, codes=codes, foreign=foreign, date_col=date_col, status=status
    )
    flags = register.simples.filter(any_flag(["idc_op_mei", "idc_op_simples"]))
    # The one large join: both sides are filtered and pruned before they are shuffled, and
    # adaptive execution splits the key of a company with very many establishments.
    joined = openings.join(
        flags.select("cnpj_basico", "idc_op_mei", "idc_op_simples"), "cnpj_basico"
    )
    lookups = [Lookup(register.municipio, "cod_municipio", columns=["nom_municipio"])]
    if not drop_unused:
        lookups.insert(0, Lookup(register.pais, "cod_pais"))
    return opening_counts(
        joined,
        keys={
            "ano": year_of(date_col),
            "mes": month_of(date_col),
            "idc_op_mei": F.col("idc_op_mei"),
            "idc_op_simples": F.col("idc_op_simples"),
        },
        lookups=lookups,
        count="cnpj_basico",
        distinct=distinct,
    ).select("ano", "mes", "qtd_empresas", "nom_municipio", "idc_op_mei", "idc_op_simples")


def industry_openings(
    register: Register, *, codes: CodeRange = INDUSTRY, **options
) -> DataFrame:
    """Q1: industries. As written any status counts; ``status=2`` keeps active ones."""
    return openings_by_municipality(register, codes=codes, **options)


def commerce_openings(
    register: Register, *, codes: CodeRange = COMMERCE, distinct: bool = True, **options
) -> DataFrame:
    """Q2: commerces. As written by opening date, whatever the status.

    ``status=8, date_col="dt_situacao_cadastral"`` counts closures by closing date.
    """
    return openings_by_municipality(register, codes=codes, distinct=distinct, **options)


def new_registrations(register: Register, **options) -> DataFrame:
    """Q3: all activities."""
    return openings_by_municipality(register, **options)


def higher_education_openings(
    register: Register,
    *,
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR),
    codes: CodeRange = HIGHER_EDUCATION,
    distinct: bool = True,
    foreign: object = FOREIGN_STATE,
    date_col: str = "dt_inicio_atividade",
    status: int | None = None,
    drop_unused: bool = False,
) -> DataFrame:
    """Q4: companies in higher education per year and state.

    The question's wording says ``years=(2015, 2021)``; the default is what was computed.
    """
    openings = _openings(
        register, years=years, codes=codes, foreign=foreign, date_col=date_col, status=status
    )
    return opening_counts(
        openings,
        keys={"ano": year_of(date_col), "uf": F.col("uf")},
        lookups=[] if drop_unused else [Lookup(register.pais, "cod_pais")],
        count="cnpj_basico",
        distinct=distinct,
    ).select("ano", "uf", "qtd_empresas")


def mean_capital_by_activity(
    register: Register, *, as_of: date | str, foreign: object = FOREIGN_STATE
) -> DataFrame:
    """Mean share capital per activity of establishments opened in the year of ``as_of``.

    Weighted by establishment, and by full activity name, as written.
    """
    opened = register.estabelecimento.filter(
        exclude_value("uf", foreign) & year_to_date(OPENED, as_of)
    )
    opened = _of_years(opened, F.year(year_start(as_of)))
    companies = Lookup(register.empresa, "cnpj_basico", columns=["capital_social"])
    activities = Lookup(
        register.cnae, "cod_cnae_principal", "cod_cnae", columns=["nom_cnae"]
    )
    return average_by(
        attach(opened, companies),
        by=["nom_cnae"],
        value="capital_social",
        name="capital_social",
        lookup=activities,
    )


def top_mean_capital(
    register: Register, *, as_of: date | str, n: int = 1, foreign: object = FOREIGN_STATE
) -> DataFrame:
    """Q5: the activity with the highest mean share capital; ties go to the first name."""
    means = mean_capital_by_activity(register, as_of=as_of, foreign=foreign)
    return top_n(means, "capital_social", n, tie_break=["nom_cnae"])


def mean_capital_by_nature(
    register: Register,
    *,
    as_of: date | str,
    size: object = SMALL_FIRM,
    label: bool = False,
    drop_unused: bool = False,
) -> DataFrame:
    """Q6: mean share capital of small firms by legal nature, for this year's openings.

    ``label`` adds the name of the legal nature.
    """
    opened = register.estabelecimento.filter(year_to_date(OPENED, as_of))
    opened = _of_years(opened, F.year(year_start(as_of)))
    companies = Lookup(
        register.empresa,
        "cnpj_basico",
        columns=["cod_nat_juridica", "capital_social", "cod_porte"],
    )
    # The condition on the right side makes this an inner join, which the planner sees.
    small = attach(opened, companies).filter(has_code("cod_porte", size))
    natures = Lookup(
        register.natureza_juridica,
        "cod_nat_juridica",
        columns=["nom_nat_juridica"] if label else [],
    )
    return average_by(
        small,
        by=["cod_nat_juridica", *natures.columns],
        value="capital_social",
        name="media_capital_social",
        lookup=natures if label or not drop_unused else None,
    )
