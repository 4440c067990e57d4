"""Jobs for spark-submit: ``links``, ``curate`` and ``ask``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date
from functools import partial

from pyspark.sql import SparkSession

from bizregistry import plans, sources
from bizregistry.functions.codes import MATRIZ_FILIAL, MATRIZ_FILIAL_AS_WRITTEN
from bizregistry.operators import overwrite_table
from bizregistry.plans.tables import PARTNERS_SINCE, build_estabelecimento, build_socio
from bizregistry.session import configure
from bizregistry.sources.links import ARCHIVE_LINK

QUESTIONS = {
    "industry-openings": plans.industry_openings,
    "commerce-openings": plans.commerce_openings,
    "new-registrations": plans.new_registrations,
    "higher-education-openings": plans.higher_education_openings,
    "top-mean-capital": plans.top_mean_capital,
    "mean-capital-by-nature": plans.mean_capital_by_nature,
}
_OPENINGS = ("years", "status", "date_col", "distinct", "drop_unused")
# Arguments that the command line may give each question, and the tables it joins.
READINGS = {
    "industry-openings": _OPENINGS,
    "commerce-openings": _OPENINGS,
    "new-registrations": _OPENINGS,
    "higher-education-openings": _OPENINGS,
    "top-mean-capital": ("as_of", "n"),
    "mean-capital-by-nature": ("as_of", "label", "drop_unused"),
}
_REGIMES = ["estabelecimento", "simples", "municipio", "pais"]
TABLES = {
    "industry-openings": _REGIMES,
    "commerce-openings": _REGIMES,
    "new-registrations": _REGIMES,
    "higher-education-openings": ["estabelecimento", "pais"],
    "top-mean-capital": ["estabelecimento", "empresa", "cnae"],
    "mean-capital-by-nature": ["estabelecimento", "empresa", "natureza_juridica"],
}


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="bizregistry", description=__doc__)
    jobs = main.add_subparsers(dest="job", required=True)

    links = jobs.add_parser("links", help="links of a Parquet table of pages")
    links.add_argument("pages", help="folder of a Parquet table with an html column")
    links.add_argument("target", help="folder or table to overwrite")
    links.add_argument("--pattern", default=ARCHIVE_LINK)

    curate = jobs.add_parser("curate", help="build the curated tables")
    curate.add_argument("landing", help="folder of register files or archives")
    curate.add_argument("target", help="folder for the tables")
    curate.add_argument("--archived", action="store_true", help="read ZIP archives")
    curate.add_argument("--skip-bad", action="store_true", help="leave out broken archives")
    curate.add_argument("--land-in", help="folder to land archives in first, new ones only")
    headers = curate.add_mutually_exclusive_group()
    headers.add_argument("--no-header", action="store_true", help="files start with data")
    headers.add_argument("--detect-header", action="store_true", help="look at the files' beginnings")
    curate.add_argument("--by-year", action="store_true", help="a partition for each opening year")
    curate.add_argument("--years", type=int, nargs=2, metavar=("FIRST", "LAST"), help="replace these only")
    curate.add_argument("--account", action="store_true", help="count what parsing loses")
    curate.add_argument("--partners-since", type=date.fromisoformat, default=PARTNERS_SINCE)
    curate.add_argument("--branches-as-written", action="store_true", help="no label for branches")
    curate.add_argument("--wide", action="store_true", help="keep lossy integers as text")
    curate.add_argument("--tables", nargs="+", choices=plans.BUILDERS, default=[*plans.BUILDERS])

    ask = jobs.add_parser("ask", help="answer a question from the curated tables")
    ask.add_argument("question", choices=QUESTIONS)
    ask.add_argument("tables", help="folder of the curated tables")
    ask.add_argument("target", help="folder or table to overwrite")
    ask.add_argument("--as-of", help="date whose year counts as the last one, yyyy-mm-dd")
    ask.add_argument("--years", type=int, nargs=2, metavar=("FIRST", "LAST"))
    ask.add_argument("--status", type=int, help="registration status, such as 2 or 8")
    ask.add_argument("--date-col", help="date that counts, such as dt_situacao_cadastral")
    ask.add_argument("--distinct", action=argparse.BooleanOptionalAction, help="companies, not establishments")
    ask.add_argument("--label", action="store_true", help="add names of legal natures")
    ask.add_argument("-n", type=int, help="how many of the first activities")
    ask.add_argument("--drop-unused", action="store_true", help="leave out joins that take no column")
    return main


def _options(args: argparse.Namespace) -> dict:
    """Readings of a question that the command line asks for; those it does not have are refused."""
    asked = {
        "as_of": args.as_of,
        "years": tuple(args.years) if args.years else None,
        "status": args.status,
        "date_col": args.date_col,
        "distinct": args.distinct,
        "label": args.label or None,
        "n": args.n,
        "drop_unused": args.drop_unused or None,
    }
    given = {name: value for name, value in asked.items() if value is not None}
    known = READINGS[args.question]
    if other := sorted(set(given) - set(known)):
        raise SystemExit(f"{args.question} has no {', '.join(other)}")
    if "as_of" in known and "as_of" not in given:
        raise SystemExit(f"{args.question} needs --as-of")
    return given


def _tables(question: str, options: dict) -> list[str]:
    """The tables that a question joins under these options."""
    tables = [t for t in TABLES[question] if t != "pais" or not options.get("drop_unused")]
    if question == "mean-capital-by-nature" and options.get("drop_unused") and not options.get("label"):
        tables.remove("natureza_juridica")
    return tables


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    if args.job == "links":
        pages = spark.read.parquet(args.pages)
        overwrite_table(sources.extract_links(pages, args.pattern), args.target)
    elif args.job == "curate":
        branches = MATRIZ_FILIAL_AS_WRITTEN if args.branches_as_written else MATRIZ_FILIAL
        readings = {
            "socio": partial(build_socio, first_entry=args.partners_since),
            "estabelecimento": partial(build_estabelecimento, matriz_filial=branches),
        }
        archived = args.archived or args.land_in is not None
        lost = plans.curate(
            spark,
            args.landing,
            args.target,
            tables=args.tables,
            archived=archived,
            land_in=args.land_in,
            header="detect" if args.detect_header else not args.no_header,
            wide=args.wide,
            on_bad="skip" if args.skip_bad else "raise",
            by_year=args.by_year,
            years=tuple(args.years) if args.years else None,
            account=args.account,
            builders=plans.BUILDERS | readings,
        )
        if lost is not None:
            lost.orderBy("table", "measure", "column").show(1000, truncate=False)
        if archived and args.skip_bad:
            # The report that a skipped archive leaves, next to the tables.
            skipped = sources.skipped_archives(sources.list_archives(spark, args.landing))
            overwrite_table(skipped.coalesce(1), f"{args.target.rstrip('/')}/_skipped")
    else:
        options = _options(args)
        register = plans.Register.load(spark, args.tables, _tables(args.question, options))
        overwrite_table(QUESTIONS[args.question](register, **options), args.target)


if __name__ == "__main__":
    run(configure(SparkSession.builder.appName("bizregistry").getOrCreate()))
