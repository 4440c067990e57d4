from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bizregistry import functions as fn
from bizregistry.functions import codes


def values(spark, rows, ddl, expr):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expr).collect()]


@pytest.mark.parametrize(
    "number, day",
    [
        (0, None),
        (None, None),
        (20190230, None),
        (20191301, None),
        (20190100, None),
        (20190132, None),
        (20190431, None),
        (19000229, None),
        (20000229, date(2000, 2, 29)),
        (20240229, date(2024, 2, 29)),
        (20070701, date(2007, 7, 1)),
        (10101, None),
        (120190101, None),
        (2147483647, None),
        (-2147483648, None),
    ],
)
def test_decode_yyyymmdd(spark, number, day):
    assert values(spark, [(number,)], "c int", fn.decode_yyyymmdd("c")) == [day]


def test_decode_yyyymmdd_is_try_to_date(spark):
    """Exhaustive where dates are, plus the edges."""
    numbers = spark.range(18990000, 21010000).selectExpr("CAST(id AS INT) AS c").unionAll(
        spark.range(-50000, 1100000).selectExpr("CAST(id AS INT) AS c")
    )
    text = F.try_to_date(F.col("c").cast("string"), "yyyyMMdd")
    wanted = F.when(F.col("c") == 0, F.lit(None)).otherwise(text)
    assert numbers.filter(~fn.decode_yyyymmdd("c").eqNullSafe(wanted)).isEmpty()


def test_decoded_type_is_date(spark):
    df = spark.createDataFrame([(0,)], "c int").select(fn.decode_yyyymmdd("c").alias("d"))
    assert df.dtypes == [("d", "date")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(date(1000, 1, 1)), min_size=20, max_size=50))
def test_decode_round_trip(spark, days):
    rows = [(int(d.strftime("%Y%m%d")) if d.year > 999 else 0,) for d in days]
    assert values(spark, rows, "c int", fn.decode_yyyymmdd("c")) == days


@pytest.mark.parametrize(
    "text, number",
    [
        ("1000,50", 1000.5),
        ("0,00", 0.0),
        ("1.234,56", None),
        ("", None),
        (None, None),
        ("-3,5", -3.5),
        ("12", 12.0),
        ("000000010000,00", 10000.0),
    ],
)
def test_parse_decimal_comma(spark, text, number):
    assert values(spark, [(text,)], "c string", fn.parse_decimal_comma("c")) == [number]


@pytest.mark.parametrize(
    "text",
    "12|012|-7|+5|2147483647|2147483648|-2147483648|99999999999|000000000000012|0|00|S/N|1,2"
    "|1.5| 12|12 ||x".split("|"),
)
def test_parse_int_is_the_csv_reader(spark, tmp_path, text):
    """The same NULLs as a typed CSV column."""
    (tmp_path / "a.txt").write_text(f"{text};x\n")
    typed = spark.read.schema("c int, x string").option("sep", ";").csv(str(tmp_path))
    (expected,) = [r.c for r in typed.collect()]
    assert values(spark, [(text,)], "c string", fn.parse_int("c")) == [expected]


@pytest.mark.parametrize(
    "mapping, expected",
    [
        (codes.TIPO_SOCIO, {1: "PESSOA JURÍDICA", 2: "PESSOA FÍSICA", 3: "ESTRANGEIRO"}),
        (
            codes.PORTE_EMPRESA,
            {
                1: "NÃO INFORMADO",
                2: "MICRO EMPRESA",
                3: "EMPRESA DE PEQUENO PORTE",
                4: None,
                5: "DEMAIS",
            },
        ),
        (codes.MATRIZ_FILIAL, {1: "MATRIZ", 2: "FILIAL"}),
        (codes.MATRIZ_FILIAL_AS_WRITTEN, {1: "MATRIZ", 2: None}),
        (
            codes.SITUACAO_CADASTRAL,
            {1: "NULA", 2: "ATIVA", 3: "SUSPENSA", 4: "INAPTA", 5: None, 8: "BAIXADA"},
        ),
    ],
)
def test_decode_code(spark, mapping, expected):
    expected = {**expected, 9: None, None: None}
    got = values(spark, [(c,) for c in expected], "c int", fn.decode_code("c", mapping))
    assert got == list(expected.values())


def test_year_month(spark):
    df = spark.createDataFrame([(date(2010, 2, 3),), (None,)], "d date")
    df = df.select(fn.year_of("d").alias("y"), fn.month_of("d").alias("m"))
    assert df.dtypes == [("y", "bigint"), ("m", "bigint")]
    assert [tuple(r) for r in df.collect()] == [(2010, 2), (None, None)]


@pytest.mark.parametrize("as_of", ["2021-09-20", date(2021, 1, 1), date(2021, 12, 31)])
def test_year_start(spark, as_of):
    assert spark.range(1).select(fn.year_start(as_of)).first()[0] == date(2021, 1, 1)


def kept(spark, rows, ddl, condition):
    return [r[0] for r in spark.createDataFrame(rows, ddl).filter(condition).collect()]


def test_date_predicates(spark):
    days = [
        (d,)
        for d in (
            date(2009, 12, 31),
            date(2010, 1, 1),
            date(2021, 12, 31),
            date(2022, 1, 1),
            None,
        )
    ]
    one = [d for (d,) in days]
    assert kept(spark, days, "d date", fn.since("d", "2010-01-01")) == one[1:4]
    assert kept(spark, days, "d date", fn.in_years("d", 2010, 2021)) == one[1:3]
    assert kept(spark, days, "d date", fn.year_to_date("d", "2022-06-01")) == one[3:4]


def test_in_years_is_year_between(spark):
    start = date(2009, 1, 1)
    days = [(start + timedelta(days=i),) for i in range(0, 5500)]
    df = spark.createDataFrame(days, "d date")
    wanted = F.year("d").between(2010, 2021)
    assert df.filter(fn.in_years("d", 2010, 2021) != wanted).isEmpty()


def test_value_predicates(spark):
    assert kept(spark, [("SP",), ("EX",), (None,)], "c string", fn.exclude_value("c", "EX")) == [
        "SP"
    ]
    numbers = [(499999,), (500000,), (3399999,), (3400000,), (None,)]
    assert kept(spark, numbers, "c int", fn.code_range("c", *codes.INDUSTRY)) == [500000, 3399999]
    assert kept(spark, [(3,), (2,), (None,)], "c int", fn.has_code("c", 3)) == [3]


def test_any_flag(spark):
    flags = [("S", "N"), ("N", "S"), ("S", None), (None, "S"), ("N", "N"), (None, "N"), ("s", "")]
    rows = [(i, *f) for i, f in enumerate(flags)]
    assert kept(spark, rows, "i int, a string, b string", fn.any_flag(["a", "b"])) == [0, 1, 2, 3]
