"""Sinks that keep the old table, placement by year, accounts of losses, headers found out."""

import zipfile
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bizregistry.__main__ import run
from bizregistry.operators import overwrite_partitions, overwrite_table, recover_table
from bizregistry.plans import (
    Register,
    curate,
    higher_education_openings,
    industry_openings,
    mean_capital_by_nature,
    place_by_year,
    top_mean_capital,
)
from bizregistry.sources import detect_header, first_records, read_delimited
from bizregistry.sources.schemas import FAMILIES, schema_of

from test_register import AS_OF, LANDING, write_landing


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# Overwrite


def failing(spark, n=1000):
    """Rows of which the last raise an error, after others have been written."""
    return spark.range(0, n, 1, 4).select(
        F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("half-way"))).alias("id")
    )


@pytest.mark.parametrize("partition_by", [(), ("k",)])
def test_a_failed_write_leaves_the_old_folder(spark, tmp_path, partition_by):
    target = str(tmp_path / "t")
    overwrite_table(spark.range(5).withColumn("k", F.lit(1)), target)
    with pytest.raises(Exception, match="half-way"):
        overwrite_table(failing(spark).withColumn("k", F.lit(2)), target, partition_by=partition_by)
    assert rows(spark.read.parquet(target)) == [(i, 1) for i in range(5)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    overwrite_table(spark.range(3), target)
    assert rows(spark.read.parquet(target)) == [(0,), (1,), (2,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_failed_write_leaves_the_old_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    try:
        for name in ("kept.t", "kept_table"):
            overwrite_table(spark.range(5), name)
            with pytest.raises(Exception, match="half-way"):
                overwrite_table(failing(spark), name)
            assert rows(spark.table(name)) == [(i,) for i in range(5)]
            # Another schema, and rows of the table itself.
            overwrite_table(spark.table(name).withColumn("twice", F.col("id") * 2), name)
            assert rows(spark.table(name)) == [(i, 2 * i) for i in range(5)]
        assert [t.name for t in spark.catalog.listTables("kept")] == ["t"]
        left = [t.name for t in spark.catalog.listTables() if "kept_table" in t.name]
        assert left == ["kept_table"]
    finally:
        spark.sql("DROP DATABASE kept CASCADE")
        spark.sql("DROP TABLE IF EXISTS kept_table")


def test_a_table_may_replace_its_own_source(spark, tmp_path):
    target = str(tmp_path / "t")
    overwrite_table(spark.range(10), target)
    overwrite_table(spark.read.parquet(target).filter("id > 6"), target)
    assert rows(spark.read.parquet(target)) == [(7,), (8,), (9,)]


def test_what_a_lost_driver_leaves_is_put_back(spark, tmp_path):
    """The old table was moved away and the new one not yet into its place."""
    target = str(tmp_path / "t")
    overwrite_table(spark.range(4), target)
    assert not recover_table(spark, target)
    (tmp_path / "t").rename(tmp_path / "_replaced-t-abc")
    assert recover_table(spark, target)
    assert spark.read.parquet(target).count() == 4
    (tmp_path / "t").rename(tmp_path / "_replaced-t-abc")
    with pytest.raises(Exception, match="half-way"):
        overwrite_table(failing(spark), target)
    assert spark.read.parquet(target).count() == 4
    assert not recover_table(spark, str(tmp_path / "none" / "t"))
    overwrite_table(spark.range(4), "left_table")
    try:
        spark.sql("ALTER TABLE left_table RENAME TO replaced_left_table_abc")
        assert recover_table(spark, "left_table")
        assert spark.table("left_table").count() == 4
    finally:
        spark.sql("DROP TABLE IF EXISTS left_table")


# Placement by year


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return write_landing(tmp_path_factory.mktemp("landing"))


@pytest.fixture(scope="module")
def roots(spark, landing, tmp_path_factory):
    plain, placed = (str(tmp_path_factory.mktemp(name)) for name in ("plain", "placed"))
    curate(spark, landing, plain)
    curate(spark, landing, placed, by_year=True)
    return plain, placed


def test_questions_open_the_years_that_they_ask_for(spark, roots):
    plain, placed = (Register.load(spark, root) for root in roots)
    table = placed.estabelecimento
    assert table.drop("ano_inicio").schema == plain.estabelecimento.schema
    assert rows(table.drop("ano_inicio")) == rows(plain.estabelecimento)
    asked = {
        "q1": (lambda r: industry_openings(r, years=(2010, 2010)), "ano_inicio"),
        "q4": (lambda r: higher_education_openings(r, years=(2015, 2021)), "ano_inicio"),
        "q5": (lambda r: top_mean_capital(r, as_of=AS_OF), "ano_inicio"),
        "q6": (lambda r: mean_capital_by_nature(r, as_of=AS_OF), "ano_inicio"),
    }
    for question, column in asked.values():
        answer = question(placed)
        assert rows(answer) == rows(question(plain)) and rows(answer)
        plan = answer._jdf.queryExecution().executedPlan().toString()
        filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
        assert any(column in part for part in filters)
    # A closing date says nothing about the partition.
    closed = industry_openings(placed, date_col="dt_situacao_cadastral")
    assert rows(closed) == rows(industry_openings(plain, date_col="dt_situacao_cadastral"))


def test_files_read_fall_with_the_years(spark, roots):
    table = Register.load(spark, roots[1]).estabelecimento
    answer = table.filter("dt_inicio_atividade >= DATE '2021-01-01' AND ano_inicio >= 2021")
    answer.collect()
    metrics = {}
    plans = [answer._jdf.queryExecution().executedPlan()]
    while plans:
        node = plans.pop()
        found = node.metrics().get("numFiles")
        if found.isDefined():
            metrics["files"] = found.get().value()
        plans += [node.children().apply(i) for i in range(node.children().size())]
    assert 0 < metrics["files"] < len(table.inputFiles()) / 2


def test_a_year_is_replaced_and_the_others_stay(spark, landing, tmp_path):
    target = str(tmp_path / "out")
    curate(spark, landing, target, tables=["estabelecimento"], by_year=True)
    folder = Path(target) / "estabelecimento"
    before = {p.relative_to(folder): p.stat().st_mtime_ns for p in folder.glob("ano_inicio=*/*.parquet")}
    changed = tmp_path / "changed"
    changed.mkdir()
    lines = [line for line in LANDING["K2.ESTABELE"] if "20210601" in line]
    (changed / "K9.ESTABELE").write_bytes("\n".join(["HEADER", *lines]).encode("latin-1"))
    for years in ((2021, 2021), (2021, 2022)):
        curate(spark, str(changed), target, tables=["estabelecimento"], by_year=True, years=years)
        after = {p.relative_to(folder): p.stat().st_mtime_ns for p in folder.glob("ano_inicio=*/*.parquet")}
        same = {p for p in before if "2021" not in str(p)}
        assert same <= set(after) and all(after[p] == before[p] for p in same)
        table = spark.read.parquet(str(folder))
        assert table.filter("ano_inicio = 2021").count() == len(lines) == 2
        # A year without new rows keeps its old ones.
        assert table.filter("ano_inicio = 2022").count() == 1
    with pytest.raises(ValueError, match="by_year"):
        curate(spark, landing, target, years=(2021, 2021))


def test_a_failed_replacement_of_partitions_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    overwrite_table(spark.range(10).withColumn("k", F.col("id") % 2), target, partition_by=["k"])
    with pytest.raises(Exception, match="half-way"):
        overwrite_partitions(failing(spark).withColumn("k", F.lit(1)), target, partition_by=["k"])
    assert spark.read.parquet(target).count() == 10
    overwrite_partitions(spark.range(1).withColumn("k", F.lit(1)), target, partition_by=["k"])
    assert rows(spark.read.parquet(target)) == [(0, 0), (0, 1), (2, 0), (4, 0), (6, 0), (8, 0)]


def test_a_hot_date_is_divided_by_company(spark):
    hot = spark.range(4000).select(
        F.format_string("%08d", "id").alias("cnpj_basico"),
        F.when(F.col("id") % 8 > 0, F.lit(date(2020, 1, 1))).alias("dt_inicio_atividade"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = place_by_year(hot).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 1500


# Accounts


def test_account_of_what_parsing_loses(spark, landing, tmp_path):
    target = str(tmp_path / "out")
    lost = curate(spark, landing, target, account=True)
    found = {(r.table, r.measure, r.column): r.n for r in lost.collect()}
    counts = {k: n for k, n in found.items() if k[1] == "rows"}
    assert counts == {
        (name, "rows", None): sum(len(v) for k, v in LANDING.items() if k.endswith(suffix))
        for name, suffix in {
            "simples": "CSV.D1", "cnae": "CNAECSV", "municipio": "MUNICCSV",
            "natureza_juridica": "NATJUCSV", "pais": "PAISCSV", "qualificacao_socio": "QUALSCSV",
            "socio": "SOCIOCSV", "empresa": "EMPRECSV", "estabelecimento": "ESTABELE",
        }.items()
    }
    losses = {(k[0], k[2]): n for k, n in found.items() if k[1] == "lost"}
    assert losses == {
        ("simples", "dt_op_simples"): 1,  # 30 February
        ("socio", "cpf_representante"): 1,
        ("empresa", "capital_social"): 1,
        ("empresa", "ente_federativo"): 1,
        ("estabelecimento", "numero"): 1,
        ("estabelecimento", "dt_inicio_atividade"): 1,
    }
    odd = {k[0]: n for k, n in found.items() if k[1] == "odd_records"}
    # Eleven fields instead of twelve, but for one of twelve.
    assert odd["socio"] == 4 and sum(odd.values()) == 4
    assert rows(spark.read.parquet(f"{target}/_account")) == rows(lost)
    # A range partitioning samples its input; rows are counted once all the same.
    placed = curate(spark, landing, str(tmp_path / "placed"), account=True, by_year=True)
    assert rows(placed) == rows(lost)
    # The tables are the same with and without.
    plain = str(tmp_path / "plain")
    assert curate(spark, landing, plain, tables=["socio", "estabelecimento"]) is None
    for name in ("socio", "estabelecimento"):
        assert rows(spark.read.parquet(f"{target}/{name}")) == rows(spark.read.parquet(f"{plain}/{name}"))
        schemas = [spark.read.parquet(f"{root}/{name}").schema for root in (target, plain)]
        assert schemas[0] == schemas[1]


def test_account_of_bad_values_short_and_long_records(spark, tmp_path):
    lines = [
        "HEADER", "00000001;S;20100101;0;N;0;0", "00000002;S;2010-01-01;20190230;N;x;0",
        "00000003;S", "00000004;S;20100101;0;N;0;0;more;and more", "00000005;;;;;;",
        '"0000;0006";S;20101301;0;"N";99;0',
    ]
    (tmp_path / "W.SIMPLES.CSV.D1").write_text("\n".join(lines))
    # Wide tables keep text, so it is not lost.
    for wide in (False, True):
        lost = curate(
            spark, str(tmp_path), str(tmp_path / "out"), tables=["simples"], account=True, wide=wide
        )
        assert {(r.measure, r.column): r.n for r in lost.collect()} == {
            ("rows", None): 6,
            ("odd_records", None): 2,
            ("lost", "dt_op_simples"): 2,
            ("lost", "dt_exclusao_simples"): 1,
            ("lost", "dt_op_mei"): 2,
        }


def test_account_of_archives_and_landed_files(spark, landing, tmp_path):
    source = tmp_path / "archives"
    source.mkdir()
    for path in Path(landing).iterdir():
        with zipfile.ZipFile(source / f"{path.name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(path.name, path.read_bytes())
    names = ["simples", "empresa", "estabelecimento"]
    plain = rows(curate(spark, landing, str(tmp_path / "a"), tables=names, account=True))
    options = {"tables": names, "account": True, "archived": True}
    assert rows(curate(spark, str(source), str(tmp_path / "b"), **options)) == plain
    landed = str(tmp_path / "landed")
    for _ in range(2):
        got = curate(spark, str(source), str(tmp_path / "c"), land_in=landed, **options)
        assert rows(got) == plain
    assert len(list(Path(landed).glob("*.ESTABELE"))) == 2
    want = spark.read.parquet(str(tmp_path / "a" / "estabelecimento")).drop("filename")
    for out in ("b", "c"):
        table = spark.read.parquet(str(tmp_path / out / "estabelecimento"))
        assert rows(table.drop("filename")) == rows(want)
    # Nothing new to land: the archives may be gone.
    for path in source.iterdir():
        path.write_bytes(b"")
    with pytest.raises(Exception, match="not a whole ZIP archive"):
        curate(spark, str(source), str(tmp_path / "c"), land_in=landed, **options)


# Headers


PAIR = schema_of("k string, v int")


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.TEXT").write_text(text)
    return f"{folder}/*.TEXT"


def test_headers_are_found_out(spark, tmp_path):
    with_header = write(tmp_path / "a", x="\n  \nk;v\na;1\n", y="K;V\n", z="", w="key;value\nb;2\n")
    without = write(tmp_path / "b", x='a;"1"\nb;\n', y="\nb;-2\n", z=" \n")
    assert detect_header(spark, with_header, PAIR) and not detect_header(spark, without, PAIR)
    for path, want in ((with_header, [("a", 1), ("b", 2)]), (without, [("a", 1), ("b", None), ("b", -2)])):
        got = read_delimited(spark, path, PAIR, header="detect").filter("k IS NOT NULL AND trim(k) <> ''")
        assert rows(got) == sorted(want, key=str)
    looked = {r.file.rsplit("/", 1)[1]: r.header for r in first_records(spark, with_header, PAIR).collect()}
    assert looked == {"x.TEXT": True, "y.TEXT": True, "w.TEXT": True}


def test_mixed_folders_are_refused_by_name(spark, tmp_path):
    mixed = write(tmp_path / "c", some="k;v\na;1\n", other="b;2\n")
    with pytest.raises(ValueError, match=r"1 files have a header, as .*some.TEXT, and 1 have none, as .*other.TEXT"):
        read_delimited(spark, mixed, PAIR, header="detect")
    unclear = write(tmp_path / "d", unclear="a;\n")
    with pytest.raises(ValueError, match=r"cannot tell .*unclear.TEXT"):
        detect_header(spark, unclear, PAIR)
    texts = write(tmp_path / "e", named="A;B\n")
    assert detect_header(spark, texts, schema_of("a string, b string"))
    with pytest.raises(ValueError, match="cannot tell"):
        detect_header(spark, texts, schema_of("a string, c string"))


def test_only_the_beginning_of_a_file_is_read(spark, tmp_path):
    path = write(tmp_path / "f", x="a;1\n" + "b;2\n" * 600_000)
    plan = first_records(spark, path, PAIR)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "Exchange" not in plan
    assert not detect_header(spark, path, PAIR)


# Command line


def test_jobs_with_options(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_landing(landing)
    target = str(tmp_path / "out")
    names = ["estabelecimento", "simples", "municipio", "pais"]
    options = ["--by-year", "--account", "--branches-as-written", "--tables", *names]
    run(spark, ["curate", str(landing), target, *options])
    table = spark.read.parquet(f"{target}/estabelecimento")
    assert table.filter("matriz_filial = 'FILIAL'").isEmpty() and "ano_inicio" in table.columns
    assert spark.read.parquet(f"{target}/_account").count() > 4
    # A question needs only its own tables, and takes its readings from the command line.
    run(spark, ["ask", "industry-openings", target, f"{target}/answer", "--status", "2", "--distinct"])
    want = industry_openings(Register.load(spark, target, names), status=2, distinct=True)
    assert rows(spark.read.parquet(f"{target}/answer")) == rows(want)
    run(spark, ["ask", "higher-education-openings", target, f"{target}/four", "--drop-unused", "--years", "2015", "2021"])
    assert rows(spark.read.parquet(f"{target}/four").select("ano").distinct()) == [(2015,), (2021,)]
    with pytest.raises(SystemExit, match="has no label, n"):
        run(spark, ["ask", "industry-openings", target, f"{target}/x", "--label", "-n", "3"])
    run(spark, ["curate", str(landing), target, "--partners-since", "2021-01-02", "--tables", "socio"])
    assert spark.read.parquet(f"{target}/socio").count() == 1


def test_job_over_archives(spark, tmp_path):
    source = tmp_path / "archives"
    source.mkdir()
    with zipfile.ZipFile(source / "a.zip", "w") as z:
        z.writestr("K1.PAISCSV", "HEADER\n1;A\n2;B\n")
    (source / "bad.zip").write_bytes(b"no archive")
    target, landed = str(tmp_path / "out"), str(tmp_path / "landed")
    options = ["--land-in", landed, "--skip-bad", "--tables", "pais"]
    run(spark, ["curate", str(source), target, *options])
    assert spark.read.parquet(f"{target}/pais").count() == 2
    assert [r.archive.rsplit("/", 1)[1] for r in spark.read.parquet(f"{target}/_skipped").collect()] == ["bad.zip"]
    assert FAMILIES["pais"].glob == "*.PAISCSV"
