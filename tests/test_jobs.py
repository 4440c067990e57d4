import pytest

from bizregistry.__main__ import QUESTIONS, run

from test_register import AS_OF, write_landing


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    run(spark, ["curate", write_landing(tmp_path_factory.mktemp("landing")), root])
    return root


@pytest.mark.parametrize("question", QUESTIONS)
def test_every_question_can_be_asked(spark, tables, tmp_path, question):
    target = str(tmp_path / "answer")
    dated = ["--as-of", AS_OF] if "mean-capital" in question else []
    run(spark, ["ask", question, tables, target, *dated])
    assert spark.read.parquet(target).count() > 0


def test_date_is_required(spark, tables, tmp_path):
    with pytest.raises(SystemExit, match="--as-of"):
        run(spark, ["ask", "top-mean-capital", tables, str(tmp_path / "answer")])


def test_links(spark, tmp_path):
    pages = str(tmp_path / "pages")
    spark.createDataFrame(
        [(1, '<a href="x.zip">x</a><a href="y.html">y</a>')], "page_id int, html string"
    ).write.parquet(pages)
    run(spark, ["links", pages, str(tmp_path / "links")])
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "links")).collect()] == [
        (1, "x.zip")
    ]


def test_curate_options(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    options = ["--no-header", "--wide", "--tables", "pais", "empresa"]
    run(spark, ["curate", write_landing(landing), str(tmp_path / "out"), *options])
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"pais", "empresa"}
    assert spark.read.parquet(str(tmp_path / "out" / "pais")).count() == 3
    empresa = spark.read.parquet(str(tmp_path / "out" / "empresa"))
    assert dict(empresa.dtypes)["ente_federativo"] == "string"
