"""A hand-made landing zone, through curation, to the six questions."""

import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from bizregistry import plans
from bizregistry.functions.codes import MATRIZ_FILIAL_AS_WRITTEN
from bizregistry.operators import overwrite_table
from bizregistry.plans import Register, curate, read_family
from bizregistry.plans.tables import build_estabelecimento
from bizregistry.sources.schemas import FAMILIES

AS_OF = "2021-09-20"
INDUSTRY, COMMERCE, SCHOOL, OTHER = 1011201, 4711301, 8531700, 9602501


def branch(company, order, opened, code, city, uf="SP", status="02", country="", **other):
    """One establishment record of 30 fields."""
    fields = dict.fromkeys(FAMILIES["estabelecimento"].schema.names, "")
    fields.update(
        cnpj_basico=company,
        cnpj_origem=f"{order:04d}",
        cod_matriz_filial="1" if order == 1 else "2",
        cod_situacao_cadastral=status,
        dt_situacao_cadastral="20210105",
        cod_pais=country,
        dt_inicio_atividade=opened,
        cod_cnae_principal=str(code),
        uf=uf,
        cod_municipio=city,
    )
    fields.update(other)
    return ";".join('"' + v.replace('"', '""') + '"' for v in fields.values())


LANDING = {
    "K1.CNAECSV": ["1011201;Abate", "4711301;Mercado", "8531700;Faculdade", "9602501;Salão"],
    "K1.MUNICCSV": ["7107;SAO PAULO", "6001;RIO DE JANEIRO"],
    "K1.PAISCSV": ["105;BRASIL", "249;ESTADOS UNIDOS"],
    "K1.NATJUCSV": ["2062;Limitada", "2135;Individual"],
    "K1.QUALSCSV": ["49;Sócio-Administrador"],
    "W.SIMPLES.CSV.D1": [
        "00000001;S;20100101;00000000;N;00000000;00000000",
        "00000002;N;20100101;20120101;S;20120101;0",
        "00000003;N;;;N;;",
        "00000004;S;20190230;00000000;S;20200101;00000000",
    ],
    "K1.EMPRECSV": [
        '00000001;UM;2062;49;"1000,50";03;',
        "00000002;DOIS;2135;50;3000,00;03;",
        "00000003;TRES;2062;49;1.234,56;05;UNIÃO",
        "00000004;QUATRO;2062;49;2000,50;01;",
    ],
    "K1.SOCIOCSV": [
        "00000001;2;ANA;***1**;49;20100101;;***123456**;;00;5",
        "00000001;1;LTDA;11;22;20091231;;;;00;0",
        "00000002;3;ZOE;22;22;20210102;249;;;00;0",
        "00000002;9;EVA;22;22;20110203;105;123;;00;0;EXTRA",
        "00000003;2;IVO;33;49;00000000;;;;00;4",
    ],
    "K1.ESTABELE": [
        branch("00000001", 1, "20100315", INDUSTRY, "7107", nom_fantasia='SALA "B"'),
        branch("00000001", 2, "20100320", INDUSTRY, "7107", status="08", numero="S/N"),
        branch("00000002", 1, "20100301", INDUSTRY, "9999", complemento="BARRA \\"),
        branch("00000003", 1, "20100301", INDUSTRY, "7107"),  # in no special regime
        branch("00000005", 1, "20100301", INDUSTRY, "7107"),  # in no table but this
        branch("00000001", 3, "20100301", INDUSTRY, "", uf="EX", country="249"),
        branch("00000001", 4, "20091231", INDUSTRY, "7107"),  # too early
        branch("00000001", 5, "20220101", INDUSTRY, "7107"),  # too late for years, not for as_of
        branch("00000004", 1, "20211231", COMMERCE, "6001", uf="RJ"),
        branch("00000004", 2, "20211201", COMMERCE, "6001", uf="RJ", status="08"),
    ],
    "K2.ESTABELE": [
        branch("00000002", 2, "20210101", 500000, "7107"),  # first industry code
        branch("00000002", 3, "20210101", 3400000, "7107"),  # first code beyond
        branch("00000001", 6, "20150601", SCHOOL, "7107"),
        branch("00000001", 7, "20150701", SCHOOL, "6001", uf="RJ"),
        branch("00000001", 8, "20150801", SCHOOL, "7107", country="105"),
        branch("00000003", 2, "20140101", SCHOOL, "7107"),
        branch("00000003", 3, "20210601", SCHOOL, "7107"),  # capital is NULL
        branch("00000001", 9, "00000000", SCHOOL, "7107"),
        branch("00000002", 4, "20190230", SCHOOL, "7107"),
        branch("00000006", 1, "20210601", OTHER, "7107"),  # company not in empresa
    ],
}


def write_landing(folder):
    for name, lines in LANDING.items():
        text = "".join(f"{line}\n" for line in ["HEADER", *lines])
        (folder / name).write_bytes(text.encode("iso-8859-1"))
    return str(folder)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return write_landing(tmp_path_factory.mktemp("landing"))


@pytest.fixture(scope="module")
def tables_root(spark, landing, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    curate(spark, landing, root)
    return root


@pytest.fixture(scope="module")
def register(spark, tables_root):
    return Register.load(spark, tables_root)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Tables


def table(spark, root, name):
    return spark.read.parquet(f"{root}/{name}")


def test_table_widths(spark, tables_root):
    widths = {name: len(table(spark, tables_root, name).columns) for name in FAMILIES}
    assert widths == {
        "simples": 7,
        "cnae": 2,
        "municipio": 2,
        "natureza_juridica": 2,
        "pais": 2,
        "qualificacao_socio": 2,
        "socio": 13,
        "empresa": 8,
        "estabelecimento": 33,
    }


def test_code_tables(spark, tables_root):
    assert rows(table(spark, tables_root, "cnae")) == [
        (1011201, "Abate"),
        (4711301, "Mercado"),
        (8531700, "Faculdade"),
        (9602501, "Salão"),
    ]
    assert rows(table(spark, tables_root, "qualificacao_socio")) == [(49, "Sócio-Administrador")]
    for name in ("municipio", "pais", "natureza_juridica"):
        assert table(spark, tables_root, name).count() == 2


def test_simples(spark, tables_root):
    assert rows(table(spark, tables_root, "simples")) == [
        ("00000001", "S", date(2010, 1, 1), None, "N", None, None),
        ("00000002", "N", date(2010, 1, 1), date(2012, 1, 1), "S", date(2012, 1, 1), None),
        ("00000003", "N", None, None, "N", None, None),
        ("00000004", "S", None, None, "S", date(2020, 1, 1), None),
    ]


def test_socio(spark, tables_root):
    socio = table(spark, tables_root, "socio").select(
        "nom_socio", "tipo_socio", "dt_entrada_sociedade", "cpf_representante", "razao_social"
    )
    assert rows(socio) == [
        ("ANA", "PESSOA FÍSICA", date(2010, 1, 1), None, None),
        ("EVA", None, date(2011, 2, 3), 123, "EXTRA"),
        ("ZOE", "ESTRANGEIRO", date(2021, 1, 2), None, None),
    ]


def test_empresa(spark, tables_root):
    empresa = table(spark, tables_root, "empresa").select(
        "cnpj_basico", "capital_social", "cod_porte", "porte_empresa", "ente_federativo"
    )
    assert rows(empresa) == [
        ("00000001", 1000.5, 3, "EMPRESA DE PEQUENO PORTE", None),
        ("00000002", 3000.0, 3, "EMPRESA DE PEQUENO PORTE", None),
        ("00000003", None, 5, "DEMAIS", None),
        ("00000004", 2000.5, 1, "NÃO INFORMADO", None),
    ]


def test_estabelecimento(spark, tables_root):
    df = table(spark, tables_root, "estabelecimento")
    assert df.count() == sum(len(v) for k, v in LANDING.items() if k.endswith("ESTABELE"))
    first = df.filter("cnpj_basico = '00000001' AND cnpj_origem = '0001'").first()
    assert first.nom_fantasia == 'SALA "B"'
    assert (first.matriz_filial, first.situacao_cadastral) == ("MATRIZ", "ATIVA")
    assert first.dt_inicio_atividade == date(2010, 3, 15)
    assert first.dt_sit_especial is None
    assert first.filename.endswith("/K1.ESTABELE")
    second = df.filter("cnpj_basico = '00000001' AND cnpj_origem = '0002'").first()
    assert (second.matriz_filial, second.situacao_cadastral) == ("FILIAL", "BAIXADA")
    assert second.numero is None
    assert df.filter(F.col("complemento") == "BARRA \\").first().cod_municipio == 9999


def test_headquarters_label_as_written(spark, landing):
    read = read_family(spark, landing, "estabelecimento")
    built = build_estabelecimento(read, MATRIZ_FILIAL_AS_WRITTEN)
    assert rows(built.select("matriz_filial").distinct()) == [("MATRIZ",), (None,)]


def test_header_loss_is_an_argument(spark, landing):
    assert read_family(spark, landing, "pais").count() == 2
    assert read_family(spark, landing, "pais", header=False).count() == 3


def test_wide_columns(spark, landing):
    wide = read_family(spark, landing, "estabelecimento", wide=True)
    assert wide.filter("numero = 'S/N'").count() == 1
    assert read_family(spark, landing, "socio", wide=True).filter(
        "cpf_representante = '***123456**'"
    ).count() == 1


def test_curation_from_archives(spark, tables_root, tmp_path):
    """Straight out of ZIP archives, the tables are the same but for the file name."""
    source = tmp_path / "archives"
    source.mkdir()
    for number, (name, lines) in enumerate(LANDING.items()):
        text = "".join(f"{line}\r\n" for line in ["HEADER", *lines])
        with zipfile.ZipFile(source / f"{number}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(name, text.encode("iso-8859-1"))
    curate(spark, str(source), lambda t: str(tmp_path / "out" / t), archived=True)
    for name in FAMILIES:
        got = table(spark, tmp_path / "out", name).drop("filename")
        want = table(spark, tables_root, name).drop("filename")
        assert got.schema == want.schema
        assert rows(got) == rows(want)
    names = table(spark, tmp_path / "out", "estabelecimento").select("filename").distinct()
    assert {n.rsplit("/", 1)[1] for (n,) in names.collect()} == {"K1.ESTABELE", "K2.ESTABELE"}


def test_curation_to_named_tables(spark, landing):
    curate(spark, landing, lambda t: f"curated_{t}", tables=["pais", "cnae"])
    try:
        assert spark.table("curated_pais").count() == 2
        curate(spark, landing, lambda t: f"curated_{t}", tables=["pais"], header=False)
        assert spark.table("curated_pais").count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS curated_pais")
        spark.sql("DROP TABLE IF EXISTS curated_cnae")


def test_errors_are_raised(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        curate(spark, str(tmp_path), str(tmp_path / "out"), tables=["pais"])


def test_overwrite_replaces_all(spark, tmp_path):
    target = str(tmp_path / "t")
    overwrite_table(spark.range(100).withColumn("k", F.col("id") % 3), target, partition_by=["k"])
    overwrite_table(spark.range(5), target, sort_by=["id"])
    assert rows(spark.read.parquet(target)) == [(i,) for i in range(5)]


# Questions


def test_industry_openings(register):
    assert rows(plans.industry_openings(register)) == [
        (2010, 3, 1, None, "S", "N"),
        (2010, 3, 2, "SAO PAULO", "N", "S"),
        (2021, 1, 1, "SAO PAULO", "S", "N"),
    ]


def test_active_industries_only(register):
    assert (2010, 3, 1, "SAO PAULO", "N", "S") in rows(
        plans.industry_openings(register, status=2)
    )


def test_industry_types_and_names(register):
    assert plans.industry_openings(register).dtypes == [
        ("ano", "bigint"),
        ("mes", "bigint"),
        ("qtd_empresas", "bigint"),
        ("nom_municipio", "string"),
        ("idc_op_mei", "string"),
        ("idc_op_simples", "string"),
    ]


def test_commerce_openings(register):
    # Two establishments of one company count once.
    assert rows(plans.commerce_openings(register)) == [
        (2021, 12, 1, "RIO DE JANEIRO", "S", "S")
    ]
    assert rows(plans.commerce_openings(register, distinct=False)) == [
        (2021, 12, 2, "RIO DE JANEIRO", "S", "S")
    ]


def test_commerce_closures_by_closing_date(register):
    closed = plans.commerce_openings(register, status=8, date_col="dt_situacao_cadastral")
    assert rows(closed) == [(2021, 1, 1, "RIO DE JANEIRO", "S", "S")]


def test_new_registrations(register):
    counts = rows(plans.new_registrations(register))
    assert counts == [
        (2010, 3, 1, None, "S", "N"),
        (2010, 3, 2, "SAO PAULO", "N", "S"),
        (2015, 6, 1, "SAO PAULO", "N", "S"),
        (2015, 7, 1, "RIO DE JANEIRO", "N", "S"),
        (2015, 8, 1, "SAO PAULO", "N", "S"),
        (2021, 1, 2, "SAO PAULO", "S", "N"),
        (2021, 12, 2, "RIO DE JANEIRO", "S", "S"),
    ]


def test_years_are_an_argument(register):
    assert rows(plans.new_registrations(register, years=(2009, 2009))) == [
        (2009, 12, 1, "SAO PAULO", "N", "S")
    ]


def test_higher_education_openings(register):
    assert rows(plans.higher_education_openings(register)) == [
        (2014, "SP", 1),
        (2015, "RJ", 1),
        (2015, "SP", 1),
        (2021, "SP", 1),
    ]
    assert rows(plans.higher_education_openings(register, years=(2015, 2021))) == [
        (2015, "RJ", 1),
        (2015, "SP", 1),
        (2021, "SP", 1),
    ]
    establishments = plans.higher_education_openings(register, distinct=False)
    assert (2015, "SP", 2) in rows(establishments)


def test_top_mean_capital(register):
    # NULL name: codes 500000 and 3400000, both of company 2, 3000.0 each.
    means = plans.questions.mean_capital_by_activity(register, as_of=AS_OF)
    assert rows(means) == [
        ("Abate", 1000.5),
        ("Faculdade", None),
        ("Mercado", 2000.5),
        ("Salão", None),
        (None, 3000.0),
    ]
    assert rows(plans.top_mean_capital(register, as_of=AS_OF)) == [(None, 3000.0)]
    two = plans.top_mean_capital(register, as_of=AS_OF, n=2).collect()
    assert [tuple(r) for r in two] == [(None, 3000.0), ("Mercado", 2000.5)]


def test_top_ties_go_to_the_first_name(register, spark):
    same = register.empresa.withColumn("capital_social", F.lit(7.0))
    tied = Register(**{**vars(register), "empresa": same})
    assert rows(plans.top_mean_capital(tied, as_of=AS_OF)) == [("Abate", 7.0)]


def test_mean_capital_by_nature(register):
    expected = [(2062, 1000.5), (2135, 3000.0)]
    assert rows(plans.mean_capital_by_nature(register, as_of=AS_OF)) == expected
    assert rows(plans.mean_capital_by_nature(register, as_of=AS_OF, drop_unused=True)) == expected
    labelled = plans.mean_capital_by_nature(register, as_of=AS_OF, label=True)
    assert rows(labelled) == [(2062, "Limitada", 1000.5), (2135, "Individual", 3000.0)]


def test_year_to_date_includes_first_of_january(register):
    assert rows(plans.mean_capital_by_nature(register, as_of="2022-01-01")) == [(2062, 1000.5)]


def doubled(register, name, condition):
    copy = getattr(register, name)
    copy = copy.unionAll(copy.filter(condition))
    return Register(**{**vars(register), name: copy})


def test_unused_join_counts_duplicate_keys(register):
    """As written, a country listed twice counts its establishments twice."""
    twice = doubled(register, "pais", "cod_pais = 105")
    school = dict(codes=(8530000, 8540000))
    written = rows(plans.new_registrations(twice, **school))
    assert (2015, 8, 2, "SAO PAULO", "N", "S") in written
    dropped = rows(plans.new_registrations(twice, drop_unused=True, **school))
    assert (2015, 8, 1, "SAO PAULO", "N", "S") in dropped
    assert rows(plans.higher_education_openings(twice)) == rows(
        plans.higher_education_openings(twice, drop_unused=True)
    )
    nature = doubled(register, "natureza_juridica", "cod_nat_juridica = 2062")
    assert rows(plans.mean_capital_by_nature(nature, as_of=AS_OF)) == rows(
        plans.mean_capital_by_nature(register, as_of=AS_OF)
    )


def test_duplicate_labels_and_companies(register):
    """Two codes with one name share a group; a company listed twice counts twice."""
    renamed = register.municipio.withColumn("nom_municipio", F.lit("CIDADE"))
    one_name = Register(**{**vars(register), "municipio": renamed})
    assert {r[3] for r in rows(plans.new_registrations(one_name))} == {"CIDADE", None}
    twice = doubled(register, "simples", "cnpj_basico = '00000004'")
    assert rows(plans.commerce_openings(twice, distinct=False))[0][2] == 4
    assert rows(plans.commerce_openings(twice)) == rows(plans.commerce_openings(register))


def test_counts_add_up(register):
    """Municipalities add up to the whole, and companies are no more than establishments."""
    total = (
        register.estabelecimento.filter("uf <> 'EX'")
        .filter(F.year("dt_inicio_atividade").between(2010, 2021))
        .join(register.simples, "cnpj_basico")
        .filter("idc_op_mei = 'S' OR idc_op_simples = 'S'")
        .count()
    )
    plain = plans.new_registrations(register)
    assert plain.agg(F.sum("qtd_empresas")).first()[0] == total
    companies = plans.new_registrations(register, distinct=True)
    keys = ["ano", "mes", "nom_municipio", "idc_op_mei", "idc_op_simples"]
    counts = {tuple(r[k] for k in keys): r.qtd_empresas for r in plain.collect()}
    for r in companies.collect():
        assert r.qtd_empresas <= counts[tuple(r[k] for k in keys)]


def test_partitioned_sink_is_in_order(spark, tmp_path):
    """Partitioning keeps the order of ``sort_by`` in each file."""
    import pyarrow.parquet as pq

    df = spark.range(2000).selectExpr("id % 3 AS part", "(id * 7919) % 2003 AS value")
    overwrite_table(df.repartition(2), f"{tmp_path}/t", partition_by=["part"], sort_by=["value"])
    files = [*(tmp_path / "t").rglob("*.parquet")]
    assert len(files) == 6
    for file in files:
        values = pq.ParquetFile(file).read().column("value").to_pylist()
        assert values == sorted(values)


def test_load_only_named_tables(spark, tmp_path):
    """By folder and by database; tables that are not named need not exist."""
    spark.range(3).write.parquet(f"{tmp_path}/pais")
    assert Register.load(spark, str(tmp_path), ["pais"]).pais.count() == 3
    spark.range(4).createOrReplaceTempView("only_here")
    spark.sql("CREATE DATABASE IF NOT EXISTS register_test")
    spark.sql("CREATE TABLE IF NOT EXISTS register_test.pais USING parquet AS SELECT * FROM only_here")
    loaded = Register.load(spark, "register_test", ["pais"])
    assert loaded.pais.count() == 4 and loaded.empresa is None
    spark.sql("DROP DATABASE register_test CASCADE")
