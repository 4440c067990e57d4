"""The same queries as SQL, for any engine that reads the test tables."""

from __future__ import annotations

from .roles import (
    ACTIVE,
    AS_OF,
    CLOSED,
    COMMERCE_PCT,
    FOREIGN,
    HIGHER_EDUCATION_PCT,
    INDUSTRY_PCT,
    MEDIUM,
    STATUS_DAYS,
    YEARS,
)

# Companies in a special tax regime, with their flags.
_SPECIAL = """
special AS (
    SELECT o_orderkey AS company, CASE WHEN simple_mei THEN 'S' ELSE 'N' END AS idc_op_mei,
           CASE WHEN urgent THEN 'S' ELSE 'N' END AS idc_op_simples
    FROM (SELECT o_orderkey, coalesce(o_orderstatus = 'F', FALSE) AS simple_mei,
                 coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), FALSE) AS urgent
          FROM orders)
    WHERE simple_mei OR urgent
)"""


def _in_range(pct: tuple[int, int]) -> str:
    low, high = (f"(SELECT max(p_partkey) * {p} // 100 FROM part)" for p in pct)
    return f"l_partkey >= {low} AND l_partkey < {high}"


def _opened(pct: tuple[int, int] | None, day: str = "l_shipdate", also: str = "TRUE") -> str:
    """Domestic openings, once for each country that their code stands for."""
    in_range = _in_range(pct) if pct else "TRUE"
    return f"""
opened AS (
    SELECT year({day}) AS ano, month({day}) AS mes, l_orderkey AS company,
           l_suppkey AS place, l_returnflag AS uf
    FROM lineitem LEFT JOIN nation ON l_linenumber = n_nationkey
    WHERE year({day}) BETWEEN {YEARS[0]} AND {YEARS[1]}
      AND l_returnflag <> '{FOREIGN}' AND {in_range} AND {also}
)"""


def _by_municipality(
    pct: tuple[int, int] | None, counted: str, day: str = "l_shipdate", also: str = "TRUE"
) -> str:
    return f"""
WITH {_SPECIAL}, {_opened(pct, day, also)}
SELECT ano, mes, s_name AS nom_municipio, idc_op_mei, idc_op_simples,
       count({counted}) AS qtd_empresas
FROM opened JOIN special USING (company) LEFT JOIN supplier ON place = s_suppkey
GROUP BY ano, mes, s_name, idc_op_mei, idc_op_simples"""


_THIS_YEAR = f"""
this_year AS (
    SELECT l_orderkey AS company, l_partkey AS activity, l_returnflag AS uf
    FROM lineitem
    WHERE l_shipdate >= date_trunc('year', DATE '{AS_OF}')
)"""


def _mean_by_activity(value: str) -> str:
    return f"""
WITH {_THIS_YEAR}
SELECT p_name AS nom_cnae, {value} AS capital_social
FROM this_year LEFT JOIN part ON activity = p_partkey LEFT JOIN orders ON company = o_orderkey
WHERE uf <> '{FOREIGN}'
GROUP BY p_name"""


# The condition on the company drops openings that have none.
_MEAN_BY_NATURE = f"""
WITH {_THIS_YEAR}, means AS (
    SELECT o_orderstatus AS nature, round(avg(o_totalprice), 2) AS mean
    FROM this_year JOIN orders ON company = o_orderkey
    WHERE o_orderpriority = '{MEDIUM}'
    GROUP BY o_orderstatus
)"""


def _lines(condition: str) -> str:
    return (
        "SELECT a.l_orderkey, a.l_partkey, a.l_suppkey, a.l_linenumber "
        f"FROM lineitem a WHERE {condition}"
    )


_LINKS = """
SELECT page_id, link FROM (
    SELECT page_id, unnest(regexp_extract_all(html, '<a[^>]* href="([^"]*)"', 1)) AS link
    FROM pages)"""

_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_ORDER_ID = "lpad(CAST(o_orderkey AS VARCHAR), 8, '0')"
_LINE_ID = "lpad(CAST(l_orderkey AS VARCHAR), 8, '0')"

_ARCHIVED_HTML = """
SELECT page_id, replace(replace(coalesce(html, ''), chr(13), ' '), chr(10), ' ') AS html FROM pages"""

_BY_STATE = f"""
WITH {_opened(HIGHER_EDUCATION_PCT)}
SELECT ano, uf, count(DISTINCT company) AS qtd_empresas FROM opened GROUP BY ano, uf"""

ORACLE: dict[str, str] = {
    "q1_industry_openings": _by_municipality(INDUSTRY_PCT, "company"),
    "q2_commerce_openings": _by_municipality(COMMERCE_PCT, "DISTINCT company"),
    "q3_new_registrations": _by_municipality(None, "company"),
    "q1_active_industries": _by_municipality(
        INDUSTRY_PCT, "company", also=f"l_linestatus = '{ACTIVE}'"
    ),
    "q2_commerce_closures": _by_municipality(
        COMMERCE_PCT, "DISTINCT company", f"(l_shipdate + INTERVAL {STATUS_DAYS} DAY)", f"l_linestatus = '{CLOSED}'"
    ),
    "q3_new_companies": _by_municipality(None, "DISTINCT company"),
    "q4_openings_by_state": _BY_STATE,
    "q4_openings_of_placed_years": _BY_STATE,
    "q5_top_mean_capital": f"""
SELECT nom_cnae, round(capital_social, 2) AS capital_social
FROM ({_mean_by_activity("avg(o_totalprice)")}
ORDER BY capital_social DESC, nom_cnae LIMIT 1)""",
    "q6_mean_capital_by_nature": f"""{_MEAN_BY_NATURE}
SELECT nature AS cod_nat_juridica, mean AS media_capital_social FROM means""",
    "q6_mean_capital_by_named_nature": f"""{_MEAN_BY_NATURE}
SELECT nature AS cod_nat_juridica, 'NATURE ' || nature AS nom_nat_juridica,
       mean AS media_capital_social
FROM means""",
    "scan_typed_delimited": """
SELECT o_orderkey, 'AÇÃO ' || o_orderpriority AS note, o_totalprice FROM orders""",
    "scan_header_per_file": "SELECT s_suppkey, s_name FROM supplier",
    "scan_header_detect": """
SELECT s_suppkey, s_name, header FROM supplier, (VALUES (TRUE), (FALSE)) v(header)""",
    "scan_account": """
SELECT 'simples' AS "table", measure, "column", n FROM (
    SELECT 'rows' AS measure, '-' AS "column", count(*) AS n FROM orders
    UNION ALL SELECT 'odd_records', '-', 0
    UNION ALL SELECT 'lost', 'dt_exclusao_simples', count(*) FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'lost', 'dt_exclusao_mei', count(*) FROM orders
        WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'P'
) WHERE n > 0 OR measure <> 'lost'""",
    "scan_glob": "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "scan_escaped_quotes": r"""
SELECT n_nationkey, 'SALA "' || n_name || '"; 2' AS quoted, n_name || ' \' AS slash,
       'next' AS after
FROM nation""",
    "scan_malformed_to_null": """
SELECT CAST(CASE WHEN l_linenumber > 4 THEN -1 ELSE l_linenumber END AS INTEGER) AS numero,
       COUNT(*) AS n, CAST(SUM(l_orderkey) AS BIGINT) AS after
FROM lineitem GROUP BY 1""",
    "scan_provenance": "SELECT o_orderkey, o_orderstatus || '.TEXT' AS filename FROM orders",
    "extract_links": _LINKS,
    "extract_links_matching": f"{_LINKS} WHERE regexp_matches(link, 'th.')",
    "list_archives": """
WITH packed AS (
  SELECT CAST(page_id // 16 AS VARCHAR) || '.zip' AS name, page_id % 2 AS odd,
         length(CAST(page_id AS VARCHAR)) + length(url) + 3 AS size
  FROM pages
), counted AS (
  SELECT name, v.odd, v.member, 13 + CAST(coalesce(sum(size) FILTER (WHERE packed.odd = v.odd), 0) AS BIGINT) AS size
  FROM packed, (VALUES (0, 'a.PAGES'), (1, 'sub/b.PAGES')) v(odd, member)
  GROUP BY name, v.odd, v.member
)
SELECT 'p' || name AS archive, member, size, TRUE AS has_bytes FROM counted
UNION ALL
SELECT 'p' || CAST(page_id // 16 AS VARCHAR) || '.zip', 'html/c.HTML',
       13 + CAST(sum(length(CAST(page_id AS VARCHAR)) + 4 + octet_length(encode(html))
                     + length(html) - length(replace(html, '"', ''))) AS BIGINT), TRUE
FROM pages GROUP BY page_id // 16
UNION ALL
SELECT DISTINCT '_broken-' || name, CAST(NULL AS VARCHAR), CAST(-1 AS BIGINT), TRUE FROM packed
UNION ALL
SELECT DISTINCT 'empty-' || name, CAST(NULL AS VARCHAR), CAST(-1 AS BIGINT), FALSE FROM packed""",
    "expand_archives": "SELECT CAST(page_id AS VARCHAR) || ';' || url AS line FROM pages",
    "read_archived_delimited": "SELECT page_id, url FROM pages",
    "read_archived_indexed": _ARCHIVED_HTML,
    "land_archives": _ARCHIVED_HTML,
    "land_archives_manifest": """
WITH packed AS (
  SELECT CAST(page_id // 16 AS VARCHAR) || '.zip' AS name, page_id % 2 AS odd,
         length(CAST(page_id AS VARCHAR)) + length(url) + 3 AS size
  FROM pages
), members AS (
  SELECT name, v.odd, v.member
  FROM (SELECT DISTINCT name FROM packed), (VALUES (0, 'a.PAGES'), (1, 'sub/b.PAGES')) v(odd, member)
)
SELECT 'p' || name AS archive, member, 13 + CAST(coalesce(sum(size), 0) AS BIGINT) AS size, FALSE AS bad
FROM members LEFT JOIN packed USING (name, odd)
GROUP BY name, member
UNION ALL
SELECT DISTINCT prefix || name, CAST(NULL AS VARCHAR), CAST(-1 AS BIGINT), TRUE
FROM packed, (VALUES ('_broken-'), ('empty-')) v(prefix)""",
    "archive_lines_format": "SELECT CAST(page_id AS VARCHAR) || ';' || url AS line FROM pages",
    "sink_overwrite": "SELECT o_orderkey, o_orderstatus FROM orders",
    "sink_overwrite_of_its_source": """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""",
    "sink_replace_years": f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano_inicio, l_returnflag AS uf, count(*) AS n
FROM lineitem
WHERE year(l_shipdate) <> {YEARS[0]} OR l_returnflag = '{FOREIGN}'
GROUP BY 1, 2""",
    "project_sentinel_date": f"""
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN NULL
            WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
            ELSE {_DAY} END AS day
FROM orders""",
    "project_decimal_comma": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END
           AS capital_social
FROM orders""",
    "project_code_label": """
SELECT o_orderkey, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS cod_porte,
       CASE substring(o_orderpriority, 1, 1)
           WHEN '1' THEN 'NÃO INFORMADO' WHEN '2' THEN 'MICRO EMPRESA'
           WHEN '3' THEN 'EMPRESA DE PEQUENO PORTE' WHEN '5' THEN 'DEMAIS' END
           AS porte_empresa
FROM orders""",
    "project_year_month": """
SELECT o_orderkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS BIGINT) AS ano,
       CAST(EXTRACT(MONTH FROM o_orderdate) AS BIGINT) AS mes
FROM orders""",
    "project_year_start": """
SELECT o_orderkey, strftime(DATE_TRUNC('year', o_orderdate), '%Y-%m-%d') AS year_start
FROM orders""",
    "filter_since": _lines("a.l_shipdate >= DATE '1999-01-01'"),
    "filter_years": _lines(f"year(l_shipdate) BETWEEN {YEARS[0]} AND {YEARS[1]}"),
    "filter_exclude_value": _lines(f"a.l_returnflag <> '{FOREIGN}'"),
    "filter_code_range": _lines(_in_range(INDUSTRY_PCT)),
    "filter_any_flag": f"""
WITH {_SPECIAL}
SELECT company AS cnpj_basico, idc_op_mei, idc_op_simples FROM special""",
    "filter_right_side_code": f"""
SELECT l_orderkey AS cnpj_basico, l_linenumber AS cod_pais, o_orderpriority AS cod_porte
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderpriority = '{MEDIUM}'""",
    "filter_year_to_date": _lines(f"l_shipdate >= date_trunc('year', DATE '{AS_OF}')"),
    "join_inner_company": """
SELECT l_orderkey AS cnpj_basico, l_linenumber AS cod_pais,
       CASE WHEN o_orderstatus = 'F' THEN 'S' ELSE 'N' END AS idc_op_mei,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'S' ELSE 'N' END AS idc_op_simples
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "join_left_label": """
SELECT l_orderkey AS cnpj_basico, l_suppkey AS cod_municipio, s_name AS nom_municipio
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "join_left_activity": """
SELECT l_orderkey AS cnpj_basico, l_partkey AS cod_cnae_principal, p_name AS nom_cnae
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "join_left_company": """
SELECT l_orderkey AS cnpj_basico, l_linenumber AS cod_pais, o_totalprice AS capital_social
FROM lineitem
LEFT JOIN (SELECT * FROM orders WHERE o_totalprice >= 250000) ON l_orderkey = o_orderkey""",
    "join_left_nature": """
SELECT o_orderkey AS cnpj_basico, o_orderstatus AS cod_nat_juridica,
       'NATURE ' || o_orderstatus AS nom_nat_juridica
FROM orders""",
    "join_left_unmatched": """
SELECT l_orderkey AS cnpj_basico, l_linenumber AS cod_pais, n_name AS nom_pais
FROM lineitem
LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <= 3) ON l_linenumber = n_nationkey""",
    "join_left_unused": """
SELECT l_returnflag AS uf, COUNT(l_orderkey) AS qtd_empresas
FROM lineitem
LEFT JOIN (SELECT n_nationkey FROM nation
           UNION ALL SELECT n_nationkey FROM nation WHERE n_nationkey = 2)
       ON l_linenumber = n_nationkey
GROUP BY 1""",
    "agg_count": """
SELECT l_returnflag AS uf, COUNT(CASE WHEN l_returnflag <> 'A' THEN l_suppkey END)
           AS qtd_empresas
FROM lineitem GROUP BY 1""",
    "agg_count_distinct": """
SELECT CAST(EXTRACT(YEAR FROM l_shipdate) AS BIGINT) AS ano, l_returnflag AS uf,
       COUNT(DISTINCT l_orderkey) AS qtd_empresas
FROM lineitem GROUP BY 1, 2""",
    "agg_distinct_sets": """
SELECT CAST(year(l_shipdate) AS BIGINT) AS ano, count(DISTINCT l_orderkey) AS qtd_empresas
FROM lineitem GROUP BY 1""",
    "agg_avg": """
SELECT o_orderpriority AS cod_porte, ROUND(AVG(o_totalprice), 2) AS media
FROM orders GROUP BY 1""",
    "agg_avg_by_label": _mean_by_activity("round(avg(o_totalprice), 2)"),
    "top_n": """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "table_simples": f"""
SELECT {_ORDER_ID} AS cnpj_basico,
       CASE WHEN o_orderstatus = 'F' THEN 'S' ELSE 'N' END AS idc_op_simples,
       {_DAY} AS dt_op_simples, CASE WHEN o_orderstatus = 'O' THEN {_DAY} END
           AS dt_exclusao_simples,
       CASE WHEN o_orderstatus = 'O' THEN 'S' ELSE 'N' END AS idc_op_mei,
       CASE WHEN o_orderstatus = 'O' THEN {_DAY} END AS dt_op_mei,
       CASE WHEN o_orderstatus = 'P' THEN {_DAY} END AS dt_exclusao_mei
FROM orders""",
    "table_cnae": "SELECT CAST(p_partkey AS INTEGER) AS cod_cnae, p_name AS nom_cnae FROM part",
    "table_municipio": """
SELECT CAST(s_suppkey AS INTEGER) AS cod_municipio, s_name AS nom_municipio FROM supplier""",
    "table_natureza_juridica": """
SELECT r_regionkey AS cod_nat_juridica, r_name AS nom_nat_juridica FROM region""",
    "table_pais": "SELECT n_nationkey AS cod_pais, n_name AS nom_pais FROM nation",
    "table_qualificacao_socio": """
SELECT CAST(c_custkey AS INTEGER) AS cod_qualif_socio, c_mktsegment AS nom_qualif_socio
FROM customer""",
    "table_socio": f"""
SELECT {_ORDER_ID} AS cnpj_basico,
       CAST(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 3 WHEN o_orderstatus = 'F' THEN 1
                 WHEN o_orderstatus = 'O' THEN 2 ELSE 9 END AS INTEGER) AS cod_ident_socio,
       'SÓCIO ' || CAST(o_custkey AS VARCHAR) AS nom_socio,
       '***123456**' AS cnpj_cpf_socio, CAST(49 AS INTEGER) AS cod_qualif_socio,
       strftime(o_orderdate + INTERVAL 144 MONTH, '%Y-%m-%d') AS dt_entrada_sociedade,
       CAST(o_custkey AS INTEGER) AS cod_pais,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS cpf_representante,
       'JOSÉ' AS nom_representante, CAST(0 AS INTEGER) AS cod_qualif_representante,
       CAST(5 AS INTEGER) AS cod_faixa_etaria, 'RAZÃO ' || o_orderpriority AS razao_social,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'ESTRANGEIRO'
            WHEN o_orderstatus = 'F' THEN 'PESSOA JURÍDICA'
            WHEN o_orderstatus = 'O' THEN 'PESSOA FÍSICA' END AS tipo_socio
FROM orders
WHERE o_orderpriority <> '5-LOW'
  AND o_orderdate + INTERVAL 144 MONTH >= DATE '2010-01-01'""",
    "table_empresa": f"""
SELECT {_ORDER_ID} AS cnpj_basico, 'COMÉRCIO ' || CAST(o_custkey AS VARCHAR) AS razao_social,
       CAST(o_custkey AS INTEGER) AS cod_nat_juridica, CAST(49 AS INTEGER) AS cod_qualif_socio,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS capital_social,
       CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS cod_porte,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS ente_federativo,
       CASE substring(o_orderpriority, 1, 1)
           WHEN '1' THEN 'NÃO INFORMADO' WHEN '2' THEN 'MICRO EMPRESA'
           WHEN '3' THEN 'EMPRESA DE PEQUENO PORTE' WHEN '5' THEN 'DEMAIS' END
           AS porte_empresa
FROM orders""",
    "table_estabelecimento": rf"""
SELECT {_LINE_ID} AS cnpj_basico,
       lpad(CAST(l_linenumber AS VARCHAR), 4, '0') AS cnpj_origem,
       lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS cnpj_dv,
       l_linenumber AS cod_matriz_filial, 'SALA "' || l_returnflag || '" Ç' AS nom_fantasia,
       CAST(CASE WHEN l_linenumber <= 4 THEN l_linenumber WHEN l_returnflag = 'N' THEN 8
                 ELSE 9 END AS INTEGER) AS cod_situacao_cadastral,
       CASE WHEN l_linestatus = 'O' THEN strftime(l_shipdate, '%Y-%m-%d') END
           AS dt_situacao_cadastral,
       CAST(0 AS INTEGER) AS cod_motivo_situcao_cadastral, '-' AS nom_cidade_exterior,
       l_linenumber AS cod_pais, strftime(l_shipdate, '%Y-%m-%d') AS dt_inicio_atividade,
       CAST(l_partkey AS INTEGER) AS cod_cnae_principal,
       CASE WHEN l_linenumber <= 2 THEN CAST(l_partkey AS VARCHAR) END AS cod_cnae_secundario,
       'RUA' AS tipo_logradouro,
       'SÃO ' || CAST(l_suppkey AS VARCHAR) AS logradouro,
       CAST(CASE WHEN l_linenumber <= 4 THEN l_linenumber END AS VARCHAR) AS numero,
       'BARRA \' AS complemento, 'CENTRO; ' || l_linestatus AS bairro,
       lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS cep, l_returnflag AS uf,
       CAST(l_suppkey AS INTEGER) AS cod_municipio, l_linenumber AS ddd_1,
       CAST(l_orderkey AS INTEGER) AS telefone_1, CAST(21 AS INTEGER) AS ddd_2,
       CAST(l_partkey AS INTEGER) AS telefone_2, CAST(31 AS INTEGER) AS ddd_fax,
       CAST(CASE WHEN l_linenumber <> 7 THEN l_partkey END AS VARCHAR) AS fax,
       CAST(l_orderkey AS VARCHAR) || '@example.com' AS email,
       '-' AS sit_especial, CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%Y-%m-%d') END
           AS dt_sit_especial,
       l_linestatus || '.ESTABELE' AS filename,
       CASE l_linenumber WHEN 1 THEN 'MATRIZ' WHEN 2 THEN 'FILIAL' END AS matriz_filial,
       CASE WHEN l_linenumber = 1 THEN 'NULA' WHEN l_linenumber = 2 THEN 'ATIVA'
            WHEN l_linenumber = 3 THEN 'SUSPENSA' WHEN l_linenumber = 4 THEN 'INAPTA'
            WHEN l_returnflag = 'N' THEN 'BAIXADA' END AS situacao_cadastral
FROM lineitem""",
}
