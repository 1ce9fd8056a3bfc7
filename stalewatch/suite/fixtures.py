"""Inventory tables derived from the star-schema test tables.

The texts run unchanged on Spark and on DuckDB; ``{name}`` stands for a base table.
"""

from pyspark.sql import DataFrame, SparkSession

SQL = {
    "servidores_siglas": """
SELECT s_name AS nome,
 CASE WHEN s_suppkey % 3 = 0 THEN 'x86_64' WHEN s_suppkey % 3 = 1 THEN 'ARM64' ELSE 'nan' END AS arquitetura,
 CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE 'Instalado' END AS status,
 CASE WHEN s_suppkey % 4 = 0 THEN 'Inativo' ELSE ' Operacional' END AS status_operacional,
 CASE WHEN s_suppkey % 2 = 0 THEN 'Produção' ELSE 'Homologação' END AS ambiente,
 CASE WHEN s_suppkey % 17 = 0 THEN 'empty string' ELSE concat(' ', n_name, ' ') END AS sigla
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
UNION ALL
SELECT s_name, 'x86_64', 'Instalado', 'operacional', 'Produção', lower(n_name)
FROM {supplier} JOIN {nation} ON n_nationkey = (s_nationkey + 1) % 25 WHERE s_suppkey % 5 = 0""",
    "software_instance": """
SELECT DISTINCT CASE WHEN p_partkey % 13 = 0 THEN lower(s_name) ELSE s_name END AS installed_on,
 CASE p_partkey % 5 WHEN 0 THEN concat(p_name, '  ', p_brand) WHEN 1 THEN concat(upper(p_name), ' enterprise ', p_brand)
  WHEN 2 THEN concat(p_name, ' edition') WHEN 3 THEN concat('agent ', p_type) ELSE concat(p_name, ' ', p_brand) END AS software,
 '20260401' AS anomesdia
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey JOIN {supplier} ON s_suppkey = l_suppkey""",
    "software_catalog": """
SELECT DISTINCT p_type AS model_id, p_name AS name, CASE WHEN p_size % 7 = 0 THEN 'nan' ELSE p_brand END AS version,
 '20260401' AS anomesdia FROM {part}""",
    "relationships": """
SELECT DISTINCT n_name AS sigla_ss, p_name AS produto, p_brand AS versao, 'Ativo' AS status,
 CASE WHEN p_size % 9 = 0 THEN 'n/d' ELSE concat(CAST(p_size % 5 AS STRING), ',', CAST(p_size % 10 AS STRING)) END AS criticidade,
 CASE WHEN p_size % 4 = 0 OR (n_nationkey % 3 = 1 AND p_size % 7 <> 0) THEN '0' WHEN p_size % 11 = 0 THEN 'nan'
  ELSE concat('0,', CAST(p_size AS STRING)) END AS indice_obsolescencia,
 CASE WHEN n_nationkey % 3 = 1 AND p_size % 7 <> 0 THEN 'Up to date' WHEN p_size % 5 = 0 THEN 'Alto' WHEN p_size % 5 = 1 THEN 'Médio'
  WHEN p_size % 5 = 2 THEN 'Baixo' WHEN p_size % 5 = 3 THEN 'Up to date' ELSE '' END AS rating,
 CASE p_size % 3 WHEN 0 THEN 'Crítico' WHEN 1 THEN 'Moderado' ELSE 'nan' END AS impacto,
 CASE p_size % 4 WHEN 0 THEN 'Sim' WHEN 1 THEN 'VERDADEIRO' ELSE 'false' END AS cloud
FROM {part} JOIN {nation} ON n_nationkey = p_partkey % 25
UNION ALL
SELECT DISTINCT n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'agent' ELSE concat('Agent ', p_type) END,
 CASE WHEN n_nationkey % 2 = 0 THEN p_type ELSE '1' END, 'Ativo', '1,5', '0', 'Up to date', 'Moderado', 'false'
FROM {part} JOIN {nation} ON n_nationkey = p_partkey % 25 WHERE n_nationkey % 4 < 2""",
    "query1": """
SELECT CASE WHEN n_nationkey % 6 = 0 THEN concat(n_name, ' fora') ELSE n_name END AS sigla_ss,
 CASE WHEN n_nationkey % 4 = 0 THEN 'Tier 1' ELSE 'Tier 2' END AS criticidade_final,
 r_name AS diretoria, concat('Com ', r_name) AS comunidade
FROM {nation} JOIN {region} ON r_regionkey = n_regionkey""",
    "query2": """
SELECT CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE concat(p_name, ' fora') END AS nome,
 min(p_type) AS pillar, min(p_brand) AS dominio, max(p_brand) AS subdominio
FROM {part} GROUP BY 1""",
}

_BASE_TABLES = ("region", "nation", "supplier", "part", "lineitem")


_TABLES: dict[tuple[str, str], DataFrame] = {}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its files are listed and their schema read once per session."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = SQL[name]
    used = {t: base_table(spark, sf_dir, t) for t in _BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def fixture_sql(name: str) -> str:
    """The same derivation with plain table names."""
    return SQL[name].format(**{t: t for t in _BASE_TABLES})
