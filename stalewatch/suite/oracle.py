"""Independent SQL for the registered queries, in the DuckDB dialect.

The SQL states the meaning directly, with theta joins where the library uses blocked lookups, so both
sides share nothing but the derived input tables.
"""

import re

from stalewatch.suite.fixtures import SQL as FIXTURES
from stalewatch.suite.fixtures import fixture_sql
from stalewatch.suite.queries import PROMPT_TEXT, SYSTEM_TEXT, VIEW_ROWS


def _blank(c: str) -> str:
    return f"CASE WHEN lower(trim({c}, ' ')) NOT IN ('nan', 'empty string', '') THEN trim({c}, ' ') END"


def _basic(c: str) -> str:
    return f"lower(trim({c}, ' '))"


def _strong(c: str) -> str:
    return f"lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'), ' '))"


def _parsed(c: str, strip: bool = True) -> str:
    return f"TRY_CAST(replace({f'trim({c})' if strip else c}, ',', '.') AS DOUBLE)"


def _number(c: str, strip: bool = True) -> str:
    parsed = _parsed(c, strip)
    return f"CASE WHEN NOT isnan({parsed}) THEN {parsed} END"


def _round(x: str, digits: int = 6) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


def _half_up(x: str) -> str:
    return _round(x, 2)


HIGH = "lower(rating) IN ('alto', 'médio', 'medio')"
CRITICAL = "contains(lower(impacto), 'cr')"
NONCONFORM = "(indice_obsolescencia > 0 OR lower(rating) IN ('alto', 'médio', 'medio', 'baixo'))"


def _servers(key) -> str:
    return f"""SELECT *, {key('servidor')} AS servidor_join, {key('sigla_origem')} AS sigla_join FROM (
SELECT {_blank('nome')} AS servidor, {_blank('arquitetura')} AS arquitetura, {_blank('status')} AS status_servidor,
 {_blank('status_operacional')} AS status_operacional, {_blank('ambiente')} AS ambiente, {_blank('sigla')} AS sigla_origem
FROM fx_servidores_siglas)"""


def _instances(key) -> str:
    return f"""SELECT *, {key('servidor_instancia')} AS servidor_join, {key('software_instalado')} AS software_join FROM (
SELECT {_blank('installed_on')} AS servidor_instancia, {_blank('software')} AS software_instalado,
 {_blank('anomesdia')} AS anomesdia_software_instance FROM fx_software_instance)"""


_CATALOG_BASE = f"""SELECT {_blank('model_id')} AS model_id, {_blank('name')} AS nome_software_catalogo,
 {_blank('version')} AS versao_catalogo, {_blank('anomesdia')} AS anomesdia_catalogo FROM fx_software_catalog"""

_RELATIONSHIP_BASE = f"""SELECT {_blank('sigla_ss')} AS sigla_relacionamento, {_blank('produto')} AS produto_tecnologico,
 {_blank('versao')} AS versao_relacionamento, {_blank('status')} AS status_relacionamento,
 {_number('criticidade')} AS criticidade, {_number('indice_obsolescencia')} AS indice_obsolescencia,
 {_blank('rating')} AS rating, {_blank('impacto')} AS impacto, {_blank('cloud')} AS cloud FROM fx_relationships"""

_GOLD_HEAD = """servidor, 'Servidor' AS tipo_chave, servidor AS descricao_servidor, sigla_origem, arquitetura,
 status_servidor, status_operacional, ambiente, software_instalado, nome_software_catalogo AS software_catalogado,
 coalesce(versao_catalogo, versao_relacionamento) AS versao, produto_tecnologico, status_relacionamento,
 criticidade, indice_obsolescencia, rating, impacto, cloud"""

_SHORT_HEADER = """concat_ws(' | ', 'servidor=' || servidor, 'sigla_origem=' || sigla_origem,
 'software=' || coalesce(software_instalado, 'N/A'), 'produto_tecnologico=' || coalesce(produto_tecnologico, 'N/A'),
 'versao=' || coalesce(versao_catalogo, versao_relacionamento, 'N/A')) AS detalhe_cabecalho"""

_LONG_HEADER = """concat_ws(' | ', 'servidor=' || servidor, 'sigla_origem=' || sigla_origem,
 'software=' || coalesce(software_instalado, 'N/A'), 'software_catalogado=' || coalesce(nome_software_catalogo, 'N/A'),
 'produto_tecnologico=' || coalesce(produto_tecnologico, 'N/A'),
 'versao=' || coalesce(versao_catalogo, versao_relacionamento, 'N/A'),
 'tipo_match_catalogo=' || tipo_match_catalogo, 'tipo_match_relacionamento=' || tipo_match_relacionamento
 ) AS detalhe_cabecalho"""

_CATALOG_LABEL = """CASE prioridade_match_catalogo WHEN 1 THEN 'MATCH_EXATO_NAME_VERSION'
 WHEN 2 THEN 'MATCH_CONTEM_NAME_VERSION' WHEN 3 THEN 'MATCH_CONTEM_NAME' ELSE 'SEM_MATCH_CATALOGO' END"""

_RELATIONSHIP_LABEL = """CASE prioridade_match_relacionamento WHEN 1 THEN 'MATCH_CAT_PRODUTO_VERSION'
 WHEN 2 THEN 'MATCH_CAT_PRODUTO' WHEN 3 THEN 'MATCH_INST_PRODUTO_VERSION' WHEN 4 THEN 'MATCH_INST_PRODUTO'
 WHEN 5 THEN 'MATCH_CONTEM_PRODUTO_VERSION' WHEN 6 THEN 'MATCH_CONTEM_PRODUTO' ELSE 'SEM_MATCH_RELACIONAMENTO' END"""


def _inside(text: str, term: str) -> str:
    return f"(length({term}) >= 4 AND contains({text}, {term}))"


def _cascade(suffix: str, extra: str) -> dict[str, str]:
    """CTEs of the cascade; ``extra`` are additional partition columns, e.g. ', sigla_join'."""
    return {
        f"cand{suffix}": f"""SELECT s.*, i.software_instalado, i.software_join, c.nome_software_catalogo, c.versao_catalogo,
 c.software_catalogo_join, c.name_join, c.version_join,
 CASE WHEN i.software_join = c.software_catalogo_join THEN 1
  WHEN {_inside('i.software_join', 'c.name_join')} AND {_inside('i.software_join', 'c.version_join')} THEN 2
  WHEN {_inside('i.software_join', 'c.name_join')} THEN 3 ELSE 99 END AS prioridade_match_catalogo
FROM srv s LEFT JOIN inst i ON s.servidor_join = i.servidor_join
LEFT JOIN cat c ON i.software_join = c.software_catalogo_join OR {_inside('i.software_join', 'c.name_join')}""",
        f"best_cat{suffix}": f"""SELECT * FROM cand{suffix} QUALIFY row_number() OVER (
 PARTITION BY servidor_join, software_join{extra} ORDER BY prioridade_match_catalogo,
 length(name_join) DESC NULLS LAST, length(version_join) DESC NULLS LAST, software_catalogo_join NULLS LAST,
 name_join NULLS LAST, version_join NULLS LAST, nome_software_catalogo NULLS LAST, versao_catalogo NULLS LAST,
 sigla_join NULLS LAST, sigla_origem NULLS LAST, servidor NULLS LAST, ambiente NULLS LAST, arquitetura NULLS LAST,
 status_servidor NULLS LAST, status_operacional NULLS LAST, software_instalado NULLS LAST) = 1""",
        f"rel_cand{suffix}": f"""SELECT b.*, r.produto_tecnologico, r.versao_relacionamento, r.status_relacionamento,
 r.criticidade, r.indice_obsolescencia, r.rating, r.impacto, r.cloud, r.produto_versao_join,
 CASE WHEN b.software_catalogo_join = r.produto_versao_join THEN 1 WHEN b.name_join = r.produto_join THEN 2
  WHEN b.software_join = r.produto_versao_join THEN 3 WHEN b.software_join = r.produto_join THEN 4
  WHEN {_inside('b.software_join', 'r.produto_join')} AND {_inside('b.software_join', 'r.versao_join')} THEN 5
  WHEN {_inside('b.software_join', 'r.produto_join')} THEN 6 ELSE 99 END AS prioridade_match_relacionamento
FROM best_cat{suffix} b LEFT JOIN rel r ON b.sigla_join = r.sigla_join AND (
 b.software_catalogo_join = r.produto_versao_join OR b.name_join = r.produto_join
 OR b.software_join = r.produto_versao_join OR b.software_join = r.produto_join
 OR {_inside('b.software_join', 'r.produto_join')})""",
        f"gold{suffix}": f"""SELECT DISTINCT {_GOLD_HEAD}, tipo_match_catalogo, tipo_match_relacionamento,
 prioridade_match_catalogo, prioridade_match_relacionamento, {_LONG_HEADER}, 'gold' AS camada, '202604' AS anomes
FROM (SELECT *, {_CATALOG_LABEL} AS tipo_match_catalogo, {_RELATIONSHIP_LABEL} AS tipo_match_relacionamento
 FROM rel_cand{suffix} QUALIFY row_number() OVER (
 PARTITION BY servidor_join, software_join, software_catalogo_join{extra}
 ORDER BY prioridade_match_relacionamento, indice_obsolescencia DESC NULLS LAST, criticidade DESC NULLS LAST,
 produto_versao_join NULLS LAST, rating NULLS LAST, impacto NULLS LAST, produto_tecnologico NULLS LAST,
 versao_relacionamento NULLS LAST, status_relacionamento NULLS LAST, cloud NULLS LAST) = 1)""",
    }


def _sigla_gold(key, zero) -> str:
    return f"""SELECT r.sigla_join AS sigla, r.* EXCLUDE (sigla_join), s.* EXCLUDE (sigla_join), m.media_softwares_por_servidor,
 3.0::DOUBLE * qtd_riscos_altos_medios + 2.0::DOUBLE * qtd_impactos_criticos
 + 2.0::DOUBLE * {zero('media_indice_obsolescencia')} + 0.2::DOUBLE * {zero('qtd_servidores_producao')} AS score_risco_operacional
FROM {key}_risks r LEFT JOIN {key}_servers s ON r.sigla_join = s.sigla_join
LEFT JOIN {key}_software m ON r.sigla_join = m.sigla_join"""


def _sigla_parts(prefix: str, clean) -> dict[str, str]:
    return {
        f"{prefix}_treated": f"""SELECT *, {_basic(clean('sigla_ss'))} AS sigla_join,
 {_number('indice_obsolescencia', False)} AS indice_obsolescencia_num, {_number('criticidade', False)} AS criticidade_num,
 CAST(coalesce({HIGH}, false) AS INTEGER) AS flag_risco_alto, CAST(coalesce({CRITICAL}, false) AS INTEGER) AS flag_critico,
 CAST(coalesce(lower(cloud) IN ('true', 'verdadeiro', 'sim'), false) AS INTEGER) AS flag_cloud FROM fx_relationships""",
        f"{prefix}_risks": f"""SELECT sigla_join, count(DISTINCT produto) AS qtd_produtos_tecnologicos,
 count(*) AS qtd_relacionamentos_tecnologia, avg(indice_obsolescencia_num) AS media_indice_obsolescencia,
 avg(criticidade_num) AS media_criticidade, CAST(sum(flag_risco_alto) AS BIGINT) AS qtd_riscos_altos_medios,
 CAST(sum(flag_critico) AS BIGINT) AS qtd_impactos_criticos, CAST(sum(flag_cloud) AS BIGINT) AS qtd_itens_cloud
FROM {prefix}_treated GROUP BY sigla_join""",
        f"{prefix}_servers": f"""SELECT {_basic(clean('sigla'))} AS sigla_join, count(DISTINCT nome) AS qtd_servidores,
 count(DISTINCT arquitetura) AS qtd_tipos_arquitetura,
 count(*) FILTER (WHERE contains(lower(ambiente), 'produ')) AS qtd_servidores_producao,
 count(*) FILTER (WHERE lower(status_operacional) = 'operacional') AS qtd_servidores_operacionais
FROM fx_servidores_siglas GROUP BY 1""",
        f"{prefix}_software": f"""SELECT {_basic(clean('sigla'))} AS sigla_join,
 avg(qtd_softwares_instalados) AS media_softwares_por_servidor
FROM fx_servidores_siglas LEFT JOIN per_server ON {_basic('nome')} = nome_servidor_join GROUP BY 1""",
    }


_RISK_CLASS = "CASE WHEN {0} >= {1} THEN 'Alto' WHEN {0} >= {2} THEN 'Médio' ELSE 'Baixo' END"

CTES: dict[str, str] = {
    **{f"fx_{name}": fixture_sql(name).strip() for name in FIXTURES},
    "srv": _servers(_strong),
    "srv1": _servers(_basic),
    "inst": _instances(_strong),
    "inst1": _instances(_basic),
    "cat_all": f"""SELECT *, {_strong('nome_software_catalogo')} AS name_join, {_strong('versao_catalogo')} AS version_join,
 {_strong('model_id')} AS model_join, {_strong("concat_ws(' ', nome_software_catalogo, versao_catalogo)")} AS software_catalogo_join
FROM ({_CATALOG_BASE})""",
    "cat": """SELECT * FROM cat_all QUALIFY row_number() OVER (PARTITION BY software_catalogo_join, name_join, version_join
 ORDER BY nome_software_catalogo NULLS LAST, versao_catalogo NULLS LAST, model_id NULLS LAST) = 1""",
    "cat1": f"""SELECT *, {_basic('nome_software_catalogo')} AS name_join, {_basic('model_id')} AS model_join
FROM ({_CATALOG_BASE})""",
    "rel": f"""SELECT *, {_strong('sigla_relacionamento')} AS sigla_join, {_strong('produto_tecnologico')} AS produto_join,
 {_strong('versao_relacionamento')} AS versao_join,
 {_strong("concat_ws(' ', produto_tecnologico, versao_relacionamento)")} AS produto_versao_join FROM ({_RELATIONSHIP_BASE})""",
    "rel1": f"""SELECT *, {_basic('sigla_relacionamento')} AS sigla_join, {_basic('produto_tecnologico')} AS produto_join
FROM ({_RELATIONSHIP_BASE})""",
    **_cascade("", ""),
    **_cascade("_s", ", sigla_join"),
    "gold_v1": f"""SELECT DISTINCT {_GOLD_HEAD}, {_SHORT_HEADER}, 'gold' AS camada, '202604' AS anomes
FROM srv1 s LEFT JOIN inst1 i ON s.servidor_join = i.servidor_join LEFT JOIN cat1 c ON i.software_join = c.name_join
LEFT JOIN rel1 r ON c.model_join = r.produto_join""",
    "gold_v2": f"""SELECT DISTINCT {_GOLD_HEAD}, {_SHORT_HEADER}, 'gold' AS camada, '202604' AS anomes
FROM srv1 s LEFT JOIN inst i ON s.servidor_join = i.servidor_join
LEFT JOIN cat_all c ON i.software_join = c.software_catalogo_join
LEFT JOIN rel r ON s.sigla_join = r.sigla_join AND (c.name_join = r.produto_join
 OR c.software_catalogo_join = r.produto_versao_join OR i.software_join = r.produto_join
 OR i.software_join = r.produto_versao_join)""",
    "per_server": f"""SELECT {_basic('installed_on')} AS nome_servidor_join, count(DISTINCT software) AS qtd_softwares_instalados
FROM fx_software_instance GROUP BY 1""",
    **_sigla_parts("raw", lambda c: c),
    **_sigla_parts("clean", _blank),
    "sigla_raw": _sigla_gold("raw", lambda c: c),
    "sigla_clean": _sigla_gold("clean", lambda c: f"coalesce({c}, 0)"),
    "dim_sig": f"""SELECT {_basic('sigla_ss')} AS sigla_join, criticidade_final AS criticidade_tier, diretoria, comunidade
FROM fx_query1 WHERE sigla_ss IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_basic('sigla_ss')}
 ORDER BY criticidade_final, diretoria, comunidade) = 1""",
    "dim_prod": f"""SELECT {_basic('nome')} AS produto_join, nome AS nome_produto, pillar, dominio, subdominio
FROM fx_query2 WHERE nome IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_basic('nome')}
 ORDER BY nome, pillar, dominio, subdominio) = 1""",
    "hub": f"""SELECT DISTINCT 'Obsolescência tecnológica por servidor' AS "INDICADOR",
 'Controle de softwares obsoletos por servidor' AS "Nome_Catch", servidor AS "Chave", 'Servidor' AS "Tipo_chave",
 descricao_servidor AS "Descricao_chave", coalesce(criticidade_tier, 'Não informado') AS "Criticidade",
 coalesce(diretoria, 'Não informado') AS "Diretoria", coalesce(comunidade, 'Não informado') AS "Comunidade",
 CASE WHEN {NONCONFORM} THEN 'Não esta em conformidade' ELSE 'Em conformidade' END AS "Conformidade",
 'produto | versao | status | criticidade | indice_obsolescencia | rating | impacto | cloud | Nome | Pillar | Dominio | Subdominio | sigla_origem | ambiente | arquitetura' AS "Nome_Cabecalho",
 array_to_string([coalesce(produto_tecnologico, software_catalogado, software_instalado, ''), coalesce(versao, ''),
 coalesce(status_relacionamento, ''), coalesce(CAST(criticidade AS VARCHAR), ''),
 coalesce(CAST(indice_obsolescencia AS VARCHAR), ''), coalesce(rating, ''), coalesce(impacto, ''), coalesce(cloud, ''),
 coalesce(nome_produto, ''), coalesce(pillar, ''), coalesce(dominio, ''), coalesce(subdominio, ''),
 'sigla_origem=' || coalesce(sigla_origem, ''), 'ambiente=' || coalesce(ambiente, ''),
 'arquitetura=' || coalesce(arquitetura, '')], ' | ') AS "Detalhe_Cabecalho", '202604' AS anomes
FROM gold g LEFT JOIN dim_sig ON {_basic('g.sigla_origem')} = dim_sig.sigla_join
LEFT JOIN dim_prod ON {_basic('coalesce(produto_tecnologico, software_catalogado, software_instalado)')} = dim_prod.produto_join""",
    "share": f"""SELECT servidor, sigla_origem, count(*) AS qtd_total_softwares,
 count(*) FILTER (WHERE {NONCONFORM}) AS qtd_inconformidades,
 {_half_up(f"100.0::DOUBLE * count(*) FILTER (WHERE {NONCONFORM}) / count(*)")} AS percentual_inconformidade
FROM gold GROUP BY servidor, sigla_origem""",
    "flags": f"""SELECT servidor, sigla_origem, CAST(coalesce(bool_or({NONCONFORM}), false) AS INTEGER) AS flag_inconforme,
 CASE WHEN bool_or({NONCONFORM}) THEN 'Vermelho' ELSE 'Verde' END AS farol FROM gold GROUP BY servidor, sigla_origem""",
    "remediation": f"""SELECT software_instalado, versao, count(DISTINCT servidor) AS qtd_servidores_afetados, count(*) AS qtd_ocorrencias,
 {_half_up('(CAST(sum(CAST(indice_obsolescencia AS DECIMAL(38, 12))) AS DOUBLE) / count(indice_obsolescencia))')} AS media_indice_obsolescencia, {_half_up('(CAST(sum(CAST(criticidade AS DECIMAL(38, 12))) AS DOUBLE) / count(criticidade))')} AS media_criticidade,
 count(*) FILTER (WHERE {HIGH}) AS qtd_riscos_altos_medios, count(*) FILTER (WHERE {CRITICAL}) AS qtd_impactos_criticos,
 {_half_up(f'''5.0::DOUBLE * count(DISTINCT servidor) + 3.0::DOUBLE * count(*) FILTER (WHERE {HIGH})
 + 4.0::DOUBLE * count(*) FILTER (WHERE {CRITICAL}) + 10.0::DOUBLE * coalesce((CAST(sum(CAST(indice_obsolescencia AS DECIMAL(38, 12))) AS DOUBLE) / count(indice_obsolescencia)), 0)
 + 10.0::DOUBLE * coalesce((CAST(sum(CAST(criticidade AS DECIMAL(38, 12))) AS DOUBLE) / count(criticidade)), 0)''')} AS score_prioridade_remediacao
FROM gold WHERE indice_obsolescencia > 0 OR rating IS NULL OR lower(rating) <> 'up to date'
GROUP BY software_instalado, versao""",
    "patchy": """SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 3 = 0 THEN event_type END AS tipo_raro,
 CASE WHEN event_id % 50 <> 0 THEN CAST(value AS VARCHAR) END AS valor_denso,
 CASE WHEN event_id % 4 <> 0 THEN CAST(value AS VARCHAR) END AS valor_falho, event_type AS tipo FROM events""",
    "months": "SELECT *, strftime(o_orderdate, '%Y%m') AS anomes FROM orders",
    "years": "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y') AS anomes FROM orders",
}


def _with(final: str) -> str:
    """The final statement preceded by the CTEs it needs, directly or not, in dependency order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\b\w+\b", text)) & CTES.keys():
            if word not in needed:
                needed.add(word)
                visit(CTES[word])

    visit(final)
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {parts}\n{final}" if parts else final


_SERVER_COUNTS = f"""count(DISTINCT software_instalado) AS {{0}}, count(DISTINCT produto_tecnologico) AS {{1}}"""
_EXACT_COUNTS = """count(*) FILTER (WHERE rating IN ('Alto', 'Médio', 'Medio')) AS qtd_riscos_altos_medios,
 count(*) FILTER (WHERE impacto IN ('Crítico', 'Critico')) AS qtd_impactos_criticos"""
_FOLDED_COUNTS = f"""count(*) FILTER (WHERE {HIGH}) AS qtd_riscos_altos_medios,
 count(*) FILTER (WHERE {CRITICAL}) AS qtd_impactos_criticos"""


def _server_score(high: str, critical: str) -> str:
    return f"""10.0::DOUBLE * coalesce((CAST(sum(CAST(indice_obsolescencia AS DECIMAL(38, 12))) AS DOUBLE) / count(indice_obsolescencia)), 0) + 10.0::DOUBLE * coalesce((CAST(sum(CAST(criticidade AS DECIMAL(38, 12))) AS DOUBLE) / count(criticidade)), 0)
 + 2.0::DOUBLE * count(*) FILTER (WHERE {high}) + 3.0::DOUBLE * count(*) FILTER (WHERE {critical})"""


_EXACT_SCORE = _server_score("rating IN ('Alto', 'Médio', 'Medio')", "impacto IN ('Crítico', 'Critico')")

_SIGLA_ROUNDED = ", ".join(
    f"{_round(c)} AS {c}"
    for c in ("media_indice_obsolescencia", "media_criticidade", "media_softwares_por_servidor", "score_risco_operacional")
)
_SIGLA_CLASS = _RISK_CLASS.format("score_risco_operacional", 50, 20)
_SIGLA_COUNTS = """qtd_produtos_tecnologicos, qtd_relacionamentos_tecnologia, qtd_riscos_altos_medios, qtd_impactos_criticos,
 qtd_itens_cloud, qtd_servidores, qtd_tipos_arquitetura, qtd_servidores_producao, qtd_servidores_operacionais"""


def _sigla(source: str) -> str:
    return f"""SELECT sigla, {_SIGLA_COUNTS}, {_SIGLA_ROUNDED}, {_SIGLA_CLASS} AS classificacao_risco, '202604' AS anomes
FROM {source}"""


def _numbers(table: str, columns: dict[str, str]) -> str:
    """Numeric summary of several columns by UNION ALL."""
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS coluna, count(v) AS contagem, {_round('avg(v)', 4)} AS media, {_round('stddev_samp(v)', 4)} AS desvio,
 min(v) AS minimo, {_round('quantile_cont(v, 0.25)', 4)} AS q1, {_round('quantile_cont(v, 0.5)', 4)} AS mediana,
 {_round('quantile_cont(v, 0.75)', 4)} AS q3, max(v) AS maximo FROM (SELECT CAST({expr} AS DOUBLE) AS v FROM {table})"""
        for name, expr in columns.items()
    )


def _values(table: str, columns: list[str]) -> str:
    """Top 30 values with distinct count of several columns by UNION ALL."""
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS coluna, valor, qtd, CAST(row_number() OVER (ORDER BY qtd DESC, valor NULLS LAST) AS INTEGER) AS posicao,
 (SELECT count(DISTINCT {c}) FROM {table}) AS valores_unicos
FROM (SELECT CAST({c} AS VARCHAR) AS valor, count(*) AS qtd FROM {table} GROUP BY 1)
QUALIFY row_number() OVER (ORDER BY qtd DESC, valor NULLS LAST) <= 30"""
        for c in columns
    )


def _ratios(columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS coluna, {_round(f'avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)')} AS razao_nulos FROM patchy"
        for c in columns
    )


def _totals(source: str) -> str:
    return f"SELECT anomes, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {source} GROUP BY anomes"


def _histogram(table: str, value: str, bins: int, group: str = "") -> str:
    keys = f"{group}, " if group else ""
    return f"""SELECT {keys}faixa, {_round(f'lo + faixa * (hi - lo) / {bins}', 4)} AS inicio,
 {_round(f'lo + (faixa + 1) * (hi - lo) / {bins}', 4)} AS fim, count(*) AS quantidade
FROM (SELECT {keys}lo, hi, CAST(least(floor(({value} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS faixa
 FROM {table}, (SELECT min({value}) AS lo, max({value}) AS hi FROM {table})) GROUP BY ALL"""


_DOUBLED = "(SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, anomes FROM years WHERE anomes IN ('1998', '1999'))"

_MESSAGES = f"""SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS posicao, role, text AS content
FROM conversations
UNION ALL SELECT DISTINCT conv_id, 0, 'system', '{SYSTEM_TEXT}' FROM conversations
UNION ALL SELECT conv_id, count(*) + 1, 'user', '{PROMPT_TEXT}' FROM conversations GROUP BY conv_id"""

FINAL: dict[str, str] = {
    "treat_risks": "SELECT * FROM raw_treated",
    "treat_servers": "SELECT * FROM srv",
    "treat_servers_basic_key": "SELECT * FROM srv1",
    "treat_instances": "SELECT * FROM inst",
    "treat_instances_basic_key": "SELECT * FROM inst1",
    "treat_catalog": "SELECT * FROM cat",
    "treat_relationships": "SELECT * FROM rel",
    "treat_relationships_nan_kept": f"""SELECT {_strong(_blank('sigla_ss'))} AS sigla_join,
 CASE WHEN isnan({_parsed('indice_obsolescencia')}) THEN 'NaN' WHEN {_parsed('indice_obsolescencia')} > 0 THEN 'positivo' ELSE 'zero' END AS indice,
 count(*) AS n FROM fx_relationships GROUP BY ALL""",
    "dim_siglas": "SELECT * FROM dim_sig",
    "dim_produtos": "SELECT * FROM dim_prod",
    "gold_join_keys": f"""SELECT servidor, software_instalado, {_basic('sigla_origem')} AS sigla_join,
 {_basic('coalesce(produto_tecnologico, software_catalogado, software_instalado)')} AS produto_join FROM gold""",
    "keyed_dedup": """SELECT p_name, p_brand, p_type FROM part
QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_brand, p_type) = 1""",
    "full_row_distinct": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "contained_names": f"""SELECT software_join, name_join FROM (SELECT DISTINCT software_join FROM inst)
JOIN (SELECT DISTINCT name_join FROM cat) ON {_inside('software_join', 'name_join')}""",
    "gold_server_v1": "SELECT * FROM gold_v1",
    "gold_server_v2": "SELECT * FROM gold_v2",
    "gold_server_v3": "SELECT * FROM gold",
    "gold_server_v3_by_sigla": "SELECT * FROM gold_s",
    "match_tier_counts": """SELECT tipo_match_catalogo, tipo_match_relacionamento, prioridade_match_catalogo,
 prioridade_match_relacionamento, count(*) AS n FROM gold GROUP BY ALL""",
    "rank_server_job": f"""SELECT servidor, sigla_origem, ambiente, arquitetura,
 {_SERVER_COUNTS.format('qtd_softwares_instalados', 'qtd_produtos_tecnologicos')},
 {_round('(CAST(sum(CAST(indice_obsolescencia AS DECIMAL(38, 12))) AS DOUBLE) / count(indice_obsolescencia))')} AS media_indice_obsolescencia, {_round('(CAST(sum(CAST(criticidade AS DECIMAL(38, 12))) AS DOUBLE) / count(criticidade))')} AS media_criticidade,
 {_EXACT_COUNTS}, count(*) FILTER (WHERE upper(cloud) IN ('TRUE', 'VERDADEIRO', 'SIM')) AS qtd_itens_cloud,
 {_round(_EXACT_SCORE)} AS score_risco_servidor,
 {_RISK_CLASS.format(f'({_EXACT_SCORE})', 60, 20)} AS classificacao_risco_servidor
FROM gold GROUP BY servidor, sigla_origem, ambiente, arquitetura""",
    "rank_server_view": f"""SELECT servidor, sigla_origem, ambiente, arquitetura, {_SERVER_COUNTS.format('qtd_softwares', 'qtd_produtos')},
 {_half_up('(CAST(sum(CAST(indice_obsolescencia AS DECIMAL(38, 12))) AS DOUBLE) / count(indice_obsolescencia))')} AS media_indice_obsolescencia, {_half_up('(CAST(sum(CAST(criticidade AS DECIMAL(38, 12))) AS DOUBLE) / count(criticidade))')} AS media_criticidade,
 {_FOLDED_COUNTS}, {_round(_server_score(HIGH, CRITICAL))} AS score_risco_servidor
FROM gold GROUP BY servidor, sigla_origem, ambiente, arquitetura""",
    "summary_server": f"""SELECT servidor, sigla_origem,
 {_SERVER_COUNTS.format('qtd_softwares_instalados', 'qtd_produtos_tecnologicos')},
 {_round('(CAST(sum(CAST(indice_obsolescencia AS DECIMAL(38, 12))) AS DOUBLE) / count(indice_obsolescencia))')} AS media_indice_obsolescencia, {_round('(CAST(sum(CAST(criticidade AS DECIMAL(38, 12))) AS DOUBLE) / count(criticidade))')} AS media_criticidade,
 {_EXACT_COUNTS} FROM gold GROUP BY servidor, sigla_origem""",
    "summary_sigla": f"""SELECT sigla_origem, count(DISTINCT servidor) AS qtd_servidores, count(DISTINCT software_instalado) AS qtd_softwares,
 {_half_up('(CAST(sum(CAST(indice_obsolescencia AS DECIMAL(38, 12))) AS DOUBLE) / count(indice_obsolescencia))')} AS media_indice_obsolescencia, {_half_up('(CAST(sum(CAST(criticidade AS DECIMAL(38, 12))) AS DOUBLE) / count(criticidade))')} AS media_criticidade,
 {_FOLDED_COUNTS} FROM gold GROUP BY sigla_origem""",
    "pct_nonconform": "SELECT * FROM share",
    "server_flag": "SELECT * FROM flags",
    "farol2": "SELECT farol, count(DISTINCT servidor) AS qtd_servidores FROM flags GROUP BY farol",
    "farol3": f"""SELECT farol, count(*) AS qtd_servidores,
 {_half_up('100.0::DOUBLE * count(*) / sum(count(*)) OVER ()')} AS percentual_servidores
FROM (SELECT CASE WHEN percentual_inconformidade <= 5 THEN 'Verde' WHEN percentual_inconformidade < 20 THEN 'Amarelo'
 ELSE 'Vermelho' END AS farol FROM share) GROUP BY farol""",
    "remediation": "SELECT * FROM remediation",
    "top10_remediation": """SELECT * FROM remediation
ORDER BY score_prioridade_remediacao DESC NULLS LAST, software_instalado NULLS LAST, versao NULLS LAST LIMIT 10""",
    "detail_job": """SELECT servidor, tipo_chave, descricao_servidor, sigla_origem, ambiente, arquitetura, status_servidor,
 status_operacional, software_instalado, software_catalogado, versao, produto_tecnologico, criticidade,
 indice_obsolescencia, rating, impacto, cloud, tipo_match_catalogo, tipo_match_relacionamento, detalhe_cabecalho, anomes
FROM gold""",
    "detail_view": """SELECT servidor, sigla_origem, ambiente, arquitetura, software_instalado, software_catalogado, versao,
 produto_tecnologico, criticidade, indice_obsolescencia, rating, impacto, cloud, detalhe_cabecalho FROM gold""",
    "detail_job_v1": """SELECT servidor, tipo_chave, descricao_servidor, sigla_origem, ambiente, arquitetura, status_servidor,
 status_operacional, software_instalado, software_catalogado, versao, produto_tecnologico, criticidade,
 indice_obsolescencia, rating, impacto, cloud, detalhe_cabecalho FROM gold_v1""",
    "risks_by_sigla": f"""SELECT * REPLACE ({_round('media_indice_obsolescencia')} AS media_indice_obsolescencia,
 {_round('media_criticidade')} AS media_criticidade) FROM raw_risks""",
    "servers_by_sigla": "SELECT * FROM raw_servers",
    "software_per_server": "SELECT * FROM per_server",
    "software_by_sigla": f"""SELECT sigla_join, {_round('media_softwares_por_servidor')} AS media_softwares_por_servidor FROM raw_software""",
    "gold_sigla": _sigla("sigla_raw"),
    "gold_sigla_null_as_zero": _sigla("sigla_clean"),
    "rank_sigla": f"""SELECT sigla, {_SIGLA_COUNTS}, {_SIGLA_ROUNDED}, {_SIGLA_CLASS} AS classificacao_risco FROM sigla_raw""",
    "top10_sigla": f"""SELECT sigla, {_round('score_risco_operacional')} AS score_risco_operacional, {_SIGLA_CLASS} AS classificacao_risco,
 qtd_produtos_tecnologicos, qtd_riscos_altos_medios, qtd_impactos_criticos,
 {_round('media_indice_obsolescencia')} AS media_indice_obsolescencia, qtd_servidores
FROM sigla_raw t ORDER BY t.score_risco_operacional DESC NULLS LAST, sigla LIMIT 10""",
    "summary_class": f"""SELECT {_SIGLA_CLASS} AS classificacao_risco, count(*) AS qtd_siglas,
 {_half_up('avg(score_risco_operacional)')} AS score_medio,
 CAST(sum(qtd_produtos_tecnologicos) AS BIGINT) AS qtd_produtos_tecnologicos,
 CAST(sum(qtd_servidores) AS BIGINT) AS qtd_servidores FROM sigla_raw GROUP BY 1""",
    "hub": "SELECT * FROM hub",
    "control": f"""SELECT total_registros, total_inconformes, percentual_inconformidade,
 CASE WHEN percentual_inconformidade <= 5 THEN 'Verde' WHEN percentual_inconformidade < 20 THEN 'Amarelo' ELSE 'Vermelho' END AS farol,
 'Verde <= 5%; Amarelo > 5% e < 20%; Vermelho >= 20%' AS criterio_farol, '202604' AS anomes
FROM (SELECT count(*) AS total_registros, count(*) FILTER (WHERE "Conformidade" LIKE 'Não%') AS total_inconformes,
 {_half_up('''100.0::DOUBLE * count(*) FILTER (WHERE "Conformidade" LIKE 'Não%') / count(*)''')} AS percentual_inconformidade FROM hub)""",
    "null_profile": f"""SELECT * FROM ({_ratios(['id', 'tipo_raro', 'valor_denso', 'valor_falho', 'tipo'])}) WHERE razao_nulos > 0.5""",
    "null_ratios": _ratios(["id", "tipo_raro", "valor_denso", "valor_falho", "tipo"]),
    "table_shape": "SELECT count(*) AS linhas, CAST(6 AS BIGINT) AS colunas FROM events",
    "typed_inference": """SELECT CAST(id AS DOUBLE) AS id, tipo_raro, CAST(valor_denso AS DOUBLE) AS valor_denso, valor_falho, tipo
FROM patchy""",
    "low_cardinality": "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS coluna, count(DISTINCT {c}) AS valores_unicos, count(*) AS linhas,
 {_round(f'count(DISTINCT {c})::DOUBLE / greatest(count(*), 1)')} AS razao,
 count(DISTINCT {c})::DOUBLE / greatest(count(*), 1) < 0.5 AS categoria FROM patchy"""
        for c in ("id", "tipo", "tipo_raro")
    ),
    "text_columns": """SELECT id, coalesce(tipo_raro, 'nan') AS tipo_raro, coalesce(valor_denso, 'nan') AS valor_denso,
 coalesce(valor_falho, 'nan') AS valor_falho, tipo FROM patchy""",
    "value_distribution": _values("orders", ["o_orderstatus", "o_orderpriority"]),
    "value_distribution_with_nulls": _values("patchy", ["tipo", "tipo_raro", "valor_falho"]),
    "numeric_summary": _numbers(
        "lineitem", {c: c for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")}
    ),
    "bar_topn": """SELECT event_type, count(*) AS quantidade FROM events WHERE event_type IS NOT NULL GROUP BY 1
ORDER BY quantidade DESC, event_type LIMIT 5""",
    "share_topn": f"""SELECT o_orderpriority, quantidade, {_round('100.0::DOUBLE * quantidade / sum(quantidade) OVER ()')} AS percentual
FROM (SELECT o_orderpriority, count(*) AS quantidade FROM orders GROUP BY 1 ORDER BY quantidade DESC, o_orderpriority LIMIT 3)""",
    "histogram": _histogram("orders", "o_totalprice", 30),
    "histogram_by_group": _histogram("events", "value", 20, "event_type"),
    "scatter_sample": """SELECT l_quantity, l_extendedprice FROM (SELECT l_quantity, l_extendedprice,
 concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS chave FROM lineitem)
ORDER BY md5(chave || '42'), chave LIMIT 10000""",
    "box_stats": f"""SELECT event_type, min(value) AS minimo, {_round('quantile_cont(value, 0.25)', 4)} AS q1,
 {_round('quantile_cont(value, 0.5)', 4)} AS mediana, {_round('quantile_cont(value, 0.75)', 4)} AS q3, max(value) AS maximo
FROM events GROUP BY event_type""",
    "box_stats_whole": f"""SELECT min(o_totalprice) AS minimo, {_round('quantile_cont(o_totalprice, 0.25)', 4)} AS q1,
 {_round('quantile_cont(o_totalprice, 0.5)', 4)} AS mediana, {_round('quantile_cont(o_totalprice, 0.75)', 4)} AS q3,
 max(o_totalprice) AS maximo FROM orders""",
    "chartable_columns": """SELECT 'o_orderkey' AS coluna, 'numerica' AS papel UNION ALL SELECT 'o_custkey', 'numerica'
UNION ALL SELECT 'o_totalprice', 'numerica'
UNION ALL SELECT 'o_orderstatus', 'categorica' FROM orders HAVING count(DISTINCT o_orderstatus) > 1
UNION ALL SELECT 'o_orderpriority', 'categorica' FROM orders HAVING count(DISTINCT o_orderpriority) > 1""",
    "first_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50",
    "partition_scan": "SELECT * FROM months WHERE anomes IN ('199801', '199803', '199912')",
    "partition_scan_single": "SELECT * FROM months WHERE anomes = '199801'",
    "partition_scan_fallback": "SELECT * FROM orders",
    "row_limit": "SELECT count(*) AS linhas FROM (SELECT * FROM orders LIMIT 100)",
    "adhoc_sql": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "explore_distribution": _values("patchy", ["tipo"]),
    "explore_summary": _numbers("patchy", {"valor_denso": "valor_denso"}),
    "conv_context": _MESSAGES,
    "conv_context_lists": f"""SELECT conv_id, posicao // 1000 AS parte, string_agg(role || ':' || content, chr(10) ORDER BY posicao) AS mensagens
FROM ({_MESSAGES}) GROUP BY 1, 2""",
    "conv_questions": "SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS perguntas FROM conversations GROUP BY conv_id",
    "sink_static": _totals(_DOUBLED),
    "sink_dynamic": _totals(f"(SELECT * FROM years WHERE anomes NOT IN ('1998', '1999') UNION ALL SELECT * FROM {_DOUBLED})"),
    "sink_recreate": _totals(_DOUBLED),
    "partition_values": "SELECT DISTINCT anomes AS valor FROM years",
    "registered_files": _totals("years"),
    "ingest_silver": """SELECT * REPLACE (CASE WHEN rating = '' THEN 'nan' ELSE rating END AS rating), 'bronze' AS camada_origem
FROM fx_relationships""",
}

#: The query that states each published view.
_VIEW_QUERIES = {
    "case_riscos_vw_ranking_risco_por_servidor": "rank_server_view",
    "case_riscos_vw_ranking_risco_por_servidor_job": "rank_server_job",
    "case_riscos_vw_detalhe_obsolescencia_por_servidor": "detail_view",
    "case_riscos_vw_detalhe_obsolescencia_por_servidor_job": "detail_job",
    "case_riscos_vw_resumo_risco_por_servidor": "summary_server",
    "case_riscos_vw_resumo_obsolescencia_por_servidor": "summary_sigla",
    "vw_percentual_inconformidade_por_servidor": "pct_nonconform",
    "case_riscos_vw_qtd_servidores_por_farol": "farol2",
    "vw_qtd_servidores_por_farol": "farol3",
    "vw_top10_softwares_prioridade_remediacao": "top10_remediation",
    "case_riscos_vw_ranking_risco_por_sigla": "rank_sigla",
    "case_riscos_vw_top_10_siglas_criticas": "top10_sigla",
    "case_riscos_vw_resumo_risco_por_sigla": "summary_class",
}
_TYPED = f"({FINAL['typed_inference']})"

FINAL |= {
    "published_views": "\nUNION ALL\n".join(
        f"SELECT '{view}' AS visao, concat_ws('|', {', '.join(VIEW_ROWS[view][0])}) AS chave, "
        f"{_round(f'CAST({VIEW_ROWS[view][1]} AS DOUBLE)', 4)} AS valor FROM ({FINAL[name]})"
        for view, name in _VIEW_QUERIES.items()
    ),
    "ingest_ragged": """SELECT CAST(p_partkey AS VARCHAR) AS chave, p_size || '" tela' AS medida,
 p_name || ', "novo"' || chr(10) || p_brand AS "descrição",
 CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE 'nan' END AS unnamed_3,
 CASE WHEN p_partkey % 3 = 0 THEN '5" y' ELSE 'nan' END AS unnamed_4, 'bronze' AS camada_origem FROM part""",
    "ingest_report": """SELECT 'relacoes' AS pasta, 'case_riscos_relacoes' AS tabela, unnest(['2', '3', '4']) AS arquivo,
 unnest(['erro', 'erro', 'vazio']) AS situacao, NULL::BIGINT AS linhas, NULL::INTEGER AS colunas, NULL AS colunas_nulas
UNION ALL SELECT 'relacoes', 'case_riscos_relacoes', '', 'gravado', count(*), 4, '' FROM fx_relationships
UNION ALL SELECT 'ausente', 'case_riscos_ausente', NULL, 'erro', NULL, NULL, NULL""",
    "ingest_last": """SELECT sigla_ss, produto, versao AS "versão", CASE WHEN rating = '' THEN 'nan' ELSE rating END AS rating, 'bronze' AS camada_origem
FROM fx_relationships WHERE length(concat_ws(';', sigla_ss, produto, versao, rating)) % 2 = 1""",
    "list_tables": "SELECT unnest(['arquivos', 'pedidos', 'totais']) AS tabela",
    "partition_keys": "SELECT unnest([0, 1]) AS posicao, unnest(['anomes', 'o_orderstatus']) AS coluna",
    "partition_scan_table": "SELECT * FROM years WHERE anomes IN ('1995', '1997')",
    "clean_names": """SELECT o_orderkey AS "código_do_pedido", o_custkey AS "código_do_pedido_1", o_totalprice AS "preço_r",
 o_orderpriority AS coluna_sem_nome, o_orderdate AS "código_do_pedido_1_1", o_orderstatus AS estado_uf FROM orders""",
    "explore_first_rows": f"SELECT * FROM {_TYPED} ORDER BY id LIMIT 50",
    "explore_bars": """SELECT tipo, count(*) AS quantidade FROM patchy WHERE tipo IS NOT NULL GROUP BY 1
ORDER BY quantidade DESC, tipo LIMIT 5""",
    "explore_histogram": _histogram(f"(SELECT valor_denso, tipo FROM {_TYPED} WHERE valor_denso IS NOT NULL)", "valor_denso", 20, "tipo"),
    "explore_boxes": f"""SELECT tipo, min(valor_denso) AS minimo, {_round('quantile_cont(valor_denso, 0.25)', 4)} AS q1,
 {_round('quantile_cont(valor_denso, 0.5)', 4)} AS mediana, {_round('quantile_cont(valor_denso, 0.75)', 4)} AS q3,
 max(valor_denso) AS maximo FROM {_TYPED} GROUP BY tipo""",
    "explore_chartable": """SELECT unnest(['id', 'valor_denso']) AS coluna, 'numerica' AS papel
UNION ALL SELECT 'tipo_raro', 'categorica' FROM patchy HAVING count(DISTINCT tipo_raro) > 1
UNION ALL SELECT 'valor_falho', 'categorica' FROM patchy HAVING count(DISTINCT valor_falho) > 1
UNION ALL SELECT 'tipo', 'categorica' FROM patchy HAVING count(DISTINCT tipo) > 1""",
}

ORACLE: dict[str, str] = {name: _with(sql) for name, sql in FINAL.items()}
