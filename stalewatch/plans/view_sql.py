"""SQL texts of the views over the gold tables, for views that live in the catalog.

A catalog keeps a view as its SQL text, so each view of :mod:`stalewatch.plans.views` is stated here once more as a text.
Weights, limits and vocabularies come from :mod:`stalewatch.rules` or from the caller when the text is made.
``{gold}`` of a text is the qualified name of a gold table.
"""

from collections.abc import Sequence

from stalewatch import rules
from stalewatch.functions.scores import weight_decimal
from stalewatch.plans import views

_SERVER = ", ".join(views.SERVER)
_PLACE = ", ".join(views.SERVER_PLACE)


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _any_of(expression: str, words: Sequence[str]) -> str:
    return f"{expression} IN ({', '.join(map(text_literal, words))})"


def _weight(value: float) -> str:
    return f"{float(value)!r}D"


def mean(column: str) -> str:
    """Average by :func:`stalewatch.functions.numbers.exact_mean`, as SQL.

    Numbers of up to twelve decimals have an exact sum and a decimal quotient, those with more decimals
    an exact sum of their own, and all others are added as doubles.
    """
    x = f"CAST({column} AS DOUBLE)"
    n = f"nullif(count({column}), 0)"
    short, fine = f"try_cast({x} AS DECIMAL(38,12))", f"try_cast({x} AS DECIMAL(38,25))"
    is_short = f"coalesce(CAST({short} AS DOUBLE) = {x}, false)"
    is_fine = f"(NOT {is_short} AND abs({x}) < 1e6D AND coalesce(CAST({fine} AS DOUBLE) = {x}, false))"

    def total(condition: str, value: str, function: str = "try_sum") -> str:
        return f"{function}({value}) FILTER (WHERE {condition})"

    exact = total(is_short, short)
    quotients = [f"CAST(try_cast({exact} AS DECIMAL({d},12)) / CAST({n} AS DECIMAL(20,0)) AS DOUBLE)" for d in (20, 28, 38)]
    parts = [
        f"coalesce({', '.join(quotients)}, {total(is_short, x, 'sum')} / {n})",
        f"coalesce(CAST({total(is_fine, fine)} / CAST({n} AS DECIMAL(13,0)) AS DOUBLE), {total(is_fine, x, 'sum')} / {n})",
        f"{total(f'NOT {is_short} AND NOT {is_fine}', x, 'sum')} / {n}",
    ]
    return f"CASE WHEN {n} IS NOT NULL THEN {' + '.join(f'coalesce({p}, 0D)' for p in parts)} END"


def decimal_mean(column: str) -> str:
    """Average by :func:`stalewatch.functions.numbers.decimal_mean`, as SQL."""
    x = f"CAST({column} AS DOUBLE)"
    short, fine = f"try_cast({x} AS DECIMAL(38,12))", f"try_cast({x} AS DECIMAL(38,25))"
    is_short = f"coalesce(CAST({short} AS DOUBLE) = {x}, false)"
    is_fine = f"(NOT {is_short} AND abs({x}) < 1e6D AND coalesce(CAST({fine} AS DOUBLE) = {x}, false))"
    total = f"try_cast(try_sum({short}) FILTER (WHERE {is_short}) AS DECIMAL(30,12))"
    others = f"coalesce(sum({x}) FILTER (WHERE {is_fine}), sum({x}) FILTER (WHERE NOT {is_short} AND NOT {is_fine}))"
    return f"CASE WHEN {others} IS NULL THEN {total} / try_cast(nullif(count({column}), 0) AS DECIMAL(12,0)) END"


def _counts(fold: bool) -> str:
    high = _any_of("lower(rating)", rules.HIGH_RATINGS) if fold else _any_of("rating", rules.HIGH_RATINGS_EXACT)
    critical = (
        f"contains(lower(impacto), {text_literal(rules.CRITICAL_FRAGMENT)})"
        if fold
        else _any_of("impacto", rules.CRITICAL_IMPACTS_EXACT)
    )
    return f"count_if({high}) AS qtd_riscos_altos_medios, count_if({critical}) AS qtd_impactos_criticos"


def _measured(keys: str, software: str, products: str, fold: bool, more: str = "") -> str:
    return (
        f"SELECT {keys}, count(DISTINCT software_instalado) AS {software}, count(DISTINCT produto_tecnologico) AS {products}, "
        f"{mean('indice_obsolescencia')} AS media_indice_obsolescencia, {mean('criticidade')} AS media_criticidade, "
        f"{_counts(fold)}{more} FROM {{gold}} GROUP BY {keys}"
    )


def _decimal_sum(terms: Sequence[tuple[str, float]]) -> str:
    return " + ".join(["0BD", *[f"{value} * {weight_decimal(weight)}BD" for value, weight in terms]])


def _term(value: str) -> str:
    return f"try_cast({value} AS DECIMAL(28,18))"


def _as_written(value: str) -> str:
    return f"CASE WHEN CAST({_term(value)} AS DOUBLE) = CAST({value} AS DOUBLE) THEN {_term(value)} END"


def _score(weights: rules.ServerWeights) -> str:
    terms = (
        ("coalesce(media_indice_obsolescencia, 0)", weights.index),
        ("coalesce(media_criticidade, 0)", weights.criticality),
        ("qtd_riscos_altos_medios", weights.high),
        ("qtd_impactos_criticos", weights.critical),
    )
    doubles = " + ".join(["0D", *[f"{value} * {_weight(weight)}" for value, weight in terms]])
    return f"coalesce(CAST({_decimal_sum([(_as_written(value), weight) for value, weight in terms])} AS DOUBLE), {doubles})"


_MEANS = ("media_indice_obsolescencia", "media_criticidade")
_RISKS = ("qtd_riscos_altos_medios", "qtd_impactos_criticos")


def _with_rounded_means(source: str, *columns: str) -> str:
    """The columns of a statement, the two averages rounded."""
    shown = [f"round({c}, 2) AS {c}" if c in _MEANS else c for c in columns]
    return f"SELECT {', '.join(shown)} FROM ({source})"


def server_ranking_of_job(
    weights: rules.ServerWeights = rules.ServerWeights(), limits: rules.ClassLimits = rules.SERVER_LIMITS
) -> str:
    cloud = f", count_if({_any_of('upper(cloud)', rules.CLOUD_WORDS_UPPER)}) AS qtd_itens_cloud"
    measured = _measured(_PLACE, "qtd_softwares_instalados", "qtd_produtos_tecnologicos", False, cloud)
    classes = (
        f"CASE WHEN score_risco_servidor >= {_weight(limits.high)} THEN {text_literal(rules.CLASS_HIGH)} "
        f"WHEN score_risco_servidor >= {_weight(limits.medium)} THEN {text_literal(rules.CLASS_MEDIUM)} ELSE {text_literal(rules.CLASS_LOW)} END"
    )
    return f"SELECT *, {classes} AS classificacao_risco_servidor FROM (SELECT *, {_score(weights)} AS score_risco_servidor FROM ({measured}))"


def server_ranking_of_view(weights: rules.ServerWeights = rules.ServerWeights()) -> str:
    measured = _measured(_PLACE, "qtd_softwares", "qtd_produtos", True)
    scored = f"SELECT *, {_score(weights)} AS score_risco_servidor FROM ({measured})"
    return _with_rounded_means(scored, *views.SERVER_PLACE, "qtd_softwares", "qtd_produtos", *_MEANS, *_RISKS, "score_risco_servidor")


def server_summary() -> str:
    return _measured(_SERVER, "qtd_softwares_instalados", "qtd_produtos_tecnologicos", False)


def sigla_obsolescence_summary() -> str:
    measured = (
        "SELECT sigla_origem, count(DISTINCT servidor) AS qtd_servidores, count(DISTINCT software_instalado) AS qtd_softwares, "
        f"{mean('indice_obsolescencia')} AS media_indice_obsolescencia, {mean('criticidade')} AS media_criticidade, "
        f"{_counts(True)} FROM {{gold}} GROUP BY sigla_origem"
    )
    return _with_rounded_means(measured, "sigla_origem", "qtd_servidores", "qtd_softwares", *_MEANS, *_RISKS)


def _nonconform() -> str:
    return f"(indice_obsolescencia > 0 OR {_any_of('lower(rating)', rules.NONCONFORM_RATINGS)})"


def nonconform_share() -> str:
    return (
        f"SELECT *, round(100.0D * qtd_inconformidades / qtd_total_softwares, 2) AS percentual_inconformidade FROM (SELECT {_SERVER}, "
        f"count(*) AS qtd_total_softwares, count_if({_nonconform()}) AS qtd_inconformidades FROM {{gold}} GROUP BY {_SERVER})"
    )


def servers_by_two_lights() -> str:
    flags = f"SELECT {_SERVER}, max(CASE WHEN {_nonconform()} THEN 1 ELSE 0 END) AS flag_inconforme FROM {{gold}} GROUP BY {_SERVER}"
    light = f"CASE WHEN flag_inconforme = 0 THEN {text_literal(rules.GREEN)} ELSE {text_literal(rules.RED)} END"
    return f"SELECT farol, count(DISTINCT servidor) AS qtd_servidores FROM (SELECT servidor, {light} AS farol FROM ({flags})) GROUP BY farol"


def servers_by_three_lights(limits: rules.LightLimits = rules.LightLimits()) -> str:
    light = (
        f"CASE WHEN percentual_inconformidade <= {_weight(limits.green)} THEN {text_literal(rules.GREEN)} "
        f"WHEN percentual_inconformidade < {_weight(limits.yellow)} THEN {text_literal(rules.YELLOW)} ELSE {text_literal(rules.RED)} END"
    )
    order = ", ".join(map(text_literal, rules.LIGHT_ORDER))
    return (
        "SELECT farol, qtd_servidores, round(100.0D * qtd_servidores / sum(qtd_servidores) OVER (), 2) AS percentual_servidores "
        f"FROM (SELECT {light} AS farol, count(*) AS qtd_servidores FROM ({nonconform_share()}) GROUP BY 1) "
        f"ORDER BY array_position(array({order}), farol)"
    )


def top_software_to_remediate(weights: rules.RemediationWeights = rules.RemediationWeights(), n: int = 10) -> str:
    measured = (
        "SELECT software_instalado, versao, count(DISTINCT servidor) AS qtd_servidores_afetados, count(*) AS qtd_ocorrencias, "
        f"{mean('indice_obsolescencia')} AS media_indice_obsolescencia, {mean('criticidade')} AS media_criticidade, {_counts(True)}, "
        f"{decimal_mean('indice_obsolescencia')} AS decimal_indice_obsolescencia, {decimal_mean('criticidade')} AS decimal_criticidade "
        f"FROM {{gold}} WHERE indice_obsolescencia > 0 OR lower(coalesce(rating, '')) <> {text_literal(rules.UP_TO_DATE)} "
        "GROUP BY software_instalado, versao"
    )
    decimals = [f"CASE WHEN media_{c} IS NULL THEN 0 ELSE decimal_{c} END" for c in ("indice_obsolescencia", "criticidade")]
    terms = (
        ("qtd_servidores_afetados", weights.servers),
        ("qtd_riscos_altos_medios", weights.high),
        ("qtd_impactos_criticos", weights.critical),
        (decimals[0], weights.index),
        (decimals[1], weights.criticality),
    )
    doubles = (
        f"round(0D + qtd_servidores_afetados * {_weight(weights.servers)} + qtd_riscos_altos_medios * {_weight(weights.high)} "
        f"+ qtd_impactos_criticos * {_weight(weights.critical)} + coalesce(media_indice_obsolescencia, 0) * {_weight(weights.index)} "
        f"+ coalesce(media_criticidade, 0) * {_weight(weights.criticality)}, 2)"
    )
    score = f"coalesce(CAST(round(round({_decimal_sum([(_term(value), weight) for value, weight in terms])}, 14), 2) AS DOUBLE), {doubles})"
    columns = ("software_instalado", "versao", "qtd_servidores_afetados", "qtd_ocorrencias", *_MEANS, *_RISKS, "score_prioridade_remediacao")
    scored = _with_rounded_means(f"SELECT *, {score} AS score_prioridade_remediacao FROM ({measured})", *columns)
    return f"{scored} ORDER BY score_prioridade_remediacao DESC NULLS LAST, software_instalado NULLS LAST, versao NULLS LAST LIMIT {n}"


def server_detail_of_job(columns: Sequence[str]) -> str:
    """``columns`` are those of the gold table, with or without match labels and a processing time."""
    tail = ("tipo_match_catalogo", "tipo_match_relacionamento", "detalhe_cabecalho", "data_processamento", "anomes")
    if "tipo_match_catalogo" not in columns:
        tail = ("detalhe_cabecalho", "data_processamento")
    return f"SELECT {', '.join([*views.DETAIL_OF_JOB, *[c for c in tail if c in columns]])} FROM {{gold}}"


def server_detail_of_view() -> str:
    return f"SELECT {', '.join(views.DETAIL_OF_VIEW)} FROM {{gold}}"


_BEST_SIGLAS = "ORDER BY score_risco_operacional DESC NULLS LAST, sigla NULLS LAST"


def sigla_ranking() -> str:
    return f"SELECT {', '.join(views.SIGLA_RANKING)} FROM {{gold}} {_BEST_SIGLAS}"


def top_critical_siglas(n: int = 10) -> str:
    return f"SELECT {', '.join(views.TOP_SIGLAS)} FROM {{gold}} {_BEST_SIGLAS} LIMIT {n}"


def summary_by_class() -> str:
    return (
        f"SELECT classificacao_risco, count(*) AS qtd_siglas, round({mean('score_risco_operacional')}, 2) AS score_medio, "
        "sum(qtd_produtos_tecnologicos) AS qtd_produtos_tecnologicos, sum(qtd_servidores) AS qtd_servidores "
        "FROM {gold} GROUP BY classificacao_risco"
    )
