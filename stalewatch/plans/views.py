"""Analytic views over the gold tables, as functions from DataFrame to DataFrame.

Two rankings and two details exist under one name each in the model; here every definition has its
own function.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stalewatch import rules
from stalewatch.functions.flags import as_flag, count_true, has_fragment, in_words, is_nonconform, needs_remediation
from stalewatch.functions.numbers import decimal_mean, exact_mean, round_half_up
from stalewatch.functions.scores import (
    light_by_flag,
    light_by_percent,
    light_position,
    remediation_score,
    risk_class,
    server_score,
)

SERVER = ("servidor", "sigla_origem")
SERVER_PLACE = (*SERVER, "ambiente", "arquitetura")


def _average(column: str, rounded: bool) -> Column:
    mean = exact_mean(F.col(column))
    return (round_half_up(mean) if rounded else mean).alias(f"media_{column}")


def _high_and_critical(fold: bool) -> list[Column]:
    """Counts of high or medium ratings and of critical impacts, in the folded or the exact reading."""
    rating, impact = F.col("rating"), F.col("impacto")
    high = in_words(rating, rules.HIGH_RATINGS) if fold else in_words(rating, rules.HIGH_RATINGS_EXACT, None)
    critical = (
        has_fragment(impact, rules.CRITICAL_FRAGMENT)
        if fold
        else in_words(impact, rules.CRITICAL_IMPACTS_EXACT, None)
    )
    return [count_true(high).alias("qtd_riscos_altos_medios"), count_true(critical).alias("qtd_impactos_criticos")]


def _distinct(column: str, name: str) -> Column:
    return F.countDistinct(column).alias(name)


def _score_columns() -> tuple[Column, ...]:
    names = ("media_indice_obsolescencia", "media_criticidade", "qtd_riscos_altos_medios", "qtd_impactos_criticos")
    return tuple(F.col(n) for n in names)


def server_ranking_of_job(
    gold: DataFrame,
    weights: rules.ServerWeights = rules.ServerWeights(),
    limits: rules.ClassLimits = rules.SERVER_LIMITS,
) -> DataFrame:
    """Risk by server and place: exact vocabularies, raw averages, cloud count, score and class."""
    measured = gold.groupBy(*SERVER_PLACE).agg(
        _distinct("software_instalado", "qtd_softwares_instalados"),
        _distinct("produto_tecnologico", "qtd_produtos_tecnologicos"),
        _average("indice_obsolescencia", False),
        _average("criticidade", False),
        *_high_and_critical(fold=False),
        count_true(in_words(F.col("cloud"), rules.CLOUD_WORDS_UPPER, "upper")).alias("qtd_itens_cloud"),
    )
    scored = measured.withColumn("score_risco_servidor", server_score(*_score_columns(), weights))
    return scored.withColumn("classificacao_risco_servidor", risk_class(F.col("score_risco_servidor"), limits))


def server_ranking_of_view(gold: DataFrame, weights: rules.ServerWeights = rules.ServerWeights()) -> DataFrame:
    """Risk by server and place: folded vocabularies, rounded averages, score over the raw averages."""
    measured = gold.groupBy(*SERVER_PLACE).agg(
        _distinct("software_instalado", "qtd_softwares"),
        _distinct("produto_tecnologico", "qtd_produtos"),
        _average("indice_obsolescencia", False),
        _average("criticidade", False),
        *_high_and_critical(fold=True),
    )
    scored = measured.withColumn("score_risco_servidor", server_score(*_score_columns(), weights))
    return scored.withColumns(
        {c: round_half_up(F.col(c)) for c in ("media_indice_obsolescencia", "media_criticidade")}
    )


def server_summary(gold: DataFrame) -> DataFrame:
    """Risk measures by server and sigla."""
    return gold.groupBy(*SERVER).agg(
        _distinct("software_instalado", "qtd_softwares_instalados"),
        _distinct("produto_tecnologico", "qtd_produtos_tecnologicos"),
        _average("indice_obsolescencia", False),
        _average("criticidade", False),
        *_high_and_critical(fold=False),
    )


def sigla_obsolescence_summary(gold: DataFrame) -> DataFrame:
    """Obsolescence measures of the server gold by sigla."""
    return gold.groupBy("sigla_origem").agg(
        _distinct("servidor", "qtd_servidores"),
        _distinct("software_instalado", "qtd_softwares"),
        _average("indice_obsolescencia", True),
        _average("criticidade", True),
        *_high_and_critical(fold=True),
    )


def nonconform_share(gold: DataFrame) -> DataFrame:
    """Rows, non-conform rows and their percentage by server and sigla."""
    broken = count_true(is_nonconform(F.col("indice_obsolescencia"), F.col("rating")))
    counted = gold.groupBy(*SERVER).agg(
        F.count(F.lit(1)).alias("qtd_total_softwares"), broken.alias("qtd_inconformidades")
    )
    share = F.lit(100.0) * F.col("qtd_inconformidades") / F.col("qtd_total_softwares")
    return counted.withColumn("percentual_inconformidade", round_half_up(share))


def server_flags(gold: DataFrame) -> DataFrame:
    """1 for every server and sigla with a non-conform row, else 0, and the two-class light."""
    flag = as_flag(is_nonconform(F.col("indice_obsolescencia"), F.col("rating")))
    flagged = gold.groupBy(*SERVER).agg(F.max(flag).alias("flag_inconforme"))
    return flagged.withColumn("farol", light_by_flag(F.col("flag_inconforme")))


def servers_by_two_lights(gold: DataFrame) -> DataFrame:
    """Distinct servers per two-class light; a server with several siglas can count under both."""
    return server_flags(gold).groupBy("farol").agg(_distinct("servidor", "qtd_servidores"))


def servers_by_three_lights(gold: DataFrame, limits: rules.LightLimits = rules.LightLimits()) -> DataFrame:
    """Servers per three-class light with their share of all, green first."""
    lights = nonconform_share(gold).select(light_by_percent(F.col("percentual_inconformidade"), limits).alias("farol"))
    counted = lights.groupBy("farol").agg(F.count(F.lit(1)).alias("qtd_servidores"))
    # At most three rows reach this window.
    everything = F.sum("qtd_servidores").over(Window.partitionBy())
    share = round_half_up(F.lit(100.0) * F.col("qtd_servidores") / everything)
    return counted.withColumn("percentual_servidores", share).orderBy(light_position(F.col("farol")))


def software_remediation(
    gold: DataFrame, weights: rules.RemediationWeights = rules.RemediationWeights()
) -> DataFrame:
    """Priority measures by installed software and version over the rows that need remediation.

    The score is added in decimals, so that an exact tie is rounded up; in doubles only where they do not hold the numbers.
    """
    affected = gold.filter(needs_remediation(F.col("indice_obsolescencia"), F.col("rating")))
    measured = affected.groupBy("software_instalado", "versao").agg(
        _distinct("servidor", "qtd_servidores_afetados"),
        F.count(F.lit(1)).alias("qtd_ocorrencias"),
        _average("indice_obsolescencia", False),
        _average("criticidade", False),
        *_high_and_critical(fold=True),
        *[decimal_mean(F.col(c)).alias(f"decimal_{c}") for c in ("indice_obsolescencia", "criticidade")],
    )
    index, criticality, high, critical = _score_columns()
    terms = (F.col("qtd_servidores_afetados"), high, critical)
    decimals = [F.when(c.isNull(), 0).otherwise(F.col(f"decimal_{n}")) for c, n in ((index, "indice_obsolescencia"), (criticality, "criticidade"))]
    known = decimals[0].isNotNull() & decimals[1].isNotNull()
    # Quotients end after 18 places; what they lack is far behind the 14th.
    exact = F.round(remediation_score(*terms, *decimals, weights, exact=True), 14)
    score = remediation_score(*terms, index, criticality, weights)
    rounded = F.coalesce(F.when(known, round_half_up(exact).cast("double")), round_half_up(score))
    scored = measured.withColumn("score_prioridade_remediacao", rounded).drop("decimal_indice_obsolescencia", "decimal_criticidade")
    return scored.withColumns(
        {c: round_half_up(F.col(c)) for c in ("media_indice_obsolescencia", "media_criticidade")}
    )


def top_software_to_remediate(gold: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` software versions of highest priority; equal scores by software and version."""
    return (
        software_remediation(gold)
        .orderBy(
            F.col("score_prioridade_remediacao").desc_nulls_last(),
            F.col("software_instalado").asc_nulls_last(),
            F.col("versao").asc_nulls_last(),
        )
        .limit(n)
    )


DETAIL_OF_JOB = (
    "servidor",
    "tipo_chave",
    "descricao_servidor",
    "sigla_origem",
    "ambiente",
    "arquitetura",
    "status_servidor",
    "status_operacional",
    "software_instalado",
    "software_catalogado",
    "versao",
    "produto_tecnologico",
    "criticidade",
    "indice_obsolescencia",
    "rating",
    "impacto",
    "cloud",
)
DETAIL_OF_VIEW = (
    "servidor",
    "sigla_origem",
    "ambiente",
    "arquitetura",
    "software_instalado",
    "software_catalogado",
    "versao",
    "produto_tecnologico",
    "criticidade",
    "indice_obsolescencia",
    "rating",
    "impacto",
    "cloud",
    "detalhe_cabecalho",
)


def server_detail_of_job(gold: DataFrame) -> DataFrame:
    """Detail columns the gold job publishes: match labels and period only for the ranked gold.

    The processing time is included where the frame has it.
    """
    if "tipo_match_catalogo" in gold.columns:
        tail = ("tipo_match_catalogo", "tipo_match_relacionamento", "detalhe_cabecalho", "data_processamento", "anomes")
    else:
        tail = ("detalhe_cabecalho", "data_processamento")
    return gold.select(*DETAIL_OF_JOB, *[c for c in tail if c in gold.columns])


def server_detail_of_view(gold: DataFrame) -> DataFrame:
    return gold.select(*DETAIL_OF_VIEW)


SIGLA_RANKING = (
    "sigla",
    "qtd_produtos_tecnologicos",
    "qtd_relacionamentos_tecnologia",
    "media_indice_obsolescencia",
    "media_criticidade",
    "qtd_riscos_altos_medios",
    "qtd_impactos_criticos",
    "qtd_itens_cloud",
    "qtd_servidores",
    "qtd_tipos_arquitetura",
    "qtd_servidores_producao",
    "qtd_servidores_operacionais",
    "media_softwares_por_servidor",
    "score_risco_operacional",
    "classificacao_risco",
)
TOP_SIGLAS = (
    "sigla",
    "score_risco_operacional",
    "classificacao_risco",
    "qtd_produtos_tecnologicos",
    "qtd_riscos_altos_medios",
    "qtd_impactos_criticos",
    "media_indice_obsolescencia",
    "qtd_servidores",
)
_BY_SIGLA_SCORE = ("score_risco_operacional", "sigla")


def _highest_first(df: DataFrame) -> DataFrame:
    score, sigla = _BY_SIGLA_SCORE
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(sigla).asc_nulls_last())


def sigla_ranking(sigla_gold: DataFrame) -> DataFrame:
    """All siglas, highest score first."""
    return _highest_first(sigla_gold.select(*SIGLA_RANKING))


def top_critical_siglas(sigla_gold: DataFrame, n: int = 10) -> DataFrame:
    return _highest_first(sigla_gold.select(*TOP_SIGLAS)).limit(n)


def summary_by_class(sigla_gold: DataFrame) -> DataFrame:
    """Siglas, average score and totals by risk class."""
    return sigla_gold.groupBy("classificacao_risco").agg(
        F.count(F.lit(1)).alias("qtd_siglas"),
        round_half_up(exact_mean(F.col("score_risco_operacional"))).alias("score_medio"),
        F.sum("qtd_produtos_tecnologicos").alias("qtd_produtos_tecnologicos"),
        F.sum("qtd_servidores").alias("qtd_servidores"),
    )
