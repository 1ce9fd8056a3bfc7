"""Gold table of technology risk by sigla."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stalewatch import rules
from stalewatch.functions.flags import count_true, has_fragment, in_words
from stalewatch.functions.keys import basic_key, blank_to_null
from stalewatch.functions.numbers import exact_mean
from stalewatch.functions.scores import risk_class, sigla_score
from stalewatch.operators.cleaning import treat_risks
from stalewatch.operators.joins import left_lookup


def _sigla_key(clean: bool) -> Column:
    return basic_key(blank_to_null(F.col("sigla")) if clean else F.col("sigla"))


def aggregate_risks(treated: DataFrame) -> DataFrame:
    """Counts and averages of the treated risk table by sigla."""
    return treated.groupBy("sigla_join").agg(
        F.countDistinct("produto").alias("qtd_produtos_tecnologicos"),
        F.count(F.lit(1)).alias("qtd_relacionamentos_tecnologia"),
        exact_mean(F.col("indice_obsolescencia_num")).alias("media_indice_obsolescencia"),
        exact_mean(F.col("criticidade_num")).alias("media_criticidade"),
        F.sum(F.col("flag_risco_alto").cast("bigint")).alias("qtd_riscos_altos_medios"),
        F.sum(F.col("flag_critico").cast("bigint")).alias("qtd_impactos_criticos"),
        F.sum(F.col("flag_cloud").cast("bigint")).alias("qtd_itens_cloud"),
    )


def aggregate_servers(servers: DataFrame, clean: bool = False) -> DataFrame:
    """Server counts by sigla."""
    return servers.groupBy(_sigla_key(clean).alias("sigla_join")).agg(
        F.countDistinct("nome").alias("qtd_servidores"),
        F.countDistinct("arquitetura").alias("qtd_tipos_arquitetura"),
        count_true(has_fragment(F.col("ambiente"), rules.PRODUCTION_FRAGMENT)).alias("qtd_servidores_producao"),
        count_true(in_words(F.col("status_operacional"), (rules.OPERATIONAL_WORD,))).alias(
            "qtd_servidores_operacionais"
        ),
    )


def software_per_server(instances: DataFrame) -> DataFrame:
    """Distinct software by server key."""
    return instances.groupBy(basic_key(F.col("installed_on")).alias("nome_servidor_join")).agg(
        F.countDistinct("software").alias("qtd_softwares_instalados")
    )


def aggregate_software(instances: DataFrame, servers: DataFrame, clean: bool = False) -> DataFrame:
    """Average software per server by sigla; servers without software are left out of the average."""
    keyed = servers.select(_sigla_key(clean).alias("sigla_join"), basic_key(F.col("nome")).alias("nome_servidor_join"))
    counted = left_lookup(keyed, software_per_server(instances), ["nome_servidor_join"])
    return counted.groupBy("sigla_join").agg(F.avg("qtd_softwares_instalados").alias("media_softwares_por_servidor"))


def join_and_score(
    risks_by_sigla: DataFrame,
    servers_by_sigla: DataFrame,
    software_by_sigla: DataFrame,
    period: str = rules.DEFAULT_PERIOD,
    weights: rules.SiglaWeights = rules.SiglaWeights(),
    limits: rules.ClassLimits = rules.SIGLA_LIMITS,
    null_as_zero: bool = False,
    audit: bool = True,
) -> DataFrame:
    """One row per sigla of the risk side, scored and classified."""
    joined = left_lookup(left_lookup(risks_by_sigla, servers_by_sigla, ["sigla_join"]), software_by_sigla, ["sigla_join"])
    score = sigla_score(
        F.col("qtd_riscos_altos_medios"),
        F.col("qtd_impactos_criticos"),
        F.col("media_indice_obsolescencia"),
        F.col("qtd_servidores_producao"),
        weights,
        null_as_zero,
    )
    scored = joined.withColumnRenamed("sigla_join", "sigla").withColumn("score_risco_operacional", score)
    scored = scored.withColumn("classificacao_risco", risk_class(F.col("score_risco_operacional"), limits))
    if audit:
        scored = scored.withColumn("data_processamento", F.current_timestamp())
    return scored.withColumn("anomes", F.lit(period))


def build_sigla_gold(
    risks: DataFrame,
    servers: DataFrame,
    instances: DataFrame,
    nan_policy: str = "null",
    clean: bool = False,
    **scoring,
) -> DataFrame:
    """Gold by sigla from the raw risk, server and software tables."""
    return join_and_score(
        aggregate_risks(treat_risks(risks, nan_policy, clean)),
        aggregate_servers(servers, clean),
        aggregate_software(instances, servers, clean),
        **scoring,
    )
