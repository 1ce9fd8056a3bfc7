"""Analytic hub by server and the non-conformity control."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stalewatch import rules
from stalewatch.functions.flags import count_true, is_nonconform
from stalewatch.functions.labels import or_default, positional_header
from stalewatch.functions.numbers import round_half_up
from stalewatch.functions.scores import light_by_percent
from stalewatch.operators.cleaning import prepare_dim_produtos, prepare_dim_siglas, prepare_server_gold
from stalewatch.operators.dedup import distinct_rows
from stalewatch.operators.joins import left_lookup


def build_hub(
    gold: DataFrame,
    query1: DataFrame,
    query2: DataFrame,
    period: str = rules.DEFAULT_PERIOD,
    clean: bool = False,
) -> DataFrame:
    """Hub rows of the server gold with sigla and product attributes.

    The dimensions are joined without a broadcast hint: Spark broadcasts them while their measured
    size is under its threshold and shuffles them otherwise.
    """
    with_sigla = left_lookup(prepare_server_gold(gold), prepare_dim_siglas(query1, clean), ["sigla_join"])
    rows = left_lookup(with_sigla, prepare_dim_produtos(query2, clean), ["produto_join"])
    labelled = [F.concat(F.lit(f"{c}="), or_default(F.col(c), "")) for c in ("sigla_origem", "ambiente", "arquitetura")]
    detail = positional_header(
        F.coalesce("produto_tecnologico", "software_catalogado", "software_instalado"),
        *[
            F.col(c)
            for c in (
                "versao",
                "status_relacionamento",
                "criticidade",
                "indice_obsolescencia",
                "rating",
                "impacto",
                "cloud",
                "nome_produto",
                "pillar",
                "dominio",
                "subdominio",
            )
        ],
        *labelled,
    )
    conformity = F.when(is_nonconform(F.col("indice_obsolescencia"), F.col("rating")), rules.NONCONFORM)
    # Only columns that can differ take part in the distinct; the constant ones follow.
    differing = rows.select(
        F.col("servidor").alias("Chave"),
        F.col("descricao_servidor").alias("Descricao_chave"),
        or_default(F.col("criticidade_tier"), rules.NOT_INFORMED).alias("Criticidade"),
        or_default(F.col("diretoria"), rules.NOT_INFORMED).alias("Diretoria"),
        or_default(F.col("comunidade"), rules.NOT_INFORMED).alias("Comunidade"),
        conformity.otherwise(rules.CONFORM).alias("Conformidade"),
        detail.alias("Detalhe_Cabecalho"),
    )
    return distinct_rows(differing).select(
        F.lit(rules.HUB_INDICATOR).alias("INDICADOR"),
        F.lit(rules.HUB_CATCH_NAME).alias("Nome_Catch"),
        "Chave",
        F.lit(rules.KEY_KIND).alias("Tipo_chave"),
        "Descricao_chave",
        "Criticidade",
        "Diretoria",
        "Comunidade",
        "Conformidade",
        F.lit(rules.HUB_HEADER_NAME).alias("Nome_Cabecalho"),
        "Detalhe_Cabecalho",
        F.lit(period).alias("anomes"),
    )


def build_control(
    hub: DataFrame,
    period: str = rules.DEFAULT_PERIOD,
    limits: rules.LightLimits = rules.LightLimits(),
    audit: bool = True,
) -> DataFrame:
    """One row: totals, share of non-conform rows and its traffic light.

    Over an empty hub the non-conform total and the share are null and the light is red.
    """
    nonconform = count_true(F.col("Conformidade") == rules.NONCONFORM)
    totals = hub.agg(F.count(F.lit(1)).alias("total_registros"), nonconform.alias("__n")).select(
        "total_registros", F.when(F.col("total_registros") > 0, F.col("__n")).alias("total_inconformes")
    )
    share = round_half_up(F.try_divide(F.col("total_inconformes"), F.col("total_registros")) * 100)
    control = totals.withColumn("percentual_inconformidade", share).withColumns(
        {
            "farol": light_by_percent(F.col("percentual_inconformidade"), limits),
            "criterio_farol": F.lit(rules.LIGHT_CRITERION),
        }
    )
    if audit:
        control = control.withColumn("data_processamento", F.current_timestamp())
    return control.withColumn("anomes", F.lit(period))
