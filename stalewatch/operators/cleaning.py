"""Cleaning projections of the inventory tables.

``generation`` selects how the join keys are made: 1 uses the basic key throughout, 2 the strong key
except for servers, 3 the strong key throughout and the extra version keys.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stalewatch import rules
from stalewatch.functions.flags import as_flag, has_fragment, in_words
from stalewatch.functions.keys import basic_key, blank_to_null, joined_key, strong_key
from stalewatch.functions.numbers import decimal_comma
from stalewatch.operators.dedup import one_row_per_key


def _cleaned(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[blank_to_null(F.col(source)).alias(target) for target, source in mapping.items()])


def _key(generation: int, strong_from: int):
    if generation not in (1, 2, 3):
        raise ValueError(f"unknown generation: {generation}")
    return strong_key if generation >= strong_from else basic_key


def treat_risks(df: DataFrame, nan_policy: str = "null", clean: bool = False) -> DataFrame:
    """Risk table with its sigla key, numeric index and criticality, and 0/1 flags.

    The key is taken from the raw text unless ``clean``, so the text 'nan' is a key like any other.
    """
    sigla = blank_to_null(F.col("sigla_ss")) if clean else F.col("sigla_ss")
    return df.withColumns(
        {
            "sigla_join": basic_key(sigla),
            "indice_obsolescencia_num": decimal_comma(F.col("indice_obsolescencia"), nan_policy, strip=False),
            "criticidade_num": decimal_comma(F.col("criticidade"), nan_policy, strip=False),
            "flag_risco_alto": as_flag(in_words(F.col("rating"), rules.HIGH_RATINGS)),
            "flag_critico": as_flag(has_fragment(F.col("impacto"), rules.CRITICAL_FRAGMENT)),
            "flag_cloud": as_flag(in_words(F.col("cloud"), rules.CLOUD_WORDS)),
        }
    )


def treat_servers(df: DataFrame, generation: int = 3) -> DataFrame:
    key = _key(generation, 3)
    cleaned = _cleaned(
        df,
        {
            "servidor": "nome",
            "arquitetura": "arquitetura",
            "status_servidor": "status",
            "status_operacional": "status_operacional",
            "ambiente": "ambiente",
            "sigla_origem": "sigla",
        },
    )
    return cleaned.withColumns({"servidor_join": key(F.col("servidor")), "sigla_join": key(F.col("sigla_origem"))})


def treat_software_instances(df: DataFrame, generation: int = 3) -> DataFrame:
    key = _key(generation, 2)
    cleaned = _cleaned(
        df,
        {
            "servidor_instancia": "installed_on",
            "software_instalado": "software",
            "anomesdia_software_instance": "anomesdia",
        },
    )
    return cleaned.withColumns(
        {"servidor_join": key(F.col("servidor_instancia")), "software_join": key(F.col("software_instalado"))}
    )


def treat_software_catalog(df: DataFrame, generation: int = 3, dedup: bool = True) -> DataFrame:
    """Software catalogue with its keys; generation 3 keeps one row per (package, name, version) key."""
    key = _key(generation, 2)
    cleaned = _cleaned(
        df,
        {
            "model_id": "model_id",
            "nome_software_catalogo": "name",
            "versao_catalogo": "version",
            "anomesdia_catalogo": "anomesdia",
        },
    )
    name, version = F.col("nome_software_catalogo"), F.col("versao_catalogo")
    keys: dict[str, Column] = {"name_join": key(name), "model_join": key(F.col("model_id"))}
    if generation >= 2:
        keys["software_catalogo_join"] = joined_key(name, version)
    if generation >= 3:
        keys["version_join"] = key(version)
    result = cleaned.withColumns(keys)
    if generation >= 3 and dedup:
        survivors = ["nome_software_catalogo", "versao_catalogo", "model_id", "model_join", "anomesdia_catalogo"]
        wanted = ["software_catalogo_join", "name_join", "version_join"]
        return one_row_per_key(result.select(*wanted, *survivors), wanted).select(*result.columns)
    return result


def treat_relationships(df: DataFrame, generation: int = 3, nan_policy: str = "null") -> DataFrame:
    key = _key(generation, 2)
    texts = {
        "sigla_relacionamento": "sigla_ss",
        "produto_tecnologico": "produto",
        "versao_relacionamento": "versao",
        "status_relacionamento": "status",
    }
    ratings = ("rating", "impacto", "cloud")
    cleaned = df.select(
        *[blank_to_null(F.col(source)).alias(target) for target, source in texts.items()],
        *[decimal_comma(F.col(c), nan_policy).alias(c) for c in ("criticidade", "indice_obsolescencia")],
        *[blank_to_null(F.col(c)).alias(c) for c in ratings],
    )
    product, version = F.col("produto_tecnologico"), F.col("versao_relacionamento")
    keys = {"sigla_join": key(F.col("sigla_relacionamento")), "produto_join": key(product)}
    if generation >= 3:
        keys["versao_join"] = key(version)
    if generation >= 2:
        keys["produto_versao_join"] = joined_key(product, version)
    return cleaned.withColumns(keys)


def prepare_dim_siglas(df: DataFrame, clean: bool = False) -> DataFrame:
    """Sigla dimension: tier, directorate and community, one row per key."""
    value = (lambda c: blank_to_null(F.col(c))) if clean else F.col
    dim = df.select(
        basic_key(value("sigla_ss")).alias("sigla_join"),
        value("criticidade_final").alias("criticidade_tier"),
        value("diretoria").alias("diretoria"),
        value("comunidade").alias("comunidade"),
    )
    return one_row_per_key(dim.filter(F.col("sigla_join").isNotNull()), ["sigla_join"])


def prepare_dim_produtos(df: DataFrame, clean: bool = False) -> DataFrame:
    """Product dimension: name, pillar, domain and subdomain, one row per key."""
    value = (lambda c: blank_to_null(F.col(c))) if clean else F.col
    dim = df.select(
        basic_key(value("nome")).alias("produto_join"),
        value("nome").alias("nome_produto"),
        *[value(c).alias(c) for c in ("pillar", "dominio", "subdominio")],
    )
    return one_row_per_key(dim.filter(F.col("produto_join").isNotNull()), ["produto_join"])


def prepare_server_gold(df: DataFrame) -> DataFrame:
    """Server gold with the keys of both dimensions."""
    product = F.coalesce("produto_tecnologico", "software_catalogado", "software_instalado")
    return df.withColumns({"sigla_join": basic_key(F.col("sigla_origem")), "produto_join": basic_key(product)})
