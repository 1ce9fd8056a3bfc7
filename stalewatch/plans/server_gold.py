"""Gold table of obsolescence by server, in the three strategies of matching."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stalewatch import rules
from stalewatch.functions.labels import labelled_header, or_default
from stalewatch.operators.cleaning import (
    treat_relationships,
    treat_servers,
    treat_software_catalog,
    treat_software_instances,
)
from stalewatch.operators.dedup import distinct_rows
from stalewatch.operators.joins import join_many, left_join_many
from stalewatch.operators.linking import RELATIONSHIP_COLUMNS, ranked_cascade

STRATEGIES = {"name": 1, "exact": 2, "cascade": 3}
_MATCH_COLUMNS = (
    "tipo_match_catalogo",
    "tipo_match_relacionamento",
    "prioridade_match_catalogo",
    "prioridade_match_relacionamento",
)


_SERVER_COLUMNS = ("sigla_origem", "arquitetura", "status_servidor", "status_operacional", "ambiente")


def _description() -> list[Column]:
    """Columns of the gold table that the catalogue and the relationships add to an installed software."""
    return [
        F.col("nome_software_catalogo").alias("software_catalogado"),
        F.coalesce("versao_catalogo", "versao_relacionamento").alias("versao"),
        *[F.col(c) for c in RELATIONSHIP_COLUMNS if c != "versao_relacionamento"],
    ]


def _facts(linked: DataFrame) -> DataFrame:
    """The columns of the ranked gold table from which all others follow."""
    return linked.select("servidor", *_SERVER_COLUMNS, "software_instalado", *_description(), *_MATCH_COLUMNS)


def _distinct_facts(installed: DataFrame, linked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct facts of all installed software; ``linked`` has every combination of its ``keys`` at least once.

    Rows are made distinct for each combination of keys, before they meet the servers: servers, and software on one
    server, are distinct by themselves, and their keys follow from columns of the gold table.
    """
    described = distinct_rows(linked.select(*keys, *_description()))
    columns = [c for c in described.columns if c not in keys]
    return join_many(installed, described.hint("merge"), keys, null_safe=True).select(
        "servidor", *_SERVER_COLUMNS, "software_instalado", *columns
    )


def _shape(facts: DataFrame, period: str, audit: bool, ranked: bool) -> DataFrame:
    """Output columns of the gold table."""

    def shown(column: str) -> Column:
        return or_default(F.col(column), rules.NOT_AVAILABLE)

    header = {
        "servidor": F.col("servidor"),
        "sigla_origem": F.col("sigla_origem"),
        "software": shown("software_instalado"),
        **({"software_catalogado": shown("software_catalogado")} if ranked else {}),
        "produto_tecnologico": shown("produto_tecnologico"),
        "versao": shown("versao"),
        **({c: F.col(c) for c in ("tipo_match_catalogo", "tipo_match_relacionamento")} if ranked else {}),
    }
    constants = [F.lit(rules.GOLD_LAYER).alias("camada"), F.lit(period).alias("anomes")]
    if audit:
        constants.insert(0, F.current_timestamp().alias("data_processamento"))
    return facts.select(
        "servidor",
        F.lit(rules.KEY_KIND).alias("tipo_chave"),
        F.col("servidor").alias("descricao_servidor"),
        *[c for c in facts.columns if c != "servidor"],
        labelled_header(header).alias("detalhe_cabecalho"),
        *constants,
    )


def _installed_everywhere(servers: DataFrame, instances: DataFrame, stage) -> DataFrame:
    """Every distinct server row with every distinct installed software.

    The raw instances are read once. Files of few different values are small for their rows, so the joins over them are
    told to shuffle; Spark would broadcast millions of rows.
    """
    installed = stage(instances.select("servidor_join", "software_instalado", "software_join").distinct())
    return stage(left_join_many(servers.distinct(), installed.hint("merge"), ["servidor_join"]))


def _link_by_name(servers, instances, catalog, relationships, stage) -> DataFrame:
    """Software text equals the catalogue name; model equals the product, for any sigla."""
    packages = catalog.select(
        F.col("name_join").alias("software_join"), "nome_software_catalogo", "versao_catalogo", "model_join"
    ).distinct()
    products = relationships.select(F.col("produto_join").alias("model_join"), *RELATIONSHIP_COLUMNS).distinct()
    installed = _installed_everywhere(servers, instances, stage)
    texts = stage(installed.select("software_join").distinct())
    packaged = stage(left_join_many(texts, packages, ["software_join"]))
    linked = left_join_many(packaged, products, ["model_join"])
    return _distinct_facts(installed, linked, ["software_join"])


def _link_exactly(servers, instances, catalog, relationships, stage) -> DataFrame:
    """Software text equals name and version; product, with or without version, equal within the sigla.

    The four alternatives of the second link become lookups by (kind, key) for each distinct
    combination of sigla, software text and catalogue keys.
    """
    packages = catalog.select(
        F.nullif("software_catalogo_join", F.lit("")).alias("software_join"),
        "nome_software_catalogo",
        "versao_catalogo",
        "name_join",
        F.col("software_catalogo_join"),
    ).distinct()
    installed = _installed_everywhere(servers, instances, stage)
    pairs = stage(installed.select("sigla_join", "software_join").distinct())
    base = stage(left_join_many(pairs, packages, ["software_join"]))

    def keys(*pairs: tuple[str, Column]) -> Column:
        tagged = [
            F.when(c != "", F.struct(F.lit(kind).alias("__kind"), c.alias("__key"))) for kind, c in pairs
        ]
        return F.inline(F.array_distinct(F.array_compact(F.array(*tagged))))

    profile = ["sigla_join", "software_join", "name_join", "software_catalogo_join"]
    wanted = base.select(*profile).distinct().filter(F.col("sigla_join").isNotNull())
    wanted = wanted.select(
        *profile,
        keys(
            ("product", F.col("name_join")),
            ("product+version", F.col("software_catalogo_join")),
            ("product", F.col("software_join")),
            ("product+version", F.col("software_join")),
        ),
    )
    offered = relationships.select(
        "sigla_join",
        *RELATIONSHIP_COLUMNS,
        keys(("product", F.col("produto_join")), ("product+version", F.col("produto_versao_join"))),
    ).distinct()
    links = (
        wanted.join(offered.hint("merge"), ["sigla_join", "__kind", "__key"])
        .select(*profile, *RELATIONSHIP_COLUMNS)
        .distinct()
    )
    linked = left_join_many(base, stage(links).hint("merge"), profile, null_safe=True)
    return _distinct_facts(installed, linked, ["sigla_join", "software_join"])


def build_server_gold(
    servers: DataFrame,
    instances: DataFrame,
    catalog: DataFrame,
    relationships: DataFrame,
    strategy: str = "cascade",
    period: str = rules.DEFAULT_PERIOD,
    nan_policy: str = "null",
    min_chars: int = rules.MIN_NEEDLE_CHARS,
    extra_partition: Sequence[str] = (),
    audit: bool = True,
    stage=lambda df: df,
) -> DataFrame:
    """Gold by server from the four raw inventory tables.

    ``strategy`` is 'name', 'exact' or 'cascade'. ``extra_partition=["sigla_join"]`` keeps one row per
    server, sigla and software instead of one per server and software (cascade only).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    generation = STRATEGIES[strategy]
    treated = (
        treat_servers(servers, generation),
        treat_software_instances(instances, generation),
        treat_software_catalog(catalog, generation, dedup=False),
        treat_relationships(relationships, generation, nan_policy),
    )
    if strategy == "cascade":
        # One row per (server key, software key) by construction, so no distinct is needed.
        facts = _facts(ranked_cascade(*treated, min_chars, extra_partition, stage))
        return _shape(facts, period, audit, ranked=True)
    link = _link_by_name if strategy == "name" else _link_exactly
    return _shape(link(*treated, stage), period, audit, ranked=False)
