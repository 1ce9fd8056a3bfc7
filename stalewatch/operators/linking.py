"""Linking installed software to the catalogue and to technology relationships.

All match rules are reduced to lookups of *tagged keys*: a rule such as "the text contains the name and
the version" becomes a key (kind, first text, second text) that both sides can produce. Each side of a
rule is thereby an equality join, and the lookup holds only the best row per key, so neither many
versions of one package nor many relationships of one sigla multiply the rows.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stalewatch import rules
from stalewatch.functions.labels import tier_label
from stalewatch.operators.containment import contained_terms
from stalewatch.operators.dedup import ascending, first_per_key
from stalewatch.operators.joins import left_join_many, left_lookup

CATALOG_COLUMNS = (
    "nome_software_catalogo",
    "versao_catalogo",
    "software_catalogo_join",
    "name_join",
    "version_join",
)
RELATIONSHIP_COLUMNS = (
    "produto_tecnologico",
    "versao_relacionamento",
    "status_relacionamento",
    "criticidade",
    "indice_obsolescencia",
    "rating",
    "impacto",
    "cloud",
)
_KEY = ("__kind", "__first", "__second")


def _tagged(kind: str, first: str, second: str = "''", **extra: int) -> str:
    """SQL of a tagged key; ``first`` and ``second`` are SQL expressions."""
    fields = [f"'__kind', '{kind}', '__first', {first}, '__second', {second}"]
    fields += [f"'{name}', {value}" for name, value in extra.items()]
    return f"named_struct({', '.join(fields)})"


def _keyed(df: DataFrame, keep: Sequence[str], *arrays: str) -> DataFrame:
    """One row per tagged key; keys with a missing or empty part match nothing and are left out."""
    return df.selectExpr(*keep, f"inline(concat({', '.join(arrays)}))").filter("__first <> '' AND __second IS NOT NULL")


def _long_enough(column: str, min_chars: int) -> str:
    return f"CASE WHEN char_length({column}) >= {min_chars} THEN {column} END"


# --- catalogue -------------------------------------------------------------------------------------


_ROLES = ("is_name", "is_version", "is_product", "is_product_version")


def _role_rows(df: DataFrame, columns: dict[str, str], min_chars: int) -> DataFrame:
    """One row per term and role; ``columns`` maps a role to the column that plays it."""
    entries = [
        f"named_struct('termo', {column}, " + ", ".join(f"'{r}', {int(r == role)}" for r in _ROLES) + ")"
        for role, column in columns.items()
    ]
    return df.selectExpr(f"inline(array({', '.join(entries)}))").filter(f"char_length(termo) >= {min_chars}")


def text_vocabulary(catalog: DataFrame, relationships: DataFrame, min_chars: int) -> DataFrame:
    """Distinct names and versions of both tables with 0/1 marks for the roles of each term."""
    rows = _role_rows(catalog, {"is_name": "name_join", "is_version": "version_join"}, min_chars).unionByName(
        _role_rows(relationships, {"is_product": "produto_join", "is_product_version": "versao_join"}, min_chars)
    )
    return rows.groupBy("termo").agg(*[F.max(r).alias(r) for r in _ROLES])


def terms_by_text(texts: DataFrame, vocabulary: DataFrame, min_chars: int) -> DataFrame:
    """One row per distinct software text and catalogue or relationship term it contains, with the roles of the term."""
    return contained_terms(texts, vocabulary, "software_join", "termo", min_chars)


def _contained_keys(found: DataFrame, single: str, double: str, first: str, second: str, tiers: tuple[int, int], tier: str) -> DataFrame:
    """Tagged keys of the terms of a text: ``double`` for each pair of a first and a second term, ``single`` for each first one.

    The pairs are joined as rows, so that a text of many terms is no long row; their number is bounded by the
    substrings of one text, not by the size of any table.
    """
    firsts = found.filter(F.col(first) == 1).select("software_join", F.col("termo").alias("__first"))
    seconds = found.filter(F.col(second) == 1).select("software_join", F.col("termo").alias("__second"))
    pairs = firsts.join(seconds, "software_join").withColumns({"__kind": F.lit(double), tier: F.lit(tiers[0])})
    singles = firsts.withColumns({"__second": F.lit(""), "__kind": F.lit(single), tier: F.lit(tiers[1])})
    return pairs.unionByName(singles)


def best_catalog_rows(texts: DataFrame, found: DataFrame, catalog: DataFrame, min_chars: int) -> DataFrame:
    """Every distinct software text with its best catalogue row and match tier, or nulls without a match.

    ``found`` holds the terms of the texts. Order: tier, longest name, longest version; equal candidates by their keys
    and texts.
    """
    order = [
        F.char_length("name_join").desc_nulls_last(),
        F.char_length("version_join").desc_nulls_last(),
        *ascending("software_catalogo_join", "name_join", "version_join", "nome_software_catalogo", "versao_catalogo"),
    ]
    name, version = _long_enough("name_join", min_chars), _long_enough("version_join", min_chars)
    keys = [
        _tagged("package", "software_catalogo_join"),
        _tagged("name+version", name, version),
        _tagged("name", name),
    ]
    offered = _keyed(catalog.select(*CATALOG_COLUMNS).distinct(), CATALOG_COLUMNS, f"array({', '.join(keys)})")
    lookup = first_per_key(offered, _KEY, order).withColumn("__found", F.lit(1))

    tier = "prioridade_match_catalogo"
    contained = _contained_keys(found, "name", "name+version", "is_name", "is_version", (2, 3), tier)
    # The key of the text itself is always there, so no text is lost.
    own = texts.select("software_join").filter(F.col("software_join").isNotNull()).distinct()
    exact = own.selectExpr("software_join", f"inline(array({_tagged('package', 'software_join', **{tier: 1})}))")
    hits = left_lookup(exact.unionByName(contained), lookup, _KEY)
    best = first_per_key(hits, ["software_join"], [F.col("__found").asc_nulls_last(), F.col(tier), *order])
    return best.selectExpr("software_join", f"CASE WHEN __found = 1 THEN {tier} END AS {tier}", *CATALOG_COLUMNS)


def with_catalog_tier(df: DataFrame) -> DataFrame:
    """Tier 99 for rows without a catalogue match, and the tier label."""
    tier = F.coalesce("prioridade_match_catalogo", F.lit(rules.NO_MATCH))
    return df.withColumns(
        {
            "prioridade_match_catalogo": tier,
            "tipo_match_catalogo": tier_label(tier, rules.CATALOG_TIERS),
        }
    )


# --- relationships ---------------------------------------------------------------------------------


def best_relationship_rows(profiles: DataFrame, found: DataFrame, relationships: DataFrame, min_chars: int) -> DataFrame:
    """The best relationship of every (sigla, software text), with its match tier.

    ``profiles`` holds one row per (sigla_join, software_join) with the keys of the best catalogue row,
    ``found`` the terms of the texts. Order: tier, highest index, highest criticality; equal candidates
    by their keys and texts. Pairs without a match are absent.
    """
    order = [
        F.col("indice_obsolescencia").desc_nulls_last(),
        F.col("criticidade").desc_nulls_last(),
        *ascending(
            "produto_versao_join",
            "rating",
            "impacto",
            "produto_tecnologico",
            "versao_relacionamento",
            "status_relacionamento",
            "cloud",
        ),
    ]
    carried = [*RELATIONSHIP_COLUMNS, "produto_versao_join"]
    keys = [
        _tagged("product+version", "produto_versao_join"),
        _tagged("product", "produto_join"),
        _tagged("contained", _long_enough("produto_join", min_chars), _long_enough("versao_join", min_chars)),
    ]
    owned = relationships.filter(F.col("sigla_join").isNotNull())
    offered = _keyed(owned, ["sigla_join", *carried], f"array({', '.join(keys)})")
    lookup = first_per_key(offered, ["sigla_join", *_KEY], order)

    tier = "prioridade_match_relacionamento"
    exact = [
        _tagged("product+version", "software_catalogo_join", **{tier: 1}),
        _tagged("product", "name_join", **{tier: 2}),
        _tagged("product+version", "software_join", **{tier: 3}),
        _tagged("product", "software_join", **{tier: 4}),
    ]
    owned_texts = profiles.filter(F.col("sigla_join").isNotNull())
    pair = ["sigla_join", "software_join"]
    contained = _contained_keys(found, "product", "contained", "is_product", "is_product_version", (5, 6), tier)
    candidates = _keyed(owned_texts, pair, f"array({', '.join(exact)})").unionByName(
        owned_texts.select(*pair).join(contained, "software_join").select(*pair, *_KEY, tier)
    )
    hits = candidates.join(lookup, ["sigla_join", *_KEY]).select("sigla_join", "software_join", tier, *carried)
    best = first_per_key(hits, ["sigla_join", "software_join"], [F.col(tier), *order])
    return best.select("sigla_join", "software_join", tier, *RELATIONSHIP_COLUMNS)


def with_relationship_tier(df: DataFrame) -> DataFrame:
    tier = F.coalesce("prioridade_match_relacionamento", F.lit(rules.NO_MATCH))
    return df.withColumns(
        {
            "prioridade_match_relacionamento": tier,
            "tipo_match_relacionamento": tier_label(tier, rules.RELATIONSHIP_TIERS),
        }
    )


# --- the cascade -----------------------------------------------------------------------------------


def installed_base(servers: DataFrame, instances: DataFrame, extra_partition: Sequence[str] = ()) -> DataFrame:
    """One row per server key and software text, or per server key alone without software.

    The cascade keeps a single row per (server, software text). Both inputs are therefore reduced
    before they meet: the server row by (sigla, all other columns), the installed text by itself.
    """
    server_rows = first_per_key(
        servers,
        ["servidor_join", *extra_partition],
        ascending(
            *[
                c
                for c in (
                    "sigla_join",
                    "sigla_origem",
                    "servidor",
                    "ambiente",
                    "arquitetura",
                    "status_servidor",
                    "status_operacional",
                )
                if c not in extra_partition
            ]
        ),
    )
    usable = instances.filter(F.col("servidor_join").isNotNull())
    installed = usable.groupBy("servidor_join", "software_join").agg(
        F.min("software_instalado").alias("software_instalado")
    )
    return left_join_many(server_rows, installed, ["servidor_join"])


def ranked_cascade(
    servers: DataFrame,
    instances: DataFrame,
    catalog: DataFrame,
    relationships: DataFrame,
    min_chars: int = rules.MIN_NEEDLE_CHARS,
    extra_partition: Sequence[str] = (),
    stage=lambda df: df,
) -> DataFrame:
    """Servers with their software, the best catalogue row and the best relationship.

    ``stage`` is applied to the intermediates that several branches read; pass
    :func:`stalewatch.staging.stage` to compute them once.
    """
    base = stage(installed_base(servers, instances, extra_partition))
    pairs = base.select("sigla_join", "software_join").filter(F.col("software_join").isNotNull()).distinct()

    vocabulary = stage(text_vocabulary(catalog, relationships, min_chars))
    found = stage(terms_by_text(pairs, vocabulary, min_chars))
    known = stage(best_catalog_rows(pairs, found, catalog, min_chars))
    profiles = left_lookup(pairs, known, ["software_join"])
    best_relationship = best_relationship_rows(profiles, found, relationships, min_chars)

    with_catalog = left_lookup(base, known, ["software_join"])
    linked = left_lookup(with_catalog, best_relationship, ["sigla_join", "software_join"])
    return with_relationship_tier(with_catalog_tier(linked))
