"""Blocked lookups against direct comparison of all pairs, on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from stalewatch.functions.keys import contains_term
from stalewatch.operators.containment import contained_terms
from stalewatch.operators.dedup import one_row_per_key
from stalewatch.operators.joins import left_join_many, left_lookup
from stalewatch.plans.server_gold import build_server_gold


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.mark.parametrize("min_chars", [1, 3, 4, 6])
def test_contained_terms_equals_all_pairs(spark, min_chars):
    rng = random.Random(min_chars)
    texts = ["".join(rng.choice("abã ") for _ in range(rng.randint(0, 40))) for _ in range(120)] + ["aaaaaaaa", None]
    terms = {"".join(rng.choice("abã ") for _ in range(rng.randint(1, 9))) for _ in range(150)} | {"aaaa", "aaaaaaaa"}
    t = spark.createDataFrame([(x,) for x in texts], "texto string")
    n = spark.createDataFrame([(x, len(x)) for x in terms], "termo string, extra int")
    naive = t.distinct().join(n, contains_term(F.col("texto"), F.col("termo"), min_chars))
    blocked = contained_terms(t, n, "texto", "termo", min_chars)
    assert rows(blocked, "texto", "termo", "extra") == rows(naive, "texto", "termo", "extra")
    assert blocked.count() > 0


def test_contained_terms_plan_has_no_pairwise_join(spark):
    t = spark.createDataFrame([("abcdef",)], "texto string")
    n = spark.createDataFrame([("abcd",)], "termo string")
    plan = contained_terms(t, n, "texto", "termo")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("null_safe", [False, True])
def test_left_join_many_equals_left_join(spark, null_safe):
    left = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("cold", 3), ("none", 4), (None, 5)], "k string, a int"
    )
    right = spark.createDataFrame(
        [("hot", i) for i in range(200)] + [("cold", 1), ("cold", 2), (None, 7)] + [("other", i) for i in range(20)],
        "k string, b int",
    )
    right2 = right.withColumnRenamed("k", "k2")
    same = F.col("k").eqNullSafe(F.col("k2")) if null_safe else F.col("k") == F.col("k2")
    expected = rows(left.join(right2, same, "left"), "k", "a", "b")
    found = left_join_many(left, right, ["k"], null_safe)
    assert rows(found, "k", "a", "b") == expected
    assert found.columns == ["k", "a", "b"]


def test_left_join_many_keeps_the_rows_of_a_hot_key_splittable(spark):
    left = spark.createDataFrame([("hot", 1), ("none", 2)], "k string, a int")
    right = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("b"))
    joined = left_join_many(left, right, ["k"])
    assert joined.count() == 1001
    assert "LeftOuter" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_left_lookup_keeps_every_left_row(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, a int")
    lookup = spark.createDataFrame([("a", "x")], "k string, v string")
    assert rows(left_lookup(left, lookup, ["k"])) == sorted(
        [("a", 1, "x"), ("a", 2, "x"), ("b", 3, None), (None, 4, None)], key=repr
    )


def test_one_row_per_key_is_deterministic(spark):
    df = spark.createDataFrame([("k", "b", None), ("k", "a", None), ("k", "a", "z"), (None, "q", "q")], "k string, x string, y string")
    assert rows(one_row_per_key(df.repartition(3), ["k"])) == sorted([("k", "a", "z"), (None, "q", "q")], key=repr)


SERVERS = [
    ("srv  1", "x86_64", "Instalado", "Operacional", "Produção", "ABC"),
    ("SRV 1", "ARM64", "Instalado", "Operacional", "Produção", "zzz"),
    ("srv 2", "nan", "", "Inativo", "Homologação", " abc "),
    ("srv 3", "x86_64", "Instalado", "Operacional", "Produção", "DEF"),
    ("nan", "x86_64", "Instalado", "Operacional", "Produção", "DEF"),
    (None, "ARM64", "Instalado", "Operacional", "Produção", "GHI"),
]
INSTANCES = [
    ("SRV 1", "Oracle  DB 19.3.0", "20260401"),
    ("srv 1", "oracle db enterprise 19.3.0", "20260401"),
    ("srv 1", "ORACLE DB standard", "20260401"),
    ("srv 1", "nothing known", "20260401"),
    ("srv 2", "tomcat 9.0.1", "20260401"),
    ("srv 2", "tomcat", "20260401"),
    ("srv 2", "my tomcat server 9.0.1 patched", "20260401"),
    ("srv 2", "my tomcat server", "20260401"),
    ("srv 2", "nan", "20260401"),
]
CATALOG = [
    ("m1", "Oracle DB", "19.3.0", "20260401"),
    ("m2", "oracle db", "12.1", "20260401"),
    ("m3", "Oracle", "nan", "20260401"),
    ("m4", "nan", "nan", "20260401"),
]
RELATIONSHIPS = [
    ("abc", "Oracle DB", "19.3.0", "Ativo", "1,5", "0,5", "Alto", "Crítico", "sim"),
    ("abc", "Oracle DB", "12.1", "Ativo", "2,5", "0,9", "Médio", "nan", "não"),
    ("abc", "oracle db", "nan", "Ativo", "1,0", "n/d", "Baixo", "Crítico", "não"),
    ("abc", "tomcat", "9.0.1", "Ativo", "3", "0", "Up to date", "Moderado", "não"),
    ("abc", "tomcat", "nan", "Ativo", "3", "0,2", "", "Moderado", "não"),
    ("def", "Oracle DB", "19.3.0", "Ativo", "9", "9", "Alto", "Crítico", "sim"),
    ("nan", "tomcat", "9.0.1", "Ativo", "9", "9", "Alto", "Crítico", "sim"),
]


def inventory(spark):
    return (
        spark.createDataFrame(SERVERS, "nome string, arquitetura string, status string, status_operacional string, ambiente string, sigla string"),
        spark.createDataFrame(INSTANCES, "installed_on string, software string, anomesdia string"),
        spark.createDataFrame(CATALOG, "model_id string, name string, version string, anomesdia string"),
        spark.createDataFrame(
            RELATIONSHIPS,
            "sigla_ss string, produto string, versao string, status string, criticidade string, "
            "indice_obsolescencia string, rating string, impacto string, cloud string",
        ),
    )


def test_cascade_tiers(spark):
    gold = build_server_gold(*inventory(spark))
    found = {
        (r["servidor"], r["software_instalado"]): (r["prioridade_match_catalogo"], r["prioridade_match_relacionamento"])
        for r in gold.collect()
    }
    assert found == {
        ("srv  1", "Oracle  DB 19.3.0"): (1, 1),
        ("srv  1", "oracle db enterprise 19.3.0"): (2, 1),
        # longest name wins, then the longest version: 'oracle db' with 19.3.0, which then decides the relationship
        ("srv  1", "ORACLE DB standard"): (3, 1),
        ("srv  1", "nothing known"): (99, 99),
        ("srv 2", "tomcat 9.0.1"): (99, 3),
        ("srv 2", "tomcat"): (99, 3),
        ("srv 2", "my tomcat server 9.0.1 patched"): (99, 5),
        ("srv 2", "my tomcat server"): (99, 6),
        ("srv 2", None): (99, 99),
        ("srv 3", None): (99, 99),
        (None, None): (99, 99),
    }


def test_cascade_by_sigla_keeps_both_owners(spark):
    gold = build_server_gold(*inventory(spark), extra_partition=["sigla_join"])
    owners = {r["sigla_origem"] for r in gold.filter("software_instalado = 'nothing known'").collect()}
    assert owners == {"ABC", "zzz"}


def test_cascade_prefers_the_highest_index(spark):
    gold = build_server_gold(*inventory(spark)).filter("software_instalado = 'my tomcat server'")
    row = gold.collect()[0]
    assert (row["indice_obsolescencia"], row["rating"], row["versao"]) == (0.2, None, None)
    assert "versao=N/A" in row["detalhe_cabecalho"]


def test_strategies_agree_on_servers(spark):
    tables = inventory(spark)
    names = {s: {r[0] for r in build_server_gold(*tables, strategy=s).select("servidor").collect()} for s in ("name", "exact", "cascade")}
    assert {"srv 2", "srv 3"} <= names["name"] and {"srv 2", "srv 3"} <= names["exact"]
    with pytest.raises(ValueError):
        build_server_gold(*tables, strategy="other")


def test_exact_strategy_binds_to_the_sigla(spark):
    gold = build_server_gold(*inventory(spark), strategy="exact")
    hits = gold.filter("servidor = 'SRV 1' and software_instalado = 'Oracle  DB 19.3.0'").collect()
    assert {r["indice_obsolescencia"] for r in hits} == {None}  # owned by zzz, which has no relationship
    tomcat = gold.filter("servidor = 'srv 2' and software_instalado = 'tomcat 9.0.1'").collect()
    assert [r["produto_tecnologico"] for r in tomcat] == ["tomcat"]


def test_name_strategy_matches_model_to_product(spark):
    servers, instances, _, relationships = inventory(spark)
    catalog = spark.createDataFrame([("Oracle DB", "tomcat", "9.0.1", "20260401")], "model_id string, name string, version string, anomesdia string")
    gold = build_server_gold(servers, instances, catalog, relationships, strategy="name")
    hits = gold.filter("software_instalado = 'tomcat'")
    assert {r["rating"] for r in hits.collect()} == {"Alto", "Médio", "Baixo"}


def test_long_texts_are_searched_by_narrow_positions(spark):
    """Texts of 20,000 characters; positions carry numbers, the texts move only for what was found."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 12))) for _ in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(2600))[:20_000] for _ in range(6)] + ["é" * 19_990 + words[0], "short"]
    terms = sorted({*words[:150], texts[0][500:900], "absent term", "é" * 700})
    t = spark.createDataFrame([(x,) for x in texts], "texto string")
    n = spark.createDataFrame([(x,) for x in terms], "termo string")
    blocked = contained_terms(t, n, "texto", "termo")
    assert rows(blocked, "texto", "termo") == sorted(((x, y) for x in texts for y in terms if y in x), key=repr)


def test_candidates_are_rows_not_arrays_of_pairs(spark):
    from stalewatch.operators import cleaning, linking

    servers, instances, catalog, relationships = inventory(spark)
    cat, rel = cleaning.treat_software_catalog(catalog), cleaning.treat_relationships(relationships)
    texts = cleaning.treat_software_instances(instances).select("software_join")
    found = linking.terms_by_text(texts, linking.text_vocabulary(cat, rel, 4), 4)
    plan = linking.best_catalog_rows(texts, found, cat, 4)._jdf.queryExecution().executedPlan().toString()
    assert "flatten(" not in plan and "collect_list(CASE" not in plan and "collect_list(termo" not in plan
