import math

import pytest
from pyspark.sql import functions as F

from stalewatch import rules
from stalewatch.functions import flags, keys, labels, names, numbers, scores


def values(spark, expression, inputs, schema="c string"):
    """Results of an expression over ``c`` (or the columns of ``schema``), in input order."""
    columns = [part.split()[0] for part in schema.split(", ")]
    rows = [(n, *(v if isinstance(v, tuple) else (v,))) for n, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"__n int, {schema}")
    assert len(columns) == len(df.columns) - 1
    return [r[0] for r in df.orderBy("__n").select(expression.alias("r")).collect()]


def test_blank_to_null(spark):
    inputs = [None, "", "   ", "NaN", " nan ", "Empty String", "N/A", " x ", "None"]
    assert values(spark, keys.blank_to_null(F.col("c")), inputs) == [None] * 6 + ["N/A", "x", "None"]


def test_decimal_comma(spark):
    inputs = ["1,25", " 0,5 ", "3", "1.5", "1.234,5", "n/d", "", "nan", None]
    assert values(spark, numbers.decimal_comma(F.col("c")), inputs) == [1.25, 0.5, 3.0, 1.5] + [None] * 5
    kept = values(spark, numbers.decimal_comma(F.col("c"), "keep"), ["nan", "n/d"])
    assert math.isnan(kept[0]) and kept[1] is None
    with pytest.raises(ValueError):
        numbers.decimal_comma(F.col("c"), "other")


def test_keys(spark):
    inputs = [" Oracle\t DB  19c ", "a b", "ÁGUA", None, "\tX"]
    assert values(spark, keys.strong_key(F.col("c")), inputs) == ["oracle db 19c", "a b", "água", None, "x"]
    assert values(spark, keys.basic_key(F.col("c")), inputs)[0] == "oracle\t db  19c"
    assert values(spark, keys.basic_key(F.col("c")), ["\tX"]) == ["\tx"]


def test_joined_key(spark):
    inputs = [("Java", "8"), ("Java", None), (None, "8"), (None, None)]
    assert values(spark, keys.joined_key(F.col("a"), F.col("b")), inputs, "a string, b string") == ["java 8", "java", "8", ""]


def test_contains_term(spark):
    inputs = [("abcd", "bcd"), ("abcde", "bcde"), ("java", "java"), (None, "java"), ("java", None), ("java", ""), ("jav", "java")]
    found = values(spark, keys.contains_term(F.col("a"), F.col("b")), inputs, "a string, b string")
    assert found == [False, True, True, False, False, False, False]


def test_nonconform_and_remediation(spark):
    inputs = [(None, None), (0.0, None), (0.1, None), (None, "BAIXO"), (0.0, "Up to date"), (float("nan"), None), (None, "Médio")]
    schema = "i2 double, r string"
    predicate = flags.as_flag(flags.is_nonconform(F.col("i2"), F.col("r")))
    assert values(spark, predicate, inputs, schema) == [0, 0, 1, 1, 0, 1, 1]
    needs = flags.as_flag(flags.needs_remediation(F.col("i2"), F.col("r")))
    assert values(spark, needs, inputs, schema) == [1, 1, 1, 1, 0, 1, 1]


def test_membership_readings(spark):
    inputs = ["Alto", "ALTO", "médio", "Medio", None]
    folded = flags.as_flag(flags.in_words(F.col("c"), rules.HIGH_RATINGS))
    exact = flags.as_flag(flags.in_words(F.col("c"), rules.HIGH_RATINGS_EXACT, None))
    assert values(spark, folded, inputs) == [1, 1, 1, 1, 0]
    assert values(spark, exact, inputs) == [1, 0, 0, 1, 0]
    upper = flags.as_flag(flags.in_words(F.col("c"), rules.CLOUD_WORDS_UPPER, "upper"))
    assert values(spark, upper, ["sim", "Verdadeiro", "não"]) == [1, 1, 0]
    assert values(spark, flags.as_flag(flags.has_fragment(F.col("c"), "cr")), ["CRítico", "micro", "x", None]) == [1, 1, 0, 0]


def test_classes_and_lights(spark):
    schema = "s double"
    sigla = scores.risk_class(F.col("s"), rules.SIGLA_LIMITS)
    assert values(spark, sigla, [50.0, 49.99, 20.0, 19.99, None], schema) == ["Alto", "Médio", "Médio", "Baixo", "Baixo"]
    server = scores.risk_class(F.col("s"), rules.SERVER_LIMITS)
    assert values(spark, server, [60.0, 59.9, 20.0], schema) == ["Alto", "Médio", "Médio"]
    light = scores.light_by_percent(F.col("s"))
    assert values(spark, light, [5.0, 5.01, 19.99, 20.0, None], schema) == ["Verde", "Amarelo", "Amarelo", "Vermelho", "Vermelho"]
    assert values(spark, scores.light_position(F.col("c")), ["Verde", "Amarelo", "Vermelho"]) == [1, 2, 3]
    assert values(spark, scores.light_by_flag(F.col("f")), [0, 1], "f int") == ["Verde", "Vermelho"]


def test_scores(spark):
    schema = "h bigint, c bigint, i double, p bigint"
    arguments = [F.col(x) for x in ("h", "c", "i", "p")]
    inputs = [(1, 2, 0.5, 10), (1, 2, None, 10)]
    assert values(spark, scores.sigla_score(*arguments), inputs, schema) == [10.0, None]
    assert values(spark, scores.sigla_score(*arguments, null_as_zero=True), inputs, schema) == [10.0, 9.0]
    server = scores.server_score(F.col("i"), F.lit(None).cast("double"), F.col("h"), F.col("c"))
    assert values(spark, server, inputs, schema) == [13.0, 8.0]
    priority = scores.remediation_score(F.col("p"), F.col("h"), F.col("c"), F.col("i"), F.lit(1.0))
    assert values(spark, priority, inputs, schema) == [76.0, 71.0]


def test_headers(spark):
    schema = "a string, b double"
    labelled = labels.labelled_header({"x": F.col("a"), "y": F.col("b").cast("string")})
    positional = labels.positional_header(F.col("a"), F.col("b"), F.lit("z"))
    inputs = [("v", 1.5), (None, 2.0), ("v", None)]
    assert values(spark, labelled, inputs, schema) == ["x=v | y=1.5", "y=2.0", "x=v"]
    assert values(spark, positional, inputs, schema) == ["v | 1.5 | z", " | 2.0 | z", "v |  | z"]
    label = labels.tier_label(F.col("t"), rules.CATALOG_TIERS)
    assert values(spark, label, [1, 99], "t int") == ["MATCH_EXATO_NAME_VERSION", "SEM_MATCH_CATALOGO"]


def test_rounding(spark):
    inputs = [0.125, 0.14499999999999999, 2.5, -0.125, None]
    assert values(spark, numbers.round_half_up(F.col("x")), inputs, "x double") == [0.13, 0.15, 2.5, -0.13, None]


def test_names(spark):
    expected = {
        "Sigla SS": "sigla_ss",
        "  ": "coluna_sem_nome",
        "Criticidade-Final%": "criticidade_final",
        "Ação": "ação",
        "__a__b": "a_b",
        "﻿Nome": "nome",
    }
    assert {k: names.normalize_name(k) for k in expected} == expected
    assert names.unique_names(["a", "a", "a_1", "a"]) == ["a", "a_1", "a_1_1", "a_2"]
    df = spark.createDataFrame([(1, 2, 3)], ["Sigla SS", "sigla-ss", "Ação"])
    assert names.with_clean_names(df).columns == ["sigla_ss", "sigla_ss_1", "ação"]


def test_rounding_happens_once(spark):
    from stalewatch.functions.numbers import exact_mean, round_half_up

    df = spark.createDataFrame([(2.34499999999,), (2.345,)], "x double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"))).collect()] == [2.34, 2.35]
    tenths = spark.createDataFrame([(x,) for x in (0.1, 0.2, 0.3, None)], "x double")
    assert tenths.select(exact_mean(F.col("x"))).first()[0] == 0.2


def test_mean_counts_every_number(spark):
    from stalewatch.functions.numbers import exact_mean

    nan, inf = float("nan"), float("inf")
    cases = [
        ((1e30, 3.0), 5e29), ((1e-13, 3e-13), 2e-13), ((1.0, nan, 3.0), nan), ((inf, 1.0), inf), ((inf, -inf), nan), ((None,), None),
        ((2.34, 2.35), 2.345), ((1.0, 1.0, 2.0), 4 / 3), ((1e25, 3e25, -4e25, 1.5), 0.375), ((9e25, 9e25, 9e25), 9e25), ((5e-324,), 5e-324),
        ((0.1234567890123456, 0.5), 0.3117283945061728), ((123456789.123, 0.007), 61728394.565), ((1e16, 0.1, 0.2), 3333333333333333.5),
    ]
    rows = [(i, x) for i, (numbers, _) in enumerate(cases) for x in numbers]
    found = dict(spark.createDataFrame(rows, "i int, x double").groupBy("i").agg(exact_mean(F.col("x"))).collect())
    for i, (_, expected) in enumerate(cases):
        assert found[i] == expected or (expected != expected and found[i] != found[i])
    assert spark.range(0).select(exact_mean(F.col("id"))).first()[0] is None
