import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stalewatch.operators import conversations, profiling, quality
from stalewatch.operators import quantiles
from stalewatch.operators.quantiles import exact_quantiles


def test_exact_quantiles_with_narrow_brackets(spark):
    """A small accuracy makes the brackets matter; ties hold a third of the rows."""
    rng = random.Random(7)
    rows = [("a", 5.0 if rng.random() < 0.33 else rng.expovariate(1.0)) for _ in range(20_000)]
    rows += [("b", float(i)) for i in range(3)] + [("b", None), ("b", float("nan")), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = {(r["g"], r["probabilidade"]): r["quantil"] for r in exact_quantiles(df, "v", probabilities, ["g"], accuracy=500).collect()}
    frame = pd.DataFrame(rows, columns=["g", "v"])
    for group, part in frame.groupby("g", dropna=False):
        key = None if pd.isna(group) else group
        expected = np.nanquantile(part["v"].astype(float), probabilities)
        assert [found[key, p] for p in probabilities] == pytest.approx(list(expected), abs=1e-12)
    whole = {r["probabilidade"]: r["quantil"] for r in exact_quantiles(df, "v", [0.5], accuracy=500).collect()}
    assert whole[0.5] == pytest.approx(frame["v"].median())


def test_brackets_keep_few_rows(spark):
    """Only the rows near a quantile are ranked, all lower ones meet as a count."""
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    found = exact_quantiles(df, "v", [0.5], accuracy=1000).collect()
    assert found[0]["quantil"] == 49_999.5


@pytest.mark.parametrize("lo, hi", [(-9.0, -8.0), (1e9, 2e9), (5.0, 5.0), (float("-inf"), float("inf"))])
def test_missed_brackets_are_opened_and_wide_ones_narrowed(spark, monkeypatch, lo, hi):
    """Whatever the sketch says, the quantiles are exact."""
    rng = random.Random(3)
    rows = [("a", rng.lognormvariate(0, 9) * rng.choice((-1, 1))) for _ in range(4000)] + [("a", 5.0)] * 2000
    rows += [("b", float(i)) for i in range(900)] + [("c", float("inf")), ("c", float("inf")), ("c", 1.0), ("d", 7.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    first, rounds = quantiles._sketched, []
    monkeypatch.setattr(quantiles, "_sketched", lambda *a: first(*a).withColumns({"lo": F.lit(lo), "hi": F.lit(hi)}))
    narrowed = quantiles._narrowed
    monkeypatch.setattr(quantiles, "_narrowed", lambda *a: rounds.append(1) or narrowed(*a))
    monkeypatch.setattr(quantiles, "FEW_VALUES", 20)
    monkeypatch.setattr(quantiles, "PARTS", 8)
    probabilities = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = {(r["g"], r["probabilidade"]): r["quantil"] for r in exact_quantiles(df, "v", probabilities, ["g"]).collect()}
    for group in ("a", "b", "c", "d", None):
        values = sorted(v for g, v in rows if g == group)
        for p in probabilities:
            place = p * (len(values) - 1)
            low, high = values[int(place)], values[min(int(place) + 1, len(values) - 1)]
            fraction = place - int(place)
            assert found[group, p] == pytest.approx(low if low == high or not fraction else low + (high - low) * fraction)
    assert len(found) == 25 and len(rounds) >= (3 if hi - lo > 1e300 else 1)
    whole = exact_quantiles(df, "v", [0.5]).first()["quantil"]
    assert whole == pytest.approx(np.quantile([v for _, v in rows], 0.5))


def test_numeric_summary_equals_pandas(spark):
    frame = pd.DataFrame({"x": [1.0, 2.0, 4.0, 8.0], "n": [1, 1, 2, 3]})
    found = {r["coluna"]: r for r in profiling.numeric_summary(spark.createDataFrame(frame)).collect()}
    described = frame.describe()
    for column in frame:
        row = found[column]
        names = ("contagem", "media", "desvio", "minimo", "q1", "mediana", "q3", "maximo")
        assert [row[n] for n in names] == pytest.approx(list(described[column]))


def test_scatter_sample(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    sample = {r["k"] for r in profiling.scatter_sample(df, ["y"], "k", size=700, digits=2).collect()}
    ordered = df.orderBy(F.md5(F.concat(F.col("k").cast("string"), F.lit("42"))), "k").limit(700)
    assert sample == {r["k"] for r in ordered.collect()} and len(sample) == 700
    assert profiling.scatter_sample(df.limit(50), ["y"], "k", size=700).count() == 50


def test_histogram_limits(spark):
    flat = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    assert [tuple(r) for r in profiling.histogram_data(flat, "v").collect()] == [(0, 3.0, 3.0, 2)]
    ramp = spark.range(101).select(F.col("id").cast("double").alias("v"))
    counts = [r["quantidade"] for r in profiling.histogram_data(ramp, "v", 10).orderBy("faixa").collect()]
    assert counts == [10] * 9 + [11]
    with pytest.raises(ValueError):
        profiling.histogram_data(flat, "v", 101)
    with pytest.raises(ValueError):
        profiling.bar_data(flat, "v", 4)


def test_value_distribution_counts_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    rows = [tuple(r) for r in profiling.value_distribution(df, top=2).orderBy("posicao").collect()]
    assert rows == [("c", "a", 2, 1, 2), ("c", "b", 1, 2, 2)]


def test_shares_add_up(spark):
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("c"))
    shares = profiling.share_data(df, "c", 4).agg(F.sum("percentual")).head()[0]
    assert shares == pytest.approx(100.0)


def test_chartable_columns(spark):
    df = spark.createDataFrame([("a", "x", 1, True), ("b", "x", 2, False)], "c string, k string, n int, b boolean")
    found = {tuple(r) for r in profiling.chartable_columns(df).collect()}
    assert found == {("c", "categorica"), ("n", "numerica")}


def test_typed_inference_limit_is_strict(spark):
    rows = [(str(i) if i < 90 else "x", str(i) if i < 91 else None, "1d") for i in range(100)]
    typed = quality.infer_types(spark.createDataFrame(rows, "at90 string, at91 string, suffix string"))
    assert dict(typed.dtypes) == {"at90": "string", "at91": "double", "suffix": "string"}
    assert typed.filter(F.col("at91").isNull()).count() == 9
    empty = quality.infer_types(spark.createDataFrame([], "c string"))
    assert dict(empty.dtypes) == {"c": "string"}


def test_null_profile_threshold_is_strict(spark):
    df = spark.createDataFrame([(None, None, "x"), (None, "x", "x")], "a string, b string, c string")
    assert [r["coluna"] for r in quality.null_profile(df).collect()] == ["a"]
    assert not quality.has_rows(df.limit(0)) and quality.has_rows(df)
    assert tuple(quality.shape(df).head()) == (2, 3)


def test_text_columns_and_lineage(spark):
    df = spark.createDataFrame([(1, None)], "n int, t string")
    texts = quality.to_text_columns(df)
    assert dict(texts.dtypes) == {"n": "string", "t": "string"} and tuple(texts.head()) == ("1", "nan")
    assert quality.to_text_columns(df, None).head()["t"] is None
    lineage = quality.with_lineage(texts, F.lit("file"))
    assert lineage.columns[-3:] == list(quality.LINEAGE_COLUMNS)
    assert (lineage.head()["camada_origem"], lineage.head()["nome_arquivo_origem"]) == ("bronze", "file")


def test_low_cardinality(spark):
    df = spark.createDataFrame([("a", str(i)) for i in range(4)], "few string, many string")
    found = {r["coluna"]: (r["valores_unicos"], r["razao"], r["categoria"]) for r in quality.low_cardinality(df).collect()}
    assert found == {"few": (1, 0.25, True), "many": (4, 1.0, False)}


def messages(spark, n=25):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(n)] + [(2, 0, "assistant", "only")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


def test_context_positions_over_blocks(spark):
    context = conversations.build_context(messages(spark), "sys", "next", block=4)
    first = [(r["posicao"], r["role"], r["content"]) for r in context.filter("conv_id = 1").orderBy("posicao").collect()]
    expected = [(0, "system", "sys")]
    expected += [(i + 1, "user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(25)]
    assert first == [*expected, (26, "user", "next")]
    bare = conversations.build_context(messages(spark)).filter("conv_id = 2").collect()
    assert [(r["posicao"], r["content"]) for r in bare] == [(1, "only")]


def test_context_lists_are_bounded(spark):
    lists = conversations.context_lists(conversations.build_context(messages(spark), "sys", "next"), chunk=10)
    sizes = {(r["conv_id"], r["parte"]): len(r["mensagens"]) for r in lists.collect()}
    assert sizes == {(1, 0): 10, (1, 1): 10, (1, 2): 7, (2, 0): 3}
    part = lists.filter("conv_id = 2").head()["mensagens"]
    assert [(m["role"], m["content"]) for m in part] == [("system", "sys"), ("assistant", "only"), ("user", "next")]


def test_question_counts(spark):
    found = {r["conv_id"]: r["perguntas"] for r in conversations.question_counts(messages(spark)).collect()}
    assert found == {1: 13, 2: 0}


def test_scatter_sample_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0)], "k string, v double")
    assert profiling.scatter_sample(df, ["v"], "k", size=10).count() == 3
    assert profiling.scatter_sample(df, ["v"], "k", size=2).count() == 2
