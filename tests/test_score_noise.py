"""Averages and scores without the noise of binary sums, as frames and as published SQL."""

from pyspark.sql import functions as F

from stalewatch.functions import scores
from stalewatch.plans import sigla_gold, view_sql, views


def test_sigla_average_and_score_are_rounded_once(spark):
    # 4.41 / 80 = 0.055125; 3 * 6 + 2 * 25 + 2 * 0.055125 + 0.2 * 4 = 68.91025
    rows = [("a", "p", x, 2.0, i < 6, i < 25, False) for i, x in enumerate([0.1] * 41 + [0.01] * 31 + [0.0] * 8)]
    schema = "sigla_join string, produto string, indice_obsolescencia_num double, criticidade_num double, flag_risco_alto int, flag_critico int, flag_cloud int"
    rows = [(*r[:4], *map(int, r[4:])) for r in rows]
    risks = sigla_gold.aggregate_risks(spark.createDataFrame(rows, schema).repartition(4))
    servers = spark.createDataFrame([("a", 4, 2, 4, 2)], "sigla_join string, qtd_servidores bigint, qtd_tipos_arquitetura bigint, qtd_servidores_producao bigint, qtd_servidores_operacionais bigint")
    software = spark.createDataFrame([("a", 3.0)], "sigla_join string, media_softwares_por_servidor double")
    found = sigla_gold.join_and_score(risks, servers, software, audit=False).first()
    assert found["media_indice_obsolescencia"] == 0.055125
    assert found["score_risco_operacional"] == 68.91025


def test_scores_are_the_nearest_double(spark):
    df = spark.createDataFrame([(0.06835, 1.864, 1, 2), (1e-30, 0.0, 0, 0), (float("nan"), 1.0, 0, 0)], "i double, k double, h bigint, c bigint")
    found = [r[0] for r in df.select(scores.server_score(F.col("i"), F.col("k"), F.col("h"), F.col("c"))).collect()]
    w = scores.rules.ServerWeights()
    assert found[0] == round(w.index * 0.06835 + w.criticality * 1.864 + w.high + 2 * w.critical, 6)
    assert found[1] == w.index * 1e-30 and found[2] != found[2]


def test_average_score_of_a_class(spark):
    frame = spark.createDataFrame([("Alto", x, 1, 1) for x in [10.1] * 3 + [10.115] * 3 + [10.1, 10.105]], "classificacao_risco string, score_risco_operacional double, qtd_produtos_tecnologicos bigint, qtd_servidores bigint")
    tenths = spark.createDataFrame([("Alto", x, 1, 1) for x in (0.1, 0.2, 0.7, 0.1, 0.2, 0.05, 0.05, 0.03, 0.03, 0.04)], frame.schema)
    frame.unionByName(tenths).createOrReplaceTempView("gold_of_classes")
    by_frame = views.summary_by_class(spark.table("gold_of_classes")).first()["score_medio"]
    by_text = spark.sql(view_sql.summary_by_class().format(gold="gold_of_classes")).first()["score_medio"]
    assert by_frame == by_text
    assert views.summary_by_class(tenths).first()["score_medio"] == 0.15
