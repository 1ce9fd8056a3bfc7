"""Scores of remediation that end in a tie of hundredths, as frame and as published SQL."""

import pytest

from stalewatch.plans import view_sql, views

SCHEMA = "software_instalado string, versao string, servidor string, indice_obsolescencia double, criticidade double, rating string, impacto string"


def rows(name, index, criticality, servers, high, critical):
    """Rows of one software: the numbers in turn, so many servers, high ratings and critical impacts."""
    n = max(len(index), len(criticality), servers)

    def at(numbers, i):
        return numbers[i] if i < len(numbers) else None

    return [
        (name, "1", f"s{i % servers}", at(index, i), at(criticality, i), "Alto" if i < high else None, "Crítico" if i < critical else None)
        for i in range(n)
    ]


CASES = {
    # 200 + 15 + 108 + 6.835 + 18.64
    "tie": (([0.68] * 39 + [0.82], [1.84] * 24 + [2.44], 40, 5, 27), 348.48),
    # 5 + 10 * 0.07 / 3 + 10 * 0.1685 / 3
    "tie of thirds": (([0.02, 0.02, 0.03], [0.05, 0.05, 0.0685], 1, 0, 0), 5.8),
    "tie of sevenths": (([0.1] * 6 + [0.2005], [0.1] * 6 + [0.101], 1, 0, 0), 7.15),
    "below a tie": (([0.6834999], [1.864], 40, 5, 27), 348.47),
    "no number": (([None], [None], 1, 0, 0), 5.0),
    "large": (([1e30, 3.0], [1.0], 1, 0, 0), 5e30),
    "not a number": (([float("nan"), 1.0], [1.0], 1, 0, 0), float("nan")),
}


@pytest.mark.parametrize("form", ["frame", "sql"])
def test_exact_ties_of_the_score_are_rounded_up(spark, form):
    gold = spark.createDataFrame([r for name, (made, _) in CASES.items() for r in rows(name, *made)], SCHEMA)
    if form == "frame":
        found = views.software_remediation(gold)
    else:
        gold.createOrReplaceTempView("gold_of_ties")
        found = spark.sql(view_sql.top_software_to_remediate().format(gold="gold_of_ties"))
    scores = {r["software_instalado"]: r["score_prioridade_remediacao"] for r in found.collect()}
    for name, (_, expected) in CASES.items():
        assert scores[name] == expected or (scores[name] != scores[name] and expected != expected), name
