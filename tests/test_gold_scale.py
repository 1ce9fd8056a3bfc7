"""The name and the exact strategy work on software texts before the servers come in."""

import pytest

from stalewatch.plans.server_gold import build_server_gold
from stalewatch.plans.views import server_detail_of_job

SERVERS = "nome string, arquitetura string, status string, status_operacional string, ambiente string, sigla string"
INSTANCES = "installed_on string, software string, anomesdia string"
CATALOG = "model_id string, name string, version string, anomesdia string"
RELATIONSHIPS = (
    "sigla_ss string, produto string, versao string, status string, criticidade string, "
    "indice_obsolescencia string, rating string, impacto string, cloud string"
)
N = 30


@pytest.fixture
def tables(spark):
    """Every server has software with a model that has relationships, without a model, without a package, and without a text."""
    names = [f"srv {i}" for i in range(N)] + [None]
    servers = [(name, "x86", "Instalado", "Operacional", "Produção", "abc") for name in names]
    texts = ["tomcat", "tomcat 9", "plain", "unknown", None]
    # Two rows that become one when the version of the catalogue hides theirs, and one of another index.
    linked = [("abc", "tomcat", v, "Ativo", "1,5", i, "Alto", "Crítico", "Sim") for v, i in (("8", "0,2"), ("9", "0,2"), ("9", "0,4"))]
    return (
        spark.createDataFrame(servers * 2, SERVERS),
        spark.createDataFrame([(s, t, "20260401") for s in names for t in texts] * 2, INSTANCES),
        spark.createDataFrame([("tomcat", "tomcat", "9", "20260401"), (None, "plain", None, "20260401")], CATALOG),
        spark.createDataFrame(linked, RELATIONSHIPS),
    )


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _facts(gold):
    return sorted(
        ((r["servidor"], r["software_instalado"], r["versao"], r["indice_obsolescencia"]) for r in gold.collect()), key=repr
    )


def test_exact_strategy_has_no_distinct_over_servers(tables):
    gold = build_server_gold(*tables, strategy="exact", audit=False)
    known = [("tomcat", "8", 0.2), ("tomcat", "9", 0.2), ("tomcat", "9", 0.4), ("tomcat 9", "9", 0.2), ("tomcat 9", "9", 0.4)]
    known += [("plain", None, None), ("unknown", None, None), (None, None, None)]
    expected = [(f"srv {i}", *k) for i in range(N) for k in known] + [(None, None, None, None)]
    assert _facts(gold) == sorted(expected, key=repr)
    above = _plan(gold).split("SortMergeJoin")
    assert len(above) > 1 and "Aggregate" not in above[0] and "Broadcast" not in above[0]


def _name_strategy(tables, **extra):
    return build_server_gold(*tables, strategy="name", audit=False, **extra)


def test_name_strategy_joins_products_once_per_text(tables):
    """Software without a model is no group of its own that holds a row for every server."""
    staged = []

    def stage(df):
        staged.append(df)
        return df

    gold = _name_strategy(tables, stage=stage)
    known = [("tomcat", "9", 0.2), ("tomcat", "9", 0.4)] + [(t, None, None) for t in ("tomcat 9", "plain", "unknown", None)]
    expected = [(f"srv {i}", *k) for i in range(N) for k in known] + [(None, None, None, None)]
    assert _facts(gold) == sorted(expected, key=repr)
    assert [f.count() for f in staged if "model_join" in f.columns] == [5]


def test_detail_of_the_name_strategy_has_no_distinct_over_servers(tables):
    gold = _name_strategy(tables)
    detail = server_detail_of_job(gold)
    assert detail.count() == N * 6 + 1 and "detalhe_cabecalho" in detail.columns
    above = _plan(detail).split("SortMergeJoin")
    assert len(above) > 1 and "Aggregate" not in above[0]
