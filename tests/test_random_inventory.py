"""The three strategies on random inventories against direct SQL over all pairs."""

import random
import re

import duckdb
import pandas as pd
import pytest
from compare import duck_table, spark_table

from stalewatch.plans.server_gold import build_server_gold
from stalewatch.suite.oracle import CTES

WORDS = ["Oracle", "oracle db", "Java", "jdk", "java  se", "App", "SQL", "Server", "linux"]
VERSIONS = ["8.0", "19.3.0", "v2022", "2022", "11.0.1", "nan", "", None]
SIGLAS = ["ABC", " abc ", "Def", "ghi", "empty string", None]
COLUMNS = {
    "servidores_siglas": ["nome", "arquitetura", "status", "status_operacional", "ambiente", "sigla"],
    "software_instance": ["installed_on", "software", "anomesdia"],
    "software_catalog": ["model_id", "name", "version", "anomesdia"],
    "relationships": "sigla_ss produto versao status criticidade indice_obsolescencia rating impacto cloud".split(),
}


def random_tables(seed):
    rng = random.Random(seed)
    pick = rng.choice

    def name():
        return pick([" ".join(pick(WORDS) for _ in range(rng.randint(1, 2))), pick(WORDS), "nan", None])

    def software():
        parts = [pick(WORDS) for _ in range(rng.randint(1, 3))] + [pick(VERSIONS) or ""]
        return pick(["  ".join(parts), " ".join(parts), parts[0], None])

    def server():
        return pick([f"srv {rng.randint(0, 6)}", f"SRV  {rng.randint(0, 6)}", None])

    number = ["0", "0,5", "1,25", "nan", "n/d", None]
    rows = {
        "servidores_siglas": [[server(), pick(["x86", "nan"]), "I", "Op", pick(["P", "H"]), pick(SIGLAS)] for _ in range(14)],
        "software_instance": [[server(), software(), "20260401"] for _ in range(60)],
        "software_catalog": [[pick([*WORDS, None]), name(), pick(VERSIONS), "20260401"] for _ in range(30)],
        "relationships": [
            [pick(SIGLAS), name(), pick(VERSIONS), "A", pick(number), pick(number), pick(["Alto", "", None]), pick(["Crítico", None]), "sim"]
            for _ in range(60)
        ],
    }
    return {t: pd.DataFrame(r, columns=COLUMNS[t], dtype=object) for t, r in rows.items()}


def direct_sql(final):
    """CTEs without the fixture derivations, which are tables here."""
    needed = set()

    def visit(name):
        needed.add(name)
        for word in set(re.findall(r"\b\w+\b", CTES[name])) & CTES.keys() - needed:
            if not word.startswith("fx_"):
                visit(word)

    visit(final)
    parts = ", ".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in CTES if n in needed)
    return f"WITH {parts} SELECT * FROM {final}"


@pytest.mark.parametrize("seed", range(3))
def test_strategies(spark, seed):
    tables = random_tables(seed)
    con = duckdb.connect()
    frames = []
    for name, columns in COLUMNS.items():
        con.register(f"raw_{name}", tables[name])
        typed = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
        con.execute(f"CREATE TABLE fx_{name} AS SELECT {typed} FROM raw_{name}")
        values = [tuple(r) for r in tables[name].itertuples(index=False)]
        frames.append(spark.createDataFrame(values, ", ".join(f"{c} string" for c in columns)))
    for strategy, final in (("cascade", "gold"), ("exact", "gold_v2"), ("name", "gold_v1")):
        found = build_server_gold(*frames, strategy=strategy, audit=False)
        assert spark_table(found) == duck_table(con, direct_sql(final)), strategy
    by_sigla = build_server_gold(*frames, audit=False, extra_partition=["sigla_join"])
    assert spark_table(by_sigla) == duck_table(con, direct_sql("gold_s"))
