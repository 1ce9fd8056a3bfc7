"""Files, catalog, sinks and the jobs over them, in temporary folders."""

import os
import uuid
from urllib.parse import unquote

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from workbooks import write_workbook

from stalewatch.plans import jobs
from stalewatch.plans.explore import explore
from stalewatch.plans.ingest import ingest
from stalewatch.sinks import tables as sinks
from stalewatch.sources import files
from stalewatch.sources import tables as sources
from stalewatch.staging import StageArea, shared_folder, stage


@pytest.fixture
def database(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    sinks.create_database(spark, name, "it's a test")
    return name


def save(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))
    return str(path)


def collected(df):
    return [tuple(r) for r in df.collect()]


def test_csv_detection(spark, tmp_path):
    latin = save(f"{tmp_path}/a/latin.csv", "Ação;Nome;Nome\n1,5;José;x\nNA;;y\n", "latin-1")
    df = files.read_file(spark, latin)
    assert df.columns == ["ação", "nome", "nome_1"]
    assert collected(df) == [("1,5", "José", "x"), (None, None, "y")]
    bom = save(f"{tmp_path}/a/bom.csv", "﻿Sigla SS\tV\nabc\tçã\n")
    assert files.read_file(spark, bom).columns == ["sigla_ss", "v"]
    assert collected(files.read_file(spark, bom)) == [("abc", "çã")]
    quoted = save(f"{tmp_path}/a/quoted.csv", 'a,b\n"x, ""y""",1\n"two\nlines",2\n')
    assert collected(files.read_file(spark, quoted)) == [('x, "y"', "1"), ("two\nlines", "2")]
    single = save(f"{tmp_path}/a/single.csv", "only\nv1\nv2\n")
    assert collected(files.read_file(spark, single)) == [("v1",), ("v2",)]
    with pytest.raises(ValueError):
        files.read_file(spark, save(f"{tmp_path}/a/empty.csv", ""))


def test_pick_delimiter():
    assert files.pick_delimiter('"a;b;c;d",x') == ","
    assert files.pick_delimiter("a|b|c") == "|" and files.pick_delimiter("alone") == ","


def test_workbook(spark, tmp_path):
    path = f"{tmp_path}/w.XLSX"
    write_workbook(path, [["Nome", "Índice", None, "Nome"], ["a", 1.5, True, "zz"], [None, None, None, None], ["ab", None, None, 7]])
    df = files.read_file(spark, path)
    assert df.columns == ["nome", "índice", "unnamed_2", "nome_1"]
    assert collected(df) == [("a", "1.5", "True", "zz"), ("ab", None, None, "7")]
    with pytest.raises(ValueError):
        files.read_file(spark, f"{tmp_path}/w.ods")


def test_workbook_dates(spark, tmp_path):
    path = f"{tmp_path}/d.xlsx"
    write_workbook(path, [["a", "b", "c", "d"], [(45292, 1), (45292.5, 2), (45292, 3), (45292, 0)]])
    assert collected(files.read_file(spark, path)) == [("2024-01-01", "2024-01-01 12:00:00", "45292", "45292")]


def test_listing_is_recursive_and_ignores_case(spark, tmp_path):
    for name in ("x/a.csv", "x/y/b.CSV", "x/c.txt", "x/d.XlSx"):
        save(f"{tmp_path}/{name}", "c\n1\n")
    found = {os.path.basename(r["path"]) for r in files.list_files(spark, f"{tmp_path}/x").collect()}
    assert found == {"a.csv", "b.CSV", "d.XlSx"}


def test_ingest(spark, tmp_path, database):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    save(f"{bronze}/Servidores Siglas/1.csv", "Nome,Sigla\nold,abc\n")
    save(f"{bronze}/Servidores Siglas/2.csv", "Nome,Sigla\nsrv,\nsrv2,\n")
    save(f"{bronze}/Servidores Siglas/3.csv", "Nome,Sigla\n")
    os.makedirs(f"{bronze}/nothing")
    with open(f"{bronze}/Servidores Siglas/4.xlsx", "wb") as f:
        f.write(b"not a workbook")
    report = ingest(spark, bronze, silver, database, ["Servidores Siglas", "nothing", "missing"])
    status = {(r["pasta"], r["situacao"]) for r in report.collect()}
    assert status == {
        ("Servidores Siglas", "erro"),
        ("Servidores Siglas", "vazio"),
        ("Servidores Siglas", "gravado"),
        ("nothing", "sem arquivo"),
        ("missing", "erro"),
    }
    written = report.filter("situacao = 'gravado'").head()
    assert (written["linhas"], written["colunas"], written["colunas_nulas"]) == (2, 2, ["sigla"])
    table = sources.read_table(spark, "case_riscos_servidores_siglas", database)
    assert {(r["nome"], r["sigla"], r["camada_origem"]) for r in table.collect()} == {("srv", "nan", "bronze"), ("srv2", "nan", "bronze")}
    assert {os.path.basename(r["nome_arquivo_origem"]) for r in table.collect()} == {"2.csv"}

    ingest(spark, bronze, silver, database, ["Servidores Siglas"], mode="union")
    spark.catalog.refreshTable(f"{database}.case_riscos_servidores_siglas")
    assert sources.read_table(spark, "case_riscos_servidores_siglas", database).count() == 3


def test_damaged_files_are_isolated(spark, tmp_path, database):
    bronze = f"{tmp_path}/bronze"
    save(f"{bronze}/f/1.csv", "Nome,Valor\na,1\nb,\nc,\n")
    save(f"{bronze}/f/2.csv", "Nome,Valor\nd,4\n")
    save(f"{bronze}/f/3 bytes.csv", "Nome,Valor\nx,\x005\n")
    save(f"{bronze}/f/4 open.csv", 'Nome,Valor\ny,"6\nz,7\n')
    save(f"{bronze}/f/5 head.csv", "Nome,Valor\n")
    write_workbook(f"{bronze}/f/6 head.xlsx", [["Nome", "Valor"], [None, None]])
    save(f"{bronze}/f/7.xlsx", "PK damaged")
    for mode, linhas, nulos in (("last", 1, []), ("union", 4, [])):
        report = ingest(spark, bronze, f"{tmp_path}/{mode}", database, ["f"], mode=mode, null_threshold=0.5).collect()
        assert {(os.path.basename(unquote(r["arquivo"])), r["situacao"]) for r in report} == {
            ("3 bytes.csv", "erro"), ("4 open.csv", "erro"), ("5 head.csv", "vazio"), ("6 head.xlsx", "vazio"), ("7.xlsx", "erro"),
            ("2.csv" if mode == "last" else "f", "gravado"),
        }
        written = next(r for r in report if r["situacao"] == "gravado")
        assert (written["linhas"], written["colunas"], written["colunas_nulas"]) == (linhas, 2, nulos)
        assert spark.read.parquet(f"{tmp_path}/{mode}/case_riscos_f").count() == linhas


def test_failed_jobs_are_narrowed_down_to_the_file():
    from stalewatch.plans.ingest import _isolated

    calls, report = [], []

    def inspect(paths):
        calls.append(paths)
        if "p5" in paths:
            raise OSError("gone")
        return {p: p.upper() for p in paths}

    paths = [f"p{i}" for i in range(8)]
    assert _isolated(paths, inspect, {"pasta": "f"}, report) == {p: p.upper() for p in paths if p != "p5"}
    assert report == [{"pasta": "f", "arquivo": "p5", "situacao": "erro", "erro": "gone"}] and len(calls) == 7


def test_union_of_dialects(spark, tmp_path, database):
    bronze = f"{tmp_path}/bronze"
    for n in range(4):
        save(f"{bronze}/mixed/part {n}.csv", f"Nome;Valor\nn{n};é{n}\n", "latin-1" if n % 2 else "utf-8")
    save(f"{bronze}/mixed/other.csv", "Extra,Nome\nx,y\n")
    save(f"{bronze}/mixed/blank.csv", "")
    write_workbook(f"{bronze}/mixed/book.xlsx", [["Nome", "Valor"], ["w", 1]])
    report = ingest(spark, bronze, f"{tmp_path}/silver", database, ["mixed"], mode="union")
    assert sorted((r["situacao"], r["linhas"]) for r in report.collect()) == [("gravado", 6)]
    rows = sources.read_table(spark, "case_riscos_mixed", database).select("nome", "valor", "extra").collect()
    expected = {(f"n{n}", f"é{n}", "nan") for n in range(4)} | {("y", "nan", "x"), ("w", "1", "nan")}
    assert {tuple(r) for r in rows} == expected


def frame(spark, *values):
    return spark.createDataFrame(values, "v int, anomes string")


def contents(spark, table):
    return sorted(collected(spark.table(table).select("v", F.col("anomes").cast("string"))))


@pytest.mark.parametrize(
    "mode, expected",
    [("static", [(9, "202602")]), ("dynamic", [(1, "202601"), (9, "202602")]), ("recreate", [(9, "202602")])],
)
def test_overwrite_modes(spark, tmp_path, database, mode, expected):
    table, path = f"{database}.t_{mode}", f"{tmp_path}/t"
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    sinks.overwrite_table(frame(spark, (1, "202601"), (2, "202602"), (3, "202602")), table, path)
    sinks.overwrite_table(frame(spark, (9, "202602")), table, path, overwrite=mode, balance=True)
    assert contents(spark, table) == expected
    assert sorted(collected(spark.read.parquet(path).select("v"))) == [(v,) for v, _ in expected]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    with pytest.raises(ValueError):
        sinks.overwrite_table(frame(spark), table, path, overwrite="other")


def test_catalog_queries(spark, tmp_path, database):
    two = spark.createDataFrame([(1, "202601", "a b"), (2, "202602", "c+d")], "v int, anomes string, k string")
    sinks.overwrite_table(two, f"{database}.zeta", f"{tmp_path}/z", ["anomes", "k"])
    sinks.overwrite_table(frame(spark, (1, "202601")), f"{database}.alfa", f"{tmp_path}/a")
    sinks.replace_temp_view(two, "temporary_one")
    assert [r[0] for r in sources.list_tables(spark, database).collect()] == ["alfa", "zeta"]
    assert sources.partition_keys(spark, f"{database}.zeta") == ["anomes", "k"]
    assert [r[0] for r in sources.partition_values(spark, f"{database}.zeta").collect()] == ["202602/c+d", "202601/a b"]

    sinks.replace_view(spark, f"{database}.vista", f"SELECT v FROM {database}.zeta")
    sinks.replace_view(spark, f"{database}.vista", f"SELECT v + 1 AS v FROM {database}.zeta")
    before = spark.catalog.currentDatabase()
    assert sorted(collected(sources.run_sql(spark, "SELECT v FROM vista", database))) == [(2,), (3,)]
    assert spark.catalog.currentDatabase() == before


def test_register_replaces_the_schema(spark, tmp_path, database):
    table = f"{database}.silver"
    for df in (spark.range(2).toDF("a"), spark.range(3).select("id", F.lit("x").alias("b"))):
        path = sinks.overwrite_files(df, f"{tmp_path}/files")
        sinks.register_table(spark, table, path, df)
        spark.catalog.refreshTable(table)
    assert spark.table(table).columns == ["id", "b"] and spark.table(table).count() == 3


def test_scan(spark):
    df = frame(spark, (1, "202601"), (2, "202602"), (3, "202603"))
    assert sources.scan(df, "anomes", ["202601", "202603"]).count() == 2
    assert sources.scan(df, "anomes", ["202602"], limit=5).count() == 1
    assert sources.scan(df).count() == 3 and sources.scan(df, limit=2).count() == 2
    with pytest.warns(UserWarning):
        assert sources.scan(df, "other", ["x"], tolerant=True).count() == 3
    with pytest.raises(AnalysisException):
        sources.scan(df, "other", ["x"])
    many = spark.range(200)
    assert [sources.limit_rows(many, n).count() for n in (10, 50, None)] == [10, 50, 200]
    for outside in (5, 50_000):
        with pytest.raises(ValueError):
            sources.limit_rows(many, outside)
    assert sources.limit_rows(many).count() == 100


def test_partition_filter_reaches_the_files(spark, tmp_path, database):
    sinks.overwrite_table(frame(spark, (1, "202601"), (2, "202602")), f"{database}.p", f"{tmp_path}/p")
    plan = sources.scan(spark.table(f"{database}.p"), "anomes", ["202602"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anomes" in plan and "PushedFilters: []" in plan


def test_stage_keeps_rows_and_schema(spark):
    df = frame(spark, (1, "a"), (None, None))
    staged = stage(df)
    assert staged.schema == df.schema and sorted(collected(staged), key=repr) == sorted(collected(df), key=repr)
    assert stage(df.limit(0)).count() == 0


def test_stage_area_removes_its_files(spark):
    with StageArea(spark) as area:
        staged = area(frame(spark, (1, "a")), "area")
        path = staged.inputFiles()[0].removeprefix("file://")
        assert staged.count() == 1 and os.path.exists(path) and shared_folder(spark) in path
    assert not os.path.exists(os.path.dirname(path))


def test_explore(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "y")], "n string, c string")
    found = explore(df)
    assert dict(found.rows.dtypes) == {"n": "double", "c": "string"}
    assert found.summary.head()["mediana"] == 2.0
    assert {tuple(r) for r in found.chartable.collect()} == {("n", "numerica"), ("c", "categorica")}
    assert explore(df.select("c")).summary is None


def test_jobs_end_to_end(spark, tmp_path, database):
    from test_linking import inventory

    servers, instances, catalog, relationships = inventory(spark)
    bronze = f"{tmp_path}/bronze"
    dims = {
        "resultado_query1": spark.createDataFrame(
            [("ABC", "d", "Com", "Dir", "Tier 1")], "sigla_ss string, descricao_da_sigla string, comunidade string, diretoria string, criticidade_final string"
        ),
        "resultado_query2": spark.createDataFrame([("Tomcat", "p", "d", "s")], "nome string, pillar string, dominio string, subdominio string"),
        "resultado_query3": relationships,
        "servidores_siglas": servers,
        "cmdb_software_instance_sot": instances,
        "cmdb_ci_spkg_sot": catalog,
    }
    for name, df in dims.items():
        df.coalesce(1).write.option("header", True).csv(f"{bronze}/{name}")
    report = ingest(spark, bronze, f"{tmp_path}/silver", database)
    assert {r["situacao"] for r in report.collect()} == {"gravado"}

    lake = jobs.Lake(database, f"{tmp_path}/gold", "202601")
    jobs.run_sigla_gold(spark, lake)
    jobs.run_server_gold(spark, lake)
    jobs.run_hub_and_control(spark, lake)
    published = jobs.publish_views(spark, lake)

    assert spark.table(f"{database}.{jobs.SERVER_GOLD}").count() == 11
    hub = spark.table(f"{database}.{jobs.HUB}")
    assert hub.filter("Criticidade = 'Tier 1'").count() > 0 and hub.filter("Criticidade = 'Não informado'").count() > 0
    control = spark.table(f"{database}.{jobs.CONTROL}").collect()
    assert len(control) == 1 and control[0]["total_registros"] == hub.count() and control[0]["farol"] == "Vermelho"
    # the silver text 'nan' is a sigla of its own in the risk table
    jobs.publish_session_views(spark, lake)
    assert "nan" in {r["sigla"] for r in spark.table("case_riscos_vw_ranking_risco_por_sigla").collect()}
    assert spark.sql("SELECT * FROM vw_top10_softwares_prioridade_remediacao").count() <= 10
    # The views of the catalog hold the same rows, also for a session that has not made them.
    other = spark.newSession()
    assert len(published) == len(jobs.VIEWS) == 13
    for name, (gold, definition, _) in jobs.VIEWS.items():
        shown = other.table(f"{database}.{name}")
        expected = definition(spark.table(f"{database}.{gold}"))
        assert shown.columns == expected.columns and dict(shown.dtypes) == dict(expected.dtypes)
        assert sorted(collected(shown), key=repr) == sorted(collected(expected), key=repr)
    jobs.publish_views(spark, lake)
    assert {f"`{database}`.`{r['tabela']}`" for r in sources.list_tables(other, database).collect()} >= set(published)
    assert sources.partition_keys(spark, f"{database}.{jobs.HUB}") == ["anomes"]


def test_control_over_an_empty_hub(spark):
    from stalewatch.plans.hub import build_control

    row = build_control(spark.createDataFrame([], "Conformidade string"), audit=False).head()
    assert (row["total_registros"], row["total_inconformes"], row["percentual_inconformidade"], row["farol"]) == (0, None, None, "Vermelho")


def test_csv_fields_beyond_the_header_are_kept(spark, tmp_path):
    ragged = save(f"{tmp_path}/ragged.csv", "a,b\n3,4,5\n6\n")
    df = files.read_file(spark, ragged)
    assert df.columns == ["a", "b", "unnamed_2"]
    assert sorted(collected(df)) == [("3", "4", "5"), ("6", None, None)]


def test_csv_header_with_a_line_break(spark, tmp_path):
    broken = save(f"{tmp_path}/broken.csv", '"a\nx",b\n1,2,"3\n4"\n')
    df = files.read_file(spark, broken)
    assert df.columns == ["a_x", "b", "unnamed_2"]
    assert collected(df) == [("1", "2", "3\n4")]


def test_workbook_cells_right_of_the_header_are_kept(spark, tmp_path):
    path = f"{tmp_path}/wide.xlsx"
    write_workbook(path, [["A", "B"], ["1", "2", "3"]])
    df = files.read_file(spark, path)
    assert df.columns == ["a", "b", "unnamed_2"] and collected(df) == [("1", "2", "3")]
