"""Registered queries: name -> function (spark, table folder) -> DataFrame."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stalewatch.functions.names import with_clean_names
from stalewatch.operators import cleaning, conversations, profiling, quality
from stalewatch.operators.containment import contained_terms
from stalewatch.operators.dedup import distinct_rows, one_row_per_key
from stalewatch.plans import jobs, sigla_gold, views
from stalewatch.plans.explore import explore
from stalewatch.plans.hub import build_control, build_hub
from stalewatch.plans.ingest import ingest, ingest_folder
from stalewatch.plans.server_gold import build_server_gold
from stalewatch.sinks import tables as sinks
from stalewatch.sources import tables as sources
from stalewatch.staging import remove, scratch_path, stage
from stalewatch.suite.fixtures import base_table, fixture

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SYSTEM_TEXT = "Responda em português."
PROMPT_TEXT = "Qual servidor tem o maior risco?"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Raw doubles rounded, so that the order of summation does not show."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


#: Queries over a gold table: how the table is built, and the query over the written table.
OVER_GOLD: dict[str, tuple[Query, Callable[[SparkSession, str, DataFrame], DataFrame]]] = {}


def query_over(build: Query) -> Callable:
    """Registers a query that builds and writes its gold table itself, as views read written tables."""

    def register(function):
        def whole(spark: SparkSession, d: str) -> DataFrame:
            return function(spark, d, stage(build(spark, d), "gold"))

        QUERIES[function.__name__] = whole
        OVER_GOLD[function.__name__] = build, function
        return function

    return register


def _server_inputs(spark: SparkSession, d: str) -> list[DataFrame]:
    names = ("servidores_siglas", "software_instance", "software_catalog", "relationships")
    return [fixture(spark, d, n) for n in names]


def _build_cascade(spark: SparkSession, d: str) -> DataFrame:
    return build_server_gold(*_server_inputs(spark, d), audit=False, stage=stage)


def _sigla_inputs(spark: SparkSession, d: str) -> list[DataFrame]:
    return [fixture(spark, d, n) for n in ("relationships", "servidores_siglas", "software_instance")]


def _build_sigla(spark: SparkSession, d: str) -> DataFrame:
    return sigla_gold.build_sigla_gold(*_sigla_inputs(spark, d), audit=False)


# --- cleaning --------------------------------------------------------------------------------------


@query
def treat_risks(spark, d):
    return cleaning.treat_risks(fixture(spark, d, "relationships"))


@query
def treat_servers(spark, d):
    return cleaning.treat_servers(fixture(spark, d, "servidores_siglas"))


@query
def treat_servers_basic_key(spark, d):
    return cleaning.treat_servers(fixture(spark, d, "servidores_siglas"), generation=1)


@query
def treat_instances(spark, d):
    return cleaning.treat_software_instances(fixture(spark, d, "software_instance"))


@query
def treat_instances_basic_key(spark, d):
    return cleaning.treat_software_instances(fixture(spark, d, "software_instance"), generation=1)


@query
def treat_catalog(spark, d):
    return cleaning.treat_software_catalog(fixture(spark, d, "software_catalog"))


@query
def treat_relationships(spark, d):
    return cleaning.treat_relationships(fixture(spark, d, "relationships"))


@query
def treat_relationships_nan_kept(spark, d):
    """NaN shows as the text 'NaN', so that both engines can be compared."""
    treated = cleaning.treat_relationships(fixture(spark, d, "relationships"), nan_policy="keep")
    shown = F.when(F.isnan("indice_obsolescencia"), "NaN").otherwise(
        F.when(F.col("indice_obsolescencia") > 0, "positivo").otherwise("zero")
    )
    return treated.groupBy("sigla_join", shown.alias("indice")).agg(F.count(F.lit(1)).alias("n"))


@query
def dim_siglas(spark, d):
    return cleaning.prepare_dim_siglas(fixture(spark, d, "query1"))


@query
def dim_produtos(spark, d):
    return cleaning.prepare_dim_produtos(fixture(spark, d, "query2"))


@query_over(_build_cascade)
def gold_join_keys(spark, d, gold):
    keyed = cleaning.prepare_server_gold(gold)
    return keyed.select("servidor", "software_instalado", "sigla_join", "produto_join")


@query
def keyed_dedup(spark, d):
    return one_row_per_key(base_table(spark, d, "part").select("p_name", "p_brand", "p_type"), ["p_name"])


@query
def full_row_distinct(spark, d):
    return distinct_rows(base_table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


# --- linking ---------------------------------------------------------------------------------------


@query
def contained_names(spark, d):
    instances = cleaning.treat_software_instances(fixture(spark, d, "software_instance"))
    names = cleaning.treat_software_catalog(fixture(spark, d, "software_catalog"), dedup=False)
    return contained_terms(
        instances.select("software_join"), names.select("name_join").distinct(), "software_join", "name_join"
    )


@query
def gold_server_v1(spark, d):
    return build_server_gold(*_server_inputs(spark, d), strategy="name", audit=False, stage=stage)


@query
def gold_server_v2(spark, d):
    return build_server_gold(*_server_inputs(spark, d), strategy="exact", audit=False, stage=stage)


@query
def gold_server_v3(spark, d):
    return _build_cascade(spark, d)


@query
def gold_server_v3_by_sigla(spark, d):
    return build_server_gold(*_server_inputs(spark, d), audit=False, extra_partition=["sigla_join"], stage=stage)


@query_over(_build_cascade)
def match_tier_counts(spark, d, gold):
    tiers = ("tipo_match_catalogo", "tipo_match_relacionamento")
    numbers = ("prioridade_match_catalogo", "prioridade_match_relacionamento")
    return gold.groupBy(*tiers, *numbers).agg(F.count(F.lit(1)).alias("n"))


# --- views of the server gold ----------------------------------------------------------------------


@query_over(_build_cascade)
def rank_server_job(spark, d, gold):
    ranked = views.server_ranking_of_job(gold)
    return _rounded(ranked, "media_indice_obsolescencia", "media_criticidade", "score_risco_servidor")


@query_over(_build_cascade)
def rank_server_view(spark, d, gold):
    return _rounded(views.server_ranking_of_view(gold), "score_risco_servidor")


@query_over(_build_cascade)
def summary_server(spark, d, gold):
    return _rounded(views.server_summary(gold), "media_indice_obsolescencia", "media_criticidade")


@query_over(_build_cascade)
def summary_sigla(spark, d, gold):
    return views.sigla_obsolescence_summary(gold)


@query_over(_build_cascade)
def pct_nonconform(spark, d, gold):
    return views.nonconform_share(gold)


@query_over(_build_cascade)
def server_flag(spark, d, gold):
    return views.server_flags(gold)


@query_over(_build_cascade)
def farol2(spark, d, gold):
    return views.servers_by_two_lights(gold)


@query_over(_build_cascade)
def farol3(spark, d, gold):
    return views.servers_by_three_lights(gold)


@query_over(_build_cascade)
def remediation(spark, d, gold):
    return views.software_remediation(gold)


@query
def top10_remediation(spark, d):
    """The flagship: from the raw inventory to the ten software versions to remediate first."""
    return views.top_software_to_remediate(_build_cascade(spark, d))


@query_over(_build_cascade)
def detail_job(spark, d, gold):
    return views.server_detail_of_job(gold)


@query_over(_build_cascade)
def detail_view(spark, d, gold):
    return views.server_detail_of_view(gold)


@query
def detail_job_v1(spark, d):
    return views.server_detail_of_job(gold_server_v1(spark, d))


# --- gold by sigla ---------------------------------------------------------------------------------


@query
def risks_by_sigla(spark, d):
    risks = sigla_gold.aggregate_risks(cleaning.treat_risks(fixture(spark, d, "relationships")))
    return _rounded(risks, "media_indice_obsolescencia", "media_criticidade")


@query
def servers_by_sigla(spark, d):
    return sigla_gold.aggregate_servers(fixture(spark, d, "servidores_siglas"))


@query
def software_per_server(spark, d):
    return sigla_gold.software_per_server(fixture(spark, d, "software_instance"))


@query
def software_by_sigla(spark, d):
    software = sigla_gold.aggregate_software(
        fixture(spark, d, "software_instance"), fixture(spark, d, "servidores_siglas")
    )
    return _rounded(software, "media_softwares_por_servidor")


_SIGLA_DOUBLES = (
    "media_indice_obsolescencia",
    "media_criticidade",
    "media_softwares_por_servidor",
    "score_risco_operacional",
)


@query
def gold_sigla(spark, d):
    return _rounded(sigla_gold.build_sigla_gold(*_sigla_inputs(spark, d), audit=False), *_SIGLA_DOUBLES)


@query
def gold_sigla_null_as_zero(spark, d):
    gold = sigla_gold.build_sigla_gold(*_sigla_inputs(spark, d), audit=False, null_as_zero=True, clean=True)
    return _rounded(gold, *_SIGLA_DOUBLES)


@query_over(_build_sigla)
def rank_sigla(spark, d, gold):
    return _rounded(views.sigla_ranking(gold), *_SIGLA_DOUBLES)


@query_over(_build_sigla)
def top10_sigla(spark, d, gold):
    return _rounded(
        views.top_critical_siglas(gold), "media_indice_obsolescencia", "score_risco_operacional"
    )


@query_over(_build_sigla)
def summary_class(spark, d, gold):
    return views.summary_by_class(gold)


# --- hub and control -------------------------------------------------------------------------------


def _build_hub(spark: SparkSession, d: str, gold: DataFrame) -> DataFrame:
    return build_hub(gold, fixture(spark, d, "query1"), fixture(spark, d, "query2"))


@query_over(_build_cascade)
def hub(spark, d, gold):
    return _build_hub(spark, d, gold)


@query_over(_build_cascade)
def control(spark, d, gold):
    return build_control(_build_hub(spark, d, gold), audit=False)


# --- quality ---------------------------------------------------------------------------------------


def _patchy_events(spark: SparkSession, d: str) -> DataFrame:
    """Events as text with blanks of different density."""
    events = base_table(spark, d, "events")

    def blanked(column: str, n: int):
        return F.when(F.col("event_id") % n != 0, F.col(column).cast("string"))

    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("tipo_raro"),
        blanked("value", 50).alias("valor_denso"),
        blanked("value", 4).alias("valor_falho"),
        F.col("event_type").alias("tipo"),
    )


@query
def null_profile(spark, d):
    return _rounded(quality.null_profile(_patchy_events(spark, d)), "razao_nulos")


@query
def null_ratios(spark, d):
    return _rounded(quality.null_ratios(_patchy_events(spark, d)), "razao_nulos")


@query
def table_shape(spark, d):
    return quality.shape(base_table(spark, d, "events"))


@query
def typed_inference(spark, d):
    return quality.infer_types(_patchy_events(spark, d))


@query
def low_cardinality(spark, d):
    found = quality.low_cardinality(_patchy_events(spark, d), ["id", "tipo", "tipo_raro"])
    return _rounded(found, "razao")


@query
def text_columns(spark, d):
    return quality.to_text_columns(_patchy_events(spark, d))


# --- profiling and chart data ----------------------------------------------------------------------


@query
def value_distribution(spark, d):
    orders = base_table(spark, d, "orders").select("o_orderstatus", "o_orderpriority")
    return profiling.value_distribution(orders)


@query
def value_distribution_with_nulls(spark, d):
    return profiling.value_distribution(_patchy_events(spark, d).select("tipo", "tipo_raro", "valor_falho"))


@query
def numeric_summary(spark, d):
    lines = base_table(spark, d, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    found = profiling.numeric_summary(lines, columns, stage=stage)
    return _rounded(found, "media", "desvio", "q1", "mediana", "q3", digits=4)


@query
def bar_topn(spark, d):
    return profiling.bar_data(base_table(spark, d, "events"), "event_type", 5)


@query
def share_topn(spark, d):
    return _rounded(profiling.share_data(base_table(spark, d, "orders"), "o_orderpriority", 3), "percentual")


@query
def histogram(spark, d):
    found = profiling.histogram_data(base_table(spark, d, "orders"), "o_totalprice", 30)
    return _rounded(found, "inicio", "fim", digits=4)


@query
def histogram_by_group(spark, d):
    found = profiling.histogram_data(base_table(spark, d, "events"), "value", 20, "event_type")
    return _rounded(found, "inicio", "fim", digits=4)


@query
def scatter_sample(spark, d):
    lines = base_table(spark, d, "lineitem").withColumn(
        "chave", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    )
    sample = profiling.scatter_sample(lines, ["l_quantity", "l_extendedprice"], "chave")
    return sample.select("l_quantity", "l_extendedprice")


@query
def box_stats(spark, d):
    found = profiling.box_stats(base_table(spark, d, "events"), "value", "event_type", stage=stage)
    return _rounded(found, "q1", "mediana", "q3", digits=4)


@query
def box_stats_whole(spark, d):
    found = profiling.box_stats(base_table(spark, d, "orders"), "o_totalprice")
    return _rounded(found, "q1", "mediana", "q3", digits=4)


@query
def chartable_columns(spark, d):
    return profiling.chartable_columns(base_table(spark, d, "orders"))


@query
def first_rows(spark, d):
    return profiling.first_rows(base_table(spark, d, "orders"), ["o_orderkey"])


# --- scans -----------------------------------------------------------------------------------------


def _orders_by_month(spark: SparkSession, d: str) -> DataFrame:
    return base_table(spark, d, "orders").withColumn("anomes", F.date_format("o_orderdate", "yyyyMM"))


@query
def partition_scan(spark, d):
    return sources.scan(_orders_by_month(spark, d), "anomes", ["199801", "199803", "199912"])


@query
def partition_scan_single(spark, d):
    return sources.scan(_orders_by_month(spark, d), "anomes", ["199801"])


@query
def partition_scan_fallback(spark, d):
    return sources.scan(base_table(spark, d, "orders"), "anomes", ["199801"], tolerant=True)


@query
def row_limit(spark, d):
    limited = sources.limit_rows(base_table(spark, d, "orders"))
    return limited.agg(F.count(F.lit(1)).alias("linhas"))


@query
def adhoc_sql(spark, d):
    base_table(spark, d, "orders").createOrReplaceTempView("adhoc_orders")
    text = "SELECT o_orderstatus, count(*) AS n FROM adhoc_orders GROUP BY o_orderstatus"
    return sources.run_sql(spark, text, "default")


@query
def explore_distribution(spark, d):
    found = explore(_patchy_events(spark, d).select("tipo", "valor_denso"), "anomes", ["202604"])
    return found.distribution


@query
def explore_summary(spark, d):
    found = explore(_patchy_events(spark, d).select("tipo", "valor_denso"), stage=stage)
    return _rounded(found.summary, "media", "desvio", "q1", "mediana", "q3", digits=4)


# --- conversations ---------------------------------------------------------------------------------


@query
def conv_context(spark, d):
    return conversations.build_context(base_table(spark, d, "conversations"), SYSTEM_TEXT, PROMPT_TEXT)


@query
def conv_context_lists(spark, d):
    context = conversations.build_context(base_table(spark, d, "conversations"), SYSTEM_TEXT, PROMPT_TEXT)
    lists = conversations.context_lists(context)
    shown = F.array_join(F.transform("mensagens", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return lists.select("conv_id", "parte", shown.alias("mensagens"))


@query
def conv_questions(spark, d):
    return conversations.question_counts(base_table(spark, d, "conversations"))


# --- sinks and catalog -----------------------------------------------------------------------------


def _order_years(spark: SparkSession, d: str) -> DataFrame:
    return base_table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("anomes")
    )


def _after_overwrite(spark: SparkSession, d: str, overwrite: str, result: Callable[[str], DataFrame]) -> DataFrame:
    """Result read from a partitioned table of all orders after a second load in the given mode."""
    with _catalog(spark, "orders") as (database, folder):
        table = f"{database}.orders"
        sinks.overwrite_table(_order_years(spark, d), table, f"{folder}/orders", balance=True)
        sinks.overwrite_table(_second_load(spark, d), table, f"{folder}/orders", overwrite=overwrite)
        return stage(result(table), "orders")


def _second_load(spark: SparkSession, d: str) -> DataFrame:
    """Later load of two years with doubled prices."""
    years = _order_years(spark, d).filter(F.col("anomes").isin("1998", "1999"))
    return years.withColumn("o_totalprice", F.col("o_totalprice") * 2)


def _totals(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("anomes").cast("string").alias("anomes")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query
def sink_static(spark, d):
    return _after_overwrite(spark, d, "static", lambda table: _totals(spark.table(table)))


@query
def sink_dynamic(spark, d):
    return _after_overwrite(spark, d, "dynamic", lambda table: _totals(spark.table(table)))


@query
def sink_recreate(spark, d):
    return _after_overwrite(spark, d, "recreate", lambda table: _totals(spark.table(table)))


@query
def partition_values(spark, d):
    return _after_overwrite(spark, d, "dynamic", lambda table: sources.partition_values(spark, table))


@query
def registered_files(spark, d):
    with _catalog(spark, "files") as (database, folder):
        path = sinks.overwrite_files(_order_years(spark, d), f"{folder}/orders")
        sinks.register_table(spark, f"{database}.orders", path, spark.read.parquet(path))
        return stage(_totals(spark.table(f"{database}.orders")), "orders")


@query
def ingest_silver(spark, d):
    """Relationships written as Latin-1 files with semicolons, then loaded into a silver table."""
    options = {"sep": ";", "header": True, "encoding": "ISO-8859-1"}
    with _catalog(spark, "silver") as (database, folder):
        bronze = f"{folder}/bronze"
        fixture(spark, d, "relationships").write.options(**options).csv(f"{bronze}/resultado_query3")
        ingest_folder(spark, "resultado_query3", bronze, f"{folder}/silver", database, mode="union")
        loaded = sources.read_table(spark, "case_riscos_resultado_query3", database)
        return stage(loaded.drop("data_processamento", "nome_arquivo_origem"), "silver")


@contextmanager
def _catalog(spark: SparkSession, label: str) -> Iterator[tuple[str, str]]:
    """A database and a folder of its own; both go with the block, so results must be staged in it."""
    folder = scratch_path(spark, label)
    database = "suite_" + folder.rsplit("/", 1)[-1].replace("-", "_")
    sinks.create_database(spark, database, label)
    try:
        yield database, folder
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
        remove(spark, folder)


#: View -> (columns that tell its rows apart, the number that is compared).
VIEW_ROWS = {
    "case_riscos_vw_ranking_risco_por_servidor": (views.SERVER_PLACE, "score_risco_servidor"),
    "case_riscos_vw_ranking_risco_por_servidor_job": ((*views.SERVER_PLACE, "classificacao_risco_servidor"), "score_risco_servidor"),
    "case_riscos_vw_detalhe_obsolescencia_por_servidor": (("servidor", "sigla_origem", "software_instalado", "versao", "rating"), "indice_obsolescencia"),
    "case_riscos_vw_detalhe_obsolescencia_por_servidor_job": (("servidor", "software_instalado", "tipo_match_catalogo", "tipo_match_relacionamento"), "criticidade"),
    "case_riscos_vw_resumo_risco_por_servidor": (views.SERVER, "media_indice_obsolescencia"),
    "case_riscos_vw_resumo_obsolescencia_por_servidor": (("sigla_origem",), "media_criticidade"),
    "vw_percentual_inconformidade_por_servidor": (views.SERVER, "percentual_inconformidade"),
    "case_riscos_vw_qtd_servidores_por_farol": (("farol",), "qtd_servidores"),
    "vw_qtd_servidores_por_farol": (("farol",), "percentual_servidores"),
    "vw_top10_softwares_prioridade_remediacao": (("software_instalado", "versao"), "score_prioridade_remediacao"),
    "case_riscos_vw_ranking_risco_por_sigla": (("sigla", "classificacao_risco"), "score_risco_operacional"),
    "case_riscos_vw_top_10_siglas_criticas": (("sigla",), "score_risco_operacional"),
    "case_riscos_vw_resumo_risco_por_sigla": (("classificacao_risco",), "score_medio"),
}


@query
def published_views(spark, d):
    """Every view read from the catalog by its name, over gold tables of the catalog."""
    with _catalog(spark, "views") as (database, folder):
        lake = jobs.Lake(database, folder)
        for name, gold in ((jobs.SERVER_GOLD, _build_cascade(spark, d)), (jobs.SIGLA_GOLD, _build_sigla(spark, d))):
            sinks.overwrite_table(gold, lake.table(name), f"{folder}/{name}")
        jobs.publish_views(spark, lake)
        shown = None
        for name, (keys, value) in VIEW_ROWS.items():
            number = F.round(F.col(value).cast("double"), 4).alias("valor")
            rows = spark.table(lake.table(name)).select(F.lit(name).alias("visao"), F.concat_ws("|", *keys).alias("chave"), number)
            shown = rows if shown is None else shown.union(rows)
        return stage(shown, "views")


def _lines(spark: SparkSession, rows: DataFrame, folder: str, files: int, header: str) -> None:
    """Text files, one per folder, of a header and the column ``linha`` by ``arquivo`` and ``ordem``."""
    heads = spark.range(files).select(F.col("id").cast("int").alias("arquivo"), F.lit(-1).cast("long").alias("ordem"), F.lit(header).alias("linha"))
    ordered = heads.union(rows.select("arquivo", "ordem", "linha")).repartition(files, "arquivo").sortWithinPartitions("arquivo", "ordem")
    ordered.select("arquivo", "linha").write.partitionBy("arquivo").text(folder)


def _csv_names(spark: SparkSession, folder: str) -> None:
    """Gives the text files the suffix by which files are found."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for row in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path").collect():
        if row["path"].endswith(".txt"):
            system.rename(path(row["path"]), path(row["path"][:-4] + ".csv"))


@query
def ingest_ragged(spark, d):
    """Parts as hand-made CSV: stray quotes, line breaks and delimiters inside quotes, more fields than the header."""
    parts = base_table(spark, d, "part")
    line = F.concat(
        "p_partkey", F.lit(","), "p_size", F.lit('" tela,"'), "p_name", F.lit(', ""novo""\n'), "p_brand", F.lit('"'),
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(","), "p_type", F.lit(",5\" y"))).otherwise(""),
    )
    rows = parts.select((F.col("p_partkey") % 4).cast("int").alias("arquivo"), F.col("p_partkey").alias("ordem"), line.alias("linha"))
    with _catalog(spark, "ragged") as (database, folder):
        _lines(spark, rows, f"{folder}/bronze/partes", 4, "Chave,Medida,Descrição")
        _csv_names(spark, f"{folder}/bronze/partes")
        ingest_folder(spark, "partes", f"{folder}/bronze", f"{folder}/silver", database, mode="union")
        loaded = sources.read_table(spark, "case_riscos_partes", database)
        return stage(loaded.drop("data_processamento", "nome_arquivo_origem"), "ragged")


def _bronze_with_damage(spark: SparkSession, d: str, folder: str) -> None:
    """Two sound files of relationships, one with a null byte in every line, one that ends in an open quote, one of a header only."""
    line = F.concat_ws(";", "sigla_ss", "produto", "versao", "rating")
    rows = fixture(spark, d, "relationships").select(line.alias("linha"), F.crc32(line).alias("ordem"))
    sound = rows.select((F.char_length("linha") % 2).alias("arquivo"), "ordem", "linha")
    broken = rows.select(F.lit(2).alias("arquivo"), "ordem", F.concat("linha", F.lit("\0")).alias("linha"))
    opened = rows.select(F.lit(3).alias("arquivo"), "ordem", "linha")
    end = spark.range(1).select(F.lit(3).alias("arquivo"), F.lit(1 << 40).alias("ordem"), F.lit('"sem fim').alias("linha"))
    _lines(spark, sound.union(broken).union(opened).union(end), folder, 5, "Sigla SS;Produto;Versão;Rating")
    _csv_names(spark, folder)


@query
def ingest_report(spark, d):
    """Verdict on every file of a folder with damaged files, and the sizes of the table made of the sound ones."""
    with _catalog(spark, "report") as (database, folder):
        _bronze_with_damage(spark, d, f"{folder}/bronze/relacoes")
        report = ingest(spark, f"{folder}/bronze", f"{folder}/silver", database, ["relacoes", "ausente"], mode="union")
        number = F.regexp_extract("arquivo", "arquivo(=|%3D)([0-9])", 2).alias("arquivo")
        nulls = F.array_join("colunas_nulas", ",").alias("colunas_nulas")
        return stage(report.select("pasta", "tabela", number, "situacao", "linhas", "colunas", nulls), "report")


@query
def ingest_last(spark, d):
    """The last sound file of a folder whose last files are damaged or empty."""
    with _catalog(spark, "last") as (database, folder):
        _bronze_with_damage(spark, d, f"{folder}/bronze/relacoes")
        ingest_folder(spark, "relacoes", f"{folder}/bronze", f"{folder}/silver", database)
        loaded = sources.read_table(spark, "case_riscos_relacoes", database)
        return stage(loaded.drop("data_processamento", "nome_arquivo_origem"), "last")


@query
def list_tables(spark, d):
    """Tables and views of a database, without temporary views."""
    with _catalog(spark, "listing") as (database, folder):
        sinks.overwrite_table(_order_years(spark, d), f"`{database}`.pedidos", f"{folder}/p")
        sinks.overwrite_files(_order_years(spark, d), f"{folder}/f")
        sinks.register_table(spark, f"`{database}`.arquivos", f"{folder}/f", _order_years(spark, d))
        sinks.replace_view(spark, f"`{database}`.totais", f"SELECT anomes, count(*) AS n FROM `{database}`.pedidos GROUP BY anomes")
        sinks.replace_temp_view(_order_years(spark, d), "suite_temporaria")
        return stage(sources.list_tables(spark, database), "listing")


@query
def partition_keys(spark, d):
    """Partition columns of a table, in their order."""
    with _catalog(spark, "keys") as (database, folder):
        orders = _order_years(spark, d).join(base_table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
        sinks.overwrite_table(orders, f"`{database}`.pedidos", f"{folder}/p", ["anomes", "o_orderstatus"])
        found = sources.partition_keys(spark, f"{database}.pedidos")
        return spark.createDataFrame(list(enumerate(found)), "posicao int, coluna string")


@query
def partition_scan_table(spark, d):
    """Two years of a partitioned catalog table; only their folders are read."""
    with _catalog(spark, "scan") as (database, folder):
        sinks.overwrite_table(_order_years(spark, d), f"`{database}`.pedidos", f"{folder}/p")
        found = sources.scan(sources.read_table(spark, "pedidos", database), "anomes", ["1995", "1997"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        if "PartitionFilters: [" not in plan or "anomes" not in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]:
            raise AssertionError("the partition filter does not reach the scan")
        return stage(found, "scan")


@query
def clean_names(spark, d):
    """Column names with accents, signs, blanks and repeats, made clean and unique."""
    names = ["Código do Pedido", " Código-do-Pedido ", "PREÇO (R$)", "%%", "código_do_pedido_1", "Estado/UF"]
    columns = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate", "o_orderstatus")
    return with_clean_names(base_table(spark, d, "orders").select(*columns).toDF(*names))


# --- exploration of one typed frame ----------------------------------------------------------------


def _explored(spark: SparkSession, d: str):
    return explore(_patchy_events(spark, d))


@query
def explore_first_rows(spark, d):
    return _explored(spark, d).first_rows(["id"])


@query
def explore_bars(spark, d):
    return _explored(spark, d).bars("tipo", 5)


@query
def explore_histogram(spark, d):
    return _rounded(_explored(spark, d).histogram("valor_denso", 20, "tipo"), "inicio", "fim", digits=4)


@query
def explore_boxes(spark, d):
    return _rounded(_explored(spark, d).boxes("valor_denso", "tipo"), "q1", "mediana", "q3", digits=4)


@query
def explore_chartable(spark, d):
    return _explored(spark, d).chartable
