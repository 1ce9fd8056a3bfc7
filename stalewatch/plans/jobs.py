"""Jobs over catalog tables: read silver, build gold, write it, publish the views."""

from dataclasses import dataclass

from pyspark.sql import SparkSession

from stalewatch import rules
from stalewatch.plans import view_sql, views
from stalewatch.plans.hub import build_control, build_hub
from stalewatch.plans.ingest import TABLE_PREFIX
from stalewatch.plans.server_gold import build_server_gold
from stalewatch.plans.sigla_gold import build_sigla_gold
from stalewatch.sinks.tables import create_database, overwrite_table, replace_temp_view, replace_view
from stalewatch.sources.tables import read_table
from stalewatch.staging import StageArea


@dataclass(frozen=True)
class Lake:
    """Where the tables live and which period is processed."""

    database: str
    gold: str
    period: str = rules.DEFAULT_PERIOD
    silver_prefix: str = TABLE_PREFIX

    def table(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"


# Names of the gold tables.
SIGLA_GOLD = "case_riscos_gold_risco_tecnologico_por_sigla"
SERVER_GOLD = "case_riscos_gold_obsolescencia_por_servidor"
HUB = "case_riscos_gold_hub_analitico_por_servidor"
CONTROL = "case_riscos_gold_controle_inconformidades_por_servidor"


def _silver(spark: SparkSession, lake: Lake, name: str):
    return read_table(spark, lake.silver_prefix + name, lake.database)


def _write(spark: SparkSession, lake: Lake, df, name: str, overwrite: str) -> None:
    create_database(spark, lake.database)
    overwrite_table(df, lake.table(name), f"{lake.gold}/{name}", overwrite=overwrite)


def run_sigla_gold(spark: SparkSession, lake: Lake, **options) -> None:
    gold = build_sigla_gold(
        _silver(spark, lake, "resultado_query3"),
        _silver(spark, lake, "servidores_siglas"),
        _silver(spark, lake, "cmdb_software_instance_sot"),
        period=lake.period,
        **options,
    )
    _write(spark, lake, gold, SIGLA_GOLD, "static")


def run_server_gold(spark: SparkSession, lake: Lake, strategy: str = "cascade", **options) -> None:
    names = ("servidores_siglas", "cmdb_software_instance_sot", "cmdb_ci_spkg_sot", "resultado_query3")
    with StageArea(spark) as stage:
        tables = [_silver(spark, lake, name) for name in names]
        gold = build_server_gold(*tables, strategy=strategy, period=lake.period, stage=stage, **options)
        _write(spark, lake, gold, SERVER_GOLD, "dynamic")


def run_hub_and_control(spark: SparkSession, lake: Lake, clean: bool = False) -> None:
    """Writes the hub, then the control over the written hub, so the hub is computed once."""
    hub = build_hub(
        read_table(spark, SERVER_GOLD, lake.database),
        _silver(spark, lake, "resultado_query1"),
        _silver(spark, lake, "resultado_query2"),
        lake.period,
        clean,
    )
    _write(spark, lake, hub, HUB, "recreate")
    _write(spark, lake, build_control(read_table(spark, HUB, lake.database), lake.period), CONTROL, "recreate")


# View name -> (gold table, definition as a frame, definition as SQL). The model has two definitions each of the server
# ranking and the server detail under one name; the ones the gold job makes end in "_job".
VIEWS = {
    "case_riscos_vw_ranking_risco_por_servidor": (SERVER_GOLD, views.server_ranking_of_view, view_sql.server_ranking_of_view),
    "case_riscos_vw_ranking_risco_por_servidor_job": (SERVER_GOLD, views.server_ranking_of_job, view_sql.server_ranking_of_job),
    "case_riscos_vw_detalhe_obsolescencia_por_servidor": (SERVER_GOLD, views.server_detail_of_view, view_sql.server_detail_of_view),
    "case_riscos_vw_detalhe_obsolescencia_por_servidor_job": (SERVER_GOLD, views.server_detail_of_job, view_sql.server_detail_of_job),
    "case_riscos_vw_resumo_risco_por_servidor": (SERVER_GOLD, views.server_summary, view_sql.server_summary),
    "case_riscos_vw_resumo_obsolescencia_por_servidor": (SERVER_GOLD, views.sigla_obsolescence_summary, view_sql.sigla_obsolescence_summary),
    "vw_percentual_inconformidade_por_servidor": (SERVER_GOLD, views.nonconform_share, view_sql.nonconform_share),
    "case_riscos_vw_qtd_servidores_por_farol": (SERVER_GOLD, views.servers_by_two_lights, view_sql.servers_by_two_lights),
    "vw_qtd_servidores_por_farol": (SERVER_GOLD, views.servers_by_three_lights, view_sql.servers_by_three_lights),
    "vw_top10_softwares_prioridade_remediacao": (SERVER_GOLD, views.top_software_to_remediate, view_sql.top_software_to_remediate),
    "case_riscos_vw_ranking_risco_por_sigla": (SIGLA_GOLD, views.sigla_ranking, view_sql.sigla_ranking),
    "case_riscos_vw_top_10_siglas_criticas": (SIGLA_GOLD, views.top_critical_siglas, view_sql.top_critical_siglas),
    "case_riscos_vw_resumo_risco_por_sigla": (SIGLA_GOLD, views.summary_by_class, view_sql.summary_by_class),
}


def publish_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Creates or replaces every view in the catalog, beside its gold table, and returns the names ``database.view``.

    The catalog keeps the SQL text: the views outlive the session, and a metastore shows them to other applications.
    """
    for name, (table, _, text) in VIEWS.items():
        gold = read_table(spark, table, lake.database)
        statement = text(gold.columns) if text is view_sql.server_detail_of_job else text()
        replace_view(spark, lake.table(name), statement.format(gold=lake.table(table)))
    return [lake.table(name) for name in VIEWS]


def publish_session_views(spark: SparkSession, lake: Lake) -> None:
    """Makes every view available under its bare name for as long as the session lasts."""
    for name, (table, definition, _) in VIEWS.items():
        replace_temp_view(definition(read_table(spark, table, lake.database)), name)
