"""Bronze to silver: raw extract folders become registered all-text Parquet tables."""

import logging
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stalewatch.functions.names import normalize_name
from stalewatch.operators.quality import MISSING_TEXT, to_text_columns, with_lineage
from stalewatch.sinks.tables import create_database, overwrite_files, register_table
from stalewatch.sources.files import (
    CSV,
    NULL_TOKENS,
    SOURCE,
    Dialect,
    Inspection,
    inspect_books,
    inspect_csv,
    list_files,
    read_book,
    read_csv_files,
    union_files,
)
from stalewatch.sources.workbook import WorkbookShape

logger = logging.getLogger(__name__)

# Folders of the bronze layer and the prefix of the tables made of them.
SOURCE_FOLDERS = (
    "cmdb_ci_spkg_sot",
    "cmdb_software_instance_sot",
    "resultado_query1",
    "resultado_query2",
    "resultado_query3",
    "servidores_siglas",
)
TABLE_PREFIX = "case_riscos_"
REPORT_SCHEMA = (
    "pasta string, tabela string, arquivo string, situacao string, linhas bigint, colunas int, "
    "colunas_nulas array<string>, segundos double, erro string"
)


def _entry(folder: str, table: str, path: str | None, status: str, **values: object) -> dict[str, object]:
    return {"pasta": folder, "tabela": table, "arquivo": path, "situacao": status, **values}


def _isolated(paths: Sequence[str], inspect: Callable, failed: dict, report: list) -> dict[str, object]:
    """What ``inspect`` finds in the files, all in one job; should the job fail, halves narrow it down to the files at fault."""
    if not paths:
        return {}
    try:
        return inspect(list(paths))
    except Exception as error:  # any unreadable file must not stop the others
        if len(paths) == 1:
            logger.exception("cannot read %s", paths[0])
            report.append({**failed, "arquivo": paths[0], "situacao": "erro", "erro": str(error)[:500]})
            return {}
    half = len(paths) // 2
    return _isolated(paths[:half], inspect, failed, report) | _isolated(paths[half:], inspect, failed, report)


def _usable_files(spark, paths, failed, report) -> dict[str, Inspection | WorkbookShape]:
    """Verdict on every file after a full read: those with rows and without a fault; the others enter the report."""
    texts = sorted(p for p in paths if p.lower().endswith(CSV))
    books = sorted(set(paths) - set(texts))
    found = _isolated(texts, lambda some: inspect_csv(spark, some), failed, report)
    found |= _isolated(books, lambda some: inspect_books(spark, some), failed, report)
    told = {e["arquivo"] for e in report}
    usable = {}
    for path in sorted(paths):
        look = found.get(path)
        if look is not None and look.fault is None and look.rows > 0:
            usable[path] = look
        elif look is not None and look.fault is not None:
            logger.error("%s: %s", path, look.fault)
            report.append({**failed, "arquivo": path, "situacao": "erro", "erro": look.fault[:500]})
        elif path not in told:
            report.append({**failed, "arquivo": path, "situacao": "vazio"})
    return usable


def _frames(spark, usable, null_tokens) -> list[DataFrame]:
    """One frame per CSV dialect, so thousands of similar files take a few reads, and one per workbook."""
    groups: dict[Dialect, list[str]] = {}
    frames = []
    for path, look in usable.items():
        if isinstance(look, Inspection):
            groups.setdefault(look.dialect, []).append(path)
        else:
            frames.append(read_book(spark, path, look))
    return [read_csv_files(spark, files, dialect, null_tokens) for dialect, files in groups.items()] + frames


def ingest_folder(
    spark: SparkSession,
    folder: str,
    bronze: str,
    silver: str,
    database: str,
    mode: str = "last",
    null_tokens: Sequence[str] = NULL_TOKENS,
    missing: str | None = MISSING_TEXT,
    null_threshold: float = 0.5,
) -> list[dict[str, object]]:
    """Loads one folder into its silver table and returns the report entries.

    Every file is read as a whole once, all CSV files in one job and all workbooks in another, for a verdict: a file that
    cannot be read or decoded is reported as an error, one without rows as empty. ``mode="last"`` then loads the
    last sound file by path, which would overwrite the others anyway; ``mode="union"`` loads all sound files. The second read
    writes the table; its row count and null shares are observed while it is written.
    """
    if mode not in ("last", "union"):
        raise ValueError(f"unknown mode: {mode}")
    start = time.perf_counter()
    table = TABLE_PREFIX + normalize_name(folder)
    failed = _entry(folder, table, None, "")
    report: list[dict[str, object]] = []
    paths = [r["path"] for r in list_files(spark, f"{bronze}/{folder}").select("path").toLocalIterator()]
    usable = _usable_files(spark, paths, failed, report)
    if not usable:
        return report or [_entry(folder, table, None, "sem arquivo")]
    if mode == "last":
        usable = {max(usable): usable[max(usable)]}

    rows = union_files(_frames(spark, usable, null_tokens))
    business = [c for c in rows.columns if c != SOURCE]
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(business)]
    seen = Observation()
    ordered = rows.select(*business, SOURCE).observe(seen, F.count(F.lit(1)).alias("linhas"), *nulls)
    silver_rows = with_lineage(to_text_columns(ordered, missing), F.col(SOURCE)).drop(SOURCE)
    path = overwrite_files(silver_rows, f"{silver}/{table}")
    register_table(spark, f"`{database}`.`{table}`", path, silver_rows)
    count = seen.get["linhas"]
    mostly_null = sorted(c for i, c in enumerate(business) if seen.get[f"n{i}"] > null_threshold * count)
    if mostly_null:
        logger.warning("%s: mostly null columns %s", table, mostly_null)
    report.append(
        _entry(
            folder,
            table,
            next(iter(usable)) if mode == "last" else f"{bronze}/{folder}",
            "gravado",
            linhas=count,
            colunas=len(business),
            colunas_nulas=mostly_null,
            segundos=time.perf_counter() - start,
        )
    )
    return report


def ingest(
    spark: SparkSession,
    bronze: str,
    silver: str,
    database: str,
    folders: Sequence[str] = SOURCE_FOLDERS,
    **options: object,
) -> DataFrame:
    """Loads every folder and returns the ingest report; a folder that fails does not stop the rest."""
    create_database(spark, database, "Silver tables of the risk model")
    report: list[dict[str, object]] = []
    for folder in folders:
        try:
            report.extend(ingest_folder(spark, folder, bronze, silver, database, **options))
        except Exception as error:
            logger.exception("cannot ingest %s", folder)
            table = TABLE_PREFIX + normalize_name(folder)
            report.append(_entry(folder, table, None, "erro", erro=str(error)[:500]))
    names = [part.split()[0] for part in REPORT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(entry.get(n) for n in names) for entry in report], REPORT_SCHEMA)
