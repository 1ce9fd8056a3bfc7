"""Parquet sinks and catalog entries."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

COMPRESSION = "snappy"
OVERWRITE_MODES = ("static", "dynamic", "recreate")


def _writer(df: DataFrame) -> DataFrameWriter:
    return df.write.mode("overwrite").format("parquet").option("compression", COMPRESSION)


def overwrite_files(df: DataFrame, path: str) -> str:
    """Replaces the Parquet files below a path."""
    _writer(df).save(path)
    return path


def overwrite_table(
    df: DataFrame,
    table: str,
    path: str,
    partition_by: Sequence[str] = ("anomes",),
    overwrite: str = "static",
    balance: bool = False,
) -> None:
    """Writes a partitioned external table.

    ``static`` replaces the whole table, ``dynamic`` only the partitions present in the frame, and
    ``recreate`` drops the catalog entry first. Recreating is always static: a dropped external table
    keeps its files, and dynamic mode would bring old partitions back. The mode is set on the writer,
    so the session stays as it was. ``balance`` gathers each partition value in few files of even
    size, splitting large values over several tasks.
    """
    if overwrite not in OVERWRITE_MODES:
        raise ValueError(f"unknown overwrite mode: {overwrite}")
    if overwrite == "recreate":
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    if balance:
        df = df.hint("rebalance", *partition_by)
    mode = "dynamic" if overwrite == "dynamic" else "static"
    _writer(df).option("partitionOverwriteMode", mode).option("path", path).partitionBy(*partition_by).saveAsTable(table)


def register_table(spark: SparkSession, table: str, path: str, df: DataFrame) -> None:
    """Catalog entry for existing Parquet files with the schema of ``df``; replaces an older entry."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)


def create_database(spark: SparkSession, name: str, comment: str = "") -> None:
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT '{text}'")


def replace_view(spark: SparkSession, name: str, query: str) -> None:
    """Creates or replaces a persistent view over a SQL text."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def replace_temp_view(df: DataFrame, name: str) -> None:
    """Creates or replaces a session view over a frame."""
    df.createOrReplaceTempView(name)
