"""Catalog tables: scans, SQL, and what the catalog knows about tables and partitions."""

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LIMIT_MIN, LIMIT_MAX, LIMIT_DEFAULT = 10, 10_000, 100


def _qualified(name: str, database: str | None) -> str:
    return f"`{database}`.`{name}`" if database else name


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.table(_qualified(name, database))


def scan(
    df: DataFrame,
    partition_column: str | None = None,
    partitions: Sequence[object] = (),
    limit: int | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Rows of the wanted partitions, up to ``limit``.

    No partition value means no filter. With ``tolerant`` a partition column the table lacks is
    reported as a warning and the filter left out; otherwise it is an analysis error.
    """
    if partition_column and partitions:
        if tolerant and partition_column not in df.columns:
            warnings.warn(f"no column {partition_column}: scanning without the partition filter", stacklevel=2)
        else:
            df = df.filter(F.col(partition_column).isin(*partitions))
    return df if limit is None else limit_rows(df, limit, bounded=False)


def limit_rows(df: DataFrame, limit: int | None = LIMIT_DEFAULT, bounded: bool = True) -> DataFrame:
    """At most ``limit`` rows (None: all); with ``bounded``, a limit outside the range offered to users is an error."""
    if limit is None:
        return df
    if bounded and not LIMIT_MIN <= limit <= LIMIT_MAX:
        raise ValueError(f"{limit} is not between {LIMIT_MIN} and {LIMIT_MAX}")
    return df.limit(limit)


def run_sql(spark: SparkSession, text: str, database: str | None = None) -> DataFrame:
    """Result of a SQL text with ``database`` as the default; the session's own default is restored."""
    if database is None:
        return spark.sql(text)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        return spark.sql(text)
    finally:
        spark.catalog.setCurrentDatabase(before)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables and views of a database, without temporary views."""
    listed = spark.sql(f"SHOW TABLES IN `{database}`").filter(~F.col("isTemporary"))
    return listed.select(F.col("tableName").alias("tabela")).orderBy("tabela")


def partition_keys(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def partition_values(spark: SparkSession, table: str) -> DataFrame:
    """Distinct partition values, newest first; the values of several keys are joined by '/'."""
    value = lambda part: F.url_decode(
        F.replace(F.substring_index(part, "=", -1), F.lit("+"), F.lit("%2B"))
    )
    joined = F.array_join(F.transform(F.split("partition", "/"), value), "/")
    return spark.sql(f"SHOW PARTITIONS {table}").select(joined.alias("valor")).distinct().orderBy(F.desc("valor"))
