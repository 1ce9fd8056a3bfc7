"""Schema, lineage and data-quality operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BRONZE = "bronze"
MISSING_TEXT = "nan"
LINEAGE_COLUMNS = ("data_processamento", "camada_origem", "nome_arquivo_origem")


def to_text_columns(df: DataFrame, missing: str | None = MISSING_TEXT) -> DataFrame:
    """All columns as text; nulls become the text ``missing`` (None keeps them)."""
    texts = [F.col(f"`{c}`").cast("string") for c in df.columns]
    if missing is not None:
        texts = [F.coalesce(t, F.lit(missing)) for t in texts]
    return df.select(*[t.alias(c) for t, c in zip(texts, df.columns)])


def with_lineage(df: DataFrame, source: Column, layer: str = BRONZE) -> DataFrame:
    """Adds the processing time, the layer of origin and the source file."""
    return df.withColumns(dict(zip(LINEAGE_COLUMNS, (F.current_timestamp(), F.lit(layer), source))))


def has_rows(df: DataFrame) -> bool:
    """Emptiness gate; looks for one row only."""
    return not df.isEmpty()


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("linhas")).withColumn("colunas", F.lit(len(df.columns)).cast("bigint"))


def null_ratios(df: DataFrame) -> DataFrame:
    """Share of nulls by column, in one pass."""
    entries = [
        F.struct(F.lit(c).alias("coluna"), F.avg(F.col(f"`{c}`").isNull().cast("double")).alias("razao_nulos"))
        for c in df.columns
    ]
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def null_profile(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Columns whose share of nulls is above the threshold."""
    return null_ratios(df).filter(F.col("razao_nulos") > threshold)


def text_number(c: Column) -> Column:
    """Double from text, null where it is no number or NaN.

    Text such as '1d' or '2f' is refused, although Java reads it as a number.
    """
    number = F.when(~c.rlike(r"(?i)[0-9.][df]\s*$"), c.try_cast("double"))
    return F.when(~F.isnan(number), number)


def numeric_ratios(df: DataFrame) -> DataFrame:
    """Share of values that read as numbers, by text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    entries = [
        F.struct(
            F.lit(c).alias("coluna"), F.avg(text_number(F.col(f"`{c}`")).isNotNull().cast("double")).alias("razao_numerica")
        )
        for c in texts
    ]
    if not entries:
        return df.sparkSession.createDataFrame([], "coluna string, razao_numerica double")
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def infer_types(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Text columns of which more than ``threshold`` of the values are numbers become double.

    The schema depends on the data, so one row of ratios is read to the driver.
    """
    ratios = {r["coluna"]: r["razao_numerica"] for r in numeric_ratios(df).toLocalIterator()}
    return df.select(
        *[
            (text_number(F.col(f"`{c}`")) if (ratios.get(c) or 0.0) > threshold else F.col(f"`{c}`")).alias(c)
            for c in df.columns
        ]
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Occurrences of every value, as text, of the given columns: coluna, valor, qtd."""
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return texts.unpivot([], columns, "coluna", "valor").groupBy("coluna", "valor").agg(F.count(F.lit(1)).alias("qtd"))


def low_cardinality(df: DataFrame, columns: list[str] | None = None, limit: float = 0.5) -> DataFrame:
    """Distinct values over rows by text column; below ``limit`` the column counts as a category."""
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    per_column = value_counts(df, columns).groupBy("coluna").agg(
        F.count("valor").alias("valores_unicos"), F.sum("qtd").alias("linhas")
    )
    ratio = F.col("valores_unicos") / F.greatest("linhas", F.lit(1))
    return per_column.withColumns({"razao": ratio, "categoria": ratio < limit})
