"""Column profiles and the data behind charts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stalewatch.operators.quality import value_counts
from stalewatch.operators.quantiles import DEFAULT_ACCURACY, exact_quantiles
from stalewatch.staging import stage as staged

QUARTILES = (0.25, 0.5, 0.75)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def other_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]


def value_distribution(df: DataFrame, columns: Sequence[str] | None = None, top: int = 30) -> DataFrame:
    """The most frequent values of every column, null included, with the number of distinct values."""
    counts = value_counts(df, list(columns or other_columns(df)))
    # The test on qtd keeps both branches on the same columns, so that they share one shuffle.
    distinct = counts.groupBy(F.col("coluna").alias("__coluna")).agg(
        F.count_if(F.col("valor").isNotNull() & (F.col("qtd") > 0)).alias("valores_unicos")
    )
    order = Window.partitionBy("coluna").orderBy(F.col("qtd").desc(), F.col("valor").asc_nulls_last())
    best = counts.withColumn("posicao", F.row_number().over(order)).filter(F.col("posicao") <= top)
    return best.join(distinct, F.col("coluna") == F.col("__coluna")).drop("__coluna")


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    accuracy: int = DEFAULT_ACCURACY,
    stage=staged,
) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of every numeric column."""
    columns = list(columns or numeric_columns(df))
    number = lambda c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
    long = df.select(*[number(c).alias(c) for c in columns]).unpivot([], columns, "coluna", "valor")
    moments = long.groupBy("coluna").agg(
        F.count("valor").alias("contagem"),
        F.avg("valor").alias("media"),
        F.stddev_samp("valor").alias("desvio"),
        F.min("valor").alias("minimo"),
        F.max("valor").alias("maximo"),
    )
    quartiles = _quartiles(long, "valor", ["coluna"], accuracy, stage).withColumnRenamed("coluna", "__coluna")
    return moments.join(quartiles, F.col("coluna") == F.col("__coluna"), "left").select(
        "coluna", "contagem", "media", "desvio", "minimo", "q1", "mediana", "q3", "maximo"
    )


def _quartiles(df: DataFrame, value: str, groups: list[str], accuracy: int, stage) -> DataFrame:
    """q1, mediana and q3 as columns."""
    long = exact_quantiles(df, value, QUARTILES, groups, accuracy, stage)
    names = zip(QUARTILES, ("q1", "mediana", "q3"))
    return long.groupBy(*groups).agg(
        *[F.max(F.when(F.col("probabilidade") == p, F.col("quantil"))).alias(n) for p, n in names]
    )


def box_stats(
    df: DataFrame,
    value: str,
    group: str | None = None,
    accuracy: int = DEFAULT_ACCURACY,
    stage=staged,
) -> DataFrame:
    """Minimum, quartiles and maximum of a column, in total or by group."""
    groups = [] if group is None else [group]
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    data = df.select(*groups, number.alias("__value")).filter(F.col("__value").isNotNull())
    ends = data.groupBy(*groups).agg(F.min("__value").alias("minimo"), F.max("__value").alias("maximo"))
    quartiles = _quartiles(data, "__value", groups, accuracy, stage)
    if group is None:
        whole = quartiles.select(F.struct("q1", "mediana", "q3")).scalar()
        joined = ends.withColumn("__q", whole).select("minimo", "__q.*", "maximo")
    else:
        joined = ends.join(
            quartiles.withColumnRenamed(group, "__group"), F.col(group).eqNullSafe(F.col("__group"))
        )
    return joined.select(*groups, "minimo", "q1", "mediana", "q3", "maximo")


def bar_data(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    """The ``n`` (5 to 50) most frequent non-null values; equal counts by value."""
    _within(n, 5, 50)
    return _most_frequent(df, column, n)


def share_data(df: DataFrame, column: str, n: int = 8) -> DataFrame:
    """The ``n`` (3 to 20) most frequent values with their percentage of the values shown."""
    _within(n, 3, 20)
    shown = _most_frequent(df, column, n)
    total = F.sum("quantidade").over(Window.partitionBy())  # at most n rows
    return shown.withColumn("percentual", F.lit(100.0) * F.col("quantidade") / total)


def _most_frequent(df: DataFrame, column: str, n: int) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("quantidade"))
    return counts.orderBy(F.col("quantidade").desc(), F.col(column).asc()).limit(n)


def histogram_data(df: DataFrame, value: str, bins: int = 30, group: str | None = None) -> DataFrame:
    """Rows per bin of equal width between the extremes; empty bins are left out.

    The last bin includes the maximum. When all values are equal they fall in bin 0.
    """
    _within(bins, 10, 100)
    groups = [] if group is None else [group]
    data = df.select(*groups, F.col(value).cast("double").alias("__v")).filter(
        F.col("__v").isNotNull() & ~F.isnan("__v")
    )
    ends = data.agg(F.struct(F.min("__v").alias("lo"), F.max("__v").alias("hi"))).scalar()
    lo, width = F.col("__ends.lo"), F.col("__ends.hi") - F.col("__ends.lo")
    place = F.floor((F.col("__v") - lo) / width * bins)
    binned = data.withColumn("__ends", ends).select(
        *groups,
        F.when(width > 0, F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int").alias("faixa"),
        (width / bins).alias("__step"),
        lo.alias("__lo"),
    )
    return (
        binned.groupBy(*groups, "faixa", "__lo", "__step")
        .agg(F.count(F.lit(1)).alias("quantidade"))
        .select(
            *groups,
            "faixa",
            (F.col("__lo") + F.col("faixa") * F.col("__step")).alias("inicio"),
            (F.col("__lo") + (F.col("faixa") + 1) * F.col("__step")).alias("fim"),
            "quantidade",
        )
    )


def scatter_sample(
    df: DataFrame, columns: Sequence[str], key: str, size: int = 10_000, seed: int = 42, digits: int = 4
) -> DataFrame:
    """All rows up to ``size``, otherwise exactly ``size`` of them chosen by a seeded hash of ``key``.

    The rows of smallest hash are wanted; a null key counts as an empty text. Counts by the first ``digits`` hex digits give the last
    prefix that is needed, so only the rows up to that prefix are sorted.
    """
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))))
    hashed = df.select(key, *[c for c in columns if c != key], digest.alias("__h"))
    prefix = F.substring("__h", 1, digits)
    per_prefix = hashed.groupBy(prefix.alias("__p")).agg(F.count(F.lit(1)).alias("__c"))
    running = Window.partitionBy().orderBy("__p").rowsBetween(Window.unboundedPreceding, 0)  # 16**digits rows
    cut = per_prefix.withColumn("__upto", F.sum("__c").over(running)).agg(
        F.min(F.when(F.col("__upto") >= size, F.col("__p"))).alias("p")
    )
    wanted = prefix <= F.coalesce(cut.scalar(), F.lit("f" * digits))
    return hashed.filter(wanted).orderBy("__h", key, *[c for c in columns if c != key]).limit(size).drop("__h")


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int = 50) -> DataFrame:
    """The first rows in the given order, as a sample of the structure."""
    return df.orderBy(*order).limit(n)


def chartable_columns(df: DataFrame) -> DataFrame:
    """Columns charts can use: numeric ones, and text ones with more than one distinct value.

    More than one distinct value is the same as a minimum that differs from the maximum.
    """
    left_out = (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.ArrayType, T.MapType, T.StructType)
    entries = []
    for f in df.schema.fields:
        numeric = isinstance(f.dataType, T.NumericType)
        if not numeric and isinstance(f.dataType, left_out):
            continue
        c = F.col(f"`{f.name}`")
        usable = F.lit(True) if numeric else F.coalesce(F.min(c) != F.max(c), F.lit(False))
        entries.append(
            F.struct(
                F.lit(f.name).alias("coluna"),
                F.lit("numerica" if numeric else "categorica").alias("papel"),
                usable.alias("__usable"),
            )
        )
    if not entries:
        return df.sparkSession.createDataFrame([], "coluna string, papel string")
    listed = df.agg(F.array(*entries).alias("e"), F.count(F.lit(1)).alias("n")).select(F.inline("e"))
    return listed.filter("__usable").drop("__usable")


def _within(n: int, low: int, high: int) -> None:
    if not low <= n <= high:
        raise ValueError(f"{n} is not between {low} and {high}")
