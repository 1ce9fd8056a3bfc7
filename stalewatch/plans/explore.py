"""Exploring one table: filtered scan, typed columns, profile and chart data."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stalewatch.operators import profiling
from stalewatch.operators.quality import infer_types
from stalewatch.sources.tables import scan
from stalewatch.staging import stage as staged


@dataclass(frozen=True)
class Exploration:
    """Typed rows, kept once, and what is shown of them: every other result reads the kept rows."""

    rows: DataFrame
    distribution: DataFrame
    summary: DataFrame | None
    chartable: DataFrame

    def first_rows(self, order: Sequence[str] | None = None, n: int = 50) -> DataFrame:
        """The first rows, by the given columns or all of them, as a sample of the structure."""
        return profiling.first_rows(self.rows, order or self.rows.columns, n)

    def bars(self, column: str, n: int = 15) -> DataFrame:
        return profiling.bar_data(self.rows, column, n)

    def shares(self, column: str, n: int = 8) -> DataFrame:
        return profiling.share_data(self.rows, column, n)

    def histogram(self, value: str, bins: int = 30, group: str | None = None) -> DataFrame:
        return profiling.histogram_data(self.rows, value, bins, group)

    def scatter(self, x: str, y: str, key: str, size: int = 10_000) -> DataFrame:
        return profiling.scatter_sample(self.rows, [x, y], key, size)

    def boxes(self, value: str, group: str | None = None) -> DataFrame:
        return profiling.box_stats(self.rows, value, group)


def explore(
    table: DataFrame,
    partition_column: str | None = None,
    partitions: Sequence[object] = (),
    limit: int | None = None,
    stage=staged,
) -> Exploration:
    """Profile of the wanted partitions. ``stage`` keeps the typed rows between the results."""
    rows = scan(table, partition_column, partitions, limit, tolerant=True)
    typed = stage(infer_types(stage(rows) if limit is not None else rows))
    return Exploration(
        rows=typed,
        distribution=profiling.value_distribution(typed),
        summary=profiling.numeric_summary(typed) if profiling.numeric_columns(typed) else None,
        chartable=profiling.chartable_columns(typed),
    )
