"""Grouped counts with several exact distinct counts.

Catalyst computes several distinct counts by expanding every input row once per
counted column.  Aggregating to one row per (group, entities) first keeps that
expansion away from raw telemetry: raw rows meet one hash aggregate with map-side
combine, and only the reduced rows are expanded.  Both shuffles are keyed by the
group *and* the entities, so a group that holds a large share of the rows is
spread over many tasks and reaches its final task as a handful of partial sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROWS = "__rows"


def spread_profile(
    df: DataFrame,
    by: Sequence[str],
    distinct: Mapping[str, str],
    rows: str = "rows",
    sums: Mapping[str, Column] | None = None,
    mins: Mapping[str, Column] | None = None,
    maxs: Mapping[str, Column] | None = None,
    sample_min: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per ``by`` with a row count, distinct counts and further aggregates.

    ``distinct`` maps output name to counted column.  ``sample_min`` maps output name
    to a column whose smallest value stands in for "any value"; it rides along as a
    grouping key of the first phase so that phase stays a hash aggregate.
    """
    sums, mins, maxs, sample_min = sums or {}, mins or {}, maxs or {}, sample_min or {}
    keys = list(dict.fromkeys([*by, *distinct.values(), *sample_min.values()]))
    measures = (
        [F.count(F.lit(1)).alias(_ROWS)]
        + [F.sum(c).alias(f"__sum_{n}") for n, c in sums.items()]
        + [F.min(c).alias(f"__min_{n}") for n, c in mins.items()]
        + [F.max(c).alias(f"__max_{n}") for n, c in maxs.items()]
    )
    reduced = df.groupBy(*keys).agg(*measures)
    return reduced.groupBy(*by).agg(
        F.coalesce(F.sum(_ROWS), F.lit(0)).alias(rows),
        *[F.count_distinct(F.col(c)).alias(n) for n, c in distinct.items()],
        *[F.sum(f"__sum_{n}").alias(n) for n in sums],
        *[F.min(f"__min_{n}").alias(n) for n in mins],
        *[F.max(f"__max_{n}").alias(n) for n in maxs],
        *[F.min(c).alias(n) for n, c in sample_min.items()],
    )


def first_non_null(value: str, order: Sequence[str]) -> Column:
    """Aggregate: the non-null value of the earliest row, ties broken by the value itself."""
    ranked = F.struct(*[F.col(c) for c in order], F.col(value).alias("__value"))
    return F.min(F.when(F.col(value).isNotNull(), ranked))["__value"]
