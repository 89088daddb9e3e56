"""Distinct counts from sketches that are stored per day and united to any window of days.

A day's rows are read once.  Each group keeps a HyperLogLog sketch per counted column, a few kilobytes whatever it
counts, beside exact row counts, minima and maxima.  Sketches unite without error of their own, so weeks are
answered from the stored days alone, and a day that is written again replaces itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LG_K = 12
DAY = "day"


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a united sketch with ``2 ** lg_k`` registers."""
    return 1.04 / 2 ** (lg_k / 2)


def daily_sketches(
    df: DataFrame,
    ts: str,
    by: Sequence[str],
    distinct: Mapping[str, str],
    rows: str = "rows",
    mins: Mapping[str, Column] | None = None,
    maxs: Mapping[str, Column] | None = None,
    lg_k: int = LG_K,
) -> DataFrame:
    """One row per ``by`` and day: row count, extremes, and a sketch for each output name of ``distinct``.

    Counted columns are whole numbers or texts; nulls are not counted.  Sketches are built before the shuffle, so a hot
    group arrives there as one sketch per task.  Rows without a time have no day and are left out.
    """
    dated = df.withColumn(DAY, F.to_date(ts)).where(F.col(DAY).isNotNull())
    return dated.groupBy(*by, DAY).agg(
        F.count(F.lit(1)).alias(rows),
        *[F.min(c).alias(n) for n, c in (mins or {}).items()],
        *[F.max(c).alias(n) for n, c in (maxs or {}).items()],
        *[F.hll_sketch_agg(c, lg_k).alias(n) for n, c in distinct.items()],
    )


def store_days(sketches: DataFrame, path: str) -> None:
    """Adds days to the store at ``path``; a day that is there already is replaced as a whole."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, schema: StructType, first: date | None = None, last: date | None = None) -> DataFrame:
    """Stored days from ``first`` to ``last``, both included; other days' files are not opened."""
    days = spark.read.schema(schema).parquet(path)
    for bound, inside in ((first, lambda b: F.col(DAY) >= F.lit(b)), (last, lambda b: F.col(DAY) <= F.lit(b))):
        if bound is not None:
            days = days.where(inside(bound))
    return days


def unite(
    days: DataFrame,
    by: Sequence[str],
    distinct: Sequence[str],
    rows: str = "rows",
    mins: Sequence[str] = (),
    maxs: Sequence[str] = (),
) -> DataFrame:
    """One row per ``by`` over all ``days``, with estimated distinct counts."""
    return days.groupBy(*by).agg(
        F.sum(rows).alias(rows),
        *[F.min(c).alias(c) for c in mins],
        *[F.max(c).alias(c) for c in maxs],
        *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in distinct],
    )
