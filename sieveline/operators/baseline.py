"""Deviation of a bucketed measure from its own group's mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_zscore(buckets: DataFrame, by: Sequence[str], value: str, out: str = "zscore") -> DataFrame:
    """Population z-score of ``value`` within ``by``; NULL where the group does not vary.

    The input is already one row per group and time bucket, so a window partition
    holds at most as many rows as the calendar has buckets, however hot the group.
    """
    group = Window.partitionBy(*by)
    deviation = F.stddev_pop(value).over(group)
    centred = F.col(value) - F.avg(value).over(group)
    return buckets.withColumn(out, F.when(deviation > 0, centred / deviation))
