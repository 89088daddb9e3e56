"""Ordered rows of hot entities as slices of bounded size, for scans that carry one row from slice to slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.heavy import FLOOR_ROWS
from sieveline.sources.artifacts import staged

SLICE, TIE = "__slice", "__tie"


def range_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, floor: int = FLOOR_ROWS) -> DataFrame:
    """``df`` with ``__slice``: consecutive stretches of its rows in (keys, order, ``__tie``) of about ``floor`` rows each.

    ``rows`` is the row count of ``df``.  Slices come from a range partitioning and are numbered in its order, nulls first.
    ``__tie`` numbers the rows, so that a slice can end between rows of equal keys and order.  The slices are
    stored once: whatever reads them, or reads them again after a lost executor, sees the same bounds.
    """
    tied = df.withColumn(TIE, F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(max(1, -(-rows // max(floor, 1))), *keys, *order, TIE)
    return staged(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")
