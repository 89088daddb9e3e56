"""Ordering at the sink: total orders with NULLs last, and bounded top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_keys(order: Sequence[str]) -> list[Column]:
    """``"-name"`` sorts descending, ``"name"`` ascending; NULLs come last either way."""
    return [F.desc_nulls_last(o[1:]) if o.startswith("-") else F.asc_nulls_last(o) for o in order]


def ranked(df: DataFrame, order: Sequence[str], limit: int | None = None) -> DataFrame:
    """Sorted result; with a limit Spark plans a per-partition top-k and one small merge."""
    out = df.orderBy(*sort_keys(order))
    return out.limit(limit) if limit is not None else out
