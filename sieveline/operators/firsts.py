"""First-seen keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(df: DataFrame, keys: Sequence[str], ts: str, out: str) -> DataFrame:
    """Earliest ``ts`` per key; rows with a NULL key part have no identity and are left out.

    An aggregate rather than a window: map-side combine reduces a hot key before the
    shuffle, and callers join the few keys they need back to their rows.
    """
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(F.min(ts).alias(out))


def distinct_entities(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()
