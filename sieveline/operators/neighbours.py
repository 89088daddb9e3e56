"""The previous row of an entity in time order, with hot entities split by rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.clock import shift
from sieveline.operators.heavy import FLOOR_ROWS, heavy_cells, mark_heavy, rows_of, same_keys
from sieveline.operators.slices import SLICE, TIE, range_slices


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    max_gap: str | None = None,
    floor: int = FLOOR_ROWS,
) -> DataFrame:
    """``lag(value)`` per ``keys`` in ``order`` (whose first column is the timestamp).

    Entities of up to ``floor`` rows are one window partition each.  The rows of larger ones are cut into slices of about
    ``floor`` rows, wherever these end, be it inside one instant; the first row of a slice takes the last row of the
    entity's previous slice, found among one row per slice.  Rows without a timestamp come first; the order of rows
    that are equal in keys and order is left open.  ``max_gap`` drops a predecessor that lies further back than that.
    """
    keys, order = list(keys), list(order)
    ts = order[0]
    previous = F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    heavy = heavy_cells([df], keys, floor, nulls=True)
    if heavy is None:
        found = df.withColumn("__hit", F.lag(previous).over(inside))
    else:
        rows = rows_of(0)
        marked = mark_heavy(df, heavy, keys)
        ordinary = marked.where(F.col(rows).isNull()).drop(rows)
        hot = marked.where(F.col(rows).isNotNull()).drop(rows)
        sliced = range_slices(hot, keys, order, heavy.agg(F.sum(rows)).first()[0], floor)
        found = ordinary.withColumn("__hit", F.lag(previous).over(inside)).unionByName(_carried(sliced, df, keys, order, previous))
    kept = F.col("__hit.v")
    if max_gap is not None:
        kept = F.when(F.col("__hit.t") >= shift(F.col(ts), max_gap, -1), kept)
    return found.select(*df.columns, kept.alias(out))


def _carried(sliced: DataFrame, df: DataFrame, keys: list[str], order: list[str], previous) -> DataFrame:
    """``__hit``, the previous row, within slices and across their bounds."""
    inside = Window.partitionBy(SLICE, *keys).orderBy(*order, TIE)
    near = sliced.withColumn("__near", F.lag(previous).over(inside))
    newest = F.max(F.struct(*order, TIE, previous.alias("__row")))["__row"]
    ends = sliced.groupBy(*keys, SLICE).agg(newest.alias("__last"))
    across = Window.partitionBy(*keys).orderBy(SLICE)
    carried = ends.select(*keys, SLICE, F.lag("__last").over(across).alias("__far"))
    here = same_keys("n", "c", keys, null_safe=True) & (F.col(f"n.{SLICE}") == F.col(f"c.{SLICE}"))
    joined = near.alias("n").join(carried.alias("c"), here, "left")
    return joined.select(*[F.col(f"n.{c}") for c in df.columns], F.coalesce("n.__near", "c.__far").alias("__hit"))
