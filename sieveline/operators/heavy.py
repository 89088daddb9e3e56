"""Cells, that is keys or keys and time bins, that hold so many rows that one task should not serve them alone.

A join or window plans its salts from one pass over its inputs: rows are counted per cell, and the few cells above a
floor come to the driver as a local table.  Without any the plain plan is used; the counted inputs are never part of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, isqrt

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells up to this size are ordinary work for one task.
FLOOR_ROWS = 100_000
# Of the cells above the floor the largest count as heavy, which bounds every local table and broadcast of them.
MOST_CELLS = 100_000
# Pairs of rows that one task of a join is meant to meet: a few seconds of work, whatever is written from it.
TASK_PAIRS = 2**23
# More tasks than that cost more to keep than they spread; beyond it a task meets more pairs.
MOST_TASKS = 20_000


def same_keys(left: str, right: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Join condition: equal ``keys`` of two aliased frames."""
    cond = F.lit(True)
    for k in keys:
        a, b = F.col(f"{left}.{k}"), F.col(f"{right}.{k}")
        cond = cond & (a.eqNullSafe(b) if null_safe else a == b)
    return cond


def rows_of(side: int) -> str:
    """Name of a side's row count in a table of heavy cells."""
    return f"__rows{side}"


def _cell_counts(sides: Sequence[DataFrame], cell: Sequence[str], nulls: bool) -> DataFrame:
    """Every side's rows per cell."""
    counts = [rows_of(at) for at in range(len(sides))]
    tagged = reduce(
        DataFrame.unionByName,
        [
            side.select(*cell, *[F.lit(int(at == other)).cast("bigint").alias(c) for other, c in enumerate(counts)])
            for at, side in enumerate(sides)
        ],
    )
    if not nulls:
        tagged = tagged.dropna(subset=list(cell))
    return tagged.groupBy(*cell).agg(*[F.sum(c).alias(c) for c in counts])


def heavy_cells(
    sides: Sequence[DataFrame],
    cell: Sequence[str],
    floor: int = FLOOR_ROWS,
    most: int = MOST_CELLS,
    nulls: bool = False,
) -> DataFrame | None:
    """Cells where a side has more than ``floor`` rows, with every side's row count; None where no cell has.

    Runs one job that reads each side once, for the columns of ``cell`` alone.  The result is a local table of the ``most``
    largest cells at most; a cell beyond those holds less than ``1 / most`` of all rows.  A cell with a missing part
    counts only with ``nulls``.
    """
    cells = _cell_counts(sides, cell, nulls)
    counts = [rows_of(at) for at in range(len(sides))]
    largest = F.greatest(*counts) if len(counts) > 1 else F.col(counts[0])
    found = cells.where(largest > floor).orderBy(largest.desc()).limit(most).toArrow()
    return cells.sparkSession.createDataFrame(found, cells.schema) if found.num_rows else None


def counted_join(
    sides: Sequence[DataFrame],
    cell: Sequence[str],
    floor: int = FLOOR_ROWS,
    pairs: int = TASK_PAIRS,
    most: int = MOST_CELLS,
) -> tuple[DataFrame | None, int, float]:
    """:func:`heavy_cells` of the two sides of a join, how many tasks of ``pairs`` pairs each the join has work for, and
    the pairs that a row takes part in, on average.

    A cell is heavy as well whose sides make more than ``pairs`` pairs, however few their rows.  All of it comes from
    the same one job: the cells that are not heavy come to the driver as one row.
    """
    counted = _cell_counts(sides, cell, nulls=False)
    counts = [rows_of(at) for at in range(2)]
    met = F.col(counts[0]).cast("double") * F.col(counts[1])
    heavy = (F.greatest(*counts) > floor) | (met > pairs)
    found = (
        counted.groupBy(F.when(heavy, F.struct(*cell)).alias("__cell"))
        .agg(*[F.sum(c).alias(c) for c in counts], F.sum(met).alias("__met"))
        .orderBy(F.col("__cell").isNotNull(), F.desc("__met"))
        .limit(most + 1)
        .select("__cell.*", *counts, "__met")
    )
    table = found.toArrow()
    total, rows = (sum(pc.sum(table[c]).as_py() or 0 for c in names) for names in (["__met"], counts))
    kept = table.filter(pc.is_valid(table[cell[-1]])).drop_columns(["__met"])
    cells = counted.sparkSession.createDataFrame(kept, found.drop("__met").schema) if kept.num_rows else None
    return cells, min(ceil(total / pairs), MOST_TASKS), total / max(rows, 1)


def joined_cells(
    sides: Sequence[DataFrame],
    cell: Sequence[str],
    floor: int = FLOOR_ROWS,
    pairs: int = TASK_PAIRS,
    most: int = MOST_CELLS,
) -> tuple[DataFrame | None, int]:
    """The heavy cells and the tasks that :func:`counted_join` tells."""
    return counted_join(sides, cell, floor, pairs, most)[:2]


def join_salts(floor: int = FLOOR_ROWS, pairs: int = TASK_PAIRS) -> list[Column]:
    """Each side's salts in a join whose cells are marked by :func:`counted_join`: ``floor`` rows to a salt, or as many
    as meet as many of the other side in ``pairs`` pairs."""
    counts = [F.col(rows_of(at)) for at in range(2)]
    crowded = counts[0].cast("double") * counts[1] > pairs
    return [F.when(crowded, salts_of(c, min(floor, isqrt(pairs)))).otherwise(salts_of(c, floor)) for c in counts]


def mark_heavy(df: DataFrame, heavy: DataFrame, cell: Sequence[str]) -> DataFrame:
    """Adds the row counts of heavy cells, NULL for any other; ``heavy`` is broadcast, as its size is bounded."""
    joined = df.alias("d").join(F.broadcast(heavy).alias("h"), same_keys("d", "h", cell, null_safe=True), "left")
    added = [c for c in heavy.columns if c not in cell]
    return joined.select(*[F.col(f"d.{c}") for c in df.columns], *[F.col(f"h.{c}") for c in added])


def salts_of(rows: Column, floor: int = FLOOR_ROWS) -> Column:
    """How many salts a cell with that many rows is split over, ``floor`` rows each; ordinary cells (NULL) get one."""
    return F.when(F.coalesce(rows, F.lit(0)) == 0, F.lit(1)).otherwise(F.ceil(rows / F.lit(max(floor, 1))).cast("int"))


def row_spread(df: DataFrame) -> Column:
    """A number to salt rows by; the partition id spreads exact copies of a row as well."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns]), F.lit(2**31 - 1))


def every_salt(salts: Column) -> Column:
    """All salts below ``salts``, as an array to explode."""
    return F.sequence(F.lit(0), salts - 1)
