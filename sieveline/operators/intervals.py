"""Time-interval joins as binned equi-joins, and first-match-after without pair explosion.

Bins are as wide as the interval, so an interval touches exactly two of them.  The
bin is part of the join key: an entity with a large share of the rows is split
along time, and salts split what is left inside one bin.  Salts are planned from one
count of both sides, and tasks from the pairs that it foretells: what a join gives may be
far larger than what it reads.  Only candidates of two neighbouring bins ever meet; the
exact range test stays on the join condition, with bounds that are told once a row.

A join of many pairs a row meets tiles, short runs of a bin's rows in order of time, instead of rows.
Tiles apart in time are never opened, and the pairs of two tiles come out in loops whose values
repeat in runs and at equal distance, so columnar files of a large result stay small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.clock import bucket_start, shift
from sieveline.operators.heavy import (
    FLOOR_ROWS,
    TASK_PAIRS,
    counted_join,
    every_salt,
    heavy_cells,
    join_salts,
    mark_heavy,
    row_spread,
    rows_of,
    salts_of,
    same_keys,
)
from sieveline.operators.slices import SLICE, range_slices
from sieveline.sources.artifacts import staged

_BIN, _BOUND, _SALTS = "__bin", "__bound", ("__salt0", "__salt1")
# Rows of a tile: a multiple of eight, as columnar files pack values by eights.
TILE_ROWS = 64


def interval_join(
    starts: DataFrame,
    points: DataFrame,
    start: str,
    point: str,
    within: str,
    keys: Sequence[str] = (),
    split: bool = False,
    replicate: str = "starts",
    floor: int = FLOOR_ROWS,
    pairs: int = TASK_PAIRS,
) -> DataFrame:
    """Inner join of ``starts`` with the ``points`` in ``[start, start + within]``.

    ``keys`` are equi-join columns of both sides (kept once; NULL matches nothing);
    all other column names must differ.  The ``replicate`` side, best the smaller one, is
    copied to the second bin; rows of the other side go to exactly one.  With ``split``,
    both sides are counted once, in a job of its own, and each (keys, bin) that is heavy on a
    side, or has many pairs, is cut into as many salts as its rows there ask for, to all of which its
    partners on the other side are copied; where none is heavy the join carries no salts.  A join of
    more pairs than one task should meet (``pairs``) is dealt over tasks in proportion to its pairs; if a
    row takes part in many, tiles of rows are joined instead of rows.
    """
    if replicate not in ("starts", "points"):
        raise ValueError("replicate is 'starts' or 'points'")
    copy_starts = replicate == "starts"
    names = [*starts.columns, *[c for c in points.columns if c not in keys]]
    equi = [*keys, _BIN]
    starts = starts.withColumn(_BOUND, shift(F.col(start), within)).withColumn(_BIN, bucket_start(start, within))
    points = points.withColumn(_BIN, bucket_start(point, within))

    def placed(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The side that goes to one bin, then the one that goes to two."""
        single, copied, step = (right, left, 1) if copy_starts else (left, right, -1)
        return single, copied.withColumn(_BIN, F.explode(F.array(F.col(_BIN), shift(F.col(_BIN), within, step))))

    single, copied = placed(starts, points)
    heavy, tasks, per_row = counted_join([single, copied], equi, floor, pairs) if split else (None, 0, 0.0)
    size, at = max(min(TILE_ROWS, isqrt(pairs) // 8), 1), int(copy_starts)
    tiled = tasks > 1 and per_row >= 2 * size
    if tiled:
        left = _tiles(starts, equi, start, _BOUND, [c for c in starts.columns if c != _BIN], heavy, at, floor, size)
        right = _tiles(points, equi, point, point, [c for c in points.columns if c not in equi], heavy, 1 - at, floor, size)
        single, copied = placed(left, right)
    if heavy is not None:
        salts, sides = join_salts(floor, pairs), []
        for at, side in enumerate((single, copied)):
            spread = F.col("__tile") if tiled else row_spread(side)
            marked = mark_heavy(side.withColumn("__spread", spread), heavy, equi)
            salted = marked.withColumn(_SALTS[at], F.pmod("__spread", salts[at]).cast("int"))
            salted = salted.withColumn("__copies", every_salt(salts[1 - at]))
            sides.append(salted.withColumn(_SALTS[1 - at], F.explode("__copies")))
        single, copied = sides
        equi += _SALTS
    left, right = (copied, single) if copy_starts else (single, copied)
    if tasks > 1:
        # By number, as adaptive execution would merge tasks by the little they read.
        tasks = max(tasks, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        left, right = (side.repartition(tasks, *equi) for side in (left, right))
    if not tiled:
        in_range = F.col(f"r.{point}").between(F.col(f"l.{start}"), F.col(f"l.{_BOUND}"))
        kept = [F.col(f"{'l' if c in starts.columns else 'r'}.{c}") for c in names]
        return left.alias("l").join(right.alias("r"), same_keys("l", "r", equi) & in_range).select(*kept)
    return _opened(left, right, equi, tasks).where(F.col(point).between(F.col(start), F.col(_BOUND))).select(*names)


def _tiles(
    rows: DataFrame,
    equi: Sequence[str],
    first: str,
    last: str,
    packed: Sequence[str],
    heavy: DataFrame | None,
    side: int,
    floor: int,
    size: int,
) -> DataFrame:
    """Rows as tiles: up to ``size`` rows of a (keys, bin) that follow each other in time, their ``packed`` columns as a list.

    A tile knows its earliest ``first`` and its latest ``last``.  The rows of a heavy cell are put in order in parts of
    about ``floor`` rows.
    """
    for name in (*equi, first):
        rows = rows.where(F.col(name).isNotNull())
    rows = rows.withColumn("__part", F.lit(0)).withColumn("__spread", row_spread(rows))
    if heavy is not None:
        parts = F.pmod("__spread", salts_of(F.col(rows_of(side)), floor))
        rows = mark_heavy(rows, heavy, equi).withColumn("__part", parts.cast("int"))
    in_time = Window.partitionBy(*equi, "__part").orderBy(first, "__spread")
    numbered = rows.withColumn("__tile", ((F.row_number().over(in_time) - 1) / size).cast("int"))
    tiles = numbered.groupBy(*equi, "__part", "__tile").agg(
        F.collect_list(F.struct(*packed)).alias("__listed"), F.min(first).alias("__first"), F.max(last).alias(_BOUND)
    )
    return tiles.withColumn("__tile", F.col("__tile") + F.col("__part")).drop("__part")


def _opened(starts: DataFrame, points: DataFrame, equi: Sequence[str], tasks: int) -> DataFrame:
    """Every pair of rows of two tiles that are near enough in time to hold a pair of the join.

    The side of fewer columns is the inner loop, of tiles and of their rows: the columns of the other stay the same longest.
    """
    columns = [side.schema["__listed"].dataType.elementType.names for side in (starts, points)]
    near = (F.col(f"{_BOUND}0") >= F.col("__first1")) & (F.col("__first0") <= F.col(f"{_BOUND}1"))
    outer, inner = sorted((0, 1), key=lambda side: -len({*columns[side]} - {_BOUND}))
    sides = [
        side.withColumnsRenamed({c: f"{c}{at}" for c in ("__listed", "__first", _BOUND)})
        for at, side in enumerate((starts, points))
    ]
    met = sides[outer].alias("l").join(sides[inner].alias("r"), same_keys("l", "r", equi) & near)
    # An operator that keeps the join's loop apart from those below, so that rows wait for the sink tile by tile.
    met = met.select(f"__listed{outer}", f"__listed{inner}").coalesce(tasks)
    rows = met.select(f"__listed{inner}", F.inline(f"__listed{outer}"))
    return rows.select(*columns[outer], F.inline(f"__listed{inner}"))


def _bounds(points: DataFrame, heavy: DataFrame, point: str, keys: Sequence[str]) -> DataFrame:
    """Heavy cells with the earliest point of their own bin and the latest of the bin before.

    With bins as wide as the look-back these two decide whether any point matches an anchor.  Points of other cells are
    left out before they are grouped; the result has a row per heavy cell.
    """
    cell = [*keys, _BIN]
    inside = points.join(F.broadcast(heavy.select(*cell)), cell, "left_semi")
    own = F.col("__own")
    edges = inside.groupBy(*cell).agg(
        F.min(F.when(own, F.col(point))).alias("__lo"), F.max(F.when(~own, F.col(point))).alias("__hi")
    )
    return heavy.join(edges, cell, "left")


def lookback_join(
    anchors: DataFrame,
    points: DataFrame,
    anchor: str,
    point: str,
    lookback: str,
    keys: Sequence[str],
    floor: int = FLOOR_ROWS,
) -> DataFrame:
    """Left outer join of ``anchors`` with every point in ``[anchor - lookback, anchor]``.

    Both sides are counted once by (keys, bin).  A cell that is heavy on a side is cut into salts there, to which its
    partners on the other side are copied; so hot anchors are spread like hot points.  Whether an anchor of a heavy
    cell has any match is settled beforehand from two numbers per cell, so an unmatched anchor is kept exactly once and a
    matched one leaves no empty row behind.  Anchors that lack a key or a time match nothing and pass by the join.
    """
    keys = list(keys)
    cell = [*keys, _BIN]
    point_columns = [c for c in points.columns if c not in keys]
    apart = F.lit(False)
    for name in (*keys, anchor):
        apart = apart | F.col(name).isNull()
    empty = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in point_columns]
    lonely = anchors.where(apart).select(*anchors.columns, *empty)

    left = anchors.where(~apart).withColumn(_BIN, bucket_start(anchor, lookback))
    left = left.withColumn(_BOUND, shift(F.col(anchor), lookback, -1))
    right = points.dropna(subset=[*keys, point]).withColumn(_BIN, bucket_start(point, lookback))
    copies = F.array(*[F.struct(b.alias(_BIN), F.lit(own).alias("__own")) for b, own in
                       ((F.col(_BIN), True), (shift(F.col(_BIN), lookback), False))])
    right = right.withColumn("__copy", F.explode(copies)).select(*points.columns, "__copy.*")

    equi, outer = list(cell), F.lit(True)
    heavy = heavy_cells([left, right], cell, floor)
    if heavy is None:
        right = right.drop("__own")
    else:
        settled = F.coalesce(F.col("__lo") <= F.col(anchor), F.lit(False)) | F.coalesce(
            F.col("__hi") >= F.col(_BOUND), F.lit(False)
        )
        anchor_salts, point_salts = (salts_of(F.col(rows_of(n)), floor) for n in (0, 1))
        marked = mark_heavy(left.withColumn("__spread", row_spread(left)), _bounds(right, heavy, point, keys), cell)
        marked = marked.withColumn("__matched", F.col(rows_of(0)).isNotNull() & settled)
        marked = marked.withColumn(_SALTS[0], F.pmod("__spread", anchor_salts))
        reached = F.when(F.col("__matched"), every_salt(point_salts)).otherwise(F.array(F.lit(0)))
        left = marked.withColumn(_SALTS[1], F.explode(reached))
        placed = mark_heavy(right.withColumn("__spread", row_spread(right)), heavy, cell)
        right = placed.withColumn(_SALTS[1], F.pmod("__spread", point_salts)).withColumn(
            _SALTS[0], F.explode(every_salt(anchor_salts))
        )
        equi += _SALTS
        outer = ~F.col("l.__matched") | F.col(f"r.{point}").isNotNull()
    in_range = F.col(f"r.{point}").between(F.col(f"l.{_BOUND}"), F.col(f"l.{anchor}"))
    joined = left.alias("l").join(right.alias("r"), same_keys("l", "r", equi) & in_range, "left").where(outer)
    kept = [F.col(f"l.{c}") for c in anchors.columns] + [F.col(f"r.{c}") for c in point_columns]
    return joined.select(*kept).unionByName(lonely)


def first_match_after(
    anchors: DataFrame,
    points: DataFrame,
    anchor: str,
    point: str,
    within: str,
    keys: Sequence[str],
    floor: int = FLOOR_ROWS,
) -> DataFrame:
    """For each (keys, anchor time): the first point in ``[anchor, anchor + within]``.

    Rows of equal time collapse to their smallest on either side.  Rows without a key or a time take no part.
    """
    keys = list(keys)
    anchor_columns = [c for c in anchors.columns if c not in (*keys, anchor)]
    point_columns = [c for c in points.columns if c not in (*keys, point)]
    tagged = anchors.select(
        *keys, F.col(anchor).alias("__t"), F.lit(True).alias("__is"), *[F.col(c).alias(f"__a_{c}") for c in anchor_columns]
    ).unionByName(
        points.select(
            *keys, F.col(point).alias("__t"), F.lit(False).alias("__is"), *[F.col(c).alias(f"__p_{c}") for c in point_columns]
        ),
        allowMissingColumns=True,
    )
    return first_match_among(
        tagged, "__t", F.col("__is"), ~F.col("__is"), anchor, point, within, keys,
        {c: F.col(f"__a_{c}") for c in anchor_columns}, {c: F.col(f"__p_{c}") for c in point_columns}, floor,
    )


def first_match_among(
    events: DataFrame,
    ts: str,
    is_anchor: Column,
    is_point: Column,
    anchor: str,
    point: str,
    within: str,
    keys: Sequence[str],
    anchor_values: Mapping[str, Column],
    point_values: Mapping[str, Column],
    floor: int = FLOOR_ROWS,
) -> DataFrame:
    """:func:`first_match_after` where anchors and points are rows of one table, which is read once.

    A row may be both; it then matches itself.  Rows are reduced to one per entity and instant and stored; an ordered
    window over an entity's instants finds the next point, so no anchor-point pairs are built.  The instants of entities
    with more than ``floor`` of them are cut into slices of about that many, wherever these end; one row per slice tells
    the first point of the slices after it.
    """
    keys = list(keys)
    anchor_row = F.when(is_anchor, F.struct(F.lit(True).alias("__here"), *[c.alias(n) for n, c in anchor_values.items()]))
    point_row = F.when(is_point, F.struct(F.col(ts).alias("__at"), *[c.alias(n) for n, c in point_values.items()]))
    tagged = events.where(is_anchor | is_point).dropna(subset=[*keys, ts])
    instants = staged(
        tagged.select(*keys, F.col(ts).alias("__t"), anchor_row.alias("__anchor"), point_row.alias("__point"))
        .groupBy(*keys, "__t")
        .agg(F.min("__anchor").alias("__anchor"), F.min("__point").alias("__point")),
        "instants",
    )
    # Descending order turns "next point" into a running last value.
    nearest = Window.partitionBy(*keys).orderBy(F.desc("__t")).rowsBetween(Window.unboundedPreceding, 0)
    next_point = F.last("__point", ignorenulls=True)
    heavy = heavy_cells([instants], keys, floor)
    if heavy is None:
        found = instants.withColumn("__hit", next_point.over(nearest))
    else:
        rows = rows_of(0)
        marked = mark_heavy(instants, heavy, keys)
        ordinary = marked.where(F.col(rows).isNull()).drop(rows).withColumn("__hit", next_point.over(nearest))
        hot = marked.where(F.col(rows).isNotNull()).drop(rows)
        sliced = range_slices(hot, keys, ["__t"], heavy.agg(F.sum(rows)).first()[0], floor)
        inside = Window.partitionBy(SLICE, *keys).orderBy(F.desc("__t")).rowsBetween(Window.unboundedPreceding, 0)
        firsts = sliced.groupBy(*keys, SLICE).agg(F.min("__point").alias("__first"))
        later = Window.partitionBy(*keys).orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
        carried = firsts.select(*keys, SLICE, F.last("__first", ignorenulls=True).over(later).alias("__far"))
        near = sliced.withColumn("__near", next_point.over(inside)).where(F.col("__anchor").isNotNull())
        across = near.join(carried, [*keys, SLICE], "left").withColumn("__hit", F.coalesce("__near", "__far"))
        found = ordinary.unionByName(across.select(*ordinary.columns))
    in_reach = F.col("__anchor").isNotNull() & (F.col("__hit.__at") <= shift(F.col("__t"), within))
    return found.where(in_reach).select(
        *keys,
        F.col("__t").alias(anchor),
        F.col("__hit.__at").alias(point),
        *[F.col(f"__anchor.{c}").alias(c) for c in anchor_values],
        *[F.col(f"__hit.{c}").alias(c) for c in point_values],
    )
