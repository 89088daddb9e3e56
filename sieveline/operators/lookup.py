"""Frequency tables per key, and mapping them back to rows without a hot task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most 1 / MIN_SHARE keys are broadcast.
MIN_SHARE = 1e-5


def frequency(df: DataFrame, key: str, out: str = "frequency") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def attach_by_frequency(df: DataFrame, table: DataFrame, key: str, count: str, heavy_share: float = 1e-4) -> DataFrame:
    """Left join of ``df`` with a per-key ``table`` that knows each key's row ``count`` in ``df``.

    Keys above ``heavy_share`` of all rows are looked up in a broadcast copy: at most
    ``1 / heavy_share`` keys can be that frequent, whatever the size of the data.  All rows
    then pass one shuffle join on (route, salt).  An ordinary row carries its key and the
    key's hash; a heavy row, or one without a key, carries no route and a salt of its own,
    so that these rows are spread over all tasks.
    """
    if not MIN_SHARE <= heavy_share <= 1:
        raise ValueError(f"heavy_share lies between {MIN_SHARE} and 1, as 1 / heavy_share bounds the broadcast")
    payload = [c for c in table.columns if c != key]
    total = table.select(F.sum(count)).scalar()
    heavy = table.where(F.col(count) > heavy_share * total)
    heavy = heavy.select(F.col(key).alias("__key"), F.struct(*payload).alias("__heavy"))
    marked = df.join(F.broadcast(heavy), df[key] == heavy["__key"], "left").drop("__key")

    ordinary = F.col("__heavy").isNull() & F.col(key).isNotNull()
    routed = marked.withColumn("__route", F.when(ordinary, F.col(key))).withColumn(
        "__salt", F.when(ordinary, F.xxhash64(key)).otherwise(F.xxhash64(F.monotonically_increasing_id()))
    )
    rest = table.where(F.col(count) <= heavy_share * total).select(
        F.col(key).alias("__route"), F.xxhash64(key).alias("__salt"), F.struct(*payload).alias("__rest")
    )
    joined = routed.join(rest, ["__route", "__salt"], "left")
    found = F.coalesce(F.col("__heavy"), F.col("__rest"))
    return joined.withColumn("__found", found).select(*df.columns, *[F.col(f"__found.{c}").alias(c) for c in payload])
