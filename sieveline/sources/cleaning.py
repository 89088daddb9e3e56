"""Normalisation of loosely typed input before it reaches a detection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from sieveline.functions.scores import lenient_double


# An offset or zone name after a time of day.
ZONE = r":\d\d(\.\d+)?\s*(Z|UTC|GMT|UT|[+-]\d|[A-Za-z]+/)"


def parse_utc(df: DataFrame, *columns: str) -> DataFrame:
    """Text columns to timestamps; rows whose timestamp cannot be read are dropped.

    Text without an offset is UTC, whatever the session's time zone; instants (timestamp columns) stay as they are.
    """
    for c in columns:
        if isinstance(df.schema[c].dataType, TimestampType):
            continue
        text = F.trim(F.col(c).cast("string"))
        timed = F.when(text.rlike(r"^[+-]?\d+-\d+-\d+$"), F.concat(text, F.lit(" 00:00:00"))).otherwise(text)
        utc = F.when(text.rlike(ZONE), text).otherwise(F.concat(timed, F.lit("Z")))
        df = df.withColumn(c, F.try_to_timestamp(utc))
    return df.dropna(subset=list(columns))


def fill_absent(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Adds each missing column with its default value."""
    absent = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def coerce_numbers(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns parsed leniently to the given numeric types; malformed values become NULL."""
    return df.withColumns({c: lenient_double(F.col(c)).try_cast(t) for c, t in types.items()})


def drop_keyless(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))
