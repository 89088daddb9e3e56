"""Interval joins of two streams, and the hunts that are one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.clock import shift
from sieveline.operators.heavy import same_keys
from sieveline.plans.hunts import PASSWORD_RESET, ROLE_GRANTED, USER_CREATED, events_of, mentions


def interval_join(
    starts: DataFrame,
    points: DataFrame,
    start: str,
    point: str,
    within: str,
    keys: Sequence[str],
    lateness: str = "10 minutes",
    point_lateness: str | None = None,
) -> DataFrame:
    """Inner join of a stream of ``starts`` with a stream of ``points`` in ``[start, start + within]``, as pairs meet.

    Gives the rows of the batch operator for rows that are no later than their side's watermark.  Both watermarks and the interval
    bound the state: a start is dropped ``within`` after the points' watermark has passed it, a point once the starts' has.
    ``keys`` are columns of both sides, kept once; all other names must differ.
    """
    left = starts.withWatermark(start, lateness).alias("l")
    right = points.withWatermark(point, point_lateness or lateness).alias("r")
    begin = F.col(f"l.{start}")
    in_range = (F.col(f"r.{point}") >= begin) & (F.col(f"r.{point}") <= shift(begin, within))
    joined = left.join(right, same_keys("l", "r", keys) & in_range)
    return joined.select(
        *[F.col(f"l.{c}") for c in starts.columns], *[F.col(f"r.{c}") for c in points.columns if c not in keys]
    )


def resets_after_creation(audit: DataFrame, within: str = "2 hours", lateness: str = "10 minutes") -> DataFrame:
    """Password resets or recoveries soon after a user was created, from a stream of audit rows."""
    created = events_of(audit, USER_CREATED).select(F.col("target").alias("user_created"), F.col("event_time").alias("created_at"))
    reset = events_of(audit, PASSWORD_RESET).select(
        F.col("target").alias("user_created"), F.col("event_time").alias("reset_time"), F.col("actor").alias("reset_actor"), "details_json"
    )
    return interval_join(created, reset, "created_at", "reset_time", within, ["user_created"], lateness).drop("created_at")


def new_privileged_users(
    audit: DataFrame, within: str = "1800 seconds", term: str = "admin", lateness: str = "10 minutes"
) -> DataFrame:
    """New users that received a privileged role within the window, from a stream of audit rows."""
    created = events_of(audit, USER_CREATED).select(F.col("target").alias("user"), "actor", F.col("event_time").alias("t_create"))
    granted = events_of(audit, ROLE_GRANTED).where(mentions(F.col("details_json"), term)).select(
        F.col("target").alias("user"), F.col("event_time").alias("t_role"), F.col("details_json").alias("details")
    )
    return interval_join(created, granted, "t_create", "t_role", within, ["user"], lateness).select(
        "t_create", "user", "actor", "t_role", "details"
    )
