"""Hunting queries over agent sessions, audit rows and cross-pack exposure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.clock import shift, span_hours
from sieveline.operators.heavy import heavy_cells, mark_heavy, rows_of
from sieveline.operators.intervals import interval_join
from sieveline.sources.artifacts import staged

USER_CREATED = ("user_create", "sys_user_insert")
ROLE_GRANTED = ("role_grant", "sys_user_has_role_insert")
PASSWORD_RESET = ("password_reset", "account_recovery")
IDENTITY_CHANGES = ("user_create", "role_grant", "password_reset")


def events_of(audit: DataFrame, kinds: Sequence[str]) -> DataFrame:
    return audit.where(F.col("event_type").isin(*kinds))


def mentions(details: Column, term: str) -> Column:
    return F.contains(F.lower(details.cast("string")), F.lit(term.lower()))


def users_created_near_sessions(sessions: DataFrame, audit: DataFrame, within: str = "30 minutes") -> DataFrame:
    """User creations inside the window that an agent session opens."""
    opened = sessions.select("session_id", F.col("user_email").alias("session_user"), "started_at")
    created = events_of(audit, USER_CREATED).select(
        "event_time", "actor", F.col("target").alias("new_user"), "target_email"
    )
    near = interval_join(
        opened, created, "started_at", "event_time", within, split=True, replicate="points"
    )
    return near.drop("started_at")


def role_grants_near_sessions(
    sessions: DataFrame, audit: DataFrame, within: str = "30 minutes", term: str = "admin"
) -> DataFrame:
    """Privileged grants to users created near an agent session.

    The keyed creation-to-grant join runs first: it leaves few rows for the join on time.  Its result is stored, as the
    second join counts its rows before it reads them.
    """
    created = events_of(audit, USER_CREATED).select(F.col("target").alias("new_user"), F.col("event_time").alias("created_at"))
    granted = events_of(audit, ROLE_GRANTED).where(mentions(F.col("details_json"), term)).select(
        F.col("target").alias("new_user"),
        F.col("details_json").alias("role_grant_details"),
        F.col("actor").alias("role_grant_actor"),
        F.col("event_time").alias("role_grant_time"),
    )
    escalated = interval_join(created, granted, "created_at", "role_grant_time", within, ["new_user"], split=True)
    opened = sessions.select("session_id", "started_at")
    near = interval_join(opened, staged(escalated, "escalated"), "started_at", "created_at", within, split=True, replicate="points")
    return near.drop("started_at", "created_at")


def resets_after_creation(audit: DataFrame, within: str = "2 hours") -> DataFrame:
    """Password resets or recoveries soon after a user was created."""
    created = events_of(audit, USER_CREATED).select(F.col("target").alias("user_created"), F.col("event_time").alias("created_at"))
    reset = events_of(audit, PASSWORD_RESET).select(
        F.col("target").alias("user_created"),
        F.col("event_time").alias("reset_time"),
        F.col("actor").alias("reset_actor"),
        "details_json",
    )
    return interval_join(created, reset, "created_at", "reset_time", within, ["user_created"], split=True).drop("created_at")


def new_privileged_users(audit: DataFrame, within: str = "1800 seconds", term: str = "admin") -> DataFrame:
    """New users that received a privileged role within the window."""
    created = events_of(audit, USER_CREATED).select(
        F.col("target").alias("user"), "actor", F.col("event_time").alias("t_create")
    )
    granted = events_of(audit, ROLE_GRANTED).where(mentions(F.col("details_json"), term)).select(
        F.col("target").alias("user"), F.col("event_time").alias("t_role"), F.col("details_json").alias("details")
    )
    return interval_join(created, granted, "t_create", "t_role", within, ["user"], split=True).select(
        "t_create", "user", "actor", "t_role", "details"
    )


def session_change_values(
    sessions: DataFrame, audit: DataFrame, within: str = "30 minutes", sources: Sequence[str] | None = None
) -> DataFrame:
    """Long form of what follows each agent session of a user: distinct (session, kind, value) rows.

    ``kind`` is ``events``, ``targets`` or ``actors``.  Values are made distinct before and after one shuffle that is keyed by
    the value as well, so a session with a large share of all changes is spread over many tasks.
    """
    opened = sessions.where(F.col("source").isin(*sources)) if sources else sessions
    opened = opened.select("session_id", F.col("user_email").alias("session_user"), "started_at")
    changes = events_of(audit, IDENTITY_CHANGES).select(
        F.col("target_email").alias("session_user"), "event_time", "event_type", "target", "actor"
    )
    pairs = interval_join(opened, changes, "started_at", "event_time", within, ["session_user"], split=True)
    kinds = {"events": "event_type", "targets": "target", "actors": "actor"}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in kinds.items()]))
    return pairs.select("session_user", "session_id", each.alias("v")).select("session_user", "session_id", "v.*").distinct()


def identity_changes_after_sessions(
    sessions: DataFrame,
    audit: DataFrame,
    within: str = "30 minutes",
    sources: Sequence[str] | None = None,
    most_values: int = 10_000,
) -> DataFrame:
    """Sets of identity events, targets and actors that follow each agent session of a user.

    A set is an array of texts, in order, with its size beside it.  A set of more than ``most_values`` is told by its size alone, its
    array is NULL; :func:`session_change_values` has its members as rows.
    """
    session, kinds = ["session_user", "session_id"], ("events", "targets", "actors")
    values = staged(session_change_values(sessions, audit, within, sources), "session-values")
    # Sets that are too large, found in one count (a missing value counts there as well), are never gathered.
    heavy = heavy_cells([values], [*session, "kind"], most_values + 1, nulls=True)
    large = F.lit(False) if heavy is None else F.col(rows_of(0)).isNotNull()
    marked = values if heavy is None else mark_heavy(values, heavy, [*session, "kind"])
    of = lambda kind: F.col("kind") == kind
    sets = marked.groupBy(*session).agg(
        *[F.array_sort(F.collect_list(F.when(of(k) & ~large, F.col("value")))).alias(k) for k in kinds],
        *[F.count(F.when(of(k), F.col("value"))).alias(f"n_{k}") for k in kinds],
    )
    told = [F.when(F.col(f"n_{k}") <= most_values, F.col(k)).alias(k) for k in kinds]
    return sets.select(*session, *told, *[f"n_{k}" for k in kinds])


def exposure_then_failed_login(
    dns: DataFrame, identity: DataFrame, min_score: int = 4, within: str = "48 hours"
) -> DataFrame:
    """Accounts whose first failed sign-in falls shortly after their last suspicious query."""
    exposed = dns.where(F.col("score") >= min_score).groupBy("account_id").agg(F.max("ts").alias("last_suspicious_dns"))
    failed = (
        identity.where((F.col("event_type") == "auth.signin") & (F.col("outcome") == "failure"))
        .groupBy("account_id")
        .agg(F.min("ts").alias("first_failed_login"))
    )
    start, end = F.col("last_suspicious_dns"), F.col("first_failed_login")
    return exposed.join(failed, "account_id").where(end.between(start, shift(start, within))).withColumn(
        "time_delta_hours", span_hours(start, end)
    )
