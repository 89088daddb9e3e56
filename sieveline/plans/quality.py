"""Documented interpretation bands and signal-alignment confidence."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scores import band, flag


def dns_score_band(score: Column) -> Column:
    """0 benign, 1-2 low, 3-4 medium, 5 and up high."""
    return band(score, [(5, "high"), (3, "medium"), (1, "low")], "benign")


def chain_completeness(chains: DataFrame) -> DataFrame:
    """Stages reached per takeover chain (burst and new origin are given) and their band."""
    stages = F.lit(2) + F.col("has_mfa_add") + F.col("has_mailbox_rule") + F.col("has_oauth_grant")
    return chains.withColumn("stages", stages).withColumn(
        "completeness", band(F.col("stages"), [(4, "high"), (3, "medium")], "low")
    )


def alert_priority(score: Column) -> Column:
    """5 investigate, 8 high priority, 10 critical."""
    return band(score, [(10, "critical"), (8, "high_priority"), (5, "investigate")], "none")


def signal_alignment(
    signals: Sequence[tuple[str, DataFrame]], entity: str, high: int = 4, medium: int = 2
) -> DataFrame:
    """Confidence per entity from how many independent signals name it.

    Each signal contributes the entities of its result; the union is reduced to one row
    per entity in a single aggregation.
    """
    tagged = [
        df.where(F.col(entity).isNotNull()).select(entity, F.lit(name).alias("signal")).distinct() for name, df in signals
    ]
    per_entity = reduce(DataFrame.unionByName, tagged).groupBy(entity).agg(
        F.count(F.lit(1)).alias("aligned_signals"),
        *[F.max(flag(F.col("signal") == name)).alias(f"has_{name}") for name, _ in signals],
    )
    return per_entity.withColumn("confidence", band(F.col("aligned_signals"), [(high, "high"), (medium, "medium")], "low"))
