"""Detection quality against a label column, in one global aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scores import f1_score, flag, positive_ratio, ratio


def confusion_sums(score: Column, label: Column, threshold: float = 0) -> dict[str, Column]:
    """Per-row 0/1 terms whose sums are the confusion counts (``score > threshold`` is flagged)."""
    flagged = score > threshold
    return {
        "flagged_events": flag(flagged),
        "malicious_events": flag(label),
        "true_positives": flag(flagged & label),
        "false_positives": flag(flagged & ~label),
        "false_negatives": flag((score <= threshold) & label),
    }


def with_quality(counts: DataFrame, digits: int = 3) -> DataFrame:
    """Adds ``precision`` and ``recall``, NULL where their denominator is zero."""
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return counts.withColumn("precision", positive_ratio(tp, tp + fp, digits)).withColumn(
        "recall", positive_ratio(tp, tp + fn, digits)
    )


def evaluate(df: DataFrame, score: str, label: str, threshold: float = 0) -> DataFrame:
    """One row: totals, confusion counts, precision, recall, F1 and flagged rate."""
    terms = confusion_sums(F.col(score), F.col(label), threshold)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_events"), *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in terms.items()]
    )
    return with_quality(counts).withColumn("f1", f1_score(F.col("precision"), F.col("recall"))).withColumn(
        "flagged_rate", ratio(F.col("flagged_events"), F.col("total_events"))
    )
