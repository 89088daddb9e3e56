"""Score arithmetic: tiers, bands, guarded ratios and lenient numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first_reached(value: Column, steps: Sequence[tuple[float, object]], default: object) -> Column:
    return F.coalesce(*[F.when(value >= threshold, F.lit(result)) for threshold, result in steps], F.lit(default))


def tier(value: Column, steps: Sequence[tuple[float, int]], default: int = 0) -> Column:
    """Points of the first step whose threshold ``value`` reaches; NULL earns the default."""
    return _first_reached(value, steps, default)


def band(value: Column, steps: Sequence[tuple[float, str]], default: str | None) -> Column:
    """Label of the first step whose threshold ``value`` reaches."""
    return _first_reached(value, steps, default)


def points_if(condition: Column, reward: int) -> Column:
    return F.when(condition, F.lit(reward)).otherwise(F.lit(0))


def flag(condition: Column) -> Column:
    """1 when the condition is true, else 0 (NULL counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def clamp01(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """``numerator / denominator`` or NULL when the denominator is 0."""
    quotient = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return quotient if digits is None else F.round(quotient, digits)


def positive_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Ratio kept only for a positive denominator, as confusion metrics need."""
    return F.when(denominator > 0, F.round(numerator.cast("double") / denominator, digits))


NUMBER = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$"


def lenient_double(value: Column) -> Column:
    """Number parsed from trimmed text; blanks and malformed text (type suffixes, hex digits) become NULL."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def f1_score(precision: Column, recall: Column) -> Column:
    total = precision + recall
    return F.when(total > 0, 2 * precision * recall / total).when(total.isNotNull(), F.lit(0.0))
