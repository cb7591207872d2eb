"""Ratios and confidences; each keeps its own rule for an empty denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_one(n: Column, d: Column, places: int = 4) -> Column:
    return F.when(d == 0, F.lit(1.0)).otherwise(F.round(n / d, places))


def ratio_or_zero(n: Column, d: Column, places: int = 6) -> Column:
    return F.when(d == 0, F.lit(0.0)).otherwise(F.round(n / d, places))


def ratio_or_null(n: Column, d: Column, places: int = 4) -> Column:
    return F.when(d > 0, F.round(n / d, places))


def floored_ratio(n: Column, d: Column, places: int = 4) -> Column:
    return F.round(n / F.greatest(d, F.lit(1)), places)


def required(expected: Column, least: int, ratio: float) -> Column:
    return F.least(expected, F.greatest(F.lit(least), F.ceil(expected * ratio))).cast("long")


def phrase_confidence(df: Column, coverage: Column) -> tuple[Column, Column]:
    """(level, score) of a repeated phrase."""
    raw = 0.45 * F.least(df / 5, F.lit(1.0)) + 0.55 * coverage
    return _levels(raw, (df >= 3) & (coverage >= 0.5), coverage >= 0.25)


def topic_confidence(docs: Column, coverage: Column, terms: Column) -> tuple[Column, Column]:
    raw = 0.35 * F.least(docs / 5, F.lit(1.0)) + 0.45 * coverage + 0.20 * F.least(terms / 4, F.lit(1.0))
    level, score = _levels(raw, (docs >= 3) & (coverage >= 0.5), coverage >= 0.25)
    single = docs <= 1
    return F.when(single, "low").otherwise(level), F.when(single, F.round(F.least(raw, F.lit(0.39)), 3)).otherwise(score)


def _levels(raw: Column, high: Column, medium: Column) -> tuple[Column, Column]:
    level = F.when(high, "high").when(medium, "medium").otherwise("low")
    score = F.when(high, F.greatest(raw, F.lit(0.75))).when(medium, F.least(F.greatest(raw, F.lit(0.4)), F.lit(0.74))).otherwise(F.least(raw, F.lit(0.39)))
    return level, F.round(score, 3)
