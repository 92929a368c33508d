"""Scalar scoring functions: tiers, bands, rounding, sigmoid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardstat.schemas import TIER_HIGH, TIER_MEDIUM


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def risk_tier(score: str | Column) -> Column:
    """>= 0.65 high, >= 0.40 medium, else low (bounds inclusive); NULL stays NULL."""
    s = _col(score)
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(s >= F.lit(TIER_HIGH), F.lit("high"))
            .when(s >= F.lit(TIER_MEDIUM), F.lit("medium"))
            .otherwise(F.lit("low")))


def metric_band(value: str | Column) -> Column:
    """Display band of a quality metric: >= 0.75 good, >= 0.50 fair, else poor."""
    v = _col(value)
    return F.when(v >= 0.75, "good").when(v >= 0.50, "fair").otherwise("poor")


def importance_band(value: str | Column) -> Column:
    """Display band of an importance: >= 0.05 strong, >= 0.02 moderate, else weak."""
    v = _col(value)
    return F.when(v >= 0.05, "strong").when(v >= 0.02, "moderate").otherwise("weak")


def score_percent(score: str | Column) -> Column:
    """Score as a percentage with one decimal, rounded half-up on the decimal
    value (so 0.0185 gives 1.9 whatever the binary form of 1.85 is)."""
    pct = _col(score).cast("decimal(20,10)") * F.lit(100)
    return F.round(pct, 1).cast("double")


def round_score(score: str | Column, digits: int = 4) -> Column:
    return F.round(_col(score), digits)


def sigmoid(x: str | Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))
