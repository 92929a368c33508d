"""Scoring-side operators that do not need a model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.functions.tiers import risk_tier, round_score, sigmoid
from wardstat.schemas import ID_COLUMNS, MEASURE_FEATURES


def normalise_scores(df: DataFrame, raw: str = "raw_score", by: list[str] | None = None,
                     out: str = "score") -> DataFrame:
    """If any raw score of a batch lies outside [0, 1], squash the whole
    batch with the logistic function; otherwise keep it.

    The batch range is a partial aggregation per batch joined back on the
    batch key (AQE splits a skewed batch; a small range table is broadcast
    at run time); without `by` the whole frame is one batch and the range
    comes from two scalar subqueries.
    """
    by = list(by or [])
    if not by:
        lo = df.select(F.min(raw)).scalar()
        hi = df.select(F.max(raw)).scalar()
        outside = (lo < F.lit(0.0)) | (hi > F.lit(1.0))
        return df.withColumn(out, F.when(outside, sigmoid(raw)).otherwise(F.col(raw)))
    rng = df.groupBy(*by).agg(F.min(raw).alias("_lo"), F.max(raw).alias("_hi"))
    outside = (F.col("_lo") < 0.0) | (F.col("_hi") > 1.0)
    return (df.join(rng, by, "inner")
            .withColumn(out, F.when(outside, sigmoid(raw)).otherwise(F.col(raw)))
            .drop("_lo", "_hi"))


def features_json(requests: DataFrame) -> DataFrame:
    """`input_features` = JSON object of the non-null measure values (ids
    excluded); `to_json` leaves NULL fields out."""
    return requests.withColumn(
        "input_features", F.to_json(F.struct(*[F.col(c) for c in MEASURE_FEATURES])))


def tier_and_round(scored: DataFrame, prob: str = "probability_1") -> DataFrame:
    """risk_level from the unrounded score; risk_score rounded to 4 dp."""
    return (scored.withColumn("risk_level", risk_tier(prob))
            .withColumn("risk_score", round_score(prob, 4)))


def response_rows(scored: DataFrame, model_version: str) -> DataFrame:
    """Echo ids beside the score: facility_id, facility_name, state,
    risk_score, risk_level, model_version (+ the input ordinal if any)."""
    keep = [c for c in ("ordinal",) if c in scored.columns]
    return scored.select(*keep, *ID_COLUMNS, "risk_score", "risk_level",
                         F.lit(model_version).alias("model_version"))
