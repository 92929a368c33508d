"""Queries over the prediction log (and over any scored frame).

The log is an append-only parquet table partitioned by `log_date`; all of
these are single-pass aggregations or top-k scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.functions.tiers import risk_tier, score_percent
from wardstat.schemas import HISTORY_MAX, LOG_SCHEMA, TIERS
from wardstat.session import path_exists

FEATURES_TYPE = T.MapType(T.StringType(), T.DoubleType())


def parse_features(log: DataFrame) -> DataFrame:
    """Parse `input_features` JSON into a map; text that is not a JSON
    object stays available in `raw_features` (parsed map NULL)."""
    parsed = F.from_json(F.col("input_features"), FEATURES_TYPE, {"mode": "PERMISSIVE"})
    return (log.withColumn("features", parsed)
            .withColumn("raw_features", F.when(F.col("features").isNull(), F.col("input_features"))))


def recent_predictions(log: DataFrame, n: int = 100, since=None,
                       hide_features: bool = True) -> DataFrame:
    """The n most recent rows by (timestamp, id), newest first; n outside
    1..1000 is refused.

    `orderBy(desc).limit(n)` is planned as TakeOrderedAndProject: each task
    keeps its own top n, so no full sort. `since` (a date) prunes
    `log_date` partitions first when the log is partitioned.
    """
    if not 1 <= n <= HISTORY_MAX:
        raise ValueError(f"n must be in 1..{HISTORY_MAX}")
    src = log
    if since is not None and "log_date" in log.columns:
        src = src.filter(F.col("log_date") >= F.lit(since))
    newest = [F.col(c).desc() for c in ("timestamp", "id") if c in src.columns]
    top = src.orderBy(*newest).limit(n)
    out = parse_features(top)
    if hide_features:
        out = out.drop("input_features", "features", "raw_features")
    return out


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The prediction log at `path`; an empty frame of its schema if there is none yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    log = spark.read.parquet(path)
    return log.select(*LOG_SCHEMA.fieldNames(), *[c for c in log.columns if c not in LOG_SCHEMA.fieldNames()])


def score_series(log: DataFrame) -> DataFrame:
    """Scores ordered by time, with percentage and tier band."""
    return (log.select("timestamp", "risk_score",
                       score_percent("risk_score").alias("risk_pct"),
                       risk_tier("risk_score").alias("band"))
            .orderBy("timestamp"))


def prediction_stats(log: DataFrame) -> DataFrame:
    """All-time totals: count, mean score (4 dp, 0 when empty), tier counts."""
    return log.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.round(F.avg("risk_score"), 4), F.lit(0.0)).alias("mean_risk_score"),
        F.count_if(F.col("risk_level") == "high").cast("long").alias("high_count"),
        F.count_if(F.col("risk_level") == "medium").cast("long").alias("medium_count"),
        F.count_if(F.col("risk_level") == "low").cast("long").alias("low_count"),
    )


def tier_dimension(spark: SparkSession) -> DataFrame:
    """The three tiers in display order (a 3-row dimension)."""
    return spark.createDataFrame([(t, i) for i, t in enumerate(TIERS)],
                                 "risk_level string, tier_order int")


def risk_distribution(log: DataFrame) -> DataFrame:
    """Counts per tier in the fixed order low, medium, high; missing -> 0.

    The tier dimension (3 rows) is broadcast and left-joined to the counts.
    """
    counts = log.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))
    dim = tier_dimension(log.sparkSession)
    return (F.broadcast(dim).join(counts, "risk_level", "left")
            .select("risk_level", "tier_order", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
            .orderBy("tier_order"))


def state_risk(scored: DataFrame, min_states: int = 2) -> DataFrame:
    """Mean score and count per state (NULL states dropped); no rows when
    fewer than `min_states` states remain.

    The guard counts the grouped rows by a window over them -- one row per
    state, a bounded set -- so the log is scanned once.
    """
    grouped = (scored.filter(F.col("state").isNotNull())
               .groupBy("state")
               .agg(F.avg("risk_score").alias("mean_risk"), F.count(F.lit(1)).alias("n")))
    everything = Window.partitionBy(F.lit(0))
    return (grouped.withColumn("_states", F.count(F.lit(1)).over(everything))
            .filter(F.col("_states") >= F.lit(min_states)).drop("_states"))


def risk_windows(log: DataFrame, duration: str = "1 day", time_col: str = "timestamp") -> DataFrame:
    """Tier counts and mean score per tumbling window of the log.

    The same function serves batch frames and streaming frames (after
    `withWatermark`), so drift can be followed per day.
    """
    return (log.groupBy(F.window(F.col(time_col), duration).alias("w"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg("risk_score").alias("mean_risk_score"),
                 F.count_if(F.col("risk_level") == "high").cast("long").alias("high_count"),
                 F.count_if(F.col("risk_level") == "medium").cast("long").alias("medium_count"),
                 F.count_if(F.col("risk_level") == "low").cast("long").alias("low_count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n", "mean_risk_score", "high_count", "medium_count", "low_count"))


def batch_summary(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per batch: total, high count, low+medium count and the mean of the
    scores rounded to 4 dp, rounded again to 4 dp. The tier comes from the
    unrounded score; the mean from the rounded ones."""
    g = scored.groupBy(*(by or []))
    out = g.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("risk_level") == "high").cast("long").alias("high_risk_count"),
        F.round(F.avg(F.round("risk_score", 4)), 4).alias("mean_risk_score"),
    )
    return out.withColumn("low_medium_count", F.col("total") - F.col("high_risk_count"))


EXPORT_NAMES = {
    "facility_id": "Facility ID",
    "facility_name": "Hospital Name",
    "risk_score": "Risk Score",
    "risk_level": "Risk Level",
}


def results_export(scored: DataFrame) -> DataFrame:
    """The four exported columns under their display names."""
    return scored.select(*[F.col(c).alias(n) for c, n in EXPORT_NAMES.items()])
