"""Inputs derived from the driver's tables.

There is no hospital data among the given tables, so the inputs of the data
product are derived from them by joins and expressions (the same rules are
written as SQL for the DuckDB cross-check):

* `hrrp_raw`       customer x orders x lineitem x nation -> raw long table
* `requests`       pivoted hospitals -> request rows with some invalid values
* `prediction_log` events -> prediction log
* `scored_labels`  feature table -> (label, score) pairs for the metrics

Everything grows with the given tables; nothing is made up on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.functions.tiers import risk_tier
from wardstat.schemas import EXCESS_COLUMNS, MEASURE_CODES, RAW_FIELDS, REQUEST_COLUMNS, STATES

UNKNOWN_MEASURE = "READM-30-UNKNOWN-HRRP"
# Constant columns of the raw rows.
RAW_CONSTANTS = {
    "footnote": "",
    "number_of_readmissions": "20",
    "start_date": "07/01/2021",
    "end_date": "06/30/2024",
}
# Ratio offset that keeps hospital means away from exactly 1.0.
RATIO_BASE = 0.70037
LOG_V2_FROM = "2024-01-16 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _measure_name(linenumber) -> F.Column:
    codes = list(MEASURE_CODES)  # alphabetical order
    expr = F.when(linenumber == 7, F.lit(UNKNOWN_MEASURE))
    for i, code in enumerate(codes, start=1):
        expr = expr.when(linenumber == i, F.lit(code))
    return expr


def _decimal_text(x: F.Column, precision: int, scale: int) -> F.Column:
    return x.cast(f"decimal({precision},{scale})").cast("string")


def hrrp_raw(spark: SparkSession, sf_dir: str, with_order_keys: bool = False) -> DataFrame:
    """Raw long table: one string row per (hospital = customer, line item).

    `with_order_keys` keeps `l_orderkey, l_linenumber`, the provider's
    delivery order, for page landing.

    Join order: orders x customer (x nation) first, then line items, so the
    largest table is shuffled once, on the order key. Spark picks broadcast
    for customer and nation from their file sizes (autoBroadcastJoinThreshold)
    and sort-merge joins beyond that.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")

    oc = (o.join(c, o.o_custkey == c.c_custkey, "inner")
          .join(n, c.c_nationkey == n.n_nationkey, "inner")
          .select("o_orderkey", "c_custkey", "c_name", "n_nationkey"))
    # Line items x orders is a shuffle (sort-merge) join, as it is at any
    # real size: the per-row derivation below then runs in every reducer
    # instead of inside the (possibly single) scan task of line items.
    j = li.join(oc.hint("merge"), li.l_orderkey == oc.o_orderkey, "inner")

    key = F.col("c_custkey")
    ln = F.col("l_linenumber")
    suppressed = (((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (ln <= 3))
                  | (key % 97 == 0))
    few = (F.col("l_quantity") < 3) | (key % 97 == 0)
    states = F.array(*[F.lit(s) for s in STATES])
    state = F.try_element_at(states, (F.col("n_nationkey") * 2 + 1).cast("int"))
    disc, tax = F.col("l_discount"), F.col("l_tax")

    cols = {
        "facility_id": F.lpad(key.cast("string"), 6, "0"),
        "facility_name": F.when((key % 50 == 0) & (ln == 1), F.lit(None).cast("string"))
                          .otherwise(F.col("c_name")),
        "state": F.when(F.col("n_nationkey") == 7, F.lit(None).cast("string"))
                  .when(F.col("n_nationkey") == 3, F.lower(state))
                  .otherwise(state),
        "measure_name": _measure_name(ln),
        "number_of_discharges": F.when(few, F.lit("Too Few to Report"))
                                 .otherwise(F.col("l_quantity").cast("int").cast("string")),
        "excess_readmission_ratio": F.when(suppressed, F.lit("N/A")).otherwise(
            _decimal_text(F.lit(RATIO_BASE) + F.lit(5) * disc + tax, 8, 5)),
        "predicted_readmission_rate": F.when(suppressed, F.lit("N/A")).otherwise(
            _decimal_text(F.lit(10) + F.lit(20) * disc + F.lit(50) * tax, 6, 2)),
        "expected_readmission_rate": F.when(suppressed, F.lit("N/A")).otherwise(
            _decimal_text(F.lit(12) + F.lit(10) * disc + F.lit(20) * tax, 6, 2)),
    }
    cols.update({k: F.lit(v) for k, v in RAW_CONSTANTS.items()})
    extra = [F.col("l_orderkey"), F.col("l_linenumber")] if with_order_keys else []
    return j.select(*[cols[name].alias(name) for name in RAW_FIELDS], *extra)


def requests(wide: DataFrame) -> DataFrame:
    """Request rows from pivoted hospitals, with invalid values planted:
    ratio 99.9 (id % 31), no ratio at all (id % 37), negative discharges
    (id % 41), a 3-letter state (id % 43)."""
    rid = F.col("facility_id").cast("long")
    out = wide.select(*REQUEST_COLUMNS)
    out = out.withColumn("ami_excess_ratio",
                         F.when(rid % 31 == 0, F.lit(99.9)).otherwise(F.col("ami_excess_ratio")))
    out = out.withColumns({c: F.when(rid % 37 == 0, F.lit(None).cast("double")).otherwise(F.col(c))
                           for c in EXCESS_COLUMNS})
    out = out.withColumn("hf_discharges",
                         F.when(rid % 41 == 0, F.lit(-1.0)).otherwise(F.col("hf_discharges")))
    out = out.withColumn("state", F.when(rid % 43 == 0, F.lit("XYZ")).otherwise(F.col("state")))
    return out


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction log rows from `events` (one row per event)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    states = F.array(*[F.lit(s) for s in STATES])
    uid = F.col("user_id")
    score = F.round(F.least(F.col("value"), F.lit(100.0)) / F.lit(100.0), 4)
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("timestamp"),
        F.lpad(uid.cast("string"), 6, "0").alias("facility_id"),
        F.concat(F.lit("Hospital "), uid.cast("string")).alias("facility_name"),
        F.when(uid % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.try_element_at(states, (uid % 54 + 1).cast("int"))).alias("state"),
        F.when(F.col("event_id") % 101 == 0, F.lit("not json"))
         .otherwise(F.col("props")).alias("input_features"),
        score.alias("risk_score"),
        risk_tier(score).alias("risk_level"),
        F.when(F.col("ts") < F.expr(f"TIMESTAMP_NTZ '{LOG_V2_FROM}'"), F.lit("v1"))
         .otherwise(F.lit("v2")).alias("model_version"),
    )


def scored_labels(features: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(facility_id, label, score) with a 3-decimal score from the AMI ratio;
    rows without that ratio are dropped. Three decimals give score ties.
    `keep` carries further columns (e.g. the fold)."""
    score = F.round(F.least(F.lit(1.0), F.greatest(
        F.lit(0.0), (F.col("ami_excess_ratio") - F.lit(RATIO_BASE)) / F.lit(0.58))), 3)
    return (features.filter(F.col("ami_excess_ratio").isNotNull())
            .select("facility_id", *(keep or []), F.col("high_readmission_risk").alias("label"),
                    score.alias("score")))
