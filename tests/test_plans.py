"""Physical-plan checks: the shapes we rely on at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tests.fixtures import raw_rows
from wardstat.operators import clean as C
from wardstat.operators import features as FE
from wardstat.operators import pivot as P
from wardstat.schemas import RAW_SCHEMA


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw_parquet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "raw.parquet")
    spark.createDataFrame(raw_rows(), RAW_SCHEMA).write.parquet(path)
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def test_measure_filter_and_pruning_reach_scan(raw_parquet):
    df = C.clean_raw(raw_parquet).select("facility_id", "excess_readmission_ratio")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(measure_name" in plan or "In(measure_name" in plan
    # only the needed columns are read
    m = re.search(r"ReadSchema: struct<([^>]*)>", plan)
    assert m and set(x.split(":")[0] for x in m.group(1).split(",")) == {
        "facility_id", "measure_name", "excess_readmission_ratio"}


def test_pivot_hash_aggregates_raw_rows(raw_parquet):
    plan = plan_text(P.pivot_wide(C.clean_raw(raw_parquet)))
    # The aggregation directly over raw rows is a hash aggregation with a
    # partial (map-side) step; sort-based aggregation only appears above
    # the first exchange, on the reduced rows.
    lines = plan.splitlines()
    scan = max(i for i, l in enumerate(lines) if "FileScan" in l or "Scan parquet" in l)
    first_agg = max(i for i, l in enumerate(lines[:scan]) if "Aggregate" in l)
    assert "HashAggregate" in lines[first_agg]
    assert "partial_sum" in lines[first_agg]
    assert plan.count("Exchange hashpartitioning") == 2


def test_no_python_udf_in_feature_plan(raw_parquet):
    df = FE.feature_table(P.pivot_wide(C.clean_raw(raw_parquet)))
    plan = df._jdf.queryExecution().optimizedPlan().toString() + plan_text(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_vocabulary_join_becomes_broadcast_at_runtime(raw_parquet):
    df = FE.feature_table(P.pivot_wide(C.clean_raw(raw_parquet)))
    df.collect()
    final = plan_text(df)
    assert "isFinalPlan=true" in final
    assert re.search(r"BroadcastHashJoin \[state_key", final)
    assert not re.search(r"SortMergeJoin \[state_key", final)


def test_recent_predictions_is_top_k(spark):
    from wardstat.operators.monitoring import recent_predictions
    df = spark.range(1000).select(F.col("id"), F.lit("{}").alias("input_features"))
    plan = plan_text(recent_predictions(df, 10))
    assert "TakeOrderedAndProject" in plan


def test_offsets_broadcast_is_bounded(spark):
    from wardstat.operators.ranking import hex_bucket, row_number_distributed
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"))
    out = row_number_distributed(df, [F.col("k")], hex_bucket(F.col("k"), 2))
    assert out.agg(F.max("rn"), F.countDistinct("rn")).first() == (5000, 5000)
    plan = plan_text(out)
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_hot_hospital_third_of_rows(spark):
    """One facility_id holds a third of all rows: the two-level pivot still
    equals a plain per-hospital average, and the raw rows are reduced by
    partial aggregation before the exchange."""
    from tests.conftest import SF001
    from wardstat.sources.derived import hrrp_raw
    raw = hrrp_raw(spark, SF001)
    hot = raw.withColumn("facility_id", F.when(F.crc32("facility_name") % 3 == 0, F.lit("HOT"))
                         .otherwise(F.col("facility_id")))
    cl = C.clean_raw(hot)
    got = P.pivot_wide(cl)
    want = (cl.filter(F.col("facility_id").isNotNull()).groupBy("facility_id")
            .agg(*[F.avg(F.when(F.col("measure_short") == m, F.col(r))).alias(f"{m}_{s}")
                   for r, s in [("excess_readmission_ratio", "excess_ratio"),
                                ("number_of_discharges", "discharges")]
                   for m in ["ami", "hf"]]))
    g = {r["facility_id"]: r for r in got.collect()}
    w = {r["facility_id"]: r for r in want.collect()}
    n_hot = hot.filter(F.col("facility_id") == "HOT").count()
    assert n_hot * 4 > raw.count()  # at least a quarter of all rows
    for fid, row in w.items():
        if fid not in g:
            continue
        for c in ("ami_excess_ratio", "hf_excess_ratio", "ami_discharges", "hf_discharges"):
            a, b = g[fid][c], row[c]
            assert (a is None and b is None) or a == pytest.approx(b, rel=1e-12)
    assert "HOT" in g


def test_recent_predictions_since_prunes_partitions(spark, tmp_path):
    import datetime as dt
    from wardstat.operators.monitoring import recent_predictions
    rows = [(i, dt.date(2024, 1, 1 + i % 3), '{"a": 1.0}', 0.5) for i in range(30)]
    path = str(tmp_path / "log")
    (spark.createDataFrame(rows, "id long, log_date date, input_features string, risk_score double")
     .write.partitionBy("log_date").parquet(path))
    df = recent_predictions(spark.read.parquet(path), 5, since="2024-01-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*log_date[^\]]*2024-01-03", plan)
    assert [r["id"] for r in df.collect()] == [29, 26, 23, 20, 17]


def test_distributed_rank_computes_input_once(spark, tmp_path):
    from wardstat.operators.ranking import hex_bucket, row_number_distributed
    from wardstat.session import apply_query_settings
    apply_query_settings(spark)  # as the query wrapper and plans do
    path = str(tmp_path / "keys")
    spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("k"),
                             (F.col("id") % 2).alias("g")).write.parquet(path)
    src = spark.read.parquet(path)
    out = row_number_distributed(src, [F.col("k")], hex_bucket(F.col("k"), 2), ["g"])
    out.collect()
    final = plan_text(out).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert "ReusedExchange" in final
