import math

import pytest
from pyspark.sql import functions as F

from tests.fixtures import EDGE_STRINGS, EVEN, HIGH, LOW, PARTIAL, RATES, raw_rows
from wardstat.operators import clean as C
from wardstat.operators import features as FE
from wardstat.operators import pivot as P
from wardstat.operators import quality as Q
from wardstat.schemas import (
    FEATURE_TABLE_COLUMNS, MODEL_FEATURES, RAW_SCHEMA, STATES, WIDE_MEASURE_COLUMNS,
)


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(raw_rows(), RAW_SCHEMA)


@pytest.fixture(scope="module")
def wide(raw):
    return P.pivot_wide(C.clean_raw(raw))


@pytest.fixture(scope="module")
def feats(wide):
    return FE.feature_table(wide)


def test_tolerant_cast_edge_strings(spark):
    from wardstat.functions.numeric import tolerant_double
    df = spark.createDataFrame([(k,) for k in EDGE_STRINGS], "s string")
    got = {r["s"]: r["v"] for r in df.select("s", tolerant_double("s").alias("v")).collect()}
    for k, want in EDGE_STRINGS.items():
        if want is None:
            assert got[k] is None, k
        else:
            assert got[k] == want, k
    assert not any(v is not None and math.isnan(v) for v in got.values())


def test_clean_types_and_unknown_measure(raw):
    cl = C.clean_raw(raw)
    types = dict(cl.dtypes)
    for c in ("excess_readmission_ratio", "predicted_readmission_rate",
              "expected_readmission_rate", "number_of_discharges"):
        assert types[c] == "double"
    assert cl.filter(F.col("measure_name") == "READM-30-UNKNOWN-HRRP").count() == 0
    assert cl.filter(F.col("measure_short").isNull()).count() == 0
    assert set(r[0] for r in cl.select("measure_short").distinct().collect()) == {
        "ami", "cabg", "copd", "hf", "hip_knee", "pn"}


def test_pivot_one_row_per_hospital(wide):
    ids = [r[0] for r in wide.select("facility_id").collect()]
    assert sorted(ids) == sorted([LOW, HIGH, PARTIAL, EVEN, RATES])  # all-missing and null id dropped
    assert wide.columns == ["facility_id", "facility_name", "state"] + WIDE_MEASURE_COLUMNS


def test_duplicates_averaged_and_first_non_null_name(wide):
    r = wide.filter(F.col("facility_id") == EVEN).first()
    assert r["ami_excess_ratio"] == pytest.approx(1.0)
    assert r["facility_name"] == "Dells Medical"
    assert r["state"] == "wi"


def test_aggregates_exact(feats):
    rows = {r["facility_id"]: r for r in feats.collect()}
    h0 = rows[LOW]
    assert h0["mean_excess_ratio"] == pytest.approx(0.86)
    assert h0["n_valid_measures"] == 6 and h0["n_measures_over_threshold"] == 0
    assert h0["total_discharges"] == pytest.approx(1860.0)
    h1 = rows[HIGH]
    assert h1["high_readmission_risk"] == 1 and h1["n_measures_over_threshold"] == 6
    assert h1["total_discharges"] == pytest.approx(440.0)  # one suppressed
    h2 = rows[PARTIAL]
    assert h2["n_valid_measures"] == 4
    assert h2["mean_excess_ratio"] == pytest.approx(0.97)
    assert h2["max_excess_ratio"] == pytest.approx(0.97) and h2["min_excess_ratio"] == pytest.approx(0.97)
    assert h2["high_readmission_risk"] == 0
    h3 = rows[EVEN]  # mean exactly 1.0 -> not high risk
    assert h3["mean_excess_ratio"] == pytest.approx(1.0)
    assert h3["high_readmission_risk"] == 0
    assert RATES not in rows  # no ratio -> no label
    assert feats.columns == FEATURE_TABLE_COLUMNS


def test_state_encoding_sorted_with_unknown(wide):
    enc = FE.encode_state(FE.add_aggregate_features(wide))
    codes = {r["facility_id"]: r["state_encoded"] for r in enc.collect()}
    # sorted distinct: AZ, LA, OH, Unknown, wi  (binary order; NULL -> Unknown)
    assert codes == {LOW: 0, HIGH: 1, PARTIAL: 2, RATES: 3, EVEN: 4}


def test_serving_state_code(spark):
    df = spark.createDataFrame([("AK",), ("wy",), ("XYZ",), (None,), ("CA",)], "state string")
    got = [r[0] for r in df.select(FE.serving_state_code("state")).collect()]
    assert got == [0, len(STATES) - 1, 0, 0, STATES.index("CA")]


def test_serving_aggregates_null_counts(spark):
    from wardstat.schemas import REQUEST_SCHEMA
    data = [{c: None for c in REQUEST_SCHEMA.fieldNames()} for _ in range(2)]
    data[0]["ami_excess_ratio"] = 1.1
    data[0]["hf_excess_ratio"] = 0.9
    data[1]["ami_predicted_rate"] = 13.0
    df = spark.createDataFrame([tuple(d.values()) for d in data], REQUEST_SCHEMA)
    out = FE.assemble_features(df).collect()
    assert out[0]["mean_excess_ratio"] == pytest.approx(1.0)
    assert out[0]["n_measures_over_threshold"] == 1.0 and out[0]["n_valid_measures"] == 2.0
    assert out[1]["n_valid_measures"] is None and out[1]["n_measures_over_threshold"] is None
    assert out[1]["mean_predicted_rate"] == pytest.approx(13.0)


def test_model_input_and_alignment(feats):
    mi = FE.model_input(feats)
    assert mi.columns == MODEL_FEATURES and len(MODEL_FEATURES) == 28
    al = FE.align_features(feats.select("facility_id", "ami_excess_ratio"), ["ami_excess_ratio", "zzz"])
    assert al.columns == ["ami_excess_ratio", "zzz"]
    assert al.filter(F.col("zzz").isNotNull()).count() == 0


def test_validate_features_passes_and_fails(feats, spark):
    rules = Q.validate_features(feats, strict=True)
    assert rules.count() == 14 and rules.filter(~F.col("ok")).count() == 0
    bad = feats.withColumn("mean_excess_ratio", F.lit(9.0))
    with pytest.raises(Q.ValidationError):
        Q.validate_features(bad, strict=True)
    for c in ("facility_id", "high_readmission_risk"):
        with pytest.raises(Q.ValidationError):
            Q.validate_features(feats.drop(c), strict=False)


def test_completeness_and_balance(feats):
    comp = {r["column_name"]: r["pct_non_null"] for r in Q.completeness(feats, ["ami_excess_ratio", "hf_discharges"]).collect()}
    assert comp["ami_excess_ratio"] == pytest.approx(75.0)  # PARTIAL has no AMI ratio
    cb = Q.class_balance(feats).first()
    assert (cb["n"], cb["positives"], cb["negatives"]) == (4, 1, 3)
    cw = Q.class_weight(feats).first()
    assert cw["scale_pos_weight"] == 3.0
    assert Q.class_weight(feats.filter("high_readmission_risk = 0")).first()["scale_pos_weight"] == 1.0


def test_build_features_plan(spark, raw, tmp):
    from wardstat.plans.feature_build import build_features
    raw.write.parquet(f"{tmp}/raw")
    res = build_features(spark, f"{tmp}/raw", f"{tmp}/features")
    got = sorted(r["facility_id"] for r in res.features.collect())
    assert got == sorted([LOW, HIGH, PARTIAL, EVEN])
    assert res.rules.filter(~F.col("ok")).count() == 0
    assert res.report.first()["n_hospitals"] == 6  # six ids; the null id is not counted


def test_feature_table_types(feats):
    from wardstat.schemas import MODEL_FEATURES
    types = dict(feats.dtypes)
    assert all(types[c] in ("double", "bigint", "int") for c in MODEL_FEATURES)
    assert types["high_readmission_risk"] == "int" and types["facility_id"] == "string"
