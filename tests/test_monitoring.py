import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardstat.operators import monitoring as MO
from wardstat.operators import scoring as S
from wardstat.schemas import LOG_SCHEMA


def log_df(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def mk(i, score, state="AL", feats='{"a": 1.0}', day=1):
    from wardstat.schemas import TIER_HIGH, TIER_MEDIUM
    tier = "high" if score >= TIER_HIGH else "medium" if score >= TIER_MEDIUM else "low"
    return (i, dt.datetime(2024, 1, day, 12, 0, i % 60), f"{i:06d}", f"H{i}", state, feats, score, tier, "v1")


def test_stats_empty_log_gives_zeros(spark):
    r = MO.prediction_stats(log_df(spark, [])).first()
    assert (r["total"], r["mean_risk_score"], r["high_count"], r["medium_count"], r["low_count"]) == (0, 0.0, 0, 0, 0)
    dist = [(r["risk_level"], r["n"]) for r in MO.risk_distribution(log_df(spark, [])).collect()]
    assert dist == [("low", 0), ("medium", 0), ("high", 0)]


def test_stats_and_distribution(spark):
    df = log_df(spark, [mk(1, 0.75), mk(2, 0.75), mk(3, 0.40), mk(4, 0.3999)])
    r = MO.prediction_stats(df).first()
    assert r["total"] == 4 and r["high_count"] == 2 and r["medium_count"] == 1 and r["low_count"] == 1
    assert r["mean_risk_score"] == round((0.75 * 2 + 0.4 + 0.3999) / 4, 4)
    assert [x["n"] for x in MO.risk_distribution(df).collect()] == [1, 1, 2]


def test_recent_predictions_clamp_and_parse(spark):
    rows = [mk(i, 0.1, feats="not json" if i == 3 else '{"a": 2.5}') for i in range(1, 6)]
    df = log_df(spark, rows)
    top = MO.recent_predictions(df, 2)
    assert [r["id"] for r in top.collect()] == [5, 4]
    assert "input_features" not in top.columns
    assert MO.recent_predictions(df, 1000).count() == 5
    for n in (0, 1001):
        with pytest.raises(ValueError):
            MO.recent_predictions(df, n)
    p = {r["id"]: r for r in MO.parse_features(df).collect()}
    assert p[3]["features"] is None and p[3]["raw_features"] == "not json"
    assert p[1]["features"] == {"a": 2.5} and p[1]["raw_features"] is None


def test_state_risk_guard(spark):
    one = log_df(spark, [mk(1, 0.2, "AL"), mk(2, 0.4, "AL"), mk(3, 0.9, None)])
    assert MO.state_risk(one).count() == 0
    two = log_df(spark, [mk(1, 0.2, "AL"), mk(2, 0.4, "AL"), mk(3, 0.9, "CA")])
    got = {r["state"]: (r["mean_risk"], r["n"]) for r in MO.state_risk(two).collect()}
    assert got["AL"][1] == 2 and got["AL"][0] == pytest.approx(0.3)


def test_windows_and_batch_summary(spark):
    df = log_df(spark, [mk(1, 0.7, day=1), mk(2, 0.1, day=1), mk(3, 0.5, day=2)])
    w = {r["window_start"].day: r for r in MO.risk_windows(df, "1 day").collect()}
    assert w[1]["n"] == 2 and w[1]["high_count"] == 1 and w[2]["medium_count"] == 1
    scored = spark.createDataFrame([(0.12345, "low"), (0.7, "high"), (0.66666, "high")],
                                   "risk_score double, risk_level string")
    s = MO.batch_summary(scored).first()
    assert (s["total"], s["high_risk_count"], s["low_medium_count"]) == (3, 2, 1)
    assert s["mean_risk_score"] == round((0.1235 + 0.7 + 0.6667) / 3, 4)


def test_normalise_scores_per_batch(spark):
    df = spark.createDataFrame([("a", 0.2), ("a", 0.9), ("b", 0.5), ("b", 2.0)], "b string, raw_score double")
    out = {(r["b"], r["raw_score"]): r["score"] for r in S.normalise_scores(df, by=["b"]).collect()}
    assert out[("a", 0.2)] == 0.2
    import math
    assert out[("b", 0.5)] == pytest.approx(1 / (1 + math.exp(-0.5)))


def test_results_export_names(spark):
    df = log_df(spark, [mk(1, 0.5)])
    assert MO.results_export(df).columns == ["Facility ID", "Hospital Name", "Risk Score", "Risk Level"]


def test_tiers_and_percent(spark):
    from wardstat.functions.tiers import risk_tier, score_percent
    df = spark.createDataFrame([(0.65,), (0.6499,), (0.40,), (0.0,), (0.0185,), (None,)], "s double")
    got = [(r[0], r[1]) for r in df.select(risk_tier("s"), score_percent("s")).collect()]
    assert [g[0] for g in got] == ["high", "medium", "medium", "low", "low", None]
    assert got[4][1] == 1.9 and got[0][1] == 65.0


def test_normalise_scores_single_batch(spark):
    import math
    inside = spark.createDataFrame([(0.2,), (0.9,)], "raw_score double")
    assert [r["score"] for r in S.normalise_scores(inside).collect()] == [0.2, 0.9]
    outside = spark.createDataFrame([(0.2,), (3.0,)], "raw_score double")
    got = [r["score"] for r in S.normalise_scores(outside).collect()]
    assert got[1] == pytest.approx(1 / (1 + math.exp(-3.0)))


def test_fixed_score_batch_summary(spark):
    """A model fixed at 0.75: every row is high risk, the summary counts 4."""
    df = spark.createDataFrame([(f"{i:06d}", f"H{i}", "AL", 0.75) for i in range(4)],
                               "facility_id string, facility_name string, state string, probability_1 double")
    resp = S.response_rows(S.tier_and_round(df), "1")
    assert {r["risk_level"] for r in resp.collect()} == {"high"}
    s = MO.batch_summary(resp).first()
    assert (s["total"], s["high_risk_count"], s["low_medium_count"], s["mean_risk_score"]) == (4, 4, 0, 0.75)
    assert set(resp.columns) == {"facility_id", "facility_name", "state", "risk_score", "risk_level", "model_version"}
