import pytest
from pyspark.sql import functions as F

from wardstat.operators import monitoring as MO
from wardstat.plans import catalog
from wardstat.plans import model as MD
from wardstat.plans import score as SC
from wardstat.operators import features as FE
from tests.conftest import SF001

SMALL = {"maxIter": (3, 6, "int"), "maxDepth": (2, 3, "int"), "stepSize": (0.1, 0.3, "log"),
         "subsamplingRate": (0.9, 1.0, "float"), "featureSubsetFraction": (0.9, 1.0, "float"),
         "minInstancesPerNode": (1, 3, "int"), "gamma": (0.0, 0.1, "float")}
FIXED = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.2}


@pytest.fixture(scope="module")
def feats(spark):
    return catalog.features(spark, SF001).persist()


@pytest.fixture(scope="module")
def trained(spark, feats):
    return MD.train(spark, feats, fixed_params=FIXED)


def test_param_sampling_seeded():
    a, b = MD.sample_params(5, 42), MD.sample_params(5, 42)
    assert a == b
    for p in a:
        assert 100 <= p["maxIter"] <= 600 and 3 <= p["maxDepth"] <= 7
        assert 0.01 <= p["stepSize"] <= 0.3


def test_cv_search_small(spark, feats):
    res = MD.train(spark, feats, n_trials=2, space=SMALL, parallelism=2)
    assert len(res.trials) == 2
    assert res.metrics["cv_auc_mean"] == pytest.approx(max(t["cv_auc_mean"] for t in res.trials), abs=1e-6)
    trials = MD.trial_frame(spark, "r1", res.trials)
    best = MD.best_trial(trials).first()
    assert best["cv_auc_mean"] == pytest.approx(max(t["cv_auc_mean"] for t in res.trials))


def test_metrics_ranges_and_determinism(spark, feats, trained):
    for k in ("auc", "f1", "precision", "recall", "brier_score"):
        assert 0.0 <= trained.metrics[k] <= 1.0
    again = MD.train(spark, feats, fixed_params=FIXED)
    assert again.metrics == trained.metrics


def test_save_load_same_predictions(spark, feats, trained, tmp):
    MD.save_model(spark, trained, f"{tmp}/m", MD.fit_vocabulary(feats), version="3")
    lm = MD.load_model(spark, f"{tmp}/m")
    assert lm.features == trained.features and lm.version == "3"
    x = MD.prepare(feats, trained.features)
    a = MD.positive_probability(trained.model.transform(x)).select("facility_id", "probability_1")
    b = MD.positive_probability(lm.model.transform(x)).select("facility_id", "probability_1")
    assert sorted(a.collect()) == sorted(b.collect())
    probs = [r[1] for r in a.collect()]
    assert all(0.0 <= p <= 1.0 for p in probs)
    with pytest.raises(FileNotFoundError):
        MD.load_model(spark, f"{tmp}/nothing")


def test_score_batch_log_and_summary(spark, feats, trained, tmp):
    MD.save_model(spark, trained, f"{tmp}/m", MD.fit_vocabulary(feats), version="7")
    lm = MD.load_model(spark, f"{tmp}/m")
    req = catalog.requests(spark, SF001)
    res = SC.score_batch(spark, lm, req, log_path=f"{tmp}/log", batch_id=1)
    n_valid = res.responses.count()
    assert n_valid + res.rejected.count() == req.count()
    s = res.summary.first()
    assert s["total"] == n_valid and s["low_medium_count"] == n_valid - s["high_risk_count"]
    lg = spark.read.parquet(f"{tmp}/log")
    assert lg.count() == n_valid
    # replaying the same batch replaces its rows instead of appending
    SC.score_batch(spark, lm, req, log_path=f"{tmp}/log", batch_id=1)
    assert spark.read.parquet(f"{tmp}/log").count() == n_valid
    SC.score_batch(spark, lm, req, log_path=f"{tmp}/log", batch_id=2)
    assert spark.read.parquet(f"{tmp}/log").count() == 2 * n_valid
    # the default batch is a new one each time; sources never meet; a replay
    # on another day still replaces its rows
    for _ in range(2):
        SC.score_batch(spark, lm, req, log_path=f"{tmp}/log").release()
    SC.score_batch(spark, lm, req, log_path=f"{tmp}/log", batch_id=1, source_id="other").release()
    lg = MO.read_log(spark, f"{tmp}/log")
    assert lg.count() == 5 * n_valid and lg.select("id").distinct().count() == 5 * n_valid
    late = res.scored if res.scored is not None else None
    rows = SC.log_rows(late, 1, "7").withColumn("log_date", F.date_add("log_date", 1))
    assert SC.append_log(rows, f"{tmp}/log") and MO.read_log(spark, f"{tmp}/log").count() == 5 * n_valid
    assert MO.prediction_stats(MO.read_log(spark, f"{tmp}/nothing")).first()["total"] == 0
    assert lm.metrics["auc"] == trained.metrics["auc"] and dict(lm.importances) == dict(trained.importances)
    # features JSON leaves out nulls and ids
    j = spark.read.parquet(f"{tmp}/log").select("input_features").first()[0]
    assert "facility_id" not in j and "null" not in j
    # strict mode refuses a batch with an invalid row
    from wardstat.operators.quality import ValidationError
    with pytest.raises(ValidationError):
        SC.score_batch(spark, lm, req, strict=True, max_rows=None)


def test_top_importances(spark, trained):
    imp = MD.importance_frame(spark, trained.importances)
    top = MD.top_importances(imp, 20).collect()
    assert len(top) == min(20, len(trained.importances))
    assert top[0]["metric_key"].startswith("fi_01_")
    keys = MD.parse_importance_keys(spark.createDataFrame(
        [("fi_01_hip_knee_excess_ratio",), ("auc",)], "metric_key string")).collect()
    assert keys[0]["feature"] == "hip_knee_excess_ratio" and keys[1]["feature"] is None


def test_with_ordinal_is_consecutive(spark):
    df = spark.range(0, 1000, 1, 7).withColumnRenamed("id", "x")
    out = SC.with_ordinal(df).collect()
    assert sorted(r["ordinal"] for r in out) == list(range(0, 1000))


def test_end_to_end_run(spark, tmp):
    from wardstat.plans.end_to_end import run
    from wardstat.sources import derived as D
    from wardstat.sources.pages import land_pages
    land = f"{tmp}/landing"
    land_pages(D.hrrp_raw(spark, SF001, with_order_keys=True), land, ["l_orderkey", "l_linenumber"])
    out = run(spark, land, f"{tmp}/work", n_trials=2, search_space=SMALL)
    p = out["paths"]
    assert out["pages_read"] > 0
    assert spark.read.parquet(p.features).count() == catalog.features(spark, SF001).count()
    assert spark.read.parquet(p.trials).count() == 2
    runs = spark.read.parquet(p.runs).collect()
    assert len(runs) == 1 and runs[0]["metrics"]["auc"] == pytest.approx(out["metrics"]["auc"])
    lm = MD.load_model(spark, p.model)
    assert lm.vocabulary is not None and lm.features


def test_serving_vocabulary_unknown_is_minus_one(spark):
    vocab = spark.createDataFrame([("AL", 0), ("CA", 1), ("Unknown", 2)], "state_key string, state_encoded int")
    feats = spark.createDataFrame([("a", "CA", 9.0), ("b", "XYZ", 9.0), ("c", None, 9.0)],
                                  "facility_id string, state string, state_encoded double")
    out = {r["facility_id"]: r["state_encoded"] for r in SC.apply_vocabulary(feats, vocab).collect()}
    assert out == {"a": 1.0, "b": -1.0, "c": 2.0}


def test_vocabulary_covers_states_seen_only_without_target(spark, tmp):
    from wardstat.plans.feature_build import build_features
    from wardstat.schemas import RAW_FIELDS

    def row(i, state, ratio):
        given = {"facility_id": i, "facility_name": i, "state": state, "measure_name": "READM-30-HF-HRRP",
                 "excess_readmission_ratio": ratio, "predicted_readmission_rate": "10.0",
                 "expected_readmission_rate": "10.0", "number_of_discharges": "50"}
        return tuple(given.get(c, "") for c in RAW_FIELDS)

    raw = spark.createDataFrame([row("h1", "AL", "1.1"), row("h2", "MA", "N/A"), row("h3", "NY", "0.9")],
                                ", ".join(f"{c} string" for c in RAW_FIELDS))
    raw.write.parquet(f"{tmp}/raw")
    built = build_features(spark, f"{tmp}/raw", f"{tmp}/features", strict=False)
    vocab = {r["state_key"]: r["state_encoded"] for r in built.vocabulary.collect()}
    assert vocab == {"AL": 0, "MA": 1, "NY": 2}
    assert {r["state"]: r["state_encoded"] for r in built.features.collect()} == {"AL": 0, "NY": 2}
    served = SC.apply_vocabulary(spark.createDataFrame([("NY", 0.0)], "state string, state_encoded double"), built.vocabulary)
    assert served.first()["state_encoded"] == 2.0
