import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardstat.operators import metrics as M
from wardstat.operators import ranking as R


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    u = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return u / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        y = 1 if rng.random() < 0.35 else 0
        s = round(min(1.0, max(0.0, rng.gauss(0.55 if y else 0.4, 0.2))), 2)  # many ties
        rows.append((f"{i:06d}", y, s))
    return spark.createDataFrame(rows, "facility_id string, label int, score double")


def test_distributed_row_number_matches_window(spark, scored):
    got = R.row_number_distributed(scored, [F.col("score"), F.col("facility_id")],
                                   R.range_bucket(scored, "score", min_buckets=16), ["label"], with_count=True)
    want = scored.withColumn("rn", F.row_number().over(
        Window.partitionBy("label").orderBy("score", "facility_id")))
    a = {r["facility_id"]: (r["rn"], r["rn_total"]) for r in got.collect()}
    b = {r["facility_id"]: r["rn"] for r in want.collect()}
    totals = {r["label"]: r["count"] for r in scored.groupBy("label").count().collect()}
    lab = {r["facility_id"]: r["label"] for r in scored.collect()}
    assert {k: v[0] for k, v in a.items()} == b
    assert all(v[1] == totals[lab[k]] for k, v in a.items())


def test_auc_matches_brute_force_and_spark(spark, scored):
    pairs = [(r["label"], r["score"]) for r in scored.collect()]
    got = M.roc_auc(scored).first()["auc"]
    assert got == pytest.approx(brute_auc(pairs), abs=1e-12)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                       metricName="areaUnderROC", numBins=0)
    spark_auc = ev.evaluate(scored.withColumn("label", F.col("label").cast("double")))
    assert got == pytest.approx(spark_auc, abs=1e-9)


def test_auc_per_group_and_degenerate(spark, scored):
    g = scored.withColumn("g", (F.col("facility_id").cast("int") % 3))
    per = {r["g"]: r["auc"] for r in M.roc_auc(g, by=["g"]).collect()}
    for k in range(3):
        pairs = [(r["label"], r["score"]) for r in g.filter(F.col("g") == k).collect()]
        assert per[k] == pytest.approx(brute_auc(pairs), abs=1e-12)
    only_pos = scored.filter("label = 1")
    assert M.roc_auc(only_pos).first()["auc"] is None


def test_binary_metrics_and_report(scored):
    rows = scored.collect()
    tp = sum(1 for r in rows if r["score"] >= 0.5 and r["label"] == 1)
    fp = sum(1 for r in rows if r["score"] >= 0.5 and r["label"] == 0)
    fn = sum(1 for r in rows if r["score"] < 0.5 and r["label"] == 1)
    bm = M.binary_metrics(scored).first()
    assert (bm["tp"], bm["fp"], bm["fn"]) == (tp, fp, fn)
    assert bm["precision"] == pytest.approx(tp / (tp + fp))
    assert bm["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    brier = sum((r["score"] - r["label"]) ** 2 for r in rows) / len(rows)
    assert bm["brier_score"] == pytest.approx(brier)
    rep = {r["class_name"]: r for r in M.classification_report(scored).collect()}
    assert rep["High Risk"]["precision"] == pytest.approx(bm["precision"])
    assert rep["accuracy"]["support"] == len(rows)
    assert set(rep) == {"Low Risk", "High Risk", "accuracy", "macro avg", "weighted avg"}


def test_stratified_split_and_folds(spark, scored):
    out = R.stratified_split(scored, label="label").collect()
    by_label = {}
    for r in out:
        by_label.setdefault(r["label"], []).append(r)
    for lab, rs in by_label.items():
        n = len(rs)
        n_test = sum(1 for r in rs if r["split"] == "test")
        assert n_test == -(-n * 2 // 10)  # ceil(0.2 n)
        folds = [r["fold"] for r in rs if r["split"] == "train"]
        counts = [folds.count(k) for k in range(5)]
        assert max(counts) - min(counts) <= 1
    again = R.stratified_split(scored, label="label").collect()
    assert sorted((r["facility_id"], r["split"], r["fold"]) for r in again) == \
        sorted((r["facility_id"], r["split"], r["fold"]) for r in out)


def test_cv_summary_population_std(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate([0.8, 0.9, 1.0])], "fold int, auc double")
    r = M.cv_summary(df).first()
    assert r["cv_auc_mean"] == pytest.approx(0.9)
    assert r["cv_auc_std"] == pytest.approx((0.02 / 3) ** 0.5)


def test_sample_rows_is_seeded_topk(spark, scored):
    a = [r[0] for r in R.sample_rows(scored, 10).select("facility_id").collect()]
    b = [r[0] for r in R.sample_rows(scored.repartition(5), 10).select("facility_id").collect()]
    assert a == b and len(a) == 10
    assert R.sample_rows(scored, 10_000).count() == scored.count()


def test_range_bucket_rank_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") * 3 % 4999).alias("k"), (F.col("id") % 7).alias("t"))
    b = R.range_bucket(df, "k", target_rows=10)  # ~500 buckets
    got = R.row_number_distributed(df, [F.col("k"), F.col("t")], b).select("k", "t", "rn")
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "t")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_range_bucket_splits_dense_range_beside_an_outlier(spark):
    df = spark.range(0, 10_000).select(F.when(F.col("id") == 0, 10 ** 12).otherwise(F.col("id")).alias("k"))
    sizes = df.groupBy(R.range_bucket(df, "k", target_rows=50).alias("b")).count().agg(F.max("count")).first()[0]
    assert sizes < 500


def test_null_keys_are_ranked_and_split_like_others(spark):
    rows = [("a", 0), ("b", None), (None, 1), ("d", 1), ("e", None)]
    df = spark.createDataFrame(rows, "facility_id string, high_readmission_risk int")
    assert R.stratified_split(df).count() == 5
    scored = spark.createDataFrame([(None, 1, 0.9), (None, 0, 0.1), (1, 1, 0.2), (1, 0, 0.8)],
                                   "fold int, label int, score double")
    auc = {r["fold"]: r["auc"] for r in M.roc_auc(scored, by=["fold"]).collect()}
    assert auc == {None: 1.0, 1: 0.0}
