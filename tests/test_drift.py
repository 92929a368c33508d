"""Drift measures against plain ones, sketch error, the stream form."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardstat.operators import drift as D

ROWS = "timestamp timestamp, risk_score double, note string"
DAY0 = dt.datetime(2024, 1, 1)


def scores():
    """Ten days: the same law for seven, then shifted, then narrow, then all alike."""
    rng = np.random.default_rng(8)
    days = [rng.beta(2, 4, 900) for _ in range(7)] + [rng.beta(3, 3, 700), rng.beta(20, 40, 700), np.full(50, 0.999)]
    return [np.round(x, 4) for x in days]


@pytest.fixture(scope="module")
def log(spark):
    rows = [(DAY0 + dt.timedelta(days=d, seconds=i % 86000), float(s), "x") for d, day in enumerate(scores()) for i, s in enumerate(day)]
    rows += [(None, 0.5, "no time"), (DAY0, None, "no score"), (DAY0, float("nan"), "no number")]
    return spark.createDataFrame(rows, ROWS).repartition(5).cache()


def reference():
    return F.col("window_end") <= F.lit("2024-01-08 00:00:00").cast("timestamp")


def by_day(df):
    return {(r["window_start"] - DAY0).days: r for r in df.collect()}


def test_exact_drift_against_numpy(spark, log):
    days = scores()
    ref = np.concatenate(days[:7])
    got = by_day(D.drift(log, reference()))
    assert sorted(got) == list(range(10))
    edges = np.arange(1, D.BINS) / D.BINS

    def counts(x):
        return np.bincount(np.minimum(np.floor(x * D.BINS).astype(int), D.BINS - 1), minlength=D.BINS)
    for d, x in enumerate(days):
        a, e = counts(x) / len(x), counts(ref) / len(ref)
        assert got[d]["n"] == len(x)
        assert got[d]["psi"] == pytest.approx(D.psi_of(list(a), list(e)), abs=1e-9)
        assert got[d]["ks"] == pytest.approx(np.abs(np.cumsum(a) - np.cumsum(e)).max(), abs=1e-12)
    assert max(got[d]["psi"] for d in range(7)) < 0.1 < got[7]["psi"] < got[9]["psi"] and len(edges) == D.BINS - 1


def test_sketch_drift_is_close_to_the_exact_one(spark, log, tmp):
    days = scores()
    ref = np.sort(np.concatenate(days[:7]))
    D.score_sketches(log).write.parquet(f"{tmp}/sketches")  # stored once, the log is not read again
    windows = spark.read.parquet(f"{tmp}/sketches")
    got = by_day(D.sketch_drift(windows, D.reference_sketch(windows.where(reference()))))

    def cdf(x, at):
        return np.searchsorted(np.sort(x), at, "right") / len(x)
    for d, x in enumerate(days):
        at = np.concatenate([x, ref])
        assert got[d]["n"] == len(x)
        assert got[d]["ks"] == pytest.approx(np.abs(cdf(x, at) - cdf(ref, at)).max(), abs=0.04)
    assert max(got[d]["psi"] for d in range(7)) < 0.1 < got[7]["psi"] < got[9]["psi"]
    assert got[8]["psi"] > 0.5


def test_merged_sketches_keep_their_error(spark, log):
    days = scores()
    whole = D.merge_sketches(D.score_sketches(log), "30 days")
    x = np.sort(np.concatenate(days))
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    row = whole.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("s")).select(
        "n", F.kll_sketch_get_quantile_double("s", F.array(*map(F.lit, probs))).alias("q")).first()
    assert row["n"] == len(x)
    for p, q in zip(probs, row["q"]):
        lo, hi = np.searchsorted(x, q, "left") / len(x), np.searchsorted(x, q, "right") / len(x)
        assert lo - 0.02 <= p <= hi + 0.02


def test_stream_form_gives_the_same_windows(spark, log, tmp):
    log.where("timestamp is not null").coalesce(3).write.parquet(f"{tmp}/log")
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/log")
    late = stream.withWatermark("timestamp", "40 days")
    first_week = spark.createDataFrame([tuple(D.reference_histogram(D.score_histograms(log).where(reference())).first())],
                                      "ref_n long, ref_counts array<long>")
    q = (D.drift_from_histograms(D.score_histograms(late), first_week).writeStream.format("memory").queryName("drift_stream")
         .outputMode("complete").option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    assert q.awaitTermination(120)
    got, want = by_day(spark.table("drift_stream")), by_day(D.drift(log, reference()))
    assert {d: (r["n"], r["psi"], r["ks"]) for d, r in got.items()} == {d: (r["n"], r["psi"], r["ks"]) for d, r in want.items()}


def test_empty_sides_give_no_rows(spark, log):
    empty = spark.createDataFrame([], ROWS)
    assert D.drift(empty, reference()).count() == 0
    assert D.drift(log, F.lit(False)).count() == 0
    sketches = D.score_sketches(log)
    assert D.sketch_drift(sketches, D.reference_sketch(sketches.where(F.lit(False)))).count() == 0


def test_ends_join_the_end_bins(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.05,), (0.999,), (1.0,), (7.0,)], "s double")
    assert [r[0] for r in df.select(D.score_bin("s")).collect()] == [0, 0, 1, 19, 19, 19]
