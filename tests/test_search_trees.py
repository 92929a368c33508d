"""Adaptive search and compiled trees."""
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from wardstat.functions import trees as TR
from wardstat.operators import boosting as B
from wardstat.operators import search as S

SPACE = {"rate": (0.01, 0.3, "log"), "depth": (3, 7, "int"), "share": (0.6, 1.0, "float"), "alpha": (1e-4, 10.0, "log")}


def bowl(p):
    """Best at rate 0.05, depth 5, share 0.8; alpha matters little."""
    return -((math.log(p["rate"] / 0.05)) ** 2 + 0.3 * (p["depth"] - 5) ** 2 + 20 * (p["share"] - 0.8) ** 2
             + 0.01 * math.log(p["alpha"]) ** 2)


def run(seed, n=50, finished=(), save=None, startup=S.STARTUP):
    return S.search(SPACE, n, lambda ps: [{"cv_auc_mean": bowl(p)} for p in ps], seed, 10, finished, save, startup=startup)


def test_points_lie_in_the_space():
    for t in run(1):
        p = t["params"]
        assert 0.01 <= p["rate"] <= 0.3 and p["depth"] in range(3, 8) and 0.6 <= p["share"] <= 1.0 and 1e-4 <= p["alpha"] <= 10
    depths = {p["depth"] for p in S.propose(SPACE, [], 200, 3)}
    assert depths == set(range(3, 8))


def test_search_beats_random_draws():
    adaptive = [max(t["cv_auc_mean"] for t in run(seed)) for seed in range(12)]
    drawn = [max(t["cv_auc_mean"] for t in run(seed, startup=10**6)) for seed in range(12)]
    assert np.mean(adaptive) > np.mean(drawn) and np.median(adaptive) > np.median(drawn)
    late = [t["cv_auc_mean"] for seed in range(12) for t in run(seed)[30:]]
    early = [t["cv_auc_mean"] for seed in range(12) for t in run(seed)[:10]]
    assert np.mean(late) > np.mean(early)


@pytest.mark.parametrize("stop", [0, 10, 13, 20, 37, 50])
def test_a_resumed_search_proposes_the_same_points(stop):
    whole = run(7)
    saved = []
    again = run(7, stop, save=saved.extend)
    assert again == whole[:stop] == saved
    table = [{"trial": t["trial"], "params": {k: str(v) for k, v in t["params"].items()}, "cv_auc_mean": t["cv_auc_mean"]}
             for t in saved]  # as the trials table keeps them, in any order
    random.Random(1).shuffle(table)
    assert run(7, finished=table) == whole


def test_trials_without_a_value_count_as_worst():
    done = [({"rate": 0.05, "depth": 5, "share": 0.8, "alpha": 1.0}, float("nan"))] * 10
    done += [({"rate": 0.2, "depth": 3, "share": 0.95, "alpha": 1.0}, 0.9)] * 10
    got = S.propose(SPACE, done, 30, 1)
    assert np.median([p["rate"] for p in got]) > 0.1


# --- compiled trees --------------------------------------------------------

def random_booster(rng, n_trees=30, depth=5):
    def tree():
        t = B.Tree()

        def add(d):
            k = len(t.feature)
            for name, v in zip(("feature", "threshold", "missing_left", "left", "right", "value", "gain", "cover"),
                               (-1, 0.0, False, -1, -1, rng.uniform(-0.3, 0.3), 0.0, 1.0)):
                getattr(t, name).append(v)
            if d < depth and rng.random() < 0.9:
                t.feature[k], t.threshold[k], t.missing_left[k] = rng.randrange(3), rng.choice([0.1, 1 / 3, -0.5, 2e-9, 1.0]), rng.random() < 0.5
                t.left[k] = add(d + 1)
                t.right[k] = add(d + 1)
            return k
        add(0)
        return t
    return B.Booster(["a", "b", "c"], B.BoostParams(), [tree() for _ in range(n_trees)])


def walk(booster, row):
    total = []
    for t in booster.trees:
        k = 0
        while t.feature[k] >= 0:
            x = row[t.feature[k]]
            missing = x is None or math.isnan(x)
            k = t.left[k] if (t.missing_left[k] if missing else x < t.threshold[k]) else t.right[k]
        total.append(t.value[k])
    return math.fsum(total)


def test_columns_and_sql_equal_the_trees(spark):
    rng = random.Random(2)
    booster = random_booster(rng)
    values = [None, float("nan"), 0.1, 1 / 3, -0.5, 2e-9, 1.0, 0.0, 5.0, float("inf"), float("-inf")]
    rows = [(i, *[rng.choice(values) for _ in range(3)]) for i in range(500)]
    df = TR.missing_as_null(spark.createDataFrame(rows, "id long, a double, b double, c double"), booster.features)
    got = {r["id"]: (r["m"], r["p"]) for r in df.select("id", TR.margin_column(booster).alias("m"), TR.probability_column(booster).alias("p")).collect()}
    for i, *x in rows:
        assert got[i][0] == pytest.approx(walk(booster, x), abs=1e-12)
        assert got[i][1] == pytest.approx(1 / (1 + math.exp(-got[i][0])), abs=1e-15)
    pdf = df.toPandas()  # noqa: F841  (read by DuckDB)
    duck = duckdb.sql(f"SELECT id, {TR.margin_sql(booster)}, {TR.probability_sql(booster)} FROM "
                      "(SELECT id, CASE WHEN NOT isnan(a) THEN a END AS a, CASE WHEN NOT isnan(b) THEN b END AS b, "
                      "CASE WHEN NOT isnan(c) THEN c END AS c FROM pdf)").fetchall()
    for i, m, p in duck:
        assert m == got[i][0] and p == pytest.approx(got[i][1], abs=1e-15)


def test_absent_columns_are_missing_and_an_empty_model_says_one_half(spark):
    booster = random_booster(random.Random(5), 3)
    df = TR.missing_as_null(spark.createDataFrame([(1, "0.2")], "id long, b string"), booster.features)
    assert df.select(TR.margin_column(booster)).first()[0] == pytest.approx(walk(booster, [None, 0.2, None]))
    assert df.select(TR.probability_column(B.Booster(["a"], B.BoostParams()))).first()[0] == 0.5


def table(spark, n):
    return spark.range(0, n, 1, 8).select("id", *[F.when(F.col("id") % 7 != i, F.rand(i) * 2 - 0.5).alias(c) for i, c in enumerate("abc")])


def test_a_serving_model_runs_as_compiled_code(spark):
    """A hundred trees: a generated projection of its own, neither interpreted nor in Python."""
    booster = random_booster(random.Random(3), 100, 4)
    scored = table(spark, 200_000).select(TR.probability_column(booster).alias("p"))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "*" not in next(line for line in plan.splitlines() if "Project" in line) and "Python" not in plan
    out = scored.agg(F.count("p"), F.min("p"), F.max("p")).first()
    assert out[0] == 200_000 and 0 < out[1] < out[2] < 1


def test_batches_and_expressions_agree(spark, monkeypatch):
    booster = random_booster(random.Random(3), 60, 4)
    df = table(spark, 2000).cache()
    want = {r["id"]: r["p"] for r in df.select("id", TR.probability_column(booster).alias("p")).collect()}
    monkeypatch.setattr(TR, "COMPILED", 10)
    batched = df.select("id", TR.probability_column(booster).alias("p"))
    assert "ArrowEvalPython" in batched._jdf.queryExecution().executedPlan().toString()
    assert all(r["p"] == pytest.approx(want[r["id"]], abs=1e-15) for r in batched.collect())


def test_the_largest_model_of_the_search_scores(spark):
    booster = random_booster(random.Random(3), 600, 7)
    out = table(spark, 20_000).select(TR.probability_column(booster).alias("p")).agg(F.count("p"), F.min("p")).first()
    assert out[0] == 20_000 and out[1] > 0
