"""The booster against a plain one on a fixture; parameters; many models in one pass."""
import math

import numpy as np
import pytest

from wardstat.operators import boosting as B

FEATURES = ["a", "b", "c"]


def data(n=400, seed=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[rng.random((n, 3)) < 0.2] = np.nan
    y = ((np.nan_to_num(x[:, 0], nan=1.5) + 0.5 * np.nan_to_num(x[:, 1]) ** 2 + rng.normal(size=n) * 0.4) > 0.6).astype(int)
    return x, y, np.where(y == 1, 1.7, 1.0), np.arange(n) % 5


def frame(spark, x, y, w, fold, parts=3):
    rows = [(i * 7919, float(y[i]), float(w[i]), int(fold[i]), *[None if math.isnan(v) else float(v) for v in x[i]])
            for i in range(len(x))]
    return spark.createDataFrame(rows, "key long, label double, weight double, fold int, a double, b double, c double").repartition(parts)


def all_cuts(x):
    return [sorted({float(v) for v in col if not math.isnan(v)}) for col in x.T]


def plain_tree(x, g, h, cuts, p, depth=0):
    """Grow by trying every (feature, cut, side of missing), row by row."""
    G, H = g.sum() / B.ONE, h.sum() / B.ONE

    def score(a, b):
        return max(abs(a) - p.reg_alpha, 0.0) ** 2 / (b + p.reg_lambda) if b + p.reg_lambda > 0 else 0.0
    best = (B.EPS, None)
    for f in range(x.shape[1]):
        miss = np.isnan(x[:, f])
        for c in cuts[f]:
            for left_too in (False, True):
                go = np.where(miss, left_too, x[:, f] < c)
                gl, hl = g[go].sum() / B.ONE, h[go].sum() / B.ONE
                gr, hr = G - gl, H - hl
                if min(hl, hr) <= 0 or min(hl, hr) < p.min_child_weight:
                    continue
                gain = score(gl, hl) + score(gr, hr) - score(G, H)
                if gain > best[0]:
                    best = (gain, (f, c, left_too, go))
    if depth == p.max_depth or best[1] is None or best[0] < p.gamma:
        t = math.copysign(max(abs(G) - p.reg_alpha, 0.0), G)
        return lambda r, v=-p.learning_rate * t / (H + p.reg_lambda): v
    f, c, left_too, go = best[1]
    left = plain_tree(x[go], g[go], h[go], cuts, p, depth + 1)
    right = plain_tree(x[~go], g[~go], h[~go], cuts, p, depth + 1)
    return lambda r: (left if (left_too if math.isnan(r[f]) else r[f] < c) else right)(r)


def plain_margins(x, y, w, learn, cuts, p):
    m = np.zeros(len(x))
    for _ in range(p.n_estimators):
        prob = 1 / (1 + np.exp(-m))
        g, h = np.rint(w * (prob - y) * B.ONE), np.rint(w * prob * (1 - prob) * B.ONE)
        tree = plain_tree(x[learn], g[learn], h[learn], cuts, p)
        m = m + np.array([tree(r) for r in x])
    return m


def grow(spark, specs, x, y, w, fold, cuts, parts=3, rows=64):
    state = B.pack(frame(spark, x, y, w, fold, parts), FEATURES, cuts, len(specs), rows=rows)
    models, state = B.fit(state, FEATURES, cuts, specs, partitions=parts)
    held = [s.holdout for s in specs]
    scores = {(r["model"], r["key"] // 7919): r["score"] for r in B.margins(state, 3).collect()}
    out = {(r["model"], r["key"] // 7919) for r in B.margins(state, 3, held).collect()}
    state.unpersist()
    return models, scores, out


CASES = [B.BoostParams(n_estimators=3, max_depth=3, learning_rate=0.3),
         B.BoostParams(n_estimators=2, max_depth=4, learning_rate=0.1, reg_alpha=2.0, reg_lambda=0.0),
         B.BoostParams(n_estimators=2, max_depth=5, gamma=3.0, min_child_weight=6.0, reg_lambda=5.0)]


def test_many_models_at_once_match_a_plain_booster(spark):
    """Different parameters and folds in one pass; the model of fold 2 does not learn from it."""
    x, y, w, fold = data()
    cuts = all_cuts(x)
    specs = [B.Spec(p, holdout=k) for p, k in zip(CASES, (None, 2, 0))]
    models, scores, out = grow(spark, specs, x, y, w, fold, cuts)
    for m, s in enumerate(specs):
        learn = fold != s.holdout if s.holdout is not None else np.ones(len(x), bool)
        want = 1 / (1 + np.exp(-plain_margins(x, y, w, learn, cuts, s.params)))
        got = np.array([scores[m, i] for i in range(len(x))])
        assert np.abs(got - want).max() < 1e-9
        assert {i for k, i in out if k == m} == set(np.flatnonzero(~learn) if s.holdout is not None else range(len(x)))
        assert len(models[m].trees) == s.params.n_estimators
    # one by one and on another partitioning: the same trees
    for m, s in enumerate(specs):
        alone, _, _ = grow(spark, [s], x, y, w, fold, cuts, parts=5, rows=17)
        assert alone[0].to_json() == models[m].to_json()


def leaves(booster):
    return sum(f < 0 for t in booster.trees for f in t.feature)


def test_every_parameter_acts(spark):
    x, y, w, fold = data()
    cuts = all_cuts(x)
    base = B.BoostParams(n_estimators=3, max_depth=4, learning_rate=0.3)
    change = {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.1, "subsample": 0.6, "colsample_bytree": 0.4,
              "min_child_weight": 10.0, "gamma": 2.0, "reg_alpha": 3.0, "reg_lambda": 20.0}
    specs = [B.Spec(base)] + [B.Spec(B.BoostParams(**{**base.__dict__, k: v})) for k, v in change.items()]
    models, scores, _ = grow(spark, specs, x, y, w, fold, cuts)
    plain = [scores[0, i] for i in range(len(x))]
    for m in range(1, len(specs)):
        assert [scores[m, i] for i in range(len(x))] != plain, list(change)[m - 1]
    by = dict(zip(change, models[1:]))
    assert len(by["n_estimators"].trees) == 2
    assert max(len(t.feature) for t in by["max_depth"].trees) <= 7
    for k in ("min_child_weight", "gamma"):
        assert leaves(by[k]) < leaves(models[0]), k
    for k in ("reg_alpha", "reg_lambda"):
        assert max(map(abs, by[k].trees[0].value)) < max(map(abs, models[0].trees[0].value)), k
    assert all(len(set(t.feature) - {-1}) <= 1 for t in by["colsample_bytree"].trees)
    again = B.Booster.from_json(models[0].to_json())
    assert again == models[0] and abs(sum(v for _, v in again.importances()) - 1) < 1e-9


def test_missing_values_find_their_side(spark):
    """Rows without a value are all positive: the learned side, not imputation, says so."""
    n = 200
    x = np.full((n, 3), np.nan)
    x[:120, 0] = np.arange(120) / 10
    y = np.array([0] * 60 + [1] * 60 + [1] * 80)
    models, scores, _ = grow(spark, [B.Spec(B.BoostParams(n_estimators=5, max_depth=2, learning_rate=0.5))], x, y,
                             np.ones(n), np.zeros(n, int), all_cuts(x))
    top = models[0].trees[0]
    assert top.feature[0] == 0 and top.threshold[0] == 6.0 and not top.missing_left[0]
    assert all((scores[0, i] > 0.5) == (y[i] == 1) for i in range(n))


def test_awkward_tables(spark):
    x, y, w, fold = data(40)
    nothing = np.full((40, 3), np.nan)
    for xs, ys in ((nothing, y), (np.zeros((40, 3)), y), (x, np.ones(40, int))):
        models, scores, _ = grow(spark, [B.Spec(B.BoostParams(n_estimators=2, max_depth=2))], xs, ys, w, fold, all_cuts(xs))
        assert all(0 < s < 1 for s in scores.values()) and len(scores) == 40
    empty = frame(spark, x[:1], y[:1], w[:1], fold[:1]).limit(0)
    models, state = B.fit(B.pack(empty, FEATURES, [[0.0], [], [1.0]]), FEATURES, [[0.0], [], [1.0]],
                          [B.Spec(B.BoostParams(n_estimators=1, max_depth=2))])
    assert models[0].trees[0].value == [0.0] and B.margins(state, 3).count() == 0


def test_cut_points(spark):
    x, y, w, fold = data()
    df = frame(spark, x, y, w, fold)
    cuts = B.cut_points(df, FEATURES)
    for c, col in zip(cuts, x.T):
        values = {v for v in col if not math.isnan(v)}
        assert c == sorted(c) and set(c) <= values and len(c) > 0.8 * len(values)
    assert all(len(c) < 8 for c in B.cut_points(df, FEATURES, max_bins=8))


@pytest.mark.parametrize("alpha, want", [(0.0, -2.0), (1.0, -1.5), (9.0, 0.0)])
def test_leaf_weight(alpha, want):
    assert B.leaf_weight(4.0, 1.0, B.BoostParams(reg_alpha=alpha, reg_lambda=1.0)) == want


def test_what_a_task_hands_on_does_not_grow_with_its_rows(spark, monkeypatch):
    """One array of sums a node, whatever the blocks; more nodes than `HELD` allows take several jobs."""
    x, y, w, fold = data()
    cuts = all_cuts(x)
    slots = np.array([len(c) + 2 for c in cuts])
    trees = [B._Growing(B.Spec(CASES[0]), 0, 0, 3)]
    sizes = []
    for copies in (1, 40):
        packed = B.pack(frame(spark, x, y, w, fold, 1), FEATURES, cuts, rows=64).toArrow().combine_chunks().to_batches()[0]
        level = B._Level([(0, trees[0], [0])], slots, 1)
        (_, _, entry, g, h), = level.histograms(B._blocks([packed] * copies, 3))
        sizes.append((len(entry), int(g.sum()) / copies, int(h.sum()) / copies))
    assert sizes[0] == sizes[1] and sizes[0][0] <= slots.sum()
    whole, _, _ = grow(spark, [B.Spec(CASES[0])], x, y, w, fold, cuts)
    monkeypatch.setattr(B, "HELD", 2 * int(slots.sum()))
    trees[0].active = [3, 4, 5]
    assert [[nodes for _, _, nodes in job] for job in B._jobs(trees * 2, int(slots.sum()))] == [[[3, 4]], [[5], [3]], [[4, 5]]]
    cut, _, _ = grow(spark, [B.Spec(CASES[0])], x, y, w, fold, cuts)
    assert cut[0].to_json() == whole[0].to_json()


def test_blocks_are_filled_over_batches(spark):
    """Arrow batches smaller than a block do not cut it, and many models make it smaller."""
    x, y, w, fold = data()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = frame(spark, x, y, w, fold, 1)
        got = B.pack(rows, FEATURES, all_cuts(x), rows=150).collect()
        many = B.pack(rows, FEATURES, all_cuts(x), B.BLOCK_MARGINS // 100).select("n").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [r["n"] for r in got] == [150, 150, 100] and [r["n"] for r in many] == [100] * 4
    keys = np.concatenate([np.frombuffer(r["key"], np.int64) for r in got])
    assert sorted(keys.tolist()) == [i * 7919 for i in range(400)]
