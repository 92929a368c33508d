"""Training: adaptive search with k-fold CV over boosted trees, held-out
evaluation, importances, persistence and run logs.

The learner is `wardstat.operators.boosting`: second-order trees that learn
a side for missing values, so nothing is imputed; a column that is wholly
NULL in the training split is left out. Folds are the stratified `fold`
column, so fold membership is data, not an RNG side effect. A batch of
trials is grown in one pass, all folds of all its points side by side; the
next batch is proposed from the trials table (`wardstat.operators.search`).
"""

from __future__ import annotations

import json
import math
import os
import random
import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.functions.trees import missing_as_null, probability_column
from wardstat.operators import boosting as B
from wardstat.operators import metrics as M
from wardstat.operators.features import state_vocabulary
from wardstat.operators.quality import class_weight, with_weight
from wardstat.operators.ranking import stratified_split
from wardstat.operators.search import search
from wardstat.schemas import MODEL_FEATURES, N_FOLDS, RANDOM_STATE, TARGET
from wardstat.session import path_exists as table_exists

MODEL_NAME = "readmission-risk-gbt"
BATCH = 10  # trials of one pass
#: model that scoring uses unless a trained one is given (tools/train_model.py writes it)
SERVING_MODEL = os.path.join(os.path.dirname(os.path.abspath(__file__)), "serving_model.json")

#: (low, high, kind) of every parameter of the search
SEARCH_SPACE = {
    "maxIter": (100, 600, "int"),
    "maxDepth": (3, 7, "int"),
    "stepSize": (0.01, 0.3, "log"),
    "subsamplingRate": (0.6, 1.0, "float"),
    "featureSubsetFraction": (0.6, 1.0, "float"),
    "minInstancesPerNode": (1, 10, "int"),  # least hessian sum of a child
    "gamma": (0.0, 1.0, "float"),
    "regAlpha": (1e-4, 10.0, "log"),
    "regLambda": (1e-4, 10.0, "log"),
}

#: the booster's name of a parameter of the search
BOOSTER_NAME = {"maxIter": "n_estimators", "maxDepth": "max_depth", "stepSize": "learning_rate",
                "subsamplingRate": "subsample", "featureSubsetFraction": "colsample_bytree",
                "minInstancesPerNode": "min_child_weight", "regAlpha": "reg_alpha", "regLambda": "reg_lambda"}


def boost_params(p: dict) -> B.BoostParams:
    return B.BoostParams.of({BOOSTER_NAME.get(k, k): v for k, v in p.items()})


class BoostedModel:
    """A fitted booster: `transform` adds `probability_1`, one projection over the rows."""

    def __init__(self, booster: B.Booster):
        self.booster = booster

    def transform(self, df: DataFrame) -> DataFrame:
        return (missing_as_null(df, self.booster.features)
                .withColumn("probability_1", probability_column(self.booster)))


@dataclass
class TrainResult:
    model: BoostedModel
    features: list[str]
    best_params: dict
    metrics: dict
    trials: list[dict] = field(default_factory=list)
    importances: list[tuple[str, float]] = field(default_factory=list)
    scale_pos_weight: float = 1.0
    n_train: int = 0
    n_test: int = 0


def sample_params(n_trials: int, seed: int = RANDOM_STATE,
                  space: dict | None = None) -> list[dict]:
    """Seeded random search: `n_trials` points of the search space
    (uniform, or log-uniform for `log` ranges)."""
    space = space or SEARCH_SPACE
    rng = random.Random(seed)
    out = []
    for _ in range(n_trials):
        p = {}
        for name, (lo, hi, kind) in space.items():
            if kind == "int":
                p[name] = rng.randint(int(lo), int(hi))
            elif kind == "log":
                p[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                p[name] = rng.uniform(lo, hi)
        out.append(p)
    return out


def prepare(df: DataFrame, features: list[str], label: str | None = TARGET) -> DataFrame:
    """Model input columns as doubles (absent -> NULL) and a double label."""
    have = set(df.columns)
    cols = [(F.col(c) if c in have else F.lit(None)).cast("double").alias(c) for c in features]
    extra = [c for c in ("facility_id", "facility_name", "state", "ordinal", "fold", "weight",
                         "input_features") if c in have]
    if label and label in have:
        cols.append(F.col(label).cast("double").alias("label"))
    return df.select(*extra, *cols)


def kept_features(train: DataFrame, features: list[str]) -> list[str]:
    """Features with at least one value in the training split (one pass)."""
    row = train.agg(*[F.count(F.col(c)).alias(c) for c in features]).first()
    return [c for c in features if row[c] and row[c] > 0]


def positive_probability(scored: DataFrame, out: str = "probability_1") -> DataFrame:
    return scored if out == "probability_1" else scored.withColumnRenamed("probability_1", out)


def importances(model: BoostedModel) -> list[tuple[str, float]]:
    """(feature, importance): mean gain of the feature's splits as a share of all."""
    return model.booster.importances()


def cross_validate(train_in: DataFrame, features: list[str], cuts: list[list[float]], points: list[dict],
                   n_folds: int = N_FOLDS, seed: int = RANDOM_STATE) -> list[dict]:
    """Mean and standard deviation of the held-out AUC of every point over the
    folds. All points and folds are grown side by side: one job a level."""
    specs = [B.Spec(boost_params(p), k, seed) for p in points for k in range(n_folds)]
    models, state = B.fit(pack_rows(train_in, features, cuts, len(specs)), features, cuts, specs)
    scores = B.margins(state, len(features), [s.holdout for s in specs])
    auc = {r["model"]: r["auc"] for r in M.roc_auc(scores, by=["model"]).collect()}  # one row a model
    state.unpersist()
    out = []
    for i in range(len(points)):
        folds = np.array([x if x is not None else math.nan for x in (auc.get(i * n_folds + k) for k in range(n_folds))], float)
        out.append({"cv_auc_mean": float(folds.mean()), "cv_auc_std": float(folds.std())})
    return out


def pack_rows(train_in: DataFrame, features: list[str], cuts: list[list[float]], models: int = 1) -> DataFrame:
    fold = F.col("fold") if "fold" in train_in.columns else F.lit(0)
    keyed = train_in.withColumn("key", F.xxhash64("facility_id")).withColumn("fold", F.coalesce(fold, F.lit(-1)))
    return B.pack(keyed, features, cuts, models)


def train(spark: SparkSession, features_df: DataFrame, n_trials: int = 50,
          n_folds: int = N_FOLDS, seed: int = RANDOM_STATE, parallelism: int = BATCH,
          fixed_params: dict | None = None, max_bins: int = 256,
          space: dict | None = None, trials_path: str | None = None, run_id: str | None = None) -> TrainResult:
    """Split, search, refit on the whole training split, evaluate on the
    held-out split. `fixed_params` skips the search (one point, no CV);
    `parallelism` is the number of trials grown in one pass. With
    `trials_path`, finished batches are appended to the trials table there,
    and a search of the same `run_id` goes on from what it holds.
    """
    # The split hospital table is read by the class weight, the column check,
    # the thresholds, the blocks and the held-out evaluation: checkpoint it
    # once to the shared checkpoint folder instead of recomputing the features
    # each time.
    split = stratified_split(features_df, n_folds=n_folds, seed=seed).checkpoint(eager=True)
    train_df = split.filter(F.col("split") == "train")
    test_df = split.filter(F.col("split") == "test")

    cw = class_weight(train_df).first()
    spw = float(cw["scale_pos_weight"])
    feats = kept_features(train_df, MODEL_FEATURES)

    train_in = prepare(with_weight(train_df, round(spw, 4)), feats).persist()
    n_train = train_in.count()
    cuts = B.cut_points(train_in, feats, max_bins)

    trials: list[dict] = []
    if fixed_params is not None:
        best = dict(fixed_params)
    else:
        run_id = run_id or new_run_id()
        done: list[dict] = []
        if trials_path and table_exists(spark, trials_path):
            done = [r.asDict() for r in spark.read.schema(TRIAL_SCHEMA).parquet(trials_path)
                    .where(F.col("run_id") == run_id).collect()]  # a row a trial
        save = None
        if trials_path:
            def save(new):
                trial_frame(spark, run_id, [_as_row(t) for t in new]).write.mode("append").parquet(trials_path)
        found = search(space or SEARCH_SPACE, n_trials,
                       lambda points: cross_validate(train_in, feats, cuts, points, n_folds, seed),
                       seed, max(1, parallelism), done, save)
        trials = [_as_row(t) for t in found]
        best = dict(max(found, key=lambda t: (t["cv_auc_mean"] if t["cv_auc_mean"] == t["cv_auc_mean"] else -1.0, -t["trial"]))["params"])
    models, state = B.fit(pack_rows(train_in, feats, cuts), feats, cuts, [B.Spec(boost_params(best), None, seed)])
    state.unpersist()
    model = BoostedModel(models[0])

    test_in = prepare(test_df, feats)
    scored = positive_probability(model.transform(test_in))
    pairs = scored.select(F.col("label").cast("int").alias("label"), F.col("probability_1").alias("score"))
    bm = M.binary_metrics(pairs).first().asDict()
    auc = M.roc_auc(pairs).first()["auc"]
    metrics = {"auc": auc, "f1": bm["f1"], "precision": bm["precision"],
               "recall": bm["recall"], "brier_score": bm["brier_score"]}
    if trials:
        metrics["cv_auc_mean"] = round(max(t["cv_auc_mean"] for t in trials), 6)
    n_test = test_in.count()
    train_in.unpersist()
    return TrainResult(model=model, features=feats, best_params=best, metrics=metrics,
                       trials=trials, importances=importances(model), scale_pos_weight=spw,
                       n_train=n_train, n_test=n_test)


def _as_row(t: dict) -> dict:
    return {**t, "params": {k: str(v) for k, v in t["params"].items()}}


# ---------------------------------------------------------------------------
# Importances, trial and run tables
# ---------------------------------------------------------------------------

def importance_frame(spark: SparkSession, pairs: list[tuple[str, float]]) -> DataFrame:
    return spark.createDataFrame(pairs, "feature string, importance double")


def top_importances(imp: DataFrame, n: int = 20) -> DataFrame:
    """Top-n by importance with rank, `fi_{rank:02d}_{name}` key and band.
    Ties are broken by name so the ranking is reproducible."""
    from wardstat.functions.tiers import importance_band
    from pyspark.sql import Window

    top = imp.orderBy(F.col("importance").desc(), F.col("feature")).limit(n)
    w = Window.orderBy(F.col("importance").desc(), F.col("feature"))  # <= n rows
    return (top.withColumn("rank", F.row_number().over(w))
            .withColumn("metric_key", F.format_string("fi_%02d_%s", F.col("rank"), F.col("feature")))
            .withColumn("importance", F.round("importance", 6))
            .withColumn("band", importance_band("importance")))


def parse_importance_keys(metrics: DataFrame, key: str = "metric_key") -> DataFrame:
    """`fi_NN_name` keys back to names; other metrics have a NULL feature."""
    is_fi = F.col(key).startswith("fi_")
    return metrics.withColumn("feature", F.when(is_fi, F.regexp_extract(F.col(key), r"^fi_[^_]*_(.*)$", 1)))


TRIAL_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("trial", T.IntegerType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("cv_auc_mean", T.DoubleType()),
    T.StructField("cv_auc_std", T.DoubleType()),
])


def trial_frame(spark: SparkSession, run_id: str, trials: list[dict]) -> DataFrame:
    rows = [(run_id, t["trial"], t["params"], t["cv_auc_mean"], t["cv_auc_std"]) for t in trials]
    return spark.createDataFrame(rows, TRIAL_SCHEMA)


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest mean CV AUC (per run; the first of equals)."""
    return (trials.groupBy("run_id")
            .agg(F.max_by(F.struct("trial", "params", "cv_auc_mean", "cv_auc_std"),
                            F.struct("cv_auc_mean", -F.col("trial"))).alias("b"))
            .select("run_id", "b.*"))


def run_record(spark: SparkSession, run_id: str, res: TrainResult, n_trials: int) -> DataFrame:
    """One row for the runs table: sizes, rates, best params, metrics."""
    row = {
        "run_id": run_id, "model_name": MODEL_NAME,
        "n_train": res.n_train, "n_val": res.n_test, "n_features": len(res.features),
        "n_trials": n_trials, "n_cv_folds": N_FOLDS,
        "scale_pos_weight": res.scale_pos_weight,
        "params": {k: str(v) for k, v in res.best_params.items()},
        "metrics": {k: float(v) for k, v in res.metrics.items() if v is not None},
    }
    schema = ("run_id string, model_name string, n_train long, n_val long, n_features int, "
              "n_trials int, n_cv_folds int, scale_pos_weight double, "
              "params map<string,string>, metrics map<string,double>")
    return (spark.createDataFrame([row], schema)
            .withColumn("logged_at", F.current_timestamp()))


# ---------------------------------------------------------------------------
# Persistence
# ---------------------------------------------------------------------------

def save_model(spark: SparkSession, res: TrainResult, path: str,
               vocabulary: DataFrame | None = None, version: str = "local") -> str:
    """Booster + info (name, version, ordered features) + optional state
    vocabulary, all under `path`."""
    spark.createDataFrame([(res.model.booster.to_json(),)], "booster string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/booster")
    info = {"model_name": MODEL_NAME, "model_version": version, "feature_names": res.features,
            "metrics": res.metrics, "best_params": {k: str(v) for k, v in res.best_params.items()},
            "importances": dict(res.importances)}
    spark.createDataFrame([(json.dumps(info),)], "info string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/info")
    if vocabulary is not None:
        vocabulary.write.mode("overwrite").parquet(f"{path}/state_vocabulary")
    return path


@dataclass
class LoadedModel:
    model: BoostedModel
    features: list[str]
    version: str
    name: str
    vocabulary: DataFrame | None = None
    metrics: dict = field(default_factory=dict)
    best_params: dict = field(default_factory=dict)
    importances: list[tuple[str, float]] = field(default_factory=list)


def serving_model(spark: SparkSession, path: str = SERVING_MODEL) -> LoadedModel:
    """The model of a JSON file: booster, state vocabulary, metrics, parameters."""
    with open(path) as f:
        d = json.load(f)
    booster = B.Booster.from_json(json.dumps(d["booster"]))
    vocabulary = spark.createDataFrame([(k, int(v)) for k, v in d["vocabulary"].items()], "state_key string, state_encoded int")
    return LoadedModel(model=BoostedModel(booster), features=booster.features, version=d["version"], name=d["name"],
                       vocabulary=vocabulary, metrics=d["metrics"], best_params=d["best_params"], importances=booster.importances())


def load_model(spark: SparkSession, path: str) -> LoadedModel:
    if not table_exists(spark, f"{path}/booster"):
        raise FileNotFoundError(f"no model at {path}; train one first")
    model = BoostedModel(B.Booster.from_json(spark.read.text(f"{path}/booster").first()[0]))
    info = json.loads(spark.read.text(f"{path}/info").first()[0])
    vocab = None
    if table_exists(spark, f"{path}/state_vocabulary"):
        vocab = spark.read.parquet(f"{path}/state_vocabulary")
    return LoadedModel(model=model, features=info["feature_names"], version=info["model_version"],
                       name=info["model_name"], vocabulary=vocab, metrics=info.get("metrics", {}),
                       best_params=info.get("best_params", {}),
                       importances=list(info.get("importances", {}).items()))


def new_run_id() -> str:
    return uuid.uuid4().hex


def fit_vocabulary(features_df: DataFrame) -> DataFrame:
    return state_vocabulary(features_df)
