"""Registered queries: one per operator of the data product.

Each entry takes (spark, sf_dir) and returns a DataFrame built from the
driver tables (see `wardstat.sources.derived`). Doubles are rounded to 6
decimals at the very end (presentation only) so that results compare
across engines; the library functions themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.operators import clean as C
from wardstat.operators import features as FE
from wardstat.operators import metrics as M
from wardstat.operators import monitoring as MO
from wardstat.operators import pivot as P
from wardstat.operators import quality as Q
from wardstat.operators import ranking as R
from wardstat.operators import scoring as S
from wardstat.operators import semistructured as SS
from wardstat.schemas import FEATURE_TABLE_COLUMNS, MODEL_FEATURES, TARGET
from wardstat.plans.feature_build import features_from_raw, vocabulary_path
from wardstat.session import apply_query_settings, scratch_dir
from wardstat.sources import derived as D
from wardstat.sources import files as FI
from wardstat.sources import pages as PG

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

DIGITS = 6
PAGE_FOLDER_ROWS = 20_000  # rows of a folder of pages
PAGE_CODEC = "gzip"        # of landed pages
CAPPED_ROWS = 1200
DRIFT_UNTIL = "2024-01-08 00:00:00"
SAMPLE_N = 100
HISTORY_N = 100


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column to `digits` decimals."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark, sf_dir):
            apply_query_settings(spark)
            return finish(fn(spark, sf_dir))
        QUERIES[name] = run
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


# ---------------------------------------------------------------------------
# Shared views
# ---------------------------------------------------------------------------

def raw(spark, sf):
    return D.hrrp_raw(spark, sf)


def cleaned(spark, sf):
    return C.clean_raw(raw(spark, sf))


def wide(spark, sf):
    return P.pivot_wide(cleaned(spark, sf))


def features(spark, sf):
    return FE.feature_table(wide(spark, sf))


def requests(spark, sf):
    return D.requests(wide(spark, sf))


def published(spark, sf):
    """Requests as a client sends them: values with six decimals."""
    return finish(requests(spark, sf))


def log(spark, sf):
    return D.prediction_log(spark, sf)


def scored(spark, sf):
    return D.scored_labels(features(spark, sf))


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------

@query("scan_raw")
def q_scan_raw(spark, sf):
    """Raw long table (all strings)."""
    return raw(spark, sf)


@query("ingest_pages")
def q_ingest_pages(spark, sf):
    """Land the raw rows as paged JSON, read them back through the page source."""
    out = scratch_dir(spark, "pages")
    PG.land_pages(D.hrrp_raw(spark, sf, with_order_keys=True), out, ["l_orderkey", "l_linenumber"], codec=PAGE_CODEC)
    return PG.read_pages(spark, out)


@query("ingest_capped")
def q_ingest_capped(spark, sf):
    """Page source with a row cap: whole pages below the cap."""
    out = scratch_dir(spark, "pages")
    PG.land_pages(D.hrrp_raw(spark, sf, with_order_keys=True), out, ["l_orderkey", "l_linenumber"], codec=PAGE_CODEC)
    return PG.read_pages(spark, out, max_rows=CAPPED_ROWS)


def _page_source(spark, sf):
    """Name of the page data source and a folder of landed pages."""
    from wardstat.sources.page_source import register_page_source
    out = scratch_dir(spark, "pages")
    PG.land_pages(D.hrrp_raw(spark, sf, with_order_keys=True), out, ["l_orderkey", "l_linenumber"], folder_rows=PAGE_FOLDER_ROWS, codec=PAGE_CODEC)
    return register_page_source(spark), out


@query("page_source")
def q_page_source(spark, sf):
    """All landed rows through the page data source."""
    name, out = _page_source(spark, sf)
    return spark.read.format(name).load(out).drop("offset")


@query("page_source_capped")
def q_page_source_capped(spark, sf):
    """The page data source under a cap: folders beyond it are not opened."""
    name, out = _page_source(spark, sf)
    return spark.read.format(name).option("max_rows", CAPPED_ROWS).load(out).drop("offset")


@query("page_source_stream")
def q_page_source_stream(spark, sf):
    """A capped stream of the page source, then the same one resumed without a cap."""
    name, pages = _page_source(spark, sf)
    out, ck = scratch_dir(spark, "page-stream"), scratch_dir(spark, "page-stream-ckpt")
    for cap in ({"max_rows": CAPPED_ROWS}, {}):
        (spark.readStream.format(name).options(**cap).load(pages).drop("offset").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out)


@query("score_csv")
def q_score_csv(spark, sf):
    """Request batch written as CSV and read back with the request schema."""
    out = scratch_dir(spark, "requests-csv")
    FI.write_request_csv(requests(spark, sf), out)
    return FI.read_request_csv(spark, out).drop("type_errors", "raw_record")


# ---------------------------------------------------------------------------
# Cleaning and pivot
# ---------------------------------------------------------------------------

@query("coerce_numeric")
def q_coerce_numeric(spark, sf):
    return C.coerce_numeric(raw(spark, sf))


@query("known_measures")
def q_known_measures(spark, sf):
    return C.keep_known_measures(raw(spark, sf))


@query("measure_short")
def q_measure_short(spark, sf):
    return cleaned(spark, sf)


@query("pivot_wide")
def q_pivot_wide(spark, sf):
    return wide(spark, sf)


@query("wide_with_meta")
def q_wide_with_meta(spark, sf):
    return P.wide_with_meta(cleaned(spark, sf))


@query("facility_meta")
def q_facility_meta(spark, sf):
    return P.facility_meta(cleaned(spark, sf))


@query("ingest_report")
def q_ingest_report(spark, sf):
    return Q.ingest_report(raw(spark, sf))


# ---------------------------------------------------------------------------
# Features, encoding, label
# ---------------------------------------------------------------------------

@query("aggregate_features")
def q_aggregate_features(spark, sf):
    return FE.add_aggregate_features(wide(spark, sf))


@query("encode_state")
def q_encode_state(spark, sf):
    w = FE.add_aggregate_features(wide(spark, sf))
    return FE.encode_state(w).select("facility_id", "state", "state_encoded")


@query("labelled")
def q_labelled(spark, sf):
    return FE.add_target(FE.add_aggregate_features(wide(spark, sf))).select(
        "facility_id", "mean_excess_ratio", TARGET)


@query("feature_table")
def q_feature_table(spark, sf):
    return features(spark, sf)


@query("feature_build")
def q_feature_build(spark, sf):
    """End-to-end build: raw rows landed as parquet, then the batch plan
    (checkpointed wide table, size-checked vocabulary, write, validate)."""
    from wardstat.plans.feature_build import build_features
    raw_path, out_path = scratch_dir(spark, "raw"), scratch_dir(spark, "features")
    FI.write_parquet(raw(spark, sf), raw_path)
    return build_features(spark, raw_path, out_path).features


def _written_features(spark, sf):
    from wardstat.sources.checked import write_observed
    cols = [c for c in FEATURE_TABLE_COLUMNS if c not in ("facility_id", "facility_name", "state", TARGET)]
    return write_observed(features(spark, sf), scratch_dir(spark, "features"), cols)


@query("observed_rules")
def q_observed_rules(spark, sf):
    """The rule table as measured by the job that writes the features."""
    return _written_features(spark, sf).rules


@query("observed_completeness")
def q_observed_completeness(spark, sf):
    """Non-null counts as measured by the job that writes the features."""
    return _written_features(spark, sf).completeness


@query("model_input")
def q_model_input(spark, sf):
    return FE.model_input(features(spark, sf))


@query("state_codes")
def q_state_codes(spark, sf):
    return requests(spark, sf).select("facility_id", "state",
                                      FE.serving_state_code("state").alias("state_code"))


@query("assemble_features")
def q_assemble_features(spark, sf):
    return FE.assemble_features(requests(spark, sf), keep=["facility_id"])


@query("align_features")
def q_align_features(spark, sf):
    assembled = FE.assemble_features(requests(spark, sf), keep=["facility_id"])
    return FE.align_features(assembled, ["facility_id"] + MODEL_FEATURES)


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------

@query("class_balance")
def q_class_balance(spark, sf):
    return Q.class_balance(features(spark, sf))


@query("class_weight")
def q_class_weight(spark, sf):
    split = R.stratified_split(features(spark, sf))
    return Q.class_weight(split.filter(F.col("split") == "train"))


@query("completeness")
def q_completeness(spark, sf):
    cols = [c for c in FEATURE_TABLE_COLUMNS if c not in ("facility_id", "facility_name", "state", TARGET)]
    return Q.completeness(features(spark, sf), cols)


@query("feature_dictionary")
def q_feature_dictionary(spark, sf):
    cols = [c for c in FEATURE_TABLE_COLUMNS if c not in ("facility_id", "facility_name", "state", TARGET)]
    return FE.feature_dictionary(Q.completeness(features(spark, sf), cols))


@query("validate_features")
def q_validate_features(spark, sf):
    return Q.feature_rules(features(spark, sf))


@query("scorable_rows")
def q_scorable_rows(spark, sf):
    return Q.scorable_rows(requests(spark, sf))


@query("validate_requests")
def q_validate_requests(spark, sf):
    valid, _ = Q.split_requests(requests(spark, sf))
    return valid


@query("rejected_requests")
def q_rejected_requests(spark, sf):
    _, rejected = Q.split_requests(requests(spark, sf))
    return rejected.select("facility_id", F.concat_ws(";", "errors").alias("errors"))


@query("clip_to_bounds")
def q_clip_to_bounds(spark, sf):
    return Q.clip_to_bounds(requests(spark, sf))


# ---------------------------------------------------------------------------
# Ranking and sampling
# ---------------------------------------------------------------------------

@query("stratified_split")
def q_stratified_split(spark, sf):
    return R.stratified_split(features(spark, sf)).select("facility_id", TARGET, "split")


@query("stratified_folds")
def q_stratified_folds(spark, sf):
    return (R.stratified_split(features(spark, sf)).filter(F.col("split") == "train")
            .select("facility_id", TARGET, "fold"))


@query("sample_rows")
def q_sample_rows(spark, sf):
    return R.sample_rows(Q.scorable_rows(requests(spark, sf)), SAMPLE_N)


# ---------------------------------------------------------------------------
# Metrics
# ---------------------------------------------------------------------------

@query("binary_metrics")
def q_binary_metrics(spark, sf):
    return M.binary_metrics(scored(spark, sf))


@query("roc_auc")
def q_roc_auc(spark, sf):
    return M.roc_auc(scored(spark, sf))


@query("classification_report")
def q_classification_report(spark, sf):
    return M.classification_report(scored(spark, sf))


@query("metric_bands")
def q_metric_bands(spark, sf):
    return M.metric_table(scored(spark, sf))


def _fold_scores(spark, sf):
    """Scores of the training split with their fold (one feature table)."""
    train = R.stratified_split(features(spark, sf)).filter(F.col("split") == "train")
    return D.scored_labels(train, keep=["fold"])


@query("fold_auc")
def q_fold_auc(spark, sf):
    return M.roc_auc(_fold_scores(spark, sf), by=["fold"])


@query("cv_summary")
def q_cv_summary(spark, sf):
    return M.cv_summary(M.roc_auc(_fold_scores(spark, sf), by=["fold"]))


# ---------------------------------------------------------------------------
# Prediction log and scoring outputs
# ---------------------------------------------------------------------------

@query("risk_level")
def q_risk_level(spark, sf):
    from wardstat.functions.tiers import risk_tier
    return log(spark, sf).select("id", "risk_score", risk_tier("risk_score").alias("tier"))


@query("recent_predictions")
def q_recent_predictions(spark, sf):
    return MO.recent_predictions(log(spark, sf), HISTORY_N)


@query("parse_features")
def q_parse_features(spark, sf):
    p = MO.parse_features(log(spark, sf))
    return p.select("id", F.col("features").isNotNull().alias("parsed_ok"),
                    F.col("features")["k"].alias("k_value"), "raw_features")


def _nested_log(spark, sf):
    """The log with nested, text, numeric and boolean features; some texts are cut short."""
    whole = F.to_json(F.struct(
        F.struct("state", "facility_name").alias("site"),
        F.array("risk_score", F.round(F.lit(1.0) - F.col("risk_score"), 4)).alias("scores"),
        F.col("facility_id").alias("code"),
        F.when(F.col("id") % 2 == 0, F.col("risk_score")).alias("score"),
        (F.col("id") % 3 == 0).alias("flag")))
    cut = F.concat(F.lit('{"code": "'), F.col("facility_id"))
    return log(spark, sf).withColumn("input_features", F.when(F.col("id") % 97 == 0, cut).otherwise(whole))


def _decoded_log(spark, sf):
    out = scratch_dir(spark, "decoded-log")
    FI.write_parquet(SS.decode_features(_nested_log(spark, sf)).drop("input_features"), out)
    return spark.read.parquet(out)


@query("decoded_features")
def q_decoded_features(spark, sf):
    """Values of every shape, read back from the stored VARIANT."""
    value = SS.feature_value
    return _decoded_log(spark, sf).select(
        "id", F.col("features_ok").alias("ok"), value("$.site.state", "string").alias("site_state"),
        value("$.scores[1]").alias("second_score"), value("$.score").alias("score"),
        value("$.code", "string").alias("code"), value("$.flag", "boolean").alias("flag"),
        F.when(~F.col("features_ok"), value("$", "string")).alias("text"))


@query("feature_profile")
def q_feature_profile(spark, sf):
    """Kinds and ranges of the logged features by key."""
    return SS.feature_profile(SS.feature_rows(_decoded_log(spark, sf), ["id"]))


@query("score_series")
def q_score_series(spark, sf):
    return MO.score_series(log(spark, sf))


@query("prediction_stats")
def q_prediction_stats(spark, sf):
    return MO.prediction_stats(log(spark, sf))


@query("risk_distribution")
def q_risk_distribution(spark, sf):
    return MO.risk_distribution(log(spark, sf))


@query("state_risk")
def q_state_risk(spark, sf):
    return MO.state_risk(log(spark, sf))


@query("daily_risk")
def q_daily_risk(spark, sf):
    return MO.risk_windows(log(spark, sf), "1 day")


@query("batch_summary")
def q_batch_summary(spark, sf):
    lg = log(spark, sf).withColumn("log_date", F.to_date("timestamp"))
    return MO.batch_summary(lg, by=["log_date"])


@query("results_export")
def q_results_export(spark, sf):
    return MO.results_export(log(spark, sf))


@query("normalise_scores")
def q_normalise_scores(spark, sf):
    lg = log(spark, sf).select("id", "facility_id",
                               (F.col("risk_score") * F.lit(1.25) - F.lit(0.05)).alias("raw_score"))
    return S.normalise_scores(lg, "raw_score", by=["facility_id"]).select("id", "facility_id", "score")


@query("features_json")
def q_features_json(spark, sf):
    return S.features_json(published(spark, sf)).select("facility_id", "input_features")


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


__all__ = ["queries", "QUERIES", "finish", "raw", "wide", "features", "requests", "log", "scored"]


# ---------------------------------------------------------------------------
# Model-backed queries (a fit is not SQL; scores of the serving model are)
# ---------------------------------------------------------------------------

#: a point of the declared search space
FIXED_PARAMS = {"maxIter": 100, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.9, "featureSubsetFraction": 0.9,
                "minInstancesPerNode": 2, "gamma": 0.1, "regAlpha": 0.01, "regLambda": 1.0}
SEARCH_TRIALS = 12        # of 50, and of fewer trees: README gives the time of the whole search
SEARCH_TREES = (5, 10, "int")
_MODELS: dict = {}


def trained_model(spark, sf):
    """Fit (once per process and input folder) and save a model trained on
    the training split of the feature table; returns the loaded model."""
    from wardstat.plans import model as MD
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        path = scratch_dir(spark, "model")
        feats = features_from_raw(raw(spark, sf), vocabulary_path(path)).checkpoint(eager=True)
        res = MD.train(spark, feats, fixed_params=FIXED_PARAMS)
        MD.save_model(spark, res, path, spark.read.parquet(vocabulary_path(path)), version="1")
        _MODELS[key] = (res, MD.load_model(spark, path), path)
    return _MODELS[key]


def _score(spark, sf, log_path=None):
    from wardstat.plans import model as MD
    from wardstat.plans import score as SC
    return SC.score_batch(spark, MD.serving_model(spark), published(spark, sf), log_path=log_path, batch_id=1)


@query("top_importances")
def q_top_importances(spark, sf):
    from wardstat.plans import model as MD
    res, _, _ = trained_model(spark, sf)
    return MD.top_importances(MD.importance_frame(spark, res.importances), 20)


@query("score_batch")
def q_score_batch(spark, sf):
    """The request batch scored by the serving model (its ordinals follow the scan order)."""
    return _score(spark, sf).responses.drop("ordinal")


@query("batch_guard_summary")
def q_batch_guard_summary(spark, sf):
    return _score(spark, sf).summary


@query("prediction_log_rows")
def q_prediction_log_rows(spark, sf):
    out = scratch_dir(spark, "log")
    _score(spark, sf, log_path=out).release()  # the result is read back from the log
    return spark.read.parquet(out).drop("timestamp", "log_date", "id", "ordinal")


ROOT_CUTS = [0.7 + 0.02 * i for i in range(31)]
ROOT_PARAMS = {"reg_alpha": 0.5, "reg_lambda": 1.0, "min_child_weight": 1.0}


@query("root_splits")
def q_root_splits(spark, sf):
    """First split of every ratio from second-order gain, missing values on their better side."""
    from wardstat.operators import boosting as B
    from wardstat.schemas import EXCESS_COLUMNS
    cuts = [ROOT_CUTS] * len(EXCESS_COLUMNS)
    rows = features(spark, sf).select(F.xxhash64("facility_id").alias("key"), F.col(TARGET).alias("label"),
                                      F.lit(1.0).alias("weight"), F.lit(0).alias("fold"), *EXCESS_COLUMNS)
    return B.root_splits(B.pack(rows, EXCESS_COLUMNS, cuts), EXCESS_COLUMNS, cuts, B.BoostParams(**ROOT_PARAMS))


@query("drift")
def q_drift(spark, sf):
    """PSI and KS of every day's scores against the first week of the log."""
    from wardstat.operators.drift import drift
    return drift(log(spark, sf), F.col("window_end") <= F.lit(DRIFT_UNTIL).cast("timestamp"))


@query("best_trial")
def q_best_trial(spark, sf):
    from wardstat.plans import model as MD
    res = MD.train(spark, features(spark, sf), n_trials=SEARCH_TRIALS, space={**MD.SEARCH_SPACE, "maxIter": SEARCH_TREES})
    return MD.best_trial(MD.trial_frame(spark, "run", res.trials))


@query("run_log")
def q_run_log(spark, sf):
    from wardstat.plans import model as MD
    res, _, _ = trained_model(spark, sf)
    out = scratch_dir(spark, "runs")
    MD.run_record(spark, MD.new_run_id(), res, 0).write.mode("append").parquet(out)
    return spark.read.parquet(out).drop("logged_at", "run_id")


@query("artifact_freshness")
def q_artifact_freshness(spark, sf):
    _, _, path = trained_model(spark, sf)
    return FI.artifact_freshness(spark, {"model": path}).select(
        "artifact", (F.col("last_modified") != "missing").alias("present"))


@query("ingest_stream")
def q_ingest_stream(spark, sf):
    """Pages landed from the raw rows, ingested by the incremental stream."""
    from wardstat.streaming.ingest import ingest_pages
    land = scratch_dir(spark, "landing")
    PG.land_pages(D.hrrp_raw(spark, sf, with_order_keys=True), land, ["l_orderkey", "l_linenumber"], codec=PAGE_CODEC)
    out, ck = scratch_dir(spark, "ingested"), scratch_dir(spark, "ingest-ckpt")
    ingest_pages(spark, land, out, ck)
    return spark.read.parquet(out)


@query("ingest_capped_then_full")
def q_ingest_capped_then_full(spark, sf):
    """A capped trial run, then the full ingest of the same pages: nothing is lost."""
    from wardstat.streaming.ingest import ingest_pages
    land = scratch_dir(spark, "landing")
    PG.land_pages(D.hrrp_raw(spark, sf, with_order_keys=True), land, ["l_orderkey", "l_linenumber"], codec=PAGE_CODEC)
    out, ck = scratch_dir(spark, "ingested"), scratch_dir(spark, "ingest-ckpt")
    ingest_pages(spark, land, out, ck, max_rows=CAPPED_ROWS)
    ingest_pages(spark, land, out, ck)
    return spark.read.parquet(out)


@query("log_round_trip")
def q_log_round_trip(spark, sf):
    """Two sources log the same scored batch, one of them twice (a replay on
    a later day); totals of the log as read back."""
    from wardstat.plans import score as SC
    out = scratch_dir(spark, "log")
    batch = log(spark, sf).select("facility_id", "facility_name", "state", "input_features",
                                  F.col("risk_score").alias("probability_1"), "risk_level",
                                  F.col("id").alias("ordinal"))
    for source, days in (("a", 0), ("b", 0), ("a", 1)):
        rows = SC.log_rows(batch, 1, "1", source).withColumn("log_date", F.date_add("log_date", days))
        SC.append_log(rows, out)
    return MO.prediction_stats(MO.read_log(spark, out))


@query("serving_vocabulary")
def q_serving_vocabulary(spark, sf):
    """State codes that scoring loads, beside the codes of the training table."""
    path = scratch_dir(spark, "features")
    feats = features_from_raw(raw(spark, sf), vocabulary_path(path))
    vocab = spark.read.parquet(vocabulary_path(path))
    used = feats.select(FE.state_key().alias("state_key"), F.col("state_encoded").alias("trained")).distinct()
    return vocab.join(used, "state_key", "left").select("state_key", "state_encoded", "trained")


def _committed_log(spark, sf):
    """The log in three batches of two sources by commits; one batch was
    logged with other scores first and is replaced by its replay."""
    from wardstat.sources.log_table import LogTable
    rows, table = log(spark, sf), LogTable(spark, scratch_dir(spark, "log-table"))
    wrong = rows.withColumn("risk_score", F.lit(1.0)).withColumn("risk_level", F.lit("high"))
    for source, batch, part, what in (("a", 1, 1, wrong), ("a", 0, 0, rows), ("a", 1, 1, rows), ("b", 1, 2, rows)):
        table.append(what.where(F.col("id") % 3 == part), source, batch, by_time=True)
    return table


@query("committed_log_stats")
def q_committed_log_stats(spark, sf):
    """All-time totals from the partials of the live commits."""
    from wardstat.sources.log_table import log_stats
    return log_stats(_committed_log(spark, sf).partials())


@query("committed_log_states")
def q_committed_log_states(spark, sf):
    """Rows and total score by state: the totals have four decimals, the means
    lie on ties of the comparison's sixth."""
    from wardstat.sources.log_table import state_stats
    return state_stats(_committed_log(spark, sf).partials()).select(
        "state", "n", F.round(F.col("mean_risk") * F.col("n"), 4).alias("score_total"))


@query("committed_log_history")
def q_committed_log_history(spark, sf):
    """The newest rows, from the files whose bounds say that they can hold them."""
    return MO.parse_features(_committed_log(spark, sf).newest(HISTORY_N)).drop(
        "input_features", "features", "raw_features", "source_id", "batch_id")


@query("committed_log_windows")
def q_committed_log_windows(spark, sf):
    """Daily totals kept by the stream of commits, before and after a replay."""
    from wardstat.streaming.log_commits import current_windows, start_commit_stream
    table, out, ck = _committed_log(spark, sf), scratch_dir(spark, "log-windows"), scratch_dir(spark, "log-windows-ckpt")
    start_commit_stream(spark, table, out, ck).awaitTermination()
    table.append(log(spark, sf).where("id % 3 = 2"), "b", 1, by_time=True)
    start_commit_stream(spark, table, out, ck).awaitTermination()
    return current_windows(spark, out)
