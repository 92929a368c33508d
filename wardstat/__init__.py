"""wardstat: hospital readmission-risk analytics on Spark.

Main entry points (all take and return Spark DataFrames):

    from wardstat import build_session, build_features, train, save_model, load_model, score_batch
    spark = build_session()
    built = build_features(spark, "s3://.../raw", "s3://.../features")
    res = train(spark, built.features, n_trials=50)
    save_model(spark, res, "s3://.../model")
    out = score_batch(spark, load_model(spark, "s3://.../model"), requests_df, log_path="s3://.../log")

Operators live in `wardstat.operators`, column functions in
`wardstat.functions`, sources and sinks in `wardstat.sources`, streaming
jobs in `wardstat.streaming`.
"""

from wardstat.session import build_session  # noqa: F401


def __getattr__(name):
    # Lazy imports keep `import wardstat` light (no ML imports until used).
    if name == "build_features":
        from wardstat.plans.feature_build import build_features
        return build_features
    if name in ("train", "save_model", "load_model"):
        from wardstat.plans import model
        return getattr(model, name)
    if name == "score_batch":
        from wardstat.plans.score import score_batch
        return score_batch
    if name == "run":
        from wardstat.plans.end_to_end import run
        return run
    raise AttributeError(name)
