"""End-to-end run as plain function calls (no scheduler):

incremental page ingest -> raw parquet -> feature build (validated) ->
training with CV -> model, trial table and run table under `work_dir`.

Steps hand over paths, not data, so any step can be re-run on its own, and
each one is idempotent: the ingest stream only picks up new pages, the
feature build and model overwrite their folders, and trials and runs are
appended with their run id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from wardstat.plans import model as MD
from wardstat.plans.feature_build import build_features
from wardstat.session import apply_query_settings
from wardstat.streaming.ingest import capped, ingest_pages


@dataclass
class RunPaths:
    raw: str
    ingest_checkpoint: str
    features: str
    model: str
    trials: str
    runs: str

    @classmethod
    def under(cls, work_dir: str) -> "RunPaths":
        w = work_dir.rstrip("/")
        return cls(raw=f"{w}/raw", ingest_checkpoint=f"{w}/_ingest_checkpoint",
                   features=f"{w}/features", model=f"{w}/model",
                   trials=f"{w}/trials", runs=f"{w}/runs")


def run(spark: SparkSession, landing_dir: str, work_dir: str, n_trials: int = 50,
        parallelism: int = 2, search_space: dict | None = None,
        max_rows: int | None = None, version: str | None = None) -> dict:
    """Run every step; returns the run id, held-out metrics and paths."""
    apply_query_settings(spark)
    paths = RunPaths.under(work_dir)
    pages = ingest_pages(spark, landing_dir, paths.raw, paths.ingest_checkpoint, max_rows=max_rows)
    built = build_features(spark, capped(paths.raw, max_rows), paths.features, strict=True)
    res = MD.train(spark, built.features, n_trials=n_trials, parallelism=parallelism,
                   space=search_space)
    run_id = MD.new_run_id()
    MD.save_model(spark, res, paths.model, built.vocabulary,
                  version=version or run_id[:8])
    if res.trials:
        MD.trial_frame(spark, run_id, res.trials).write.mode("append").parquet(paths.trials)
    MD.run_record(spark, run_id, res, n_trials).write.mode("append").parquet(paths.runs)
    return {"run_id": run_id, "pages_read": pages, "metrics": res.metrics,
            "best_params": res.best_params, "paths": paths}
