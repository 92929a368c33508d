"""Batch feature build: raw parquet -> validated feature table.

read -> clean -> pivot -> row aggregates -> [checkpoint] -> state code ->
label -> write, validated by the same job -> publish.

The wide table is checkpointed to the shared checkpoint folder: it is read
by the vocabulary, the join and the write, and the checkpoint both cuts the
lineage back to the raw scan and survives the loss of executors. The
vocabulary is then counted cheaply and broadcast within its bound.
The rules and the completeness counts are observed metrics of the writing
job, so the table is scanned by nothing but its readers; it is written
beside its path and moved there only if the rules hold.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wardstat.operators.clean import clean_raw
from wardstat.operators.features import add_aggregate_features, add_target, encode_state, state_vocabulary
from wardstat.operators.pivot import pivot_wide
from wardstat.operators.quality import ingest_report
from wardstat.schemas import FEATURE_TABLE_COLUMNS, ID_COLUMNS, TARGET
from wardstat.session import apply_query_settings, delete_path, ensure_checkpoint_dir, replace_path
from wardstat.sources.checked import publish, write_observed
from wardstat.sources.files import read_features, read_raw, write_parquet


@dataclass
class BuildResult:
    features: DataFrame
    rules: DataFrame
    report: DataFrame
    completeness: DataFrame
    vocabulary: DataFrame


def features_from_raw(raw: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """Labelled feature table. The state vocabulary covers all hospitals, those
    without a target too; with `vocabulary_path` it is written there, and the
    codes of the table come from the written copy -- scoring loads the same."""
    wide = add_aggregate_features(pivot_wide(clean_raw(raw))).checkpoint(eager=True)
    vocabulary = None
    if vocabulary_path:
        write_parquet(state_vocabulary(wide), vocabulary_path)
        vocabulary = raw.sparkSession.read.parquet(vocabulary_path)
    return add_target(encode_state(wide, vocabulary, check_size=True)).select(*FEATURE_TABLE_COLUMNS)


def vocabulary_path(features_path: str) -> str:
    """Where the state vocabulary of a feature table lies: beside it."""
    return f"{features_path.rstrip('/')}-state-vocabulary"


def build_features(spark: SparkSession, raw_path: str, out_path: str,
                   strict: bool = True) -> BuildResult:
    """Build, validate, publish: the table is written and checked beside its
    path in one job, so a build that fails leaves the published table as it was."""
    apply_query_settings(spark)
    ensure_checkpoint_dir(spark)
    raw = read_raw(spark, raw_path)
    apart = f"{out_path.rstrip('/')}-build-{uuid.uuid4().hex[:12]}"
    cols = [c for c in FEATURE_TABLE_COLUMNS if c not in ID_COLUMNS + [TARGET]]
    try:
        written = write_observed(features_from_raw(raw, vocabulary_path(apart)), apart, cols)
        built = publish(spark, written, out_path, strict=strict)
    except Exception:
        for path in (apart, vocabulary_path(apart)):
            delete_path(spark, path)
        raise
    replace_path(spark, vocabulary_path(apart), vocabulary_path(out_path))
    return BuildResult(features=read_features(spark, out_path), rules=built.rules, report=ingest_report(raw),
                       completeness=built.completeness,
                       vocabulary=spark.read.parquet(vocabulary_path(out_path)))
