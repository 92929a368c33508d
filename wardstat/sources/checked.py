"""Checked writes: what a table must satisfy is measured by the job that
writes it, and the table appears at its path only if the checks hold.

The rules and the completeness counts are observed metrics of the last
operator before the sink. That operator runs in the result stage, whose
tasks count once each however often they are retried, so the figures are
those of the rows that were written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardstat.operators.quality import (
    ValidationError, completeness_metrics, completeness_table, raise_failed, rule_metrics, rule_table,
)
from wardstat.session import delete_path, replace_path


@dataclass
class CheckedWrite:
    """A table written apart, with what the writing job has measured."""
    path: str
    rules: DataFrame
    completeness: DataFrame
    rows: int


def _row(spark: SparkSession, values: dict) -> DataFrame:
    """One row of observed figures (a few dozen numbers)."""
    cols = [F.lit(v).cast("double" if isinstance(v, float) or v is None else "long").alias(k) for k, v in values.items()]
    return spark.range(1).select(*cols)


def write_observed(df: DataFrame, path: str, columns: list[str]) -> CheckedWrite:
    """Write `df` to `path` in one job that also measures the feature rules and
    the non-null counts of `columns`. An empty frame has zero counts and null
    bounds, which fail as they do in `feature_rules`."""
    spark = df.sparkSession
    rules, full = rule_metrics(df), completeness_metrics(columns)
    seen = Observation()
    watched: list[Column] = [*rules.values(), *full.values()]
    names = [*rules, *full]
    df.observe(seen, *[c.alias(n) for c, n in zip(watched, names)]).write.mode("overwrite").parquet(path)
    got = seen.get
    counts = _row(spark, {n: int(got[n]) for n in full})
    bounds = _row(spark, {n: None if got[n] is None else float(got[n]) for n in rules})
    return CheckedWrite(path, rule_table(bounds, df.columns), completeness_table(counts, columns), int(got["_total"]))


def publish(spark: SparkSession, written: CheckedWrite, path: str, strict: bool = True) -> CheckedWrite:
    """Move a written table to `path` if its rules hold.

    In strict mode a table that breaks a rule is deleted and the rule named;
    what was at `path` before stays as it was. The move is a rename of the
    folder, so the rows are written once; a reader sees the old table or the
    new one, never a part of one.
    """
    if strict:
        try:
            raise_failed(written.rules)
        except ValidationError:
            delete_path(spark, written.path)
            raise
    replace_path(spark, written.path, path)
    return CheckedWrite(path, written.rules, written.completeness, written.rows)
