"""Rules observed by the job that writes the table; a failing table is never at its path."""
import os

import pytest
from pyspark.sql import functions as F

from tests.fixtures import raw_rows
from wardstat.operators.quality import ValidationError, completeness, feature_rules
from wardstat.plans.feature_build import build_features, features_from_raw
from wardstat.schemas import FEATURE_TABLE_COLUMNS, RAW_SCHEMA
from wardstat.session import delete_path
from wardstat.sources.checked import publish, write_observed

COLUMNS = FEATURE_TABLE_COLUMNS[3:]


@pytest.fixture()
def features(spark):
    return features_from_raw(spark.createDataFrame(raw_rows(), RAW_SCHEMA))


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_observed_figures_are_those_of_the_table(spark, tmp, features):
    parts = features.repartition(5)
    got = write_observed(parts, f"{tmp}/t", COLUMNS)
    table = spark.read.parquet(f"{tmp}/t")
    same(got.rules, feature_rules(table))
    same(got.completeness, completeness(table, COLUMNS))
    assert got.rows == table.count()


def test_one_scan_writes_and_checks(spark, tmp, features):
    features.write.parquet(f"{tmp}/in")
    source = spark.read.parquet(f"{tmp}/in")
    got = write_observed(source, f"{tmp}/t", COLUMNS)
    want = sorted(map(str, feature_rules(source).collect()))
    delete_path(spark, f"{tmp}/in")
    delete_path(spark, f"{tmp}/t")  # neither table is read for the figures
    assert sorted(map(str, got.rules.collect())) == want
    plan = got.rules._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("spoil", ["label", "key", "range"])
def test_a_table_that_breaks_a_rule_is_not_published(spark, tmp, features, spoil):
    publish(spark, write_observed(features, f"{tmp}/a", COLUMNS), f"{tmp}/out")
    before = sorted(os.listdir(f"{tmp}/out"))
    bad = {"label": features.withColumn("high_readmission_risk", F.lit(2)),
           "key": features.withColumn("facility_id", F.lit(None).cast("string")),
           "range": features.withColumn("mean_excess_ratio", F.lit(9.0))}[spoil]
    with pytest.raises(ValidationError):
        publish(spark, write_observed(bad, f"{tmp}/b", COLUMNS), f"{tmp}/out")
    assert sorted(os.listdir(f"{tmp}/out")) == before
    assert sorted(os.listdir(tmp)) == ["out"]  # nothing is left beside it
    publish(spark, write_observed(bad, f"{tmp}/c", COLUMNS), f"{tmp}/loose", strict=False)
    assert spark.read.parquet(f"{tmp}/loose").count() == bad.count()


def test_an_empty_table_fails_its_bounds(spark, tmp, features):
    got = write_observed(features.where("false"), f"{tmp}/e", COLUMNS)
    assert got.rows == 0
    same(got.rules, feature_rules(features.where("false")))
    with pytest.raises(ValidationError):
        publish(spark, got, f"{tmp}/out")


def test_a_build_replaces_the_table_and_leaves_nothing_beside(spark, tmp):
    spark.createDataFrame(raw_rows(), RAW_SCHEMA).write.parquet(f"{tmp}/raw")
    for _ in range(2):
        result = build_features(spark, f"{tmp}/raw", f"{tmp}/features")
        same(result.rules, feature_rules(result.features))
        assert sorted(os.listdir(tmp)) == ["features", "features-state-vocabulary", "raw"]
