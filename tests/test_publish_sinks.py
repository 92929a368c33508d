"""A failing build publishes nothing; two scoring streams share one output folder."""
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.fixtures import raw_rows
from wardstat.operators.quality import ValidationError
from wardstat.plans import catalog
from wardstat.plans import model as MD
from wardstat.plans.feature_build import build_features, vocabulary_path
from wardstat.schemas import RAW_SCHEMA
from wardstat.streaming.scoring import start_scoring_stream


def test_a_failing_build_leaves_the_published_table(spark, tmp):
    raw = spark.createDataFrame(raw_rows(), RAW_SCHEMA)
    raw.write.parquet(f"{tmp}/raw")
    good = build_features(spark, f"{tmp}/raw", f"{tmp}/features").features
    want = sorted(map(str, good.collect()))
    codes = sorted(spark.read.parquet(vocabulary_path(f"{tmp}/features")).collect())
    raw.withColumn("excess_readmission_ratio", F.lit("9.9")).withColumn("state", F.lit("ZZ")).write.parquet(f"{tmp}/bad")
    with pytest.raises(ValidationError):
        build_features(spark, f"{tmp}/bad", f"{tmp}/features")
    assert sorted(map(str, spark.read.parquet(f"{tmp}/features").collect())) == want
    assert sorted(spark.read.parquet(vocabulary_path(f"{tmp}/features")).collect()) == codes
    with pytest.raises(ValidationError):
        build_features(spark, f"{tmp}/bad", f"{tmp}/new")
    assert not os.path.exists(f"{tmp}/new")


def test_two_streams_write_to_one_folder(spark, tmp):
    model = MD.serving_model(spark)
    requests = catalog.requests(spark, SF001).cache()
    requests.write.json(f"{tmp}/a")
    requests.limit(40).write.json(f"{tmp}/b")
    for source in ("a", "b", "a"):  # the last one finds nothing new
        start_scoring_stream(spark, model, f"{tmp}/{source}", f"{tmp}/out", f"{tmp}/ck-{source}", source_id=source).awaitTermination()
    scored, rejected = (spark.read.parquet(f"{tmp}/out/{n}") for n in ("scored", "rejected"))
    by_source = {s: scored.where(F.col("source_id") == s).count() + rejected.where(F.col("source_id") == s).count() for s in "ab"}
    assert by_source == {"a": requests.count(), "b": 40}
    assert spark.read.parquet(f"{tmp}/out/log").count() == scored.count()
    assert spark.read.parquet(f"{tmp}/out/summary").agg(F.sum("total")).first()[0] == scored.count()
