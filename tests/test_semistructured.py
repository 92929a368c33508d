"""Logged features of any shape as VARIANT: decode, store, read paths, profile."""
from pyspark.sql import functions as F

from wardstat.operators.scoring import features_json
from wardstat.operators.semistructured import decode_features, feature_profile, feature_rows, feature_value
from wardstat.schemas import MEASURE_FEATURES, REQUEST_SCHEMA

TEXTS = [
    (1, '{"k": 1.5, "site": {"state": "TX", "beds": [10, 20]}, "note": "a b", "on": true, "none": null}'),
    (2, "oops{"), (3, None), (4, '"only text"'), (5, '{"k": "7"}'), (6, "[1, 2]"), (7, "{}"), (8, ""),
    (9, '{"k": 1, "k": 2}'),
]


def decoded(spark, tmp):
    decode_features(spark.createDataFrame(TEXTS, "id long, input_features string")).write.parquet(f"{tmp}/log")
    return spark.read.parquet(f"{tmp}/log")


def test_values_of_every_shape_come_back(spark, tmp):
    log = decoded(spark, tmp)
    assert dict(log.dtypes)["features"] == "variant"
    rows = {r.id: r for r in log.select(
        "id", "features_ok", feature_value("$.k").alias("k"), feature_value("$.site.state", "string").alias("state"),
        feature_value("$.site.beds[1]", "int").alias("beds"), feature_value("$.note", "string").alias("note"),
        feature_value("$", "string").alias("whole")).collect()}
    assert (rows[1].k, rows[1].state, rows[1].beds, rows[1].note) == (1.5, "TX", 20, "a b")
    assert {i: rows[i].features_ok for i in rows} == {
        1: True, 2: False, 3: None, 4: True, 5: True, 6: True, 7: True, 8: False, 9: False}
    assert {i: rows[i].whole for i in (2, 3, 4, 8, 9)} == {
        2: "oops{", 3: None, 4: "only text", 8: "", 9: '{"k": 1, "k": 2}'}
    assert rows[5].k == 7.0 and rows[6].k is None


def test_profile_by_key_and_kind(spark, tmp):
    rows = feature_rows(decoded(spark, tmp), ["id"])
    got = {(r.key, r.kind): (r.n, r.mean_value) for r in feature_profile(rows).collect()}
    assert got == {("k", "number"): (1, 1.5), ("k", "text"): (1, None), ("site", "object"): (1, None),
                   ("note", "text"): (1, None), ("on", "boolean"): (1, None), ("none", "null"): (1, None)}


def test_empty_log(spark):
    empty = decode_features(spark.createDataFrame([], "id long, input_features string"))
    assert feature_profile(feature_rows(empty, ["id"])).collect() == []


def test_logged_measures_are_decoded(spark):
    first, second = MEASURE_FEATURES[:2]
    row = {f.name: None for f in REQUEST_SCHEMA.fields} | {first: 1.25}
    request = spark.createDataFrame([tuple(row.values())], REQUEST_SCHEMA)
    out = decode_features(features_json(request)).select(
        feature_value(f"$.{first}").alias("a"), feature_value(f"$.{second}").alias("b"),
        F.col("features_ok").alias("ok")).first()
    assert (out.a, out.b, out.ok) == (1.25, None, True)
