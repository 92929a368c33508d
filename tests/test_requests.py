import pytest
from pyspark.sql import functions as F

from wardstat.operators import quality as Q
from wardstat.schemas import REQUEST_SCHEMA


def req(spark, rows):
    names = REQUEST_SCHEMA.fieldNames()
    data = [tuple(r.get(c) for c in names) for r in rows]
    return spark.createDataFrame(data, REQUEST_SCHEMA)


def test_request_validation_cases(spark):
    df = req(spark, [
        {"facility_id": "min", "ami_excess_ratio": 1.1},
        {"facility_id": "noratio", "ami_predicted_rate": 13.0},
        {"facility_id": "range", "ami_excess_ratio": 99.9},
        {"facility_id": "empty"},
        {"facility_id": "state", "state": "XYZ", "hf_excess_ratio": 1.0},
        {"facility_id": "neg", "hf_excess_ratio": 1.0, "hf_discharges": -1.0},
        {"facility_id": "edge", "pn_excess_ratio": 5.0, "pn_predicted_rate": 100.0, "pn_discharges": 0.0},
    ])
    valid, rejected = Q.split_requests(df)
    assert sorted(r[0] for r in valid.select("facility_id").collect()) == ["edge", "min"]
    errs = {r["facility_id"]: r["errors"] for r in rejected.collect()}
    assert errs["noratio"] == ["no_excess_ratio"]
    assert errs["range"] == ["ami_excess_ratio_out_of_range"]
    assert errs["empty"] == ["no_excess_ratio"]
    assert errs["state"] == ["state_too_long"]
    assert errs["neg"] == ["hf_discharges_out_of_range"]


def test_clip_to_bounds(spark):
    df = req(spark, [{"facility_id": "a", "ami_excess_ratio": 9.0, "ami_predicted_rate": -3.0,
                      "ami_discharges": -1.0, "hf_discharges": 1e6}])
    r = Q.clip_to_bounds(df).first()
    assert r["ami_excess_ratio"] == 5.0 and r["ami_predicted_rate"] == 0.0
    assert r["ami_discharges"] == 0.0 and r["hf_discharges"] == 1e6
    assert r["cabg_excess_ratio"] is None


def test_batch_guard(spark):
    df = spark.range(501)
    with pytest.raises(Q.ValidationError):
        Q.guard_batch(df, 500)
    with pytest.raises(Q.ValidationError):
        Q.guard_batch(df.limit(0), 500)
    assert Q.guard_batch(df.limit(4), 500) == 4
    assert Q.guard_batch(df, None) == 501


def test_scorable_rows(spark):
    df = req(spark, [{"facility_id": "a", "ami_excess_ratio": 1.0}, {"facility_id": "b"}])
    assert [r[0] for r in Q.scorable_rows(df).select("facility_id").collect()] == ["a"]


def test_request_csv_roundtrip_and_type_errors(spark, tmp):
    from wardstat.sources import files as FI
    path = f"{tmp}/in.csv"
    with open(path, "w") as f:
        f.write(",".join(REQUEST_SCHEMA.fieldNames()) + "\n")
        vals = ["010001", "X", "AL", "not-a-number"] + [""] * 23
        f.write(",".join(vals) + "\n")
        vals = ["010002", "Y", "AL", "1.1"] + [""] * 23
        f.write(",".join(vals) + "\n")
    df = FI.read_request_csv(spark, path)
    rows = {r["facility_id"]: r for r in df.collect()}
    assert rows["010001"]["type_errors"] == ["ami_excess_ratio_not_numeric"]
    assert rows["010002"]["ami_excess_ratio"] == 1.1 and rows["010002"]["type_errors"] == []
    # bad text rejects the row, whatever else it holds; the record comes along
    valid, rejected = Q.split_requests(df)
    bad = rejected.first()
    assert [r["facility_id"] for r in valid.collect()] == ["010002"] and "type_errors" not in valid.columns
    assert bad["errors"][0] == "ami_excess_ratio_not_numeric" and "not-a-number" in bad["raw_record"]
    # JSON requests are typed the same way: numeric text is a number
    with open(f"{tmp}/r.json", "w") as f:
        f.write('{"facility_id": "a", "ami_excess_ratio": "1.1"}\n{"facility_id": "b", "ami_excess_ratio": 1.2}\n'
                '{"facility_id": "c", "ami_excess_ratio": 1.0, "hf_discharges": "many"}\n')
    typed = FI.type_requests(spark.read.schema(FI.request_text_schema()).json(f"{tmp}/r.json"))
    got = {r["facility_id"]: r["errors"] for r in Q.with_request_errors(typed).collect()}
    assert got == {"a": [], "b": [], "c": ["hf_discharges_not_numeric"]}
    text = spark.createDataFrame([("1.5d", "7", "2")], "ami_excess_ratio string, mean_excess_ratio string, x string")
    assert tuple(Q.clip_to_bounds(text).first()) == (None, 5.0, "2")
    FI.write_request_template(spark, f"{tmp}/tpl")
    tpl = spark.read.option("header", True).csv(f"{tmp}/tpl")
    assert tpl.columns == REQUEST_SCHEMA.fieldNames() and tpl.count() == 0
