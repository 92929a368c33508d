import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from wardstat.sources import derived as D
from wardstat.sources import pages as PG
from wardstat.sources import files as FI
from wardstat.streaming import ingest as IN


def test_pages_roundtrip_and_cap(spark, tmp):
    raw = D.hrrp_raw(spark, SF001, with_order_keys=True)
    n = raw.count()
    PG.land_pages(raw, f"{tmp}/pages", ["l_orderkey", "l_linenumber"])
    pages = spark.read.json(f"{tmp}/pages")
    assert pages.agg(F.max(F.size("results"))).first()[0] <= 500
    back = PG.read_pages(spark, f"{tmp}/pages")
    assert back.count() == n
    assert back.exceptAll(D.hrrp_raw(spark, SF001)).count() == 0
    capped = PG.read_pages(spark, f"{tmp}/pages", max_rows=700)
    assert capped.count() == min(n, 1000)  # whole pages: offsets 0 and 500


def test_multiline_page_files(spark, tmp):
    os.makedirs(f"{tmp}/ml")
    row = {"facility_id": "010001", "measure_name": "READM-30-AMI-HRRP", "excess_readmission_ratio": "1.1"}
    with open(f"{tmp}/ml/p0.json", "w") as f:
        json.dump({"offset": 0, "count": 2, "results": [row, row]}, f, indent=2)
    assert PG.read_pages(spark, f"{tmp}/ml", multi_line=True).count() == 2


def test_incremental_ingest_no_duplicates(spark, tmp):
    land = f"{tmp}/land"
    os.makedirs(land)

    def page(i, k):
        rows = [{"facility_id": f"{i:03d}{j:03d}", "measure_name": "READM-30-HF-HRRP",
                 "excess_readmission_ratio": "1.0"} for j in range(k)]
        with open(f"{land}/page-{i:04d}.json", "w") as f:
            f.write(json.dumps({"offset": i * 500, "count": 3000, "results": rows}) + "\n")

    page(0, 3)
    page(1, 2)
    out, ck = f"{tmp}/out", f"{tmp}/ck"
    IN.ingest_pages(spark, land, out, ck)
    assert spark.read.parquet(out).count() == 5
    IN.ingest_pages(spark, land, out, ck)  # rerun: nothing new
    assert spark.read.parquet(out).count() == 5
    page(2, 4)
    IN.ingest_pages(spark, land, out, ck)
    assert spark.read.parquet(out).count() == 9
    # a capped run works apart: the full table stays full
    assert IN.ingest_pages(spark, land, out, ck, max_rows=500) == 1  # page
    assert spark.read.parquet(IN.capped(out, 500)).count() == 3
    assert IN.ingest_pages(spark, land, out, ck) == 0 and spark.read.parquet(out).count() == 9
    assert IN.load_or_refresh(spark, land, f"{tmp}/final", max_rows=500).count() == 3
    # cache-or-refresh
    cached = IN.load_or_refresh(spark, land, f"{tmp}/final")
    assert cached.count() == 9
    page(3, 1)
    assert IN.load_or_refresh(spark, land, f"{tmp}/final").count() == 9
    assert IN.load_or_refresh(spark, land, f"{tmp}/final", force=True).count() == 10
    # a refresh and later incremental runs share output and checkpoint
    page(4, 2)
    assert IN.ingest_pages(spark, land, f"{tmp}/final", f"{tmp}/final-checkpoint") == 1
    assert spark.read.parquet(f"{tmp}/final").count() == 12


def test_missing_inputs_raise(spark, tmp):
    with pytest.raises(FI.MissingInput):
        FI.read_raw(spark, f"{tmp}/none")
    assert FI.load_feature_source(spark, f"{tmp}/none", f"{tmp}/none.csv") is None


def test_scoring_and_window_streams(spark, tmp):
    from wardstat.plans import catalog
    from wardstat.plans import model as MD
    from wardstat.streaming.scoring import start_scoring_stream
    from wardstat.streaming.windows import start_window_stream

    feats = catalog.features(spark, SF001)
    res = MD.train(spark, feats, fixed_params={"maxIter": 3, "maxDepth": 2})
    MD.save_model(spark, res, f"{tmp}/m")
    lm = MD.load_model(spark, f"{tmp}/m")
    src = f"{tmp}/req"
    catalog.requests(spark, SF001).write.json(src)
    q = start_scoring_stream(spark, lm, src, f"{tmp}/out", f"{tmp}/ck")
    q.awaitTermination()
    scored = spark.read.parquet(f"{tmp}/out/scored")
    rejected = spark.read.parquet(f"{tmp}/out/rejected")
    assert scored.count() + rejected.count() == catalog.requests(spark, SF001).count()
    n_log = spark.read.parquet(f"{tmp}/out/log").count()
    assert n_log == scored.count()
    # a second run sees no new files and adds nothing
    q = start_scoring_stream(spark, lm, src, f"{tmp}/out", f"{tmp}/ck")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp}/out/log").count() == n_log
    w = start_window_stream(spark, f"{tmp}/out/log", f"{tmp}/win", f"{tmp}/ckw", watermark="0 seconds")
    w.awaitTermination()
    assert os.path.isdir(f"{tmp}/win")


def test_artifact_freshness(spark, tmp):
    spark.range(3).write.parquet(f"{tmp}/feat")
    out = {r["artifact"]: r["last_modified"] for r in
           FI.artifact_freshness(spark, {"features": f"{tmp}/feat", "model": f"{tmp}/nope"}).collect()}
    assert out["model"] == "missing" and len(out["features"]) == 16


def test_append_rows_union_by_name(spark):
    a = spark.createDataFrame([("1", "x")], "facility_id string, state string")
    b = spark.createDataFrame([("2", "y")], "facility_id string, measure_name string")
    out = PG.append_rows(PG.append_rows(None, a), b)
    rows = {r["facility_id"]: r for r in out.collect()}
    assert rows["1"]["measure_name"] is None and rows["2"]["state"] is None


def test_window_stream_matches_batch_on_closed_windows(spark, tmp):
    from wardstat.operators.monitoring import risk_windows
    from wardstat.streaming.windows import start_window_stream
    log = D.prediction_log(spark, SF001)  # event time is TIMESTAMP_NTZ here
    log.write.parquet(f"{tmp}/log")
    q = start_window_stream(spark, f"{tmp}/log", f"{tmp}/win", f"{tmp}/ck", watermark="1 hour")
    q.awaitTermination()
    streamed = {r["window_start"].isoformat(): (r["n"], r["high_count"])
                for r in spark.read.parquet(f"{tmp}/win").collect()}
    batch = {r["window_start"].isoformat(): (r["n"], r["high_count"])
             for r in risk_windows(log, "1 day").collect()}
    assert streamed and len(streamed) >= len(batch) - 1  # the last window waits for the watermark
    for k, v in streamed.items():
        assert batch[k] == v
