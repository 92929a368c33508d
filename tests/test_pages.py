"""Pages cut in one shuffle, folders by offset, and the page data source."""
import json
import os

import pytest
from pyspark.sql import functions as F

from wardstat.schemas import RAW_FIELDS, RAW_SCHEMA
from wardstat.sources.page_source import PageReader, list_folders, register_page_source
from wardstat.sources.pages import land_pages, read_pages
from wardstat.session import delete_path

ORDER = ["ord"]


def rows(spark, n, parts=7, start=0, hot=False):
    """n rows whose name says their place; with `hot`, two thirds share one order key."""
    cols = [F.lit(None).cast("string").alias(c) for c in RAW_FIELDS if c != "facility_name"]
    key = F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")) if hot else F.col("id")
    return spark.range(start, start + n, 1, parts).select(key.alias("ord"), F.col("id").cast("string").alias("facility_name"), *cols)


def landed(path):
    out = {}
    for folder, _, files in os.walk(path):
        for name in files:
            if name.endswith(".json"):
                with open(f"{folder}/{name}") as f:
                    for line in f:
                        page = json.loads(line)
                        assert page["offset"] not in out
                        out[page["offset"]] = page
    return out


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 1003])
def test_pages_are_whole_and_in_order(spark, tmp, n):
    land_pages(rows(spark, n).repartition(5), f"{tmp}/p", ORDER, page_size=10, folder_rows=100)
    pages = landed(f"{tmp}/p")
    assert sorted(pages) == list(range(0, n, 10))
    for offset, page in pages.items():
        assert page["count"] == n
        assert [r["facility_name"] for r in page["results"]] == [str(i) for i in range(offset, min(offset + 10, n))]
    assert sorted(os.listdir(tmp)) == ["p"]
    assert read_pages(spark, f"{tmp}/p").count() == n


def test_a_hot_order_key_is_dealt_out(spark, tmp):
    land_pages(rows(spark, 5000, hot=True), f"{tmp}/p", ORDER, page_size=10, folder_rows=1000)
    pages = landed(f"{tmp}/p")
    assert [len(pages[o]["results"]) for o in sorted(pages)] == [10] * 500
    assert sorted(int(r["facility_name"]) for p in pages.values() for r in p["results"]) == list(range(5000))


def test_a_batch_border_does_not_cut_a_page(spark, tmp):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        land_pages(rows(spark, 400), f"{tmp}/p", ORDER, page_size=25, folder_rows=100)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [len(p["results"]) for p in landed(f"{tmp}/p").values()] == [25] * 16


def test_folders_beyond_the_cap_are_not_opened(spark, tmp):
    land_pages(rows(spark, 1000), f"{tmp}/p", ORDER, page_size=10, folder_rows=200)
    name = register_page_source(spark)
    for first, _, folder in list_folders(f"{tmp}/p"):
        if first >= 400:  # whoever opens these fails
            for f in os.listdir(folder):
                with open(f"{folder}/{f}", "w") as out:
                    out.write("{broken")
    want = sorted(map(str, range(260)))
    capped = read_pages(spark, f"{tmp}/p", max_rows=255)
    assert sorted(r.facility_name for r in capped.collect()) == want
    assert "PartitionFilters: [isnotnull(first" in capped._jdf.queryExecution().executedPlan().toString()
    read = spark.read.format(name).option("max_rows", 255).load(f"{tmp}/p")
    assert sorted(r.facility_name for r in read.collect()) == want
    assert read.rdd.getNumPartitions() == 2
    assert spark.read.format(name).option("max_rows", 0).load(f"{tmp}/p").count() == 0


def test_comparisons_of_the_offset_are_pushed(spark, tmp):
    land_pages(rows(spark, 1000), f"{tmp}/p", ORDER, page_size=10, folder_rows=200)
    name = register_page_source(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        part = spark.read.format(name).option("push_filters", True).load(f"{tmp}/p").where("offset >= 210 and offset < 395 and facility_name <> '300'")
        assert sorted(int(r.facility_name) for r in part.collect()) == [i for i in range(210, 400) if i != 300]
        assert part.rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_source_and_spark_reader_agree(spark, tmp):
    land_pages(rows(spark, 777), f"{tmp}/p", ORDER, page_size=50, folder_rows=100)
    source = spark.read.format(register_page_source(spark)).load(f"{tmp}/p").select(*RAW_FIELDS)
    assert sorted(map(str, source.collect())) == sorted(map(str, read_pages(spark, f"{tmp}/p").collect()))
    assert source.schema.fieldNames() == RAW_SCHEMA.fieldNames()


def test_a_stream_resumes_at_its_offset(spark, tmp):
    name, out = register_page_source(spark), f"{tmp}/out"
    land_pages(rows(spark, 300), f"{tmp}/p", ORDER, page_size=10, folder_rows=100)

    def run():
        (spark.readStream.format(name).load(f"{tmp}/p").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start().awaitTermination())
        return sorted(int(r.facility_name) for r in spark.read.parquet(out).collect())

    assert run() == list(range(300))
    assert run() == list(range(300))  # nothing new
    land_pages(rows(spark, 250, start=300), f"{tmp}/p", ORDER, page_size=10, folder_rows=100, start=300)
    delete_path(spark, f"{tmp}/p/first=0")  # seen: not needed any more
    assert run() == list(range(550))


def test_options_and_awkward_pages(spark, tmp):
    os.makedirs(f"{tmp}/p/first=0/end=1500")
    with open(f"{tmp}/p/first=0/end=1500/a.json", "w") as f:
        f.write(json.dumps({"offset": 0, "count": 3, "results": [{"state": "TX", "extra": 1}, {}]}) + "\n")
        f.write(json.dumps({"offset": 500, "count": 3, "results": []}) + "\n\n")
        f.write(json.dumps({"offset": 1000, "count": 3, "results": [{"state": "é" * 50_000}]}))
    name = register_page_source(spark)
    got = spark.read.format(name).load(f"{tmp}/p").collect()
    assert sorted((r.offset, len(r.state or "")) for r in got) == [(0, 0), (0, 2), (1000, 50_000)]
    assert spark.read.format(name).load(f"{tmp}/nothing").count() == 0
    with pytest.raises(Exception, match="max_rows"):
        spark.read.format(name).option("max_rows", -1).load(f"{tmp}/p").count()
    assert len(PageReader(f"{tmp}/p", None).partitions()) == 1


def test_compressed_pages_are_read_by_every_source(spark, tmp):
    """The same rows in far fewer bytes, through Spark's reader, the page source and its stream."""
    size = {}
    for codec in (None, "gzip"):
        land_pages(rows(spark, 3000), f"{tmp}/{codec}", ORDER, page_size=50, folder_rows=1000, codec=codec)
        files = [f"{d}/{f}" for d, _, fs in os.walk(f"{tmp}/{codec}") for f in fs if ".json" in f and not f.endswith(".crc")]
        assert files and all(f.endswith(".gz") == (codec is not None) for f in files)
        size[codec] = sum(map(os.path.getsize, files))
    assert 5 * size["gzip"] < size[None]
    path, want = f"{tmp}/gzip", list(map(str, range(3000)))
    name = register_page_source(spark)
    assert sorted(r.facility_name for r in read_pages(spark, path).collect()) == sorted(want)
    assert sorted(r.facility_name for r in spark.read.format(name).load(path).collect()) == sorted(want)
    assert spark.read.format(name).option("max_rows", 60).load(path).count() == 100
    (spark.readStream.format(name).load(path).writeStream.format("parquet").option("path", f"{tmp}/out")
     .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start().awaitTermination())
    assert sorted(r.facility_name for r in spark.read.parquet(f"{tmp}/out").collect()) == sorted(want)


def test_landing_queries_write_compressed_pages(spark, tmp, monkeypatch):
    from wardstat.plans import catalog
    seen = []
    land = catalog.PG.land_pages
    monkeypatch.setattr(catalog.PG, "land_pages", lambda *a, **k: seen.append(k.get("codec")) or land(*a, **k))
    for q in ("ingest_pages", "page_source", "ingest_stream"):
        catalog.QUERIES[q](spark, "/root/testdata/sf0.001")
    assert seen == ["gzip"] * 3
