"""The log with a commit manifest: replays, partials, data skipping, the stream of commits."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from wardstat.operators import monitoring as MO
from wardstat.sources.derived import prediction_log
from wardstat.sources.log_table import LogTable, _put, log_stats, state_stats, window_stats
from wardstat.streaming.log_commits import current_windows, start_commit_stream


def rows_of(df):
    def plain(v):
        return round(v, 6) if isinstance(v, float) else str(v)
    return sorted(tuple(plain(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def rows(spark):
    return prediction_log(spark, SF001).cache()


@pytest.fixture()
def filled(spark, rows, tmp):
    """Three batches of two sources; one batch was logged wrongly before and replayed."""
    log = LogTable(spark, f"{tmp}/log")
    log.append(rows.where("id % 3 = 1").withColumn("risk_score", F.lit(0.9)).withColumn("risk_level", F.lit("high")), "a", 1)
    for source, batch, part in (("a", 0, 0), ("a", 1, 1), ("b", 1, 2)):
        log.append(rows.where(F.col("id") % 3 == part), source, batch, by_time=True)
    return log


def test_a_replay_replaces_its_batch(rows, filled):
    assert rows_of(filled.read().drop("source_id", "batch_id")) == rows_of(rows)
    assert filled.commits().count() == 4 and filled.live().count() == 3
    filled.append(rows.where("id % 3 = 2").limit(0), "b", 1)
    assert filled.read().where("source_id = 'b'").count() == 0


def test_an_older_sequence_does_not_win(spark, rows, tmp):
    log = LogTable(spark, f"{tmp}/log")
    log.append(rows.limit(3), "a", 1, seq=7)
    log.append(rows.limit(9), "a", 1, seq=6)
    assert log.read().count() == 3


def test_what_is_not_committed_is_not_seen(spark, rows, filled, monkeypatch):
    import wardstat.sources.log_table as LT

    def dies(*_):
        raise OSError("lost")
    want = rows_of(filled.read())
    monkeypatch.setattr(LT, "_put", dies)
    with pytest.raises(OSError):
        filled.append(rows, "c", 1)
    assert rows_of(filled.read()) == want
    assert log_stats(filled.partials()).first()["total"] == rows.count()


def test_partials_equal_the_full_scan(rows, filled):
    assert rows_of(log_stats(filled.partials())) == rows_of(MO.prediction_stats(rows))
    assert rows_of(window_stats(filled.partials())) == rows_of(MO.risk_windows(rows))
    assert rows_of(state_stats(filled.partials())) == rows_of(MO.state_risk(rows))


def test_statistics_do_not_scan_the_log(filled):
    files = log_stats(filled.partials()).inputFiles()
    assert {f.removeprefix(f"file://{filled.path}/").split("/")[0] for f in files} == {"partials", "commits"}


@pytest.mark.parametrize("n", (1, 17, 100, 5000))
def test_newest_equals_the_full_scan(rows, filled, n):
    want = rows.orderBy(F.col("timestamp").desc(), F.col("id").desc()).limit(n)
    assert rows_of(filled.newest(n).drop("source_id", "batch_id")) == rows_of(want)


def test_newest_opens_the_files_that_can_hold_it(spark, rows, tmp):
    log = LogTable(spark, f"{tmp}/log")
    days = sorted(r[0] for r in rows.select(F.to_date("timestamp")).distinct().collect())
    for i, day in enumerate(days[:6]):
        log.append(rows.where(F.to_date("timestamp") == F.lit(day)).coalesce(1), "a", i)
    n = rows.where(F.to_date("timestamp") == F.lit(days[5])).count()
    assert len(log.newest_files(1)) == 1
    assert len(log.newest_files(n)) == 1
    assert len(log.newest_files(n + 1)) == 2
    assert log.newest_files(10**6) is None
    assert set(log.newest(n + 1).inputFiles()) == {f"file://{f}" for f in log.newest_files(n + 1)}


def test_rows_without_a_time_or_score(spark, rows, tmp):
    log = LogTable(spark, f"{tmp}/log")
    odd = (rows.limit(4).withColumn("timestamp", F.lit(None).cast(rows.schema["timestamp"].dataType))
           .unionAll(rows.limit(2).withColumn("risk_score", F.lit(None).cast("double")))
           .unionAll(rows.limit(1).withColumn("risk_score", F.lit(float("nan")))))
    log.append(odd, "a", 1)
    assert log_stats(log.partials()).first()["total"] == 7
    assert window_stats(log.partials()).agg(F.sum("n")).first()[0] == 3
    assert log.newest(3).where("timestamp is null").count() == 0
    assert log.newest(5).where("timestamp is null").count() == 2


def test_empty_log(spark, tmp):
    log = LogTable(spark, f"{tmp}/none")
    assert log.read().count() == 0 and log.newest(5).count() == 0
    assert log_stats(log.partials()).first().asDict() == {"total": 0, "mean_risk_score": 0.0, "high_count": 0, "medium_count": 0, "low_count": 0}


def test_stream_of_commits_is_exact_after_a_replay(spark, rows, filled, tmp):
    out, ck = f"{tmp}/windows", f"{tmp}/ck"
    run = lambda: start_commit_stream(spark, filled, out, ck).awaitTermination()
    run()
    assert rows_of(current_windows(spark, out)) == rows_of(MO.risk_windows(rows))
    # the same rows again, then fewer: one window loses all its rows of the batch
    filled.append(rows.where("id % 3 = 1"), "a", 1)
    run()
    assert rows_of(current_windows(spark, out)) == rows_of(MO.risk_windows(rows))
    last = rows.agg(F.max(F.to_date("timestamp"))).first()[0]
    for source, batch, part in (("a", 0, 0), ("a", 1, 1), ("b", 1, 2)):
        filled.append(rows.where((F.col("id") % 3 == part) & (F.to_date("timestamp") < F.lit(last))), source, batch)
    run()
    want = MO.risk_windows(rows.where(F.to_date("timestamp") < F.lit(last)))
    assert rows_of(current_windows(spark, out)) == rows_of(want)
    assert isinstance(last, dt.date) and os.path.isdir(ck)


def test_put_leaves_no_part_file(spark, tmp):
    _put(spark, f"{tmp}/x/y.json", "{}\n")
    assert [f for f in os.listdir(f"{tmp}/x") if not f.endswith(".crc")] == ["y.json"]


def test_scored_batches_are_committed_and_replayed(spark, tmp):
    from wardstat.plans import catalog
    from wardstat.plans import model as MD
    from wardstat.plans.score import score_batch
    model, requests = MD.serving_model(spark), catalog.requests(spark, SF001).limit(40)
    table = LogTable(spark, f"{tmp}/log")
    for batch in (1, 2, 1):
        res = score_batch(spark, model, requests, log_table=table, batch_id=batch, source_id="s")
        n = res.responses.count()
        res.release()
    assert table.commits().count() == 3
    assert table.read().groupBy("batch_id").count().orderBy("batch_id").collect() == [(1, n), (2, n)]
    assert log_stats(table.partials()).first()["total"] == 2 * n


def test_plain_window_stream_counts_a_replay_once(spark, rows, tmp):
    from wardstat.plans.score import append_log
    from wardstat.streaming.windows import start_window_stream
    part = rows.where("id % 40 = 0").withColumns({"source_id": F.lit("a"), "batch_id": F.lit(1)})
    for _ in range(2):  # the replay rewrites the files that the stream has read
        append_log(part, f"{tmp}/log")
        start_window_stream(spark, f"{tmp}/log", f"{tmp}/out", f"{tmp}/ck", watermark="60 days").awaitTermination()
    late = part.limit(1).withColumns({"timestamp": F.lit("2030-01-01").cast("timestamp_ntz"), "id": F.lit(-1).cast("long"), "batch_id": F.lit(2)})
    append_log(late, f"{tmp}/log")
    start_window_stream(spark, f"{tmp}/log", f"{tmp}/out", f"{tmp}/ck", watermark="60 days").awaitTermination()
    done = spark.read.parquet(f"{tmp}/out").where("year(window_start) < 2030")
    assert done.agg(F.sum("n")).first()[0] == part.count()
