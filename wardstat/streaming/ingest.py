"""Incremental, resumable page ingest (Structured Streaming).

Landed page files are a file-stream source; each run with
`trigger(availableNow=True)` processes only pages it has not seen (the
checkpoint records them) and the parquet file sink commits each batch
exactly once, so a crash between page and commit re-reads nothing twice.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from wardstat.schemas import PAGE_SCHEMA, RAW_SCHEMA
from wardstat.session import delete_path, path_exists
from wardstat.sources.pages import page_rows


def capped(path: str, max_rows: int | None) -> str:
    """Folder of a capped run: apart from the uncapped one, so that a trial
    run neither marks pages as seen nor shortens the full table."""
    return path if max_rows is None else f"{path.rstrip('/')}-capped-{int(max_rows)}"


class _RowCount(StreamingQueryListener):
    """Adds up the input rows of one query over all its progress reports."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def of(self, query) -> int:
        self.ended.setdefault(str(query.runId), threading.Event()).wait(30)
        return self.rows.get(str(query.runId), 0)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + int(event.progress.numInputRows)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.setdefault(str(event.runId), threading.Event()).set()


def ingest_pages(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_dir: str,
                 max_rows: int | None = None, multi_line: bool = False) -> int:
    """Process all newly landed pages into `out_dir`; returns the number of
    page payloads read by this run (0 when nothing was new).

    A run with `max_rows` works in `capped(out_dir, max_rows)` with a
    checkpoint of its own."""
    pages = (spark.readStream.schema(PAGE_SCHEMA).option("multiLine", multi_line)
             .json(landing_dir))
    count = _RowCount()
    spark.streams.addListener(count)
    try:
        q = (page_rows(pages, max_rows).writeStream.format("parquet")
             .option("path", capped(out_dir, max_rows)).option("checkpointLocation", capped(checkpoint_dir, max_rows))
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        return count.of(q)
    finally:
        spark.streams.removeListener(count)


def load_or_refresh(spark: SparkSession, landing_dir: str, out_dir: str, force: bool = False,
                    max_rows: int | None = None, checkpoint_dir: str | None = None) -> DataFrame:
    """Cache-or-refresh: reuse the table at `out_dir` unless `force`; a capped
    table has a folder of its own and is never returned for the full one.

    A refresh deletes the output and the checkpoint together and ingests all
    landed pages anew, so incremental runs on them can go on afterwards."""
    out = capped(out_dir, max_rows)
    ck = checkpoint_dir or f"{out_dir.rstrip('/')}-checkpoint"
    if path_exists(spark, out) and not force:
        return spark.read.parquet(out)
    delete_path(spark, out)
    delete_path(spark, capped(ck, max_rows))
    ingest_pages(spark, landing_dir, out_dir, ck, max_rows=max_rows)
    return spark.read.schema(RAW_SCHEMA).parquet(out)
