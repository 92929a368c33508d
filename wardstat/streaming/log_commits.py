"""Window totals that follow the commits of a log, exact after replays.

The stream's source is the folder of commit files, so each commit arrives
once. A micro-batch finds the windows that its commits, or the commits they
replace, have rows in, and writes the totals of those windows anew from the
partials of the live commits. Its output is keyed by the micro-batch and
overwritten, so a micro-batch that runs twice leaves the same rows, and
`current_windows` takes the newest total of each window. A window that lost
all its rows to a replay gets a total of 0 rows and is not shown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardstat.session import path_exists
from wardstat.sources.log_table import COMMIT_TYPE, COUNTED_TIERS, LogTable, window_stats


def start_commit_stream(spark: SparkSession, log: LogTable, out_dir: str, checkpoint_dir: str,
                        available_now: bool = True) -> StreamingQuery:
    """Keep the daily totals of `log` in `out_dir`; the log must have a commit."""
    def refresh(new: DataFrame, epoch: int) -> None:
        # every commit of the batches that have a new one: also what was replaced
        batches = new.select("source_id", "batch_id").distinct()
        named = log.commits().join(batches, ["source_id", "batch_id"], "left_semi").select("commit")
        touched = (spark.read.parquet(f"{log.path}/partials").join(named, "commit", "left_semi")
                   .where("window_start is not null").select("window_start", "window_end").distinct())
        totals = window_stats(log.partials().join(touched, ["window_start", "window_end"], "left_semi"))
        counts = ["n", *[f"{t}_count" for t in COUNTED_TIERS]]
        (touched.join(totals, ["window_start", "window_end"], "left").fillna(0, counts)
         .write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}"))

    stream = spark.readStream.schema(COMMIT_TYPE).json(f"{log.path}/commits")
    w = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def current_windows(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The newest totals of every window (None: the stream has written nothing)."""
    if not path_exists(spark, out_dir):
        return None
    rows = spark.read.parquet(out_dir)
    kept = [c for c in rows.columns if c not in ("epoch", "window_start", "window_end")]
    last = rows.groupBy("window_start", "window_end").agg(F.max(F.struct("epoch", *kept)).alias("m"))
    return last.select("window_start", "window_end", *[F.col(f"m.{c}").alias(c) for c in kept]).where("n > 0")
