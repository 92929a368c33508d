"""Drift monitoring over the prediction log as a stream: tier counts and
mean score per tumbling window, finalised once the watermark passes.

A batch replayed within the watermark counts once, by the rows' `id`. Totals
that are exact whenever the replay comes need the log's commits: see
`log_commits`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardstat.operators.monitoring import risk_windows


def as_instant(df: DataFrame, col: str) -> Column:
    """Event time as TIMESTAMP. A TIMESTAMP_NTZ column holds UTC wall-clock
    values; it is converted to the session zone's wall clock first, so the
    cast yields the same instant whatever the session time zone is."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
        return F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(col)).cast("timestamp")
    return F.col(col)


def start_window_stream(spark: SparkSession, log_dir: str, out_dir: str, checkpoint_dir: str,
                        window: str = "1 day", watermark: str = "1 hour",
                        available_now: bool = True, time_col: str = "timestamp") -> StreamingQuery:
    schema = spark.read.parquet(log_dir).schema
    logs = spark.readStream.schema(schema).parquet(log_dir)
    logs = logs.withColumn(time_col, as_instant(logs, time_col)).withWatermark(time_col, watermark)
    if "id" in logs.columns:  # a replayed batch brings the ids it had before
        logs = logs.dropDuplicatesWithinWatermark(["id"])
    agg = risk_windows(logs, window, time_col)
    w = (agg.writeStream.format("parquet").outputMode("append")
         .option("path", out_dir).option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
