"""Streaming scoring: request files -> validate -> score -> sinks.

Each micro-batch runs the batch scoring plan inside `foreachBatch`; every
output is keyed by the stream's source and the micro-batch id and written in
overwrite mode, so a batch replayed after a failure replaces its own output
(idempotent sinks) and two streams may write to one place.
The stream itself is stateless.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from wardstat.plans.model import LoadedModel
from wardstat.plans.score import score_batch
from wardstat.sources.files import request_text_schema, type_requests
from wardstat.sources.log_table import LogTable


def start_scoring_stream(spark: SparkSession, model: LoadedModel, source_dir: str, out_dir: str,
                         checkpoint_dir: str, available_now: bool = True,
                         processing_time: str | None = None, source_id: str | None = None,
                         log_table: LogTable | None = None) -> StreamingQuery:
    """`source_id` names the stream in the log; by default it follows from the
    checkpoint folder, so a restarted stream replays under its own name and
    two streams that log to one place stay apart. Requests are read as text
    and typed like a CSV upload: numeric text is accepted, other text rejected."""
    source = source_id or "stream-" + hashlib.sha256(checkpoint_dir.encode()).hexdigest()[:12]
    stream = type_requests(spark.readStream.schema(request_text_schema()).json(source_dir))

    def run_batch(df, batch_id: int) -> None:
        res = score_batch(spark, model, df, log_path=f"{out_dir}/log", batch_id=batch_id, source_id=source, log_table=log_table)
        own = f"source_id={source}/batch_id={batch_id}"
        for name, rows in (("scored", res.responses), ("rejected", res.rejected), ("summary", res.summary)):
            rows.write.mode("overwrite").parquet(f"{out_dir}/{name}/{own}")
        res.release()

    w = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()
