"""The prediction log with a commit manifest.

Layout below one folder:

    data/commit=<c>/...       rows of one commit, never rewritten
    partials/commit=<c>/...   mergeable counts of the commit by (window, state)
    bounds/commit=<c>/...     one row a data file: name, rows with a time, least and largest time
    commits/<c>.json          one line: commit, source, batch, sequence

A commit is the whole content of a (source_id, batch_id); of several commits
of one batch the last one counts (largest sequence, then largest name), so a
replay replaces its batch and the files before are no longer live. The commit
file is put in place by one rename after everything it names is written: a
writer that dies before leaves files that no reader sees. Nothing is changed
in place, so a reader that listed the commits keeps a consistent set of
files, and a stream that follows `commits/` sees every commit exactly once.

What the readers save:

* statistics merge the partials of the live commits: the log is not read;
* `newest` looks at the bounds of the live files and opens only those that
  can hold one of the newest n rows.

A missing folder is an empty log. Rows without a time are kept: they count in
the totals, belong to no window and come last in the history.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.schemas import LOG_SCHEMA
from wardstat.session import path_exists

COMMIT_TYPE = "commit string, source_id string, batch_id bigint, seq bigint"
#: a partial's window
PARTIAL_WINDOW = "1 day"
COUNTED_TIERS = ("high", "medium", "low")


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a hidden name and rename it into place."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    end = jvm.org.apache.hadoop.fs.Path(path)
    part = jvm.org.apache.hadoop.fs.Path(end.getParent(), f".{end.getName()}.part")
    fs = end.getFileSystem(conf)
    fs.mkdirs(end.getParent())
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, end):
        raise OSError(f"could not commit {path}")


def partials(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mergeable counts of log rows by `keys`, window and state.

    The mean is kept as an exact decimal sum and the number of scores in it,
    so that it does not depend on the order in which rows and partials are added.
    """
    score = F.col("risk_score").try_cast("decimal(20,12)")
    day = F.window(F.col("timestamp"), PARTIAL_WINDOW)
    timed = rows.where("timestamp is not null").withColumn("_w", day)
    kind = timed.schema["_w"].dataType.simpleString()
    every = timed.unionByName(rows.where("timestamp is null").withColumn("_w", F.lit(None).cast(kind)))
    return (every.groupBy(*(keys or []), F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "state")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(score).alias("score_sum"), F.count(score).alias("n_scores"),
                 *[F.count_if(F.col("risk_level") == t).cast("long").alias(f"{t}_count") for t in COUNTED_TIERS]))


class LogTable:
    """The log at `path`; every reader lists the commits anew."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, rows: DataFrame, source_id: str, batch_id: int, seq: int | None = None, by_time: bool = False) -> str:
        """Commit `rows` as the whole content of (source_id, batch_id).

        `seq` orders the commits of one batch (default: the clock). Rows are
        written once; partials and bounds are worked out from the files, so
        they describe what is stored. `by_time` deals the rows to files by
        ranges of time, for batches that span a long time.
        """
        commit = f"c{uuid.uuid4().hex}"
        data, part, bound = (f"{self.path}/{kind}/commit={commit}" for kind in ("data", "partials", "bounds"))
        rows = rows.withColumns({"source_id": F.lit(source_id), "batch_id": F.lit(int(batch_id)).cast("long")})
        if by_time:
            rows = rows.repartitionByRange(F.col("timestamp"))
        rows.write.parquet(data)
        stored = self.spark.read.schema(rows.schema).parquet(data)
        partials(stored, ["source_id", "batch_id"]).coalesce(1).write.parquet(part)
        (stored.groupBy(F.col("_metadata.file_name").alias("file"))
         .agg(F.count("timestamp").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
         .coalesce(1).write.parquet(bound))
        line = {"commit": commit, "source_id": source_id, "batch_id": int(batch_id), "seq": time.time_ns() if seq is None else int(seq)}
        _put(self.spark, f"{self.path}/commits/{commit}.json", json.dumps(line) + "\n")
        return commit

    def commits(self) -> DataFrame:
        """Every commit, one row each, replaced ones too."""
        if not path_exists(self.spark, f"{self.path}/commits"):
            return self.spark.createDataFrame([], COMMIT_TYPE)
        return self.spark.read.schema(COMMIT_TYPE).json(f"{self.path}/commits")

    def live(self) -> DataFrame:
        """The last commit of every (source_id, batch_id)."""
        return (self.commits().groupBy("source_id", "batch_id").agg(F.max(F.struct("seq", "commit")).alias("m"))
                .select("source_id", "batch_id", "m.seq", "m.commit"))

    def _live_rows(self, kind: str) -> DataFrame:
        """Rows of `kind` of the live commits. Folders of replaced commits are
        still read; the join, on the partition column `commit`, drops their rows."""
        return self.spark.read.parquet(f"{self.path}/{kind}").join(self.live().select("commit"), "commit", "left_semi")

    def _empty(self) -> DataFrame:
        key = [T.StructField("source_id", T.StringType()), T.StructField("batch_id", T.LongType())]
        return self.spark.createDataFrame([], T.StructType([*LOG_SCHEMA.fields, *key]))

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/commits")

    def read(self) -> DataFrame:
        """The log: rows of the live commits."""
        return self._live_rows("data").drop("commit") if self.exists() else self._empty()

    def partials(self) -> DataFrame:
        """Partials of the live commits by source, batch, window and state."""
        if not self.exists():
            return partials(self._empty(), ["source_id", "batch_id"])
        return self._live_rows("partials").drop("commit")

    def newest_files(self, n: int) -> list[str] | None:
        """Data files that can hold one of the `n` newest rows; None if fewer
        than `n` rows have a time, so that every file is needed.

        If the files that begin at a time B or later hold n rows, the n-th
        newest row is at B or later, and a file that ends before B holds none
        of them. B is the latest full hour with that property. What is
        sorted is one row an hour, made from one row a file.
        """
        bounds = self._live_rows("bounds").where("n > 0")
        hours = bounds.groupBy(F.date_trunc("hour", "first").alias("hour")).agg(F.sum("n").alias("n"))
        total = hours.select("hour", F.sum("n").over(Window.orderBy(F.col("hour").desc())).alias("total"))
        least = total.where(F.col("total") >= n).agg(F.max("hour").alias("least"))
        got = (bounds.crossJoin(F.broadcast(least))  # one row
               .where(F.col("least").isNull() | (F.col("last") >= F.col("least")))
               .select("commit", "file", F.col("least").isNull().alias("few")))
        rows = list(got.toLocalIterator())
        if not rows or rows[0]["few"]:
            return None
        return sorted(f"{self.path}/data/commit={r['commit']}/{r['file']}" for r in rows)

    def newest(self, n: int) -> DataFrame:
        """The `n` newest rows by (timestamp, id), from the files that can hold them."""
        if not self.exists():
            return self._empty()
        files = self.newest_files(n)
        rows = self.read() if files is None else self.spark.read.parquet(*files)
        return rows.orderBy(F.col("timestamp").desc(), F.col("id").desc()).limit(n)


def _mean() -> Column:
    return F.sum("score_sum").cast("double") / F.sum("n_scores")


def log_stats(parts: DataFrame) -> DataFrame:
    """All-time totals from partials: the columns of `prediction_stats`."""
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                     F.coalesce(F.round(_mean(), 4), F.lit(0.0)).alias("mean_risk_score"),
                     *[F.coalesce(F.sum(f"{t}_count"), F.lit(0)).alias(f"{t}_count") for t in COUNTED_TIERS])


def window_stats(parts: DataFrame) -> DataFrame:
    """Daily totals from partials: the columns of `risk_windows`."""
    return (parts.where("window_start is not null").groupBy("window_start", "window_end")
            .agg(F.sum("n").alias("n"), _mean().alias("mean_risk_score"),
                 *[F.sum(f"{t}_count").alias(f"{t}_count") for t in COUNTED_TIERS]))


def state_stats(parts: DataFrame, min_states: int = 2) -> DataFrame:
    """Mean score and count by state from partials: the columns of `state_risk`."""
    grouped = (parts.where("state is not null").groupBy("state")
               .agg(_mean().alias("mean_risk"), F.sum("n").alias("n")))
    return (grouped.withColumn("_states", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
            .where(F.col("_states") >= min_states).drop("_states"))
