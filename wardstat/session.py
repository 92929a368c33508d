"""Session helpers: builder defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


DEFAULTS = {
    # results are the same with it; without it the wide conditional aggregations plan faster
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "wardstat") -> SparkSession:
    """Session with the settings the library assumes (AQE on, UTC, no UI).

    Settings that the launcher or `spark-defaults.conf` has made win: the
    defaults here are applied only where a setting is absent. A running
    session is returned as it is.
    """
    b = SparkSession.builder.appName(app_name)
    if SparkSession.getActiveSession() is None:
        given = SparkConf()  # system properties and defaults of the launcher
        if master:
            b = b.master(master)
        memory = os.environ.get("WARDSTAT_DRIVER_MEMORY", "8g")
        for k, v in {**DEFAULTS, "spark.driver.memory": memory}.items():
            if not given.contains(k):
                b = b.config(k, v)
        if shuffle_partitions:
            b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def apply_query_settings(spark: SparkSession) -> None:
    """Check what the library's plans rely on, without touching the caller's
    optimizer settings: a checkpoint folder."""
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names a shared folder in `spark.checkpoint.dir`; we only set
    our own when it is unset and the master is local (tests, local runs).
    On a cluster an unset folder is an error: a machine-local temporary
    folder would not survive the loss of the executor that wrote it.
    """
    path = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a shared folder (HDFS/S3/...) for this cluster")
        path = tempfile.mkdtemp(prefix="wardstat-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/wardstat/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the Hadoop FileSystem of `path`, if it is there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder `source` at `target` by renames: what lies there is set
    aside first, deleted once the new one is in place, and put back if the
    rename fails. Both must lie in one file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, old = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    aside = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}-replaced-{uuid.uuid4().hex[:12]}")
    fs = old.getFileSystem(conf)
    had = bool(fs.exists(old))
    if not had and old.getParent() is not None:
        fs.mkdirs(old.getParent())
    if had and not fs.rename(old, aside):
        raise OSError(f"cannot set {target} aside")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError(f"cannot move {source} to {target}")
    if had:
        fs.delete(aside, True)


def move_children(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Move the entries of `source` whose names begin with `prefix` to `target`."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = old.getFileSystem(conf)
    fs.mkdirs(new)
    for status in fs.listStatus(old):
        name = status.getPath().getName()
        if name.startswith(prefix) and not fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(new, name)):
            raise OSError(f"cannot move {source}/{name} to {target}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of `path` (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))

