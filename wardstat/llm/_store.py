"""Intermediate tables in the shared folder of the session."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from wardstat.session import delete_path, scratch_dir


def keep(spark: SparkSession, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write `df` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage at a file that every executor sees; columnar and
    compressed, and each reader prunes to the columns it needs.
    """
    path = scratch_dir(spark, f"llm-{name}")
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *done: DataFrame) -> None:
    """Delete kept tables that no later step reads, and let Spark delete the
    shuffle files of steps whose result is written: it does so when the driver
    collects the garbage that refers to them."""
    for path in {f.rsplit("/", 1)[0] for df in done for f in df.inputFiles()}:
        delete_path(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
