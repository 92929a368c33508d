"""Cleaning of the raw long table (one row per hospital x measure)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.functions.numeric import tolerant_double
from wardstat.schemas import MEASURE_CODES, RAW_NUMERIC


def coerce_numeric(df: DataFrame, columns: list[str] = RAW_NUMERIC) -> DataFrame:
    """Sentinel-tolerant text -> double for `columns`; other columns untouched."""
    return df.withColumns({c: tolerant_double(c) for c in columns})


def keep_known_measures(df: DataFrame) -> DataFrame:
    """Keep the six known measure codes. An IN list on a scan column, so the
    predicate reaches the parquet reader."""
    return df.filter(F.col("measure_name").isin(list(MEASURE_CODES)))


def measure_short_expr():
    """Measure code -> short prefix, as a literal map lookup (no join)."""
    lookup = F.create_map(*[F.lit(x) for kv in MEASURE_CODES.items() for x in kv])
    return lookup[F.col("measure_name")]


def add_measure_short(df: DataFrame) -> DataFrame:
    return df.withColumn("measure_short", measure_short_expr())


def clean_raw(df: DataFrame) -> DataFrame:
    """Coerce the four metrics, keep known measures, add `measure_short`."""
    return add_measure_short(keep_known_measures(coerce_numeric(df)))
