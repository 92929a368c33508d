"""Parquet / CSV sources and sinks of the data product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.functions.numeric import tolerant_double
from wardstat.operators.monitoring import results_export
from wardstat.schemas import FEATURE_TABLE_COLUMNS, ID_COLUMNS, MEASURE_FEATURES, RAW_SCHEMA, REQUEST_SCHEMA
from wardstat.session import path_exists


class MissingInput(FileNotFoundError):
    pass


def feature_schema() -> T.StructType:
    fields = []
    for c in FEATURE_TABLE_COLUMNS:
        if c in ID_COLUMNS:
            t = T.StringType()
        elif c in ("n_measures_over_threshold", "n_valid_measures"):
            t = T.LongType()
        elif c in ("state_encoded", "high_readmission_risk"):
            t = T.IntegerType()
        else:
            t = T.DoubleType()
        fields.append(T.StructField(c, t, True))
    return T.StructType(fields)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw long table (declared all-string schema); error if absent."""
    if not path_exists(spark, path):
        raise MissingInput(f"raw data not found at {path}; land it first")
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        raise MissingInput(f"feature table not found at {path}; build it first")
    return spark.read.schema(feature_schema()).parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def load_feature_source(spark: SparkSession, parquet_path: str, csv_path: str | None = None):
    """Feature parquet if present, else a CSV fallback, else None."""
    if path_exists(spark, parquet_path):
        return spark.read.parquet(parquet_path)
    if csv_path and path_exists(spark, csv_path):
        return spark.read.option("header", True).schema(feature_schema()).csv(csv_path)
    return None


def request_text_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in REQUEST_SCHEMA.fieldNames()])


def read_request_csv(spark: SparkSession, path: str) -> DataFrame:
    """Request CSV with a header. Read as text, then typed: a value that is
    present but not a number is kept as an error (`type_errors`) instead of
    failing the whole file."""
    return type_requests(spark.read.option("header", True).option("enforceSchema", False)
                         .schema(request_text_schema()).csv(path))


def type_requests(text: DataFrame) -> DataFrame:
    """Request rows read as text -> typed rows, with `type_errors` (values
    that are present but not a number; numeric text is accepted) and
    `raw_record` (the row as it came, for the rejected output)."""
    typed = [F.col(c) for c in ID_COLUMNS]
    typed += [tolerant_double(c).alias(c) for c in MEASURE_FEATURES]
    bad = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & tolerant_double(c).isNull(),
               F.lit(f"{c}_not_numeric")) for c in MEASURE_FEATURES]))
    return text.select(*typed, bad.alias("type_errors"),
                       F.to_json(F.struct(*request_text_schema().fieldNames())).alias("raw_record"))


def write_request_csv(df: DataFrame, path: str) -> str:
    df.select(*REQUEST_SCHEMA.fieldNames()).write.mode("overwrite").option("header", True).csv(path)
    return path


def export_results_csv(scored: DataFrame, path: str) -> str:
    """Scored rows as a CSV with the four display columns."""
    results_export(scored).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_request_template(spark: SparkSession, path: str) -> str:
    """Header-only CSV with the 27 request columns."""
    (spark.createDataFrame([], REQUEST_SCHEMA).coalesce(1)
     .write.mode("overwrite").option("header", True).csv(path))
    return path


def artifact_freshness(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Last modification time (UTC, minute precision) of each artifact
    folder, read from the file metadata column of a scan; 'missing' when
    the path does not exist."""
    out = None
    for name, path in paths.items():
        if path_exists(spark, path):
            df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
                  .agg(F.max("modificationTime").alias("mtime"))
                  .select(F.lit(name).alias("artifact"),
                          F.date_format("mtime", "yyyy-MM-dd HH:mm").alias("last_modified")))
        else:
            df = spark.range(1).select(F.lit(name).alias("artifact"),
                                       F.lit("missing").alias("last_modified"))
        out = df if out is None else out.unionByName(df)
    return out
