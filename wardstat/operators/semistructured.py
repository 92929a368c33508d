"""Logged features of any shape, kept as VARIANT.

`monitoring.parse_features` reads a flat object of numbers. Requests also
carry nested objects, arrays, text and booleans; here the JSON text is
decoded once into a VARIANT column, which Parquet stores in binary form, so
that later reads take single paths out of it without parsing text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "text", "BOOLEAN": "boolean", "VOID": "null"}


def decode_features(log: DataFrame, column: str = "input_features", out: str = "features") -> DataFrame:
    """Add `out` (VARIANT) and `<out>_ok`.

    Valid JSON of any kind is decoded. Other text (an object that names a key
    twice counts as such) is kept as a text value with `<out>_ok` false; a
    null text gives a null value and a null flag. A column of either name
    that is there already is replaced.
    """
    text = F.col(column)
    parsed = F.try_parse_json(text)
    return log.withColumns({
        out: F.coalesce(parsed, text.cast("variant")),
        f"{out}_ok": F.when(text.isNotNull(), parsed.isNotNull())})


def feature_value(path: str, kind: str = "double", column: str = "features") -> Column:
    """The value at `path` (`$.site.state`, `$.scores[1]`) as `kind`; null
    where there is none or where it does not cast."""
    return F.try_variant_get(column, path, kind)


def feature_kind(value: Column) -> Column:
    """object, array, text, boolean, null or number; null for no value."""
    schema = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    named = F.coalesce(*[F.when(schema == k, F.lit(v)) for k, v in KINDS.items()], F.lit("number"))
    return F.when(value.isNotNull(), named)


def feature_rows(decoded: DataFrame, keep: list[str], column: str = "features") -> DataFrame:
    """One row per feature of an object: `keep`, key, value (VARIANT), kind.

    Rows whose value is no object have no features and give no row. The
    explode is a generator over the stored value: no shuffle.
    """
    out = decoded.select(*keep, F.col(column).alias("_v")).where(feature_kind(F.col("_v")) == "object")
    return (out.lateralJoin(out.sparkSession.tvf.variant_explode(F.col("_v").outer()))
            .select(*keep, "key", "value", feature_kind(F.col("value")).alias("kind")))


def feature_profile(rows: DataFrame) -> DataFrame:
    """By key and kind: how many values, and the mean, least and greatest of
    the numbers. One partial aggregation, so a key that every row has costs
    one row a task."""
    number = F.when(F.col("kind") == "number", F.try_variant_get("value", "$", "double"))
    return rows.groupBy("key", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.avg(number).alias("mean_value"),
        F.min(number).alias("min_value"), F.max(number).alias("max_value"))
