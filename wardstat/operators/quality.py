"""Data-quality operators: balance, completeness, rule checks, request
validation, clipping and batch guards.

Every check is one aggregation (a single pass, partial aggregation per
task); only the small result table (one row per rule or per column) is ever
brought to the driver, and only in strict mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.functions.numeric import clip, nan_to_null, tolerant_double
from wardstat.schemas import (
    EXCESS_COLUMNS, FEATURE_KEY_COLUMNS, FEATURE_RANGE_RULES, MEASURE_FEATURES, REQUEST_BOUNDS,
    REQUEST_COLUMNS, STATE_MAX_LENGTH, TARGET,
)


class ValidationError(ValueError):
    """Raised in strict mode when a rule fails."""


def class_balance(labelled: DataFrame, label: str = TARGET) -> DataFrame:
    """n, positives, negatives and positive rate of a 0/1 label."""
    return labelled.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).cast("long").alias("positives"),
        F.count_if(F.col(label) == 0).cast("long").alias("negatives"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
    )


def class_weight(train: DataFrame, label: str = TARGET) -> DataFrame:
    """neg / pos rounded to 4 decimals; 1.0 when there is no positive row."""
    pos = F.count_if(F.col(label) == 1)
    neg = F.count_if(F.col(label) == 0)
    return train.agg(
        neg.cast("long").alias("negatives"),
        pos.cast("long").alias("positives"),
        F.when(pos > 0, F.round(neg / pos, 4)).otherwise(F.lit(1.0)).alias("scale_pos_weight"),
    )


def with_weight(train: DataFrame, weight: float, label: str = TARGET,
                name: str = "weight") -> DataFrame:
    """Per-row weight column: `weight` for positives, 1.0 for negatives."""
    return train.withColumn(name, F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))


def completeness_metrics(columns: list[str]) -> dict[str, Column]:
    """Row count and one `count(c)` per column, by name of the aggregate."""
    return {"_total": F.count(F.lit(1)), **{f"_nn_{i}": F.count(F.col(c)) for i, c in enumerate(columns)}}


def completeness_table(one: DataFrame, columns: list[str]) -> DataFrame:
    """The single row of `completeness_metrics` as one row per column."""
    pairs = ", ".join(f"'{c}', _nn_{i}" for i, c in enumerate(columns))
    stacked = one.selectExpr("_total", f"stack({len(columns)}, {pairs}) AS (column_name, non_null)")
    return stacked.select(
        "column_name",
        F.col("non_null").cast("long").alias("non_null"),
        F.col("_total").cast("long").alias("total"),
        F.when(F.col("_total") > 0, F.col("non_null") * F.lit(100.0) / F.col("_total"))
         .alias("pct_non_null"),
    )


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percentage of non-null values per column, in one pass.

    One `agg` of `count(c)` per column, then `stack` turns the single wide
    row into (column_name, non_null, total, pct_non_null) rows.
    """
    return completeness_table(df.agg(*[c.alias(n) for n, c in completeness_metrics(columns).items()]), columns)


def _rules(columns: list[str], key_columns: list[str], range_rules: dict[str, tuple[float, float]],
           label: str) -> list[tuple[str, str, str, Column, float, float]]:
    """(rule, column, name of the aggregate, aggregate, lo, hi) for a table of these columns."""
    absent = [c for c in [*key_columns, label] if c not in columns]
    if absent:
        raise ValidationError(f"feature table has no column {', '.join(absent)}")
    out = [("not_null", c, f"_null_{c}", F.count_if(F.col(c).isNull()), 0.0, 0.0) for c in key_columns]
    for c, (lo, hi) in range_rules.items():
        if c in columns:
            out += [("min_in_range", c, f"_min_{c}", F.min(F.col(c)), lo, hi),
                    ("max_in_range", c, f"_max_{c}", F.max(F.col(c)), lo, hi)]
    bad_label = F.count_if(~F.col(label).isin(0, 1) | F.col(label).isNull())
    return [*out, ("label_binary", label, "_bad_label", bad_label, 0.0, 0.0)]


def rule_metrics(df: DataFrame, key_columns: list[str] = FEATURE_KEY_COLUMNS,
                 range_rules: dict[str, tuple[float, float]] = FEATURE_RANGE_RULES,
                 label: str = TARGET) -> dict[str, Column]:
    """What the rules look at, by name: aggregates for `agg` or `observe`."""
    return {name: agg.cast("double") for _, _, name, agg, _, _ in _rules(df.columns, key_columns, range_rules, label)}


def rule_table(one: DataFrame, columns: list[str], key_columns: list[str] = FEATURE_KEY_COLUMNS,
               range_rules: dict[str, tuple[float, float]] = FEATURE_RANGE_RULES,
               label: str = TARGET) -> DataFrame:
    """The single row of `rule_metrics` as one row per rule."""
    rows = _rules(columns, key_columns, range_rules, label)
    entries = ", ".join(f"'{r}', '{c}', {a}, CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE)"
                        for r, c, a, _, lo, hi in rows)
    table = one.selectExpr(f"stack({len(rows)}, {entries}) AS (rule, column_name, observed, lo, hi)")
    ok = F.col("observed").isNotNull() & (F.col("observed") >= F.col("lo")) & (F.col("observed") <= F.col("hi"))
    return table.withColumn("ok", ok)


def feature_rules(df: DataFrame, key_columns: list[str] = FEATURE_KEY_COLUMNS,
                  range_rules: dict[str, tuple[float, float]] = FEATURE_RANGE_RULES,
                  label: str = TARGET) -> DataFrame:
    """Rule table `rule, column_name, observed, lo, hi, ok` from one aggregation.

    Rules: no NULL in each key column; min and max of each ranged column
    within bounds (ranged columns absent from `df` are skipped); label in
    {0, 1}. An absent key or label column raises.
    """
    given = (key_columns, range_rules, label)
    one = df.agg(*[c.alias(n) for n, c in rule_metrics(df, *given).items()])
    return rule_table(one, df.columns, *given)


def raise_failed(rules: DataFrame) -> None:
    """Raise if a rule of the table does not hold (only the rule rows, at most
    a few dozen, come to the driver)."""
    failed = [r for r in rules.collect() if not r["ok"]]
    if failed:
        msg = "; ".join(f"{r['rule']}({r['column_name']}) observed={r['observed']} "
                        f"bounds=[{r['lo']}, {r['hi']}]" for r in failed)
        raise ValidationError(f"feature validation failed: {msg}")


def validate_features(df: DataFrame, strict: bool = True) -> DataFrame:
    """Rule table; in strict mode raise when a rule fails."""
    rules = feature_rules(df)
    if strict:
        raise_failed(rules)
    return rules


def ingest_report(raw: DataFrame) -> DataFrame:
    """Rows, column count, column names and distinct hospitals of a raw table."""
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(raw.columns)).cast("long").alias("n_columns"),
        F.lit(",".join(raw.columns)).alias("columns"),
        F.countDistinct("facility_id").alias("n_hospitals"),
    )


def scorable_rows(df: DataFrame) -> DataFrame:
    """Request columns present in `df`, rows with at least one excess ratio."""
    cols = [c for c in REQUEST_COLUMNS if c in df.columns]
    excess = [c for c in cols if c in EXCESS_COLUMNS]
    return df.filter(F.coalesce(*[F.col(c) for c in excess]).isNotNull()).select(*cols)


def _bounds_for(column: str) -> tuple[float | None, float | None]:
    for suffix, b in REQUEST_BOUNDS.items():
        if column.endswith(suffix):
            return b
    return (None, None)


def request_errors() -> Column:
    """Array of rule names a request row breaks (empty when valid)."""
    checks: list[Column] = []
    for c in MEASURE_FEATURES:
        lo, hi = _bounds_for(c)
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (F.col(c) < F.lit(lo))
        if hi is not None:
            bad = bad | (F.col(c) > F.lit(hi))
        bad = bad | F.isnan(F.col(c))
        checks.append(F.when(F.col(c).isNotNull() & bad, F.lit(f"{c}_out_of_range")))
    checks.append(F.when(F.length("state") > STATE_MAX_LENGTH, F.lit("state_too_long")))
    checks.append(F.when(F.coalesce(*[F.col(c) for c in EXCESS_COLUMNS]).isNull(),
                         F.lit("no_excess_ratio")))
    return F.array_compact(F.array(*checks))


def with_request_errors(requests: DataFrame) -> DataFrame:
    """`errors`: rules a row breaks, after what its source found wrong with
    the types (`type_errors`, if the source has typed the rows)."""
    errors = request_errors()
    if "type_errors" in requests.columns:
        errors = F.concat(F.coalesce("type_errors", F.array().cast("array<string>")), errors)
    return requests.withColumn("errors", errors)


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rows without errors, and rows with their errors."""
    checked = with_request_errors(requests)
    valid = checked.filter(F.size("errors") == 0).drop("errors", "type_errors", "raw_record")
    rejected = checked.filter(F.size("errors") > 0)
    return valid, rejected


def clip_to_bounds(df: DataFrame) -> DataFrame:
    """Numeric coercion + clip by column suffix: ratios (their row mean, max
    and min too) 0..5, rates 0..100, discharges >= 0; NULL, NaN and text that
    is not a plain number stay missing."""
    out = {}
    for c, kind in df.dtypes:
        lo, hi = _bounds_for(c)
        if (lo, hi) != (None, None):
            value = tolerant_double(c) if kind == "string" else F.col(c).cast("double")
            out[c] = clip(nan_to_null(value), lo, hi)
    return df.withColumns(out)


def guard_batch(df: DataFrame, max_rows: int | None = 500) -> int:
    """Refuse an empty batch or one above `max_rows` (reads at most
    max_rows + 1 rows). Returns the checked row count."""
    n = (df.limit(max_rows + 1) if max_rows is not None else df).count()
    if n == 0:
        raise ValidationError("batch must not be empty")
    if max_rows is not None and n > max_rows:
        raise ValidationError(f"batch exceeds maximum of {max_rows} rows")
    return n
