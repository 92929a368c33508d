"""Long -> wide: one row per hospital, 6 measures x 4 metrics.

The pivot is a conditional aggregation: 24
`avg(CASE WHEN measure_short = m THEN value END)` plus `min` of name and
state per hospital. Spark plans the heavy level as partial (map-side) +
final hash aggregation, so a hospital with a huge number of rows is
pre-aggregated in every map task before it is shuffled.
`groupBy().pivot()` would scan and shuffle the long table twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.schemas import MEASURES, METRIC_SUFFIX, WIDE_MEASURE_COLUMNS


def _measure_sums() -> list:
    """Level 1: sum and count of each raw metric (8 fixed-width buffers)."""
    out = []
    for raw in METRIC_SUFFIX:
        out.append(F.sum(raw).alias(f"_s_{raw}"))
        out.append(F.count(raw).alias(f"_n_{raw}"))
    return out


def _spread() -> list:
    """Level 2: spread the per-measure buffers into 24 sum/count pairs."""
    out = []
    for raw, suffix in METRIC_SUFFIX.items():
        for m in MEASURES:
            hit = F.col("measure_short") == F.lit(m)
            out.append(F.sum(F.when(hit, F.col(f"_s_{raw}"))).alias(f"_s_{m}_{suffix}"))
            out.append(F.sum(F.when(hit, F.col(f"_n_{raw}"))).alias(f"_n_{m}_{suffix}"))
    return out


def _averages() -> list:
    return [F.when(F.col(f"_n_{c}") > 0, F.col(f"_s_{c}") / F.col(f"_n_{c}")).alias(c)
            for c in WIDE_MEASURE_COLUMNS]


def _meta_aggs() -> list:
    # The first non-null value per hospital is order-dependent in the source;
    # `min` is the deterministic choice (equal whenever the values agree).
    return [F.min("facility_name").alias("facility_name"), F.min("state").alias("state")]


def _any_count() -> F.Column:
    """Some of the 24 metrics has a value: one of the count buffers is > 0.

    Filtering on the buffers, before the averages are aliased, keeps the
    predicate small: a predicate over 24 aliased expressions pushed below
    the alias projection makes Catalyst's constraint inference copy it
    once per alias substitution.
    """
    return F.greatest(*[F.col(f"_n_{c}") for c in WIDE_MEASURE_COLUMNS]) > 0


def pivot_wide(clean: DataFrame) -> DataFrame:
    """Clean long table -> wide table (3 id columns + 24 metric columns).

    Null `facility_id` rows are dropped (grouping drops null keys) and a
    hospital whose 24 values are all missing disappears.

    Two levels:
    1. group by (facility_id, facility_name, state, measure_short): sum and
       count of the four metrics -- a hash aggregation with map-side
       partial aggregation over the raw rows and only 8 fixed-width
       buffers, so a hospital with a third of all rows is pre-aggregated
       in every map task and the generated code stays small;
    2. group the at most 6 x (name/state variants) rows per hospital by
       facility_id: min of name and state, 24 conditional sums of the
       buffers; average = sum / count.
    String `min` in the first level would force a sort-based aggregation
    of every raw row; here it only sees the small second level.
    """
    per_measure = (clean.filter(F.col("facility_id").isNotNull())
                   .groupBy("facility_id", "facility_name", "state", "measure_short")
                   .agg(*_measure_sums()))
    merged = per_measure.groupBy("facility_id").agg(*_meta_aggs(), *_spread())
    return (merged.filter(_any_count())
            .select("facility_id", "facility_name", "state", *_averages()))


def facility_meta(clean: DataFrame) -> DataFrame:
    """First non-null name and state per hospital (deterministic `min`).

    Distinct (id, name, state) first -- a hash aggregation on string keys
    -- so the string `min` only sees a few rows per hospital."""
    return (clean.filter(F.col("facility_id").isNotNull())
            .select("facility_id", "facility_name", "state").distinct()
            .groupBy("facility_id").agg(*_meta_aggs()))


def wide_metrics(clean: DataFrame) -> DataFrame:
    """The 24 metric columns per hospital, without metadata."""
    per_measure = (clean.filter(F.col("facility_id").isNotNull())
                   .groupBy("facility_id", "measure_short").agg(*_measure_sums()))
    return (per_measure.groupBy("facility_id").agg(*_spread())
            .filter(_any_count())
            .select("facility_id", *_averages()))


def wide_with_meta(clean: DataFrame) -> DataFrame:
    """Explicit form of the pivot: metadata inner-joined to the metrics.

    Both sides are hash-partitioned on `facility_id` by their own aggregation,
    so the join adds no further exchange.
    """
    return (facility_meta(clean)
            .join(wide_metrics(clean), "facility_id", "inner")
            .select("facility_id", "facility_name", "state", *WIDE_MEASURE_COLUMNS))
