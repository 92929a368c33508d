"""Feature engineering on the wide table and on request rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.functions.numeric import count_above, count_present, row_max, row_mean, row_min, row_sum
from wardstat.operators.ranking import first_char_bucket, row_number_distributed
from wardstat.schemas import (
    DISCHARGE_COLUMNS, DROP_COLUMNS, EXCESS_COLUMNS, EXCESS_RATIO_THRESHOLD,
    FEATURE_TABLE_COLUMNS, MEASURE_FEATURES, PREDICTED_COLUMNS, SERVING_FEATURES, STATES, TARGET,
)

# A state vocabulary larger than this is joined by shuffle instead of broadcast.
MAX_BROADCAST_VOCAB = 100_000


def aggregate_feature_columns(null_counts: bool = False) -> dict[str, Column]:
    """The seven row-wise aggregates over the six measures.

    Means skip missing values; max/min use `greatest`/`least`, which skip
    NULLs. Counts are 0 when no ratio is present, or NULL with `null_counts`
    (the serving-side convention).
    """
    n_valid = count_present(EXCESS_COLUMNS)
    n_over = count_above(EXCESS_COLUMNS, EXCESS_RATIO_THRESHOLD)
    if null_counts:
        n_valid = F.when(n_valid > 0, n_valid)
        n_over = F.when(count_present(EXCESS_COLUMNS) > 0, n_over)
    return {
        "mean_excess_ratio": row_mean(EXCESS_COLUMNS),
        "max_excess_ratio": row_max(EXCESS_COLUMNS),
        "min_excess_ratio": row_min(EXCESS_COLUMNS),
        "n_measures_over_threshold": n_over,
        "n_valid_measures": n_valid,
        "mean_predicted_rate": row_mean(PREDICTED_COLUMNS),
        "total_discharges": row_sum(DISCHARGE_COLUMNS),
    }


def add_aggregate_features(wide: DataFrame, null_counts: bool = False) -> DataFrame:
    return wide.withColumns(aggregate_feature_columns(null_counts))


def state_key() -> Column:
    return F.coalesce(F.col("state"), F.lit("Unknown"))


def state_vocabulary(df: DataFrame) -> DataFrame:
    """Sorted distinct states (NULL -> 'Unknown') with 0-based codes.

    `state_key, state_encoded`; ranks are computed per first-character
    bucket, so no single task sees the whole vocabulary.
    """
    distinct = df.select(state_key().alias("state_key")).distinct()
    ranked = row_number_distributed(distinct, [F.col("state_key")],
                                    first_char_bucket(F.col("state_key")), name="_rn")
    return ranked.select("state_key", (F.col("_rn") - 1).cast("int").alias("state_encoded"))


def encode_state(df: DataFrame, vocabulary: DataFrame | None = None,
                 check_size: bool = False, max_broadcast: int = MAX_BROADCAST_VOCAB) -> DataFrame:
    """Add `state_encoded`: rank of the state among the sorted distinct states.

    The vocabulary is fitted on `df` unless given. With `check_size` (use it
    when the vocabulary is stored or `df` is materialised, so the count is
    cheap) it is counted and broadcast when within `max_broadcast` rows.
    Otherwise the join is left to AQE, which measures the vocabulary's
    shuffle output at run time and switches to a broadcast join when it is
    small; if it were large (many states) the sort-merge join stays, and it
    is not skewed then, with AQE's skew split as a further guard.
    """
    vocab = vocabulary if vocabulary is not None else state_vocabulary(df)
    right = vocab
    if check_size and vocab.count() <= max_broadcast:
        right = F.broadcast(vocab)
    return (df.withColumn("state_key", state_key())
            .join(right, "state_key", "left")
            .drop("state_key"))


def serving_state_code(state: str | Column = "state") -> Column:
    """Fixed 54-state list, upper-cased; unknown or missing -> 0.

    A literal map lookup, evaluated in codegen, with no join.
    """
    c = F.col(state) if isinstance(state, str) else state
    lookup = F.create_map(*[x for i, s in enumerate(STATES) for x in (F.lit(s), F.lit(i))])
    return F.coalesce(lookup[F.upper(c)], F.lit(0)).cast("int")


def add_target(df: DataFrame) -> DataFrame:
    """Drop hospitals without a mean ratio; label = mean ratio strictly > 1.0."""
    return (df.filter(F.col("mean_excess_ratio").isNotNull())
            .withColumn(TARGET, (F.col("mean_excess_ratio") > F.lit(EXCESS_RATIO_THRESHOLD)).cast("int")))


def feature_table(wide: DataFrame) -> DataFrame:
    """Wide -> aggregates -> state code -> label, in the source's order:
    the vocabulary is fitted before target-less hospitals are dropped.

    The wide table is read twice (vocabulary, join), so it is checkpointed:
    the pivot runs once, the vocabulary is counted cheaply and, within its
    bound, broadcast -- the hospitals are not shuffled on their state.
    """
    wide = add_aggregate_features(wide).checkpoint(eager=True)
    return add_target(encode_state(wide, check_size=True)).select(*FEATURE_TABLE_COLUMNS)


def model_input(features: DataFrame) -> DataFrame:
    """Drop ids, label and label-encoding aggregates (absent names ignored)."""
    return features.drop(*DROP_COLUMNS)


def align_features(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns in model order; absent -> NULL double, extra -> dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("double").alias(c)
                       for c in names])


def assemble_features(requests: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Serving-side features of request rows: the 24 measures, the seven
    aggregates with NULL counts when no ratio is given, and the fixed-list
    state code. Columns: `keep` + the 32 serving features (all double)."""
    keep = list(keep or [])
    aggs = aggregate_feature_columns(null_counts=True)
    cols = [F.col(c) for c in keep]
    cols += [F.col(c).cast("double").alias(c) for c in MEASURE_FEATURES]
    cols += [aggs[c].cast("double").alias(c) for c in aggs]
    cols += [serving_state_code("state").cast("double").alias("state_encoded")]
    out = requests.select(*cols)
    return out.select(*keep, *SERVING_FEATURES)


METRIC_TEMPLATES = {
    "excess_ratio": "observed / expected 30-day readmissions for {m}; above 1.0 is worse than expected",
    "predicted_rate": "predicted 30-day readmission rate (%) for {m}",
    "expected_rate": "expected 30-day readmission rate (%) for {m} given the case mix",
    "discharges": "eligible discharges for {m} in the measurement period",
}
AGGREGATE_DESCRIPTIONS = {
    "mean_excess_ratio": "mean excess ratio over the reported measures",
    "max_excess_ratio": "highest excess ratio over the reported measures",
    "min_excess_ratio": "lowest excess ratio over the reported measures",
    "n_measures_over_threshold": "number of measures with an excess ratio above 1.0",
    "n_valid_measures": "number of measures with an excess ratio",
    "mean_predicted_rate": "mean predicted readmission rate over the reported measures",
    "total_discharges": "eligible discharges summed over the six measures",
    "state_encoded": "state code (rank of the state among the sorted states)",
}


def feature_descriptions() -> list[tuple[str, str]]:
    """(feature, description) for every model-side feature, built from the
    measure labels and one template per metric."""
    from wardstat.schemas import MEASURE_LABELS, MEASURES, METRICS
    rows = [(f"{m}_{s}", METRIC_TEMPLATES[s].format(m=MEASURE_LABELS[m]))
            for m in MEASURES for s in METRICS]
    return rows + list(AGGREGATE_DESCRIPTIONS.items())


def feature_dictionary(columns: DataFrame, name_col: str = "column_name") -> DataFrame:
    """Left-join a per-feature frame to the description dimension (a fixed
    32-row table, broadcast); unknown names get an empty description."""
    dim = columns.sparkSession.createDataFrame(feature_descriptions(), f"{name_col} string, description string")
    return (columns.join(F.broadcast(dim), name_col, "left")
            .withColumn("description", F.coalesce(F.col("description"), F.lit(""))))
