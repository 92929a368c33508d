"""Global ranks and running sums without a single-partition window.

`row_number() over (order by k)` with no partition puts every row in one
task. Here the ordered domain is cut into buckets by an expression that is
monotone in the sort key; each bucket is ranked on its own (one window
partition per bucket, spread over the cluster), and a per-bucket total
table (one row per bucket and partition value) gives every bucket its offset.

Used by the stratified split and folds (md5 order), the exact ROC AUC
(running sums over distinct scores) and the training state vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.schemas import N_FOLDS, RANDOM_STATE, TEST_FRACTION

_B = "_rk_bucket"


def hex_bucket(hex_col: Column, digits: int = 3) -> Column:
    """Leading hex digits of a hash string: 16**digits equal-mass buckets."""
    return F.substring(hex_col, 1, digits)


def first_char_bucket(text_col: Column) -> Column:
    """First character: monotone under binary string order."""
    return F.substring(text_col, 1, 1)


def range_bucket(df: DataFrame, col: str, target_rows: int = 2_000_000,
                 min_buckets: int = 128, accuracy: int = 10000) -> Column:
    """Monotone bucket of a numeric column; the number of buckets grows with
    the data: max(min_buckets, count / target_rows).

    Approximate quantiles cut the values into at most 128 ranges of about
    equal rows, so dense ranges are split and an outlier costs nothing; when
    more buckets are needed, every range is cut further into equal widths.
    One aggregation (quantiles, min, max, count) sizes all of it, and the
    expression is a balanced CASE tree of 128 leaves at most. NULL comes
    first, as in Spark's ascending order.
    """
    x = F.col(col).cast("double")
    probs = [i / 128 for i in range(1, 128)]
    row = df.agg(F.percentile_approx(x, probs, accuracy).alias("b"), F.min(x).alias("lo"),
                 F.max(x).alias("hi"), F.count(x).alias("n")).first()
    if not row["n"]:
        return F.lit(0).cast("long")
    bounds = sorted(set(row["b"]) - {row["hi"]})
    buckets = max(int(min_buckets), -(-int(row["n"]) // int(target_rows)))
    parts = -(-buckets // (len(bounds) + 1))  # equal widths within a range
    edges = [row["lo"], *bounds, row["hi"]]

    def leaf(i: int) -> Column:
        lo, hi = edges[i], edges[i + 1]
        base = F.lit(i * parts).cast("long")
        if parts == 1 or not lo < hi:
            return base
        cut = F.floor((x - F.lit(lo)) * F.lit(parts / (hi - lo))).cast("long")
        return base + F.least(F.greatest(cut, F.lit(0)), F.lit(parts - 1))

    def tree(i: int, j: int) -> Column:
        # ranges i..j; range k holds values in (edges[k], edges[k + 1]]
        if i == j:
            return leaf(i)
        mid = (i + j) // 2
        return F.when(x <= F.lit(bounds[mid]), tree(i, mid)).otherwise(tree(mid + 1, j))

    return F.when(x.isNull(), F.lit(-1).cast("long")).otherwise(tree(0, len(bounds)))


def prefix_sums(df: DataFrame, order_by: list, values: dict[str, Column], bucket: Column,
                partition_by: list[str] | None = None, inclusive: bool = False,
                totals: bool = False, materialised: bool = False) -> DataFrame:
    """Add, for every name in `values`, the sum of that value over the rows
    ordered before this row (within `partition_by`); `inclusive` also counts
    the row itself. `bucket` must be non-decreasing in `order_by`.

    With `totals`, also adds `<name>_total`, the sum over the whole partition.
    Ties in `order_by` are broken arbitrarily, as `row_number` does.

    Balance contract: one bucket is one window partition, so callers choose
    buckets that cannot concentrate rows -- hash prefixes of unique keys or
    `range_bucket`. NULL is a value like any other in `partition_by` and in
    the bucket (both sit in a struct key, which compares NULLs as equal).

    The offsets table has one row per (partition_by value, bucket). It is
    joined on the key the window is already partitioned by, without a hint:
    only the offsets are shuffled, and AQE broadcasts them when it has
    measured them to be small. `materialised=True` says that `df` is cheap to
    read again; the bucket totals then come from a partial aggregation of it.
    """
    parts = list(partition_by or [])
    part = F.struct(*parts) if parts else F.struct(F.lit(0).alias("all"))
    keyed = (df.withColumn(_B, F.struct(part.alias("part"), bucket.alias("bucket")))
             .withColumns({f"_rk_v_{k}": v for k, v in values.items()}))
    frame_end = Window.currentRow if inclusive else -1
    w_local = Window.partitionBy(_B).orderBy(*parts, *order_by).rowsBetween(Window.unboundedPreceding, frame_end)
    local = keyed.withColumns({
        f"_rk_l_{k}": F.coalesce(F.sum(f"_rk_v_{k}").over(w_local), F.lit(0)) for k in values})
    if materialised:
        per_bucket = keyed.groupBy(_B).agg(*[F.sum(f"_rk_v_{k}").alias(f"_rk_t_{k}") for k in values])
    else:
        # Totals from a window column of the same partitioning and ordering:
        # the aggregation needs no exchange and reuses the window's, so the
        # input is read and shuffled once.
        w_bucket = (Window.partitionBy(_B).orderBy(*parts, *order_by)
                    .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        local = local.withColumns({f"_rk_b_{k}": F.sum(f"_rk_v_{k}").over(w_bucket) for k in values})
        per_bucket = local.groupBy(_B).agg(*[F.max(f"_rk_b_{k}").alias(f"_rk_t_{k}") for k in values])
    w_off = Window.partitionBy(f"{_B}.part").orderBy(f"{_B}.bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset_cols = [F.coalesce(F.sum(f"_rk_t_{k}").over(w_off), F.lit(0)).alias(f"_rk_o_{k}") for k in values]
    if totals:
        w_all = Window.partitionBy(f"{_B}.part")
        offset_cols += [F.sum(f"_rk_t_{k}").over(w_all).alias(f"{k}_total") for k in values]
    out = local.join(per_bucket.select(_B, *offset_cols), _B)
    out = out.withColumns({k: F.col(f"_rk_o_{k}") + F.col(f"_rk_l_{k}") for k in values})
    return out.drop(_B, *[f"_rk_{p}_{k}" for k in values for p in ("v", "l", "b", "o")])


def row_number_distributed(df: DataFrame, order_by: list, bucket: Column,
                           partition_by: list[str] | None = None, name: str = "rn",
                           with_count: bool = False) -> DataFrame:
    """`row_number() over (partition by .. order by ..)`, 1-based, distributed.

    With `with_count`, also adds `<name>_total` = rows in the partition.
    """
    out = prefix_sums(df, order_by, {name: F.lit(1).cast("long")}, bucket,
                      partition_by, inclusive=True, totals=with_count)
    return out


# ---------------------------------------------------------------------------
# Stratified split and folds (seeded, reproducible in any engine with md5)
# ---------------------------------------------------------------------------

def split_key(id_col: str = "facility_id", seed: int = RANDOM_STATE) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def stratified_split(df: DataFrame, label: str = "high_readmission_risk",
                     id_col: str = "facility_id", test_fraction: float = TEST_FRACTION,
                     seed: int = RANDOM_STATE, n_folds: int = N_FOLDS) -> DataFrame:
    """Add `split` ('train'/'test') and `fold` (0..n_folds-1 for train rows).

    Within each label, rows are ranked by md5(id || ':' || seed); the first
    ceil(test_fraction * n_label) ranks are the test split, and the train rows
    take fold = (train rank - 1) mod n_folds, which stratifies the folds too.
    """
    keyed = df.withColumn("_rk_key", split_key(id_col, seed))
    ranked = row_number_distributed(keyed, [F.col("_rk_key"), F.col(id_col)],
                                    hex_bucket(F.col("_rk_key")), [label],
                                    name="_rk_rn", with_count=True)
    n_test = F.ceil(F.col("_rk_rn_total") * F.lit(test_fraction))
    is_test = F.col("_rk_rn") <= n_test
    return (ranked
            .withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
            .withColumn("fold", F.when(is_test, F.lit(None).cast("int"))
                        .otherwise(((F.col("_rk_rn") - n_test - 1) % F.lit(n_folds)).cast("int")))
            .drop("_rk_key", "_rk_rn", "_rk_rn_total"))


def sample_rows(df: DataFrame, n: int, id_col: str = "facility_id",
                seed: int = RANDOM_STATE) -> DataFrame:
    """min(n, rows) rows in a seeded pseudo-random order.

    A top-n by md5(id, seed): Spark plans `TakeOrderedAndProject`, keeping at
    most n rows per task, with no full sort and no shuffle of the input.
    """
    return df.orderBy(split_key(id_col, seed), F.col(id_col)).limit(n)
