"""Drift of the scores against a reference window.

Two forms of the same two measures, per window of the log:

* PSI, the population stability index over bins of the score, and
* KS, the largest distance between the two distribution functions.

`drift` counts in fixed bins (exact, one partial aggregation). `sketch_drift`
keeps one mergeable quantile sketch per window (KLL): windows of any length
come from merging stored sketches, bins follow the reference's own deciles,
and the log is never read again. Both aggregations work on batch frames and,
after `withWatermark`, on streams.

Rows without a time or a score take no part. An empty reference or an empty
log gives no rows. A share below `FLOOR` counts as `FLOOR` in the PSI, so
that an empty bin does not make it infinite.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 20
FLOOR = 1e-4
SKETCH_SIZE = 400         # rank error of a sketch: about 1.7 / k^0.9, under 0.9 %
POINTS = 100              # quantiles at which the KS of two sketches is taken


# ---------------------------------------------------------------------------
# Exact form: fixed bins
# ---------------------------------------------------------------------------

def score_bin(score: str | Column, bins: int = BINS) -> Column:
    """Bin 0..bins-1 of a score in [0, 1]; what lies outside joins the end bins."""
    s = F.col(score) if isinstance(score, str) else score
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(s * bins))).cast("int")


def score_histograms(log: DataFrame, duration: str = "1 day", time_col: str = "timestamp", value: str = "risk_score",
                     bins: int = BINS) -> DataFrame:
    """(window_start, window_end, n, counts): counts by bin of every window."""
    b = score_bin(value, bins)
    rows = log.where(F.col(time_col).isNotNull() & F.col(value).isNotNull() & ~F.isnan(value))
    return (rows.groupBy(F.window(F.col(time_col), duration).alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(b == i).alias(f"_c{i}") for i in range(bins)])
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n",
                    F.array(*[f"_c{i}" for i in range(bins)]).alias("counts")))


def reference_histogram(windows: DataFrame, bins: int = BINS) -> DataFrame:
    """One row (ref_n, ref_counts) from the histograms of the reference windows."""
    sums = windows.agg(F.sum("n").alias("ref_n"), *[F.sum(F.col("counts")[i]).alias(f"_c{i}") for i in range(bins)])
    return sums.where("ref_n > 0").select("ref_n", F.array(*[f"_c{i}" for i in range(bins)]).alias("ref_counts"))


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def psi(actual: list[Column], expected: list[Column]) -> Column:
    pairs = [(F.greatest(a, F.lit(FLOOR)), F.greatest(e, F.lit(FLOOR))) for a, e in zip(actual, expected)]
    return _sum([(a - e) * F.log(a / e) for a, e in pairs])


def drift_from_histograms(windows: DataFrame, reference: DataFrame, bins: int = BINS) -> DataFrame:
    """(window_start, window_end, n, psi, ks) of every window; `reference` is
    the one row of `reference_histogram`, which is joined as a constant."""
    both = windows.join(F.broadcast(reference), F.lit(True))  # one row
    actual = [F.col("counts")[i] / F.col("n") for i in range(bins)]
    expected = [F.col("ref_counts")[i] / F.col("ref_n") for i in range(bins)]
    gaps = [F.abs(_sum([F.col("counts")[j] for j in range(i + 1)]) / F.col("n")
                  - _sum([F.col("ref_counts")[j] for j in range(i + 1)]) / F.col("ref_n")) for i in range(bins)]
    return both.select("window_start", "window_end", "n", psi(actual, expected).alias("psi"), F.greatest(*gaps).alias("ks"))


def drift(log: DataFrame, reference: Column, duration: str = "1 day", time_col: str = "timestamp", value: str = "risk_score",
          bins: int = BINS) -> DataFrame:
    """Drift of every window against the windows for which `reference` (a
    condition on window_start and window_end) holds; the log is read once,
    both sides share its histograms."""
    windows = score_histograms(log, duration, time_col, value, bins)
    return drift_from_histograms(windows, reference_histogram(windows.where(reference), bins), bins)


# ---------------------------------------------------------------------------
# Sketches
# ---------------------------------------------------------------------------

def score_sketches(log: DataFrame, duration: str = "1 day", time_col: str = "timestamp", value: str = "risk_score",
                   size: int = SKETCH_SIZE) -> DataFrame:
    """(window_start, window_end, n, sketch): a quantile sketch of every window."""
    rows = log.where(F.col(time_col).isNotNull() & F.col(value).isNotNull() & ~F.isnan(value))
    return (rows.groupBy(F.window(F.col(time_col), duration).alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("sketch"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "sketch"))


def merge_sketches(windows: DataFrame, duration: str) -> DataFrame:
    """Sketches of longer windows from stored ones, without the log."""
    return (windows.groupBy(F.window(F.col("window_start"), duration).alias("w"))
            .agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "sketch"))


def reference_sketch(windows: DataFrame) -> DataFrame:
    """One row (ref_n, ref_sketch): the merged sketch of the reference windows."""
    return (windows.agg(F.sum("n").alias("ref_n"), F.kll_merge_agg_double("sketch").alias("ref_sketch")).where("ref_n > 0"))


def sketch_drift(windows: DataFrame, reference: DataFrame, bins: int = 10, points: int = POINTS) -> DataFrame:
    """(window_start, window_end, n, psi, ks) from sketches: bins between the
    reference's quantiles, KS over `points` of its quantiles (between two of
    them the distance grows by 1 / `points` at most). The reference is one
    row; its quantiles become constants, so `windows` may be a stream."""
    def quantiles(k: int) -> Column:
        return F.kll_sketch_get_quantile_double("ref_sketch", F.array(*[F.lit(i / k) for i in range(k + 1)]))

    ref = reference.select(quantiles(bins).alias("edges"), quantiles(points).alias("at"), "ref_sketch").first()  # one row
    if ref is None:
        return windows.where(F.lit(False)).select("window_start", "window_end", "n", F.lit(0.0).alias("psi"), F.lit(0.0).alias("ks"))
    edges, at = sorted(set(ref["edges"][1:-1])), sorted(set(ref["at"]))
    constant = F.lit(bytes(ref["ref_sketch"]))

    def cdf(sketch, values: list[float]) -> Column:
        return F.kll_sketch_get_rank_double(sketch, F.array(*[F.lit(float(v)) for v in values]))

    both = windows.withColumns({"cdf": cdf("sketch", edges), "ref_cdf": cdf(constant, edges),
                                "cdf_at": cdf("sketch", at), "ref_at": cdf(constant, at)})

    def shares(name: str) -> Column:
        upper = F.concat(F.col(name), F.array(F.lit(1.0)))
        lower = F.concat(F.array(F.lit(0.0)), F.col(name))
        return F.zip_with(upper, lower, lambda a, b: F.greatest(a - b, F.lit(FLOOR)))

    terms = F.zip_with(shares("cdf"), shares("ref_cdf"), lambda a, e: (a - e) * F.log(a / e))
    gaps = F.zip_with("cdf_at", "ref_at", lambda a, b: F.abs(a - b))
    return both.select("window_start", "window_end", "n",
                       F.aggregate(terms, F.lit(0.0), lambda s, x: s + x).alias("psi"), F.array_max(gaps).alias("ks"))


def psi_of(actual: list[float], expected: list[float]) -> float:
    """PSI of two lists of shares, for a single pair outside Spark."""
    pairs = [(max(a, FLOOR), max(e, FLOOR)) for a, e in zip(actual, expected, strict=True)]
    return sum((a - e) * math.log(a / e) for a, e in pairs)
