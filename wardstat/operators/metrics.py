"""Binary-classification metrics as aggregations over (label, score) rows.

Counts come from one aggregation with partial aggregation per task; the
exact ROC AUC is a Mann-Whitney U statistic over distinct scores with ties
counted half, computed with distributed running sums (no global sort into
one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.operators.ranking import prefix_sums, range_bucket

CUT = 0.5


def _ratio(num, den):
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def confusion(scored: DataFrame, label: str = "label", score: str = "score",
              cut: float = CUT, by: list[str] | None = None) -> DataFrame:
    pred = F.col(score) >= F.lit(cut)
    y = F.col(label) == 1
    return scored.groupBy(*(by or [])).agg(
        F.count_if(pred & y).cast("long").alias("tp"),
        F.count_if(pred & ~y).cast("long").alias("fp"),
        F.count_if(~pred & y).cast("long").alias("fn"),
        F.count_if(~pred & ~y).cast("long").alias("tn"),
        F.avg(F.pow(F.col(score) - F.col(label).cast("double"), 2)).alias("brier_score"),
    )


def binary_metrics(scored: DataFrame, label: str = "label", score: str = "score",
                   cut: float = CUT, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 (positive class; 0 when
    undefined) and Brier score."""
    c = confusion(scored, label, score, cut, by)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        *(by or []), "tp", "fp", "fn", "tn",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "brier_score",
    )


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score",
            by: list[str] | None = None, min_buckets: int = 128,
            checkpoint: bool = True) -> DataFrame:
    """Exact ROC AUC with ties counted half, per `by` group.

    1. pos / neg counts per distinct score (partial aggregation, so a score
       shared by a third of the rows is still one row after the map side);
    2. running sum of negatives below each score, bucketed by approximate
       score quantiles;
    3. AUC = sum(pos * (neg_below + neg / 2)) / (P * N); NULL if P or N is 0.

    The per-score table (one row per distinct score and group) is
    checkpointed to the shared checkpoint folder: the quantile bounds and
    the running sums both read it instead of recomputing the input.
    """
    by = list(by or [])
    per_score = (scored.groupBy(*by, score)
                 .agg(F.count_if(F.col(label) == 1).cast("double").alias("pos"),
                      F.count_if(F.col(label) != 1).cast("double").alias("neg")))
    if checkpoint:
        per_score = per_score.checkpoint(eager=True)
    bucket = range_bucket(per_score, score, min_buckets=min_buckets)
    run = prefix_sums(per_score, [F.col(score)], {"neg_below": F.col("neg")}, bucket, by,
                      materialised=checkpoint)
    return (run.groupBy(*by)
            .agg(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * 0.5)).alias("_u"),
                 F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
            .select(*by, F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                                F.col("_u") / (F.col("_p") * F.col("_n"))).alias("auc")))


CLASS_NAMES = {0: "Low Risk", 1: "High Risk"}


def classification_report(scored: DataFrame, label: str = "label", score: str = "score",
                          cut: float = CUT) -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and
    support-weighted averages (rows: class names, accuracy, macro avg,
    weighted avg)."""
    c = confusion(scored, label, score, cut)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    total = tp + fp + fn + tn
    # class 1: positives; class 0: the same table read the other way round
    per = c.select(
        _ratio(tp, tp + fp).alias("p1"), _ratio(tp, tp + fn).alias("r1"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_1"), (tp + fn).alias("s1"),
        _ratio(tn, tn + fn).alias("p0"), _ratio(tn, tn + fp).alias("r0"),
        _ratio(2 * tn, 2 * tn + fn + fp).alias("f1_0"), (tn + fp).alias("s0"),
        _ratio(tp + tn, total).alias("acc"), total.alias("n"),
    )
    w0 = F.col("s0") / F.col("n")
    w1 = F.col("s1") / F.col("n")
    def row(name, p, r, f, n):
        return F.struct(F.lit(name).alias("class_name"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        n.cast("long").alias("support"))

    none = F.lit(None).cast("double")
    p0, p1, r0, r1 = F.col("p0"), F.col("p1"), F.col("r0"), F.col("r1")
    f0, f1 = F.col("f1_0"), F.col("f1_1")
    rows = F.array(
        row(CLASS_NAMES[0], p0, r0, f0, F.col("s0")),
        row(CLASS_NAMES[1], p1, r1, f1, F.col("s1")),
        row("accuracy", none, none, F.col("acc"), F.col("n")),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, F.col("n")),
        row("weighted avg", p0 * w0 + p1 * w1, r0 * w0 + r1 * w1, f0 * w0 + f1 * w1, F.col("n")),
    )
    return per.select(F.inline(rows)).select(
        "class_name", "precision", "recall", "f1", F.col("support").cast("long").alias("support"))


def cv_summary(fold_scores: DataFrame, metric: str = "auc", by: list[str] | None = None) -> DataFrame:
    """Mean and population standard deviation of per-fold metrics."""
    return fold_scores.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_folds"),
        F.avg(metric).alias(f"cv_{metric}_mean"),
        F.stddev_pop(metric).alias(f"cv_{metric}_std"),
    )


def metric_table(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Evaluation metrics as rows (metric, value, band) -- AUC, F1,
    precision, recall, Brier -- with the display band of each value."""
    from wardstat.functions.tiers import metric_band

    counts = binary_metrics(scored, label, score).selectExpr(
        "stack(4, 'f1', f1, 'precision', precision, 'recall', recall, "
        "'brier_score', brier_score) AS (metric, value)")
    auc = roc_auc(scored, label, score).select(F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    return auc.unionByName(counts).withColumn("band", metric_band("value"))
