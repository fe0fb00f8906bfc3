"""Classifier evaluation.

Inputs are a labelled score table (label 0/1, probability). Counts are one
aggregation; AUC and ROC points are computed from per-score counts with
distributed running totals, never by ranking all rows in one task.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import rules as R
from .ranking import running_totals


def _safe_div(num, den):
    return F.when(den > 0, num.cast(T.DoubleType()) / den.cast(T.DoubleType())).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "label", prob: str = "probability",
                     threshold: float = 0.5) -> DataFrame:
    y = F.col(label) == 1
    yhat = F.col(prob) >= threshold
    return df.agg(
        F.count_if(y & yhat).alias("tp"), F.count_if(~y & yhat).alias("fp"),
        F.count_if(~y & ~yhat).alias("tn"), F.count_if(y & ~yhat).alias("fn"))


def confusion_metrics(df: DataFrame, label: str = "label", prob: str = "probability",
                      threshold: float = 0.5) -> DataFrame:
    """Counts, precision, recall, F1 and accuracy at ``threshold`` (A15);
    a zero denominator gives 0."""
    c = confusion_counts(df, label, prob, threshold)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return c.select(
        "tp", "fp", "tn", "fn",
        R.round_half_up(_safe_div(tp, tp + fp), 4).alias("precision"),
        R.round_half_up(_safe_div(tp, tp + fn), 4).alias("recall"),
        R.round_half_up(_safe_div(2 * tp, 2 * tp + fp + fn), 4).alias("f1_score"),
        R.round_half_up(_safe_div(tp + tn, tp + fp + tn + fn), 4).alias("accuracy"))


def classification_report(df: DataFrame, label: str = "label", prob: str = "probability",
                          threshold: float = 0.5,
                          names=("stays", "churns")) -> DataFrame:
    """Per-class precision/recall/F1/support plus macro and weighted
    averages (A17), as rows."""
    c = confusion_counts(df, label, prob, threshold)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    # class 1 uses (tp, fp, fn); class 0 mirrors it with (tn, fn, fp)
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f0 = _safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    n = (s0 + s1).cast(T.DoubleType())
    wide = c.select(
        p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1.alias("f1"), s1.alias("s1"),
        ((p0 + p1) / 2).alias("pm"), ((r0 + r1) / 2).alias("rm"), ((f0 + f1) / 2).alias("fm"),
        _safe_div(p0 * s0 + p1 * s1, n).alias("pw"), _safe_div(r0 * s0 + r1 * s1, n).alias("rw"),
        _safe_div(f0 * s0 + f1 * s1, n).alias("fw"), (s0 + s1).alias("sn"))
    long = wide.selectExpr(
        f"stack(4, '{names[0]}', p0, r0, f0, s0, '{names[1]}', p1, r1, f1, s1,"
        " 'macro avg', pm, rm, fm, sn, 'weighted avg', pw, rw, fw, sn)"
        " AS (class, precision, recall, f1_score, support)")
    return long.select("class",
                       *[R.round_half_up(x, 4).alias(x) for x in ("precision", "recall", "f1_score")],
                       F.col("support").cast(T.LongType()).alias("support"))


def score_counts(df: DataFrame, label: str = "label", prob: str = "probability") -> DataFrame:
    """(score, pos, neg): one row per distinct score; partial aggregation."""
    return df.groupBy(F.col(prob).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) != 1).alias("neg"))


def auc(df: DataFrame, label: str = "label", prob: str = "probability") -> DataFrame:
    """Area under the ROC curve (A16) by the rank-sum formula with average
    ranks for ties: sum over scores of pos * (neg below + neg/2), / (P*N)."""
    rt = running_totals(score_counts(df, label, prob), "score", ["pos", "neg"])
    below = F.col("cum_neg") - F.col("neg")
    agg = rt.agg(
        F.sum(F.col("pos") * (below.cast(T.DoubleType()) + F.col("neg") * 0.5)).alias("_u"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    return agg.select(
        "positives", "negatives",
        R.round_half_up(F.when((F.col("positives") > 0) & (F.col("negatives") > 0),
                               F.col("_u") / (F.col("positives") * F.col("negatives")).cast(T.DoubleType())),
                        6).alias("auc_roc"))


def roc_points(df: DataFrame, label: str = "label", prob: str = "probability") -> DataFrame:
    """One ROC point per distinct score, thresholds descending."""
    rt = running_totals(score_counts(df, label, prob), "score", ["pos", "neg"], descending=True)
    return rt.select(
        F.col("score").alias("threshold"),
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        R.round_half_up(_safe_div(F.col("cum_neg"), F.col("total_neg")), 6).alias("fpr"),
        R.round_half_up(_safe_div(F.col("cum_pos"), F.col("total_pos")), 6).alias("tpr"))


def roc_curve_min(df: DataFrame, label: str = "label", prob: str = "probability") -> DataFrame:
    """The ROC curve without points on a straight line between their neighbours.

    A distinct score adds (neg, pos) to the point before it, so its point lies
    on a line exactly where the next score adds the same; first and last
    points stay. Starts at (0, 0) with a NULL threshold.
    """
    rt = running_totals(score_counts(df, label, prob), "score", ["pos", "neg"], descending=True,
                        neighbours=["pos", "neg"])
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    bend = (F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg")))
    points = rt.where(first | bend).select(
        F.col("score").alias("threshold"),
        R.round_half_up(_safe_div(F.col("cum_neg"), F.col("total_neg")), 6).alias("fpr"),
        R.round_half_up(_safe_div(F.col("cum_pos"), F.col("total_pos")), 6).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(None).cast(T.DoubleType()).alias("threshold"),
                                            F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def evaluation_record(df: DataFrame, label: str = "label", prob: str = "probability",
                      train_size: int | None = None, model_version: str = "1.0.0",
                      trained_at=None) -> DataFrame:
    """One metrics row (M6): AUC, F1, precision, recall, sizes, version, time."""
    cm = confusion_metrics(df, label, prob)
    a = auc(df, label, prob)
    # the AUC is a one-row aggregate: a scalar subquery, not a join
    return (cm.withColumn("auc_roc", a.select("auc_roc").scalar())
              .select(R.round_half_up("auc_roc", 4).alias("auc_roc"), "f1_score", "precision",
                      "recall",
                      F.lit(train_size).cast(T.LongType()).alias("train_size"),
                      (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("test_size"),
                      F.lit(model_version).alias("model_version"),
                      R.as_of_literal(trained_at).alias("trained_at")))


def release_gate(metrics: DataFrame, threshold: float = S.AUC_THRESHOLD,
                 force: bool = False) -> DataFrame:
    """AUC >= threshold passes; a forced release is marked as such (M8)."""
    passed = F.col("auc_roc") >= F.lit(threshold)
    return metrics.select(
        "auc_roc", F.lit(threshold).alias("threshold"), passed.alias("passed"),
        F.when(passed, "promote").when(F.lit(force), "promote_forced")
         .otherwise("block").alias("action"))


def performance_drift(metrics: DataFrame, baseline_auc: float = S.AUC_BASELINE,
                      threshold: float = S.DRIFT_THRESHOLD) -> DataFrame:
    """X11: AUC against the baseline, same deviation rule as feature drift."""
    dev = R.relative_deviation(F.col("auc_roc"), F.lit(baseline_auc))
    return metrics.select(
        F.lit(baseline_auc).alias("baseline_auc"), "auc_roc",
        R.round_half_up(dev * 100.0, 2).alias("deviation_pct"),
        R.is_drifted(dev, threshold).alias("drifted"))


def business_impact(metrics: DataFrame) -> DataFrame:
    """Churners found at the model's recall, those kept, revenue saved
    (whole numbers, truncated)."""
    detected = F.floor(F.lit(float(S.SUBSCRIBERS * S.CHURN_RATE)) * F.col("recall")).cast(T.LongType())
    retained = F.floor(detected.cast(T.DoubleType()) * F.lit(S.RETENTION_RATE)).cast(T.LongType())
    return metrics.select(
        "recall",
        F.lit(int(S.SUBSCRIBERS * S.CHURN_RATE)).cast(T.LongType()).alias("expected_churners"),
        detected.alias("churners_detected"),
        retained.alias("subscribers_retained"),
        (retained * S.MONTHLY_REVENUE * 12).cast(T.LongType()).alias("revenue_saved"))
