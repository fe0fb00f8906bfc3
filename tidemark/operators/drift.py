"""Drift monitoring.

Feature means are one aggregation (NaN skipped, as pandas does), unpivoted
and joined to the baseline table, which has one row per monitored feature
and is broadcast. The daily timeline groups a scored snapshot table by day
in the same single pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import rules as R

FEATURES = list(S.BASELINE_STATS)


def baseline_table(spark: SparkSession, stats: dict | None = None) -> DataFrame:
    """feature, position, mean, std, min, max: one row per monitored feature."""
    stats = stats or S.BASELINE_STATS
    rows = [(f, i, *map(float, v)) for i, (f, v) in enumerate(stats.items())]
    return R.literal_table(
        spark, rows, "feature string, position int, baseline_mean double, baseline_std double, "
                     "baseline_min double, baseline_max double")


def monitored(df: DataFrame, stats: dict | None = None) -> list[str]:
    """Monitored features present in ``df``."""
    return [f for f in (stats or S.BASELINE_STATS) if f in df.columns]


def _status(drifted):
    return F.when(drifted, S.DRIFT_STATUS[True]).otherwise(S.DRIFT_STATUS[False])


def _means_long(df: DataFrame, feats: list[str], by: list[str]) -> DataFrame:
    aggs = [F.avg(R.nan_to_null(f)).alias(f"m{i}") for i, f in enumerate(feats)]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    stack = ", ".join(f"'{f}', m{i}" for i, f in enumerate(feats))
    return wide.selectExpr(*by, f"stack({len(feats)}, {stack}) AS (feature, current_mean)")


def feature_drift(df: DataFrame, by: list[str] | None = None, stats: dict | None = None,
                  threshold: float = S.DRIFT_THRESHOLD) -> DataFrame:
    """Per monitored feature (and per ``by`` group): baseline and current
    mean (4 dp), deviation in % (2 dp), drift flag and status (M12)."""
    by = by or []
    feats = monitored(df, stats)
    base = baseline_table(df.sparkSession, stats)
    joined = _means_long(df, feats, by).join(F.broadcast(base), "feature")
    dev = R.relative_deviation(F.col("current_mean"), F.col("baseline_mean"))
    drifted = R.is_drifted(dev, threshold)
    return joined.select(
        *by, "feature", "position",
        R.round_half_up("baseline_mean", 4).alias("baseline_mean"),
        R.round_half_up("current_mean", 4).alias("current_mean"),
        R.round_half_up(dev * 100.0, 2).alias("deviation_pct"),
        drifted.alias("drifted"), _status(drifted).alias("status"))


def positive_rate(prob: str = "churn_probability"):
    """Share of predictions >= 0.5 (A9); NaN counts as a negative."""
    p = F.col(prob)
    return F.avg(F.when(~F.isnan(p) & (p >= 0.5), 1.0).otherwise(0.0))


def prediction_drift(preds: DataFrame, prob: str = "churn_probability",
                     by: list[str] | None = None,
                     baseline_rate: float = S.BASELINE_CHURN_RATE,
                     threshold: float = S.DRIFT_THRESHOLD) -> DataFrame:
    """Predicted churn rate against the baseline rate."""
    by = by or []
    rate = positive_rate(prob).alias("rate")
    agg = preds.groupBy(*by).agg(rate) if by else preds.agg(rate)
    dev = F.abs(F.col("rate") - F.lit(baseline_rate)) / F.lit(baseline_rate)
    drifted = R.is_drifted(dev, threshold)
    return agg.select(
        *by,
        R.round_half_up(F.lit(baseline_rate), 4).alias("baseline_churn_rate"),
        R.round_half_up("rate", 4).alias("current_churn_rate"),
        R.round_half_up(dev * 100.0, 2).alias("deviation_pct"),
        drifted.alias("drifted"), _status(drifted).alias("status"))


def _report(features: DataFrame, prediction: DataFrame, by: list[str], as_of) -> DataFrame:
    flags = features.groupBy(*by).agg(
        F.bool_or("drifted").alias("any_feature_drift"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.struct("position", "feature"))))
         .alias("_d"))
    p = prediction.select(*by, F.col("drifted").alias("prediction_drifted"))
    if by:
        j = flags.join(p, by, "full_outer")
    else:
        # both sides are one-row aggregates: a scalar subquery, not a join
        j = flags.withColumn("prediction_drifted", p.select("prediction_drifted").scalar())
    return _finish_report(j, by, as_of)


def _finish_report(j: DataFrame, by: list[str], as_of) -> DataFrame:
    names = F.transform(F.coalesce(F.col("_d"), F.array()), lambda s: s["feature"])
    any_f = F.coalesce(F.col("any_feature_drift"), F.lit(False))
    pred = F.coalesce(F.col("prediction_drifted"), F.lit(False))
    alert = any_f | pred
    listed = F.when(pred, F.concat(names, F.array(F.lit("prediction")))).otherwise(names)
    return j.select(
        *by,
        R.as_of_literal(as_of).alias("generated_at"),
        alert.alias("overall_alert"),
        F.when(alert, "HIGH").otherwise("OK").alias("alert_level"),
        pred.alias("prediction_drifted"),
        F.array_join(names, ", ").alias("drifted_features"),
        F.when(alert, F.concat(F.lit(S.RETRAIN_TEXT), F.array_join(listed, ", ")))
         .otherwise(S.HEALTHY_TEXT).alias("recommendation"))


def drift_report(features_df: DataFrame, preds: DataFrame, as_of=None,
                 prob: str = "churn_probability") -> DataFrame:
    """Full report (M14): alert flag and level, drifted features in baseline
    order, and advice. ``prediction`` is named when the output rate drifted."""
    return _report(feature_drift(features_df), prediction_drift(preds, prob), [], as_of)


def drift_timeline(scored: DataFrame, day: str = "snapshot_date", as_of=None,
                   prob: str = "churn_probability", stats: dict | None = None,
                   threshold: float = S.DRIFT_THRESHOLD,
                   baseline_rate: float = S.BASELINE_CHURN_RATE) -> DataFrame:
    """One report per day over a scored snapshot table (M14 over a period)."""
    return _one_pass(scored, [day], as_of, positive_rate(prob), stats, threshold, baseline_rate)


def drift_report_scored(scored: DataFrame, as_of=None, prob: str = "churn_probability",
                        stats: dict | None = None, threshold: float = S.DRIFT_THRESHOLD,
                        baseline_rate: float = S.BASELINE_CHURN_RATE) -> DataFrame:
    """``drift_report`` where the probability is a column of the feature table:
    the table is read and aggregated once. Rows with a NULL probability (not
    scored) count for the feature means, not for the predicted rate. An empty
    table gives one row without an alert, as there."""
    rate = F.avg(F.when(F.col(prob).isNotNull(), F.when(~F.isnan(prob) & (F.col(prob) >= 0.5), 1.0).otherwise(0.0)))
    return _one_pass(scored, [], as_of, rate, stats, threshold, baseline_rate)


def _one_pass(scored: DataFrame, by: list[str], as_of, rate, stats: dict | None, threshold: float,
              baseline_rate: float) -> DataFrame:
    """Reports per ``by`` as one linear plan: a single aggregation gives the
    feature means and the predicted churn rate; the rate is checked by the same
    relative rule as a feature (baseline 0.25), so it joins the unpivoted means
    as one more row against the broadcast baseline, and one more grouping turns
    the flags into the report.
    """
    feats = monitored(scored, stats)
    wide = scored.groupBy(*by).agg(
        *[F.avg(R.nan_to_null(f)).alias(f"m{i}") for i, f in enumerate(feats)], rate.alias("m_pred"))
    stack = ", ".join([f"'{f}', m{i}" for i, f in enumerate(feats)] + ["'prediction', m_pred"])
    long = wide.selectExpr(*by, f"stack({len(feats) + 1}, {stack}) AS (feature, current_mean)")
    spark = scored.sparkSession
    base = baseline_table(spark, stats).select("feature", "position", "baseline_mean").unionByName(
        R.literal_table(spark, [("prediction", len(feats), float(baseline_rate))],
                        "feature string, position int, baseline_mean double"))
    dev = R.relative_deviation(F.col("current_mean"), F.col("baseline_mean"))
    flagged = (long.join(F.broadcast(base), "feature")
                   .withColumn("drifted", R.is_drifted(dev, threshold)))
    is_pred = F.col("feature") == "prediction"
    flags = flagged.groupBy(*by).agg(
        F.bool_or(F.col("drifted") & ~is_pred).alias("any_feature_drift"),
        F.bool_or(F.col("drifted") & is_pred).alias("prediction_drifted"),
        F.array_sort(F.collect_list(F.when(F.col("drifted") & ~is_pred,
                                           F.struct("position", "feature")))).alias("_d"))
    return _finish_report(flags, by, as_of)


def alert_days(timeline: DataFrame) -> DataFrame:
    """Days, alert days."""
    return timeline.agg(F.count(F.lit(1)).alias("days"),
                        F.count_if("overall_alert").alias("alert_days"))


def retrain_decision(report: DataFrame) -> DataFrame:
    """M16 as a table: retrain when the report alerts, with the reason."""
    return report.agg(F.bool_or("overall_alert").alias("retrain"),
                      F.max(F.when(F.col("overall_alert"), F.col("drifted_features")))
                       .alias("drifted_features"))


def should_retrain(report: DataFrame) -> bool:
    """The documented rule, drift starts retraining. One scalar."""
    return bool(report.agg(F.bool_or("overall_alert")).first()[0])


# --- X10: population stability index -----------------------------------------------

def psi(expected: DataFrame, actual: DataFrame, ranges: dict | None = None,
        bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """Population stability index per feature between two tables.

    ``ranges`` maps feature -> (lo, hi); the default is the baseline's
    min/max. Each range is cut into ``bins`` equal-width bins (values outside
    are clamped to the edge bins; NULL/NaN skipped); shares below ``floor``
    are raised to it; PSI = sum over bins of (a - e) * ln(a / e).
    All features are binned in one aggregation per table (unpivot, then
    count per (feature, bin)); the result tables have features x bins rows.
    """
    if ranges is None:
        ranges = {f: (v[2], v[3]) for f, v in S.BASELINE_STATS.items()}
    ranges = {f: r for f, r in ranges.items() if f in expected.columns and f in actual.columns}
    spark = expected.sparkSession

    def shares(df: DataFrame, name: str) -> DataFrame:
        cols = []
        for i, (f, (lo, hi)) in enumerate(ranges.items()):
            x = R.nan_to_null(f)
            width = (hi - lo) / bins
            b = F.least(F.greatest(F.floor((x - F.lit(float(lo))) / F.lit(width)), F.lit(0)),
                        F.lit(bins - 1)).cast(T.IntegerType())
            cols.append(F.struct(F.lit(f).alias("feature"), b.alias("bin")))
        long = df.select(F.explode(F.array(*cols)).alias("fb")).select("fb.*") \
                 .where(F.col("bin").isNotNull())
        counts = long.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
        # features x bins rows: a bounded table
        per_feature = Window.partitionBy("feature")
        return counts.select("feature", "bin",
                             (F.col("n") / F.sum("n").over(per_feature)).alias(name))

    grid = literal_table_grid(spark, list(ranges), bins)
    e, a = shares(expected, "e"), shares(actual, "a")
    j = (grid.join(F.broadcast(e), ["feature", "bin"], "left")
             .join(F.broadcast(a), ["feature", "bin"], "left"))
    ev = F.greatest(F.coalesce("e", F.lit(0.0)), F.lit(floor))
    av = F.greatest(F.coalesce("a", F.lit(0.0)), F.lit(floor))
    return j.groupBy("feature").agg(
        R.round_half_up(F.sum((av - ev) * F.log(av / ev)), 6).alias("psi"))


def literal_table_grid(spark: SparkSession, features: list[str], bins: int) -> DataFrame:
    """Every (feature, bin) pair: features x bins rows."""
    return R.literal_table(spark, [(f, b) for f in features for b in range(bins)],
                           "feature string, bin int")
