"""Comparison of runs and report tables over findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenhand.operators.corpus import run_metrics

# Truncation unit of each report grain.
GRAINS = {"hourly": "hour", "daily": "day", "weekly": "week", "monthly": "month"}


def compare_models(annotated: DataFrame, by: tuple = ("run_id", "model_name")) -> DataFrame:
    """One summary row per run, counts per type and severity as columns, for all runs in
    one aggregate over texts with their findings."""
    return run_metrics(annotated, by)


def bias_trends(runs: DataFrame) -> DataFrame:
    """Rate and score of the runs of each model over time, with the change to the run
    before."""
    w = Window.partitionBy("model_name").orderBy("ts", "run_id")
    return runs.select(
        "model_name", "run_id", "ts", "biased_sample_rate", "overall_bias_score",
        (F.col("biased_sample_rate") - F.lag("biased_sample_rate").over(w)).alias("rate_change"),
        (F.col("overall_bias_score") - F.lag("overall_bias_score").over(w)).alias("score_change"),
    )


def hourly_trends(runs: DataFrame, width: str = "1 hour") -> DataFrame:
    """Pooled rate and finding-weighted mean score per time bucket."""
    return runs.groupBy(F.window("ts", width).alias("_w")).agg(
        F.sum("total_samples").alias("total_samples"),
        (F.sum("biased_samples") / F.sum("total_samples")).alias("biased_sample_rate"),
        (F.sum(F.col("overall_bias_score") * F.col("finding_count"))
         / F.sum("finding_count")).alias("overall_bias_score"),
    ).select(F.col("_w.start").alias("bucket"), "total_samples", "biased_sample_rate",
             "overall_bias_score")


def comparative_report(runs: DataFrame) -> DataFrame:
    """Totals, pooled rate, and the models with the lowest and highest rate; the earlier run
    wins ties both ways."""
    def first_by(order):
        return F.min(F.struct(order.alias("o"), F.col("ts"), F.col("run_id"),
                              F.col("model_name").alias("name"),
                              F.col("biased_sample_rate").alias("rate"),
                              F.col("overall_bias_score").alias("score")))

    one = runs.agg(
        F.coalesce(F.sum("total_samples"), F.lit(0)).alias("total_samples"),
        F.coalesce(F.sum("biased_samples"), F.lit(0)).alias("biased_samples"),
        first_by(F.col("biased_sample_rate")).alias("_best"),
        first_by(-F.col("biased_sample_rate")).alias("_worst"))
    return one.select(
        "total_samples", "biased_samples",
        F.when(F.col("total_samples") > 0, F.col("biased_samples") / F.col("total_samples"))
        .otherwise(0.0).alias("average_bias_rate"),
        *[F.col(f"_{side}.{field}").alias(f"{side}_{field}")
          for side in ("best", "worst") for field in ("name", "rate", "score")])


def value_distribution(findings: DataFrame, column: str) -> DataFrame:
    """Number of findings per value, most frequent first."""
    return (findings.groupBy(column).agg(F.count(F.lit(1)).alias("findings"))
            .orderBy(F.desc("findings"), F.asc(column)))


def filter_findings(findings: DataFrame, bias_type: str | None = None,
                    severity: str | None = None, min_confidence: float = 0.0) -> DataFrame:
    """Findings of a type and severity, if given, with at least the confidence."""
    out = findings.where(F.col("confidence") >= F.lit(float(min_confidence)))
    if bias_type is not None:
        out = out.where(F.col("bias_type") == bias_type)
    if severity is not None:
        out = out.where(F.col("severity") == severity)
    return out


def score_histogram(findings: DataFrame, bins: int = 20, low: float = 0.0, high: float = 1.0,
                    column: str = "confidence") -> DataFrame:
    """Findings per equal-width bin, empty bins included; scores at or beyond the ends count
    in the outer bins."""
    bucket = F.width_bucket(F.col(column), F.lit(low), F.lit(high), F.lit(bins))
    inside = F.greatest(F.lit(1), F.least(F.lit(bins), bucket)).cast("int")
    counts = (findings.where(F.col(column).isNotNull()).groupBy(inside.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    every = findings.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / bins
    return every.join(counts, "bin", "left").select(
        "bin", (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("findings"))


def sample_findings(findings: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` findings in a total order."""
    return (findings.orderBy("doc_id", "check_name", "group_type", "group_name", "term",
                             "pattern", "category")
            .limit(k).select("doc_id", "bias_type", "severity", "confidence", "bias_score"))


def period_report(runs: DataFrame, alerts: DataFrame, grain: str = "daily") -> DataFrame:
    """Texts, findings, alerts and mean score per period, and over all periods (null)."""
    unit = GRAINS[grain]
    per_run = runs.groupBy(F.date_trunc(unit, "ts").alias("period")).agg(
        F.sum("total_samples").alias("texts"), F.sum("finding_count").alias("findings"),
        F.sum(F.col("overall_bias_score") * F.col("finding_count")).alias("_score"))
    per_alert = alerts.groupBy(F.date_trunc(unit, "ts").alias("period")).agg(
        F.count(F.lit(1)).alias("alerts"))
    both = per_run.join(per_alert, "period", "full").fillna(
        0, ["texts", "findings", "alerts"]).fillna(0.0, ["_score"])
    return both.rollup("period").agg(
        F.sum("texts").alias("texts"), F.sum("findings").alias("findings"),
        F.sum("alerts").alias("alerts"),
        F.when(F.sum("findings") > 0, F.sum("_score") / F.sum("findings")).alias("avg_score"))
