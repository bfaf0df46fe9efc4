"""Monitoring of a message stream: window summaries, alerts, counters.

Detection is stateless (``operators.detection.annotate`` runs unchanged on a stream); state
appears only in the window aggregate and in the alert rate limit.  All functions but
``rate_limit_stream`` also work on tables, which is how they are checked.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenhand import lexicons as L
from evenhand.lexicons import DEFAULT_LEXICONS, Lexicons
from evenhand.operators.detection import annotate
from evenhand.operators.preparation import preprocess
from evenhand.options import DEFAULT_MONITOR, DEFAULT_OPTIONS, DetectOptions, MonitorOptions
from evenhand.sources.results import cut_text

SEVERE = ("high", "critical")
ALERT_SAMPLES, ALERT_CHARS = 3, 200


def micro_batches(monitor: MonitorOptions = DEFAULT_MONITOR, drain: bool = False) -> dict:
    """Trigger arguments: one micro-batch per interval, or everything there is, then stop."""
    return {"availableNow": True} if drain else {"processingTime": monitor.window}


def detect_stream(messages: DataFrame, lexicons: Lexicons = DEFAULT_LEXICONS,
                  options: DetectOptions = DEFAULT_OPTIONS) -> DataFrame:
    """Valid messages with their findings; the text is cleaned first and then dropped."""
    if "model_name" not in messages.columns:
        messages = messages.withColumn("model_name", F.lit(options.model_name))
    return annotate(preprocess(messages, options), None, lexicons, options)


def window_summary(annotated: DataFrame, monitor: MonitorOptions = DEFAULT_MONITOR
                   ) -> DataFrame:
    """Per window and model: messages, findings, rates, mean score, counts per type and
    severity.  In append mode a window comes out once the watermark has passed it."""
    found = F.col("findings")
    scores = F.aggregate(found, F.lit(0.0), lambda a, f: a + f["bias_score"])

    def counts(field, values):
        return [F.sum(F.size(F.filter(found, lambda f: f[field] == F.lit(v)))).cast("long")
                .alias(v) for v in values]

    # One watermark only: a stream that was deduplicated within it already has one.
    sums = annotated if not annotated.isStreaming else annotated.withWatermark(
        "ts", monitor.watermark)
    sums = sums.groupBy(F.window("ts", monitor.window).alias("w"), "model_name").agg(
        F.count(F.lit(1)).alias("processed_count"),
        F.sum(F.size(found)).cast("long").alias("finding_count"),
        F.count_if(F.size(found) > 0).alias("biased_samples"), F.sum(scores).alias("_score"),
        *counts("bias_type", L.BIAS_TYPES), *counts("severity", L.SEVERITIES))
    return sums.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("ts"), "model_name",
        "processed_count", "finding_count", "biased_samples",
        (F.col("finding_count") / F.col("processed_count")).alias("findings_per_sample"),
        (F.col("biased_samples") / F.col("processed_count")).alias("biased_sample_rate"),
        F.when(F.col("finding_count") > 0, F.col("_score") / F.col("finding_count"))
        .otherwise(0.0).alias("overall_bias_score"),
        *L.BIAS_TYPES, *L.SEVERITIES)


def alert_candidates(summaries: DataFrame, monitor: MonitorOptions = DEFAULT_MONITOR,
                     rate: str = "biased_sample_rate") -> DataFrame:
    """Windows with a high or critical finding and a rate above the threshold."""
    return summaries.where((F.col("high") + F.col("critical") > 0)
                           & (F.col(rate) > monitor.alert_rate))


def build_alert(candidates: DataFrame, findings: DataFrame, texts: DataFrame,
                monitor: MonitorOptions = DEFAULT_MONITOR) -> DataFrame:
    """Alert records with up to three sample findings.

    ``findings`` (doc_id, ts, model_name, ...) and ``texts`` (doc_id, text) are the stored
    tables; only findings of candidate windows are read on, the three per window are chosen
    by rank (cut down in every task before the shuffle), and the text is joined last.
    """
    severe = findings.where(F.col("severity").isin(*SEVERE)).select(
        "doc_id", "model_name", F.window("ts", monitor.window)["start"].alias("window_start"),
        "bias_type", "severity", "severity_rank", "confidence", "term", "category")
    keys = candidates.select("window_start", "model_name")
    w = Window.partitionBy("window_start", "model_name").orderBy(
        F.desc("severity_rank"), F.desc("confidence"), "doc_id", "bias_type",
        F.asc_nulls_first("term"), F.asc_nulls_first("category"))
    top = (severe.join(keys, ["window_start", "model_name"], "left_semi")
           .withColumn("n", F.row_number().over(w)).where(F.col("n") <= ALERT_SAMPLES))
    samples = top.join(texts.select("doc_id", cut_text(F.col("text"), ALERT_CHARS)
                                    .alias("text_sample")), "doc_id", "left")
    listed = samples.groupBy("window_start", "model_name").agg(F.sort_array(F.collect_list(
        F.struct("n", "bias_type", "severity", "confidence", "text_sample"))).alias("s"))
    sampled = candidates.join(listed, ["window_start", "model_name"], "left")
    return alert_record(sampled.withColumn("sample_instances", F.transform(
        "s", lambda x: x.dropFields("n"))))


def alert_record(windows: DataFrame) -> DataFrame:
    """Window summaries with ``sample_instances`` as alert records."""
    return windows.select(
        F.sha2(F.concat_ws("|", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"),
                           "model_name"), 256).alias("alert_id"),
        F.col("ts").alias("timestamp"), F.lit("bias_detected").alias("alert_type"),
        F.lit("high").alias("severity"), F.col("biased_sample_rate").alias("bias_rate"),
        F.col("overall_bias_score").alias("bias_score"),
        (F.col("high") + F.col("critical")).alias("critical_instances_count"), "model_name",
        "sample_instances")


# -- rate limit -------------------------------------------------------------


def _fold(times, seconds: int, last):
    """Greedy rule: send when at least ``seconds`` have passed since the last one sent."""
    sent = []
    for t in times:
        if last is None or t - last >= seconds:
            last = t
            sent.append(True)
        else:
            sent.append(False)
    return sent, last


def rate_limit(alerts: DataFrame, key: str = "model_name", ts: str = "ts",
               seconds: int = DEFAULT_MONITOR.alert_interval_seconds) -> DataFrame:
    """Alerts that are sent when each must follow the last sent one by ``seconds``.

    The rule depends on the last row sent, so no window function expresses it.  The input
    is one row per window and key, so its size is bounded by elapsed time, not by traffic.
    Rows are partitioned by key and sorted by time inside Spark (spilling if need be); a
    task streams through them batch by batch and holds one timestamp.
    """
    schema = alerts.schema

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, last = None, None
        for rows in batches:
            keep = []
            for k, t in zip(rows[key], rows["_t"], strict=True):
                if k != current:
                    current, last = k, None
                sent, last = _fold([t], seconds, last)
                keep.append(sent[0])
            yield rows[keep].drop(columns="_t")

    timed = alerts.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1e6))
    ordered = timed.repartition(key).sortWithinPartitions(key, "_t")
    return ordered.mapInPandas(stream, schema)


def rate_limit_stream(alerts: DataFrame, key: str = "model_name", ts: str = "ts",
                      seconds: int = DEFAULT_MONITOR.alert_interval_seconds) -> DataFrame:
    """The same rule on a stream: the last sent time is keyed state.  Rows of a micro-batch
    are taken in time order; rows at or before the last sent time are dropped."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def limit(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState
              ) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(ts)
        sent, last = _fold(rows[ts].astype("int64") / 1e9 if str(rows[ts].dtype).endswith("[ns]")
                           else rows[ts].map(lambda t: t.timestamp()), seconds, last)
        if last is not None:
            state.update((float(last),))
        yield rows[sent]

    return alerts.groupBy(key).applyInPandasWithState(
        limit, alerts.schema, "last double", "append", GroupStateTimeout.NoTimeout)


# -- counters over the summary table ----------------------------------------


def _so_far():
    return Window.partitionBy("model_name").orderBy("ts").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)


def running_totals(summaries: DataFrame) -> DataFrame:
    """Messages, findings and biased messages up to each window."""
    return summaries.select("model_name", "ts", *[
        F.sum(c).over(_so_far()).alias(f"total_{c}")
        for c in ("processed_count", "finding_count", "biased_samples")])


def processing_metrics(summaries: DataFrame, recent: int = 100) -> DataFrame:
    """Mean duration of the last ``recent`` windows, and severe findings per message so far.

    ``summaries`` has ``processing_duration`` besides the summary columns.
    """
    last = Window.partitionBy("model_name").orderBy("ts").rowsBetween(1 - recent, 0)
    severe = F.sum(F.col("high") + F.col("critical")).over(_so_far())
    processed = F.sum("processed_count").over(_so_far())
    return summaries.select(
        "model_name", "ts", processed.alias("processed_count"),
        severe.alias("bias_detected_count"),
        F.when(processed > 0, severe / processed).otherwise(0.0).alias("bias_detection_rate"),
        F.avg("processing_duration").over(last).alias("avg_processing_time"))


def monitor_status(metrics: DataFrame, alerts: DataFrame, rejects: DataFrame) -> DataFrame:
    """Newest counters per model with the number and time of alerts and the number of
    rejected messages.  ``alerts`` and ``rejects`` have model_name and ts."""
    latest = metrics.groupBy("model_name").agg(F.max_by(F.struct(
        "processed_count", "bias_detected_count", "bias_detection_rate",
        "avg_processing_time"), "ts").alias("m")).select("model_name", "m.*")
    sent = alerts.groupBy("model_name").agg(F.count(F.lit(1)).alias("alert_count"),
                                            F.max("ts").alias("last_alert_time"))
    errors = rejects.groupBy("model_name").agg(F.count(F.lit(1)).alias("error_count"))
    return (latest.join(sent, "model_name", "left").join(errors, "model_name", "left")
            .fillna(0, ["alert_count", "error_count"]))


def throughput_per_minute(annotated: DataFrame, minutes: int = 60, as_of=None) -> DataFrame:
    """Messages and share of biased messages in each of the last minutes, gaps filled."""
    newest = (F.lit(as_of).cast("timestamp") if as_of is not None
              else annotated.agg(F.max("ts").alias("t")).scalar())
    end = F.date_trunc("minute", newest)
    spark = annotated.sparkSession
    every = spark.range(minutes).select(
        (end - F.make_dt_interval(mins=F.col("id").cast("int"))).alias("minute"))
    oldest = end - F.expr(f"INTERVAL {minutes - 1} MINUTES")
    counts = (annotated.where((F.col("ts") >= oldest) & (F.col("ts") <= newest))
              .groupBy(F.date_trunc("minute", "ts").alias("minute"))
              .agg(F.count(F.lit(1)).alias("n"),
                   F.count_if(F.size("findings") > 0).alias("biased")))
    return every.join(counts, "minute", "left").select(
        "minute", F.coalesce("n", F.lit(0)).alias("throughput"),
        F.when(F.col("n") > 0, F.col("biased") / F.col("n")).otherwise(0.0).alias("bias_rate"))


def error_health(rejects: DataFrame, width: str = "1 hour") -> DataFrame:
    """Rejected messages per period: below 10 normal, below 50 elevated, else high."""
    counts = rejects.groupBy(F.window("ts", width)["start"].alias("period")).agg(
        F.count(F.lit(1)).alias("errors"))
    return counts.withColumn("health", F.when(F.col("errors") < 10, "normal")
                             .when(F.col("errors") < 50, "elevated").otherwise("high"))
