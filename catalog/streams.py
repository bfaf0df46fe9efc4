"""Sources, sinks and monitor queries.

Messages are the documents with a derived time (20 seconds apart), and besides them a copy of every
17th without its timestamp.  Counters and alerts run over hourly windows of ``events``, where an
``error`` is a finding whose score is derived from ``value``; an event counts as rejected where a copy of
its message has no text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import base as B
from catalog import findings_sql as S
from catalog import text as TX
from catalog.base import CARRIER
from evenhand import lexicons as L
from evenhand.operators import detection as D
from evenhand.options import MonitorOptions
from evenhand.sources import messages as MS
from evenhand.sources import results as RS
from evenhand.sources import texts as TS
from evenhand.streaming import live as V
from evenhand.streaming import monitor as R

HOURLY = MonitorOptions(window="1 hour")
LIMIT = 3 * 3600


def _r(name, digits=9):
    return F.round(name, digits).alias(name)


def _stamp(column, name=None):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name or column)


# -- sources ----------------------------------------------------------------


def _text_lines(spark, sf):
    path = B.scratch_dir(spark)
    B.documents(spark, sf).select("text").write.text(path)
    return TS.read_text_lines(spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("lines")) \
        .select(F.md5("text").alias("digest"), "lines")


def _text_csv(spark, sf):
    """All documents, and besides them a row without text for every fifth."""
    path = B.scratch_dir(spark)
    rows = B.documents(spark, sf).select("doc_id", "lang", "text")
    blank = rows.where("doc_id % 5 = 0").select(
        (-1 - F.col("doc_id")).alias("doc_id"), "lang", F.lit(None).cast("string").alias("text"))
    (rows.unionByName(blank)
     .write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path))
    return TS.read_text_csv(spark, path, multi_line=True).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest"))


def _as_texts(spark, sf):
    out = TS.as_texts(B.table(spark, sf, "benchmark"), "text", "item_id")
    return out.select("doc_id", F.md5("text").alias("digest"))


def _union(spark, sf):
    parts = {
        "documents": TS.as_texts(B.table(spark, sf, "documents"), "text", "doc_id"),
        "benchmark": TS.as_texts(B.table(spark, sf, "benchmark"), "text", "item_id"),
        "conversations": TS.as_texts(B.table(spark, sf, "conversations").withColumn(
            "k", F.col("conv_id") * 1000 + F.col("turn")), "text", "k"),
    }
    return TS.union_datasets(parts).groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("texts"), F.sum(F.length("text")).alias("chars"))


def _round_trip(spark, sf):
    from catalog.corpus import run_table

    path = B.scratch_dir(spark)
    findings = D.detect_findings(B.carrier(spark, sf)).withColumn("run_id", F.col("source"))
    RS.write_results(findings, run_table(spark, sf), path, "json")
    stored, runs = RS.read_results(spark, path, "json")
    kept = stored.groupBy("run_id").agg(F.count(F.lit(1)).alias("findings"),
                                        F.sum("bias_score").alias("score"))
    return runs.join(kept, "run_id", "left").select(
        "run_id", "total_samples", "biased_samples", _r("overall_bias_score"),
        _stamp("ts"), "findings", _r("score", 4))


def _csv_export(spark, sf):
    path = B.scratch_dir(spark)
    texts = B.carrier(spark, sf)
    RS.write_findings_csv(D.detect_findings(texts), texts, path)
    out = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return out.select("bias_type", "severity", F.col("bias_score").cast("double").alias("bias_score"),
                      F.md5("text_sample").alias("sample"), "biased_terms", "language",
                      F.col("p_value").cast("double").alias("p_value"))


# -- messages ---------------------------------------------------------------


def _as_json(rows, key="doc_id", stamped=True):
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 20)
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss") if stamped else F.lit(None).cast("string")
    return rows.select(F.to_json(F.struct(
        "text", stamp.alias("timestamp"), F.expr(key).cast("string").alias("message_id"), "source"))
        .alias("value"))


def _copied(spark, sf):
    return B.carrier(spark, sf).where("doc_id % 17 = 0")


def _messages(spark, sf):
    return _as_json(B.carrier(spark, sf)).unionAll(
        _as_json(_copied(spark, sf), "-1 - doc_id", stamped=False))


def _split(spark, sf):
    valid, rejected = MS.split_valid(MS.parse_messages(_messages(spark, sf)))
    return valid.select("message_id", F.lit(True).alias("valid")).unionByName(
        rejected.select("message_id", F.lit(False).alias("valid")))


def _valid(spark, sf):
    valid, _ = MS.split_valid(MS.parse_messages(_messages(spark, sf)))
    return valid.withColumnRenamed("source", "model_name")


def _deduplicated(spark, sf):
    """A stream of the valid messages, every 17th of which comes twice; each leaves one row."""
    path = B.scratch_dir(spark)
    _messages(spark, sf).unionAll(_as_json(_copied(spark, sf))).write.text(f"{path}/in")
    raw = MS.read_message_stream(spark, "text", path=f"{path}/in")
    valid, _ = MS.split_valid(MS.parse_messages(raw))
    query = (MS.deduplicated(valid).select("message_id", F.md5("text").alias("digest"))
             .writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
             .trigger(availableNow=True).start(f"{path}/out"))
    query.awaitTermination()
    return spark.read.schema("message_id string, digest string").parquet(f"{path}/out").select(
        F.col("message_id").cast("long").alias("doc_id"), "digest")


def _detect_stream(spark, sf):
    found = D.explode_findings(R.detect_stream(_valid(spark, sf)))
    return found.select(F.col("message_id").cast("long").alias("doc_id"), "check_name",
                        "severity", _r("bias_score"), "group_name", "term", "category")


SUMMARY = ["processed_count", "finding_count", "biased_samples"]


def _summary_columns(df):
    return df.select(
        _stamp("window_start"), "model_name", *SUMMARY, _r("biased_sample_rate"),
        _r("overall_bias_score"), *L.BIAS_TYPES, *L.SEVERITIES)


def _window_summary(spark, sf):
    return _summary_columns(R.window_summary(R.detect_stream(_valid(spark, sf)), HOURLY))


def _stream_window_summary(spark, sf):
    """Messages from files through the streaming pipeline into a sink; only closed windows
    come out."""
    path = B.scratch_dir(spark)
    _messages(spark, sf).write.text(f"{path}/in")
    raw = MS.read_message_stream(spark, "text", path=f"{path}/in")
    valid, _ = MS.split_valid(MS.parse_messages(raw))
    annotated = R.detect_stream(valid.withColumnRenamed("source", "model_name"))
    query = MS.write_batch_summaries(
        R.window_summary(annotated, HOURLY), f"{path}/checkpoint", "json",
        R.micro_batches(drain=True), path=f"{path}/out")
    query.awaitTermination()
    lines = spark.read.schema("value string").json(f"{path}/out")
    schema = ("window_start timestamp, model_name string, processed_count long, "
              "finding_count long, biased_samples long, biased_sample_rate double, "
              "overall_bias_score double, "
              + ", ".join(f"{c} long" for c in [*L.BIAS_TYPES, *L.SEVERITIES]))
    return _summary_columns(lines.select(F.from_json("value", schema).alias("s")).select("s.*"))


# -- events -----------------------------------------------------------------


def _annotated_events(spark, sf):
    score = F.least(F.lit(1.0), F.col("value") / 20)
    one = D.finding("event", "cultural", score, F.array("event_type"), term=F.col("event_type"))
    return B.table(spark, sf, "events").select(
        F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("m"), F.col("user_id") % 5).alias("model_name"),
        F.when(F.col("event_type") == "error", F.array(one)).otherwise(D._none())
        .alias("findings"))


def _event_summaries(spark, sf):
    """Summaries; a window took as long as its events were apart."""
    events = _annotated_events(spark, sf)
    spans = events.groupBy(F.window("ts", HOURLY.window)["start"].alias("window_start"), "model_name").agg(
        (F.max(F.unix_seconds("ts")) - F.min(F.unix_seconds("ts"))).cast("double").alias("processing_duration"))
    return R.window_summary(events, HOURLY).join(spans, ["window_start", "model_name"])


def _candidates(spark, sf):
    return R.alert_candidates(_event_summaries(spark, sf))


def _alert_candidates(spark, sf):
    return _candidates(spark, sf).select(
        _stamp("window_start"), "model_name", _r("biased_sample_rate"), "high", "critical")


def _build_alert(spark, sf):
    return _alerts_of_events(spark, sf).select(
        "alert_id", _stamp("timestamp"), "model_name", _r("bias_rate"), _r("bias_score"),
        "critical_instances_count", F.size("sample_instances").alias("samples"), _sampled())


def _sent(spark, sf):
    return R.rate_limit(_candidates(spark, sf).select("model_name", "ts"), seconds=LIMIT)


def _rate_limit(spark, sf):
    return _sent(spark, sf).select("model_name", _stamp("ts"))


def _stream_rate_limit(spark, sf):
    path = B.scratch_dir(spark)
    _candidates(spark, sf).select("model_name", "ts").write.parquet(f"{path}/in")
    alerts = spark.readStream.schema("model_name string, ts timestamp").parquet(f"{path}/in")
    query = (R.rate_limit_stream(alerts, seconds=LIMIT).writeStream.format("parquet")
             .option("checkpointLocation", f"{path}/checkpoint")
             .trigger(availableNow=True).start(f"{path}/out"))
    query.awaitTermination()
    return spark.read.schema("model_name string, ts timestamp").parquet(f"{path}/out").select(
        "model_name", _stamp("ts"))


ALERT = ("alert_id string, timestamp timestamp, alert_type string, severity string, bias_rate double, "
         "bias_score double, critical_instances_count long, model_name string, sample_instances "
         "array<struct<bias_type: string, severity: string, confidence: double, text_sample: string>>")


def _sampled():
    return F.array_join(F.transform("sample_instances", lambda s: F.concat_ws(
        "/", s["severity"], F.md5(s["text_sample"]))), ",").alias("sampled")


def _alerts_of_events(spark, sf):
    texts = B.table(spark, sf, "events").select(
        F.col("event_id").alias("doc_id"), F.concat_ws(" ", "event_type", F.repeat("props", 30))
        .alias("text"))
    return R.build_alert(_candidates(spark, sf), D.explode_findings(_annotated_events(spark, sf)),
                         texts, HOURLY)


def _stream_alerts(spark, sf):
    """Alert records sent through ``foreachBatch`` to a sink and to a callback that stores them."""
    path = B.scratch_dir(spark)
    _alerts_of_events(spark, sf).write.parquet(f"{path}/in")
    alerts = spark.readStream.schema(ALERT).parquet(f"{path}/in")
    query = MS.write_alerts(
        alerts, f"{path}/checkpoint", "text",
        [lambda batch: batch.write.mode("append").parquet(f"{path}/seen")],
        R.micro_batches(drain=True), path=f"{path}/out")
    query.awaitTermination()
    sent = spark.read.text(f"{path}/out").select(F.from_json("value", ALERT).alias("a")).select("a.*")
    seen = spark.read.schema(ALERT).parquet(f"{path}/seen").select("alert_id", F.lit(1).alias("seen"))
    return sent.join(seen, "alert_id", "left").select(
        "alert_id", _stamp("timestamp"), "model_name", _r("bias_rate"), _r("bias_score"),
        "critical_instances_count", _sampled(), F.coalesce("seen", F.lit(0)).alias("seen"))


# -- the monitor as streams ---------------------------------------------------

LIVE = MonitorOptions(window="1 hour", alert_interval_seconds=LIMIT)


def _drained(spark, path, monitor=LIVE, callbacks=None):
    """What has come into ``path``/in goes through the monitor's stream and into its tables."""
    raw = MS.read_message_stream(spark, "text", path=f"{path}/in")
    V.write_monitor(V.window_stream(raw, monitor), f"{path}/checkpoint", f"{path}/out", callbacks,
                    R.micro_batches(drain=True)).awaitTermination()


def _live_alerts(spark, sf):
    """Raw messages to stored alert records in one stream."""
    path = B.scratch_dir(spark)
    _messages(spark, sf).write.text(f"{path}/in")
    _drained(V.stateful_session(spark), path)
    return V.stored_part(spark, f"{path}/out", "alerts").select(
        "alert_id", _stamp("timestamp"), "model_name", _r("bias_rate"), _r("bias_score"),
        "critical_instances_count", _sampled())


def _live_accounting(spark, sf):
    """Every message is in a window, late or invalid.

    Copies of every 17th message come in when the stream has taken in all others, and a last
    message a month later closes all windows but its own.
    """
    path, own = B.scratch_dir(spark), V.stateful_session(spark)
    _messages(spark, sf).write.text(f"{path}/in")
    _drained(own, path)
    _as_json(_copied(spark, sf), "'again ' || doc_id").write.mode("append").text(f"{path}/in")
    _drained(own, path)
    last = B.carrier(spark, sf).agg((F.max("doc_id") + 180 * 24 * 31).alias("doc_id")).select(
        "doc_id", F.lit("the end").alias("text"), F.lit("end").alias("source"))
    _as_json(last).write.mode("append").text(f"{path}/in")
    _drained(own, path)
    _, invalid = MS.split_valid(MS.parse_messages(spark.read.text(f"{path}/in")))
    windows = V.stored_part(spark, f"{path}/out", "windows")
    parts = [windows.select("model_name", F.lit("window").alias("part"), F.col("processed_count").alias("n")),
             V.stored_part(spark, f"{path}/out", "late").select("model_name", F.lit("late"), F.lit(1)),
             invalid.select("source", F.lit("invalid"), F.lit(1))]
    every = parts[0].unionAll(parts[1]).unionAll(parts[2])
    return every.groupBy("model_name", "part").agg(F.sum("n").cast("long").alias("messages"))


SUMMARIZED = ("window_start timestamp, ts timestamp, model_name string, processed_count long, finding_count "
              "long, biased_samples long, high long, critical long, processing_duration double")


def _live_counters(spark, sf):
    """Counters over a stream of summaries that stops after an half of them and goes on."""
    path, own = B.scratch_dir(spark), V.stateful_session(spark)
    summaries = _event_summaries(spark, sf).select([f.split()[0] for f in SUMMARIZED.split(", ")])
    middle = F.timestamp_seconds((F.min(F.unix_seconds("ts")) + F.max(F.unix_seconds("ts"))) / 2)
    early = F.col("ts") < summaries.agg(middle.alias("t")).scalar()
    for half in (early, ~early):
        summaries.where(half).write.mode("append").parquet(f"{path}/in")
        rows = own.readStream.schema(SUMMARIZED).parquet(f"{path}/in")
        V.write_counters(V.counter_stream(rows), f"{path}/checkpoint", f"{path}/out",
                         R.micro_batches(drain=True)).awaitTermination()
    return V.latest_counters(spark, f"{path}/out").select(
        "model_name", _stamp("ts"), *[f"total_{c}" for c in SUMMARY], "bias_detected_count",
        _r("bias_detection_rate"), _r("avg_processing_time"))


def _live_processing(spark, sf):
    """Processing metrics of the stream's windows with the measured durations of their batches;
    ``measured`` says that a mean lies between the shortest and the longest of them."""
    path, own = B.scratch_dir(spark), V.stateful_session(spark)
    _messages(spark, sf).write.text(f"{path}/in")
    listener = V.ProgressTable(own, f"{path}/progress")
    own.streams.addListener(listener)
    try:
        _drained(own, path)
        listener.settle()
    finally:
        own.streams.removeListener(listener)
    progress = spark.read.parquet(f"{path}/progress")
    windows = V.with_durations(V.stored_part(spark, f"{path}/out", "windows"), progress)
    mean = F.col("avg_processing_time")
    known = windows.groupBy("model_name").agg(F.min("processing_duration").alias("low"),
                                              F.max("processing_duration").alias("high"))
    return R.processing_metrics(windows).join(known, "model_name").select(
        "model_name", _stamp("ts"), "processed_count", "bias_detected_count",
        _r("bias_detection_rate"),
        ((mean > 0) & (mean >= F.col("low") - 1e-9) & (mean <= F.col("high") + 1e-9)).alias("measured"))


def _live_batches(spark, sf):
    """All messages in batches of 100 a model, what is left of a model after two seconds."""
    import time

    path, own = B.scratch_dir(spark), V.stateful_session(spark)
    messages = B.documents(spark, sf).select(F.col("source").alias("model_name"),
                                             F.col("doc_id").cast("string").alias("message_id"))
    messages.write.parquet(f"{path}/in")
    stream = own.readStream.schema("model_name string, message_id string").parquet(f"{path}/in")
    total = messages.count()
    query = (V.message_batches(stream, 100, 2).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{path}/checkpoint").trigger(processingTime="1 second")
             .start(f"{path}/out"))
    flushed, until = 0, time.time() + 600
    try:
        while flushed < total and time.time() < until and query.exception() is None:
            query.awaitTermination(2)
            if query.lastProgress and query.lastProgress["batchId"] > 0:
                flushed = spark.read.schema(V.BATCHED).parquet(f"{path}/out").count()
    finally:
        query.stop()
    batches = spark.read.schema(V.BATCHED).parquet(f"{path}/out").groupBy(
        "model_name", "batch_no", "flush").agg(F.count(F.lit(1)).alias("n"))
    return batches.groupBy("model_name", "flush", "n").agg(F.count(F.lit(1)).alias("batches"))


def _running(spark, sf):
    return R.running_totals(_event_summaries(spark, sf)).select(
        "model_name", _stamp("ts"), *[f"total_{c}" for c in SUMMARY])


def _metrics(spark, sf):
    return R.processing_metrics(_event_summaries(spark, sf))


def _processing(spark, sf):
    return _metrics(spark, sf).select(
        "model_name", _stamp("ts"), "processed_count", "bias_detected_count",
        _r("bias_detection_rate"), _r("avg_processing_time"))


def _rejects(spark, sf):
    """All events as messages, and besides them copies without text, which are rejected."""
    rows = B.table(spark, sf, "events").select(
        F.col("props").alias("text"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("event_id").alias("message_id"),
        F.concat(F.lit("m"), F.col("user_id") % 5).alias("source"))
    copies = rows.where(F.col("message_id") % 17 == 0).withColumn("text", F.lit(None).cast("string"))
    _, rejected = MS.split_valid(MS.parse_messages(MS.as_messages(rows.unionByName(copies))))
    return rejected.select(F.col("source").alias("model_name"), "ts")


def _status(spark, sf):
    return R.monitor_status(_metrics(spark, sf), _sent(spark, sf), _rejects(spark, sf)).select(
        "model_name", "processed_count", "bias_detected_count", _r("bias_detection_rate"),
        _r("avg_processing_time"), "alert_count", _stamp("last_alert_time"), "error_count")


def _throughput(spark, sf):
    return R.throughput_per_minute(_annotated_events(spark, sf)).select(
        _stamp("minute"), "throughput", _r("bias_rate"))


def _health(spark, sf):
    errors = _annotated_events(spark, sf).where(F.size("findings") > 0)
    return R.error_health(errors, "6 hours").select(_stamp("period"), "errors", "health")


def _recent(spark, sf):
    return MS.recent_summaries(_event_summaries(spark, sf)).select(
        "model_name", _stamp("ts"), "processed_count", "finding_count")


def _stored_summaries(spark, sf):
    """Summaries appended by a stream to a table of dates; those of 12 hours before a noon, from its dates alone."""
    path = B.scratch_dir(spark)
    summaries = _event_summaries(spark, sf).select([f.split()[0] for f in SUMMARIZED.split(", ")])
    summaries.write.parquet(f"{path}/in")
    rows = spark.readStream.schema(SUMMARIZED).parquet(f"{path}/in")
    MS.write_summaries(rows, f"{path}/checkpoint", f"{path}/out", R.micro_batches(drain=True)).awaitTermination()
    noon = spark.read.parquet(f"{path}/in").agg(
        (F.date_trunc("day", F.max("ts")) - F.expr("INTERVAL 12 HOURS")).alias("t")).first()[0]
    return MS.recent_summaries(spark.read.parquet(f"{path}/out"), "12 hours", noon).select(
        "model_name", _stamp("ts"), "processed_count", "finding_count")


QUERIES = {
    "stored_summaries": _stored_summaries,
    "read_text_lines": _text_lines,
    "read_text_csv": _text_csv,
    "as_texts": _as_texts,
    "union_datasets": _union,
    "results_round_trip": _round_trip,
    "findings_csv": _csv_export,
    "split_valid": _split,
    "deduplicated": _deduplicated,
    "detect_stream": _detect_stream,
    "window_summary": _window_summary,
    "stream_window_summary": _stream_window_summary,
    "alert_candidates": _alert_candidates,
    "build_alert": _build_alert,
    "rate_limit": _rate_limit,
    "stream_rate_limit": _stream_rate_limit,
    "stream_alerts": _stream_alerts,
    "live_alerts": _live_alerts,
    "live_accounting": _live_accounting,
    "live_counters": _live_counters,
    "live_processing_metrics": _live_processing,
    "live_batches": _live_batches,
    "running_totals": _running,
    "processing_metrics": _processing,
    "monitor_status": _status,
    "throughput_per_minute": _throughput,
    "error_health": _health,
    "recent_summaries": _recent,
}


# -- SQL --------------------------------------------------------------------

_AT = "TIMESTAMP '2024-01-01' + to_seconds(doc_id * 20)"
_LOW_MESSAGES = S.LOW_CARRIER.replace("lower(text)", f"lower({TX.preprocess_sql('text')})").replace(
    "AS low, language, source", "AS low, 'en' AS language, source") + ""
_FINDINGS = S.findings_cte(_LOW_MESSAGES)

_TYPE_COUNTS = ", ".join(f"count(f.doc_id) FILTER (f.bias_type = '{t}') AS {t}"
                         for t in L.BIAS_TYPES)
_LEVEL_COUNTS = ", ".join(f"count(f.doc_id) FILTER (f.severity = '{s}') AS {s}"
                          for s in L.SEVERITIES)


def _summary_sql(where: str = "") -> str:
    return f"""{_FINDINGS}, messages AS (SELECT doc_id, source AS model_name, {_AT} AS ts FROM low),
      s AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS w, model_name,
        count(DISTINCT m.doc_id) AS processed_count, count(f.doc_id) AS finding_count,
        count(DISTINCT f.doc_id) AS biased_samples, avg(bias_score) AS score,
        {_TYPE_COUNTS}, {_LEVEL_COUNTS}
        FROM messages m LEFT JOIN findings f USING (doc_id) GROUP BY ALL)
      SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, model_name, processed_count,
        finding_count, biased_samples,
        round(biased_samples / processed_count, 9) AS biased_sample_rate,
        round(coalesce(score, 0e0), 9) AS overall_bias_score,
        {', '.join([*L.BIAS_TYPES, *L.SEVERITIES])} FROM s {where}"""


_CLOSED = ("WHERE w + INTERVAL '1 hour' <= (SELECT max(ts) FROM messages) "
           "- INTERVAL '10 minutes'")

EVENTS = f"""ev AS (SELECT event_id AS doc_id, ts, 'm' || (user_id % 5) AS model_name, event_type,
      props, event_type = 'error' AS biased, least(1e0, value / 20) AS score FROM events),
    fe AS (SELECT *, {S.severity('score')} AS severity FROM ev WHERE biased),
    sm AS (SELECT time_bucket(INTERVAL '1 hour', ev.ts) AS w,
      time_bucket(INTERVAL '1 hour', ev.ts) + INTERVAL '1 hour' AS ts, ev.model_name AS model_name,
      count(*) AS processed_count, count(fe.doc_id) AS finding_count,
      count(fe.doc_id) AS biased_samples, count(fe.doc_id) / count(*) AS rate,
      coalesce(avg(fe.score), 0e0) AS score,
      count(*) FILTER (fe.severity = 'high') AS high,
      count(*) FILTER (fe.severity = 'critical') AS critical,
      epoch(max(date_trunc('second', ev.ts))) - epoch(min(date_trunc('second', ev.ts))) AS span
      FROM ev LEFT JOIN fe USING (doc_id) GROUP BY ALL),
    ca AS (SELECT * FROM sm WHERE high + critical > 0 AND rate > 0.2)"""

_SENT = f"""sent AS (SELECT model_name, min(ts) AS ts FROM ca GROUP BY model_name
    UNION ALL SELECT model_name, (SELECT min(c.ts) FROM ca c WHERE c.model_name = sent.model_name
      AND c.ts >= sent.ts + to_seconds({LIMIT})) FROM sent WHERE ts IS NOT NULL)"""


def _fmt(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column}"


_PROCESSED = """pm AS (SELECT model_name, ts, sum(processed_count) OVER a AS processed_count,
      sum(high + critical) OVER a AS bias_detected_count,
      avg(span) OVER (PARTITION BY model_name ORDER BY ts
        ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS avg_processing_time
    FROM sm WINDOW a AS (PARTITION BY model_name ORDER BY ts
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

# Closed windows of the messages, those that ask for an alert, and those that the limit lets pass.
_LIVE = f"""messages AS (SELECT doc_id, source AS model_name, {_AT} AS ts,
        time_bucket(INTERVAL '1 hour', {_AT}) AS w FROM low),
      windowed AS (SELECT m.*, f.* EXCLUDE (doc_id) FROM messages m JOIN findings f USING (doc_id)),
      closed AS (SELECT w, w + INTERVAL '1 hour' AS ts, m.model_name AS model_name,
        count(DISTINCT m.doc_id) AS processed_count, count(DISTINCT f.doc_id) / count(DISTINCT m.doc_id) AS rate,
        coalesce(avg(bias_score), 0e0) AS score,
        count(*) FILTER (severity IN ('high', 'critical')) AS severe
        FROM messages m LEFT JOIN findings f USING (doc_id) GROUP BY ALL
        HAVING w + INTERVAL '1 hour' <= (SELECT max(ts) FROM messages) - INTERVAL '10 minutes'),
      asked AS (SELECT * FROM closed WHERE severe > 0 AND rate > 0.2),
      sent AS (SELECT model_name, min(ts) AS ts FROM asked GROUP BY model_name
        UNION ALL SELECT model_name, (SELECT min(c.ts) FROM asked c WHERE c.model_name = sent.model_name
          AND c.ts >= sent.ts + to_seconds({LIMIT})) FROM sent WHERE ts IS NOT NULL)"""

SQL = {
    "read_text_lines": rf"""SELECT md5(t) AS digest, count(*) AS lines FROM (
        SELECT regexp_replace(unnest(regexp_split_to_array(text, '\r\n|\n|\r')),
          '^{TX.SPACE}+|{TX.SPACE}+$', '', 'g') AS t FROM documents) WHERE t <> '' GROUP BY t""",
    "read_text_csv": "SELECT doc_id, md5(text) AS digest FROM documents",
    "as_texts": "SELECT item_id AS doc_id, md5(text) AS digest FROM benchmark",
    "union_datasets": " UNION ALL ".join(
        f"SELECT '{t}' AS dataset_name, count(*) AS texts, sum(length(text)) AS chars FROM {t}"
        for t in ("documents", "benchmark", "conversations")),
    "findings_csv": f"""{S.findings_cte()} SELECT bias_type, severity, bias_score,
        md5(CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END)
          AS sample, replace(terms, ',', ', ') AS biased_terms, carrier.language AS language,
        1e0 AS p_value FROM findings JOIN carrier USING (doc_id)""",
    "split_valid": f"WITH {CARRIER} SELECT doc_id::VARCHAR AS message_id, true AS valid FROM carrier "
                   "UNION ALL SELECT (-1 - doc_id)::VARCHAR, false FROM carrier WHERE doc_id % 17 = 0",
    "deduplicated": f"WITH {CARRIER} SELECT doc_id, md5(text) AS digest FROM carrier",
    "detect_stream": f"""{_FINDINGS} SELECT doc_id, check_name, severity,
        round(bias_score, 9) AS bias_score, group_name, term, category FROM findings""",
    "window_summary": _summary_sql(),
    "stream_window_summary": _summary_sql(_CLOSED),
    "alert_candidates": f"""WITH {EVENTS} SELECT {_fmt('w', 'window_start')}, model_name,
        round(rate, 9) AS biased_sample_rate, high, critical FROM ca""",
    "build_alert": f"""WITH {EVENTS}, top AS (SELECT fe.*,
          time_bucket(INTERVAL '1 hour', fe.ts) AS w, row_number() OVER (
          PARTITION BY time_bucket(INTERVAL '1 hour', fe.ts), model_name
          ORDER BY CASE severity WHEN 'critical' THEN 0 ELSE 1 END, score DESC, doc_id) AS n
        FROM fe WHERE severity IN ('high', 'critical')),
        texts AS (SELECT *, event_type || ' ' || repeat(props, 30) AS text FROM top WHERE n <= 3),
        listed AS (SELECT w, model_name, count(*) AS samples, string_agg(severity || '/'
          || md5(CASE WHEN length(text) > 200
            THEN substring(text, 1, 200) || '...' ELSE text END), ',' ORDER BY n) AS sampled
          FROM texts GROUP BY ALL)
        SELECT sha256(strftime(w, '%Y-%m-%d %H:%M:%S') || '|' || model_name) AS alert_id,
          {_fmt('ts', 'timestamp')}, model_name, round(rate, 9) AS bias_rate,
          round(score, 9) AS bias_score, high + critical AS critical_instances_count,
          samples, sampled FROM ca JOIN listed USING (w, model_name)""",
    "rate_limit": f"WITH RECURSIVE {EVENTS}, {_SENT} SELECT model_name, {_fmt('ts')} FROM sent "
                  "WHERE ts IS NOT NULL",
    "stream_rate_limit": f"WITH RECURSIVE {EVENTS}, {_SENT} SELECT model_name, {_fmt('ts')} "
                         "FROM sent WHERE ts IS NOT NULL",
    "live_alerts": f"""{_FINDINGS.replace("WITH ", "WITH RECURSIVE ", 1)}, {_LIVE},
      top AS (SELECT *, row_number() OVER (PARTITION BY w, model_name ORDER BY
          CASE severity WHEN 'critical' THEN 0 ELSE 1 END, bias_score DESC, doc_id::VARCHAR, bias_type,
          term NULLS FIRST, category NULLS FIRST) AS n
        FROM windowed WHERE severity IN ('high', 'critical')),
      cleaned AS (SELECT doc_id, {TX.preprocess_sql('text')} AS text FROM carrier),
      listed AS (SELECT w, model_name, string_agg(severity || '/' || md5(CASE WHEN length(text) > 200
          THEN substring(text, 1, 200) || '...' ELSE text END), ',' ORDER BY n) AS sampled
        FROM top JOIN cleaned USING (doc_id) WHERE n <= 3 GROUP BY ALL)
      SELECT sha256(strftime(w, '%Y-%m-%d %H:%M:%S') || '|' || model_name) AS alert_id,
        {_fmt('ts', 'timestamp')}, model_name, round(rate, 9) AS bias_rate, round(score, 9) AS bias_score,
        severe AS critical_instances_count, sampled
      FROM asked JOIN listed USING (w, model_name) JOIN sent USING (model_name, ts)""",
    "live_accounting": f"""WITH {CARRIER}, messages AS (SELECT doc_id, source, {_AT} AS ts FROM carrier),
      parts AS (SELECT source, 'window' AS part FROM messages UNION ALL
        SELECT source, 'invalid' FROM messages WHERE doc_id % 17 = 0 UNION ALL
        SELECT source, CASE WHEN time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour'
          <= (SELECT max(ts) FROM messages) - INTERVAL '10 minutes' THEN 'late' ELSE 'window' END
        FROM messages WHERE doc_id % 17 = 0)
      SELECT source AS model_name, part, count(*) AS messages FROM parts GROUP BY ALL""",
    "live_counters": f"""WITH {EVENTS}, {_PROCESSED}, t AS (SELECT model_name, max(ts) AS ts,
        {', '.join(f'sum({c}) AS total_{c}' for c in SUMMARY)} FROM sm GROUP BY model_name)
      SELECT model_name, {_fmt('ts')}, {', '.join(f'total_{c}' for c in SUMMARY)}, bias_detected_count,
        round(bias_detected_count / processed_count, 9) AS bias_detection_rate,
        round(avg_processing_time, 9) AS avg_processing_time FROM t JOIN pm USING (model_name, ts)""",
    "live_processing_metrics": f"""{_FINDINGS.replace("WITH ", "WITH RECURSIVE ", 1)}, {_LIVE} SELECT model_name, {_fmt('ts')},
        sum(processed_count) OVER a AS processed_count, sum(severe) OVER a AS bias_detected_count,
        round(sum(severe) OVER a / sum(processed_count) OVER a, 9) AS bias_detection_rate, true AS measured
      FROM closed WINDOW a AS (PARTITION BY model_name ORDER BY closed.ts ROWS UNBOUNDED PRECEDING)""",
    "live_batches": """WITH n AS (SELECT source AS model_name, count(*) AS n FROM documents GROUP BY 1)
      SELECT model_name, 'count' AS flush, 100 AS n, n // 100 AS batches FROM n WHERE n >= 100 UNION ALL
      SELECT model_name, 'time', n % 100, 1 FROM n WHERE n % 100 > 0""",
    "running_totals": f"""WITH {EVENTS} SELECT model_name, {_fmt('ts')},
        {', '.join(f'sum({c}) OVER a AS total_{c}' for c in SUMMARY)} FROM sm
        WINDOW a AS (PARTITION BY model_name ORDER BY sm.ts ROWS UNBOUNDED PRECEDING)""",
    "processing_metrics": f"""WITH {EVENTS}, {_PROCESSED} SELECT model_name, {_fmt('ts')},
        processed_count, bias_detected_count,
        round(bias_detected_count / processed_count, 9) AS bias_detection_rate,
        round(avg_processing_time, 9) AS avg_processing_time FROM pm""",
    "monitor_status": f"""WITH RECURSIVE {EVENTS}, {_SENT}, {_PROCESSED},
        latest AS (SELECT * FROM pm QUALIFY row_number() OVER (PARTITION BY model_name
          ORDER BY ts DESC) = 1),
        al AS (SELECT model_name, count(ts) AS alert_count, max(ts) AS last_alert_time FROM sent
          GROUP BY model_name),
        er AS (SELECT model_name, count(*) AS error_count FROM ev WHERE doc_id % 17 = 0  -- the copies
          GROUP BY model_name)
        SELECT model_name, processed_count, bias_detected_count,
          round(bias_detected_count / processed_count, 9) AS bias_detection_rate,
          round(avg_processing_time, 9) AS avg_processing_time,
          coalesce(alert_count, 0) AS alert_count, {_fmt('last_alert_time')},
          coalesce(error_count, 0) AS error_count
        FROM latest LEFT JOIN al USING (model_name) LEFT JOIN er USING (model_name)""",
    "throughput_per_minute": f"""WITH {EVENTS}, e AS (SELECT max(ts) AS newest,
        date_trunc('minute', max(ts)) AS last FROM ev),
        mi AS (SELECT last - to_minutes(i) AS minute FROM e, (SELECT unnest(range(60)) AS i)),
        c AS (SELECT date_trunc('minute', ts) AS minute, count(*) AS n,
          count(*) FILTER (biased) AS b FROM ev GROUP BY 1)
        SELECT {_fmt('mi.minute', 'minute')}, coalesce(n, 0) AS throughput,
          round(coalesce(b / n, 0e0), 9) AS bias_rate FROM mi LEFT JOIN c USING (minute)""",
    "error_health": f"""WITH {EVENTS} SELECT
        {_fmt("time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')", 'period')},
        count(*) AS errors, CASE WHEN count(*) < 10 THEN 'normal' WHEN count(*) < 50
          THEN 'elevated' ELSE 'high' END AS health FROM ev WHERE biased GROUP BY 1""",
    "stored_summaries": f"""WITH {EVENTS}, n AS (SELECT date_trunc('day', max(ts)) - INTERVAL 12 HOURS AS noon FROM sm)
        SELECT model_name, {_fmt('sm.ts', 'ts')}, processed_count, finding_count FROM sm, n
        WHERE sm.ts > noon - INTERVAL 12 HOURS AND sm.ts <= noon""",
    "recent_summaries": f"""WITH {EVENTS} SELECT model_name, {_fmt('ts')}, processed_count,
        finding_count FROM sm WHERE sm.ts > (SELECT max(ts) FROM sm) - INTERVAL 24 HOURS""",
}


def _round_trip_sql() -> str:
    from catalog.corpus import ALL, RUNS

    return f"""{ALL}, {RUNS}, kept AS (SELECT source AS run_id, count(*) AS findings,
        sum(bias_score) AS score FROM findings JOIN low USING (doc_id) GROUP BY 1)
        SELECT run_id, total_samples, biased_samples,
          round(overall_bias_score, 9) AS overall_bias_score, {_fmt('ts')}, findings,
          round(score, 4) AS score FROM runs LEFT JOIN kept USING (run_id)"""


SQL["results_round_trip"] = _round_trip_sql()
SQL["stream_alerts"] = SQL["build_alert"].replace("samples, sampled FROM", "sampled, 1 AS seen FROM")
