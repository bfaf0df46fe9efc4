"""The monitor as streams: raw messages in, stored windows, alerts, counters and batches out.

Every stateful step is keyed state of bounded size: a window's totals with its three worst findings,
a model's last sent alert, a model's totals with its last durations, the messages that wait for
their batch.  Messages are made compact within their row first, so that only numbers and a short sample
are shuffled.  The state needs the RocksDB provider: start the queries from ``stateful_session``.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQueryListener

from evenhand import lexicons as L
from evenhand.lexicons import DEFAULT_LEXICONS, Lexicons
from evenhand.operators.detection import annotate
from evenhand.operators.preparation import preprocess
from evenhand.options import DEFAULT_MONITOR, DEFAULT_OPTIONS, DetectOptions, MonitorOptions
from evenhand.sources.messages import once, parse_messages, split_valid
from evenhand.sources.results import cut_text
from evenhand.streaming.monitor import ALERT_CHARS, ALERT_SAMPLES, SEVERE, _fold, alert_record

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTED = [*L.BIAS_TYPES, *L.SEVERITIES]
WINDOW = ("kind string, w_start long, w_end long, model_name string, message_id string, "
          "processed long, findings long, biased long, score double, counts array<long>, top string")
TOTALS = "processed long, findings long, biased long, score double, counts array<long>, top string"


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session of its own whose streams keep their state in RocksDB; the given one's settings
    of shuffles and time zone hold, and nothing is set in the given one."""
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return own


# -- windows with their worst findings --------------------------------------


def _compact(messages: DataFrame, monitor: MonitorOptions, lexicons: Lexicons,
             options: DetectOptions) -> DataFrame:
    """One short row per message: its window, its numbers, up to three severe findings as JSON."""
    clean = preprocess(messages, options)
    found = annotate(clean.withColumn("_sample", cut_text(F.col("text"), ALERT_CHARS)), None,
                     lexicons, options)
    findings = F.col("findings")
    severe = F.transform(
        F.filter(findings, lambda f: f["severity"].isin(*SEVERE)), lambda f: F.struct(
            (-f["severity_rank"]).alias("r"), (-f["confidence"]).alias("c"),
            F.col("message_id").alias("k"), f["bias_type"].alias("bias_type"),
            f["term"].alias("t"), f["category"].alias("g"), f["severity"].alias("severity"),
            f["confidence"].alias("confidence"), F.col("_sample").alias("text_sample")))

    def count(field: str, value: str):
        return F.size(F.filter(findings, lambda f: f[field] == F.lit(value))).cast("long")

    counts = F.array(*[count("bias_type", t) for t in L.BIAS_TYPES],
                     *[count("severity", s) for s in L.SEVERITIES])
    window = F.window("ts", monitor.window)
    return found.select(
        F.unix_micros(window["start"]).alias("w_start"), F.unix_micros(window["end"]).alias("w_end"),
        "model_name", "message_id", F.size(findings).cast("long").alias("n"),
        F.aggregate(findings, F.lit(0.0), lambda a, f: a + f["bias_score"]).alias("score"),
        counts.alias("counts"),
        F.when(F.size(severe) > 0, F.to_json(F.slice(F.array_sort(severe), 1, ALERT_SAMPLES)))
        .alias("top"))


def _worst(first: list[dict], second: list[dict]) -> list[dict]:
    """The worst of two short lists; nulls, which JSON leaves out, come first."""
    return sorted(first + second, key=lambda d: (
        d["r"], d["c"], d.get("k") or "", d["bias_type"], d.get("t") is not None, d.get("t") or "",
        d.get("g") is not None, d.get("g") or ""))[:ALERT_SAMPLES]


class _Windows(StatefulProcessor):
    """Totals of a window and model until the watermark has passed it; later messages come
    out as late ones at once."""

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", TOTALS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start, end, model = key
        if end // 1000 <= timerValues.getCurrentWatermarkInMs():
            for df in rows:
                yield _window_rows(len(df), kind="late", w_start=start, w_end=end, model_name=model,
                                   message_id=df["message_id"].tolist())
            return
        if self.totals.exists():
            processed, findings, biased, score, counts, top = self.totals.get()
            counts, top = np.array(counts, np.int64), json.loads(top)
        else:
            processed, findings, biased, score = 0, 0, 0, 0.0
            counts, top = np.zeros(len(COUNTED), np.int64), []
            self.handle.registerTimer(end // 1000 - 1)
        for df in rows:
            processed += len(df)
            findings += int(df["n"].sum())
            biased += int((df["n"] > 0).sum())
            score += float(df["score"].sum())
            counts = counts + np.sum([np.asarray(c, np.int64) for c in df["counts"]], axis=0)
            for listed in df["top"].dropna():
                top = _worst(top, json.loads(listed))
        self.totals.update((processed, findings, biased, score, counts.tolist(), json.dumps(top)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, end, model = key
        processed, findings, biased, score, counts, top = self.totals.get()
        self.totals.clear()
        yield _window_rows(1, kind="window", w_start=start, w_end=end, model_name=model,
                           processed=processed, findings=findings, biased=biased, score=score,
                           counts=[list(counts)], top=top)


def _window_rows(n: int, **values) -> pd.DataFrame:
    names = [f.split()[0] for f in WINDOW.split(", ")]
    rows = pd.DataFrame({c: values.get(c) for c in names}, index=range(n), dtype=object)
    numbers = ["w_start", "w_end", "processed", "findings", "biased"]
    return rows.astype({**{c: "Int64" for c in numbers}, "score": "Float64"})


class _Limit(StatefulProcessor):
    """Marks the alerts that are sent; what isn't one passes through."""

    def __init__(self, seconds: int) -> None:
        self.seconds = seconds

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "last double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        waiting = []  # a row a window that may be alerted, no messages
        for df in rows:
            asked = df["candidate"].fillna(False).astype(bool)
            yield df[~asked].assign(sent=False)
            waiting.append(df[asked])
        alerts = pd.concat(waiting).sort_values("w_end")
        last = self.last.get()[0] if self.last.exists() else None
        sent, last = _fold((alerts["w_end"] / 1e6).tolist(), self.seconds, last)
        if last is not None:
            self.last.update((float(last),))
        yield alerts.assign(sent=sent)


def window_stream(raw: DataFrame, monitor: MonitorOptions = DEFAULT_MONITOR,
                  lexicons: Lexicons = DEFAULT_LEXICONS,
                  options: DetectOptions = DEFAULT_OPTIONS) -> DataFrame:
    """From raw messages (``value``) to closed windows and late messages, in append mode.

    ``kind`` is ``window`` or ``late``.  A window has its summary columns, ``sample_instances``
    (its three worst severe findings) and ``sent``: whether it is an alert that the rate limit lets
    pass.  A late message has its window and ``message_id``.  Invalid messages are left out:
    ``split_valid`` gives them.
    """
    valid, _ = split_valid(parse_messages(raw))
    named = valid.withColumnRenamed("source", "model_name").withWatermark("ts", monitor.watermark)
    rows = _compact(named, monitor, lexicons, options)
    closed = rows.groupBy("w_start", "w_end", "model_name").transformWithStateInPandas(
        _Windows(), WINDOW, "append", "EventTime")
    severe = sum((F.col("counts")[COUNTED.index(s)] for s in SEVERE[1:]),
                 F.col("counts")[COUNTED.index(SEVERE[0])])
    rate = F.col("biased") / F.col("processed")
    asked = closed.withColumn("candidate", F.coalesce(
        (F.col("kind") == "window") & (severe > 0) & (rate > monitor.alert_rate), F.lit(False)))
    limited = asked.groupBy("model_name").transformWithStateInPandas(
        _Limit(monitor.alert_interval_seconds), f"{WINDOW}, candidate boolean, sent boolean",
        "append", "None")
    samples = F.from_json("top", "array<struct<bias_type: string, severity: string, "
                                 "confidence: double, text_sample: string>>")
    return limited.select(
        "kind", F.timestamp_micros("w_start").alias("window_start"),
        F.timestamp_micros("w_end").alias("ts"), "model_name", "message_id",
        F.col("processed").alias("processed_count"), F.col("findings").alias("finding_count"),
        F.col("biased").alias("biased_samples"),
        (F.col("findings") / F.col("processed")).alias("findings_per_sample"),
        rate.alias("biased_sample_rate"),
        F.when(F.col("findings") > 0, F.col("score") / F.col("findings")).otherwise(0.0)
        .alias("overall_bias_score"),
        *[F.col("counts")[n].alias(c) for n, c in enumerate(COUNTED)],
        samples.alias("sample_instances"), "candidate", "sent")


def write_monitor(windows: DataFrame, checkpoint: str, path: str,
                  callbacks: list[Callable[[DataFrame, int], None]] | None = None,
                  trigger: dict | None = None):
    """Start the query that stores ``windows``, ``late`` and ``alerts`` below ``path``.

    A batch writes folders of its own, which a retry overwrites, so no row is there twice.  Each
    callback gets the batch's alerts and its number, once: its mark in the manifest is
    written before it is called, and ``done`` marks after it show which calls ended.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            parts = {
                "windows": batch.where("kind = 'window'").drop("kind", "message_id"),
                "late": batch.where("kind = 'late'").select("window_start", "model_name",
                                                            "message_id"),
                "alerts": alert_record(batch.where("sent")),
            }
            for name, part in parts.items():
                part.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
            for n, callback in enumerate(callbacks or []):
                once(batch.sparkSession, f"{path}/_calls/{batch_id}-{n}",
                     lambda call=callback: call(parts["alerts"], batch_id))
        finally:
            batch.unpersist()

    return (windows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).foreachBatch(store).start())


def stored_part(spark: SparkSession, path: str, part: str) -> DataFrame:
    """``windows``, ``late`` or ``alerts`` of ``write_monitor``, with the number of their batch."""
    return spark.read.parquet(f"{path}/{part}")


# -- counters -----------------------------------------------------------------

COUNTERS = ("model_name string, ts timestamp, total_processed_count long, total_finding_count long, "
            "total_biased_samples long, bias_detected_count long, avg_processing_time double")


class _Counters(StatefulProcessor):
    """Totals of a model and the durations of its latest windows, a ring of fixed length."""

    def __init__(self, recent: int) -> None:
        self.recent = recent

    def init(self, handle) -> None:
        self.state = handle.getValueState(
            "counters", "processed long, findings long, biased long, severe long, newest long, "
                        "times array<long>, durations array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        sums, newest, ring = [0, 0, 0, 0], None, []
        if self.state.exists():
            *sums, newest, times, durations = self.state.get()
            ring = list(zip(times, durations, strict=True))
        for df in rows:
            for n, c in enumerate(("processed_count", "finding_count", "biased_samples", "severe")):
                sums[n] += int(df[c].sum())
            new = zip(df["us"].tolist(), df["processing_duration"].tolist(), strict=True)
            ring = sorted(ring + list(new))[-self.recent:]
            newest = max(int(df["us"].max()), newest or 0)
        known = [d for _, d in ring if d == d]
        self.state.update((*sums, newest, [t for t, _ in ring], [float(d) for _, d in ring]))
        yield pd.DataFrame([(key[0], pd.Timestamp(newest, unit="us"), *sums,
                             sum(known) / len(known) if known else None)],
                           columns=[f.split()[0] for f in COUNTERS.split(", ")])


def counter_stream(summaries: DataFrame, recent: int = 100) -> DataFrame:
    """Per model the totals so far, severe findings and the mean duration of its last ``recent``
    windows, in update mode: a row for each model that a batch has windows of.

    ``summaries`` is a stream of window summaries with ``processing_duration``.  A null duration
    counts in the ring but not in the mean.
    """
    rows = summaries.select(
        "model_name", F.unix_micros("ts").alias("us"), "processed_count", "finding_count",
        "biased_samples", (F.col("high") + F.col("critical")).alias("severe"),
        F.col("processing_duration").cast("double").alias("processing_duration"))
    totals = rows.groupBy("model_name").transformWithStateInPandas(
        _Counters(recent), COUNTERS, "update", "None")
    processed, severe = F.col("total_processed_count"), F.col("bias_detected_count")
    return totals.withColumn("bias_detection_rate",
                             F.when(processed > 0, severe / processed).otherwise(0.0))


def write_counters(counters: DataFrame, checkpoint: str, path: str, trigger: dict | None = None):
    """Start the query that stores each batch's counters in a folder of its own."""
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (counters.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).foreachBatch(store).start())


def latest_counters(spark: SparkSession, path: str) -> DataFrame:
    """The counters of each model's newest batch."""
    rows = spark.read.parquet(path)
    fields = [c for c in rows.columns if c not in ("model_name", "batch_id")]
    return rows.groupBy("model_name").agg(F.max_by(F.struct(*fields), "batch_id").alias("c")).select(
        "model_name", "c.*")


# -- durations ------------------------------------------------------------------

PROGRESS = ("query_id string, batch_id long, started string, input_rows long, duration double, "
            "dropped_rows long")


class ProgressTable(StreamingQueryListener):
    """Stores a row for each batch of the streams of a session: its duration in seconds, the rows
    taken in and the rows that state dropped as late.

    Register it by ``spark.streams.addListener``.  A row a batch is all that passes the driver.
    Events come in a thread of their own; ``settle`` waits until those of ended queries are stored.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.open = threading.Semaphore(0)
        self.started = 0

    def onQueryStarted(self, event) -> None:
        self.started += 1

    def settle(self, timeout: float = 60) -> None:
        for _ in range(self.started):
            self.open.acquire(timeout=timeout)
        self.started = 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (str(p.id), p.batchId, p.timestamp, p.numInputRows,
               p.durationMs.get("triggerExecution", 0) / 1000,
               sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
        self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        self.open.release()


def with_durations(summaries: DataFrame, progress: DataFrame) -> DataFrame:
    """Summaries with ``batch_id`` and the duration of that batch as ``processing_duration``.

    ``progress`` holds the rows of one query; of a batch that was tried again the last one counts.
    """
    last = progress.groupBy("batch_id").agg(F.max_by("duration", "started").alias("processing_duration"))
    return summaries.join(last, "batch_id", "left")


# -- batches by count or time ---------------------------------------------------

BATCHED = "model_name string, batch_no long, message_id string, flush string"


class _Batches(StatefulProcessor):
    """Messages wait until there are ``size`` of them, or until ``seconds`` after the first."""

    def __init__(self, size: int, seconds: float) -> None:
        self.size, self.seconds = size, seconds

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "message_id string")
        self.state = handle.getValueState("state", "batch_no long, waiting long, deadline long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        number, n, deadline = self.state.get() if self.state.exists() else (0, 0, 0)
        held = [r[0] for r in self.waiting.get()] if n else []
        for df in rows:
            held += df["message_id"].tolist()
            while len(held) >= self.size:
                yield _batch(key[0], number, held[: self.size], "count")
                held, number = held[self.size:], number + 1
                if deadline:
                    self.handle.deleteTimer(deadline)
                    deadline = 0
        if held and not deadline:
            deadline = timerValues.getCurrentProcessingTimeInMs() + int(1000 * self.seconds)
            self.handle.registerTimer(deadline)
        self._keep(number, held, deadline)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, _, _ = self.state.get()
        held = [r[0] for r in self.waiting.get()]
        self._keep(number + 1, [], 0)
        yield _batch(key[0], number, held, "time")

    def _keep(self, number: int, held: list[str], deadline: int) -> None:
        if held:
            self.waiting.put([(m,) for m in held])
        else:
            self.waiting.clear()
        self.state.update((number, len(held), deadline))


def _batch(model, number: int, held: list[str], flush: str) -> pd.DataFrame:
    return pd.DataFrame({"model_name": model, "batch_no": number, "message_id": held, "flush": flush})


def message_batches(messages: DataFrame, size: int = 100, seconds: float = 60) -> DataFrame:
    """Messages (model_name, message_id) with the number of their model's batch: a batch ends at
    ``size`` messages or ``seconds`` after its first, whatever a trigger takes in.

    ``flush`` says which.  At most ``size - 1`` messages of a model wait in its state.
    """
    return messages.select("model_name", "message_id").groupBy(
        "model_name").transformWithStateInPandas(
            _Batches(size, seconds), BATCHED, "append", "ProcessingTime")
