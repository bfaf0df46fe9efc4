"""The monitor's streams against their table forms, across restarts and repeated batches."""

import datetime
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from evenhand.options import MonitorOptions
from evenhand.sources import messages as MS
from evenhand.streaming import live as V
from evenhand.streaming import monitor as R

MONITOR = MonitorOptions(window="30 minutes", alert_interval_seconds=3600)
BAD, FINE = "the man is lazy and women cannot drive", "fine words only"


def line(n, text=BAD, model="m", **fields):
    stamp = f"2024-01-{1 + n // 1440:02d}T{n // 60 % 24:02d}:{n % 60:02d}:00"
    return (json.dumps({"text": text, "timestamp": stamp, "message_id": str(n), "source": model} | fields),)


def put(spark, path, rows):
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(f"{path}/in")


def drain(spark, path, callbacks=None):
    raw = MS.read_message_stream(V.stateful_session(spark), "text", path=f"{path}/in")
    query = V.write_monitor(V.window_stream(raw, MONITOR), f"{path}/checkpoint", f"{path}/out", callbacks,
                            {"availableNow": True})
    query.awaitTermination()
    return query


def stored(spark, path, part):
    return sorted((r.asDict(True) for r in V.stored_part(spark, f"{path}/out", part).drop("batch_id").collect()), key=str)


def test_windows_equal_the_table_form(spark, tmp_path):
    path = str(tmp_path)
    rows = [line(n, BAD if n % 3 else FINE, f"m{n % 2}") for n in range(200)]
    put(spark, path, rows + [("broken",), (json.dumps({"text": BAD}),), line(7, message_id=None), line(8, source=None)])
    drain(spark, path)
    valid, _ = MS.split_valid(MS.parse_messages(spark.read.text(f"{path}/in")))
    table = R.window_summary(R.detect_stream(valid.withColumnRenamed("source", "model_name")), MONITOR)
    closed = table.where("ts <= timestamp'2024-01-01 03:09:00'")
    columns = [c for c in table.columns if c in V.stored_part(spark, f"{path}/out", "windows").columns]
    got = V.stored_part(spark, f"{path}/out", "windows").select(columns)
    def rounded(df):
        return sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.collect())
    assert rounded(got) == rounded(closed.select(columns)) and len(columns) > 12
    assert stored(spark, path, "late") == []
    limited = R.rate_limit(R.alert_candidates(table, MONITOR).where("ts <= timestamp'2024-01-01 03:09:00'").select("model_name", "ts"), seconds=3600)
    assert sorted((str(r["model_name"]), r["timestamp"]) for r in stored(spark, path, "alerts")) == sorted((str(r[0]), r[1]) for r in limited.collect())


def test_samples_are_the_worst_three(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, [line(n, "x" * 300 + " " + BAD if n == 3 else BAD) for n in range(10)] + [line(n, FINE) for n in range(10, 29)] + [line(2000, FINE)])
    drain(spark, path)
    record, = stored(spark, path, "alerts")
    samples = record["sample_instances"]
    assert len(samples) == 3 and {s["severity"] for s in samples} == {"critical"}
    assert all(len(s["text_sample"]) <= 203 for s in samples)
    assert record["alert_type"] == "bias_detected" and len(record["alert_id"]) == 64


def test_a_repeated_batch_gives_no_row_and_no_call_twice(spark, tmp_path):
    path, seen = str(tmp_path), []
    put(spark, path, [line(n) for n in range(200)])
    query = drain(spark, path, [lambda alerts, batch_id: seen.append((batch_id, alerts.count()))])
    before = {p: stored(spark, path, p) for p in ("windows", "late", "alerts")}
    assert before["alerts"] and sum(n for _, n in seen) == len(before["alerts"])
    last = max(int(f) for f in os.listdir(f"{path}/checkpoint/commits") if f.isdigit())
    for f in (f"{last}", f".{last}.crc"):  # as if the query was killed between its sink and its commit
        if os.path.exists(f"{path}/checkpoint/commits/{f}"):
            os.remove(f"{path}/checkpoint/commits/{f}")
    calls = list(seen)
    drain(spark, path, [lambda alerts, batch_id: seen.append((batch_id, alerts.count()))])
    assert {p: stored(spark, path, p) for p in before} == before
    assert seen[: len(calls)] == calls and len({b for b, _ in seen}) == len(seen)
    put(spark, path, [line(n) for n in range(200, 300)])
    drain(spark, path)
    windows = stored(spark, path, "windows")
    assert len({(w["window_start"], w["model_name"]) for w in windows}) == len(windows) > len(before["windows"])
    assert query.exception() is None


def test_every_message_is_counted(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, [line(n) for n in range(200)] + [("broken",)])
    drain(spark, path)
    put(spark, path, [line(n, message_id=f"again {n}") for n in (3, 3, 50, 150, 199)] + [(json.dumps({"text": "a", "timestamp": "soon"}),)])
    drain(spark, path)
    put(spark, path, [line(20_000, model="end")])
    drain(spark, path)
    late = stored(spark, path, "late")
    assert sorted(r["message_id"] for r in late) == ["again 150", "again 3", "again 3", "again 50"]
    counted = sum(w["processed_count"] for w in stored(spark, path, "windows"))
    _, invalid = MS.split_valid(MS.parse_messages(spark.read.text(f"{path}/in")))
    assert counted + len(late) + invalid.count() + 1 == spark.read.text(f"{path}/in").count()


def summaries(spark, n, model="m", start=0):
    base = datetime.datetime(2024, 1, 1)
    rows = [(base + datetime.timedelta(hours=k), model, 10, k % 4, k % 3, k % 2, k % 5 % 2, float(k) if k % 7 else None) for k in range(start, start + n)]
    return spark.createDataFrame(rows, "ts timestamp, model_name string, processed_count long, finding_count long, "
                                       "biased_samples long, high long, critical long, processing_duration double")


def test_counters_equal_the_table_form_across_a_restart(spark, tmp_path):
    path, own = str(tmp_path), V.stateful_session(spark)
    parts = [summaries(spark, 90), summaries(spark, 70, start=90).unionAll(summaries(spark, 3, "k"))]
    for part in parts:
        part.repartition(3).write.mode("append").parquet(f"{path}/in")
        rows = own.readStream.schema(part.schema).parquet(f"{path}/in")
        V.write_counters(V.counter_stream(rows), f"{path}/checkpoint", f"{path}/out", {"availableNow": True}).awaitTermination()
    table = spark.read.parquet(f"{path}/in")
    metrics = R.processing_metrics(table).join(R.running_totals(table), ["model_name", "ts"])
    want = {r["model_name"]: r for r in metrics.collect() if r["ts"] == (datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=159 if r["model_name"] == "m" else 2))}
    got = {r["model_name"]: r for r in V.latest_counters(spark, f"{path}/out").collect()}
    assert set(got) == {"m", "k"}
    for model, r in got.items():
        assert r["ts"] == want[model]["ts"]
        for c in ("total_processed_count", "total_finding_count", "total_biased_samples", "bias_detected_count"):
            assert r[c] == want[model][c]
        for c in ("bias_detection_rate", "avg_processing_time"):
            assert r[c] == pytest.approx(want[model][c])


def test_durations_come_from_the_progress(spark, tmp_path):
    path, own = str(tmp_path), V.stateful_session(spark)
    put(spark, path, [line(n) for n in range(200)])
    listener = V.ProgressTable(own, f"{path}/progress")
    own.streams.addListener(listener)
    try:
        raw = MS.read_message_stream(own, "text", path=f"{path}/in")
        query = V.write_monitor(V.window_stream(raw, MONITOR), f"{path}/checkpoint", f"{path}/out", None, {"availableNow": True})
        query.awaitTermination()
        listener.settle()
    finally:
        own.streams.removeListener(listener)
    progress = spark.read.parquet(f"{path}/progress")
    told = {p["batchId"]: p["durationMs"]["triggerExecution"] / 1000 for p in query.recentProgress}
    assert {r["batch_id"]: r["duration"] for r in progress.collect()} == told
    assert progress.agg(F.sum("input_rows")).first()[0] == 200
    windows = V.with_durations(V.stored_part(spark, f"{path}/out", "windows"), progress)
    assert windows.count() == 6 and all(r["processing_duration"] == told[r["batch_id"]] for r in windows.collect())


def test_batches_by_count_and_time(spark, tmp_path):
    path, own = str(tmp_path), V.stateful_session(spark)
    schema = "model_name string, message_id string"
    def batches():
        return sorted((r["model_name"], r["batch_no"], r["flush"], r["count"]) for r in spark.read.schema(V.BATCHED).parquet(f"{path}/out").groupBy("model_name", "batch_no", "flush").count().collect())
    spark.createDataFrame([("a", str(n)) for n in range(25)] + [("b", "x")], schema).write.parquet(f"{path}/in")
    query = (V.message_batches(own.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in"), 10, 3)
             .writeStream.format("parquet").option("checkpointLocation", f"{path}/c").trigger(processingTime="1 second").start(f"{path}/out"))
    try:
        until = time.time() + 120
        while time.time() < until and query.exception() is None and (not os.path.isdir(f"{path}/out") or len(batches()) < 4):
            query.awaitTermination(1)
    finally:
        query.stop()
    assert query.exception() is None
    found = batches()
    assert sum(n for *_, n in found) == 26
    assert all(n == 10 for *_, flush, n in found if flush == "count") and all(n < 10 for *_, flush, n in found if flush == "time")
    assert ("b", 0, "time", 1) in found
    ids = [r["message_id"] for r in spark.read.schema(V.BATCHED).parquet(f"{path}/out").where("model_name = 'a'").collect()]
    assert sorted(ids, key=int) == [str(n) for n in range(25)]


def test_once(spark, tmp_path):
    calls = []
    mark = f"{tmp_path}/marks/1"
    assert MS.once(spark, mark, lambda: calls.append(1)) and not MS.once(spark, mark, lambda: calls.append(2))
    assert calls == [1] and os.path.exists(f"{mark}.done")
    with pytest.raises(ZeroDivisionError):
        MS.once(spark, f"{tmp_path}/marks/2", lambda: 1 / 0)
    assert not MS.once(spark, f"{tmp_path}/marks/2", lambda: calls.append(3)) and not os.path.exists(f"{tmp_path}/marks/2.done")


def test_table_forms_of_odd_input(spark):
    """Empty tables, null models, ties and repeated rows."""
    df = summaries(spark, 3).unionAll(summaries(spark, 3)).withColumn("window_start", F.col("ts"))
    null = df.withColumn("model_name", F.lit(None).cast("string"))
    for rows, n in ((df, 6), (null, 6), (df.limit(0), 0)):
        assert R.running_totals(rows).count() == R.processing_metrics(rows).count() == n
        assert MS.recent_summaries(rows).count() == n
    rejects = df.select("model_name", "ts")
    status = R.monitor_status(R.processing_metrics(df), df.limit(0).select("model_name", "ts"), rejects).first()
    assert status["alert_count"] == 0 and status["last_alert_time"] is None and status["error_count"] == 6
    assert R.monitor_status(R.processing_metrics(df.limit(0)), rejects, rejects).collect() == []
    assert R.error_health(rejects.limit(0)).collect() == [] and R.error_health(rejects, "1 day").first()["health"] == "normal"
    found = df.select("ts", "model_name", F.array().cast("array<string>").alias("findings"))
    assert R.throughput_per_minute(found, 5).count() == 5
    assert {r["throughput"] for r in R.throughput_per_minute(found, 5).collect()} == {0, 2}
    assert R.throughput_per_minute(found.limit(0), 5, "2024-01-01 00:00:00").agg(F.sum("throughput")).first()[0] == 0
