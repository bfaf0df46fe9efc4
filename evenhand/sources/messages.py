"""Message streams in and out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand import schemas
from evenhand.options import DEFAULT_MONITOR, MonitorOptions


def kafka_options(monitor: MonitorOptions = DEFAULT_MONITOR) -> dict:
    """Reader options of a Kafka stream: from the latest offset; what a trigger takes in is
    only limited if asked for."""
    options = {"startingOffsets": "latest"}
    if monitor.max_messages_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = monitor.max_messages_per_trigger
    return options


def read_message_stream(spark: SparkSession, fmt: str = "kafka",
                        monitor: MonitorOptions = DEFAULT_MONITOR, **options) -> DataFrame:
    """JSON messages as a stream with a ``value`` string column.

    With Kafka the stream starts at the latest offset; any other source format that yields
    a ``value`` column (``text`` files) works the same way.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        for name, value in kafka_options(monitor).items():
            reader = reader.option(name, value)
    path = options.pop("path", None)
    reader = reader.options(**options)
    raw = reader.load(path) if path else reader.load()
    return raw.select(F.col("value").cast("string").alias("value"))


def parse_messages(raw: DataFrame) -> DataFrame:
    """The message fields, the parsed event time ``ts`` and the raw value."""
    parsed = raw.select("value", F.from_json("value", schemas.MESSAGE).alias("m"))
    return parsed.select("value", "m.*", F.try_to_timestamp(F.col("m.timestamp")).alias("ts"))


def split_valid(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages with text and timestamp, all others)."""
    valid = F.col("text").isNotNull() & F.col("timestamp").isNotNull() & F.col("ts").isNotNull()
    return messages.where(valid).drop("value"), messages.where(~valid)


def deduplicated(messages: DataFrame, monitor: MonitorOptions = DEFAULT_MONITOR) -> DataFrame:
    """Messages without repeated ``message_id`` within the watermark."""
    return (messages.withWatermark("ts", monitor.watermark)
            .dropDuplicatesWithinWatermark(["message_id"]))


def as_messages(df: DataFrame) -> DataFrame:
    """Every row as one JSON message in ``value``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_batch_summaries(summaries: DataFrame, checkpoint: str, fmt: str = "kafka",
                          trigger: dict | None = None, **options):
    """Start the query that writes one message per closed window."""
    path = options.pop("path", None)
    writer = (as_messages(summaries).writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).options(**options)
              .trigger(**(trigger or {"processingTime": "60 seconds"})))
    return writer.start(path) if path else writer.start()


def once(spark: SparkSession, mark: str, call: Callable[[], None]) -> bool:
    """Make a call unless its mark, a path in a shared folder, is there; whether it was made.

    The mark is written before the call, which is therefore made at most once, and ``mark`` +
    ``.done`` after it; a mark without that is a call that was cut off.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(mark)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.createNewFile(path):
        return False
    call()
    files.createNewFile(jvm.org.apache.hadoop.fs.Path(f"{mark}.done"))
    return True


def write_alerts(alerts: DataFrame, checkpoint: str, fmt: str = "kafka",
                 callbacks: list[Callable[[DataFrame], None]] | None = None,
                 trigger: dict | None = None, **options):
    """Start the query that sends alerts to their sink and then calls each callback with the
    batch of alerts, as a DataFrame.

    A batch that is tried again doesn't repeat its alerts: in a file sink each batch has a
    folder of its own, which is overwritten; other sinks get ``batch_id`` in each message.  Nor
    are callbacks called again: their marks lie below the checkpoint folder.
    """
    path = options.pop("path", None)

    def send(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if path:
                (as_messages(batch).write.format(fmt).mode("overwrite").options(**options)
                 .save(f"{path}/batch_id={batch_id}"))
            else:
                (as_messages(batch.withColumn("batch_id", F.lit(batch_id))).write.format(fmt)
                 .mode("append").options(**options).save())
            for n, callback in enumerate(callbacks or []):
                once(batch.sparkSession, f"{checkpoint}/calls/{batch_id}-{n}",
                     lambda call=callback: call(batch))
        finally:
            batch.unpersist()

    return (alerts.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"}))
            .foreachBatch(send).start())


def write_summaries(summaries: DataFrame, checkpoint: str, path: str, trigger: dict | None = None):
    """Start the query that appends a stream of summaries to a table partitioned by ``date``, that of ``ts``."""
    dated = summaries.withColumn("date", F.to_date("ts"))
    return (dated.writeStream.format("parquet").outputMode("append").partitionBy("date")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start(path))


def recent_summaries(summaries: DataFrame, ttl: str = DEFAULT_MONITOR.summary_ttl,
                     as_of=None) -> DataFrame:
    """Summaries of the last ``ttl`` before ``as_of`` (default: the newest summary).

    With a given instant the filter reaches the scan; on a table of ``write_summaries``, which has a
    ``date``, only the dates of that time are read.
    """
    newest = (F.lit(as_of).cast("timestamp") if as_of is not None
              else summaries.agg(F.max("ts").alias("t")).scalar())
    oldest = newest - F.expr(f"INTERVAL {ttl}")
    kept = summaries.where(F.col("ts") > oldest)
    if as_of is not None:
        kept = kept.where(F.col("ts") <= newest)
    if "date" in summaries.columns:
        kept = kept.where(F.col("date").between(F.to_date(oldest), F.to_date(newest)))
    return kept
