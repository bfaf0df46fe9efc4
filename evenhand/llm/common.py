"""What the operators share: stored tables, batches, column names that clash with none, bounded samples."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Hash values of `share` lie in 0 .. 2**31 - 1.
SHARES = 1 << 31


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where none is set, as in tests, one below the session's warehouse."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(folder or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """`df` with its lineage cut: written as a table in the shared folder and read again, by column.

    Unlike a checkpoint it is compressed, and the plan that reads it knows nothing of the one
    that wrote it. It stays until the shared folder is cleared.
    """
    folder = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """`df`; its session hands Python tasks `rows` rows at a time, unless it sets another number than Spark does.

    Texts are long: 10,000 of them, in Java, Arrow and Python at once, take much of an executor.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, str(rows))
    return df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have, made from `name`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def share(*keys: str) -> Column:
    """An even number in [0, SHARES) that depends on the key columns only."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(SHARES))


def remainder(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo `n`; null keys give null."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def bounded_sample(df: DataFrame, by: str, size: int, order: str) -> DataFrame:
    """At most `size` rows for each value of `by`: those whose `order` column hashes lowest.

    The values of `by` are classes, few by nature; their counts come to the driver. Rows are
    first thinned to about twice `size` a class where they are, so that the ranking window
    sees a bounded number of rows even if one class holds nearly all. Null classes are left out.
    """
    spot = fresh(df, "spot")
    df = df.filter(F.col(by).isNotNull()).withColumn(spot, share(order))
    counts = df.groupBy(by).count().collect()
    if not counts:
        return df.drop(spot)
    limits = {row[by]: min(SHARES, int(SHARES * (2 * size + 50) / row["count"])) for row in counts}
    pairs = [x for value, limit in limits.items() for x in (F.lit(value), F.lit(limit))]
    rank = fresh(df, "rank")
    near = df.filter(F.col(spot) < F.create_map(*pairs)[F.col(by)])
    ranked = near.withColumn(rank, F.row_number().over(Window.partitionBy(by).orderBy(spot, order)))
    return ranked.filter(F.col(rank) <= size).drop(spot, rank)


def labelled_sample(df: DataFrame, labels: DataFrame, label: str, size: int, key: str = "doc_id") -> DataFrame:
    """The rows of `df` whose key is among at most `size` sampled keys of each label, with the label as column `label`.

    Keys are sampled in the label table; a key with several different labels is left out. The
    sample's bound makes it safe to broadcast, so `df` is filtered where it lies.
    """
    from_labels = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias(label), F.max(label).alias("other"))
    keys = bounded_sample(from_labels.filter(F.col(label) == F.col("other")).drop("other"), label, size, key)
    return df.join(F.broadcast(keys), key)
