"""Tables of texts from files and from other tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evenhand.functions.text import NOT_SPACE_CHAR, SPACE_CHAR


def _trimmed(column):
    return F.regexp_replace(column, f"^{SPACE_CHAR}+|{SPACE_CHAR}+$", "")


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt out to ``partitions``, for scans of few files with one row group each; by
    default the table as it is."""
    return df if partitions is None else df.repartition(partitions)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One text per non-blank line, trimmed.  Lines have no key of their own: they get the
    unique id Spark gives to rows, so write the table out to keep the ids."""
    lines = spark.read.text(path).where(F.col("value").rlike(NOT_SPACE_CHAR))
    return lines.select(F.monotonically_increasing_id().alias("doc_id"),
                        _trimmed(F.col("value")).alias("text"))


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV files with a header and a ``text`` column; rows without text are dropped.

    ``multi_line`` is for values with line breaks; see ``csv_records``.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    df = reader.csv(path)
    if multi_line:
        schema = reader.option("multiLine", True).csv(path).schema
        fields = F.from_csv("record", schema.simpleString()[len("struct<"):-1].replace(":", " "),
                            {"escape": '"', "multiLine": "true"})
        df = csv_records(spark, path).where("NOT header").select(fields.alias("r")).select("r.*")
    if "text" not in df.columns:
        raise ValueError("CSV file must have a 'text' column")
    return df.dropna(subset=["text"])


PIECES = "file string, block long, part string, record string, header boolean"


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of blocks of files to records: whole ones, and what a block has of records that cross its edges.

    ``inside`` says whether the block begins within quotes.
    """
    where, inside, held, started = None, False, [], False

    def piece(part: str, header: bool = False) -> tuple:
        text = "\n".join(held)
        return (*where, part, text[:-1] if part in ("whole", "last") and text.endswith("\r") else text, header)

    for batch in batches:
        out = []
        for file, block, line, begins_inside in zip(
                batch["file"], batch["block"], batch["value"], batch["inside"], strict=True):
            if (file, block) != where:
                if held:
                    out.append(piece("middle" if not started else "first"))
                where, inside, held, started = (file, block), bool(begins_inside), [], not begins_inside
                first = block == 0
            held.append(line)
            inside ^= line.count('"') % 2 == 1
            if not inside:
                if line.strip("\r") or len(held) > 1 or not started:  # a blank line is no record
                    out.append(piece("whole" if started else "last", first))
                    first = False
                held, started = [], True
        yield pd.DataFrame(out, columns=[f.split()[0] for f in PIECES.split(", ")])
    if held:
        yield pd.DataFrame([piece("middle" if not started else "first")],
                           columns=[f.split()[0] for f in PIECES.split(", ")])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as strings, with ``header`` for the first of each file.  Values in quotes
    may have line breaks, and still many tasks read a file.

    Files are read by lines, in blocks.  A first pass counts the quotes of each block, whose running
    sum tells whether a block begins within a value; the second cuts records.  Only what crosses a block's
    edges, two pieces a block at most, is put together by a shuffle.  Quotes stand around
    values or doubled in them, as ``escape='"'`` writes them.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    blocks = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
                           .alias("inside"))
    # one row a block: lines stay where and in the order they are read
    pieces = lines.join(F.broadcast(begins), ["file", "block"]).select(
        "file", "block", "value", "inside").mapInPandas(_cut, PIECES)
    whole = pieces.where("part = 'whole'").select("record", "header")
    # pieces in order of their blocks; in a block the end of one record stands before the begin of the next
    split = pieces.where("part <> 'whole'")
    order = F.struct("block", (F.col("part") == "first").alias("later"))
    so_far = Window.partitionBy("file").orderBy("block", F.col("part") == "first").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    named = split.withColumn("n", F.count_if(F.col("part") == "first").over(so_far))
    joined = named.groupBy("file", "n").agg(
        F.array_sort(F.collect_list(F.struct(order.alias("o"), "record"))).alias("p"),
        F.max("header").alias("header"))
    text = F.array_join(F.transform("p", lambda x: x["record"]), "\n")
    return whole.unionByName(joined.select(F.regexp_replace(text, "\r$", "").alias("record"), "header"))


def as_texts(df: DataFrame, text_col: str = "text", key_col: str | None = None,
             keep: tuple = ()) -> DataFrame:
    """Any table or stream with a text column as (doc_id, text, ...).  Without a key every row
    gets an id of its own, equal texts as well; write the table out to keep the ids."""
    key = F.col(key_col) if key_col else F.monotonically_increasing_id()
    return df.select(key.alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)


def union_datasets(datasets: dict[str, DataFrame]) -> DataFrame:
    """Several named tables as one, with ``dataset_name``; group by it downstream, so that
    one job covers them all."""
    if not datasets:
        raise ValueError("no datasets given")
    named = [df.withColumn("dataset_name", F.lit(name)) for name, df in datasets.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
