"""A training-data pipeline over documents, in stages that each read what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. In `run` each result is written as Parquet in the shared folder and
read again, so a lost executor costs the current stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.llm import decontamination, quality, sentencepiece_sampling, simhash, suffix_dedup
from evenhand.llm.common import remainder, stored, table

#: The model file whose pieces are sampled, a public vocabulary.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts; labels of held-out documents teach nothing.

    Null and empty texts are scored like any other, repeated rows each; documents without a doc_id
    teach nothing; an empty table gives an empty one.
    """
    teaching = remainder("doc_id", 3) != 1
    positives = table(spark, sf_dir, "labels").filter(teaching & (F.col("quality") == 1))
    return quality.filtered(docs, quality.fit(docs.filter(teaching), positives)).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links (3-word shingles, at most 3 bits apart), that of the least doc_id.

    Null and empty texts have fingerprint 0 and are one group, rows with a null doc_id come last
    in a group, equal rows leave one; an empty table gives an empty one.
    """
    return simhash.deduplicated(docs, n=3, radius=3).select(*COLUMNS)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of strings of 200 bytes; n_chars is that of what is left.

    Of equal passages that of the least doc_id stays, nulls first; null texts stay null, and rows
    with equal doc_id and text count as one and all stay; an empty table gives an empty one.
    """
    return suffix_dedup.deduplicated(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word window of a benchmark item, items without an id included.

    Null and empty texts hold no window and stay, repeated rows each; an empty table gives an empty one.
    """
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with sampled pieces; text is what they decode to, which is the text they come from.

    A null text has null pieces and stays null, an empty one has the piece of the space before it;
    doc_id and text decide the pieces, so equal rows have equal ones; an empty table gives an empty one.
    """
    vocabulary = sentencepiece_sampling.Vocabulary.load(PIECES)
    pieces = sentencepiece_sampling.tokenized(docs.select(*COLUMNS), vocabulary)
    text = sentencepiece_sampling.decoded(spark, F.col("pieces"), vocabulary)
    return pieces.withColumns({"text": text, "n_pieces": F.size("pieces").cast("long")})


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", without_near_copies),
    ("suffix_array_dedup", without_repeated_passages),
    ("benchmark_decontamination", decontaminated),
    ("sentencepiece", tokenized),
]

#: SQL can't express the classifier, the suffix arrays or the sampling; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
