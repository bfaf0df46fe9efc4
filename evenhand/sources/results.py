"""Stored runs and findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenhand import schemas

SAMPLE_CHARS = 100


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema, in its order and types; missing ones are null."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def write_results(findings: DataFrame, runs: DataFrame, path: str, fmt: str = "parquet",
                  mode: str = "errorifexists") -> None:
    """Findings and runs below ``path``, findings partitioned by run.  Every task writes the
    rows it has, so a run that holds most findings is written by many tasks."""
    (_conform(findings, schemas.FINDINGS)
     .write.mode(mode).partitionBy("run_id").format(fmt).save(f"{path}/findings"))
    _conform(runs, schemas.RUNS).write.mode(mode).format(fmt).save(f"{path}/runs")


def read_results(spark: SparkSession, path: str, fmt: str = "parquet"
                 ) -> tuple[DataFrame, DataFrame]:
    """(findings, runs) as written, read with their schemas."""
    findings = spark.read.schema(schemas.FINDINGS).format(fmt).load(f"{path}/findings")
    runs = spark.read.schema(schemas.RUNS).format(fmt).load(f"{path}/runs")
    return findings.select(*schemas.FINDINGS.names), runs


def cut_text(column, limit: int):
    """The text, cut to ``limit`` characters with ``...`` when it is longer."""
    return F.when(F.length(column) > limit,
                  F.concat(F.substring(column, 1, limit), F.lit("..."))).otherwise(column)


def flat_findings(findings: DataFrame, texts: DataFrame, key: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The eleven export columns.  The text is cut before the join, so that only a short
    sample of it is shuffled."""
    samples = texts.select(key, cut_text(F.col(text_col), SAMPLE_CHARS).alias("text_sample"))

    def optional(name, default, kind):
        return (F.col(name) if name in findings.columns else F.lit(default).cast(kind)).alias(name)

    narrow = findings.select(
        key, "bias_type", "severity", "confidence", "bias_score", "biased_terms",
        optional("model_name", "", "string"), optional("language", "en", "string"),
        optional("ts", None, "timestamp"))
    return narrow.join(samples, key).select(
        "bias_type", "severity", "confidence", "bias_score", F.lit(1.0).alias("p_value"),
        F.lit(0.0).alias("effect_size"), "text_sample",
        F.array_join("biased_terms", ", ").alias("biased_terms"), "model_name", "language",
        F.col("ts").alias("timestamp"))


def write_findings_csv(findings: DataFrame, texts: DataFrame, path: str,
                       mode: str = "errorifexists") -> None:
    """The flat findings as CSV with a header."""
    (flat_findings(findings, texts).write.mode(mode).option("header", True)
     .option("escape", '"').option("quoteAll", True).csv(path))
