"""Column names and types shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# One detected finding, as it sits in the ``findings`` array of a text.
FINDING = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("bias_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("severity_rank", T.IntegerType()),
    T.StructField("bias_score", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("biased_terms", T.ArrayType(T.StringType())),
    T.StructField("group_type", T.StringType()),
    T.StructField("group_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("term", T.StringType()),
    T.StructField("pattern", T.StringType()),
    T.StructField("suggestion", T.StringType()),
    T.StructField("marker_count", T.IntegerType()),
])

MESSAGE = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("message_id", T.StringType()),
    T.StructField("source", T.StringType()),
])

# Columns a finding row takes over from its text, when the text has them.
IDENTITY = ["run_id", "dataset_name", "model_name", "doc_id", "output_idx", "language", "ts"]

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("dataset_name", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("total_samples", T.LongType()),
    T.StructField("finding_count", T.LongType()),
    T.StructField("biased_samples", T.LongType()),
    T.StructField("findings_per_sample", T.DoubleType()),
    T.StructField("biased_sample_rate", T.DoubleType()),
    T.StructField("overall_bias_score", T.DoubleType()),
    T.StructField("duration_s", T.DoubleType()),
])

FINDINGS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("dataset_name", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("output_idx", T.IntegerType()),
    T.StructField("language", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    *FINDING.fields,
])
