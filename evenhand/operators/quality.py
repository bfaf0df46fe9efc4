"""Data quality of texts and of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenhand import lexicons as L
from evenhand.functions import text as T
from evenhand.operators.preparation import keywords

# The limits of the checks.
MIN_SAMPLE_SIZE = 10
MAX_TEXT_LENGTH = 10000
MAX_DUPLICATE_RATIO = 0.1
RATE_TOLERANCE = 0.001

# The wording of errors, warnings and advice.
NO_TEXTS = "No text data provided"
NO_VALID = "No valid text data found"
SMALL_SAMPLE = f"Sample size (%d) is below recommended minimum ({MIN_SAMPLE_SIZE})"
LONG_TEXTS = f"Some texts exceed maximum length ({MAX_TEXT_LENGTH})"
DUPLICATES = "High duplicate ratio detected: %.1f%%"
NO_SAMPLES = "No samples were analyzed"
TOO_MANY_BIASED = "Biased samples count exceeds total samples"
RATE_DIFFERS = "Bias rate calculation inconsistency detected"
BAD_DURATION = "Invalid detection duration"
ADVISE_DUPLICATES = "Consider removing duplicate texts to improve analysis quality"
ADVISE_SAMPLE = f"Increase sample size to at least {MIN_SAMPLE_SIZE} for reliable results"
ADVISE_LENGTH = "Consider truncating very long texts for better processing performance"


def is_valid(text: Column) -> Column:
    """Not null and not blank."""
    return F.coalesce(text.rlike(T.NOT_SPACE_CHAR), F.lit(False))


def _messages(*rules: Column) -> Column:
    return F.filter(F.array(*rules), lambda m: m.isNotNull())


def duplicate_ratio(df: DataFrame, text_col: str = "text") -> DataFrame:
    """1 - distinct / valid texts.  Distinct is counted on the SHA-256 of the text, so that
    32 bytes per text are shuffled and a task holds one row per text, not per copy."""
    valid = df.where(is_valid(F.col(text_col)))
    return valid.agg(
        F.count(F.lit(1)).alias("valid_texts"), _distinct(text_col).alias("distinct_texts"),
    ).withColumn("duplicate_ratio", F.when(
        F.col("valid_texts") > 0, F.lit(1.0) - F.col("distinct_texts") / F.col("valid_texts")))


def _distinct(text_col: str) -> Column:
    return F.count_distinct(F.unhex(F.sha2(F.col(text_col), 256)))


# Buckets of a sketch as a power of two: 2 ** 14 give a standard error of about 0.8 %.
SKETCH_BITS = 14


def text_sketches(df: DataFrame, by: tuple = (), text_col: str = "text") -> DataFrame:
    """Per ``by`` (a run, a day) the number of valid texts and a sketch of the distinct ones, some KB.

    Stored, they let later questions do without the texts: ``sketched_duplicate_ratio`` merges
    the sketches of any runs.
    """
    valid = df.where(is_valid(F.col(text_col)))
    return valid.groupBy(*by).agg(
        F.count(F.lit(1)).alias("valid_texts"),
        F.hll_sketch_agg(F.sha2(F.col(text_col), 256), F.lit(SKETCH_BITS)).alias("sketch"))


def sketched_duplicate_ratio(sketches: DataFrame, by: tuple = ()) -> DataFrame:
    """``duplicate_ratio`` over the texts of all sketches (per ``by``), with an estimated number of distinct texts.

    An estimate above the number of texts counts as that; without texts the ratio is null.
    """
    merged = sketches.groupBy(*by).agg(
        F.coalesce(F.sum("valid_texts"), F.lit(0)).alias("valid_texts"),
        F.hll_union_agg("sketch").alias("_sketch"))
    distinct = F.least("valid_texts", F.coalesce(F.hll_sketch_estimate("_sketch"), F.lit(0)))
    return merged.select(*by, "valid_texts", distinct.alias("distinct_texts")).withColumn(
        "duplicate_ratio", F.when(F.col("valid_texts") > 0,
                                  F.lit(1.0) - F.col("distinct_texts") / F.col("valid_texts")))


def character_distribution(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Shares of ASCII, digit, punctuation and space characters over all valid texts."""
    return df.where(is_valid(F.col(text_col))).agg(*_shares(F.col(text_col)))


def _shares(text: Column) -> list[Column]:
    def count(char_class: str) -> Column:
        # Removing what is not in the class costs one replacement per run of characters.
        return F.sum(F.length(text) - F.length(F.regexp_replace(text, f"[{char_class}]+", "")))

    total = F.sum(F.length(text))
    space = T.SPACE_CHAR[1:-1]
    classes = {
        "ascii_ratio": r"\x00-\x7f",
        "digit_ratio": r"\p{Nd}²³¹⁰⁴-⁹₀-₉",
        "punct_ratio": rf"^\p{{L}}\p{{N}}{space}",
        "space_ratio": space,
    }
    return [F.when(total > 0, count(c) / total).alias(name) for name, c in classes.items()]


def validate_texts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: counts and lengths of the valid texts, duplicate ratio, errors, warnings."""
    return _judged(df, text_col)


def _judged(df: DataFrame, text_col: str, more: tuple = ()) -> DataFrame:
    """``validate_texts`` with ``more`` aggregates of ``_text``, the valid texts: one scan."""
    text = F.col(text_col)
    valid = is_valid(text)
    length = F.when(valid, F.length(text))
    stats = df.select(F.when(valid, text).alias("_text"), length.alias("_len"),
                      valid.alias("_valid")).agg(
        F.count(F.lit(1)).alias("total_texts"),
        F.count_if("_valid").alias("valid_texts"),
        F.avg("_len").alias("avg_length"), F.min("_len").alias("min_length"),
        F.max("_len").alias("max_length"),
        _distinct("_text").alias("_distinct"), *more)
    found = F.col("valid_texts") > 0
    ratio = F.when(found, F.lit(1.0) - F.col("_distinct") / F.col("valid_texts"))
    out = stats.withColumn("duplicate_ratio", ratio).drop("_distinct")
    errors = _messages(
        F.when(F.col("total_texts") == 0, F.lit(NO_TEXTS)),
        F.when((F.col("total_texts") > 0) & ~found, F.lit(NO_VALID)))
    warnings = _messages(
        F.when(found & (F.col("valid_texts") < MIN_SAMPLE_SIZE), F.format_string(
            SMALL_SAMPLE, F.col("valid_texts"))),
        F.when(F.col("max_length") > MAX_TEXT_LENGTH,
               F.lit(LONG_TEXTS)),
        F.when(F.col("duplicate_ratio") > MAX_DUPLICATE_RATIO, F.format_string(
            DUPLICATES, F.col("duplicate_ratio") * 100)))
    return out.select("*", found.alias("is_valid"), errors.alias("errors"),
                      warnings.alias("warnings"))


def validate_runs(runs: DataFrame, findings: DataFrame,
                  significance: DataFrame | None = None) -> DataFrame:
    """Errors, warnings and a quality score per run.

    The score is the mean of a size factor, the share of bias types that occur, and a factor
    for the significance test (``significance``: run_id, significant; none done gives 0.5).
    A run without samples has an error and score 0.
    """
    types = (findings.groupBy("run_id", "bias_type").agg(F.lit(1).alias("_one"))
             .groupBy("run_id").agg(F.count(F.lit(1)).alias("_types")))
    joined = runs.join(types, "run_id", "left")
    if significance is None:
        joined = joined.withColumn("significant", F.lit(None).cast("boolean"))
    else:
        joined = joined.join(significance.select("run_id", "significant"), "run_id", "left")
    total, biased = F.col("total_samples"), F.col("biased_samples")
    empty = total == 0
    expected = biased / F.when(total > 0, total)
    errors = _messages(
        F.when(empty, F.lit(NO_SAMPLES)),
        F.when(~empty & (biased > total), F.lit(TOO_MANY_BIASED)))
    warnings = _messages(
        F.when(~empty & (F.abs(F.col("biased_sample_rate") - expected) > RATE_TOLERANCE),
               F.lit(RATE_DIFFERS)),
        F.when(~empty & (F.col("duration_s") <= 0), F.lit(BAD_DURATION)))
    size = F.when(total >= 1000, 1.0).when(total >= 100, 0.8).otherwise(0.5)
    diversity = F.coalesce(F.col("_types"), F.lit(0)) / F.lit(len(L.BIAS_TYPES))
    tested = F.when(F.col("significant"), 1.0).when(~F.col("significant"), 0.7).otherwise(0.5)
    return joined.select(
        "run_id", (F.size(errors) == 0).alias("is_valid"), errors.alias("errors"),
        warnings.alias("warnings"),
        F.when(empty, 0.0).otherwise((size + diversity + tested) / 3).alias("quality_score"))


def quality_report(df: DataFrame, text_col: str = "text", key_col: str = "doc_id",
                   samples: int = 5) -> DataFrame:
    """Validation, character shares, the first texts in key order and advice as one long
    table (section, ord, key, value): one scan for the counts and one for the first texts."""
    stats = _judged(df, text_col, tuple(_shares(F.col("_text"))))

    def percent(column):
        return F.format_string("%.1f%%", F.coalesce(F.col(column), F.lit(0.0)) * 100)

    def line(section: str, n, key: str, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), (F.lit(n) if isinstance(n, int) else n)
                        .alias("ord"), F.lit(key).alias("key"), value.cast("string").alias("value"))

    def lines(section: str, entries: dict[str, Column]) -> Column:
        return F.array(*[line(section, n, key, value)
                         for n, (key, value) in enumerate(entries.items(), 1)])

    def listed(section: str, column: str) -> Column:
        return F.transform(column, lambda v, i: line(section, i + 1, "message", v))

    counted = F.concat(
        lines("overview", {
            "total_texts": F.col("total_texts"), "valid_texts": F.col("valid_texts"),
            "status": F.when(F.col("is_valid"), "PASSED").otherwise("FAILED")}),
        lines("statistics", {
            "average_length": F.format_string("%.1f", F.col("avg_length")),
            "min_length": F.col("min_length"), "max_length": F.col("max_length"),
            "duplicate_ratio": F.when(F.col("is_valid"), percent("duplicate_ratio"))}),
        lines("characters", {
            "ascii": percent("ascii_ratio"), "digits": percent("digit_ratio"),
            "punctuation": percent("punct_ratio")}),
        listed("errors", "errors"), listed("warnings", "warnings"),
        lines("recommendations", {
            "duplicates": F.when(F.col("duplicate_ratio") > MAX_DUPLICATE_RATIO,
                                 F.lit(ADVISE_DUPLICATES)),
            "sample_size": F.when(F.col("valid_texts") < MIN_SAMPLE_SIZE, F.lit(ADVISE_SAMPLE)),
            "length": F.when(F.col("max_length") > MAX_TEXT_LENGTH, F.lit(ADVISE_LENGTH))}))
    # The outer form and a filter behind it, see the README on generators.
    report = stats.select(F.inline_outer(counted)).where(F.col("value").isNotNull())

    first = (df.where(is_valid(F.col(text_col))).select(key_col, text_col)
             .orderBy(key_col).limit(samples))
    numbered = first.withColumn("n", F.row_number().over(Window.orderBy(key_col)))
    top = (keywords(numbered, 3, text_col).groupBy("n")
           .agg(F.array_sort(F.collect_list(F.struct("rank", "keyword"))).alias("k")))
    described = numbered.join(top, "n", "left").select(
        "n", F.length(text_col).alias("length"),
        T.readability(F.col(text_col))["flesch_score"].alias("flesch"),
        F.coalesce(F.array_join(F.transform("k", lambda k: k["keyword"]), ", "), F.lit(""))
        .alias("keywords"))
    sample_rows = described.select("n", F.inline(F.array(
        F.struct(F.lit("length").alias("key"), F.col("length").cast("string").alias("value")),
        F.struct(F.lit("readability").alias("key"),
                 F.format_string("%.1f", F.col("flesch")).alias("value")),
        F.struct(F.lit("keywords").alias("key"), F.col("keywords").alias("value")),
    ))).select(F.lit("samples").alias("section"), F.col("n").alias("ord"), "key", "value")

    return report.unionByName(sample_rows)


def render_report(report: DataFrame) -> DataFrame:
    """The report as ordered text lines."""
    return report.select("section", "ord", "key", F.concat(
        F.lit("  "), F.col("key"), F.lit(": "), F.col("value")).alias("line")).orderBy(
        "section", "ord", "key")
