"""Aggregates over findings and over texts.

Every function takes ``by``, the columns that tell runs apart; without it the whole table is
one run.  Demographic measures all derive from one small aggregate (``group_comparisons``),
linguistic ones from one narrow row per text (``text_features``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from evenhand import lexicons as L
from evenhand.functions import automaton as A
from evenhand.functions import matching as M
from evenhand.functions import text as T
from evenhand.lexicons import DEFAULT_LEXICONS, Lexicons
from evenhand.operators.preparation import language_of
from evenhand.operators.ranks import kruskal_wallis
from evenhand.operators.shared import settled
from evenhand.options import DEFAULT_OPTIONS, DetectOptions


#: Rows a counted row stands for, in the tables of ``finding_counts`` and ``text_counts``.
ROWS = "_rows"


def _rows_of(df: DataFrame) -> Column:
    return F.col(ROWS) if ROWS in df.columns else F.lit(1)


def _mean_of(df: DataFrame, column) -> Column:
    """Mean of a column over the rows that a table's rows stand for."""
    if ROWS not in df.columns:
        return F.avg(column)
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.sum(value * F.col(ROWS)) / F.sum(F.when(value.isNotNull(), F.col(ROWS)))


def _window(by: tuple, *more: str):
    keys = [*by, *more]
    return Window.partitionBy(*(keys or [F.lit(0)]))


def with_total(df: DataFrame, totals: DataFrame, by: tuple) -> DataFrame:
    """Add ``total_samples`` of each run: joined on ``by``, or the one number there is."""
    if by:
        return df.join(totals.select(*by, "total_samples"), list(by))
    return df.withColumn("total_samples", totals.select("total_samples").scalar())


def total_samples(texts: DataFrame, by: tuple = ()) -> DataFrame:
    return texts.groupBy(*by).agg(F.count(F.lit(1)).alias("total_samples"))


# -- demographic ------------------------------------------------------------


def group_findings(findings: DataFrame) -> DataFrame:
    """Demographic findings that name their group."""
    return findings.where((F.col("bias_type") == "demographic")
                          & F.col("group_type").isNotNull() & F.col("group_name").isNotNull())


def finding_counts(findings: DataFrame, by: tuple = ()) -> DataFrame:
    """Demographic findings that name their group, counted by group, severity and score: all that the demographic
    measures need, and few rows.  The measures take it in place of the findings."""
    keys = [*by, "bias_type", "group_type", "group_name", "severity", "bias_score"]
    return settled(group_findings(findings).groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS)))


def group_comparisons(findings: DataFrame, by: tuple = ()) -> DataFrame:
    """Count, mean and maximum score and severity counts per group; ``disparity`` is the
    distance of a group's mean from the plain mean of the other groups of its type."""
    rows = _rows_of(findings)
    per_group = group_findings(findings).groupBy(*by, "group_type", "group_name").agg(
        F.sum(rows).alias("bias_count"),
        _mean_of(findings, "bias_score").alias("avg_bias_score"),
        F.max("bias_score").alias("max_bias_score"),
        *[F.sum(F.when(F.col("severity") == s, rows).otherwise(0)).alias(s) for s in L.SEVERITIES],
    )
    w = _window(by, "group_type")
    groups, mean = F.count(F.lit(1)).over(w), F.col("avg_bias_score")
    others = (F.sum("avg_bias_score").over(w) - mean) / (groups - 1)
    return per_group.withColumns({
        "groups": groups,
        "disparity": F.when(groups > 1, F.abs(mean - others)),
    })


def severity_distribution(comparisons: DataFrame, by: tuple = ()) -> DataFrame:
    """Severity counts of each group as a map without zeros."""
    pairs = F.filter(
        F.array(*[F.struct(F.lit(s).alias("key"), F.col(s).alias("value"))
                  for s in L.SEVERITIES]), lambda p: p["value"] > 0)
    return comparisons.select(*by, "group_type", "group_name",
                              F.map_from_entries(pairs).alias("severity_distribution"))


def parity_metrics(comparisons: DataFrame, totals: DataFrame, by: tuple = ()) -> DataFrame:
    """Per group type with at least two groups: 1 - lowest / highest finding rate, and with
    exactly two groups the difference of the rates."""
    rated = with_total(comparisons, totals, by).withColumn(
        "rate", F.col("bias_count") / F.col("total_samples"))
    high, low = F.max("rate"), F.min("rate")
    per_type = rated.groupBy(*by, "group_type").agg(
        F.count(F.lit(1)).alias("groups"),
        (F.lit(1.0) - F.when(high > 0, low / high).otherwise(1.0)).alias("parity_violation"),
        F.when(F.count(F.lit(1)) == 2, high - low).alias("equalized_odds"),
    )
    return per_type.where(F.col("groups") >= 2)


def disparate_impact(comparisons: DataFrame, by: tuple = ()) -> DataFrame:
    """Mean of all disparities, 0 if there are none."""
    return comparisons.groupBy(*by).agg(
        F.coalesce(F.avg("disparity"), F.lit(0.0)).alias("disparate_impact"))


def significance(findings: DataFrame, options: DetectOptions = DEFAULT_OPTIONS,
                 by: tuple = ()) -> DataFrame:
    """Kruskal-Wallis test per group type over the groups with enough findings."""
    return kruskal_wallis(
        group_findings(findings), "group_name", "bias_score", (*by, "group_type"),
        options.min_group_size, options.significance_level, ROWS if ROWS in findings.columns else None)


def protected_attributes(comparisons: DataFrame, by: tuple = ()) -> DataFrame:
    """Group types with more than 10 findings, more than 5 of them high or critical."""
    return (comparisons.groupBy(*by, "group_type")
            .agg(F.sum("bias_count").alias("findings"),
                 F.sum(F.col("high") + F.col("critical")).alias("severe"))
            .where("findings > 10 AND severe > 5"))


def worst_disparity(comparisons: DataFrame, by: tuple = ()) -> DataFrame:
    """The group with the largest disparity; names decide ties.  The two groups of a pair are
    equally far apart, so the order ignores what floating point adds after 12 digits."""
    ranked = comparisons.where("disparity > 0").select(
        *by, "group_type", "group_name", "disparity")
    order = [F.desc(F.round("disparity", 12)), F.asc("group_type"), F.asc("group_name")]
    if not by:
        return ranked.orderBy(*order).limit(1)
    return (ranked.withColumn("_n", F.row_number().over(_window(by).orderBy(*order)))
            .where("_n = 1").drop("_n"))


def demographic_analysis(findings: DataFrame, totals: DataFrame,
                         options: DetectOptions = DEFAULT_OPTIONS,
                         by: tuple = ()) -> dict[str, DataFrame]:
    """All demographic measures; they share one count of the findings."""
    findings = finding_counts(findings, by)
    comparisons = group_comparisons(findings, by)
    return {
        "group_comparisons": comparisons,
        "severity_distribution": severity_distribution(comparisons, by),
        "parity_metrics": parity_metrics(comparisons, totals, by),
        "disparate_impact": disparate_impact(comparisons, by),
        "significance": significance(findings, options, by),
        "protected_attributes": protected_attributes(comparisons, by),
        "worst_disparity": worst_disparity(comparisons, by),
    }


# -- linguistic -------------------------------------------------------------


def text_features(df: DataFrame, lexicons: Lexicons = DEFAULT_LEXICONS, text_col: str = "text",
                  language_col: str | None = "language", by: tuple = ()) -> DataFrame:
    """One narrow row per text with what the linguistic aggregates need: language, dialects,
    marker counts and polarity.  One scan of the text; without a language column the
    language is identified."""
    return _features(df, lexicons, text_col, language_col, by)


def _features(df: DataFrame, lexicons: Lexicons, text_col: str, language_col: str | None, by: tuple,
              **more: Column) -> DataFrame:
    has_language = language_col is not None and language_col in df.columns
    language = F.col(language_col) if has_language else language_of(
        F.col(text_col), lexicons.language_profiles)
    lists = [*lexicons.dialect_markers.values(), lexicons.formal_markers,
             lexicons.informal_markers, lexicons.technical_terms, lexicons.casual_terms,
             lexicons.positive_words, lexicons.negative_words]
    terms = sorted({t for ts in lists for t in ts})
    if "" in terms:
        raise ValueError("terms must be a non-empty list of non-empty strings")
    low = df.select(*by, language.alias("language"), *[c.alias(n) for n, c in more.items()],
                    F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_low"))
    found = low.select(*by, "language", *more, A.automaton_terms(None, F.col("_low"), terms, False).alias("_found"))

    def hits(terms) -> Column:
        return F.size(M.among(F.col("_found"), terms))

    every = M.literal_structs(("dialect", "markers"), lexicons.dialect_markers.items())

    def overlapping(terms: Column) -> Column:
        return F.transform(F.filter(every, lambda d: F.arrays_overlap(d["markers"], terms)),
                           lambda d: d["dialect"])

    # Named: inside the lambda over dialects the optimizer would put the scan itself.
    dialects = F.transform(F.array(F.col("_found")), overlapping)[0]
    polarity = F.transform(
        F.array(F.struct(hits(lexicons.positive_words).alias("p"),
                         hits(lexicons.negative_words).alias("n"))),
        lambda c: F.when(c["p"] + c["n"] > 0, (c["p"] - c["n"]) / (c["p"] + c["n"]))
        .otherwise(0.0))[0]
    return found.select(
        *by, "language", *more, dialects.alias("dialects"),
        hits(lexicons.formal_markers).alias("formal"),
        hits(lexicons.informal_markers).alias("informal"),
        hits(lexicons.technical_terms).alias("technical"),
        hits(lexicons.casual_terms).alias("casual"),
        F.when(F.col("language") == "en", polarity).otherwise(0.0).alias("polarity"),
    )


def text_counts(df: DataFrame, lexicons: Lexicons = DEFAULT_LEXICONS, text_col: str = "text",
                language_col: str | None = "language", by: tuple = ()) -> DataFrame:
    """Texts counted by all that the linguistic measures need (``word`` is null), and tokens counted per word and
    class (``class`` is null for texts), out of one scan of the text.

    Tokens are counted per batch of texts by Arrow and summed by Spark.  They are many, so what is known of a text
    is one column that they leave empty, and their class a flag, until they are summed.
    """
    identified = language_of(F.col(text_col), lexicons.language_profiles, short="unknown", default="unknown")
    features = _features(df, lexicons, text_col, language_col, by, _identified=identified, _text=F.col(text_col))
    known = [c for c in features.columns if c not in ("_text", *by)]
    plain = features.select(*by, F.struct(*known).alias("_known"), "_text")
    schema = T_.StructType([T_.StructField(f.name, f.dataType) for f in plain.drop("_text").schema.fields])
    schema = schema.add("_complex", "boolean").add("_word", "string").add(ROWS, "long")
    names = schema.names

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in (*by, "_known")], pa.nulls(n, pa.bool_()), pa.nulls(n, pa.string()),
                 pa.array([1] * n, pa.int64())], names)
            lists = pc.utf8_split_whitespace(batch.column("_text"))
            at, words = pc.list_parent_indices(lists), pc.list_flatten(lists)
            tokens = pa.table([*[pc.take(batch.column(c), at) for c in by], words], [*by, "_word"]).filter(
                pc.greater(pc.utf8_length(words), 2))
            sums = tokens.group_by([*by, "_word"], use_threads=False).aggregate([([], "count_all")])
            yield from pa.table(
                [*[sums[c] for c in by], pa.nulls(sums.num_rows, batch.schema.field("_known").type),
                 pc.greater(pc.utf8_length(sums["_word"]), 10), sums["_word"], sums["count_all"]], names).to_batches()

    rows = plain.mapInArrow(counted, schema).withColumn("_word", F.lower("_word"))
    sums = settled(rows.groupBy(*by, "_known", "_complex", "_word").agg(F.sum(ROWS).alias(ROWS)))
    return sums.select(
        *by, *[F.col(f"_known.{c}").alias(c) for c in known],
        F.when(F.col("_complex"), "complex").when(~F.col("_complex"), "simple").alias("class"),
        F.col("_word").alias("word"), ROWS)


def dialect_distribution(features: DataFrame, lexicons: Lexicons = DEFAULT_LEXICONS,
                         by: tuple = ()) -> DataFrame:
    """Share of texts with at least one marker, per dialect seen."""
    dialects = list(lexicons.dialect_markers)
    rows = _rows_of(features)
    counts = features.groupBy(*by).agg(
        F.sum(rows).alias("_total"),
        *[F.sum(F.when(F.array_contains("dialects", d), rows).otherwise(0)).alias(f"_d{n}")
          for n, d in enumerate(dialects)])
    rows = F.array(*[F.struct(F.lit(d).alias("dialect"), F.col(f"_d{n}").alias("texts"))
                     for n, d in enumerate(dialects)])
    return (counts.select(*by, "_total", F.explode(rows).alias("_r"))
            .select(*by, "_r.dialect", "_r.texts",
                    (F.col("_r.texts") / F.col("_total")).alias("share"))
            .where("texts > 0"))


def formality_distribution(features: DataFrame, by: tuple = ()) -> DataFrame:
    """Mean share of formal markers over texts with any marker, its population standard
    deviation (named variance), and how far the mean lies beyond 0.7 or below 0.3."""
    ratio = F.col("formal") / (F.col("formal") + F.col("informal"))
    counted = ROWS in features.columns
    marked = features.where("formal + informal > 0").select(*by, ratio.alias("_r"), *[ROWS] * counted)
    mean, deviation = _mean_of(marked, "_r"), F.stddev_pop("_r")
    if counted:  # around the middle of the range, so that little is lost
        away = F.col("_r") - 0.5
        deviation = F.when(F.max("_r") == F.min("_r"), 0.0).otherwise(F.sqrt(F.greatest(
            F.lit(0.0), _mean_of(marked, away * away) - _mean_of(marked, away) * _mean_of(marked, away))))
    return marked.groupBy(*by).agg(
        F.coalesce(F.sum(_rows_of(marked)), F.lit(0)).alias("texts"),
        mean.alias("average_formality"),
        deviation.alias("formality_variance"),
        F.greatest(F.lit(0.0), mean - 0.7).alias("formal_bias"),
        F.greatest(F.lit(0.0), F.lit(0.3) - mean).alias("informal_bias"),
    ).where("texts > 0")


def vocabulary_top(df: DataFrame, k: int = 20, text_col: str = "text",
                   by: tuple = ()) -> DataFrame:
    """The ``k`` most frequent complex (over 10 letters) and simple (3 to 10) tokens.

    Counts are combined before the shuffle, and the rank filter keeps only ``k`` rows per
    task before the final sort, so the two classes do not become two big tasks.
    """
    token = F.explode_outer(F.regexp_extract_all(
        F.col(text_col), F.lit(T.NOT_SPACE_CHAR + "+"), F.lit(0)))
    words = df.select(*by, token.alias("_w")).where(F.length("_w") > 2).select(
        *by, F.when(F.length("_w") > 10, "complex").otherwise("simple").alias("class"),
        F.lower("_w").alias("word"))
    counts = words.groupBy(*by, "class", "word").agg(F.count(F.lit(1)).alias("count"))
    return _top_words(counts, k, by)


def _top_words(counts: DataFrame, k: int, by: tuple) -> DataFrame:
    w = _window(by, "class").orderBy(F.desc("count"), F.asc("word"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def register_bias(features: DataFrame, lexicons: Lexicons = DEFAULT_LEXICONS,
                  by: tuple = ()) -> DataFrame:
    """Mean number of technical and of casual terms over texts with at least one; the list
    is reported when the mean exceeds 2."""
    kinds = {"technical": lexicons.technical_terms, "casual": lexicons.casual_terms}
    means = features.groupBy(*by).agg(*[
        F.coalesce(_mean_of(features, F.when(F.col(k) > 0, F.col(k))), F.lit(0.0)).alias(k) for k in kinds])
    rows = F.array(*[
        F.struct(F.lit(k).alias("register"), F.col(k).alias("mean_terms"),
                 (F.col(k) > 2).alias("flagged"),
                 F.when(F.col(k) > 2, M.literal_array(terms))
                 .otherwise(M.literal_array([])).alias("terms"))
        for k, terms in kinds.items()])
    return means.select(*by, F.inline(rows))


def sentiment_by_group(features: DataFrame, by: tuple = ()) -> DataFrame:
    """Mean polarity per language, and for English texts per dialect they hold."""
    groups = F.concat(
        F.array(F.struct(F.lit("language").alias("kind"), F.col("language").alias("group"))),
        F.when(F.col("language") == "en", F.transform("dialects", lambda d: F.struct(
            F.lit("dialect").alias("kind"), F.concat(F.lit("dialect_"), d).alias("group"))))
        .otherwise(F.expr("CAST(array() AS ARRAY<STRUCT<kind: STRING, group: STRING>>)")))
    grouped = features.select(*by, "polarity", *[ROWS] * (ROWS in features.columns), F.explode_outer(groups).alias("_g"))
    return (grouped.groupBy(*by, F.col("_g.kind").alias("kind"), F.col("_g.group").alias("group"))
            .agg(F.sum(_rows_of(grouped)).alias("texts"), _mean_of(grouped, "polarity").alias("sentiment")))


def sentiment_disparities(sentiments: DataFrame, by: tuple = ()) -> DataFrame:
    """Highest less lowest group mean: languages with more than 10 texts, dialects with more
    than 5, at least two groups."""
    enough = F.when(F.col("kind") == "language", F.col("texts") > 10).otherwise(
        F.col("texts") > 5)
    return (sentiments.where(enough).groupBy(*by, "kind")
            .agg(F.count(F.lit(1)).alias("groups"),
                 (F.max("sentiment") - F.min("sentiment")).alias("disparity"))
            .where("groups > 1"))


def linguistic_analysis(df: DataFrame, lexicons: Lexicons = DEFAULT_LEXICONS,
                        text_col: str = "text", language_col: str | None = "language",
                        by: tuple = (), features: DataFrame | None = None
                        ) -> dict[str, DataFrame]:
    """All linguistic measures, out of one scan of the texts (``text_counts``); ``features`` may be a stored result
    of ``text_features``."""
    from evenhand.operators.preparation import language_distribution, share_of

    if features is None:
        counts = text_counts(df, lexicons, text_col, language_col, by)
        # Summed apart from the many words, so that only one reader passes over those.
        features = settled(counts.where("class IS NULL").groupBy(
            *[c for c in counts.columns if c not in ("class", "word", ROWS)]).agg(F.sum(ROWS).alias(ROWS)))
        languages = share_of(features.select(*by, F.col("_identified").alias("language"), ROWS), "language", by, ROWS)
        # Rows of words have nothing but these, so they are summed already.
        words = counts.where("class IS NOT NULL").select(*by, "class", "word", F.col(ROWS).alias("count"))
        vocabulary = _top_words(words, 20, by)
    else:
        languages = language_distribution(df, lexicons, text_col, by)
        vocabulary = vocabulary_top(df, 20, text_col, by)
    sentiments = sentiment_by_group(features, by)
    return {
        "language_distribution": languages,
        "dialect_distribution": dialect_distribution(features, lexicons, by),
        "formality_distribution": formality_distribution(features, by),
        "vocabulary_top": vocabulary,
        "register_bias": register_bias(features, lexicons, by),
        "sentiment_by_group": sentiments,
        "sentiment_disparities": sentiment_disparities(sentiments, by),
    }


def long_table(parts: dict[str, DataFrame], by: tuple = ()) -> DataFrame:
    """All parts of an analysis as rows of one table: ``by``, part, item, measure, value.

    ``item`` is made of a part's text columns; its numbers and flags are measures, as are the
    entries of its maps, and of a list its length.  Nulls are left out.
    """
    out = None
    for part, df in parts.items():
        names = [f for f in df.schema.fields if f.name not in by]
        item = F.concat_ws("/", *[f.name for f in names if f.dataType.typeName() == "string"])
        pairs = []
        for f in names:
            kind, column = f.dataType.typeName(), F.col(f.name)
            if kind == "map":
                pairs.append(F.transform(F.map_entries(column), lambda e: F.struct(
                    e["key"].alias("measure"), e["value"].cast("double").alias("value"))))
            elif kind != "string":
                number = F.size(column) if kind == "array" else column.cast("double")
                pairs.append(F.array(F.struct(F.lit(f.name).alias("measure"),
                                              number.cast("double").alias("value"))))
        rows = df.select(*by, F.lit(part).alias("part"), item.alias("item"),
                         F.inline_outer(F.concat(*pairs))).where(F.col("value").isNotNull())
        out = rows if out is None else out.unionByName(rows)
    return out


# -- run level --------------------------------------------------------------


def run_metrics(annotated: DataFrame, by: tuple = ()) -> DataFrame:
    """Totals, both rates and the mean score of a run, from texts with their findings.

    ``findings_per_sample`` counts findings, ``biased_sample_rate`` texts with at least one.
    Texts without findings are rows too, so one partial aggregate gives everything.
    """
    found = F.col("findings")
    scores = F.aggregate(found, F.lit(0.0), lambda total, f: total + f["bias_score"])
    sums = annotated.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.coalesce(F.sum(F.size(found)), F.lit(0)).cast("long").alias("finding_count"),
        F.count_if(F.size(found) > 0).alias("biased_samples"),
        F.coalesce(F.sum(scores), F.lit(0.0)).alias("_score"),
        *_counts_in_arrays("bias_type", L.BIAS_TYPES),
        *_counts_in_arrays("severity", L.SEVERITIES),
    )
    return _with_rates(sums, by)


def _counts_in_arrays(field: str, values) -> list[Column]:
    return [
        F.coalesce(F.sum(F.size(F.filter("findings", lambda f: f[field] == F.lit(value)))),
                   F.lit(0)).cast("long").alias(value)
        for value in values
    ]


def _with_rates(sums: DataFrame, by: tuple) -> DataFrame:
    def rate(column):
        return F.when(F.col("total_samples") > 0,
                      F.col(column) / F.col("total_samples")).otherwise(0.0)

    score = F.when(F.col("finding_count") > 0,
                   F.col("_score") / F.col("finding_count")).otherwise(0.0)
    return sums.select(
        *by, "total_samples", "finding_count", "biased_samples",
        rate("finding_count").alias("findings_per_sample"),
        rate("biased_samples").alias("biased_sample_rate"),
        score.alias("overall_bias_score"), *L.BIAS_TYPES, *L.SEVERITIES)


def run_metrics_from_findings(findings: DataFrame, totals: DataFrame, by: tuple = ()
                              ) -> DataFrame:
    """The same row from a stored findings table; findings of one text are combined first,
    so that counting texts needs no distinct."""
    per_text = findings.groupBy(*by, "doc_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("bias_score").alias("_s"),
        *[F.count_if(F.col("bias_type") == t).alias(t) for t in L.BIAS_TYPES],
        *[F.count_if(F.col("severity") == s).alias(s) for s in L.SEVERITIES])
    sums = per_text.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("finding_count"),
        F.count(F.lit(1)).alias("biased_samples"),
        F.coalesce(F.sum("_s"), F.lit(0.0)).alias("_score"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*L.BIAS_TYPES, *L.SEVERITIES]])
    if by:
        filled = totals.select(*by, "total_samples").join(sums, list(by), "left").fillna(0)
    else:
        filled = with_total(sums, totals, by)
    return _with_rates(filled, by)


def by_type(metrics: DataFrame, by: tuple = ()) -> DataFrame:
    """Findings per bias type, zeros included."""
    return _unpivoted(metrics, "bias_type", L.BIAS_TYPES, by)


def by_severity(metrics: DataFrame, by: tuple = ()) -> DataFrame:
    """Findings per severity, zeros included."""
    return _unpivoted(metrics, "severity", L.SEVERITIES, by)


def _unpivoted(metrics: DataFrame, name: str, values, by: tuple) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(v).alias(name), F.col(v).alias("findings"))
                     for v in values])
    return metrics.select(*by, F.inline(rows))


def summary_statistics(metrics: DataFrame, by: tuple = ()) -> DataFrame:
    """One row per run with the counts per type and per severity as maps."""
    def counts(values):
        return F.map_from_entries(F.array(*[
            F.struct(F.lit(v).alias("key"), F.col(v).alias("value")) for v in values]))

    return metrics.select(
        *by, "total_samples", "finding_count", "biased_samples", "findings_per_sample",
        "biased_sample_rate", "overall_bias_score", counts(L.BIAS_TYPES).alias("bias_by_type"),
        counts(L.SEVERITIES).alias("bias_by_severity"))


# The messages of the recommendation rules.
_HIGH_RATE = ("High bias rate detected. Consider comprehensive model retraining with bias "
              "mitigation techniques.")
_MODERATE_RATE = ("Moderate bias rate detected. Implement targeted bias reduction strategies.")
_DEMOGRAPHIC = ("Demographic bias detected in %d instances. "
                "Review training data for representation issues.")
_DEMOGRAPHIC_FIX = "Implement demographic parity constraints during training"
_GENDER = "Gender bias detected in %d instances. Apply gender-neutral language processing."
_GENDER_FIX = "Use counterfactual data augmentation for gender terms"
_CRITICAL = ("CRITICAL: %d instances of critical bias detected. "
             "Immediate intervention required before deployment.")
_LINGUISTIC = ("Significant linguistic bias detected. Consider multilingual training data "
               "balancing.")
_LINGUISTIC_FIX = "Implement cross-lingual bias reduction techniques"


def recommendations(metrics: DataFrame, disparities: DataFrame | None = None,
                    by: tuple = (), rate: str = "biased_sample_rate") -> DataFrame:
    """Messages and mitigations of the rules that apply to a run, in rule order."""
    if disparities is None:
        judged = metrics.withColumn("_gap", F.lit(None).cast("double"))
    else:
        gap = disparities.groupBy(*by).agg(F.max("disparity").alias("_gap"))
        judged = (metrics.join(gap, list(by), "left") if by
                  else metrics.withColumn("_gap", gap.scalar()))

    def rule(number, applies, message, fix=None):
        return F.when(applies, F.struct(
            F.lit(number).alias("rule"), message.alias("recommendation"),
            F.lit(fix).cast("string").alias("mitigation")))

    def counted(template, column):
        return F.format_string(template, F.col(column))

    rules = F.array(
        rule(1, F.col(rate) > 0.2, F.lit(_HIGH_RATE)),
        rule(2, (F.col(rate) > 0.1) & (F.col(rate) <= 0.2), F.lit(_MODERATE_RATE)),
        rule(3, F.col("demographic") > 0, counted(_DEMOGRAPHIC, "demographic"),
             _DEMOGRAPHIC_FIX),
        rule(4, F.col("gender") > 0, counted(_GENDER, "gender"), _GENDER_FIX),
        rule(5, F.col("critical") > 0, counted(_CRITICAL, "critical")),
        rule(6, F.col("_gap") > 0.3, F.lit(_LINGUISTIC), _LINGUISTIC_FIX),
    )
    return judged.select(*by, F.inline(F.filter(rules, lambda r: r.isNotNull())))


