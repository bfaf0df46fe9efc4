"""Corpus aggregates, run comparison and report queries.

A run is a document source: run_id and model_name are the source, and its time is derived
from the number in the source name.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import base as B
from catalog import findings_sql as S
from catalog import text as TX
from catalog.base import NW, sql_list, sql_values
from evenhand import lexicons as L
from evenhand.operators import corpus as C
from evenhand.operators import detection as D
from evenhand.operators import report as R
from evenhand.options import DetectOptions

BY = ("source",)
OPTIONS = DetectOptions(min_group_size=20)


def _r(name, digits=9):
    return F.round(name, digits).alias(name)


def _annotated(spark, sf):
    return D.annotate(B.carrier(spark, sf))


def _findings(spark, sf):
    return D.detect_findings(B.carrier(spark, sf))


def _demographic(spark, sf):
    return D.detect_findings(B.carrier(spark, sf), ("demographic",))


def _totals(spark, sf, by=()):
    return C.total_samples(B.carrier(spark, sf), by)


def _features(spark, sf):
    return C.text_features(B.carrier(spark, sf))


def _comparisons(spark, sf):
    return C.group_comparisons(_demographic(spark, sf))


def run_table(spark, sf):
    """Runs per source with a derived time and duration."""
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    return C.run_metrics(_annotated(spark, sf), BY).select(
        F.col("source").alias("run_id"), F.col("source").alias("model_name"),
        F.timestamp_seconds(F.lit(1704067200) + number * 5400).alias("ts"),
        "total_samples", "finding_count", "biased_samples", "findings_per_sample",
        "biased_sample_rate", "overall_bias_score", (number % 4).cast("double").alias("duration_s"))


def _alerts(spark, sf):
    return (B.table(spark, sf, "events").where("event_type = 'error'")
            .select(F.col("ts").cast("timestamp").alias("ts")))


def _group_findings(spark, sf):
    return C.group_findings(_demographic(spark, sf)).groupBy("group_type", "group_name").agg(
        F.count(F.lit(1)).alias("findings"))


def _group_comparisons(spark, sf):
    return _comparisons(spark, sf).select(
        "group_type", "group_name", "bias_count", _r("avg_bias_score"), _r("max_bias_score"),
        _r("disparity"))


def _severity_distribution(spark, sf):
    out = C.severity_distribution(_comparisons(spark, sf))
    return out.select("group_type", "group_name",
                      F.explode("severity_distribution").alias("severity", "findings"))


def _parity(spark, sf):
    return C.parity_metrics(_comparisons(spark, sf), _totals(spark, sf)).select(
        "group_type", "groups", _r("parity_violation"), _r("equalized_odds"))


def _impact(spark, sf):
    return C.disparate_impact(_comparisons(spark, sf)).select(_r("disparate_impact"))


def _significance(spark, sf):
    return C.significance(_demographic(spark, sf), OPTIONS).select(
        "group_type", "groups", "n", _r("h", 4))


def _significance_p(spark, sf):
    return C.significance(_demographic(spark, sf), OPTIONS).select(
        "group_type", "groups", "n", _r("h", 4), _r("p_value"), "significant")


def _protected(spark, sf):
    return C.protected_attributes(_comparisons(spark, sf))


def _worst(spark, sf):
    return C.worst_disparity(_comparisons(spark, sf)).select(
        "group_type", "group_name", _r("disparity"))


def _long(parts, by=BY):
    return C.long_table(parts, by).select(*by, "part", "item", "measure", _r("value", 6))


def _demographic_analysis(spark, sf):
    """All seven demographic measures of every source in one long table."""
    return _long(C.demographic_analysis(
        D.detect_findings(B.carrier(spark, sf), ("demographic",)), _totals(spark, sf, BY),
        OPTIONS, BY))


def _dialects(spark, sf):
    return C.dialect_distribution(_features(spark, sf)).select("dialect", "texts", _r("share"))


def _formality(spark, sf):
    return C.formality_distribution(_features(spark, sf)).select(
        "texts", *[_r(c) for c in ("average_formality", "formality_variance", "formal_bias",
                                   "informal_bias")])


def _vocabulary(spark, sf):
    return C.vocabulary_top(B.carrier(spark, sf)).select("class", "word", "count", "rank")


def _register(spark, sf):
    return C.register_bias(_features(spark, sf)).select(
        "register", _r("mean_terms"), "flagged", F.size("terms").alias("listed"))


def _sentiment(spark, sf):
    return C.sentiment_by_group(_features(spark, sf)).select(
        "kind", "group", "texts", _r("sentiment"))


def _disparities(spark, sf):
    return C.sentiment_disparities(C.sentiment_by_group(_features(spark, sf))).select(
        "kind", "groups", _r("disparity"))


def _linguistic_analysis(spark, sf):
    """All seven linguistic measures of every source in one long table."""
    return _long(C.linguistic_analysis(B.carrier(spark, sf), by=BY))


RUN_COLUMNS = ["total_samples", "finding_count", "biased_samples"]
RUN_RATES = ["findings_per_sample", "biased_sample_rate", "overall_bias_score"]


def _run_metrics(spark, sf):
    return C.run_metrics(_annotated(spark, sf), BY).select(
        "source", *RUN_COLUMNS, *[_r(c) for c in RUN_RATES])


def _run_metrics_stored(spark, sf):
    return C.run_metrics_from_findings(_findings(spark, sf), _totals(spark, sf, BY), BY).select(
        "source", *RUN_COLUMNS, *[_r(c) for c in RUN_RATES])


def _by_type(spark, sf):
    return C.by_type(C.run_metrics(_annotated(spark, sf)))


def _by_severity(spark, sf):
    return C.by_severity(C.run_metrics(_annotated(spark, sf)))


def _summary(spark, sf):
    out = C.summary_statistics(C.run_metrics(_annotated(spark, sf), BY), BY)
    return out.select("source", "total_samples", "biased_samples",
                      F.explode(F.map_concat("bias_by_type", "bias_by_severity"))
                      .alias("key", "findings"))


def _recommendations(spark, sf):
    metrics = C.run_metrics(_annotated(spark, sf), BY)
    features = C.text_features(B.carrier(spark, sf), by=BY)
    gaps = C.sentiment_disparities(C.sentiment_by_group(features, BY), BY)
    return C.recommendations(metrics, gaps, BY)


def _compare(spark, sf):
    annotated = _annotated(spark, sf)
    return R.compare_models(annotated, ("source",)).select(
        F.col("source").alias("model_name"), *RUN_COLUMNS, *[_r(c) for c in RUN_RATES],
        *L.BIAS_TYPES, *L.SEVERITIES)


def _stamp(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def _trends(spark, sf):
    runs = run_table(spark, sf).withColumn("model_name", F.concat(
        F.lit("m"), F.regexp_extract("run_id", r"(\d+)", 1).cast("int") % 3))
    return R.bias_trends(runs).select(
        "model_name", "run_id", _stamp("ts").alias("ts"), _r("biased_sample_rate"),
        _r("overall_bias_score"), _r("rate_change"), _r("score_change"))


def _hourly(spark, sf):
    return R.hourly_trends(run_table(spark, sf), "2 hours").select(
        _stamp("bucket").alias("bucket"), "total_samples", _r("biased_sample_rate"),
        _r("overall_bias_score"))


def _report(spark, sf):
    return R.comparative_report(run_table(spark, sf)).select(
        "total_samples", "biased_samples", _r("average_bias_rate"), "best_name", "worst_name",
        *[_r(f"{s}_{f}") for s in ("best", "worst") for f in ("rate", "score")])


def _distribution(column):
    return lambda spark, sf: R.value_distribution(_findings(spark, sf), column)


def _filtered(spark, sf):
    out = R.filter_findings(_findings(spark, sf), "demographic", "high", 0.65)
    return out.select("doc_id", "check_name", "group_name", "term", "pattern", _r("bias_score"))


def _histogram(spark, sf):
    return R.score_histogram(_findings(spark, sf)).select(
        "bin", _r("lower"), _r("upper"), "findings")


def _sample(spark, sf):
    return R.sample_findings(_findings(spark, sf)).select(
        "doc_id", "bias_type", "severity", _r("confidence"), _r("bias_score"))


def _period(spark, sf):
    return R.period_report(run_table(spark, sf), _alerts(spark, sf), "daily").select(
        _stamp("period").alias("period"), "texts", "findings", "alerts", _r("avg_score"))


def _flagship(spark, sf):
    """Trait findings per group and severity over preprocessed texts."""
    from evenhand.operators.preparation import preprocess

    texts = preprocess(B.carrier(spark, sf), DetectOptions(max_text_length=None))
    return D.detect_findings(texts, ("trait",)).groupBy(
        "group_type", "group_name", "severity").agg(F.count(F.lit(1)).alias("findings"))


def _detect_run(spark, sf):
    """A whole run per source: rates of the preprocessed texts and the advice they give."""
    from evenhand.plans.run import detect

    run = detect(B.carrier(spark, sf), by=BY, persist=False)
    metrics = run.metrics.select("source", *RUN_COLUMNS, *[_r(c) for c in RUN_RATES])
    advice = run.recommendations.groupBy("source").agg(
        F.count(F.lit(1)).alias("rules"), F.count("mitigation").alias("mitigations"))
    return metrics.join(advice, "source", "left")


def _run(spark, sf):
    from catalog.variants import modulo_pick
    from evenhand.plans.run import detect

    return detect(B.carrier(spark, sf), options=OPTIONS, by=BY, persist=False, pick=modulo_pick)


def _run_demographic(spark, sf):
    """The demographic tables of a whole run, over its preprocessed texts."""
    return _long(_run(spark, sf).demographic)


def _run_linguistic(spark, sf):
    """The linguistic tables of a whole run."""
    return _long(_run(spark, sf).linguistic)


def _run_counterfactual(spark, sf):
    """The counterfactual table of a whole run and what it comes to per source."""
    from evenhand.operators.counterfactual import counterfactual_analysis

    return counterfactual_analysis(_run(spark, sf).counterfactual, BY).select(
        "source", "texts", _r("average_bias_change"), "significant_changes")


QUERIES = {
    "flagship": _flagship,
    "detect_run": _detect_run,
    "detect_run_demographic": _run_demographic,
    "detect_run_linguistic": _run_linguistic,
    "detect_run_counterfactual": _run_counterfactual,
    "group_findings": _group_findings,
    "group_comparisons": _group_comparisons,
    "severity_distribution": _severity_distribution,
    "parity_metrics": _parity,
    "disparate_impact": _impact,
    "kruskal_wallis": _significance,
    "kruskal_wallis_p": _significance_p,
    "protected_attributes": _protected,
    "worst_disparity": _worst,
    "demographic_analysis": _demographic_analysis,
    "dialect_distribution": _dialects,
    "formality_distribution": _formality,
    "vocabulary_top": _vocabulary,
    "register_bias": _register,
    "sentiment_by_group": _sentiment,
    "sentiment_disparities": _disparities,
    "linguistic_analysis": _linguistic_analysis,
    "run_metrics": _run_metrics,
    "run_metrics_from_findings": _run_metrics_stored,
    "by_type": _by_type,
    "by_severity": _by_severity,
    "summary_statistics": _summary,
    "recommendations": _recommendations,
    "compare_models": _compare,
    "bias_trends": _trends,
    "hourly_trends": _hourly,
    "comparative_report": _report,
    "type_distribution": _distribution("bias_type"),
    "severity_counts": _distribution("severity"),
    "filter_findings": _filtered,
    "score_histogram": _histogram,
    "sample_findings": _sample,
    "period_report": _period,
}

# -- SQL --------------------------------------------------------------------

DEMO = S.findings_cte(checks=["occupation", "trait", "exclusion"])
ALL = S.findings_cte()


def comparisons_sql(by: str = "") -> str:
    """CTE ``comparisons`` with the disparity to the mean of the other groups' means."""
    keys = f"{by}, " if by else ""
    same = f"o.{by} = g.{by} AND " if by else ""
    source = (f"(SELECT f.*, source FROM findings f JOIN low USING (doc_id))" if by
              else "findings")
    return f"""groups AS (SELECT {keys}group_type, group_name, count(*) AS bias_count,
      avg(bias_score) AS avg_score, max(bias_score) AS max_score,
      count(*) FILTER (severity IN ('high', 'critical')) AS severe
      FROM {source} WHERE bias_type = 'demographic' AND group_type IS NOT NULL GROUP BY ALL),
    comparisons AS (SELECT g.*, abs(avg_score - (SELECT avg(o.avg_score) FROM groups o
      WHERE {same}o.group_type = g.group_type AND o.group_name <> g.group_name)) AS disparity
      FROM groups g)"""


def parity_sql(by: str = "") -> str:
    keys = f"{by}, " if by else ""
    where = f" WHERE low.{by} = c.{by}" if by else ""
    return f"""rated AS (SELECT *, bias_count / (SELECT count(*) FROM low{where}) AS rate
      FROM comparisons c),
    parity AS (SELECT {keys}group_type, count(*) AS groups,
      1e0 - min(rate) / max(rate) AS parity_violation,
      CASE WHEN count(*) = 2 THEN max(rate) - min(rate) END AS equalized_odds
      FROM rated GROUP BY ALL HAVING count(*) >= 2)"""


KRUSKAL = """scored AS (SELECT group_type AS by_key, group_name AS grp, bias_score AS score
      FROM findings WHERE group_type IS NOT NULL),
    big AS (SELECT by_key, grp FROM scored GROUP BY ALL HAVING count(*) >= 20),
    ranked AS (SELECT s.*, rank() OVER (PARTITION BY by_key ORDER BY score)
        + (count(*) OVER (PARTITION BY by_key, score) - 1) / 2 AS rnk,
        count(*) OVER (PARTITION BY by_key, score) AS t
      FROM scored s JOIN big USING (by_key, grp)),
    sums AS (SELECT by_key, grp, count(*) AS n, sum(rnk) AS r, sum(t * t - 1) AS ties
      FROM ranked GROUP BY ALL),
    h AS (SELECT by_key AS group_type, count(*) AS groups, sum(n) AS n,
      (12e0 / (sum(n) * (sum(n) + 1e0)) * sum(r * r / n) - 3e0 * (sum(n) + 1))
        / (1e0 - sum(ties) / (sum(n)::DOUBLE ^ 3 - sum(n))) AS h
      FROM sums GROUP BY by_key HAVING count(*) >= 2)"""

_count = S.count_of
FEATURES = f"""{S.LOW_CARRIER},
    dialect_lists AS (SELECT * FROM {sql_values(
        (d, B.raw(sql_list(m))) for d, m in L.DIALECT_MARKERS.items())} t(dialect, markers)),
    text_dialects AS (SELECT doc_id, source, language, dialect FROM low, dialect_lists
      WHERE len(list_filter(markers, lambda m: contains(low, m))) > 0),
    features AS (SELECT doc_id, source, language, {_count(L.FORMAL_MARKERS)} AS formal,
      {_count(L.INFORMAL_MARKERS)} AS informal, {_count(L.TECHNICAL_TERMS)} AS technical,
      {_count(L.CASUAL_TERMS)} AS casual, {_count(L.TRAITS['positive_traits'])} AS pos,
      {_count(L.TRAITS['negative_traits'])} AS neg FROM low),
    polarities AS (SELECT *, CASE WHEN language = 'en' AND pos + neg > 0
      THEN (pos - neg) / (pos + neg) ELSE 0e0 END AS polarity FROM features)"""


def sentiments_sql(by: str = "") -> str:
    keys = f"{by}, " if by else ""
    pkeys = f"p.{by}, " if by else ""
    return f"""sentiments AS (
      SELECT {keys}'language' AS kind, language AS "group", count(*) AS texts,
        avg(polarity) AS sentiment FROM polarities GROUP BY ALL
      UNION ALL
      SELECT {pkeys}'dialect', 'dialect_' || dialect, count(*), avg(polarity)
      FROM polarities p JOIN text_dialects d USING (doc_id) WHERE p.language = 'en'
      GROUP BY ALL),
    gaps AS (SELECT {keys}kind, count(*) AS groups, max(sentiment) - min(sentiment) AS disparity
      FROM sentiments WHERE (kind = 'language' AND texts > 10) OR (kind = 'dialect' AND texts > 5)
      GROUP BY ALL HAVING count(*) > 1)"""


def runs_sql(by: str = "source") -> str:
    """CTE ``metrics``: one row per ``by`` with totals, rates and zero-filled counts."""
    types = ", ".join(f"count(*) FILTER (bias_type = '{t}') AS {t}" for t in L.BIAS_TYPES)
    levels = ", ".join(f"count(*) FILTER (severity = '{s}') AS {s}" for s in L.SEVERITIES)
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c in [*L.BIAS_TYPES, *L.SEVERITIES])
    return f"""run_findings AS (SELECT {by}, count(*) AS finding_count,
      count(DISTINCT doc_id) AS biased_samples, avg(bias_score) AS score, {types}, {levels}
      FROM findings JOIN low USING (doc_id) GROUP BY {by}),
    metrics AS (SELECT {by}, total_samples, coalesce(finding_count, 0) AS finding_count,
      coalesce(biased_samples, 0) AS biased_samples,
      coalesce(finding_count, 0) / total_samples AS findings_per_sample,
      coalesce(biased_samples, 0) / total_samples AS biased_sample_rate,
      coalesce(score, 0e0) AS overall_bias_score, {zero}
      FROM (SELECT {by}, count(*) AS total_samples FROM low GROUP BY {by})
      LEFT JOIN run_findings USING ({by}))"""


RUNS = f"""{runs_sql()}, runs AS (SELECT source AS run_id, source AS model_name,
    TIMESTAMP '2024-01-01' + to_seconds(5400 * regexp_extract(source, '(\\d+)', 1)::INT) AS ts,
    regexp_extract(source, '(\\d+)', 1)::INT % 4 AS duration_s, * FROM metrics)"""

_RUN_SELECT = ("total_samples, finding_count, biased_samples, "
               + ", ".join(f"round({c}, 9) AS {c}" for c in RUN_RATES))

_UNPIVOT_TYPES = " UNION ALL ".join(
    f"SELECT '{t}' AS bias_type, count(*) FILTER (bias_type = '{t}') AS findings FROM findings"
    for t in L.BIAS_TYPES)
_UNPIVOT_LEVELS = " UNION ALL ".join(
    f"SELECT '{s}' AS severity, count(*) FILTER (severity = '{s}') AS findings FROM findings"
    for s in L.SEVERITIES)

_MESSAGES = f"""
    SELECT source, 1 AS rule, 'High bias rate detected. Consider comprehensive model retraining with bias mitigation techniques.' AS recommendation, NULL AS mitigation
      FROM metrics WHERE biased_sample_rate > 0.2
    UNION ALL SELECT source, 2, 'Moderate bias rate detected. Implement targeted bias reduction strategies.', NULL
      FROM metrics WHERE biased_sample_rate > 0.1 AND biased_sample_rate <= 0.2
    UNION ALL SELECT source, 3, 'Demographic bias detected in ' || demographic || ' instances. Review training data for representation issues.', 'Implement demographic parity constraints during training'
      FROM metrics WHERE demographic > 0
    UNION ALL SELECT source, 4, 'Gender bias detected in ' || gender || ' instances. Apply gender-neutral language processing.', 'Use counterfactual data augmentation for gender terms'
      FROM metrics WHERE gender > 0
    UNION ALL SELECT source, 5, 'CRITICAL: ' || critical || ' instances of critical bias detected. Immediate intervention required before deployment.', NULL
      FROM metrics WHERE critical > 0
    UNION ALL SELECT source, 6, 'Significant linguistic bias detected. Consider multilingual training data balancing.', 'Implement cross-lingual bias reduction techniques'
      FROM (SELECT source, max(disparity) AS gap FROM gaps GROUP BY source) WHERE gap > 0.3"""

_FEATURES_ONLY = FEATURES.split(S.LOW_CARRIER + ",", 1)[1]

_PREPARED = S.LOW_CARRIER.replace("lower(text)", f"lower({TX.preprocess_sql('text')})")

_PREPARED_CARRIER = (B.CARRIER.replace("carrier AS", "unprepared AS", 1)
                     + f", carrier AS (SELECT * REPLACE ({TX.preprocess_sql('text')} AS text) FROM unprepared)")


def _unpivoted(part: str, item: str, measures: list[str], table: str, more: str = "") -> str:
    """Rows of a part, nulls left out."""
    values = ", ".join(f"('{m.split(' AS ')[-1]}', ({m.split(' AS ')[0]})::DOUBLE)" for m in measures)
    return (f"SELECT t.source AS source, '{part}' AS part, {item} AS item, v.measure, v.value "
            f"FROM {table} t, LATERAL (VALUES {values}) v(measure, value) {more}")


def _long_sql(parts: list[str]) -> str:
    return (f"SELECT source, part, item, measure, round(value, 6) AS value FROM ({' UNION ALL '.join(parts)}) "
            "WHERE value IS NOT NULL")


def demographic_long(findings: str) -> str:
    """All demographic measures per source, unpivoted."""
    group, levels = "t.group_type || '/' || t.group_name", ", ".join(
        f"count(*) FILTER (severity = '{s}') AS {s}" for s in L.SEVERITIES)
    kruskal = KRUSKAL.replace("SELECT group_type AS by_key", "SELECT low.source || '|' || group_type AS by_key").replace(
        "FROM findings WHERE", "FROM findings JOIN low USING (doc_id) WHERE bias_type = 'demographic' AND")
    return f"""{findings}, {comparisons_sql('source')}, {parity_sql('source')}, {kruskal},
        levels AS (SELECT source, group_type, group_name, {levels} FROM findings JOIN low USING (doc_id)
          WHERE bias_type = 'demographic' AND group_type IS NOT NULL GROUP BY ALL),
        compared AS (SELECT c.*, {', '.join(f'l.{s}' for s in L.SEVERITIES)},
          count(*) OVER (PARTITION BY c.source, c.group_type) AS n_groups
          FROM comparisons c JOIN levels l ON c.source = l.source AND c.group_type = l.group_type AND c.group_name = l.group_name),
        impact AS (SELECT source, coalesce(avg(disparity), 0e0) AS v FROM comparisons GROUP BY source),
        tested AS (SELECT split_part(group_type, '|', 1) AS source, split_part(group_type, '|', 2) AS kind, groups, n, h,
          {B.gamma_tail_sql('h', 'groups - 1')} AS p FROM h),
        protected AS (SELECT source, group_type, sum(bias_count) AS findings, sum(severe) AS severe FROM comparisons
          GROUP BY ALL HAVING sum(bias_count) > 10 AND sum(severe) > 5),
        worst AS (SELECT * FROM comparisons WHERE disparity > 0 QUALIFY row_number() OVER (PARTITION BY source
          ORDER BY round(disparity, 12) DESC, group_type, group_name) = 1)
        """ + _long_sql([
        _unpivoted("group_comparisons", group, ["bias_count", "avg_score AS avg_bias_score", "max_score AS max_bias_score",
                                                *L.SEVERITIES, "n_groups AS groups", "disparity"], "compared"),
        _unpivoted("severity_distribution", group, [f"nullif({s}, 0) AS {s}" for s in L.SEVERITIES], "levels"),
        _unpivoted("parity_metrics", "t.group_type", ["groups", "parity_violation", "equalized_odds"], "parity"),
        _unpivoted("disparate_impact", "''", ["v AS disparate_impact"], "impact"),
        _unpivoted("significance", "t.kind", ["groups", "n", "h", "p AS p_value", "coalesce(p < 0.05e0, false) AS significant"], "tested"),
        _unpivoted("protected_attributes", "t.group_type", ["findings", "severe"], "protected"),
        _unpivoted("worst_disparity", group, ["disparity"], "worst")])


def linguistic_long(carrier: str, features: str) -> str:
    """All linguistic measures per source, unpivoted."""
    languages = TX.language_sql("unknown", "unknown").replace("FROM documents", "FROM carrier").replace("doc_id, lang,", "doc_id, source,")
    return f"""WITH {features}, {sentiments_sql('source')}, {languages},
        totals AS (SELECT source, count(*) AS total FROM low GROUP BY source),
        spoken AS (SELECT source, language, count(*) AS texts, count(*) / any_value(total) AS share
          FROM languages JOIN totals USING (source) GROUP BY ALL),
        dialects AS (SELECT source, dialect, count(*) AS texts, count(*) / any_value(total) AS share
          FROM text_dialects JOIN totals USING (source) GROUP BY ALL),
        ratios AS (SELECT source, formal / (formal + informal) AS r FROM features WHERE formal + informal > 0),
        formality AS (SELECT source, count(*) AS texts, avg(r) AS mean, stddev_pop(r) AS spread FROM ratios GROUP BY source),
        tokens AS (SELECT source, unnest(regexp_extract_all(text, '[^{TX.SPACE[1:]}+')) AS w FROM carrier),
        counted AS (SELECT source, CASE WHEN length(w) > 10 THEN 'complex' ELSE 'simple' END AS class, lower(w) AS word,
          count(*) AS n FROM tokens WHERE length(w) > 2 GROUP BY ALL),
        vocabulary AS (SELECT *, row_number() OVER (PARTITION BY source, class ORDER BY n DESC, word) AS place
          FROM counted QUALIFY place <= 20),
        registers AS (SELECT source, register, coalesce(v, 0e0) AS v FROM (
          SELECT source, 'technical' AS register, avg(technical) FILTER (technical > 0) AS v FROM features GROUP BY source
          UNION ALL SELECT source, 'casual', avg(casual) FILTER (casual > 0) FROM features GROUP BY source))
        """ + _long_sql([
        _unpivoted("language_distribution", "t.language", ["texts", "share"], "spoken"),
        _unpivoted("dialect_distribution", "t.dialect", ["texts", "share"], "dialects"),
        _unpivoted("formality_distribution", "''", ["texts", "mean AS average_formality", "spread AS formality_variance",
            "greatest(0e0, mean - 0.7e0) AS formal_bias", "greatest(0e0, 0.3e0 - mean) AS informal_bias"], "formality"),
        _unpivoted("vocabulary_top", "t.class || '/' || t.word", ["n AS count", "place AS rank"], "vocabulary"),
        _unpivoted("register_bias", "t.register", ["v AS mean_terms", "v > 2 AS flagged", "CASE WHEN v > 2 THEN 8 ELSE 0 END AS terms"], "registers"),
        _unpivoted("sentiment_by_group", "t.kind || '/' || t.\"group\"", ["texts", "sentiment"], "sentiments"),
        _unpivoted("sentiment_disparities", "t.kind", ["groups", "disparity"], "gaps")])


def _run_counterfactual_sql() -> str:
    from catalog.variants import differences_sql

    return f"""{differences_sql(_PREPARED_CARRIER)} SELECT source, count(*) AS texts,
        round(avg(difference), 9) AS average_bias_change,
        count(*) FILTER (difference > 0.1e0) AS significant_changes
        FROM differences JOIN carrier USING (doc_id) GROUP BY source"""


SQL = {
    "detect_run_demographic": demographic_long(S.findings_cte(_PREPARED)),
    "detect_run_linguistic": linguistic_long(_PREPARED_CARRIER, FEATURES.replace(S.LOW_CARRIER, _PREPARED).replace(
        B.CARRIER, _PREPARED_CARRIER)),
    "detect_run_counterfactual": _run_counterfactual_sql(),
    "detect_run": f"""{S.findings_cte(_PREPARED)}, {runs_sql()},
        {_FEATURES_ONLY.replace('dialect_lists AS', 'marker_lists AS').replace('FROM low, dialect_lists', 'FROM low, marker_lists')},
        {sentiments_sql('source')}, messages AS ({_MESSAGES})
        SELECT source, {_RUN_SELECT}, rules, mitigations FROM metrics LEFT JOIN (
          SELECT source, count(*) AS rules, count(mitigation) AS mitigations FROM messages
          GROUP BY source) USING (source)""",
    "flagship": f"""{S.findings_cte(checks=['trait']).replace(
        'lower(text)', f"lower({TX.anonymize_sql(TX.clean_sql('text'))})")}
        SELECT group_type, group_name, severity, count(*) AS findings FROM findings GROUP BY ALL""",
    "group_findings": f"{DEMO} SELECT group_type, group_name, count(*) AS findings FROM findings "
                      "WHERE group_type IS NOT NULL GROUP BY ALL",
    "group_comparisons": f"""{DEMO}, {comparisons_sql()} SELECT group_type, group_name, bias_count,
        round(avg_score, 9) AS avg_bias_score, round(max_score, 9) AS max_bias_score,
        round(disparity, 9) AS disparity FROM comparisons""",
    "severity_distribution": f"{DEMO} SELECT group_type, group_name, severity, "
                             "count(*) AS findings FROM findings GROUP BY ALL",
    "parity_metrics": f"""{DEMO}, {comparisons_sql()}, {parity_sql()} SELECT group_type, groups,
        round(parity_violation, 9) AS parity_violation,
        round(equalized_odds, 9) AS equalized_odds FROM parity""",
    "disparate_impact": f"{DEMO}, {comparisons_sql()} SELECT "
                        "round(coalesce(avg(disparity), 0e0), 9) AS disparate_impact "
                        "FROM comparisons",
    "kruskal_wallis": f"{DEMO}, {KRUSKAL} SELECT group_type, groups, n, round(h, 4) AS h FROM h",
    "kruskal_wallis_p": f"""{DEMO}, {KRUSKAL}, p AS (SELECT *,
        {B.gamma_tail_sql('h', 'groups - 1')} AS p_value FROM h)
        SELECT group_type, groups, n, round(h, 4) AS h, round(p_value, 9) AS p_value,
          coalesce(p_value < 0.05e0, false) AS significant FROM p""",
    "protected_attributes": f"""{DEMO}, {comparisons_sql()} SELECT group_type,
        sum(bias_count) AS findings, sum(severe) AS severe FROM comparisons GROUP BY group_type
        HAVING sum(bias_count) > 10 AND sum(severe) > 5""",
    "worst_disparity": f"""{DEMO}, {comparisons_sql()} SELECT group_type, group_name,
        round(disparity, 9) AS disparity FROM comparisons WHERE disparity > 0
        ORDER BY round(comparisons.disparity, 12) DESC, group_type, group_name LIMIT 1""",
    "demographic_analysis": demographic_long(DEMO),
    "dialect_distribution": f"""WITH {FEATURES} SELECT dialect, count(*) AS texts,
        round(count(*) / (SELECT count(*) FROM low), 9) AS share FROM text_dialects
        GROUP BY dialect""",
    "formality_distribution": f"""WITH {FEATURES}, ratios AS (SELECT formal / (formal + informal) AS r
        FROM features WHERE formal + informal > 0) SELECT count(*) AS texts,
        round(avg(r), 9) AS average_formality, round(stddev_pop(r), 9) AS formality_variance,
        round(greatest(0e0, avg(r) - 0.7e0), 9) AS formal_bias,
        round(greatest(0e0, 0.3e0 - avg(r)), 9) AS informal_bias FROM ratios
        HAVING count(*) > 0""",
    "vocabulary_top": f"""WITH {B.CARRIER}, tokens AS (SELECT unnest(
        regexp_extract_all(text, '[^{TX.SPACE[1:]}+')) AS w FROM carrier),
        counted AS (SELECT CASE WHEN length(w) > 10 THEN 'complex' ELSE 'simple' END AS class,
          lower(w) AS word, count(*) AS count FROM tokens WHERE length(w) > 2 GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY class
          ORDER BY count DESC, word COLLATE "C") AS rank FROM counted)
        SELECT class, word, count, rank FROM ranked WHERE rank <= 20""".replace(
            ' COLLATE "C"', ""),
    "register_bias": f"""WITH {FEATURES}, m AS (
        SELECT 'technical' AS register, coalesce(avg(technical) FILTER (technical > 0), 0e0) AS v
          FROM features
        UNION ALL SELECT 'casual', coalesce(avg(casual) FILTER (casual > 0), 0e0) FROM features)
        SELECT register, round(v, 9) AS mean_terms, v > 2 AS flagged,
          CASE WHEN v > 2 THEN 8 ELSE 0 END AS listed FROM m""",
    "sentiment_by_group": f"""WITH {FEATURES}, {sentiments_sql()} SELECT kind, "group", texts,
        round(sentiment, 9) AS sentiment FROM sentiments""",
    "sentiment_disparities": f"WITH {FEATURES}, {sentiments_sql()} SELECT kind, groups, "
                             "round(disparity, 9) AS disparity FROM gaps",
    "linguistic_analysis": linguistic_long(f"{B.CARRIER}", FEATURES),
    "run_metrics": f"{ALL}, {runs_sql()} SELECT source, {_RUN_SELECT} FROM metrics",
    "run_metrics_from_findings":
        f"{ALL}, {runs_sql()} SELECT source, {_RUN_SELECT} FROM metrics",
    "by_type": f"{ALL} {_UNPIVOT_TYPES}",
    "by_severity": f"{ALL} {_UNPIVOT_LEVELS}",
    "summary_statistics": f"""{ALL}, {runs_sql()} SELECT source, total_samples, biased_samples,
        key, findings FROM (UNPIVOT metrics ON {', '.join([*L.BIAS_TYPES, *L.SEVERITIES])}
        INTO NAME key VALUE findings)""",
    "recommendations": f"{ALL}, {runs_sql()}, "
                       f"{_FEATURES_ONLY.replace('dialect_lists AS', 'marker_lists AS').replace('FROM low, dialect_lists', 'FROM low, marker_lists')}, "
                       f"{sentiments_sql('source')} {_MESSAGES}",
    "compare_models": f"""{ALL}, {runs_sql()} SELECT source AS model_name, {_RUN_SELECT},
        {', '.join([*L.BIAS_TYPES, *L.SEVERITIES])} FROM metrics""",
    "bias_trends": f"""{ALL}, {RUNS}, named AS (SELECT *, 'm' || (regexp_extract(run_id, '(\\d+)', 1)::INT % 3)
        AS m FROM runs) SELECT m AS model_name, run_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
        round(biased_sample_rate, 9) AS biased_sample_rate,
        round(overall_bias_score, 9) AS overall_bias_score,
        round(biased_sample_rate - lag(biased_sample_rate) OVER w, 9) AS rate_change,
        round(overall_bias_score - lag(overall_bias_score) OVER w, 9) AS score_change
        FROM named WINDOW w AS (PARTITION BY m ORDER BY named.ts)""",
    "hourly_trends": f"""{ALL}, {RUNS} SELECT
        strftime(time_bucket(INTERVAL '2 hours', ts), '%Y-%m-%d %H:%M:%S') AS bucket,
        sum(total_samples) AS total_samples,
        round(sum(biased_samples) / sum(total_samples), 9) AS biased_sample_rate,
        round(sum(overall_bias_score * finding_count) / sum(finding_count), 9)
          AS overall_bias_score FROM runs GROUP BY 1""",
    "comparative_report": f"""{ALL}, {RUNS},
        best AS (SELECT * FROM runs ORDER BY biased_sample_rate, ts LIMIT 1),
        worst AS (SELECT * FROM runs ORDER BY biased_sample_rate DESC, ts LIMIT 1)
        SELECT (SELECT sum(total_samples) FROM runs) AS total_samples,
          (SELECT sum(biased_samples) FROM runs) AS biased_samples,
          (SELECT round(sum(biased_samples) / sum(total_samples), 9) FROM runs) AS average_bias_rate,
          best.model_name AS best_name, worst.model_name AS worst_name,
          round(best.biased_sample_rate, 9) AS best_rate,
          round(best.overall_bias_score, 9) AS best_score,
          round(worst.biased_sample_rate, 9) AS worst_rate,
          round(worst.overall_bias_score, 9) AS worst_score FROM best, worst""",
    "type_distribution": f"{ALL} SELECT bias_type, count(*) AS findings FROM findings GROUP BY 1",
    "severity_counts": f"{ALL} SELECT severity, count(*) AS findings FROM findings GROUP BY 1",
    "filter_findings": f"""{ALL} SELECT doc_id, check_name, group_name, term, pattern,
        round(bias_score, 9) AS bias_score FROM findings WHERE bias_type = 'demographic'
        AND severity = 'high' AND bias_score >= 0.65e0""",
    "score_histogram": f"""{ALL}, binned AS (SELECT greatest(1, least(20,
        floor(bias_score * 20)::INT + 1)) AS bin FROM findings)
        SELECT b AS bin, round((b - 1) * 0.05e0, 9) AS lower, round(b * 0.05e0, 9) AS upper,
          (SELECT count(*) FROM binned WHERE bin = b) AS findings
        FROM (SELECT unnest(range(1, 21)) AS b)""",
    "sample_findings": f"""{ALL} SELECT doc_id, bias_type, severity,
        round(bias_score, 9) AS confidence, round(bias_score, 9) AS bias_score FROM findings
        ORDER BY doc_id, check_name, group_type NULLS FIRST, group_name NULLS FIRST,
          term NULLS FIRST, pattern NULLS FIRST, category NULLS FIRST LIMIT 10""",
    "period_report": f"""{ALL}, {RUNS}, r AS (SELECT date_trunc('day', ts) AS period,
          sum(total_samples) AS texts, sum(finding_count) AS findings,
          sum(overall_bias_score * finding_count) AS score FROM runs GROUP BY 1),
        a AS (SELECT date_trunc('day', ts) AS period, count(*) AS alerts FROM events
          WHERE event_type = 'error' GROUP BY 1),
        b AS (SELECT coalesce(r.period, a.period) AS period, coalesce(texts, 0) AS texts,
          coalesce(findings, 0) AS findings, coalesce(alerts, 0) AS alerts,
          coalesce(score, 0e0) AS score FROM r FULL JOIN a ON r.period = a.period)
        SELECT strftime(period, '%Y-%m-%d %H:%M:%S') AS period, sum(texts) AS texts,
          sum(findings) AS findings, sum(alerts) AS alerts,
          round(CASE WHEN sum(findings) > 0 THEN sum(score) / sum(findings) END, 9) AS avg_score
        FROM b GROUP BY ROLLUP (period)""",
}
