"""Fairness, rank test and data quality queries."""

from __future__ import annotations


from pyspark.sql import functions as F

from catalog import base as B
from catalog import corpus as CC
from catalog import text as TX
from evenhand.operators import fairness as E
from evenhand.operators import quality as Q
from evenhand.operators import ranks as K
from evenhand.operators.detection import detect_findings

INSULTS = ["trash", "idiot", "scum", "clown", "worthless", "moron", "pathetic", "loser",
           "stupid", "disgusting"]


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _r(name, digits=9):
    return F.round(name, digits).alias(name)


def _labelled(spark, sf):
    """y_true = toxic, y_pred = the text holds an insult, sensitive = language."""
    documents = B.table(spark, sf, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        F.lower("text").rlike("|".join(INSULTS)).cast("int").alias("y_pred"))
    labels = B.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("y_true"),
                                                 "quality")
    return documents.join(labels, "doc_id")


def _parity(spark, sf):
    return E.demographic_parity_difference(_labelled(spark, sf), "y_pred", "lang").select(
        _r("demographic_parity_difference"))


def _odds(spark, sf):
    return E.equalized_odds_difference(_labelled(spark, sf), "y_true", "y_pred", "lang").select(
        _r("tpr_difference"), _r("fpr_difference"))


def _impact(spark, sf):
    return E.disparate_impact_ratio(_labelled(spark, sf), "quality", "lang").select(
        _r("disparate_impact_ratio"))


def _individual(spark, sf):
    return E.individual_fairness(
        B.table(spark, sf, "embeddings"), "embedding", "label", threshold=0.3).select(
        "similar_pairs", "differing_pairs", _r("individual_fairness"))


def _individual_banded(spark, sf):
    """The banded count beside the exact one; ``found`` says that it has at least 0.9 of the pairs."""
    vectors = B.table(spark, sf, "embeddings")
    exact = E.individual_fairness(vectors, "embedding", "label", threshold=0.3)
    banded = E.individual_fairness_banded(vectors, "embedding", "label", threshold=0.3, bits=6)
    share = F.col("banded") / F.col("similar_pairs")
    both = exact.select("similar_pairs", F.lit(1).alias("one")).join(
        banded.select(F.col("similar_pairs").alias("banded"), "expected_recall", F.lit(1).alias("one")), "one")
    return both.select("similar_pairs", ((share >= 0.9) & (share <= 1)).alias("found"),
                       (F.col("expected_recall") >= 0.98).alias("expected"))


def _individual_texts(spark, sf):
    """Letter counts of every document; y = insult found."""
    low = B.documents(spark, sf).select(F.lower("text").alias("low"))
    letters = F.array(*[
        (F.length("low") - F.length(F.replace("low", F.lit(c)))).cast("double")
        for c in LETTERS])
    docs = low.select(letters.alias("v"), F.col("low").rlike("|".join(INSULTS)).cast("int")
                      .alias("y"))
    return E.individual_fairness(docs, "v", "y", threshold=0.98).select(
        "similar_pairs", "differing_pairs", _r("individual_fairness"))


def _mann_whitney(spark, sf):
    return K.mann_whitney(_labelled(spark, sf), "y_true", "n_chars", 1, 0).select(
        "n1", "n2", "u")


def _mann_whitney_p(spark, sf):
    return K.mann_whitney(_labelled(spark, sf), "y_true", "n_chars", 1, 0).select(
        "n1", "n2", "u", _r("p_value"), "significant")


def _kruskal_events(spark, sf):
    return K.kruskal_wallis(B.table(spark, sf, "events"), "event_type", "value").select(
        "groups", "n", _r("h", 4))


def _amplification(spark, sf):
    flagged = F.lower("text").rlike("|".join([*INSULTS, "le ", "the "])).cast("int")
    turns = B.table(spark, sf, "conversations").where("role <> 'system'").select(
        F.when(F.col("role") == "user", "input").otherwise("output").alias("side"),
        flagged.alias("flag"))
    return E.bias_amplification(turns, "side", "flag").select(
        _r("input_rate"), _r("output_rate"), _r("amplification"))


def _flesch(spark, sf):
    from evenhand.functions.text import readability

    return B.documents(spark, sf).select(
        "lang", "source", readability(F.col("text"))["flesch_score"].alias("score"))


def _intersectional(spark, sf):
    return E.intersectional_bias(_flesch(spark, sf), ["lang", "source"], "score").select(
        _r("intersectional_variance", 4), _r("max_disparity"), _r("weighted_mean"), "num_groups")


def _cube(spark, sf):
    return E.intersectional_means(_flesch(spark, sf), ["lang", "source"], "score").select(
        "lang", "source", _r("mean_score"), "rows")


def _validate_texts(spark, sf):
    return Q.validate_texts(B.carrier(spark, sf).select("text")).select(
        "total_texts", "valid_texts", _r("avg_length"), "min_length", "max_length",
        _r("duplicate_ratio"), "is_valid", F.array_join("errors", ";").alias("errors"),
        F.array_join("warnings", ";").alias("warnings"))


def _duplicates(spark, sf):
    return Q.duplicate_ratio(B.documents(spark, sf)).select(
        "valid_texts", "distinct_texts", _r("duplicate_ratio"))


def _sketched(spark, sf):
    """Distinct texts from stored sketches of each source; ``near`` says that the estimate is within 2 %."""
    path = B.scratch_dir(spark)
    Q.text_sketches(B.documents(spark, sf), ("source",)).write.parquet(path)
    sketched = Q.sketched_duplicate_ratio(spark.read.parquet(path))
    exact = Q.duplicate_ratio(B.documents(spark, sf)).select("distinct_texts", F.lit(1).alias("one"))
    both = sketched.select("valid_texts", F.col("distinct_texts").alias("estimate"), F.lit(1).alias("one")).join(exact, "one")
    return both.select("valid_texts", "distinct_texts", (
        F.abs(F.col("estimate") / F.col("distinct_texts") - 1) < 0.02).alias("near"))


def _characters(spark, sf):
    return Q.character_distribution(B.documents(spark, sf)).select(
        *[_r(c) for c in ("ascii_ratio", "digit_ratio", "punct_ratio", "space_ratio")])


def _validate_runs(spark, sf):
    runs = CC.run_table(spark, sf)
    findings = detect_findings(B.carrier(spark, sf)).select(
        F.col("source").alias("run_id"), "bias_type")
    tested = runs.select("run_id", (F.col("duration_s") > 1).alias("significant")).where(
        "run_id <> 'src0'")
    return Q.validate_runs(runs, findings, tested).select(
        "run_id", "is_valid", F.array_join("errors", ";").alias("errors"),
        F.array_join("warnings", ";").alias("warnings"), _r("quality_score"))


def _quality_report(spark, sf):
    return Q.quality_report(B.carrier(spark, sf).select("doc_id", "text")).select(
        "section", "ord", "key", "value")


QUERIES = {
    "demographic_parity_difference": _parity,
    "equalized_odds_difference": _odds,
    "disparate_impact_ratio": _impact,
    "individual_fairness": _individual,
    "individual_fairness_banded": _individual_banded,
    "individual_fairness_texts": _individual_texts,
    "mann_whitney": _mann_whitney,
    "mann_whitney_p": _mann_whitney_p,
    "kruskal_wallis_events": _kruskal_events,
    "bias_amplification": _amplification,
    "intersectional_bias": _intersectional,
    "intersectional_means": _cube,
    "validate_texts": _validate_texts,
    "duplicate_ratio": _duplicates,
    "sketched_duplicate_ratio": _sketched,
    "character_distribution": _characters,
    "validate_runs": _validate_runs,
    "quality_report": _quality_report,
}

LABELLED = f"""labelled AS (SELECT doc_id, lang, source, n_chars, toxic AS y_true, quality,
    CASE WHEN {' OR '.join(f"contains(lower(text), '{w}')" for w in INSULTS)} THEN 1 ELSE 0 END
      AS y_pred FROM documents JOIN labels USING (doc_id))"""

FLESCH = f"""source_texts AS (SELECT doc_id, text FROM documents), {TX.READABILITY},
    flesch AS (SELECT lang, source, flesch_score AS score FROM readability
      JOIN documents USING (doc_id))"""


def _kruskal_sql(source: str, grp: str, score: str) -> str:
    return f"""WITH scored AS (SELECT {grp} AS grp, {score} AS score FROM {source}),
    ranked AS (SELECT *, rank() OVER (ORDER BY score)
        + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rnk,
        count(*) OVER (PARTITION BY score) AS t FROM scored),
    sums AS (SELECT grp, count(*) AS n, sum(rnk) AS r, sum(t * t - 1) AS ties FROM ranked
      GROUP BY grp)
    SELECT count(*) AS groups, sum(n) AS n, round(
      (12e0 / (sum(n) * (sum(n) + 1e0)) * sum(r * r / n) - 3e0 * (sum(n) + 1))
        / (1e0 - sum(ties) / (sum(n)::DOUBLE ^ 3 - sum(n))), 4) AS h FROM sums"""


_VALID = rf"regexp_matches(text, '[^\t-\r\x1c-\x20\x{{85}}\p{{Z}}]')"
_ASCII = r"[\x00-\x7f]"
_DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]"
_PUNCT = r"[^\p{L}\p{N}\t-\r\x1c-\x20\x{85}\p{Z}]"
_SPACES = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


def _share(char_class: str) -> str:
    return (f"round(sum(len(regexp_extract_all(text, '{char_class}'))) / sum(length(text)), 9)")


_STATS = f"""stats AS (SELECT count(*) AS total_texts, count(*) FILTER ({_VALID}) AS valid_texts,
    avg(length(text)) FILTER ({_VALID}) AS avg_length,
    min(length(text)) FILTER ({_VALID}) AS min_length,
    max(length(text)) FILTER ({_VALID}) AS max_length,
    1e0 - count(DISTINCT text) FILTER ({_VALID}) / count(*) FILTER ({_VALID}) AS duplicate_ratio
    FROM carrier)"""

_WARNINGS = """concat_ws(';',
      CASE WHEN valid_texts < 10 THEN 'Sample size (' || valid_texts
        || ') is below recommended minimum (10)' END,
      CASE WHEN max_length > 10000 THEN 'Some texts exceed maximum length (10000)' END,
      CASE WHEN duplicate_ratio > 0.1 THEN printf('High duplicate ratio detected: %.1f%%',
        duplicate_ratio * 100) END)"""


def _report_sql() -> str:
    def line(section, n, key, value, source="stats"):
        return (f"SELECT '{section}' AS section, {n} AS ord, '{key}' AS key, "
                f"({value})::VARCHAR AS value FROM {source}")

    shares = (f"shares AS (SELECT {_share(_ASCII)} AS a, {_share(_DIGIT)} AS d, "
              f"{_share(_PUNCT)} AS p FROM carrier WHERE {_VALID})")
    rows = [
        line("overview", 1, "total_texts", "total_texts"),
        line("overview", 2, "valid_texts", "valid_texts"),
        line("overview", 3, "status", "'PASSED'"),
        line("statistics", 1, "average_length", "printf('%.1f', avg_length)"),
        line("statistics", 2, "min_length", "min_length"),
        line("statistics", 3, "max_length", "max_length"),
        line("statistics", 4, "duplicate_ratio", "printf('%.1f%%', duplicate_ratio * 100)"),
        line("characters", 1, "ascii", "printf('%.1f%%', a * 100)", "shares"),
        line("characters", 2, "digits", "printf('%.1f%%', d * 100)", "shares"),
        line("characters", 3, "punctuation", "printf('%.1f%%', p * 100)", "shares"),
        f"SELECT 'warnings', i, 'message', w FROM (SELECT unnest(ws) AS w, "
        f"generate_subscripts(ws, 1) AS i FROM (SELECT string_split({_WARNINGS}, ';') AS ws "
        "FROM stats)) WHERE w <> ''",
        line("samples", "n", "length", "length(text)", "first_texts"),
        line("samples", "n", "readability", "printf('%.1f', flesch_score)",
             "first_texts JOIN readability USING (doc_id)"),
        line("samples", "n", "keywords", "coalesce((SELECT string_agg(keyword, ', ' ORDER BY rank) "
             "FROM keywords k WHERE k.doc_id = f.doc_id AND rank <= 3), '')", "first_texts f"),
        "SELECT 'recommendations', 1, 'duplicates', 'Consider removing duplicate texts to improve "
        "analysis quality' FROM stats WHERE duplicate_ratio > 0.1",
        "SELECT 'recommendations', 2, 'sample_size', 'Increase sample size to at least 10 for "
        "reliable results' FROM stats WHERE valid_texts < 10",
        "SELECT 'recommendations', 3, 'length', 'Consider truncating very long texts for better "
        "processing performance' FROM stats WHERE max_length > 10000",
    ]
    return (f"WITH {B.CARRIER}, source_texts AS (SELECT * FROM carrier), {_STATS}, {shares}, "
            f"{TX.READABILITY}, {TX.KEYWORDS}, first_texts AS (SELECT doc_id, text, "
            f"row_number() OVER (ORDER BY doc_id) AS n FROM carrier WHERE {_VALID} "
            "ORDER BY doc_id LIMIT 5) " + " UNION ALL ".join(rows))


SQL = {
    "demographic_parity_difference": f"""WITH {LABELLED}, r AS (SELECT avg(y_pred) AS rate
        FROM labelled GROUP BY lang) SELECT round(max(rate) - min(rate), 9)
        AS demographic_parity_difference FROM r""",
    "equalized_odds_difference": f"""WITH {LABELLED}, r AS (SELECT
        avg(y_pred) FILTER (y_true = 1) AS tpr, avg(y_pred) FILTER (y_true = 0) AS fpr
        FROM labelled GROUP BY lang HAVING count(DISTINCT y_true) = 2)
        SELECT round(CASE WHEN count(*) >= 2 THEN max(tpr) - min(tpr) ELSE 0 END, 9)
          AS tpr_difference,
          round(CASE WHEN count(*) >= 2 THEN max(fpr) - min(fpr) ELSE 0 END, 9)
          AS fpr_difference FROM r""",
    "disparate_impact_ratio": f"""WITH {LABELLED}, r AS (SELECT avg(quality) AS rate
        FROM labelled GROUP BY lang) SELECT round(min(rate) / max(rate), 9)
        AS disparate_impact_ratio FROM r""",
    "individual_fairness_banded": """SELECT count(*) AS similar_pairs, true AS found, true AS expected
        FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND list_cosine_similarity(
          a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3e0""",
    "individual_fairness": """WITH p AS (SELECT abs(a.label - b.label) > 0.1 AS differs
        FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND list_cosine_similarity(
          a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3e0)
        SELECT count(*) AS similar_pairs, count(*) FILTER (differs) AS differing_pairs,
          round(CASE WHEN count(*) = 0 THEN 1e0
            ELSE 1e0 - count(*) FILTER (differs) / count(*) END, 9) AS individual_fairness FROM p""",
    "individual_fairness_texts": f"""WITH d AS (SELECT doc_id, [{', '.join(
        f"(length(low) - length(replace(low, '{c}', '')))::DOUBLE" for c in LETTERS)}] AS v,
        {' OR '.join(f"contains(low, '{w}')" for w in INSULTS)} AS y
        FROM (SELECT doc_id, lower(text) AS low FROM documents)),
        p AS (SELECT a.y <> b.y AS differs FROM d a JOIN d b ON a.doc_id < b.doc_id
          AND list_sum(a.v) > 0 AND list_sum(b.v) > 0
          AND list_cosine_similarity(a.v, b.v) >= 0.98e0)
        SELECT count(*) AS similar_pairs, count(*) FILTER (differs) AS differing_pairs,
          round(1e0 - count(*) FILTER (differs) / count(*), 9) AS individual_fairness FROM p""",
    "mann_whitney": f"""WITH {LABELLED}, ranked AS (SELECT y_true, rank() OVER (ORDER BY n_chars)
        + (count(*) OVER (PARTITION BY n_chars) - 1) / 2 AS r FROM labelled)
        SELECT count(*) FILTER (y_true = 1) AS n1, count(*) FILTER (y_true = 0) AS n2,
          sum(r) FILTER (y_true = 1) - count(*) FILTER (y_true = 1)
            * (count(*) FILTER (y_true = 1) + 1) / 2 AS u FROM ranked""",
    "mann_whitney_p": f"""WITH {LABELLED}, ranked AS (SELECT y_true, rank() OVER (ORDER BY n_chars)
        + (count(*) OVER (PARTITION BY n_chars) - 1) / 2 AS r,
        count(*) OVER (PARTITION BY n_chars) AS t FROM labelled),
        u AS (SELECT count(*) FILTER (y_true = 1) AS n1, count(*) FILTER (y_true = 0) AS n2,
          sum(r) FILTER (y_true = 1) - count(*) FILTER (y_true = 1)
            * (count(*) FILTER (y_true = 1) + 1) / 2 AS u,
          sum(t::DOUBLE * t - 1) AS ties FROM ranked),
        z AS (SELECT *, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5e0) / sqrt(n1 * n2 / 12e0
          * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1e0)))) AS z FROM u),
        p AS (SELECT *, {B.gamma_tail_sql('(z * z)', '1')} AS p_value FROM z)
        SELECT n1, n2, u, round(p_value, 9) AS p_value, p_value < 0.05e0 AS significant FROM p""",
    "kruskal_wallis_events": _kruskal_sql("events", "event_type", "value"),
    "bias_amplification": f"""WITH t AS (SELECT role, CASE WHEN
        {' OR '.join(f"contains(lower(text), '{w}')" for w in [*INSULTS, 'le ', 'the '])}
        THEN 1 ELSE 0 END AS flag FROM conversations WHERE role <> 'system'),
        r AS (SELECT avg(flag) FILTER (role = 'user') AS i,
          avg(flag) FILTER (role <> 'user') AS o FROM t)
        SELECT round(i, 9) AS input_rate, round(o, 9) AS output_rate,
          round(o / i, 9) AS amplification FROM r""",
    "intersectional_bias": f"""WITH {FLESCH}, g AS (SELECT avg(score) AS m, count(*) AS n
        FROM flesch GROUP BY lang, source) SELECT round(var_pop(m), 4) AS intersectional_variance,
        round(max(m) - min(m), 9) AS max_disparity,
        round(sum(m * n) / sum(n), 9) AS weighted_mean, count(*) AS num_groups FROM g""",
    "intersectional_means": f"""WITH {FLESCH} SELECT lang, source,
        round(avg(score), 9) AS mean_score, count(*) AS rows FROM flesch
        GROUP BY CUBE (lang, source)""",
    "validate_texts": f"""WITH {B.CARRIER}, {_STATS} SELECT total_texts, valid_texts,
        round(avg_length, 9) AS avg_length, min_length, max_length,
        round(duplicate_ratio, 9) AS duplicate_ratio, valid_texts > 0 AS is_valid, '' AS errors,
        {_WARNINGS} AS warnings FROM stats""",
    "sketched_duplicate_ratio": f"""SELECT count(*) AS valid_texts, count(DISTINCT text) AS distinct_texts,
        true AS near FROM documents WHERE {_VALID}""",
    "duplicate_ratio": f"""SELECT count(*) AS valid_texts, count(DISTINCT text) AS distinct_texts,
        round(1e0 - count(DISTINCT text) / count(*), 9) AS duplicate_ratio FROM documents
        WHERE {_VALID}""",
    "character_distribution": f"""SELECT {_share(_ASCII)} AS ascii_ratio,
        {_share(_DIGIT)} AS digit_ratio, {_share(_PUNCT)} AS punct_ratio,
        {_share(_SPACES)} AS space_ratio FROM documents WHERE {_VALID}""",
    "validate_runs": f"""{CC.ALL}, {CC.RUNS}, t AS (SELECT source AS run_id,
        count(DISTINCT bias_type) AS types FROM findings JOIN low USING (doc_id) GROUP BY 1)
        SELECT run_id, true AS is_valid, '' AS errors,
          CASE WHEN duration_s <= 0 THEN 'Invalid detection duration' ELSE '' END AS warnings,
          round((CASE WHEN total_samples >= 1000 THEN 1e0 WHEN total_samples >= 100 THEN 0.8e0
            ELSE 0.5e0 END + coalesce(types, 0) / 9 + CASE WHEN run_id = 'src0' THEN 0.5e0
            WHEN duration_s > 1 THEN 1e0 ELSE 0.7e0 END) / 3, 9) AS quality_score
        FROM runs LEFT JOIN t USING (run_id)""",
    "quality_report": _report_sql(),
}

