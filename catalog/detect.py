"""Detection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import base as B
from catalog import findings_sql as S
from evenhand import lexicons as L
from evenhand.functions import text as T
from evenhand.operators import detection as D
from evenhand.operators import lexicon_tables as LT


def shown(findings):
    """Finding columns in a form that compares across engines."""
    return findings.select(
        "doc_id", "check_name", "bias_type", "severity",
        F.round("bias_score", 9).alias("bias_score"),
        F.array_join("biased_terms", ",").alias("terms"), "group_type", "group_name",
        "category", "term", "pattern", "suggestion", "marker_count")


def _part(*parts):
    return lambda spark, sf: shown(D.detect_findings(B.carrier(spark, sf), parts))


def _groups(spark, sf):
    return D.demographic_groups(B.carrier(spark, sf)).select("doc_id", "group_type", "group_name")


def _severity(spark, sf):
    score = F.round(F.col("value") / 100, 4)
    return B.table(spark, sf, "events").select(
        "event_id", T.severity(score).alias("severity"),
        T.severity_rank(T.severity(score)).alias("severity_rank"))


def _quick(spark, sf):
    return D.quick_check(B.pairs(spark, sf)).select(
        "doc_id", "outputs", "bias_detected",
        F.array_join("bias_types", ",").alias("bias_types"), "confidence")


def _pairs(spark, sf):
    return shown(D.detect_pairs(B.pairs(spark, sf)))


def _table_findings(spark, sf):
    """All checks with the lexicons as a table."""
    lexicon = LT.TableLexicons(LT.lexicon_table(spark))
    return shown(D.detect_findings(B.carrier(spark, sf), ("demographic", "gender", "racial", "religious",
                                                          "linguistic"), lexicon))


def _pairs_of_words(words):
    return F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                       lambda w, i: F.concat(F.get(words, i), F.lit(" "), w))


def _phrases(spark, sf):
    """A lexicon of all pairs of words next to each other in conversations and benchmark."""
    texts = B.table(spark, sf, "conversations").select("text").unionAll(
        B.table(spark, sf, "benchmark").select("text"))
    words = texts.select(T.words(F.col("text")).alias("w")).where(F.size("w") > 1)
    terms = words.select(F.explode(_pairs_of_words(F.col("w"))).alias("term")).distinct()
    none = F.lit(None).cast("string")
    return terms.select(F.lit("phrase").alias("list"), none.alias("category"), none.alias("subcategory"),
                        "term", none.alias("extra"), F.lit(0).cast("long").alias("ord"))


def _phrase_findings(spark, sf):
    """Phrases of a derived lexicon in whole documents, whose words are joined by single spaces; the lexicon
    is dealt into shards."""
    texts = B.documents(spark, sf).select("doc_id", F.array_join(T.words(F.col("text")), " ").alias("text"))
    found = LT.term_findings(texts, _phrases(spark, sf), shard_chars=200_000)
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("phrases"),
        F.md5(F.array_join(F.sort_array(F.collect_list("term")), ",")).alias("digest"))


def _word_mentions(spark, sf):
    """Distinct words of the benchmark in documents, joined on the word."""
    lexicon = B.table(spark, sf, "benchmark").select(F.explode(T.words(F.col("text"))).alias("term")).distinct()
    return D.word_mentions(B.documents(spark, sf), lexicon).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"),
        F.md5(F.array_join(F.sort_array(F.collect_list("term")), ",")).alias("digest"))


QUERIES = {
    "lexicon_table_findings": _table_findings,
    "phrase_findings": _phrase_findings,
    "word_mentions": _word_mentions,
    "severity": _severity,
    "demographic_groups": _groups,
    "occupation_findings": _part("occupation"),
    "trait_findings": _part("trait"),
    "exclusion_findings": _part("exclusion"),
    "demographic_findings": _part("demographic"),
    "gender_stereotype_findings": _part("gender"),
    "racial_term_findings": _part("racial"),
    "religious_term_findings": _part("religious"),
    "dialect_findings": _part("dialect"),
    "formality_findings": _part("formality"),
    "language_preference_findings": _part("language_preference"),
    "inclusive_language_findings": _part("inclusive_language"),
    "linguistic_findings": _part("linguistic"),
    "detect_pairs": _pairs,
    "quick_check": _quick,
}

def _words_sql(table: str) -> str:
    return f"SELECT regexp_extract_all(lower(text), '{B.W}+') AS w FROM {table}"


SQL = {
    "lexicon_table_findings": S.findings_sql(S.ALL),
    "phrase_findings": f"""WITH t AS ({_words_sql('conversations')} UNION ALL {_words_sql('benchmark')}),
        lexicon AS (SELECT DISTINCT w[i] || ' ' || w[i + 1] AS term FROM (SELECT w, unnest(range(1, len(w))) AS i FROM t)),
        d AS (SELECT doc_id, regexp_extract_all(lower(text), '{B.W}+') AS w FROM documents),
        pairs AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS term FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d))
        SELECT doc_id, count(*) AS phrases, md5(string_agg(term, ',' ORDER BY term)) AS digest
        FROM pairs JOIN lexicon USING (term) GROUP BY doc_id""",
    "word_mentions": f"""WITH lexicon AS (SELECT DISTINCT unnest(w) AS term FROM ({_words_sql('benchmark')})),
        d AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '{B.W}+')) AS term FROM documents)
        SELECT doc_id, count(*) AS words, md5(string_agg(term, ',' ORDER BY term)) AS digest
        FROM d JOIN lexicon USING (term) GROUP BY doc_id""",
    "severity": f"""SELECT event_id, {S.severity('s')} AS severity,
        CASE {S.severity('s')} WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 4 END
          AS severity_rank
        FROM (SELECT event_id, round(value / 100, 4) AS s FROM events)""",
    "demographic_groups":
        f"WITH {S.LOW_CARRIER}, {S.CHECKS} SELECT doc_id, group_type, group_name FROM mentions",
    "occupation_findings": S.findings_sql(["occupation"]),
    "trait_findings": S.findings_sql(["trait"]),
    "exclusion_findings": S.findings_sql(["exclusion"]),
    "demographic_findings": S.findings_sql(["occupation", "trait", "exclusion"]),
    "gender_stereotype_findings": S.findings_sql(["gender"]),
    "racial_term_findings": S.findings_sql(["racial"]),
    "religious_term_findings": S.findings_sql(["religious"]),
    "dialect_findings": S.findings_sql(["dialect"]),
    "formality_findings": S.findings_sql(["formality"]),
    "language_preference_findings": S.findings_sql(["preference"]),
    "inclusive_language_findings": S.findings_sql(["inclusive"]),
    "linguistic_findings": S.findings_sql(["dialect", "formality", "preference", "inclusive"]),
    "detect_pairs": S.findings_sql(S.ALL, S.LOW_PAIRS),
    "quick_check": f"""WITH {S.LOW_PAIRS},
        flags AS (SELECT doc_id, count(*) AS outputs,
          bool_or({S.has_any(L.QUICK_INDICATORS['gender'])}) AS g,
          bool_or({S.has_any(L.QUICK_INDICATORS['racial'])}) AS r FROM low GROUP BY doc_id)
        SELECT doc_id, outputs, g OR r AS bias_detected,
          CASE WHEN g AND r THEN 'gender,racial' WHEN g THEN 'gender' WHEN r THEN 'racial'
            ELSE '' END AS bias_types,
          CASE WHEN g OR r THEN 0.7e0 ELSE 0.3e0 END AS confidence FROM flags""",
}
