"""Text preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import base as B
from catalog.base import CARRIER, NW, W, sql_list
from evenhand import lexicons as L
from evenhand.functions import text as T
from evenhand.operators import preparation as P

TEXT = F.col

# -- Spark ------------------------------------------------------------------


def _digest(name, build):
    """Key, length and digest of a computed text."""
    def query(spark, sf):
        out = B.carrier(spark, sf).select("doc_id", build(F.col("text")).alias("t"))
        return out.select("doc_id", F.length("t").alias("chars"), F.md5("t").alias("digest"))
    return query


def _clean_pages(spark, sf):
    pages = B.table(spark, sf, "pages").select("page_id", T.clean_text(F.col("html")).alias("t"))
    return pages.select("page_id", F.length("t").alias("chars"), F.md5("t").alias("digest"))


def _preprocess(spark, sf):
    out = P.preprocess(B.carrier(spark, sf))
    return out.select("doc_id", F.length("text").alias("chars"), F.md5("text").alias("digest"))


def _profanity(spark, sf):
    words = T.profanity(F.col("text"))
    return B.carrier(spark, sf).select("doc_id", F.array_join(words, ",").alias("words"))


def _syllables(spark, sf):
    return B.carrier(spark, sf).select("doc_id", T.syllables(F.col("text")).alias("syllables"))


def _readability(spark, sf):
    r = B.carrier(spark, sf).select("doc_id", T.readability(F.col("text")).alias("r"))
    return r.select("doc_id", *[F.round(f"r.{c}", 9).alias(c) for c in (
        "flesch_score", "flesch_grade", "avg_sentence_length", "avg_syllables_per_word")])


def _keywords(spark, sf):
    return P.keywords(B.carrier(spark, sf)).select(
        "doc_id", "rank", "keyword", F.round("score", 9).alias("score"))


def _language(spark, sf):
    out = P.detect_language(B.documents(spark, sf).drop("source"))
    return out.select("doc_id", "language", (F.col("language") == F.col("lang")).alias("agrees"))


def _distribution(spark, sf):
    return P.language_distribution(B.documents(spark, sf)).select(
        "language", "texts", F.round("share", 9).alias("share"))


QUERIES = {
    "clean_text": _digest("clean_text", T.clean_text),
    "clean_pages": _clean_pages,
    "anonymize": _digest("anonymize", T.anonymize),
    "truncate": _digest("truncate", T.truncate),
    "preprocess": _preprocess,
    "profanity": _profanity,
    "syllables": _syllables,
    "readability": _readability,
    "keywords": _keywords,
    "detect_language": _language,
    "language_distribution": _distribution,
}

# -- SQL --------------------------------------------------------------------

SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


def clean_sql(text: str) -> str:
    # Fixed value: what counts as a URL.
    out = rf"regexp_replace({text}, 'https?://[a-zA-Z0-9$-_@.&+!*\\(),]+', '[URL]', 'g')"
    out = f"trim(regexp_replace({out}, '{SPACE}+', ' ', 'g'), ' ')"
    return rf"regexp_replace({out}, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')"


# The patterns of personal data.
PII = {
    "EMAIL": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "PHONE": r"\b(?:\+?1[-.\s]?)?\(?[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}\b",
    "SSN": r"\b\d{3}-\d{2}-\d{4}\b",
    "CREDIT_CARD": r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b",
    "IP_ADDRESS": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
}


def anonymize_sql(text: str) -> str:
    for kind, pattern in PII.items():
        text = f"regexp_replace({text}, '{pattern}', '[{kind}]', 'g')"
    return text


def preprocess_sql(text: str) -> str:
    return anonymize_sql(clean_sql(text))


def _digest_sql(expression: str, source: str = "carrier", key: str = "doc_id") -> str:
    return (f"WITH {CARRIER} SELECT {key}, length(t) AS chars, md5(t) AS digest "
            f"FROM (SELECT {key}, {expression} AS t FROM {source})")


COUNTS = f"""counts AS (SELECT doc_id, text,
    len(regexp_extract_all(text, '[.!?]')) AS sentences,
    len(regexp_extract_all(text, '[^' || '{SPACE}'[2:])) AS words,
    list_sum(list_transform(regexp_extract_all(lower(text), '{W}+'), lambda w:
      CASE WHEN len(regexp_extract_all(w, '[aeiouy]+')) > 1 AND w[-1] = 'e'
        THEN len(regexp_extract_all(w, '[aeiouy]+')) - 1
        ELSE greatest(1, len(regexp_extract_all(w, '[aeiouy]+'))) END)) AS syllables FROM source_texts)"""
COUNTS = COUNTS.replace(f"'[^' || '{SPACE}'[2:]", f"'[^{SPACE[1:]}+'")

READABILITY = f"""{COUNTS},
readability AS (SELECT doc_id, text,
    CASE WHEN sentences = 0 OR words = 0 THEN 0e0 ELSE greatest(0e0, least(100e0,
      206.835e0 - 1.015e0 * (words / sentences) - 84.6e0 * (syllables / words))) END AS flesch_score,
    CASE WHEN sentences = 0 OR words = 0 THEN 0e0 ELSE greatest(0e0,
      0.39e0 * (words / sentences) + 11.8e0 * (syllables / words) - 15.59e0) END AS flesch_grade,
    CASE WHEN sentences = 0 OR words = 0 THEN 0e0 ELSE words / sentences END AS avg_sentence_length,
    CASE WHEN sentences = 0 OR words = 0 THEN 0e0 ELSE syllables / words END AS avg_syllables_per_word
    FROM counts)"""

KEYWORDS = f"""tokens AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(lower(text), '{W}+') AS ws FROM source_texts)),
token_totals AS (SELECT doc_id, count(*) AS total FROM tokens GROUP BY doc_id),
word_counts AS (SELECT doc_id, w, count(*) AS n, min(i) AS first FROM tokens
    WHERE length(w) > 2 AND w NOT IN ({', '.join(B.quote(w) for w in L.STOP_WORDS)}) GROUP BY ALL),
keywords AS (SELECT doc_id, w AS keyword, n / total AS score,
    row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS rank
    FROM word_counts JOIN token_totals USING (doc_id))"""


def language_sql(short: str, default: str) -> str:
    hits = [f"len(list_filter(ws, lambda w: list_contains({sql_list(p)}, w))) AS {lang}_hits"
            for lang, p in L.LANGUAGE_PROFILES.items()]
    langs = list(L.LANGUAGE_PROFILES)
    best = f"greatest({', '.join(f'{x}_hits' for x in langs)})"
    cases = " ".join(f"WHEN {x}_hits = {best} THEN '{x}'" for x in langs)
    return f"""hits AS (SELECT doc_id, lang, text, {', '.join(hits)} FROM (SELECT *,
      regexp_extract_all(lower(text), '{W}+') AS ws FROM documents)),
    languages AS (SELECT doc_id, lang, CASE
      WHEN length(regexp_replace(text, '^{SPACE}+|{SPACE}+$', '', 'g')) <= 10 THEN '{short}'
      WHEN {best} = 0 THEN '{default}' {cases} END AS language FROM hits)"""


SQL = {
    "clean_text": _digest_sql(clean_sql("text")),
    "clean_pages": _digest_sql(clean_sql("html"), "pages", "page_id"),
    "anonymize": _digest_sql(anonymize_sql("text")),
    "truncate": _digest_sql("substring(text, 1, 2048)"),
    "preprocess": _digest_sql(preprocess_sql("text")),
    "profanity": rf"""WITH {CARRIER} SELECT doc_id, array_to_string(regexp_extract_all(
        regexp_replace(lower(text), '({NW})', '\1\1', 'g'),
        '(?:^|{NW})(damn|hell|crap)(?:$|{NW})', 1), ',') AS words FROM carrier""",
    "syllables": f"WITH {CARRIER}, source_texts AS (SELECT * FROM carrier), {COUNTS} "
                 "SELECT doc_id, syllables FROM counts",
    "readability": f"WITH {CARRIER}, source_texts AS (SELECT * FROM carrier), {READABILITY} "
                   "SELECT doc_id, round(flesch_score, 9) AS flesch_score, "
                   "round(flesch_grade, 9) AS flesch_grade, "
                   "round(avg_sentence_length, 9) AS avg_sentence_length, "
                   "round(avg_syllables_per_word, 9) AS avg_syllables_per_word FROM readability",
    "keywords": f"WITH {CARRIER}, source_texts AS (SELECT * FROM carrier), {KEYWORDS} "
                "SELECT doc_id, rank, keyword, round(score, 9) AS score FROM keywords "
                "WHERE rank <= 10",
    "detect_language": f"WITH {language_sql('en', 'en')} "
                       "SELECT doc_id, language, language = lang AS agrees FROM languages",
    "language_distribution": f"""WITH {language_sql('unknown', 'unknown')}
        SELECT language, count(*) AS texts,
          round(count(*) / (SELECT count(*) FROM languages), 9) AS share
        FROM languages GROUP BY language""",
}
