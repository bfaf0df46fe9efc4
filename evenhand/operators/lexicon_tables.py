"""Detection with lexicons that are tables, of any length.

A lexicon table has a row per term: ``list`` (the field of ``Lexicons`` it belongs to),
``category`` (a group type, gender, dialect, language ...), ``subcategory`` (a group name), ``term`` in lower
case, ``extra`` (a suggestion) and ``ord``, its place.  An automaton finds in each text the rows
whose terms occur; these few ``hits`` take the place of the fixed lists in all checks, so the same rules
give the same findings, and nothing in the plan grows with the table.

The table is broadcast in shards of a bounded number of characters.  One shard is a projection, which
works on streams; with several, texts are read once for each and the hits meet by key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.functions import automaton as A
from evenhand.functions import text as T
from evenhand.functions.matching import HITS, Listed
from evenhand.lexicons import DEFAULT_LEXICONS, Lexicons

SHARD_CHARS = 20_000_000
TABLE = "list string, category string, subcategory string, term string, extra string, ord long"
HIT = TABLE + ", word boolean"
FIELDS = [f.split()[0] for f in TABLE.split(", ")]
#: Arguments of rules that aren't lists of terms, and lists that the checks don't look for.
OTHER = ("occupation_sides", "exclusion_templates", "quick_indicators", "language_profiles", "technical_terms",
         "casual_terms", "positive_words")


def lexicon_rows(lexicons: Lexicons = DEFAULT_LEXICONS) -> list[tuple]:
    """The lists of ``lexicons`` as rows of a lexicon table."""
    rows: list[tuple] = []
    for name, value in vars(lexicons).items():
        if name in OTHER:
            continue
        for category, terms in (value.items() if isinstance(value, dict) else [(None, value)]):
            groups = [(None, terms)] if not isinstance(terms, dict) or name == "inclusive_terms" else terms.items()
            for sub, listed in groups:
                for term in listed:
                    rows.append((name, category, sub, term,
                                 listed[term] if isinstance(listed, dict) else None, len(rows)))
    return rows


def lexicon_table(spark: SparkSession, lexicons: Lexicons = DEFAULT_LEXICONS) -> DataFrame:
    return spark.createDataFrame(lexicon_rows(lexicons), TABLE)


def _hits(spark: SparkSession, low: Column, rows: list[tuple]) -> Column:
    """The rows whose term occurs, by ord, each with whether it does as a whole word."""
    terms = sorted({r[3] for r in rows})
    place = {t: n for n, t in enumerate(terms)}
    by_term: list[list[tuple]] = [[] for _ in terms]
    for r in rows:
        by_term[place[r[3]]].append(r)
    shared = spark.sparkContext.broadcast((terms, by_term))
    made: list = []

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words, listed = shared.value
        if not made:
            made.append(A.build(words))
        for texts in batches:
            out = []
            for text in texts:
                found = A.occurring(made[0], words, text or "")
                hits = sorted((r[5], r, whole) for n, whole in found.items() for r in listed[n])
                out.append([dict(zip(FIELDS, r, strict=True)) | {"word": whole} for _, r, whole in hits])
            yield pd.Series(out, dtype=object)

    find.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(find, f"array<struct<{HIT.replace(' ', ': ').replace(',:', ',')}>>")(low)


def with_hits(df: DataFrame, lexicon: DataFrame, text_col: str = "text", key: str = "doc_id",
              shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``df`` with ``_hits``, the lexicon rows whose term occurs in the lower-cased text, by ord.

    Null and empty terms are left out; null texts have no hits.  A lexicon of more than
    ``shard_chars`` characters is dealt into shards, for which ``key`` must be unique and not null.
    """
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    terms = lexicon.select(*[F.col(f).cast(t.split()[1]).alias(f) for f, t in
                             zip(FIELDS, TABLE.split(", "), strict=True)]).where("term <> ''")
    chars = terms.agg(F.sum(F.length("term"))).first()[0] or 0
    shards = max(1, math.ceil(chars / shard_chars))
    parts = []
    for k in range(shards):
        rows = [tuple(r) for r in terms.where(F.pmod(F.xxhash64("term"), F.lit(shards)) == k).collect()]
        found = _hits(df.sparkSession, low, rows)
        if shards == 1:
            return df.withColumn(HITS, found)
        parts.append(df.select(F.col(key).alias("_key"), found.alias("_part")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    gathered = every.where(F.size("_part") > 0).groupBy("_key").agg(
        F.flatten(F.collect_list("_part")).alias("_all"))
    by_ord = F.array_sort(F.transform("_all", lambda h: F.struct(h["ord"].alias("o"), h.alias("h"))))
    joined = df.join(gathered, F.col(key) == F.col("_key"), "left")
    none = F.expr(f"CAST(array() AS array<struct<{HIT.replace(' ', ': ').replace(',:', ',')}>>)")
    return joined.withColumn(HITS, F.coalesce(F.transform(by_ord, lambda x: x["h"]), none)).drop("_key", "_all")


class TableLexicons:
    """A lexicon table as the argument of the checks and of ``annotate``; ``rules`` has what isn't a list of terms.

    Only the names of lists and categories reach the driver, and the shards on their way.
    """

    def __init__(self, lexicon: DataFrame, rules: Lexicons = DEFAULT_LEXICONS, key: str = "doc_id",
                 shard_chars: int = SHARD_CHARS) -> None:
        self.table, self.key, self.shard_chars = lexicon, key, shard_chars
        for name in OTHER:
            setattr(self, name, getattr(rules, name))
        named = lexicon.groupBy("list", "category").agg(F.min("ord").alias("o")).orderBy("o").collect()
        for name, value in vars(rules).items():
            if name in OTHER:
                continue
            if isinstance(value, dict):
                listed = {r["category"]: Listed(name, r["category"]) for r in named if r["list"] == name}
                setattr(self, name, listed or {None: Listed(name)})
            else:
                setattr(self, name, Listed(name))

    def add_hits(self, df: DataFrame, text_col: str) -> DataFrame:
        return with_hits(df, self.table, text_col, self.key, self.shard_chars)


def term_findings(df: DataFrame, lexicon: DataFrame, text_col: str = "text", key: str = "doc_id",
                  whole_words: bool = True, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """One row per text and lexicon row whose term occurs, as a whole word unless asked otherwise: key, list,
    category, subcategory, term, extra.

    A lexicon of more than ``shard_chars`` characters isn't broadcast for whole words: terms that begin and end
    within a word are joined with the runs of as many words of each text, read once.  The automaton finds the
    others, shard by shard.
    """
    texts = df.select(key, text_col)
    terms = lexicon.where("term <> ''")
    if whole_words:
        term = F.col("term").cast("string")
        wordy = term.rlike(f"^{T.WORD_CHAR}") & term.rlike(f"{T.WORD_CHAR}$")
        words = F.regexp_count(term, F.lit(T.WORD_CHAR + "+"))
        kinds = terms.groupBy(wordy.alias("wordy"), F.when(wordy, words).alias("words")).agg(
            F.sum(F.length("term")).alias("chars")).collect()
        if sum(k["chars"] for k in kinds) > shard_chars:
            parts = [_joined(texts, terms.where(wordy), text_col, key, sorted(k["words"] for k in kinds if k["wordy"]))
                     ] if any(k["wordy"] for k in kinds) else []
            if not all(k["wordy"] for k in kinds):
                parts.append(_scanned(texts, terms.where(~wordy), text_col, key, True, shard_chars))
            return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _scanned(texts, lexicon, text_col, key, whole_words, shard_chars)


def _joined(df: DataFrame, terms: DataFrame, text_col: str, key: str, counts: list[int]) -> DataFrame:
    """Rows of ``terms`` joined with the runs of words of each text, for the numbers of words in ``counts``."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))

    def runs(n: int) -> Column:
        more = "" if n == 1 else rf"(?:[^\p{{L}}\p{{N}}_]++{T.WORD_CHAR}++){{{n - 1}}}"
        return F.regexp_extract_all(low, F.lit(rf"{T.NOT_AFTER_WORD}(?=({T.WORD_CHAR}++{more}))"), F.lit(1))

    found = F.array_distinct(F.concat(*[runs(n) for n in counts]))
    held = df.select(key, F.explode_outer(found).alias("term")).where(F.col("term").isNotNull())
    columns = [f for f in FIELDS if f not in ("term", "ord")]
    listed = terms.select(F.col("term").cast("string").alias("term"), *[F.col(c).cast("string") for c in columns])
    # As where shards meet by key: each of several rows with one key gets the finds of all, a null key none.
    times = df.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("_times")).where("_times > 1")
    rows = held.join(listed, "term").where(F.col(key).isNotNull()).join(times, key, "left")
    copies = F.explode(F.sequence(F.lit(1), F.coalesce("_times", F.lit(1)))).alias("_copy")
    return rows.select(key, *[f for f in FIELDS if f != "ord"], copies).drop("_copy")


def _scanned(df: DataFrame, lexicon: DataFrame, text_col: str, key: str, whole_words: bool,
             shard_chars: int) -> DataFrame:
    found = with_hits(df, lexicon, text_col, key, shard_chars)
    rows = found.select(key, F.inline_outer(HITS)).where(F.col("term").isNotNull())
    if whole_words:
        rows = rows.where("word")
    return rows.drop("ord", "word")
