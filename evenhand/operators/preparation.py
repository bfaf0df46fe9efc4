"""Text preparation over a table: cleaning, keywords, language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand import lexicons as L
from evenhand.functions import text as T
from evenhand.lexicons import DEFAULT_LEXICONS, Lexicons
from evenhand.options import DEFAULT_OPTIONS, DetectOptions


def preprocess(df: DataFrame, options: DetectOptions = DEFAULT_OPTIONS,
               text_col: str = "text") -> DataFrame:
    """Clean, anonymise and, if a length is given, cut the text column, in that order."""
    out = T.clean_text(F.col(text_col))
    if options.anonymize:
        out = T.anonymize(out)
    if options.max_text_length is not None:
        out = T.truncate(out, options.max_text_length)
    return df.withColumn(text_col, out)


def keywords(df: DataFrame, k: int = 10, text_col: str = "text",
             stop_words: list[str] | None = None) -> DataFrame:
    """The ``k`` most frequent words of each text with their share of all its words.

    Stop words and words of up to two letters are left out of the ranking but not of the
    total; equal counts rank by first position.  The words of one text are sorted and
    counted inside its row, so the operator needs no shuffle.
    """
    stop = list(stop_words or L.STOP_WORDS)
    tokens = df.withColumn("_words", T.words(F.col(text_col))).drop(text_col)
    kept = F.filter(
        F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
        lambda s: (F.length(s["w"]) > 2) & ~s["w"].isin(stop),
    )
    ordered = tokens.select("*", F.size("_words").alias("_total"),
                            F.array_sort(kept).alias("_sorted")).drop("_words")
    # Positions in the sorted array where a new word starts.
    starts = ordered.withColumn(
        "_starts",
        F.filter(
            F.transform("_sorted", lambda s, n: F.when(
                (n == 0) | (s["w"] != F.col("_sorted")[F.greatest(n - 1, F.lit(0))]["w"]), n)),
            lambda n: n.isNotNull(),
        ),
    )
    runs = F.transform("_starts", lambda n, j: F.struct(
        (n - F.coalesce(F.get("_starts", j + 1), F.size("_sorted"))).alias("minus_count"),
        F.get("_sorted", n)["i"].alias("position"),
        F.get("_sorted", n)["w"].alias("keyword"),
    ))
    top = starts.withColumn("_top", F.slice(F.array_sort(runs), 1, k))
    keep = [c for c in df.columns if c != text_col]
    # The outer form, so that no "array not empty" filter is derived and pushed down, which
    # would compute the ranking twice.
    ranked = top.select(*keep, "_total", F.posexplode_outer("_top").alias("_n", "_k"))
    return ranked.where(F.col("_n").isNotNull()).select(
        *keep,
        (F.col("_n") + 1).alias("rank"),
        F.col("_k.keyword").alias("keyword"),
        (-F.col("_k.minus_count") / F.col("_total")).alias("score"),
    )


def language_of(text: Column, profiles: dict[str, list[str]] | None = None,
                short: str = "en", default: str = "en") -> Column:
    """Language whose function words are most frequent in the text.

    Up to ten characters after trimming give ``short``; no hit gives ``default``; equal
    hits go to the language that comes first in ``profiles``.
    """
    profiles = profiles or L.LANGUAGE_PROFILES
    every = sorted({w for ws in profiles.values() for w in ws})

    def best_of(hits: Column) -> Column:
        def hits_of(ws):
            return F.size(F.filter(hits, lambda w: w.isin(list(ws))))

        scored = F.array(*[
            F.struct(hits_of(ws).alias("hits"), F.lit(-n).alias("order"),
                     F.lit(lang).alias("language"))
            for n, (lang, ws) in enumerate(profiles.items())
        ])
        best = F.array_max(scored)
        return F.when(best["hits"] > 0, best["language"]).otherwise(F.lit(default))

    hits = F.filter(T.words(text), lambda w: w.isin(every))
    chosen = F.transform(F.array(hits), best_of)[0]
    # Characters are counted only of texts that may be short: each has four bytes at most.
    is_short = (F.octet_length(T.stripped(text)) <= 40) & (F.length(T.stripped(text)) <= 10)
    return F.when(text.isNull() | is_short, F.lit(short)).otherwise(chosen)


def detect_language(df: DataFrame, lexicons: Lexicons = DEFAULT_LEXICONS,
                    text_col: str = "text", out_col: str = "language") -> DataFrame:
    """Add the language of each text."""
    return df.withColumn(out_col, language_of(F.col(text_col), lexicons.language_profiles))


def language_distribution(df: DataFrame, lexicons: Lexicons = DEFAULT_LEXICONS,
                          text_col: str = "text", by: tuple = ()) -> DataFrame:
    """Share of texts per language; short or unrecognised texts count as ``unknown``."""
    language = language_of(F.col(text_col), lexicons.language_profiles,
                           short="unknown", default="unknown")
    return share_of(df.select(*by, language.alias("language")), "language", by)


def share_of(df: DataFrame, column: str, by: tuple = (), rows: str | None = None) -> DataFrame:
    """Count and share of each value of a column, within ``by``; ``rows`` names how many texts a row stands for."""
    from pyspark.sql import Window

    counts = df.groupBy(*by, column).agg(F.sum(F.col(rows) if rows else F.lit(1)).alias("texts"))
    total = F.sum("texts").over(Window.partitionBy(*(by or [F.lit(0)])))
    return counts.withColumn("share", F.col("texts") / total)
