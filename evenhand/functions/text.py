"""Scalar text functions: Column in, Column out, no Python on the executors.

Regular expressions spell their character classes out.  ``\\b``, ``\\d`` and ``\\s``
mean different things in different JDKs and engines, so a word character is always
``[\\p{L}\\p{N}_]`` and whitespace is always the Unicode set below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenhand import lexicons as L

WORD_CHAR = r"[\p{L}\p{N}_]"
SPACE_CHAR = r"[\t-\r\x1c-\x20\x85\p{Z}]"
ODD_SPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}&&[^ ]]"
NOT_SPACE_CHAR = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
# The characters of SPACE_CHAR.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                           0x202F, 0x205F, 0x3000]))
NOT_BEFORE_WORD = rf"(?!{WORD_CHAR})"
NOT_AFTER_WORD = rf"(?<!{WORD_CHAR})"
# Either side of a word edge.
EDGE = rf"(?:{NOT_AFTER_WORD}(?={WORD_CHAR})|(?<={WORD_CHAR}){NOT_BEFORE_WORD})"

# What counts as a URL and as personal data, and the tag it becomes.
# One class under "+", because an alternation there recurses once per character.
URL_PATTERN = r"https?://[a-zA-Z0-9$-_@.&+!*\\(),]+"

# A leading lookahead for the first character lets the scan skip ordinary letters before
# it looks at word edges; a kind that starts and ends with a digit needs one side only.
PII_PATTERNS = {
    "EMAIL": EDGE + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}" + EDGE,
    "PHONE": r"(?=[+(0-9])" + EDGE
             + rf"(?:\+?1(?:[-.]|{SPACE_CHAR})?)?\(?[0-9]{{3}}\)?(?:[-.]|{SPACE_CHAR})?"
             + rf"[0-9]{{3}}(?:[-.]|{SPACE_CHAR})?[0-9]{{4}}" + NOT_BEFORE_WORD,
    "SSN": r"(?=\p{Nd})" + NOT_AFTER_WORD
           + r"\p{Nd}{3}-\p{Nd}{2}-\p{Nd}{4}" + NOT_BEFORE_WORD,
    "CREDIT_CARD": r"(?=\p{Nd})" + NOT_AFTER_WORD
                   + r"\p{Nd}{4}" + 3 * rf"(?:-|{SPACE_CHAR})?\p{{Nd}}{{4}}" + NOT_BEFORE_WORD,
    "IP_ADDRESS": r"(?=[0-9])" + NOT_AFTER_WORD
                  + r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}" + NOT_BEFORE_WORD,
}

#: What every match of a pattern holds.
NEEDED = {PII_PATTERNS["EMAIL"]: "@"}


def clean_text(text: Column) -> Column:
    """URLs become ``[URL]``, whitespace runs one space, ends are trimmed, then the
    remaining control characters go; null becomes the empty string."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), URL_PATTERN, "[URL]")
    # A single plain space is left alone, so most of the text is copied, not replaced.
    out = F.trim(F.regexp_replace(out, f" {SPACE_CHAR}+|{ODD_SPACE}{SPACE_CHAR}*", " "))
    return F.regexp_replace(out, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def stripped(text: Column) -> Column:
    """The text without the whitespace at its ends."""
    return F.trim(text, F.lit(SPACES))


def anonymize(text: Column, kinds: dict[str, str] | None = None) -> Column:
    """Replace personal data by its tag, kind after kind in the given order."""
    out = text
    for kind, pattern in (kinds or PII_PATTERNS).items():
        needed = NEEDED.get(pattern)
        if needed is None:
            out = F.regexp_replace(out, pattern, f"[{kind}]")
        else:  # a plain search spares most texts the expression; the array names the text, so that it is made once
            out = F.transform(F.array(out), lambda t: F.when(  # noqa: B023
                F.contains(t, F.lit(needed)), F.regexp_replace(t, pattern, f"[{kind}]")).otherwise(t))[0]  # noqa: B023
    return out


def truncate(text: Column, limit: int = 2048) -> Column:
    """The first ``limit`` characters."""
    return F.substring(text, 1, limit)


def profanity(text: Column, words: list[str] | None = None) -> Column:
    """Every whole-word match, repeats included, in reading order."""
    words = words or L.PROFANITY
    starts = "".join(sorted({w[0] for w in words}))
    pattern = f"(?=[{starts}]){NOT_AFTER_WORD}({'|'.join(words)}){NOT_BEFORE_WORD}"
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))


def words(text: Column) -> Column:
    """Lower-cased words in reading order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_CHAR + "+"), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated tokens."""
    return F.regexp_count(text, F.lit(NOT_SPACE_CHAR + "+"))


def syllables(text: Column) -> Column:
    """Vowel runs per word, a final silent ``e`` taken off, at least one per word.

    Summed over the text by counting three patterns, so no array of words is built:
    all vowel runs, plus the words without a vowel, less the words that end in ``e``
    and have an earlier run.
    """
    consonant = r"[\p{L}\p{N}_&&[^aeiouy]]"
    low = F.lower(text)
    runs = F.regexp_count(low, F.lit("[aeiouy]+"))
    without = F.regexp_count(low, F.lit(f"{NOT_AFTER_WORD}{consonant}++{NOT_BEFORE_WORD}"))
    silent = F.regexp_count(
        low, F.lit(f"{NOT_AFTER_WORD}{consonant}*+[aeiouy]++{consonant}{WORD_CHAR}*+(?<=e)")
    )
    return runs + without - silent


def readability(text: Column) -> Column:
    """Struct of Flesch score, Flesch grade and the two averages they rest on."""
    counts = F.struct(
        F.regexp_count(text, F.lit("[.!?]")).alias("sentences"),
        word_count(text).alias("words"),
        syllables(text).alias("syllables"),
    )
    # A one-element array: the counts are computed once and then named.
    return F.transform(F.array(counts), _readability_of)[0]


def _readability_of(c: Column) -> Column:
    zero = F.lit(0.0)
    empty = c["sentences"].isNull() | (c["sentences"] == 0) | (c["words"] == 0)
    per_sentence = F.when(~empty, c["words"] / c["sentences"])
    per_word = F.when(~empty, c["syllables"] / c["words"])
    flesch = F.lit(206.835) - F.lit(1.015) * per_sentence - F.lit(84.6) * per_word
    grade = F.lit(0.39) * per_sentence + F.lit(11.8) * per_word - F.lit(15.59)

    def unless_empty(value: Column) -> Column:
        return F.when(empty, zero).otherwise(value)

    return F.struct(
        unless_empty(F.greatest(zero, F.least(F.lit(100.0), flesch))).alias("flesch_score"),
        unless_empty(F.greatest(zero, grade)).alias("flesch_grade"),
        unless_empty(per_sentence).alias("avg_sentence_length"),
        unless_empty(per_word).alias("avg_syllables_per_word"),
    )


def severity(score: Column) -> Column:
    """Severity name of a score."""
    bounds = L.SEVERITY_BOUNDS
    return (
        F.when(score >= bounds["critical"], "critical")
        .when(score >= bounds["high"], "high")
        .when(score >= bounds["medium"], "medium")
        .when(score.isNotNull(), "low")
    )


def severity_rank(name: Column) -> Column:
    """1 for low up to 4 for critical."""
    return F.array_position(F.array(*[F.lit(s) for s in L.SEVERITIES]), name).cast("int")
