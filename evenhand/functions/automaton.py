"""Terms of lists of any length, found in one pass over a text by an Aho-Corasick automaton.

A regular expression (``matching``) needs no Python, but tries its tree of terms at nearly every place; an
automaton, built once per task, takes a time that depends on the text and its matches alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def build(terms):
    """An automaton whose values are the places of the terms in the list; None for an empty one."""
    import ahocorasick

    made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for n, term in enumerate(terms):
        made.add_word(term, n)
    if not len(made):
        return None
    made.make_automaton()
    return made


def _in_word(char: str) -> bool:
    return char == "_" or char.isalnum()


def occurring(automaton, terms, text: str) -> dict[int, bool]:
    """Terms that occur in the text, by place in the list, each with whether it does as a whole word."""
    found: dict[int, bool] = {}
    if automaton is None or not text:
        return found
    for end, n in automaton.iter(text):
        if found.get(n):
            continue
        start = end - len(terms[n])
        found[n] = not (start >= 0 and _in_word(text[start])
                        or end + 1 < len(text) and _in_word(text[end + 1]))
    return found


def automaton_terms(spark, low: Column, terms: list[str], whole_words: bool) -> Column:
    """Distinct terms that occur in the (lower-cased) text, in the order of the list.  Without a session the
    list, a short one, travels with the task instead of a broadcast."""
    shared = spark.sparkContext.broadcast(terms) if spark else None
    made: list = []

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        listed = shared.value if shared else terms
        if not made:
            made.append(build(listed))
        for texts in batches:
            hits = (occurring(made[0], listed, t) if t else {} for t in texts)
            yield pd.Series([[listed[n] for n in sorted(h) if h[n] or not whole_words]
                             for h in hits], dtype=object)

    find.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(find, "array<string>")(low)
