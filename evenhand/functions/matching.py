"""Which terms of a list occur in a text, in one pass over the text.

A list of some hundred terms must not mean some hundred scans.  The terms become one
regular expression shaped as a prefix tree, matched inside a lookahead so that
overlapping occurrences are all seen.  At every position it reports the longest term;
the shorter terms that start there are prefixes of it and are added from a small table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenhand.functions.text import NOT_AFTER_WORD, NOT_BEFORE_WORD, WORD_CHAR

# Longer lists are looked for by an automaton instead of an expression, with the same result.
EXPRESSION_TERMS = 5000
# The column of the lexicon rows found in a text (operators.lexicon_tables).
HITS = "_hits"

_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}])")


def escape(term: str) -> str:
    """The term as a literal inside a regular expression."""
    return _SPECIAL.sub(r"\\\1", term)


def sql_string(value: str | None) -> str:
    """A value as a SQL string literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_array(values) -> Column:
    """An array constant, built in one call however long the list is."""
    values = list(values)
    if not values:
        return F.expr("CAST(array() AS ARRAY<STRING>)")
    return F.expr(f"array({', '.join(map(sql_string, values))})")


def literal_structs(names, rows) -> Column:
    """An array of structs as a constant; a field is a string or a list of strings."""
    def field(value):
        if isinstance(value, (list, tuple)):
            return f"array({', '.join(map(sql_string, value))})"
        return sql_string(value)

    structs = ", ".join(
        "named_struct(" + ", ".join(
            f"{sql_string(n)}, {field(v)}" for n, v in zip(names, row, strict=True)) + ")"
        for row in rows)
    return F.expr(f"array({structs})")


def prefix_tree_pattern(terms) -> str:
    """One pattern that matches the longest of the terms at a position."""
    root: dict = {}
    for term in terms:
        node = root
        for char in term:
            node = node.setdefault(char, {})
        node[""] = {}

    def choice(branches: list[tuple[str, str]]) -> str:
        # Alternatives are tried one after another; halving them by the next character
        # keeps the number of tries per position small.
        if len(branches) <= 3:
            return "|".join(body for _, body in branches)
        half = len(branches) // 2
        return (f"(?=[{_char_class(c for c, _ in branches[:half])}])"
                f"(?:{choice(branches[:half])})|{choice(branches[half:])}")

    def render(node: dict) -> str:
        branches = [(char, escape(char) + render(child))
                    for char, child in sorted(node.items()) if char]
        if not branches:
            return ""
        if len(branches) == 1 and "" not in node:
            return branches[0][1]
        return f"(?:{choice(branches)})" + ("?" if "" in node else "")

    return render(root)


def _char_class(chars) -> str:
    return "".join(sorted({re.sub(r"([\\\]\[^&-])", r"\\\1", c) for c in chars}))


def _starts(terms) -> str:
    return _char_class(t[0] for t in terms)


def _with_prefixes(found: Column, prefixes: dict[str, list[str]]) -> Column:
    if not prefixes:
        return found
    entries = ", ".join(
        f"{sql_string(long)}, array({', '.join(map(sql_string, [long, *short]))})"
        for long, short in prefixes.items())
    table = F.expr(f"map({entries})")
    expanded = F.transform(found, lambda t: F.coalesce(F.element_at(table, t), F.array(t)))
    return F.array_distinct(F.flatten(expanded))


def _checked(terms) -> list[str]:
    terms = sorted(set(terms))
    if not terms or "" in terms:
        raise ValueError("terms must be a non-empty list of non-empty strings")
    return terms


def automaton_terms(low: Column, terms, whole_words: bool) -> Column:
    """``contained_terms`` or ``word_terms`` by an automaton in Python, however short the list is."""
    from evenhand.functions import automaton

    terms = _checked(terms)
    if len(terms) > EXPRESSION_TERMS:  # sent once, not with each task
        return _by_automaton(low, terms, whole_words)
    return automaton.automaton_terms(None, low, terms, whole_words)


def _by_automaton(low: Column, terms: list[str], whole_words: bool) -> Column:
    from pyspark.sql import SparkSession

    from evenhand.functions.automaton import automaton_terms

    return automaton_terms(SparkSession.active(), low, terms, whole_words)


class Listed:
    """A list of a lexicon table, or one category of it: what a text has of it stands in its hits."""

    def __init__(self, name: str, category: str | None = None) -> None:
        self.name, self.category = name, category

    def whole(self) -> Listed:
        return Listed(self.name)

    def hits(self) -> Column:
        def mine(h: Column) -> Column:
            listed = h["list"] == self.name
            return listed if self.category is None else listed & (h["category"] == self.category)

        return F.filter(F.col(HITS), mine)

    def found(self) -> Column:
        return F.array_distinct(F.transform(self.hits(), lambda h: h["term"]))

    def words(self) -> Column:
        return F.array_distinct(F.transform(F.filter(self.hits(), lambda h: h["word"]),
                                            lambda h: h["term"]))


def contained_terms(low: Column, terms) -> Column:
    """Distinct terms that occur anywhere in the (lower-cased) text."""
    terms = _checked(terms)
    if len(terms) > EXPRESSION_TERMS:
        return _by_automaton(low, terms, False)
    pattern = f"(?=[{_starts(terms)}])(?=({prefix_tree_pattern(terms)}))"
    prefixes = {
        long: short for long in terms
        if (short := [t for t in terms if t != long and long.startswith(t)])
    }
    found = F.array_distinct(F.regexp_extract_all(low, F.lit(pattern), F.lit(1)))
    return _with_prefixes(found, prefixes)


def word_terms(low: Column, terms) -> Column:
    """Distinct terms that occur as whole words in the (lower-cased) text."""
    terms = _checked(terms)
    if len(terms) > EXPRESSION_TERMS:
        return _by_automaton(low, terms, True)
    # The first character is the cheaper look: most places fail at it.
    pattern = (f"(?=[{_starts(terms)}]){NOT_AFTER_WORD}"
               f"(?=({prefix_tree_pattern(terms)}){NOT_BEFORE_WORD})")
    prefixes = {
        long: short for long in terms
        if (short := [t for t in terms if t != long and long.startswith(t)
                      and not re.match(r"\w", long[len(t)])])
    }
    found = F.array_distinct(F.regexp_extract_all(low, F.lit(pattern), F.lit(1)))
    return _with_prefixes(found, prefixes)


def among(found: Column, terms) -> Column:
    """Those of ``terms`` that were found, in the order of ``terms``."""
    if isinstance(terms, Listed):
        return terms.found()
    return F.array_intersect(literal_array(terms), found)


def any_of(found: Column, terms) -> Column:
    if isinstance(terms, Listed):
        return F.size(terms.hits()) > 0
    return F.arrays_overlap(found, literal_array(terms))


def pattern_of(term: Column) -> Column:
    """The term as a literal inside a regular expression."""
    return F.regexp_replace(term, r"([\\.^$|?*+()\[\]{}\- #&~\t\n\r\x0b\x0c])", r"\\$1")


def first_word_position(low: Column, term: Column) -> Column:
    """1-based position of the first whole-word occurrence, 0 if there is none.

    ``term`` must already be safe inside a pattern.
    """
    return F.regexp_instr(low, F.concat(F.lit(NOT_AFTER_WORD), term, F.lit(NOT_BEFORE_WORD)))


__all__ = ["EXPRESSION_TERMS", "HITS", "Listed", "WORD_CHAR", "among", "any_of", "automaton_terms", "contained_terms", "escape",
           "first_word_position", "literal_array", "literal_structs", "pattern_of", "prefix_tree_pattern",
           "sql_string", "word_terms"]
