"""Counterfactual variants of texts and test sentences.

A variant is first described in its text's row: which method replaces what by what.  Descriptions
are a few words each, so a row stays about as large as its text however many variants there are;
the variant's text is built behind the generator that makes a row of each description, and a text
is cut at a word once for all names that replace it.  Equal variants are told apart in Python over
Arrow batches by where they first differ from their text, and scored by what lies around their
replaced words, so that the time follows the text and the number of variants, not their length.  No
operator needs a shuffle.  Where a name or profession is picked, the pick is a hash of the key
(``hash_pick``); any function of (key, salt, size) can be passed instead.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from evenhand import lexicons as L
from evenhand.functions import matching as M
from evenhand.functions import text as T

# A variant's description: `word` is what the method replaces (or the whole sentence of a filled
# template) and orders the variants of a method and target.
DESCRIBED = ("array<struct<method: string, target: string, word: string, to: string, "
             "capital: string, to_capital: string>>")
DESCRIBED_FIELDS = ("method", "target", "word", "to", "capital", "to_capital")
SIGNIFICANT = 0.1
ALL_ADJECTIVES = [a for kind in L.TEMPLATE_ADJECTIVES.values() for a in kind]


def hash_pick(key: Column, salt: str | Column, size: int) -> Column:
    """A stable pseudo-random index below ``size``."""
    salt = F.lit(salt) if isinstance(salt, str) else salt
    return F.pmod(F.xxhash64(key, salt), F.lit(size))


def _none() -> Column:
    return F.expr(f"CAST(array() AS {DESCRIBED})")


def _described(method: str, target: str | Column, word: Column | None = None,
               to: Column | None = None, capital: Column | None = None,
               to_capital: Column | None = None) -> Column:
    target = F.lit(target) if isinstance(target, str) else target
    word = F.lit("") if word is None else word
    rest = [("to", to), ("capital", capital), ("to_capital", to_capital)]
    return F.struct(F.lit(method).alias("method"), target.alias("target"), word.alias("word"), *[
        (F.lit(None).cast("string") if c is None else c).alias(n) for n, c in rest])


def _pick_from(values: list[str], index: Column) -> Column:
    return F.get(M.literal_array(values), index.cast("int"))


# -- substitutions ----------------------------------------------------------


def _whole(term: str, edge: str = T.NOT_BEFORE_WORD) -> str:
    """The term as a whole word.  The term comes first and the look behind it second, so that most
    places fail at their first character."""
    return f"{M.escape(term)}(?<!{T.WORD_CHAR}{M.escape(term)}){edge}"


def _gender_word(term: str) -> str:
    return _whole(term, T.NOT_BEFORE_WORD if term[-1].isalnum() else "")


def gender_variants(text: Column) -> Column:
    """Male pronouns and titles replaced by those of each other gender, as whole words, in
    lower and capitalised form."""
    sources = {s for t in L.SWAP_PRONOUNS.values() for s in t}
    sources |= {s.capitalize() for s in sources} | {s for t in L.SWAP_TITLES.values() for s in t}
    starts = "".join(sorted({s[0] for s in sources}))
    present = f"(?=[{starts}])(?:{'|'.join(_gender_word(s) for s in sorted(sources))})"
    every = F.array(*[_described("gender", t) for t in L.SWAP_PRONOUNS])
    return F.when(text.rlike(present), every).otherwise(_none())


def _gender_text(text: Column, target: str) -> Column:
    table = {}
    for source, to in L.SWAP_PRONOUNS[target].items():
        table[source], table[source.capitalize()] = to, to.capitalize()
    table.update(L.SWAP_TITLES[target])
    return reduce(lambda out, item: F.regexp_replace(out, _gender_word(item[0]), item[1]),
                  table.items(), text)


NAME_LISTS = {f"{g}_names": names for g, names in L.GENDER_NAMES.items()} | L.ETHNIC_NAMES


def _name_words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(
        text, F.lit(f"[A-Z](?<!{T.WORD_CHAR}[A-Z])[a-z]++{T.NOT_BEFORE_WORD}"), F.lit(0)))


def _picked_names(key: Column, pick) -> dict[str, Column]:
    return {target: _pick_from(names, pick(key, target, len(names)))
            for target, names in NAME_LISTS.items()}


def name_variants(text: Column, key: Column, pick=hash_pick) -> Column:
    """Each distinct capitalised word replaced everywhere by a name of each gender and
    ethnicity list."""
    found = _name_words(text)
    picked = F.array(*[F.struct(F.lit(target).alias("target"), name.alias("name"))
                       for target, name in _picked_names(key, pick).items()])
    # The picks depend on the key alone: made once a row.
    every = F.flatten(F.transform(F.array(picked), lambda names: F.flatten(F.transform(
        found, lambda word: F.transform(names, lambda x: _described(
            "name", x["target"], word, x["name"]))))))
    return F.filter(every, lambda v: v["word"] != v["to"])


def _race_pattern(race: str) -> str:
    return f"(?i)(?:{'|'.join(map(_whole, L.RACE_SWAP_TERMS[race]))})"


def race_variants(text: Column, low: Column | None = None) -> Column:
    """Race terms, in any case, replaced by the label of each other race.  A plain search of the lower-cased text
    spares most texts the expression."""
    low, parts = F.lower(text) if low is None else low, []
    for race in L.RACE_SWAP_TERMS:
        others = F.array(*[
            _described("race", f"{race}>{target}", to=F.lit(target), capital=F.lit(race))
            for target in L.RACE_SWAP_TERMS if target != race])
        held = reduce(lambda a, b: a | b, [low.contains(t) for t in L.RACE_SWAP_TERMS[race]])
        parts.append(F.when(held & text.rlike(_race_pattern(race)), others).otherwise(_none()))
    return F.concat(*parts)


def religion_variants(text: Column, low: Column) -> Column:
    """Religion terms replaced by the term at the same place of each other religion, as
    written in the list and capitalised."""
    rows = [
        (f"{source}>{target}", term.lower(), term, to, term.capitalize(), to.capitalize())
        for source, terms in L.RELIGION_SWAP_TERMS.items()
        for n, term in enumerate(terms)
        for target, others in L.RELIGION_SWAP_TERMS.items()
        if target != source and (to := others[n]) != term
    ]
    table = M.literal_structs(("target", "low", "term", "to", "capital", "to_capital"), rows)
    found = F.array(*[F.when(low.contains(t), t) for t in sorted({r[1] for r in rows})])

    def swap(hits: Column) -> Column:
        matching = F.filter(table, lambda p: F.array_contains(hits, p["low"]))
        return F.when(F.exists(hits, lambda h: h.isNotNull()), F.transform(matching, lambda p: _described(
            "religion", p["target"], p["term"], p["to"], p["capital"], p["to_capital"]))).otherwise(_none())

    # Matched once per text, then named.
    return F.flatten(F.transform(F.array(found), swap))


def _template_rows(templates=None, attributes=None, adjectives=None) -> list[tuple[str, str, str]]:
    return [(f"{n}/{attribute}/{adjective}", attribute, _fill(template, attribute, adjective))
            for n, template in enumerate(templates or L.TEMPLATES)
            for attribute in attributes or L.TEMPLATE_ATTRIBUTES
            for adjective in adjectives or ALL_ADJECTIVES]


def _slot_picks(key: Column, salt: Column, pick) -> tuple[Column, Column]:
    """Places of the name and of the profession that fill a template."""
    return (pick(key, F.concat(salt, F.lit("/name")), len(L.GENDER_NAMES["male"])),
            pick(key, F.concat(salt, F.lit("/profession")), len(L.PROFESSIONS)))


def template_variants(key: Column, templates=None, attributes=None, adjectives=None,
                      pick=hash_pick) -> Column:
    """Filled templates: every template, attribute and adjective, with a picked name and
    profession."""
    rows = _template_rows(templates, attributes, adjectives)

    def filled(row: Column) -> Column:
        name, job = _slot_picks(key, row["salt"], pick)
        return F.replace(F.replace(row["sentence"], F.lit("{name}"), _pick_from(L.GENDER_NAMES["male"], name)),
                         F.lit("{profession}"), _pick_from(L.PROFESSIONS, job))

    table = M.literal_structs(("salt", "target", "sentence"), rows)
    return F.transform(table, lambda r: _described("template", r["target"], filled(r)))


def _fill(template: str, attribute: str, adjective: str) -> str:
    slots = {"attribute": attribute, "adjective": adjective, "characteristic": adjective,
             "trait": adjective, **L.TEMPLATE_CONSTANTS}
    return reduce(lambda s, kv: s.replace("{" + kv[0] + "}", kv[1]), slots.items(), template)


_BUILDERS = {
    "gender": lambda text, low, key, pick: gender_variants(text),
    "name": lambda text, low, key, pick: name_variants(text, key, pick),
    "race": lambda text, low, key, pick: race_variants(text, low),
    "religion": lambda text, low, key, pick: religion_variants(text, low),
    "template": lambda text, low, key, pick: template_variants(key, pick=pick),
}
DIRECT = ("gender", "name", "race", "religion")


def built(text: Column, v: Column, methods=tuple(_BUILDERS)) -> Column:
    """The variant of ``text`` that the description ``v`` stands for."""
    forms = {
        # The word is letters alone, the name from a list: as a pattern it's found by skips.
        "name": lambda: F.regexp_replace(text, v["word"], v["to"]),
        "religion": lambda: F.replace(F.replace(text, v["word"], v["to"]), v["capital"],
                                      v["to_capital"]),
        "template": lambda: v["word"],
        "gender": lambda: F.coalesce(*[F.when(v["target"] == t, _gender_text(text, t))
                                       for t in L.SWAP_PRONOUNS]),
        "race": lambda: F.coalesce(*[F.when(v["capital"] == race, F.regexp_replace(
            text, F.lit(_race_pattern(race)), v["to"])) for race in L.RACE_SWAP_TERMS]),
    }
    return F.coalesce(*[F.when(v["method"] == m, forms[m]()) for m in methods])


def _descriptions(text: Column, low: Column, key: Column, methods, pick) -> Column:
    return F.concat(*[_BUILDERS[m](text, low, key, pick) for m in methods])


def _joined(rows: DataFrame, pieces: Column, fills: Column, keep: list[str]) -> DataFrame:
    """A row per element of ``fills``, with its fields, and a ``_variant``: ``pieces`` of a text put together with
    its ``_fill``.

    A text is cut at a word once for all names that replace it.  The pieces come out of a generator, so that
    filters on them don't reach below it and cut the text once more."""
    cut = rows.select(*keep, fills.alias("_fills"), F.inline_outer(F.array(F.struct(pieces.alias("_pieces")))))
    filled = cut.where(F.size("_pieces") > 0).select(*keep, "_pieces", F.inline_outer("_fills"))
    return filled.where(F.col("_fill").isNotNull()).withColumn(
        "_variant", F.call_function("concat_ws", F.col("_fill"), F.col("_pieces")))


def substitutions(df: DataFrame, methods=DIRECT, text_col: str = "text",
                  key_col: str = "doc_id", pick=hash_pick) -> DataFrame:
    """One row per variant of the given methods: method, target, variant."""
    text, key, keep = F.col(text_col), F.col(key_col), [c for c in df.columns if c != text_col]
    few, named = [m for m in methods if m != "name"], "name" in methods
    # Either a word, which all names of the row replace, or one description of another method.
    sources = [F.transform(_name_words(text), lambda w: _described("name", "", w))] * named
    if few:
        sources.append(_descriptions(text, F.col("_low"), key, few, pick))
    names = F.array(*[F.struct(F.lit(target).alias("_target"), name.alias("_fill"))
                      for target, name in (_picked_names(key, pick) if named else {}).items()])
    # Lower-cased apart, as it is searched for many terms.
    rows = df.withColumn("_low", F.lower(text)).select(*keep, text.alias("_text"), *[names.alias("_names")] * named,
                                                       F.concat(*sources).alias("_sources"))
    rows = rows.select(*[c for c in rows.columns if c != "_sources"], F.explode_outer("_sources").alias("_v"))
    v, text, renamed = F.col("_v"), F.col("_text"), F.col("_v")["method"] == "name"
    split = F.split(text, v["word"], -1)
    alone = F.array(F.struct(v["target"].alias("_target"), F.lit("").alias("_fill")))
    if not few:
        pieces, fills = split, F.col("_names")
    else:
        pieces, fills = F.array_remove(F.array(built(text, v, few)), text), alone
        if named:
            pieces, fills = F.when(renamed, split).otherwise(pieces), F.when(renamed, F.col("_names")).otherwise(alone)
    rows = rows.where(v.isNotNull()).select(*keep, "_text", *["_names"] * named, "_v", v["method"].alias("_method"),
                                            v["word"].alias("_word"))
    out = _joined(rows, pieces, fills, [*keep, "_method", "_word"])
    return out.where((F.col("_method") != "name") | (F.col("_word") != F.col("_fill"))).select(
        *keep, F.col("_method").alias("method"), F.col("_target").alias("target"), F.col("_variant").alias("variant"))


# -- distinct variants --------------------------------------------------------

_SKEWED = [*L.SKEW_WORDS["positive"], *L.SKEW_WORDS["negative"]]
_REACH = max(map(len, _SKEWED)) - 1
# Characters that follow and go before each in the scored words.
_AFTER = {c: {w[n + 1] for w in _SKEWED for n in range(len(w) - 1) if w[n] == c} for c in {*"".join(_SKEWED)}}
_BEFORE = {c: {w[n] for w in _SKEWED for n in range(len(w) - 1) if w[n + 1] == c} for c in {*"".join(_SKEWED)}}
_RUN = re.compile("[A-Z][a-z]+")


def _skew_of(words: Iterable[str]) -> float:
    held = set(words)
    p = sum(w in held for w in L.SKEW_WORDS["positive"])
    n = sum(w in held for w in L.SKEW_WORDS["negative"])
    return abs(p - n) / (p + n) if p + n else 0.0


def _text_score(text: str) -> float:
    low = text.lower()
    return _skew_of(w for w in _SKEWED if w in low)


def _starts(text: str, word: str, step: int) -> Iterator[int]:
    at = text.find(word)
    while at >= 0:
        yield at
        at = text.find(word, at + step)


class _Places:
    """Where the words of a text stand, found in one pass.

    A word is a capital and small letters, so it stands where a run of those begins with it, and nowhere
    overlaps itself."""

    def __init__(self, text: str) -> None:
        self.runs: dict[str, list[int]] = {}
        for run in _RUN.finditer(text):
            self.runs.setdefault(run.group(), []).append(run.start())
        self.ordered = sorted(self.runs)

    def of(self, word: str) -> list[int]:
        n, found = bisect_left(self.ordered, word), []
        while n < len(self.ordered) and self.ordered[n].startswith(word):
            found.append(self.runs[self.ordered[n]])
            n += 1
        return found[0] if len(found) == 1 else sorted(x for places in found for x in places)


class _Renamed:
    """Scores of a text's variants with one word replaced, each from what lies around the replaced places.

    A scored word of a variant either stands in a piece that is left as it was, or touches a new name
    and lies within ``_REACH`` characters of it."""

    def __init__(self, text: str, places: _Places | None = None) -> None:
        # The one character that gives two in lower case: an i, which ends no scored word, and a dot above.
        if "İ" in text and not any(w.endswith("i") for w in _SKEWED):
            text = text.replace("İ", "̇")
        low = text.lower()
        self.text, self.low, self.aligned = text, low, len(low) == len(text)
        self.names, self.ends = None, []
        self.places = places or _Places(text)
        self.held = [(w, list(_starts(low, w, 1))) for w in _SKEWED if w in low] if self.aligned else []

    def score(self, word: str, to: str) -> float:
        return self.scores(word, [to])[0]

    def scores(self, word: str, names: list[str]) -> list[float]:
        """Of the variants with the word replaced by each of the names."""
        if not self.aligned:
            return [_text_score(self.text.replace(word, to)) for to in names]
        at, left, value, before, after = self._cut(word)
        pieces = None

        def touched(to: str) -> float:
            nonlocal pieces
            pieces = pieces or self._pieces(at, len(word))
            near = to.join(pieces).lower()
            return _skew_of(w for w in _SKEWED if w in left or w in near)

        if before is None:
            return [touched(to) for to in names]
        # A scored word in or over an edge of a name.
        first, last = {c for b in before for c in _AFTER.get(b, "")}, {c for b in after for c in _BEFORE.get(b, "")}
        if self.names != names:
            lows = [to.lower() for to in names]
            self.names = names
            self.ends = [(w[:1], w[-1:], not w or any(x in w for x in _SKEWED)) for w in lows]
        return [touched(to) if holds or a in first or b in last else value
                for to, (a, b, holds) in zip(names, self.ends, strict=True)]

    def _cut(self, word: str) -> tuple:
        """Places of the word, scored words left where it is replaced, their score, and the characters around
        its places, unless some touch."""
        size, low = len(word), self.low
        at = self.places.of(word)

        def untouched(place: int, w: str) -> bool:
            n = bisect_right(at, place - size)
            return n == len(at) or at[n] >= place + len(w)

        left = {w for w, places in self.held if any(untouched(x, w) for x in places)}
        before = after = None
        if all(y - x > size for x, y in pairwise(at)):
            before = {low[x - 1] for x in at if x}
            after = {low[x + size] for x in at if x + size < len(low)}
        return at, left, _skew_of(left), before, after

    def _pieces(self, at: list[int], size: int) -> list[str]:
        ends = zip([0, *[x + size for x in at]], [*at, len(self.text)], strict=True)
        return [self.text[a:b] if b - a <= 2 * _REACH
                else f"{self.text[a:a + _REACH]}\0{self.text[b - _REACH:b]}" for a, b in ends]


def _first_difference(a: str, b: str) -> int:
    if a[:1] != b[:1]:
        return 0
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class _Distinct:
    """Variants of a text told apart without building them: equal ones have the same length, differ from the text
    first at the same place and there by the same character.  Those alike in this are built and compared."""

    def __init__(self, text: str, places: _Places) -> None:
        self.text, self.places, self.seen, self.words = text, places, {}, {}

    def _stands(self, word: str) -> tuple[int, int]:
        if word not in self.words:
            at = self.places.of(word)
            self.words[word] = at[0], len(at)
        return self.words[word]

    def start(self, word: str) -> int:
        return self._stands(word)[0]

    def length(self, word: str, to: str) -> int:
        return len(self.text) + self._stands(word)[1] * (len(to) - len(word))

    def mark(self, v: str | tuple[str, str]) -> tuple:
        if isinstance(v, tuple):
            word, to = v
            length, start, n = self.length(word, to), self.start(word), _first_difference(word, to)
            if n < len(word) and n < len(to):
                return length, start + n, to[n]
            # One begins with the other: what follows the word in the text decides, unless it goes on alike.
            follows = self.text[start + len(word):start + len(word) + 1]
            if to and follows != (to + word)[n if n == len(word) else len(to) + n]:
                return length, start + n, to[n] if n == len(word) else follows
            v = self.text.replace(word, to)
        n = _first_difference(self.text, v)
        return len(v), n, v[n:n + 1]

    def _built(self, v: str | tuple[str, str]) -> str:
        return v if isinstance(v, str) else self.text.replace(*v)

    def add(self, v: str | tuple[str, str]) -> bool:
        """Whether the variant, itself or as (word, name), is the first of its kind."""
        alike = self.seen.setdefault(self.mark(v), [])
        # A word's places filled by two names make two variants.
        others = [x for x in alike if not (isinstance(v, tuple) and isinstance(x, tuple) and v[0] == x[0])]
        if others and (built_ := self._built(v)) in map(self._built, others):
            return False
        alike.append(v)
        return True


class _Templates:
    """Filled templates by the places of their picks: distinct ones in their order, with scores."""

    def __init__(self) -> None:
        self.rows, self.known, self.scores = _template_rows(), {}, {}
        self.longest = max(len(s) for _, _, s in self.rows) + sum(
            max(map(len, values)) for values in (L.GENDER_NAMES["male"], L.PROFESSIONS))

    def _score(self, sentence: str) -> float:
        if sentence not in self.scores:
            if len(self.scores) >= 100_000:
                self.scores.clear()
            self.scores[sentence] = _text_score(sentence)
        return self.scores[sentence]

    def filled(self, picks) -> tuple:
        """Rows, picks, scores and sentences, for ``picks`` of the rows in ``_slotted`` order."""
        import numpy as np

        if (key := picks.tobytes()) not in self.known:
            if len(self.known) >= 256:
                self.known.clear()
            names, jobs = L.GENDER_NAMES["male"], L.PROFESSIONS
            places = dict(zip(_slotted(self.rows), picks.tolist(), strict=True))
            first: dict[tuple[str, str], int] = {}
            for n, (_, target, sentence) in enumerate(self.rows):
                if n in places:
                    name, job = divmod(places[n], len(jobs))
                    sentence = sentence.replace("{name}", names[name]).replace("{profession}", jobs[job])
                first.setdefault((target, sentence), n)
            rows: dict[str, int] = {}
            for (_, sentence), n in sorted(first.items()):
                rows.setdefault(sentence, n)
            self.known[key] = (
                np.array([*rows.values()], "int32"), np.array([places.get(n, 0) for n in rows.values()], "int32"),
                np.array([self._score(s) for s in rows]), list(rows))
        return self.known[key]

    def others(self, picks, excluded: set[str], limit: int | None) -> tuple:
        """Rows, picks and scores of the first sentences that are not excluded."""
        *columns, sentences = self.filled(picks)
        if excluded and not excluded.isdisjoint(sentences):
            left = [n for n, s in enumerate(sentences) if s not in excluded]
            columns = [c[left] for c in columns]
        return tuple(c[:limit] for c in columns)


def _slotted(rows: list[tuple[str, str, str]]) -> list[int]:
    """Places of the template rows that a pick fills."""
    return [n for n, (_, _, sentence) in enumerate(rows) if "{name}" in sentence or "{profession}" in sentence]


def _contested(text: str, words: list[str], names: list[str], variants: list[str], distinct: _Distinct) -> set[int]:
    """Places of the words of which a renamed variant may equal another variant.

    Names that don't begin alike with a word differ from it within its first place, and those places lie apart but
    for words that begin alike.  So a variant is like no other unless a word begins like a name or another word, or
    the first difference of another variant lies in that place."""
    starts, begun = {}, {to[:2] for to in names}
    for k, word in enumerate(words):
        starts.setdefault(distinct.start(word), []).append(k)
    found = {k for ks in starts.values() for k in ks if len(ks) > 1 or words[k][:2] in begun}
    marks = [distinct.mark((w, to))[1] for k in found for to in names
             if to[:1] == (w := words[k])[0] and to != w and (to.startswith(w) or w.startswith(to))]
    marks += [_first_difference(text, v) for v in variants]
    ordered = sorted(starts)
    for at in marks:
        n = bisect_right(ordered, at) - 1
        found.update(k for k in (starts[ordered[n]] if n >= 0 else ()) if at <= ordered[n] + len(words[k]))
    return found


def _variants_of(text: str, others: list[dict], words: list[str], names: list[str | None], longest: int,
                 scored: bool) -> tuple:
    """Distinct changed variants of a text in the order of (method, target, word), templates left out: arrays of the place
    of the description or, after those, of the word; of that of the name; and of the score.  Also a set of those, and
    the text, that are no longer than ``longest``."""
    import numpy as np

    distinct, short = _Distinct(text, _Places(text) if words else None), {text} if len(text) <= longest else set()
    variants = {}
    for n, how in enumerate(others):
        variant = how["made"]
        if how["method"] == "religion":
            variant = text.replace(how["word"], how["to"]).replace(how["capital"], how["to_capital"])
        if variant is not None and variant != text:
            variants[n] = variant
    steps = sorted((o["method"], o["target"], o["word"], n) for n, o in enumerate(others) if n in variants)
    sources, picked, scores = [[]], [[]], [[]]

    def of_others(some: list[tuple]) -> None:
        kept = [n for *_, n in some if distinct.add(variants[n])]
        sources.append(kept)
        picked.append([-1] * len(kept))
        scores.append([_text_score(variants[n]) for n in kept] if scored else [])
        short.update(v for n in kept if len(v := variants[n]) <= longest)

    of_others([x for x in steps if x[0] < "name"])
    firsts: dict[str, tuple] = {}
    listed = zip(NAME_LISTS, range(len(names)), names, strict=True) if words else ()
    for target, n, to in sorted(x for x in listed if x[2]):
        firsts.setdefault(to, (target, n))  # the same name of another list makes the same variants
    if firsts:
        filled, places = [*firsts], [n for _, n in firsts.values()]
        order = sorted(range(len(words)), key=words.__getitem__)
        kept = np.ones((len(filled), len(words)), bool)
        renamed = _Renamed(text, distinct.places) if scored else None
        values = np.array([renamed.scores(words[k], filled) for k in order]).T if scored else None
        doubtful = _contested(text, words, filled, [*variants.values()], distinct)
        doubtful = [(c, words[k]) for c, k in enumerate(order) if k in doubtful]
        for r, to in enumerate(filled):
            for c, word in doubtful:
                kept[r, c] = word != to and distinct.add((word, to))
        least = min(map(len, filled))
        for c, word in enumerate(words[k] for k in order):
            if distinct.length(word, "x" * least) <= longest:
                short.update(text.replace(word, to) for to in filled if distinct.length(word, to) <= longest)
        sources.append((np.broadcast_to(np.array(order) + len(others), kept.shape))[kept])
        picked.append(np.broadcast_to(np.array(places)[:, None], kept.shape)[kept])
        scores.append(values[kept] if scored else [])
    of_others([x for x in steps if x[0] > "name"])
    return (np.concatenate(sources).astype("int32"), np.concatenate(picked).astype("int32"),
            np.concatenate(scores).astype("float64"), short)


def _kept_rows(batch, text_col: str, templates: _Templates, limit: int | None, scored: bool) -> Iterator[tuple | None]:
    """For each row of a batch what ``_variants_of`` gives, and its templates."""
    import numpy as np

    # Lists become Python values row by row, since a batch has thousands of rows.
    columns = [batch.column(c) for c in (text_col, "_others", "_words", "_names")]
    picks, nothing = batch.column("_picks"), (np.empty(0, "int32"), np.empty(0, "int32"), np.empty(0))
    for k in range(batch.num_rows):
        text, others, words, names = (c[k].as_py() for c in columns)
        if text is None:
            yield None
            continue
        *found, short = _variants_of(text, others or [], words or [], names or [], templates.longest, scored)
        chosen, filled = picks[k].values, nothing
        if chosen is not None and len(chosen) and not chosen.null_count:
            rest = None if limit is None else max(0, limit - len(found[0]))
            filled = templates.others(chosen.to_numpy(), short, rest)
        yield *(f[:limit] for f in found), filled


_KEPT = "_kept array<struct<rank: int, n: int, place: int>>, _units array<struct<source: int, first: int, size: int>>"


def _with_kept(limit: int | None, text_col: str):
    """Batches of rows with ``_kept`` and ``_units`` added and the columns that only they were made from dropped."""
    def columns_of(row: tuple | None) -> tuple:
        import numpy as np

        if row is None:
            return ((), (), ()), ((), (), ())
        sources, picked, _, (rows, places, _) = row
        order = np.argsort(sources, kind="stable")  # all variants of a word side by side
        units, first, size = np.unique(sources[order], return_index=True, return_counts=True)
        n = len(sources)
        kept = (np.concatenate([order, np.arange(n, n + len(rows))]), np.concatenate([picked[order], rows]),
                np.concatenate([np.zeros(n, "int32"), places]))
        if len(rows):
            units, first, size = np.append(units, -1), np.append(first, n), np.append(size, len(rows))
        return kept, (units, first, size)

    def with_kept(batches):
        import numpy as np
        import pyarrow as pa

        templates = _Templates()

        def listed(rows: list[tuple], names: tuple[str, ...]):
            sizes = np.cumsum([0, *[len(r[0]) for r in rows]])
            fields = [pa.array(np.concatenate([np.empty(0, "int32"), *[r[f] for r in rows]]).astype("int32"))
                      for f in range(len(names))]
            return pa.ListArray.from_arrays(pa.array(sizes.astype("int32")), pa.StructArray.from_arrays(fields, names))

        for batch in batches:
            both = [columns_of(r) for r in _kept_rows(batch, text_col, templates, limit, False)]
            left = [c for c in batch.schema.names if c != "_picks"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in left], listed([b[0] for b in both], ("rank", "n", "place")),
                 listed([b[1] for b in both], ("source", "first", "size"))], names=[*left, "_kept", "_units"])

    return with_kept


def _with_means(limit: int | None, compared: int | None, text_col: str):
    """Batches of rows with the mean score of the variants as ``variant_score``, and without the text."""
    def mean(row: tuple | None) -> float | None:
        import numpy as np

        if row is None:
            return None
        scores = np.concatenate([row[2], row[3][2]])[:compared]
        # Summed one after another.
        return float(np.cumsum(scores)[-1]) / len(scores) if len(scores) else None

    def with_means(batches):
        import pyarrow as pa

        templates = _Templates()
        for batch in batches:
            means = [mean(r) for r in _kept_rows(batch, text_col, templates, limit, True)]
            left = [c for c in batch.schema.names if c not in (text_col, "_others", "_words", "_names", "_picks")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in left], pa.array(means, pa.float64())],
                                             names=[*left, "variant_score"])

    return with_means


def _described_rows(df: DataFrame, text_col: str, key_col: str, pick, methods) -> DataFrame:
    """``df`` with what the variants of its texts are made from.  Only words and places go to Python; variants made by
    patterns are few and come with the text."""
    text, key = F.col(text_col), F.col(key_col)
    few = [m for m in ("gender", "race", "religion") if m in methods]
    patterned = [m for m in few if m != "religion"]
    strings, fields = F.expr("CAST(array() AS array<string>)"), DESCRIBED_FIELDS
    jobs = len(L.PROFESSIONS)

    def made(v: Column) -> Column:
        variant = F.when(v["method"].isin(patterned), built(text, v, patterned)) if patterned else (
            F.lit(None).cast("string"))
        return F.struct(*[v[f].alias(f) for f in fields], variant.alias("made"))

    def place(salt: Column) -> Column:
        name, job = _slot_picks(key, salt, pick)
        return (name * jobs + job).cast("int")

    templates = _template_rows()
    described = _descriptions(text, F.col("_low"), key, few, pick) if few else _none()
    return df.withColumn("_low", F.lower(text)).select(
        *df.columns, F.transform(described, made).alias("_others"),
        (_name_words(text) if "name" in methods else strings).alias("_words"),
        (F.array(*_picked_names(key, pick).values()) if "name" in methods else strings).alias("_names"),
        (F.transform(M.literal_array([templates[n][0] for n in _slotted(templates)]), place)
         if "template" in methods else F.expr("CAST(array() AS array<int>)")).alias("_picks"))


def _distinct(df: DataFrame, per_text: int | None, text_col: str, key_col: str, pick, methods) -> DataFrame:
    """``df`` with its distinct changed variants in ``_kept``, each with its rank by (method, target, word), of
    equal ones the first; a limit keeps the first of them.  Those of one source, in ``_units``, lie side by side:
    a description in ``_others``, after those a word, or (-1) the templates.  ``n`` is the place of the name or
    of the template."""
    rows = _described_rows(df, text_col, key_col, pick, methods)
    schema = T_.StructType([*rows.drop("_picks").schema.fields, *T_.StructType.fromDDL(_KEPT).fields])
    return rows.mapInArrow(_with_kept(per_text, text_col), schema)


def counterfactuals(df: DataFrame, per_text: int | None = None, text_col: str = "text",
                    key_col: str = "doc_id", pick=hash_pick,
                    methods=tuple(_BUILDERS)) -> DataFrame:
    """Distinct variants of each text by (method, target, replaced word); all, or the first
    ``per_text``."""
    out = _distinct(df, per_text, text_col, key_col, pick, methods)
    keep = [c for c in df.columns if c != text_col]
    unit = F.col("_unit")
    rows = out.select(*keep, F.col(text_col).alias("_text"), "_others", "_words", "_names", "_kept",
                      F.explode_outer("_units").alias("_unit")).where(unit.isNotNull())
    rows = rows.select(*keep, "_text", "_names", F.when(unit["source"] >= 0, F.get("_others", unit["source"])).alias("_v"),
                       F.get("_words", unit["source"] - F.size("_others")).alias("_word"),
                       F.slice("_kept", unit["first"] + 1, unit["size"]).alias("_fills"))
    v, text, word, n, place = F.col("_v"), F.col("_text"), F.col("_word"), F.col("_pick.n"), F.col("_pick.place")
    # A text cut at a word, one variant, or nothing around a sentence.
    made = F.when(v["method"] == "religion", built(text, v, ("religion",))).otherwise(v["made"])
    pieces = F.when(word.isNotNull(), F.split(text, word, -1)).when(v.isNotNull(), F.array(made)).otherwise(
        F.array(F.lit(""), F.lit("")))
    templates, jobs = _template_rows(), len(L.PROFESSIONS)
    name = _pick_from(L.GENDER_NAMES["male"], F.floor(place / jobs))
    sentence = F.replace(F.replace(_pick_from([r[2] for r in templates], n), F.lit("{name}"), name),
                         F.lit("{profession}"), _pick_from(L.PROFESSIONS, place % jobs))
    kept = rows.select(*keep, "_names", "_word", v["method"].alias("_method"), v["target"].alias("_target"), "_fills",
                       F.inline_outer(F.array(F.struct(pieces.alias("_pieces")))))
    kept = kept.select(*[c for c in kept.columns if c != "_fills"], F.explode_outer("_fills").alias("_pick"))

    def by_kind(renamed: Column, given: Column, filled: Column) -> Column:
        return F.when(word.isNotNull(), renamed).when(F.col("_method").isNotNull(), given).otherwise(filled)

    fill = by_kind(F.get("_names", n), F.lit(""), sentence)
    return kept.select(
        *keep, (F.col("_pick.rank") + 1).alias("variant_rank"),
        by_kind(F.lit("name"), F.col("_method"), F.lit("template")).alias("method"),
        by_kind(_pick_from(list(NAME_LISTS), n), F.col("_target"), _pick_from([r[1] for r in templates], n)).alias("target"),
        F.call_function("concat_ws", fill, F.col("_pieces")).alias("variant"))


# -- scores -----------------------------------------------------------------


def skew_score(low: Column) -> Column:
    """|positive - negative| / (positive + negative) contained words of lower-cased text."""
    def hits(words):
        return reduce(lambda a, b: a + b, [low.contains(w).cast("int") for w in words])

    counts = F.struct(hits(L.SKEW_WORDS["positive"]).alias("p"),
                      hits(L.SKEW_WORDS["negative"]).alias("n"))
    return F.transform(F.array(counts), lambda c: F.when(
        c["p"] + c["n"] > 0, F.abs(c["p"] - c["n"]) / (c["p"] + c["n"])).otherwise(0.0))[0]


def counterfactual_differences(df: DataFrame, per_text: int | None = None,
                               compared: int | None = None, texts: int | None = None,
                               text_col: str = "text", key_col: str = "doc_id",
                               pick=hash_pick, methods=tuple(_BUILDERS),
                               by: tuple = ()) -> DataFrame:
    """Per text with variants: ``by``, own score, mean score of its variants, difference.

    All texts and all variants count; ``texts`` takes the first texts in key order,
    ``per_text`` and ``compared`` the first variants.
    """
    source = df.select(*by, key_col, text_col)
    if texts is not None:
        source = source.orderBy(key_col).limit(texts)
    rows = _described_rows(source.withColumn("own_score", skew_score(F.lower(text_col))), text_col, key_col, pick, methods)
    kept = rows.select(*by, key_col, "own_score").schema.add("variant_score", "double")
    meant = rows.mapInArrow(_with_means(per_text, compared, text_col), kept)
    # Texts without variants drop out.
    return meant.where(F.col("variant_score").isNotNull()).select(
        "*", F.abs(F.col("own_score") - F.col("variant_score")).alias("difference"))


def counterfactual_analysis(differences: DataFrame, by: tuple = ()) -> DataFrame:
    """Mean difference, number and share of significant ones; one row, or one per ``by``."""
    significant = F.count_if(F.col("difference") > SIGNIFICANT)
    return differences.groupBy(*by).agg(
        F.count(F.lit(1)).alias("texts"),
        F.coalesce(F.avg("difference"), F.lit(0.0)).alias("average_bias_change"),
        significant.alias("significant_changes"))


def effectiveness(differences: DataFrame) -> DataFrame:
    """Share of differences above 0.1, 0 if there are none."""
    return differences.agg(F.coalesce(F.avg(
        F.when(F.col("difference") > SIGNIFICANT, 1.0).otherwise(0.0)), F.lit(0.0))
        .alias("effectiveness"))


# -- test sentences ---------------------------------------------------------


def template_sentences(slots: DataFrame, templates=None, adjectives=None) -> DataFrame:
    """Fill templates from a table with ``name``, ``attribute`` and ``profession``.

    Templates and adjectives are short lists exploded inside each row, so a slot table of any size is only read
    once.  A row gives over a hundred sentences and its file few splits, so rows are dealt out first.  A sentence is
    put together from the pieces of its template; only where a value or the rest of the template holds a brace, which
    may stand for another value, are the values put in one after another.
    """
    templates = templates or L.TEMPLATES
    adjectives = adjectives or ALL_ADJECTIVES
    spark = slots.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    slots = slots.repartition(parts)
    values = ["attribute", "name", "profession"]
    fills = {**{v: F.col(v) for v in values}, "adjective": F.col("adjective"),
             "characteristic": F.col("adjective"), "trait": F.col("adjective"),
             **{k: F.lit(v) for k, v in L.TEMPLATE_CONSTANTS.items()}}
    replaced = reduce(lambda s, kv: F.replace(s, F.lit("{" + kv[0] + "}"), kv[1]),
                      fills.items(), F.col("template"))

    slot = "(" + "|".join(r"\{" + k + r"\}" for k in fills) + ")"

    def joined(template: str) -> Column:
        pieces = [p for p in re.split(slot, template) if p]
        if any(("{" in p or "}" in p) and not re.fullmatch(slot, p) for p in pieces):
            return F.lit(None).cast("string")
        return F.concat(F.lit(""), *[fills[p[1:-1]] if re.fullmatch(slot, p) else F.lit(p) for p in pieces])

    wide = slots.select("*", F.explode(M.literal_array(adjectives)).alias("adjective"))
    braces = reduce(lambda a, b: a | b, [F.contains(F.col(c).cast("string"), F.lit("{")) for c in (*values, "adjective")])
    plain = ~F.coalesce(braces | F.concat(*values, "adjective").isNull(), F.lit(True))
    each = F.array(*[F.struct(F.lit(t).alias("template"), F.when(plain, joined(t)).alias("_plain")) for t in templates])
    rows = wide.select("*", F.inline(each))
    return rows.withColumn("sentence", F.when(F.col("_plain").isNotNull(), F.col("_plain")).otherwise(replaced)).select(
        *slots.columns, "template", "adjective", "sentence")


def _sentence(template: str, name: Column, profession: Column) -> Column:
    return F.replace(F.replace(F.lit(template), F.lit("{name}"), name),
                     F.lit("{profession}"), profession)


def paired_cases(names: DataFrame, professions: list[str] | None = None,
                 template: str = L.PAIRED_TEMPLATE,
                 genders: list[str] | None = None) -> DataFrame:
    """Pairs of sentences that differ in the gender of the name.

    ``names`` has ``gender``, ``ord`` (0, 1, ... within a gender) and ``name``.  Every name
    is paired with the name at the same place, modulo the list length, of each other of
    ``genders``: those are exploded in the row, and both joins are equi-joins.
    """
    professions = professions or L.PROFESSIONS
    genders = genders or list(L.GENDER_NAMES)
    sizes = names.groupBy(F.col("gender").alias("variation_gender")).agg(
        F.count(F.lit(1)).alias("_size"))
    others = F.filter(M.literal_array(genders), lambda g: g != F.col("gender"))
    wanted = names.select("*", F.explode(others).alias("variation_gender")).join(
        sizes, "variation_gender").select(
        F.col("gender").alias("original_gender"), F.col("name").alias("original_name"),
        "variation_gender", (F.col("ord") % F.col("_size")).alias("variation_ord"))
    others = names.select(F.col("gender").alias("variation_gender"),
                          F.col("ord").alias("variation_ord"), F.col("name").alias("other_name"))
    pairs = wanted.join(others, ["variation_gender", "variation_ord"])
    job = F.col("profession")
    return pairs.select("*", F.explode(M.literal_array(professions)).alias("profession")).select(
        F.lit("gender").alias("attribute_type"), "original_gender", "variation_gender",
        "profession", _sentence(template, F.col("original_name"), job).alias("original"),
        _sentence(template, F.col("other_name"), job).alias("variation"))


def intersection_cases(people: DataFrame, surnames: dict[str, list[str]] | None = None,
                       professions: list[str] | None = None,
                       template: str = L.INTERSECTION_TEMPLATE) -> DataFrame:
    """Pairs of sentences about one person that differ in the race of the surname.

    ``people`` has ``gender``, ``race``, ``ord``, ``name``; ``surnames`` lists those of each
    race.  The lists are literals, so nothing is joined or shuffled; people of a race
    without a list give no pairs.
    """
    surnames = surnames or L.ETHNIC_NAMES
    jobs = M.literal_array(professions or L.PROFESSIONS)
    lists = F.create_map(*[x for race, names in surnames.items()
                           for x in (F.lit(race), M.literal_array(names))])

    def at(values: Column) -> Column:
        return F.get(values, (F.col("ord") % F.size(values)).cast("int"))

    others = F.filter(M.literal_array(list(surnames)), lambda r: r != F.col("race"))
    varied = people.where(F.col("race").isin(list(surnames))).select(
        "*", F.explode(others).alias("variation_race"))
    job = at(jobs)
    return varied.select(
        F.lit("intersectional").alias("attribute_type"), "gender", "race", "variation_race",
        job.alias("profession"),
        _sentence(template, F.concat_ws(" ", "name", at(lists[F.col("race")])), job)
        .alias("original"),
        _sentence(template, F.concat_ws(" ", "name", at(lists[F.col("variation_race")])), job)
        .alias("variation"))
