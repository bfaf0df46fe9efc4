"""Runs of repeated words: maximal stretches with a period, found on sparse diagonals.

A diagonal is a lag: its match length at word i is the number of words up to i that each equal
the word `lag` before, one more than at word i - 1 where word i has an earlier occurrence at
that lag, else 0. A diagonal whose match length reaches the lag when it ends gives a stretch of
at least two periods, a run if the lag is the stretch's smallest period.

Taken literally, that steps through every earlier occurrence of every word, the square of the
text's length where one word is repeated. So diagonals stay sparse in three ways, none of
which loses a run:

* Lags are taken in classes [g, 2g) for g = 12, 24, ... and one class below 12. A run needs a match
  length of at least g on a lag of the class (6 in the lowest, as short runs must have 12 words),
  so only occurrences of words that agree in the g - 1 words behind them too can matter. If no
  g words are repeated, longer ones aren't, and the pass ends: after the first class in usual prose.
* Within a class an earlier occurrence opens a diagonal only where the words before the two differ.
  Elsewhere it would continue one. Such openings are maximal repeats whose distance is at most
  twice their length, and a text of n words has at most a constant times n of them.
* An open diagonal is followed to its end only if g words that end its first period match as well.
  Of diagonals that pass, the smallest period of a stretch is emitted first, and larger ones with
  the same start that it divides are dropped.

Memory is a few numbers a word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import small_batches

LEAST = 12  # words of the shortest run
FOUND = "n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers from 0, equal where both a and b are."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1].astype(np.int64)


def openings(ids: np.ndarray, before: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places j < i with equal ids, a lag i - j in [low, high) and different `before`; place 0 opens with any.

    Places with one id, in order, fall into blocks of equal `before`; a place looks into earlier
    blocks that differ from its own, one block further at a time, until they are too far.
    """
    order = np.argsort(ids, kind="stable")
    group, words = ids[order], before[order]
    new = np.ones(len(order), bool)
    new[1:] = (group[1:] != group[:-1]) | (words[1:] != words[:-1])
    block = np.cumsum(new) - 1
    firsts = np.flatnonzero(new)
    of_block, word_of_block = group[firsts], words[firsts]
    last_of_block = order[np.append(firsts[1:], len(order)) - 1]
    span = len(ids) + 1
    key = block * span + order  # ascending: by block, then by place
    at = np.arange(len(order))
    lefts, rights = [], []
    step = 0
    while len(at):
        step += 1
        other = block[at] - step
        at, other = at[other >= 0], other[other >= 0]
        near = (of_block[other] == group[at]) & (last_of_block[other] > order[at] - high)
        at, other = at[near], other[near]
        differ = word_of_block[other] != words[at]
        i, b = order[at[differ]], other[differ]
        start = np.searchsorted(key, b * span + np.maximum(i - high + 1, 0))
        stop = np.searchsorted(key, b * span + np.maximum(i - low + 1, 0))
        counts = np.maximum(stop - start, 0)
        total = int(counts.sum())
        if total:
            offset = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
            lefts.append(order[np.repeat(start, counts) + offset])
            rights.append(np.repeat(i, counts))
    if not lefts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(lefts), np.concatenate(rights)


def match_length(words: np.ndarray, i: int, lag: int) -> int:
    """How many words from place i on equal the word `lag` before."""
    n, done, size = len(words), 0, 64
    while i + done < n:
        a = i + done
        b = min(n, a + size)
        differ = words[a:b] != words[a - lag : b - lag]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, size = done + b - a, 4 * size
    return done


def runs(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of numbered words, by start, then period.

    A run is a stretch that no neighbour extends, with that smallest period, of at least
    `least` words and two periods.
    """
    n, found = len(words), {}
    ids, width, low, g = words.astype(np.int64), 1, 1, max(1, (least + 1) // 2)
    while 2 * low <= n and g <= n:
        while width < g:  # numbers of the g words from each place on
            step = min(width, g - width)
            ids, width = paired(ids[:-step], ids[step:]), width + step
        order = np.sort(ids)
        if not (order[1:] == order[:-1]).any():
            break  # what isn't repeated at this length isn't at a larger one
        high = 2 * g
        before = np.concatenate(([-1], words[: len(ids) - 1])).astype(np.int64)
        j, i = openings(ids, before, low, high)
        lag = i - j
        rest = np.maximum(least - lag, lag) - g  # what the match length needs beyond the first g words
        far = np.maximum(rest, 0)
        passes = (rest <= 0) | (i + far < len(ids))
        passes[passes] = ids[np.minimum(i + far, len(ids) - 1)[passes]] == ids[np.minimum(j + far, len(ids) - 1)[passes]]
        lag, j, i = lag[passes], j[passes], i[passes]
        for k in np.argsort(lag, kind="stable").tolist():
            start, period = int(j[k]), int(lag[k])
            earlier = found.setdefault(start, [])
            if any(period % q == 0 and length >= 2 * period for length, q in earlier):
                continue
            length = period + match_length(words, int(i[k]), period)
            if length >= max(least, 2 * period):
                earlier.append((length, period))
        low, g = high, high
    return sorted((s, length, q) for s, rows in found.items() for length, q in rows)


def number(parts: list[bytes]) -> np.ndarray:
    """Words by number, equal words alike."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in parts), np.int64, len(parts))


def collapsed(parts: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run has after its first period, joined by one space."""
    if not found:
        return b" ".join(parts)
    depth = np.zeros(len(parts) + 1, np.int64)
    for start, length, period in found:
        depth[start + period] += 1
        depth[start + length] -= 1
    gone = np.cumsum(depth[:-1]) > 0
    return b" ".join(w for w, x in zip(parts, gone.tolist(), strict=True) if not x)


def with_runs(df: DataFrame, text: str = "text", out: str = "runs", least: int = LEAST) -> DataFrame:
    """`df` with a struct column `out`: n_words, starts, lengths and periods of all runs, and collapsed, the text without repeats.

    Words are what ASCII white space separates. Row by row, without a shuffle; whole texts,
    of any length. Null and empty texts have no words, no runs and an empty collapsed text; repeated
    rows get equal results; an empty table gives an empty one. A column named `out` is replaced.
    """

    def each(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            parts = value.encode().split() if value else []  # on bytes: ASCII white space only
            found = runs(number(parts), least)
            start, length, period = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            rows.append((len(parts), start, length, period, collapsed(parts, found).decode()))
        return pd.DataFrame(rows, columns=["n_words", "starts", "lengths", "periods", "collapsed"])

    return small_batches(df).withColumn(out, F.pandas_udf(each, FOUND)(F.col(text)))


def longest(found: Column) -> Column:
    """start, length and period of the longest run of a struct of `with_runs`, of equal ones the first, then that of the smaller period; null without runs."""
    spans = F.zip_with(found["starts"], found["lengths"], lambda s, n: F.struct((-n).alias("minus"), s.alias("start"), n.alias("length")))
    return F.array_min(F.zip_with(spans, found["periods"], lambda x, p: F.struct(x["minus"].alias("minus"), x["start"].alias("start"), x["length"].alias("length"), p.alias("period"))))


def listed(found: Column) -> Column:
    """The runs as lines `start,length,period`, each with its line feed."""
    lines = F.zip_with(F.zip_with(found["starts"], found["lengths"], lambda s, n: F.concat(s.cast("string"), F.lit(","), n.cast("string"))), found["periods"], lambda x, p: F.concat(x, F.lit(","), p.cast("string"), F.lit("\n")))
    return F.array_join(lines, "")
