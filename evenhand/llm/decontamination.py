"""Benchmark decontamination: word windows of test items, looked up in training texts.

Words are runs of letters and digits (everything from U+0080 on counts as a letter), A-Z in
lower case. The windows of all items form a hash set that is broadcast; a task numbers the
words of a text by the items' vocabulary, hashes every window of them with numpy, looks the
hashes up and verifies each hit word by word. Texts move nowhere: there is no shuffle.

The broadcast is bounded: items are dealt into blocks of about `block_words` words. Texts pass one
block after the other; the hits so far are stored and a block's broadcast is freed before the
next one is made, so that one block is in memory at a time.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import fresh, small_batches, stored

# The word pattern of the contract; the multiplier is any large odd number.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

FOUND = "n_words long, n_hit long, items array<string>, words array<int>, chars array<int>"
_word = re.compile(WORD)


def words_of(text: str | None) -> list[str]:
    return _word.findall(text.translate(UPPER)) if text else []


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of each window of n numbers."""
    out = np.zeros(len(ids) - n + 1, np.uint64)
    for k in range(n):
        out *= MULTIPLIER
        out += ids[k : len(ids) - n + 1 + k]
    return out ^ (out >> np.uint64(29))


@dataclass
class Windows:
    """The windows of a block of items: for each length sorted hashes, and for each hash the windows and their items."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    by_length: dict[int, tuple[np.ndarray, list[dict[bytes, list[str]]]]] = field(default_factory=dict)

    @classmethod
    def of(cls, items: list[tuple[str | None, list[str]]], n: int) -> Windows:
        made = cls()
        gathered: dict[int, dict[int, dict[bytes, set[str]]]] = {}
        for item, words in items:
            if not words:
                continue
            ids = np.array([made.vocabulary.setdefault(w, len(made.vocabulary) + 1) for w in words], np.uint64)
            length = min(n, len(words))
            for k, h in enumerate(window_hashes(ids, length).tolist()):
                named = gathered.setdefault(length, {}).setdefault(h, {}).setdefault(ids[k : k + length].tobytes(), set())
                if item is not None:
                    named.add(item)
        for length, hashes in gathered.items():
            order = sorted(hashes)
            made.by_length[length] = np.array(order, np.uint64), [{w: sorted(x) for w, x in hashes[h].items()} for h in order]
        return made

    def find(self, words: list[str]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in a window, and the items of those windows."""
        hit, items = np.zeros(len(words), bool), set()
        ids = np.fromiter(map(self.vocabulary.get, words, (0,) * len(words)), np.uint64, len(words)) if words else np.zeros(0, np.uint64)
        for length, (hashes, windows) in self.by_length.items():
            if len(ids) < length:
                continue
            known = window_hashes(ids, length)
            at = np.minimum(np.searchsorted(hashes, known), len(hashes) - 1)
            for k in np.flatnonzero(hashes[at] == known).tolist():
                if (found := windows[at[k]].get(ids[k : k + length].tobytes())) is not None:
                    hit[k : k + length] = True
                    items.update(found)
        return hit, items


def runs(hit: np.ndarray) -> np.ndarray:
    """Starts and ends (exclusive) of the runs of true values, alternating."""
    return np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))


def _search(block, n: int):
    def search(texts: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        windows, out = block.value, []
        for text, old_words, old_items in zip(texts, before["words"], before["items"], strict=True):
            words = words_of(text)
            hit, items = windows.find(words)
            if old_words is not None:
                for a, b in zip(old_words[::2], old_words[1::2], strict=True):
                    hit[a:b] = True
            if old_items is not None:
                items.update(old_items)
            spans, chars = runs(hit).tolist(), []
            if spans:
                places = [m.span() for m in _word.finditer(text.translate(UPPER))]
                chars = [places[x - k % 2][k % 2] for k, x in enumerate(spans)]
            out.append((len(words), int(hit.sum()), sorted(items), spans, chars))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "items", "words", "chars"])

    return F.pandas_udf(search, FOUND)


def with_hits(df: DataFrame, benchmark: DataFrame, out: str, text: str = "text", item: str = "item_id", item_text: str = "text", n: int = 10, block_words: int = 2_000_000) -> DataFrame:
    """`df` with a struct column `out`: n_words, n_hit, items (ids as sorted strings), words and chars (runs of hit words as word and character offsets, start and end alternating).

    An item of fewer than n words, but not none, is one window. Null and empty texts have no
    words and no hits; items with null text have no windows, those of items with a null id count for
    all but the ids; equal items all count; with an empty benchmark nothing is hit. Repeated rows
    each get their own result. block_words bounds the words of items broadcast at a time.
    """
    df = small_batches(df)
    context = df.sparkSession.sparkContext
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text")).filter("text IS NOT NULL")
    total = items.agg(F.sum(F.regexp_count(F.translate("text", "".join(map(chr, UPPER)), "".join(map(chr, UPPER.values()))), F.lit(WORD)).cast("long"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block_words))
    before = F.lit(None).cast(f"struct<{', '.join(x.replace(' ', ':', 1) for x in FOUND.split(', '))}>")
    for k in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k).collect()
        block = context.broadcast(Windows.of([(r["item"], words_of(r["text"])) for r in rows], n))
        df = df.withColumn(out, _search(block, n)(F.col(text), before))
        before = F.col(out)
        if k < n_blocks - 1:
            df = stored(df)
            block.destroy()
    return df


def contamination(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """key, n_words, n_hit, items, words and chars of each row of `df`; see with_hits."""
    hits = with_hits(df.select(F.col(key).alias("key"), F.col(text).alias("text")), benchmark, "hits", **options)
    return hits.select(F.col("key").alias(key), "hits.*")


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", remove: str = "documents", **options) -> DataFrame:
    """`df` without contaminated rows (remove="documents") or with the hit words cut out of `text` ("spans").

    A cut runs from the first to the last character of a run of hit words; what stands before
    and after is joined as it is. All columns stay. See with_hits for nulls and ties.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove}")
    hits = fresh(df, "hits")
    found = with_hits(df, benchmark, hits, text, **options)
    if remove == "documents":
        return found.filter(F.col(hits)["n_hit"] == 0).drop(hits)

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([x if x is None or s is None or not len(s) else "".join(x[a:b] for a, b in zip([0, *s[1::2]], [*s[::2], len(x)], strict=True)) for x, s in zip(texts, spans, strict=True)], dtype=object)

    return found.withColumn(text, F.pandas_udf(cut, "string")(F.col(text), F.col(hits)["chars"])).drop(hits)
