"""Removal of repeated byte strings, by suffix arrays with previous-factor arrays.

A string of `length` bytes that starts anywhere else too is repeated; every byte that such
strings cover goes (keep="none"), or only those of later copies (keep="first").

How it spreads over tasks. Each window of `length` bytes has an anchor, the place in it where
a `gram`-byte hash is lowest. Anchors depend on the window's content only, so equal windows
have equal anchors, and consecutive windows with one anchor are one segment. Segments with an
anchor that occurs once repeat nothing. Equal segments are counted before anything moves;
where all segments of an anchor are equal, that settles them. What is left are the borders of
copied passages: distinct segments with one anchor. Their bytes meet in one task, which sorts
their suffixes. The longest factor at a place that also starts earlier is the longer of its
matches with two neighbours in suffix order, the nearest ones before and behind it that start
earlier in the text: the previous and next smaller positions. Places whose longest previous
factor has `length` bytes are later copies. Anchors with more than `group` distinct segments are
settled by counting the 128-bit hashes of their windows, which spreads over all tasks. Texts
are shuffled once, by document, and read there twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import fresh, small_batches, stored

LENGTH = 200
GRAM = 64
GROUP = 4096
BUFFER = 1 << 19  # bytes of texts looked at together
PLACE = 20  # bits of a place in a buffer; longer texts are looked at piece by piece
PIECE = (1 << PLACE) - 1

_rng = np.random.default_rng(20240229)
_TABLES = _rng.integers(0, 1 << 63, (2, 256), dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    if base not in _powers or len(_powers[base][0]) <= n:
        size = max(1 << 12, 1 << int(n + 1).bit_length())
        with np.errstate(over="ignore"):
            both = [np.cumprod(np.array([1] + [b] * size, np.uint64), dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64))]
        if size > 1 << 23:
            return both[0], both[1]  # of one very long text: not kept
        _powers[base] = both[0], both[1]
    return _powers[base]


class Hashes:
    """Hashes of any stretches of a byte array; equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray, which: int = 0):
        self.back = powers(_BASES[which], len(data))[1]
        terms = _TABLES[which][data]
        terms *= powers(_BASES[which], len(data))[0][: len(data)]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, n: int) -> np.ndarray:
        return mixed((self.sums[n:] - self.sums[:-n]) * self.back[: len(self.sums) - n])


def mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return x


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest of each `width` neighbours."""
    done, low = 1, values
    while done * 2 <= width:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    return low if done == width else np.minimum(low[: len(values) - width + 1], low[width - done :])


def segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, first window and number of windows of each segment of texts that stand one after another and end at `ends`."""
    hashes = Hashes(data)
    grams = hashes.grams(gram)
    low = window_minima(grams & np.uint64(~PIECE & 0xFFFFFFFFFFFFFFFF) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    place = (low & np.uint64(PIECE)).astype(np.int64)
    valid = np.ones(len(place), bool)
    for end in ends[:-1].tolist():
        valid[max(0, end - length + 1) : end] = False
    new = np.concatenate(([True], (place[1:] != place[:-1]) | ~valid[:-1])) & valid
    first = np.flatnonzero(new)
    if not len(first):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    last = np.flatnonzero(valid & np.concatenate((new[1:] | ~valid[1:], [True])))
    return grams[place[first]].view(np.int64), hashes.of(first, last + length).view(np.int64), first, last - first + 1


def _anchored(length: int, gram: int):
    def anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def emit(parts: list[bytes], ids: list, offsets: list[int]) -> pd.DataFrame:
            ends = np.cumsum([len(p) for p in parts])
            a, h, first, n = segments(np.frombuffer(b"".join(parts), np.uint8), ends, length, gram)
            part = np.searchsorted(ends, first, "right")
            starts = first - (ends - [len(p) for p in parts])[part] + np.array(offsets, np.int64)[part]
            return pd.DataFrame({"a": a, "h": h, "d": pd.array([ids[k] for k in part.tolist()], dtype="Int64"), "at": starts << 12 | n})

        for batch in batches:
            parts, ids, offsets, size = [], [], [], 0
            for d, text in zip(batch["d"], batch["text"], strict=True):
                data = text.encode() if text else b""
                for offset in range(0, len(data) - length + 1, BUFFER):
                    parts.append(data[offset : offset + BUFFER + length - 1])
                    ids.append(None if pd.isna(d) else int(d))
                    offsets.append(offset)
                    size += len(parts[-1])
                    if size >= BUFFER - (BUFFER >> 2):
                        yield emit(parts, ids, offsets)
                        parts, ids, offsets, size = [], [], [], 0
            if parts:
                yield emit(parts, ids, offsets)

    return anchored


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value, or -1. Places jump over what is larger, all at once."""
    found = np.arange(-1, len(values) - 1)
    open_ = np.arange(1, len(values))
    while len(open_):
        open_ = open_[values[found[open_]] > values[open_]]
        found[open_] = found[found[open_]]
        open_ = open_[found[open_] >= 0]
    return found


def longest_previous_factors(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place the length of the longest string from it that also starts earlier, at most `length`, and where; 0 and -1 if there is none.

    Suffixes are put in order of their first `length` symbols, by position where these are equal,
    by doubling the prefixes that are ranked. The ranks of all prefix lengths stay, so that the match
    of two places is put together from powers of two. The last symbol must be one of its own.
    """
    n = len(symbols)
    ranks, done = [(1, np.concatenate((symbols.astype(np.uint32) + 1, np.zeros(length, np.uint32))))], 1
    order = np.argsort(symbols, kind="stable")
    while done < length:
        step, rank = min(done, length - done), ranks[-1][1]
        key = rank[:n].astype(np.uint64) << np.uint64(32) | rank[step : n + step]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.zeros(n + length, np.uint32)
        rank[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1])
        rank[:n] += 1
        done += step
        ranks.append((done, rank))
    best, source = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    for turned in (order, order[::-1]):  # previous, then next smaller positions
        near = previous_smaller(turned)
        i, j = turned[near >= 0], turned[near[near >= 0]]
        match = np.zeros(len(i), np.int64)
        for size, rank in reversed(ranks):
            fits = match + size <= length
            match[fits] += size * (rank[i[fits] + match[fits]] == rank[j[fits] + match[fits]])
        longer = match > best[i]
        best[i[longer]], source[i[longer]] = match[longer], j[longer]
    return best, source


def _factored(length: int, keep_first: bool):
    def runs(flags: np.ndarray) -> list[int]:
        return np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))).tolist()

    def settle(df: pd.DataFrame) -> pd.DataFrame:
        """One row of a segment: runs of its windows that are repeated, start and end alternating."""
        df = df.drop_duplicates(["a", "h"])  # repeated rows give a segment each
        parts = df["bytes"].tolist()
        sizes = np.array([len(p) for p in parts])
        starts = np.cumsum(sizes + 1) - sizes - 1
        # a symbol of its own behind each segment: no match reaches beyond one
        symbols = np.insert(np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32), np.cumsum(sizes), np.arange(256, 256 + len(parts)))
        factors, source = longest_previous_factors(symbols, length)
        repeated = factors >= length
        if not keep_first:
            often = np.repeat(df["n"].to_numpy() > 1, sizes + 1)
            repeated[source[repeated]] = True
            left = np.repeat(starts + sizes, sizes + 1) - np.arange(len(symbols))
            repeated |= often & (left >= length)
        return pd.DataFrame({"a": df["a"], "h": df["h"], "cover": [runs(repeated[s : s + k - length + 1]) for s, k in zip(starts.tolist(), sizes.tolist(), strict=True)]})

    def factored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            kept.append(batch)
            size += int(batch["bytes"].map(len).sum())
            if size >= BUFFER:
                df = pd.concat(kept, ignore_index=True)
                others = np.flatnonzero(df["a"].to_numpy() != df["a"].iloc[-1])
                if len(others):
                    cut = int(others[-1]) + 1  # the last anchor may go on
                    yield settle(df.iloc[:cut].reset_index(drop=True))
                    kept = [df.iloc[cut:]]
                    size = int(kept[0]["bytes"].map(len).sum())
                else:
                    kept = [df]
        if kept and size:
            yield settle(pd.concat(kept, ignore_index=True))

    return factored


def _windows(length: int):
    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 1000):
                some = batch.iloc[k : k + 1000]
                parts = some["bytes"].tolist()
                sizes = np.array([len(p) for p in parts])
                data = np.frombuffer(b"".join(parts), np.uint8)
                per = sizes - length + 1
                o = np.concatenate([np.arange(x) for x in per])
                start = np.repeat(np.cumsum(sizes) - sizes, per) + o
                one, two = Hashes(data, 0).of(start, start + length), Hashes(data, 1).of(start, start + length)
                again = lambda c: np.repeat(some[c].to_numpy(), per)
                yield pd.DataFrame({"a": again("a"), "h": again("h"), "n": again("n"), "d": pd.array(np.repeat(some["d"].array, per), dtype="Int64"), "p": again("at") // 4096 + o, "o": o, "w1": one.view(np.int64), "w2": two.view(np.int64)})

    return windows


def _flat(spans: Column, *fields: str) -> Column:
    """Fields of an array of structs as one array of longs, which tasks take as they are."""
    return F.flatten(F.transform(spans, lambda x: F.array(*[x[f].cast("long") for f in fields])))


def _pieces(text: Column, spans: Column) -> Column:
    """Bytes of the segments in `spans`, null where the text doesn't have them (another text with the same key)."""

    def pieces(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for text, spans in zip(texts, lists, strict=True):
            data = text.encode() if text else b""
            start, end, h = np.asarray(spans, np.int64).reshape(-1, 3).T
            fits = end <= len(data)
            if fits.any():
                fits[fits] = Hashes(np.frombuffer(data, np.uint8)).of(start[fits], end[fits]).view(np.int64) == h[fits]
            out.append([data[a:b] if ok else None for a, b, ok in zip(start.tolist(), end.tolist(), fits.tolist(), strict=True)])
        return pd.Series(out)

    return F.pandas_udf(pieces, "array<binary>")(text, _flat(spans, "start", "end", "h"))


def _removed(text: Column, spans: Column) -> Column:
    def removed(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans in zip(texts, lists, strict=True):
            data = text.encode() if text else b""
            runs: list[tuple[int, int]] = []
            if spans is not None and len(spans):
                array = np.frombuffer(data, np.uint8)
                start, end, h, low, high = np.asarray(spans, np.int64).reshape(-1, 5).T
                fits = end <= len(data)
                start, end, h, low, high = (x[fits] for x in (start, end, h, low, high))
                same = Hashes(array).of(start, end).view(np.int64) == h
                for a, b in sorted(zip(low[same].tolist(), high[same].tolist(), strict=True)):
                    if runs and a <= runs[-1][1]:
                        runs[-1] = runs[-1][0], max(b, runs[-1][1])
                    else:
                        runs.append((a, b))
            if runs:
                edges = [0, *(x for r in runs for x in r), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            else:
                kept = data
            out.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), text if not runs else kept.decode("utf-8", "ignore")))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return F.pandas_udf(removed, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")(text, _flat(spans, "start", "end", "h", "low", "high"))


def with_removed(df: DataFrame, out: str, key: str = "doc_id", text: str = "text", keep: str = "none", length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """`df` with a struct column `out`: n_bytes, n_removed, n_spans, kept_sha256 and kept, the text without its repeated bytes.

    Texts are UTF-8 bytes; matches stay within a text. keep="first" leaves the copy of the
    least (key, position), nulls first; repeated rows (one key and text) are then one. Null
    and empty texts have no bytes, shorter ones than `length` lose none; kept stays null for a
    null text, and drops what a cut leaves of a character. The key is an integer column; equal
    keys of different texts do no harm, as each removal is checked against the text's bytes.
    An empty table gives an empty one; all columns stay.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep is none or first, not {keep}")
    texts = small_batches(df).select(F.col(key).cast("long").alias("d"), F.col(text).alias("text"))
    found = texts.mapInPandas(_anchored(length, gram), "a long, h long, d long, at long")

    order = F.struct("d", "at")
    known = [F.count("*").alias("n"), F.min("h").alias("low"), F.max("h").alias("high")] + [F.min(order).alias("first")] * (keep == "first")
    anchors = found.groupBy("a").agg(*known).filter("n > 1").withColumn("sole", F.col("low") == F.col("high")).drop("n", "low", "high")
    # stored, as adaptive execution splits a frequent anchor only where both sides are shuffled for the join
    repeated = stored(found.join(stored(anchors), "a"))
    settled = repeated.filter("sole")
    if keep == "first":
        settled = settled.filter(~order.eqNullSafe(F.col("first")))
    start, windows = F.shiftright("at", 12), F.col("at").bitwiseAND(F.lit(4095))
    span = lambda low, high: F.struct(start.cast("int").alias("start"), (start + windows + length - 1).cast("int").alias("end"), "h", (start + low).cast("int").alias("low"), (start + high + length - 1).cast("int").alias("high"))
    whole = settled.select("d", span(F.lit(0), windows).alias("span"))

    # the distinct segments of an anchor that has several, with their bytes
    open_ = repeated.filter("NOT sole").select("a", "h", "d", "at")
    distinct = open_.groupBy("a", "h").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    wanted = distinct.select(F.xxhash64("first.d").alias("spot"), F.struct(F.shiftright("first.at", 12).alias("start"), (F.shiftright("first.at", 12) + F.col("first.at").bitwiseAND(F.lit(4095)) + length - 1).alias("end"), "a", "h", "n", "first").alias("x")).groupBy("spot").agg(F.collect_list("x").alias("spans"))
    mark, whose = fresh(df, "spot"), fresh(df, "spans")
    rows = df.withColumn(mark, F.xxhash64(F.col(key).cast("long")))
    pieces = rows.join(wanted.withColumnsRenamed({"spot": "_spot_of_spans", "spans": whose}), F.col(mark) == F.col("_spot_of_spans"))
    # always true: it asks for the columns that the result has, so that both reads are of one shuffle
    pieces = pieces.filter(F.hash(*[F.col(c) for c in df.columns]) >= -(1 << 31)).select(F.col(whose).alias("spans"), _pieces(F.col(text), F.col(whose)).alias("pieces"))
    sources = pieces.select(F.explode(F.arrays_zip("spans", "pieces")).alias("x")).select("x.spans.*", F.col("x.pieces").alias("bytes")).filter("bytes IS NOT NULL")
    sources = sources.select("a", "h", "n", F.col("first.d").alias("d"), F.col("first.at").alias("at"), "bytes")
    sizes = distinct.groupBy("a").agg(F.count("*").alias("m"))
    sources = sources.join(sizes, "a")

    schema = "a long, h long, cover array<int>"
    small = sources.filter(F.col("m") <= group).drop("m").repartition("a").sortWithinPartitions("a", F.col("d").asc_nulls_first(), "at").mapInPandas(_factored(length, keep == "first"), schema)
    large = sources.filter(F.col("m") > group).drop("m").mapInPandas(_windows(length), "a long, h long, n long, d long, p long, o int, w1 long, w2 long")
    place = F.struct("d", "p")
    met = large.groupBy("w1", "w2").agg(F.sum("n").alias("times"), F.min(place).alias("first")).filter("times > 1")
    hit = large.join(met, ["w1", "w2"])
    if keep == "first":
        hit = hit.filter(~place.eqNullSafe(F.col("first")))
    hit = hit.groupBy("a", "h").agg(F.array_sort(F.collect_set("o")).alias("o"))
    cover = small.unionByName(hit.select("a", "h", F.flatten(F.transform("o", lambda o: F.array(o, o + 1))).alias("cover")))
    if keep == "none":
        partial = open_.join(cover, ["a", "h"])
    else:
        # every occurrence goes as a whole but the first of equal segments, whose cover replaces that: a row
        # for each distinct segment meets the occurrences in an aggregate, so frequent ones need no join
        firsts = distinct.join(cover, ["a", "h"], "left").select("a", "h", "first.d", "first.at", F.coalesce("cover", F.array().cast("array<int>")).alias("cover"))
        partial = open_.withColumn("cover", F.lit(None).cast("array<int>")).unionByName(firsts).groupBy("a", "h", "d", "at").agg(F.max("cover").alias("cover"))
        partial = partial.withColumn("cover", F.coalesce("cover", F.array(F.lit(0), windows.cast("int"))))
    ends = F.when(F.size("cover") > 0, F.sequence(F.lit(0), F.size("cover") - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
    partial = partial.select("d", F.transform(ends, lambda k: span(F.get("cover", k), F.get("cover", k + 1))).alias("some"))
    whole = whole.select("d", F.array("span").alias("some"))

    spans = whole.unionByName(partial).groupBy(F.xxhash64("d").alias("_spot_of_spans")).agg(F.flatten(F.collect_list("some")).alias(whose))
    joined = rows.join(spans, F.col(mark) == F.col("_spot_of_spans"), "left")
    return joined.withColumn(out, _removed(F.col(text), F.col(whose))).drop(mark, whose, "_spot_of_spans")


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`df` with later copies of repeated strings cut out of `text`; see with_removed. All columns and rows stay."""
    out = fresh(df, "removed")
    return with_removed(df, out, key, text, **{"keep": "first"} | options).withColumn(text, F.col(out)["kept"]).drop(out)
