"""SimHash near-duplicates: exact pairs of fingerprints within a few bits, in tiles.

Equal fingerprints are one from the start. Of fingerprints within `radius` bits at least one
of `radius + 1` bit fields is equal, so fingerprints meet in buckets of equal fields, and a
bucket misses no pair. A bucket is compared in tiles with numpy exclusive-or and bit counts;
rows are in order of their population counts, and pairs of tiles whose counts lie further
apart than the radius are skipped. Buckets over `bucket_rows` are dealt into parts, and each
pair of parts is a task's work. A task gives a spanning forest of the pairs it finds, not the
pairs, so that a dense group costs no more rows than it has members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import fresh, small_batches, stored
from evenhand.llm.components import components, local_components

BITS = 64
SEED = 42
TILE = 1024
SMALL = 256
AT_ONCE = 1 << 16


def fingerprint(text: str | None, n: int = 3) -> int:
    """Majority bits of the XXH64 of the text's word n-grams; fewer words are one gram, none give 0."""
    words = text.encode().lower().split() if text else []  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < n else map(b" ".join, zip(*(words[k:] for k in range(n)), strict=False))
    digest, count, ones = xxhash.xxh64_intdigest, max(1, len(words) - n + 1), np.zeros(BITS, np.int64)
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, count)
    for k in range(0, count, AT_ONCE):
        ones += np.unpackbits(hashes[k : k + AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprinted(text: Column, n: int = 3) -> Column:
    """Fingerprints as longs of the same 64 bits."""

    def each(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, n) for x in texts], np.uint64).view(np.int64))

    return F.pandas_udf(each, "long")(text)


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def near_pairs(group: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row of its group that it reaches over pairs within the radius; rows come sorted by group and population count."""
    n = len(prints)
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(starts, n))
    label = np.arange(n)
    small = np.repeat(sizes <= SMALL, sizes)
    left, right = [], []
    for shift in range(1, int(sizes[sizes <= SMALL].max(initial=0))):
        at = np.flatnonzero((group[shift:] == group[:-shift]) & small[shift:])
        at = at[np.bitwise_count(prints[at] ^ prints[at + shift]) <= radius]
        left.append(at)
        right.append(at + shift)
    if left:
        label = local_components(n, np.concatenate(left), np.concatenate(right))
    counts = np.bitwise_count(prints).astype(np.int64)
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        tiles = range(start, start + size, TILE)
        for i in tiles:
            a = slice(i, min(i + TILE, start + size))
            for j in range(i, start + size, TILE):
                b = slice(j, min(j + TILE, start + size))
                if counts[b.start] - counts[a.stop - 1] > radius:
                    break  # the following tiles' counts are higher still
                x, y = np.nonzero(np.bitwise_count(prints[a, None] ^ prints[None, b]) <= radius)
                new = label[x + i] != label[y + j]
                if new.any():
                    label = local_components(n, x[new] + i, y[new] + j, label)
    return label


def _forests(radius: int):
    def forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        rows = 0

        def links(df: pd.DataFrame) -> pd.DataFrame:
            prints = df["fp"].to_numpy(np.int64)
            label = near_pairs(df["g"].to_numpy(np.int64), prints.view(np.uint64), radius)
            far = np.flatnonzero(label != np.arange(len(label)))
            return pd.DataFrame({"a": prints[far], "b": prints[label[far]]})

        for batch in batches:
            kept.append(batch)
            rows += len(batch)
            if rows >= AT_ONCE:
                df = pd.concat(kept, ignore_index=True)
                others = np.flatnonzero(df["g"].to_numpy() != df["g"].iloc[-1])
                cut = int(others[-1]) + 1 if len(others) else 0  # the last group may go on
                if cut:
                    yield links(df.iloc[:cut])
                kept, rows = [df.iloc[cut:]], len(df) - cut
        if rows:
            yield links(pd.concat(kept, ignore_index=True))

    return forests


def near_links(prints: DataFrame, fp: str = "fp", radius: int = 3, bucket_rows: int = 16384) -> DataFrame:
    """Links a-b that connect what pairs within `radius` bits connect, of distinct fingerprints (longs)."""
    width = math.ceil(BITS / (radius + 1))
    fields = F.array(*[F.struct(F.lit(k).alias("band"), F.shiftrightunsigned(F.shiftleft(fp, max(0, BITS - (k + 1) * width)), BITS - min(width, BITS - k * width)).alias("value")) for k in range(radius + 1)])
    rows = prints.select(F.col(fp).alias("fp"), F.inline(fields))
    sizes = rows.groupBy("band", "value").count().filter(F.col("count") > bucket_rows).select("band", "value", F.ceil(F.col("count") / bucket_rows).cast("int").alias("parts"))
    rows = rows.join(sizes, ["band", "value"], "left")
    own = F.pmod(F.xxhash64("fp"), "parts").cast("int")
    pairs = F.transform(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: k != own), lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j")))
    nothing = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    dealt = rows.select("fp", "band", "value", F.inline(F.when(F.col("parts").isNull(), nothing).otherwise(pairs)))
    # a group by its hash: two groups with one hash would only add comparisons
    dealt = dealt.select("fp", F.xxhash64("band", "value", "i", "j").alias("g"), F.bit_count("fp").alias("ones"))
    return dealt.repartition("g").sortWithinPartitions("g", "ones", "fp").mapInPandas(_forests(radius), "a long, b long").distinct()


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 3, n: int = 3) -> DataFrame:
    """key, text_hash, fp, component and component_id of each row.

    component is the least fingerprint that is reachable, component_id the least key there;
    null keys don't count for it, and where all are null it is null. Null and empty texts have
    fingerprint 0, linked like any other. Repeated rows are members each; an empty table gives
    an empty one; other columns take no part.
    """
    rows = stored(small_batches(df).select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text_hash"), fingerprinted(F.col(text), n).alias("fp")))
    prints = rows.groupBy("fp").agg(F.min("key").alias("first"))
    linked = components(near_links(prints, radius=radius))
    named = stored(prints.join(linked, prints.fp == linked.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component")))
    firsts = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows.join(named.join(firsts, "component").select("fp", "component", "component_id"), "fp").select(F.col("key").alias(key), "text_hash", "fp", "component", "component_id")


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`df` with one row of each group: that of the least key, of equal keys the least text hash, of equal rows any one.

    All columns stay. Null keys come last within a group.
    """
    return first_of_groups(df, groups(df, key, text, **options), key, text)


def first_of_groups(df: DataFrame, grouped: DataFrame, key: str, text: str) -> DataFrame:
    """`df` with one row of each component; `grouped` has key, text_hash and component of each row."""
    members = stored(grouped.groupBy(key, "text_hash", "component").count())
    order = F.struct(F.col(key).isNull(), key, "text_hash")
    first = members.groupBy("component").agg(F.min(order).alias("chosen"))
    marked = members.join(first, "component").select(F.col(key).alias("_key"), F.col("text_hash").alias("_hash"), (order == F.col("chosen")).alias("stays"), "count")
    going = marked.filter("NOT stays OR count > 1").drop("stays", "count")
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.xxhash64(F.col(text)) == F.col("_hash"))
    out = df.join(going, same, "left_anti")
    repeated = marked.filter("stays AND count > 1").drop("stays", "count")
    if repeated.isEmpty():
        return out
    spot = fresh(df, "spot")
    single = df.join(repeated, same, "left_semi").withColumn(spot, F.xxhash64(F.col(text))).dropDuplicates([key, spot]).drop(spot)
    return out.unionByName(single)
