import random

import numpy as np
import pytest

from evenhand.llm import simhash
from evenhand.llm.components import components


def brute(prints, radius=3):
    prints = list(prints)
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize("bucket_rows", [16384, 20])  # 20: most buckets are dealt into parts
def test_links_equal_brute_force(spark, bucket_rows):
    r = random.Random(bucket_rows)
    prints = {signed(r.getrandbits(64)) for _ in range(300)} | {0, -1, 1, 7, 15, 255}
    for p in list(prints)[:60]:
        q = p & (2**64 - 1)
        for _ in range(r.randint(1, 8)):
            q ^= 1 << r.randrange(64)
            prints.add(signed(q))
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {r["node"]: r["component"] for r in components(simhash.near_links(df, bucket_rows=bucket_rows)).collect()}
    assert {p: found.get(p, p) for p in prints} == brute(prints)


def test_near_pairs_in_tiles():
    r = np.random.default_rng(2)
    prints = np.unique(r.integers(0, 2**63, 4000, dtype=np.uint64) & np.uint64(0x3FFF))
    prints = prints[np.argsort(np.bitwise_count(prints), kind="stable")]
    label = simhash.near_pairs(np.zeros(len(prints), np.int64), prints, 1)
    want = brute(prints.tolist(), 1)
    same = {}
    assert all(same.setdefault(want[int(p)], int(k)) == int(k) for p, k in zip(prints, label, strict=True))


def test_fingerprint():
    import xxhash

    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("Two\tWORDS") == xxhash.xxh64_intdigest("two words", 42) == simhash.fingerprint("two words")
    assert simhash.fingerprint("É x") == xxhash.xxh64_intdigest("É x", 42)  # only A-Z is lowered
    h = [xxhash.xxh64_intdigest(x, 42) for x in ("a b c", "b c d")]
    assert simhash.fingerprint("a b c d") == h[0] & h[1]


def test_groups_and_dedup(spark):
    text = " ".join(f"w{k}" for k in range(3000))
    rows = [(5, text), (3, text + " end"), (9, text), (9, text), (1, "other words here"), (None, "other words here"), (7, None), (8, ""), (None, None), (2, "x y z"), (2, "x y z"), (2, "p q r s")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS fp", "'d' AS component", "'e' AS spot", "'f' AS key")
    got = {(r["doc_id"], r["text_hash"]): r["component_id"] for r in simhash.groups(df).collect()}
    assert sorted(map(str, got.values())) == ["1", "1", "2", "2", "3", "3", "3", "7", "7", "7"]
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], (r["text"] or "")[:3]) for r in kept.collect()) == [(1, "oth"), (2, "p q"), (2, "x y"), (3, "w0 "), (7, "")]
    assert simhash.deduplicated(df.filter("false")).collect() == []


def test_long_chain_of_links(spark):
    df = spark.range(1, 200).selectExpr("id AS a", "id - 1 AS b")
    extra = spark.createDataFrame([(500, 501), (501, 501), (None, 3), (501, 500)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(df.union(extra)).collect()}
    assert found == {k: 0 for k in range(200)} | {500: 500, 501: 500}
