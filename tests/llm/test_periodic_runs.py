import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenhand.llm import periodic_runs as R
from evenhand.llm.queries import with_period


def plain_runs(w, least=12):
    """Every lag, every diagonal, every smaller period."""
    n, out = len(w), []
    for p in range(1, n // 2 + 1):
        i = p
        while i < n:
            if w[i] != w[i - p]:
                i += 1
                continue
            s = i - p
            while i < n and w[i] == w[i - p]:
                i += 1
            if i - s >= max(least, 2 * p) and not any(all(w[k] == w[k - q] for k in range(s + q, i)) for q in range(1, p)):
                out.append((s, i - s, p))
    return sorted(out)


def plain_collapsed(words, found):
    gone = {k for s, n, p in found for k in range(s + p, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def texts(kind, rng):
    n, k = rng.randrange(80), rng.choice([1, 2, 2, 3, 4])
    if kind == "random":
        return [rng.randrange(k) for _ in range(n)]
    if kind == "powers":
        w = []
        while len(w) < n:
            w += [rng.randrange(k) for _ in range(rng.randint(1, 12))] * rng.randint(1, 6)
        return w
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    w = b[:n]
    for _ in range(rng.randrange(3)):
        if w:
            w[rng.randrange(len(w))] = rng.randrange(3)
    return w


@pytest.mark.parametrize("kind", ["random", "powers", "fibonacci"])
@pytest.mark.parametrize("least", [12, 1, 4, 7])
def test_against_every_diagonal(kind, least):
    rng = random.Random(f"{kind}{least}")
    for _ in range(150):
        w = texts(kind, rng)
        found = R.runs(np.array(w, np.int64), least)
        assert found == plain_runs(w, least), w
        words = [b"w%d" % x for x in w]
        assert R.collapsed(words, found) == plain_collapsed(words, found)


def test_openings_against_all_pairs():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 40)
        ids, before = ([rng.randrange(2) for _ in range(n)] for _ in range(2))
        before[0] = -1
        low = rng.randint(1, 5)
        j, i = R.openings(np.array(ids), np.array(before), low, 2 * low)
        want = [(a, b) for b in range(n) for a in range(b) if ids[a] == ids[b] and before[a] != before[b] and low <= b - a < 2 * low]
        assert sorted(zip(j.tolist(), i.tolist(), strict=True)) == sorted(want)


def test_long_texts_stay_linear():
    """One word, long blocks of one, and short periods: the square of their length would take hours."""
    start = time.time()
    assert R.runs(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]
    blocks = np.tile(np.array([0] * 25_000 + [1]), 20)
    found = R.runs(blocks)
    assert len(found) == 21 and (0, len(blocks), 25_001) in found
    assert R.runs(np.tile(np.arange(10), 50_000)) == [(0, 500_000, 10)]
    assert time.time() - start < 60


def test_rows(spark):
    line = "one two three four five six "
    rows = [(None, None, 1), (1, "", 1), (2, " \t\n\x0b\x0c\r ", 1), (3, line * 5, 1), (3, line * 5, 1), (4, "a\u00a0b " * 12, 1), (5, "x " * 11, 1), (6, "x " * 200_000, 1), (7, line + "seven " * 12 + line * 2, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, starts int")
    got = R.with_runs(df, out="RUNS")
    assert got.columns == ["doc_id", "text", "starts", "RUNS"]
    for r in got.withColumn("best", R.longest(F.col("RUNS"))).withColumn("lines", R.listed(F.col("RUNS"))).collect():
        words = (r["text"] or "").encode().split()
        found = plain_runs(words) if len(words) < 1000 else [(0, len(words), 1)]
        assert list(zip(r["RUNS"]["starts"], r["RUNS"]["lengths"], r["RUNS"]["periods"], strict=True)) == found and r["RUNS"]["n_words"] == len(words)
        assert r["RUNS"]["collapsed"].encode() == plain_collapsed(words, found)
        assert r["lines"] == "".join(f"{s},{n},{p}\n" for s, n, p in found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r["best"] and (r["best"]["start"], r["best"]["length"], r["best"]["period"])) == best
    assert R.with_runs(df.filter("false")).collect() == []


def test_query_makes_a_tenth_periodic(spark):
    rows = [(None, "a b c"), (3, None), (11, "")] + [(k, " ".join(f"w{j % 17}" for j in range(k % 40))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in with_period(df).collect()), key=str)
    want = []
    for key, text in rows:
        h = None if key is None else zlib.crc32(str(key).encode())
        words = (text or "").split()
        if h is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[a + (i - a) % p] if i >= a else words[i] for i in range(n))
        want.append((key, text))
    assert got == sorted(want, key=str) and got != sorted(rows, key=str)
