import hashlib

import pytest
from pyspark.sql import functions as F

from evenhand.llm import fingerprints as P


def jaccard(a, b):
    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likeness_is_unbiased(spark):
    base = [f"w{k}" for k in range(400)]
    texts = [(j, " ".join(base), " ".join(base[: 400 - j] + [f"x{k}" for k in range(j)])) for j in range(0, 401, 20)]
    df = spark.createDataFrame(texts, "k long, a string, b string")
    got = df.select("k", "a", "b", P.likeness(P.codes(F.col("a")), P.codes(F.col("b"))).alias("near")).collect()
    errors = [r["near"] - jaccard(r["a"], r["b"]) for r in got]
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.12


def test_strings_and_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "one"), (4, "one"), (5, "a b c d e f"), (6, "a  b\nc d e f"), (7, "z " * 60_000)], "doc_id long, text string").selectExpr("*", "'x' AS fingerprint")
    got = [r["fingerprint"] for r in P.fingerprinted(df).collect()]
    assert got[:3] == [""] * 3 and got[3] == got[4] != got[5] == got[6] and all(len(x) == 2 * P.BINS for x in got[3:])
    again = P.fingerprinted(df).select(P.packed(P.unpacked(F.col("fingerprint"))).alias("x")).collect()
    assert [r["x"] for r in again] == got
    pairs = df.select(P.likeness(P.codes(F.col("text")), P.codes(F.lit(""))).alias("x")).collect()
    assert [r["x"] for r in pairs] == [1, 1, 1, 0, 0, 0, 0, 0]


@pytest.mark.parametrize("ids", [list(range(300)), [k * k * 1000 for k in range(150)], [None, None, 5, 5, 9], [3]])
def test_next_and_edits(spark, ids):
    rows = [(k, " ".join(f"{n}é{j}" for j in range(n % 23)) if n % 7 else None if n % 2 else "") for n, k in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS codes").repartition(3)
    got = P.against_edits(df).collect()
    assert len(got) == len(rows)
    order = df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    order = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["h"], r["text"] or "") for r in order))
    want = []
    for k, (_, _, _, t) in enumerate(order):
        h = len(t) // 2
        e = t[: len(t) - h] + order[(k + 1) % len(order)][3][:h]
        want.append((len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted((r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)


def test_empty_table_and_no_python(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.against_edits(df).collect() == []
    full = P.against_edits(spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string"))
    assert "Python" not in full._jdf.queryExecution().executedPlan().toString()
