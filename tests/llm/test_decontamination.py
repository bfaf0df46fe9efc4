import random
import re

import pytest

from evenhand.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, n=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        size = min(n, len(b))
        for k in range(len(b) - size + 1 if b else 0):
            for i in range(len(w) - size + 1):
                if w[i : i + size] == b[k : k + size]:
                    hit.update(range(i, i + size))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.fixture(scope="module")
def data():
    r = random.Random(5)
    text = lambda n: " ".join(r.choice(["ab", "Cd", "é1", "Zz", "q"]) for _ in range(n))
    items = [(k, text(r.choice([3, 9, 10, 12, 30]))) for k in range(12)] + [(98, None), (99, "!!"), (100, "ab, cd"), (7, "zz Zz zz q")]
    docs = [(k, text(r.randint(0, 60)) + "; " + r.choice(items)[1] if k % 2 and r.choice(items)[1] else text(40)) for k in range(60) if True]
    return [*docs, (200, None), (201, ""), (None, items[0][1]), (1, docs[1][1])], items


@pytest.mark.parametrize("block_words", [2_000_000, 40])  # 40: several passes
def test_equals_brute_force(spark, data, block_words):
    docs, items = data
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS words", "2 AS hits")
    found = D.contamination(df, spark.createDataFrame(items, "item_id long, text string"), block_words=block_words).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in found)
    assert got == sorted((str(k), *brute(t, items)) for k, t in docs)


def test_removal(spark):
    passage = "One two three four five six seven eight nine TEN eleven"
    items = spark.createDataFrame([(1, passage.lower() + " twelve")], "item_id long, text string")
    df = spark.createDataFrame([(1, f"Before, {passage}! After.", "x"), (2, "clean one two three", "y"), (3, None, "z")], "doc_id long, text string, hits string")
    assert sorted(r["doc_id"] for r in D.decontaminate(df, items).collect()) == [2, 3]
    cut = {r["doc_id"]: r["text"] for r in D.decontaminate(df, items, remove="spans").collect()}
    assert cut == {1: "Before, ! After.", 2: "clean one two three", 3: None}
    assert D.decontaminate(df, items).columns == df.columns
    with pytest.raises(ValueError):
        D.decontaminate(df, items, remove="all")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [tuple(r)[:4] for r in D.contamination(df, none).collect()] == [(1, 2, 0, [])]
    assert D.contamination(df.filter("false"), none).collect() == []


def test_items_without_an_id(spark):
    items = spark.createDataFrame([(None, "leaked words of a test"), (1, "named item"), (None, None)], "item_id long, text string")
    df = spark.createDataFrame([(1, "x Leaked words of a test y"), (2, "clean"), (3, "a named item, leaked words of a test")], "doc_id long, text string")
    assert [r["doc_id"] for r in D.decontaminate(df, items).collect()] == [2]
    for block_words in (2_000_000, 2):
        found = {r["doc_id"]: (r["n_hit"], r["items"]) for r in D.contamination(df, items, block_words=block_words).collect()}
        assert found == {1: (5, []), 2: (0, []), 3: (7, ["1"])}


def test_sql_counts_items_without_an_id(spark, tmp_path):
    import duckdb

    from evenhand.llm import queries

    spark.createDataFrame([(None, "leaked words of a test"), (1, "named item"), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, "x Leaked words of a test y"), (2, "clean"), (3, "a named item, leaked words of a test"), (4, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for name in ("benchmark", "documents"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = queries.op6_benchmark_decontamination(spark, str(tmp_path))
    want = con.sql(queries.SQL["op6_benchmark_decontamination"]).project(", ".join(found.columns)).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_blocks_are_sized_by_words_and_freed(spark):
    """Items without white space are as many words as they are; each pass reads stored hits, with one worker."""
    items = spark.createDataFrame([(k, ",".join(f"w{k}x{j}" for j in range(20))) for k in range(10)], "item_id long, text string")
    df = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(10)], "doc_id long, text string")
    found = D.contamination(df, items, block_words=50)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {r["doc_id"]: (r["n_hit"], r["items"]) for r in found.collect()} == {k: (20, [str(k)]) for k in range(10)}
