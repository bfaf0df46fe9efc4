"""Lexicons as tables: the same findings as the lists give, and lists of any length."""

import random
import re

from pyspark.sql import functions as F

from evenhand.functions import automaton as A
from evenhand.functions import matching as M
from evenhand.lexicons import DEFAULT_LEXICONS, Lexicons
from evenhand.operators import detection as D
from evenhand.operators import lexicon_tables as LT

CHECKS = ("demographic", "gender", "racial", "religious", "linguistic")


def findings(df, lexicons):
    rows = D.detect_findings(df, CHECKS, lexicons, language_col=None).collect()
    return sorted(str(r.asDict(True)) for r in rows)


def test_same_findings_as_the_lists(spark, texts):
    from catalog.base import PHRASES

    df = texts(*PHRASES, *[a + " " + b for a, b in zip(PHRASES, PHRASES[3:], strict=False)], "", None)
    want = findings(df, DEFAULT_LEXICONS)
    table = LT.lexicon_table(spark)
    assert findings(df, LT.TableLexicons(table)) == want and len(want) > 100
    assert findings(df, LT.TableLexicons(table.repartition(7), shard_chars=900)) == want  # several shards


def test_own_lists_and_nulls(spark, texts):
    own = Lexicons(racial_terms=["zorg", "b c"], dialect_markers={"odd": ["zzz", "yyy"]}, inclusive_terms={"en": {"chairman": "chair"}})
    df = texts("a zorg is stupid; b c zzz yyy that is wrong", "chairman b  c", None, "")
    table = LT.lexicon_table(spark, own)
    odd = spark.createDataFrame([("racial_terms", None, None, None, None, 9999), ("racial_terms", None, None, "", None, 9998)], LT.TABLE)
    assert findings(df, LT.TableLexicons(table.unionAll(odd), own)) == findings(df, own) != []
    assert findings(df, LT.TableLexicons(table.limit(0), own)) == []
    assert LT.term_findings(df.limit(0), table).collect() == []


def test_two_hundred_thousand_terms(spark, texts):
    r = random.Random(1)
    terms = sorted({"".join(r.choices("abcdefghij ", k=r.randint(4, 12))).strip() for _ in range(200_000)} - {""})
    words = [" ".join("".join(r.choices("abcdefghij", k=r.randint(1, 8))) for _ in range(400)) for _ in range(20)]
    df = texts(*words)
    table = spark.createDataFrame([("l", None, None, t, None, n) for n, t in enumerate(terms)], LT.TABLE)
    known = set(terms)
    for shard_chars in (LT.SHARD_CHARS, 500_000):
        got = {(x["doc_id"], x["term"]) for x in LT.term_findings(df, table, shard_chars=shard_chars).collect()}
        want = set()
        for n, text in enumerate(words):
            starts = [m.start() for m in re.finditer(r"\b\w", text)]
            ends = [m.end() for m in re.finditer(r"\w\b", text)]
            want |= {(n, text[a:b]) for a in starts for b in ends if 0 < b - a <= 12 and text[a:b] in known}
        assert got == want and len(got) > 50
    column = df.select("doc_id", M.word_terms(F.col("text"), terms).alias("t"))
    assert {(x["doc_id"], t) for x in column.collect() for t in x["t"]} == want


def test_automaton_equals_the_expression(spark, texts):
    r = random.Random(2)
    terms = sorted({"".join(r.choices("abé_1 -", k=r.randint(1, 4))) for _ in range(60)})
    values = ["".join(r.choices("abé_1 -½", k=r.randint(0, 30))) for _ in range(300)] + [None]
    df = texts(*values)
    for whole, expression in ((False, M.contained_terms), (True, M.word_terms)):
        rows = df.select(expression(F.col("text"), terms).alias("a"), A.automaton_terms(spark, F.col("text"), terms, whole).alias("b")).collect()
        assert all(sorted(x["a"] or []) == x["b"] for x in rows)
    assert A.build([]) is None and A.occurring(None, [], "a") == {}


def test_one_shard_is_a_projection(spark, texts):
    plan = D.annotate(texts("a b"), None, LT.TableLexicons(LT.lexicon_table(spark)), language_col=None)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_word_mentions_of_odd_input(spark, texts):
    lexicon = spark.createDataFrame([("one",), ("two",), (None,), ("one two",)], "term string")
    got = D.word_mentions(texts("One two one", None, "", "three"), lexicon).collect()
    assert sorted((x["doc_id"], x["term"]) for x in got) == [(0, "one"), (0, "two")]
    assert D.word_mentions(texts("one").limit(0), lexicon).collect() == []
