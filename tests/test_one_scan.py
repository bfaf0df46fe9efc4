"""Queries that need several measures of one table read it once; operators that compare or fill stay exact."""

import itertools
import re

import numpy as np
import pandas as pd
import pytest
from catalog import base as B
from conftest import plan
from pyspark.sql import functions as F

from evenhand.functions import text as T
from evenhand.operators import corpus as C
from evenhand.operators import counterfactual as X
from evenhand.operators import detection as D
from evenhand.operators import fairness as E
from evenhand.operators import lexicon_tables as LT
from evenhand.operators import preparation as P
from evenhand.operators import ranks as K
from evenhand.operators.shared import settled
from evenhand.plans.run import detect


def counting(spark, df, column):
    """``df`` whose column counts the rows that are made of it, and the counter."""
    seen = spark.sparkContext.accumulator(0)

    def look(values: pd.Series) -> pd.Series:
        seen.add(len(values))
        return values

    # Behind a generator, or a filter on the column would run the function once more.
    return settled(df.withColumn(column, F.pandas_udf(look, df.schema[column].dataType)(column))), seen


def test_kruskal_wallis_reads_once(spark):
    rows = [("abc"[n % 3], float(n % 17)) for n in range(90)]
    df, seen = counting(spark, spark.createDataFrame(rows, "g string, s double"), "s")
    assert K.kruskal_wallis(df, "g", "s", min_group_size=2).first()["n"] == 90
    assert seen.value == 90


def test_linguistic_analysis_reads_once(spark):
    texts = ["y'all ain't sure, furthermore yeah", "the framework is great and super good", None, "Ein Satz, der die Sache hat",
             "Unquestionably unquestionably bad bad bad"] * 9
    rows = [(n, t, "en" if n % 4 else None, "s" if n % 2 else None) for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, language string, source string")
    counted, seen = counting(spark, df, "text")
    parts = C.linguistic_analysis(counted, by=("source",))
    got = {tuple(r) for r in C.long_table(parts, ("source",)).withColumn("value", F.round("value", 6)).collect()}
    assert seen.value == len(rows)
    features = C.text_features(df, by=("source",))
    apart = C.linguistic_analysis(df, by=("source",), features=features)
    assert got == {tuple(r) for r in C.long_table(apart, ("source",)).withColumn("value", F.round("value", 6)).collect()}


def test_demographic_analysis_reads_once(spark):
    rows = [(f"s{n % 2}", "demographic", "gender", "abc"[n % 3], ["low", "high"][n % 2], (n % 7) / 10) for n in range(840)]
    df = spark.createDataFrame(rows, "source string, bias_type string, group_type string, group_name string, "
                                     "severity string, bias_score double")
    counted, seen = counting(spark, df, "bias_score")
    totals = spark.createDataFrame([("s0", 50), ("s1", 60)], "source string, total_samples long")
    parts = C.demographic_analysis(counted, totals, by=("source",))
    rows = C.long_table(parts, ("source",)).collect()
    assert {r["part"] for r in rows} >= {"group_comparisons", "severity_distribution", "parity_metrics", "significance"}
    assert seen.value == 840
    plain = {tuple(r) for r in C.group_comparisons(df, ("source",)).withColumn("avg_bias_score", F.round("avg_bias_score", 9))
             .drop("disparity").collect()}
    assert plain == {tuple(r) for r in parts["group_comparisons"].withColumn(
        "avg_bias_score", F.round("avg_bias_score", 9)).drop("disparity").collect()}


@pytest.mark.parametrize("continuous", [False, True])
def test_fairness_of_weighted_vectors_of_two_lengths(spark, continuous):
    rng = np.random.default_rng(3)
    rows = [(rng.normal(size=3 + n % 2).tolist(), float(rng.random() if continuous else n % 2)) for n in range(60)]
    rows += rows[:7] * 3
    want = [0, 0]
    for (a, x), (b, y) in itertools.combinations(rows, 2):
        if len(a) == len(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.3:
            want[0] += 1
            want[1] += abs(x - y) > 0.1
    df, seen = counting(spark, spark.createDataFrame(rows, "v array<double>, y double"), "y")
    got = E.individual_fairness(df, "v", "y", 0.3, block_rows=11).first()
    assert (got["similar_pairs"], got["differing_pairs"]) == tuple(want)
    assert seen.value == len(rows)
    sure = E.individual_fairness_banded(df, "v", "y", threshold=0.3, bits=2, recall=1 - 1e-12, block_rows=11).first()
    assert (sure["similar_pairs"], sure["differing_pairs"]) == tuple(want)


def test_long_lexicons_are_joined_with_texts_read_once(spark):
    df = spark.createDataFrame([(1, "The old man, the old  man; C++ old man"), (2, None), (3, "an old mane. old")],
                               "doc_id long, text string")
    terms = ["old", "old man", "old  man", "the old man", "c++", "man, the", "mane old", "old mane"]
    table = spark.createDataFrame([("l", "c", None, t, None, n) for n, t in enumerate(terms)], LT.TABLE)
    counted, seen = counting(spark, df, "text")
    got = LT.term_findings(counted, table, shard_chars=1_000_000)
    want = sorted(map(str, got.collect()))
    seen.value = 0
    wordy = LT.term_findings(counted, table.where("term <> 'c++'"), shard_chars=3)
    assert sorted(map(str, wordy.collect())) == [r for r in want if "c++" not in r]
    assert seen.value <= 6  # once for its words, once to count rows of a key; not once a shard
    twice = df.unionAll(df.where("doc_id = 3"))
    assert LT.term_findings(twice, table, shard_chars=3).where("doc_id = 3 AND term = 'old mane'").count() == 4
    assert sorted(map(str, LT.term_findings(df, table, shard_chars=3).collect())) == want


def test_a_run_searches_texts_once_for_rates_and_advice(spark):
    """The texts are read for the findings and for the linguistic measures, not once more for the advice."""
    rows = [(n, ["the man is lazy", "she is a weak nurse", None, "nothing here to be found"][n % 4], "ab"[n % 2]) for n in range(40)]
    counted, seen = counting(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "text")
    run = detect(counted, by=("source",), include_counterfactual=False, persist=False)
    advice = run.recommendations.groupBy("source").agg(F.count("rule").alias("rules"))
    got = {r["source"]: (r["total_samples"], r["rules"]) for r in run.metrics.join(advice, "source", "left").collect()}
    assert got["a"][0] == got["b"][0] == 20 and all(rules for _, rules in got.values())
    assert seen.value == 2 * len(rows)


def test_findings_by_automata_and_by_expressions_are_the_same(spark):
    texts = [*B.PHRASES, None, "", "İstanbul: ΣΑΣ the man_he, MAN", "he-man; non-binaryman"]
    df = spark.createDataFrame([(n, t, "en") for n, t in enumerate(texts)], "doc_id long, text string, language string")
    both = [{str(r) for r in D.annotate(df, by_automaton=b).collect()} for b in (False, True)]
    assert both[0] == both[1] and len(both[0]) == len(texts)


def test_counted_words_are_summed_once(spark):
    """The words of ``text_counts`` go to their ranks without another shuffle."""
    df = spark.createDataFrame([(1, "Wordy wordy wordy unquestionably \u3000 unquestionablY is", "s"), (2, None, "s"), (3, " ", None)],
                               "doc_id long, text string, source string")
    top = C.linguistic_analysis(df, by=("source",))["vocabulary_top"]
    assert plan(top).count("Exchange hashpartitioning") == 2
    assert {(r["class"], r["word"], r["count"], r["rank"]) for r in top.collect()} == {
        ("simple", "wordy", 3, 1), ("complex", "unquestionably", 2, 1)}


def test_short_texts_are_told_by_their_characters(spark):
    """Up to ten characters between any white space are short, however many bytes they have."""
    texts = ["\u3000" * 30 + "le la des" + "\x85\u2028\x1c\t", "der die und", "\u65e5" * 10, "\U0001f600" * 10, "el la los de\n", None]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, text string")
    assert [r["language"] for r in P.detect_language(df).orderBy("n").collect()] == ["en", "de", "en", "en", "es", "en"]
    kept = df.select(P.language_of(F.col("text"), short="short", default="none").alias("l"), "n").orderBy("n").collect()
    assert [r["l"] for r in kept] == ["short", "de", "short", "short", "es", "short"]
    assert set(re.findall(T.SPACE_CHAR.replace(r"\p{Z}", r"\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"),
                          "".join(map(chr, range(0x3100))))) == set(T.SPACES)


def test_template_values_with_braces_and_rows_dealt_out(spark):
    rows = [(1, "Ann", "a nation", "cook"), (2, "{adjective} Bob", "{name}", "{profession}"), (3, None, "x", "y")]
    df = spark.createDataFrame(rows, "id long, name string, attribute string, profession string").coalesce(1)
    out = X.template_sentences(df, ["{name} of {attribute} is {adjective}.", "A {profession}", "{x} {name}"], ["kind"])
    assert out.rdd.getNumPartitions() > 1
    got = {(r["id"], r["template"]): r["sentence"] for r in out.collect()}
    assert got[1, "{name} of {attribute} is {adjective}."] == "Ann of a nation is kind."
    assert got[2, "{name} of {attribute} is {adjective}."] == "kind Bob of kind Bob is kind."
    assert got[1, "{x} {name}"] == "{x} Ann" and len(got) == 9
    assert all(got[3, t] is None for t in ("{name} of {attribute} is {adjective}.", "A {profession}"))
