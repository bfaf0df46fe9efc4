import math
import random

import pytest
from pyspark.sql import functions as F

from evenhand.functions.tails import chi_square_tail, rank_sum_p
from evenhand.operators import corpus as C
from evenhand.operators import detection as D
from evenhand.operators import fairness as E
from evenhand.operators import quality as Q
from evenhand.operators import ranks as K
from evenhand.operators import report as R


@pytest.fixture
def findings(spark):
    return spark.createDataFrame([
        (0, "demographic", "gender", "male", "medium", 0.3),
        (1, "demographic", "gender", "female", "high", 0.7),
        (2, "demographic", "age", "old", "low", 0.2),
        (2, "racial", None, None, "critical", 0.9),
    ], "doc_id long, bias_type string, group_type string, group_name string, "
       "severity string, bias_score double")


def test_group_comparisons(findings, spark):
    rows = {r["group_name"]: r for r in C.group_comparisons(findings).collect()}
    assert rows["male"]["disparity"] == pytest.approx(0.4)
    assert rows["female"]["disparity"] == pytest.approx(0.4)
    assert rows["old"]["disparity"] is None
    comparisons = C.group_comparisons(findings)
    assert C.disparate_impact(comparisons).first()[0] == pytest.approx(0.4)
    worst = C.worst_disparity(comparisons).first()
    assert worst["group_name"] == "female"
    totals = spark.range(10).agg(F.count(F.lit(1)).alias("total_samples"))
    parity = C.parity_metrics(comparisons, totals).collect()
    assert [(p["group_type"], p["parity_violation"], p["equalized_odds"]) for p in parity] == [
        ("gender", 0.0, 0.0)]


def test_run_metrics_both_ways(findings, spark, texts):
    totals = spark.range(10).agg(F.count(F.lit(1)).alias("total_samples"))
    row = C.run_metrics_from_findings(findings, totals).first()
    assert (row["finding_count"], row["biased_samples"]) == (4, 3)
    assert row["biased_sample_rate"] == pytest.approx(0.3)
    assert row["overall_bias_score"] == pytest.approx(0.525)
    annotated = D.annotate(texts("the man is lazy", "fine", "black and lazy"))
    direct = C.run_metrics(annotated).first()
    stored = C.run_metrics_from_findings(
        D.explode_findings(annotated), C.total_samples(annotated)).first()
    assert direct.asDict() == pytest.approx(stored.asDict())


def test_empty_run(spark, texts):
    annotated = D.annotate(texts("a").limit(0))
    row = C.run_metrics(annotated).first()
    assert row["total_samples"] == 0 and row["overall_bias_score"] == 0.0


def test_recommendations(findings, spark):
    totals = spark.range(10).agg(F.count(F.lit(1)).alias("total_samples"))
    metrics = C.run_metrics_from_findings(findings, totals)
    rules = [r["rule"] for r in C.recommendations(metrics).collect()]
    assert rules == [1, 3, 5]
    assert any("CRITICAL" in r["recommendation"]
               for r in C.recommendations(metrics).collect())


def test_metrics_do_not_depend_on_partitions(texts):
    df = texts(*["the man is lazy", "women cannot", "fine"] * 20)
    one = C.run_metrics(D.annotate(df.coalesce(1))).first()
    many = C.run_metrics(D.annotate(df.repartition(7))).first()
    assert one.asDict() == pytest.approx(many.asDict())


def test_known_tails():
    assert chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert chi_square_tail(5.991464547107979, 2) == pytest.approx(0.05)
    assert chi_square_tail(7.814727903251179, 3) == pytest.approx(0.05)
    assert chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05)
    # 3 against 3 without overlap: 2 of the 20 orderings are as extreme.
    assert rank_sum_p(3, 3, 9, 0, "exact") == pytest.approx(0.1)
    assert rank_sum_p(8, 2500, 9000, 0) == pytest.approx(rank_sum_p(8, 2501, 9002, 0), rel=0.05)
    # many groups: a tail in logarithms doesn't vanish
    assert chi_square_tail(1600, 1600) == pytest.approx(0.4953, abs=1e-3)
    assert chi_square_tail(1400, 1400) == pytest.approx(0.4950, abs=1e-3)
    assert chi_square_tail(3000, 10) == 0.0
    assert rank_sum_p(1, 30, 0, 0) == 1.0


def ranks_by_hand(values):
    order = sorted(values)
    return [order.index(v) + (order.count(v) + 1) / 2 for v in values]


def test_rank_sums_match_sorting(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), round(rng.random(), 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, s double").repartition(5)
    got = {r["g"]: (r["n"], r["rank_sum"]) for r in K.rank_sums(df, "g", "s", ranges=16).collect()}
    ranks = ranks_by_hand([s for _, s in rows])
    for g in "abc":
        mine = [r for (x, _), r in zip(rows, ranks, strict=True) if x == g]
        assert got[g] == (len(mine), pytest.approx(sum(mine)))


def test_identical_scores_are_not_significant(spark):
    df = spark.createDataFrame([("a", 1.0)] * 5 + [("b", 1.0)] * 5, "g string, s double")
    row = K.kruskal_wallis(df, "g", "s").first()
    assert row["h"] is None and row["significant"] is False
    small = K.mann_whitney(df.where("g = 'a'"), "g", "s", "a", "b").first()
    assert small["p_value"] == 1.0 and small["significant"] is False


def test_group_fairness(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 0, 0), ("a", 1, 0), ("b", 1, 1), ("b", 0, 1), ("c", 1, 0)],
        "g string, t int, p int")
    assert E.demographic_parity_difference(df, "p", "g").first()[0] == pytest.approx(1.0)
    odds = E.equalized_odds_difference(df, "t", "p", "g").first()
    assert odds["tpr_difference"] == pytest.approx(0.5)
    assert odds["fpr_difference"] == pytest.approx(1.0)
    one = df.where("g = 'a'")
    assert E.demographic_parity_difference(one, "p", "g").first()[0] == 0.0
    assert E.disparate_impact_ratio(one, "p", "g").first()[0] == 1.0
    bad = spark.createDataFrame([("a", 2, 1)], "g string, t int, p int")
    with pytest.raises(Exception, match="must be 0 or 1"):
        E.equalized_odds_difference(bad, "t", "p", "g").collect()


def test_amplification(spark):
    df = spark.createDataFrame([("input", 0), ("output", 1)], "side string, flag int")
    assert E.bias_amplification(df, "side", "flag").first()["amplification"] == math.inf
    both = spark.createDataFrame([("input", 0), ("output", 0)], "side string, flag int")
    assert E.bias_amplification(both, "side", "flag").first()["amplification"] == 1.0


@pytest.mark.parametrize("block_rows", [2048, 7])
@pytest.mark.parametrize("threshold", [0.9, 0.3])
def test_individual_fairness_matches_all_pairs(spark, block_rows, threshold):
    import numpy as np

    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 4))
    vectors = np.concatenate([base, base[:10], np.repeat(base[:1], 30, axis=0)])
    y = rng.integers(0, 2, len(vectors)).astype(float)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    similar = differing = 0
    for i in range(len(unit)):
        for j in range(i + 1, len(unit)):
            if unit[i] @ unit[j] >= threshold - 1e-12:
                similar += 1
                differing += abs(y[i] - y[j]) > 0.1
    df = spark.createDataFrame([(v.tolist(), float(p)) for v, p in zip(vectors, y, strict=True)],
                               "v array<double>, y double")
    row = E.individual_fairness(df, "v", "y", threshold, block_rows=block_rows).first()
    assert (row["similar_pairs"], row["differing_pairs"]) == (similar, differing)
    none = E.individual_fairness(df.limit(1), "v", "y").first()
    assert none["individual_fairness"] == 1.0


def test_individual_fairness_of_vectors_with_equal_sums(spark):
    import itertools

    vectors = [[float(x) for x in v] for v in itertools.product((0, 1), repeat=8) if sum(v) == 4]
    df = spark.createDataFrame([(v, float(n % 2)) for n, v in enumerate(vectors)] * 3,
                               "v array<double>, y double")
    row = E.individual_fairness(df, "v", "y", 0.74, block_rows=9).first()
    want = [0, 0]
    for (n, a), (m, b) in itertools.combinations(enumerate(vectors), 2):
        if sum(x * y for x, y in zip(a, b, strict=True)) >= 3:
            want[0] += 9
            want[1] += 9 * (n % 2 != m % 2)
    assert (row["similar_pairs"], row["differing_pairs"]) == (want[0] + 3 * len(vectors), want[1])


def test_intersectional(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("b", "x", 5.0)],
                               "d1 string, d2 string, s double")
    row = E.intersectional_bias(df, ["d1", "d2"], "s").first()
    assert row["max_disparity"] == 4.0 and row["num_groups"] == 3
    assert row["intersectional_variance"] == pytest.approx(8 / 3)
    one = E.intersectional_bias(df.limit(1), ["d1", "d2"], "s").first()
    assert one["intersectional_variance"] == 0.0 and one["num_groups"] is None


def test_validate_texts(texts):
    row = Q.validate_texts(texts("a", "a", " ", None, "b")).first()
    assert (row["total_texts"], row["valid_texts"]) == (5, 3)
    assert row["duplicate_ratio"] == pytest.approx(1 / 3)
    assert len(row["warnings"]) == 2 and row["is_valid"]
    empty = Q.validate_texts(texts("a").limit(0)).first()
    assert empty["errors"] == ["No text data provided"] and not empty["is_valid"]
    blank = Q.validate_texts(texts(" ")).first()
    assert blank["errors"] == ["No valid text data found"]
    report = Q.quality_report(texts("a").limit(0)).collect()
    assert any(r["section"] == "errors" for r in report)


def test_validate_runs(spark):
    runs = spark.createDataFrame([("r1", 0, 0, 0.0, 1.0), ("r2", 100, 150, 0.5, 0.0)],
                                 "run_id string, total_samples long, biased_samples long, "
                                 "biased_sample_rate double, duration_s double")
    found = spark.createDataFrame([("r2", "age")], "run_id string, bias_type string")
    rows = {r["run_id"]: r for r in Q.validate_runs(runs, found).collect()}
    assert rows["r1"]["errors"] == ["No samples were analyzed"]
    assert rows["r2"]["errors"] and len(rows["r2"]["warnings"]) == 2
    assert rows["r2"]["quality_score"] == pytest.approx((0.8 + 1 / 9 + 0.5) / 3)


def test_reports(findings, spark):
    counts = [(r["bias_type"], r["findings"]) for r in
              R.value_distribution(findings, "bias_type").collect()]
    assert counts == [("demographic", 3), ("racial", 1)]
    scored = findings.withColumn("confidence", F.col("bias_score"))
    assert R.filter_findings(scored, "demographic", "high", 0.7).count() == 1
    bins = R.score_histogram(scored, 10).collect()
    assert len(bins) == 10 and sum(b["findings"] for b in bins) == 4


def test_comparative_report_first_run_wins_ties(spark):
    runs = spark.sql("""SELECT * FROM VALUES
        ('a', 'm1', timestamp'2024-01-01', 100L, 10L, 0.1D, 0.5D),
        ('b', 'm2', timestamp'2024-01-02', 100L, 10L, 0.1D, 0.6D)
        AS t(run_id, model_name, ts, total_samples, biased_samples, biased_sample_rate,
             overall_bias_score)""")
    row = R.comparative_report(runs).first()
    assert row["best_name"] == row["worst_name"] == "m1"
    assert row["average_bias_rate"] == pytest.approx(0.1)


def test_vocabulary_ranks_are_cut_before_the_shuffle(texts):
    from conftest import plan

    text = plan(C.vocabulary_top(texts("some words here")))
    assert "WindowGroupLimit" in text and "partial_count" in text
