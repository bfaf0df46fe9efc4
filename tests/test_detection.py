import pytest
from conftest import plan
from pyspark.sql import functions as F

from evenhand.operators import detection as D
from evenhand.options import DetectOptions


def found(df, parts, **kwargs):
    rows = D.detect_findings(df, parts, **kwargs).collect()
    return sorted((r["doc_id"], r["group_name"], r["category"], r["term"],
                   round(r["bias_score"], 6), r["severity"]) for r in rows)


def test_groups_are_whole_words(texts):
    df = texts("The man met a woman", "éhe heather", "Native American and South Asian", "")
    got = {(r["doc_id"], r["group_name"]) for r in D.demographic_groups(df).collect()}
    assert got == {(0, "male"), (0, "female"), (2, "native"), (2, "asian")}


def test_occupation_scores(texts):
    df = texts("a man is an engineer", "a woman is an engineer", "a man must be a nurse",
               "an engineer")
    assert found(df, ["occupation"]) == [
        (0, "male", "male_dominated", "engineer", 0.7, "high"),
        (1, "female", "male_dominated", "engineer", 0.3, "medium"),
        (2, "male", "female_dominated", "nurse", 0.5, "medium")]


def test_trait_distance(texts):
    df = texts("man lazy", "man" + "." * 60 + "smart", "man" + "." * 120 + "lazy")
    assert found(df, ["trait"]) == [
        (0, "male", "negative_traits", "lazy", 0.9, "critical"),
        (1, "male", "positive_traits", "smart", 0.4, "medium"),
        (2, "male", "negative_traits", "lazy", 0.5, "medium")]


def test_exclusion_has_no_word_boundary_unless_asked(texts):
    df = texts("he said no  hero", "only he", "women cannot")
    loose = D.detect_findings(df, ["exclusion"]).collect()
    assert {(r["doc_id"], r["term"], r["pattern"]) for r in loose} == {
        (0, "he", r"no\s+he"), (1, "he", r"only\s+he"), (2, "women", r"women\s+cannot")}
    assert {r["severity"] for r in loose} == {"high"}
    strict = D.detect_findings(df, ["exclusion"],
                               options=DetectOptions(whole_word_exclusions=True)).collect()
    assert {r["doc_id"] for r in strict} == {1, 2}


def test_gender_needs_a_whole_word_of_that_gender(texts):
    df = texts("he is strong", "strong theory", "she is weak" , "he" + "." * 70 + " strong")
    assert found(df, ["gender"]) == [
        (0, None, "male", "strong", 0.5, "medium"), (2, None, "female", "weak", 0.5, "medium"),
        (3, None, "male", "strong", 0.3, "medium")]


def test_named_groups_need_a_negative_trait(texts):
    df = texts("black and lazy", "black", "a hindu, lazy")
    assert found(df, ["racial"]) == [(0, None, None, "black", 0.5, "medium")]
    assert found(df, ["religious"]) == [(2, None, None, "hindu", 0.5, "medium")]


def test_dialect_single_marker_is_not_enough(texts):
    df = texts("reckon", "reckon yonder", "reckon that is wrong, the correct way", language="en")
    got = [g for g in found(df, ["dialect"]) if g[2] == "southern_us"]
    assert got == [(1, None, "southern_us", None, 0.2, "low"),
                   (2, None, "southern_us", None, 0.8, "critical")]
    assert found(texts("reckon yonder", language="fr"), ["dialect"]) == []


def test_formality_is_not_capped(texts):
    df = texts("yeah really cool super awesome but wrong and inappropriate",
               "yeah really wrong", "yeah really cool")
    rows = D.detect_findings(df, ["formality"]).collect()
    assert [(r["doc_id"], r["term"], round(r["bias_score"], 6), r["marker_count"])
            for r in rows] == [(0, "inappropriate", 1.1, 5)]


def test_preference_and_inclusive(texts):
    df = texts("English is better, you have poor English", "the chairman of mankind", language="en")
    assert found(df, ["language_preference"]) == [
        (0, None, "language_inferiority", "poor english", 0.7, "high"),
        (0, None, "language_supremacy", "english is better", 0.8, "high")]
    rows = D.detect_findings(df, ["inclusive_language"]).collect()
    assert {(r["term"], r["suggestion"]) for r in rows} == {
        ("chairman", "chairperson"), ("mankind", "humankind")}


def test_checks_that_are_off_leave_the_plan(texts):
    df = texts("the chairman")
    text = plan(D.detect_findings(df, options=DetectOptions(checks=("racial",))))
    assert "chairman" not in text and "hispanic" in text
    with pytest.raises(ValueError):
        DetectOptions(checks=("nonsense",))


def test_detection_is_one_projection(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = plan(D.detect_findings(df))
    for operator in ("Join", "Exchange", "Python", "Filter (size"):
        assert operator not in text
    assert "n_chars" in text  # kept because the caller selected it
    narrow = plan(D.detect_findings(df.select("doc_id", "text")))
    assert "n_chars" not in narrow


def test_quick_check(spark):
    df = spark.createDataFrame([(1, "only men"), (1, "Typical Woman, all blacks"), (2, "fine")],
                               "doc_id long, output string")
    rows = {r["doc_id"]: r for r in D.quick_check(df).collect()}
    assert rows[1]["bias_types"] == ["gender", "racial"] and rows[1]["confidence"] == 0.7
    assert rows[2]["bias_types"] == [] and rows[2]["confidence"] == 0.3


def test_pairs_search_the_output_only(spark):
    df = spark.createDataFrame([(1, "a man is lazy", "fine")],
                               "doc_id long, prompt string, output string")
    assert D.detect_pairs(df).count() == 0


def test_lexicon_table_join(spark, texts):
    lexicon = spark.createDataFrame([("man", "male"), ("he", "male"), ("lady", "female")],
                                    "term string, group_name string")
    got = {(r["doc_id"], r["term"]) for r in D.word_mentions(
        texts("The man, the MAN he", "theatre", "", None), lexicon).collect()}
    assert got == {(0, "man"), (0, "he")}


def test_words_are_looked_for_by_their_first_character(texts):
    """Before the look behind it, and with the same words."""
    from evenhand.functions import matching as M

    df = texts("he said: the he-man, _he, ahe, he").select(M.word_terms(F.col("text"), ["he", "he-man", "man"]).alias("w"))
    assert sorted(df.first()["w"]) == ["he", "he-man", "man"]
    assert "(?=[hm])(?<!" in plan(df)
    assert texts("_he ahe he7").select(M.word_terms(F.col("text"), ["he"]).alias("w")).first()["w"] == []
