import numpy as np
import pytest

from evenhand.llm import language_id, quality, toxicity
from evenhand.llm.common import bounded_sample, remainder, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SF, "documents").cache()


def test_language_held_out(spark, documents):
    contents = language_id.train(documents.filter(remainder("doc_id", 4) != 2))
    assert sorted(contents) == ["de", "en", "es", "fr"] and all(len(x) <= 50_000 for x in contents.values())
    found = language_id.identify(documents, contents).join(documents.select("doc_id", "lang", "n_chars"), "doc_id").filter(remainder("doc_id", 4) == 2).collect()
    right = [r["lang"] == r["lang_pred"] for r in found if r["lang"] and r["n_chars"] > 60]
    assert np.mean(right) > 0.97 and all(0 <= r["score"] <= 1 for r in found)


def test_language_odd_texts(spark, documents):
    contents = language_id.train(documents)
    df = spark.createDataFrame([(1, None), (2, ""), (3, "12 %% !"), (6, "½ ² ① _"), (4, "the of and to in is that"), (4, "the of and to in is that"), (5, "der " * 100_000)], "doc_id long, text string").selectExpr("*", "'x' AS score", "'y' AS lang")
    got = [tuple(r)[:2] for r in language_id.identify(df, contents).collect()]
    assert got == [(1, "und"), (2, "und"), (3, "und"), (6, "und"), (4, "en"), (4, "en"), (5, "de")]
    assert language_id.identify(df.filter("false"), contents).collect() == []
    assert {r["lang_pred"] for r in language_id.identify(df, {}).collect()} == {"und"}
    assert language_id.train(documents.filter("false")) == {}
    model = language_id.Model(contents, language_id.Settings())
    assert model.predict("q")[3] and not model.predict("le la les des et en un une du que qui est dans pour " * 3)[3]


def test_quality_prior_and_risk():
    r = np.random.default_rng(0)
    good, bad = r.normal(0, 1, (4000, quality.N_FEATURES)), r.normal(4, 1, (1000, quality.N_FEATURES))
    model = quality.fit_arrays(good[:2000], np.vstack([good[2000:], bad[:500]]))
    assert 0.7 < model.prior < 0.86  # 0.8
    assert (model.score(good) >= 0.5).mean() > 0.95 and (model.score(bad) >= 0.5).mean() < 0.02


def test_quality_held_out(spark):
    documents, labels = (table(spark, "/root/testdata/sf0.1", x) for x in ("documents", "labels"))
    teaching = remainder("doc_id", 3) != 1
    model = quality.fit(documents.filter(teaching), labels.filter(teaching & (labels.quality == 1)))
    found = quality.classify(documents, model).join(labels, "doc_id").filter(~teaching).collect()
    assert np.mean([r["predicted"] == r["quality"] for r in found]) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "a b\n" * 50_000), (3, "a b\n" * 50_000)], "doc_id long, text string").selectExpr("*", "'s' AS score")
    scores = [r["score"] for r in quality.classify(odd, model).collect()]
    assert len(scores) == 5 and scores[0] == scores[1] and scores[3] == scores[4] and all(0 <= x <= 1 for x in scores)
    assert quality.filtered(odd, model).columns == odd.columns and quality.classify(odd.filter("false"), model).collect() == []
    nothing = labels.filter("false")
    assert quality.fit(documents, nothing) is None
    assert {r["score"] for r in quality.classify(odd, None).collect()} == {0.5}


def test_cumulative_links():
    r = np.random.default_rng(1)
    x = r.poisson(1.0, (3000, 3)).astype(float)
    y = np.digitize(x @ [1.0, 2.0, 0.0] + r.logistic(0, 0.3, 3000), [1, 3, 5])
    w, theta = toxicity.fit_arrays(x, y, toxicity.Settings(steps=800, decay=0))
    assert (np.diff(theta) > 0).all() and 1.7 < w[1] / w[0] < 2.3 and abs(w[2]) < 0.2
    model = toxicity.Model({}, w, theta, ())
    chances = model.grades(x @ w)
    assert np.allclose(chances.sum(1), 1) and (chances >= 0).all() and (chances.argmax(1) == y).mean() > 0.75


def test_toxicity_held_out(spark):
    documents, labels = (table(spark, "/root/testdata/sf0.1", x) for x in ("documents", "labels"))
    teaching = remainder("doc_id", 3) != 1
    model = toxicity.fit(documents.filter(teaching), labels.filter(teaching))
    found = toxicity.grade(documents, model).withColumnRenamed("toxic", "p").join(labels, "doc_id").filter(~teaching).collect()
    assert np.mean([r["p"] == (r["toxic"] == 1) for r in found]) > 0.97
    assert all(0 <= r["severity"] <= 3 and 0 <= r["grade"] <= 3 for r in found)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "idiot scum trash " * 30_000), (3, "idiot scum"), (3, "idiot scum")], "doc_id long, text string").selectExpr("*", "1 AS grade")
    got = toxicity.grade(odd, model).collect()
    assert got[0]["severity"] == got[1]["severity"] and got[2]["severity"] > got[3]["severity"] == got[4]["severity"] and got[3]["toxic"]
    assert toxicity.grade(odd.filter("false"), model).collect() == []
    assert toxicity.fit(documents, labels.filter("toxic = 1")) is None
    assert {r["severity"] for r in toxicity.grade(odd, None).collect()} == {0.0}


def test_bounded_sample(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "CASE WHEN id < 19990 THEN 'a' WHEN id < 19999 THEN 'b' END AS kind", "id AS rank")
    got = bounded_sample(df, "kind", 100, "doc_id")
    assert {r["kind"]: r["count"] for r in got.groupBy("kind").count().collect()} == {"a": 100, "b": 9}
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, bounded_sample(df.repartition(7), "kind", 100, "doc_id").collect()))
