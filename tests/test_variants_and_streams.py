import datetime
import random
import re

import pytest
from conftest import plan
from pyspark.sql import functions as F

from evenhand.operators import counterfactual as X
from evenhand.options import MonitorOptions
from evenhand.plans.run import detect
from evenhand.sources import messages as MS
from evenhand.sources import results as RS
from evenhand.sources import texts as TS
from evenhand.streaming import monitor as R


def variants(df, *methods):
    return {(r["target"], r["variant"]) for r in X.substitutions(df, methods).collect()}


def test_gender_swap(texts):
    assert variants(texts("He said Mr. Fox is his man"), "gender") == {
        ("female", "She said Ms. Fox is her woman"),
        ("neutral", "They said Mx. Fox is their person")}
    assert variants(texts("the theory"), "gender") == set()


def test_race_and_religion_swap(texts):
    got = variants(texts("An African-American and a white man"), "race")
    assert ("black>asian", "An asian-American and a white man") in got and len(got) == 6
    got = variants(texts("the church"), "religion")
    assert ("christian>muslim", "the mosque") in got and len(got) == 5


def test_names(texts):
    got = variants(texts("Anna met Bob and Carl, then Anna left"), "name")
    assert len(got) == 24  # three distinct names, eight lists
    assert sum("Anna" not in v for _, v in got) == 8


def test_counterfactuals_are_distinct_and_whole(texts):
    df = texts("He met Anna, a white Christian", "")
    rows = X.counterfactuals(df).collect()
    for key in (0, 1):
        mine = [r["variant"] for r in rows if r["doc_id"] == key]
        assert len(mine) == len(set(mine)) > 100
    assert {r["method"] for r in rows if r["doc_id"] == 0} == set(X._BUILDERS)
    assert X.counterfactuals(df, per_text=20).count() == 40


def test_all_variants_are_compared(texts):
    text = "He is lazy, said Anna, a white Christian"
    variants_ = [r["variant"] for r in X.counterfactuals(texts(text)).collect()]
    scores = [r[0] for r in texts(*variants_).select(X.skew_score(F.lower("text"))).collect()]
    row = X.counterfactual_differences(texts(text, source="a"), by=("source",)).first()
    assert row["variant_score"] == pytest.approx(sum(scores) / len(scores))
    assert row["source"] == "a"


def test_nothing_is_cut_by_default(texts):
    run = detect(texts("x " * 2000 + "the man is lazy"), persist=False)
    assert run.metrics.first()["finding_count"] > 0
    assert "maxOffsetsPerTrigger" not in MS.kafka_options()
    assert MS.kafka_options(MonitorOptions(max_messages_per_trigger=5))["maxOffsetsPerTrigger"] == 5


def test_equal_texts_have_keys_of_their_own(texts, tmp_path, spark):
    df = TS.as_texts(texts(*["the man is lazy"] * 3).select("text"))
    assert df.select("doc_id").distinct().count() == 3
    df.write.parquet(str(tmp_path / "t"))
    kept = spark.read.parquet(str(tmp_path / "t"))
    run = detect(kept, persist=False)
    assert run.metrics.first()["biased_samples"] == 3
    n = run.findings.count()
    assert RS.flat_findings(run.findings, kept).count() == n


def test_rows_of_long_texts_hold_descriptions(texts):
    """All variants of a text of 1 MB with 200 names: 1.6 GB, one variant at a time."""
    words = [f"Na{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    df = texts(" ".join(words) + " und so weiter" * 72_000)
    size = df.select(F.length("text")).first()[0]
    for variants_ in (X.substitutions(df, ("name",)), X.counterfactuals(df, methods=("name",))):
        row = variants_.agg(F.count(F.lit(1)), F.max(F.length("variant")), F.count_if(F.col("variant").contains("Naaa"))).first()
        assert row[0] > 1500 and size - 10 < row[1] < size + 20 and row[2] >= row[0] - 8
    described = X._distinct(df.withColumn("text", F.substring("text", 1, 2000)), None, "text", "doc_id", X.hash_pick, ("name",))
    assert described.select(F.size("_kept")).first()[0] > 1500
    assert described.select(F.max(F.length(F.to_json("_kept")))).first()[0] < 300 * 1600


def test_differences(texts):
    rows = X.counterfactual_differences(texts("He is lazy and strong"), methods=("gender",))
    row = rows.first()
    assert row["own_score"] == 0.0 and row["difference"] == 0.0
    assert X.effectiveness(rows).first()[0] == 0.0
    none = X.counterfactual_analysis(rows.limit(0)).first()
    assert none["average_bias_change"] == 0.0 and none["significant_changes"] == 0


def test_renamed_variants_are_scored_around_their_places():
    """Against the built variant, with words that cross replaced places, overlap them or lie between them."""
    parts = ["We", "we", "ak", "Ak", " lazy", "La", "zy", "strong", "St", "emotional" * 2, " x" * 12, "\u0130", "capable"]
    cases = [(a + b + c + d, w, to) for a in parts for b in parts for c in ("La", "zy weak ", "" ) for d in parts[:5]
             for w in ("We", "La", "St") for to in ("Lazyla", "weAk", "")]
    for text, word, to in cases:
        assert X._Renamed(text).score(word, to) == X._text_score(text.replace(word, to)), (text, word, to)


def plain_variants(text, others, words, names):
    """Places of the distinct variants of a text by building each, with their score."""
    rows = [(o["method"], o["target"], o["word"], n, -1, o["made"]) for n, o in enumerate(others)]
    rows += [("name", target, word, len(others) + k, n, text.replace(word, to))
             for k, word in enumerate(words) for n, (target, to) in enumerate(zip(X.NAME_LISTS, names, strict=True))
             if to is not None and to != word]
    seen, out = {text}, []
    for *_, source, n, variant in sorted(rows, key=lambda r: r[:5]):
        if variant not in seen:
            seen.add(variant)
            out.append((source, n, X._text_score(variant)))
    return out


def test_variants_are_told_apart_without_building_them():
    """Against built variants: words that begin alike, or like a name, stand side by side or hold a scored word."""
    parts = ["Li", "Lin", "Linda", "Ma", "Mary", "M", " ", ". ", "la", "zy", "n", "Weak", "İ", "We", "ak", "a"]
    names = ["Ma", "Lin", "Linda", "Mary", "Zylazy", None, "Mary", "Weak"]
    draw = random.Random(4)
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 9)))
        words = list(dict.fromkeys(re.findall(r"(?<!\w)[A-Z][a-z]+(?!\w)", text)))
        draw.shuffle(words)
        made = [text.replace(draw.choice(parts), draw.choice(parts), 1) for _ in range(3)]
        others = [{"method": m, "target": "t", "word": str(n), "made": v}
                  for n, (m, v) in enumerate(zip(["gender", "race", "race"], made, strict=True))]
        sources, picked, scores, short = X._variants_of(text, others, words, names, 1000, True)
        want = plain_variants(text, others, words, names)
        assert list(zip(sources.tolist(), picked.tolist(), scores.tolist(), strict=True)) == want, (text, words)
        assert len(short) == len(want) + 1


def test_long_texts_are_not_built_to_count_their_variants(monkeypatch):
    """2,000 words of 8 names each: 16,000 variants, none of which is built."""
    words = [f"Q{chr(97 + k // 676 % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(2000)]
    names = [names[0] for names in X.NAME_LISTS.values()]
    monkeypatch.setattr(X._Distinct, "_built", lambda *_: pytest.fail("built"))
    monkeypatch.setattr(X, "_text_score", lambda _: pytest.fail("built"))
    sources, *_, scores, short = X._variants_of(" lazy ".join(words) * 3, [], words, names, 100, True)
    assert len(sources) == len(scores) == 16_000 - 2000 * (len(names) - len({*names})) and not short


def test_a_text_is_cut_once_for_all_names(texts):
    """No expression runs over the text for each name of a word."""
    df = texts("Anna met Bob", "Éva met Anna in Annapolis", None)
    for out in (X.substitutions(df, ("name",)), X.counterfactuals(df, methods=("name",))):
        assert "regexp_replace" not in plan(out) and "concat_ws" in plan(out)
    rows = X.substitutions(df, ("name", "template")).where("doc_id = 1").collect()
    names = [r["variant"] for r in rows if r["method"] == "name"]
    assert len(names) == 16 and len(rows) > 800
    assert sorted(v.count("Anna") for v in names) == [0] * 8 + [1] * 8 and all(v.startswith("Éva met ") for v in names)


def test_equal_variants_of_any_method_are_one(texts):
    """A template's sentence and a renamed text may be the same."""
    text = "The male person is lazy."
    rows = X.counterfactuals(texts(text, "Lazy Lazy", None)).collect()
    assert text not in [r["variant"] for r in rows if r["doc_id"] == 0]
    assert not [r for r in rows if r["doc_id"] == 2]
    for key in (0, 1):
        mine = [r for r in rows if r["doc_id"] == key]
        assert len({r["variant"] for r in mine}) == len(mine)
        assert [r["variant_rank"] for r in sorted(mine, key=lambda r: r["variant_rank"])] == list(range(1, len(mine) + 1))
    plain = {"We", "He"}
    found = texts("We7 _We AWe We-He Wé He").select(X._name_words(F.col("text")).alias("w")).first()["w"]
    assert set(found) == plain


def test_run_object(texts):
    df = texts("The man is lazy", "women cannot drive", "fine words only")
    run = detect(df, persist=False)
    assert run.metrics.first()["total_samples"] == 3
    assert run.findings.count() == run.metrics.first()["finding_count"]
    assert run.counterfactual.count() == 3
    assert run.recommendations.count() >= 2


def test_lines_and_csv(spark, tmp_path):
    (tmp_path / "a.txt").write_text("  one \n\n\t\ntwo\n")
    assert sorted(r["text"] for r in TS.read_text_lines(spark, str(tmp_path / "a.txt")).collect()) \
        == ["one", "two"]
    (tmp_path / "b.csv").write_text('id,text\n1,"a, ""b""\nc"\n2,\n')
    rows = TS.read_text_csv(spark, str(tmp_path / "b.csv"), multi_line=True).collect()
    assert [r["text"] for r in rows] == ['a, "b"\nc']
    (tmp_path / "c.csv").write_text("id\n1\n")
    with pytest.raises(ValueError, match="text"):
        TS.read_text_csv(spark, str(tmp_path / "c.csv"))


def test_results_round_trip(spark, texts, tmp_path):
    from evenhand.operators.detection import detect_findings

    found = detect_findings(texts("the man is lazy", "women cannot", run_id="r1"))
    runs = spark.createDataFrame([("r1", 2)], "run_id string, total_samples long")
    for fmt in ("json", "parquet"):
        path = str(tmp_path / fmt)
        RS.write_results(found, runs, path, fmt)
        stored, stored_runs = RS.read_results(spark, path, fmt)
        kept = [c for c in found.columns if c in stored.columns and c != "text"]
        assert sorted(map(str, stored.select(kept).collect())) == \
            sorted(map(str, found.select(kept).collect()))
        assert stored_runs.first()["total_samples"] == 2


def message(spark, path, rows):
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(path)


def test_split_valid(spark):
    raw = spark.createDataFrame([('{"text":"a","timestamp":"2024-01-01T00:00:00"}',),
                                 ('{"text":"a"}',), ("broken",)], "value string")
    valid, rejected = MS.split_valid(MS.parse_messages(raw))
    assert valid.count() == 1 and rejected.count() == 2


def test_stream_equals_batch_and_drops_repeats(spark, tmp_path):
    rows = [('{"text":"the man is lazy","timestamp":"2024-01-01T00:%02d:%02d",'
             '"message_id":"%d","source":"m"}' % (n // 4, n % 4 * 15, n),) for n in range(200)]
    message(spark, str(tmp_path / "in"), rows + rows[:20])
    raw = MS.read_message_stream(spark, "text", path=str(tmp_path / "in"))
    valid, _ = MS.split_valid(MS.parse_messages(raw))
    query = (MS.deduplicated(valid).writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "c1"))
             .trigger(availableNow=True).start(str(tmp_path / "dedup")))
    query.awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "dedup"))
    assert kept.count() == 200

    monitor = MonitorOptions(window="5 minutes")
    named = valid.withColumnRenamed("source", "model_name")
    query = MS.write_batch_summaries(
        R.window_summary(R.detect_stream(named), monitor), str(tmp_path / "c2"), "text",
        R.micro_batches(monitor, drain=True), path=str(tmp_path / "out"))
    query.awaitTermination()
    streamed = spark.read.text(str(tmp_path / "out")).select(F.from_json(
        "value", "window_start timestamp, processed_count long, finding_count long")
        .alias("s")).select("s.*")
    batch_valid, _ = MS.split_valid(MS.parse_messages(spark.read.text(str(tmp_path / "in"))))
    batch = R.window_summary(R.detect_stream(
        batch_valid.withColumnRenamed("source", "model_name")), monitor)
    closed = batch.where("ts <= timestamp'2024-01-01 00:39:45'").select(streamed.columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, closed.collect()))


def test_rate_limit_depends_on_last_sent(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    minutes = [0, 3, 4, 6, 9, 11, 30]
    rows = [("m", start + datetime.timedelta(minutes=m)) for m in minutes]
    rows += [("k", start + datetime.timedelta(minutes=m)) for m in (1, 2)]
    alerts = spark.createDataFrame(rows, "model_name string, ts timestamp").repartition(3)
    sent = R.rate_limit(alerts, seconds=300).collect()
    got = sorted((r["model_name"], (r["ts"] - start).seconds // 60) for r in sent)
    assert got == [("k", 1), ("m", 0), ("m", 6), ("m", 11), ("m", 30)]
    alerts.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(alerts.schema).parquet(str(tmp_path / "in"))
    query = (R.rate_limit_stream(stream, seconds=300).writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "c"))
             .trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination()
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect())) == \
        sorted(map(str, sent))
