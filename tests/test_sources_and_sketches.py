"""CSV in ranges, summaries by date, sketches, banded fairness."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenhand.operators import fairness as E
from evenhand.operators import quality as Q
from evenhand.sources import messages as MS
from evenhand.sources import texts as TS


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_csv_ranges_equal_the_one_task_read(spark, tmp_path, small_blocks):
    r = random.Random(1)
    value = lambda: "".join(r.choices(["a", "é", ",", "\n", "\r\n", '"', " ", "xyz"], k=r.choice([0, 1, 5, 40, 9000])))
    for seed in range(2):
        r.seed(seed)
        data = [(n, value(), r.choice(["de", ""])) for n in range(40)]
        path = str(tmp_path / str(seed))
        spark.createDataFrame(data, "id int, text string, lang string").coalesce(r.choice([1, 2])).write.option(
            "header", True).option("escape", '"').option("quoteAll", r.random() < 0.5).csv(path)
        one = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).dropna(subset=["text"])
        many = TS.read_text_csv(spark, path, multi_line=True)
        assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 10
        assert many.columns == one.columns and rows_of(many) == rows_of(one) and one.count() > 20


def test_odd_csv(spark, tmp_path):
    for name, text in {"crlf": 'id,text\r\n1,"a, ""b"""\r\n2,c\r\n', "blank": 'id,text\n\n1,a\n\n2,"\n\n"\n', "no end": 'id,text\n1,"a ""q"" b"', "header": "id,text\n", "long": 'id,text\n1,"' + "x\n" * 50 + '"\n2,y\n'}.items():
        path = tmp_path / f"{name}.csv"
        path.write_bytes(text.encode())
        one = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(path)).dropna(subset=["text"])
        assert rows_of(TS.read_text_csv(spark, str(path), multi_line=True)) == rows_of(one), name
    (tmp_path / "kept.csv").write_bytes(b'id,text\r\n1,"a\r\nb"\r\n2,c\r\n')  # line breaks of values stay as they are
    assert {r["text"] for r in TS.read_text_csv(spark, str(tmp_path / "kept.csv"), multi_line=True).collect()} == {"a\r\nb", "c"}
    (tmp_path / "n.csv").write_text("id\n1\n")
    with pytest.raises(ValueError):
        TS.read_text_csv(spark, str(tmp_path / "n.csv"), multi_line=True)


def test_summaries_by_date(spark, tmp_path):
    base = datetime.datetime(2024, 1, 1)
    rows = [(base + datetime.timedelta(hours=h), "m", h) for h in range(24 * 6)]
    df = spark.createDataFrame(rows, "ts timestamp, model_name string, processed_count long")
    for k in range(2):
        df.where(F.col("processed_count") % 2 == k).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        MS.write_summaries(stream, f"{tmp_path}/c", f"{tmp_path}/out", {"availableNow": True}).awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert stored.count() == len(rows)
    noon = datetime.datetime(2024, 1, 3, 12)
    recent = MS.recent_summaries(stored, "6 hours", noon)
    assert sorted(r["ts"] for r in recent.collect()) == [noon - datetime.timedelta(hours=h) for h in (5, 4, 3, 2, 1, 0)]
    assert "PartitionFilters: [isnotnull(date" in recent._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    read = stored.where(F.col("date") == noon.date())
    assert {r["date"] for r in recent.select("date").distinct().collect()} == {noon.date()} and read.count() == 24
    assert MS.recent_summaries(stored).count() == 24 and MS.recent_summaries(df.limit(0)).collect() == []


def test_sketches(spark, texts):
    many = spark.range(60_000).select((F.col("id") % 7).alias("run"), F.concat(F.lit("text "), F.col("id") % 40_000).alias("text"))
    sketches = Q.text_sketches(many.unionAll(many.limit(5).select("run", F.lit(" "))), ("run",))
    all_ = Q.sketched_duplicate_ratio(sketches).first()
    assert all_["valid_texts"] == 60_000 and abs(all_["distinct_texts"] / 40_000 - 1) < 0.02
    assert abs(all_["duplicate_ratio"] - 1 / 3) < 0.02
    by = {r["run"]: r for r in Q.sketched_duplicate_ratio(sketches, ("run",)).collect()}
    assert len(by) == 7 and all(abs(r["distinct_texts"] / r["valid_texts"] - 1) < 0.02 and r["distinct_texts"] <= r["valid_texts"] for r in by.values())
    empty = Q.sketched_duplicate_ratio(Q.text_sketches(texts(None, ""))).first()
    assert empty["valid_texts"] == empty["distinct_texts"] == 0 and empty["duplicate_ratio"] is None
    assert Q.sketched_duplicate_ratio(Q.text_sketches(texts("a").limit(0), ("doc_id",))).first()["valid_texts"] == 0


def test_banded_fairness_against_the_exact_one(spark):
    r = np.random.default_rng(3)
    base = r.standard_normal((30, 20))
    rows = [((base[k % 30] + 0.35 * r.standard_normal(20)).tolist(), float(k % 3)) for k in range(300)] + [(base[0].tolist(), 1.0)] * 5
    odd = [(None, 1.0), ([0.0] * 20, 1.0), (base[1].tolist(), None), ([1.0, 2.0], 0.0), ([2.0, 4.1], 1.0)]
    df = spark.createDataFrame(rows + odd, "v array<double>, y double")
    plain = df.where("size(v) = 20")
    for threshold in (0.9, 0.7):
        exact = E.individual_fairness(plain, "v", "y", threshold=threshold).first()
        for options in ({}, {"block_rows": 150, "bits": 6}):
            found = E.individual_fairness_banded(plain, "v", "y", threshold=threshold, **options).first()
            assert 0.95 * exact["similar_pairs"] <= found["similar_pairs"] <= exact["similar_pairs"]
            assert found["differing_pairs"] <= exact["differing_pairs"] and found["expected_recall"] >= 0.98
            assert found["individual_fairness"] == pytest.approx(exact["individual_fairness"], abs=0.02)
        sure = E.individual_fairness_banded(plain, "v", "y", threshold=threshold, bits=2, recall=1 - 1e-9).first()
        assert sure["similar_pairs"] == exact["similar_pairs"] and sure["differing_pairs"] == exact["differing_pairs"]
    assert E.individual_fairness_banded(df, "v", "y").first()["similar_pairs"] >= 11  # vectors of two lengths
    none = E.individual_fairness_banded(df.limit(0), "v", "y").first()
    assert none["similar_pairs"] == 0 and none["individual_fairness"] == 1.0
    assert E.bands_for(1.0, 12, 0.98) == 1 and E.bands_for(0.9, 12, 0.98) > 10
