import hashlib
from collections import Counter

import pytest

import corpus_pipeline as P
from evenhand.llm import decontamination, quality, sentencepiece_sampling, simhash, suffix_dedup
from evenhand.llm.common import remainder, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returned, rows by key."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, SF))
        out.append((name, docs.columns, sorted((r.asDict() for r in docs.collect()), key=lambda r: r["doc_id"])))
    return out


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_order_and_columns(spark, stages):
    columns = table(spark, SF, "documents").columns
    assert [n for n, _, _ in stages] == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "sentencepiece"]
    assert all(c == columns for _, c, _ in stages[:-1]) and set(columns) < set(stages[-1][1])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2][2])


def test_quality_stage(spark, stages):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    teaching = remainder("doc_id", 3) != 1
    model = quality.fit(docs.filter(teaching), labels.filter(teaching & (labels.quality == 1)))
    import numpy as np

    kept = {r["doc_id"] for r in docs.collect() if model.score(np.array([quality.features(r["text"])]))[0] >= 0.5}
    assert {r["doc_id"] for r in stages[0][2]} == kept


def test_near_copy_stage(stages):
    rows = texts(stages[0][2])
    prints = {k: simhash.fingerprint(t) for k, t in rows.items()}
    group = {k: k for k in rows}
    changed = True
    while changed:
        changed = False
        for a in rows:
            for b in rows:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and group[b] > group[a]:
                    group[b], changed = group[a], True
    assert texts(stages[1][2]) == {k: t for k, t in rows.items() if group[k] == k}


def test_repeated_passage_stage(stages):
    rows, seen, want = texts(stages[1][2]), {}, {}
    for key, text in sorted(rows.items()):
        data = text.encode()
        marks = bytearray(len(data))
        for i in range(len(data) - suffix_dedup.LENGTH + 1):
            h = hashlib.md5(data[i : i + suffix_dedup.LENGTH]).digest()
            if seen.setdefault(h, (key, i)) != (key, i):
                marks[i : i + suffix_dedup.LENGTH] = b"\1" * suffix_dedup.LENGTH
        want[key] = bytes(b for b, m in zip(data, marks, strict=True) if not m).decode("utf-8", "ignore")
    assert texts(stages[2][2]) == want


def test_decontamination_stage(spark, stages):
    windows = decontamination.Windows.of([(str(r["item_id"]), decontamination.words_of(r["text"])) for r in table(spark, SF, "benchmark").collect()], 10)
    rows = texts(stages[2][2])
    plain = {" ".join(w[i : i + n]) for r in table(spark, SF, "benchmark").collect() if (w := decontamination.words_of(r["text"])) for n in [min(10, len(w))] for i in range(len(w) - n + 1)}
    clean = {k: t for k, t in rows.items() if not any(f" {w} " in f" {' '.join(decontamination.words_of(t))} " for w in plain)}
    assert texts(stages[3][2]) == clean == {k: t for k, t in rows.items() if not windows.find(decontamination.words_of(t))[0].any()}


def test_sentencepiece_stage(stages):
    vocabulary = sentencepiece_sampling.Vocabulary.load(P.PIECES)
    parts = sentencepiece_sampling.piece_bytes(vocabulary)
    assert texts(stages[4][2]) == texts(stages[3][2])
    assert all(sentencepiece_sampling.decode(vocabulary, r["pieces"], parts) == r["text"] and r["n_pieces"] == len(r["pieces"]) for r in stages[4][2])


def test_run(spark, stages):
    assert sorted(r["doc_id"] for r in P.run(spark, SF).select("doc_id").collect()) == [r["doc_id"] for r in stages[4][2]]


def test_odd_documents(spark, tmp_path):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (900_001, "", "en", "s", 0), (900_001, "", "en", "s", 0), (900_002, "word " * 50_000, None, None, 250_000)], docs.schema)
    rows, before = docs.limit(20).union(odd), None
    for name, stage in P.STAGES:
        rows = P.stored(stage(spark, rows, SF))
        now = [r.asDict() for r in rows.collect()]
        assert {"doc_id", "text", "lang", "source", "n_chars"} <= set(rows.columns)
        if before is not None:  # nothing appears, and what stays keeps its columns
            known = Counter((r["doc_id"], r["lang"], r["source"]) for r in before)
            assert not Counter((r["doc_id"], r["lang"], r["source"]) for r in now) - known, name
        if name == "simhash_near_dedup":
            assert sum(not (r["text"] or "").split() for r in now) <= 1  # null and empty texts are one group
            assert len({r["doc_id"] for r in now}) == len(now)
        if name == "sentencepiece":
            texts_before = {r["doc_id"]: r["text"] for r in before}
            assert all(r["text"] == texts_before[r["doc_id"]] for r in now)
            assert all((r["pieces"] is None) == (r["text"] is None) for r in now)
        before = now
    assert len(before) > 5
    empty = docs.filter("false")
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0
