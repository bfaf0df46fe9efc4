"""Fingerprints and scores of the given texts against plain loops that follow each method's definition."""

import math
import re
import string

import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from evenhand.llm import fingerprints, language_id, quality, toxicity
from evenhand.llm.common import remainder, table

SF = "/root/testdata/sf0.01"
ODD = [(-1, None), (-2, ""), (-3, " \n"), (-4, "one"), (-5, "a b c d e f"), (-6, "Ünï 日本 ½ x_y\0z\n\n- 1,2"), (-7, "idiot Idiots scum " * 5000)]


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def texts(spark, documents):
    """The given texts of every kind that the plain loops can take in time, and odd ones."""
    some = documents.filter(remainder("doc_id", 8) == 5).select("doc_id", "text")
    return some.unionByName(spark.createDataFrame(ODD, "doc_id long, text string")).cache()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(numbers):
    h = 42
    for x in numbers:
        h = xxhash.xxh64_intdigest((x & (1 << 64) - 1).to_bytes(8, "little"), h)
    return signed(h)


def fingerprint(text):
    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    if not words:
        return ""
    shingles = [chained(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
    bins = {}
    for h in shingles:
        rank = h & (1 << 56) - 1
        bins[(h >> 56) + 128] = min(rank, bins.get((h >> 56) + 128, rank))
    out = []
    for i in range(256):
        h = xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 42) & 0xFFFFFFFF
        probes = (i, *((h + j * (h >> 8 | 1)) % 256 for j in range(256)))
        out.append(bins[next(p for p in probes if p in bins)] & 255)
    return bytes(out).hex()


def test_fingerprints(texts):
    got = fingerprints.fingerprinted(texts).collect()
    assert len(got) > 100 and [r["fingerprint"] for r in got] == [fingerprint(r["text"]) for r in got]


def test_languages(documents, texts):
    contents = language_id.train(documents.filter(remainder("doc_id", 4) != 2))
    names = sorted(contents)
    got = {r["doc_id"]: r for r in language_id.identify(texts, contents).collect()}
    for row in texts.collect():
        found = got[row["doc_id"]]
        words = "".join(c if c.isalpha() else " " for c in (row["text"] or "").lower()).split()
        if not words:
            assert (found["lang_pred"], found["score"]) == ("und", 0.0)
            continue
        spaced = f" {' '.join(words)} "
        sizes = []
        for name in names:
            known = zstandard.ZstdCompressionDict(contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=6)
            packer = zstandard.ZstdCompressor(level=6, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(packer.compress(spaced[i : i + 1000].encode())) for i in range(0, len(spaced), 1000)))
        low, second = sorted(sizes)[:2]
        assert found["lang_pred"] == names[sizes.index(low)] and found["rejected"] == ((second - low) / low < 0.01)
        assert math.isclose(found["score"], 1 / sum(math.exp((low - x) / 3) for x in sizes), rel_tol=1e-9)


def test_severities(spark, documents, texts):
    model = toxicity.fit(documents, table(spark, SF, "labels"))
    assert model is not None and list(model.thresholds) == sorted(model.thresholds)
    got = {r["doc_id"]: r for r in toxicity.grade(texts, model).collect()}
    for row in texts.collect():
        counts = {}
        for word in toxicity._word.findall((row["text"] or "").lower()):
            for f in (word, *(word[:k] + "-" for k in model.beginnings if len(word) > k)):
                counts[f] = counts.get(f, 0) + 1
        score = sum(model.weights[model.vocabulary[f]] * math.log1p(n) for f, n in counts.items() if f in model.vocabulary)
        # the expected grade is the sum over thresholds of the chance to lie above each
        above = [1 / (1 + math.exp(min(500, t - score))) for t in model.thresholds]
        found = got[row["doc_id"]]
        assert math.isclose(found["severity"], sum(above), abs_tol=1e-9) and math.isclose(found["toxic_chance"], above[0], abs_tol=1e-9)
        assert found["toxic"] == (found["toxic_chance"] >= 0.5)


def numbers_of(text):
    if not text:
        return [0.0] * 13
    n, words = len(text.encode()), text.split()
    letters = sum(c in string.ascii_letters for c in text)
    beyond = sum(len(c.encode()) for c in text if ord(c) > 127)
    symbols = sum(not quality._PLAIN[b] for b in text.encode())
    lines = [x for x in text.split("\n") if x]
    many = max(1, len(words))
    most = max((words.count(w) for w in set(words)), default=0)
    return [
        math.log1p(n), sum(c in string.ascii_uppercase for c in text) / max(1, letters), sum(c in string.digits for c in text) / n,
        symbols / n, symbols / many, (text.count(",") + text.count(".")) / many, sum(a == b for a, b in zip(words, words[1:])) / many,
        math.log(many / max(1, len(set(words)))) - 0.35 * math.log(many), most / many if len(words) >= 8 else 0.0, math.log1p(n / many),
        1 - len(set(lines)) / max(1, len(lines)), beyond / n, text.count("\n") / many,
    ]


def test_quality_scores(spark, documents, texts):
    model = quality.fit(documents, table(spark, SF, "labels").filter("quality = 1"))
    got = {r["doc_id"]: r for r in quality.classify(texts, model).collect()}
    for row in texts.filter(F.length(F.coalesce("text", F.lit(""))) < 20_000).collect():
        z = [min(6.0, max(-6.0, (x - m) / s)) for x, m, s in zip(numbers_of(row["text"]), model.center, model.scale)]
        inputs = z + [max(x - 1, 0) for x in z] + [max(-x - 1, 0) for x in z]
        score = 1 / (1 + math.exp(-sum(a * b for a, b in zip(inputs, model.weights)) - model.bias))
        found = got[row["doc_id"]]
        assert math.isclose(found["score"], score, abs_tol=1e-9) and found["predicted"] == (found["score"] >= 0.5)


def test_risk_of_positive_unlabelled():
    """The fit lowers the non-negative risk: no small step in any direction lowers it further by much."""
    r = quality.np.random.default_rng(3)
    p, u = r.normal(0, 1, (600, 13)), quality.np.vstack([r.normal(0, 1, (300, 13)), r.normal(3, 1, (300, 13))])
    model = quality.fit_arrays(p, u)

    def risk(weights, bias):
        def f(x):
            z = quality.np.clip((x - model.center) / model.scale, -model.clip, model.clip)
            return quality.expanded(z) @ weights + bias
        loss = lambda y: quality.np.logaddexp(0, -y).mean()
        decay = quality.Settings().decay / 600 / 2 * ((weights**2).sum() + bias**2)
        return model.prior * loss(f(p)) + max(0.0, loss(-f(u)) - model.prior * loss(-f(p))) + decay

    best = risk(model.weights, model.bias)
    assert best < risk(0 * model.weights, 0.0)
    for _ in range(50):
        step = r.normal(0, 0.3, len(model.weights))
        assert risk(model.weights + step, model.bias + r.normal(0, 0.3)) > best - 1e-3
