import math
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from evenhand.llm import sentencepiece_sampling as S

PATH = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def vocabulary():
    return S.Vocabulary.load(PATH)


def segmentations(v, ids, word):
    if not word:
        yield (), 0.0
    for j in range(1, len(word) + 1):
        if (k := ids.get(word[:j])) is not None:
            for rest, weight in segmentations(v, ids, word[j:]):
                yield (k, *rest), weight + v.logs[k]


def test_samples_follow_the_lattice(vocabulary):
    v = vocabulary
    ids = {p: k for k, p in enumerate(v.pieces) if k > 258}
    ways = dict(segmentations(v, ids, "▁there"))
    total = sum(map(math.exp, ways.values()))
    lattices, n = S.Lattices(v, 1.0), 20_000
    drawn = Counter(tuple(x.tolist()) for x in S.sample(lattices, list(range(n)), ["there"] * n))
    assert set(drawn) <= set(ways)
    for ids_, weight in ways.items():
        p = math.exp(weight) / total
        assert abs(drawn[ids_] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
    sharp = S.sample(S.Lattices(v, 50.0), list(range(50)), ["there"] * 50)
    best = max(ways, key=ways.get)
    assert {tuple(x.tolist()) for x in sharp} == {best}


def test_lossless_and_reproducible(spark, vocabulary):
    texts = ["", " ", "  two  spaces ", "a\n\tb\r\n", "▁mark ▁▁ in▁it", "\0nul\0", "日本語 ünï 🎉🎉🎉", "x" * 5000, "the cat sat " * 20_000, None]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "null key"), (4, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'old' AS pieces")
    tokens = S.tokenized(df, vocabulary)
    got = tokens.withColumn("back", S.decoded(spark, F.col("pieces"), vocabulary)).collect()
    assert all(r["back"] == r["text"] for r in got) and [r["pieces"] for r in got if r["text"] is None] == [None]
    other = {(r["doc_id"], r["text"]): r["pieces"] for r in S.tokenized(df.repartition(5), vocabulary).collect()}
    assert all(other[r["doc_id"], r["text"]] == r["pieces"] for r in got)
    assert S.tokenized(df.filter("false"), vocabulary).collect() == []


def test_cache_does_not_change_draws(vocabulary, monkeypatch):
    texts = [" ".join(f"word{k}{j}" for j in range(30)) for k in range(40)]
    keys = list(range(40))
    want = [x.tolist() for x in S.sample(S.Lattices(vocabulary, 1.0), keys, texts)]
    monkeypatch.setattr(S, "CACHED", 50)
    monkeypatch.setattr(S, "CHUNK", 100)
    assert [x.tolist() for x in S.sample(S.Lattices(vocabulary, 1.0), keys, texts)] == want


def whole_word_draws(vocabulary, key, word):
    """Ids of one word, its whole lattice filtered from its start and sampled place by place."""
    v, text = vocabulary, S.MARK + word
    ids = {p: k for k, p in enumerate(v.pieces) if k > 258 and S.MARK not in p[1:]}
    longest, ways, edges = max(map(len, ids)), [0.0], [[]]
    for end in range(1, len(text) + 1):
        found = []
        for back in reversed(range(max(0, end - longest), end)):  # edges are drawn from the shortest on
            part = text[back:end]
            if part in ids and (back == 0 or S.MARK not in part):
                found.append((back, (ids[part],), ways[back] + v.logs[ids[part]]))
        last = text[end - 1]
        if last not in ids or (end > 1 and last == S.MARK):
            spelled = tuple(v.bytes[b] for b in last.encode())
            found.append((end - 1, spelled, ways[end - 1] + len(spelled) * v.logs[v.bytes[0]]))
        top = max(w for _, _, w in found)
        ways.append(top + math.log(sum(math.exp(w - top) for _, _, w in found)))
        edges.append(found)
    out, at = [], len(text)
    while at:
        u = float(S.uniform(S.np.array([key], S.np.uint64), S.np.array([at]))[0])
        total = 0.0
        for back, piece, weight in edges[at]:
            total += math.exp(weight - ways[at])
            if total > u:
                break
        out[:0], at = piece, back
    return out


@pytest.mark.parametrize("letters", ["的一是不了人我在有他", "abcdefgh", "ab的一▁", "x", "日本語ünï🎉"])
def test_parts_draw_what_the_whole_lattice_draws(vocabulary, letters):
    r = random.Random(letters)
    words = ["".join(r.choice(letters) for _ in range(n)) for n in (0, 1, 31, 32, 33, 63, 64, 65, 100, 333)]
    got = S.sample(S.Lattices(vocabulary, 1.0), list(range(len(words))), words)
    assert [x.tolist() for x in got] == [whole_word_draws(vocabulary, k, w) for k, w in enumerate(words)]


def test_texts_without_spaces_take_few_steps(vocabulary):
    text = "".join(random.Random(0).choices("的一是不了人我在有他这为之大来以个中上们", k=200_000))
    lattices, start = S.Lattices(vocabulary, 1.0), time.perf_counter()
    (ids,) = S.sample(lattices, [1], [text])
    assert time.perf_counter() - start < 5 and S.decode(vocabulary, ids, S.piece_bytes(vocabulary)) == text
    assert int((lattices.high - lattices.low).max()) < 3 * S.PART
