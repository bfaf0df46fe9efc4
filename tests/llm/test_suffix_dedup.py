import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from evenhand.llm import suffix_dedup


def brute(rows, length, keep):
    """n_bytes, n_removed, n_spans and sha256 of what is kept, for (key, text) rows; keep="first" by (key, place)."""
    places = defaultdict(list)
    for r, (key, text) in enumerate(rows):
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            places[data[i : i + length]].append((-1 if key is None else key, i, r))
    hit = [bytearray(len((t or "").encode())) for _, t in rows]
    for found in places.values():
        if len(found) > 1:
            first = min(found)[:2]
            for key, i, r in found:
                if keep == "none" or (key, i) != first:
                    hit[r][i : i + length] = b"\1" * length
    out = Counter()
    for (key, text), marks in zip(rows, hit, strict=True):
        data = (text or "").encode()
        kept = bytes(b for b, m in zip(data, marks, strict=True) if not m)
        spans = sum(m and not (k and marks[k - 1]) for k, m in enumerate(marks))
        out[(key, len(data), sum(marks), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(30) for _ in range(4)]
    rows = [(k, text(r.randint(0, 30)) + r.choice(shared) + text(r.randint(0, 20)) + r.choice(["", r.choice(shared)])) for k in range(60)]
    rows += [(100 + k, rows[k][1]) for k in range(5)] + [rows[7], (None, rows[8][1]), (None, None), (201, ""), (202, None), (203, "x")]
    rows += [(300, "Und " * 200), (301, "Und " * 90 + text(10) + " der" * 80), (302, "ab" * 300)]
    return rows


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [4096, 3])  # 3: nearly all anchors count as hot
def test_equals_brute_force(spark, keep, group):
    rows = corpus(group)
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, spot string, spans int")
    found = suffix_dedup.with_removed(df, "out", keep=keep, length=60, gram=20, group=group)
    assert found.columns == [*df.columns, "out"]
    got = Counter((r["doc_id"], *r["out"][:4]) for r in found.collect())
    assert got == brute(rows, 60, keep)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.deduplicated(df).collect() == []


def test_kept_text(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    df = spark.createDataFrame([(1, f"one {passage} end"), (2, f"two {passage} fin"), (3, None)], "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in suffix_dedup.deduplicated(df).collect()}
    # the spaces around the passage are part of what is repeated
    assert kept == {1: f"one {passage} end", 2: "twofin", 3: None}


def test_previous_smaller():
    r = random.Random(1)
    for _ in range(300):
        values = r.choices(range(9), k=r.randint(1, 40)) if r.random() < 0.5 else r.sample(range(99), r.randint(1, 60))
        want = [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(len(values))]
        if len(set(values)) == len(values):
            assert suffix_dedup.previous_smaller(np.array(values)).tolist() == want


def test_factor_lengths_against_brute_force():
    r = random.Random(2)
    for _ in range(150):
        length, size = r.choice([1, 2, 3, 7, 8, 13, 60]), r.randint(1, 90)
        data = r.choices(range(r.choice([1, 2, 4])), k=size) if r.random() < 0.6 else (r.choices(range(3), k=r.randint(1, 20)) * 90)[:size]
        for cut in sorted(r.sample(range(size), min(size, r.randint(0, 3)))):
            data[cut] = 300 + cut  # borders of segments
        data.append(999)
        factors, source = suffix_dedup.longest_previous_factors(np.array(data), length)
        for i in range(len(data)):
            def match(j):
                k = 0
                while k < length and i + k < len(data) and data[i + k] == data[j + k]:
                    k += 1
                return k
            assert factors[i] == max(map(match, range(i)), default=0)
            assert source[i] == -1 if factors[i] == 0 else match(int(source[i])) == factors[i]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_text_beyond_a_buffer(spark, keep):
    """Passages of a text of 1.3 MB that repeat far apart, in it and elsewhere, over the edges of its pieces."""
    r = random.Random(4)
    text = list("".join(r.choices("abcdefgh \n", k=1_300_000)))
    passage = "".join(r.choices("ijklmnop ", k=1000))
    for at in (5, suffix_dedup.BUFFER - 500, 2 * suffix_dedup.BUFFER - 3, 1_298_000):
        text[at : at + 1000] = passage
    rows = [(1, "".join(text)), (2, f"q{passage[100:900]}r"), (3, "".join(text[600_000:600_400]))]
    hit = {k: bytearray(len(t)) for k, t in rows}
    seen = {}
    for key, t in rows:
        data = t.encode()
        for i in range(len(data) - 199):
            seen.setdefault(hash(data[i : i + 200]), []).append((key, i))
    for places in seen.values():
        for key, i in places[1:] if keep == "first" else places if len(places) > 1 else []:
            hit[key][i : i + 200] = b"\1" * 200
    found = suffix_dedup.with_removed(spark.createDataFrame(rows, "doc_id long, text string"), "x", keep=keep)
    got = {r["doc_id"]: (r["x"]["n_removed"], r["x"]["kept"]) for r in found.collect()}
    assert got == {k: (sum(hit[k]), "".join(c for c, m in zip(t, hit[k], strict=True) if not m)) for k, t in rows}
