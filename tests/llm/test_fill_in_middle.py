import random

import pytest
from pyspark.sql import functions as F

from evenhand.llm import fill_in_middle as M

ALPHABET = "aB \n<>PSMé߿ࠀ日￿🙂\U0010ffff\x00\x7f"


def plain_transform(key, text, settings):
    """By code points and str slices."""
    text = text or ""
    units = list(text) if settings.unit == "character" else [x for x in text.split("\n")]
    if settings.unit == "line":
        units = [u + "\n" for u in units[:-1]] + ([units[-1]] if units[-1] else [])
    n = len(units)
    h = M.draws(key, settings.seed)
    if not text or h[2] % 100 >= settings.transformed or any(m in text for m in settings.marks):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    p, s, m = settings.marks
    if h[3] % 100 < settings.suffix_first:
        return n, "spm", a, b - a, s + suf + p + pre + m + mid
    return n, "psm", a, b - a, p + pre + s + suf + m + mid


@pytest.mark.parametrize("unit", M.UNITS)
def test_against_slices(unit):
    rng = random.Random(5)
    settings = M.Settings(unit=unit)
    for k in range(3000):
        text = "".join(rng.choices(ALPHABET, k=rng.randrange(40)))
        assert M.transform(str(k), text, settings) == plain_transform(str(k), text, settings), (k, text)


def test_every_cut():
    for text in ("", "a", "é" * 8, "🙂" * 9, "aé日🙂" * 7, "x" * 64, "\n\n\n", "a\nb"):
        data = text.encode()
        cuts = M.Cuts(data)
        assert cuts.count == len(text)
        assert [data[: cuts.after(k)].decode() for k in range(len(text) + 1)] == [text[:k] for k in range(len(text) + 1)]
        lines = M.Cuts(data, "line")
        assert [data[: lines.after(k)].decode() for k in range(lines.count + 1)] == ["".join(text.splitlines(True)[:k]) for k in range(lines.count + 1)]


def test_select_in_word():
    for mask in range(256):
        marked = [k for k in range(8) if mask >> k & 1]
        word = sum(1 << 8 * k for k in marked)
        assert [M.select_in_word(word, r) for r in range(1, len(marked) + 1)] == marked


def test_draws_are_the_first_digits_of_the_hash():
    import hashlib

    digits = hashlib.sha256(b"1:42").hexdigest()
    assert M.draws("42") == [int(digits[:8], 16), int(digits[8:16], 16), int(digits[16:24], 16), int(digits[24:32], 16)]


def test_marks():
    for marks in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aba", "ab", "x"), ("ab", "bc", "x"), ("aa", "x", "y")):
        with pytest.raises(ValueError):
            M.Settings(marks=marks)
    assert M.transform("1", "has <S> inside", M.Settings())[1] == "plain"
    with pytest.raises(ValueError):
        M.Settings(unit="byte")


def test_round_trip_and_odd_rows(spark):
    rows = [(None, None, 1), (None, "abc", 1), (1, "", 1), (1, None, 2), (2, "x <M> y", 1)] + [(3, "same é text 🙂", 1)] * 2
    rows += [(k, "aé日🙂\n" * k, 1) for k in range(10, 60)] + [(99, "日本 " * 400_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fim int")
    made = M.transformed(df, out="FORM")
    assert made.columns == ["doc_id", "text", "fim", "FORM"]
    back = made.withColumn("back", M.restored(F.col("FORM.form"), F.col("FORM.output"))).collect()
    assert len(back) == len(rows)
    for r in back:
        assert r["back"] == (r["text"] or "")
        assert tuple(r["FORM"]) == plain_transform("" if r["doc_id"] is None else str(r["doc_id"]), r["text"], M.Settings())
    assert {r["FORM"]["form"] for r in back} == {"plain", "psm", "spm"}
    assert set(M.transformed(df, out="text").columns) == {"doc_id", "text", "fim"}
    assert M.transformed(df.filter("false")).collect() == []
