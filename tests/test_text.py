import random
import re
from collections import Counter

from pyspark.sql import functions as F

from evenhand import lexicons as L
from evenhand.functions import matching as M
from evenhand.functions import text as T
from evenhand.operators import preparation as P
from evenhand.options import DetectOptions


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_clean_text(texts):
    df = texts("  a \t b\n c ", "see http://x.org/a?b=1#c now", "\x00 a\x07b", None,
               "a 　b", "x\x1cy")
    assert one(df, T.clean_text(F.col("text"))) == [
        "a b c", "see [URL]#c now", " ab", "", "a b", "x y"]


def test_anonymize(texts):
    df = texts("mail bob.x@a.org!", "call 555-123-4567 or +1 555 123 4567", "123-45-6789",
               "4111 1111 1111 1111", "from 10.0.0.1.", "é12345678901x", "a@b.c|m")
    assert one(df, T.anonymize(F.col("text"))) == [
        "mail [EMAIL]!", "call [PHONE] or +[PHONE]", "[SSN]", "[CREDIT_CARD]",
        "from [IP_ADDRESS].", "é12345678901x", "[EMAIL]"]


def test_anonymize_is_idempotent(texts):
    df = texts("bob@a.org 555-123-4567 10.1.1.1", "1234 5678 1234 5678 x")
    once = T.anonymize(F.col("text"))
    assert one(df, once) == one(df, T.anonymize(once))


def test_preprocess_cuts_after_anonymising(texts):
    df = P.preprocess(texts("abc a@bcd.org tail"), DetectOptions(max_text_length=6))
    assert one(df, "text") == ["abc [E"]


def test_profanity_counts_repeats(texts):
    assert one(texts("Damn, hell hello; DAMN"), T.profanity(F.col("text"))) == [
        ["damn", "hell", "damn"]]


def syllables_by_hand(text):
    total = 0
    for word in re.findall(r"\b\w+\b", text.lower()):
        runs = len(re.findall(r"[aeiouy]+", word))
        if word.endswith("e") and runs > 1:
            runs -= 1
        total += max(1, runs)
    return total


def test_syllables_match_word_by_word_counting(texts):
    rng = random.Random(1)
    values = ["", "the tree made here", "éclair cwm 123 rhythm queue eee ae"]
    values += ["".join(rng.choice("aeeybcdtré _1.-") for _ in range(80)) for _ in range(60)]
    assert one(texts(*values), T.syllables(F.col("text"))) == [
        syllables_by_hand(v) for v in values]


def test_readability(texts):
    rows = texts("The cat sat. It ran!", "no end", "", None).select(
        T.readability(F.col("text")).alias("r")).select("r.*").collect()
    assert rows[0]["avg_sentence_length"] == 2.5
    assert rows[0]["avg_syllables_per_word"] == 1.0
    assert rows[0]["flesch_score"] == 100.0 and rows[0]["flesch_grade"] == 0.0
    for row in rows[1:]:
        assert all(v == 0.0 for v in row)


def test_keywords_match_counter(texts):
    rng = random.Random(2)
    vocabulary = ["alpha", "beta", "gamma", "the", "of", "xy", "delta", "été", "word1"]
    values = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(10)] + ["", "the of"]
    got = {}
    for r in P.keywords(texts(*values), 4).collect():
        got.setdefault(r["doc_id"], []).append((r["keyword"], round(r["score"], 9)))
    for n, value in enumerate(values):
        words = re.findall(r"\w+", value.lower())
        kept = [(w, c) for w, c in Counter(words).items()
                if w not in L.STOP_WORDS and len(w) > 2]
        kept.sort(key=lambda x: -x[1])
        assert got.get(n, []) == [(w, round(c / len(words), 9)) for w, c in kept[:4]]


def test_language(texts):
    df = P.detect_language(texts("the cat and the dog of that house", "le chat et la maison dans",
                                 "der hund und die katze nicht", "short", "zzzz qqqq xxxx wwww"))
    assert one(df, "language") == ["en", "fr", "de", "en", "en"]
    shares = {r["language"]: r["texts"] for r in P.language_distribution(texts(
        "the cat and the dog of that house", "short", "zzzz qqqq xxxx wwww")).collect()}
    assert shares == {"en": 1, "unknown": 2}


TERMS = ["he", "her", "hers", "the", "south asian", "asian", "african", "african-american",
         "african-", "a.b", "e(r", "y'all", "all y'all"]


def random_texts():
    rng = random.Random(3)
    pieces = [*TERMS, " ", "-", "é", "x", ".", "axb", "_"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(150)]


def test_contained_terms_match_in(texts):
    values = random_texts()
    got = one(texts(*values), M.contained_terms(F.col("text"), TERMS))
    for value, found in zip(values, got, strict=True):
        assert sorted(found) == sorted(t for t in TERMS if t in value), value


def test_word_terms_match_word_boundaries(texts):
    terms = [t for t in TERMS if t != "african-"]
    values = random_texts()
    got = one(texts(*values), M.word_terms(F.col("text"), terms))
    for value, found in zip(values, got, strict=True):
        want = [t for t in terms
                if re.search(r"(?<!\w)" + re.escape(t) + r"(?!\w)", value)]
        assert sorted(found) == sorted(want), value


def test_severity_bounds(spark):
    df = spark.createDataFrame([(0.8,), (0.6,), (0.3,), (0.29,), (None,)], "s double")
    assert one(df, T.severity(F.col("s"))) == ["critical", "high", "medium", "low", None]
