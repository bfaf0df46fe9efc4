import random
import re
from collections import Counter, defaultdict

from evenhand.llm import quotations


def build(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_links_levels_and_order(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nI have a list."),
        (1, 1, "user", "Unrelated question."),
        (1, 2, "assistant", "> How do I  SORT?\nUse sorted."),
        (1, 3, "user", "On Monday Bob wrote:\n> Use sorted.\n>> How do I sort?\n\nThanks!"),
        (1, 4, "assistant", "> Unrelated question.\nAnswer."),
        (1, 5, "user", "> never said\nHm."),
        (2, 0, "user", "> How do I sort?\nfrom another conversation"),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in quotations.linked(build(spark, rows)).collect()}
    assert [got[1, t]["reply_to"] for t in range(6)] == [None, None, 0, 2, 1, None]
    assert [got[1, t]["thread"] for t in range(6)] == [0, 1, 0, 0, 1, 5]
    assert [got[1, t]["depth"] for t in range(6)] == [0, 0, 1, 2, 1, 0]
    assert [got[1, t]["position"] for t in range(6)] == [1, 4, 2, 3, 5, 6]
    assert got[1, 3]["text"] == "Thanks!" and got[1, 3]["deepest"] == 2 and got[1, 3]["n_linked"] == 2
    assert got[1, 5]["n_quoted"] == 1 and got[1, 5]["n_linked"] == 0 and got[2, 0]["reply_to"] is None
    assert got[1, 2]["chat"] == '{"role":"assistant","content":"Use sorted."}'


SPEECH = "The committee met on Tuesday to discuss the new bridge over the river, and after two hours of talk it agreed to ask the engineers for a second opinion."


def test_quotes_that_were_wrapped_anew(spark):
    words = SPEECH.split()
    wrapped = "\n".join("> " + " ".join(words[k : k + 6]) for k in range(0, len(words), 6))
    rows = [
        (1, 0, "a", f"Hello.\n{SPEECH}\nBye."),
        (1, 1, "b", "Something else that nobody quotes, with as many words as it takes to have windows."),
        (1, 2, "c", f"{wrapped}\nAgreed."),  # broken elsewhere
        (1, 3, "d", "> it agreed to ask the engineers\nWhich ones?"),  # a part of a line, a short one
        (1, 4, "e", "> after two hours of talk it agreed to ask the engineers for a second\nLong."),  # half a line, with another comma
        (1, 5, "f", "> Agreed.\nFine."),  # too short to be a part: a whole line
        (1, 6, "g", "> two hours\nNo."),  # too short, and no line
        (1, 7, "h", "> Something else that nobody quotes, with as many words as\n>> committee met on tuesday TO discuss the\n\nBoth."),
        (2, 0, "a", f"> {SPEECH}\nElsewhere."),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in quotations.linked(build(spark, rows)).collect()}
    assert [got[1, t]["reply_to"] for t in range(8)] == [None, None, 0, 0, 0, 2, None, 1]
    assert [got[1, t]["n_linked"] for t in range(8)] == [0, 0, 1, 1, 1, 1, 0, 2]
    assert [got[1, t]["n_passages"] for t in range(8)] == [0, 0, 1, 1, 1, 1, 1, 2]
    assert got[1, 2]["n_quoted"] == -(-len(words) // 6) and got[2, 0]["reply_to"] is None
    assert got[1, 2]["text"] == "Agreed."


def brute(rows):
    """reply_to of each row, by looking for each window in all earlier messages."""
    def cut(text):
        found = []
        for line in (text or "").replace("\r\n", "\n").split("\n"):
            mark = re.match(r"(?:[ \t]*>)+[ \t]?", line)
            level = mark[0].count(">") if mark else 0
            body = line[mark.end():] if mark else line
            if found and found[-1][0] == level:
                found[-1][1].append(body)
            else:
                found.append((level, [body]))
        return [(level, " ".join(" ".join(b).split()).lower().split(), b) for level, b in found]

    out = []
    for conv, turn, _, text in rows:
        votes = defaultdict(Counter)
        for level, words, _ in cut(text):
            if not level or not words:
                continue
            n = len(words)
            k = 0 if n < 3 else min(n, 8)
            windows = [words] if not k else [words[i : i + k] for i in range(n - k + 1)]
            for w in windows:
                best = None
                for c, t, _, other in rows:
                    if c != conv or t is None or turn is None or t >= turn or (best is not None and t <= best):
                        continue
                    for lv, ws, bodies in cut(other):
                        if not lv and (any(ws[i : i + k] == w for i in range(len(ws) - k + 1)) if k else w == ws or any(" ".join(b.split()).lower().split() == w for b in bodies)):
                            best = t
                if best is not None:
                    votes[level][best] += len(" ".join(words)) / len(windows)
        if not votes or conv is None:
            out.append(None)
        else:
            first = votes[min(votes)]
            out.append(max(first, key=lambda t: (round(first[t], 6), t)))
    return out


def test_links_against_brute_force(spark):
    r = random.Random(6)
    vocabulary = "alpha beta gamma delta epsilon".split()
    rows = []
    for conv in range(12):
        said = []
        for turn in range(r.randint(2, 9)):
            own = [" ".join(r.choices(vocabulary, k=r.randint(0, 14))) for _ in range(r.randint(1, 3))]
            parts = list(own)
            for _ in range(r.randint(0, 2)):
                if said:
                    words = " ".join(r.choice(said)).split() or ["x"]
                    a = r.randrange(len(words))
                    words = words[a : a + r.randint(1, 20)]
                    size, marks = r.randint(1, 9), r.choice(["> ", ">", ">> "])
                    parts[r.randrange(len(parts) + 1):0] = [marks + " ".join(words[k : k + size]).upper() for k in range(0, len(words), size)]
            rows.append((conv, turn, "user", "\n".join(parts)))
            said.append(own)
    got = {(x["conv_id"], x["turn"]): x["reply_to"] for x in quotations.linked(build(spark, rows).repartition(5)).collect()}
    assert [got[c, t] for c, t, _, _ in rows] == brute(rows) and sum(v is not None for v in got.values()) > 15


def test_ties_long_texts_and_other_columns(spark):
    tie = [(1, 0, "a", "one two three four"), (1, 1, "a", "five six seven eigh"), (1, 2, "b", "> one two three four\n>> x\n> five six seven eigh\nok")]
    assert {r["turn"]: r["reply_to"] for r in quotations.linked(build(spark, tie)).collect()}[2] == 1
    long = "\n".join(f"line {k} of the long text {k * 7}" for k in range(20_000))
    rows = [(1, 0, "a", long), (1, 1, "b", "> " + long.replace("\n", "\n> ") + "\nread")]
    got = {r["turn"]: r for r in quotations.linked(build(spark, rows)).collect()}
    assert got[1]["reply_to"] == 0 and got[1]["n_quoted"] == 20_000 and got[1]["text"] == "read"
    df = build(spark, tie).selectExpr("*", "1 AS conv", "2 AS id", "3 AS lines", "4 AS position", "5 AS thread")
    assert quotations.linked(df).count() == 3


def test_equal_and_null_turns_in_number(spark):
    rows = [(1, None, "a", f"t{k}") for k in range(300)] + [(1, 5, "a", "same")] * 300 + [(None, 1, "b", "x")] * 50 + [(2, k, "a", "y") for k in range(40)]
    got = quotations.linked(build(spark, rows).repartition(6)).collect()
    for conv, n in ((1, 600), (None, 50), (2, 40)):
        assert sorted(r["position"] for r in got if r["conv_id"] == conv) == list(range(1, n + 1))
    assert {r["position"] for r in got if r["conv_id"] == 1 and r["turn"] is None} == set(range(1, 301))
    assert all(r["position"] == r["turn"] + 1 for r in got if r["conv_id"] == 2)


def test_native_plan(spark):
    plan = quotations.linked(build(spark, [(1, 0, "a", "b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan


def test_far_originals_and_blocks(spark):
    n = 2 * quotations.BLOCK + 10
    rows = [(7, 0, "user", "first line"), *[(7, t, "user", f"message {t}") for t in range(1, n)], (7, n, "user", "> first line\nyes"), (7, n + 1, "user", f"> message {n - 1}\nno")]
    got = {r["turn"]: r for r in quotations.linked(build(spark, rows)).collect()}
    assert got[n]["reply_to"] == 0 and got[n + 1]["reply_to"] == n - 1
    assert sorted(r["position"] for r in got.values()) == list(range(1, n + 3))
    assert got[n]["position"] == 2 and got[1]["position"] == 3


def test_nulls_repeats_and_empty_table(spark):
    rows = [(None, 0, "user", "a"), (1, None, "user", "a"), (1, 0, None, None), (1, 0, "user", ""), (1, 1, "user", "hello"), (1, 2, "user", "> hello\nhi"), (1, 2, "user", "> hello\nhi")]
    got = quotations.linked(build(spark, rows)).collect()
    assert len(got) == len(rows) and [r["reply_to"] for r in got if r["turn"] == 2] == [1, 1]
    assert sorted(r["position"] for r in got if r["conv_id"] == 1) == [1, 2, 3, 4, 5, 6]
    assert quotations.linked(build(spark, [])).collect() == []


def test_long_chain(spark):
    rows = [(1, 0, "user", "line 0"), *[(1, t, "user", f"> line {t - 1}\nline {t}") for t in range(1, 40)]]
    got = {r["turn"]: r for r in quotations.linked(build(spark, rows)).collect()}
    assert all(got[t]["depth"] == t and got[t]["thread"] == 0 and got[t]["position"] == t + 1 for t in range(40))
