"""Quotation linking: quoted passages of messages are joined to the messages they come from.

Lines that begin with ">" are quotes; the number of marks is their level. Lines of one level that
stand together are a passage, whatever their breaks: a mail program may have wrapped them anew.
Case and white space are normalised, and a passage is cut into windows of eight words, each
hashed; a shorter passage of three words or more is one window of its own length, and a still
shorter one has to be a whole line or passage of the original. What messages say themselves is
cut into windows of the lengths that their conversation's quotes need, in conversations that quote at
all. A window's original is the latest earlier message of its conversation that says it; a message
answers the one from which its first-level quotes take most characters. Without the
quotes, messages are ordered by reply: threads by their first message, within a thread by
turn, so that each message stands after the one it answers.

DataFrame functions only. Lookups are made in blocks of turns, so that a conversation with very
many messages or a window that very many quote spreads over tasks. Positions come from one range
partitioning by conversation, thread, turn and hash, in which no key has to stay together. No
conversation is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evenhand.llm.common import stored

BLOCK = 1024  # turns that are looked at together
WINDOW = 8  # words of a window
LEAST = 3  # words of a passage that may be a part of a line

# How mail programs of four languages introduce a quote.
INTRODUCES = r"^\s*(?:On|Am|Le|El)\s.*(?:wrote|schrieb.*|a écrit|escribió)\s*:\s*$"
MARKS = r"^(?:[ \t]*>)+"


def lines_of(text: Column) -> Column:
    """Lines as structs of level (0: the message's own) and body without quote marks; empty for null."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n")
    level = lambda x: F.length(F.translate(F.regexp_extract(x, MARKS, 0), " \t", ""))
    return F.transform(lines, lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, MARKS + "[ \t]?", "").alias("body")))


def own_text(text: Column, lines: Column) -> Column:
    """The text without quoted lines and the lines that introduce them, as it is where it quotes nothing; null for null."""
    own = F.filter(lines, lambda x, i: (x["level"] == 0) & ~(x["body"].rlike(INTRODUCES) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)))
    kept = F.array_join(F.transform(own, lambda x: x["body"]), "\n")
    tidy = F.regexp_replace(F.regexp_replace(kept, "\n{3,}", "\n\n"), r"^\s+|\s+$", "")
    return F.when(text.isNull() | ~F.exists(lines, lambda x: x["level"] > 0), text).otherwise(tidy)


def normalised(body: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(body, r"\s+", " ")))


def passages_of(lines: Column) -> Column:
    """Passages as structs of level, words and size: neighbouring lines of one level, joined; those without a word are left out."""
    at = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]))

    def passage(starts: Column, start: Column, n: Column) -> Column:
        stop = F.coalesce(F.get(starts, n + 1), F.size(lines))
        text = normalised(F.array_join(F.transform(F.sequence(start, stop - 1), lambda i: F.get(lines, i)["body"]), " "))
        return F.struct(F.get(lines, start)["level"].alias("level"), F.split(text, " ").alias("words"), F.length(text).alias("size"))

    # named once: a lambda would compute what stands in it again for each element
    every = F.transform(F.array(at), lambda starts: F.transform(starts, lambda start, n: passage(starts, start, n)))[0]
    return F.filter(every, lambda p: p["size"] > 0)


def _hashed(kind: Column, text: Column) -> list[Column]:
    return [F.xxhash64(kind, text).alias("h1"), F.xxhash64(kind, F.lit(1), text).alias("h2")]


def _windows(words: Column, n: Column) -> Column:
    """Hashes of all windows of n words; kind 0 stands for a whole short text. Words are taken one by one, as a slice copies all."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.concat_ws(" ", *[F.when(F.lit(k) < n, F.get(words, i + k)) for k in range(WINDOW)])
    return F.transform(starts, lambda i: F.struct(*_hashed(n, window(i))))


def _quoted_windows(passage: Column) -> Column:
    """The hashes of a quoted passage, each with its share of the passage's characters."""
    words, n = passage["words"], F.size(passage["words"])
    whole = F.array(F.struct(*_hashed(F.lit(0), F.array_join(words, " "))))
    cut = F.when(n < LEAST, whole).otherwise(_windows(words, F.least(n, F.lit(WINDOW))))
    count = F.when(n < LEAST, 1).otherwise(n - F.least(n, F.lit(WINDOW)) + 1)
    return F.transform(cut, lambda h: F.struct(h["h1"].alias("h1"), h["h2"].alias("h2"), (passage["size"] / count).alias("size")))


def _originals(quoted: DataFrame, own: DataFrame) -> DataFrame:
    """conv, hash, turn and original (the latest earlier turn that says the window) of quoted windows that have one."""
    asked = quoted.groupBy("conv", "h1", "h2", "turn").agg(F.lit(False).alias("says"))
    wanted = asked.select("conv", "h1", "h2").distinct()
    said = own.join(wanted, ["conv", "h1", "h2"], "left_semi").groupBy("conv", "h1", "h2", "turn").agg(F.lit(True).alias("says"))
    events = asked.unionByName(said).groupBy("conv", "h1", "h2", "turn").agg(F.max("says").alias("says"), F.min("says").alias("only_says"))
    events = events.withColumn("block", F.floor(F.col("turn") / BLOCK))
    line = ["conv", "h1", "h2"]
    before = Window.partitionBy(*line, "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    near = events.withColumn("near", F.max(F.when(F.col("says"), F.col("turn"))).over(before)).filter("NOT only_says")
    latest = events.groupBy(*line, "block").agg(F.max(F.when(F.col("says"), F.col("turn"))).alias("latest"))
    blocks = Window.partitionBy(*line).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    latest = latest.withColumn("far", F.max("latest").over(blocks)).select(*line, "block", "far")
    found = near.join(latest, [*line, "block"]).withColumn("original", F.coalesce("near", "far"))
    return found.filter("original IS NOT NULL").select(*line, "turn", "original")


def _threads(answers: DataFrame) -> DataFrame:
    """conv, turn, thread (the first turn reached by going from answer to original) and depth, of answers; the way doubles at each step."""
    at = answers.groupBy("conv", "turn").agg(F.max("original").alias("thread")).withColumn("depth", F.lit(1).cast("long"))
    at = stored(at)
    while True:
        up = at.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("_thread"), F.col("depth").alias("_depth"))
        if at.join(up, ["conv", "thread"], "left_semi").isEmpty():
            return at
        at = stored(at.join(up, ["conv", "thread"], "left").select("conv", "turn", F.coalesce("_thread", "thread").alias("thread"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")))


def _positions(rows: DataFrame) -> DataFrame:
    """`rows` with position, the rank by (thread, turn, id) within conv.

    Rows are dealt out by ranges of all of these and a number of their own, so that equal ones too may
    stand in several parts; a row's rank is the number of rows in earlier parts and before it in its
    own. Of the parts only their sizes are broadcast.
    """
    order = ["conv", "thread", "turn", "id"]
    spread = rows.withColumn("_own", F.xxhash64("id", F.monotonically_increasing_id())).repartitionByRange(*[F.col(c).asc_nulls_first() for c in order], "_own")
    sorted_ = stored(spread.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order], "_own").withColumn("_at", F.monotonically_increasing_id()).drop("_own"))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted_.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = sorted_.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("_rank", F.col("_before") + place)
    firsts = ranked.groupBy("conv").agg(F.min("_rank").alias("_first")).withColumnRenamed("conv", "_c")
    return ranked.join(firsts, F.col("conv").eqNullSafe(F.col("_c"))).withColumn("position", F.col("_rank") - F.col("_first") + 1).drop("_at", "_part", "_before", "_rank", "_c", "_first")


def linked(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text (without quotes) and chat (the message as a JSON line) of each message, with n_quoted (quoted lines), n_passages (quoted passages), n_linked (those with a window whose original is known), deepest (level), reply_to, thread and depth, and position in its conversation, from 1.

    A null or empty text has no lines and stays as it is. Rows with a null conversation or
    turn are never linked; null turns come first. Of messages with one turn each can be
    answered, as that turn. Where two messages are quoted equally much, the later is answered.
    Messages that answer none begin a thread of their own. Repeated rows each get the same
    links and positions of their own; an empty table gives an empty one; other columns take
    no part.
    """
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    rows = rows.withColumns({"id": F.xxhash64("role", "text"), "lines": lines_of(F.col("text"))})
    quotes = F.filter("lines", lambda x: (x["level"] > 0) & (normalised(x["body"]) != ""))
    known = rows.filter("conv IS NOT NULL AND turn IS NOT NULL")
    # only texts with a mark are cut into passages, and below only conversations that quote
    marked = known.filter(F.col("text").contains(">")).withColumn("passages", passages_of(F.col("lines")))
    asking = marked.select("conv", "turn", "id", F.posexplode(F.filter("passages", lambda p: p["level"] > 0)).alias("passage", "p"))
    # a repeated row's passages count once
    asking = asking.withColumns({"level": F.col("p.level"), "n": F.size("p.words")}).dropDuplicates(["conv", "turn", "id", "passage"])
    quoted = asking.select("conv", "turn", "id", "passage", "level", F.inline(_quoted_windows(F.col("p"))))
    # the lengths of windows that a conversation's quotes need: at most WINDOW - LEAST + 2
    length = F.when(F.col("n") < LEAST, 0).otherwise(F.least("n", F.lit(WINDOW)))
    needed = asking.groupBy("conv").agg(F.collect_set(length).alias("lengths"))
    saying = known.select("conv", "turn", "text").join(needed, "conv").withColumn("lines", lines_of(F.col("text")))
    saying = saying.withColumn("passages", passages_of(F.col("lines"))).select("conv", "turn", "lengths", F.filter("passages", lambda p: p["level"] == 0).alias("own"), F.filter("lines", lambda x: x["level"] == 0).alias("own_lines"))
    short = F.transform(F.concat(F.transform("own_lines", lambda x: normalised(x["body"])), F.transform("own", lambda p: F.array_join(p["words"], " "))), lambda t: F.struct(*_hashed(F.lit(0), t)))
    said = F.flatten(F.transform("lengths", lambda n: F.when(n == 0, short).otherwise(F.flatten(F.transform("own", lambda p: _windows(p["words"], n))))))
    own = saying.select("conv", "turn", F.inline(said))
    originals = _originals(quoted, own)
    matched = stored(quoted.join(originals, ["conv", "h1", "h2", "turn"]))
    counts = matched.groupBy("conv", "turn", "id").agg(F.countDistinct("passage").alias("n_linked"))
    votes = matched.groupBy("conv", "turn", "id", "level", "original").agg(F.round(F.sum("size"), 6).alias("size"))
    answers = votes.groupBy("conv", "turn", "id").agg(F.max(F.struct(-F.col("level"), "size", "original"))["original"].alias("original"))
    threads = _threads(answers)
    named = answers.join(threads, ["conv", "turn"]).join(counts, ["conv", "turn", "id"])
    named = named.select(F.col("conv").alias("_c"), F.col("turn").alias("_t"), F.col("id").alias("_i"), F.col("original").alias("reply_to"), "thread", "depth", "n_linked")
    rows = rows.join(named, (F.col("conv") == F.col("_c")) & (F.col("turn") == F.col("_t")) & (F.col("id") == F.col("_i")), "left")
    rows = rows.select(
        "conv", "turn", "id", "role", own_text(F.col("text"), F.col("lines")).alias("text"), F.size(quotes).cast("long").alias("n_quoted"), F.when(F.col("text").contains(">"), F.size(F.filter(passages_of(F.col("lines")), lambda p: p["level"] > 0))).otherwise(0).cast("long").alias("n_passages"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0)).alias("deepest"),
        "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))
    rows = _positions(rows).withColumn("chat", F.to_json(F.struct("role", F.col("text").alias("content")), {"ignoreNullFields": "false"}))
    return rows.select(F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), F.col("text").alias(text), "chat", "n_quoted", "n_passages", "n_linked", "deepest", "reply_to", "thread", "depth", "position")
