"""Inputs the queries share, each in a Spark form and an SQL form.

The tables are invented prose in which most lexicon terms never occur, so detection
queries run over a carrier corpus: every document with one of the phrases below appended,
chosen by ``doc_id``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand import lexicons as L
from evenhand.functions.matching import literal_array
from evenhand.sources.texts import spread

PHRASES = [
    "The man is an engineer and he should be a strong leader.",
    "The woman was a nurse, she is emotional and weak.",
    "Only men can be a pilot; women cannot.",
    "Mr. Smith said he knows Mary Jones himself.",
    "Black people are aggressive, white people are smart.",
    "All women are hysterical and no man should ever hire her.",
    "The muslim man was lazy, the Christian church helped him.",
    "Y'all ain't gonna say dat, that is wrong and bad grammar; the correct way is standard English.",
    "Yeah I mean it is really super cool like whatever, but unprofessional.",
    "English is better and you have a foreign accent and poor English.",
    "The chairman of mankind needs manpower and a policeman.",
    "An elderly teacher, a young programmer and a poor librarian never met.",
    "Old people should not drive. Asian drivers are not suitable, except asian ones.",
    "Only women and only men, a typical woman; all blacks, typical asian.",
    "Damn, what the hell is this crap? Hell no.",
    "The African-American doctor and the South Asian nurse were intelligent and capable.",
    "They said their non-binary kid is disabled and deaf, always irrational.",
    "The algorithm and the framework need an architecture, methodology and optimization. Great!",
    "A good, nice, fine and okay day; bad weather, though great and awesome.",
    "The Mexican secretary and the Latina receptionist are incompetent.",
    "The gentleman asked sir John about the Bible, prayer and the temple.",
    "Mail bob.stone@example.org or call (555) 123-4567, ssn 123-45-6789, http://x.org/a?b=1#c now.",
    "The wee lassie cannae ken; whilst quite proper, crikey mate, reckon yonder.",
    "A wealthy Hindu surgeon; a homeless jewish soldier, both stupid. Card 4111 1111 1111 1111.",
    "Competent, ambitious, rational, logical women.",
    "Furthermore, therefore I would like to say the broken English is a language barrier.",
    "She is technical and caring, a successful mother; his wife is irrational, he is rational.",
    "The young are lazy, the old are smart; Chinese and Japanese and Korean, all emotional.",
    "Blind Catholic mechanic from 10.0.0.1, depression and anxiety, weak.",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; ``spark.evenhand.spread`` in the session's settings deals them out to so many
    partitions, as bench and tests do, whose tables are one split each."""
    parts = spark.conf.get("spark.evenhand.spread", None)
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"),
                  int(parts) if parts else None)


def gamma_tail_sql(x: str, dof: str) -> str:
    """P(X >= x) of a chi-square variable in SQL: one less the positive series of the lower
    incomplete gamma function, its terms taken in logarithms."""
    a, half = f"({dof}) / 2e0", f"({x}) / 2e0"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 0 THEN 1e0 ELSE greatest(0e0, 1e0 - "
            f"list_sum(list_transform(range(0, 2000 + 4 * ({half})::BIGINT), lambda i: exp("
            f"({a} + i) * ln({half}) - {half} - lgamma({a} + i + 1))))) END")


def carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a phrase appended; ``lang`` is the language column."""
    phrases = literal_array(PHRASES)
    return documents(spark, sf_dir).select(
        "doc_id",
        F.concat("text", F.lit(" "),
                 F.get(phrases, (F.col("doc_id") % len(PHRASES)).cast("int"))).alias("text"),
        F.col("lang").alias("language"), "source",
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn that follows it, phrase appended to the output."""
    from pyspark.sql import Window

    turns = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.col("text").alias("prompt"),
        F.lead("text").over(turns).alias("reply"), F.lead("role").over(turns).alias("reply_role"),
    ).where("role = 'user' AND reply_role = 'assistant'")
    phrases = literal_array(PHRASES)
    return rows.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "prompt",
        F.concat("reply", F.lit(" "), F.get(
            phrases, ((F.col("conv_id") + F.col("turn")) % len(PHRASES)).cast("int"))
        ).alias("output"),
        F.lit("en").alias("language"),
    )


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder for a query that writes and reads back: below the shared checkpoint
    folder, else below the session's warehouse, which all machines share as well."""
    shared = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.conf.get("spark.sql.warehouse.dir", None))
    if not shared:
        raise ValueError("set spark.checkpoint.dir or spark.sql.warehouse.dir to a shared folder")
    return f"{shared.rstrip('/')}/evenhand-{uuid.uuid4().hex}"


# -- SQL text helpers -------------------------------------------------------


def quote(value) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


def sql_values(rows) -> str:
    return "(VALUES " + ", ".join(
        "(" + ", ".join(v if isinstance(v, _Raw) else quote(v) for v in row) + ")"
        for row in rows) + ")"


class _Raw(str):
    """SQL text that goes in unquoted."""


def raw(value) -> _Raw:
    return _Raw(value)


W = r"[\p{L}\p{N}_]"
NW = r"[^\p{L}\p{N}_]"

CARRIER = (
    "carrier AS (SELECT doc_id, text || ' ' || "
    f"({sql_list(PHRASES)})[(doc_id % {len(PHRASES)}) + 1] AS text, "
    "lang AS language, source FROM documents)"
)

PAIRS = f"""
turns AS (SELECT conv_id, turn, role, text AS prompt,
    lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS reply,
    lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS reply_role FROM conversations),
pairs AS (SELECT conv_id * 1000 + turn AS doc_id, prompt,
    reply || ' ' || ({sql_list(PHRASES)})[((conv_id + turn) % {len(PHRASES)}) + 1] AS output,
    'en' AS language FROM turns WHERE role = 'user' AND reply_role = 'assistant')"""


def demographic_rows():
    return [(gt, gn, term) for gt, groups in L.DEMOGRAPHIC_GROUPS.items()
            for gn, terms in groups.items() for term in terms]
