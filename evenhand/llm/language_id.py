"""Language identification by compression.

Each language has a raw-content zstandard dictionary, a bounded sample of its training texts.
A text is compressed with every dictionary; the language that makes it smallest is chosen.
Where the two best are nearly equal the choice is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import bounded_sample, small_batches

UNDETERMINED = "und"
PREDICTED = "lang_pred string, score double, margin double, rejected boolean"
_gap = re.compile(r"[\W\d_]+")


@dataclass
class Settings:
    """rows and piece bound the training sample of a language: so many rows, so many characters of each; dictionary its bytes.

    block: characters compressed at once, so that a long text doesn't train itself; level: of zstandard;
    scale: bytes of difference that count as a factor of e in the score; margin: share of the
    smallest size below which a choice is rejected. Of a piece at most dictionary // rows taken bytes go
    into the dictionary, so that all sampled rows take part.
    """

    rows: int = 400
    piece: int = 1000
    dictionary: int = 50_000
    block: int = 1000
    level: int = 6
    scale: float = 3.0
    margin: float = 0.01


def letters(text: str) -> str:
    """Lower-case words, one space between and around; empty without a letter."""
    words = _gap.sub(" ", text.lower()).strip()
    if words and not words.replace(" ", "").isalpha():  # other numerals, such as fractions and circled digits
        words = " ".join("".join(c if c.isalpha() else " " for c in words).split())
    return f" {words} " if words else ""


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", settings: Settings | None = None) -> dict[str, bytes]:
    """A dictionary for each language from a bounded sample; rows with null text or language teach nothing.

    A piece starts at a place that depends on the row's key, so that sampled texts are not all openings.
    """
    s = settings or Settings()
    start = F.pmod(F.xxhash64("key"), F.greatest(F.lit(1), F.length("text") - s.piece + 1)).cast("int") + 1
    rows = df.select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text")).filter("text IS NOT NULL AND lang IS NOT NULL")
    taught: dict[str, list[str]] = {}
    for row in bounded_sample(rows, "lang", s.rows, "key").select("lang", F.substring("text", start, F.lit(s.piece)).alias("piece"), "key").orderBy("lang", "key", "piece").collect():
        taught.setdefault(row["lang"], []).append(letters(row["piece"]))
    contents = {}
    for name, pieces in sorted(taught.items()):
        each = max(1, s.dictionary // max(1, len(pieces)))  # all pieces take part, short of the whole if they must
        contents[name] = b"".join(p.encode()[:each] for p in pieces)
    return {name: x for name, x in contents.items() if len(x) >= 8}


class Model:
    def __init__(self, contents: dict[str, bytes], settings: Settings):
        self.names, self.settings, self.packers = sorted(contents), settings, []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=settings.level)
            self.packers.append(zstandard.ZstdCompressor(level=settings.level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        words = letters(text) if text else ""
        if not words or not self.names:
            return UNDETERMINED, 0.0, 0.0, True
        blocks = [words[i : i + self.settings.block].encode() for i in range(0, len(words), self.settings.block)]
        sizes = np.array([sum(len(pack(b)) for b in blocks) for pack in self.packers])
        best = int(sizes.argmin())
        rest = np.delete(sizes, best)
        score = float(1 / np.exp(-np.minimum(700, (sizes - sizes[best]) / self.settings.scale)).sum())
        margin = float((rest.min() - sizes[best]) / sizes[best]) if len(rest) else 1.0
        return self.names[best], score, margin, margin < self.settings.margin


def predicted(spark, text: Column, contents: dict[str, bytes], settings: Settings | None = None) -> Column:
    """Struct of lang_pred, score, margin and rejected for a column of texts."""
    s = settings or Settings()
    shared = spark.sparkContext.broadcast(contents)  # a dictionary's bound times the languages
    made: list[Model] = []

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not made:
            made.append(Model(shared.value, s))
        for texts in batches:
            yield pd.DataFrame([made[0].predict(x) for x in texts], columns=["lang_pred", "score", "margin", "rejected"])

    return F.pandas_udf(predict, PREDICTED)(text)


def identify(df: DataFrame, contents: dict[str, bytes], key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """key, lang_pred, score, margin and rejected of each row; whole texts, no shuffle.

    Null texts and texts without a letter, and all texts if nothing was learned, are "und"
    with score 0, rejected. Equal sizes go to the language that comes first by name. Repeated
    rows each get a result, an empty table an empty one; other columns take no part.
    """
    rows = small_batches(df).select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.select(F.col("key").alias(key), predicted(df.sparkSession, F.col("text"), contents, settings).alias("found")).select(key, "found.*")
