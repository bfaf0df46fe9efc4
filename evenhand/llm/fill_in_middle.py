"""Fill-in-the-middle: cut texts in three at units and put the middle last, word arithmetic finds the cuts.

A text's UTF-8 bytes are viewed as 64-bit words. Arithmetic on whole words marks the bytes that
end a unit, bit counts per word are summed up, a sorted search in the sums finds the word that
holds the k-th unit's end, and a byte-wise prefix sum within that word finds the byte. So a cut
costs a few passes over an eighth of the text's length, and no text is decoded to find it.

Units are code points or lines. Cuts and forms are drawn from a hash of the row's key, so a row
gives the same output on any executor and any number of times. Outputs can be undone by
declarative expressions alone (`restored`).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import small_batches

LOW = np.uint64(0x0101010101010101)  # the lowest bit of every byte
HIGH = np.uint64(0x8080808080808080)
REST = np.uint64(0x7F7F7F7F7F7F7F7F)
FEEDS = np.uint64(0x0A0A0A0A0A0A0A0A)
ONE, SIX, SEVEN, EIGHT, TOP = (np.uint64(k) for k in (1, 6, 7, 8, 56))

UNITS = ("character", "line")
MADE = "n long, form string, prefix_units long, middle_units long, output string"


@dataclass(frozen=True)
class Settings:
    """Shares in percent: of texts that are transformed, and of those that put the suffix first.

    marks stand before prefix, suffix and middle; a text that has one of them stays plain. They
    must not be empty, equal, or overlap with one another.
    """

    transformed: int = 90
    suffix_first: int = 20
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    unit: str = "character"
    seed: int = 1

    def __post_init__(self) -> None:
        if self.unit not in UNITS:
            raise ValueError(f"unit is one of {UNITS}, not {self.unit}")
        if not all(self.marks) or len(set(self.marks)) < 3 or any(_overlap(a, b) for a in self.marks for b in self.marks):
            raise ValueError(f"marks must not be empty, equal or overlap: {self.marks}")


def _overlap(a: str, b: str) -> bool:
    """Whether an end of `a` is a beginning of `b`, or one holds the other."""
    return (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b))))


def words(data: bytes) -> np.ndarray:
    """Bytes as 64-bit words, the first byte lowest, zeros behind the last; at least one zero."""
    return np.frombuffer(data + bytes(8 - len(data) % 8), "<u8")


def unit_ends(data: bytes, unit: str = "character") -> np.ndarray:
    """For each word of `data` the lowest bit of every byte that ends a unit."""
    v = words(data)
    if unit == "character":
        # 10xxxxxx continues a character; a byte ends one where the next byte begins one
        begins = ((v >> SEVEN) & ~(v >> SIX) & LOW) ^ LOW
        ends = begins >> EIGHT
        ends[:-1] |= begins[1:] << TOP
    else:
        # zero bytes of the difference are line feeds
        x = v ^ FEEDS
        ends = (~(((x & REST) + REST) | x) & HIGH) >> SEVEN
    tail = len(data) % 8  # what lies behind the last byte ends nothing
    ends[-1] &= np.uint64((1 << (8 * tail)) - 1)
    if unit == "line" and data and data[-1] != 10:  # the last line ends with the text
        last = len(data) - 1
        ends[last // 8] |= ONE << np.uint64(8 * (last % 8))
    return ends


def select_in_word(word: int, rank: int) -> int:
    """The byte of the `rank`-th mark (from 1) of a word: one more than the bytes whose prefix sum is below."""
    sums = word * int(LOW) & 0xFFFFFFFFFFFFFFFF
    reached = ((sums | int(HIGH)) - rank * int(LOW)) & int(HIGH)
    return 8 - reached.bit_count()


class Cuts:
    """Places of unit ends in a text."""

    def __init__(self, data: bytes, unit: str = "character") -> None:
        self.ends = unit_ends(data, unit)
        self.sums = np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)
        self.count = int(self.sums[-1])

    def after(self, k: int) -> int:
        """The number of bytes of the first k units."""
        if k <= 0:
            return 0
        at = int(np.searchsorted(self.sums, k))
        before = int(self.sums[at - 1]) if at else 0
        return 8 * at + select_in_word(int(self.ends[at]), k - before) + 1


def draws(key: str, seed: int = 1) -> list[int]:
    """Four numbers below 2**32 from the hash of seed and key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def transform(key: str, text: str | None, settings: Settings) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, units of prefix and middle, and output of a text."""
    data = (text or "").encode()
    cuts = Cuts(data, settings.unit)
    n = cuts.count
    one, two, three, four = draws(key, settings.seed)
    prefix_mark, suffix_mark, middle_mark = (m.encode() for m in settings.marks)
    if not data or three % 100 >= settings.transformed or any(m in data for m in (prefix_mark, suffix_mark, middle_mark)):
        return n, "plain", None, None, text or ""
    first, second = sorted((one % (n + 1), two % (n + 1)))
    a, b = cuts.after(first), cuts.after(second)
    prefix, middle, suffix = prefix_mark + data[:a], middle_mark + data[a:b], suffix_mark + data[b:]
    if four % 100 < settings.suffix_first:
        form, out = "spm", suffix + prefix + middle
    else:
        form, out = "psm", prefix + suffix + middle
    return n, form, first, second - first, out.decode()


def transformed(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "fim", settings: Settings = Settings()) -> DataFrame:
    """`df` with a struct column `out`: n (units), form, prefix_units, middle_units, output.

    form is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle); a plain text is its
    own output and has no numbers of units. Row by row, without a shuffle, whole texts of any
    length. A null text is an empty one, which is plain; a null key draws as an empty key does;
    repeated rows get equal results; an empty table gives an empty one. A column named `out` is replaced.
    """

    def each(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = [transform(k or "", t, settings) for k, t in zip(keys, texts, strict=True)]
        made = pd.DataFrame(rows, columns=["n", "form", "prefix_units", "middle_units", "output"])
        return made.astype({"n": "int64", "prefix_units": "Int64", "middle_units": "Int64"})

    made = F.pandas_udf(each, MADE)(F.col(key).cast("string"), F.col(text))
    return small_batches(df).withColumn(out, made)


def restored(form: Column, output: Column, settings: Settings = Settings()) -> Column:
    """The text that an output was made from. Each mark is in it once, as marked texts stay plain."""
    pattern = "|".join(f"\\Q{m}\\E" for m in settings.marks)
    parts = F.split(output, pattern)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
