"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

A text's word shingles are hashed once; the top 8 bits of a hash are its bin, the rest its
rank there, and the least rank of each bin is kept. Empty bins are filled by optimal
densification: bin i takes the value of the first full bin of a probe sequence that its hash
draws for it, which visits every bin and is equal for all texts. The low 8 bits of each value
are packed into two hex digits. Chance makes 1 in 256 of them agree, which likeness takes off.

All work is done within the row: an array of hashes and of one end mark for each bin is
sorted, and the first of each bin is kept, so that a text costs what sorting its shingles does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evenhand.llm.common import fresh

SHINGLE = 5
BINS = 256
CHANCE = 1 / 256
EMPTY = ""  # fingerprint of a text without words
RANKS = (1 << 56) - 1
PROBES = (0, 4, 16, 64, BINS)  # borders of the rounds of probes; a round is only made if none before found a full bin


def _named(value: Column, body) -> Column:
    """body(value) with the value computed once: as the variable of a lambda over an array of one."""
    return F.get(F.transform(F.array(value), body), 0)


def codes(text: Column, shingle: int = SHINGLE) -> Column:
    """The low 8 bits of each bin's value, less 128, as an array of tinyint; empty for null and for texts without words.

    Words are what stands between white space (ASCII), as they are written; a text of fewer
    words than a shingle is one shingle.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    none = F.array().cast("array<bigint>")

    def shingles(h: Column) -> Column:
        every = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, shingle)]))
        short = F.when(F.size(h) == 0, none).otherwise(F.array(F.xxhash64(h)))
        return F.when(F.size(h) < shingle, short).otherwise(F.slice(every, F.lit(1), F.size(h) - (shingle - 1)))

    marks = F.lit([(b << 56) + RANKS for b in range(-BINS // 2, BINS // 2)]).cast("array<bigint>")
    least = lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, 56) != F.shiftright(F.get(s, i - 1), 56)))
    full = lambda x: x.bitwiseAND(F.lit(RANKS)) != RANKS

    def filled(bins: Column) -> Column:
        def probed(h: Column, low: int, high: int) -> Column:
            step = F.shiftright(h, 8).bitwiseOR(F.lit(1))  # odd: all bins are visited
            spot = lambda j: (h + j * step).bitwiseAND(F.lit(BINS - 1)).cast("int")
            return F.get(F.filter(F.transform(F.lit(list(range(low, high))), lambda j: F.get(bins, spot(j))), full), 0)

        donor = lambda i: _named(F.xxhash64(i).bitwiseAND(F.lit((1 << 32) - 1)), lambda h: F.coalesce(*[probed(h, a, b) for a, b in zip(PROBES, PROBES[1:], strict=False)]))
        return F.transform(bins, lambda x, i: F.when(full(x), x).otherwise(donor(i)).bitwiseAND(F.lit(255)) - 128).cast("array<tinyint>")

    def of(s: Column) -> Column:
        return F.when(F.size(s) == 0, F.array().cast("array<tinyint>")).otherwise(_named(_named(F.sort_array(F.concat(s, marks)), least), filled))

    return _named(_named(F.transform(words, lambda w: F.xxhash64(w)), shingles), of)


def packed(values: Column) -> Column:
    """The fingerprint as a string: two hex digits for each bin, EMPTY without bins."""
    return F.lower(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v.cast("long") + 128), 2, "0")), ""))


def unpacked(fingerprint: Column) -> Column:
    """The codes of a fingerprint string."""
    pairs = F.when(F.length(fingerprint) > 0, F.sequence(F.lit(1), F.length(fingerprint), F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.transform(pairs, lambda i: (F.conv(F.substr(fingerprint, i, F.lit(2)), 16, 10).cast("int") - 128).cast("tinyint"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of shingles in common, 0 to 1, from two texts' codes; of two empty texts 1, of one 0."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / BINS
    estimate = F.greatest(F.lit(0.0), (same - CHANCE) / (1 - CHANCE))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), ((F.size(a) == 0) & (F.size(b) == 0)).cast("double")).otherwise(estimate)


def fingerprinted(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """`df` with the fingerprint string of whole texts as column `out`, which replaces one of that name; no shuffle.

    Null and empty texts have the fingerprint EMPTY; equal texts have equal ones; repeated
    rows stay; an empty table gives an empty one.
    """
    return df.withColumn(out, packed(codes(F.col(text))))


def with_next(df: DataFrame, key: str, tie: Column, derived: dict[str, Column], columns: dict[str, str]) -> DataFrame:
    """`df` with `derived` columns and the values that the row next by `key` has in some columns (column -> new name); after the last comes the first.

    Null keys come first, equal keys in the order of `tie`. Rows are dealt into ranges of the
    key, as even as quantiles make them, and follow one another within a range; a range's last
    row gets the first of the next range that has rows. So whole rows are shuffled once, and
    what the driver sees is a number and a count for each range.
    """
    spark = df.sparkSession
    n_ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(df.agg(F.percentile_approx(key, [k / n_ranges for k in range(1, n_ranges)], 100 * n_ranges)).first()[0] or []))
    part, tied, last = fresh(df, "part"), fresh(df, "tied"), fresh(df, "last")
    # a range's number: of the bounds below the key first every `coarse`-th is counted, then those after it
    coarse = max(1, int(len(bounds) ** 0.5))
    below = lambda values: F.size(F.filter(values, lambda b: b < F.col(key)))
    if bounds:
        number = _named(below(F.lit(bounds[::coarse])), lambda c: F.when(c == 0, 0).otherwise((c - 1) * coarse + below(F.slice(F.lit(bounds), (c - 1) * coarse + 1, F.lit(coarse)))))
    else:
        number = F.lit(0)
    rows = df.withColumns({part: F.coalesce(F.when(F.col(key).isNull(), F.lit(-1)).otherwise(number), F.lit(-1)), tied: tie})
    used = sorted(r[0] for r in rows.select(part).distinct().collect())
    if not used:
        return df.withColumns(derived).withColumns({new: F.col(old) for old, new in columns.items()})
    # the first rows of ranges, found by key alone; their number is that of the ranges, so they may be broadcast
    least = F.struct(F.col(key).isNotNull(), key, tied)
    starts = rows.groupBy(F.col(part).alias("_part")).agg(F.min(least).alias("_least"))
    first = rows.join(F.broadcast(starts), (F.col(part) == F.col("_part")) & least.eqNullSafe(F.col("_least"))).dropDuplicates([part])
    rows = rows.withColumns(derived)
    order = Window.partitionBy(part).orderBy(F.col(key).asc_nulls_first(), tied)
    follow = {new: F.lead(old).over(order) for old, new in columns.items()}
    rows = rows.withColumns(follow | {last: F.lead(F.lit(False), 1, True).over(order)})
    before = F.create_map(*[F.lit(x) for k, p in enumerate(used) for x in (p, used[k - 1])])
    first = first.withColumns(derived).select(before[F.col(part)].alias("_before"), *[F.col(old).alias(f"_first_{k}") for k, old in enumerate(columns)])
    rows = rows.join(first, F.col(part) == F.col("_before"), "left")
    rows = rows.withColumns({new: F.when(F.col(last), F.col(f"_first_{k}")).otherwise(F.col(new)) for k, new in enumerate(columns.values())})
    return rows.drop(part, tied, last, "_before", *[f"_first_{k}" for k in range(len(columns))])


def against_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each row.

    The edited text has the last half of a text's characters (rounded down) replaced by as
    many, or all, that the next row's text begins with. Null texts count as empty; see
    with_next for null, equal and single keys; other columns take no part.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(rows, "key", F.xxhash64("text"), {"codes": codes(F.col("text"))}, {"text": "next_text", "codes": "next_codes"})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    rows = rows.select("key", "codes", "next_codes", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.select("*", codes(F.col("edited")).alias("edited_codes"))
    return rows.select(
        F.col("key").alias(key), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), packed(F.col("codes")).alias("fingerprint"),
        packed(F.col("edited_codes")).alias("edited_fingerprint"), likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"))
