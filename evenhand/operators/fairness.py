"""Fairness metrics over labelled tables.

All of them are two-level aggregates: per group (combined before the shuffle, so a group
that holds most rows is no problem), then over the few groups.  Only individual fairness
compares rows with each other.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.operators.shared import settled


def demographic_parity_difference(df: DataFrame, y_pred: str, sensitive: str) -> DataFrame:
    """Highest less lowest mean prediction over the groups; 0 with fewer than two."""
    return _group_rates(df, y_pred, sensitive).agg(
        F.coalesce(F.when(F.count(F.lit(1)) >= 2, F.max("rate") - F.min("rate")), F.lit(0.0))
        .alias("demographic_parity_difference"))


def disparate_impact_ratio(df: DataFrame, y_pred: str, sensitive: str) -> DataFrame:
    """Lowest over highest mean prediction; 1 with fewer than two groups or all zero."""
    return _group_rates(df, y_pred, sensitive).agg(
        F.coalesce(F.when((F.count(F.lit(1)) >= 2) & (F.max("rate") != 0),
                          F.min("rate") / F.max("rate")), F.lit(1.0))
        .alias("disparate_impact_ratio"))


def _group_rates(df: DataFrame, y_pred: str, sensitive: str) -> DataFrame:
    return (df.where(F.col(sensitive).isNotNull()).groupBy(sensitive)
            .agg(F.avg(F.col(y_pred).cast("double")).alias("rate")))


def _binary(column: str) -> Column:
    value = F.col(column)
    return F.when(value.isin(0, 1), value).otherwise(
        F.raise_error(F.concat(F.lit(f"{column} must be 0 or 1, found "),
                               F.coalesce(value.cast("string"), F.lit("null")))))


def equalized_odds_difference(df: DataFrame, y_true: str, y_pred: str,
                              sensitive: str) -> DataFrame:
    """Spread of the true and of the false positive rate over the groups in which both
    classes occur; 0 with fewer than two such groups.  Labels must be 0 or 1."""
    labelled = df.where(F.col(sensitive).isNotNull()).select(
        sensitive, _binary(y_true).alias("t"), _binary(y_pred).alias("p"))
    cells = labelled.groupBy(sensitive).agg(
        F.count_if((F.col("t") == 1) & (F.col("p") == 1)).alias("tp"),
        F.count_if((F.col("t") == 0) & (F.col("p") == 1)).alias("fp"),
        F.count_if(F.col("t") == 1).alias("positives"),
        F.count_if(F.col("t") == 0).alias("negatives"))
    rates = cells.where("positives > 0 AND negatives > 0").select(
        (F.col("tp") / F.col("positives")).alias("tpr"),
        (F.col("fp") / F.col("negatives")).alias("fpr"))

    def spread(rate):
        return F.coalesce(F.when(F.count(F.lit(1)) >= 2, F.max(rate) - F.min(rate)), F.lit(0.0))

    return rates.agg(spread("tpr").alias("tpr_difference"), spread("fpr").alias("fpr_difference"))


def bias_amplification(df: DataFrame, side: str, flag: str, input_value="input",
                       output_value="output") -> DataFrame:
    """Output rate over input rate of a 0/1 flag; with input rate 0 it is 1 if the output
    rate is 0 too, else infinite."""
    def rate(value):
        return F.coalesce(F.avg(F.when(F.col(side) == value, F.col(flag).cast("double"))),
                          F.lit(0.0))

    rates = df.agg(rate(input_value).alias("input_rate"), rate(output_value).alias("output_rate"))
    return rates.withColumn("amplification", F.when(
        F.col("input_rate") == 0,
        F.when(F.col("output_rate") == 0, 1.0).otherwise(float("inf")),
    ).otherwise(F.col("output_rate") / F.when(F.col("input_rate") != 0, F.col("input_rate"))))


def intersectional_bias(df: DataFrame, dims: list[str], score: str) -> DataFrame:
    """Spread of mean scores over the combinations of ``dims``: population variance, range,
    size-weighted mean, number of groups; fewer than two groups give zeros and nulls."""
    groups = (df.where(F.col(score).isNotNull()).groupBy(*dims)
              .agg(F.avg(score).alias("m"), F.count(F.lit(1)).alias("n")))
    several = F.count(F.lit(1)) >= 2
    return groups.agg(
        F.coalesce(F.when(several, F.var_pop("m")), F.lit(0.0)).alias("intersectional_variance"),
        F.coalesce(F.when(several, F.max("m") - F.min("m")), F.lit(0.0)).alias("max_disparity"),
        F.when(several, F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias("weighted_mean"),
        F.when(several, F.count(F.lit(1))).alias("num_groups"))


def intersectional_means(df: DataFrame, dims: list[str], score: str) -> DataFrame:
    """Mean score of every combination and of every marginal (null = all values)."""
    return (df.where(F.col(score).isNotNull()).cube(*dims)
            .agg(F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("rows")))


# -- individual fairness ----------------------------------------------------

# Vectors and bytes of vectors per block; a task holds two blocks and one tile of their product.  Each row is sent once
# per pair of blocks, so larger blocks mean fewer copies.
BLOCK_ROWS = 32768
BLOCK_BYTES = 16_000_000
TILE_ROWS, TILE_COLUMNS = 512, 4096
DIRECTIONS = 2


def _along(vector: Column, n: int) -> Column:
    """Component of a vector along the n-th fixed direction: signs that follow a
    hash of the place (all positive for the first), over the root of their number."""
    def signed(x: Column, i: Column) -> Column:
        if n == 0:
            return x
        return F.when(F.xxhash64(i, F.lit(n)) % 2 == 0, x).otherwise(-x)

    total = F.aggregate(F.transform(vector, signed), F.lit(0.0), lambda a, x: a + x)
    return total / F.sqrt(F.size(vector))


def individual_fairness(df: DataFrame, vector: str, y_pred: str, threshold: float = 0.9,
                        tolerance: float = 0.1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One less the share of similar pairs whose predictions differ by more than
    ``tolerance``; similar means cosine at or above ``threshold``; no such pair gives 1.

    The result is exact and only two numbers leave a task, never the pairs.

    * Rows with the same vector and prediction become one row with a weight first, so many
      copies of one vector cost one comparison.
    * Unit vectors with cosine >= c lie within sqrt(2 - 2c) of each other, so their
      components along any fixed direction differ by no more.  Cells of that width along
      two directions form a grid; a cell is compared with itself and with the neighbouring
      cells on one side, so every similar pair meets once.
    * Rows of a cell are dealt by hash into blocks of at most about ``block_rows``; each pair of
      blocks that meet is worked off in one task, tile by tile, and a pair of a cell's own blocks once.
      Where nearly all rows are similar the work stays quadratic, but it is spread.
    """
    distinct = (df.where(F.col(vector).isNotNull() & F.col(y_pred).isNotNull())
                .groupBy(F.transform(vector, lambda x: x.cast("double")).alias("v"),
                         F.col(y_pred).cast("double").alias("y"))
                .agg(F.count(F.lit(1)).alias("w")))
    distinct = settled(distinct)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * threshold)) + 1e-9
    cells = [F.floor(_along(F.col("v"), n) / F.col("norm") / F.lit(reach)).alias(f"c{n}")
             for n in range(DIRECTIONS)]
    names = [f"c{n}" for n in range(DIRECTIONS)]
    placed = distinct.withColumn("norm", norm).where("norm > 0").select(
        F.transform("v", lambda x: x / F.col("norm")).alias("v"), "y", "w", F.xxhash64("v", "y").alias("h"), *cells)
    steps = [s for s in itertools.product((-1, 0, 1), repeat=DIRECTIONS) if s <= (0,) * DIRECTIONS]
    parts = _block_pairs(placed, names, steps, threshold, tolerance, block_rows)
    # Copies of one row are similar to each other and agree.
    copies = placed.agg(F.sum(F.expr("w * (w - 1) div 2")).alias("similar")).select(
        "similar", F.lit(0).cast("long").alias("differing"))
    if threshold <= 1.0:
        parts = parts.unionByName(copies)
    total = F.coalesce(F.sum("similar"), F.lit(0))
    differing = F.coalesce(F.sum("differing"), F.lit(0))
    return parts.agg(
        total.alias("similar_pairs"), differing.alias("differing_pairs"),
        F.when(total > 0, F.lit(1.0) - differing / total).otherwise(1.0)
        .alias("individual_fairness"))


def _block_pairs(placed: DataFrame, names: list[str], steps: list[tuple], threshold: float, tolerance: float,
                 block_rows: int) -> DataFrame:
    """Numbers of similar and of differing pairs, by pairs of blocks.  ``placed`` has unit vectors ``v``, ``y``,
    weights ``w``, a hash ``h``, its cell ``names`` and maybe ``signs``; cells meet that lie one of ``steps`` apart."""
    cells = placed.groupBy(*names).agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / block_rows, F.sum(F.size("v")) * 8 / BLOCK_BYTES)).cast("int").alias("parts"))
    step = F.inline(F.array(*[F.struct(F.lit(n).alias("step"), *[
        (F.col(c) - F.lit(d)).alias(f"other_{c}") for c, d in zip(names, s, strict=True)]) for n, s in enumerate(steps)]))
    others = cells.select(*[F.col(c).alias(f"other_{c}") for c in names], F.col("parts").alias("other_parts"))
    same = F.lit(True)
    for c in names:
        same &= F.col(c) == F.col(f"other_{c}")
    met = cells.select(*names, "parts", step).join(others, [f"other_{c}" for c in names]).withColumn("same", same)
    blocks = met.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i")).select(
        "*", F.explode(F.sequence(F.when(F.col("same"), F.col("i")).otherwise(F.lit(0)), F.col("other_parts") - 1))
        .alias("j")).withColumn("within", F.col("same") & (F.col("i") == F.col("j")))
    unit = [F.col(c).alias(f"at_{c}") for c in names] + [F.col(c) for c in ("step", "i", "j", "within")]
    roles = blocks.select(*names, F.col("i").alias("block"), *unit, F.lit(True).alias("home")).unionByName(
        blocks.where("NOT within").select(*[F.col(f"other_{c}").alias(c) for c in names], F.col("j").alias("block"),
                                          *unit, F.lit(False).alias("home")))
    dealt = placed.join(cells, names).withColumn("block", F.pmod("h", F.col("parts")).cast("int"))
    data = [c for c in ("v", "y", "w", "signs") if c in placed.columns]
    keys = [*[f"at_{c}" for c in names], "step", "i", "j", "within"]
    members = dealt.join(roles, [*names, "block"]).select(*data, *keys, "home")

    def count_pairs(rows: pa.Table) -> pa.Table:
        similar, differing = _pair_counts(rows, threshold, tolerance)
        return pa.table({"similar": pa.array([similar], pa.int64()), "differing": pa.array([differing], pa.int64())})

    return members.groupBy(*keys).applyInArrow(count_pairs, "similar long, differing long")


def _pair_counts(rows: pa.Table, threshold: float, tolerance: float) -> tuple[int, int]:
    """Weighted number of similar pairs of two blocks, or within one, and how many of them differ; with ``signs`` only
    pairs that agree on one.  Vectors of different lengths are not similar."""
    if not rows.num_rows:
        return 0, 0
    vectors = rows.column("v").combine_chunks()
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
    y, w = rows.column("y").to_numpy(), rows.column("w").to_numpy()
    home, within = rows.column("home").to_numpy(), rows.column("within")[0].as_py()
    order = np.argsort(y, kind="stable")
    signs = rows.column("signs").to_pylist() if "signs" in rows.column_names else None

    def side(at: np.ndarray, length: int) -> tuple:
        v = flat[(ends[at] - length)[:, None] + np.arange(length)]
        marks = None if signs is None else np.stack([np.frombuffer(signs[n], "uint8") for n in at])
        return v, v.astype("float32"), y[at], w[at], marks

    similar = differing = 0
    for length in np.unique(lengths):
        mine = order[lengths[order] == length]
        a = mine if within else mine[home[mine]]
        b = mine if within else mine[~home[mine]]
        if length and len(a) and len(b):
            one = side(a, int(length))
            s, d = _tile_counts(one, one if within else side(b, int(length)), within, threshold, tolerance)
            similar, differing = similar + s, differing + d
    return similar, differing


def _tile_counts(one: tuple, two: tuple, within: bool, threshold: float, tolerance: float) -> tuple[int, int]:
    """``_pair_counts`` of rows in the order of y, tile by tile."""
    (va, fa, ya, wa, sa), (vb, fb, yb, wb, sb) = one, two
    # Single precision decides all pairs but those as near to the threshold as its error.
    error = (va.shape[1] + 8) * 2.0 ** -23
    # Tiles of one value of y each, where values repeat: then the columns that agree with it stand together.
    starts = np.flatnonzero(np.r_[True, ya[1:] != ya[:-1]])
    grouped = len(starts) * 64 <= len(ya) + 64 and not np.isnan(ya).any() and not np.isnan(yb).any()
    cuts = [*starts.tolist(), len(ya)] if grouped else [0, len(ya)]
    strips = [(k, min(k + TILE_ROWS, stop)) for start, stop in itertools.pairwise(cuts) for k in range(start, stop, TILE_ROWS)]
    similar = differing = 0
    for top, bottom in strips:
        for left in range(top if within else 0, len(vb), TILE_COLUMNS):
            right = min(left + TILE_COLUMNS, len(vb))
            near = fa[top:bottom] @ fb[left:right].T
            close = near >= threshold + error
            p, q = np.nonzero((near >= threshold - error) ^ close)
            for k in range(0, len(p), 65536):
                x, z = p[k:k + 65536], q[k:k + 65536]
                close[x, z] = np.einsum("ij,ij->i", va[top + x], vb[left + z]) >= threshold
            if within and left < bottom:
                close &= np.arange(left, right)[None, :] > np.arange(top, bottom)[:, None]
            if sa is not None:
                p, q = np.nonzero(close)
                for k in range(0, len(p), 65536):
                    x, z = p[k:k + 65536], q[k:k + 65536]
                    close[x, z] = (sa[top + x] == sb[left + z]).any(axis=1)
            similar += _weight(close, wa[top:bottom], wb[left:right])
            if grouped:
                agree = np.flatnonzero(np.abs(yb[left:right] - ya[top]) <= tolerance)
                low, high = (agree[0], agree[-1] + 1) if len(agree) else (0, 0)
                differing += _weight(close[:, :low], wa[top:bottom], wb[left:left + low])
                differing += _weight(close[:, high:], wa[top:bottom], wb[left + high:right])
            else:
                close &= np.abs(ya[top:bottom, None] - yb[None, left:right]) > tolerance
                differing += _weight(close, wa[top:bottom], wb[left:right])
    return similar, differing


def _weight(close: np.ndarray, wa: np.ndarray, wb: np.ndarray) -> int:
    """Sum of the weights of the pairs that are close."""
    heavy = np.flatnonzero(wb > 1)
    if not len(heavy) and (wa == 1).all():
        return int(np.count_nonzero(close))
    each = np.count_nonzero(close, axis=1)
    if len(heavy):
        each = each + close[:, heavy] @ (wb[heavy] - 1)
    return int((each * wa).sum())


# -- individual fairness by bands of projections ------------------------------


def bands_for(threshold: float, bits: int, recall: float) -> int:
    """How many bands of ``bits`` signs a pair at the threshold needs to meet with the chance ``recall``."""
    agree = (1.0 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return 1 if agree >= 1.0 else max(1, math.ceil(math.log1p(-recall) / math.log1p(-agree)))


def _signatures(bands: int, bits: int, seed: int):
    def sign(vectors: pd.Series) -> pd.Series:
        out: list = [None] * len(vectors)
        sizes = vectors.map(len).to_numpy()
        for size in np.unique(sizes):
            planes = np.random.default_rng((seed, int(size))).standard_normal((int(size), bands * bits))
            at = np.flatnonzero(sizes == size)
            for k in range(0, len(at), 1024):
                some = at[k:k + 1024]
                above = np.stack(vectors.iloc[some].to_numpy()) @ planes > 0
                codes = above.reshape(len(some), bands, bits) @ (1 << np.arange(bits, dtype=np.int64))
                for n, row in zip(some.tolist(), codes, strict=True):
                    out[n] = row
        return pd.Series(out, dtype=object)

    return F.pandas_udf(sign, "array<long>")


def individual_fairness_banded(df: DataFrame, vector: str, y_pred: str, threshold: float = 0.9,
                               tolerance: float = 0.1, bits: int = 12, recall: float = 0.98,
                               block_rows: int = BLOCK_ROWS, seed: int = 11) -> DataFrame:
    """``individual_fairness`` over the similar pairs that meet in a band: a lower count of pairs,
    each of them checked exactly.

    A band is the signs of ``bits`` random projections; there are as many as a pair at the threshold
    needs to agree on one with the chance ``recall``, and more similar pairs have a higher one.  That
    chance is the column ``expected_recall``.  Rows join on (band, signs); a pair counts in the first
    band that it agrees on, so none counts twice.  A band's rows are dealt by hash into blocks of
    about ``block_rows``, and each pair of blocks is one matrix product that gives two numbers; bands so short that
    a row meets all others several times over are checked on blocks of all rows instead, with the same result.  Null
    and zero vectors and null predictions are left out, copies are one weighted row.
    """
    bands = bands_for(threshold, bits, recall)
    distinct = (df.where(F.col(vector).isNotNull() & F.col(y_pred).isNotNull())
                .groupBy(F.transform(vector, lambda x: x.cast("double")).alias("v"),
                         F.col(y_pred).cast("double").alias("y"))
                .agg(F.count(F.lit(1)).alias("w")))
    distinct = settled(distinct)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    placed = distinct.withColumn("norm", norm).where("norm > 0").select(
        F.transform("v", lambda x: x / F.col("norm")).alias("v"), "y", "w",
        F.xxhash64("v", "y").alias("h"))
    signed = placed.withColumn("signs", _signatures(bands, bits, seed)("v"))
    if bands >= 1 << bits <= 256:
        # A row would meet more rows in such short bands than there are: all pairs are compared in blocks instead, and
        # similar ones count if they agree on a band.
        pairs = _block_pairs(signed.withColumns({"cell": F.lit(0), "signs": _as_bytes("signs")}), ["cell"], [(0,)],
                             threshold, tolerance, block_rows)
    else:
        pairs = _band_pairs(signed, threshold, tolerance, block_rows)
    if threshold <= 1.0:
        pairs = pairs.unionByName(placed.agg(F.sum(F.expr("w * (w - 1) div 2")).alias("similar")).select(
            "similar", F.lit(0).cast("long").alias("differing")))
    total = F.coalesce(F.sum("similar"), F.lit(0))
    differing = F.coalesce(F.sum("differing"), F.lit(0))
    agree = (1.0 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return pairs.agg(
        total.alias("similar_pairs"), differing.alias("differing_pairs"),
        F.when(total > 0, F.lit(1.0) - differing / total).otherwise(1.0).alias("individual_fairness"),
        F.lit(1.0 - (1.0 - agree) ** bands).alias("expected_recall"))


def _as_bytes(signs: str) -> Column:
    """Codes of up to eight bits as bytes."""
    def pack(codes: pd.Series) -> pd.Series:
        return codes.map(lambda row: np.asarray(row).astype("uint8").tobytes())

    return F.pandas_udf(pack, "binary")(signs)


def _band_pairs(signed: DataFrame, threshold: float, tolerance: float, block_rows: int) -> DataFrame:
    rows = signed.select("*", F.posexplode("signs").alias("band", "code"))
    sizes = rows.groupBy("band", "code").agg(
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"),
        F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    met = rows.join(sizes, ["band", "code"]).withColumn("own", F.pmod("h", "parts").cast("int"))
    dealt = met.select("v", "y", "w", "h", "signs", "band", "code", "own", F.explode(F.sequence(
        F.lit(0), F.col("parts") - 1)).alias("other")).withColumns(
            {"i": F.least("own", "other"), "j": F.greatest("own", "other")})

    def count_pairs(part: pd.DataFrame) -> pd.DataFrame:
        similar, differing = _banded_counts(part, threshold, tolerance)
        return pd.DataFrame({"similar": [similar], "differing": [differing]})

    return dealt.groupBy("band", "code", "i", "j").applyInPandas(count_pairs, "similar long, differing long")


def _banded_counts(part: pd.DataFrame, threshold: float, tolerance: float) -> tuple[int, int]:
    """Weighted numbers of similar and of differing pairs of a band's two blocks that agree on no earlier band."""
    part = part.reset_index(drop=True)
    band, i, j = (int(part[c].iloc[0]) for c in ("band", "i", "j"))
    own = part["own"].to_numpy()
    left = np.flatnonzero(own == i)
    right = left if i == j else np.flatnonzero(own == j)
    if not len(left) or not len(right):
        return 0, 0
    v = part["v"].to_numpy()
    sizes = part["v"].map(len).to_numpy()
    signs, y, w = np.stack(part["signs"].to_numpy()), part["y"].to_numpy(), part["w"].to_numpy()
    similar = differing = 0
    for size in np.unique(sizes[left]):
        one, two = left[sizes[left] == size], right[sizes[right] == size]
        if not len(two):
            continue
        b = np.stack(v[two])
        for k in range(0, len(one), 512):
            some = one[k:k + 512]
            close = np.stack(v[some]) @ b.T >= threshold
            if i == j:
                close &= two[None, :] > some[:, None]
            x, z = np.nonzero(close)
            x, z = some[x], two[z]
            for start in range(0, len(x), 65536):
                p, q = x[start:start + 65536], z[start:start + 65536]
                first = ~(signs[p, :band] == signs[q, :band]).any(axis=1)
                p, q = p[first], q[first]
                weight = w[p] * w[q]
                similar += int(weight.sum())
                differing += int(weight[np.abs(y[p] - y[q]) > tolerance].sum())
    return similar, differing
