"""Rank tests over tables of any size.

Ranks come from counts per distinct score, so tied rows cost one row.  Distinct scores are
cut into ranges by approximate quantiles; each range is ranked on its own and shifted by the
number of rows in the ranges before it, so no task ever sorts all scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenhand.functions.tails import chi_square_tail_udf, rank_sum_p_udf


def _ranges(df: DataFrame, ranges: int | None) -> int:
    """As many ranges as the session shuffles into, unless given."""
    return ranges or max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def rank_sums(df: DataFrame, group: str, score: str, by: tuple = (),
              ranges: int | None = None) -> DataFrame:
    """Per (by, group): rows ``n``, rank sum ``rank_sum`` and its part of the tie term."""
    return _rank_sums(score_counts(df, group, score, by), group, score, by, ranges)


def score_counts(df: DataFrame, group: str, score: str, by: tuple = (), rows: str | None = None) -> DataFrame:
    """Rows per distinct score of a group; everything else works on this table.  ``rows`` names how many rows a
    row stands for."""
    return (df.where(F.col(score).isNotNull() & F.col(group).isNotNull())
            .groupBy(*by, group, score).agg(F.sum(F.col(rows) if rows else F.lit(1)).alias("_n")))


def _rank_sums(counts: DataFrame, group: str, score: str, by: tuple,
               ranges: int | None = None) -> DataFrame:
    ranges = _ranges(counts, ranges)
    # The count is looked at, or it would be left out below the shared aggregate, which would then run twice.
    cuts = counts.agg(F.percentile_approx(
        F.when(F.col("_n") > 0, F.col(score)), [i / ranges for i in range(1, ranges)], F.lit(ranges * 40)).alias("c")).scalar()
    # Never null, or the joins below would push "is not null" under the shared aggregate.
    ranged = counts.withColumn("_cuts", cuts).withColumn("_range", F.coalesce(
        F.size(F.filter("_cuts", lambda c: c < F.col(score))), F.lit(0))).drop("_cuts")

    sizes = ranged.groupBy(*by, "_range").agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_range",
                           F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))

    inside = Window.partitionBy(*by, "_range").orderBy(score)
    tied = Window.partitionBy(*by, "_range", score)
    placed = ranged.withColumns({
        "_upto": F.sum("_n").over(inside), "_tied": F.sum("_n").over(tied),
    }).join(offsets, [*by, "_range"])
    rank = F.col("_offset") + F.col("_upto") - F.col("_tied") + (F.col("_tied") + 1) / 2
    tied_double = F.col("_tied").cast("double")
    return placed.groupBy(*by, group).agg(
        F.sum("_n").alias("n"),
        F.sum(F.col("_n") * rank).alias("rank_sum"),
        F.sum(F.col("_n") * (tied_double * tied_double - 1)).alias("ties"),
    )


def kruskal_wallis(df: DataFrame, group: str, score: str, by: tuple = (),
                   min_group_size: int = 1, alpha: float = 0.05, rows: str | None = None) -> DataFrame:
    """H with tie correction and its p per ``by``, over the groups with enough rows.

    One row per ``by`` with at least two such groups; identical scores give a null H and
    are not significant.
    """
    counts = score_counts(df, group, score, by, rows)
    big = (counts.groupBy(*by, group).agg(F.sum("_n").alias("_rows"))
           .where(F.col("_rows") >= min_group_size).drop("_rows"))
    # An inner join on the unique group keys: a semi join would be pushed below the
    # aggregate, which could then not be shared between its uses.
    kept = counts.join(big, [*by, group])
    sums = _rank_sums(kept, group, score, by)
    total = sums.groupBy(*by).agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"), F.sum("ties").alias("ties"),
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("squares"))
    n = F.col("n").cast("double")
    raw = F.lit(12.0) / (n * (n + 1)) * F.col("squares") - F.lit(3.0) * (n + 1)
    correction = F.lit(1.0) - F.col("ties") / (n * n * n - n)
    h = F.when(correction > 0, raw / correction)
    out = total.where(F.col("groups") >= 2).select(*by, "groups", "n", h.alias("h"))
    out = out.withColumn("p_value", chi_square_tail_udf("h", F.col("groups") - 1))
    return out.withColumn("significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


def mann_whitney(df: DataFrame, group: str, score: str, first, second,
                 alpha: float = 0.05, method: str = "asymptotic") -> DataFrame:
    """Two-sided rank-sum test between two values of ``group``; one row.

    ``method`` is that of ``rank_sum_p`` and the same for all sizes.  Fewer than two rows on a side give p = 1 and not significant.
    """
    two = df.where(F.col(group).isin(first, second))
    sums = rank_sums(two, group, score)

    def of(value, column):
        return F.coalesce(F.sum(F.when(F.col(group) == value, F.col(column))), F.lit(0))

    one = sums.agg(of(first, "n").alias("n1"), of(second, "n").alias("n2"),
                   of(first, "rank_sum").cast("double").alias("r1"),
                   F.coalesce(F.sum("ties"), F.lit(0.0)).alias("ties"))
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    out = one.select("n1", "n2", u.alias("u"), "ties")
    out = out.withColumn("p_value", rank_sum_p_udf(method)("n1", "n2", "u", "ties")).drop("ties")
    return out.withColumn("significant", (F.col("p_value") < alpha)
                          & (F.col("n1") >= 2) & (F.col("n2") >= 2))
