"""Exact global ranks and quantiles without a single-task window.

A window over a whole table, or `percentile` over a whole table, puts every distinct value in one
task. Here values are first collapsed to (value, count) with map-side combine, split into value
ranges of near equal size, counted inside each range, and shifted by the ranges' running totals (a
table of `ranges` rows per key). Any number of rows on one key or one value stays spread out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellcast.session import cut_lineage


def _range_count(df: DataFrame) -> int:
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def key_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a one-row-per-key lookup onto a table where a few keys may hold most rows.

    Left to adaptive execution, which splits the rows of a hot key and copies only that key's lookup
    row; a lookup copied for every key would multiply the shuffle of long ones.
    """
    return df.join(lookup, list(keys), how)


def cumulative_counts(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None, ranges: int | None = None
) -> DataFrame:
    """(by..., value, n, n_below, n_upto, n_total) per distinct non-null value.

    `n_below` counts rows < value, `n_upto` rows <= value. With `weight`, rows count that many
    times; weight 0 places a probe value without counting it.
    """
    ranges = ranges or _range_count(df)
    by = list(by)
    count = F.count("*") if weight is None else F.sum(weight)
    # read three times below (cuts, range totals, running counts), so it is written once
    distinct = cut_lineage(df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(count.cast("long").alias("n")))
    cuts = distinct.agg(
        F.percentile_approx(value, [i / ranges for i in range(1, ranges)], 10_000).alias("cuts")
    )
    # two-level search: every step-th cut first, then the step cuts after the last one passed
    step = math.isqrt(ranges - 1) + 1
    coarse = F.filter("cuts", lambda _, i: (i + 1) % step == 0)
    below = lambda cut: cut < F.col(value)
    split = distinct.withColumn("_cuts", cuts.select(F.struct("cuts", coarse.alias("coarse"))).scalar())
    split = split.withColumn("_at", F.size(F.filter("_cuts.coarse", below)) * step)
    within = F.size(F.filter(F.slice("_cuts.cuts", F.col("_at") + 1, F.lit(step)), below))
    split = split.withColumn("_range", F.col("_at") + within).drop("_cuts", "_at")
    totals = split.groupBy(*by, "_range").agg(F.sum("n").alias("_in_range"))
    over_ranges = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    totals = totals.select(
        *by,
        "_range",
        (F.sum("_in_range").over(over_ranges.orderBy("_range")) - F.col("_in_range")).alias("_before"),
        F.sum("_in_range").over(over_ranges).alias("n_total"),
    )
    inside = W.partitionBy(*by, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    running = split.withColumn("_run", F.sum("n").over(inside))
    join_on = [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in by] + [F.col("r._range") == F.col("t._range")]
    return (
        running.alias("r")
        .join(totals.alias("t"), join_on)
        .select(
            *[F.col(f"r.{k}").alias(k) for k in by],
            F.col(f"r.{value}").alias(value),
            F.col("r.n").alias("n"),
            (F.col("_before") + F.col("_run") - F.col("r.n")).alias("n_below"),
            (F.col("_before") + F.col("_run")).alias("n_upto"),
            F.col("n_total"),
        )
    )


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., q, quantile) with linear interpolation; safe for one key holding most rows."""
    by = list(by)
    counts = cumulative_counts(df, value, by)
    rank = lambda q: q * (F.col("n_total") - 1)
    hit = lambda r: (F.col("n_below") <= r) & (r < F.col("n_upto"))
    # only the levels that fall on a row are expanded, so rows are not multiplied by the levels
    levels = F.filter(F.array(*[F.lit(float(q)) for q in qs]), lambda q: hit(F.floor(rank(q))) | hit(F.ceil(rank(q))))
    probes = counts.withColumn("q", F.explode(levels))
    position = rank(F.col("q"))
    lower, upper = F.floor(position), F.ceil(position)
    picked = (
        probes.groupBy(*by, "q")
        .agg(
            F.max(F.when(hit(lower), F.col(value))).alias("_lo"),
            F.max(F.when(hit(upper), F.col(value))).alias("_hi"),
            F.max(position - lower).alias("_frac"),
        )
    )
    return picked.select(*by, "q", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("quantile"))


def quantile_scalar(df: DataFrame, value: str, q: float) -> Column:
    """One exact quantile of the whole table as a scalar subquery."""
    return exact_quantiles(df, value, [q]).select("quantile").scalar()


def counts_at(values: DataFrame, reference: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """For each distinct `value`: how many reference rows lie below / up to it, and the total.

    The probe values enter the count with weight 0, so the as-of lookup becomes one grouped count.
    """
    by = list(by)
    base = reference.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_w"))
    probes = values.where(F.col(value).isNotNull()).select(*by, value).distinct().withColumn("_w", F.lit(0).cast("long"))
    return cumulative_counts(base.unionByName(probes), value, by, weight="_w")


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., value, avg_rank, n_total): ranks from 1, ties sharing their mean rank."""
    return cumulative_counts(df, value, by).withColumn(
        "avg_rank", (F.col("n_below") + 1 + F.col("n_upto")) / F.lit(2.0)
    )
