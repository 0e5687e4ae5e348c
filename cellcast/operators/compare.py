"""Comparison of maps and series, and whole-table summaries.

Statistics over all cells that need order (medians, rank correlation, KS) use the distributed
rank, never a window or `percentile` over one group holding the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.functions.vectorized import theil_sen
from cellcast.operators.ranking import average_ranks, counts_at, exact_quantiles, key_lookup


def standardized_anomaly(panel: DataFrame, baseline: int, value: str = "median") -> DataFrame:
    """(v - mean) / sd against each scenario's baseline panel, and the change from the cell's own baseline."""
    base = panel.where(F.col("decade") == baseline)
    stats = base.groupBy("scenario").agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    own = base.select("scenario", "cell_id", F.col(value).alias("_b"))
    joined = panel.join(stats, "scenario").join(own, ["scenario", "cell_id"], "left")
    return joined.withColumns(
        {
            "anomaly": (F.col(value) - F.col("_m")) / F.nullif(F.col("_s"), F.lit(0.0)),
            "change": F.col(value) - F.col("_b"),
        }
    ).drop("_m", "_s", "_b")


def legacy_quantile_index(panel: DataFrame, baseline: DataFrame, value: str = "median") -> DataFrame:
    """Step index 1..99 against the baseline's 99 quantiles, for more-is-bad and less-is-bad layers."""
    levels = [i / 100 for i in range(1, 100)]
    cuts = exact_quantiles(baseline, value, levels).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("q", "quantile"))), lambda s: F.round(s["quantile"], 9))
    )
    with_cuts = panel.withColumn("_q", cuts.scalar())
    above = F.size(F.filter(F.slice("_q", 2, 98), lambda q: F.round(value, 9) > q))
    below = F.size(F.filter("_q", lambda q: F.round(value, 9) < q))
    have = F.col(value).isNotNull()
    return with_cuts.withColumns(
        {
            "more_is_bad": F.when(have, F.greatest(F.lit(1), above + 1)),
            "less_is_bad": F.when(have, F.greatest(F.lit(1), below)),
        }
    ).drop("_q")


def _both(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull())


def spearman(pairs: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rank correlation with averaged ties, per key when given."""
    both = _both(pairs, a, b).select(*keys, a, b)
    ra = average_ranks(both, a, keys).select(*keys, a, F.col("avg_rank").alias("_ra"))
    rb = average_ranks(both, b, keys).select(*keys, b, F.col("avg_rank").alias("_rb"))
    ranked = key_lookup(key_lookup(both, ra, [*keys, a]), rb, [*keys, b])
    return ranked.groupBy(*keys).agg(F.corr("_ra", "_rb").alias("spearman_r"))


def spatial_correlation(pairs: DataFrame, a: str = "old_value", b: str = "new_value") -> DataFrame:
    both = _both(pairs, a, b)
    rho = spearman(pairs, a, b).select("spearman_r").scalar()
    stats = both.agg(F.corr(a, b).alias("pearson_r"), F.count("*").alias("n_valid"))
    enough = F.col("n_valid") >= 3
    return stats.select(F.when(enough, F.col("pearson_r")).alias("pearson_r"), F.when(enough, rho).alias("spearman_r"), "n_valid")


def rmsd(pairs: DataFrame, a: str = "old_value", b: str = "new_value") -> Column:
    d = F.col(b) - F.col(a)
    return F.sqrt(F.avg(d * d))


def coverage_comparison(pairs: DataFrame, a: str = "old_value", b: str = "new_value") -> DataFrame:
    """Overlap and one-sided coverage in percent, and the root mean square difference."""
    x, y = F.col(a).isNotNull(), F.col(b).isNotNull()
    counts = pairs.agg(
        F.count("*").alias("_n"), F.count(a).alias("old_count"), F.count(b).alias("new_count"),
        F.count_if(x & y).alias("overlap_count"), F.count_if(x & ~y).alias("_xo"), F.count_if(~x & y).alias("_yo"),
        rmsd(pairs, a, b).alias("rmsd"),
    )
    pct = lambda n, d: 100.0 * F.col(n) / F.greatest(F.col(d), F.lit(1))
    return counts.select(
        "old_count", "new_count", "overlap_count", "rmsd",
        pct("old_count", "_n").alias("old_coverage_pct"), pct("new_count", "_n").alias("new_coverage_pct"),
        pct("overlap_count", "old_count").alias("overlap_pct"), pct("_xo", "old_count").alias("old_only_pct"),
        pct("_yo", "new_count").alias("new_only_pct"),
    )


def anomalous_differences(pairs: DataFrame, n_sigma: float = 3.0, a: str = "old_value", b: str = "new_value") -> DataFrame:
    """Mean and spread of the differences, and how many lie beyond n sigmas; none below ten pairs."""
    diff = _both(pairs, a, b).select((F.col(b) - F.col(a)).alias("d"))
    stats = diff.agg(F.avg("d").alias("m"), F.stddev_pop("d").alias("s"), F.count("*").alias("n"))
    far = F.abs(F.col("d") - stats.select("m").scalar()) > n_sigma * stats.select("s").scalar()
    out = diff.agg(F.avg("d").alias("diff_mean"), F.stddev_pop("d").alias("diff_std"), F.count("*").alias("n_valid"), F.count_if(far).alias("n_outliers"))
    usable = (F.col("n_valid") >= 10) & (F.col("diff_std") > 0)
    enough = F.col("n_valid") >= 10
    return out.select(
        F.when(enough, F.col("diff_mean")).alias("diff_mean"), F.when(enough, F.col("diff_std")).alias("diff_std"), F.when(usable, F.col("n_outliers")).otherwise(0).alias("n_outliers"),
        F.when(usable, 100.0 * F.col("n_outliers") / F.col("n_valid")).otherwise(0.0).alias("outlier_pct"),
    )


#: Up to this product of the sample sizes the p-value is exact.
EXACT_KS = 10_000
_KS_TERMS = 100


def kolmogorov_p(d: Column, n: Column, m: Column) -> Column:
    """P(D >= d) of two samples of n and m values without a difference, by Kolmogorov's series."""
    square = d * d * n * m / (n + m)
    k = F.sequence(F.lit(1), F.lit(_KS_TERMS))
    series = F.aggregate(F.transform(k, lambda i: F.when(i % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * i * i * square)), F.lit(0.0), lambda a, t: a + t)
    # below this the series has not settled and the chance is 1 to ten digits
    return F.when(square < 0.04, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)))


def exact_ks_p(d: Column, n: Column, m: Column) -> Column:
    """P(D >= d) by counting: of all orders in which n and m values can come, the share that strays d or more.

    A row of the lattice holds, per number of values of the second sample, the share of orders so far that have
    kept within; each row follows from the one before.
    """
    limit = F.round(d * n * m)
    inside = lambda i, j: F.abs(i * m - j * n) < limit

    def next_row(row: Column, i: Column) -> Column:
        def add(done: Column, j: Column) -> Column:
            from_a = F.when(i > 0, F.get(row, j.cast("int")) * i / (i + j)).otherwise(0.0)
            from_b = F.when(j > 0, F.get(done, (j - 1).cast("int")) * j / (i + j)).otherwise(0.0)
            share = F.when((i == 0) & (j == 0), F.lit(1.0)).otherwise(from_a + from_b)
            return F.concat(done, F.array(F.when(inside(i, j), share).otherwise(0.0)))

        return F.aggregate(F.sequence(F.lit(0).cast("long"), m), F.array().cast("array<double>"), add)

    first = F.array_repeat(F.lit(0.0), (m + 1).cast("int"))
    last = F.aggregate(F.sequence(F.lit(0).cast("long"), n), first, next_row)
    return F.when(limit <= 0, F.lit(1.0)).otherwise(1 - F.element_at(last, -1))


def ks_statistic(pairs: DataFrame, a: str = "old_value", b: str = "new_value") -> DataFrame:
    """Largest distance between the two empirical distributions, over all values of both sides, and its
    p-value; NULL below ten values on a side. Exact up to `EXACT_KS`, else by the limiting series."""
    x, y = pairs.select(F.col(a).alias("v")), pairs.select(F.col(b).alias("v"))
    every = x.unionByName(y)
    fx = counts_at(every, x, "v").select("v", (F.col("n_upto") / F.col("n_total")).alias("_x"), F.col("n_total").alias("_nx"))
    fy = counts_at(every, y, "v").select("v", (F.col("n_upto") / F.col("n_total")).alias("_y"), F.col("n_total").alias("_ny"))
    found = fx.join(fy, "v").agg(F.max(F.abs(F.col("_x") - F.col("_y"))).alias("d"), F.max("_nx").cast("long").alias("n"), F.max("_ny").cast("long").alias("m"))
    d, n, m = F.col("d"), F.col("n"), F.col("m")
    enough = (n >= 10) & (m >= 10)
    p = F.when(n * m <= EXACT_KS, exact_ks_p(d, n, m)).otherwise(kolmogorov_p(d, n, m))
    return found.select(F.when(enough, d).alias("ks_statistic"), F.when(enough, p).alias("p_value"))


SUMMARY_LEVELS = [0.05, 0.25, 0.5, 0.75, 0.95]


def summary_stats(df: DataFrame, value: str = "value", keys: Sequence[str] = ()) -> DataFrame:
    """Mean, population sd, range, quantiles and coverage, exact for groups of any size."""
    keys = list(keys)
    q = exact_quantiles(df, value, SUMMARY_LEVELS, keys).groupBy(*keys).agg(
        *[F.max(F.when(F.col("q") == lv, F.col("quantile"))).alias(f"p{int(lv * 100)}") for lv in SUMMARY_LEVELS]
    )
    base = df.groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.count(value).alias("n_valid"), (100.0 * F.count(value) / F.count("*")).alias("coverage_pct"),
    )
    if keys:
        return base.join(q, keys, "left")
    row = q.select(F.struct(*[f"p{int(lv * 100)}" for lv in SUMMARY_LEVELS])).scalar()
    return base.withColumn("_q", row).select(*base.columns, "_q.*")


def suspicious_patterns(df: DataFrame, value: str = "value", keys: Sequence[str] = ()) -> DataFrame:
    """Flags: nothing present, all zero, constant, infinite, negative."""
    v = F.col(value)
    any_value = F.count(value) > 0
    return df.groupBy(*keys).agg(
        (~any_value).alias("all_null"),
        (any_value & (F.sum(F.abs(v)) == 0)).alias("all_zero"),
        (any_value & (F.min(v) == F.max(v))).alias("constant"),
        F.coalesce(F.bool_or(F.abs(v) == float("inf")), F.lit(False)).alias("has_inf"),
        F.coalesce(F.bool_or(v < 0), F.lit(False)).alias("has_negative"),
    )


def sign_profile(df: DataFrame, value: str = "value", keys: Sequence[str] = ()) -> DataFrame:
    """Percent negative and zero, and the mean log10 of the positive values."""
    v = F.col(value)
    return df.where(v.isNotNull()).groupBy(*keys).agg(
        (100 * F.avg(F.when(v < 0, 1.0).otherwise(0.0))).alias("pct_negative"),
        (100 * F.avg(F.when(v == 0, 1.0).otherwise(0.0))).alias("pct_zero"),
        F.avg(F.log10(F.when(v > 0, v))).alias("mean_log10"),
    )


def seasonal_compare(pairs: DataFrame, keys: Sequence[str], a: str = "old_value", b: str = "new_value") -> DataFrame:
    """Twelve-month cycles: correlation, amplitude ratio, phase shift and RMSD; NULL below six months.

    Phase shift is the lag with the largest full cross-correlation of the standardised cycles, the
    earliest lag winning a tie. Twelve values travel as one array per key.
    """
    both = _both(pairs, a, b)
    cycle = F.array_sort(F.collect_list(F.struct("month", F.col(a).alias("x"), F.col(b).alias("y"))))
    d = F.col(b) - F.col(a)
    g = both.groupBy(*keys).agg(
        cycle.alias("_c"), F.count("*").alias("n_months"), F.corr(a, b).alias("_r"), F.sqrt(F.avg(d * d)).alias("_d"),
        (F.max(b) - F.min(b)).alias("_rb"), (F.max(a) - F.min(a)).alias("_ra"),
        F.avg(a).alias("_ma"), F.stddev_pop(a).alias("_sa"), F.avg(b).alias("_mb"), F.stddev_pop(b).alias("_sb"),
    )
    z = F.transform("_c", lambda c: F.struct(
        ((c["x"] - F.col("_ma")) / F.nullif(F.col("_sa"), F.lit(0.0))).alias("x"), ((c["y"] - F.col("_mb")) / F.nullif(F.col("_sb"), F.lit(0.0))).alias("y")
    ))
    g = g.withColumn("_z", z)

    def at_lag(lag: Column) -> Column:
        index = F.sequence(F.greatest(F.lit(0), lag), F.least(F.lit(11), 11 + lag))
        return F.aggregate(index, F.lit(0.0), lambda acc, i: acc + F.get("_z", i)["x"] * F.get("_z", i - lag)["y"])

    lags = F.transform(F.sequence(F.lit(-11), F.lit(11)), lambda k: F.struct((-F.round(at_lag(k), 9)).alias("s"), k.alias("k")))
    full = (F.col("n_months") == 12) & (F.col("_sa") > 0) & (F.col("_sb") > 0)
    enough = F.col("n_months") >= 6
    return g.select(
        *keys, "n_months",
        F.when(enough & (F.col("_sa") > 0) & (F.col("_sb") > 0), F.col("_r")).alias("correlation"),
        F.when(enough, F.col("_rb") / F.nullif(F.col("_ra"), F.lit(0.0))).alias("amplitude_ratio"),
        F.when(full, F.array_min(lags)["k"]).alias("phase_shift"),
        F.when(enough, F.col("_d")).alias("rmsd"),
    )


def pixel_trends(panel: DataFrame, keys: Sequence[str], value: str = "value", min_values: int = 4) -> DataFrame:
    """Median pairwise slope per decade and rank correlation with time per pixel; NULL below four values.

    A pixel's decades are few, so they travel as one array row.
    """
    have = panel.where(F.col(value).isNotNull())
    point = F.struct(F.col("decade").cast("double").alias("y"), F.col(value).alias("v"))
    series = have.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("_s"), F.count("*").alias("n_valid"))
    enough = F.when(F.col("n_valid") >= min_values, F.col("_s"))
    slope = theil_sen(enough) * 10.0
    ranks = F.transform(enough, lambda p: (
        F.size(F.filter("_s", lambda o: o["v"] < p["v"])) + F.size(F.filter("_s", lambda o: o["v"] <= p["v"])) + 1
    ) / 2.0)
    per = series.select(*keys, "n_valid", slope.alias("slope"), F.posexplode_outer(ranks).alias("_t", "_r"))
    return per.groupBy(*keys).agg(
        F.max("n_valid").alias("n_valid"), F.max("slope").alias("slope"), F.corr("_t", "_r").alias("rho")
    )


def trend_agreement(pairs: DataFrame, a: str = "old_slope", b: str = "new_slope") -> DataFrame:
    """Pearson, Spearman and its square, and the percentage of equal signs."""
    both = _both(pairs, a, b)
    rho = spearman(pairs, a, b).select("spearman_r").scalar()
    same = F.when(F.signum(a) == F.signum(b), 100.0).otherwise(0.0)
    out = both.agg(F.corr(a, b).alias("pearson_r"), F.avg(same).alias("sign_agree_pct"), F.count("*").alias("n_valid"))
    return out.withColumn("spearman_r", rho).withColumn("r2", F.col("spearman_r") * F.col("spearman_r"))


def slope_choice(panel: DataFrame, keys: Sequence[str] = ("layer_id",), zero_limit: float = 0.10) -> DataFrame:
    """Over active cells at the last decade: share of flat Sen slopes, sign agreement, recommendation."""
    last = panel.select(F.max("decade")).scalar()
    active = panel.where(
        (F.col("decade") == last) & F.col("ols_slope").isNotNull() & F.col("sen_slope").isNotNull()
        & ((F.col("ols_slope") != 0) | (F.col("sen_slope") != 0))
    )
    out = active.groupBy(*keys).agg(
        F.count("*").alias("n_active"),
        F.avg(F.when(F.col("sen_slope") == 0, 1.0).otherwise(0.0)).alias("sen_zero_share"),
        F.avg(F.when(F.signum("ols_slope") == F.signum("sen_slope"), 1.0).otherwise(0.0)).alias("sign_agreement"),
    )
    return out.withColumn("recommended", F.when(F.col("sen_zero_share") > zero_limit, "ols_slope").otherwise("sen_slope"))


def bound_shares(df: DataFrame, keys: Sequence[str], bound: float, value: str = "value") -> DataFrame:
    """Share of the pool at or above a bound (saturation) and exactly at zero (sparsity)."""
    v = F.col(value)
    return df.where(v.isNotNull()).groupBy(*keys).agg(
        F.avg(F.when(v >= bound, 1.0).otherwise(0.0)).alias("saturation_share"),
        F.avg(F.when(v == 0, 1.0).otherwise(0.0)).alias("sparsity_share"),
    )


def symmetric_limit(df: DataFrame, value: str = "value", q: float = 0.95, min_n: int = 40) -> DataFrame:
    """Limit of |value| for a zero-centred scale and how many values it clamps.

    The q-quantile, or the maximum for fewer than `min_n` values or a limit of 0 (1 when all are 0).
    """
    size = df.where(F.col(value).isNotNull()).select(F.abs(value).alias("m"))
    quantile = exact_quantiles(size, "m", [q]).select("quantile").scalar()
    stats = size.agg(F.count("*").alias("n"), F.max("m").alias("top")).withColumn("_q", quantile)
    pick = F.when((F.col("n") >= min_n) & (F.col("_q") > 0), F.col("_q")).otherwise(F.coalesce(F.nullif("top", F.lit(0.0)), F.lit(1.0)))
    limit = stats.select(pick).scalar()
    return size.agg(F.count_if(F.col("m") > limit).alias("n_clamped"), F.count("*").alias("n")).withColumn("limit_value", limit)


