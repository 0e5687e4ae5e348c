"""Metrics of daily and monthly series: thresholds, intensity, rolling sums, runs, seasonality.

Series windows are partitioned by (member, cell), whose rows are bounded by the length of the
record, since `daily` holds one row per (member, cell, day).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellcast.operators.ranking import exact_quantiles

KEYS = ("member", "cell_id")
WET_DAY_MM = 1.0
# 256 logarithmic bins over 1..1000 mm/day.
HIST_BINS, HIST_TOP = 256, 1000.0
# Quantile levels and codes of the water index.
ANNUAL_QUANTILES = [0.05, 0.15, 0.25, 0.50, 0.75, 0.85, 0.95]


def annualize(monthly: DataFrame, how: str, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Sum or mean of twelve months, NULL unless all twelve are present."""
    total = F.sum(value) if how == "sum" else F.avg(value)
    months = F.count_distinct(F.when(F.col(value).isNotNull(), F.col("month")))
    return monthly.groupBy(*keys, "year").agg(F.when(months == 12, total).alias("value"))


def water_value_types(
    monthly: DataFrame, windows: Mapping[int, tuple[int, int]], keys: Sequence[str] = ("scenario", "cell_id"), value: str = "value"
) -> DataFrame:
    """(keys, decade, value_type, value): 0-11 monthly means, 12 their mean, 13-19 annual quantiles.

    Quantiles pool the annual means of every (member, year). Each decade names its own years, since
    the first one is shorter than ten.
    """
    decade = F.when(F.lit(False), F.lit(0))
    for d, (a, b) in windows.items():
        decade = decade.when(F.col("year").between(a, b), F.lit(int(d)))
    rows = monthly.withColumn("decade", decade).where("decade IS NOT NULL")
    out = [*keys, "decade"]
    months = rows.groupBy(*out, "month").agg(F.avg(value).alias("value"))
    types = months.select(*out, (F.col("month") - 1).alias("value_type"), "value")
    annual = months.groupBy(*out).agg(F.avg("value").alias("value")).select(*out, F.lit(12).alias("value_type"), "value")
    member_annual = rows.groupBy(*out, "member", "year").agg(F.avg(value).alias("_a"))
    q = F.percentile("_a", F.array(*[F.lit(x) for x in ANNUAL_QUANTILES]))
    quantiles = member_annual.groupBy(*out).agg(q.alias("_q")).select(*out, F.posexplode("_q").alias("_i", "value"))
    quantiles = quantiles.select(*out, (F.col("_i") + 13).alias("value_type"), "value")
    return types.unionByName(annual).unionByName(quantiles)


def robust_model_stats(monthly: DataFrame, ref_years: tuple[int, int], value: str = "value") -> DataFrame:
    """Median and interquartile range per model of annual means over all cells in the reference years.

    A model's pool is the whole grid, so quantiles come from the distributed rank.
    """
    rows = monthly.where(F.col("year").between(*ref_years))
    means = rows.groupBy("scenario", "member", "model", "cell_id", "year").agg(F.avg(value).alias("_a"))
    q = exact_quantiles(means, "_a", [0.25, 0.5, 0.75], ["model"])
    at = lambda level: F.max(F.when(F.col("q") == level, F.col("quantile")))
    return q.groupBy("model").agg(at(0.5).alias("median"), (at(0.75) - at(0.25)).alias("iqr"))


def per_model(stats: DataFrame, key: str, value: Column) -> Column:
    """The row's own model's value from a table of one row per model.

    An ensemble has some tens of models, each with very many rows: the few values travel as one map, and
    no row is shuffled by its model.
    """
    values = stats.where(F.col(key).isNotNull()).select(F.map_from_entries(F.collect_list(F.struct(F.col(key), value))))
    return F.try_element_at(values.scalar(), F.col(key))


def robust_normalize(
    df: DataFrame, stats: DataFrame, target_mean: float, target_sd: float, value: str = "value"
) -> DataFrame:
    """target_mean + (v - median) / IQR * target_sd; unchanged where the IQR is not positive."""
    joined = df.withColumn("_s", per_model(stats, "model", F.struct(F.col("median").alias("m"), F.col("iqr").alias("i"))))
    joined = joined.withColumns({"_m": F.col("_s.m"), "_i": F.col("_s.i")}).drop("_s")
    scaled = target_mean + (F.col(value) - F.col("_m")) / F.nullif(F.col("_i"), F.lit(0.0)) * target_sd
    return joined.withColumn(value, F.when(F.col("_i") > 0, scaled).otherwise(F.col(value))).drop("_m", "_i")


def threshold_columns(ladder: Sequence[tuple[str, str, float]], value: str = "value") -> list[Column]:
    """One counter per (name, comparison, threshold); comparisons are '>', '<' and '>='."""
    tests = {">": lambda v, t: v > t, "<": lambda v, t: v < t, ">=": lambda v, t: v >= t}
    return [F.count_if(tests[op](F.col(value), F.lit(t))).alias(name) for name, op, t in ladder]


def threshold_counts(daily: DataFrame, ladder: Sequence[tuple[str, str, float]], keys: Sequence[str] = KEYS) -> DataFrame:
    """Days per year beyond every threshold of the ladder, in one pass over the data."""
    return daily.groupBy(*keys, F.year("day").alias("year")).agg(*threshold_columns(ladder))


def precip_intensity(daily: DataFrame, keys: Sequence[str] = KEYS, value: str = "value") -> DataFrame:
    """Wet-day total, wet days and largest daily amount per year."""
    return daily.groupBy(*keys, F.year("day").alias("year")).agg(*intensity_columns(value))


def intensity_columns(value: str = "value") -> list[Column]:
    wet = F.col(value) >= WET_DAY_MM
    return [
        F.coalesce(F.sum(F.when(wet, F.col(value))), F.lit(0.0)).alias("prcptot"),
        F.count_if(wet).alias("wetdays"),
        F.max(value).alias("rx1day"),
    ]


def log_bin(value: str = "value") -> Column:
    raw = F.floor(F.ln(F.col(value)) / math.log(HIST_TOP) * HIST_BINS)
    return F.greatest(F.lit(0), F.least(F.lit(HIST_BINS - 1), raw.cast("int")))


def bin_edge(index: Column) -> Column:
    return F.exp(index * (math.log(HIST_TOP) / HIST_BINS))


def wet_histogram(daily: DataFrame, key: Sequence[str] = ("cell_id",), value: str = "value") -> DataFrame:
    """(key, bin, n) of wet days; counts of parts add up."""
    return daily.where(F.col(value) >= WET_DAY_MM).groupBy(*key, log_bin(value).alias("bin")).agg(F.count("*").alias("n"))


def running_sum_by_bin(hist: DataFrame, key: Sequence[str] = ("cell_id",), n: str = "n") -> DataFrame:
    """Cumulative counts in bin order."""
    w = W.partitionBy(*key).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    return hist.withColumn("running", F.sum(n).over(w))


def hist_percentile(hist: DataFrame, q: float, key: Sequence[str] = ("cell_id",)) -> DataFrame:
    """Percentile per key by linear interpolation inside the containing bin, with the pooled count."""
    total = F.sum("n").over(W.partitionBy(*key))
    cum = running_sum_by_bin(hist, key).withColumn("n_wet", total)
    target = F.col("n_wet") * (q / 100.0)
    inside = cum.where((F.col("running") >= target) & (F.col("running") - F.col("n") < target))
    share = (target - (F.col("running") - F.col("n"))) / F.col("n")
    lo, hi = bin_edge(F.col("bin")), bin_edge(F.col("bin") + 1)
    return inside.select(*key, "n_wet", (lo + share * (hi - lo)).alias("threshold"))


def relative_threshold_counts(
    daily: DataFrame, thresholds: DataFrame, min_wet_days: int, keys: Sequence[str] = KEYS, value: str = "value"
) -> DataFrame:
    """Days per year at or above the cell's own percentile; NULL where the pool is too small."""
    met = with_own_threshold(daily, thresholds, min_wet_days)
    return met.groupBy(*keys, F.year("day").alias("year")).agg(relative_column(value).alias("n_days"))


def with_own_threshold(daily: DataFrame, thresholds: DataFrame, min_wet_days: int) -> DataFrame:
    """`daily` with its cell's percentile as `_t`, NULL where the pool is too small."""
    usable = thresholds.select("cell_id", F.when(F.col("n_wet") >= min_wet_days, F.col("threshold")).alias("_t"))
    return daily.join(usable, "cell_id", "left")


def relative_column(value: str = "value") -> Column:
    return F.when(F.max("_t").isNotNull(), F.count_if(F.col(value) >= F.col("_t")))


def day_number(day: str = "day") -> Column:
    return F.unix_date(day)


def five_day_sums(daily: DataFrame, keys: Sequence[str] = KEYS, value: str = "value") -> DataFrame:
    """Sum of each day and the four before it; absent unless all five days are."""
    return daily.select(*keys, "day", five_day_sum(keys, value).alias("sum5")).where("sum5 IS NOT NULL")


def five_day_sum(keys: Sequence[str] = KEYS, value: str = "value") -> Column:
    w = W.partitionBy(*keys).orderBy(day_number()).rangeBetween(-4, 0)
    return F.when(F.count(value).over(w) == 5, F.sum(value).over(w))


def rx5day(daily: DataFrame, keys: Sequence[str] = KEYS, value: str = "value") -> DataFrame:
    """Largest five-day sum, counted in the year of its last day."""
    return five_day_sums(daily, keys, value).groupBy(*keys, F.year("day").alias("year")).agg(F.max("sum5").alias("rx5day"))


def with_growing_year(daily: DataFrame, start_doy: int) -> DataFrame:
    """Adds `grow_year` (the year it ends in) and `grow_day`, counted from 1 at its first day."""
    y, late = F.year("day"), F.dayofyear("day") >= start_doy
    start_year = F.when(late, y).otherwise(y - 1)
    first = F.date_add(F.make_date(start_year, F.lit(1), F.lit(1)), start_doy - 1)
    return daily.withColumns({"grow_year": start_year + 1, "grow_day": F.datediff("day", first) + 1})


def first_run(
    daily: DataFrame, cond: Column, k: int, start_doy: int, keys: Sequence[str] = KEYS, default: int = 364
) -> DataFrame:
    """First day of the growing year on which the condition has held k days in a row.

    True runs of k days are built; a rule that compares positions k apart would ask for k + 1.
    """
    rows = with_growing_year(daily, start_doy)
    years = rows.groupBy(*keys, "grow_year").agg(F.count("*").alias("_days"))
    series = W.partitionBy(*keys, "grow_year").orderBy("grow_day")
    held = rows.where(cond).withColumn("_island", F.col("grow_day") - F.row_number().over(series))
    run = W.partitionBy(*keys, "grow_year", "_island").orderBy("grow_day")
    reached = held.withColumn("_run", F.row_number().over(run)).where(F.col("_run") == k)
    first = reached.groupBy(*keys, "grow_year").agg(F.min("grow_day").alias("_first"))
    return years.join(first, [*keys, "grow_year"], "left").select(
        *keys, "grow_year", F.coalesce("_first", F.lit(default)).alias("first_day")
    )


def growing_degree_days(
    daily: DataFrame, starts: DataFrame, base: float, thresholds: Sequence[float], start_doy: int,
    keys: Sequence[str] = KEYS, value: str = "value", no_start: int = 364, default: int = 400,
) -> DataFrame:
    """First day the degree-day sum after the start passes each threshold; `default` if it never does."""
    rows = with_growing_year(daily, start_doy).join(starts, [*keys, "grow_year"])
    degree = F.greatest(F.col(value) - base, F.lit(0.0))
    w = W.partitionBy(*keys, "grow_year").orderBy("grow_day").rowsBetween(W.unboundedPreceding, 0)
    after = rows.where((F.col("grow_day") > F.col("first_day")) & (F.col("first_day") < no_start))
    summed = after.withColumn("_gdd", F.sum(degree).over(w))
    hits = [F.min(F.when(F.col("_gdd") > t, F.col("grow_day"))).alias(f"_t{i}") for i, t in enumerate(thresholds)]
    reached = summed.groupBy(*keys, "grow_year").agg(*hits)
    table = F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.coalesce(F.col(f"_t{i}"), F.lit(default)).alias("day_reached"))
        for i, t in enumerate(thresholds)
    ])
    joined = starts.join(reached, [*keys, "grow_year"], "left").withColumn("_x", F.explode(table))
    return joined.select(*keys, "grow_year", "_x.threshold", "_x.day_reached")


def doy_climatology(daily: DataFrame, key: Sequence[str] = ("cell_id",), value: str = "value") -> DataFrame:
    """Median per cell and day of year over members and years."""
    return daily.groupBy(*key, F.dayofyear("day").alias("doy")).agg(F.percentile(value, 0.5).alias("median"))


# Quantile pairs that bound each date band.
DATE_BANDS = [("Q5_to_Q25", 0, 1), ("Q25_to_Q75", 1, 3), ("Q75_to_Q95", 3, 4)]


def season_date_bands(days: DataFrame, start_date: str, key: Sequence[str], value: str = "first_day") -> DataFrame:
    """Quantiles (5, 25, 50, 75, 95 %) of day counts over years as date ranges from a start date."""
    q = F.percentile(value, F.array(*[F.lit(x) for x in (0.05, 0.25, 0.5, 0.75, 0.95)]))
    per = days.groupBy(*key).agg(q.alias("_q"))
    date = lambda i: F.date_add(F.lit(start_date).cast("date"), F.ceil(F.round(F.col("_q")[i], 9)).cast("int"))
    bands = F.array(*[
        F.struct(F.lit(n).alias("band"), date(a).alias("from_date"), date(b).alias("to_date")) for n, a, b in DATE_BANDS
    ])
    return per.select(*key, F.explode(bands).alias("_b")).select(*key, "_b.*")


def lagged_feature(df: DataFrame, n: int, keys: Sequence[str] = KEYS, value: str = "value", order: str = "day") -> DataFrame:
    """Value minus its n-step lag, and the relative change n steps ahead."""
    w = W.partitionBy(*keys).orderBy(order)
    ahead = (F.lead(value, n).over(w) - F.col(value)) / F.nullif(F.col(value), F.lit(0.0))
    return df.withColumns({"lag_difference": F.col(value) - F.lag(value, n).over(w), "ahead_change": ahead})


def linear_fill(df: DataFrame, keys: Sequence[str] = KEYS, value: str = "value", day: str = "day") -> DataFrame:
    """Straight line between the known days on either side of a gap; open ends stay NULL."""
    t = day_number(day)
    known = F.when(F.col(value).isNotNull(), F.struct(t.alias("t"), F.col(value).alias("v")))
    back = W.partitionBy(*keys).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy(*keys).orderBy(day).rowsBetween(0, W.unboundedFollowing)
    both = df.withColumns({"_a": F.last(known, True).over(back), "_b": F.first(known, True).over(ahead)})
    slope = (F.col("_b.v") - F.col("_a.v")) / F.nullif(F.col("_b.t") - F.col("_a.t"), F.lit(0))
    filled = F.coalesce(F.col(value), F.col("_a.v") + slope * (t - F.col("_a.t")))
    return both.withColumn(value, filled).drop("_a", "_b")


# Fixed value: standard deviation of a normal kernel per unit of bandwidth, so that its quartiles
# lie at a quarter of the bandwidth. Weights beyond four standard deviations are dropped.
KERNEL_SD = 0.3706506


def kernel_smooth_time(series: DataFrame, bandwidth: float, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Normal-kernel smoother over the year axis of each series, evaluated at its own years."""
    sd = bandwidth * KERNEL_SD
    reach = int(4 * sd)
    spread = series.withColumn("_d", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
    w = F.exp(-0.5 * (F.col("_d") / sd) * (F.col("_d") / sd))
    have = F.when(F.col(value).isNotNull(), w)
    grouped = spread.groupBy(*keys, (F.col("year") + F.col("_d")).alias("year")).agg(
        F.sum(w * F.col(value)).alias("_wv"), F.sum(have).alias("_w"), F.bool_or(F.col("_d") == 0).alias("_own")
    )
    return grouped.where("_own").select(*keys, "year", (F.col("_wv") / F.nullif(F.col("_w"), F.lit(0.0))).alias("smooth"))


def containment(metrics: DataFrame, chains: Sequence[Sequence[str]]) -> DataFrame:
    """Violations per scenario of 'each metric is at least the next' along the given chains."""
    links = [(a, b) for c in chains for a, b in zip(c, c[1:])]
    counts = [F.count_if(F.col(a) < F.col(b)).alias(f"{a}_ge_{b}") for a, b in links]
    wide = metrics.groupBy("scenario").agg(*counts)
    return wide.unpivot(["scenario"], [f"{a}_ge_{b}" for a, b in links], "rule", "violations")
