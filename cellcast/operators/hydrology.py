"""Hydrological comparisons, seasonal sums, quantile bands and extremes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def area_weighted_basin_mean(basin_cells: DataFrame, climate: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Mean per basin (and `by`), weighted by cell area; cells without a value carry no weight."""
    met = basin_cells.select("basin_id", "cell_id", "area_km2").join(climate, "cell_id")
    area = F.when(F.col(value).isNotNull(), F.col("area_km2"))
    return met.groupBy("basin_id", *by).agg((F.sum(F.col(value) * area) / F.sum(area)).alias("mean"))


def goodness_of_fit(pairs: DataFrame, keys: Sequence[str], obs: str = "obs", sim: str = "sim", n_predictors: int = 1) -> DataFrame:
    """KGE, NSE, MAE and adjusted R2 of simulated against observed series."""
    both = pairs.where(F.col(obs).isNotNull() & F.col(sim).isNotNull())
    o, s = F.col(obs), F.col(sim)
    agg = both.groupBy(*keys).agg(
        F.corr(sim, obs).alias("_r"),
        F.stddev(sim).alias("_ss"), F.stddev(obs).alias("_so"),
        F.avg(sim).alias("_ms"), F.avg(obs).alias("_mo"),
        F.sum((o - s) * (o - s)).alias("_sse"), F.var_pop(obs).alias("_vo"),
        F.count("*").alias("n"), F.avg(F.abs(o - s)).alias("mae"),
    )
    sq = lambda c: c * c
    safe = lambda a, b: a / F.nullif(b, F.lit(0.0))
    kge = 1 - F.sqrt(sq(F.col("_r") - 1) + sq(safe(F.col("_ss"), F.col("_so")) - 1) + sq(safe(F.col("_ms"), F.col("_mo")) - 1))
    nse = 1 - safe(F.col("_sse"), F.col("_vo") * F.col("n"))
    spare = F.nullif((F.col("n") - n_predictors - 1).cast("double"), F.lit(0.0))
    adjusted = 1 - (1 - sq(F.col("_r"))) * (F.col("n") - 1) / spare
    return agg.select(*keys, "n", kge.alias("kge"), nse.alias("nse"), "mae", adjusted.alias("adj_r2"))


def water_year_sums(daily: DataFrame, keys: Sequence[str], day: str = "day", obs: str = "obs", sim: str = "sim") -> DataFrame:
    """Water-year, April-July and October-March totals of both series (year starts in October)."""
    m = F.month(day)
    year = F.year(F.add_months(day, 3))
    spring, winter = m.between(4, 7), (m >= 10) | (m <= 3)
    sums = [
        F.sum(F.when(cond, F.col(c))).alias(f"{c}_{name}")
        for name, cond in (("annual", F.lit(True)), ("apr_jul", spring), ("oct_mar", winter))
        for c in (obs, sim)
    ]
    return daily.groupBy(*keys, year.alias("water_year")).agg(*sums)


def water_year_r2(sums: DataFrame, keys: Sequence[str], obs: str = "obs", sim: str = "sim") -> DataFrame:
    return sums.groupBy(*keys).agg(
        *[F.regr_r2(f"{obs}_{s}", f"{sim}_{s}").alias(f"r2_{s}") for s in ("annual", "apr_jul", "oct_mar")]
    )


def yearly_extremes(series: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    return series.groupBy(*keys, "year").agg(
        F.min(value).alias("low"), F.avg(value).alias("mean"), F.max(value).alias("high")
    )


def annual_extreme_change(series: DataFrame, keys: Sequence[str], baseline: int, window: int = 10, value: str = "value") -> DataFrame:
    """Yearly minimum, mean and maximum as % change against the baseline decade's medians."""
    yearly = yearly_extremes(series, keys, value)
    in_base = F.col("year").between(baseline, baseline + window - 1)
    parts = ("low", "mean", "high")
    base = yearly.where(in_base).groupBy(*keys).agg(*[F.percentile(p, 0.5).alias(f"_{p}") for p in parts])
    joined = yearly.join(base, list(keys))
    change = [((F.col(p) / F.nullif(F.col(f"_{p}"), F.lit(0.0)) - 1) * 100).alias(f"{p}_change") for p in parts]
    return joined.select(*keys, "year", *change)


def decade_difference(series: DataFrame, keys: Sequence[str], baseline: int, decades: Sequence[int], window: int = 10, value: str = "value") -> DataFrame:
    """Median of yearly minima per later decade minus the baseline median."""
    from cellcast.operators.decadal import assign_decades

    yearly = yearly_extremes(series, keys, value)
    med = assign_decades(yearly, [baseline, *decades], window).groupBy(*keys, "decade").agg(F.percentile("low", 0.5).alias("_m"))
    base = med.where(F.col("decade") == baseline).select(*keys, F.col("_m").alias("_b"))
    later = med.where(F.col("decade") != baseline)
    return later.join(base, list(keys)).select(*keys, "decade", (F.col("_m") - F.col("_b")).alias("difference"))


QUANTILE_LEVELS = [0.05, 0.25, 0.5, 0.75, 0.95]


def quantile_columns(value: str, prefix: str, levels: Sequence[float] = QUANTILE_LEVELS) -> list[Column]:
    q = F.percentile(value, F.array(*[F.lit(x) for x in levels]))
    return [q[i].alias(f"{prefix}{int(round(x * 100)):02d}") for i, x in enumerate(levels)]


def ensemble_quantiles(forecast: DataFrame, history: DataFrame, keys: Sequence[str], lead: str = "lead", value: str = "value") -> DataFrame:
    """Quantiles of forecast members next to climatology over the same days of year, per lead."""
    f = forecast.groupBy(*keys, lead).agg(*quantile_columns(value, "f"))
    days = forecast.select(*keys, lead, F.dayofyear("day").alias("_doy")).distinct()
    pooled = days.join(history.withColumn("_doy", F.dayofyear("day")).select(*keys, "_doy", value), [*keys, "_doy"])
    c = pooled.groupBy(*keys, lead).agg(*quantile_columns(value, "c"))
    return f.join(c, [*keys, lead], "left")


def low_flow_days(series: DataFrame, keys: Sequence[str], qs: Sequence[float] = (0.04, 0.10, 0.20), value: str = "value") -> DataFrame:
    """Days at or below each series' own q-quantile: threshold, count, mean and minimum of those days.

    Thresholds come from the exact distributed quantiles, as one series may hold most rows.
    """
    from cellcast.operators.ranking import exact_quantiles

    cut = exact_quantiles(series, value, qs, keys).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("q", "quantile"))).alias("_cuts")
    )
    tagged = series.join(cut, list(keys)).withColumn("_c", F.explode("_cuts"))
    low = tagged.where(F.col(value) <= F.col("_c.quantile"))
    return low.groupBy(*keys, F.col("_c.q").alias("q")).agg(
        F.max("_c.quantile").alias("threshold"), F.count("*").alias("n_days"), F.avg(value).alias("mean"), F.min(value).alias("lowest")
    )


def best_parameters(runs: DataFrame, keys: Sequence[str], score: str, run: str = "run_id", n: int = 1) -> DataFrame:
    """The n runs with the largest score per key, ties by run id.

    Each task keeps its own best n per key before the shuffle, so no key gathers all its runs.
    """
    from pyspark.sql import Window as W

    order = [F.col(score).desc_nulls_last(), F.col(run)]
    part = F.pmod(F.xxhash64(run), F.lit(32))
    local = runs.withColumn("_p", part).withColumn("_k", F.row_number().over(W.partitionBy(*keys, "_p").orderBy(*order)))
    top = local.where(F.col("_k") <= n).withColumn("position", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return top.where(F.col("position") <= n).drop("_p", "_k")


def significance_shares(cells: DataFrame, populations: dict[str, Column], p: str = "p_value", slope: str = "slope", alpha: float = 0.05) -> DataFrame:
    """Share of cells with p < alpha and, of those, the share positive, per named population."""
    hit = F.col(p) < alpha
    parts = []
    for name, cond in populations.items():
        share = F.avg(F.when(hit, 1.0).otherwise(0.0))
        positive = F.avg(F.when(hit, F.when(F.col(slope) > 0, 1.0).otherwise(0.0)))
        parts.append(cells.where(cond).agg(share.alias("significant"), positive.alias("positive")).withColumn("population", F.lit(name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
