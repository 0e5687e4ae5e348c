"""Per-cell statistics of decade pools and expanding stacks.

Groups here are one cell's pool, bounded by members x years because `annual` holds one row per
(scenario, member, cell, year). Tables without that guarantee use `ranking.exact_quantiles`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.functions.vectorized import theil_sen, theil_sen_at

MIN_SLOPE_OBS = 3


def decade_axis(decades: Sequence[int]) -> Column:
    """One literal row per decade, for exploding."""
    return F.explode(F.array(*[F.lit(int(d)) for d in decades]))


def assign_decades(annual: DataFrame, decades: Sequence[int], window: int = 10) -> DataFrame:
    """Rows inside some window, labelled with its start. Windows do not overlap, so no row is copied."""
    label = F.when(F.lit(False), F.lit(0))
    for d in decades:
        label = label.when(F.col("year").between(d, d + window - 1), F.lit(int(d)))
    lo, hi = min(decades), max(decades) + window - 1
    return annual.where(F.col("year").between(lo, hi)).withColumn("decade", label).where("decade IS NOT NULL")


def central_columns(value: str, central: str) -> dict[str, Column]:
    """Central value and interval: median with quartiles, or mean with one population sd."""
    v = F.col(value)
    if central == "median":
        q = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        return {"median": q[1], "lower_ci": q[0], "upper_ci": q[2]}
    if central == "mean":
        mean, sd = F.avg(v), F.stddev_pop(v)
        return {"median": mean, "lower_ci": mean - sd, "upper_ci": mean + sd}
    raise ValueError(f"central must be 'median' or 'mean', not {central!r}")


def pooled_decadal_stat(
    annual: DataFrame, decades: Sequence[int], window: int = 10, central: str = "median", value: str = "value",
    keys: Sequence[str] = ("scenario", "cell_id"),
) -> DataFrame:
    """Central value and interval over the pooled (year x member) sample of each decade."""
    stats = [c.alias(n) for n, c in central_columns(value, central).items()]
    return assign_decades(annual, decades, window).groupBy(*keys, "decade").agg(*stats)


def choose_central(panel_pool: DataFrame, value: str = "value", cell: str = "cell_id") -> DataFrame:
    """Evidence for the branch: exact-zero share, exposed cells under either statistic, erased share."""
    cells = panel_pool.groupBy(cell).agg(
        F.percentile(value, 0.5).alias("_med"),
        F.avg(value).alias("_mean"),
        F.count(value).alias("_n"),
        F.count_if(F.col(value) == 0).alias("_zero"),
        F.bool_and(F.col(value).isin(0.0, 1.0)).alias("_bool"),
    )
    exposed_med, exposed_mean = F.count_if(F.col("_med") > 0), F.count_if(F.col("_mean") > 0)
    erased = 1 - exposed_med / F.nullif(exposed_mean, F.lit(0))
    return cells.agg(
        (F.sum("_zero") / F.sum("_n")).alias("zero_share"),
        exposed_med.alias("exposed_median"),
        exposed_mean.alias("exposed_mean"),
        erased.alias("erased_share"),
        F.coalesce(F.bool_and("_bool"), F.lit(False)).alias("is_boolean"),
    ).withColumn("central", F.when(F.col("is_boolean") | (F.col("erased_share") > 0.5), "mean").otherwise("median"))


def shared_baseline(
    annual: DataFrame, baseline: int, mode: str, window: int = 10, central: str = "median", value: str = "value",
    by: Sequence[str] = (),
) -> DataFrame:
    """One baseline panel for every scenario.

    `pool_all` pools the members of all scenarios; `member_mean_first` averages each member across
    scenarios per year and pools those. The numbers differ, so the mode has no default.
    """
    rows = annual.where(F.col("year").between(baseline, baseline + window - 1))
    if mode == "member_mean_first":
        rows = rows.groupBy(*by, "member", "cell_id", "year").agg(F.avg(value).alias(value))
    elif mode != "pool_all":
        raise ValueError(f"mode must be 'pool_all' or 'member_mean_first', not {mode!r}")
    stats = [c.alias(n) for n, c in central_columns(value, central).items()]
    return rows.groupBy(*by, "cell_id").agg(*stats).withColumn("decade", F.lit(int(baseline)))


def spread_to_scenarios(baseline_panel: DataFrame, scenarios: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Copy the baseline panel to each scenario present (a handful of names, carried as one array)."""
    by = list(by)
    if not by:
        names = scenarios.select(F.collect_set("scenario")).scalar()
        return baseline_panel.withColumn("scenario", F.explode(names))
    names = scenarios.groupBy(*by).agg(F.collect_set("scenario").alias("_s"))
    return baseline_panel.join(names, by).withColumn("scenario", F.explode("_s")).drop("_s")


def trend_ends(decades: Sequence[int], baseline: int, window: int) -> dict[int, int]:
    """Last year of the expanding window of every decade that has a trend; the baseline has none."""
    return {int(d): int(d) + window - 1 for d in sorted(decades) if d != baseline}


def trend_axis(rows: DataFrame) -> Column:
    """The distinct years of a table, as a scalar: what the windows span on the shared axis."""
    return rows.select(F.collect_set("year")).scalar()


def _trend_rows(annual: DataFrame, baseline: int, ends: dict[int, int]) -> DataFrame:
    return annual.where(F.col("year").between(baseline, max(ends.values())))


def _by_decade(wide: DataFrame, keys: Sequence[str], ends: dict[int, int], axis: Column, slopes: Sequence[str]) -> DataFrame:
    """From one array per slope, an element a decade, to one row per decade that has begun for the cell.

    A trend needs three years on the shared axis besides what the cell itself needs.
    """
    axis_years = lambda end: F.size(F.filter("_axis", lambda y: y <= end))
    per = {
        str(d): F.when(F.col("_first") <= end, F.struct(*[F.when(axis_years(end) >= 3, F.get(s, k)).alias(s) for s in slopes]))
        for k, (d, end) in enumerate(ends.items())
    }
    # spaces cannot occur in a decade, so the columns clash with no key
    spread = wide.withColumn("_axis", axis).select(*keys, *[c.alias(f" {d}") for d, c in per.items()])
    long = spread.unpivot(list(keys), [f" {d}" for d in per], "decade", "_t")
    return long.where(F.col("_t").isNotNull()).select(*keys, F.trim("decade").cast("int").alias("decade"), *[F.col("_t")[s].alias(s) for s in slopes])


def _ols_columns(ends: dict[int, int], baseline: int, value: str) -> list[Column]:
    """Count and four sums, least and largest value of the years that each decade adds; they merge."""
    x = (F.col("year") - baseline).cast("double")
    y = F.when(F.col(value).isNotNull(), F.col(value)).cast("double")
    out, begin = [], baseline
    for k, end in enumerate(ends.values()):
        here = F.when(F.col("year").between(begin, end) & y.isNotNull(), F.lit(True))
        only = lambda c: F.when(here, c)  # noqa: B023, E731
        out += [
            F.count(here).alias(f"_n{k}"), F.sum(only(x)).alias(f"_x{k}"), F.sum(only(x * x)).alias(f"_xx{k}"),
            F.sum(only(y)).alias(f"_y{k}"), F.sum(only(x * y)).alias(f"_xy{k}"), F.min(only(y)).alias(f"_lo{k}"), F.max(only(y)).alias(f"_hi{k}"),
        ]
        begin = end + 1
    return out


def _ols_array(n_ends: int) -> Column:
    """Slopes from the running totals of the decades' sums; exactly 0 for a constant stack."""
    slopes = []
    for k in range(n_ends):
        total = lambda c: sum((F.coalesce(F.col(f"_{c}{i}"), F.lit(0.0)) for i in range(k + 1)), F.lit(0.0))  # noqa: B023, E731
        least = lambda f, c: f(*[F.col(f"_{c}{i}") for i in range(k + 1)], F.lit(None).cast("double"), F.lit(None).cast("double"))  # noqa: B023, E731
        n, x, xx, y, xy = map(total, ("n", "x", "xx", "y", "xy"))
        spread = n * xx - x * x  # whole numbers: 0 if all points are of one year
        flat = least(F.least, "lo") == least(F.greatest, "hi")
        slopes.append(F.when((n >= MIN_SLOPE_OBS) & (spread > 0), F.when(flat, F.lit(0.0)).otherwise((n * xy - x * y) / spread)))
    return F.array(*slopes)


def ols_slope(
    annual: DataFrame, decades: Sequence[int], baseline: int, window: int = 10, value: str = "value",
    keys: Sequence[str] = ("scenario", "cell_id"), axis: Column | None = None,
) -> DataFrame:
    """Least-squares slope per year over the expanding window of each later decade.

    An observation enters the sums of the one decade that first holds it, before the shuffle; the decades'
    running totals give all slopes of a cell. `axis` is `trend_axis` of a table that holds the same years
    and is cheaper to read; else `annual` is read for it once more.
    """
    ends = trend_ends(decades, baseline, window)
    rows = _trend_rows(annual, baseline, ends)
    sums = rows.groupBy(*keys).agg(F.min("year").alias("_first"), *_ols_columns(ends, baseline, value))
    wide = sums.select(*keys, "_first", _ols_array(len(ends)).alias("ols_slope"))
    return _by_decade(wide, keys, ends, trend_axis(rows) if axis is None else axis, ["ols_slope"])


def _guarded_sen(ends: dict[int, int]) -> Column:
    """Slopes of the ends at which the cell has at least three observations."""
    n = lambda end: F.size(F.filter("_points", lambda p: p["y"] <= end))
    return F.array(*[F.when(n(end) >= MIN_SLOPE_OBS, F.get("_sen", F.lit(k))) for k, end in enumerate(ends.values())])


def _points(value: str) -> Column:
    return F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col("year").alias("y"), F.col(value).cast("double").alias("v"))))


def sen_slope(
    annual: DataFrame, decades: Sequence[int], baseline: int, window: int = 10, value: str = "value",
    keys: Sequence[str] = ("scenario", "cell_id"), axis: Column | None = None,
) -> DataFrame:
    """Exact median pairwise slope per year over the expanding window of each later decade.

    A cell's series is shuffled once, as one array, and one call returns the slopes of all decades;
    each decade adds its new pairs to those before it.
    """
    ends = trend_ends(decades, baseline, window)
    rows = _trend_rows(annual, baseline, ends)
    series = rows.groupBy(*keys).agg(F.min("year").alias("_first"), _points(value).alias("_points"))
    wide = series.withColumn("_sen", theil_sen_at(list(ends.values()))("_points")).select(*keys, "_first", _guarded_sen(ends).alias("sen_slope"))
    return _by_decade(wide, keys, ends, trend_axis(rows) if axis is None else axis, ["sen_slope"])


def slopes(
    annual: DataFrame, decades: Sequence[int], baseline: int, window: int = 10, value: str = "value",
    keys: Sequence[str] = ("scenario", "cell_id"), axis: Column | None = None,
) -> DataFrame:
    """Both slopes from one shuffle of the series."""
    ends = trend_ends(decades, baseline, window)
    rows = _trend_rows(annual, baseline, ends)
    series = rows.groupBy(*keys).agg(F.min("year").alias("_first"), _points(value).alias("_points"), *_ols_columns(ends, baseline, value))
    wide = series.withColumn("_sen", theil_sen_at(list(ends.values()))("_points")).select(
        *keys, "_first", _ols_array(len(ends)).alias("ols_slope"), _guarded_sen(ends).alias("sen_slope")
    )
    return _by_decade(wide, keys, ends, trend_axis(rows) if axis is None else axis, ["ols_slope", "sen_slope"])


def depth_columns(value: str = "value") -> list[Column]:
    """Members and model families with any value in the window; NULL when none.

    Sets rather than distinct counts: a handful of names per cell, and no row expansion.
    """
    have = F.col(value).isNotNull()
    return [
        F.nullif(F.size(F.collect_set(F.when(have, F.col("member")))), F.lit(0)).alias("n_members"),
        F.nullif(F.size(F.collect_set(F.when(have, F.col("model")))), F.lit(0)).alias("n_models"),
    ]


def ensemble_depth(
    annual: DataFrame, decades: Sequence[int], window: int = 10, value: str = "value",
    keys: Sequence[str] = ("scenario", "cell_id"),
) -> DataFrame:
    return assign_decades(annual, decades, window).groupBy(*keys, "decade").agg(*depth_columns(value))


def two_stage_stat(
    annual: DataFrame, decades: Sequence[int], order: str, window: int = 10, value: str = "value"
) -> DataFrame:
    """Superseded estimators: 'models_then_years' (mean, median) or 'years_then_members' (mean, +/- sd)."""
    rows = assign_decades(annual, decades, window)
    if order == "models_then_years":
        yearly = rows.groupBy("scenario", "cell_id", "decade", "year").agg(F.avg(value).alias("_v"))
        stats = central_columns("_v", "median")
    else:
        yearly = rows.groupBy("scenario", "cell_id", "decade", "member").agg(F.avg(value).alias("_v"))
        stats = central_columns("_v", "mean")
    return yearly.groupBy("scenario", "cell_id", "decade").agg(*[c.alias(n) for n, c in stats.items()])


def anchored_trend(panel: DataFrame, baseline: int, keys: Sequence[str] = ("scenario", "cell_id")) -> DataFrame:
    """(median - baseline median) per elapsed year; 0 at the baseline."""
    base = panel.where(F.col("decade") == baseline).select(*keys, F.col("median").alias("_base"))
    rise = (F.col("median") - F.col("_base")) / F.nullif(F.col("decade") - baseline, F.lit(0))
    out = F.when(F.col("decade") == baseline, F.when(F.col("median").isNotNull(), 0.0)).otherwise(rise)
    return panel.join(base, list(keys), "left").withColumn("trend", out).drop("_base")


def per_member_trend(annual: DataFrame, value: str = "value") -> DataFrame:
    """Robust slope and Spearman rho per member, then their medians over members.

    A member's yearly series is first averaged over scenarios, so each year ranks once.
    """
    yearly = annual.groupBy("cell_id", "member", "year").agg(F.avg(value).alias(value)).where(F.col(value).isNotNull())
    pair = F.struct(F.col("year").alias("y"), F.col(value).alias("v"))
    series = yearly.groupBy("cell_id", "member").agg(
        F.sort_array(F.collect_list(pair)).alias("_s"), F.count("*").alias("_n")
    )
    below = lambda s, x: F.size(F.filter(s, lambda o: o["v"] < x))
    upto = lambda s, x: F.size(F.filter(s, lambda o: o["v"] <= x))
    ranks = F.transform("_s", lambda p: (below(F.col("_s"), p["v"]) + upto(F.col("_s"), p["v"]) + 1) / 2)
    ranked = series.withColumn("_r", ranks)
    per = ranked.select("cell_id", "member", theil_sen("_s").alias("slope"), F.posexplode("_r").alias("_t", "_rank"))
    stats = per.groupBy("cell_id", "member").agg(
        F.first("slope").alias("slope"), F.count("*").alias("_n"), F.corr("_t", "_rank").alias("rho")
    )
    stats = stats.where("_n >= 3")
    return stats.groupBy("cell_id").agg(
        F.percentile("slope", 0.5).alias("slope"), F.percentile("rho", 0.5).alias("rho"), F.count("*").alias("n_members")
    )
