"""Event statistics: paired hail events, Poisson rates, hypsometry and coastal exposure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellcast.functions.scalar import kinetic_energy_j
from cellcast.functions.vectorized import gamma_quantile
from cellcast.operators.ranking import exact_quantiles

LARGE_MM = 30.0


def ratio_of_sums(stones: DataFrame, cell: Sequence[str], event: str = "event_id", size: str = "landed") -> DataFrame:
    """Pooled and per-storm means per cell, kept apart; areal energy = production x mean energy is asserted.

    Each (cell, event) is summed first, so a cell or storm with most stones is combined map-side.
    """
    d = F.col(size)
    hit = d > 0
    storms = stones.groupBy(*cell, event).agg(
        F.sum(F.when(hit, d)).alias("_sd"), F.sum(F.when(hit, kinetic_energy_j(d))).alias("_ske"),
        F.count_if(hit).alias("_nl"), F.count("*").alias("_ne"),
    )
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    per = storms.groupBy(*cell).agg(
        zero("_sd").alias("_sd"), zero("_ske").alias("_ske"), F.sum("_nl").alias("_nl"), F.sum("_ne").alias("_ne"),
        F.avg(F.col("_sd") / F.nullif(F.col("_nl"), F.lit(0))).alias("storm_mean_diameter"),
        F.avg(F.col("_ske") / F.nullif(F.col("_nl"), F.lit(0))).alias("storm_mean_ke"),
    )
    landed, embryos = F.nullif(F.col("_nl"), F.lit(0)), F.nullif(F.col("_ne"), F.lit(0))
    out = per.select(
        *cell,
        (F.col("_sd") / landed).alias("mean_diameter"), (F.col("_ske") / landed).alias("mean_ke"),
        (F.col("_nl") / embryos).alias("production"), (F.col("_ske") / embryos).alias("ake"),
        "storm_mean_diameter", "storm_mean_ke",
    )
    gap = F.abs(F.col("ake") - F.col("production") * F.col("mean_ke"))
    broken = F.raise_error(F.lit("areal energy is not production times mean energy")).cast("double")
    return out.withColumn("ake", F.when((F.col("ake") > 0) & (gap > 1e-9 * F.col("ake")), broken).otherwise(F.col("ake")))


def ensemble_change(hist: DataFrame, fut: DataFrame, keys: Sequence[str], quantity: str, member: str = "member") -> DataFrame:
    """Per member 100 (f / h - 1), then median, minimum and maximum over members."""
    h = hist.select(*keys, member, F.col(quantity).alias("_h"))
    f = fut.select(*keys, member, F.col(quantity).alias("_f"))
    change = 100.0 * (F.col("_f") / F.when(F.col("_h") > 0, F.col("_h")) - 1.0)
    return h.join(f, [*keys, member]).withColumn("_c", change).groupBy(*keys).agg(
        F.percentile("_c", 0.5).alias("change_pct"), F.min("_c").alias("change_low"), F.max("_c").alias("change_high")
    )


def event_estimands(hist: DataFrame, fut: DataFrame, event: str = "event_id", size: str = "landed") -> DataFrame:
    """Shares and medians on events common to both sides, each denominator named.

    Stones are reduced per event first; medians over all events come from the distributed rank.
    """

    def per_event(df: DataFrame, tag: str) -> DataFrame:
        d = F.col(size)
        return df.groupBy(event).agg(
            F.max(size).alias(f"mhd_{tag}"), F.count("*").alias(f"n_{tag}"), F.count_if(d == 0).alias(f"melted_{tag}"),
            F.count_if(d > 0).alias(f"produced_{tag}"), F.count_if(d >= LARGE_MM).alias(f"large_{tag}"),
            F.coalesce(F.sum(F.when(d > 0, kinetic_energy_j(d))), F.lit(0.0)).alias(f"ke_{tag}"),
        )

    pairs = per_event(hist, "hist").join(per_event(fut, "fut"), event).withColumn("delta", F.col("mhd_fut") - F.col("mhd_hist"))
    out = [F.count("*").alias("n_paired_events")]
    for tag in ("hist", "fut"):
        n = F.sum(f"n_{tag}")
        produced = F.sum(f"produced_{tag}")
        out += [
            (F.sum(f"melted_{tag}") / n).alias(f"embryo_melted_share_{tag}"),
            (F.sum(f"large_{tag}") / n).alias(f"embryo_share_ge30_{tag}"),
            (F.sum(f"large_{tag}") / F.nullif(produced, F.lit(0))).alias(f"produced_share_ge30_{tag}"),
            F.avg(F.when(F.col(f"mhd_{tag}") >= LARGE_MM, 1.0).otherwise(0.0)).alias(f"event_share_ge30_{tag}"),
            F.avg(F.col(f"ke_{tag}") / F.col(f"n_{tag}")).alias(f"ake_{tag}_j"),
        ]
    out += [
        F.avg("delta").alias("paired_mhd_delta_mean"),
        F.avg(F.when(F.col("delta") > 0, 1.0).otherwise(0.0)).alias("paired_share_increasing"),
    ]
    medians = {
        name: exact_quantiles(pairs, c, [0.5]).select("quantile").scalar()
        for name, c in (("event_mhd_median_hist", "mhd_hist"), ("event_mhd_median_fut", "mhd_fut"), ("paired_mhd_delta_median", "delta"))
    }
    return pairs.agg(*out).withColumns(medians)


def poisson_rate_interval(cells: DataFrame, count: str, exposure: str, estimator: str = "posterior") -> DataFrame:
    """Rate with its quartiles: those of Gamma(k + 1/2, rate T), or k / T with the lower bound clipped."""
    shape, rate = (F.col(count) + 0.5).cast("double"), F.col(exposure).cast("double")
    q = lambda p: gamma_quantile(p)(shape, rate)
    if estimator == "posterior":
        out = cells.withColumns({"median": q(0.5), "lower_ci": q(0.25), "upper_ci": q(0.75)})
    elif estimator == "mle":
        out = cells.withColumns({"median": F.col(count) / rate, "lower_ci": q(0.25), "upper_ci": q(0.75)})
        out = out.withColumn("lower_ci", F.least("lower_ci", "median"))
    else:
        raise ValueError(f"estimator must be 'posterior' or 'mle', not {estimator!r}")
    ordered = (F.col("lower_ci") <= F.col("median")) & (F.col("median") <= F.col("upper_ci"))
    failure = F.raise_error(F.lit("rate interval is not ordered")).cast("double")
    return out.withColumn("median", F.when(ordered, F.col("median")).otherwise(failure))


# Elevation bins of 0.05 m over [-30, 30).
BIN_M, FLOOR_M, CEIL_M = 0.05, -30.0, 30.0
# Percentile at sea level, at the low-elevation bound (10 m) and the band between.
P_AT_SEA, P_AT_BOUND, P_HI, P_LO, LECZ_M = 100.0, 1.0, 99.0, 2.0, 10.0


def bin_centre(index: Column) -> Column:
    return FLOOR_M + (index + 0.5) * BIN_M


def hypsometry(pixels: DataFrame, cell: str = "cell_id") -> tuple[DataFrame, DataFrame]:
    """Histogram (cell, bin, n, n_expo) and cell totals of land elevation.

    `wide` marks pixels connected to the sea at 10 m, `near` at 2 m. Land below the floor, above the
    bound or unconnected is counted, not binned, so every share has all land as its base.
    """
    e = F.col("elevation")
    binned = pixels.where("wide").where((e >= FLOOR_M) & (e < LECZ_M)).withColumn("bin", F.floor(F.round((e - FLOOR_M) / BIN_M, 6)).cast("int"))
    hist = binned.groupBy(cell, "bin").agg(F.count("*").alias("n"), F.count_if("near").alias("n_expo"))
    totals = pixels.groupBy(cell).agg(
        F.count_if(F.col("wide") & (e < FLOOR_M)).alias("n_below"),
        F.count_if(F.col("near") & (e < FLOOR_M)).alias("n_below_expo"),
        F.count_if(~F.col("wide") | (e >= LECZ_M)).alias("n_safe"),
        F.count_if(~F.col("wide")).alias("n_unconnected"),
        F.count("*").alias("n_land"),
    )
    return hist, totals


FIRST_BAND, N_BAND = round(-FLOOR_M / BIN_M), round(LECZ_M / BIN_M)


def calibration_curve(hist: DataFrame) -> DataFrame:
    """(bin, p): percentile of an elevation above sea level, from the pooled baseline distribution.

    Fixed once, one row for each of the 200 bins between sea level and 10 m, empty ones included.
    Without any land in that band there is no curve and `p` is NULL.
    """
    axis = hist.sparkSession.range(FIRST_BAND, FIRST_BAND + N_BAND).select(F.col("id").cast("int").alias("bin"))
    pooled = hist.groupBy("bin").agg(F.sum("n").alias("_n"))
    band = axis.join(pooled, "bin", "left").select("bin", F.coalesce("_n", F.lit(0)).alias("_n"))
    whole = W.partitionBy(F.lit(0))
    share = F.sum("_n").over(whole.orderBy("bin")) / F.nullif(F.sum("_n").over(whole), F.lit(0))
    return band.select("bin", (P_HI - (P_HI - P_LO) * share).alias("p"))


def relative_percentile(relative: Column, curve: Column) -> Column:
    """Percentile of an elevation relative to the water: the curve inside the band, fixed outside.

    `curve` is the array of the 200 bin values; bins are uniform, so the knot is found by arithmetic.
    """
    position = (relative - BIN_M / 2) / BIN_M
    knot = F.greatest(F.lit(0), F.least(F.lit(N_BAND - 2), F.floor(position))).cast("int")
    low, high = F.get(curve, knot), F.get(curve, knot + 1)
    inside = low + (high - low) * (position - knot)
    return (
        F.when(relative <= 0, P_AT_SEA)
        .when(relative >= LECZ_M, P_AT_BOUND)
        .when(position < 0, P_HI)
        .when(position > N_BAND - 1, P_LO)
        .otherwise(inside)
    )


def coastal_exposure(hist: DataFrame, totals: DataFrame, curve: DataFrame, levels: DataFrame, cell: str = "cell_id") -> DataFrame:
    """Exposed share and area-weighted percentile per cell and water level.

    `levels` has rows (cell, level_id..., level); bins at or below the level are exposed. A cell's
    histogram is one array of at most 800 bins, so a level meets its cell as one row; its bins are unfolded
    where they are summed, in order.
    """
    ordered = F.array_sort(F.collect_list(F.struct("bin", "p")))
    knots = curve.select(F.transform(ordered, lambda k: k["p"])).scalar()
    ids = [c for c in levels.columns if c != cell]
    bins = hist.groupBy(cell).agg(F.array_sort(F.collect_list(F.struct("bin", "n", "n_expo"))).alias("_h"))
    met = levels.select(cell, "level").distinct().join(bins, cell, "left").select(cell, "level", F.explode_outer("_h").alias("_b"))
    per_bin = met.select(cell, "level", F.round(bin_centre(F.col("_b.bin")) - F.col("level"), 9).alias("_r"), "_b.n", "_b.n_expo")
    term = F.col("n") * relative_percentile(F.col("_r"), knots)
    # without a curve a bin inside the band has no percentile, and so its cell has none
    sums = per_bin.groupBy(cell, "level").agg(
        F.coalesce(F.sum(F.when(F.col("_r") <= 0, F.col("n_expo"))), F.lit(0)).alias("_expo"),
        F.when(F.count(term) == F.count("n"), F.coalesce(F.sum(term), F.lit(0.0))).alias("_num"),
    )
    land = F.nullif(F.col("n_land"), F.lit(0))
    out = sums.join(totals, cell).select(
        cell,
        "level",
        ((F.col("_expo") + F.col("n_below_expo")) / land).alias("exposed"),
        ((F.col("_num") + F.col("n_below") * P_AT_SEA + F.col("n_safe") * P_AT_BOUND) / land).alias("percentile"),
    )
    return levels.select(cell, *ids).join(out, [cell, "level"])
