"""Hazard jobs: how each family prepares its series before the shared layer job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.functions.scalar import cell_area_km2, monthly_ratio
from cellcast.operators import compare, daily, decadal, events, filters, graph, grids, ranks, spatial
from cellcast.operators.ranking import exact_quantiles
from cellcast.plans.layer import LayerSpec, build_layer
from cellcast.session import cut_lineage


MEMBER_KEYS = ("scenario", "model", "member", "cell_id")


def fire_layer(monthly: DataFrame, spec: LayerSpec) -> DataFrame:
    """Burnt share: sum of twelve complete months, then the layer job."""
    return build_layer(daily.annualize(monthly, "sum", MEMBER_KEYS), spec)


def smoothed_layer(annual: DataFrame, grid: DataFrame, spec: LayerSpec, kernel: str = "latitude", length: float = 2.5) -> DataFrame:
    """Cyclone and heat exposure: each member's yearly map is smoothed before years are pooled."""
    placed = annual.join(grid.select("cell_id", "grow", "gcol"), "cell_id").select(
        "scenario", "model", "member", "year", "grow", "gcol", spec.value
    )
    keys = ["scenario", "model", "member", "year"]
    smooth = grids.smooth_exp if kernel == "latitude" else grids.smooth_exp_index
    smoothed = smooth(placed, keys, spec.value, length=length)
    back = smoothed.join(grid.select("cell_id", "grow", "gcol"), ["grow", "gcol"]).drop("grow", "gcol")
    return build_layer(back, replace(spec, central="mean"))


def model_capacities(annual: DataFrame, value: str = "value", q: float = 0.99) -> DataFrame:
    """(model, cap): the mode, at 4 decimals, of each model's values from its q-quantile up."""
    cut = exact_quantiles(annual, value, [q], ["model"]).select("model", F.col("quantile").alias("_cut"))
    tail = annual.where(F.col(value) >= daily.per_model(cut, "model", F.col("_cut")))
    counted = tail.groupBy("model", F.round(value, 4).alias("_r")).agg(F.count("*").alias("_n"))
    return counted.groupBy("model").agg(F.max_by("_r", F.struct(F.col("_n"), -F.col("_r"))).alias("cap"))


def permafrost_layer(annual: DataFrame, spec: LayerSpec, min_models: int, rtol: float = 1e-4) -> DataFrame:
    """Thaw depth as a share of each model's soil column, where the baseline still has frozen ground."""
    caps = model_capacities(annual, spec.value)
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(spec.value) / F.col("_cap")))
    capped = annual.withColumn("_cap", daily.per_model(caps, "model", F.col("cap"))).where("_cap IS NOT NULL")
    scaled = capped.withColumn(spec.value, share).drop("_cap")
    subject = filters.baseline_subjects(scaled, spec.baseline, spec.window, 1.0, spec.value, rtol=rtol)
    frozen = scaled.join(subject, ["member", "cell_id"], "left_semi")
    return build_layer(frozen, replace(spec, central="mean", min_models=min_models))


def productivity_layer(annual: DataFrame, cover: DataFrame, spec: LayerSpec, min_cover: float, mode: str = "divide") -> DataFrame:
    """Conifer productivity per tile; more is better, so ranks are inverted."""
    present = filters.presence_mask(annual, cover, ["cell_id", "member", "year"], spec.value, min_cover, mode)
    return build_layer(present, replace(spec, higher_is_better=True))


def flooded_layers(annual: DataFrame, spec: LayerSpec, bound: float, mask_variant: str) -> DataFrame:
    """Flooded share under each protection variant, on one mask taken from the unprotected variant."""
    shown = filters.published_cells(annual.where(F.col("layer") == mask_variant), bound, spec.value)
    return build_layer(annual, replace(spec, by=("layer",)), mask=shown)


def ladder_layers(days: DataFrame, ladder: Sequence[tuple[str, str, float]], spec: LayerSpec) -> DataFrame:
    """One layer per temperature threshold, all counted in a single pass over the daily data."""
    counts = daily.threshold_counts(days, ladder, MEMBER_KEYS)
    long = counts.unpivot([*MEMBER_KEYS, "year"], [n for n, _, _ in ladder], "layer", "value")
    return build_layer(long.withColumn("value", F.col("value").cast("double")), replace(spec, by=("layer",)))


def precipitation_metrics(days: DataFrame, ladder: Sequence[tuple[str, str, float]], q: float, min_wet_days: int, baseline: tuple[int, int]) -> DataFrame:
    """Long (layer, member keys, year, value) of counts, intensity, five-day maximum and relative days.

    One pass makes the cells' percentiles; then the days are dealt out once, by cell, and one window and one
    grouping give every metric.
    """
    pooled = days.where(F.year("day").between(*baseline))
    cut = daily.hist_percentile(daily.wet_histogram(pooled), q)
    met = daily.with_own_threshold(days, cut, min_wet_days).withColumn("_five", daily.five_day_sum(MEMBER_KEYS))
    wide = met.groupBy(*MEMBER_KEYS, F.year("day").alias("year")).agg(
        *daily.threshold_columns(ladder), *daily.intensity_columns(), F.max("_five").alias("rx5day"), daily.relative_column().alias("relative")
    )
    metrics = [n for n, _, _ in ladder] + ["prcptot", "wetdays", "rx1day", "rx5day", "relative"]
    doubles = wide.withColumns({m: F.col(m).cast("double") for m in metrics})
    return doubles.unpivot([*MEMBER_KEYS, "year"], metrics, "layer", "value")


def precipitation_layers(days: DataFrame, ladder, spec: LayerSpec, q: float = 95.0, min_wet_days: int = 840) -> DataFrame:
    """The precipitation family: ranks count from the left in the positive tier."""
    span = (spec.baseline, spec.baseline + spec.window - 1)
    metrics = precipitation_metrics(days, ladder, q, min_wet_days, span)
    return build_layer(metrics, replace(spec, by=("layer",), rank_side="left"))


RATIO_CAP = 100.0


def stress_metrics(monthly: DataFrame, edges: DataFrame, rivers: DataFrame) -> DataFrame:
    """(layer, member keys, year, value) for local and routed, annual and worst-month stress.

    `monthly` has demand, runoff and discharge volumes; demand is accumulated along the river for
    the routed ratio, which exists only in a member's river cells. A year counts when all twelve
    months are defined; ratios are capped last.
    """
    steps = ("scenario", "model", "member", "year", "month")
    routed_demand = graph.accumulate_downstream(edges, monthly.where("demand IS NOT NULL").select("cell_id", *steps, "demand"), "demand", steps)
    flags = rivers.select("member", "cell_id").withColumn("river", F.lit(True))
    parts = []
    for name, routed in (("local", False), ("routed", True)):
        if routed:
            base = monthly.drop("demand").join(routed_demand, ["cell_id", *steps], "left")
            den = "discharge"
        else:
            base, den = monthly, "runoff"
        base = base.join(flags, ["member", "cell_id"], "left")
        ratio = monthly_ratio("demand", den, "river", routed)
        yearly = base.withColumn("_r", ratio).groupBy(*MEMBER_KEYS, "year").agg(
            F.count("_r").alias("_n"), F.sum("demand").alias("_num"), F.sum(den).alias("_den"), F.max("_r").alias("_max")
        )
        full = F.col("_n") == 12
        annual = F.when(full & (F.col("_num") == 0), 0.0).when(full & (F.col("_den") > 0), F.col("_num") / F.nullif(F.col("_den"), F.lit(0.0)))
        cap = lambda c: F.when(c.isNotNull(), F.least(c, F.lit(RATIO_CAP)))
        wide = yearly.withColumns({f"{name}_annual": cap(annual), f"{name}_worst_month": cap(F.when(full, F.col("_max")))})
        parts.append(wide.unpivot([*MEMBER_KEYS, "year"], [f"{name}_annual", f"{name}_worst_month"], "layer", "value"))
    return parts[0].unionByName(parts[1])


def water_stress_layers(monthly: DataFrame, edges: DataFrame, rivers: DataFrame, spec: LayerSpec) -> DataFrame:
    metrics = stress_metrics(monthly, edges, rivers)
    return build_layer(metrics, replace(spec, by=("layer",), baseline_mode="member_mean_first", rank="stress"))


def consensus_members(
    deltas: DataFrame, decades: Sequence[int], window: int, components: DataFrame, tolerance: float = 0.5, body_fail: float = 0.25
) -> DataFrame:
    """(member, grow, gcol, judged, keep): members usable per cell and per water body.

    A member is judged in a cell and panel when at least three members have a value there, against
    the median of all of them; one failure in any panel drops it. A member failing on more than
    `body_fail` of its judged cells in a water body is dropped from the whole body.
    """
    panels = decadal.assign_decades(deltas, decades, window).groupBy("scenario", "decade", "member", "grow", "gcol").agg(F.avg("value").alias("_v"))
    cell = ["scenario", "decade", "grow", "gcol"]
    # members per cell and panel are few, so they travel as one array
    group = panels.where("_v IS NOT NULL").groupBy(*cell).agg(F.percentile("_v", 0.5).alias("_med"), F.count("*").alias("_n"), F.collect_list(F.struct("member", "_v")).alias("_m"))
    judged = group.select(*cell, "_med", "_n", F.explode("_m").alias("_x"))
    flags = judged.select(
        F.col("_x.member").alias("member"), "grow", "gcol", (F.col("_n") >= 3).alias("_j"),
        ((F.col("_n") >= 3) & (F.abs(F.col("_x._v") - F.col("_med")) > tolerance)).alias("_f"),
    )
    per = flags.groupBy("member", "grow", "gcol").agg(F.bool_or("_j").alias("judged"), F.bool_or("_f").alias("_failed"))
    placed = per.join(components.select("grow", "gcol", "component"), ["grow", "gcol"], "left")
    body = placed.where("component IS NOT NULL").groupBy("member", "component").agg(
        (F.count_if("_failed") / F.nullif(F.count_if("judged"), F.lit(0))).alias("_share")
    )
    return placed.join(body, ["member", "component"], "left").select(
        "member", "grow", "gcol", "judged", (~F.col("_failed") & (F.coalesce("_share", F.lit(0.0)) <= body_fail)).alias("keep")
    )


def sea_level_delta(levels: DataFrame, ocean: DataFrame, land: DataFrame, baseline: int, window: int, decades: Sequence[int], tolerance: float, max_km: float) -> DataFrame:
    """Change of water level per member carried to the nearest land cell within `max_km`.

    `levels` has (scenario, member, year, cell_id, grow, gcol, lat, lon, value). The reference is each
    member's baseline mean over scenarios. Only judged and kept ocean cells lend values.
    """
    in_base = F.col("year").between(baseline, baseline + window - 1)
    per = levels.where(in_base).groupBy("scenario", "member", "cell_id").agg(F.avg("value").alias("_m"))
    reference = per.groupBy("member", "cell_id").agg(F.avg("_m").alias("_ref"))
    deltas = levels.join(reference, ["member", "cell_id"]).withColumn("value", F.col("value") - F.col("_ref")).drop("_ref")
    usable = consensus_members(deltas, decades, window, graph.connected_components(ocean), tolerance)
    sources = usable.where("judged AND keep").select("member", "grow", "gcol").join(
        levels.select("grow", "gcol", "cell_id", "lat", "lon").distinct(), ["grow", "gcol"]
    )
    targets = land.select(F.col("cell_id").alias("target_id"), "lat", "lon")
    stock = sources.select(F.col("cell_id").alias("source_id"), "lat", "lon", "member")
    lookup = spatial.nearest_valid(targets, stock, max_km, by=["member"])
    borrowed = lookup.join(deltas.select("scenario", "member", "year", F.col("cell_id").alias("source_id"), "value"), ["member", "source_id"])
    return borrowed.select("scenario", "member", "year", F.col("target_id").alias("cell_id"), "value", "km")


def coastal_panels(exposure: DataFrame, decades: Sequence[int], baseline: int, window: int) -> DataFrame:
    """Exposed share per decade with interval and slopes; the percentile is the pooled mean of its own axis.

    The exposure feeds the panels, the slopes and their axis, so it is written once.
    """
    keys = ["scenario", "cell_id"]
    rows = cut_lineage(exposure.select(*keys, "year", "exposed", "percentile").dropna(subset=keys))
    stats = [c.alias(n) for n, c in decadal.central_columns("exposed", "mean").items()]
    panels = decadal.assign_decades(rows, decades, window).groupBy(*keys, "decade").agg(*stats, F.avg("percentile").alias("percentile"))
    trend = decadal.slopes(rows, decades, baseline, window, "exposed", keys)
    joined = panels.join(trend, [*keys, "decade"], "left")
    return filters.clip_ci(filters.mask_slopes_to_panel(joined), 0.0, 1.0)


def tornado_layer(tracks: DataFrame, n_years: int, res: float, south: float, west: float, n_rows: int, n_cols: int, domain: DataFrame, estimator: str = "posterior") -> DataFrame:
    """Observed crossings per 10^4 km2 and year with quartiles and two-tier rank, over the domain cells."""
    hits = grids.track_cells(tracks, res, south, west, n_rows, n_cols).groupBy("grow", "gcol").agg(F.count("*").alias("n_events"))
    lat = south + (F.col("grow") + 0.5) * res
    cells = domain.join(hits, ["grow", "gcol"], "left").withColumns(
        {"n_events": F.coalesce("n_events", F.lit(0)), "exposure": cell_area_km2(lat, res) / 1e4 * n_years}
    )
    rates = events.poisson_rate_interval(cells, "n_events", "exposure", estimator)
    return ranks.observed_rate_rank(rates, "median", "n_events", "ends", 100.0)


def hail_layer(points: DataFrame, n_years: int, size: float, estimator: str = "mle") -> DataFrame:
    """Observed expected counts per cell as a rate, ranked like the tornado layer (2 for a lone cell)."""
    lat = (F.col("grow") + 0.5) * size
    cells = grids.bin_points(points, size, "amount").select("grow", "gcol", F.col("total").alias("n_events")).withColumn(
        "exposure", cell_area_km2(lat, size) / 1e4 * n_years
    )
    rates = events.poisson_rate_interval(cells, "n_events", "exposure", estimator)
    return ranks.observed_rate_rank(rates, "median", "n_events", "ends", 2.0)


def landslide_layer(pixels: DataFrame, k: int, value: str) -> DataFrame:
    """Block quartiles of hazard pixels, ranked on the areal mean over occupied cells."""
    blocks = grids.block_summary(pixels, k, value)
    return ranks.observed_rate_rank(blocks, "areal_mean", "n_hazard", "mid")


def hail_severity(hist: DataFrame, fut: DataFrame, cell: Column, quantities: Sequence[str]) -> DataFrame:
    """Severity fields of paired events per member and cell, and their ensemble change."""
    both = hist.select("event_id").intersect(fut.select("event_id"))
    keys = ["cell_id", "member"]

    def fields(df: DataFrame) -> DataFrame:
        kept = df.join(both, "event_id", "left_semi").withColumn("cell_id", cell)
        return events.ratio_of_sums(kept, keys)

    h, f = fields(hist), fields(fut)
    parts = [events.ensemble_change(h, f, ["cell_id"], q).withColumn("quantity", F.lit(q)) for q in quantities]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def water_index(monthly: DataFrame, windows: Mapping[int, tuple[int, int]], ref_years: tuple[int, int], target_mean: float, target_sd: float, outliers: Sequence[str]) -> DataFrame:
    """Value types after the named mis-scaled models have been brought to the ensemble's scale."""
    stats = daily.robust_model_stats(monthly, ref_years).where(F.col("model").isin(list(outliers)))
    return daily.water_value_types(daily.robust_normalize(monthly, stats, target_mean, target_sd), windows)


def compare_indices(pairs: DataFrame, keys: Sequence[str] = ("old_scenario", "new_scenario", "value_type", "decade")) -> DataFrame:
    """Per scenario pair, value type and decade: correlations, RMSD, bias and number of cells."""
    both = pairs.where("old_value IS NOT NULL AND new_value IS NOT NULL")
    d = F.col("new_value") - F.col("old_value")
    stats = both.groupBy(*keys).agg(
        F.corr("old_value", "new_value").alias("pearson_r"), F.sqrt(F.avg(d * d)).alias("rmsd"), F.avg(d).alias("bias"), F.count("*").alias("n_valid")
    )
    return stats.join(compare.spearman(pairs, "old_value", "new_value", keys), list(keys))


def split_half_smoothing(crossings: DataFrame, domain: DataFrame, exposure: Column, sigmas: Sequence[float], years: tuple[int, int]) -> DataFrame:
    """Held-out score per smoothing width: fit odd years, score even years, and back.

    `crossings` has (event_id, year, grow, gcol); `exposure` is 10^4 km2 per year of a domain cell.
    Columns: sigma, n_cells, nb_loglik and poisson_loglik per cell, best (by the former).
    """
    from cellcast.functions.vectorized import lgamma

    n_year = {p: sum(1 for y in range(years[0], years[1] + 1) if y % 2 == p) for p in (0, 1)}
    half = F.pmod(F.col("year"), F.lit(2))
    counts = crossings.groupBy("grow", "gcol").agg(*[F.count_if(half == p).alias(f"k{p}") for p in (0, 1)])
    cells = domain.join(counts, ["grow", "gcol"], "left").select(
        "grow", "gcol", exposure.alias("area"), *[F.coalesce(f"k{p}", F.lit(0)).cast("double").alias(f"k{p}") for p in (0, 1)]
    )
    halves = F.explode(F.array(*[
        F.struct(F.lit(p).alias("p"), F.col(f"k{p}").alias("k"), (F.col("area") * n_year[p]).alias("t"), F.col(f"k{1 - p}").alias("ko"), (F.col("area") * n_year[1 - p]).alias("to"))
        for p in (1, 0)
    ]))
    train = cells.select("grow", "gcol", halves.alias("h")).select("grow", "gcol", "h.*").withColumn("rate", F.col("k") / F.col("t"))
    floor = train.where("p = 1").select(F.avg("rate") / 1000.0).scalar()
    held = train.select("grow", "gcol", "p", "ko", "to")
    widths = {f"s{i}": (s, s) for i, s in enumerate(sigmas)}
    long = train.unpivot(["grow", "gcol", "p"], ["k", "t", "rate"], "_what", "value")
    smooth = grids.nan_aware_gaussians(long, ["p", "_what"], widths)
    each = smooth.unpivot(["p", "_what", "grow", "gcol"], list(widths), "_width", "value").groupBy("p", "grow", "gcol", "_width").agg(
        *[F.max(F.when(F.col("_what") == c, F.col("value"))).alias(f"_{c}") for c in ("k", "t", "rate")]
    )
    width = F.create_map(*[x for n, (s, _) in widths.items() for x in (F.lit(n), F.lit(float(s)))])
    every = held.join(each, ["p", "grow", "gcol"]).withColumn("sigma", width[F.col("_width")])
    lam = F.greatest(F.col("_rate"), floor) * F.col("to")
    alpha, share = F.col("_k") + 0.5, F.col("_t") / (F.col("_t") + F.col("to"))
    nb = lgamma(F.col("ko") + alpha) - lgamma(alpha) - lgamma(F.col("ko") + 1.0) + alpha * F.ln(share) + F.col("ko") * F.log1p(-share)
    scored = every.groupBy("sigma").agg(
        F.count("*").alias("n_cells"), F.avg(nb).alias("nb_loglik"), F.avg(F.col("ko") * F.ln(lam) - lam).alias("poisson_loglik")
    )
    top = scored.select(F.max_by("sigma", F.struct(F.col("nb_loglik"), -F.col("sigma")))).scalar()
    return scored.withColumn("best", F.col("sigma") == top)


def leave_one_out(members: DataFrame, keys: Sequence[str] = ("scenario", "cell_id"), n_members: Column | int | None = None) -> DataFrame:
    """(keys, member, value, deviation) from the median of the other members, where all are present.

    A cell's members are few and travel as one array.
    """
    total = n_members if n_members is not None else members.select(F.count_distinct("member")).scalar()
    have = members.where("value IS NOT NULL").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("value", "member"))).alias("_m"))
    full = have.where(F.size("_m") == total)
    each = full.select(*keys, "_m", F.explode("_m").alias("_x"))
    rest = F.transform(F.filter("_m", lambda o: o["member"] != F.col("_x.member")), lambda o: o["value"])
    each = each.withColumn("_o", rest).withColumn("_n", F.size("_o"))
    low, high = F.get("_o", F.floor((F.col("_n") - 1) / 2).cast("int")), F.get("_o", F.floor(F.col("_n") / 2).cast("int"))
    return each.select(*keys, F.col("_x.member").alias("member"), F.col("_x.value").alias("value"), (F.col("_x.value") - (low + high) / 2).alias("deviation"))


def member_deviation_summary(deviations: DataFrame, limits: Sequence[float] = (0.5, 1.0, 2.0), keys: Sequence[str] = ("scenario", "member")) -> DataFrame:
    """Median deviation per member and the percentage of cells beyond each limit."""
    beyond = [
        (100 * F.avg(F.when(F.abs("deviation") > x, 1.0).otherwise(0.0))).alias("pct_over_" + str(x).replace(".", "_")) for x in limits
    ]
    med = exact_quantiles(deviations, "deviation", [0.5], keys).select(*keys, F.col("quantile").alias("median_deviation"))
    return deviations.groupBy(*keys).agg(*beyond).join(med, list(keys))


OFFSETS = [(0.25, 0.0), (-0.25, 0.0), (0.0, 0.25), (0.0, -0.25)]


def extraction_sensitivity(sites: DataFrame, panel: DataFrame, metric: str) -> DataFrame:
    """Largest % change of a site's value when it moves a quarter degree, and the move that did it."""
    moves = F.explode(F.array(*[
        F.struct(F.lit(i).alias("move"), F.lit(a).alias("dlat"), F.lit(b).alias("dlon")) for i, (a, b) in enumerate([(0.0, 0.0), *OFFSETS])
    ]))
    moved = sites.select("site_id", "lat", "lon", moves.alias("_m")).select(
        F.struct("site_id", "_m.move").alias("site_id"), (F.col("lat") + F.col("_m.dlat")).alias("lat"), (F.col("lon") + F.col("_m.dlon")).alias("lon")
    )
    got = spatial.extract_points(moved, panel, [metric], []).select("site_id.site_id", "site_id.move", metric)
    still = got.where("move = 0").select("site_id", F.col(metric).alias("base"))
    shift = F.abs(F.col(metric) - F.col("base")) / F.abs(F.nullif(F.col("base"), F.lit(0.0))) * 100
    shifted = got.where("move > 0").join(still, "site_id").withColumn("_s", shift).where("_s IS NOT NULL")
    worst = F.min(F.struct((-F.col("_s")).alias("s"), F.col("move").alias("move")))
    return shifted.groupBy("site_id", "base").agg(worst.alias("_w")).select("site_id", "base", (-F.col("_w.s")).alias("worst_pct"), F.col("_w.move").alias("move"))


def blend_counts(sites: DataFrame) -> DataFrame:
    """How many cells each site's window draws on, and how many sites draw on that many."""
    per = spatial.cell_weights(sites).groupBy("site_id").agg(F.count("*").alias("n_cells"))
    return per.groupBy("n_cells").agg(F.count("*").alias("n_sites"))
