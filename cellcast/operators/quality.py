"""Contract checks as tables: (check_name, passed, detail) or one row per violation.

Every verifier reduces its input with one aggregate of counters; only counts leave the executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cellcast.functions.scalar import parse_number
from cellcast.operators.ranking import exact_quantiles
from cellcast.session import cut_lineage

CI_TOLERANCE = 1e-5


def _report(counts: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule from a single row of counters; the detail is the number of violations."""
    rows = F.array(*[
        F.struct(F.lit(n).alias("check_name"), (F.coalesce(v.cast("long"), F.lit(0)) == 0).alias("passed"), F.coalesce(v.cast("long"), F.lit(0)).alias("detail"))
        for n, v in rules.items()
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def verify_panel(panel: DataFrame, grid: DataFrame, baseline: int, step: float = 0.5, higher_is_better: bool = False) -> DataFrame:
    """The published-layer contract. Grid rules use `grid` (cell_id, grow, gcol, lat, lon)."""
    have = lambda c: F.col(c).isNotNull()
    ordered = have("median") & have("lower_ci") & have("upper_ci")
    early = F.col("decade") <= baseline
    slope = have("ols_slope") | have("sen_slope")
    bad_order = (F.col("lower_ci") > F.col("median") + CI_TOLERANCE) | (F.col("median") > F.col("upper_ci") + CI_TOLERANCE)
    # every counter that needs one row at a time is taken while the panel is staged, so its plan runs once
    seen = Observation()
    panel = cut_lineage(panel.observe(
        seen,
        F.count_if(ordered & bad_order).alias("ci"),
        F.count_if((F.col("percentile") < 1 - 1e-4) | (F.col("percentile") > 100 + 1e-4)).alias("range"),
        F.count_if(early & slope).alias("early"),
        (1 - F.max((~early & slope).cast("int"))).alias("later"),
        F.count_if(slope & ~have("median")).alias("leak"),
        F.count_if(F.col("n_models") > F.col("n_members")).alias("depth"),
        F.count_if(F.col("n_members") < 1).alias("members"),
        F.corr(F.when(F.col("decade") == baseline, F.col("median")), F.col("percentile")).alias("orient"),
        F.max("decade").alias("last"),
        F.collect_set("scenario").alias("scenarios"),
    ))
    counted = dict(seen.get)
    last, n_scenarios = counted.pop("last"), len(counted.pop("scenarios") or [])
    # one pass per cell: the baseline must be the same in every scenario, the last decade must not
    at_base = F.col("decade") == baseline
    varies = lambda c: (F.min(F.when(at_base, F.col(c))) != F.max(F.when(at_base, F.col(c)))) | (
        (F.count(F.when(at_base, F.col(c))) > 0) & (F.count(F.when(at_base, F.col(c))) < F.count_if(at_base))
    )
    unlike = [F.coalesce(varies(c), F.lit(False)) for c in ("median", "lower_ci", "upper_ci", "percentile")]
    final = F.when(F.col("decade") == F.lit(last), F.col("median"))
    cells = panel.groupBy("cell_id").agg(
        (unlike[0] | unlike[1] | unlike[2] | unlike[3]).alias("_unlike"),
        F.coalesce(F.min(final) != F.max(final), F.lit(False)).alias("_differs"),
        (F.size(F.collect_set("scenario")) < n_scenarios).alias("_short"),
    )
    per_cell = cells.agg(F.count_if("_unlike").alias("shared"), (1 - F.max(F.col("_differs").cast("int"))).alias("differs"), F.count_if("_short").alias("one_grid"))
    regular = grid.agg(
        F.count_if(F.abs(F.col("lat") - (90 - step / 2 - step * F.col("grow"))) > 1e-6).alias("lat"),
        F.count_if(F.abs(F.col("lon") - (-180 + step / 2 + step * F.col("gcol"))) > 1e-6).alias("lon"),
        F.count_if((F.abs("lat") > 90) | (F.abs("lon") > 180)).alias("globe"),
    )
    names = regular.columns
    row = per_cell.withColumn("_o", regular.select(F.struct(*names)).scalar())
    row = row.select(*per_cell.columns, *[F.col(f"_o.{n}").alias(n) for n in names], *[F.lit(v).cast("double" if n == "orient" else "long").alias(n) for n, v in counted.items()])
    want = F.col("orient") < 0 if higher_is_better else F.col("orient") > 0
    return _report(row, {
        "grid_rows_regular": F.col("lat"), "grid_columns_regular": F.col("lon"), "grid_on_globe": F.col("globe"),
        "scenarios_share_one_grid": F.col("one_grid"), "baseline_shared": F.col("shared"), "last_decade_differs": F.col("differs"),
        "interval_ordered": F.col("ci"), "percentile_in_range": F.col("range"), "percentile_orientation": (~want).cast("int"),
        "no_slope_through_baseline": F.col("early"), "slopes_populated": F.col("later"), "no_slope_without_median": F.col("leak"),
        "members_at_least_one": F.col("members"), "models_within_members": F.col("depth"),
    })


def verify_observed(panel: DataFrame, mask: DataFrame | None, key: Sequence[str], forbidden: Sequence[str] = ("ols_slope", "sen_slope", "n_members", "n_models", "trend")) -> DataFrame:
    """The observed-layer contract; the rank test correlates average ranks of rate and percentile."""
    have = lambda c: F.col(c).isNotNull()
    occupied, empty = F.col("n_events") > 0, F.col("n_events") <= 0
    one = F.col("percentile") == 1.0
    full = have("median") & have("lower_ci") & have("upper_ci")
    own = panel.agg(
        F.lit(sum(c in panel.columns for c in forbidden)).alias("forbidden"),
        F.count_if(full & ((F.col("lower_ci") > F.col("median")) | (F.col("median") > F.col("upper_ci")))).alias("ci"),
        F.count_if((have("median") != have("lower_ci")) | (have("median") != have("upper_ci"))).alias("pattern"),
        F.count_if((F.col("percentile") < 1) | (F.col("percentile") > 100)).alias("range"),
        F.count_if(full & empty & ~F.coalesce(one, F.lit(False))).alias("zero_tier"),
        F.count_if(one & full & ~empty).alias("tier_zero"),
        F.count_if(occupied & ((F.col("percentile") < 2) | (F.col("percentile") > 100))).alias("occupied"),
    )
    from cellcast.operators.compare import spearman

    rho = spearman(panel.where(occupied), "median", "percentile").select("spearman_r").scalar()
    rules = {
        "decadal_columns_absent": F.col("forbidden"), "interval_ordered": F.col("ci"), "one_missingness_pattern": F.col("pattern"),
        "percentile_in_range": F.col("range"), "unobserved_in_zero_tier": F.col("zero_tier"), "zero_tier_unobserved": F.col("tier_zero"),
        "occupied_score_2_to_100": F.col("occupied"), "rank_follows_rate": (F.coalesce(F.col("rho"), F.lit(1.0)) <= 0.999).cast("int"),
    }
    row = own.withColumn("rho", rho)
    if mask is not None:
        out = panel.where(have("median") | have("percentile")).join(mask.select(*key), list(key), "left_anti")
        row = row.withColumn("outside", out.select(F.count("*")).scalar())
        rules["nothing_outside_mask"] = F.col("outside")
    return _report(row, rules)


def verify_delivery(values: DataFrame, assets: DataFrame, locations: DataFrame, layers: DataFrame, counts: Mapping[str, Column] | None = None) -> DataFrame:
    """Integrity, uniqueness, the full expected key set, and status against missing values.

    `layers` has (layer_id, scenarios ARRAY, decades ARRAY); assets carry layer_ids as text.
    """
    from cellcast.functions.scalar import split_list

    keys = ["asset_id", "layer_id", "scenario", "decade"]
    planned = assets.select("asset_id", F.explode(split_list("layer_ids")).alias("layer_id"))
    expected = planned.join(layers, "layer_id").select("asset_id", "layer_id", F.explode("scenarios").alias("scenario"), "decades")
    expected = expected.select("asset_id", "layer_id", "scenario", F.explode("decades").alias("decade"))
    n = lambda df: df.select(F.count("*")).scalar()
    dup = lambda df, k: n(df.groupBy(*k).agg(F.count("*").alias("_n")).where("_n > 1"))
    rules = {
        "assets_have_locations": n(assets.join(locations, "location_id", "left_anti")),
        "values_have_assets": n(values.join(assets.select("asset_id"), "asset_id", "left_anti")),
        "values_have_layers": n(values.join(layers.select("layer_id"), "layer_id", "left_anti")),
        "location_ids_unique": dup(locations, ["location_id"]),
        "asset_ids_unique": dup(assets, ["asset_id"]),
        "value_keys_unique": dup(values, keys),
        "no_missing_rows": n(expected.join(values.select(*keys), keys, "left_anti")),
        "no_extra_rows": n(values.select(*keys).join(expected, keys, "left_anti")),
        "status_matches_value": n(values.where((F.col("data_status") == "OK") != F.col("value").isNotNull())),
    }
    if counts:
        rules.update(counts)
    one = values.sparkSession.range(1)
    names = list(rules)
    row = one.select(*[c.alias(f"_{i}") for i, c in enumerate(rules.values())])
    return _report(row, {name: F.col(f"_{i}") for i, name in enumerate(names)})


def mismatches(delivered: DataFrame, recomputed: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """Rows whose delivered numbers differ from an independent recomputation, or that only one side has."""
    left = delivered.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_in_a"))
    right = recomputed.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(True).alias("_in_b"))
    joined = left.join(right, list(keys), "full")
    wrong = F.col("_in_a").isNull() | F.col("_in_b").isNull()
    for c in columns:
        a, b = F.col(f"_a_{c}"), F.col(f"_b_{c}")
        wrong = wrong | (a.isNull() != b.isNull()) | F.coalesce(F.abs(a - b) > tolerance, F.lit(False))
    return joined.where(wrong).select(*keys)


def verify_water_index(index: DataFrame, keys: Sequence[str] = ("scenario", "cell_id", "decade"), tolerance: float = 1e-3) -> DataFrame:
    """Per scenario and decade: annual against months, quantile order, seasonal variation, ranges."""
    at = lambda i: F.max(F.when(F.col("value_type") == i, F.col("value")))
    months = F.when(F.col("value_type") < 12, F.col("value"))
    wide = index.groupBy(*keys).agg(
        at(12).alias("_annual"), F.avg(months).alias("_mean"), F.stddev_pop(months).alias("_sd"), *[at(i).alias(f"_q{i}") for i in range(13, 20)]
    )
    disorder = F.lit(False)
    for i in range(13, 19):
        disorder = disorder | F.coalesce(F.col(f"_q{i}") > F.col(f"_q{i + 1}"), F.lit(False))
    return wide.groupBy("scenario", "decade").agg(
        F.count("*").alias("n_cells"),
        F.count_if(F.abs(F.col("_annual") - F.col("_mean")) >= tolerance).alias("annual_mismatches"),
        F.count_if(disorder).alias("quantile_violations"),
        F.avg(F.col("_sd") / F.nullif(F.abs("_mean"), F.lit(0.0))).alias("seasonal_cv"),
        F.min("_annual").alias("low"), F.max("_annual").alias("high"),
    )


def cross_scenario_correlation(index: DataFrame, decade: int, a: str, b: str, value_type: int = 12) -> DataFrame:
    """Correlation of two scenarios' maps in a decade in which they should agree."""
    sel = index.where((F.col("decade") == decade) & (F.col("value_type") == value_type))
    side = lambda s, n: F.max(F.when(F.col("scenario") == s, F.col("value"))).alias(n)
    return sel.groupBy("cell_id").agg(side(a, "_a"), side(b, "_b")).agg(F.corr("_a", "_b").alias("correlation"))


def profile_members(annual: DataFrame, baseline: int, late: int, window: int = 10, value: str = "value") -> DataFrame:
    """Per member: coverage, distinct values, shares at zero and at the maximum, range, early and late mean.

    Distinct values are counted after a map-side combine on (member, value).
    """
    keys = ["model", "member", "scenario"]
    top = annual.groupBy(*keys).agg(F.max(value).alias("_top"))
    v = F.col(value)
    joined = annual.join(top, keys)
    tol = F.greatest(F.lit(1e-3), 1e-4 * F.abs("_top"))
    mean_in = lambda d: F.avg(F.when(F.col("year").between(d, d + window - 1), v))
    out = joined.groupBy(*keys).agg(
        (F.count(v) / F.count("*")).alias("finite_share"),
        F.avg(F.when(v.isNotNull(), F.when(v == 0, 1.0).otherwise(0.0))).alias("zero_share"),
        F.avg(F.when(v.isNotNull(), F.when(v >= F.col("_top") - tol, 1.0).otherwise(0.0))).alias("at_max_share"),
        F.min(v).alias("low"), F.max(v).alias("high"), mean_in(baseline).alias("baseline_mean"), mean_in(late).alias("late_mean"),
    )
    unique = annual.where(v.isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c")).groupBy(*keys).agg(F.count("*").alias("n_unique"))
    return out.join(unique, keys, "left")


def cluster_separation(annual: DataFrame, value: str = "value") -> DataFrame:
    """Distance of each model's median from the pooled median, in pooled interquartile ranges."""
    pooled = exact_quantiles(annual, value, [0.25, 0.5, 0.75])
    at = lambda q: F.max(F.when(F.col("q") == q, F.col("quantile")))
    box = pooled.agg(F.struct(at(0.5).alias("m"), (at(0.75) - at(0.25)).alias("i"))).scalar()
    med = exact_quantiles(annual, value, [0.5], ["model"]).withColumn("_p", box)
    return med.select("model", F.col("quantile").alias("median"), ((F.col("quantile") - F.col("_p.m")) / F.nullif(F.col("_p.i"), F.lit(0.0))).alias("separation"))


def layer_report(panel: DataFrame, baseline: int) -> DataFrame:
    """Per scenario and decade: cells, level, spread, mean slopes, mean change against the baseline."""
    keys = ["scenario", "decade"]
    panel = cut_lineage(panel.select(*keys, "cell_id", "median", "lower_ci", "upper_ci", "ols_slope", "sen_slope"))
    base = panel.where(F.col("decade") == baseline).select("scenario", "cell_id", F.col("median").alias("_b"))
    joined = panel.join(base, ["scenario", "cell_id"], "left").withColumn("_w", F.col("upper_ci") - F.col("lower_ci"))
    main = joined.where("median IS NOT NULL").groupBy(*keys).agg(
        F.count("*").alias("n_cells"), F.avg("median").alias("mean"), F.max("median").alias("high"), F.avg("ols_slope").alias("ols_mean"),
        F.avg("sen_slope").alias("sen_mean"), F.avg(F.col("median") - F.col("_b")).alias("change_mean"),
    )
    q = exact_quantiles(panel, "median", [0.5, 0.9], keys).groupBy(*keys).agg(
        F.max(F.when(F.col("q") == 0.5, F.col("quantile"))).alias("p50"), F.max(F.when(F.col("q") == 0.9, F.col("quantile"))).alias("p90")
    )
    width = exact_quantiles(joined, "_w", [0.5], keys).select(*keys, F.col("quantile").alias("ci_width_p50"))
    return main.join(q, keys).join(width, keys)


def time_varying_masks(annual: DataFrame, value: str = "value", keys: Sequence[str] = ("scenario", "member")) -> DataFrame:
    """(keys, cell) whose presence changes over the member's years; a sound member has none."""
    years = annual.groupBy(*keys).agg(F.count_distinct("year").alias("_years"))
    per = annual.groupBy(*keys, "cell_id").agg(F.count(value).alias("n_present"))
    return per.join(years, list(keys)).where((F.col("n_present") > 0) & (F.col("n_present") < F.col("_years"))).select(*keys, "cell_id", "n_present")


def coverage_tiers(annual: DataFrame, value: str = "value") -> DataFrame:
    """Cells and mean level by the number of models that cover them."""
    per = annual.groupBy("cell_id", "model").agg(F.avg(value).alias("_m"))
    cells = per.groupBy("cell_id").agg(F.count("_m").alias("n_models"), F.avg("_m").alias("_level"))
    return cells.groupBy("n_models").agg(F.count("*").alias("n_cells"), F.avg("_level").alias("mean_level"))


def input_checks(rows: DataFrame, position: str = "position") -> DataFrame:
    """(position, problem): untrusted text columns Lat, Lon, Asset_Value and Currency of a site list."""
    lat, lon = F.col("Lat").try_cast("double"), F.col("Lon").try_cast("double")
    value = F.regexp_replace("Asset_Value", r"[,\s]", "").try_cast("double")
    given = lambda c: F.col(c).isNotNull()
    rules = F.array(
        F.when(given("Lat") & lat.isNull(), "non-numeric Lat"),
        F.when(given("Lon") & lon.isNull(), "non-numeric Lon"),
        F.when(~given("Lat") | ~given("Lon"), "missing coordinate"),
        F.when((F.abs(lat) > 90) | (F.abs(lon) > 360), "coordinate out of range"),
        F.when(given("Asset_Value") & value.isNull(), "non-numeric Asset_Value"),
        F.when(value < 0, "negative Asset_Value"),
        F.when(parse_number("Asset_Value").isNotNull() & ~given("Currency"), "value without currency"),
    )
    own = rows.select(F.col(position), F.explode(F.array_compact(rules)).alias("problem"))
    currency = F.upper(F.trim("Currency"))
    kinds = rows.where(given("Asset_Value")).select(F.count_distinct(currency).alias("_n"))
    mixed = kinds.where("_n > 1").select(F.lit(None).cast(rows.schema[position].dataType).alias(position), F.lit("mixed currencies").alias("problem"))
    return own.unionByName(mixed)


def scenario_symmetry(annual: DataFrame) -> DataFrame:
    """Members that not every scenario has: (member, scenarios)."""
    n = annual.select(F.count_distinct("scenario")).scalar()
    per = annual.select("member", "scenario").distinct().groupBy("member").agg(F.array_sort(F.collect_list("scenario")).alias("_s"))
    return per.where(F.size("_s") < n).select("member", F.array_join("_s", ";").alias("scenarios"))


def attributes_must_match(attributes: DataFrame) -> DataFrame:
    """(layer_id, attribute, n_values) where a layer's scenarios declare different values."""
    per = attributes.groupBy("layer_id", "attribute").agg(F.count_distinct(F.coalesce("value", F.lit(""))).alias("n_values"))
    return per.where("n_values > 1")


def reference_site_table(sites: DataFrame, panel: DataFrame, value: str, tolerance: float) -> DataFrame:
    """Value at each named site's own cell against the expected one."""
    from cellcast.operators.spatial import nearest_cell

    placed = nearest_cell(sites)
    got = placed.join(panel.select("grow", "gcol", F.col(value).alias("found")), ["grow", "gcol"], "left")
    verdict = F.when(F.col("found").isNull(), "missing").when(F.abs(F.col("found") - F.col("expected")) <= tolerance, "ok").otherwise("off")
    return got.select("site_id", "expected", "found", verdict.alias("verdict"))


def support_by_band(cells: DataFrame, land: DataFrame, value: str = "value", band: float = 10.0) -> DataFrame:
    """Finite share, land cells and land cells with a value per latitude band."""
    mark = land.select("cell_id").withColumn("_land", F.lit(True))
    joined = cells.join(mark, "cell_id", "left")
    have = F.col(value).isNotNull()
    return joined.groupBy((F.floor(F.col("lat") / band) * band).cast("int").alias("band")).agg(
        (F.count(value) / F.count("*")).alias("finite_share"), F.count("_land").alias("n_land"), F.count_if(F.col("_land") & have).alias("n_land_value")
    )


def lookup_distance(found: DataFrame, levels: Sequence[float] = (0.5, 0.75, 0.9, 0.95, 0.99, 1.0)) -> DataFrame:
    return exact_quantiles(found, "km", levels)


def model_cycle(monthly: DataFrame, value: str = "value") -> DataFrame:
    """Mean by calendar month and model, next to the model's mean of annual means."""
    cycle = monthly.groupBy("model", "month").agg(F.avg(value).alias("month_mean"))
    annual = monthly.groupBy("model", "member", "scenario", "cell_id", "year").agg(F.avg(value).alias("_a"))
    return cycle.join(annual.groupBy("model").agg(F.avg("_a").alias("annual_mean")), "model")


def taxonomy_links(taxonomy: DataFrame, registry: DataFrame) -> DataFrame:
    """(family, layer_id) the taxonomy names and the registry lacks."""
    named = taxonomy.select("family", F.explode("covered_by").alias("layer_id")).distinct()
    return named.join(registry.select("layer_id"), "layer_id", "left_anti").select("family", "layer_id")
