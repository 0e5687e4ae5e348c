"""Scores, vulnerability, balanced panels and rollups of a delivered portfolio.

`values` holds one row per (asset_id, layer_id, scenario, decade); `scores` one per (asset_id,
scenario_tier, decade). Configuration tables (families, weights) are small and left for the
optimizer to broadcast after it has checked their size.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.functions.scalar import (
    TIER_ORDER,
    is_forcing,
    join_list,
    risk_band,
    slopes_agree,
    split_list,
    tier_of,
    tier_rank,
)


def half_even(c: Column, digits: int) -> Column:
    """Half-even rounding of the double itself; the first rounding removes summation-order noise."""
    scale = 10.0**digits
    return F.rint(F.round(c, 9) * scale) / scale


def climate_score(values: DataFrame, assets: DataFrame, families: DataFrame, weights: DataFrame) -> DataFrame:
    """Mean of family percentiles per (asset, tier, decade).

    Codes are averaged within a layer, layers within a family, families within the asset. Observed
    families have no forcing and enter every (tier, decade) cell the asset already has as a
    constant. An asset without any forcing family has no rows.
    """
    weighted = weights.where("weight = 1").select("asset_type", "family")
    scope = assets.select("asset_id", "asset_type").join(weighted, "asset_type").select("asset_id", "family")
    expected = scope.groupBy("asset_id").agg(F.count_distinct("family").alias("n_hazards_expected"))
    rows = (
        values.where("percentile IS NOT NULL")
        .select("asset_id", "layer_id", "scenario", "decade", "percentile")
        .join(families, "layer_id")
        .join(scope, ["asset_id", "family"])
    )
    forcing = is_forcing("scenario")

    def to_family(part: DataFrame, cell: Sequence[str]) -> DataFrame:
        per_layer = part.groupBy("asset_id", "family", "layer_id", *cell).agg(
            F.avg("percentile").alias("_p"), F.collect_set("scenario").alias("_codes")
        )
        return per_layer.groupBy("asset_id", "family", *cell).agg(
            F.avg("_p").alias("pct"), F.collect_set("layer_id").alias("layers"), F.flatten(F.collect_list("_codes")).alias("codes")
        )

    cell = ["scenario_tier", "decade"]
    projected = to_family(rows.where(forcing).withColumn("scenario_tier", tier_of("scenario")), cell)
    observed = to_family(rows.where(~forcing), [])
    grid = projected.select("asset_id", *cell).distinct()
    constant = grid.join(observed, "asset_id")
    every = projected.unionByName(constant.select(projected.columns))
    scored = every.groupBy("asset_id", *cell).agg(
        half_even(F.avg("pct"), 2).alias("climate_score"),
        F.count("*").alias("n_hazards"),
        join_list(F.collect_set("family")).alias("hazards"),
        join_list(F.flatten(F.collect_list("layers"))).alias("layers"),
        join_list(F.flatten(F.collect_list("codes"))).alias("scenarios"),
    )
    return scored.join(expected, "asset_id").select(
        "asset_id", *cell, "climate_score", "n_hazards", "n_hazards_expected", "hazards", "layers", "scenarios"
    )


def vulnerability(values: DataFrame, assets: DataFrame, hazards: DataFrame, threshold: float | Column) -> DataFrame:
    """Per (asset, tier, decade): worst hazard percentile and status.

    Mean over codes within a hazard, maximum over hazards. No assessed hazard is NOT_ASSESSED,
    which is not the same as NOT_VULNERABLE.
    """
    listed = assets.select("asset_id", F.explode(split_list("layer_ids")).alias("layer_id"))
    expected = listed.join(hazards.select("layer_id"), "layer_id", "left_semi").groupBy("asset_id").agg(
        F.count("*").alias("n_hazards_expected")
    )
    rows = values.join(hazards.select("layer_id"), "layer_id", "left_semi").withColumn("scenario_tier", tier_of("scenario"))
    per_hazard = (
        rows.where("scenario_tier IS NOT NULL")
        .groupBy("asset_id", "scenario_tier", "decade", "layer_id")
        .agg(F.avg("percentile").alias("_p"))
    )
    # ties go to the layer that sorts first
    worst = per_hazard.groupBy("asset_id", "scenario_tier", "decade").agg(
        F.max("_p").alias("worst_percentile"),
        F.min_by("layer_id", F.when(F.col("_p").isNotNull(), F.struct(-F.col("_p"), "layer_id"))).alias("worst_hazard"),
        F.count("_p").alias("n_hazards_assessed"),
    )
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    p = F.col("worst_percentile")
    status = F.when(p.isNull(), "NOT_ASSESSED").when(p >= limit, "VULNERABLE").otherwise("NOT_VULNERABLE")
    joined = worst.withColumn("status", status).join(expected, "asset_id", "left")
    return joined.withColumn("n_hazards_expected", F.coalesce("n_hazards_expected", F.lit(0)))


def vulnerability_rollup(frame: DataFrame, assets: DataFrame, tier: str, decade: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts, shares and amounts at one (tier, decade); unassessed assets stay out of the rate."""
    totals = assets.agg(F.count("*").alias("n_total"), F.sum("asset_value").alias("amount_total"))
    sel = frame.where((F.col("scenario_tier") == tier) & (F.col("decade") == decade))
    sel = sel.join(assets.select("asset_id", "asset_value"), "asset_id")
    hit, seen = F.col("status") == "VULNERABLE", F.col("status") != "NOT_ASSESSED"
    out = sel.groupBy(*by).agg(
        F.count_if(seen).alias("n_assessed"),
        F.count_if(hit).alias("n_vulnerable"),
        F.coalesce(F.sum(F.when(hit, F.col("asset_value"))), F.lit(0.0)).alias("amount_vulnerable"),
        F.coalesce(F.sum(F.when(seen, F.col("asset_value"))), F.lit(0.0)).alias("amount_assessed"),
    )
    out = out.withColumns(
        {"n_total": totals.select("n_total").scalar(), "amount_total": totals.select("amount_total").scalar()}
    )
    return out.withColumns(
        {
            "pct_of_assessed": 100.0 * F.col("n_vulnerable") / F.nullif(F.col("n_assessed"), F.lit(0)),
            "pct_of_portfolio": 100.0 * F.col("n_vulnerable") / F.nullif(F.col("n_total"), F.lit(0)),
        }
    )


def vulnerability_sensitivity(
    frame: DataFrame, assets: DataFrame, tier: str, decade: int, thresholds: Sequence[float], chosen: float
) -> DataFrame:
    """The rollup at the chosen threshold and at its neighbours, from one pass over the frame."""
    axis = F.explode(F.array(*[F.lit(float(t)) for t in sorted({*thresholds, chosen})]))
    p = F.col("worst_percentile")
    status = F.when(p.isNull(), "NOT_ASSESSED").when(p >= F.col("threshold"), "VULNERABLE").otherwise("NOT_VULNERABLE")
    spread = frame.withColumn("threshold", axis).withColumn("status", status)
    return vulnerability_rollup(spread, assets, tier, decade, ["threshold"]).withColumn("is_chosen", F.col("threshold") == chosen)


def balanced_assets(scores: DataFrame, tiers: Sequence[str] | None = None, decades: Sequence[int] | None = None) -> DataFrame:
    """Assets with a score in every (tier, decade) cell compared; None means all that occur.

    Scores are unique per (asset, tier, decade), so counting an asset's rows counts its cells.
    """
    kept = scores.select("asset_id", "scenario_tier", "decade")
    if tiers is not None:
        kept = kept.where(F.col("scenario_tier").isin(list(tiers)))
    if decades is not None:
        kept = kept.where(F.col("decade").isin(list(decades)))
    if tiers is not None and decades is not None:
        needed = F.lit(len(set(tiers)) * len(set(decades)))
    else:
        occurring = kept.select(F.size(F.collect_set("scenario_tier")) * F.size(F.collect_set("decade")))
        needed = occurring.scalar()
    have = kept.groupBy("asset_id").agg(F.count("*").alias("_n"))
    return have.where(F.col("_n") == needed).select("asset_id")


def balanced_assets_by_family_set(scores: DataFrame, tiers: Sequence[str], decades: Sequence[int]) -> DataFrame:
    """Assets whose hazard set is the same in all decades within each tier (it may differ between tiers)."""
    kept = scores.where(F.col("scenario_tier").isin(list(tiers)) & F.col("decade").isin(list(decades)))
    per_tier = kept.groupBy("asset_id", "scenario_tier").agg(
        F.count_distinct("decade").alias("_n"), F.min("hazards").alias("_lo"), F.max("hazards").alias("_hi")
    )
    steady = per_tier.where((F.col("_n") == len(set(decades))) & (F.col("_lo") == F.col("_hi")))
    return steady.groupBy("asset_id").agg(F.count("*").alias("_t")).where(F.col("_t") == len(set(tiers))).select("asset_id")


def portfolio_series(scores: DataFrame) -> DataFrame:
    """(scenario_tier, decade, mean_score, kept): mean score on the balanced panel.

    A decade is kept only when every panel asset is complete in every tier; a dropped decade is one
    row without a tier, so the caller sees what was left out. Each asset's cells travel as one
    array (at most tiers x decades), so the panel test needs no second join.
    """
    axes = scores.agg(F.collect_set("scenario_tier").alias("tiers"), F.collect_set("decade").alias("decades"))
    needed = axes.select(F.size("tiers") * F.size("decades")).scalar()
    complete = F.col("n_hazards") >= F.col("n_hazards_expected")
    cell = F.struct("scenario_tier", "decade", "climate_score", complete.alias("complete"))
    panel = scores.groupBy("asset_id").agg(F.collect_list(cell).alias("_cells")).where(F.size("_cells") == needed)
    cells = panel.select(F.explode("_cells").alias("c")).select("c.*")
    per_cell = cells.groupBy("decade", "scenario_tier").agg(
        F.avg("climate_score").alias("mean_score"), F.bool_and("complete").alias("_all")
    )
    per_decade = per_cell.groupBy("decade").agg(
        F.bool_and("_all").alias("_kept"), F.collect_list(F.struct("scenario_tier", "mean_score")).alias("_tiers")
    )
    every = axes.select(F.explode("decades").alias("decade")).join(per_decade, "decade", "left")
    none = F.array(F.struct(F.lit(None).cast("string").alias("scenario_tier"), F.lit(None).cast("double").alias("mean_score")))
    kept = F.coalesce("_kept", F.lit(False))
    shown = every.select("decade", kept.alias("kept"), F.explode(F.when(kept, F.col("_tiers")).otherwise(none)).alias("t"))
    return shown.select("t.scenario_tier", "decade", "t.mean_score", "kept")


def baseline_spread(series: DataFrame, baseline: int, tolerance: float = 0.05) -> DataFrame:
    """Spread of the baseline score across tiers; beyond the tolerance it is a composition artifact."""
    at_base = series.where(F.col("decade") == baseline).where("mean_score IS NOT NULL")
    out = at_base.agg(F.count("*").alias("n_tiers"), (F.max("mean_score") - F.min("mean_score")).alias("spread"))
    return out.withColumn("passed", (F.col("n_tiers") < 2) | (F.col("spread") <= tolerance))


def change_vs_baseline(scores: DataFrame, tiers: Sequence[str], baseline: int, decade: int) -> DataFrame:
    """Mean score now, at the baseline, and their difference, over assets comparable in both."""
    panel = balanced_assets_by_family_set(scores, tiers, [baseline, decade])
    kept = scores.where(F.col("scenario_tier").isin(list(tiers))).join(panel, "asset_id", "left_semi")
    at = lambda d: F.avg(F.when(F.col("decade") == d, F.col("climate_score")))
    return kept.agg(at(decade).alias("now"), at(baseline).alias("base"), F.count_distinct("asset_id").alias("n_assets")).withColumn(
        "change", F.col("now") - F.col("base")
    )


def mean_percentile_by(values: DataFrame, assets: DataFrame, key: str) -> DataFrame:
    """Mean percentile and five-band counts per tier, decade and asset attribute."""
    rows = values.withColumn("scenario_tier", tier_of("scenario")).join(assets.select("asset_id", key), "asset_id")
    band = risk_band("percentile")
    counts = [
        F.count_if(band == label).alias("n_" + label.lower().replace(" ", "_"))
        for label in ("Very Low", "Low", "Medium", "High", "Very High")
    ]
    return rows.groupBy(key, "scenario_tier", "decade").agg(F.avg("percentile").alias("mean_percentile"), *counts)


def tier_gaps(values: DataFrame) -> DataFrame:
    """(layer_id, scenario_tier) for every tier in which a layer publishes no scenario."""
    tiers = F.array(*[F.lit(t) for t in TIER_ORDER])
    have = values.groupBy("layer_id").agg(F.collect_set(tier_of("scenario")).alias("_have"))
    return have.select("layer_id", F.explode(F.array_except(tiers, "_have")).alias("scenario_tier"))


def tier_collisions(values: DataFrame) -> DataFrame:
    """Layers in which two scenario codes fall in one tier."""
    per = values.withColumn("scenario_tier", tier_of("scenario")).where("scenario_tier IS NOT NULL")
    grouped = per.groupBy("layer_id", "scenario_tier").agg(F.collect_set("scenario").alias("_codes"))
    return grouped.where(F.size("_codes") > 1).select("layer_id", "scenario_tier", join_list("_codes").alias("scenarios"))


def coverage_summary(taxonomy: DataFrame, values: DataFrame) -> DataFrame:
    """Hazard families (family, covered_by ARRAY) and whether this delivery evidences them."""
    present = values.select("layer_id").distinct().withColumn("_here", F.lit(True))
    listed = taxonomy.select("family", F.explode_outer("covered_by").alias("layer_id")).join(present, "layer_id", "left")
    return listed.groupBy("family").agg(
        F.coalesce(F.bool_or("_here"), F.lit(False)).alias("covered"),
        join_list(F.collect_set(F.when(F.col("_here"), F.col("layer_id")))).alias("layers"),
    )


def trend_table(values: DataFrame, layers: DataFrame, decade: int) -> DataFrame:
    """Long-horizon slope per asset and hazard by the layer's recommended estimator, at its highest tier."""
    rows = values.where(F.col("decade") == decade).withColumn("_rank", tier_rank(tier_of("scenario"))).where("_rank < 99")
    top = rows.groupBy("layer_id").agg(F.max("_rank").alias("_rank"))
    slope = F.when(F.col("recommended") == "ols", F.col("ols_slope")).otherwise(F.col("sen_slope"))
    return (
        rows.join(top, ["layer_id", "_rank"])
        .join(layers.select("layer_id", "recommended"), "layer_id")
        .select("asset_id", "layer_id", "scenario", slope.alias("slope"), slopes_agree("ols_slope", "sen_slope").alias("agree"))
    )


def caveat_rules(
    layers: DataFrame, values: DataFrame, scores: DataFrame, vulnerability_frame: DataFrame, locations: DataFrame,
    assets: DataFrame, taxonomy: DataFrame, config: DataFrame,
) -> DataFrame:
    """(rule, severity, subject, n): one row per triggered disclosure rule.

    `layers` carries saturation_share, zero_share, n_models, smoothing, relative_baseline, reviewed_on and
    is_hazard; `assets` asset_type, layer_source and asset_value; `taxonomy` (family, layer_id) of all families,
    with NULL where none covers one; `config` (item, source) of the report's settings.
    """

    def of_layer(rule: str, severity: str, cond: Column) -> DataFrame:
        return layers.where(cond).select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.col("layer_id").alias("subject"), F.lit(1).cast("long").alias("n"))

    def of_rows(rule: str, severity: str, df: DataFrame, subject: Column) -> DataFrame:
        counted = df.groupBy(subject.cast("string").alias("subject")).agg(F.count("*").alias("n"))
        return counted.where("n > 0").select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "subject", "n")

    everything = F.lit("delivery")
    delivered = values.select("layer_id").distinct()
    seen = taxonomy.join(delivered.withColumn("_seen", F.lit(True)), "layer_id", "left").groupBy("family").agg(F.max("_seen").alias("_seen"))
    scored = scores.select(F.explode(split_list("layers")).alias("layer_id")).distinct()
    mixed = layers.where(~F.col("is_hazard")).join(scored, "layer_id", "left_semi").join(delivered, "layer_id", "left_semi")
    parts = [
        # what the delivery covers, who has looked at it, and what it was asked to do
        of_rows("HAZARD-COVERAGE", "must", seen.where("_seen IS NULL"), F.col("family")),
        of_rows("QA-UNREVIEWED", "must", layers.where("reviewed_on IS NULL").join(delivered, "layer_id", "left_semi"), F.col("layer_id")),
        of_rows("CATALOG-UNCONFIRMED", "must", assets.where("layer_source = 'catalog'"), F.col("asset_type")),
        of_rows("HORIZONS-DEFAULT", "must", config.where("item = 'horizons' AND lower(source) = 'default'"), everything),
        of_rows("ASSET-VALUES-ABSENT", "must", assets.where("asset_value IS NULL"), everything),
        # how the numbers were made
        of_layer("RELATIVE-BASELINE", "must", F.col("relative_baseline")),
        of_layer("SATURATION", "must", F.col("saturation_share") > 0.05),
        of_layer("SPARSITY", "should", F.col("zero_share") > 0.5),
        of_layer("SINGLE-MODEL", "must", F.col("n_models") == 1),
        of_layer("SMOOTHED", "should", F.col("smoothing").isNotNull()),
        # sites and assets
        of_rows("UNASSESSED-ASSET", "must", vulnerability_frame.where("status = 'NOT_ASSESSED'"), F.col("asset_id")),
        of_rows("DERIVED-COORDINATE", "must", locations.where("coord_source <> 'supplied'"), F.col("location_id")),
        # the score
        of_rows("SCORE-MIXED-AXES", "must", mixed, F.col("layer_id")),
        of_rows("SCORE-OBSERVED-CONSTANT", "must", scores.where(F.array_contains(split_list("scenarios"), "observed")), everything),
        of_rows("SCORE-INCOMPLETE-ROWS", "should", scores.where("n_hazards < n_hazards_expected"), everything),
        of_rows("PANEL-UNBALANCED", "should", tier_gaps(values), F.col("layer_id")),
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def legacy_decade_columns(values: DataFrame, assets: DataFrame, key: str, decades: Sequence[int]) -> DataFrame:
    """Mean percentile per layer and group, one column per decade."""
    rows = values.join(assets.select("asset_id", key), "asset_id")
    wide = rows.groupBy(key, "layer_id").pivot("decade", list(decades)).agg(F.avg("percentile"))
    return wide.withColumnsRenamed({str(d): f"d{d}" for d in decades})


def legacy_significant_change(values: DataFrame, baseline: int, decade: int, significant: Column) -> DataFrame:
    """Mean change of value against the baseline per layer, over significant rows only."""
    keys = ["asset_id", "layer_id", "scenario"]
    base = values.where(F.col("decade") == baseline).select(*keys, F.col("value").alias("_b"))
    later = values.where((F.col("decade") == decade) & significant).join(base, keys)
    return later.groupBy("layer_id").agg(F.avg(F.col("value") - F.col("_b")).alias("mean_change"), F.count("*").alias("n_rows"))


def six_number_summary(values: DataFrame, value: str = "percentile") -> DataFrame:
    """Minimum, quartiles, mean and maximum per layer and decade, exact for any group size."""
    from cellcast.operators.ranking import exact_quantiles

    keys = ["layer_id", "decade"]
    q = exact_quantiles(values, value, [0.25, 0.5, 0.75], keys).groupBy(*keys).agg(
        *[F.max(F.when(F.col("q") == lv, F.col("quantile"))).alias(n) for lv, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    )
    return values.groupBy(*keys).agg(F.min(value).alias("low"), F.avg(value).alias("mean"), F.max(value).alias("high")).join(q, keys)


def split_region_text(text: Column | str) -> dict[str, Column]:
    """'region, country' -> two columns; text without a comma is a country alone."""
    parts = F.split(text, ",")
    two = F.size(parts) > 1
    return {"region": F.when(two, F.trim(parts[0])), "country": F.trim(F.element_at(parts, -1))}


def worst_hazard_per_asset(values: DataFrame) -> DataFrame:
    """Layer with the largest percentile per (asset, tier, decade); ties to the first layer id."""
    rows = values.where("percentile IS NOT NULL").withColumn("scenario_tier", tier_of("scenario")).where("scenario_tier IS NOT NULL")
    best = F.min(F.struct((-F.col("percentile")).alias("neg"), F.col("layer_id").alias("layer")))
    return rows.groupBy("asset_id", "scenario_tier", "decade").agg(best.alias("_b")).select(
        "asset_id", "scenario_tier", "decade", F.col("_b.layer").alias("worst_hazard"), (-F.col("_b.neg")).alias("percentile")
    )


def ranked_assets(frame: DataFrame, tier: str, decade: int) -> DataFrame:
    """Assets by worst percentile, missing last, ties by asset id."""
    sel = frame.where((F.col("scenario_tier") == tier) & (F.col("decade") == decade))
    return sel.orderBy(F.col("worst_percentile").desc_nulls_last(), "asset_id")


def highest_risk_location(scores: DataFrame, assets: DataFrame, tier: str, decade: int) -> DataFrame:
    """The location with the largest mean score (ties to the smaller id): a top-1 report."""
    sel = scores.where((F.col("scenario_tier") == tier) & (F.col("decade") == decade))
    per = sel.join(assets.select("asset_id", "location_id"), "asset_id").groupBy("location_id").agg(F.avg("climate_score").alias("mean_score"))
    return per.orderBy(F.desc("mean_score"), "location_id").limit(1)
