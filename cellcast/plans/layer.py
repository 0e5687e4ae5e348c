"""From member series to a published layer: one parameterised job for every hazard."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.operators import decadal, filters, ranks
from cellcast.session import cut_lineage


@dataclass(frozen=True)
class LayerSpec:
    """What distinguishes one hazard layer from another."""

    decades: Sequence[int] = field(default_factory=lambda: list(range(2020, 2100, 10)))
    baseline: int = 2020
    window: int = 10
    central: str = "median"
    baseline_mode: str = "pool_all"
    rank: str = "two_tier"  # or 'single', 'stress'
    rank_side: str = "right"
    higher_is_better: bool = False
    ci_floor: float | None = None
    ci_cap: float | None = None
    min_models: int = 1
    mask_zeros: bool = False
    slope_scale: float = 10.0
    value: str = "value"
    by: Sequence[str] = ()  # e.g. ('layer',): build many layers in one job


PANEL_COLUMNS = [
    "scenario", "decade", "cell_id", "median", "lower_ci", "upper_ci", "percentile", "ols_slope", "sen_slope",
    "n_members", "n_models",
]


def prepare(annual: DataFrame, spec: LayerSpec, mask: DataFrame | None = None) -> DataFrame:
    """Member series after land, footprint and coverage rules."""
    rows = annual
    if mask is not None:
        rows = filters.apply_mask(rows, mask)
    if spec.mask_zeros:
        rows = filters.mask_structural_zeros(rows, spec.value)
    if spec.min_models > 1:
        rows = filters.min_models_rule(rows, spec.min_models, spec.value)
    return rows


def build_layer(annual: DataFrame, spec: LayerSpec, mask: DataFrame | None = None) -> DataFrame:
    """Panels of every scenario and decade: central value, interval, rank, slopes, ensemble depth.

    Central values and depth come from one shuffle on (scenario, decade, cell); slopes from another
    of the series on (scenario, cell); the baseline panel is one row per cell and is shared by all scenarios.
    With `spec.by`, all of it happens within each layer.

    The prepared series feeds four branches and the small panels feed the ranks several times, so
    each is written once as a stage table instead of being recomputed per branch.
    """
    by = list(spec.by)
    columns = [*by, "scenario", "model", "member", "cell_id", "year", spec.value]
    rows = cut_lineage(prepare(annual, spec, mask).select(*columns))
    later = [d for d in spec.decades if d != spec.baseline]
    keys = [*by, "scenario", "decade", "cell_id"]
    stack_keys = [*by, "scenario", "cell_id"]

    stats = [c.alias(n) for n, c in decadal.central_columns(spec.value, spec.central).items()]
    pooled = cut_lineage(
        decadal.assign_decades(rows, spec.decades, spec.window).groupBy(*keys).agg(*stats, *decadal.depth_columns(spec.value))
    )
    # depth is each scenario's own; central values of the baseline are replaced by the shared panel
    depth = pooled.select(*keys, "n_members", "n_models")
    own = pooled.where(F.col("decade").isin(later)).select(*keys, "median", "lower_ci", "upper_ci")
    base = cut_lineage(
        decadal.shared_baseline(rows, spec.baseline, spec.baseline_mode, spec.window, spec.central, spec.value, by)
    )
    spread = decadal.spread_to_scenarios(base, pooled.select(*by, "scenario").distinct(), by)
    panels = own.unionByName(spread.select(own.columns))

    if spec.rank == "single":
        ranked = ranks.percentile_of_score(panels, base, "median", spec.rank_side, spec.higher_is_better, by)
    elif spec.rank == "stress":
        ranked = ranks.stress_percentile(panels, base, "median", by)
    else:
        ranked = ranks.two_tier_percentile(panels, base, "median", spec.rank_side, spec.higher_is_better, by)

    axis = decadal.trend_axis(rows.where(F.col("year") >= spec.baseline))
    trend = decadal.slopes(rows, spec.decades, spec.baseline, spec.window, spec.value, stack_keys, axis)
    trend = trend.withColumns({s: F.col(s) * spec.slope_scale for s in ("ols_slope", "sen_slope")})
    joined = ranked.join(trend, keys, "left").join(depth, keys, "left")
    published = filters.clip_ci(filters.mask_slopes_to_panel(joined), spec.ci_floor, spec.ci_cap)
    return published.select(*by, *PANEL_COLUMNS)


def member_baselines(annual: DataFrame, baseline: int, window: int = 10, value: str = "value") -> DataFrame:
    """Diagnostic: each member's mean over the baseline window, all scenarios pooled."""
    rows = annual.where(filters.in_window("year", baseline, window))
    return rows.groupBy("member", "cell_id").agg(F.avg(value).alias("baseline_mean"))
