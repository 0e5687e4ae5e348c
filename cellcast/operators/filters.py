"""Windows, masks and value rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellcast.operators.ranking import quantile_scalar


def in_window(year: Column | str, start: int | Column, length: int = 10, baseline: int | None = None) -> Column:
    """Year inside [start, start+length-1]; with `baseline`, the expanding window from there."""
    y = F.col(year) if isinstance(year, str) else year
    first = F.lit(baseline) if baseline is not None else start
    return y.between(first, start + length - 1)


def is_boolean_field(df: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """Whether every non-null value is 0 or 1; false when there is none."""
    test = F.coalesce(F.bool_and(F.col(value).isin(0.0, 1.0)), F.lit(False))
    return df.groupBy(*by).agg(test.alias("is_boolean"))


def apply_mask(df: DataFrame, mask: DataFrame, on: Sequence[str] = ("cell_id",), invert: bool = False) -> DataFrame:
    return df.join(mask.select(*on), list(on), "left_anti" if invert else "left_semi")


def mask_structural_zeros(df: DataFrame, value: str = "value", keys: Sequence[str] = ("member", "cell_id")) -> DataFrame:
    """NULL wherever a member never records a positive value at the cell over its whole record."""
    footprint = df.groupBy(*keys).agg(F.coalesce(F.bool_or(F.col(value) > 0), F.lit(False)).alias("_ever"))
    return df.join(footprint, list(keys)).withColumn(value, F.when(F.col("_ever"), F.col(value))).drop("_ever")


def cells_covered_by(df: DataFrame, k: int, value: str = "value", cell: str = "cell_id", model: str = "model") -> DataFrame:
    """Cells with a value from at least `k` models, and how many."""
    n = F.count_distinct(F.when(F.col(value).isNotNull(), F.col(model)))
    return df.groupBy(cell).agg(n.alias("n_models")).where(F.col("n_models") >= k)


def min_models_rule(df: DataFrame, k: int, value: str = "value", cell: str = "cell_id", model: str = "model") -> DataFrame:
    return df.join(cells_covered_by(df, k, value, cell, model).select(cell), cell, "left_semi")


def always_at_bound(df: DataFrame, bound: float, value: str = "value", cell: str = "cell_id") -> DataFrame:
    """Cells at or above `bound` in every year of every member, a missing value counting as 0."""
    at_bound = F.bool_and(F.coalesce(F.col(value), F.lit(0.0)) >= bound)
    return df.groupBy(cell).agg(at_bound.alias("_at")).where("_at").select(cell)


def published_cells(df: DataFrame, bound: float, value: str = "value", cell: str = "cell_id", member: str = "member") -> DataFrame:
    """Cells every member covers, less the permanent ones."""
    n_members = df.select(F.count_distinct(member)).scalar()
    covered = df.where(F.col(value).isNotNull()).groupBy(cell).agg(F.count_distinct(member).alias("_n"))
    return covered.where(F.col("_n") == n_members).select(cell).join(
        always_at_bound(df, bound, value, cell), cell, "left_anti"
    )


def presence_mask(
    df: DataFrame, cover: DataFrame, keys: Sequence[str], value: str = "value", min_cover: float = 0.02, mode: str = "divide"
) -> DataFrame:
    """Keep values where the land-cover share reaches `min_cover`; cover above 1.5 means percent."""
    top = cover.select(F.max("cover")).scalar()
    share = F.col("cover") / F.when(top > 1.5, 100.0).otherwise(1.0)
    joined = df.join(cover.select(*keys, "cover"), list(keys), "left").withColumn("_share", share)
    kept = F.col(value) / F.col("_share") if mode == "divide" else F.col(value)
    return joined.withColumn(value, F.when(F.col("_share") >= min_cover, kept)).drop("_share", "cover")


def capacity(df: DataFrame, value: str = "value", q: float = 0.99) -> Column:
    """Most frequent value (4 decimals, smallest on a tie) at or above the q-quantile, as a scalar."""
    tail = df.where(F.col(value) >= quantile_scalar(df, value, q)).withColumn("_r", F.round(value, 4))
    counted = tail.groupBy("_r").agg(F.count("*").alias("_n"))
    return counted.select(F.max_by("_r", F.struct(F.col("_n"), -F.col("_r")))).scalar()


def normalize_by_capacity(df: DataFrame, value: str = "value", rtol: float = 1e-3) -> DataFrame:
    """Share of the cap, clipped to [0, 1]. The cap must be the top of the range."""
    checked = df.withColumns({"_cap": capacity(df, value), "_top": df.select(F.max(value)).scalar()})
    sound = (F.col("_top") >= F.col("_cap")) & (F.col("_top") <= F.col("_cap") * (1 + rtol))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(value) / F.col("_cap")))
    failure = F.raise_error(F.lit("the modal cap is not the top of the range")).cast("double")
    result = F.when(F.col(value).isNotNull(), F.when(sound, share).otherwise(failure))
    return checked.withColumn(value, result).drop("_cap", "_top")


def baseline_subjects(
    df: DataFrame, baseline: int, window: int, cap: float, value: str = "value", cell: str = "cell_id", rtol: float = 1e-4
) -> DataFrame:
    """(member, cell) whose baseline maximum stays below the cap in some scenario."""
    tops = df.where(in_window("year", baseline, window)).groupBy("scenario", "member", cell).agg(F.max(value).alias("_m"))
    return tops.groupBy("member", cell).agg(F.bool_or(F.col("_m") < cap * (1 - rtol)).alias("_s")).where("_s").drop("_s")


def member_river_mask(df: DataFrame, threshold: float, baseline: int, window: int, value: str = "value") -> DataFrame:
    """(member, cell) whose baseline mean discharge exceeds the threshold."""
    means = df.where(in_window("year", baseline, window)).groupBy("member", "cell_id").agg(F.avg(value).alias("_q"))
    return means.where(F.col("_q") > threshold).drop("_q")


def clip_ci(df: DataFrame, floor: float | None = None, cap: float | None = None) -> DataFrame:
    """Bound lower_ci from below and upper_ci from above; NULL stays NULL."""
    cols = {}
    if floor is not None:
        cols["lower_ci"] = F.when(F.col("lower_ci").isNotNull(), F.greatest("lower_ci", F.lit(floor)))
    if cap is not None:
        cols["upper_ci"] = F.when(F.col("upper_ci").isNotNull(), F.least("upper_ci", F.lit(cap)))
    return df.withColumns(cols)


def unit_convert(value: Column | str, factor: float = 1.0, offset: float = 0.0) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return c * factor + offset


def flux_to_volume(flux, area_km2, land_percent, seconds) -> Column:
    """kg m-2 s-1 over the land part of a cell -> cubic metres per step."""
    return F.col(flux) * (F.col(area_km2) * 1e6) * (F.col(land_percent) / 100.0) * F.col(seconds) / 1000.0


def measured_scale(df: DataFrame, value: str, order: str, limit: float, factor: float = 1.0, offset: float = 0.0) -> DataFrame:
    """Convert the column when the mean of the first record shows the raw unit (e.g. Kelvin > 100)."""
    first = df.select(F.min(order)).scalar()
    level = df.where(F.col(order) == first).select(F.avg(value)).scalar()
    return df.withColumn(value, F.when(level > limit, F.col(value) * factor + offset).otherwise(F.col(value)))


def standard_set(registry: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Reviewed layers of a deliverable status, less the explicit exclusions."""
    kept = registry.where(F.col("status").isin("preferred", "alternate") & F.col("reviewed_on").isNotNull())
    return kept if excluded is None else kept.join(excluded.select("layer_id"), "layer_id", "left_anti")


def decade_policy(values: DataFrame, baseline: int = 2020) -> DataFrame:
    """Keep decades from the baseline on; a layer with none keeps its latest, relabelled."""
    latest = values.groupBy("layer_id").agg(F.max("decade").alias("_latest"))
    joined = values.join(latest, "layer_id")
    recent = F.col("_latest") >= baseline
    kept = joined.where((recent & (F.col("decade") >= baseline)) | (~recent & (F.col("decade") == F.col("_latest"))))
    return kept.withColumn("decade", F.when(recent, F.col("decade")).otherwise(F.lit(baseline))).drop("_latest")


def mask_slopes_to_panel(df: DataFrame, central: str = "median") -> DataFrame:
    have = F.col(central).isNotNull()
    return df.withColumns({s: F.when(have, F.col(s)) for s in ("ols_slope", "sen_slope")})


def prefer_variant(files: DataFrame, ranking: Sequence[str], keys: Sequence[str] = ("model", "gcm", "scenario")) -> DataFrame:
    """All files of the best-ranked variant present per key."""
    rank = F.array_position(F.array(*[F.lit(r) for r in ranking]), F.col("soc"))
    order = F.when(rank == 0, len(ranking) + 1).otherwise(rank)
    best = W.partitionBy(*keys)
    return (
        files.withColumn("_o", order)
        .withColumn("_best", F.min("_o").over(best))
        .where("_o = _best")
        .drop("_o", "_best")
    )


def common_variant(files: DataFrame, dimension: str, ranking: Sequence[str], keys: Sequence[str] = ("model", "gcm")) -> DataFrame:
    """Per member the best soc present at every level of `dimension`, else the best per level.

    Columns: keys, dimension, soc, shared (false = the fallback was needed).
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in ranking]), F.col("soc"))
    seen = files.select(*keys, dimension, "soc").distinct().withColumn(
        "_o", F.when(rank == 0, len(ranking) + 1).otherwise(rank)
    )
    levels = seen.groupBy(*keys).agg(F.count_distinct(dimension).alias("_levels"))
    spans = seen.groupBy(*keys, "soc").agg(F.count_distinct(dimension).alias("_span"), F.min("_o").alias("_so"))
    shared = (
        spans.join(levels, list(keys))
        .where("_span = _levels")
        .groupBy(*keys)
        .agg(F.min_by("soc", F.struct("_so", "soc")).alias("_shared"))
    )
    best = seen.groupBy(*keys, dimension).agg(F.min_by("soc", F.struct("_o", "soc")).alias("_level_best"))
    return best.join(shared, list(keys), "left").select(
        *keys,
        dimension,
        F.coalesce("_shared", "_level_best").alias("soc"),
        F.col("_shared").isNotNull().alias("shared"),
    )
