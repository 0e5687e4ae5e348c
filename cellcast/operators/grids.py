"""Grid geometry, neighbourhood kernels and block statistics.

Cells carry integer row and column keys. Smoothing kernels run over tiles with a halo (`tiles`); the
neighbourhoods of one cell's width are a scatter: each cell is exploded to the targets it contributes to
and summed per target. One shuffle, no self join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.operators import tiles
from cellcast.operators.tiles import Tiling


def offsets(radius_rows: int, radius_cols: int, weight=None) -> list[tuple[int, int, float]]:
    out = []
    for di in range(-radius_rows, radius_rows + 1):
        for dj in range(-radius_cols, radius_cols + 1):
            out.append((di, dj, 1.0 if weight is None else weight(di, dj)))
    return out


def offset_table(items: Sequence[tuple[int, int, float]]) -> Column:
    return F.array(*[
        F.struct(F.lit(int(i)).alias("di"), F.lit(int(j)).alias("dj"), F.lit(float(w)).alias("w")) for i, j, w in items
    ])


def wrapped(col: Column, n_cols: int | None) -> Column:
    return col if n_cols is None else F.pmod(col, F.lit(n_cols))


def _scatter(df: DataFrame, items, n_cols: int | None, row: str, col: str) -> DataFrame:
    exploded = df.withColumn("_o", F.explode(offset_table(items)))
    return exploded.withColumns(
        {"_row": (F.col(row) + F.col("_o.di")).cast("int"), "_col": wrapped(F.col(col) + F.col("_o.dj"), n_cols).cast("int")}
    )


def _weighted(tiling: Tiling, items, weight, sums, rows, norm):
    """Weighted sum of the values and sum of the weights on the tiles' own cells."""
    total, weights = np.zeros(tiles.own(sums, tiling).shape), np.zeros(tiles.own(sums, tiling).shape)
    for di, dj, fixed in items:
        w = weight(rows, di, dj) if weight else fixed
        total += w * tiles.own(sums, tiling, di, dj)
        weights += w * tiles.own(norm, tiling, di, dj)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(weights != 0, total / weights, np.nan)


def smooth_exp(
    df: DataFrame, keys: Sequence[str], value: str = "value", length: float = 2.5, radius: int = 2, n_cols: int = 720,
    lat0: float = 89.75, step: float = 0.5, row: str = "grow", col: str = "gcol",
) -> DataFrame:
    """Exponential kernel with longitude steps shortened by cos(lat) of the target row.

    Rows of `df` are the member's fixed mask: a NULL value counts 0 in the sum and still weighs in
    the normaliser, so every year is normalised alike. Longitude wraps; rows off the edge do not exist.
    """
    tiling = Tiling.around(radius, radius, n_cols)
    items = offsets(radius, radius)

    def weight(rows, di, dj):
        lat = lat0 - step * (rows[:, None] * tiling.height + np.arange(tiling.height))
        east = dj * np.cos(np.radians(lat))
        return np.exp(-np.sqrt(di * di + east * east) / length)[:, :, None]

    def kernel(rows, sums, there, _):
        smooth = _weighted(tiling, items, weight, sums, rows, there)
        return [np.where(tiles.own(there, tiling) > 0, smooth, np.nan)]

    return tiles.convolve(df, keys, value, tiling, kernel, [value], row, col)


def smooth_exp_index(
    df: DataFrame, keys: Sequence[str], value: str = "value", length: float = 2.5, radius: int = 2, n_cols: int = 720,
    row: str = "grow", col: str = "gcol",
) -> DataFrame:
    """Exponential kernel on index distance, normalised over the neighbours that have a value."""
    items = offsets(radius, radius, lambda i, j: math.exp(-math.sqrt(i * i + j * j) / length))
    return _smooth_present(df, keys, value, Tiling.around(radius, radius, n_cols), {value: items}, row, col)


def _smooth_present(df, keys, value, tiling, kernels, row, col):
    """One column per kernel: sum(w v) / sum(w) over the values present, on the cells that have one."""

    def kernel(rows, sums, _, have):
        here = tiles.own(have, tiling) > 0
        return [np.where(here, _weighted(tiling, items, None, sums, rows, have), np.nan) for items in kernels.values()]

    return tiles.convolve(df, keys, value, tiling, kernel, list(kernels), row, col)


def gaussian_radii(sigma_y: float, sigma_x: float, truncate: float) -> tuple[int, int]:
    return int(truncate * sigma_y + 0.5), int(truncate * sigma_x + 0.5)


def _gaussian(sigma_y: float, sigma_x: float, truncate: float) -> list[tuple[int, int, float]]:
    def weight(i: int, j: int) -> float:
        a = i * i / (2 * sigma_y**2) if sigma_y > 0 else 0.0
        b = j * j / (2 * sigma_x**2) if sigma_x > 0 else 0.0
        return math.exp(-a - b)

    return offsets(*gaussian_radii(sigma_y, sigma_x, truncate), weight)


def nan_aware_gaussian(
    df: DataFrame, keys: Sequence[str], sigma_y: float, sigma_x: float, value: str = "value", truncate: float = 4.0,
    row: str = "grow", col: str = "gcol",
) -> DataFrame:
    """Normalised Gaussian convolution cut at `truncate` sigmas, without wrapping."""
    return nan_aware_gaussians(df, keys, {value: (sigma_y, sigma_x)}, value, truncate, row, col)


def nan_aware_gaussians(
    df: DataFrame, keys: Sequence[str], sigmas: Mapping[str, tuple[float, float]], value: str = "value", truncate: float = 4.0,
    row: str = "grow", col: str = "gcol",
) -> DataFrame:
    """A column per (sigma_y, sigma_x), all from one pass over the tiles; width 0 leaves a value as it is."""
    radii = [gaussian_radii(y, x, truncate) for y, x in sigmas.values()]
    tiling = Tiling.around(max(r for r, _ in radii), max(c for _, c in radii), None)
    return _smooth_present(df, keys, value, tiling, {n: _gaussian(y, x, truncate) for n, (y, x) in sigmas.items()}, row, col)


def neighbour_offsets(eight: bool = True) -> list[tuple[int, int, float]]:
    return [(i, j, 1.0) for i, j, _ in offsets(1, 1) if (i or j) and (eight or not (i and j))]


def dilate(mask: DataFrame, rings: int = 1, eight: bool = True, n_cols: int = 720, row: str = "grow", col: str = "gcol") -> DataFrame:
    """Grow a set of cells by `rings` rings; the ring number of each cell is its first reach."""
    items = [(0, 0, 1.0), *neighbour_offsets(eight)]
    grown = mask.select(row, col).distinct().withColumn("ring", F.lit(0))
    for k in range(1, rings + 1):
        reach = F.when((F.col("_o.di") == 0) & (F.col("_o.dj") == 0), F.col("ring")).otherwise(F.lit(k))
        grown = (
            _scatter(grown, items, n_cols, row, col)
            .groupBy(F.col("_row").alias(row), F.col("_col").alias(col))
            .agg(F.min(reach).alias("ring"))
        )
    return grown


def touching(mask: DataFrame, other: DataFrame, eight: bool = True, n_cols: int = 720, row: str = "grow", col: str = "gcol") -> DataFrame:
    """Cells of `mask` next to a cell of `other` (coastal land: land next to ocean)."""
    near = _scatter(other.select(row, col), neighbour_offsets(eight), n_cols, row, col)
    near = near.select(F.col("_row").alias(row), F.col("_col").alias(col)).distinct()
    return mask.join(near, [row, col], "left_semi")


def align_coarse_mask(fine: DataFrame, coarse: DataFrame, k: int, row: str = "grow", col: str = "gcol") -> DataFrame:
    """Give each fine cell the columns of the coarse cell it lies in."""
    keyed = fine.withColumns({"_r": F.floor(F.col(row) / k).cast("int"), "_c": F.floor(F.col(col) / k).cast("int")})
    names = [c for c in coarse.columns if c not in (row, col)]
    lookup = coarse.select(F.col(row).cast("int").alias("_r"), F.col(col).cast("int").alias("_c"), *names)
    return keyed.join(lookup, ["_r", "_c"], "left").drop("_r", "_c")


def block_keys(k: int, row: str = "grow", col: str = "gcol") -> list[Column]:
    return [F.floor(F.col(row) / k).cast("int").alias("block_row"), F.floor(F.col(col) / k).cast("int").alias("block_col")]


def block_mean(
    df: DataFrame, k: int, value: str = "value", n_rows: int | None = None, n_cols: int | None = None,
    row: str = "grow", col: str = "gcol",
) -> DataFrame:
    """k x k mean over values present; a ragged edge is trimmed when the extent is given."""
    kept = df
    if n_rows is not None:
        kept = kept.where(F.col(row) < (n_rows // k) * k)
    if n_cols is not None:
        kept = kept.where(F.col(col) < (n_cols // k) * k)
    return kept.groupBy(*block_keys(k, row, col)).agg(F.avg(value).alias("mean"))


def block_summary(df: DataFrame, k: int, value: str = "value", lat: str = "lat", row: str = "grow", col: str = "gcol") -> DataFrame:
    """Coarse-cell summary: cos(lat)-weighted mean, maximum, counts, quartiles of the positive pixels.

    A cell without any positive pixel has quartiles 0, since its rate is 0 everywhere.
    """
    w = F.cos(F.radians(lat))
    hazard = F.when(F.col(value) > 0, F.col(value))
    q = F.percentile(hazard, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return df.groupBy(*block_keys(k, row, col)).agg(
        (F.sum(F.col(value) * w) / F.sum(F.when(F.col(value).isNotNull(), w))).alias("areal_mean"),
        F.max(value).alias("max_value"),
        F.count(hazard).alias("n_hazard"),
        F.count(value).alias("n_pixels"),
        zero(q[0]).alias("lower_ci"),
        zero(q[1]).alias("median"),
        zero(q[2]).alias("upper_ci"),
    )


def neighbour_pairs(df: DataFrame, value: str, n_cols: int | None, row: str = "grow", col: str = "gcol") -> DataFrame:
    """(a, b) values of each cell and its east and south neighbour."""
    items = [(0, 0, 0.0), (0, -1, 1.0), (-1, 0, 2.0)]
    moved = _scatter(df.where(F.col(value).isNotNull()), items, n_cols, row, col)
    kind = F.col("_o.w").cast("int")
    met = moved.groupBy("_row", "_col").agg(
        F.max(F.when(kind == 0, F.col(value))).alias("a"),
        F.max(F.when(kind == 1, F.col(value))).alias("_east"),
        F.max(F.when(kind == 2, F.col(value))).alias("_south"),
    )
    pairs = met.where("a IS NOT NULL").select("a", F.explode(F.array("_east", "_south")).alias("b"))
    return pairs.where("b IS NOT NULL")


def adjacent_difference(df: DataFrame, value: str = "value", n_cols: int | None = None) -> DataFrame:
    """p99 and maximum of the absolute difference between side neighbours."""
    from cellcast.operators.ranking import exact_quantiles

    steps = neighbour_pairs(df, value, n_cols).select(F.abs(F.col("a") - F.col("b")).alias("step"))
    top = steps.select(F.max("step")).scalar()
    return exact_quantiles(steps, "step", [0.99]).select(F.col("quantile").alias("p99"), top.alias("max_step"))


def roughness(
    df: DataFrame, value: str = "value", form: str = "neighbour_mean", n_rows: int | None = None, n_cols: int | None = None,
    row: str = "grow", col: str = "gcol",
) -> DataFrame:
    """Mean |cell - mean of its four neighbours| over the mean level; or mean side-neighbour step."""
    level = df.select(F.avg(value)).scalar()
    if form == "adjacent":
        steps = neighbour_pairs(df, value, n_cols)
        return steps.agg(F.avg(F.abs(F.col("a") - F.col("b"))).alias("_d")).select((F.col("_d") / level).alias("roughness"))
    moved = _scatter(df.where(F.col(value).isNotNull()), [(0, 0, 0.0), *neighbour_offsets(False)], n_cols, row, col)
    rows = F.col("_row") if n_rows is None else F.pmod(F.col("_row"), F.lit(n_rows))
    own = F.col("_o.w") == 0
    met = moved.groupBy(rows.alias("_r"), "_col").agg(
        F.max(F.when(own, F.col(value))).alias("_v"), F.avg(F.when(~own, F.col(value))).alias("_nb")
    )
    return met.agg(F.avg(F.abs(F.col("_v") - F.col("_nb"))).alias("_d")).select((F.col("_d") / level).alias("roughness"))


def track_cells(
    events: DataFrame, res: float, south: float, west: float, n_rows: int, n_cols: int, touchdown: bool = False
) -> DataFrame:
    """Distinct (event, cell) crossed by each segment, sampled every res/16.

    A zero or missing end leaves the start cell only.
    """
    no_end = F.coalesce((F.col("elat") == 0) | (F.col("elon") == 0) | F.isnan("elat") | F.isnan("elon"), F.lit(True))
    span = F.greatest(F.abs(F.col("elat") - F.col("slat")), F.abs(F.col("elon") - F.col("slon")))
    still = no_end | (span == 0) if not touchdown else F.lit(True)
    steps = F.when(still, F.lit(0)).otherwise(F.ceil(span / (res / 16)).cast("int"))
    sampled = events.withColumn("_n", steps).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n"))))
    t = F.col("_i") / F.nullif(F.col("_n"), F.lit(0)).cast("double")
    at_start = F.col("_n") == 0
    lat = F.when(at_start, F.col("slat")).otherwise(F.col("slat") + (F.col("elat") - F.col("slat")) * t)
    lon = F.when(at_start, F.col("slon")).otherwise(F.col("slon") + (F.col("elon") - F.col("slon")) * t)
    cells = sampled.withColumns(
        {"grow": F.floor((lat - south) / res).cast("int"), "gcol": F.floor((lon - west) / res).cast("int")}
    )
    inside = F.col("grow").between(0, n_rows - 1) & F.col("gcol").between(0, n_cols - 1)
    return cells.where(inside).dropDuplicates(["event_id", "grow", "gcol"]).drop("_n", "_i")


def bin_points(events: DataFrame, size: float, value: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Sum, mean and count of points per grid cell; NULL values do not count."""
    return events.groupBy(
        F.floor(F.col(lat) / size).cast("int").alias("grow"), F.floor(F.col(lon) / size).cast("int").alias("gcol")
    ).agg(F.sum(value).alias("total"), F.avg(value).alias("mean"), F.count(value).alias("n"))


def box_mean(panel: DataFrame, boxes: DataFrame, value: str = "value", row: str = "grow") -> DataFrame:
    """Mean of cells inside named boxes; each box is exploded to its grid rows so the join has an equal key."""
    rows = boxes.withColumn("_row", F.explode(F.sequence("grow0", "grow1")))
    hit = panel.join(rows, panel[row] == rows["_row"]).where(
        F.col("lat").between(F.col("south"), F.col("north")) & F.col("lon").between(F.col("west"), F.col("east"))
    )
    return hit.groupBy("box_id").agg(F.avg(value).alias("mean"), F.count(value).alias("n_cells"))


def orientation_check(means: DataFrame, high: Column, low: Column) -> DataFrame:
    """Whether the first box group's mean exceeds the second's."""
    return means.agg(F.avg(F.when(high, F.col("mean"))).alias("high"), F.avg(F.when(low, F.col("mean"))).alias("low")).withColumn(
        "passed", F.col("high") > F.col("low")
    )
