"""Joins between sites, cells, polygons and rivers, all on integer block or cell keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.functions.scalar import EARTH_RADIUS_KM, haversine_km, lon_gap, normalize_lon
from cellcast.operators.ranking import key_lookup
from cellcast.operators.rings import edge_shares, ring_edges
from cellcast.session import cut_lineage


def grid_row(lat: Column, size: float = 0.5, lat0: float = 89.75) -> Column:
    return F.round((lat0 - lat) / size).cast("int")


def grid_col(lon: Column, size: float = 0.5, lon0: float = -179.75) -> Column:
    n = int(round(360 / size))
    return F.pmod(F.round((lon - lon0) / size).cast("int"), F.lit(n))


def cell_weights(sites: DataFrame, size: float = 0.5, sigma: float | None = None, radius: float | None = None) -> DataFrame:
    """(site_id, grow, gcol, w): Gaussian weights of the cell centres within `radius` degrees.

    Separations are in degrees, longitude the short way round. Defaults follow the grid: one cell
    of radius, half a cell of sigma. The fan-out is the fixed window, so nothing is compared pairwise.
    """
    radius = size if radius is None else radius
    sigma = size / 2 if sigma is None else sigma
    reach = int(radius / size + 1)
    lat0, lon0, n = 90 - size / 2, -180 + size / 2, int(round(360 / size))
    steps = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)
    ])
    placed = sites.select("site_id", "lat", normalize_lon("lon").alias("lon")).withColumn("_o", F.explode(steps))
    keyed = placed.select(
        "site_id",
        "lat",
        "lon",
        (grid_row(F.col("lat"), size, lat0) + F.col("_o.i")).alias("grow"),
        F.pmod(grid_col(F.col("lon"), size, lon0) + F.col("_o.j"), F.lit(n)).alias("gcol"),
    )
    dlat = F.abs((lat0 - size * F.col("grow")) - F.col("lat"))
    dlon = lon_gap(lon0 + size * F.col("gcol"), F.col("lon"))
    on_grid = F.col("grow").between(0, int(round(180 / size)) - 1)
    near = keyed.where(on_grid & (dlat <= radius) & (dlon <= radius))
    return near.select("site_id", "grow", "gcol", F.exp(-0.5 * (dlat * dlat + dlon * dlon) / (sigma * sigma)).alias("w"))


def _weighted(metric: str) -> Column:
    have = F.when(F.col(metric).isNotNull(), F.col("w"))
    return (F.sum(F.col("w") * F.col(metric)) / F.sum(have)).alias(metric)


def extract_points(
    sites: DataFrame, panel: DataFrame, metrics: Sequence[str], by: Sequence[str], size: float = 0.5,
    sigma: float | None = None, radius: float | None = None,
) -> DataFrame:
    """Blend of nearby cells per site, the weights renormalised per metric over the cells that have it.

    `panel` carries grow and gcol. A cell under many sites is one key; sites are spread over copies
    of the panel rows only when the optimizer finds that key skewed (adaptive skew join).
    """
    weights = cell_weights(sites, size, sigma, radius)
    met = weights.join(panel.select("grow", "gcol", *by, *metrics), ["grow", "gcol"])
    return met.groupBy("site_id", *by).agg(*[_weighted(m) for m in metrics])


def box_shares(boxes: DataFrame, size: float = 0.5) -> DataFrame:
    """(box_id, grow, gcol, w): share of each cell an axis-aligned box covers."""
    lat0, lon0 = 90 - size / 2, -180 + size / 2
    rows = boxes.withColumn("grow", F.explode(F.sequence(
        F.floor((90 - F.col("north")) / size).cast("int"), F.floor((90 - F.col("south")) / size).cast("int")
    )))
    cells = rows.withColumn("gcol", F.explode(F.sequence(
        F.floor((F.col("west") + 180) / size).cast("int"), F.floor((F.col("east") + 180) / size).cast("int")
    )))
    lat, lon = lat0 - size * F.col("grow"), lon0 + size * F.col("gcol")
    high = F.least(F.col("north"), lat + size / 2) - F.greatest(F.col("south"), lat - size / 2)
    wide = F.least(F.col("east"), lon + size / 2) - F.greatest(F.col("west"), lon - size / 2)
    share = F.greatest(high, F.lit(0.0)) * F.greatest(wide, F.lit(0.0)) / (size * size)
    return cells.select("box_id", "grow", _wrapped_col(size), share.alias("w")).where("w > 0")


def _wrapped_col(size: float) -> Column:
    """Columns past the antimeridian, as the panels count them."""
    return F.pmod(F.col("gcol"), F.lit(int(round(360 / size)))).alias("gcol")


def ring_shares(polygons: DataFrame, size: float = 0.5) -> DataFrame:
    """(box_id, grow, gcol, w) for polygon rings given as arrays xs, ys: planar area shares.

    A polygon may have several rings (rows of one box_id); those with `hole` true are taken off.
    """
    return edge_shares(ring_edges(polygons), size)


def extract_polygons(shares: DataFrame, panel: DataFrame, metrics: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Area-weighted mean per polygon, renormalised over the cells that have each metric."""
    met = shares.join(panel.select("grow", "gcol", *by, *metrics), ["grow", "gcol"])
    return met.groupBy("box_id", *by).agg(*[_weighted(m) for m in metrics])


def extract_regions(names: DataFrame, dictionary: DataFrame, boxes: DataFrame, panel: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Fuzzy-match region names (entry, box_id), then extract each matched region once."""
    from cellcast.operators.delivery import fuzzy_match

    matched = fuzzy_match(names, dictionary.select("entry")).where("entry IS NOT NULL")
    found = matched.join(dictionary, "entry")
    wanted = boxes.join(found.select("box_id").distinct(), "box_id", "left_semi")
    values = extract_polygons(box_shares(wanted), panel, metrics, by)
    return found.select("query", "entry", "box_id").join(values, "box_id").drop("box_id")


def nearest_cell(sites: DataFrame, size: float = 0.5) -> DataFrame:
    """Row and column of the nearest centre, each axis on its own, longitude wrapped."""
    return sites.withColumns(
        {"grow": grid_row(F.col("lat"), size, 90 - size / 2), "gcol": grid_col(F.col("lon"), size, -180 + size / 2)}
    )


def nearest_valid(
    targets: DataFrame, sources: DataFrame, max_km: float = 250.0, block: float = 2.5, key: str = "target_id",
    by: Sequence[str] = (),
) -> DataFrame:
    """Great-circle nearest source within `max_km` of each target, with its distance.

    With `by` (columns of the sources, such as the member) one nearest source is found per group,
    and targets without any are left out.

    Targets are exploded to the latitude-longitude blocks their circle can reach; the longitude
    reach widens with 1/cos(lat) so no candidate is missed near a pole. Equal distances (to the
    millimetre) go to the smaller id.
    """
    dlat = max_km / 111.0
    span = F.ceil(F.lit(dlat) / block).cast("int")
    n_blocks = int(round(360 / block))
    edge = F.abs(F.col("lat")) + dlat
    # a circle that holds a pole meets every longitude
    across = F.ceil(F.lit(dlat) / F.cos(F.radians(edge)) / block).cast("int")
    wide = F.when(edge >= 89.9, n_blocks // 2).otherwise(F.least(F.lit(n_blocks // 2), across))
    row, column = F.floor(F.col("lat") / block).cast("int"), F.floor((F.col("lon") + 180) / block).cast("int")
    reach = targets.select(key, "lat", "lon").withColumn("_by", F.explode(F.sequence(row - span, row + span)))
    reach = reach.withColumn("_bx", F.explode(F.array_distinct(F.transform(
        F.sequence(column - wide, column + wide), lambda b: F.pmod(b, F.lit(n_blocks))
    ))))
    stock = sources.select(
        F.col("source_id"), *by, F.col("lat").alias("_la"), F.col("lon").alias("_lo"),
        F.floor(F.col("lat") / block).cast("int").alias("_by"),
        F.pmod(F.floor((F.col("lon") + 180) / block).cast("int"), F.lit(n_blocks)).alias("_bx"),
    )
    km = haversine_km("lat", "lon", "_la", "_lo")
    near = reach.join(stock, ["_by", "_bx"]).withColumn("km", F.round(km, 6)).where(F.col("km") <= max_km)
    best = near.groupBy(key, *by).agg(F.min(F.struct("km", "source_id")).alias("_b"))
    if by:
        return best.select(key, *by, F.col("_b.source_id").alias("source_id"), F.col("_b.km").alias("km"))
    return targets.select(key).join(best, key, "left").select(key, F.col("_b.source_id").alias("source_id"), F.col("_b.km").alias("km"))


#: Fine blocks along a side of a coarse one.
COARSE = 8


def _block_midpoint(side: int, size: float) -> dict[str, Column]:
    """Centre of the block of `side` cells that a cell lies in."""
    middle = lambda c: F.floor(F.col(c) / side) * side + (side - 1) / 2.0
    return {"_mla": 90 - size / 2 - size * middle("grow"), "_mlo": -180 + size / 2 + size * middle("gcol")}


def _summaries(cells: DataFrame, side: int, size: float, key: Sequence[str]) -> DataFrame:
    """Midpoint of each block and the distance of its farthest river cell from there."""
    placed = cells.withColumns(_block_midpoint(side, size))
    radius = F.max(haversine_km("_mla", "_mlo", "lat", "lon")).alias("_radius")
    return placed.groupBy("basin_id", *key).agg(F.first("_mla").alias("_mla"), F.first("_mlo").alias("_mlo"), radius)


def _not_ruled_out(met: DataFrame) -> DataFrame:
    """Blocks that may hold a site's nearest cell, by the triangle inequality."""
    far = met.withColumn("_mid", haversine_km("lat", "lon", "_mla", "_mlo"))
    bound = far.groupBy("site_id").agg(F.min(F.col("_mid") + F.col("_radius")).alias("_bound"))
    return far.join(bound, "site_id").where(F.col("_mid") - F.col("_radius") <= F.col("_bound") + 1e-6).drop("_mla", "_mlo", "_radius", "_mid", "_bound")


def _km_to_edge(block: int, size: float) -> Column:
    """At least this far from a site is whatever lies outside the 3 x 3 blocks around it."""
    u, v = (normalize_lon("lon") + 180) / size, (90 - F.col("lat")) / size
    dlat = size * F.least(v - (F.col("_br") - 1) * block, (F.col("_br") + 2) * block - v)
    dlon = size * F.least(u - (F.col("_bc") - 1) * block, (F.col("_bc") + 2) * block - u)
    to_meridian = F.asin(F.cos(F.radians("lat")) * F.sin(F.radians(F.least(dlon, F.lit(90.0)))))
    return EARTH_RADIUS_KM * F.least(F.radians(dlat), to_meridian)


def snap_to_river(
    sites: DataFrame, basins: DataFrame, rivers: DataFrame, max_km: float = 50.0, block_rows: int = 5, size: float = 0.5,
    north: float = 83.75, south: float = -55.75,
) -> DataFrame:
    """Nearest river cell inside the site's own basin, with a status.

    A basin may hold most river cells and most sites, so a site first meets the cells of the 3 x 3 small
    blocks around it, keyed by basin and block. It is settled if what it finds is nearer than the edge of
    these blocks. The others meet their basin's coarse blocks (162 at most on the globe), then the small
    blocks of those that may hold the nearest cell, then the cells of those that still may.
    `basins` has grow, gcol, basin_id; `rivers` adds upstream and coordinates.
    """
    n_cols = int(round(360 / size))
    if n_cols % (block_rows * COARSE):
        raise ValueError("coarse blocks must tile the circle")
    lat0, lon0 = 90 - size / 2, -180 + size / 2
    located = sites.select("site_id", "lat", "lon").withColumns(
        {"grow": grid_row(F.col("lat"), size, lat0), "gcol": grid_col(F.col("lon"), size, lon0)}
    )
    inside = F.col("lat").between(south - size / 2, north + size / 2)
    placed = located.withColumn("inside", inside).join(basins.select("grow", "gcol", "basin_id"), ["grow", "gcol"], "left")
    block = lambda c, side: F.floor(F.col(c) / side).cast("int")
    cells = cut_lineage(rivers.select("basin_id", "cell_id", "grow", "gcol", "lat", "lon", "upstream").withColumns({
        "_br": block("grow", block_rows), "_bc": block("gcol", block_rows),
        "_cr": block("grow", block_rows * COARSE), "_cc": block("gcol", block_rows * COARSE),
    }))
    ask = placed.where("inside AND basin_id IS NOT NULL").select("site_id", "lat", "lon", "basin_id", block("grow", block_rows).alias("_br"), block("gcol", block_rows).alias("_bc"))
    stock = cells.select("basin_id", "_br", "_bc", F.col("cell_id").alias("river_id"), F.col("lat").alias("_la"), F.col("lon").alias("_lo"), "upstream")

    def nearest(pairs: DataFrame) -> DataFrame:
        measured = pairs.join(stock, ["basin_id", "_br", "_bc"]).withColumn("km", F.round(haversine_km("lat", "lon", "_la", "_lo"), 6))
        return measured.groupBy("site_id").agg(F.min(F.struct("km", "river_id", "upstream")).alias("_b"))

    ring = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    around = ask.withColumn("_o", ring).select(
        "site_id", "lat", "lon", "basin_id", (F.col("_br") + F.col("_o.i")).alias("_br"), F.pmod(F.col("_bc") + F.col("_o.j"), F.lit(n_cols // block_rows)).alias("_bc")
    )
    tried = cut_lineage(ask.withColumn("_edge", _km_to_edge(block_rows, size)).join(nearest(around), "site_id", "left"))
    done = F.coalesce(F.col("_b.km") < F.col("_edge"), F.lit(False))
    left = tried.where(~done).select("site_id", "lat", "lon", "basin_id")
    coarse = _not_ruled_out(left.join(_summaries(cells, block_rows * COARSE, size, ["_cr", "_cc"]), "basin_id"))
    fine = _not_ruled_out(coarse.join(_summaries(cells, block_rows, size, ["_cr", "_cc", "_br", "_bc"]), ["basin_id", "_cr", "_cc"]))
    best = tried.where(done).select("site_id", "_b").unionByName(nearest(fine))
    joined = placed.join(best, "site_id", "left")
    status = (
        F.when(~F.col("inside"), "OUTSIDE_ROUTING_DOMAIN")
        .when(F.col("basin_id").isNull(), "NO_BASIN")
        .when(F.col("_b").isNull(), "NO_RIVER_IN_BASIN")
        .when(F.col("_b.km") > max_km, "SNAP_TOO_FAR")
        .otherwise("OK")
    )
    ok = F.col("status") == "OK"
    return joined.withColumn("status", status).select(
        "site_id", "status", F.when(F.col("inside"), F.col("basin_id")).alias("basin_id"), F.col("_b.km").alias("snap_km"),
        F.when(ok, F.col("_b.river_id")).alias("river_id"), F.when(ok, F.col("_b.upstream")).alias("upstream"),
    )


def exact_regrid(fine: DataFrame, coarse: DataFrame, columns: Sequence[str], decimals: int = 3) -> DataFrame:
    """Columns of `fine` at the exact coordinates of `coarse`; a coordinate without a match is an error."""
    keys = {"_la": F.round("lat", decimals), "_lo": F.round("lon", decimals)}
    source = fine.withColumns(keys).select("_la", "_lo", *columns, F.lit(True).alias("_hit"))
    joined = coarse.withColumns(keys).join(source, ["_la", "_lo"], "left")
    fail = F.raise_error(F.concat(F.lit("no source cell at "), F.col("_la"), F.lit(","), F.col("_lo"))).cast("boolean")
    return joined.withColumn("_hit", F.when(F.col("_hit"), True).otherwise(fail)).where("_hit").drop("_la", "_lo", "_hit")


def domain_status(
    values: DataFrame, sites: DataFrame, finite_cells: DataFrame, value: str = "value", size: float = 0.5, wrap: bool = True
) -> DataFrame:
    """OK, OFF_LAYER_MASK (some registry layer models a cell in its own window) or OUTSIDE_DOMAIN.

    `finite_cells` lists (layer_id, grow, gcol) over the whole registry. With `wrap` off, the window
    stops at the antimeridian.
    """
    window = cell_weights(sites, size).join(sites.select("site_id", F.col("lon").alias("_lon")), "site_id")
    if not wrap:
        centre = -180 + size / 2 + size * F.col("gcol")
        window = window.where(F.abs(centre - normalize_lon("_lon")) <= size)
    known = window.join(finite_cells.select("grow", "gcol").distinct(), ["grow", "gcol"], "left_semi")
    inside = known.select("site_id").distinct().withColumn("_in", F.lit(True))
    status = F.when(F.col(value).isNotNull(), "OK").when(F.col("_in"), "OFF_LAYER_MASK").otherwise("OUTSIDE_DOMAIN")
    return key_lookup(values, inside, ["site_id"]).withColumn("data_status", status).drop("_in")
