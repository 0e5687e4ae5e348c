"""Site, polygon and river joins; neighbourhood kernels; block statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellcast.functions.scalar import cell_area_km2
from cellcast.operators import grids, rings, spatial
from querybook.common import rounded
from querybook.layers import annual_panel
from querybook.registry import query
from querybook.sources import HAVERSINE
from querybook.standins import SQL, table

SQL["dlonsites"] = "SELECT s.site_id, s.lat, s.lon FROM sites s"
SQL["site_cells"] = """
    SELECT s.site_id, g.cell_id, g.grow, g.gcol,
           exp(-0.5 * (pow(g.lat - s.lat, 2) + pow(least(abs(g.lon - s.lon), 360 - abs(g.lon - s.lon)), 2)) / 625e-4) AS w
    FROM sites s JOIN grid g ON abs(g.lat - s.lat) <= 0.5 AND least(abs(g.lon - s.lon), 360 - abs(g.lon - s.lon)) <= 0.5"""
SQL["gridpanel"] = """
    SELECT p.scenario, p.decade, p.cell_id, g.grow, g.gcol, g.lat, g.lon, p.median,
           CASE WHEN p.decade > 1995 AND p.median > 24 THEN p.median - 25 END AS slope
    FROM panel p JOIN grid g ON p.cell_id = g.cell_id"""


def grid_panel(spark, sf):
    panel, _ = annual_panel(spark, sf)
    g = table(spark, sf, "grid").select("cell_id", "grow", "gcol", "lat", "lon")
    slope = F.when((F.col("decade") > 1995) & (F.col("median") > 24), F.col("median") - 25)
    return panel.join(g, "cell_id").withColumn("slope", slope)


@query("j1_extract_points", """
    SELECT c.site_id, p.scenario, p.decade, round(sum(w * median) / sum(CASE WHEN median IS NOT NULL THEN w END), 6) AS median,
           round(sum(w * slope) / sum(CASE WHEN slope IS NOT NULL THEN w END), 6) AS slope
    FROM site_cells c JOIN gridpanel p ON c.cell_id = p.cell_id GROUP BY 1, 2, 3""")
def j1(spark, sf):
    out = spatial.extract_points(table(spark, sf, "sites"), grid_panel(spark, sf), ["median", "slope"], ["scenario", "decade"])
    return rounded(out, "median", "slope")


BOX_W = """greatest(0, least(b.north, g.lat + 25e-2) - greatest(b.south, g.lat - 25e-2))
    * greatest(0, least(b.east, g.lon + 25e-2) - greatest(b.west, g.lon - 25e-2)) / 25e-2"""


@query("j2_extract_polygons", f"""
    WITH w AS (SELECT b.box_id, g.cell_id, {BOX_W} AS w FROM boxes b JOIN grid g ON {BOX_W} > 0)
    SELECT w.box_id, p.scenario, p.decade, round(sum(w * median) / sum(CASE WHEN median IS NOT NULL THEN w END), 6) AS median,
           round(sum(w * slope) / sum(CASE WHEN slope IS NOT NULL THEN w END), 6) AS slope
    FROM w JOIN gridpanel p ON w.cell_id = p.cell_id GROUP BY 1, 2, 3""")
def j2(spark, sf):
    shares = spatial.box_shares(table(spark, sf, "boxes"))
    return rounded(spatial.extract_polygons(shares, grid_panel(spark, sf), ["median", "slope"], ["scenario", "decade"]), "median", "slope")


@query("j2_extract_rings", f"""
    WITH w AS (SELECT b.box_id, g.cell_id, {BOX_W} AS w FROM boxes b JOIN grid g ON {BOX_W} > 0)
    SELECT w.box_id, round(sum(w * s.value) / sum(w), 6) AS value FROM w JOIN surface s ON w.cell_id = s.cell_id GROUP BY 1""")
def j2_rings(spark, sf):
    b = table(spark, sf, "boxes")
    frames = b.select("box_id", F.array("west", "east", "east", "west").alias("xs"), F.array("south", "south", "north", "north").alias("ys"))
    return rounded(spatial.extract_polygons(spatial.ring_shares(frames), table(spark, sf, "surface"), ["value"], []), "value")


SQL["edges"] = """
    SELECT box_id AS polygon_id, x0, y0, x1, y1 FROM (
        SELECT box_id, west AS x0, south AS y0, east AS x1, south AS y1 FROM boxes
        UNION ALL SELECT box_id, east, south, (west + east) / 2, north FROM boxes
        UNION ALL SELECT box_id, (west + east) / 2, north, west, south FROM boxes) t"""


@query("j4_points_in_polygons", """
    SELECT s.site_id AS point_id, e.polygon_id FROM sites s JOIN edges e ON (e.y0 > s.lat) <> (e.y1 > s.lat)
        AND s.lon < e.x0 + (s.lat - e.y0) * (e.x1 - e.x0) / (e.y1 - e.y0)
    GROUP BY 1, 2 HAVING count(*) % 2 = 1""")
def j4(spark, sf):
    pts = table(spark, sf, "sites").select(F.col("site_id").alias("point_id"), "lat", "lon")
    return rings.points_in_polygons(pts, table(spark, sf, "edges"))


@query("j5_nearest_cell", """
    SELECT site_id, CAST(round((89.75 - lat) / 0.5) AS INT) AS grow, CAST((CAST(round((lon + 179.75) / 0.5) AS INT) + 720) % 720 AS INT) AS gcol FROM sites""")
def j5(spark, sf):
    return spatial.nearest_cell(table(spark, sf, "sites")).select("site_id", "grow", "gcol")


@query("j6_nearest_valid", """
    WITH v AS (SELECT cell_id, lat, lon FROM surface WHERE gappy IS NOT NULL),
    d AS (SELECT s.site_id, v.cell_id, """ + HAVERSINE.format(a="s.lat", b="v.lat", c="s.lon", d="v.lon") + """ AS km FROM sites s, v),
    k AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY round(km, 6), cell_id) AS rn FROM d WHERE km <= 120)
    SELECT s.site_id AS target_id, k.cell_id AS source_id, round(k.km, 6) AS km FROM sites s LEFT JOIN k ON s.site_id = k.site_id AND k.rn = 1""")
def j6(spark, sf):
    targets = table(spark, sf, "sites").select(F.col("site_id").alias("target_id"), "lat", "lon")
    sources = table(spark, sf, "surface").where("gappy IS NOT NULL").select(F.col("cell_id").alias("source_id"), "lat", "lon")
    return spatial.nearest_valid(targets, sources, 120.0)


SQL["rivers"] = """
    SELECT g.cell_id, g.grow, g.gcol, g.lat, g.lon, CAST(floor(g.cell_id / 25e0) AS BIGINT) AS basin_id,
           s.value > 25.5 AND floor(g.cell_id / 25e0) % 4 <> 2 AS is_river, g.cell_id * 3 + 1 AS upstream
    FROM grid g JOIN surface s ON g.cell_id = s.cell_id WHERE g.acctbal > 0"""


@query("j7_snap_to_river", """
    WITH here AS (SELECT s.site_id, s.lat, s.lon, r.basin_id, s.lat BETWEEN -56 AND 84 AS inside FROM sites s
        LEFT JOIN rivers r ON r.grow = CAST(round((89.75 - s.lat) / 0.5) AS INT) AND r.gcol = CAST((CAST(round((s.lon + 179.75) / 0.5) AS INT) + 720) % 720 AS INT)),
    d AS (SELECT h.site_id, r.cell_id, r.upstream, """ + HAVERSINE.format(a="h.lat", b="r.lat", c="h.lon", d="r.lon") + """ AS km
          FROM here h JOIN rivers r ON h.basin_id = r.basin_id WHERE r.is_river AND h.inside),
    k AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY round(km, 6), cell_id) AS rn FROM d)
    SELECT h.site_id, CASE WHEN NOT inside THEN 'OUTSIDE_ROUTING_DOMAIN' WHEN h.basin_id IS NULL THEN 'NO_BASIN' WHEN k.km IS NULL THEN 'NO_RIVER_IN_BASIN'
             WHEN k.km > 50 THEN 'SNAP_TOO_FAR' ELSE 'OK' END AS status, CASE WHEN inside THEN h.basin_id END AS basin_id, round(k.km, 6) AS snap_km,
           CASE WHEN k.km <= 50 THEN k.cell_id END AS river_id, CASE WHEN k.km <= 50 THEN k.upstream END AS upstream
    FROM here h LEFT JOIN k ON h.site_id = k.site_id AND k.rn = 1""")
def j7(spark, sf):
    r = table(spark, sf, "rivers")
    return spatial.snap_to_river(table(spark, sf, "sites"), r, r.where("is_river"))


@query("j8_exact_regrid", "SELECT l.cell_id, round(s.value, 6) AS value FROM land l JOIN surface s ON l.cell_id = s.cell_id")
def j8(spark, sf):
    return rounded(spatial.exact_regrid(table(spark, sf, "surface"), table(spark, sf, "land"), ["value"]), "value").select("cell_id", "value")


SITE_VALUE = """
    WITH v AS (SELECT site_id, sum(w * gappy) / sum(CASE WHEN gappy IS NOT NULL THEN w END) AS value
               FROM site_cells c JOIN surface s ON c.cell_id = s.cell_id GROUP BY 1)
    SELECT s.site_id, round(v.value, 6) AS value, CASE WHEN v.value IS NOT NULL THEN 'OK' WHEN EXISTS (SELECT 1 FROM site_cells c WHERE c.site_id = s.site_id {extra})
           THEN 'OFF_LAYER_MASK' ELSE 'OUTSIDE_DOMAIN' END AS data_status FROM sites s LEFT JOIN v ON s.site_id = v.site_id"""


def _domain(spark, sf, wrap):
    sites, s = table(spark, sf, "sites"), table(spark, sf, "surface")
    got = spatial.extract_points(sites, s, ["gappy"], []).withColumnRenamed("gappy", "value")
    values = sites.select("site_id").join(got, "site_id", "left")
    return rounded(spatial.domain_status(values, sites, s, wrap=wrap), "value").select("site_id", "value", "data_status")


@query("j13_domain_status", SITE_VALUE.replace("{extra}", ""))
def j13(spark, sf):
    return _domain(spark, sf, True)


@query("j13_domain_status_no_wrap", SITE_VALUE.replace(
    "{extra}", "AND abs((SELECT g.lon FROM grid g WHERE g.cell_id = c.cell_id) - s.lon) <= 0.5"))
def j13_flat(spark, sf):
    return _domain(spark, sf, False)


# Kernels ------------------------------------------------------------------------------------

NEIGH = """abs(b.grow - a.grow) <= 2 AND least((b.gcol - a.gcol + 720) % 720, (a.gcol - b.gcol + 720) % 720) <= 2"""
DJ = "least((b.gcol - a.gcol + 720) % 720, (a.gcol - b.gcol + 720) % 720)"


@query("k1_smooth_exp", f"""
    SELECT a.grow, a.gcol, round(sum(exp(-sqrt(pow(b.grow - a.grow, 2) + pow({DJ} * cos(radians(a.lat)), 2)) / 2.5) * coalesce(b.gappy, 0))
         / sum(exp(-sqrt(pow(b.grow - a.grow, 2) + pow({DJ} * cos(radians(a.lat)), 2)) / 2.5)), 6) AS value
    FROM surface a JOIN surface b ON {NEIGH} GROUP BY 1, 2""")
def k1(spark, sf):
    s = table(spark, sf, "surface").select("grow", "gcol", F.col("gappy").alias("value"))
    return rounded(grids.smooth_exp(s, []), "value")


@query("k2_smooth_exp_index", f"""
    SELECT a.grow, a.gcol, round(sum(exp(-sqrt(pow(b.grow - a.grow, 2) + pow({DJ}, 2)) / 2.5) * b.gappy)
         / sum(CASE WHEN b.gappy IS NOT NULL THEN exp(-sqrt(pow(b.grow - a.grow, 2) + pow({DJ}, 2)) / 2.5) END), 6) AS value
    FROM surface a JOIN surface b ON {NEIGH} WHERE a.gappy IS NOT NULL GROUP BY 1, 2""")
def k2(spark, sf):
    s = table(spark, sf, "surface").select("grow", "gcol", F.col("gappy").alias("value"))
    return rounded(grids.smooth_exp_index(s, []), "value")


@query("k3_nan_aware_gaussian", """
    SELECT a.grow, a.gcol, round(sum(exp(-pow(b.grow - a.grow, 2) / 2 - pow(b.gcol - a.gcol, 2) / (2 * 64e-2)) * b.gappy)
         / sum(CASE WHEN b.gappy IS NOT NULL THEN exp(-pow(b.grow - a.grow, 2) / 2 - pow(b.gcol - a.gcol, 2) / (2 * 64e-2)) END), 6) AS value
    FROM surface a JOIN surface b ON abs(b.grow - a.grow) <= 4 AND abs(b.gcol - a.gcol) <= 3 WHERE a.gappy IS NOT NULL GROUP BY 1, 2""")
def k3(spark, sf):
    s = table(spark, sf, "surface").select("grow", "gcol", F.col("gappy").alias("value"))
    return rounded(grids.nan_aware_gaussian(s, [], 1.0, 0.8), "value")


@query("k4_dilate", """
    WITH o AS (SELECT grow, gcol FROM grid WHERE acctbal > 8500),
    n AS (SELECT i.i, j.i AS j FROM (VALUES (-2), (-1), (0), (1), (2)) i(i), (VALUES (-2), (-1), (0), (1), (2)) j(i)),
    t AS (SELECT o.grow + n.i AS grow, (o.gcol + n.j + 720) % 720 AS gcol, greatest(abs(n.i), abs(n.j)) AS ring FROM o, n)
    SELECT 'ring' AS kind, grow, gcol, min(ring) AS ring FROM t GROUP BY 1, 2, 3
    UNION ALL SELECT 'coast', l.grow, l.gcol, 0 FROM land l WHERE EXISTS (SELECT 1 FROM grid b WHERE b.cell_id NOT IN (SELECT cell_id FROM land)
        AND abs(b.grow - l.grow) <= 1 AND least((b.gcol - l.gcol + 720) % 720, (l.gcol - b.gcol + 720) % 720) <= 1)""")
def k4(spark, sf):
    g, land = table(spark, sf, "grid"), table(spark, sf, "land")
    grown = grids.dilate(g.where("acctbal > 8500"), 2).withColumn("kind", F.lit("ring"))
    coast = grids.touching(land.select("grow", "gcol"), g.where("acctbal <= 1500 OR acctbal IS NULL"))
    return grown.unionByName(coast.withColumns({"ring": F.lit(0), "kind": F.lit("coast")}))


TRACK_SQL = """
    WITH n AS (SELECT *, CASE WHEN elat = 0 OR elon = 0 OR greatest(abs(elat - slat), abs(elon - slon)) = 0 THEN 0
                   ELSE CAST(ceil(greatest(abs(elat - slat), abs(elon - slon)) / (0.5e0 / 16)) AS INT) END AS n FROM tracks),
    p AS (SELECT event_id, mag, year, CASE WHEN n = 0 THEN slat ELSE slat + (elat - slat) * (CAST(i AS DOUBLE) / CAST(n AS DOUBLE)) END AS la,
                 CASE WHEN n = 0 THEN slon ELSE slon + (elon - slon) * (CAST(i AS DOUBLE) / CAST(n AS DOUBLE)) END AS lo
          FROM (SELECT *, unnest(generate_series(0, n)) AS i FROM n) s),
    c AS (SELECT DISTINCT event_id, mag, year, CAST(floor((la - 25) / 0.5) AS INT) AS grow, CAST(floor((lo + 105) / 0.5) AS INT) AS gcol FROM p)"""
SQL["crossings"] = TRACK_SQL + " SELECT * FROM c WHERE grow BETWEEN 0 AND 39 AND gcol BETWEEN 0 AND 59"


def crossings(spark, sf):
    return grids.track_cells(table(spark, sf, "tracks"), 0.5, 25.0, -105.0, 40, 60)


@query("k5_track_cells", "SELECT grow, gcol, count(*) AS n_tracks, sum(CASE WHEN mag >= 3 THEN 1 ELSE 0 END) AS n_strong FROM crossings GROUP BY 1, 2")
def k5(spark, sf):
    return crossings(spark, sf).groupBy("grow", "gcol").agg(
        F.count("*").alias("n_tracks"), F.count_if(F.col("mag") >= 3).alias("n_strong")
    )


@query("k6_align_coarse_mask", """
    SELECT s.cell_id, c.top FROM surface s LEFT JOIN (SELECT floor(grow / 3) AS r, floor(gcol / 3) AS c, max(cell_id) AS top FROM land GROUP BY 1, 2) c
      ON floor(s.grow / 3) = c.r AND floor(s.gcol / 3) = c.c""")
def k6(spark, sf):
    coarse = table(spark, sf, "land").groupBy(
        F.floor(F.col("grow") / 3).alias("grow"), F.floor(F.col("gcol") / 3).alias("gcol")
    ).agg(F.max("cell_id").alias("top"))
    return grids.align_coarse_mask(table(spark, sf, "surface"), coarse, 3).select("cell_id", "top")


# Block statistics ---------------------------------------------------------------------------


@query("a14_bin_points", """
    SELECT CAST(floor(slat / 0.5) AS INT) AS grow, CAST(floor(slon / 0.5) AS INT) AS gcol, sum(CASE WHEN mag < 5 THEN mag END) AS total,
           round(avg(CASE WHEN mag < 5 THEN mag END), 6) AS mean, count(CASE WHEN mag < 5 THEN mag END) AS n FROM tracks GROUP BY 1, 2""")
def a14(spark, sf):
    t = table(spark, sf, "tracks").withColumn("strength", F.when(F.col("mag") < 5, F.col("mag")))
    return rounded(grids.bin_points(t, 0.5, "strength", "slat", "slon"), "mean")


@query("a18_block_mean", """
    SELECT CAST(floor(grow / 4) AS INT) AS block_row, CAST(floor(gcol / 4) AS INT) AS block_col, round(avg(gappy), 6) AS mean FROM surface WHERE grow < 240 GROUP BY 1, 2""")
def a18(spark, sf):
    return rounded(grids.block_mean(table(spark, sf, "surface"), 4, "gappy", n_rows=243), "mean")


@query("a19_block_summary", """
    SELECT CAST(floor(grow / 4) AS INT) AS block_row, CAST(floor(gcol / 4) AS INT) AS block_col, round(sum(zeroed * cos(radians(lat))) / sum(cos(radians(lat))), 6) AS areal_mean,
           max(zeroed) AS max_value, count(CASE WHEN zeroed > 0 THEN 1 END) AS n_hazard, count(*) AS n_pixels,
           round(coalesce(quantile_cont(CASE WHEN zeroed > 0 THEN zeroed END, 0.25), 0), 6) AS lower_ci,
           round(coalesce(quantile_cont(CASE WHEN zeroed > 0 THEN zeroed END, 0.5), 0), 6) AS median,
           round(coalesce(quantile_cont(CASE WHEN zeroed > 0 THEN zeroed END, 0.75), 0), 6) AS upper_ci FROM surface GROUP BY 1, 2""")
def a19(spark, sf):
    return rounded(grids.block_summary(table(spark, sf, "surface"), 4, "zeroed"), "areal_mean", "lower_ci", "median", "upper_ci")


@query("a30_adjacent_difference", """
    WITH d AS (SELECT abs(a.gappy - b.gappy) AS step FROM surface a JOIN surface b ON (b.grow = a.grow AND b.gcol = (a.gcol + 1) % 720) OR (b.grow = a.grow + 1 AND b.gcol = a.gcol)
               WHERE a.gappy IS NOT NULL AND b.gappy IS NOT NULL)
    SELECT round(quantile_cont(step, 0.99), 6) AS p99, round(max(step), 6) AS max_step FROM d""")
def a30(spark, sf):
    return rounded(grids.adjacent_difference(table(spark, sf, "surface"), "gappy", 720), "p99", "max_step")


@query("a31_roughness", """
    WITH nb AS (SELECT a.cell_id, max(a.gappy) AS v, avg(b.gappy) AS m FROM surface a JOIN surface b
        ON (abs(b.grow - a.grow) = 1 AND b.gcol = a.gcol) OR (b.grow = a.grow AND (b.gcol = (a.gcol + 1) % 720 OR a.gcol = (b.gcol + 1) % 720))
        WHERE a.gappy IS NOT NULL GROUP BY 1),
    d AS (SELECT abs(a.gappy - b.gappy) AS step FROM surface a JOIN surface b ON (b.grow = a.grow AND b.gcol = (a.gcol + 1) % 720) OR (b.grow = a.grow + 1 AND b.gcol = a.gcol)
          WHERE a.gappy IS NOT NULL AND b.gappy IS NOT NULL)
    SELECT 'neighbour_mean' AS form, round((SELECT avg(abs(v - m)) FROM nb) / avg(gappy), 6) AS roughness FROM surface
    UNION ALL SELECT 'adjacent', round((SELECT avg(step) FROM d) / avg(gappy), 6) FROM surface""")
def a31(spark, sf):
    s = table(spark, sf, "surface")
    parts = [
        grids.roughness(s, "gappy", form, n_rows=360, n_cols=720).withColumn("form", F.lit(form))
        for form in ("neighbour_mean", "adjacent")
    ]
    return rounded(parts[0].unionByName(parts[1]), "roughness")


@query("a34_box_mean", """
    SELECT b.box_id, round(avg(s.value), 6) AS mean, count(s.value) AS n_cells FROM boxes b JOIN surface s
      ON s.lat BETWEEN b.south AND b.north AND s.lon BETWEEN b.west AND b.east GROUP BY 1""")
def a34(spark, sf):
    return rounded(grids.box_mean(table(spark, sf, "surface"), table(spark, sf, "boxes")), "mean")


@query("a34_orientation_check", """
    WITH m AS (SELECT b.box_id, avg(s.value) AS mean FROM boxes b JOIN surface s ON s.lat BETWEEN b.south AND b.north AND s.lon BETWEEN b.west AND b.east GROUP BY 1),
    r AS (SELECT avg(CASE WHEN box_id < 12 THEN mean END) AS high, avg(CASE WHEN box_id >= 12 THEN mean END) AS low FROM m)
    SELECT round(high, 6) AS high, round(low, 6) AS low, high > low AS passed FROM r""")
def a34_check(spark, sf):
    means = grids.box_mean(table(spark, sf, "surface"), table(spark, sf, "boxes"))
    return rounded(grids.orientation_check(means, F.col("box_id") < 12, F.col("box_id") >= 12), "high", "low")


@query("a33_area_weighted_basin_mean", """
    SELECT r.basin_id, round(sum(s.value * a) / sum(a), 6) AS mean FROM (SELECT *, 6371.0088e0 * 6371.0088e0 * radians(5e-1) * (sin(radians(lat + 25e-2)) - sin(radians(lat - 25e-2))) AS a FROM rivers) r
    JOIN surface s ON r.cell_id = s.cell_id GROUP BY 1""")
def a33(spark, sf):
    from cellcast.operators.hydrology import area_weighted_basin_mean

    cells = table(spark, sf, "rivers").select("basin_id", "cell_id", cell_area_km2("lat").alias("area_km2"))
    return rounded(area_weighted_basin_mean(cells, table(spark, sf, "surface").select("cell_id", "value"), []), "mean")
