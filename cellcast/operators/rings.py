"""Polygons on the grid by their edges: cover shares and point membership. No ring travels whole.

Every edge is cut at the rows and columns it passes. A piece adds, to its own cell, the signed area to its
east there, and its signed height to all cells east of it; the running sum of heights along a row gives
the cells between the edges. What is grouped is one row of one polygon, at most as long as the grid is wide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Shares that are left by rounding alone.
_NOISE = 1e-9
#: Strips of a grid row in which points meet the edges.
STRIPS = 8


def ring_edges(polygons: DataFrame) -> DataFrame:
    """(box_id, x0, y0, x1, y1, sign) of rings given as arrays xs, ys, closed by themselves.

    `sign` makes the inside count 1 whichever way the ring runs, and -1 where `hole` is true. A ring is
    unpacked where it is read; only edges go on.
    """
    ahead = lambda c: F.concat(F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 1, 1))
    corner = F.arrays_zip(F.col("xs").alias("x0"), F.col("ys").alias("y0"), ahead("xs").alias("x1"), ahead("ys").alias("y1"))
    twice = F.aggregate("_edges", F.lit(0.0), lambda a, e: a + (e["x0"] * e["y1"] - e["x1"] * e["y0"]).cast("double"))
    hole = F.coalesce("hole", F.lit(False)) if "hole" in polygons.columns else F.lit(False)
    rings = polygons.withColumn("_edges", corner).withColumn("sign", F.signum(twice) * F.when(hole, -1.0).otherwise(1.0))
    return rings.select("box_id", "sign", F.explode("_edges").alias("e")).select("box_id", *[F.col(f"e.{c}").cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")], "sign")


def signed_edges(edges: DataFrame) -> DataFrame:
    """`sign` for rings given as rows (box_id, ring_id, x0, y0, x1, y1, hole): their areas are summed, no ring is put together."""
    ring = ["box_id", "ring_id"]
    turn = edges.groupBy(*ring).agg((F.signum(F.sum(F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0"))) * F.when(F.bool_or("hole"), -1.0).otherwise(1.0)).alias("sign"))
    return edges.join(turn, ring).select("box_id", "x0", "y0", "x1", "y1", "sign")


def _on_grid(edges: DataFrame, size: float) -> DataFrame:
    """Edges in cell units: u to the east from -180, v to the south from 90."""
    u, v = lambda c: (F.col(c) + 180) / size, lambda c: (90 - F.col(c)) / size
    return edges.withColumns({"_u0": u("x0"), "_v0": v("y0"), "_u1": u("x1"), "_v1": v("y1")})


def _between(c: Column, low: Column) -> Column:
    return F.least(F.greatest(c, low), low + 1)


def _span(a: Column, b: Column, slack: float = 0.0) -> Column:
    return F.sequence(F.floor(F.least(a, b) - slack).cast("int"), F.floor(F.greatest(a, b) + slack).cast("int"))


def _in_row(edges: DataFrame, slack: float) -> DataFrame:
    """The part of each edge in each row that it meets, from (_us, _vs) to (_ue, _ve)."""
    rows = edges.withColumn("grow", F.explode(_span(F.col("_v0"), F.col("_v1"), slack)))
    rows = rows.withColumns({"_vs": _between(F.col("_v0"), F.col("grow")), "_ve": _between(F.col("_v1"), F.col("grow"))})
    steep = F.nullif(F.col("_v1") - F.col("_v0"), F.lit(0.0))
    at = lambda v, end: F.coalesce(F.col("_u0") + (F.col(v) - F.col("_v0")) / steep * (F.col("_u1") - F.col("_u0")), F.col(end))
    return rows.withColumns({"_us": at("_vs", "_u0"), "_ue": at("_ve", "_u1")})


def edge_shares(edges: DataFrame, size: float = 0.5) -> DataFrame:
    """(box_id, grow, gcol, w): planar share of each cell that a polygon covers, from (box_id, x0, y0, x1, y1, sign)."""
    rows = _in_row(_on_grid(edges, size).where("_v0 <> _v1"), 0.0).withColumn("_dv", (F.col("_ve") - F.col("_vs")) * F.col("sign")).where("_dv <> 0")
    cells = rows.withColumn("gcol", F.explode(_span(F.col("_us"), F.col("_ue"))))
    begin, end = _between(F.col("_us"), F.col("gcol")), _between(F.col("_ue"), F.col("gcol"))
    high = F.when(F.col("_us") == F.col("_ue"), F.col("_dv")).otherwise(F.col("_dv") * (end - begin) / (F.col("_ue") - F.col("_us")))
    east = 1 - ((begin + end) / 2 - F.col("gcol"))
    met = cells.select("box_id", "grow", "gcol", high.alias("_h"), (high * east).alias("_e")).groupBy("box_id", "grow", "gcol").agg(F.sum("_h").alias("_h"), F.sum("_e").alias("_e"))
    along = W.partitionBy("box_id", "grow").orderBy("gcol")
    upto = F.sum("_h").over(along.rowsBetween(W.unboundedPreceding, 0))
    marked = met.withColumns({"_to": upto, "_next": F.lead("gcol").over(along)})
    own = F.array(F.struct("gcol", (F.col("_to") - F.col("_h") + F.col("_e")).alias("w")))
    gap = F.transform(F.sequence(F.col("gcol") + 1, F.col("_next") - 1), lambda c: F.struct(c.alias("gcol"), F.col("_to").alias("w")))
    filled = F.when((F.col("_next") - F.col("gcol") > 1) & (F.abs("_to") > _NOISE), F.concat(own, gap)).otherwise(own)
    shares = marked.select("box_id", "grow", F.explode(filled).alias("c"))
    n_cols = F.lit(int(round(360 / size)))
    return shares.groupBy("box_id", "grow", F.pmod("c.gcol", n_cols).alias("gcol")).agg(F.sum("c.w").alias("w")).where(F.col("w") > _NOISE)


def polygon_cells(edges: DataFrame, size: float = 0.5) -> DataFrame:
    """(polygon_id, grow, gcol, crossed): cells that an edge may meet, and uncrossed cells inside (even-odd).

    `gcol` may run past the antimeridian. Inside is told by the edges that cross the middle of the row to the west.
    """
    rows = _in_row(_on_grid(edges, size), _NOISE)
    cells = rows.withColumn("gcol", F.explode(_span(F.col("_us"), F.col("_ue"), _NOISE)))
    middle = F.col("grow") + 0.5
    crosses = (F.col("_v0") > middle) != (F.col("_v1") > middle)
    at = F.col("_u0") + (middle - F.col("_v0")) / F.nullif(F.col("_v1") - F.col("_v0"), F.lit(0.0)) * (F.col("_u1") - F.col("_u0"))
    here = F.when(crosses & (F.floor(at) == F.col("gcol")), 1).otherwise(0)
    met = cells.select("polygon_id", "grow", "gcol", here.alias("_n")).groupBy("polygon_id", "grow", "gcol").agg(F.sum("_n").alias("_n"))
    along = W.partitionBy("polygon_id", "grow").orderBy("gcol")
    marked = met.withColumns({"_odd": F.sum("_n").over(along.rowsBetween(W.unboundedPreceding, 0)) % 2 == 1, "_next": F.lead("gcol").over(along)})
    own = F.array(F.struct("gcol", F.lit(True).alias("crossed")))
    gap = F.transform(F.sequence(F.col("gcol") + 1, F.col("_next") - 1), lambda c: F.struct(c.alias("gcol"), F.lit(False).alias("crossed")))
    filled = F.when((F.col("_next") - F.col("gcol") > 1) & F.col("_odd"), F.concat(own, gap)).otherwise(own)
    return marked.select("polygon_id", "grow", F.explode(filled).alias("c")).select("polygon_id", "grow", "c.gcol", "c.crossed")


def points_in_polygons(points: DataFrame, edges: DataFrame, size: float = 0.5) -> DataFrame:
    """(point_id, polygon_id), inside by the even-odd rule over all edges of a polygon.

    A point in a cell that no edge meets is settled by the cell. The others meet the edges of the polygon on
    their own strip of an eighth of a row, and are inside if an odd number of them pass to the east.
    """
    n_cols = F.lit(int(round(360 / size)))
    cells = polygon_cells(edges, size).select("polygon_id", F.col("grow").alias("_row"), F.col("gcol").alias("_over"), F.pmod("gcol", n_cols).alias("_col"), "crossed")
    at = F.floor((F.col("lon") + 180) / size).cast("int")
    placed = points.select("point_id", "lat", "lon", F.floor((90 - F.col("lat")) / size).cast("int").alias("_row"), at.alias("_at")).withColumn("_col", F.pmod("_at", n_cols))
    # polygons may run past the antimeridian: the point moves to the polygon's side
    met = placed.join(cells, ["_row", "_col"]).withColumn("lon", F.col("lon") + (F.col("_over") - F.col("_at")) * size)
    strip = lambda c: F.floor(c * STRIPS / size).cast("int")
    asked = met.where("crossed").select("point_id", "lat", "lon", "polygon_id", strip(F.col("lat")).alias("_strip"))
    spans = edges.select("polygon_id", "x0", "y0", "x1", "y1").withColumn("_strip", F.explode(F.sequence(strip(F.least("y0", "y1")), strip(F.greatest("y0", "y1")))))
    y = F.col("lat")
    passes = ((F.col("y0") > y) != (F.col("y1") > y)) & (
        F.col("lon") < F.col("x0") + (y - F.col("y0")) * (F.col("x1") - F.col("x0")) / F.nullif(F.col("y1") - F.col("y0"), F.lit(0.0))
    )
    hits = asked.join(spans, ["polygon_id", "_strip"]).where(passes).groupBy("point_id", "polygon_id").agg(F.count("*").alias("_k"))
    settled = met.where(~F.col("crossed")).select("point_id", "polygon_id")
    return settled.unionByName(hits.where(F.col("_k") % 2 == 1).drop("_k"))
