"""Geometry of regions given as vertex tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def region_geometry(vertices: DataFrame, region: str = "region_id", seq: str = "seq") -> DataFrame:
    """Bounds, area and centroid per region from its ordered ring of vertices (x, y)."""
    ring = W.partitionBy(region).orderBy(seq)
    whole = ring.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    closed = vertices.withColumns(
        {
            "_nx": F.coalesce(F.lead("x").over(ring), F.first("x").over(whole)),
            "_ny": F.coalesce(F.lead("y").over(ring), F.first("y").over(whole)),
        }
    )
    cross = F.col("x") * F.col("_ny") - F.col("_nx") * F.col("y")
    sums = closed.groupBy(region).agg(
        F.min("x").alias("west"), F.max("x").alias("east"), F.min("y").alias("south"), F.max("y").alias("north"),
        F.sum(cross).alias("_a"), F.sum((F.col("x") + F.col("_nx")) * cross).alias("_cx"), F.sum((F.col("y") + F.col("_ny")) * cross).alias("_cy"),
    )
    twice = F.nullif(F.col("_a"), F.lit(0.0))
    return sums.select(
        region, "west", "east", "south", "north", (F.abs("_a") / 2).alias("area"),
        (F.col("_cx") / (3 * twice)).alias("centroid_x"), (F.col("_cy") / (3 * twice)).alias("centroid_y"),
    )
