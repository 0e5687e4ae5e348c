"""Input tables of the engine, derived from the given parquet tables.

The definitions are plain SQL that both Spark and DuckDB run, so a query and its counterpart start
from the same rows. A "decade" is a two-year window here; window and baseline are arguments of
every operator.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASELINE = 1995
WINDOW = 2
#: The last one holds 2001, the last year of the tables, and a year without rows.
DECADES = [1995, 1997, 1999, 2001]

#: Cells of the 240 x 720 band of the half-degree grid that stand-in cell ids fold into.
GRID_CELLS = 172800

SQL: dict[str, str] = {
    # member series: one row per (scenario, member, cell, year)
    "annual": f"""
        SELECT CAST(l_suppkey % {GRID_CELLS} AS BIGINT) AS cell_id, CAST(year(l_shipdate) AS INT) AS year,
               l_returnflag AS model, l_linestatus AS gcm, concat(l_returnflag, '_', l_linestatus) AS member,
               CASE l_linenumber % 3 WHEN 0 THEN 'ssp126' WHEN 1 THEN 'ssp370' ELSE 'ssp585' END AS scenario,
               avg(l_quantity) AS value,
               CASE WHEN min(l_quantity) > 1 THEN avg(l_quantity) END AS value_null,
               sum(CASE WHEN l_discount >= 0.085 THEN l_quantity ELSE 0e0 END) AS value_zero,
               max(CASE WHEN l_discount >= 0.075 THEN 1e0 ELSE 0e0 END) AS value_bool
        FROM {{lineitem}}
        GROUP BY 1, 2, 3, 4, 5, 6""",
    # cells of one decade-less panel with zeros, used as a map
    "grid": f"""
        SELECT cell_id, grow, gcol, 89.75e0 - 5e-1 * grow AS lat, -179.75e0 + 5e-1 * gcol AS lon, acctbal
        FROM (SELECT CAST(s_suppkey % {GRID_CELLS} AS BIGINT) AS cell_id,
                     CAST(60 + floor((s_suppkey % {GRID_CELLS}) / 10e0) % 240 AS INT) AS grow,
                     CAST((716 + s_suppkey % {GRID_CELLS} % 10 + 10 * floor((s_suppkey % {GRID_CELLS}) / 24e2)) % 720
                          AS INT) AS gcol,
                     max(s_acctbal) AS acctbal
              FROM {{supplier}} GROUP BY 1, 2, 3) g""",
    "land": "SELECT cell_id, grow, gcol, lat, lon FROM grid WHERE acctbal > 1500",
    # one value per cell on the grid
    "surface": """
        SELECT g.cell_id, g.grow, g.gcol, g.lat, g.lon, a.value,
               CASE WHEN a.n_low > 3 THEN a.value END AS gappy, a.zeroed
        FROM grid g JOIN (
            SELECT cell_id, avg(value) AS value,
                   sum(CASE WHEN value < 12 THEN 1 ELSE 0 END) AS n_low,
                   CASE WHEN sum(CASE WHEN value > 44 THEN 1 ELSE 0 END) > 4 THEN avg(value_zero) ELSE 0e0 END AS zeroed
            FROM annual GROUP BY cell_id) a ON a.cell_id = g.cell_id""",
    "sites": f"""
        SELECT site_id, lat, round(CASE WHEN rawlon > 180 THEN rawlon - 360 WHEN rawlon < -180 THEN rawlon + 360 ELSE rawlon END, 6) AS lon, rawlon, asset_type,
               asset_value, country, home_region
        FROM (SELECT c_custkey AS site_id, c_mktsegment AS asset_type, c_acctbal AS asset_value,
                     n_name AS country, r_name AS home_region,
                     round(89.75e0 - 5e-1 * (60 + floor((floor(c_custkey / 15e0) % {GRID_CELLS}) / 10e0) % 240)
                       + 13e-3 * (c_custkey % 37) - 2e-1 + CASE WHEN c_custkey % 29 = 0 THEN 20e0 ELSE 0e0 END, 6) AS lat,
                     round(-179.75e0 + 5e-1 * ((716 + floor(c_custkey / 15e0) % {GRID_CELLS} % 10
                       + 10 * floor((floor(c_custkey / 15e0) % {GRID_CELLS}) / 24e2)) % 720)
                       + 107e-3 * (c_custkey % 13) - 6e-1, 6) AS rawlon
              FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
                   JOIN {{region}} ON n_regionkey = r_regionkey) s""",
    # one axis-aligned box per nation, around the cells its suppliers sit on
    "boxes": f"""
        SELECT s_nationkey AS box_id, CAST(min(grow) AS INT) AS grow0, CAST(max(grow) AS INT) AS grow1,
               min(lat) - 13e-2 AS south, max(lat) + 17e-2 AS north, 1781e-1 AS west, 1798e-1 AS east
        FROM {{supplier}} JOIN grid ON CAST(s_suppkey % {GRID_CELLS} AS BIGINT) = cell_id
        GROUP BY s_nationkey""",
    "monthly": """
        SELECT CAST(floor(l_suppkey / 10e0) AS BIGINT) AS cell_id, CAST(year(l_shipdate) AS INT) AS year,
               CAST(month(l_shipdate) AS INT) AS month, l_returnflag AS model,
               concat(l_returnflag, '_', l_linestatus) AS member,
               CASE l_linenumber % 3 WHEN 0 THEN 'ssp126' WHEN 1 THEN 'ssp370' ELSE 'ssp585' END AS scenario,
               avg(l_quantity) AS value, sum(l_quantity) AS demand,
               sum(CASE WHEN l_discount > 0.025 THEN l_quantity ELSE 0e0 END) AS supply
        FROM {lineitem} GROUP BY 1, 2, 3, 4, 5, 6""",
    "observed_days": """
        SELECT CAST(floor(user_id / 3e0) AS BIGINT) AS cell_id, event_type AS member, CAST(ts AS DATE) AS day,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS value,
               count(*) AS n_events
        FROM {events} GROUP BY 1, 2, 3""",
    "network": """
        SELECT c_custkey AS cell_id, CASE WHEN c_custkey > 0 THEN CAST(floor(c_custkey / 3e0) AS BIGINT) END AS next_id,
               CAST(round(abs(c_acctbal) * 100) AS BIGINT) AS payload
        FROM {customer}""",
    "tracks": """
        SELECT o_orderkey AS event_id, CAST(year(o_orderdate) AS INT) AS year,
               CAST(substr(o_orderpriority, 1, 1) AS INT) AS mag,
               30013e-3 + 1e-1 * (o_orderkey % 97) AS slat, -100007e-3 + 1e-1 * (floor(o_orderkey / 97e0) % 89) AS slon,
               CASE WHEN o_orderkey % 11 = 0 THEN 0e0
                    ELSE 30013e-3 + 1e-1 * (o_orderkey % 97) + 93e-3 * (o_orderkey % 7) END AS elat,
               CASE WHEN o_orderkey % 11 = 0 THEN 0e0
                    ELSE -100007e-3 + 1e-1 * (floor(o_orderkey / 97e0) % 89) + 87e-3 * (o_orderkey % 5) END AS elon,
               o_totalprice
        FROM {orders}""",
    "hail_hist": """
        SELECT l_orderkey AS event_id, l_linenumber AS embryo, max(l_quantity) AS size,
               max(CASE WHEN l_returnflag = 'N' THEN 0e0 ELSE l_quantity END) AS landed
        FROM {lineitem} WHERE l_linestatus = 'F' GROUP BY 1, 2""",
    "hail_fut": """
        SELECT l_orderkey AS event_id, l_linenumber AS embryo, max(l_quantity) AS size,
               max(CASE WHEN l_returnflag = 'N' THEN 0e0 ELSE l_quantity END) AS landed
        FROM {lineitem} WHERE l_linestatus = 'O' GROUP BY 1, 2""",
    # fine elevation pixels: 'elevation' in steps of 0.05 around sea level
    "pixels": f"""
        SELECT CAST(l_suppkey % {GRID_CELLS} AS BIGINT) AS cell_id, 40e0 * (l_quantity - 25) / 25 + l_tax AS elevation,
               l_discount >= 0.035 AS wide, l_discount >= 0.065 AS near, l_quantity AS hazard
        FROM {{lineitem}}""",
    "files": """
        SELECT DISTINCT concat(lower(model), 'mod_', lower(gcm), 'gcm_w5e5_', scenario, '_', soc, '_default_yield_global_annual_',
                      CAST(y0 AS VARCHAR(8)), '_', CAST(y0 + 1 AS VARCHAR(8)), '.nc') AS path,
               CAST(n_bytes AS BIGINT) AS n_bytes
        FROM (SELECT l_returnflag AS model, l_linestatus AS gcm,
                     CASE l_linenumber % 3 WHEN 0 THEN 'ssp126' WHEN 1 THEN 'ssp370' ELSE 'ssp585' END AS scenario,
                     CASE WHEN l_linenumber % 2 = 0 THEN '2015soc' WHEN l_tax > 0.065 THEN 'histsoc' ELSE '2015soc-from-histsoc' END AS soc,
                     1995 + 2 * CAST(floor((year(l_shipdate) - 1995) / 2e0) AS INT) AS y0,
                     count(*) * 1000 AS n_bytes
              FROM {lineitem} GROUP BY 1, 2, 3, 4, 5) f""",
    # delivered values: one row per (asset, layer, scenario, decade); layer L4 is observed
    "layer_values": """
        SELECT asset_id, layer_id, scenario, decade,
               CASE WHEN n >= 5 OR decade = 1997 THEN mean_q END AS value, mean_q - 5 AS lower_ci, mean_q + 5 AS upper_ci,
               CASE WHEN n >= 5 OR decade = 1997 THEN CASE WHEN 4 * mean_q - 50 > 100 THEN 100e0 WHEN 4 * mean_q - 50 < 1 THEN 1e0
                    ELSE 4 * mean_q - 50 END END AS percentile,
               CASE WHEN decade > 1995 AND n >= 5 THEN CASE WHEN n % 5 = 0 THEN 0e0 ELSE mean_q - 25 END END AS ols_slope,
               CASE WHEN decade > 1995 AND n >= 5 THEN CASE WHEN n % 4 = 0 THEN 0e0 ELSE 24 - low_q * 4 + n END END AS sen_slope,
               n_members, n_models
        FROM (SELECT l_suppkey AS asset_id, concat('L', CAST(l_partkey % 5 AS VARCHAR(2))) AS layer_id,
                     CASE WHEN l_partkey % 5 = 4 THEN 'observed' WHEN l_partkey % 5 = 1 AND l_linenumber % 3 = 0 THEN 'ssp245'
                          WHEN l_linenumber % 3 = 0 THEN 'ssp126'
                          WHEN l_linenumber % 3 = 1 THEN 'ssp370' ELSE 'ssp585' END AS scenario,
                     CASE WHEN l_partkey % 5 = 4 THEN 1995
                          ELSE 1995 + 2 * CAST(floor((year(l_shipdate) - 1995) / 2e0) AS INT) END AS decade,
                     avg(l_quantity) AS mean_q, min(l_quantity) AS low_q, count(*) AS n,
                     count(DISTINCT concat(l_returnflag, l_linestatus)) AS n_members,
                     count(DISTINCT l_returnflag) AS n_models
              FROM {lineitem} GROUP BY 1, 2, 3, 4) v""",
    "assets": """
        SELECT s_suppkey AS asset_id, CAST(floor(s_suppkey / 4e0) AS BIGINT) AS location_id,
               CASE s_nationkey % 3 WHEN 0 THEN 'warehouse' WHEN 1 THEN 'office' ELSE 'plant' END AS asset_type,
               'L0;L1;L2;L3;L4' AS layer_ids, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS asset_value,
               n_name AS country, r_name AS home_region
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "families": """
        SELECT * FROM (VALUES ('heat', 'L0'), ('heat', 'L1'), ('water', 'L2'), ('wind', 'L3'), ('storm', 'L4')) f(family, layer_id)""",
    "weights": """
        SELECT * FROM (VALUES ('warehouse', 'heat', 1), ('warehouse', 'water', 1), ('warehouse', 'wind', 0), ('warehouse', 'storm', 1),
            ('office', 'heat', 1), ('office', 'water', 0), ('office', 'wind', 1), ('office', 'storm', 0),
            ('plant', 'heat', 1), ('plant', 'water', 1), ('plant', 'wind', 1), ('plant', 'storm', 1)) w(asset_type, family, weight)""",
    # layer registry rows, one per part: status, review flag, direction
    "layer_registry": """
        SELECT p_partkey AS layer_key, concat(p_name, '-', CAST(p_partkey AS VARCHAR(12))) AS layer_id,
               CASE p_size % 5 WHEN 0 THEN 'preferred' WHEN 1 THEN 'alternate' WHEN 2 THEN 'blocked'
                    WHEN 3 THEN 'development' ELSE 'superseded' END AS status,
               CASE WHEN p_retailprice > 930 THEN '2026-01-01' END AS reviewed_on, p_brand AS brand, p_type AS kind
        FROM {part}""",
}


def base(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The stand-in table `name`, built lazily from the parquet files under `sf`."""
    from querybook.registry import expand

    text = expand(f"SELECT * FROM {name}")
    text = re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{sf}/{m.group(1)}.parquet`", text)
    return spark.sql(text)


#: DuckDB text of the gap-filled daily series; Spark builds it with an exploded day sequence.
SQL["daily"] = """
        SELECT k.cell_id, k.member, d.day, coalesce(o.value, 0e0) AS value, coalesce(o.n_events, 0) AS n_events
        FROM (SELECT DISTINCT cell_id, member FROM observed_days) k
        CROSS JOIN (SELECT DISTINCT day FROM observed_days) d
        LEFT JOIN observed_days o ON o.cell_id = k.cell_id AND o.member = k.member AND o.day = d.day"""


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily series with missing days filled with 0."""
    seen = table(spark, sf, "observed_days")
    span = seen.agg(F.min("day").alias("d0"), F.max("day").alias("d1"))
    keys = seen.select("cell_id", "member").distinct().withColumn(
        "day", F.explode(F.sequence(span.select("d0").scalar(), span.select("d1").scalar()))
    )
    return keys.join(seen, ["cell_id", "member", "day"], "left").select(
        "cell_id",
        "member",
        "day",
        F.coalesce("value", F.lit(0.0)).alias("value"),
        F.coalesce("n_events", F.lit(0)).alias("n_events"),
    )
