"""Composite hazard jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellcast.functions.scalar import cell_area_km2
from cellcast.plans import hazards, layer, models
from querybook.common import gamma_below_sql, gamma_quantiles_sql, rounded
from querybook.layers import LAYER_FLOATS
from querybook.registry import query
from querybook.standins import DECADES, SQL, base, table
from querybook.spatial import crossings
from querybook.statistics import QUARTILES, RATE_QUARTILES, exposure

SPEC = layer.LayerSpec(decades=DECADES, baseline=1995, window=2)


def layer_sql(src, central="median", mode="pool_all", rank="two_tier", side="<=", higher=False, by="", extra="", scale=10, value="value"):
    """The layer job in SQL over the rows of `src`; `by` is '' or a layer column name."""
    b = f"{by}, " if by else ""
    on = (lambda x, y: f" AND {x}.{by} = {y}.{by}") if by else (lambda x, y: "")
    if central == "median":
        stats = "quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.25) AS lower_ci, quantile_cont(v, 0.75) AS upper_ci"
    else:
        stats = "avg(v) AS median, avg(v) - stddev_pop(v) AS lower_ci, avg(v) + stddev_pop(v) AS upper_ci"
    base_src = "lp WHERE decade = 1995"
    if mode == "member_mean_first":
        base_src = f"(SELECT {b}member, cell_id, year, avg(v) AS v FROM lp WHERE decade = 1995 GROUP BY ALL) mm"
    n_all, n_pos = "nullif(t.n, 0)", "(t.n - t.z)"
    hits_r = f"(SELECT count(*) FROM lb x WHERE x.median <= p.median{on('x', 'p')})"
    hits_l = f"(SELECT count(*) FROM lb x WHERE x.median < p.median{on('x', 'p')})"
    pos = f"(SELECT count(*) FROM lb x WHERE x.median > 0 AND x.median {side} p.median{on('x', 'p')})"
    one = f"greatest(1, least(100, 100.0 * {hits_r} / {n_all}))"
    two = f"CASE WHEN p.median > 0 THEN coalesce(greatest(2, least(100, 2 + 98.0 * {pos} / nullif({n_pos}, 0))), 1) WHEN p.median IS NOT NULL THEN 1 END"
    if rank == "stress":
        two = f"CASE WHEN p.median = 0 THEN 1 WHEN p.median > 0 THEN 1 + 99.0 * (SELECT count(*) FROM lb x WHERE x.median > 0 AND x.median < p.median{on('x', 'p')}) / nullif({n_pos}, 0) END"
        pct = f"CASE WHEN t.zero / t.n > 0.02 THEN {two} ELSE 100.0 * {hits_l} / {n_all} END"
    else:
        pct = f"CASE WHEN t.zero / t.n >= 0.02 THEN {two} ELSE {one} END"
    pct = f"CASE WHEN p.median IS NOT NULL AND t.n > 0 THEN {pct} END"
    if higher:
        pct = f"CASE WHEN p.median IS NOT NULL AND t.n > 0 THEN greatest(1, least(100, 101 - ({pct}))) END"
    return f"""
    WITH {extra} la AS (SELECT *, {value} AS v FROM {src}),
    lp AS (SELECT *, CAST(CASE WHEN year BETWEEN 1995 AND 1996 THEN 1995 WHEN year BETWEEN 1997 AND 1998 THEN 1997 WHEN year BETWEEN 1999 AND 2000 THEN 1999 ELSE 2001 END AS INT) AS decade FROM la WHERE year BETWEEN 1995 AND 2002),
    lb AS (SELECT {b}cell_id, {stats} FROM {base_src} GROUP BY {b}cell_id),
    lq AS (SELECT {b}scenario, decade, cell_id, {stats} FROM lp WHERE decade > 1995 GROUP BY {b}scenario, decade, cell_id
           UNION ALL SELECT {"s." + by + ", " if by else ""}s.scenario, 1995, b.cell_id, b.median, b.lower_ci, b.upper_ci FROM lb b JOIN (SELECT DISTINCT {b}scenario FROM la) s ON true{on('s', 'b')}),
    lt AS (SELECT {b}count(median) AS n, count(CASE WHEN median <= 0 THEN 1 END) AS z, count(CASE WHEN median = 0 THEN 1 END) AS zero FROM lb {"GROUP BY " + by if by else ""}),
    ls AS (SELECT a.*, d.d AS sdec FROM la a JOIN (VALUES (1997), (1999), (2001)) d(d) ON a.year BETWEEN 1995 AND d.d + 1 WHERE a.v IS NOT NULL),
    lo AS (SELECT {b}scenario, sdec AS decade, cell_id, CASE WHEN count(*) >= 3 AND min(year) < max(year) THEN {scale} * regr_slope(v, year) END AS ols_slope, count(*) AS n FROM ls GROUP BY {b}scenario, sdec, cell_id),
    ln AS (SELECT {"a." + by + ", " if by else ""}a.scenario, a.sdec AS decade, a.cell_id, {scale} * quantile_cont((c.v - a.v) / (c.year - a.year), 0.5) AS sen FROM ls a JOIN ls c ON a.scenario = c.scenario AND a.cell_id = c.cell_id AND a.sdec = c.sdec AND a.year < c.year{on('a', 'c')}
           GROUP BY {"a." + by + ", " if by else ""}a.scenario, a.sdec, a.cell_id),
    ld AS (SELECT {b}scenario, decade, cell_id, nullif(count(DISTINCT CASE WHEN v IS NOT NULL THEN member END), 0) AS n_members, nullif(count(DISTINCT CASE WHEN v IS NOT NULL THEN model END), 0) AS n_models FROM lp GROUP BY {b}scenario, decade, cell_id)
    SELECT {"p." + by + ", " if by else ""}p.scenario, p.decade, p.cell_id, round(p.median, 6) AS median, round(p.lower_ci, 6) AS lower_ci, round(p.upper_ci, 6) AS upper_ci, round({pct}, 6) AS percentile,
           round(CASE WHEN p.median IS NOT NULL THEN lo.ols_slope END, 6) AS ols_slope, round(CASE WHEN p.median IS NOT NULL AND lo.n >= 3 THEN ln.sen END, 6) AS sen_slope, ld.n_members, ld.n_models
    FROM lq p JOIN lt t ON true{on('t', 'p')}
    LEFT JOIN lo ON lo.scenario = p.scenario AND lo.decade = p.decade AND lo.cell_id = p.cell_id{on('lo', 'p')}
    LEFT JOIN ln ON ln.scenario = p.scenario AND ln.decade = p.decade AND ln.cell_id = p.cell_id{on('ln', 'p')}
    LEFT JOIN ld ON ld.scenario = p.scenario AND ld.decade = p.decade AND ld.cell_id = p.cell_id{on('ld', 'p')}"""


def shown(df):
    return rounded(df, *LAYER_FLOATS)


SQL["burnt"] = "SELECT cell_id, scenario, model, member, year, CASE WHEN count(DISTINCT month) = 12 THEN sum(value) END AS value FROM monthly GROUP BY 1, 2, 3, 4, 5"


@query("h2_fire_layer", layer_sql("burnt"))
def h2(spark, sf):
    return shown(hazards.fire_layer(table(spark, sf, "monthly"), SPEC))


DJ = "least((b.gcol - a.gcol + 720) % 720, (a.gcol - b.gcol + 720) % 720)"
SQL["smoothpairs"] = f"""
    SELECT a.cell_id AS target, b.cell_id AS source, exp(-sqrt(pow(b.grow - a.grow, 2) + pow({DJ} * cos(radians(a.lat)), 2)) / 2.5) AS wl, exp(-sqrt(pow(b.grow - a.grow, 2) + pow({DJ}, 2)) / 2.5) AS wi
    FROM grid a JOIN grid b ON abs(b.grow - a.grow) <= 2 AND {DJ} <= 2"""


def _smoothed(w):
    return f"""(SELECT s.target AS cell_id, a.scenario, a.model, a.member, a.year, sum({w} * a.value_zero) / sum({w}) AS value, bool_or(s.target = s.source) AS here FROM annual a JOIN smoothpairs s ON s.source = a.cell_id GROUP BY 1, 2, 3, 4, 5) sm WHERE here"""


@query("h3_cyclone_layer", layer_sql(_smoothed("wl"), central="mean"))
def h3(spark, sf):
    a = table(spark, sf, "annual").select("scenario", "model", "member", "cell_id", "year", F.col("value_zero").alias("value"))
    return shown(hazards.smoothed_layer(a, table(spark, sf, "grid"), SPEC))


@query("h3_heat_layer", layer_sql(_smoothed("wi"), central="mean"))
def h3_heat(spark, sf):
    a = table(spark, sf, "annual").select("scenario", "model", "member", "cell_id", "year", F.col("value_zero").alias("value"))
    return shown(hazards.smoothed_layer(a, table(spark, sf, "grid"), SPEC, kernel="index"))


SQL["thaw"] = "SELECT scenario, model, member, cell_id, year, CASE WHEN value > 38 THEN 38e0 + CASE model WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END ELSE value END AS value FROM annual"
SQL["thawshare"] = """
    WITH q AS (SELECT model, quantile_cont(value, 0.99) AS c FROM thaw GROUP BY 1), m AS (SELECT t.model, round(value, 4) AS r, count(*) AS n FROM thaw t JOIN q ON q.model = t.model AND value >= c GROUP BY 1, 2),
    k AS (SELECT model, arg_max(r, n * 1e6 - r) AS cap FROM m GROUP BY 1), s AS (SELECT t.scenario, t.model, t.member, t.cell_id, t.year, greatest(0, least(1, value / cap)) AS value FROM thaw t JOIN k ON k.model = t.model),
    b AS (SELECT member, cell_id FROM (SELECT scenario, member, cell_id, max(value) AS m FROM s WHERE year BETWEEN 1995 AND 1996 GROUP BY 1, 2, 3) x GROUP BY 1, 2 HAVING bool_or(m < 1 - 1e-4)),
    f AS (SELECT s.* FROM s JOIN b ON b.member = s.member AND b.cell_id = s.cell_id)
    SELECT * FROM f WHERE cell_id IN (SELECT cell_id FROM f GROUP BY 1 HAVING count(DISTINCT model) >= 3)"""


@query("h4_permafrost_layer", layer_sql("thawshare", central="mean"))
def h4(spark, sf):
    return shown(hazards.permafrost_layer(table(spark, sf, "thaw"), SPEC, 3))


SQL["tiles"] = """
    SELECT a.scenario, a.model, a.member, a.cell_id, a.year, CASE WHEN c.cover / 100 >= 0.4 THEN a.value / (c.cover / 100) END AS value
    FROM annual a JOIN (SELECT cell_id, member, year, max(value_zero) AS cover FROM annual GROUP BY 1, 2, 3) c ON c.cell_id = a.cell_id AND c.member = a.member AND c.year = a.year"""


@query("h5_productivity_layer", layer_sql("tiles", higher=True))
def h5(spark, sf):
    a = table(spark, sf, "annual")
    cover = a.groupBy("cell_id", "member", "year").agg(F.max("value_zero").alias("cover"))
    rows = a.select("scenario", "model", "member", "cell_id", "year", "value")
    return shown(hazards.productivity_layer(rows, cover, SPEC, 0.4))


SQL["variants"] = """
    SELECT 'none' AS layer, scenario, model, member, cell_id, year, value_null AS value FROM annual UNION ALL SELECT 'low', scenario, model, member, cell_id, year, value_zero FROM annual
    UNION ALL SELECT 'high', scenario, model, member, cell_id, year, value_zero / 4 FROM annual"""


@query("h6_flooded_layers", layer_sql("""variants WHERE cell_id IN (SELECT cell_id FROM annual WHERE value_null IS NOT NULL GROUP BY cell_id HAVING count(DISTINCT member) = (SELECT count(DISTINCT member) FROM annual))
    AND cell_id NOT IN (SELECT cell_id FROM annual GROUP BY cell_id HAVING bool_and(coalesce(value_null, 0) >= 2))""", by="layer"))
def h6(spark, sf):
    return shown(hazards.flooded_layers(table(spark, sf, "variants"), SPEC, 2.0, "none"))


SQL["memberdays"] = """
    SELECT CAST(floor(l_suppkey / 50e0) AS BIGINT) AS cell_id, CASE l_linenumber % 3 WHEN 0 THEN 'ssp126' WHEN 1 THEN 'ssp370' ELSE 'ssp585' END AS scenario, l_returnflag AS model,
           concat(l_returnflag, '_', l_linestatus) AS member, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) / 2 AS value
    FROM {lineitem} GROUP BY 1, 2, 3, 4, 5"""
RUNGS = [("above_20", ">", 20.0), ("above_30", ">", 30.0), ("below_3", "<", 3.0)]
SQL["rungs"] = """
    WITH c AS (SELECT scenario, model, member, cell_id, CAST(year(day) AS INT) AS year, count(CASE WHEN value > 20 THEN 1 END) AS above_20, count(CASE WHEN value > 30 THEN 1 END) AS above_30, count(CASE WHEN value < 3 THEN 1 END) AS below_3 FROM memberdays GROUP BY 1, 2, 3, 4, 5)
    SELECT 'above_20' AS layer, scenario, model, member, cell_id, year, CAST(above_20 AS DOUBLE) AS value FROM c UNION ALL SELECT 'above_30', scenario, model, member, cell_id, year, above_30 FROM c UNION ALL SELECT 'below_3', scenario, model, member, cell_id, year, below_3 FROM c"""


@query("h7_temperature_ladder", layer_sql("rungs", by="layer"))
def h7(spark, sf):
    return shown(hazards.ladder_layers(table(spark, sf, "memberdays"), RUNGS, SPEC))


SQL["rain"] = """
    WITH h AS (SELECT cell_id, CAST(greatest(0, least(255, floor(ln(value) / ln(1000e0) * 256))) AS INT) AS bin, count(*) AS n FROM memberdays WHERE value >= 1 AND year(day) BETWEEN 1995 AND 1996 GROUP BY 1, 2),
    c AS (SELECT *, sum(n) OVER (PARTITION BY cell_id ORDER BY bin) AS running, sum(n) OVER (PARTITION BY cell_id) AS n_wet FROM h),
    t AS (SELECT cell_id, exp(bin * ln(1000e0) / 256) + (n_wet * 0.9e0 - (running - n)) / n * (exp((bin + 1) * ln(1000e0) / 256) - exp(bin * ln(1000e0) / 256)) AS cut FROM c WHERE running >= n_wet * 0.9e0 AND running - n < n_wet * 0.9e0 AND n_wet >= 840),
    f AS (SELECT * FROM (SELECT scenario, model, member, cell_id, day, sum(value) OVER w AS s5, count(*) OVER w AS k FROM memberdays WINDOW w AS (PARTITION BY scenario, model, member, cell_id ORDER BY day RANGE BETWEEN INTERVAL 4 DAYS PRECEDING AND CURRENT ROW)) x WHERE k = 5),
    m AS (SELECT d.scenario, d.model, d.member, d.cell_id, CAST(year(day) AS INT) AS year, count(CASE WHEN value >= 20 THEN 1 END) AS r20, coalesce(sum(CASE WHEN value >= 1 THEN value END), 0) AS prcptot, count(CASE WHEN value >= 1 THEN 1 END) AS wetdays, max(value) AS rx1day,
          CASE WHEN max(t.cut) IS NOT NULL THEN count(CASE WHEN value >= t.cut THEN 1 END) END AS relative FROM memberdays d LEFT JOIN t ON t.cell_id = d.cell_id GROUP BY 1, 2, 3, 4, 5),
    x AS (SELECT scenario, model, member, cell_id, CAST(year(day) AS INT) AS year, max(s5) AS rx5day FROM f GROUP BY 1, 2, 3, 4, 5),
    j AS (SELECT m.*, x.rx5day FROM m LEFT JOIN x USING (scenario, model, member, cell_id, year))
    SELECT layer, scenario, model, member, cell_id, year, CAST(CASE layer WHEN 'r20' THEN r20 WHEN 'prcptot' THEN prcptot WHEN 'wetdays' THEN wetdays WHEN 'rx1day' THEN rx1day WHEN 'rx5day' THEN rx5day ELSE relative END AS DOUBLE) AS value
    FROM j, (VALUES ('r20'), ('prcptot'), ('wetdays'), ('rx1day'), ('rx5day'), ('relative')) l(layer)"""


@query("h8_precipitation_family", layer_sql("rain", by="layer", side="<"))
def h8(spark, sf):
    return shown(hazards.precipitation_layers(table(spark, sf, "memberdays"), [("r20", ">=", 20.0)], SPEC, 90.0, 840))


SQL["watermonths"] = """
    SELECT cell_id, scenario, model, member, year, month, CASE WHEN demand > 100 THEN NULL ELSE demand END AS demand, supply AS runoff, supply * 5 + value AS discharge FROM monthly"""
SQL["waterflow"] = "SELECT DISTINCT cell_id, CASE WHEN cell_id > 0 THEN CAST(floor(cell_id / 3e0) AS BIGINT) END AS next_id FROM monthly"
SQL["waterriver"] = "SELECT member, cell_id FROM watermonths WHERE year BETWEEN 1995 AND 1996 GROUP BY 1, 2 HAVING avg(discharge) > 300"
STRESS = """WITH RECURSIVE up AS (SELECT cell_id AS origin, cell_id, next_id FROM waterflow UNION ALL SELECT up.origin, n.cell_id, n.next_id FROM up JOIN waterflow n ON n.cell_id = up.next_id),
    acc AS (SELECT u.cell_id, w.scenario, w.model, w.member, w.year, w.month, sum(w.demand) AS demand FROM watermonths w JOIN up u ON u.origin = w.cell_id WHERE w.demand IS NOT NULL GROUP BY ALL),
    num AS (SELECT 'local' AS name, w.cell_id, w.scenario, w.model, w.member, w.year, w.month, w.demand, w.runoff AS den, true AS river FROM watermonths w
            UNION ALL SELECT 'routed', w.cell_id, w.scenario, w.model, w.member, w.year, w.month, a.demand, w.discharge, EXISTS (SELECT 1 FROM waterriver r WHERE r.member = w.member AND r.cell_id = w.cell_id) FROM watermonths w LEFT JOIN acc a USING (cell_id, scenario, model, member, year, month)),
    rat AS (SELECT *, CASE WHEN demand IS NULL OR den IS NULL OR NOT river THEN NULL WHEN demand = 0 THEN 0 WHEN den > 0 THEN demand / den END AS r FROM num),
    yr AS (SELECT name, scenario, model, member, cell_id, year, count(r) AS n, sum(demand) AS a, sum(den) AS b, max(r) AS m FROM rat GROUP BY ALL),
    stressed AS (SELECT concat(name, '_annual') AS layer, scenario, model, member, cell_id, year, CASE WHEN n = 12 THEN CASE WHEN a = 0 THEN 0 WHEN b > 0 THEN least(a / b, 100) END END AS value FROM yr
      UNION ALL SELECT concat(name, '_worst_month'), scenario, model, member, cell_id, year, CASE WHEN n = 12 THEN least(m, 100) END FROM yr),"""


@query("h9_water_stress", layer_sql("stressed", by="layer", mode="member_mean_first", rank="stress", extra=STRESS.replace("WITH RECURSIVE ", "", 1)).replace("WITH ", "WITH RECURSIVE ", 1))
def h9(spark, sf):
    m = table(spark, sf, "watermonths")
    return shown(hazards.water_stress_layers(m, table(spark, sf, "waterflow"), table(spark, sf, "waterriver"), SPEC))


SQL["sealevel"] = """
    SELECT a.scenario, a.member, a.year, g.cell_id, g.grow, g.gcol, g.lat, g.lon, a.value / 20 AS value FROM annual a JOIN grid g ON g.cell_id = a.cell_id WHERE g.acctbal <= 6000"""
SQL["drydland"] = "SELECT cell_id, lat, lon FROM grid WHERE acctbal > 6000"
SQL["deltas"] = """
    SELECT s.*, s.value - r.ref AS delta, CAST(1995 + 2 * floor((s.year - 1995) / 2e0) AS INT) AS decade FROM sealevel s JOIN (SELECT member, cell_id, avg(m) AS ref FROM (SELECT scenario, member, cell_id, avg(value) AS m FROM sealevel WHERE year BETWEEN 1995 AND 1996 GROUP BY 1, 2, 3) x GROUP BY 1, 2) r
      ON r.member = s.member AND r.cell_id = s.cell_id"""
CONSENSUS = """WITH RECURSIVE oc AS (SELECT DISTINCT grow, gcol, grow * 720 + gcol AS num FROM sealevel),
    e AS (SELECT a.num AS a, b.num AS b FROM oc a JOIN oc b ON abs(a.grow - b.grow) <= 1 AND least((a.gcol - b.gcol + 720) % 720, (b.gcol - a.gcol + 720) % 720) <= 1),
    rc AS (SELECT num AS a, num AS b FROM oc UNION SELECT rc.a, e.b FROM rc JOIN e ON rc.b = e.a), comp AS (SELECT oc.grow, oc.gcol, min(rc.b) AS component FROM rc JOIN oc ON oc.num = rc.a GROUP BY 1, 2),
    pn AS (SELECT scenario, decade, member, grow, gcol, avg(delta) AS v FROM deltas GROUP BY ALL), md AS (SELECT scenario, decade, grow, gcol, quantile_cont(v, 0.5) AS m, count(*) AS n FROM pn GROUP BY ALL),
    fl AS (SELECT pn.member, pn.grow, pn.gcol, bool_or(n >= 3) AS judged, bool_or(n >= 3 AND abs(v - m) > 0.5) AS failed FROM pn JOIN md USING (scenario, decade, grow, gcol) GROUP BY 1, 2, 3),
    bd AS (SELECT member, component, count(CASE WHEN failed THEN 1 END) / nullif(count(CASE WHEN judged THEN 1 END), 0) AS share FROM fl JOIN comp USING (grow, gcol) GROUP BY 1, 2),
    us AS (SELECT fl.member, fl.grow, fl.gcol, judged, NOT failed AND coalesce(share, 0) <= {limit} AS keep FROM fl LEFT JOIN comp USING (grow, gcol) LEFT JOIN bd ON bd.member = fl.member AND bd.component = comp.component)"""


@query("h10_consensus_members", CONSENSUS.format(limit=0.25) + " SELECT member, grow, gcol, judged, keep FROM us")
def h10(spark, sf):
    from cellcast.operators.graph import connected_components

    d = table(spark, sf, "deltas").withColumn("value", F.col("delta")).drop("decade")
    ocean = table(spark, sf, "sealevel").select("grow", "gcol").distinct()
    return hazards.consensus_members(d, DECADES, 2, connected_components(ocean))


KM = """2 * 6371.0088e0 * asin(sqrt(greatest(0, least(1, pow(sin(radians(s.lat - d.lat) / 2), 2) + cos(radians(d.lat)) * cos(radians(s.lat)) * pow(sin(radians((((s.lon - d.lon) + 540) % 360) - 180) / 2), 2)))))"""


@query("h10_sea_level_delta", CONSENSUS.format(limit=0.25).replace("abs(v - m) > 0.5", "abs(v - m) > 1.4567") + f""",
    so AS (SELECT us.member, q.cell_id, q.lat, q.lon FROM us JOIN (SELECT DISTINCT cell_id, grow, gcol, lat, lon FROM sealevel) q USING (grow, gcol) WHERE judged AND keep),
    nn AS (SELECT d.cell_id, s.member, s.cell_id AS src, {KM} AS km FROM drydland d, so s), pk AS (SELECT *, row_number() OVER (PARTITION BY cell_id, member ORDER BY round(km, 6), src) AS rn FROM nn WHERE km <= 150)
    SELECT x.scenario, x.member, x.year, pk.cell_id, round(x.delta, 6) AS value, round(pk.km, 6) AS km FROM pk JOIN deltas x ON x.member = pk.member AND x.cell_id = pk.src WHERE rn = 1""")
def h10_delta(spark, sf):
    levels = table(spark, sf, "sealevel")
    ocean = levels.select("grow", "gcol").distinct()
    out = hazards.sea_level_delta(levels, ocean, table(spark, sf, "drydland"), 1995, 2, DECADES, 1.4567, 150.0)
    return rounded(out, "value")


@query("h11_coastal_panels", """
    WITH x AS (SELECT e.*, 'ssp585' AS scenario, CAST(1995 + 2 * floor((year - 1995) / 2e0) AS INT) AS decade FROM exposure e),
    p AS (SELECT scenario, cell_id, decade, avg(exposed) AS m, stddev_pop(exposed) AS s, avg(percentile) AS pct FROM x GROUP BY 1, 2, 3),
    k AS (SELECT x.*, d.d AS sdec FROM x JOIN (VALUES (1997), (1999), (2001)) d(d) ON x.year BETWEEN 1995 AND d.d + 1),
    o AS (SELECT cell_id, sdec, regr_slope(exposed, year) AS ols FROM k GROUP BY 1, 2), n AS (SELECT a.cell_id, a.sdec, quantile_cont((b.exposed - a.exposed) / (b.year - a.year), 0.5) AS sen FROM k a JOIN k b ON a.cell_id = b.cell_id AND a.sdec = b.sdec AND a.year < b.year GROUP BY 1, 2)
    SELECT p.scenario, p.cell_id, p.decade, round(m, 6) AS median, round(greatest(m - s, 0), 6) AS lower_ci, round(least(m + s, 1), 6) AS upper_ci, round(pct, 5) AS percentile, round(ols, 6) AS ols_slope, round(sen, 6) AS sen_slope
    FROM p LEFT JOIN o ON o.cell_id = p.cell_id AND o.sdec = p.decade LEFT JOIN n ON n.cell_id = p.cell_id AND n.sdec = p.decade""")
def h11(spark, sf):
    e = exposure(spark, sf).withColumn("scenario", F.lit("ssp585"))
    out = hazards.coastal_panels(e, DECADES, 1995, 2)
    return rounded(rounded(out, "median", "lower_ci", "upper_ci", "ols_slope", "sen_slope"), "percentile", n=5)


# the rectangle of grid cells that the tracks' bounding box covers
SQL["box40"] = """
    SELECT CAST(r.r AS INT) AS grow, CAST(c.c AS INT) AS gcol
    FROM (SELECT unnest(generate_series(CAST((SELECT min(grow) FROM crossings) AS BIGINT), CAST((SELECT max(grow) FROM crossings) AS BIGINT))) AS r) r,
         (SELECT unnest(generate_series(CAST((SELECT min(gcol) FROM crossings) AS BIGINT), CAST((SELECT max(gcol) FROM crossings) AS BIGINT))) AS c) c"""


def domain_cells(spark, sf):
    """The rectangle of grid cells that the tracks' bounding box covers."""
    box = crossings(spark, sf).agg(*[f(c).alias(f"{n}_{c}") for c in ("grow", "gcol") for n, f in (("low", F.min), ("high", F.max))])
    rows = box.withColumn("grow", F.explode(F.sequence("low_grow", "high_grow")))
    return rows.withColumn("gcol", F.explode(F.sequence("low_gcol", "high_gcol"))).select("grow", "gcol")


@query("h12_tornado_layer", """
    WITH k AS (SELECT d.grow, d.gcol, coalesce(t.n, 0) AS n_events FROM box40 d LEFT JOIN (SELECT grow, gcol, count(*) AS n FROM crossings GROUP BY 1, 2) t ON t.grow = d.grow AND t.gcol = d.gcol),
    x AS (SELECT *, n_events / (6371.0088e0 * 6371.0088e0 * radians(5e-1) * (sin(radians(25 + (grow + 0.5) * 0.5 + 0.25)) - sin(radians(25 + (grow + 0.5) * 0.5 - 0.25))) / 1e4 * 7) AS rate FROM k),
    r AS (SELECT grow, gcol, rank() OVER (ORDER BY round(rate, 12)) + (count(*) OVER (PARTITION BY round(rate, 12)) - 1) / 2e0 AS rk, count(*) OVER () AS n FROM x WHERE n_events > 0)
    SELECT x.grow, x.gcol, x.n_events, round(x.rate, 6) AS median, round(CASE WHEN n_events = 0 THEN 1 WHEN n = 1 THEN 100 ELSE 2 + 98.0 * (rk - 1) / (n - 1) END, 6) AS percentile FROM x LEFT JOIN r ON r.grow = x.grow AND r.gcol = x.gcol""")
def h12(spark, sf):
    out = hazards.tornado_layer(table(spark, sf, "tracks"), 7, 0.5, 25.0, -105.0, 40, 60, domain_cells(spark, sf), "mle")
    return rounded(out, "median", "percentile").select("grow", "gcol", "n_events", "median", "percentile")


@query("h12_tornado_posterior", f"""
    WITH RECURSIVE e AS (SELECT d.grow, d.gcol, coalesce(t.n, 0) AS n_events, 6371.0088e0 * 6371.0088e0 * radians(5e-1) * (sin(radians(25 + (d.grow + 0.5) * 0.5 + 0.25)) - sin(radians(25 + (d.grow + 0.5) * 0.5 - 0.25))) / 1e4 * 7 AS exposure
        FROM box40 d LEFT JOIN (SELECT grow, gcol, count(*) AS n FROM crossings GROUP BY 1, 2) t ON t.grow = d.grow AND t.gcol = d.gcol),
    {gamma_quantiles_sql("SELECT DISTINCT n_events + 0.5 AS a FROM e", QUARTILES)},
    x AS (SELECT grow, gcol, n_events, exposure, max(CASE WHEN q = 0.5 THEN x END) / exposure AS rate, {RATE_QUARTILES} FROM e JOIN gammaquant ON a = n_events + 0.5 GROUP BY 1, 2, 3, 4),
    r AS (SELECT grow, gcol, rank() OVER (ORDER BY round(rate, 12)) + (count(*) OVER (PARTITION BY round(rate, 12)) - 1) / 2e0 AS rk, count(*) OVER () AS n FROM x WHERE n_events > 0)
    SELECT x.grow, x.gcol, x.n_events, round(exposure, 6) AS exposure, median, lower_ci, upper_ci, round(CASE WHEN n_events = 0 THEN 1 WHEN n = 1 THEN 100 ELSE 2 + 98.0 * (rk - 1) / (n - 1) END, 6) AS percentile
    FROM x LEFT JOIN r ON r.grow = x.grow AND r.gcol = x.gcol""")
def h12_posterior(spark, sf):
    out = hazards.tornado_layer(table(spark, sf, "tracks"), 7, 0.5, 25.0, -105.0, 40, 60, domain_cells(spark, sf))
    shown = rounded(out, "median", "lower_ci", "upper_ci", "percentile", "exposure")
    return shown.select("grow", "gcol", "n_events", "exposure", "median", "lower_ci", "upper_ci", "percentile")


@query("h12_hail_layer", """
    WITH k AS (SELECT CAST(floor(lat / 0.5) AS INT) AS grow, CAST(floor(lon / 0.5) AS INT) AS gcol, sum(CASE WHEN asset_value > 9000 THEN 1 ELSE 0 END) AS n_events FROM sites GROUP BY 1, 2),
    x AS (SELECT *, n_events / (6371.0088e0 * 6371.0088e0 * radians(5e-1) * (sin(radians((grow + 0.5) * 0.5 + 0.25)) - sin(radians((grow + 0.5) * 0.5 - 0.25))) / 1e4 * 40) AS rate FROM k),
    r AS (SELECT grow, gcol, rank() OVER (ORDER BY round(rate, 12)) + (count(*) OVER (PARTITION BY round(rate, 12)) - 1) / 2e0 AS rk, count(*) OVER () AS n FROM x WHERE n_events > 0)
    SELECT x.grow, x.gcol, x.n_events, round(x.rate, 6) AS median, round(CASE WHEN n_events = 0 THEN 1 WHEN n = 1 THEN 2 ELSE 2 + 98.0 * (rk - 1) / (n - 1) END, 6) AS percentile FROM x LEFT JOIN r ON r.grow = x.grow AND r.gcol = x.gcol""")
def h12_hail(spark, sf):
    pts = table(spark, sf, "sites").withColumn("amount", F.when(F.col("asset_value") > 9000, 1).otherwise(0))
    return rounded(hazards.hail_layer(pts, 40, 0.5), "median", "percentile").select("grow", "gcol", "n_events", "median", "percentile")


@query("h12_landslide_layer", """
    WITH b AS (SELECT CAST(floor(grow / 2) AS INT) AS block_row, CAST(floor(gcol / 2) AS INT) AS block_col, sum(zeroed * cos(radians(lat))) / sum(cos(radians(lat))) AS am, count(CASE WHEN zeroed > 0 THEN 1 END) AS n_hazard, coalesce(quantile_cont(CASE WHEN zeroed > 0 THEN zeroed END, 0.5), 0) AS median FROM surface GROUP BY 1, 2),
    r AS (SELECT *, rank() OVER (ORDER BY round(am, 12)) + (count(*) OVER (PARTITION BY round(am, 12)) - 1) / 2e0 AS rk, count(*) OVER () AS n FROM b WHERE n_hazard > 0)
    SELECT b.block_row, b.block_col, round(b.am, 6) AS areal_mean, b.n_hazard, round(b.median, 6) AS median, round(CASE WHEN b.n_hazard = 0 THEN 1 ELSE 2 + 98.0 * (rk - 0.5) / n END, 6) AS percentile FROM b LEFT JOIN r ON r.block_row = b.block_row AND r.block_col = b.block_col""")
def h12_landslide(spark, sf):
    out = hazards.landslide_layer(table(spark, sf, "surface"), 2, "zeroed")
    return rounded(out, "areal_mean", "median", "percentile").select("block_row", "block_col", "areal_mean", "n_hazard", "median", "percentile")


KE = "CASE WHEN landed < 22.1 THEN 0.0107e0 * pow(landed / 10, 4.59e0) ELSE 0.0243e0 * pow(landed / 10, 3.5e0) END"


def _fields(t):
    return f"""SELECT event_id % 50 AS cell_id, 'm' || CAST(embryo % 3 AS VARCHAR) AS member, sum(CASE WHEN landed > 0 THEN {KE} END) / nullif(count(CASE WHEN landed > 0 THEN 1 END), 0) AS mean_ke, count(CASE WHEN landed > 0 THEN 1 END) / count(*) AS production,
        coalesce(sum(CASE WHEN landed > 0 THEN {KE} END), 0) / count(*) AS ake FROM {t} WHERE event_id IN (SELECT event_id FROM hail_hist INTERSECT SELECT event_id FROM hail_fut) GROUP BY 1, 2"""


@query("h13_hail_severity", f"""
    WITH h AS ({_fields('hail_hist')}), f AS ({_fields('hail_fut')}), c AS (SELECT h.cell_id, h.member, 100 * (f.mean_ke / nullif(h.mean_ke, 0) - 1) AS mean_ke, 100 * (f.production / nullif(h.production, 0) - 1) AS production, 100 * (f.ake / nullif(h.ake, 0) - 1) AS ake
      FROM h JOIN f ON h.cell_id = f.cell_id AND h.member = f.member), l AS (UNPIVOT c ON mean_ke, production, ake INTO NAME quantity VALUE v)
    SELECT cell_id, quantity, round(quantile_cont(v, 0.5), 5) AS change_pct, round(min(v), 5) AS change_low, round(max(v), 5) AS change_high FROM l GROUP BY 1, 2""")
def h13(spark, sf):
    tag = lambda t: table(spark, sf, t).withColumn("member", F.concat(F.lit("m"), (F.col("embryo") % 3).cast("string")))
    out = hazards.hail_severity(tag("hail_hist"), tag("hail_fut"), F.col("event_id") % 50, ["mean_ke", "production", "ake"])
    return rounded(out, "change_pct", "change_low", "change_high", n=5)


@query("h14_water_index", """
    WITH z AS (SELECT m.scenario, m.cell_id, m.member, m.year, m.month, CASE WHEN m.model = 'R' THEN 25 + (m.value - s.median) / s.iqr * 8 ELSE m.value END AS value, CASE WHEN year BETWEEN 1995 AND 1995 THEN 1990 WHEN year BETWEEN 1996 AND 2001 THEN 1996 END AS decade
      FROM monthly m JOIN modelstats s ON s.model = m.model),
    mm AS (SELECT scenario, cell_id, decade, month, avg(value) AS v FROM z WHERE decade IS NOT NULL GROUP BY 1, 2, 3, 4), ma AS (SELECT scenario, cell_id, decade, member, year, avg(value) AS v FROM z WHERE decade IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
    q AS (SELECT scenario, cell_id, decade, quantile_cont(v, [0.05, 0.15, 0.25, 0.5, 0.75, 0.85, 0.95]) AS q FROM ma GROUP BY 1, 2, 3)
    SELECT scenario, cell_id, decade, month - 1 AS value_type, round(v, 9) AS value FROM mm UNION ALL SELECT scenario, cell_id, decade, 12, round(avg(v), 9) FROM mm GROUP BY 1, 2, 3
    UNION ALL SELECT scenario, cell_id, decade, i + 12, round(q[i], 9) FROM q, (VALUES (1), (2), (3), (4), (5), (6), (7)) i(i)""")
def h14(spark, sf):
    return rounded(hazards.water_index(table(spark, sf, "monthly"), {1990: (1995, 1995), 1996: (1996, 2001)}, (1996, 2001), 25.0, 8.0, ["R"]), "value", n=9)


@query("h15_compare_indices", """
    WITH p AS (SELECT a.month AS value_type, a.year AS decade, a.v AS o, b.v AS n FROM (SELECT cell_id, year, month, round(avg(value), 9) AS v FROM monthly WHERE scenario = 'ssp126' GROUP BY 1, 2, 3) a JOIN (SELECT cell_id, year, month, round(avg(value), 9) AS v FROM monthly WHERE scenario = 'ssp585' GROUP BY 1, 2, 3) b USING (cell_id, year, month)),
    r AS (SELECT *, rank() OVER (PARTITION BY value_type, decade ORDER BY o) + (count(*) OVER (PARTITION BY value_type, decade, o) - 1) / 2e0 AS ra, rank() OVER (PARTITION BY value_type, decade ORDER BY n) + (count(*) OVER (PARTITION BY value_type, decade, n) - 1) / 2e0 AS rb FROM p)
    SELECT 'ssp126' AS old_scenario, 'ssp585' AS new_scenario, value_type, decade, CASE WHEN count(*) > 1 THEN round(corr(o, n), 6) END AS pearson_r, round(sqrt(avg(pow(n - o, 2))), 6) AS rmsd, round(avg(n - o), 6) AS bias, count(*) AS n_valid, CASE WHEN count(*) > 1 THEN round(corr(ra, rb), 6) END AS spearman_r FROM r GROUP BY value_type, decade""")
def h15(spark, sf):
    from cellcast.operators.delivery import paired_layers

    m = table(spark, sf, "monthly").groupBy("scenario", "cell_id", F.col("year").alias("decade"), F.col("month").alias("value_type")).agg(F.round(F.avg("value"), 9).alias("value"))
    names = spark.createDataFrame([("ssp126", "ssp585")], "old_scenario STRING, new_scenario STRING")
    pairs = paired_layers(m, m, names)
    return rounded(hazards.compare_indices(pairs), "pearson_r", "rmsd", "bias", "spearman_r")


@query("h16_split_half_smoothing", """
    WITH c AS (SELECT d.grow, d.gcol, 6371.0088e0 * 6371.0088e0 * radians(5e-1) * (sin(radians(25 + (d.grow + 0.5) * 0.5 + 0.25)) - sin(radians(25 + (d.grow + 0.5) * 0.5 - 0.25))) / 1e4 AS area,
               count(CASE WHEN t.year % 2 = 1 THEN 1 END) AS odd, count(CASE WHEN t.year % 2 = 0 THEN 1 END) AS even
        FROM box40 d LEFT JOIN crossings t ON t.grow = d.grow AND t.gcol = d.gcol GROUP BY 1, 2, 3),
    tr AS (SELECT grow, gcol, 1 AS p, odd AS k, area * 4 AS t, even AS ko, area * 3 AS ot FROM c UNION ALL SELECT grow, gcol, 0, even, area * 3, odd, area * 4 FROM c),
    fl AS (SELECT avg(k / t) / 1000 AS f FROM tr WHERE p = 1),
    w AS (SELECT s.sigma, a.p, a.grow, a.gcol, a.ko, a.ot, b.k, b.t, CASE WHEN s.sigma = 0 THEN 1e0 ELSE exp(-(pow(a.grow - b.grow, 2) + pow(a.gcol - b.gcol, 2)) / (2 * s.sigma * s.sigma)) END AS w
          FROM (VALUES (0e0), (7e-1), (15e-1)) s(sigma), tr a, tr b WHERE a.p = b.p AND abs(a.grow - b.grow) <= floor(4 * s.sigma + 0.5) AND abs(a.gcol - b.gcol) <= floor(4 * s.sigma + 0.5)),
    sm AS (SELECT sigma, p, grow, gcol, ko, ot, sum(w * k) / sum(w) AS k, sum(w * t) / sum(w) AS t, sum(w * (k / t)) / sum(w) AS rate FROM w GROUP BY ALL),
    sc AS (SELECT sigma, count(*) AS n_cells, avg(lgamma(ko + k + 0.5) - lgamma(k + 0.5) - lgamma(ko + 1) + (k + 0.5) * ln(t / (t + ot)) + ko * ln(1 - t / (t + ot))) AS nb,
                  avg(ko * ln(greatest(rate, f) * ot) - greatest(rate, f) * ot) AS po FROM sm, fl GROUP BY 1)
    SELECT sigma, n_cells, round(nb, 6) AS nb_loglik, round(po, 6) AS poisson_loglik, sigma = (SELECT sigma FROM sc ORDER BY nb DESC, sigma LIMIT 1) AS best FROM sc""")
def h16(spark, sf):
    from cellcast.operators.grids import track_cells

    hits = track_cells(table(spark, sf, "tracks"), 0.5, 25.0, -105.0, 40, 60)
    area = cell_area_km2(25.0 + (F.col("grow") + 0.5) * 0.5, 0.5) / 1e4
    out = hazards.split_half_smoothing(hits, domain_cells(spark, sf), area, [0.0, 0.7, 1.5], (1995, 2001))
    return rounded(out, "nb_loglik", "poisson_loglik")


SQL["ensemble"] = "SELECT scenario, cell_id, member, avg(value) AS value FROM annual WHERE year >= 1999 GROUP BY 1, 2, 3"
SQL["loo"] = """
    SELECT a.scenario, a.cell_id, a.member, max(a.value) AS value, max(a.value) - quantile_cont(b.value, 0.5) AS deviation FROM ensemble a JOIN ensemble b ON a.scenario = b.scenario AND a.cell_id = b.cell_id AND a.member <> b.member
    WHERE (SELECT count(*) FROM ensemble c WHERE c.scenario = a.scenario AND c.cell_id = a.cell_id) = (SELECT count(DISTINCT member) FROM ensemble) GROUP BY 1, 2, 3"""


def _ensemble(spark, sf):
    return table(spark, sf, "ensemble")


@query("h17_leave_one_out", "SELECT scenario, cell_id, member, round(value, 6) AS value, round(deviation, 6) AS deviation FROM loo")
def h17(spark, sf):
    return rounded(hazards.leave_one_out(_ensemble(spark, sf)), "value", "deviation")


@query("h17_member_deviation_summary", """
    SELECT scenario, member, round(100 * avg(CASE WHEN abs(deviation) > 0.47 THEN 1e0 ELSE 0e0 END), 6) AS pct_over_0_47, round(100 * avg(CASE WHEN abs(deviation) > 1.03 THEN 1e0 ELSE 0e0 END), 6) AS pct_over_1_03,
           round(100 * avg(CASE WHEN abs(deviation) > 2.07 THEN 1e0 ELSE 0e0 END), 6) AS pct_over_2_07, round(quantile_cont(deviation, 0.5), 6) AS median_deviation FROM loo GROUP BY 1, 2""")
def h17_summary(spark, sf):
    out = hazards.member_deviation_summary(hazards.leave_one_out(_ensemble(spark, sf)), [0.47, 1.03, 2.07])
    return rounded(out, "pct_over_0_47", "pct_over_1_03", "pct_over_2_07", "median_deviation")


@query("h18_extraction_sensitivity", """
    WITH mv AS (SELECT * FROM (VALUES (0, 0e0, 0e0), (1, 25e-2, 0e0), (2, -25e-2, 0e0), (3, 0e0, 25e-2), (4, 0e0, -25e-2)) m(move, dlat, dlon)),
    p AS (SELECT site_id, move, lat + dlat AS la, CASE WHEN lon + dlon > 180 THEN lon + dlon - 360 WHEN lon + dlon < -180 THEN lon + dlon + 360 ELSE lon + dlon END AS lo FROM sites, mv),
    v AS (SELECT p.site_id, p.move, sum(w.value * exp(-0.5 * (pow(w.lat - la, 2) + pow(least(abs(w.lon - lo), 360 - abs(w.lon - lo)), 2)) / 625e-4)) / sum(exp(-0.5 * (pow(w.lat - la, 2) + pow(least(abs(w.lon - lo), 360 - abs(w.lon - lo)), 2)) / 625e-4)) AS v
      FROM p JOIN surface w ON abs(w.lat - la) <= 0.5 AND least(abs(w.lon - lo), 360 - abs(w.lon - lo)) <= 0.5 GROUP BY 1, 2),
    s AS (SELECT a.site_id, a.v AS base, b.move, abs(b.v - a.v) / abs(a.v) * 100 AS pct FROM v a JOIN v b ON a.site_id = b.site_id AND a.move = 0 AND b.move > 0), k AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY pct DESC, move) AS rn FROM s)
    SELECT site_id, round(base, 6) AS base, round(pct, 5) AS worst_pct FROM k WHERE rn = 1""")
def h18(spark, sf):
    out = hazards.extraction_sensitivity(table(spark, sf, "sites"), table(spark, sf, "surface"), "value")
    return rounded(rounded(out, "base"), "worst_pct", n=5).drop("move")


@query("h18_blend_counts", """
    WITH r AS (SELECT site_id, count(*) AS n FROM sites JOIN (SELECT unnest(range(0, 360)) AS g) a ON abs(89.75e0 - 5e-1 * g - lat) <= 5e-1 GROUP BY 1),
    c AS (SELECT site_id, count(*) AS n FROM sites JOIN (SELECT unnest(range(0, 720)) AS g) b ON least(abs(-179.75e0 + 5e-1 * g - lon), 360 - abs(-179.75e0 + 5e-1 * g - lon)) <= 5e-1 GROUP BY 1)
    SELECT r.n * c.n AS n_cells, count(*) AS n_sites FROM r JOIN c ON r.site_id = c.site_id GROUP BY 1""")
def h18_blend(spark, sf):
    return hazards.blend_counts(table(spark, sf, "sites"))


def _peaks(spark, sf):
    """Yearly maximum per customer segment and nation of order prices, early and late."""
    o = base(spark, sf, "orders").join(base(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    yearly = o.groupBy(F.col("c_nationkey").alias("cell_id"), F.date_trunc("month", "o_orderdate").alias("period")).agg(F.max("o_totalprice").alias("value"))
    early = F.year("period") <= 1997
    return yearly.where(early), yearly.where(~early)


# L-moments of both periods and what they make of a Pearson III distribution
SQL["pearson"] = """
    SELECT cell_id, late, l1 AS m, l2 * sqrt(pi() * shape) * exp(lgamma(shape) - lgamma(shape + 0.5)) AS s, sign(t3) AS sgn, shape AS a FROM (
        SELECT *, CASE WHEN abs(t3) <= 1 / 3e0 THEN (1 + 0.2906 * z) / (z + 0.1882 * z * z + 0.0442 * z * z * z)
                       ELSE (0.36067 * y - 0.59567 * y * y + 0.25361 * y * y * y) / (1 - 2.78861 * y + 2.56096 * y * y - 0.77045 * y * y * y) END AS shape FROM (
            SELECT cell_id, late, b0 AS l1, 2 * b1 - b0 AS l2, (6 * b2 - 6 * b1 + b0) / (2 * b1 - b0) AS t3, 3 * pi() * pow((6 * b2 - 6 * b1 + b0) / (2 * b1 - b0), 2) AS z, 1 - abs((6 * b2 - 6 * b1 + b0) / (2 * b1 - b0)) AS y FROM (
                SELECT cell_id, late, avg(v) AS b0, sum(v * i) / max(n * (n - 1)) AS b1, sum(v * i * (i - 1)) / max(n * (n - 1) * (n - 2)) AS b2 FROM (
                    SELECT cell_id, late, v, row_number() OVER (PARTITION BY cell_id, late ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY cell_id, late) AS n FROM (
                        SELECT c_nationkey AS cell_id, date_trunc('month', o_orderdate) AS period, year(o_orderdate) > 1997 AS late, max(o_totalprice) AS v FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2, 3) p1) p2
                GROUP BY 1, 2) p3) p4) p5"""


@query("h19_flood_frequency_shift", f"""
    WITH RECURSIVE {gamma_quantiles_sql("SELECT DISTINCT a FROM pearson WHERE NOT late", "(0.05), (0.95)", 20_000)},
    v AS (SELECT h.cell_id, h.m + h.s * h.sgn * (g.x - h.a) / sqrt(h.a) AS volume FROM pearson h JOIN gammaquant g ON g.a = h.a AND g.q = CASE WHEN h.sgn > 0 THEN 0.95 ELSE 0.05 END WHERE NOT late),
    z AS (SELECT f.cell_id, f.sgn, f.a, greatest(f.a + (v.volume - f.m) / f.s * sqrt(f.a) * f.sgn, 1e-300) AS x FROM pearson f JOIN v ON v.cell_id = f.cell_id WHERE late)
    SELECT cell_id, round(1 / greatest(CASE WHEN sgn > 0 THEN 1 - {gamma_below_sql("a", "x", 20_000)} ELSE {gamma_below_sql("a", "x", 20_000)} END, 1e-4), 4) AS new_period FROM z""")
def h19(spark, sf):
    """Periods beyond 10,000 are shown as that."""
    h, f = _peaks(spark, sf)
    shift = models.flood_frequency_shift(h, f, ["cell_id"], 20.0)
    return rounded(shift.withColumn("new_period", F.least("new_period", F.lit(1e4))), "new_period", n=4)


@query("h19_l_moments", """
    WITH y AS (SELECT c_nationkey AS cell_id, date_trunc('month', o_orderdate) AS period, max(o_totalprice) AS v FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE year(o_orderdate) <= 1997 GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY cell_id) AS n FROM y),
    b AS (SELECT cell_id, n, avg(v) AS b0, sum(v * i) / (n * (n - 1)) AS b1, sum(v * i * (i - 1)) / (n * (n - 1) * (n - 2)) AS b2 FROM r GROUP BY 1, 2)
    SELECT cell_id, n, round(b0, 4) AS l1, round(2 * b1 - b0, 4) AS l2, round((6 * b2 - 6 * b1 + b0) / (2 * b1 - b0), 6) AS t3 FROM b""")
def h19_moments(spark, sf):
    h, _ = _peaks(spark, sf)
    return rounded(rounded(models.l_moments(h, ["cell_id"]), "l1", "l2", n=4), "t3").select("cell_id", "n", "l1", "l2", "t3")


def _prices(spark, sf):
    """Daily mean order price per nation with lagged features and the 5-day-ahead change."""
    from cellcast.operators.daily import lagged_feature, linear_fill

    o = base(spark, sf, "orders").join(base(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    seen = o.groupBy(F.col("c_nationkey").alias("cell_id"), F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("value"))
    span = seen.agg(F.sequence(F.min("day"), F.max("day"))).scalar()
    every = seen.select("cell_id").distinct().withColumn("day", F.explode(span))
    filled = linear_fill(every.join(seen, ["cell_id", "day"], "left"), ["cell_id"])
    return lagged_feature(filled, 5, ["cell_id"]).withColumn("month", F.month("day").cast("double"))


@query("h20_price_features", """
    WITH o AS (SELECT c_nationkey AS cell_id, CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS value FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2),
    d AS (SELECT k.cell_id, s.day, o.value FROM (SELECT DISTINCT cell_id FROM o) k CROSS JOIN (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM o) s LEFT JOIN o ON o.cell_id = k.cell_id AND o.day = s.day),
    k AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER a AS da, last_value(value IGNORE NULLS) OVER a AS va,
                 first_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER b AS db, first_value(value IGNORE NULLS) OVER b AS vb FROM d
          WINDOW a AS (PARTITION BY cell_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY cell_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    f AS (SELECT cell_id, day, coalesce(value, va + (vb - va) / (db - da) * (day - da)) AS value FROM k),
    w AS (SELECT *, value - lag(value, 5) OVER o AS lag_difference, (lead(value, 5) OVER o - value) / nullif(value, 0) AS ahead_change FROM f WINDOW o AS (PARTITION BY cell_id ORDER BY day))
    SELECT cell_id, day, round(value + 1.234567e-5, 4) AS value, round(lag_difference + 1.234567e-5, 4) AS lag_difference, round(ahead_change, 9) AS ahead_change, CAST(month(day) AS DOUBLE) AS month, year(day) <= 1999 AS train, year(day) >= 2000 AS holdout FROM w""")
def h20_features(spark, sf):
    """What the price model learns from and is held against."""
    # means of cents often end in a tie; a shift keeps them off the rounding's edge
    off = {c: F.col(c) + 1.234567e-5 for c in ("value", "lag_difference")}
    p = _prices(spark, sf).withColumns(off).select("cell_id", "day", "value", "lag_difference", "ahead_change", "month", (F.year("day") <= 1999).alias("train"), (F.year("day") >= 2000).alias("holdout"))
    return rounded(rounded(p, "value", "lag_difference", n=4), "ahead_change", n=9)


@query("h20_price_model")
def h20(spark, sf):
    p = _prices(spark, sf)
    return models.price_model(
        p, ["lag_difference", "value", "month"], "ahead_change", F.year("day") <= 1999, F.year("day") >= 2000, trees=5, folds=2
    ).select("n_holdout", F.round("holdout_r2", 4).alias("holdout_r2"))


SQL["monthprice"] = """
    SELECT cell_id, month, value, value - lag(value, 1) OVER (PARTITION BY cell_id ORDER BY month) AS x1, value - lag(value, 3) OVER (PARTITION BY cell_id ORDER BY month) AS x3, value - lag(value, 6) OVER (PARTITION BY cell_id ORDER BY month) AS x6,
           lead(value, 2) OVER (PARTITION BY cell_id ORDER BY month) - value AS ahead
    FROM (SELECT c_nationkey AS cell_id, date_trunc('month', o_orderdate) AS month, floor(avg(o_totalprice) / 500) AS value FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2) m"""


@query("t4_lag_scores", """
    WITH l AS (SELECT cell_id, lag, x, ahead AS y FROM (SELECT cell_id, month, 1 AS lag, x1 AS x, ahead FROM monthprice UNION ALL SELECT cell_id, month, 3, x3, ahead FROM monthprice UNION ALL SELECT cell_id, month, 6, x6, ahead FROM monthprice) u
               WHERE x IS NOT NULL AND ahead IS NOT NULL),
    i AS (SELECT *, row_number() OVER (PARTITION BY cell_id, lag ORDER BY x, y) AS k FROM l),
    s AS (SELECT a.cell_id, a.lag, sum(sign(b.x - a.x) * sign(b.y - a.y)) AS s FROM i a JOIN i b ON a.cell_id = b.cell_id AND a.lag = b.lag AND a.k < b.k GROUP BY 1, 2),
    tx AS (SELECT cell_id, lag, sum(t * (t - 1) / 2) AS p, sum(t * (t - 1) * (2 * t + 5)) AS v, sum(t * (t - 1) * (t - 2)) AS w FROM (SELECT cell_id, lag, x, CAST(count(*) AS DOUBLE) AS t FROM l GROUP BY 1, 2, 3) q GROUP BY 1, 2),
    ty AS (SELECT cell_id, lag, sum(t * (t - 1) / 2) AS p, sum(t * (t - 1) * (2 * t + 5)) AS v, sum(t * (t - 1) * (t - 2)) AS w FROM (SELECT cell_id, lag, y, CAST(count(*) AS DOUBLE) AS t FROM l GROUP BY 1, 2, 3) q GROUP BY 1, 2),
    n AS (SELECT cell_id, lag, CAST(count(*) AS DOUBLE) AS n FROM l GROUP BY 1, 2)
    SELECT n.cell_id, n.lag, CAST(n.n AS BIGINT) AS n, CAST(s.s AS DOUBLE) AS s,
           round(s.s / sqrt((n.n * (n.n - 1) * (2 * n.n + 5) - tx.v - ty.v) / 18 + 2 * tx.p * ty.p / (n.n * (n.n - 1)) + tx.w * ty.w / (9 * n.n * (n.n - 1) * (n.n - 2))), 6) AS z
    FROM n JOIN s USING (cell_id, lag) JOIN tx USING (cell_id, lag) JOIN ty USING (cell_id, lag)""")
def t4_scores(spark, sf):
    m = table(spark, sf, "monthprice").select("cell_id", "month", "value", "ahead")
    return rounded(models.lag_scores(m, ["cell_id"], "month", "value", "ahead", [1, 3, 6]).drop("p"), "z")


@query("t4_best_lag")
def t4(spark, sf):
    p = _prices(spark, sf)
    return rounded(models.best_lag(p, ["cell_id"], "day", "value", "ahead_change", [1, 3, 7, 14]), "p_value")
