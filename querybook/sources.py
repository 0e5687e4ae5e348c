"""Sources, sinks and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellcast.functions import scalar
from cellcast.operators import filters
from cellcast.session import scratch_folder
from cellcast.sources import missing, naming, readers, sinks
from querybook.common import rounded
from querybook.layers import LAYER_FLOATS, LAYER_ROUNDED, built_layer
from querybook.portfolio import scores
from querybook.registry import query
from querybook.standins import SQL, base, table


@query("s1_read_annual", """
    SELECT cell_id, scenario, count(*) AS n, round(sum(value), 6) AS total FROM annual WHERE year BETWEEN 1996 AND 1999 GROUP BY 1, 2""")
def s1(spark, sf):
    folder = scratch_folder(spark, "annual")
    table(spark, sf, "annual").write.parquet(folder)
    a = readers.read_annual(spark, folder, 1996, 1999)
    return a.groupBy("cell_id", "scenario").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query("s2_normalize_missing", """
    SELECT l_linenumber AS k, count(CASE WHEN l_quantity NOT IN (1, 2, 3, 4, 5) THEN 1 END) AS n_kept,
           sum(CASE WHEN l_quantity NOT IN (1, 2, 3, 4, 5) THEN l_quantity END) AS total FROM {lineitem} GROUP BY 1""")
def s2(spark, sf):
    q = F.col("l_quantity")
    dirty = (
        F.when(q == 1, float("nan")).when(q == 2, float("inf")).when(q == 3, 1e20).when(q == 4, -1.0)
        .when(q == 5, 9.9692099e15 * (1 + 1e-8)).otherwise(q)
    )
    raw = base(spark, sf, "lineitem").select(F.col("l_linenumber").alias("k"), dirty.alias("v"))
    clean = missing.normalize_missing(raw, "v", fill=9.9692099e15, sentinel=-1.0)
    return clean.groupBy("k").agg(F.count("v").alias("n_kept"), F.sum("v").alias("total"))


@query("s3_parse_member_name", """
    SELECT path, p[len(p) - 10] AS model, p[len(p) - 9] AS gcm, p[len(p) - 7] AS scenario, p[len(p) - 6] AS soc, p[len(p) - 5] AS sens,
           p[len(p) - 4] AS variable, p[len(p) - 2] AS cadence, CAST(p[len(p) - 1] AS INT) AS y0, CAST(p[len(p)] AS INT) AS y1, n_bytes
    FROM (SELECT path, n_bytes, string_split(replace(path, '.nc', ''), '_') AS p FROM files) t""")
def s3(spark, sf):
    return naming.parse_member_name(table(spark, sf, "files"), variable="yield")


@query("s4_decode_cf_year", """
    SELECT l_linenumber AS k, l_quantity AS q, CAST(round(1850 + l_quantity) AS INT) AS by_year,
           CAST(floor(1850 + (0 + l_quantity * 12) / 12) AS INT) AS by_month,
           CAST(year(DATE '1850-01-01' + CAST(floor(l_quantity * 365.25e0) AS INT)) AS INT) AS by_date,
           CAST(floor(1850 + (0 * 360e0 / 12 + 1 - 1 + l_quantity * 361) / 360e0) AS INT) AS by_360, count(*) AS n
    FROM {lineitem} GROUP BY 1, 2, 3, 4, 5, 6""")
def s4(spark, sf):
    q = F.col("l_quantity")
    year = lambda off, units, cal: naming.decode_cf_year(off, F.lit(units), F.lit(cal))
    return (
        base(spark, sf, "lineitem")
        .groupBy(F.col("l_linenumber").alias("k"), q.alias("q"))
        .agg(F.count("*").alias("n"))
        .withColumns(
            {
                "by_year": year(F.col("q"), "years since 1850-01-01", "standard"),
                "by_month": year(F.col("q") * 12, "months since 1850-01-01", "standard"),
                "by_date": year(F.col("q") * 365.25, "days since 1850-01-01", "proleptic_gregorian"),
                "by_360": year(F.col("q") * 361, "days since 1850-01-01", "360_day"),
            }
        )
    )


@query("s5_assert_contiguous_years", """
    WITH k AS (SELECT l_partkey, CAST(year(l_shipdate) AS INT) AS year, count(*) AS n FROM {lineitem} GROUP BY 1, 2),
    g AS (SELECT *, lag(year) OVER (PARTITION BY l_partkey ORDER BY year) AS before FROM k)
    SELECT l_partkey, year, CASE WHEN n > 20 THEN 'crowded' WHEN year - before > 1 THEN 'gap' END AS problem FROM g
    WHERE n > 20 OR year - before > 1
    UNION ALL SELECT p.l_partkey, y.year, 'absent' FROM (SELECT DISTINCT l_partkey FROM {lineitem}) p,
      (SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS year FROM {lineitem}) y
      WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.l_partkey = p.l_partkey AND k.year = y.year)""")
def s5(spark, sf):
    li = base(spark, sf, "lineitem").select("l_partkey", F.year("l_shipdate").alias("year"))
    years = li.groupBy("l_partkey", "year").agg(F.count("*").alias("n"))
    # one row per year, or two where the year is crowded, so that duplicates are seen too
    rows = years.withColumn("i", F.explode(F.when(F.col("n") > 20, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    found = naming.year_axis_gaps(rows, ["l_partkey"]).replace("duplicate", "crowded", "problem")
    span = li.agg(F.min("year").alias("y0"), F.max("year").alias("y1"))
    names = li.select("l_partkey").distinct().withColumns(
        {"y0": span.select("y0").scalar(), "y1": span.select("y1").scalar()}
    )
    absent = naming.span_mismatches(years, names, ["l_partkey"]).withColumn("problem", F.lit("absent"))
    return found.unionByName(absent)


@query("s6_read_customer_input", """
    SELECT c_name AS Location, CAST(lat AS VARCHAR) AS Lat, asset_type AS Asset_Type, country AS Country, CAST(NULL AS VARCHAR) AS Layers
    FROM sites JOIN {customer} ON site_id = c_custkey""")
def s6(spark, sf):
    folder = scratch_folder(spark, "sites") + ".csv"
    s = table(spark, sf, "sites").join(base(spark, sf, "customer"), F.col("site_id") == F.col("c_custkey"))
    s.select(F.col("c_name").alias(" Location "), F.col("lat").alias("Lat"), F.col("lon").alias("Lon "),
             F.col("asset_type").alias("Asset_Type"), F.col("country").alias("Country")).write.csv(folder, header=True)
    return readers.read_customer_input(spark, folder).select("Location", "Lat", "Asset_Type", "Country", "Layers")


@query("s7_read_source_grid", "SELECT cell_id, round(gappy, 6) AS hail FROM surface")
def s7(spark, sf):
    folder = scratch_folder(spark, "hail")
    s = table(spark, sf, "surface")
    s.select("lat", "lon", F.col("gappy").alias("hail")).write.csv(folder, header=True, emptyValue="")
    return rounded(readers.read_source_grid(spark, folder, "hail", table(spark, sf, "grid")), "hail").select("cell_id", "hail")


@query("s8_read_point_events", """
    SELECT event_id, year, mag FROM tracks WHERE year BETWEEN 1996 AND 1999 AND slat BETWEEN 31 AND 37 AND slon BETWEEN -99 AND -94""")
def s8(spark, sf):
    folder = scratch_folder(spark, "tracks")
    t = table(spark, sf, "tracks").select("event_id", "year", "mag", "slat", "slon", "elat", "elon")
    t.write.csv(folder, header=True)
    schema = "event_id BIGINT, year INT, mag INT, slat DOUBLE, slon DOUBLE, elat DOUBLE, elon DOUBLE"
    return readers.read_point_events(spark, folder, schema, (1996, 1999), (31, 37, -99, -94)).select("event_id", "year", "mag")


@query("s9_read_config", """
    WITH e AS (SELECT DISTINCT p_brand AS entry, lower(p_type) AS alias FROM {part} UNION SELECT DISTINCT p_brand, lower(p_brand) FROM {part})
    SELECT alias, count(DISTINCT entry) AS n_entries FROM e GROUP BY 1 HAVING count(DISTINCT entry) > 1""")
def s9(spark, sf):
    catalog = base(spark, sf, "part").groupBy(F.col("p_brand").alias("entry")).agg(
        F.collect_set("p_type").alias("aliases"),
        F.create_map(F.lit("heat"), F.lit(1), F.lit("water"), F.lit(0)).alias("weights"),
    )
    return readers.alias_collisions(readers.flatten_catalog(catalog))


@query("s10_list_scenarios", "SELECT DISTINCT model AS layer, scenario FROM annual WHERE year BETWEEN 1995 AND 2001")
def s10(spark, sf):
    a = table(spark, sf, "annual").withColumn("layer", F.col("model"))
    control = a.withColumn("scenario", F.lit("historical"))
    folder = scratch_folder(spark, "store")
    a.unionByName(control).write.partitionBy("layer", "scenario").parquet(folder)
    return readers.list_scenarios(spark.read.parquet(folder))


@query("s11_write_panel", f"""
    SELECT 'yield' AS layer, {LAYER_ROUNDED}, n_members, n_models FROM built_layer
    UNION ALL SELECT 'late', {LAYER_ROUNDED}, n_members, n_models FROM built_layer WHERE decade >= 1999""")
def s11(spark, sf):
    folder = scratch_folder(spark, "layer")
    made = built_layer(spark, sf).withColumn("layer", F.explode(F.when(F.col("decade") >= 1999, F.array(F.lit("yield"), F.lit("late"))).otherwise(F.array(F.lit("yield")))))
    sinks.write_panel(made, folder, {"units": "t", "window_years": "2"})
    return rounded(spark.read.parquet(f"{folder}/panel"), *LAYER_FLOATS)


SQL["status_values"] = """
    SELECT *, CASE WHEN value IS NULL THEN 'OFF_LAYER_MASK' ELSE 'OK' END AS data_status FROM layer_values"""


def status_values(spark, sf):
    v = table(spark, sf, "layer_values")
    return v.withColumn("data_status", F.when(F.col("value").isNull(), "OFF_LAYER_MASK").otherwise("OK"))


@query("s13_write_star_schema", """
    SELECT asset_id, layer_id, scenario, decade, round(percentile, 6) AS percentile, n_members FROM layer_values""")
def s13(spark, sf):
    folder = scratch_folder(spark, "delivery")
    a = table(spark, sf, "assets").withColumn("layer_ids", scalar.split_list("layer_ids"))
    sinks.write_star_schema({"assets": a, "values": table(spark, sf, "layer_values")}, folder, "csv")
    schema = "asset_id BIGINT, layer_id STRING, scenario STRING, decade INT, value DOUBLE, lower_ci DOUBLE, upper_ci DOUBLE, percentile DOUBLE, ols_slope DOUBLE, sen_slope DOUBLE, n_members BIGINT, n_models BIGINT"
    back = spark.read.csv(f"{folder}/values", header=True, schema=schema)
    return rounded(back, "percentile").select("asset_id", "layer_id", "scenario", "decade", "percentile", "n_members")


@query("s14_provenance")
def s14(spark, sf):
    return sinks.provenance(spark, f"{sf}/*.parquet").drop("modificationTime")


@query("s15_manifest", """
    SELECT 'values' AS table_name, data_status AS item, count(*) AS n FROM status_values GROUP BY 2
    UNION ALL SELECT 'climate_score', CASE WHEN n_hazards >= n_hazards_expected THEN 'complete' ELSE 'incomplete' END, count(*) FROM scores GROUP BY 2""")
def s15(spark, sf):
    v = status_values(spark, sf)
    return sinks.manifest(v, scores(spark, sf))


@query("s16_payload_json", """
    WITH one AS (SELECT location_id, layer_id, scenario, decade, arg_min(v.percentile, v.asset_id) AS p
                 FROM (SELECT * FROM layer_values WHERE percentile IS NOT NULL) v JOIN assets a ON v.asset_id = a.asset_id GROUP BY 1, 2, 3, 4),
    r AS (SELECT *, CASE WHEN p = 0 THEN 0 ELSE round_even(p * pow(10e0, 3 - floor(log10(abs(p)))), 0) / pow(10e0, 3 - floor(log10(abs(p)))) END AS s FROM one)
    SELECT location_id, layer_id, scenario, count(*) AS n_points, round(sum(s), 3) AS total FROM r GROUP BY 1, 2, 3""")
def s16(spark, sf):
    v = table(spark, sf, "layer_values").where("percentile IS NOT NULL")
    text = sinks.payload_json(v, table(spark, sf, "assets"), ["percentile"])
    points = F.from_json("series", "ARRAY<STRUCT<decade: INT, percentile: DOUBLE>>")
    parsed = text.withColumn("p", points)
    return parsed.select(
        "location_id", "layer_id", "scenario", F.size("p").cast("long").alias("n_points"),
        F.round(F.aggregate("p", F.lit(0.0), lambda a, x: a + x["percentile"]), 3).alias("total"),
    )


CODES = {0: "median", 1: "lower_ci", 2: "upper_ci"}


@query("s17_coded_to_wide", """
    SELECT scenario, cell_id, decade, round(median, 6) AS median, round(lower_ci, 6) AS lower_ci, round(upper_ci, 6) AS upper_ci FROM panel""")
def s17(spark, sf):
    from querybook.layers import annual_panel

    panel, _ = annual_panel(spark, sf)
    coded = sinks.wide_to_coded(panel, CODES, ["scenario", "cell_id"])
    return rounded(sinks.coded_to_wide(coded, CODES, ["scenario", "cell_id"]), "median", "lower_ci", "upper_ci")


@query("p19_prefer_variant", """
    WITH p AS (SELECT path, split_part(path, '_', 1) AS model, split_part(path, '_', 2) AS gcm, split_part(path, '_', 4) AS scenario, split_part(path, '_', 5) AS soc FROM files),
    o AS (SELECT *, CASE soc WHEN '2015soc-from-histsoc' THEN 1 WHEN '2015soc' THEN 2 ELSE 3 END AS k FROM p)
    SELECT path, soc FROM o WHERE k = (SELECT min(k) FROM o i WHERE i.model = o.model AND i.gcm = o.gcm AND i.scenario = o.scenario)""")
def p19(spark, sf):
    f = naming.parse_member_name(table(spark, sf, "files"))
    return filters.prefer_variant(f, ["2015soc-from-histsoc", "2015soc"]).select("path", "soc")


@query("p20_common_variant", """
    WITH p AS (SELECT DISTINCT model, gcm, scenario AS level, CASE WHEN d > 0.035 AND scenario <> 'ssp126' THEN 'a' ELSE 'b' END AS soc FROM (
        SELECT l_returnflag AS model, CAST(l_orderkey AS VARCHAR) AS gcm, CASE l_linenumber % 3 WHEN 0 THEN 'ssp126' WHEN 1 THEN 'ssp370' ELSE 'ssp585' END AS scenario, l_discount AS d FROM {lineitem}) t),
    lv AS (SELECT model, gcm, count(DISTINCT level) AS n FROM p GROUP BY 1, 2),
    sp AS (SELECT model, gcm, soc, count(DISTINCT level) AS n FROM p GROUP BY 1, 2, 3),
    sh AS (SELECT s.model, s.gcm, min(s.soc) AS soc FROM sp s JOIN lv ON s.model = lv.model AND s.gcm = lv.gcm AND s.n = lv.n GROUP BY 1, 2),
    b AS (SELECT model, gcm, level, min(soc) AS soc FROM p GROUP BY 1, 2, 3)
    SELECT b.model, b.gcm, b.level, coalesce(sh.soc, b.soc) AS soc, sh.soc IS NOT NULL AS shared FROM b LEFT JOIN sh ON b.model = sh.model AND b.gcm = sh.gcm""")
def p20(spark, sf):
    li = base(spark, sf, "lineitem")
    scen = F.when(F.col("l_linenumber") % 3 == 0, "ssp126").when(F.col("l_linenumber") % 3 == 1, "ssp370").otherwise("ssp585")
    f = li.select(F.col("l_returnflag").alias("model"), F.col("l_orderkey").cast("string").alias("gcm"), scen.alias("level"), "l_discount")
    f = f.withColumn("soc", F.when((F.col("l_discount") > 0.035) & (F.col("level") != "ssp126"), "a").otherwise("b"))
    return filters.common_variant(f, "level", ["a", "b"])


# Scalar functions ---------------------------------------------------------------------------


@query("f1_normalize_lon", """
    SELECT site_id, round(CASE WHEN rawlon < -180 THEN rawlon + 360 WHEN rawlon > 180 THEN rawlon - 360 ELSE rawlon END, 6) AS strict,
           round(((rawlon + 720 + 180) % 360) - 180, 6) AS modulo FROM sites""")
def f1(spark, sf):
    return table(spark, sf, "sites").select(
        "site_id", F.round(scalar.normalize_lon("rawlon"), 6).alias("strict"),
        F.round(scalar.wrap_lon(F.col("rawlon") + 720), 6).alias("modulo"),
    )


HAVERSINE = """2 * 6371.0088e0 * asin(sqrt(greatest(0, least(1, pow(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b}))
    * pow(sin(radians(((({d} - {c}) + 540) % 360) - 180) / 2), 2)))))"""


@query("f2_haversine_km", "SELECT site_id, round(" + HAVERSINE.format(a="lat", b="55e0", c="lon", d="-1795e-1") + ", 5) AS km FROM sites")
def f2(spark, sf):
    km = scalar.haversine_km("lat", "lon", F.lit(55.0), F.lit(-179.5))
    return table(spark, sf, "sites").select("site_id", F.round(km, 5).alias("km"))


@query("f3_cell_area_km2", """
    SELECT cell_id, round(6371.0088e0 * 6371.0088e0 * radians(5e-1) * (sin(radians(lat + 25e-2)) - sin(radians(lat - 25e-2))), 4) AS spherical,
           round(radians(5e-1) * 6371.0088e0 * radians(5e-1) * 6371.0088e0 * cos(radians(lat)), 4) AS planar FROM grid""")
def f3(spark, sf):
    return table(spark, sf, "grid").select(
        "cell_id", F.round(scalar.cell_area_km2("lat"), 4).alias("spherical"),
        F.round(scalar.cell_area_km2("lat", mode="planar"), 4).alias("planar"),
    )


@query("f4_kinetic_energy", """
    SELECT l_suppkey, round(sum(CASE WHEN l_quantity < 22.1 THEN 0.0107e0 * pow(l_quantity / 10, 4.59e0) ELSE 0.0243e0 * pow(l_quantity / 10, 3.5e0) END), 4) AS joules
    FROM {lineitem} GROUP BY 1""")
def f4(spark, sf):
    return base(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum(scalar.kinetic_energy_j("l_quantity")), 4).alias("joules"))


@query("f5_slopes_agree", """
    SELECT asset_id, layer_id, scenario, decade, CASE WHEN ols_slope IS NULL OR sen_slope IS NULL OR (ols_slope = 0 AND sen_slope = 0) THEN NULL
           WHEN ols_slope = 0 OR sen_slope = 0 THEN false ELSE (ols_slope > 0) = (sen_slope > 0) END AS agree FROM layer_values""")
def f5(spark, sf):
    v = table(spark, sf, "layer_values")
    return v.select("asset_id", "layer_id", "scenario", "decade", scalar.slopes_agree("ols_slope", "sen_slope").alias("agree"))


@query("f6_risk_band", """
    SELECT layer_id, CASE WHEN percentile <= 20 THEN 'Very Low' WHEN percentile <= 40 THEN 'Low' WHEN percentile <= 60 THEN 'Medium'
           WHEN percentile <= 80 THEN 'High' WHEN percentile IS NOT NULL THEN 'Very High' END AS band, count(*) AS n FROM layer_values GROUP BY 1, 2""")
def f6(spark, sf):
    return table(spark, sf, "layer_values").groupBy("layer_id", scalar.risk_band("percentile").alias("band")).agg(F.count("*").alias("n"))


@query("f7_monthly_ratio", """
    SELECT cell_id, year, month, model, member, scenario, round(CASE WHEN cell_id % 7 = 0 THEN NULL WHEN demand < 30 THEN 0
      WHEN supply > 0 THEN demand / supply END, 6) AS ratio FROM monthly""")
def f7(spark, sf):
    m = table(spark, sf, "monthly").withColumns(
        {"demand": F.when(F.col("demand") < 30, 0.0).otherwise(F.col("demand")), "river": F.col("cell_id") % 7 != 0}
    )
    ratio = scalar.monthly_ratio("demand", "supply", "river", routed=True)
    return m.select("cell_id", "year", "month", "model", "member", "scenario", F.round(ratio, 6).alias("ratio"))


@query("f8_piecewise_linear", """
    SELECT l_suppkey, round(sum(CASE WHEN l_quantity < 10 THEN 99 WHEN l_quantity > 40 THEN 2 WHEN l_quantity <= 20 THEN 90 + (60 - 90) * (l_quantity - 10) / 10
           ELSE 60 + (5 - 60) * (l_quantity - 20) / 20 END), 6) AS total FROM {lineitem} GROUP BY 1""")
def f8(spark, sf):
    y = scalar.piecewise_linear("l_quantity", [(10.0, 90.0), (20.0, 60.0), (40.0, 5.0)], 99.0, 2.0)
    return base(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum(y), 6).alias("total"))


@query("f9_parse_number", """
    SELECT c_custkey, CASE WHEN c_custkey % 5 = 4 OR c_acctbal < 0 THEN NULL ELSE c_acctbal END AS amount FROM {customer}""")
def f9(spark, sf):
    text = F.when(F.col("c_custkey") % 5 == 4, F.concat(F.lit("$"), F.col("c_acctbal"))).when(
        F.col("c_custkey") % 5 == 3, F.format_number("c_acctbal", 2)
    ).otherwise(F.concat(F.lit(" "), F.col("c_acctbal").cast("string")))
    return base(spark, sf, "customer").select("c_custkey", scalar.parse_number(text).alias("amount"))


@query("f10_slugify", """
    SELECT p_partkey, regexp_replace(regexp_replace(lower(trim(concat(' ', p_name, ' -- ', p_brand, '! '))), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM {part}""")
def f10(spark, sf):
    name = F.concat(F.lit(" "), F.col("p_name"), F.lit(" -- "), F.col("p_brand"), F.lit("! "))
    return base(spark, sf, "part").select("p_partkey", scalar.slugify(name).alias("slug"))


@query("f11_list_columns", """
    SELECT asset_id, string_agg(scenario, ';' ORDER BY scenario) AS scenarios FROM (SELECT DISTINCT asset_id, scenario FROM layer_values) t GROUP BY 1""")
def f11(spark, sf):
    lists = table(spark, sf, "layer_values").groupBy("asset_id", "layer_id").agg(
        F.array_join(F.collect_set("scenario"), " ; ").alias("codes")
    )
    merged = F.flatten(F.collect_list(scalar.split_list("codes")))
    return lists.groupBy("asset_id").agg(scalar.join_list(merged).alias("scenarios"))


@query("f12_sigfig", """
    SELECT o_orderkey, CASE WHEN o_totalprice = 0 THEN 0 ELSE round_even(o_totalprice * pow(10e0, 3 - floor(log10(abs(o_totalprice)))), 0) / pow(10e0, 3 - floor(log10(abs(o_totalprice)))) END AS short
    FROM {orders}""")
def f12(spark, sf):
    return base(spark, sf, "orders").select("o_orderkey", scalar.sigfig("o_totalprice").alias("short"))


@query("f13_percentile_direction", """
    SELECT p_partkey, CASE WHEN p_size > 45 THEN 'declared' WHEN p_size % 3 = 0 THEN 'higher_is_better' WHEN p_size % 3 = 1 THEN 'higher_is_worse' ELSE 'unknown' END AS direction FROM {part}""")
def f13(spark, sf):
    variable = F.when(F.col("p_size") % 3 == 0, "cveg-tree").when(F.col("p_size") % 3 == 1, "led").otherwise("mystery")
    declared = F.when(F.col("p_size") > 45, "declared")
    return base(spark, sf, "part").select("p_partkey", scalar.percentile_direction(declared, variable).alias("direction"))


@query("f14_curve_number_infiltration", """
    SELECT l_suppkey, round(sum(l_quantity - CASE WHEN l_quantity > 12 THEN pow(l_quantity - 12, 2) / (l_quantity - 12 + 60) ELSE 0 END), 6) AS infiltration FROM {lineitem} GROUP BY 1""")
def f14(spark, sf):
    return base(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.round(F.sum(scalar.curve_number_infiltration("l_quantity", 60.0, 0.2)), 6).alias("infiltration")
    )


@query("f15_conditional_class", """
    SELECT p_partkey, round(exp((ln(p_size) + ln(p_retailprice) + ln(p_size + 1)) / 3e0), 6) AS score,
           CASE WHEN p_size / 50e0 > 0.75 THEN 'High' WHEN p_size / 50e0 > 0.5 THEN 'Medium' ELSE 'Low' END AS class FROM {part}""")
def f15(spark, sf):
    p = base(spark, sf, "part").withColumn("next", F.col("p_size") + 1)
    return p.select(
        "p_partkey", F.round(scalar.geometric_mean("p_size", "p_retailprice", "next"), 6).alias("score"),
        scalar.conditional_class(F.col("p_size") / 50.0).alias("class"),
    )


@query("f16_config_value", """
    SELECT event_type, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS total FROM {events} GROUP BY 1""")
def f16(spark, sf):
    return base(spark, sf, "events").groupBy("event_type").agg(
        F.sum(scalar.config_value("props", "$.k").cast("long")).alias("total")
    )
