"""Contract checks and data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellcast.operators import portfolio, quality, recompute, spatial
from querybook.common import rounded
from querybook.layers import built_layer
from querybook.registry import query
from querybook.spatial import grid_panel
from querybook.standins import SQL, base, table

RULE = "SELECT '{n}' AS check_name, ({v}) = 0 AS passed, CAST(({v}) AS BIGINT) AS detail"


def rules_sql(pairs, head=""):
    return head + " UNION ALL ".join(RULE.format(n=n, v=v) for n, v in pairs)


@query("q1_verify_panel", rules_sql([
    ("grid_rows_regular", "SELECT count(*) FROM grid WHERE abs(lat - (89.75 - 0.5 * grow)) > 1e-6"),
    ("grid_columns_regular", "SELECT count(*) FROM grid WHERE abs(lon - (-179.75 + 0.5 * gcol)) > 1e-6"),
    ("grid_on_globe", "SELECT count(*) FROM grid WHERE abs(lat) > 90 OR abs(lon) > 180"),
    ("scenarios_share_one_grid", "SELECT count(*) FROM (SELECT cell_id FROM built_layer GROUP BY 1 HAVING count(DISTINCT scenario) < (SELECT count(DISTINCT scenario) FROM built_layer)) x"),
    ("baseline_shared", "SELECT count(*) FROM (SELECT cell_id FROM built_layer WHERE decade = 1995 GROUP BY 1 HAVING count(DISTINCT median) > 1 OR count(DISTINCT percentile) > 1 OR count(DISTINCT lower_ci) > 1) x"),
    ("last_decade_differs", "SELECT CASE WHEN max(n) > 1 THEN 0 ELSE 1 END FROM (SELECT count(DISTINCT median) AS n FROM built_layer WHERE decade = 2001 GROUP BY cell_id) x"),
    ("interval_ordered", "SELECT count(*) FROM built_layer WHERE lower_ci > median + 1e-5 OR median > upper_ci + 1e-5"),
    ("percentile_in_range", "SELECT count(*) FROM built_layer WHERE percentile < 1 OR percentile > 100"),
    ("percentile_orientation", "SELECT CASE WHEN corr(median, percentile) > 0 THEN 0 ELSE 1 END FROM built_layer WHERE decade = 1995"),
    ("no_slope_through_baseline", "SELECT count(*) FROM built_layer WHERE decade <= 1995 AND (ols_slope IS NOT NULL OR sen_slope IS NOT NULL)"),
    ("slopes_populated", "SELECT CASE WHEN count(ols_slope) > 0 THEN 0 ELSE 1 END FROM built_layer WHERE decade > 1995"),
    ("no_slope_without_median", "SELECT count(*) FROM built_layer WHERE median IS NULL AND ols_slope IS NOT NULL"),
    ("members_at_least_one", "SELECT count(*) FROM built_layer WHERE n_members < 1"),
    ("models_within_members", "SELECT count(*) FROM built_layer WHERE n_models > n_members"),
]))
def q1(spark, sf):
    return quality.verify_panel(built_layer(spark, sf), table(spark, sf, "grid"), 1995)


def _observed(spark, sf):
    """Event counts per part as rates, with a few rows spoilt on purpose."""
    li = base(spark, sf, "lineitem")
    k = li.groupBy(F.col("l_suppkey").alias("cell_id")).agg(F.count_if((F.col("l_discount") >= 0.095) & (F.col("l_quantity") > 44)).alias("n_events"))
    k = k.withColumn("median", F.col("n_events") / 7.0)
    from cellcast.operators.ranks import observed_rate_rank

    ranked = observed_rate_rank(k, "median", "n_events")
    spoilt = F.col("cell_id") % 50 == 3
    return ranked.withColumns(
        {
            "lower_ci": F.when(~spoilt, F.col("median") * 0.8),
            "upper_ci": F.when(F.col("cell_id") % 50 == 7, F.col("median") * 0.9).otherwise(F.col("median") * 1.2),
            "percentile": F.when(F.col("cell_id") % 50 == 11, 1.5).otherwise(F.col("percentile")),
        }
    )


SQL["observedlayer"] = """
    WITH k AS (SELECT l_suppkey AS cell_id, count(CASE WHEN l_discount >= 0.095 AND l_quantity > 44 THEN 1 END) AS n_events FROM {lineitem} GROUP BY 1), m AS (SELECT *, n_events / 7e0 AS median FROM k),
    r AS (SELECT cell_id, rank() OVER (ORDER BY median) + (count(*) OVER (PARTITION BY median) - 1) / 2e0 AS rk, count(*) OVER () AS n FROM m WHERE n_events > 0)
    SELECT m.cell_id, n_events, median, CASE WHEN m.cell_id % 50 <> 3 THEN median * 0.8 END AS lower_ci, CASE WHEN m.cell_id % 50 = 7 THEN median * 0.9 ELSE median * 1.2 END AS upper_ci,
           CASE WHEN m.cell_id % 50 = 11 THEN 1.5 WHEN n_events = 0 THEN 1 ELSE 2 + 98 * (rk - 1) / (n - 1) END AS percentile FROM m LEFT JOIN r ON r.cell_id = m.cell_id"""


@query("q2_verify_observed", rules_sql([
    ("decadal_columns_absent", "SELECT count(*) FROM (VALUES ('trend'), ('n_models')) c(c)"),
    ("interval_ordered", "SELECT count(*) FROM observedlayer WHERE lower_ci > median OR (lower_ci IS NOT NULL AND median > upper_ci)"),
    ("one_missingness_pattern", "SELECT count(*) FROM observedlayer WHERE (median IS NULL) <> (lower_ci IS NULL) OR (median IS NULL) <> (upper_ci IS NULL)"),
    ("percentile_in_range", "SELECT count(*) FROM observedlayer WHERE percentile < 1 OR percentile > 100"),
    ("unobserved_in_zero_tier", "SELECT count(*) FROM observedlayer WHERE lower_ci IS NOT NULL AND n_events = 0 AND percentile <> 1"),
    ("zero_tier_unobserved", "SELECT count(*) FROM observedlayer WHERE lower_ci IS NOT NULL AND n_events > 0 AND percentile = 1"),
    ("occupied_score_2_to_100", "SELECT count(*) FROM observedlayer WHERE n_events > 0 AND (percentile < 2 OR percentile > 100)"),
    ("rank_follows_rate", """SELECT CASE WHEN corr(ra, rb) > 0.999 THEN 0 ELSE 1 END FROM (SELECT rank() OVER (ORDER BY median) + (count(*) OVER (PARTITION BY median) - 1) / 2e0 AS ra,
        rank() OVER (ORDER BY percentile) + (count(*) OVER (PARTITION BY percentile) - 1) / 2e0 AS rb FROM observedlayer WHERE n_events > 0) x"""),
    ("nothing_outside_mask", "SELECT count(*) FROM observedlayer WHERE cell_id NOT IN (SELECT cell_id FROM land)"),
]))
def q2(spark, sf):
    with_more = _observed(spark, sf).withColumns({"trend": F.lit(0.5), "n_models": F.lit(3)})  # columns that no observed layer may have
    return quality.verify_observed(with_more, table(spark, sf, "land"), ["cell_id"])


# a delivery with some of everything broken
SQL["brokenvalues"] = """
    SELECT asset_id, layer_id, scenario, decade, value, CASE WHEN (value IS NOT NULL) = (asset_id % 41 <> 3) THEN 'OK' ELSE 'OFF_LAYER_MASK' END AS data_status FROM layer_values WHERE asset_id % 23 <> 6 OR decade <> 1997
    UNION ALL SELECT asset_id, 'L9', scenario, decade, value, CASE WHEN value IS NOT NULL THEN 'OK' ELSE 'OFF_LAYER_MASK' END FROM layer_values WHERE layer_id = 'L0' AND asset_id % 59 = 2
    UNION ALL SELECT asset_id, layer_id, scenario, decade, value, CASE WHEN value IS NOT NULL THEN 'OK' ELSE 'OFF_LAYER_MASK' END FROM layer_values WHERE layer_id = 'L1' AND asset_id % 47 = 5 AND decade = 1995"""
SQL["brokenassets"] = """
    SELECT asset_id, location_id, layer_ids, asset_value FROM assets WHERE asset_id % 37 <> 11 UNION ALL SELECT asset_id, location_id, layer_ids, asset_value FROM assets WHERE asset_id % 61 = 1"""
SQL["brokenlocations"] = """
    SELECT DISTINCT location_id FROM assets WHERE asset_value IS NOT NULL UNION ALL SELECT DISTINCT location_id FROM assets WHERE location_id % 17 = 0 AND asset_value IS NOT NULL"""
SQL["layerlist"] = "SELECT DISTINCT layer_id, scenario, decade FROM layer_values"
SQL["wantedkeys"] = "SELECT a.asset_id, l.layer_id, s.scenario, d.decade FROM brokenassets a, (SELECT DISTINCT layer_id FROM layerlist) l, (SELECT DISTINCT layer_id, scenario FROM layerlist) s, (SELECT DISTINCT layer_id, decade FROM layerlist) d WHERE s.layer_id = l.layer_id AND d.layer_id = l.layer_id"


@query("q3_verify_delivery", rules_sql([
    ("assets_have_locations", "SELECT count(*) FROM brokenassets WHERE location_id NOT IN (SELECT location_id FROM brokenlocations)"),
    ("values_have_assets", "SELECT count(*) FROM brokenvalues WHERE asset_id NOT IN (SELECT asset_id FROM brokenassets)"),
    ("values_have_layers", "SELECT count(*) FROM brokenvalues WHERE layer_id NOT IN (SELECT layer_id FROM layerlist)"),
    ("location_ids_unique", "SELECT count(*) FROM (SELECT 1 FROM brokenlocations GROUP BY location_id HAVING count(*) > 1) x"),
    ("asset_ids_unique", "SELECT count(*) FROM (SELECT 1 FROM brokenassets GROUP BY asset_id HAVING count(*) > 1) x"),
    ("value_keys_unique", "SELECT count(*) FROM (SELECT 1 FROM brokenvalues GROUP BY asset_id, layer_id, scenario, decade HAVING count(*) > 1) x"),
    ("no_missing_rows", "SELECT count(*) FROM wantedkeys w WHERE NOT EXISTS (SELECT 1 FROM brokenvalues v WHERE v.asset_id = w.asset_id AND v.layer_id = w.layer_id AND v.scenario = w.scenario AND v.decade = w.decade)"),
    ("no_extra_rows", "SELECT count(*) FROM brokenvalues v WHERE NOT EXISTS (SELECT 1 FROM wantedkeys w WHERE v.asset_id = w.asset_id AND v.layer_id = w.layer_id AND v.scenario = w.scenario AND v.decade = w.decade)"),
    ("status_matches_value", "SELECT count(*) FROM brokenvalues WHERE (data_status = 'OK') <> (value IS NOT NULL)"),
]))
def q3(spark, sf):
    sound = table(spark, sf, "layer_values")
    layers = sound.groupBy("layer_id").agg(F.collect_set("scenario").alias("scenarios"), F.collect_set("decade").alias("decades"))
    return quality.verify_delivery(table(spark, sf, "brokenvalues"), table(spark, sf, "brokenassets"), table(spark, sf, "brokenlocations"), layers)


@query("q3_recomputed_values", """
    WITH d AS (SELECT c.site_id, p.scenario, p.decade, sum(w * median) / sum(CASE WHEN median IS NOT NULL THEN w END) AS median, sum(w * slope) / sum(CASE WHEN slope IS NOT NULL THEN w END) AS slope
               FROM site_cells c JOIN gridpanel p ON c.cell_id = p.cell_id GROUP BY 1, 2, 3)
    SELECT site_id, scenario, decade, '*' AS item, 'missing' AS problem FROM d WHERE site_id % 89 = 8
    UNION ALL SELECT site_id, scenario, decade, 'median', 'differs' FROM d WHERE site_id % 89 <> 8 AND site_id % 97 = 5 AND median IS NOT NULL
    UNION ALL SELECT site_id, scenario, decade, 'slope', 'absent' FROM d WHERE site_id % 89 <> 8 AND site_id % 83 = 4 AND slope IS NOT NULL
    UNION ALL SELECT site_id, scenario, decade, 'slope', 'invented' FROM d WHERE site_id % 89 <> 8 AND site_id % 83 = 7 AND slope IS NULL""")
def q3_recompute(spark, sf):
    """Blends as delivered, some of them altered, against blends by another path."""
    panel, sites = grid_panel(spark, sf), table(spark, sf, "sites")
    made = spatial.extract_points(sites, panel, ["median", "slope"], ["scenario", "decade"]).where("site_id % 89 <> 8")
    altered = made.withColumns({
        "median": F.when(F.col("site_id") % 97 == 5, F.col("median") + 1e-6).otherwise(F.col("median")),
        "slope": F.when(F.col("site_id") % 83 == 4, F.lit(None)).when(F.col("site_id") % 83 == 7, F.coalesce("slope", F.lit(0.5))).otherwise(F.col("slope")),
    })
    again = recompute.extraction_again(sites, panel, ["median", "slope"], ["scenario", "decade"])
    return recompute.differences(altered, again, ["site_id", "scenario", "decade"], ["median", "slope"])


@query("q3_recomputed_scores", """
    SELECT asset_id, scenario_tier, decade, 'climate_score' AS item, 'differs' AS problem FROM scores WHERE asset_id % 13 = 4
    UNION ALL SELECT asset_id, scenario_tier, 2099, '*', 'extra' FROM scores WHERE asset_id % 31 = 9 AND decade = 1995""")
def q3_scores(spark, sf):
    """Scores as delivered, some of them altered or invented, against scores from one weight a row."""
    t = lambda n: table(spark, sf, n)
    made = portfolio.climate_score(t("layer_values"), t("assets"), t("families"), t("weights")).select("asset_id", "scenario_tier", "decade", "climate_score")
    altered = made.withColumn("climate_score", F.col("climate_score") + F.when(F.col("asset_id") % 13 == 4, 0.01).otherwise(0.0))
    invented = made.where("asset_id % 31 = 9 AND decade = 1995").withColumn("decade", F.lit(2099))
    again = recompute.scores_again(t("layer_values"), t("assets"), t("families"), t("weights"))
    return recompute.differences(altered.unionByName(invented), again, ["asset_id", "scenario_tier", "decade"], ["climate_score"])


@query("q3_recomputed_vulnerable", """
    SELECT scenario_tier, decade, count(CASE WHEN status <> 'NOT_ASSESSED' THEN 1 END) AS n_assessed, count(CASE WHEN status = 'VULNERABLE' THEN 1 END) AS n_vulnerable
    FROM vuln GROUP BY 1, 2 HAVING count(CASE WHEN status <> 'NOT_ASSESSED' THEN 1 END) > 0""")
def q3_vulnerable(spark, sf):
    return recompute.vulnerable_again(table(spark, sf, "layer_values"), table(spark, sf, "hazard_layers"), 70.0)


SQL["watermonthly"] = "SELECT scenario, cell_id, CASE WHEN year <= 1996 THEN 1995 ELSE 1997 END AS decade, month, avg(value) AS v FROM monthly GROUP BY 1, 2, 3, 4"
# some annual values do not fit their months, some quantiles are out of order
SQL["waterindex"] = """
    SELECT scenario, cell_id, decade, month - 1 AS value_type, v AS value FROM watermonthly
    UNION ALL SELECT scenario, cell_id, decade, 12, avg(v) + CASE WHEN cell_id % 7 = 3 THEN 0.5 ELSE 0 END FROM watermonthly GROUP BY 1, 2, 3
    UNION ALL SELECT scenario, cell_id, decade, 13 + i, low + i / 10e0 + CASE WHEN cell_id % 5 = 2 AND i = 3 THEN 9e-1 ELSE 0e0 END
    FROM (SELECT scenario, cell_id, decade, min(v) AS low FROM watermonthly GROUP BY 1, 2, 3) a, (VALUES (0), (1), (2), (3), (4), (5), (6)) q(i)"""


@query("q4_verify_water_index", """
    WITH w AS (SELECT scenario, decade, cell_id, max(CASE WHEN value_type = 12 THEN value END) AS a, avg(CASE WHEN value_type < 12 THEN value END) AS m, stddev_pop(CASE WHEN value_type < 12 THEN value END) AS s FROM waterindex GROUP BY 1, 2, 3),
    o AS (SELECT scenario, decade, cell_id, bool_or(value > ahead) AS bad FROM (SELECT *, lead(value) OVER (PARTITION BY scenario, decade, cell_id ORDER BY value_type) AS ahead FROM waterindex WHERE value_type >= 13) x GROUP BY 1, 2, 3)
    SELECT w.scenario, w.decade, count(*) AS n_cells, count(CASE WHEN abs(a - m) >= 1e-3 THEN 1 END) AS annual_mismatches, count(CASE WHEN bad THEN 1 END) AS quantile_violations, round(avg(s / abs(m)), 6) AS seasonal_cv, round(min(a), 6) AS low, round(max(a), 6) AS high
    FROM w JOIN o ON w.scenario = o.scenario AND w.decade = o.decade AND w.cell_id = o.cell_id GROUP BY 1, 2""")
def q4(spark, sf):
    return rounded(quality.verify_water_index(table(spark, sf, "waterindex")), "seasonal_cv", "low", "high")


@query("q4_cross_scenario_correlation", """
    SELECT CASE WHEN count(*) > 1 THEN round(corr(a.value, b.value), 6) END AS correlation FROM waterindex a JOIN waterindex b ON a.cell_id = b.cell_id AND a.decade = b.decade AND a.value_type = b.value_type WHERE a.decade = 1995 AND a.value_type = 12 AND a.scenario = 'ssp126' AND b.scenario = 'ssp585'""")
def q4_correlation(spark, sf):
    return rounded(quality.cross_scenario_correlation(table(spark, sf, "waterindex"), 1995, "ssp126", "ssp585"), "correlation")


@query("q6_profile_members", """
    WITH t AS (SELECT *, max(value_zero) OVER (PARTITION BY model, member, scenario) AS top FROM annual)
    SELECT model, member, scenario, round(count(value_zero) / count(*), 6) AS finite_share, round(avg(CASE WHEN value_zero = 0 THEN 1e0 ELSE 0e0 END), 6) AS zero_share, round(avg(CASE WHEN value_zero >= top - greatest(1e-3, 1e-4 * abs(top)) THEN 1e0 ELSE 0e0 END), 6) AS at_max_share,
      min(value_zero) AS low, max(value_zero) AS high, round(avg(CASE WHEN year BETWEEN 1995 AND 1996 THEN value_zero END), 6) AS baseline_mean, round(avg(CASE WHEN year BETWEEN 1999 AND 2000 THEN value_zero END), 6) AS late_mean, count(DISTINCT value_zero) AS n_unique FROM t GROUP BY 1, 2, 3""")
def q6(spark, sf):
    return rounded(quality.profile_members(table(spark, sf, "annual"), 1995, 1999, 2, "value_zero"), "finite_share", "zero_share", "at_max_share", "baseline_mean", "late_mean")


@query("q6_cluster_separation", """
    WITH p AS (SELECT quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS i FROM annual), g AS (SELECT model, quantile_cont(value, 0.5) AS median FROM annual GROUP BY 1)
    SELECT model, round(median, 6) AS median, round((median - m) / i, 6) AS separation FROM g, p""")
def q6_clusters(spark, sf):
    return rounded(quality.cluster_separation(table(spark, sf, "annual")), "median", "separation")


@query("q7_layer_report", """
    SELECT l.scenario, l.decade, count(*) AS n_cells, round(avg(l.median), 6) AS mean, round(max(l.median), 6) AS high, round(avg(l.ols_slope), 6) AS ols_mean, round(avg(l.sen_slope), 6) AS sen_mean, round(avg(l.median - b.median), 6) AS change_mean,
           round(quantile_cont(l.median, 0.5), 6) AS p50, round(quantile_cont(l.median, 0.9), 6) AS p90, round(quantile_cont(l.upper_ci - l.lower_ci, 0.5), 6) AS ci_width_p50
    FROM built_layer l LEFT JOIN built_layer b ON b.scenario = l.scenario AND b.cell_id = l.cell_id AND b.decade = 1995 GROUP BY 1, 2""")
def q7(spark, sf):
    out = quality.layer_report(built_layer(spark, sf), 1995)
    return rounded(out, "mean", "high", "ols_mean", "sen_mean", "change_mean", "p50", "p90", "ci_width_p50")


@query("q8_time_invariant_mask", """
    WITH y AS (SELECT scenario, member, count(DISTINCT year) AS n FROM annual GROUP BY 1, 2)
    SELECT a.scenario, a.member, a.cell_id, count(a.value_null) AS n_present FROM annual a JOIN y ON y.scenario = a.scenario AND y.member = a.member GROUP BY 1, 2, 3, y.n HAVING count(a.value_null) > 0 AND count(a.value_null) < y.n""")
def q8(spark, sf):
    return quality.time_varying_masks(table(spark, sf, "annual"), "value_null")


@query("q9_coverage_tiers", """
    WITH m AS (SELECT cell_id, model, avg(CASE WHEN value_zero > 100 THEN value_zero END) AS v FROM annual GROUP BY 1, 2), c AS (SELECT cell_id, count(v) AS n, avg(v) AS l FROM m GROUP BY 1)
    SELECT n AS n_models, count(*) AS n_cells, round(avg(l), 6) AS mean_level FROM c GROUP BY 1""")
def q9(spark, sf):
    a = table(spark, sf, "annual").withColumn("high", F.when(F.col("value_zero") > 100, F.col("value_zero")))
    return rounded(quality.coverage_tiers(a, "high"), "mean_level")


@query("q10_input_checks", """
    WITH c AS (SELECT c_custkey AS position, c_custkey % 11 AS k, c_acctbal FROM {customer})
    SELECT position, 'non-numeric Lat' AS problem FROM c WHERE k = 1 UNION ALL SELECT position, 'missing coordinate' FROM c WHERE k = 2 UNION ALL SELECT position, 'coordinate out of range' FROM c WHERE k = 3
    UNION ALL SELECT position, 'non-numeric Asset_Value' FROM c WHERE k = 4 UNION ALL SELECT position, 'negative Asset_Value' FROM c WHERE k <> 4 AND c_acctbal < 0 UNION ALL SELECT position, 'value without currency' FROM c WHERE k = 5 AND c_acctbal >= 0
    UNION ALL SELECT NULL, 'mixed currencies'""")
def q10(spark, sf):
    k = F.col("c_custkey") % 11
    rows = base(spark, sf, "customer").select(
        F.col("c_custkey").alias("position"),
        F.when(k == 1, "N/A").when(k == 3, "91.5").otherwise("45.25").alias("Lat"),
        F.when(k == 2, F.lit(None).cast("string")).otherwise("-120").alias("Lon"),
        F.when(k == 4, "TBD").otherwise(F.col("c_acctbal").cast("string")).alias("Asset_Value"),
        F.when(k == 5, F.lit(None).cast("string")).when(k == 6, " usd").otherwise("EUR").alias("Currency"),
    )
    return quality.input_checks(rows)


@query("q11_scenario_symmetry", """
    WITH m AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS member, CASE l_linenumber % 3 WHEN 0 THEN 'ssp126' WHEN 1 THEN 'ssp370' ELSE 'ssp585' END AS scenario FROM {lineitem})
    SELECT member, string_agg(scenario, ';' ORDER BY scenario) AS scenarios FROM m GROUP BY 1 HAVING count(*) < 3""")
def q11(spark, sf):
    li = base(spark, sf, "lineitem")
    scen = F.when(F.col("l_linenumber") % 3 == 0, "ssp126").when(F.col("l_linenumber") % 3 == 1, "ssp370").otherwise("ssp585")
    return quality.scenario_symmetry(li.select(F.col("l_orderkey").cast("string").alias("member"), scen.alias("scenario")))


@query("q11_attributes_must_match", """
    SELECT concat(p_brand, '-', CAST(p_size AS VARCHAR)) AS layer_id, 'units' AS attribute, count(DISTINCT p_type) AS n_values FROM {part} GROUP BY 1 HAVING count(DISTINCT p_type) > 1
    UNION ALL SELECT concat(p_brand, '-', CAST(p_size AS VARCHAR)), 'direction', count(DISTINCT p_retailprice > 930) FROM {part} GROUP BY 1 HAVING count(DISTINCT p_retailprice > 930) > 1""")
def q11_attributes(spark, sf):
    layer_id = F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("layer_id")
    declared = F.create_map(F.lit("units"), F.col("p_type"), F.lit("direction"), (F.col("p_retailprice") > 930).cast("string"))
    attrs = base(spark, sf, "part").select(layer_id, F.explode(declared).alias("attribute", "value"))
    return quality.attributes_must_match(attrs)


@query("q12_reference_site_table", """
    WITH p AS (SELECT site_id, 25e0 AS expected, CAST(round((89.75 - lat) / 0.5) AS INT) AS grow, CAST((CAST(round((lon + 179.75) / 0.5) AS INT) + 720) % 720 AS INT) AS gcol FROM sites)
    SELECT p.site_id, p.expected, round(s.gappy, 6) AS found, CASE WHEN s.gappy IS NULL THEN 'missing' WHEN abs(s.gappy - 25) <= 0.3 THEN 'ok' ELSE 'off' END AS verdict FROM p LEFT JOIN surface s ON s.grow = p.grow AND s.gcol = p.gcol""")
def q12(spark, sf):
    s = table(spark, sf, "sites").withColumn("expected", F.lit(25.0))
    return rounded(quality.reference_site_table(s, table(spark, sf, "surface"), "gappy", 0.3), "found")


@query("q13_support_by_band", """
    SELECT CAST(floor(s.lat / 2) * 2 AS INT) AS band, round(count(s.gappy) / count(*), 6) AS finite_share, count(l.cell_id) AS n_land, count(CASE WHEN l.cell_id IS NOT NULL AND s.gappy IS NOT NULL THEN 1 END) AS n_land_value
    FROM surface s LEFT JOIN land l ON l.cell_id = s.cell_id GROUP BY 1""")
def q13(spark, sf):
    return rounded(quality.support_by_band(table(spark, sf, "surface"), table(spark, sf, "land"), "gappy", 2.0), "finite_share")


@query("q13_lookup_distance", """
    WITH d AS (SELECT a.cell_id, min(round(2 * 6371.0088e0 * asin(sqrt(greatest(0, least(1, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians((((b.lon - a.lon) + 540) % 360) - 180) / 2), 2))))), 6)) AS km
               FROM surface a, surface b WHERE b.gappy IS NOT NULL GROUP BY 1), k AS (SELECT km FROM d WHERE km <= 250)
    SELECT 0.5e0 AS q, round(quantile_cont(km, 0.5), 5) AS quantile FROM k UNION ALL SELECT 0.75e0, round(quantile_cont(km, 0.75), 5) FROM k UNION ALL SELECT 0.9e0, round(quantile_cont(km, 0.9), 5) FROM k UNION ALL SELECT 0.95e0, round(quantile_cont(km, 0.95), 5) FROM k
    UNION ALL SELECT 0.99e0, round(quantile_cont(km, 0.99), 5) FROM k UNION ALL SELECT 1e0, round(max(km), 5) FROM k""")
def q13_distance(spark, sf):
    s = table(spark, sf, "surface")
    found = spatial.nearest_valid(s.select(F.col("cell_id").alias("target_id"), "lat", "lon"), s.where("gappy IS NOT NULL").select(F.col("cell_id").alias("source_id"), "lat", "lon"))
    return rounded(quality.lookup_distance(found), "quantile", n=5)


@query("q14_model_cycle", """
    WITH c AS (SELECT model, month, avg(value) AS m FROM monthly GROUP BY 1, 2), a AS (SELECT model, avg(v) AS a FROM (SELECT model, member, scenario, cell_id, year, avg(value) AS v FROM monthly GROUP BY 1, 2, 3, 4, 5) x GROUP BY 1)
    SELECT c.model, month, round(m, 6) AS month_mean, round(a, 6) AS annual_mean FROM c JOIN a ON a.model = c.model""")
def q14(spark, sf):
    return rounded(quality.model_cycle(table(spark, sf, "monthly")), "month_mean", "annual_mean")


@query("q15_taxonomy_links", """
    SELECT DISTINCT p_brand AS family, concat('L', CAST(p_size % 9 AS VARCHAR)) AS layer_id FROM {part} WHERE concat('L', CAST(p_size % 9 AS VARCHAR)) NOT IN (SELECT layer_id FROM layer_values)""")
def q15(spark, sf):
    tax = base(spark, sf, "part").groupBy(F.col("p_brand").alias("family")).agg(F.collect_set(F.concat(F.lit("L"), (F.col("p_size") % 9).cast("string"))).alias("covered_by"))
    return quality.taxonomy_links(tax, table(spark, sf, "layer_values").select("layer_id").distinct())
