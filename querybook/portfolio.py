"""Delivery planning, scores, vulnerability and rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellcast.operators import delivery, portfolio
from cellcast.sources import naming, sinks
from querybook.common import rounded
from querybook.registry import query
from querybook.standins import SQL, base, table

TIER = "CASE scenario WHEN 'ssp126' THEN 'low' WHEN 'ssp245' THEN 'medium' WHEN 'ssp370' THEN 'medium' WHEN 'ssp585' THEN 'high' END"

SQL["score_rows"] = f"""
    SELECT v.asset_id, f.family, v.layer_id, v.scenario, v.decade, v.percentile, {TIER} AS tier
    FROM layer_values v JOIN families f ON v.layer_id = f.layer_id JOIN assets a ON v.asset_id = a.asset_id
         JOIN weights w ON w.asset_type = a.asset_type AND w.family = f.family AND w.weight = 1
    WHERE v.percentile IS NOT NULL"""
SQL["family_cells"] = """
    SELECT asset_id, tier, decade, family, avg(p) AS pct FROM (
        SELECT asset_id, tier, decade, family, layer_id, avg(percentile) AS p FROM score_rows WHERE scenario <> 'observed' GROUP BY 1, 2, 3, 4, 5) l GROUP BY 1, 2, 3, 4"""
SQL["observed_cells"] = """
    SELECT asset_id, family, avg(p) AS pct FROM (SELECT asset_id, family, layer_id, avg(percentile) AS p FROM score_rows WHERE scenario = 'observed' GROUP BY 1, 2, 3) l GROUP BY 1, 2"""
SQL["all_cells"] = """
    SELECT asset_id, tier, decade, family, pct FROM family_cells
    UNION ALL SELECT g.asset_id, g.tier, g.decade, o.family, o.pct FROM (SELECT DISTINCT asset_id, tier, decade FROM family_cells) g JOIN observed_cells o ON g.asset_id = o.asset_id"""
SQL["score_lists"] = """
    SELECT asset_id, tier, decade, string_agg(DISTINCT layer_id, ';' ORDER BY layer_id) AS layers, string_agg(DISTINCT scenario, ';' ORDER BY scenario) AS scenarios FROM (
        SELECT asset_id, tier, decade, layer_id, scenario FROM score_rows WHERE scenario <> 'observed'
        UNION ALL SELECT g.asset_id, g.tier, g.decade, r.layer_id, r.scenario FROM (SELECT DISTINCT asset_id, tier, decade FROM family_cells) g
          JOIN score_rows r ON r.asset_id = g.asset_id AND r.scenario = 'observed') t GROUP BY 1, 2, 3"""
SQL["scores"] = """
    SELECT c.asset_id, c.tier AS scenario_tier, c.decade, round_even(round(avg(c.pct), 9), 2) AS climate_score, count(*) AS n_hazards,
           max(e.n) AS n_hazards_expected, string_agg(c.family, ';' ORDER BY c.family) AS hazards, max(l.layers) AS layers, max(l.scenarios) AS scenarios
    FROM all_cells c JOIN (SELECT a.asset_id, count(*) AS n FROM assets a JOIN weights w ON w.asset_type = a.asset_type AND w.weight = 1 GROUP BY 1) e ON e.asset_id = c.asset_id
         JOIN score_lists l ON l.asset_id = c.asset_id AND l.tier = c.tier AND l.decade = c.decade
    GROUP BY 1, 2, 3"""
SQL["hazard_layers"] = "SELECT * FROM (VALUES ('L0'), ('L1'), ('L2'), ('L3')) h(layer_id)"
SQL["vuln"] = f"""
    WITH h AS (SELECT asset_id, {TIER} AS scenario_tier, decade, layer_id, avg(percentile) AS p FROM layer_values
               WHERE layer_id IN (SELECT layer_id FROM hazard_layers) AND scenario <> 'observed' GROUP BY 1, 2, 3, 4),
    k AS (SELECT *, row_number() OVER (PARTITION BY asset_id, scenario_tier, decade ORDER BY p DESC NULLS LAST, layer_id) AS rn FROM h)
    SELECT asset_id, scenario_tier, decade, max(p) AS worst_percentile, max(CASE WHEN rn = 1 AND p IS NOT NULL THEN layer_id END) AS worst_hazard,
           count(p) AS n_hazards_assessed, 4 AS n_hazards_expected, CASE WHEN max(p) IS NULL THEN 'NOT_ASSESSED' WHEN max(p) >= 70 THEN 'VULNERABLE' ELSE 'NOT_VULNERABLE' END AS status
    FROM k GROUP BY 1, 2, 3"""


def scores(spark, sf):
    t = lambda n: table(spark, sf, n)
    return portfolio.climate_score(t("layer_values"), t("assets"), t("families"), t("weights"))


def vuln(spark, sf, threshold=70.0):
    t = lambda n: table(spark, sf, n)
    return portfolio.vulnerability(t("layer_values"), t("assets"), t("hazard_layers"), threshold)


@query("r1_climate_score", "SELECT * FROM scores")
def r1(spark, sf):
    return scores(spark, sf)


@query("r2_vulnerability", """
    SELECT asset_id, scenario_tier, decade, round(worst_percentile, 6) AS worst_percentile, worst_hazard, n_hazards_assessed, n_hazards_expected, status FROM vuln""")
def r2(spark, sf):
    return rounded(vuln(spark, sf), "worst_percentile")


ROLL = """count(CASE WHEN status <> 'NOT_ASSESSED' THEN 1 END) AS n_assessed, count(CASE WHEN status = 'VULNERABLE' THEN 1 END) AS n_vulnerable,
    round(coalesce(sum(CASE WHEN status = 'VULNERABLE' THEN asset_value END), 0), 2) AS amount_vulnerable,
    round(coalesce(sum(CASE WHEN status <> 'NOT_ASSESSED' THEN asset_value END), 0), 2) AS amount_assessed,
    (SELECT count(*) FROM assets) AS n_total, round((SELECT sum(asset_value) FROM assets), 2) AS amount_total,
    round(100.0 * count(CASE WHEN status = 'VULNERABLE' THEN 1 END) / nullif(count(CASE WHEN status <> 'NOT_ASSESSED' THEN 1 END), 0), 6) AS pct_of_assessed,
    round(100.0 * count(CASE WHEN status = 'VULNERABLE' THEN 1 END) / (SELECT count(*) FROM assets), 6) AS pct_of_portfolio"""


@query("r3_vulnerability_rollup", f"SELECT {ROLL} FROM vuln v JOIN assets a ON v.asset_id = a.asset_id WHERE scenario_tier = 'high' AND decade = 1999")
def r3(spark, sf):
    out = portfolio.vulnerability_rollup(vuln(spark, sf), table(spark, sf, "assets"), "high", 1999)
    return rounded(rounded(out, "amount_vulnerable", "amount_assessed", "amount_total", n=2), "pct_of_assessed", "pct_of_portfolio")


@query("r4_vulnerability_sensitivity", f"""
    SELECT threshold, threshold = 70 AS is_chosen, {ROLL} FROM (
      SELECT v.asset_id, t.threshold, CASE WHEN worst_percentile IS NULL THEN 'NOT_ASSESSED' WHEN worst_percentile >= t.threshold THEN 'VULNERABLE' ELSE 'NOT_VULNERABLE' END AS status
      FROM vuln v, (VALUES (60e0), (70e0), (80e0)) t(threshold) WHERE scenario_tier = 'high' AND decade = 1999) v JOIN assets a ON v.asset_id = a.asset_id GROUP BY 1, 2""")
def r4(spark, sf):
    out = portfolio.vulnerability_sensitivity(vuln(spark, sf), table(spark, sf, "assets"), "high", 1999, [60, 80], 70)
    return rounded(rounded(out, "amount_vulnerable", "amount_assessed", "amount_total", n=2), "pct_of_assessed", "pct_of_portfolio")


@query("r5_balanced_assets", """
    SELECT asset_id FROM scores GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT scenario_tier) * count(DISTINCT decade) FROM scores)""")
def r5(spark, sf):
    return portfolio.balanced_assets(scores(spark, sf))


@query("r6_balanced_by_family_set", """
    SELECT asset_id FROM (SELECT asset_id, scenario_tier FROM scores WHERE decade IN (1995, 1997, 1999) AND scenario_tier IN ('low', 'high') GROUP BY 1, 2
      HAVING count(DISTINCT decade) = 3 AND count(DISTINCT hazards) = 1) t GROUP BY 1 HAVING count(*) = 2""")
def r6(spark, sf):
    return portfolio.balanced_assets_by_family_set(scores(spark, sf), ["low", "high"], [1995, 1997, 1999])


SQL["series"] = """
    WITH panel AS (SELECT asset_id FROM scores GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT scenario_tier) * count(DISTINCT decade) FROM scores)),
    c AS (SELECT * FROM scores WHERE n_hazards >= n_hazards_expected AND asset_id IN (SELECT asset_id FROM panel)),
    kept AS (SELECT decade FROM c GROUP BY 1 HAVING count(*) = (SELECT count(*) FROM panel) * (SELECT count(DISTINCT scenario_tier) FROM scores))
    SELECT scenario_tier, decade, avg(climate_score) AS mean_score, true AS kept FROM c WHERE decade IN (SELECT decade FROM kept) GROUP BY 1, 2
    UNION ALL SELECT NULL, decade, NULL, false FROM (SELECT DISTINCT decade FROM scores) d WHERE decade NOT IN (SELECT decade FROM kept)"""


@query("r7_portfolio_series", "SELECT scenario_tier, decade, round(mean_score, 6) AS mean_score, kept FROM series")
def r7(spark, sf):
    return rounded(portfolio.portfolio_series(scores(spark, sf)), "mean_score")


@query("r8_assert_baseline_equal", """
    SELECT count(*) AS n_tiers, round(max(mean_score) - min(mean_score), 6) AS spread, count(*) < 2 OR max(mean_score) - min(mean_score) <= 0.05 AS passed
    FROM series WHERE decade = 1997 AND mean_score IS NOT NULL""")
def r8(spark, sf):
    return rounded(portfolio.baseline_spread(portfolio.portfolio_series(scores(spark, sf)), 1997), "spread")


@query("r9_change_vs_baseline", """
    WITH p AS (SELECT asset_id FROM (SELECT asset_id, scenario_tier FROM scores WHERE decade IN (1997, 1999) AND scenario_tier IN ('low', 'medium') GROUP BY 1, 2
      HAVING count(DISTINCT decade) = 2 AND count(DISTINCT hazards) = 1) t GROUP BY 1 HAVING count(*) = 2),
    s AS (SELECT avg(CASE WHEN decade = 1999 THEN climate_score END) AS a, avg(CASE WHEN decade = 1997 THEN climate_score END) AS b, count(DISTINCT asset_id) AS n
          FROM scores WHERE scenario_tier IN ('low', 'medium') AND asset_id IN (SELECT asset_id FROM p))
    SELECT round(a, 6) AS now, round(b, 6) AS base, n AS n_assets, round(a - b, 6) AS change FROM s""")
def r9(spark, sf):
    return rounded(portfolio.change_vs_baseline(scores(spark, sf), ["low", "medium"], 1997, 1999), "now", "base", "change")


def _bands_sql(key):
    return f"""
    SELECT {key}, {TIER} AS scenario_tier, decade, round(avg(percentile), 6) AS mean_percentile, count(CASE WHEN percentile <= 20 THEN 1 END) AS n_very_low,
           count(CASE WHEN percentile > 20 AND percentile <= 40 THEN 1 END) AS n_low, count(CASE WHEN percentile > 40 AND percentile <= 60 THEN 1 END) AS n_medium,
           count(CASE WHEN percentile > 60 AND percentile <= 80 THEN 1 END) AS n_high, count(CASE WHEN percentile > 80 THEN 1 END) AS n_very_high
    FROM layer_values v JOIN assets a ON v.asset_id = a.asset_id GROUP BY 1, 2, 3"""


@query("r10_mean_percentile_by_type", _bands_sql("asset_type"))
def r10(spark, sf):
    return rounded(portfolio.mean_percentile_by(table(spark, sf, "layer_values"), table(spark, sf, "assets"), "asset_type"), "mean_percentile")


@query("r10_mean_percentile_by_location", _bands_sql("location_id"))
def r10_loc(spark, sf):
    return rounded(portfolio.mean_percentile_by(table(spark, sf, "layer_values"), table(spark, sf, "assets"), "location_id"), "mean_percentile")


@query("r11_tier_gaps", f"""
    SELECT l.layer_id, t.t AS scenario_tier FROM (SELECT DISTINCT layer_id FROM layer_values) l, (VALUES ('low'), ('medium'), ('high')) t(t)
    WHERE NOT EXISTS (SELECT 1 FROM layer_values v WHERE v.layer_id = l.layer_id AND {TIER} = t.t)""")
def r11(spark, sf):
    return portfolio.tier_gaps(table(spark, sf, "layer_values"))


@query("r12_coverage_summary", """
    WITH t AS (SELECT DISTINCT concat(p_brand, '-', CAST(p_size AS VARCHAR)) AS family, concat('L', CAST(p_size % 9 AS VARCHAR)) AS layer_id FROM {part})
    SELECT t.family, bool_or(v.layer_id IS NOT NULL) AS covered, coalesce(string_agg(v.layer_id, ';' ORDER BY v.layer_id), '') AS layers
    FROM t LEFT JOIN (SELECT DISTINCT layer_id FROM layer_values) v ON v.layer_id = t.layer_id GROUP BY 1""")
def r12(spark, sf):
    tax = base(spark, sf, "part").groupBy(F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("family")).agg(
        F.collect_set(F.concat(F.lit("L"), (F.col("p_size") % 9).cast("string"))).alias("covered_by")
    )
    return portfolio.coverage_summary(tax, table(spark, sf, "layer_values"))


@query("r13_trend_table", f"""
    WITH r AS (SELECT *, CASE {TIER} WHEN 'low' THEN 0 WHEN 'medium' THEN 1 WHEN 'high' THEN 2 END AS k FROM layer_values WHERE decade = 1999 AND scenario <> 'observed')
    SELECT asset_id, layer_id, scenario, round(CASE WHEN layer_id IN ('L0', 'L2') THEN ols_slope ELSE sen_slope END, 6) AS slope,
      CASE WHEN ols_slope IS NULL OR sen_slope IS NULL OR (ols_slope = 0 AND sen_slope = 0) THEN NULL WHEN ols_slope = 0 OR sen_slope = 0 THEN false ELSE (ols_slope > 0) = (sen_slope > 0) END AS agree
    FROM r WHERE k = (SELECT max(k) FROM r i WHERE i.layer_id = r.layer_id)""")
def r13(spark, sf):
    layers = table(spark, sf, "families").withColumn("recommended", F.when(F.col("layer_id").isin("L0", "L2"), "ols").otherwise("sen"))
    return rounded(portfolio.trend_table(table(spark, sf, "layer_values"), layers, 1999), "slope")


# the families that a report must name, two of them without a layer, and where its settings come from
SQL["taxonomy"] = """
    SELECT family, layer_id FROM families UNION ALL SELECT * FROM (VALUES ('drought', 'L7'), ('frost', NULL)) f(family, layer_id)"""
SQL["reportconfig"] = "SELECT DISTINCT CASE WHEN r_regionkey % 2 = 0 THEN 'horizons' ELSE 'threshold' END AS item, 'default' AS source FROM {region}"


@query("r14_caveat_rules", f"""
    WITH ly AS (SELECT layer_id, avg(CASE WHEN percentile >= 99 THEN 1e0 ELSE 0e0 END) AS sat, avg(CASE WHEN percentile IS NULL THEN 1e0 ELSE 0e0 END) AS gap, min(n_models) AS m FROM layer_values GROUP BY 1),
    loc AS (SELECT location_id, CASE WHEN min(asset_value) IS NULL THEN 'derived' ELSE 'supplied' END AS src FROM assets GROUP BY 1),
    g AS (SELECT l.layer_id, count(*) AS n FROM (SELECT DISTINCT layer_id FROM layer_values) l, (VALUES ('low'), ('medium'), ('high')) t(t)
          WHERE NOT EXISTS (SELECT 1 FROM layer_values v WHERE v.layer_id = l.layer_id AND {TIER} = t.t) GROUP BY 1)
    SELECT 'HAZARD-COVERAGE' AS rule, 'must' AS severity, family AS subject, 1 AS n FROM (SELECT family FROM taxonomy GROUP BY 1 HAVING count(CASE WHEN layer_id IN (SELECT layer_id FROM layer_values) THEN 1 END) = 0) f
    UNION ALL SELECT 'QA-UNREVIEWED', 'must', layer_id, 1 FROM ly WHERE layer_id IN ('L1', 'L3')
    UNION ALL SELECT 'CATALOG-UNCONFIRMED', 'must', asset_type, count(*) FROM assets WHERE asset_id % 3 = 0 GROUP BY 3
    UNION ALL SELECT 'HORIZONS-DEFAULT', 'must', 'delivery', count(*) FROM reportconfig WHERE item = 'horizons' AND source = 'default' HAVING count(*) > 0
    UNION ALL SELECT 'ASSET-VALUES-ABSENT', 'must', 'delivery', count(*) FROM assets WHERE asset_value IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'SCORE-MIXED-AXES', 'must', layer_id, 1 FROM ly WHERE layer_id = 'L3' AND EXISTS (SELECT 1 FROM scores WHERE layers LIKE '%L3%')
    UNION ALL SELECT 'RELATIVE-BASELINE' AS rule, 'must' AS severity, layer_id AS subject, 1 AS n FROM ly WHERE layer_id <> 'L4'
    UNION ALL SELECT 'SATURATION', 'must', layer_id, 1 FROM ly WHERE sat > 0.05
    UNION ALL SELECT 'SPARSITY', 'should', layer_id, 1 FROM ly WHERE gap > 0.5
    UNION ALL SELECT 'SINGLE-MODEL', 'must', layer_id, 1 FROM ly WHERE m = 1
    UNION ALL SELECT 'SMOOTHED', 'should', layer_id, 1 FROM ly WHERE layer_id = 'L2'
    UNION ALL SELECT 'UNASSESSED-ASSET', 'must', CAST(asset_id AS VARCHAR), count(*) FROM vuln WHERE status = 'NOT_ASSESSED' GROUP BY 3
    UNION ALL SELECT 'DERIVED-COORDINATE', 'must', CAST(location_id AS VARCHAR), 1 FROM loc WHERE src = 'derived'
    UNION ALL SELECT 'SCORE-OBSERVED-CONSTANT', 'must', 'delivery', count(*) FROM scores WHERE scenarios LIKE '%observed%'
    UNION ALL SELECT 'SCORE-INCOMPLETE-ROWS', 'should', 'delivery', count(*) FROM scores WHERE n_hazards < n_hazards_expected
    UNION ALL SELECT 'PANEL-UNBALANCED', 'should', layer_id, n FROM g""")
def r14(spark, sf):
    v, a = table(spark, sf, "layer_values"), table(spark, sf, "assets")
    layers = v.groupBy("layer_id").agg(
        F.avg(F.when(F.col("percentile") >= 99, 1.0).otherwise(0.0)).alias("saturation_share"),
        F.avg(F.when(F.col("percentile").isNull(), 1.0).otherwise(0.0)).alias("zero_share"),
        F.min("n_models").alias("n_models"),
    ).withColumns({
        "smoothing": F.when(F.col("layer_id") == "L2", "5x5"), "relative_baseline": F.col("layer_id") != "L4",
        "reviewed_on": F.when(~F.col("layer_id").isin("L1", "L3"), "2026-01-01"), "is_hazard": F.col("layer_id") != "L3",
    })
    locations = a.groupBy("location_id").agg(F.when(F.min("asset_value").isNull(), "derived").otherwise("supplied").alias("coord_source"))
    mapped = a.withColumn("layer_source", F.when(F.col("asset_id") % 3 == 0, "catalog").otherwise("row-override"))
    return portfolio.caveat_rules(layers, v, scores(spark, sf), vuln(spark, sf), locations, mapped, table(spark, sf, "taxonomy"), table(spark, sf, "reportconfig"))


@query("r15_legacy_decade_columns", """
    SELECT home_region, layer_id, round(avg(CASE WHEN decade = 1995 THEN percentile END), 6) AS d1995, round(avg(CASE WHEN decade = 1997 THEN percentile END), 6) AS d1997,
           round(avg(CASE WHEN decade = 1999 THEN percentile END), 6) AS d1999 FROM layer_values v JOIN assets a ON v.asset_id = a.asset_id GROUP BY 1, 2""")
def r15(spark, sf):
    out = portfolio.legacy_decade_columns(table(spark, sf, "layer_values"), table(spark, sf, "assets"), "home_region", [1995, 1997, 1999])
    return rounded(out, "d1995", "d1997", "d1999")


@query("r15_legacy_significant_change", """
    SELECT l.layer_id, round(avg(l.value - b.value), 6) AS mean_change, count(*) AS n_rows FROM layer_values l JOIN layer_values b
      ON b.asset_id = l.asset_id AND b.layer_id = l.layer_id AND b.scenario = l.scenario AND b.decade = 1995
    WHERE l.decade = 1999 AND abs(l.ols_slope) > 3 GROUP BY 1""")
def r15_change(spark, sf):
    out = portfolio.legacy_significant_change(table(spark, sf, "layer_values"), 1995, 1999, F.abs("ols_slope") > 3)
    return rounded(out, "mean_change")


@query("r15_six_number_summary", """
    SELECT layer_id, decade, round(min(percentile), 6) AS low, round(avg(percentile), 6) AS mean, round(max(percentile), 6) AS high, round(quantile_cont(percentile, 0.25), 6) AS q1,
           round(quantile_cont(percentile, 0.5), 6) AS median, round(quantile_cont(percentile, 0.75), 6) AS q3 FROM layer_values GROUP BY 1, 2""")
def r15_six(spark, sf):
    return rounded(portfolio.six_number_summary(table(spark, sf, "layer_values")), "low", "mean", "high", "q1", "median", "q3")


@query("r15_split_region_text", "SELECT site_id, CASE WHEN site_id % 3 = 0 THEN NULL ELSE home_region END AS region, country FROM sites")
def r15_split(spark, sf):
    s = table(spark, sf, "sites")
    text = F.when(F.col("site_id") % 3 == 0, F.col("country")).otherwise(F.concat_ws(", ", "home_region", "country"))
    return s.select("site_id", text.alias("t")).select("site_id", *[c.alias(n) for n, c in portfolio.split_region_text("t").items()])


@query("r16_tier_collisions", f"""
    SELECT layer_id, tier AS scenario_tier, string_agg(DISTINCT scenario, ';' ORDER BY scenario) AS scenarios FROM (SELECT layer_id, scenario, {TIER} AS tier FROM layer_values) t
    WHERE tier IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT scenario) > 1""")
def r16(spark, sf):
    return portfolio.tier_collisions(table(spark, sf, "layer_values"))


# Top-k --------------------------------------------------------------------------------------


@query("t1_worst_hazard_per_asset", f"""
    SELECT asset_id, tier AS scenario_tier, decade, layer_id AS worst_hazard, round(percentile, 6) AS percentile FROM (
      SELECT *, row_number() OVER (PARTITION BY asset_id, tier, decade ORDER BY percentile DESC, layer_id) AS rn FROM (SELECT *, {TIER} AS tier FROM layer_values WHERE percentile IS NOT NULL) a WHERE tier IS NOT NULL) b
    WHERE rn = 1""")
def t1(spark, sf):
    return rounded(portfolio.worst_hazard_per_asset(table(spark, sf, "layer_values")), "percentile")


@query("t2_ranked_assets", "SELECT asset_id, worst_hazard, round(worst_percentile, 6) AS worst_percentile, status FROM vuln WHERE scenario_tier = 'high' AND decade = 2001")
def t2(spark, sf):
    ranked = portfolio.ranked_assets(vuln(spark, sf), "high", 2001)
    return rounded(ranked, "worst_percentile").select("asset_id", "worst_hazard", "worst_percentile", "status")


@query("t3_highest_risk_location", """
    SELECT location_id, round(avg(climate_score), 6) AS mean_score FROM scores s JOIN assets a ON s.asset_id = a.asset_id WHERE scenario_tier = 'high' AND decade = 1999
    GROUP BY 1 ORDER BY avg(climate_score) DESC, location_id LIMIT 1""")
def t3(spark, sf):
    return rounded(portfolio.highest_risk_location(scores(spark, sf), table(spark, sf, "assets"), "high", 1999), "mean_score")


@query("t8_delivery_order", "SELECT asset_id, scenario_tier, decade, climate_score FROM scores")
def t8(spark, sf):
    return sinks.score_order(scores(spark, sf)).select("asset_id", "scenario_tier", "decade", "climate_score")


# Set operations -----------------------------------------------------------------------------


@query("u1_union_layers", """
    SELECT cell_id, scenario, value, CAST(NULL AS DOUBLE) AS value_zero FROM annual UNION ALL SELECT cell_id, 'observed', NULL, value_zero FROM annual""")
def u1(spark, sf):
    a = table(spark, sf, "annual")
    one = a.select("cell_id", "scenario", "value")
    two = a.select("cell_id", F.lit("observed").alias("scenario"), "value_zero")
    return one.unionByName(two, allowMissingColumns=True)


@query("u2_intersect_decades", """
    SELECT DISTINCT decade FROM layer_values WHERE layer_id = 'L0' INTERSECT SELECT DISTINCT decade FROM layer_values WHERE layer_id = 'L4'""")
def u2(spark, sf):
    v = table(spark, sf, "layer_values")
    return delivery.common_decades(v.where("layer_id = 'L0'"), v.where("layer_id = 'L4'"))


@query("u3_members_missing", """
    WITH f AS (SELECT DISTINCT l_returnflag AS model, CAST(l_partkey AS VARCHAR) AS gcm, CASE l_linenumber % 3 WHEN 0 THEN 'ssp126' WHEN 1 THEN 'ssp370' ELSE 'ssp585' END AS scenario FROM {lineitem})
    SELECT m.model, m.gcm, s.scenario FROM (SELECT DISTINCT model, gcm FROM f) m, (SELECT DISTINCT scenario FROM f) s
    WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.model = m.model AND f.gcm = m.gcm AND f.scenario = s.scenario)""")
def u3(spark, sf):
    li = base(spark, sf, "lineitem")
    scen = F.when(F.col("l_linenumber") % 3 == 0, "ssp126").when(F.col("l_linenumber") % 3 == 1, "ssp370").otherwise("ssp585")
    f = li.select(F.col("l_returnflag").alias("model"), F.col("l_partkey").cast("string").alias("gcm"), scen.alias("scenario"))
    return delivery.members_missing(f)


@query("u3_key_differences", """
    WITH e AS (SELECT DISTINCT asset_id, layer_id FROM layer_values), h AS (SELECT asset_id, layer_id FROM layer_values WHERE decade = 2001 AND percentile IS NOT NULL)
    SELECT asset_id, layer_id, 'missing' AS side FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM h) m UNION ALL SELECT asset_id, layer_id, 'extra' FROM (SELECT * FROM h EXCEPT ALL SELECT * FROM e) x""")
def u3_keys(spark, sf):
    v = table(spark, sf, "layer_values")
    return delivery.key_differences(v.where("decade = 2001 AND percentile IS NOT NULL"), v.select("asset_id", "layer_id").distinct(), ["asset_id", "layer_id"])


@query("u4_distinct_locations", """
    WITH f AS (SELECT country AS name, round(lat, 6) AS lat, round(lon, 6) AS lon, min(site_id) AS pos FROM sites GROUP BY 1, 2, 3), k AS (SELECT *, rank() OVER (ORDER BY pos) AS n FROM f)
    SELECT 'LOC-' || CASE WHEN n < 100 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS location_id, name, lat, lon FROM k""")
def u4(spark, sf):
    s = table(spark, sf, "sites").select(F.col("country").alias("name"), "lat", F.col("lon"), F.col("site_id").alias("position"))
    return delivery.distinct_locations(s)


@query("u5_availability_matrix", """
    WITH p AS (SELECT split_part(path, '_', 1) AS model, split_part(path, '_', 2) AS gcm, split_part(path, '_', 4) AS scenario, n_bytes FROM files)
    SELECT model, gcm, count(CASE WHEN scenario = 'ssp126' THEN 1 END) AS ssp126, count(CASE WHEN scenario = 'ssp370' THEN 1 END) AS ssp370, count(CASE WHEN scenario = 'ssp585' THEN 1 END) AS ssp585,
           count(*) AS n_files, round(sum(n_bytes) / 1e6, 6) AS megabytes FROM p GROUP BY ROLLUP (model, gcm)""")
def u5(spark, sf):
    f = naming.parse_member_name(table(spark, sf, "files"))
    return rounded(delivery.availability_matrix(f, ["ssp126", "ssp370", "ssp585"]), "megabytes")


# Planning joins -----------------------------------------------------------------------------

SQL["names"] = """
    SELECT s_suppkey AS id, CASE s_suppkey % 5 WHEN 0 THEN upper(n_name) WHEN 1 THEN substr(n_name, 1, length(n_name) - 1) WHEN 2 THEN replace(n_name, 'TIO', 'XIO')
           WHEN 3 THEN concat('zz', substr(n_name, 3, 2)) ELSE substr(n_name, 4, 5) END AS name FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""


@query("j9_fuzzy_match", """
    WITH q AS (SELECT DISTINCT lower(trim(name)) AS query FROM names),
    d AS (SELECT q.query, n_name AS entry, CASE WHEN lower(n_name) = query THEN 1e0 WHEN contains(lower(n_name), query) THEN greatest(1 - levenshtein(query, lower(n_name)) / greatest(length(query), length(n_name)), 0.8e0)
            ELSE 1 - levenshtein(query, lower(n_name)) / greatest(length(query), length(n_name)) END AS score FROM q, {nation}),
    k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, entry) AS rn FROM d WHERE score >= 0.6)
    SELECT q.query, k.entry, round(k.score, 6) AS score FROM q LEFT JOIN k ON q.query = k.query AND rn = 1""")
def j9(spark, sf):
    d = base(spark, sf, "nation").select(F.col("n_name").alias("entry"))
    return rounded(delivery.fuzzy_match(table(spark, sf, "names"), d), "score")


@query("j3_extract_regions", """
    WITH q AS (SELECT DISTINCT lower(trim(name)) AS query FROM names),
    d AS (SELECT q.query, n_nationkey, n_name, CASE WHEN lower(n_name) = query THEN 1e0 WHEN contains(lower(n_name), query) THEN greatest(1 - levenshtein(query, lower(n_name)) / greatest(length(query), length(n_name)), 0.8e0)
            ELSE 1 - levenshtein(query, lower(n_name)) / greatest(length(query), length(n_name)) END AS score FROM q, {nation}),
    k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, n_name) AS rn FROM d WHERE score >= 0.6),
    w AS (SELECT b.box_id, g.cell_id, greatest(0, least(b.north, g.lat + 25e-2) - greatest(b.south, g.lat - 25e-2)) * greatest(0, least(b.east, g.lon + 25e-2) - greatest(b.west, g.lon - 25e-2)) / 25e-2 AS w FROM boxes b, grid g)
    SELECT k.query, k.n_name AS entry, round(sum(w * s.value) / sum(w), 6) AS value FROM k JOIN w ON w.box_id = k.n_nationkey AND w > 0 JOIN surface s ON s.cell_id = w.cell_id WHERE rn = 1 GROUP BY 1, 2""")
def j3(spark, sf):
    from cellcast.operators import spatial

    nation = base(spark, sf, "nation").select(F.col("n_name").alias("entry"), F.col("n_nationkey").alias("box_id"))
    return rounded(
        spatial.extract_regions(table(spark, sf, "names"), nation, table(spark, sf, "boxes"), table(spark, sf, "surface"), ["value"]), "value"
    )


@query("j10_pair_common_events", """
    WITH h AS (SELECT event_id, max(size) AS a FROM hail_hist GROUP BY 1), f AS (SELECT event_id, max(size) AS b FROM hail_fut GROUP BY 1)
    SELECT h.event_id, a AS hist_size, b AS fut_size FROM h JOIN f ON h.event_id = f.event_id""")
def j10(spark, sf):
    return delivery.pair_common_events(table(spark, sf, "hail_hist"), table(spark, sf, "hail_fut"))


@query("j10_event_eligibility", """
    WITH h AS (SELECT DISTINCT event_id FROM hail_hist), f AS (SELECT DISTINCT event_id FROM hail_fut)
    SELECT count(CASE WHEN h.event_id IS NOT NULL AND f.event_id IS NOT NULL THEN 1 END) AS paired, count(CASE WHEN f.event_id IS NULL THEN 1 END) AS only_hist,
           count(CASE WHEN h.event_id IS NULL THEN 1 END) AS only_fut FROM h FULL JOIN f ON h.event_id = f.event_id""")
def j10_eligible(spark, sf):
    return delivery.event_eligibility(table(spark, sf, "hail_hist"), table(spark, sf, "hail_fut"))


@query("j11_asset_layer_plan", """
    WITH st AS (SELECT layer_id FROM families WHERE layer_id <> 'L4'), a AS (SELECT site_id, asset_type, CASE WHEN site_id % 10 = 0 THEN 'L1; L2' END AS layers FROM sites)
    SELECT site_id AS asset_id, asset_type AS catalog_entry, l.l AS layer_id, 'row-override' AS layer_source, CAST(NULL AS VARCHAR) AS problem FROM a, (VALUES ('L1'), ('L2')) l(l) WHERE layers IS NOT NULL
    UNION ALL SELECT site_id, CASE WHEN asset_type <> 'MACHINERY' THEN lower(substr(asset_type, 1, 4)) END, st.layer_id, 'standard-set', CASE WHEN asset_type = 'MACHINERY' THEN 'unknown asset type' END FROM a, st WHERE layers IS NULL""")
def j11(spark, sf):
    s = table(spark, sf, "sites")
    aliases = s.where("asset_type <> 'MACHINERY'").select(F.col("asset_type").alias("alias"), F.lower(F.substring("asset_type", 1, 4)).alias("entry")).distinct()
    assets = s.select(F.col("site_id").alias("asset_id"), "asset_type", F.when(F.col("site_id") % 10 == 0, "L1; L2").alias("layers"))
    return delivery.asset_layer_plan(assets, aliases, table(spark, sf, "families").where("layer_id <> 'L4'"))


@query("j12_match_region_profiles", """
    WITH p AS (SELECT r_name AS profile_id, n_name AS country, r_regionkey AS rk FROM {nation} JOIN {region} ON n_regionkey = r_regionkey),
    l AS (SELECT site_id AS location_id, country, CASE WHEN site_id % 4 = 0 THEN NULL ELSE asset_type END AS state FROM sites)
    SELECT DISTINCT l.location_id, p.profile_id FROM l JOIN p ON lower(l.country) = lower(p.country) WHERE rk > 2 OR l.state IS NULL OR l.state = 'BUILDING' OR l.state = 'FURNITURE'
    UNION ALL SELECT location_id, 'OFFSHORE' FROM l WHERE state IS NULL OR state = 'HOUSEHOLD'""")
def j12(spark, sf):
    locations, profiles = _profiles(spark, sf)
    return delivery.match_region_profiles(locations, profiles)


def _profiles(spark, sf):
    n = base(spark, sf, "nation").join(base(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    states = F.when(F.first("r_regionkey") > 2, F.array().cast("array<string>")).otherwise(F.array(F.lit("Building "), F.lit("furniture")))
    profiles = n.groupBy(F.col("r_name").alias("profile_id")).agg(F.collect_list("n_name").alias("countries"), states.alias("states"))
    anywhere = spark.range(1).select(
        F.lit("OFFSHORE").alias("profile_id"), F.array().cast("array<string>").alias("countries"), F.array(F.lit("household")).alias("states")
    )
    state = F.when(F.col("site_id") % 4 == 0, F.lit(None)).otherwise(F.col("asset_type"))
    return table(spark, sf, "sites").select(F.col("site_id").alias("location_id"), "country", state.alias("state")), profiles.unionByName(anywhere)


@query("j12_uncovered_locations", """
    WITH p AS (SELECT n_name AS country, n_regionkey AS rk FROM {nation}), l AS (SELECT site_id AS location_id, country, CASE WHEN site_id % 4 = 0 THEN NULL ELSE asset_type END AS state FROM sites)
    SELECT l.location_id FROM l JOIN p ON l.country = p.country WHERE NOT (rk > 2 OR l.state IS NULL OR l.state IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD'))""")
def j12_uncovered(spark, sf):
    locations, profiles = _profiles(spark, sf)
    return delivery.uncovered_locations(locations, delivery.match_region_profiles(locations, profiles)).select("location_id")


@query("j14_align_priority_sources", """
    SELECT o.cell_id, o.member, o.day, coalesce(CASE WHEN day(o.day) <= 10 THEN o.value END, CASE WHEN o.member = 'view' THEN o.value * 2 END, c.v) AS value,
           CASE WHEN day(o.day) <= 10 THEN 0 WHEN o.member = 'view' THEN 1 ELSE 2 END AS source
    FROM observed_days o JOIN (SELECT cell_id, member, max(value) AS v FROM observed_days GROUP BY 1, 2) c ON c.cell_id = o.cell_id AND c.member = o.member""")
def j14(spark, sf):
    o = table(spark, sf, "observed_days")
    keys = ["cell_id", "member", "day"]
    top = o.groupBy("cell_id", "member").agg(F.max("value").alias("_v"))
    climatology = o.join(top, ["cell_id", "member"]).select(*keys, F.col("_v").alias("value"))
    seasonal = o.where("member = 'view'").withColumn("value", F.col("value") * 2)
    return delivery.align_priority_sources([o.where(F.dayofmonth("day") <= 10), seasonal, climatology], keys)


@query("j15_resolve_citations", """
    WITH c AS (SELECT c_custkey AS doc_id, CASE c_custkey % 4 WHEN 0 THEN 'data' WHEN 1 THEN 'data' WHEN 2 THEN 'dossier' ELSE 'data' END AS kind,
        CASE c_custkey % 4 WHEN 0 THEN concat('layers.csv#', n_name, ':units') WHEN 1 THEN concat('layers.csv#', substr(n_name, 1, 8)) WHEN 2 THEN n_name ELSE concat('other.csv#', n_name) END AS ref, n_name, c_custkey % 4 AS k
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey)
    SELECT doc_id, kind, ref, CASE WHEN k = 3 THEN 'unknown file' ELSE 'unresolved' END AS problem FROM c
    WHERE k = 3 OR (k = 1 AND substr(n_name, 1, 8) NOT IN (SELECT n_name FROM {nation})) OR (k = 2 AND n_name NOT IN (SELECT n_name FROM {nation} WHERE n_regionkey > 1))""")
def j15(spark, sf):
    n = base(spark, sf, "nation")
    c = base(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey") % 4
    cite = (
        F.when(k == 0, F.concat(F.lit("[data:layers.csv#"), "n_name", F.lit(":units]")))
        .when(k == 1, F.concat(F.lit("[data:layers.csv#"), F.substring("n_name", 1, 8), F.lit("]")))
        .when(k == 2, F.concat(F.lit("[dossier:"), "n_name", F.lit("]")))
        .otherwise(F.concat(F.lit("[data:other.csv#"), "n_name", F.lit("]")))
    )
    texts = c.select(F.col("c_custkey").alias("doc_id"), F.concat(F.lit("As shown in "), cite, F.lit(" above.")).alias("text"))
    targets = n.select(F.lit("layers.csv").alias("target"), F.col("n_name").alias("key")).unionByName(
        n.where("n_regionkey > 1").select(F.lit("dossier").alias("target"), F.col("n_name").alias("key"))
    )
    return delivery.resolve_citations(texts, targets, ["layers.csv"])
