"""Windows, masks, decadal statistics, slopes and ranks on the member series."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellcast.operators import decadal, filters, ranks
from cellcast.operators.ranking import exact_quantiles
from cellcast.plans import layer
from querybook.common import rounded
from querybook.registry import query
from querybook.standins import BASELINE, DECADES, SQL, WINDOW, base, table

# SQL building blocks ------------------------------------------------------------------------

SQL["pool"] = """
    SELECT *, CAST(CASE WHEN year BETWEEN 1995 AND 1996 THEN 1995 WHEN year BETWEEN 1997 AND 1998 THEN 1997
                        WHEN year BETWEEN 1999 AND 2000 THEN 1999 WHEN year BETWEEN 2001 AND 2002 THEN 2001 END AS INT) AS decade
    FROM annual WHERE year BETWEEN 1995 AND 2002"""
SQL["stack"] = """
    SELECT a.*, d.decade FROM annual a JOIN (VALUES (1997), (1999), (2001)) d(decade) ON a.year BETWEEN 1995 AND d.decade + 1"""
SQL["base_median"] = """
    SELECT cell_id, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.25) AS lower_ci,
           quantile_cont(value, 0.75) AS upper_ci
    FROM pool WHERE decade = 1995 GROUP BY cell_id"""
SQL["panel"] = """
    SELECT scenario, decade, cell_id, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.25) AS lower_ci,
           quantile_cont(value, 0.75) AS upper_ci
    FROM pool WHERE decade > 1995 GROUP BY 1, 2, 3
    UNION ALL SELECT s.scenario, 1995, b.* FROM base_median b, (SELECT DISTINCT scenario FROM annual) s"""
SQL["base_zero"] = """
    SELECT cell_id, quantile_cont(value_zero, 0.5) AS median FROM pool WHERE decade = 1995 GROUP BY cell_id"""
SQL["panel_zero"] = """
    SELECT scenario, decade, cell_id, quantile_cont(value_zero, 0.5) AS median
    FROM pool WHERE decade > 1995 GROUP BY 1, 2, 3
    UNION ALL SELECT s.scenario, 1995, b.* FROM base_zero b, (SELECT DISTINCT scenario FROM annual) s"""
SQL["pair_slopes"] = """
    SELECT a.scenario, a.decade, a.cell_id, (b.value - a.value) / (b.year - a.year) AS slope
    FROM stack a JOIN stack b ON a.scenario = b.scenario AND a.cell_id = b.cell_id AND a.decade = b.decade AND a.year < b.year"""
SQL["slope_table"] = """
    SELECT o.*, s.sen_slope FROM (
        SELECT scenario, decade, cell_id, CASE WHEN count(value) >= 3 AND min(year) < max(year)
               THEN regr_slope(value, year) END AS ols_slope FROM stack GROUP BY 1, 2, 3) o
    LEFT JOIN (SELECT scenario, decade, cell_id, quantile_cont(slope, 0.5) AS sen_slope FROM pair_slopes GROUP BY 1, 2, 3) s
      USING (scenario, decade, cell_id)"""


def annual_panel(spark, sf, value="value"):
    """Median panel with the shared baseline, as the rank queries use it."""
    a = table(spark, sf, "annual")
    stats = decadal.pooled_decadal_stat(a, DECADES[1:], WINDOW, value=value)
    b = decadal.shared_baseline(a, BASELINE, "pool_all", WINDOW, value=value)
    spread = decadal.spread_to_scenarios(b, a.select("scenario").distinct())
    return stats.unionByName(spread.select(stats.columns)), b


@query("p1_in_window", """
    SELECT scenario, sum(CASE WHEN year BETWEEN 1997 AND 1998 THEN 1 ELSE 0 END) AS n_window,
           sum(CASE WHEN year BETWEEN 1995 AND 1998 THEN 1 ELSE 0 END) AS n_expanding FROM annual GROUP BY scenario""")
def p1(spark, sf):
    return table(spark, sf, "annual").groupBy("scenario").agg(
        F.count_if(filters.in_window("year", 1997, WINDOW)).alias("n_window"),
        F.count_if(filters.in_window("year", 1997, WINDOW, baseline=BASELINE)).alias("n_expanding"),
    )


@query("p2_is_boolean_field", """
    SELECT 'value' AS field, coalesce(bool_and(value IN (0, 1)), false) AS is_boolean FROM annual
    UNION ALL SELECT 'value_bool', coalesce(bool_and(value_bool IN (0, 1)), false) FROM annual
    UNION ALL SELECT 'value_zero', coalesce(bool_and(value_zero IN (0, 1)), false) FROM annual""")
def p2(spark, sf):
    a = table(spark, sf, "annual")
    long = a.unpivot([], ["value", "value_bool", "value_zero"], "field", "v")
    return filters.is_boolean_field(long, "v", ["field"])


@query("p3_apply_mask", """
    SELECT 'land' AS side, scenario, count(*) AS n, sum(value_zero) AS total FROM annual WHERE cell_id IN (SELECT cell_id FROM land) GROUP BY scenario
    UNION ALL SELECT 'ocean', scenario, count(*), sum(value_zero) FROM annual WHERE cell_id NOT IN (SELECT cell_id FROM land) GROUP BY scenario""")
def p3(spark, sf):
    a, land = table(spark, sf, "annual"), table(spark, sf, "land")
    parts = [
        filters.apply_mask(a, land, invert=inv)
        .groupBy("scenario")
        .agg(F.count("*").alias("n"), F.sum("value_zero").alias("total"))
        .withColumn("side", F.lit(side))
        for side, inv in (("land", False), ("ocean", True))
    ]
    return parts[0].unionByName(parts[1])


@query("p4_mask_structural_zeros", """
    SELECT a.cell_id, a.member, sum(CASE WHEN f.ever THEN value_zero END) AS total, count(CASE WHEN f.ever THEN value_zero END) AS n
    FROM annual a JOIN (SELECT member, cell_id, bool_or(value_zero > 40) AS ever FROM annual GROUP BY 1, 2) f
      ON a.member = f.member AND a.cell_id = f.cell_id GROUP BY 1, 2""")
def p4(spark, sf):
    a = table(spark, sf, "annual").withColumn("excess", F.greatest(F.col("value_zero") - 40, F.lit(0.0)))
    masked = filters.mask_structural_zeros(a, "excess")
    kept = F.when(F.col("excess").isNotNull(), F.col("value_zero"))
    return masked.groupBy("cell_id", "member").agg(F.sum(kept).alias("total"), F.count(kept).alias("n"))


@query("p5_min_models_rule", """
    SELECT cell_id, scenario, count(*) AS n FROM annual
    WHERE cell_id IN (SELECT cell_id FROM annual WHERE value_zero > 60 GROUP BY cell_id HAVING count(DISTINCT model) >= 3)
    GROUP BY 1, 2""")
def p5(spark, sf):
    a = table(spark, sf, "annual").withColumn("high", F.when(F.col("value_zero") > 60, F.col("value_zero")))
    return filters.min_models_rule(a, 3, "high").groupBy("cell_id", "scenario").agg(F.count("*").alias("n"))


@query("p6_always_at_bound", """
    SELECT cell_id, 'published' AS status FROM (SELECT cell_id FROM annual WHERE value_null IS NOT NULL GROUP BY cell_id
        HAVING count(DISTINCT member) = (SELECT count(DISTINCT member) FROM annual)) c
    WHERE cell_id NOT IN (SELECT cell_id FROM annual GROUP BY cell_id HAVING bool_and(coalesce(value_null, 0) >= 2))
    UNION ALL SELECT cell_id, 'permanent' FROM annual GROUP BY cell_id HAVING bool_and(coalesce(value, 0) >= 6)""")
def p6(spark, sf):
    a = table(spark, sf, "annual")
    shown = filters.published_cells(a, 2.0, "value_null").withColumn("status", F.lit("published"))
    wet = filters.always_at_bound(a, 6.0, "value").withColumn("status", F.lit("permanent"))
    return shown.unionByName(wet)


@query("p7_presence_mask", """
    WITH cover AS (SELECT cell_id, member, max(value_zero) AS cover FROM annual GROUP BY 1, 2),
    share AS (SELECT cell_id, member, cover / CASE WHEN (SELECT max(cover) FROM cover) > 1.5 THEN 100e0 ELSE 1e0 END AS share FROM cover)
    SELECT a.cell_id, round(avg(CASE WHEN share >= 0.5 THEN value / share END), 6) AS divided,
           round(avg(CASE WHEN share >= 0.5 THEN value END), 6) AS masked
    FROM annual a JOIN share s ON a.cell_id = s.cell_id AND a.member = s.member GROUP BY 1""")
def p7(spark, sf):
    a = table(spark, sf, "annual")
    cover = a.groupBy("cell_id", "member").agg(F.max("value_zero").alias("cover"))
    keys = ["cell_id", "member"]
    both = a.withColumn("masked", F.col("value"))
    one = filters.presence_mask(both, cover, keys, "value", 0.5, "divide")
    two = filters.presence_mask(one, cover, keys, "masked", 0.5, "mask")
    return rounded(two.groupBy("cell_id").agg(F.avg("value").alias("divided"), F.avg("masked").alias("masked")), "divided", "masked")


@query("p8_normalize_by_capacity", """
    WITH v AS (SELECT s_suppkey AS id, CASE WHEN s_acctbal > 7000 THEN 7e3 ELSE s_acctbal END AS depth FROM {supplier}),
    cut AS (SELECT quantile_cont(depth, 0.99) AS c FROM v),
    modes AS (SELECT round(depth, 4) AS r, count(*) AS n FROM v, cut WHERE depth >= c GROUP BY 1),
    cap AS (SELECT r FROM modes ORDER BY n DESC, r LIMIT 1)
    SELECT id, round(greatest(0, least(1, depth / r)), 6) AS share FROM v, cap""")
def p8(spark, sf):
    v = base(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.least("s_acctbal", F.lit(7000.0)).alias("value")
    )
    return filters.normalize_by_capacity(v).select("id", F.round("value", 6).alias("share"))


@query("p9_baseline_subject_mask", """
    SELECT member, cell_id FROM (SELECT scenario, member, cell_id, max(value) AS m FROM pool WHERE decade = 1995 GROUP BY 1, 2, 3) t
    GROUP BY 1, 2 HAVING bool_or(m < 30 * (1 - 1e-4))""")
def p9(spark, sf):
    return filters.baseline_subjects(table(spark, sf, "annual"), BASELINE, WINDOW, 30.0)


@query("p10_member_river_mask", """
    SELECT member, cell_id FROM pool WHERE decade = 1995 GROUP BY 1, 2 HAVING avg(value) > 25.5""")
def p10(spark, sf):
    return filters.member_river_mask(table(spark, sf, "annual"), 25.5, BASELINE, WINDOW)


@query("p11_drop_negative", """
    SELECT c_nationkey AS nation, sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS n_negative,
           round(sum(CASE WHEN c_acctbal >= 0 THEN c_acctbal END), 2) AS kept FROM {customer} GROUP BY 1""")
def p11(spark, sf):
    from cellcast.sources.missing import drop_negative

    cleaned = drop_negative(base(spark, sf, "customer"), "c_acctbal")
    return cleaned.groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count_if("was_negative").alias("n_negative"), F.round(F.sum("c_acctbal"), 2).alias("kept")
    )


@query("p12_clip_ci", """
    SELECT scenario, decade, cell_id, round(greatest(avg(value) - stddev_pop(value), 12), 6) AS lower_ci,
           round(least(avg(value) + stddev_pop(value), 37), 6) AS upper_ci FROM pool GROUP BY 1, 2, 3""")
def p12(spark, sf):
    p = decadal.pooled_decadal_stat(table(spark, sf, "annual"), DECADES, WINDOW, "mean")
    return rounded(filters.clip_ci(p, 12.0, 37.0), "lower_ci", "upper_ci").drop("median")


@query("p13_unit_convert", """
    SELECT l_suppkey AS cell_id, round(sum(l_quantity * 864e2), 2) AS mm,
           round(sum(l_quantity * (l_extendedprice * 1e6) * (l_tax * 1000 / 100e0) * 864e2 / 1000e0) / 1e12, 4) AS volume
    FROM {lineitem} GROUP BY 1""")
def p13(spark, sf):
    li = base(spark, sf, "lineitem").withColumns(
        {"land_percent": F.col("l_tax") * 1000, "seconds": F.lit(86400.0)}
    )
    volume = filters.flux_to_volume("l_quantity", "l_extendedprice", "land_percent", "seconds")
    return li.groupBy(F.col("l_suppkey").alias("cell_id")).agg(
        F.round(F.sum(filters.unit_convert("l_quantity", 86400.0)), 2).alias("mm"),
        F.round(F.sum(volume) / 1e12, 4).alias("volume"),
    )


@query("p14_measured_scale", """
    SELECT member, round(avg(CASE WHEN (SELECT avg(value + 250) FROM daily WHERE day = (SELECT min(day) FROM daily)) > 100
           THEN value + 250 - 273.15 ELSE value + 250 END), 6) AS mean_value FROM daily GROUP BY member""")
def p14(spark, sf):
    from querybook.standins import daily

    raw = daily(spark, sf).withColumn("value", F.col("value") + 250)
    scaled = filters.measured_scale(raw, "value", "day", 100.0, offset=-273.15)
    return scaled.groupBy("member").agg(F.round(F.avg("value"), 6).alias("mean_value"))


@query("p15_standard_set", """
    SELECT layer_key, layer_id FROM layer_registry r WHERE status IN ('preferred', 'alternate') AND reviewed_on IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM layer_registry x WHERE x.layer_id = r.layer_id AND x.brand = 'Brand#11')""")
def p15(spark, sf):
    reg = table(spark, sf, "layer_registry")
    return filters.standard_set(reg, reg.where("brand = 'Brand#11'")).select("layer_key", "layer_id")


@query("p16_decade_policy", """
    SELECT asset_id, layer_id, scenario, decade, round(value, 6) AS value FROM (
      SELECT v.asset_id, v.layer_id, v.scenario, v.value, CASE WHEN m.latest >= 1997 THEN v.decade ELSE 1997 END AS decade,
             m.latest, v.decade AS d0
      FROM layer_values v JOIN (SELECT layer_id, max(decade) AS latest FROM layer_values GROUP BY 1) m ON v.layer_id = m.layer_id) t
    WHERE (latest >= 1997 AND d0 >= 1997) OR (latest < 1997 AND d0 = latest)""")
def p16(spark, sf):
    kept = filters.decade_policy(table(spark, sf, "layer_values"), 1997)
    return rounded(kept, "value").select("asset_id", "layer_id", "scenario", "decade", "value")


@query("p17_mask_slopes_to_panel", """
    SELECT s.scenario, s.decade, s.cell_id, round(CASE WHEN p.median > 20 THEN ols_slope END, 6) AS ols_slope,
           round(CASE WHEN p.median > 20 THEN sen_slope END, 6) AS sen_slope
    FROM slope_table s JOIN panel p ON s.scenario = p.scenario AND s.decade = p.decade AND s.cell_id = p.cell_id""")
def p17(spark, sf):
    panel, _ = annual_panel(spark, sf)
    panel = panel.withColumn("median", F.when(F.col("median") > 20, F.col("median")))
    trend = decadal.slopes(table(spark, sf, "annual"), DECADES, BASELINE, WINDOW)
    joined = trend.join(panel.select("scenario", "decade", "cell_id", "median"), ["scenario", "decade", "cell_id"])
    return rounded(filters.mask_slopes_to_panel(joined), "ols_slope", "sen_slope").drop("median")


@query("p18_recode_tier", """
    SELECT asset_id, CASE scenario WHEN 'ssp126' THEN 'low' WHEN 'ssp370' THEN 'medium' WHEN 'ssp245' THEN 'medium' WHEN 'ssp585' THEN 'high' END AS tier,
           scenario <> 'observed' AS forcing, count(*) AS n FROM layer_values GROUP BY 1, 2, 3""")
def p18(spark, sf):
    from cellcast.functions.scalar import is_forcing, tier_of

    v = table(spark, sf, "layer_values")
    return v.groupBy("asset_id", tier_of("scenario").alias("tier"), is_forcing("scenario").alias("forcing")).agg(
        F.count("*").alias("n")
    )


# Decadal statistics -------------------------------------------------------------------------


@query("a1_pooled_decadal_stat", """
    SELECT scenario, decade, cell_id, round(quantile_cont(value_null, 0.5), 6) AS median, round(quantile_cont(value_null, 0.25), 6) AS lower_ci,
           round(quantile_cont(value_null, 0.75), 6) AS upper_ci FROM pool GROUP BY 1, 2, 3""")
def a1(spark, sf):
    p = decadal.pooled_decadal_stat(table(spark, sf, "annual"), DECADES, WINDOW, value="value_null")
    return rounded(p, "median", "lower_ci", "upper_ci")


@query("a1_pooled_mean_branch", """
    SELECT scenario, decade, cell_id, round(avg(value_bool), 6) AS median, round(avg(value_bool) - stddev_pop(value_bool), 6) AS lower_ci,
           round(avg(value_bool) + stddev_pop(value_bool), 6) AS upper_ci FROM pool GROUP BY 1, 2, 3""")
def a1b(spark, sf):
    p = decadal.pooled_decadal_stat(table(spark, sf, "annual"), DECADES, WINDOW, "mean", "value_bool")
    return rounded(p, "median", "lower_ci", "upper_ci")


@query("a2_choose_central", """
    WITH c AS (SELECT cell_id, quantile_cont(value_zero, 0.5) AS med, avg(value_zero) AS mean, count(value_zero) AS n,
                      sum(CASE WHEN value_zero = 0 THEN 1 ELSE 0 END) AS zero, bool_and(value_zero IN (0, 1)) AS b
               FROM annual WHERE year BETWEEN 1995 AND 1996 GROUP BY cell_id),
    s AS (SELECT sum(zero) / sum(n) AS zero_share, sum(CASE WHEN med > 0 THEN 1 ELSE 0 END) AS em,
                 sum(CASE WHEN mean > 0 THEN 1 ELSE 0 END) AS ea, bool_and(b) AS b FROM c)
    SELECT round(zero_share, 6) AS zero_share, em AS exposed_median, ea AS exposed_mean, round(1 - em / ea, 6) AS erased_share,
           b AS is_boolean, CASE WHEN b OR 1 - em / ea > 0.5 THEN 'mean' ELSE 'median' END AS central FROM s""")
def a2(spark, sf):
    pool = table(spark, sf, "annual").where(filters.in_window("year", BASELINE, WINDOW))
    return rounded(decadal.choose_central(pool, "value_zero"), "zero_share", "erased_share")


@query("a3_shared_baseline", """
    SELECT 'pool_all' AS mode, cell_id, round(median, 6) AS median, round(lower_ci, 6) AS lower_ci, round(upper_ci, 6) AS upper_ci FROM base_median
    UNION ALL SELECT 'member_mean_first', cell_id, round(quantile_cont(v, 0.5), 6), round(quantile_cont(v, 0.25), 6), round(quantile_cont(v, 0.75), 6)
    FROM (SELECT member, cell_id, year, avg(value) AS v FROM pool WHERE decade = 1995 GROUP BY 1, 2, 3) m GROUP BY cell_id""")
def a3(spark, sf):
    a = table(spark, sf, "annual")
    parts = [
        decadal.shared_baseline(a, BASELINE, mode, WINDOW).withColumn("mode", F.lit(mode)).drop("decade")
        for mode in ("pool_all", "member_mean_first")
    ]
    return rounded(parts[0].unionByName(parts[1]), "median", "lower_ci", "upper_ci")


@query("a4_ols_slope", "SELECT scenario, decade, cell_id, round(ols_slope, 6) AS ols_slope FROM slope_table")
def a4(spark, sf):
    return rounded(decadal.ols_slope(table(spark, sf, "annual"), DECADES, BASELINE, WINDOW), "ols_slope")


@query("a5_sen_slope", "SELECT scenario, decade, cell_id, round(sen_slope, 6) AS sen_slope FROM slope_table")
def a5(spark, sf):
    return rounded(decadal.sen_slope(table(spark, sf, "annual"), DECADES, BASELINE, WINDOW), "sen_slope")


@query("a6_ensemble_depth", """
    SELECT scenario, decade, cell_id, nullif(count(DISTINCT CASE WHEN value_null IS NOT NULL THEN member END), 0) AS n_members,
           nullif(count(DISTINCT CASE WHEN value_null IS NOT NULL THEN model END), 0) AS n_models FROM pool GROUP BY 1, 2, 3""")
def a6(spark, sf):
    return decadal.ensemble_depth(table(spark, sf, "annual"), DECADES, WINDOW, "value_null")


@query("a35_two_stage_stat", """
    WITH y AS (SELECT scenario, cell_id, decade, year, avg(value) AS v FROM pool GROUP BY 1, 2, 3, 4),
    m AS (SELECT scenario, cell_id, decade, member, avg(value) AS v FROM pool GROUP BY 1, 2, 3, 4)
    SELECT 'models_then_years' AS form, scenario, cell_id, decade, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.25), 6) AS lower_ci,
           round(quantile_cont(v, 0.75), 6) AS upper_ci FROM y GROUP BY 1, 2, 3, 4
    UNION ALL SELECT 'years_then_members', scenario, cell_id, decade, round(avg(v), 6), round(avg(v) - stddev_pop(v), 6), round(avg(v) + stddev_pop(v), 6)
    FROM m GROUP BY 1, 2, 3, 4""")
def a35(spark, sf):
    a = table(spark, sf, "annual")
    parts = [
        decadal.two_stage_stat(a, DECADES, form, WINDOW).withColumn("form", F.lit(form))
        for form in ("models_then_years", "years_then_members")
    ]
    return rounded(parts[0].unionByName(parts[1]), "median", "lower_ci", "upper_ci")


@query("a38_per_member_trend", """
    WITH y AS (SELECT cell_id, member, year, avg(value) AS v FROM annual GROUP BY 1, 2, 3),
    rk AS (SELECT cell_id, member, year, row_number() OVER (PARTITION BY cell_id, member ORDER BY year) AS t,
                  rank() OVER (PARTITION BY cell_id, member ORDER BY v) + (count(*) OVER (PARTITION BY cell_id, member, v) - 1) / 2e0 AS r FROM y),
    rho AS (SELECT cell_id, member, count(*) AS n, corr(t, r) AS rho FROM rk GROUP BY 1, 2 HAVING count(*) >= 3),
    sl AS (SELECT a.cell_id, a.member, quantile_cont((b.v - a.v) / (b.year - a.year), 0.5) AS slope
           FROM y a JOIN y b ON a.cell_id = b.cell_id AND a.member = b.member AND a.year < b.year GROUP BY 1, 2)
    SELECT cell_id, round(quantile_cont(slope, 0.5), 6) AS slope, round(quantile_cont(rho, 0.5), 6) AS rho, count(*) AS n_members
    FROM rho JOIN sl USING (cell_id, member) GROUP BY 1""")
def a38(spark, sf):
    return rounded(decadal.per_member_trend(table(spark, sf, "annual")), "slope", "rho")


@query("w15_anchored_trend", """
    SELECT p.scenario, p.decade, p.cell_id, round(CASE WHEN p.decade = 1995 THEN 0 ELSE (p.median - b.median) / (p.decade - 1995) END, 6) AS trend
    FROM panel p JOIN base_median b ON p.cell_id = b.cell_id""")
def w15(spark, sf):
    panel, _ = annual_panel(spark, sf)
    return rounded(decadal.anchored_trend(panel, BASELINE), "trend").select("scenario", "decade", "cell_id", "trend")


# Ranks --------------------------------------------------------------------------------------

RANK_ONE = """
    SELECT p.scenario, p.decade, p.cell_id,
           round(greatest(1, least(100, 100.0 * (SELECT count(*) FROM base_median b WHERE b.median {op} p.median) / (SELECT count(*) FROM base_median))), 6) AS percentile
    FROM panel p"""


@query("w1_percentile_of_score", RANK_ONE.replace("{op}", "<="))
def w1(spark, sf):
    panel, b = annual_panel(spark, sf)
    return rounded(ranks.percentile_of_score(panel, b), "percentile").select("scenario", "decade", "cell_id", "percentile")


@query("w1_percentile_left", RANK_ONE.replace("{op}", "<"))
def w1_left(spark, sf):
    panel, b = annual_panel(spark, sf)
    ranked = ranks.percentile_of_score(panel, b, side="left")
    return rounded(ranked, "percentile").select("scenario", "decade", "cell_id", "percentile")


def _two_tier_sql(op, body):
    return f"""
    WITH z AS (SELECT avg(CASE WHEN median = 0 THEN 1e0 ELSE 0e0 END) AS share FROM base_zero),
    raw AS (SELECT p.scenario, p.decade, p.cell_id, CASE WHEN (SELECT share FROM z) >= 0.02 THEN
        CASE WHEN p.median > 0 THEN greatest(2, least(100, 2 + 98.0 * (SELECT count(*) FROM base_zero b WHERE b.median > 0 AND b.median {op} p.median)
             / (SELECT count(*) FROM base_zero WHERE median > 0))) ELSE 1 END
        ELSE greatest(1, least(100, 100.0 * (SELECT count(*) FROM base_zero b WHERE b.median <= p.median) / (SELECT count(*) FROM base_zero))) END AS pct
      FROM panel_zero p)
    SELECT scenario, decade, cell_id, round({body}, 6) AS percentile FROM raw"""


@query("w2_two_tier_right", _two_tier_sql("<=", "pct"))
def w2(spark, sf):
    panel, b = annual_panel(spark, sf, "value_zero")
    return rounded(ranks.two_tier_percentile(panel, b), "percentile").select("scenario", "decade", "cell_id", "percentile")


@query("w2_two_tier_left", _two_tier_sql("<", "pct"))
def w2_left(spark, sf):
    panel, b = annual_panel(spark, sf, "value_zero")
    ranked = ranks.two_tier_percentile(panel, b, side="left")
    return rounded(ranked, "percentile").select("scenario", "decade", "cell_id", "percentile")


@query("w3_inverted_percentile", _two_tier_sql("<=", "greatest(1, least(100, 101 - pct))"))
def w3(spark, sf):
    panel, b = annual_panel(spark, sf, "value_zero")
    ranked = ranks.two_tier_percentile(panel, b, higher_is_better=True)
    return rounded(ranked, "percentile").select("scenario", "decade", "cell_id", "percentile")


@query("w4_stress_percentile", """
    WITH z AS (SELECT avg(CASE WHEN median = 0 THEN 1e0 ELSE 0e0 END) AS share FROM base_zero)
    SELECT p.scenario, p.decade, p.cell_id, round(CASE WHEN (SELECT share FROM z) > 0.02 THEN
        CASE WHEN p.median = 0 THEN 1 ELSE 1 + 99.0 * (SELECT count(*) FROM base_zero b WHERE b.median > 0 AND b.median < p.median)
             / (SELECT count(*) FROM base_zero WHERE median > 0) END
        ELSE 100.0 * (SELECT count(*) FROM base_zero b WHERE b.median < p.median) / (SELECT count(*) FROM base_zero) END, 6) AS percentile
    FROM panel_zero p""")
def w4(spark, sf):
    panel, b = annual_panel(spark, sf, "value_zero")
    return rounded(ranks.stress_percentile(panel, b), "percentile").select("scenario", "decade", "cell_id", "percentile")


RATES = """SELECT l_suppkey AS cell_id, sum(CASE WHEN l_discount >= 0.095 AND l_quantity > 42 THEN 1 ELSE 0 END) AS n_events, count(*) AS n_all FROM {lineitem} GROUP BY 1"""


@query("w5_observed_rate_rank", f"""
    WITH t AS ({RATES}), r AS (SELECT *, CAST(n_events AS DOUBLE) AS rate FROM t),
    k AS (SELECT cell_id, rank() OVER (ORDER BY rate) + (count(*) OVER (PARTITION BY rate) - 1) / 2e0 AS rk, count(*) OVER () AS n FROM r WHERE n_events > 0)
    SELECT r.cell_id, round(CASE WHEN n_events = 0 THEN 1 WHEN n = 1 THEN 100 ELSE 2 + 98.0 * (rk - 1) / (n - 1) END, 6) AS ends,
           round(CASE WHEN n_events = 0 THEN 1 ELSE 2 + 98.0 * (rk - 0.5) / n END, 6) AS mid
    FROM r LEFT JOIN k ON r.cell_id = k.cell_id""")
def w5(spark, sf):
    li = base(spark, sf, "lineitem")
    hit = (F.col("l_discount") >= 0.095) & (F.col("l_quantity") > 42)
    r = li.groupBy(F.col("l_suppkey").alias("cell_id")).agg(F.count_if(hit).alias("n_events"))
    r = r.withColumn("rate", F.col("n_events").cast("double"))
    ends = ranks.observed_rate_rank(r).select("cell_id", F.round("percentile", 6).alias("ends"))
    mid = ranks.observed_rate_rank(r, form="mid").select("cell_id", F.round("percentile", 6).alias("mid"))
    return ends.join(mid, "cell_id")


@query("w1_exact_quantiles_by_key", """
    SELECT l_returnflag, l_linestatus, q, round(CASE q WHEN 0.01 THEN a WHEN 0.5 THEN b ELSE c END, 4) AS quantile FROM (
      SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.01) AS a, quantile_cont(l_extendedprice, 0.5) AS b,
             quantile_cont(l_extendedprice, 0.95) AS c FROM {lineitem} GROUP BY 1, 2) t, (VALUES (1e-2), (5e-1), (95e-2)) v(q)""")
def w1_quantiles(spark, sf):
    li = base(spark, sf, "lineitem")
    return rounded(exact_quantiles(li, "l_extendedprice", [0.01, 0.5, 0.95], ["l_returnflag", "l_linestatus"]), "quantile", n=4)


# The layer job ------------------------------------------------------------------------------

SPEC = layer.LayerSpec(decades=DECADES, baseline=BASELINE, window=WINDOW, ci_floor=0.0, ci_cap=50.0)

SQL["built_layer"] = """
    SELECT p.scenario, p.decade, p.cell_id, p.median, greatest(p.lower_ci, 0) AS lower_ci, least(p.upper_ci, 50) AS upper_ci,
           greatest(1, least(100, 100.0 * (SELECT count(*) FROM base_median b WHERE b.median <= p.median) / (SELECT count(*) FROM base_median))) AS percentile,
           10 * s.ols_slope AS ols_slope, 10 * s.sen_slope AS sen_slope, d.n_members, d.n_models
    FROM panel p LEFT JOIN slope_table s ON s.scenario = p.scenario AND s.decade = p.decade AND s.cell_id = p.cell_id
    LEFT JOIN (SELECT scenario, decade, cell_id, count(DISTINCT member) AS n_members, count(DISTINCT model) AS n_models FROM pool GROUP BY 1, 2, 3) d
      ON d.scenario = p.scenario AND d.decade = p.decade AND d.cell_id = p.cell_id"""
LAYER_FLOATS = ["median", "lower_ci", "upper_ci", "percentile", "ols_slope", "sen_slope"]
LAYER_ROUNDED = "scenario, decade, cell_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in LAYER_FLOATS)


def built_layer(spark, sf):
    return layer.build_layer(table(spark, sf, "annual"), SPEC)


@query("h1_build_layer", f"SELECT {LAYER_ROUNDED}, n_members, n_models FROM built_layer")
def h1(spark, sf):
    return rounded(built_layer(spark, sf), *LAYER_FLOATS)


@query("s12_member_baselines", """
    SELECT member, cell_id, round(avg(value), 6) AS baseline_mean FROM pool WHERE decade = 1995 GROUP BY 1, 2""")
def s12(spark, sf):
    return rounded(layer.member_baselines(table(spark, sf, "annual"), BASELINE, WINDOW), "baseline_mean")
