"""Event, coastal, graph, comparison and hydrology queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellcast.functions.scalar import cell_area_km2
from cellcast.operators import compare, events, graph, hydrology
from querybook.common import gamma_quantiles_sql, rounded
from querybook.registry import query
from querybook.standins import SQL, base, daily, table

KE = "CASE WHEN {d} < 22.1 THEN 0.0107e0 * pow({d} / 10, 4.59e0) ELSE 0.0243e0 * pow({d} / 10, 3.5e0) END"


@query("a15_ratio_of_sums", f"""
    WITH s AS (SELECT event_id % 200 AS cell_id, event_id, sum(CASE WHEN landed > 0 THEN landed END) AS sd, sum(CASE WHEN landed > 0 THEN {KE.format(d='landed')} END) AS ske, count(CASE WHEN landed > 0 THEN 1 END) AS nl, count(*) AS ne FROM hail_hist GROUP BY 1, 2)
    SELECT cell_id, round(coalesce(sum(sd), 0) / nullif(sum(nl), 0), 6) AS mean_diameter, round(coalesce(sum(ske), 0) / nullif(sum(nl), 0), 6) AS mean_ke, round(sum(nl) / sum(ne), 6) AS production,
           round(coalesce(sum(ske), 0) / sum(ne), 6) AS ake, round(avg(sd / nullif(nl, 0)), 6) AS storm_mean_diameter, round(avg(ske / nullif(nl, 0)), 6) AS storm_mean_ke FROM s GROUP BY 1""")
def a15(spark, sf):
    stones = table(spark, sf, "hail_hist").withColumn("cell_id", F.col("event_id") % 200)
    return rounded(events.ratio_of_sums(stones, ["cell_id"]), "mean_diameter", "mean_ke", "production", "ake", "storm_mean_diameter", "storm_mean_ke")


@query("a16_ensemble_change", """
    WITH h AS (SELECT cell_id, member, avg(value) AS v FROM annual WHERE year <= 1997 GROUP BY 1, 2), f AS (SELECT cell_id, member, avg(value) AS v FROM annual WHERE year > 1997 GROUP BY 1, 2)
    SELECT h.cell_id, round(quantile_cont(100 * (f.v / h.v - 1), 0.5), 6) AS change_pct, round(min(100 * (f.v / h.v - 1)), 6) AS change_low, round(max(100 * (f.v / h.v - 1)), 6) AS change_high
    FROM h JOIN f ON h.cell_id = f.cell_id AND h.member = f.member GROUP BY 1""")
def a16(spark, sf):
    a = table(spark, sf, "annual")
    mean = lambda cond: a.where(cond).groupBy("cell_id", "member").agg(F.avg("value").alias("v"))
    return rounded(events.ensemble_change(mean("year <= 1997"), mean("year > 1997"), ["cell_id"], "v"), "change_pct", "change_low", "change_high")


@query("a17_event_estimands", f"""
    WITH h AS (SELECT event_id, max(landed) AS m, count(*) AS n, count(CASE WHEN landed = 0 THEN 1 END) AS z, count(CASE WHEN landed > 0 THEN 1 END) AS p, count(CASE WHEN landed >= 30 THEN 1 END) AS b, coalesce(sum(CASE WHEN landed > 0 THEN {KE.format(d='landed')} END), 0) AS k FROM hail_hist GROUP BY 1),
    f AS (SELECT event_id, max(landed) AS m, count(*) AS n, count(CASE WHEN landed = 0 THEN 1 END) AS z, count(CASE WHEN landed > 0 THEN 1 END) AS p, count(CASE WHEN landed >= 30 THEN 1 END) AS b, coalesce(sum(CASE WHEN landed > 0 THEN {KE.format(d='landed')} END), 0) AS k FROM hail_fut GROUP BY 1)
    SELECT count(*) AS n_paired_events, round(sum(h.z) / sum(h.n), 6) AS embryo_melted_share_hist, round(sum(h.b) / sum(h.n), 6) AS embryo_share_ge30_hist, round(sum(h.b) / sum(h.p), 6) AS produced_share_ge30_hist,
      round(avg(CASE WHEN h.m >= 30 THEN 1e0 ELSE 0e0 END), 6) AS event_share_ge30_hist, round(avg(h.k / h.n), 6) AS ake_hist_j, round(sum(f.z) / sum(f.n), 6) AS embryo_melted_share_fut,
      round(sum(f.b) / sum(f.n), 6) AS embryo_share_ge30_fut, round(sum(f.b) / sum(f.p), 6) AS produced_share_ge30_fut, round(avg(CASE WHEN f.m >= 30 THEN 1e0 ELSE 0e0 END), 6) AS event_share_ge30_fut, round(avg(f.k / f.n), 6) AS ake_fut_j,
      round(avg(f.m - h.m), 6) AS paired_mhd_delta_mean, round(avg(CASE WHEN f.m > h.m THEN 1e0 ELSE 0e0 END), 6) AS paired_share_increasing, quantile_cont(h.m, 0.5) AS event_mhd_median_hist, quantile_cont(f.m, 0.5) AS event_mhd_median_fut, quantile_cont(f.m - h.m, 0.5) AS paired_mhd_delta_median
    FROM h JOIN f ON h.event_id = f.event_id""")
def a17(spark, sf):
    out = events.event_estimands(table(spark, sf, "hail_hist"), table(spark, sf, "hail_fut"))
    return rounded(out, *[c for c in out.columns if c != "n_paired_events" and "median" not in c])


def _rates(spark, sf):
    li = base(spark, sf, "lineitem")
    hit = (F.col("l_discount") >= 0.095) & (F.col("l_quantity") > 42)
    k = li.groupBy(F.col("l_suppkey").alias("cell_id")).agg(F.count_if(hit).alias("n_events"))
    g = table(spark, sf, "grid").select("cell_id", (cell_area_km2("lat") / 1e4 * 7).alias("exposure"))
    return k.join(g, "cell_id")


QUARTILES = "(0.25), (0.5), (0.75)"
RATE_QUARTILES = """round(max(CASE WHEN q = 0.5 THEN x END) / max(exposure), 6) AS median, round(max(CASE WHEN q = 0.25 THEN x END) / max(exposure), 6) AS lower_ci, round(max(CASE WHEN q = 0.75 THEN x END) / max(exposure), 6) AS upper_ci"""


@query("a20_poisson_rate_posterior", f"""
    WITH RECURSIVE k AS (SELECT l_suppkey AS cell_id, count(CASE WHEN l_discount >= 0.095 AND l_quantity > 42 THEN 1 END) AS n_events FROM {{lineitem}} GROUP BY 1),
    e AS (SELECT k.cell_id, n_events, 6371.0088e0 * 6371.0088e0 * radians(5e-1) * (sin(radians(lat + 25e-2)) - sin(radians(lat - 25e-2))) / 1e4 * 7 AS exposure FROM k JOIN grid g ON g.cell_id = k.cell_id),
    {gamma_quantiles_sql("SELECT DISTINCT n_events + 0.5 AS a FROM e", QUARTILES)}
    SELECT cell_id, n_events, round(exposure, 6) AS exposure, {RATE_QUARTILES} FROM e JOIN gammaquant ON a = n_events + 0.5 GROUP BY 1, 2, 3""")
def a20(spark, sf):
    return rounded(events.poisson_rate_interval(_rates(spark, sf), "n_events", "exposure"), "exposure", "median", "lower_ci", "upper_ci")


@query("a20_poisson_rate_mle", """
    WITH k AS (SELECT l_suppkey AS cell_id, count(CASE WHEN l_discount >= 0.095 AND l_quantity > 42 THEN 1 END) AS n_events FROM {lineitem} GROUP BY 1)
    SELECT k.cell_id, n_events, round(n_events / (6371.0088e0 * 6371.0088e0 * radians(5e-1) * (sin(radians(lat + 25e-2)) - sin(radians(lat - 25e-2))) / 1e4 * 7), 6) AS median FROM k JOIN grid g ON g.cell_id = k.cell_id""")
def a20_mle(spark, sf):
    out = events.poisson_rate_interval(_rates(spark, sf), "n_events", "exposure", "mle")
    return rounded(out, "median").select("cell_id", "n_events", "median")


SQL["elev_hist"] = """
    SELECT cell_id, CAST(floor(round((elevation + 30) / 0.05e0, 6)) AS INT) AS bin, count(*) AS n, count(CASE WHEN near THEN 1 END) AS n_expo FROM pixels WHERE wide AND elevation >= -30 AND elevation < 10 GROUP BY 1, 2"""
SQL["elev_totals"] = """
    SELECT cell_id, count(CASE WHEN wide AND elevation < -30 THEN 1 END) AS n_below, count(CASE WHEN near AND elevation < -30 THEN 1 END) AS n_below_expo, count(CASE WHEN NOT wide OR elevation >= 10 THEN 1 END) AS n_safe,
           count(CASE WHEN NOT wide THEN 1 END) AS n_unconnected, count(*) AS n_land FROM pixels GROUP BY 1"""


@query("a21_hypsometry", "SELECT h.cell_id, h.bin, h.n, h.n_expo, t.n_below, t.n_below_expo, t.n_safe, t.n_unconnected, t.n_land FROM elev_hist h JOIN elev_totals t ON h.cell_id = t.cell_id")
def a21(spark, sf):
    hist, totals = events.hypsometry(table(spark, sf, "pixels"))
    return hist.join(totals, "cell_id")


SQL["sea_levels"] = "SELECT cell_id, member, year, floor((avg(value) - 25) * 20 + 0.1234567e0) / 100 AS level FROM annual GROUP BY 1, 2, 3"
SQL["exposure"] = """
    WITH c AS (SELECT g.b AS bin, round(-30e0 + (g.b + 0.5e0) * 0.05e0, 9) AS x, coalesce(sum(h.n), 0) AS n FROM generate_series(600, 799) g(b) LEFT JOIN elev_hist h ON h.bin = g.b GROUP BY 1),
    k AS (SELECT x, 99e0 - 97e0 * sum(n) OVER (ORDER BY bin) / sum(n) OVER () AS p FROM c WHERE x > 0 AND x < 10),
    s AS (SELECT x, p, lead(x) OVER (ORDER BY x) AS nx, lead(p) OVER (ORDER BY x) AS np FROM k),
    l AS (SELECT DISTINCT cell_id, level FROM sea_levels),
    r AS (SELECT l.cell_id, l.level, h.n, h.n_expo, round(-30e0 + (h.bin + 0.5e0) * 0.05e0 - l.level, 9) AS r FROM l LEFT JOIN elev_hist h ON h.cell_id = l.cell_id),
    q AS (SELECT r.*, CASE WHEN r <= 0 THEN 100 WHEN r >= 10 THEN 1 WHEN r < (SELECT min(x) FROM k) THEN 99 WHEN r > (SELECT max(x) FROM k) THEN 2 WHEN s.nx IS NULL THEN s.p ELSE s.p + (s.np - s.p) * (r - s.x) / (s.nx - s.x) END AS p
          FROM r LEFT JOIN s ON r.r >= s.x AND (r.r < s.nx OR s.nx IS NULL)),
    z AS (SELECT cell_id, level, coalesce(sum(CASE WHEN r <= 0 THEN n_expo END), 0) AS e, coalesce(sum(n * p), 0) AS num FROM q GROUP BY 1, 2)
    SELECT v.cell_id, v.member, v.year, v.level, (z.e + t.n_below_expo) / t.n_land AS exposed, (z.num + t.n_below * 100 + t.n_safe) / t.n_land AS percentile
    FROM sea_levels v JOIN z ON v.cell_id = z.cell_id AND v.level = z.level JOIN elev_totals t ON t.cell_id = v.cell_id"""


def sea_levels(spark, sf):
    return table(spark, sf, "annual").groupBy("cell_id", "member", "year").agg((F.floor((F.avg("value") - 25) * 20 + 0.1234567) / 100).alias("level"))


def exposure(spark, sf):
    hist, totals = events.hypsometry(table(spark, sf, "pixels"))
    return events.coastal_exposure(hist, totals, events.calibration_curve(hist), sea_levels(spark, sf))


@query("a22_coastal_exposure", "SELECT cell_id, member, year, level, round(exposed, 6) AS exposed, round(percentile, 5) AS percentile FROM exposure")
def a22(spark, sf):
    return rounded(rounded(exposure(spark, sf), "exposed"), "percentile", n=5)


# Map comparison -----------------------------------------------------------------------------

SQL["index_pair"] = """
    SELECT coalesce(o.cell_id, n.cell_id) AS cell_id, coalesce(o.year, n.year) AS year, o.value AS old_value, n.value AS new_value
    FROM (SELECT cell_id, year, round(avg(value_null), 9) AS value FROM annual WHERE scenario = 'ssp126' GROUP BY 1, 2) o
    FULL JOIN (SELECT cell_id, year, round(avg(CASE WHEN value_zero > 8 THEN value_null END), 9) AS value FROM annual WHERE scenario = 'ssp585' GROUP BY 1, 2) n ON o.cell_id = n.cell_id AND o.year = n.year"""


def pair(spark, sf):
    return table(spark, sf, "index_pair")


SQL["pair_ranks"] = """
    SELECT *, rank() OVER (ORDER BY old_value) + (count(*) OVER (PARTITION BY old_value) - 1) / 2e0 AS ra, rank() OVER (ORDER BY new_value) + (count(*) OVER (PARTITION BY new_value) - 1) / 2e0 AS rb
    FROM index_pair WHERE old_value IS NOT NULL AND new_value IS NOT NULL"""


@query("a23_spatial_correlation", "SELECT round(corr(old_value, new_value), 6) AS pearson_r, round(corr(ra, rb), 6) AS spearman_r, count(*) AS n_valid FROM pair_ranks")
def a23(spark, sf):
    return rounded(compare.spatial_correlation(pair(spark, sf)), "pearson_r", "spearman_r")


@query("a23_coverage_comparison", """
    WITH c AS (SELECT count(*) AS n, count(old_value) AS o, count(new_value) AS w, count(CASE WHEN old_value IS NOT NULL AND new_value IS NOT NULL THEN 1 END) AS b, sqrt(avg(pow(new_value - old_value, 2))) AS rmsd FROM index_pair)
    SELECT o AS old_count, w AS new_count, b AS overlap_count, round(rmsd, 6) AS rmsd, round(100.0 * o / n, 6) AS old_coverage_pct, round(100.0 * w / n, 6) AS new_coverage_pct, round(100.0 * b / greatest(o, 1), 6) AS overlap_pct,
           round(100.0 * (o - b) / greatest(o, 1), 6) AS old_only_pct, round(100.0 * (w - b) / greatest(w, 1), 6) AS new_only_pct FROM c""")
def a23_coverage(spark, sf):
    out = compare.coverage_comparison(pair(spark, sf))
    return rounded(out, *[c for c in out.columns if c.endswith("pct") or c == "rmsd"])


@query("a23_anomalous_differences", """
    WITH d AS (SELECT new_value - old_value AS d FROM index_pair WHERE old_value IS NOT NULL AND new_value IS NOT NULL), s AS (SELECT avg(d) AS m, stddev_pop(d) AS s FROM d)
    SELECT round(avg(d), 6) AS diff_mean, round(stddev_pop(d), 6) AS diff_std, count(CASE WHEN abs(d - m) > 2 * s THEN 1 END) AS n_outliers, round(100.0 * count(CASE WHEN abs(d - m) > 2 * s THEN 1 END) / count(*), 6) AS outlier_pct FROM d, s""")
def a23_outliers(spark, sf):
    return rounded(compare.anomalous_differences(pair(spark, sf), 2.0), "diff_mean", "diff_std", "outlier_pct")


@query("a23_ks_statistic", """
    WITH RECURSIVE v AS (SELECT old_value AS v FROM index_pair WHERE old_value IS NOT NULL UNION SELECT new_value FROM index_pair WHERE new_value IS NOT NULL),
    c AS (SELECT CAST(count(old_value) AS BIGINT) AS n, CAST(count(new_value) AS BIGINT) AS m FROM index_pair),
    k AS (SELECT n, m, max(abs((SELECT count(*) FROM index_pair WHERE old_value <= v) / n - (SELECT count(*) FROM index_pair WHERE new_value <= v) / m)) AS d FROM v, c GROUP BY 1, 2),
    s AS (SELECT *, d * d * n * m / (n + m) AS q, round(d * n * m) AS far FROM k),
    -- share of the orders of i and j values that have kept within the distance
    lattice AS (
        SELECT 0 AS i, 0 AS j, 1e0 AS p, n, m, far FROM s WHERE n * m <= 10000
        UNION ALL
        SELECT i, j, sum(p) AS p, n, m, far FROM (
            SELECT i + 1 AS i, j, p * (i + 1) / (i + 1 + j) AS p, n, m, far FROM lattice UNION ALL SELECT i, j + 1, p * (j + 1) / (i + j + 1), n, m, far FROM lattice) l
        WHERE i <= n AND j <= m AND abs(i * m - j * n) < far GROUP BY i, j, n, m, far)
    SELECT round(d, 6) AS ks_statistic, round(CASE WHEN n * m <= 10000 THEN 1 - coalesce((SELECT max(p) FROM lattice l WHERE l.i = s.n AND l.j = s.m), 0)
        WHEN q < 0.04 THEN 1e0 ELSE least(1, greatest(0, 2 * (SELECT sum(CASE WHEN i % 2 = 1 THEN 1e0 ELSE -1e0 END * exp(-2 * i * i * q)) FROM range(1, 101) t(i)))) END, 6) AS p_value FROM s""")
def a23_ks(spark, sf):
    return rounded(compare.ks_statistic(pair(spark, sf)), "ks_statistic", "p_value")


SUMMARY = """round(avg({v}), 6) AS mean, round(stddev_pop({v}), 6) AS std, round(min({v}), 6) AS low, round(max({v}), 6) AS high, count({v}) AS n_valid, round(100.0 * count({v}) / count(*), 6) AS coverage_pct,
    round(quantile_cont({v}, 0.05), 6) AS p5, round(quantile_cont({v}, 0.25), 6) AS p25, round(quantile_cont({v}, 0.5), 6) AS p50, round(quantile_cont({v}, 0.75), 6) AS p75, round(quantile_cont({v}, 0.95), 6) AS p95"""


@query("a24_summary_stats", f"SELECT scenario, {SUMMARY.format(v='value_null')} FROM annual GROUP BY 1 UNION ALL SELECT 'all', {SUMMARY.format(v='value_null')} FROM annual")
def a24(spark, sf):
    a = table(spark, sf, "annual")
    per = compare.summary_stats(a, "value_null", ["scenario"])
    out = per.unionByName(compare.summary_stats(a, "value_null").withColumn("scenario", F.lit("all")))
    return rounded(out, *[c for c in out.columns if c not in ("scenario", "n_valid")])


@query("a24_suspicious_patterns", """
    SELECT model, count(value_bool) = 0 AS all_null, coalesce(sum(abs(value_bool)) = 0, false) AS all_zero, min(value_bool) = max(value_bool) AS constant, false AS has_inf, coalesce(bool_or(value_bool < 0), false) AS has_negative,
           0e0 AS pct_negative, round(100 * avg(CASE WHEN value_bool = 0 THEN 1e0 ELSE 0e0 END), 6) AS pct_zero, round(avg(log10(CASE WHEN value_zero > 0 THEN value_zero END)), 6) AS mean_log10 FROM annual GROUP BY 1""")
def a24_flags(spark, sf):
    a = table(spark, sf, "annual")
    signs = compare.sign_profile(a, "value_bool", ["model"]).drop("mean_log10")
    logs = compare.sign_profile(a, "value_zero", ["model"]).select("model", "mean_log10")
    out = compare.suspicious_patterns(a, "value_bool", ["model"]).join(signs, "model").join(logs, "model")
    return rounded(out, "pct_zero", "mean_log10")


SQL["cycles"] = """
    SELECT cell_id, month, avg(CASE WHEN scenario = 'ssp126' THEN value END) AS old_value, avg(CASE WHEN scenario = 'ssp585' THEN value END) AS new_value FROM monthly GROUP BY 1, 2"""


@query("a25_seasonal_compare", """
    WITH s AS (SELECT cell_id, corr(old_value, new_value) AS r, (max(new_value) - min(new_value)) / (max(old_value) - min(old_value)) AS amp, sqrt(avg(pow(new_value - old_value, 2))) AS d, count(*) AS n,
                      avg(old_value) AS mo, stddev_pop(old_value) AS so, avg(new_value) AS mn, stddev_pop(new_value) AS sn FROM cycles GROUP BY 1),
    z AS (SELECT c.cell_id, c.month, (old_value - mo) / so AS x, (new_value - mn) / sn AS y FROM cycles c JOIN s ON s.cell_id = c.cell_id),
    k AS (SELECT a.cell_id, a.month - b.month AS lag, round(sum(a.x * b.y), 9) AS c FROM z a JOIN z b ON a.cell_id = b.cell_id GROUP BY 1, 2),
    w AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY c DESC, lag) AS rn FROM k)
    SELECT s.cell_id, n AS n_months, round(r, 6) AS correlation, round(amp, 6) AS amplitude_ratio, w.lag AS phase_shift, round(d, 6) AS rmsd FROM s JOIN w ON w.cell_id = s.cell_id AND rn = 1""")
def a25(spark, sf):
    return rounded(compare.seasonal_compare(table(spark, sf, "cycles"), ["cell_id"]), "correlation", "amplitude_ratio", "rmsd")


PIXEL = """
    WITH y AS (SELECT cell_id, year AS decade, avg(CASE WHEN value_zero > 2 THEN value END) AS v FROM annual WHERE scenario = '{s}' GROUP BY 1, 2), h AS (SELECT * FROM y WHERE v IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY decade) AS t, rank() OVER (PARTITION BY cell_id ORDER BY v) + (count(*) OVER (PARTITION BY cell_id, v) - 1) / 2e0 AS rk FROM h),
    c AS (SELECT cell_id, count(*) AS n_valid, corr(t, rk) AS rho FROM r GROUP BY 1),
    s AS (SELECT a.cell_id, quantile_cont((b.v - a.v) / (b.decade - a.decade), 0.5) * 10 AS slope FROM h a JOIN h b ON a.cell_id = b.cell_id AND a.decade < b.decade GROUP BY 1)
    SELECT c.cell_id, n_valid, CASE WHEN n_valid >= 4 THEN slope END AS slope, CASE WHEN n_valid >= 4 THEN rho END AS rho FROM c LEFT JOIN s ON s.cell_id = c.cell_id"""
SQL["old_trends"] = PIXEL.format(s="ssp126")
SQL["new_trends"] = PIXEL.format(s="ssp585")


def trends(spark, sf, scenario):
    a = table(spark, sf, "annual").where(F.col("scenario") == scenario)
    y = a.groupBy("cell_id", F.col("year").alias("decade")).agg(F.avg(F.when(F.col("value_zero") > 2, F.col("value"))).alias("value"))
    return compare.pixel_trends(y, ["cell_id"])


@query("a26_pixel_trends", "SELECT cell_id, n_valid, round(slope, 6) AS slope, round(rho, 6) AS rho FROM old_trends")
def a26(spark, sf):
    return rounded(trends(spark, sf, "ssp126"), "slope", "rho")


@query("a27_trend_agreement", """
    WITH p AS (SELECT o.slope AS a, n.slope AS b FROM old_trends o JOIN new_trends n ON o.cell_id = n.cell_id WHERE o.slope IS NOT NULL AND n.slope IS NOT NULL),
    r AS (SELECT *, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2e0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2e0 AS rb FROM p)
    SELECT round(corr(a, b), 6) AS pearson_r, round(avg(CASE WHEN sign(a) = sign(b) THEN 100e0 ELSE 0e0 END), 6) AS sign_agree_pct, count(*) AS n_valid, round(corr(ra, rb), 6) AS spearman_r, round(pow(corr(ra, rb), 2), 6) AS r2 FROM r""")
def a27(spark, sf):
    old = trends(spark, sf, "ssp126").select("cell_id", F.col("slope").alias("old_slope"))
    new = trends(spark, sf, "ssp585").select("cell_id", F.col("slope").alias("new_slope"))
    return rounded(compare.trend_agreement(old.join(new, "cell_id")), "pearson_r", "sign_agree_pct", "spearman_r", "r2")


@query("a28_slope_choice", """
    WITH t AS (SELECT * FROM layer_values WHERE decade = (SELECT max(decade) FROM layer_values) AND ols_slope IS NOT NULL AND sen_slope IS NOT NULL AND (ols_slope <> 0 OR sen_slope <> 0)),
    g AS (SELECT layer_id, count(*) AS n, avg(CASE WHEN sen_slope = 0 THEN 1e0 ELSE 0e0 END) AS z, avg(CASE WHEN sign(ols_slope) = sign(sen_slope) THEN 1e0 ELSE 0e0 END) AS g FROM t GROUP BY 1)
    SELECT layer_id, n AS n_active, round(z, 6) AS sen_zero_share, round(g, 6) AS sign_agreement, CASE WHEN z > 0.10 THEN 'ols_slope' ELSE 'sen_slope' END AS recommended FROM g""")
def a28(spark, sf):
    return rounded(compare.slope_choice(table(spark, sf, "layer_values")), "sen_zero_share", "sign_agreement")


@query("a29_bound_shares", """
    SELECT scenario, year, round(avg(CASE WHEN value_zero >= 100 THEN 1e0 ELSE 0e0 END), 6) AS saturation_share, round(avg(CASE WHEN value_zero = 0 THEN 1e0 ELSE 0e0 END), 6) AS sparsity_share FROM annual GROUP BY 1, 2""")
def a29(spark, sf):
    return rounded(compare.bound_shares(table(spark, sf, "annual"), ["scenario", "year"], 100.0, "value_zero"), "saturation_share", "sparsity_share")


@query("t6_first_outliers", """
    WITH d AS (SELECT g.grow, g.gcol, a.value - b.value AS diff FROM grid g JOIN (SELECT cell_id, avg(value) AS value FROM annual WHERE scenario = 'ssp585' GROUP BY 1) a ON a.cell_id = g.cell_id
       JOIN (SELECT cell_id, avg(value) AS value FROM annual WHERE scenario = 'ssp126' GROUP BY 1) b ON b.cell_id = g.cell_id), s AS (SELECT avg(diff) AS m, stddev_pop(diff) AS s FROM d)
    SELECT grow, gcol, round(diff, 6) AS diff FROM d, s WHERE abs(diff - m) > 1.2e0 * s ORDER BY grow, gcol LIMIT 10""")
def t6(spark, sf):
    from cellcast.operators.delivery import first_outliers

    a = table(spark, sf, "annual")
    at = lambda s, name: a.where(F.col("scenario") == s).groupBy("cell_id").agg(F.avg("value").alias(name))
    maps = table(spark, sf, "grid").join(at("ssp126", "old_value"), "cell_id").join(at("ssp585", "new_value"), "cell_id")
    return rounded(first_outliers(maps, 10, 1.2), "diff")


@query("t7_symmetric_limit", """
    WITH m AS (SELECT abs(c_acctbal - 4000) AS m FROM {customer}), l AS (SELECT quantile_cont(m, 0.95) AS q FROM m)
    SELECT count(CASE WHEN m > q THEN 1 END) AS n_clamped, count(*) AS n, round(max(q), 6) AS limit_value FROM m, l""")
def t7(spark, sf):
    c = base(spark, sf, "customer").select((F.col("c_acctbal") - 4000).alias("value"))
    return rounded(compare.symmetric_limit(c), "limit_value")


@query("j16_paired_layers", """
    SELECT 'ssp126' AS old_scenario, 'ssp585' AS new_scenario, a.cell_id, a.decade, a.value_type, round(a.value, 6) AS old_value, round(b.value, 6) AS new_value
    FROM (SELECT cell_id, year AS decade, month AS value_type, avg(value) AS value FROM monthly WHERE scenario = 'ssp126' AND year <= 1999 GROUP BY 1, 2, 3) a
    JOIN (SELECT cell_id, year AS decade, month AS value_type, avg(value) AS value FROM monthly WHERE scenario = 'ssp585' AND year >= 1997 GROUP BY 1, 2, 3) b USING (cell_id, decade, value_type)""")
def j16(spark, sf):
    from cellcast.operators.delivery import common_decades, paired_layers

    m = table(spark, sf, "monthly").groupBy("scenario", "cell_id", F.col("year").alias("decade"), F.col("month").alias("value_type")).agg(F.avg("value").alias("value"))
    old, new = m.where("scenario = 'ssp126' AND decade <= 1999"), m.where("scenario = 'ssp585' AND decade >= 1997")
    both = common_decades(old, new)
    pairs = spark.createDataFrame([("ssp126", "ssp585")], "old_scenario STRING, new_scenario STRING")
    return rounded(paired_layers(old.join(both, "decade", "left_semi"), new, pairs), "old_value", "new_value")


# Hydrology ----------------------------------------------------------------------------------

SQL["runs"] = """
    SELECT l_suppkey AS cell_id, l_linenumber AS run_id, l_partkey AS step, avg(l_quantity) AS obs, avg(l_extendedprice / 1024) AS sim FROM {lineitem} GROUP BY 1, 2, 3"""
SQL["fits"] = """
    WITH g AS (SELECT cell_id, run_id, count(*) AS n, corr(sim, obs) AS r, stddev_samp(sim) / stddev_samp(obs) AS a, avg(sim) / avg(obs) AS b, 1 - sum(pow(obs - sim, 2)) / (var_pop(obs) * count(*)) AS nse, avg(abs(obs - sim)) AS mae FROM runs GROUP BY 1, 2)
    SELECT cell_id, run_id, n, 1 - sqrt(pow(r - 1, 2) + pow(a - 1, 2) + pow(b - 1, 2)) AS kge, nse, mae, 1 - (1 - r * r) * (n - 1) / nullif(n - 2, 0) AS adj_r2 FROM g"""


@query("a32_goodness_of_fit", "SELECT cell_id, run_id, n, round(kge, 6) AS kge, round(nse, 6) AS nse, round(mae, 4) AS mae, round(adj_r2, 6) AS adj_r2 FROM fits")
def a32(spark, sf):
    out = hydrology.goodness_of_fit(table(spark, sf, "runs"), ["cell_id", "run_id"])
    return rounded(rounded(out, "kge", "nse", "adj_r2"), "mae", n=4)


@query("t5_best_parameters", """
    SELECT cell_id, run_id, round(kge, 6) AS kge, position FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY kge DESC, run_id) AS position FROM fits) t WHERE position <= 2""")
def t5(spark, sf):
    fits = hydrology.goodness_of_fit(table(spark, sf, "runs"), ["cell_id", "run_id"])
    return rounded(hydrology.best_parameters(fits, ["cell_id"], "kge", n=2), "kge").select("cell_id", "run_id", "kge", "position")


SQL["flows"] = """
    SELECT l_suppkey AS cell_id, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS obs, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / 1024e0 AS sim FROM {lineitem} GROUP BY 1, 2"""
WY = """SELECT cell_id, CAST(year(day + INTERVAL 3 MONTH) AS INT) AS water_year, sum(obs) AS obs_annual, sum(sim) AS sim_annual, sum(CASE WHEN month(day) BETWEEN 4 AND 7 THEN obs END) AS obs_apr_jul, sum(CASE WHEN month(day) BETWEEN 4 AND 7 THEN sim END) AS sim_apr_jul,
    sum(CASE WHEN month(day) >= 10 OR month(day) <= 3 THEN obs END) AS obs_oct_mar, sum(CASE WHEN month(day) >= 10 OR month(day) <= 3 THEN sim END) AS sim_oct_mar FROM flows GROUP BY 1, 2"""


@query("a36_water_year_sums", f"SELECT cell_id, water_year, obs_annual, obs_apr_jul, obs_oct_mar, round(sim_annual, 2) AS sim_annual, round(sim_apr_jul, 2) AS sim_apr_jul, round(sim_oct_mar, 2) AS sim_oct_mar FROM ({WY}) w")
def a36(spark, sf):
    return rounded(hydrology.water_year_sums(table(spark, sf, "flows"), ["cell_id"]), "sim_annual", "sim_apr_jul", "sim_oct_mar", n=2)


@query("a36_water_year_r2", f"""
    SELECT cell_id, round(regr_r2(obs_annual, sim_annual), 6) AS r2_annual, round(regr_r2(obs_apr_jul, sim_apr_jul), 6) AS r2_apr_jul, round(regr_r2(obs_oct_mar, sim_oct_mar), 6) AS r2_oct_mar FROM ({WY}) w GROUP BY 1""")
def a36_r2(spark, sf):
    sums = hydrology.water_year_sums(table(spark, sf, "flows"), ["cell_id"])
    return rounded(hydrology.water_year_r2(sums, ["cell_id"]), "r2_annual", "r2_apr_jul", "r2_oct_mar")


SQL["yearly"] = "SELECT cell_id, year, min(value) AS low, avg(value) AS mean, max(value) AS high FROM monthly GROUP BY 1, 2"


@query("a37_annual_extreme_change", """
    WITH b AS (SELECT cell_id, quantile_cont(low, 0.5) AS l, quantile_cont(mean, 0.5) AS m, quantile_cont(high, 0.5) AS h FROM yearly WHERE year BETWEEN 1995 AND 1996 GROUP BY 1)
    SELECT y.cell_id, y.year, round((low / nullif(l, 0) - 1) * 100, 6) AS low_change, round((mean / m - 1) * 100, 6) AS mean_change, round((high / h - 1) * 100, 6) AS high_change FROM yearly y JOIN b ON y.cell_id = b.cell_id""")
def a37(spark, sf):
    return rounded(hydrology.annual_extreme_change(table(spark, sf, "monthly"), ["cell_id"], 1995, 2), "low_change", "mean_change", "high_change")


@query("a43_decade_difference", """
    WITH d AS (SELECT cell_id, 1995 + 2 * CAST(floor((year - 1995) / 2e0) AS INT) AS decade, quantile_cont(low, 0.5) AS m FROM yearly GROUP BY 1, 2)
    SELECT d.cell_id, d.decade, round(d.m - b.m, 6) AS difference FROM d JOIN d b ON b.cell_id = d.cell_id AND b.decade = 1995 WHERE d.decade > 1995""")
def a43(spark, sf):
    return rounded(hydrology.decade_difference(table(spark, sf, "monthly"), ["cell_id"], 1995, [1997, 1999, 2001], 2), "difference")


@query("a39_ensemble_quantiles", """
    WITH f AS (SELECT cell_id, day, value, CAST(floor((day(day) - 1) / 10e0) AS INT) AS lead FROM daily WHERE member IN ('click', 'view')), h AS (SELECT cell_id, day, value FROM daily WHERE member NOT IN ('click', 'view')),
    d AS (SELECT DISTINCT cell_id, lead, dayofyear(day) AS doy FROM f), p AS (SELECT d.cell_id, d.lead, h.value FROM d JOIN h ON h.cell_id = d.cell_id AND dayofyear(h.day) = d.doy)
    SELECT a.*, b.* EXCLUDE (cell_id, lead) FROM (SELECT cell_id, lead, round(quantile_cont(value, 0.05), 6) AS f05, round(quantile_cont(value, 0.25), 6) AS f25, round(quantile_cont(value, 0.5), 6) AS f50, round(quantile_cont(value, 0.75), 6) AS f75, round(quantile_cont(value, 0.95), 6) AS f95 FROM f GROUP BY 1, 2) a
    JOIN (SELECT cell_id, lead, round(quantile_cont(value, 0.05), 6) AS c05, round(quantile_cont(value, 0.25), 6) AS c25, round(quantile_cont(value, 0.5), 6) AS c50, round(quantile_cont(value, 0.75), 6) AS c75, round(quantile_cont(value, 0.95), 6) AS c95 FROM p GROUP BY 1, 2) b USING (cell_id, lead)""")
def a39(spark, sf):
    d = daily(spark, sf)
    forecast = d.where(F.col("member").isin("click", "view")).withColumn("lead", F.floor((F.dayofmonth("day") - 1) / 10).cast("int"))
    out = hydrology.ensemble_quantiles(forecast, d.where(~F.col("member").isin("click", "view")), ["cell_id"])
    return rounded(out, *[c for c in out.columns if c[1:].isdigit()])


SQL["vertices"] = """
    SELECT s_nationkey AS region_id, s_suppkey AS seq, s_acctbal AS x, CAST(s_suppkey * 7 % 31 AS DOUBLE) AS y FROM {supplier}"""


@query("a40_region_bounds_centroid", """
    WITH r AS (SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny FROM vertices WINDOW w AS (PARTITION BY region_id ORDER BY seq)),
    s AS (SELECT region_id, min(x) AS west, max(x) AS east, min(y) AS south, max(y) AS north, sum(x * ny - nx * y) AS a, sum((x + nx) * (x * ny - nx * y)) AS cx, sum((y + ny) * (x * ny - nx * y)) AS cy FROM r GROUP BY 1)
    SELECT region_id, west, east, south, north, round(abs(a) / 2, 4) AS area, round(cx / (3 * a), 4) AS centroid_x, round(cy / (3 * a), 4) AS centroid_y FROM s WHERE abs(a) > 1e-9""")
def a40(spark, sf):
    from cellcast.operators.regions import region_geometry

    out = region_geometry(table(spark, sf, "vertices")).where("area > 0")
    return rounded(out, "area", "centroid_x", "centroid_y", n=4)


@query("a41_significance_shares", """
    SELECT 'land' AS population, round(avg(CASE WHEN l_discount < 0.025 THEN 1e0 ELSE 0e0 END), 6) AS significant, round(avg(CASE WHEN l_discount < 0.025 THEN CASE WHEN l_quantity > 20 THEN 1e0 ELSE 0e0 END END), 6) AS positive FROM {lineitem}
    UNION ALL SELECT 'exposed', round(avg(CASE WHEN l_discount < 0.025 THEN 1e0 ELSE 0e0 END), 6), round(avg(CASE WHEN l_discount < 0.025 THEN CASE WHEN l_quantity > 20 THEN 1e0 ELSE 0e0 END END), 6) FROM {lineitem} WHERE l_tax > 0.035""")
def a41(spark, sf):
    cells = base(spark, sf, "lineitem").select((F.col("l_discount") * 2).alias("p_value"), (F.col("l_quantity") - 20).alias("slope"), "l_tax")
    return rounded(hydrology.significance_shares(cells, {"land": F.lit(True), "exposed": F.col("l_tax") > 0.035}), "significant", "positive")


@query("a42_low_flow_days", """
    WITH t AS (SELECT cell_id, q, CASE q WHEN 0.04 THEN a WHEN 0.1 THEN b ELSE c END AS threshold FROM (SELECT cell_id, quantile_cont(obs, 0.04) AS a, quantile_cont(obs, 0.1) AS b, quantile_cont(obs, 0.2) AS c FROM flows GROUP BY 1) x, (VALUES (4e-2), (1e-1), (2e-1)) v(q))
    SELECT t.cell_id, t.q, round(max(t.threshold), 6) AS threshold, count(*) AS n_days, round(avg(obs), 6) AS mean, min(obs) AS lowest FROM t JOIN flows f ON f.cell_id = t.cell_id AND f.obs <= t.threshold GROUP BY 1, 2""")
def a42(spark, sf):
    return rounded(hydrology.low_flow_days(table(spark, sf, "flows"), ["cell_id"], value="obs"), "threshold", "mean")


# Graphs -------------------------------------------------------------------------------------

SQL["flowgrid"] = "SELECT cell_id, grow, gcol, lat, CAST(CASE WHEN cell_id % 10 = 0 THEN 3 ELSE 5 END AS INT) AS flow FROM grid WHERE acctbal > -500"
SQL["d8"] = """
    SELECT a.cell_id, b.cell_id AS next_id FROM flowgrid a LEFT JOIN flowgrid b ON (a.flow = 3 AND b.lat = a.lat - 5e-1 AND b.gcol = a.gcol) OR (a.flow = 5 AND b.grow = a.grow AND b.gcol = (a.gcol + 719) % 720)"""


@query("g1_d8_edges", "SELECT cell_id, next_id FROM d8")
def g1(spark, sf):
    return graph.d8_edges(table(spark, sf, "flowgrid"), 720, northward=False)


@query("g2_assert_acyclic", """
    WITH RECURSIVE d AS (SELECT cell_id, CAST(0 AS BIGINT) AS depth FROM network WHERE next_id IS NULL UNION ALL SELECT n.cell_id, d.depth + 1 FROM network n JOIN d ON n.next_id = d.cell_id) SELECT cell_id, depth FROM d""")
def g2(spark, sf):
    return graph.assert_acyclic(table(spark, sf, "network"))


@query("g2_peel_rounds", """
    WITH RECURSIVE u AS (SELECT cell_id, next_id, 0 AS k FROM network UNION SELECT n.cell_id, n.next_id, u.k + 1 FROM u JOIN network n ON n.cell_id = u.next_id) SELECT cell_id, CAST(max(k) AS INT) AS peel FROM u GROUP BY 1""")
def g2_peel(spark, sf):
    return graph.peel_rounds(table(spark, sf, "network"))


@query("g3_accumulate_downstream", """
    WITH RECURSIVE u AS (SELECT cell_id AS origin, cell_id, next_id, payload FROM network UNION ALL SELECT u.origin, n.cell_id, n.next_id, u.payload FROM u JOIN network n ON n.cell_id = u.next_id) SELECT cell_id, CAST(sum(payload) AS BIGINT) AS payload FROM u GROUP BY 1""")
def g3(spark, sf):
    n = table(spark, sf, "network")
    return graph.accumulate_downstream(n, n)


SQL["islands"] = "SELECT cell_id, grow, gcol, CAST(grow AS BIGINT) * 720 + gcol AS num FROM grid WHERE acctbal > 4500"


@query("g4_connected_components", """
    WITH RECURSIVE e AS (SELECT a.num AS a, b.num AS b FROM islands a JOIN islands b ON abs(a.grow - b.grow) <= 1 AND least((a.gcol - b.gcol + 720) % 720, (b.gcol - a.gcol + 720) % 720) <= 1),
    r AS (SELECT num AS a, num AS b FROM islands UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT i.grow, i.gcol, min(r.b) AS component FROM r JOIN islands i ON i.num = r.a GROUP BY 1, 2""")
def g4(spark, sf):
    return graph.connected_components(table(spark, sf, "islands"))


@query("g4_largest_component", """
    WITH RECURSIVE e AS (SELECT a.num AS a, b.num AS b FROM islands a JOIN islands b ON abs(a.grow - b.grow) <= 1 AND least((a.gcol - b.gcol + 720) % 720, (b.gcol - a.gcol + 720) % 720) <= 1),
    r AS (SELECT num AS a, num AS b FROM islands UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), c AS (SELECT a, min(b) AS component FROM r GROUP BY 1), t AS (SELECT component, count(*) AS n FROM c GROUP BY 1 ORDER BY n DESC, component LIMIT 1)
    SELECT component, n AS n_cells FROM t""")
def g4_largest(spark, sf):
    return graph.component_sizes(graph.largest_component(graph.connected_components(table(spark, sf, "islands"))))


@query("g5_upstream_set", """
    WITH RECURSIVE o AS (SELECT c_custkey AS cell_id FROM {customer} WHERE c_acctbal > 8900), u AS (SELECT cell_id, cell_id AS outlet FROM o
      UNION ALL SELECT n.cell_id, u.outlet FROM network n JOIN u ON n.next_id = u.cell_id WHERE n.cell_id NOT IN (SELECT cell_id FROM o)) SELECT cell_id, outlet FROM u""")
def g5(spark, sf):
    outlets = base(spark, sf, "customer").where("c_acctbal > 8900").select(F.col("c_custkey").alias("cell_id"))
    return graph.upstream_set(table(spark, sf, "network"), outlets)
