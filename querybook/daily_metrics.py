"""Daily and monthly metrics, seasonal windows, and the streaming forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellcast.operators import daily as D
from cellcast.session import cut_lineage, scratch_folder
from cellcast.streaming import incremental
from querybook.common import rounded
from querybook.layers import annual_panel
from querybook.registry import query
from querybook.standins import SQL, daily, table

LADDER = [("above_50", ">", 50.0), ("above_90", ">", 90.0), ("below_5", "<", 5.0), ("r10", ">=", 10.0), ("r20", ">=", 20.0)]
LADDER_SQL = """count(CASE WHEN value > 50 THEN 1 END) AS above_50, count(CASE WHEN value > 90 THEN 1 END) AS above_90,
    count(CASE WHEN value < 5 THEN 1 END) AS below_5, count(CASE WHEN value >= 10 THEN 1 END) AS r10, count(CASE WHEN value >= 20 THEN 1 END) AS r20"""
SQL["wethist"] = """
    SELECT cell_id, CAST(greatest(0, least(255, floor(ln(value) / ln(1000e0) * 256))) AS INT) AS bin, count(*) AS n FROM daily WHERE value >= 1 GROUP BY 1, 2"""
SQL["wetcut"] = """
    WITH c AS (SELECT *, sum(n) OVER (PARTITION BY cell_id ORDER BY bin) AS running, sum(n) OVER (PARTITION BY cell_id) AS n_wet FROM wethist)
    SELECT cell_id, n_wet, exp(bin * ln(1000e0) / 256) + (n_wet * 0.9e0 - (running - n)) / n * (exp((bin + 1) * ln(1000e0) / 256) - exp(bin * ln(1000e0) / 256)) AS threshold
    FROM c WHERE running >= n_wet * 0.9e0 AND running - n < n_wet * 0.9e0"""
SQL["sum5"] = """
    SELECT * FROM (SELECT member, cell_id, day, sum(value) OVER w AS sum5, count(*) OVER w AS k FROM daily WINDOW w AS (PARTITION BY member, cell_id ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) t WHERE k = 5"""


@query("a7_annualize", """
    SELECT cell_id, scenario, member, year, round(CASE WHEN count(DISTINCT month) = 12 THEN sum(value) END, 6) AS total, round(CASE WHEN count(DISTINCT month) = 12 THEN avg(value) END, 6) AS mean FROM monthly GROUP BY 1, 2, 3, 4""")
def a7(spark, sf):
    m, keys = table(spark, sf, "monthly"), ["cell_id", "scenario", "member"]
    total = D.annualize(m, "sum", keys).withColumnRenamed("value", "total")
    return rounded(total.join(D.annualize(m, "mean", keys).withColumnRenamed("value", "mean"), [*keys, "year"]), "total", "mean")


@query("a8_water_value_types", """
    WITH m AS (SELECT *, CASE WHEN year BETWEEN 1995 AND 1995 THEN 1990 WHEN year BETWEEN 1996 AND 2001 THEN 1996 END AS decade FROM monthly),
    mm AS (SELECT scenario, cell_id, decade, month, avg(value) AS v FROM m WHERE decade IS NOT NULL GROUP BY 1, 2, 3, 4),
    ma AS (SELECT scenario, cell_id, decade, member, year, avg(value) AS v FROM m WHERE decade IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
    q AS (SELECT scenario, cell_id, decade, quantile_cont(v, [0.05, 0.15, 0.25, 0.5, 0.75, 0.85, 0.95]) AS q FROM ma GROUP BY 1, 2, 3)
    SELECT scenario, cell_id, decade, month - 1 AS value_type, round(v, 6) AS value FROM mm
    UNION ALL SELECT scenario, cell_id, decade, 12, round(avg(v), 6) FROM mm GROUP BY 1, 2, 3
    UNION ALL SELECT scenario, cell_id, decade, i + 12, round(q[i], 6) FROM q, (VALUES (1), (2), (3), (4), (5), (6), (7)) i(i)""")
def a8(spark, sf):
    return rounded(D.water_value_types(table(spark, sf, "monthly"), {1990: (1995, 1995), 1996: (1996, 2001)}), "value")


SQL["modelstats"] = """
    WITH a AS (SELECT scenario, member, model, cell_id, year, avg(value) AS v FROM monthly WHERE year BETWEEN 1996 AND 2001 GROUP BY 1, 2, 3, 4, 5)
    SELECT model, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM a GROUP BY 1"""


@query("a9_robust_normalize", """
    SELECT s.model, round(s.median, 6) AS median, round(s.iqr, 6) AS iqr, round(avg(100 + (m.value - s.median) / s.iqr * 15), 6) AS mean_scaled, round(max(100 + (m.value - s.median) / s.iqr * 15), 6) AS max_scaled
    FROM monthly m JOIN modelstats s ON m.model = s.model GROUP BY s.model, s.median, s.iqr""")
def a9(spark, sf):
    m = table(spark, sf, "monthly")
    stats = D.robust_model_stats(m, (1996, 2001))
    scaled = D.robust_normalize(m, stats, 100.0, 15.0).groupBy("model").agg(F.avg("value").alias("mean_scaled"), F.max("value").alias("max_scaled"))
    return rounded(stats.join(scaled, "model"), "median", "iqr", "mean_scaled", "max_scaled")


@query("a10_threshold_counts", f"SELECT member, cell_id, CAST(year(day) AS INT) AS year, {LADDER_SQL} FROM daily GROUP BY 1, 2, 3")
def a10(spark, sf):
    return D.threshold_counts(daily(spark, sf), LADDER)


@query("a11_relative_threshold_counts", """
    SELECT d.member, d.cell_id, CAST(year(day) AS INT) AS year, CASE WHEN max(c.threshold) IS NOT NULL THEN count(CASE WHEN d.value >= c.threshold THEN 1 END) END AS n_days
    FROM daily d LEFT JOIN (SELECT * FROM wetcut WHERE n_wet >= 105) c ON c.cell_id = d.cell_id GROUP BY 1, 2, 3""")
def a11(spark, sf):
    d = daily(spark, sf)
    return D.relative_threshold_counts(d, D.hist_percentile(D.wet_histogram(d), 90.0), 105)


@query("a12_precip_intensity", """
    SELECT member, cell_id, CAST(year(day) AS INT) AS year, round(coalesce(sum(CASE WHEN value >= 1 THEN value END), 0), 6) AS prcptot, count(CASE WHEN value >= 1 THEN 1 END) AS wetdays, max(value) AS rx1day FROM daily GROUP BY 1, 2, 3""")
def a12(spark, sf):
    return rounded(D.precip_intensity(daily(spark, sf)), "prcptot")


@query("a13_hist_percentile", "SELECT cell_id, n_wet, round(threshold, 6) AS threshold FROM wetcut")
def a13(spark, sf):
    return rounded(D.hist_percentile(D.wet_histogram(daily(spark, sf)), 90.0), "threshold")


@query("w6_running_sum_by_bin", "SELECT cell_id, bin, n, sum(n) OVER (PARTITION BY cell_id ORDER BY bin) AS running FROM wethist")
def w6(spark, sf):
    return D.running_sum_by_bin(D.wet_histogram(daily(spark, sf)))


@query("w7_rx5day", "SELECT member, cell_id, CAST(year(day) AS INT) AS year, round(max(sum5), 6) AS rx5day FROM sum5 GROUP BY 1, 2, 3")
def w7(spark, sf):
    return rounded(D.rx5day(daily(spark, sf)), "rx5day")


SQL["firstrun"] = """
    WITH g AS (SELECT member, cell_id, day, value, CASE WHEN dayofyear(day) >= 11 THEN year(day) + 1 ELSE year(day) END AS grow_year FROM daily),
    n AS (SELECT *, date_diff('day', make_date(CAST(grow_year - 1 AS BIGINT), 1, 1) + 10, day) + 1 AS grow_day FROM g),
    h AS (SELECT *, grow_day - row_number() OVER (PARTITION BY member, cell_id, grow_year ORDER BY grow_day) AS island FROM n WHERE value > 10),
    r AS (SELECT *, row_number() OVER (PARTITION BY member, cell_id, grow_year, island ORDER BY grow_day) AS run FROM h),
    f AS (SELECT member, cell_id, grow_year, min(grow_day) AS first_day FROM r WHERE run = 3 GROUP BY 1, 2, 3)
    SELECT k.member, k.cell_id, k.grow_year, coalesce(f.first_day, 364) AS first_day FROM (SELECT DISTINCT member, cell_id, grow_year FROM n) k
    LEFT JOIN f ON f.member = k.member AND f.cell_id = k.cell_id AND f.grow_year = k.grow_year"""


@query("w8_first_run", "SELECT member, cell_id, grow_year, first_day FROM firstrun")
def w8(spark, sf):
    return D.first_run(daily(spark, sf), F.col("value") > 10, 3, 11)


@query("w9_growing_degree_days", """
    WITH g AS (SELECT member, cell_id, day, value, CASE WHEN dayofyear(day) >= 11 THEN year(day) + 1 ELSE year(day) END AS grow_year FROM daily),
    n AS (SELECT *, date_diff('day', make_date(CAST(grow_year - 1 AS BIGINT), 1, 1) + 10, day) + 1 AS grow_day FROM g),
    c AS (SELECT n.*, sum(greatest(value - 5, 0)) OVER (PARTITION BY n.member, n.cell_id, n.grow_year ORDER BY grow_day ROWS UNBOUNDED PRECEDING) AS gdd
          FROM n JOIN firstrun f ON f.member = n.member AND f.cell_id = n.cell_id AND f.grow_year = n.grow_year WHERE n.grow_day > f.first_day AND f.first_day < 364)
    SELECT f.member, f.cell_id, f.grow_year, t.t AS threshold, coalesce((SELECT min(grow_day) FROM c WHERE c.member = f.member AND c.cell_id = f.cell_id AND c.grow_year = f.grow_year AND gdd > t.t), 400) AS day_reached
    FROM firstrun f, (VALUES (4e1), (15e1)) t(t)""")
def w9(spark, sf):
    d = daily(spark, sf)
    return D.growing_degree_days(d, D.first_run(d, F.col("value") > 10, 3, 11), 5.0, [40.0, 150.0], 11)


@query("w10_doy_climatology", "SELECT cell_id, CAST(dayofyear(day) AS INT) AS doy, round(quantile_cont(value, 0.5), 6) AS median FROM daily GROUP BY 1, 2")
def w10(spark, sf):
    return rounded(D.doy_climatology(daily(spark, sf)), "median")


@query("w11_season_date_bands", """
    WITH q AS (SELECT cell_id, quantile_cont(first_day, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q FROM firstrun GROUP BY 1)
    SELECT cell_id, b.n AS band, DATE '2024-05-01' + CAST(ceil(round(q[b.a], 9)) AS INT) AS from_date, DATE '2024-05-01' + CAST(ceil(round(q[b.b], 9)) AS INT) AS to_date
    FROM q, (VALUES ('Q5_to_Q25', 1, 2), ('Q25_to_Q75', 2, 4), ('Q75_to_Q95', 4, 5)) b(n, a, b)""")
def w11(spark, sf):
    days = D.first_run(daily(spark, sf), F.col("value") > 10, 3, 11)
    return D.season_date_bands(days, "2024-05-01", ["cell_id"])


@query("w12_lagged_feature", """
    SELECT member, cell_id, day, round(value - lag(value, 3) OVER w, 6) AS lag_difference, round((lead(value, 3) OVER w - value) / nullif(value, 0), 6) AS ahead_change FROM daily WINDOW w AS (PARTITION BY member, cell_id ORDER BY day)""")
def w12(spark, sf):
    out = D.lagged_feature(daily(spark, sf), 3)
    return rounded(out, "lag_difference", "ahead_change").select("member", "cell_id", "day", "lag_difference", "ahead_change")


@query("w13_linear_fill", """
    WITH d AS (SELECT member, cell_id, day, CASE WHEN value > 0 THEN value END AS value FROM daily),
    k AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER a AS da, last_value(value IGNORE NULLS) OVER a AS va,
                 first_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER b AS db, first_value(value IGNORE NULLS) OVER b AS vb FROM d
          WINDOW a AS (PARTITION BY member, cell_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY member, cell_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT member, cell_id, day, round(coalesce(value, va + (vb - va) / (db - da) * (day - da)), 6) AS value FROM k""")
def w13(spark, sf):
    gappy = daily(spark, sf).withColumn("value", F.when(F.col("value") > 0, F.col("value")))
    return rounded(D.linear_fill(gappy), "value").select("member", "cell_id", "day", "value")


@query("w14_kernel_smooth_time", """
    WITH y AS (SELECT cell_id, member, year, avg(value) AS v FROM annual GROUP BY 1, 2, 3)
    SELECT a.cell_id, a.member, a.year, round(sum(exp(-0.5 * pow((b.year - a.year) / (3 * 0.3706506), 2)) * b.v) / sum(exp(-0.5 * pow((b.year - a.year) / (3 * 0.3706506), 2))), 6) AS smooth
    FROM y a JOIN y b ON a.cell_id = b.cell_id AND a.member = b.member AND abs(a.year - b.year) <= 4 GROUP BY 1, 2, 3""")
def w14(spark, sf):
    y = table(spark, sf, "annual").groupBy("cell_id", "member", "year").agg(F.avg("value").alias("value"))
    return rounded(D.kernel_smooth_time(y, 3.0, ["cell_id", "member"]), "smooth")


@query("w16_standardized_anomaly", """
    WITH b AS (SELECT scenario, avg(median) AS m, stddev_pop(median) AS s FROM panel WHERE decade = 1995 GROUP BY 1)
    SELECT p.scenario, p.decade, p.cell_id, round((p.median - b.m) / b.s, 6) AS anomaly, round(p.median - q.median, 6) AS change
    FROM panel p JOIN b ON b.scenario = p.scenario JOIN panel q ON q.scenario = p.scenario AND q.cell_id = p.cell_id AND q.decade = 1995""")
def w16(spark, sf):
    from cellcast.operators.compare import standardized_anomaly

    panel, _ = annual_panel(spark, sf)
    return rounded(standardized_anomaly(panel, 1995), "anomaly", "change").select("scenario", "decade", "cell_id", "anomaly", "change")


LEVELS = ", ".join(str(i / 100) for i in range(1, 100))


@query("w17_legacy_quantile_index", """
    WITH a AS (SELECT quantile_cont(median, [""" + LEVELS + """]) AS v FROM base_median), q AS (SELECT round(unnest(v), 9) AS v, generate_subscripts(v, 1) AS i FROM a)
    SELECT p.scenario, p.decade, p.cell_id, (SELECT greatest(1, 1 + count(*)) FROM q WHERE i >= 2 AND round(p.median, 9) > v) AS more_is_bad,
           (SELECT greatest(1, count(*)) FROM q WHERE round(p.median, 9) < v) AS less_is_bad FROM panel p""")
def w17(spark, sf):
    from cellcast.operators.compare import legacy_quantile_index

    panel, b = annual_panel(spark, sf)
    return legacy_quantile_index(panel, b).select("scenario", "decade", "cell_id", "more_is_bad", "less_is_bad")


@query("q5_containment", """
    WITH m AS (SELECT member AS scenario, cell_id, count(CASE WHEN value >= 1 THEN 1 END) AS wetdays, count(CASE WHEN value >= 10 THEN 1 END) AS r10, count(CASE WHEN value >= 20 THEN 1 END) AS r20, max(value) AS rx1 FROM daily GROUP BY 1, 2),
    x AS (SELECT member, cell_id, max(sum5) AS rx5 FROM sum5 GROUP BY 1, 2), j AS (SELECT m.*, x.rx5 FROM m JOIN x ON x.member = m.scenario AND x.cell_id = m.cell_id)
    SELECT scenario, 'wetdays_ge_r10' AS rule, count(CASE WHEN wetdays < r10 THEN 1 END) AS violations FROM j GROUP BY 1 UNION ALL SELECT scenario, 'r10_ge_r20', count(CASE WHEN r10 < r20 THEN 1 END) FROM j GROUP BY 1
    UNION ALL SELECT scenario, 'rx5_ge_rx1', count(CASE WHEN rx5 < rx1 THEN 1 END) FROM j GROUP BY 1""")
def q5(spark, sf):
    d = daily(spark, sf)
    counts = D.threshold_counts(d, [("wetdays", ">=", 1.0), ("r10", ">=", 10.0), ("r20", ">=", 20.0)])
    peaks = D.precip_intensity(d).select("member", "cell_id", "year", F.col("rx1day").alias("rx1"))
    five = D.rx5day(d).withColumnRenamed("rx5day", "rx5")
    keys = ["member", "cell_id", "year"]
    wide = counts.join(peaks, keys).join(five, keys).withColumnRenamed("member", "scenario")
    return D.containment(wide, [["wetdays", "r10", "r20"], ["rx5", "rx1"]])


# Streaming ----------------------------------------------------------------------------------


def _chunks(spark, sf, repeated=False):
    """The daily series written as a set of files per third of the month, in time order; optionally twice.

    A micro-batch takes as many files as a third has, whatever the number of tasks that wrote them.
    """
    folder = scratch_folder(spark, "chunks")
    d = daily(spark, sf).select(
        F.concat(F.lit("c"), F.floor((F.dayofmonth("day") - 1) / 10).cast("string")).alias("chunk_id"),
        "member", "cell_id", "day", "value",
    )
    d = cut_lineage(d)
    # file modification times order the chunks, so each is written in turn
    names = [name for name in ("c0", "c1", "c2") for _ in range(2 if repeated else 1)]
    for name in names:
        d.where(F.col("chunk_id") == name).write.mode("append").parquet(folder)
    files = len(spark.read.schema(incremental.CHUNK_SCHEMA).parquet(folder).inputFiles())
    return incremental.read_chunks(spark, folder, files_per_trigger=max(1, -(-files // len(names))))


def _run(spark, stream, mode="update"):
    out = scratch_folder(spark, "stream")
    incremental.run_to_end(stream, out + "/data", out + "/checkpoint", mode)
    return out + "/data"


@query("st1_stream_threshold_counts", f"SELECT member, cell_id, CAST(year(day) AS INT) AS year, {LADDER_SQL} FROM daily GROUP BY 1, 2, 3")
def st1(spark, sf):
    out = _run(spark, incremental.stream_threshold_counts(_chunks(spark, sf), LADDER))
    return incremental.latest(spark, out, ["member", "cell_id", "year"])


@query("st2_stream_rx5day", "SELECT member, cell_id, CAST(year(day) AS INT) AS year, round(max(sum5), 6) AS rx5day FROM sum5 GROUP BY 1, 2, 3")
def st2(spark, sf):
    out = _run(spark, incremental.stream_five_day_sums(_chunks(spark, sf)), "append")
    return rounded(incremental.rx5day_from_sums(spark.read.parquet(out)), "rx5day")


@query("st3_idempotent_ingest", f"SELECT member, cell_id, CAST(year(day) AS INT) AS year, {LADDER_SQL} FROM daily GROUP BY 1, 2, 3")
def st3(spark, sf):
    out = scratch_folder(spark, "ingest")
    incremental.ingest_once(_chunks(spark, sf, repeated=True), f"{out}/rows", f"{out}/checkpoint")
    return D.threshold_counts(incremental.ingested(spark, f"{out}/rows"), LADDER)


@query("st4_stream_histogram", "SELECT cell_id, bin, n FROM wethist")
def st4(spark, sf):
    out = _run(spark, incremental.stream_histogram(_chunks(spark, sf)))
    return incremental.latest(spark, out, ["cell_id", "bin"])
