"""A delivery's numbers computed again by another path, and where the delivery differs.

Nothing here calls the code that made the numbers: windows come from the cells' coordinates instead of grid
keys, scores from one weight per row instead of nested means, vulnerable counts from a ranking instead of maxima.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The tier of each scenario code.
TIERS = {"ssp126": "low", "ssp245": "medium", "ssp370": "medium", "ssp585": "high"}


def _tier() -> Column:
    c = F.lit(None).cast("string")
    for code, tier in TIERS.items():
        c = F.when(F.col("scenario") == code, tier).otherwise(c)
    return c


def extraction_again(sites: DataFrame, panel: DataFrame, metrics: Sequence[str], by: Sequence[str], cell: float = 0.5) -> DataFrame:
    """(site_id, by, metrics) from the cells whose centres, by their own lat and lon, lie within one cell of the site.

    Weights are exp(-d^2 / 2 s^2) with s half a cell and d in degrees; a cell without the metric gives its weight up.
    Sites and cells meet on whole degrees.
    """
    degree = lambda c: F.floor(c).cast("int")
    around = lambda c: F.sequence(degree(F.col(c)) - 1, degree(F.col(c)) + 1)
    asked = sites.select("site_id", F.col("lat").alias("_sla"), F.col("lon").alias("_slo"), F.explode(around("lat")).alias("_y"), F.col("lon").alias("_l"))
    asked = asked.withColumn("_x", F.explode(F.transform(around("_l"), lambda d: F.pmod(d, F.lit(360))))).drop("_l")
    stock = panel.select(*by, *metrics, F.col("lat").alias("_la"), F.col("lon").alias("_lo"), degree(F.col("lat")).alias("_y"), F.pmod(degree(F.col("lon")), F.lit(360)).alias("_x"))
    turn = F.pmod(F.col("_lo") - F.col("_slo"), F.lit(360.0))
    dlat, dlon = F.abs(F.col("_la") - F.col("_sla")), F.least(turn, 360 - turn)
    met = asked.join(stock, ["_y", "_x"]).where((dlat <= cell + 1e-9) & (dlon <= cell + 1e-9))
    weight = F.exp(-2 * (F.pow(dlat, F.lit(2)) + F.pow(dlon, F.lit(2))) / (cell * cell))
    long = met.select("site_id", *by, weight.alias("_w"), *metrics).unpivot(["site_id", *by, "_w"], list(metrics), "_metric", "_v")
    rows = long.groupBy("site_id", *by, "_metric").agg(F.sum(F.col("_w") * F.col("_v")).alias("_wv"), F.sum(F.when(F.col("_v").isNotNull(), F.col("_w"))).alias("_ww"))
    return rows.groupBy("site_id", *by).agg(*[F.max(F.when(F.col("_metric") == m, F.col("_wv") / F.col("_ww"))).alias(m) for m in metrics])


def scores_again(values: DataFrame, assets: DataFrame, families: DataFrame, weights: DataFrame) -> DataFrame:
    """(asset_id, scenario_tier, decade, climate_score): every percentile with the one weight it ends up with.

    A row weighs 1 / (families x layers of its family x codes of its layer); the counts are taken per row.
    """
    scope = assets.join(weights.where("weight = 1"), "asset_type").select("asset_id", "family").distinct()
    rows = values.where("percentile IS NOT NULL").join(families, "layer_id").join(scope, ["asset_id", "family"])
    rows = rows.select("asset_id", "family", "layer_id", "decade", "percentile", _tier().alias("scenario_tier"))
    forced = rows.where("scenario_tier IS NOT NULL")
    constant = rows.where("scenario_tier IS NULL").drop("scenario_tier", "decade")
    every = forced.unionByName(constant.join(forced.select("asset_id", "scenario_tier", "decade").distinct(), "asset_id"))
    cell = ["asset_id", "scenario_tier", "decade"]
    n_codes = F.count("*").over(W.partitionBy(*cell, "family", "layer_id"))
    n_layers = F.size(F.collect_set("layer_id").over(W.partitionBy(*cell, "family")))
    n_families = F.size(F.collect_set("family").over(W.partitionBy(*cell)))
    weighed = every.select(*cell, (F.col("percentile") / (n_codes * n_layers * n_families)).alias("_p"))
    total = F.round(F.sum("_p"), 9)
    # two digits, half to even, on the double itself
    return weighed.groupBy(*cell).agg((F.rint(total * 100) / 100).alias("climate_score"))


def vulnerable_again(values: DataFrame, hazards: DataFrame, threshold: float) -> DataFrame:
    """(scenario_tier, decade, n_assessed, n_vulnerable): an asset counts by the hazard that ranks first, if any has a percentile."""
    rows = values.select("asset_id", "layer_id", "decade", "percentile", _tier().alias("scenario_tier")).where("scenario_tier IS NOT NULL AND percentile IS NOT NULL")
    level = F.avg("percentile").over(W.partitionBy("asset_id", "scenario_tier", "decade", "layer_id"))
    ranked = rows.join(hazards.select("layer_id").distinct(), "layer_id", "left_semi").withColumn("_p", level)
    first = F.row_number().over(W.partitionBy("asset_id", "scenario_tier", "decade").orderBy(F.col("_p").desc()))
    top = ranked.withColumn("_k", first).where("_k = 1")
    return top.groupBy("scenario_tier", "decade").agg(F.count("*").alias("n_assessed"), F.count_if(F.col("_p") >= threshold).alias("n_vulnerable"))


def differences(delivered: DataFrame, again: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """(keys, item, problem): 'missing' or 'extra' rows once (item '*'), and each number that is 'absent', 'invented' or 'differs'."""
    keys = list(keys)
    left = delivered.select(*keys, F.struct(*[F.col(c).cast("double").alias(c) for c in columns]).alias("_a"))
    right = again.select(*keys, F.struct(*[F.col(c).cast("double").alias(c) for c in columns]).alias("_b"))
    met = left.join(right, keys, "full")
    whole = F.when(F.col("_a").isNull(), "missing").when(F.col("_b").isNull(), "extra")

    def of(c: str) -> Column:
        a, b = F.col(f"_a.{c}"), F.col(f"_b.{c}")
        wrong = F.when(a.isNull() & b.isNotNull(), "absent").when(a.isNotNull() & b.isNull(), "invented").when(F.abs(a - b) > tolerance, "differs")
        return F.struct(F.lit(c).alias("item"), F.when(whole.isNull(), wrong).alias("problem"))

    found = met.select(*keys, F.explode(F.array(F.struct(F.lit("*").alias("item"), whole.alias("problem")), *[of(c) for c in columns])).alias("_f"))
    return found.select(*keys, "_f.item", "_f.problem").where("problem IS NOT NULL")
