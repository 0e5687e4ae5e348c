"""Lag selection, price model and flood-frequency shift."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cellcast.functions.vectorized import log_gamma, pearson3_exceedance, pearson3_quantile
from cellcast.session import cut_lineage


def _inversions(row: np.ndarray, rank: np.ndarray, n_rows: int) -> np.ndarray:
    """Per row the pairs whose later element ranks lower. `row` rises; ranks start at 0.

    Merge counting for all rows at once: on each level, blocks of twice the width are put in order, and every
    element of a right half counts the elements of its left half that lie above it.
    """
    place = np.arange(len(row)) - np.searchsorted(row, row)
    top = int(rank.max(initial=0)) + 1
    out, width = np.zeros(n_rows), 1
    while width <= place.max(initial=0):
        block, right = place // (2 * width), place // width % 2
        key = ((row * (place.max() // (2 * width) + 1) + block) * top + rank) * 2 + right
        order = np.argsort(key, kind="stable")
        of = (key[order] // (2 * top))  # the block, over all rows
        is_left = right[order] == 0
        seen = np.cumsum(is_left)
        first = np.searchsorted(of, of, "left")
        last = np.searchsorted(of, of, "right") - 1
        above = seen[last] - seen  # left elements of the block that come after
        out += np.bincount(row[order], np.where(is_left, 0, above), n_rows)
        width *= 2
    return out


def _tie_sums(row: np.ndarray, *keys: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the sums over groups of t equal keys of t(t-1)/2, t(t-1)(2t+5) and t(t-1)(t-2)."""
    order = np.lexsort((*keys, row))
    new = np.ones(len(row), bool)
    if len(row):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in (row, *keys)])
    first = np.flatnonzero(new)
    t = np.diff(np.append(first, len(row))).astype(float)
    of = row[order][first]
    return tuple(np.bincount(of, v, n_rows) for v in (t * (t - 1) / 2, t * (t - 1) * (2 * t + 5), t * (t - 1) * (t - 2)))


def kendall(row: np.ndarray, x: np.ndarray, y: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(concordant less discordant pairs, their variance without a relation, ties allowed for) of each row."""
    order = np.lexsort((y, x, row))
    row, x, y = row[order], x[order], y[order]
    n = np.bincount(row, minlength=n_rows).astype(float)
    rank = np.unique(y, return_inverse=True)[1]
    (px, vx, wx), (py, vy, wy), (pxy, _, _) = (_tie_sums(row, *k, n_rows=n_rows) for k in ((x,), (y,), (x, y)))
    s = n * (n - 1) / 2 - px - py + pxy - 2 * _inversions(row, rank, n_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        var = (n * (n - 1) * (2 * n + 5) - vx - vy) / 18 + px * py * 2 / (n * (n - 1)) + wx * wy / (9 * n * (n - 1) * (n - 2))
    return s, np.where(n >= 3, var, np.nan)


def kendall_p(x: np.ndarray, y: np.ndarray) -> float | None:
    """Two-sided p-value of Kendall's tau by the normal approximation with ties."""
    s, var = kendall(np.zeros(len(x), np.int64), np.asarray(x, float), np.asarray(y, float), 1)
    return math.erfc(abs(s[0]) / math.sqrt(2 * var[0])) if var[0] > 0 else None


@F.arrow_udf(StructType([StructField(c, DoubleType()) for c in ("s", "z", "p")]))
def kendall_test(pairs: pa.Array) -> pa.Array:
    """Kendall's S, its standard score and p-value of arrays of (x, y), all arrays of a batch together; NULL below three pairs or without variation."""
    flat = pairs.flatten()
    x, y = (flat.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y"))
    row = np.repeat(np.arange(len(pairs)), pairs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    s, var = kendall(row, x, y, len(pairs))
    ok = var > 0
    z = np.where(ok, s / np.sqrt(np.where(ok, var, 1.0)), np.nan)
    p = np.array([math.erfc(abs(v) / math.sqrt(2)) if k else np.nan for v, k in zip(z, ok)])
    return pa.StructArray.from_arrays([pa.array(np.where(ok, v, np.nan), from_pandas=True) for v in (s, z, p)], names=["s", "z", "p"])


def lag_scores(df: DataFrame, keys: Sequence[str], order: str, feature: str, target: str, lags: Sequence[int]) -> DataFrame:
    """(keys, lag, n, s, z, p): Kendall's test of the feature's change over each lag against the target.

    Each (station, lag) is one array row, bounded by the length of the record.
    """
    w = W.partitionBy(*keys).orderBy(order)
    table = F.array(*[F.struct(F.lit(int(n)).alias("lag"), (F.col(feature) - F.lag(feature, n).over(w)).alias("x")) for n in lags])
    rows = df.withColumn("_l", table).select(*keys, F.col(target).alias("_y"), F.explode("_l").alias("_l"))
    both = rows.where(F.col("_y").isNotNull() & F.col("_l.x").isNotNull())
    pair = F.struct(F.col("_l.x").cast("double").alias("x"), F.col("_y").cast("double").alias("y"))
    series = both.groupBy(*keys, F.col("_l.lag").alias("lag")).agg(F.collect_list(pair).alias("_s"))
    return series.select(*keys, "lag", F.size("_s").cast("long").alias("n"), kendall_test("_s").alias("_k")).select(*keys, "lag", "n", "_k.s", "_k.z", "_k.p")


def best_lag(df: DataFrame, keys: Sequence[str], order: str, feature: str, target: str, lags: Sequence[int]) -> DataFrame:
    """Per station the lag whose differenced feature has the smallest Kendall p-value against the target."""
    scored = lag_scores(df, keys, order, feature, target, lags).where("p IS NOT NULL")
    best = scored.groupBy(*keys).agg(F.min(F.struct("p", "lag")).alias("_b"))
    return best.select(*keys, F.col("_b.lag").alias("lag"), F.col("_b.p").alias("p_value"))


def price_model(
    features: DataFrame, inputs: Sequence[str], target: str, train: Column, holdout: Column, trees: int = 20, folds: int = 3, seed: int = 7
) -> DataFrame:
    """Random forest tuned by cross-validation; one row with the holdout R2 and row counts."""
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    known = cut_lineage(features.select(*inputs, target, train.alias("_train"), holdout.alias("_hold")).dropna(subset=[*inputs, target]))
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="features")
    forest = RandomForestRegressor(labelCol=target, featuresCol="features", numTrees=trees, seed=seed)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, [4, 7]).build()
    r2 = RegressionEvaluator(labelCol=target, metricName="r2")
    search = CrossValidator(
        estimator=Pipeline(stages=[assembler, forest]), estimatorParamMaps=grid, evaluator=r2, numFolds=folds, seed=seed, parallelism=2
    )
    model = search.fit(known.where("_train"))
    scored = model.transform(known.where("_hold"))
    return scored.agg(F.regr_r2(target, "prediction").alias("holdout_r2"), F.count("*").alias("n_holdout"))


def l_moments(series: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """(keys, n, l1, l2, t3): sample L-moments from ranked sums; a series is one value per year."""
    w = W.partitionBy(*keys).orderBy(value)
    all_rows = W.partitionBy(*keys)
    ranked = series.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).alias("v"), (F.row_number().over(w) - 1).alias("i"), F.count("*").over(all_rows).alias("n")
    )
    n, i, v = F.col("n"), F.col("i"), F.col("v")
    b = ranked.groupBy(*keys, "n").agg(
        F.avg(v).alias("b0"),
        (F.sum(v * i) / F.nullif(F.first(n) * (F.first(n) - 1), F.lit(0))).alias("b1"),
        (F.sum(v * i * (i - 1)) / F.nullif(F.first(n) * (F.first(n) - 1) * (F.first(n) - 2), F.lit(0))).alias("b2"),
        F.max(v).alias("top"),
        F.min(v).alias("low"),
    )
    l2 = 2 * F.col("b1") - F.col("b0")
    l3 = 6 * F.col("b2") - 6 * F.col("b1") + F.col("b0")
    return b.select(*keys, "n", F.col("b0").alias("l1"), l2.alias("l2"), (l3 / F.nullif(l2, F.lit(0.0))).alias("t3"), "top", "low")


def pearson3_parameters(l1, l2, t3):
    """Mean, standard deviation and skew of Pearson III distributions with the given L-moments (arrays or numbers)."""
    l1, l2, t3 = (np.asarray(x, float) for x in (l1, l2, t3))
    a = np.abs(t3)
    near = np.maximum(np.minimum(a, 1 / 3), 1e-6)
    # Rational approximation of the shape parameter from the L-skewness.
    z = 3 * math.pi * near * near
    low = (1 + 0.2906 * z) / (z + 0.1882 * z**2 + 0.0442 * z**3)
    z = 1 - np.maximum(a, 1 / 3)
    high = (0.36067 * z - 0.59567 * z**2 + 0.25361 * z**3) / (1 - 2.78861 * z + 2.56096 * z**2 - 0.77045 * z**3)
    shape = np.where(a <= 1 / 3, low, high)
    spread = l2 * np.sqrt(math.pi * shape) * np.exp(log_gamma(shape) - log_gamma(shape + 0.5))
    plain = a < 1e-6
    return l1, np.where(plain, l2 * math.sqrt(math.pi), spread), np.where(plain, 0.0, np.copysign(2 / np.sqrt(shape), t3))


def shifted_periods(old: Sequence[np.ndarray], new: Sequence[np.ndarray], period: float) -> np.ndarray:
    """Period, under the new L-moments, of the event of the given period under the old ones; NaN without spread."""
    (m, s, g), (m2, s2, g2) = pearson3_parameters(*old), pearson3_parameters(*new)
    ok = (s > 0) & (s2 > 0)
    volume = m + s * pearson3_quantile(1 - 1 / period, g)
    p = pearson3_exceedance(g2, (volume - m2) / np.where(ok, s2, 1.0))
    with np.errstate(divide="ignore"):
        return np.where(ok, 1 / p, np.nan)


def flood_frequency_shift(hist: DataFrame, fut: DataFrame, keys: Sequence[str], period: float, value: str = "value") -> DataFrame:
    """Return period, under future values, of the event that recurred every `period` years in the past."""
    h, f = l_moments(hist, keys, value), l_moments(fut, keys, value)
    names = ("l1", "l2", "t3")
    both = h.select(*keys, *[F.col(n).alias(f"h_{n}") for n in names]).join(f.select(*keys, *[F.col(n).alias(f"f_{n}") for n in names]), list(keys))

    @F.pandas_udf(DoubleType())
    def shift(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series, e: pd.Series, g: pd.Series) -> pd.Series:
        moments = [x.to_numpy(float, na_value=np.nan) for x in (a, b, c, d, e, g)]
        known = ~np.isnan(np.array(moments)).any(axis=0)
        out = np.full(len(a), np.nan)
        if known.any():
            given = [x[known] for x in moments]
            out[known] = shifted_periods(given[:3], given[3:], period)
        return pd.Series(out).astype(object).where(~np.isnan(out), None)

    return both.select(*keys, shift(*[F.col(f"{s}_{n}") for s in ("h", "f") for n in names]).alias("new_period"))
