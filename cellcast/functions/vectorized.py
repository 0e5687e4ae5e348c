"""Arrow-batched column functions for the few formulas no built-in expression covers."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


# Lanczos coefficients for g = 7.
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905,
    -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)


def log_gamma(a: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers; below a half by reflection."""
    a = np.asarray(a, float)
    small = a < 0.5
    x = np.where(small, 1 - a, a) - 1
    t = x + 7.5
    series = _LANCZOS[0] + sum(c / (x + i) for i, c in enumerate(_LANCZOS[1:], 1))
    # beyond this the series' terms no longer matter, and Stirling's formula keeps more digits
    far = np.maximum(x + 1, 1.0)
    stirling = (far - 0.5) * np.log(far) - far + 0.5 * math.log(2 * math.pi) + 1 / (12 * far) - 1 / (360 * far**3)
    whole = np.where(x > 50, stirling, 0.5 * math.log(2 * math.pi) + (x + 0.5) * np.log(t) - t + np.log(series))
    with np.errstate(divide="ignore"):
        return np.where(small, np.log(math.pi / np.sin(math.pi * np.where(small, a, 0.5))) - whole, whole)


def _terms(a: np.ndarray) -> int:
    """Terms that both expansions need at most near x = a, where they are slowest: some multiples of sqrt(a)."""
    return int(500 + 40 * math.sqrt(float(np.max(a))))


def regularized_gamma(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """P(a, x) by its power series below a+1 and by the continued fraction above."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    out = np.zeros(a.shape)
    front = np.exp(a * np.log(np.maximum(x, 1e-300)) - x - log_gamma(a))
    small = (x < a + 1) & (x > 0)
    if small.any():
        aa, xx = a[small], x[small]
        term = total = 1.0 / aa
        k = aa.copy()
        for _ in range(_terms(aa)):
            k = k + 1
            term = term * xx / k
            total = total + term
            if np.all(np.abs(term) < np.abs(total) * 1e-16):
                break
        else:
            raise ArithmeticError("the incomplete gamma series has not converged")
        out[small] = front[small] * total
    big = x >= a + 1
    if big.any():
        aa, xx = a[big], x[big]
        tiny = 1e-300
        b = xx + 1 - aa
        c = np.full_like(xx, 1 / tiny)
        d = 1 / b
        h = d.copy()
        for i in range(1, _terms(aa)):
            an = -i * (i - aa)
            b = b + 2
            d = an * d + b
            d = np.where(np.abs(d) < tiny, tiny, d)
            c = b + an / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            d = 1 / d
            step = d * c
            h = h * step
            if np.all(np.abs(step - 1) < 1e-15):
                break
        else:
            raise ArithmeticError("the incomplete gamma fraction has not converged")
        out[big] = 1 - front[big] * h
    return out


def gamma_ppf(q: float, a: np.ndarray) -> np.ndarray:
    """Quantile of Gamma(shape a, rate 1): Newton steps, kept in a bracket that surely holds it."""
    a = np.asarray(a, float)
    lo, hi = np.zeros_like(a), a + 20 * np.sqrt(a) + 50
    x, log_norm = np.clip(a, 1e-3, None), log_gamma(a)
    for _ in range(200):
        over = regularized_gamma(a, x) - q
        lo, hi = np.where(over < 0, x, lo), np.where(over < 0, hi, x)
        density = np.exp((a - 1) * np.log(x) - x - log_norm)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            step = x - over / density
        new = np.where((step > lo) & (step < hi), step, 0.5 * (lo + hi))
        if np.all(np.abs(new - x) <= 1e-14 * np.maximum(x, 1e-300)):
            return new
        x = new
    return x


def gamma_quantile(q: float):
    """Column function (shape, rate) -> the q-quantile of the Gamma distribution."""

    @F.pandas_udf(DoubleType())
    def quantile(shape: pd.Series, rate: pd.Series) -> pd.Series:
        shapes, back = np.unique(shape.to_numpy(float), return_inverse=True)
        return pd.Series(gamma_ppf(q, shapes)[back] / rate.to_numpy(float))

    return quantile


@F.pandas_udf(DoubleType())
def lgamma(x: pd.Series) -> pd.Series:
    return pd.Series(log_gamma(x.to_numpy(float)))


#: Pair slopes held at once by the kernel: cells whose years are the same are worked on together up to this size.
_PAIRS_AT_ONCE = 1 << 21


def _medians_of_heads(slopes: np.ndarray, heads: list[int]) -> np.ndarray:
    """Median of the first `n` columns of each row, for each n of `heads`; NaN where n is 0. Exact.

    Of long rows a sample brackets the median, so that only what lies in the bracket is put in order.
    """
    out = np.full((len(slopes), len(heads)), np.nan)
    for k, n in enumerate(heads):
        if n and n < 20_000:
            out[:, k] = np.median(slopes[:, :n], axis=1)
        elif n:
            for row, all_slopes in enumerate(slopes):
                out[row, k] = _bracketed_median(all_slopes[:n])
    return out


def _bracketed_median(x: np.ndarray) -> float:
    n = len(x)
    sample = np.sort(x[:: n // 2000])
    low, high = sample[[int(0.45 * len(sample)), int(0.55 * len(sample))]]
    below = int(np.count_nonzero(x < low))
    inside = x[(x >= low) & (x <= high)]
    ranks = [(n - 1) // 2 - below, n // 2 - below]
    if ranks[0] < 0 or ranks[1] >= len(inside):
        return float(np.median(x))
    inside.partition(ranks)
    return float(0.5 * (inside[ranks[0]] + inside[ranks[1]]))


def pair_slope_medians(x: np.ndarray, y: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(cells, ends): median slope of all pairs of points of different years up to each end.

    `x` holds the years of the points in rising order, `y` a row of values per cell. Each later year meets
    the points before it once; an end that takes in more years only adds their pairs.
    """
    years, first = np.unique(x, return_index=True)
    past = np.append(first[1:], len(x))
    count = np.cumsum((past - first) * first)  # pairs up to each year
    heads = [int(count[k - 1]) if k else 0 for k in np.searchsorted(years, ends, "right")]
    out = np.full((len(y), len(ends)), np.nan)
    moving = np.flatnonzero(y.min(axis=1) < y.max(axis=1)) if y.size else np.zeros(0, int)
    out[:, [n > 0 for n in heads]] = 0.0  # what a constant cell gets
    step = max(1, _PAIRS_AT_ONCE // max(1, heads[-1]))
    for i in range(0, len(moving), step):
        rows = y[moving[i : i + step]]
        slopes = np.empty((len(rows), heads[-1]))
        at = 0
        for year, a, b in zip(years, first, past):
            if a and at < heads[-1]:
                block = (rows[:, a:b, None] - rows[:, None, :a]) / (year - x[:a])
                slopes[:, at : at + (b - a) * a] = block.reshape(len(rows), -1)
                at += (b - a) * a
        out[moving[i : i + step]] = _medians_of_heads(slopes, heads)
    return out


def _stacks(points: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each point, year, value) of arrays of (y, v), by row and year."""
    flat = points.flatten()
    year, value = (flat.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("y", "v"))
    row = np.repeat(np.arange(len(points)), points.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    order = np.lexsort((year, row))
    return row[order], year[order], value[order]


def theil_sen_at(ends: Sequence[int]):
    """Column function: array of (y year, v value) -> per end the exact median slope of all pairs of points of
    different years up to it. NULL where there is no such pair; a NULL array gives NULL."""
    stops = np.asarray(ends, float)
    if not len(stops) or (np.diff(stops) <= 0).any():
        raise ValueError("ends must rise")

    @F.arrow_udf("array<double>")
    def medians(points: pa.Array) -> pa.Array:
        row, year, value = _stacks(points)
        border = np.searchsorted(row, np.arange(len(points) + 1))
        same: dict[bytes, list[int]] = {}
        for k in range(len(points)):
            same.setdefault(year[border[k] : border[k + 1]].tobytes(), []).append(k)
        out = np.full((len(points), len(stops)), np.nan)
        for layout, cells in same.items():
            x = np.frombuffer(layout)
            if len(x):
                out[cells] = pair_slope_medians(x, value[border[cells][:, None] + np.arange(len(x))], stops)
        flat = pa.array(out.ravel(), from_pandas=True)
        return pa.ListArray.from_arrays(np.arange(0, out.size + 1, len(stops), dtype=np.int32), flat, mask=points.is_null())

    return medians


def theil_sen(points: str | Column) -> Column:
    """Median slope of all pairs of an array of (y, v)."""
    return theil_sen_at([1_000_000])(points)[0]


def normal_upper(z: np.ndarray) -> np.ndarray:
    """P(Z > z) of a standard normal variate, from the incomplete gamma function at shape 1/2."""
    z = np.asarray(z, float)
    half = 0.5 * (1 - regularized_gamma(np.full(z.shape, 0.5), z * z / 2))
    return np.where(z > 0, half, 1 - half)


def pearson3_exceedance(skew: np.ndarray, z: np.ndarray) -> np.ndarray:
    """P(Z > z) for standardized Pearson III variates of the given skews."""
    skew, z = np.broadcast_arrays(np.asarray(skew, float), np.asarray(z, float))
    plain = np.abs(skew) < 1e-6
    a = 4 / np.where(plain, 1.0, skew) ** 2
    x = a + z * np.sqrt(a) * np.where(skew > 0, 1, -1)
    below = regularized_gamma(a, np.maximum(x, 0.0))
    beyond = np.where(skew > 0, 1 - below, below)
    return np.where(plain, normal_upper(z), beyond)


def pearson3_quantile(q: float, skew: np.ndarray) -> np.ndarray:
    """The standardized value that a share `q` stays below."""
    skew = np.asarray(skew, float)
    plain = np.abs(skew) < 1e-6
    a = 4 / np.where(plain, 1.0, skew) ** 2
    up, down = (gamma_ppf(p, a) for p in (q, 1 - q))
    z = np.where(skew > 0, up - a, a - down) / np.sqrt(a)
    if plain.any():  # the square of a normal variate is gamma of shape 1/2
        tail = abs(2 * q - 1)
        z = np.where(plain, math.copysign(math.sqrt(2 * float(gamma_ppf(tail, np.array([0.5]))[0])), q - 0.5), z)
    return z
