"""Small helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, *columns: str, n: int = 6) -> DataFrame:
    """Round float columns so both engines print the same value."""
    return df.withColumns({c: F.round(c, n) for c in columns})



def gamma_quantiles_sql(shapes: str, levels: str, terms: int = 1000) -> str:
    """CTEs `gammabox` and `gammaquant` (a, q, x): quantiles of Gamma(a, 1) for the shapes `a` that the SQL gives,
    by halving brackets; P(a, x) is its power series. Belongs after WITH RECURSIVE."""
    return f"""gammabox AS (
        SELECT CAST(a AS DOUBLE) AS a, CAST(q AS DOUBLE) AS q, 0e0 AS lo, CAST(a + 20 * sqrt(a) + 50 AS DOUBLE) AS hi, 0 AS step FROM ({shapes}) gs, (VALUES {levels}) gl(q)
        UNION ALL
        SELECT a, q, CASE WHEN p < q THEN m ELSE lo END, CASE WHEN p < q THEN hi ELSE m END, step + 1
        FROM (SELECT *, (lo + hi) / 2 AS m, {gamma_below_sql('a', '(lo + hi) / 2', terms)} AS p FROM gammabox WHERE step < 70) gb),
    gammaquant AS (SELECT a, q, (lo + hi) / 2 AS x FROM gammabox WHERE step = 70)"""


def gamma_below_sql(a: str, x: str, terms: int = 1000) -> str:
    """P(a, x) by its power series."""
    return f"list_sum([exp(({a} + k) * ln({x}) - {x} - lgamma({a} + k + 1)) FOR k IN range(0, {terms})])"
