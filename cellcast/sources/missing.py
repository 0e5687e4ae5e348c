"""Missing values become NULL once, at ingest, so no aggregate ever meets NaN or a fill value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_value(c: Column, fill: float | None = None, sentinel: float | None = None, max_abs: float = 1e19) -> Column:
    """NULL for NaN, infinities, huge fill values, the declared fill (rtol 1e-6) and the sentinel."""
    bad = F.isnan(c) | (F.abs(c) >= max_abs)
    if fill is not None:
        bad = bad | (F.abs(c - fill) <= abs(fill) * 1e-6)
    if sentinel is not None:
        bad = bad | (c == sentinel)
    return F.when(~bad, c)


def normalize_missing(df: DataFrame, *columns: str, fill: float | None = None, sentinel: float | None = None) -> DataFrame:
    return df.withColumns({c: clean_value(F.col(c).cast("double"), fill, sentinel) for c in columns})


def drop_negative(df: DataFrame, column: str) -> DataFrame:
    """Negative -> NULL, keeping a flag column that `negative_report` counts."""
    return df.withColumns({"was_negative": F.coalesce(F.col(column) < 0, F.lit(False)),
                           column: F.when(F.col(column) >= 0, F.col(column))})
