"""Tables from storage: member series, customer lists, source grids, point events, configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED_INPUT = ["Location", "Lat", "Lon", "Asset_Type"]
OPTIONAL_INPUT = [
    "Sub_Asset_Unit", "Country", "State", "City", "Region", "Subregion", "Layers", "Coord_Source",
    "Asset_Value", "Currency", "Valuation_Date", "Value_Basis",
]
NON_PROJECTION = ["picontrol", "historical", "obsclim", "counterclim"]


def read_annual(spark: SparkSession, path: str, min_year: int, max_year: int) -> DataFrame:
    """Member series in a year range; the filter reaches the Parquet scan."""
    return spark.read.parquet(path).where(F.col("year").between(min_year, max_year))


def read_customer_input(spark: SparkSession, path: str) -> DataFrame:
    """Customer site list (CSV, or TSV by suffix): trimmed headers, required columns, optional ones as NULL.

    Every column is read as text; `quality.input_checks` coerces and reports.
    """
    sep = "\t" if path.rstrip("/").lower().endswith((".tsv", ".tab")) else ","
    raw = spark.read.csv(path, header=True, sep=sep, inferSchema=False, ignoreLeadingWhiteSpace=True)
    df = raw.toDF(*[c.strip() for c in raw.columns])
    missing = [c for c in REQUIRED_INPUT if c not in df.columns]
    if missing:
        raise ValueError(f"input {path} lacks required columns: {', '.join(missing)}")
    absent = {c: F.lit(None).cast("string") for c in OPTIONAL_INPUT if c not in df.columns}
    return df.withColumns(absent) if absent else df


def read_source_grid(
    spark: SparkSession, path: str, value: str, grid: DataFrame, decimals: int = 3
) -> DataFrame:
    """One CSV row per cell in any order, placed on `grid` by rounded coordinate; '' is NULL."""
    raw = spark.read.csv(path, header=True, schema=f"lat DOUBLE, lon DOUBLE, {value} DOUBLE", nullValue="")
    keyed = raw.select(F.round("lat", decimals).alias("_la"), F.round("lon", decimals).alias("_lo"), value)
    placed = grid.withColumns({"_la": F.round("lat", decimals), "_lo": F.round("lon", decimals)})
    return placed.join(keyed, ["_la", "_lo"], "left").drop("_la", "_lo")


def read_point_events(
    spark: SparkSession, path: str, schema: str, years: tuple[int, int], bbox: tuple[float, float, float, float]
) -> DataFrame:
    """Event CSV within a year range and a (south, north, west, east) box of start points."""
    south, north, west, east = bbox
    events = spark.read.csv(path, header=True, schema=schema)
    return events.where(
        F.col("year").between(*years) & F.col("slat").between(south, north) & F.col("slon").between(west, east)
    )


def check_keys(df: DataFrame, key: str, allowed: Sequence[str]) -> DataFrame:
    """Rows of a configuration table whose key is not a known one."""
    return df.where(~F.col(key).isin(list(allowed)))


def flatten_catalog(catalog: DataFrame) -> DataFrame:
    """(entry, aliases ARRAY, weights MAP) -> one row per (entry, alias, family, weight)."""
    alias = catalog.select("entry", F.explode(F.array_union(F.array("entry"), "aliases")).alias("alias"), "weights")
    return alias.select("entry", F.lower(F.trim("alias")).alias("alias"), F.explode("weights").alias("family", "weight"))


def alias_collisions(flat: DataFrame) -> DataFrame:
    """Aliases claimed by more than one catalog entry."""
    n = F.count_distinct("entry")
    return flat.groupBy("alias").agg(n.alias("n_entries")).where("n_entries > 1")


def list_scenarios(df: DataFrame, keys: Sequence[str] = ("layer",)) -> DataFrame:
    """Scenarios present in storage, without control and historical runs.

    On a table partitioned by scenario this reads partition values only.
    """
    return df.select(*keys, "scenario").distinct().where(~F.lower("scenario").isin(NON_PROJECTION))
