"""Facts read from file names and time axes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

def parse_member_name(df: DataFrame, path: str = "path", variable: str | None = None) -> DataFrame:
    """Columns model, gcm, scenario, soc, sens, variable, cadence, y0, y1 from a member file name.

    With `variable` given, a file of another variable is an error, not a silent row.
    """
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[a-z0-9]+$", "")
    parts = F.split(stem, "_")
    out = df.withColumn("_parts", parts)
    part = lambda k: F.element_at("_parts", -k)
    # ...: model _ gcm _ bias _ scenario _ soc _ sens _ variable _ region _ cadence _ y0 _ y1
    out = out.select(
        *df.columns,
        part(11).alias("model"),
        part(10).alias("gcm"),
        part(8).alias("scenario"),
        part(7).alias("soc"),
        part(6).alias("sens"),
        part(5).alias("variable"),
        part(3).alias("cadence"),
        part(2).cast("int").alias("y0"),
        part(1).cast("int").alias("y1"),
    )
    if variable is not None:
        wrong = F.raise_error(F.concat(F.lit("unexpected variable in "), F.col(path))).cast("string")
        out = out.withColumn("variable", F.when(F.col("variable") == variable, F.col("variable")).otherwise(wrong))
    return out


def decode_cf_year(offset: Column, units: Column, calendar: Column) -> Column:
    """Calendar year of a '<unit> since <date>' offset; fixed-length calendars by rounding days."""
    unit = F.regexp_extract(units, r"^\s*(\w+?)s?\s+since", 1)
    start = F.regexp_extract(units, r"since\s+(\d{1,4})", 1).cast("int")
    month = F.regexp_extract(units, r"since\s+\d{1,4}-(\d{1,2})", 1).cast("int")
    day = F.regexp_extract(units, r"since\s+\d{1,4}-\d{1,2}-(\d{1,2})", 1).cast("int")
    length = (
        F.when(calendar == "360_day", 360.0).when(calendar.isin("noleap", "365_day"), 365.0).otherwise(365.25)
    )
    real = calendar.isin("standard", "gregorian", "proleptic_gregorian")
    by_date = F.year(F.date_add(F.make_date(start, month, day), F.floor(offset).cast("int")))
    return (
        F.when(unit == "year", F.round(start + offset).cast("int"))
        .when(unit == "month", F.floor(start + (month - 1 + offset) / 12).cast("int"))
        .when((unit == "day") & real, by_date)
        .when(unit == "day", F.floor(start + ((month - 1) * length / 12 + day - 1 + offset) / length).cast("int"))
    )


def year_axis_gaps(df: DataFrame, keys: Sequence[str], year: str = "year") -> DataFrame:
    """Violations of a contiguous year axis: (keys, year, problem) for gaps and duplicates."""
    per_year = df.groupBy(*keys, year).agg(F.count("*").alias("_n"))
    before = F.lag(year).over(W.partitionBy(*keys).orderBy(year))
    flagged = per_year.withColumn("_before", before).withColumn(
        "problem",
        F.when(F.col("_n") > 1, "duplicate").when(F.col(year) - F.col("_before") > 1, "gap"),
    )
    return flagged.where("problem IS NOT NULL").select(*keys, year, "problem")


def span_mismatches(df: DataFrame, names: DataFrame, keys: Sequence[str], year: str = "year") -> DataFrame:
    """Years the file names promise (y0..y1 per key) that the data does not hold."""
    promised = names.select(*keys, F.explode(F.sequence("y0", "y1")).alias(year)).distinct()
    return promised.join(df.select(*keys, year).distinct(), [*keys, year], "left_anti")
