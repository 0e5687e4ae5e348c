"""Outputs: partitioned panels, delivery tables, manifests and payloads."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellcast.functions.scalar import sigfig, tier_rank


def write_panel(panel: DataFrame, path: str, attributes: Mapping[str, str] | None = None) -> None:
    """One partition per (layer, scenario), clustered by cell, plus a table of declared attributes."""
    clustered = panel.repartition("layer", "scenario", F.pmod(F.xxhash64("cell_id"), F.lit(64)))
    clustered.sortWithinPartitions("layer", "scenario", "cell_id").write.mode("overwrite").partitionBy(
        "layer", "scenario"
    ).parquet(f"{path}/panel")
    if attributes:
        rows = [(k, str(v)) for k, v in attributes.items()]
        spark = panel.sparkSession
        spark.createDataFrame(rows, "attribute STRING, value STRING").write.mode("overwrite").parquet(f"{path}/attributes")


def delivery_order(values: DataFrame) -> DataFrame:
    return values.orderBy("asset_id", "layer_id", "scenario", "decade")


def score_order(scores: DataFrame) -> DataFrame:
    return scores.orderBy("asset_id", tier_rank("scenario_tier"), "decade")


def write_star_schema(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Each delivery table sorted by its key; list columns joined by ';' when written as CSV."""
    for name, df in tables.items():
        if name == "values":
            df = delivery_order(df)
        elif name == "climate_score":
            df = score_order(df)
        if fmt == "csv":
            lists = {f.name: F.array_join(f.name, ";") for f in df.schema.fields if f.dataType.typeName() == "array"}
            df = df.withColumns(lists) if lists else df
            df.write.mode("overwrite").csv(f"{path}/{name}", header=True)
        else:
            df.write.mode("overwrite").parquet(f"{path}/{name}")


#: Bytes of a source file that are held at once.
_PIECE = 1 << 20


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files' digests, each read piece by piece from the file system that its path names."""
    from pyarrow import fs

    for batch in batches:
        found = []
        for uri in batch.column("path").to_pylist():
            system, path = fs.FileSystem.from_uri(quote(uri, safe=":/"))
            digest = hashlib.sha256()
            with system.open_input_stream(path) as stream:
                while piece := stream.read(_PIECE):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], names=["path", "sha256"])


def provenance(spark: SparkSession, path: str) -> DataFrame:
    """Size, modification time and sha256 of every source file, of any size.

    The listing reads no content; a task then streams its files in pieces of a megabyte. Executors need an
    Arrow driver for the paths' scheme.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    digests = files.select("path").repartition(tasks, "path").mapInArrow(_digests, "path STRING, sha256 STRING")
    return files.join(digests, "path").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), "modificationTime", "sha256"
    )


def manifest(values: DataFrame, scores: DataFrame) -> DataFrame:
    """Row counts by status and of incomplete score rows: (table, item, n)."""
    by_status = values.groupBy("data_status").agg(F.count("*").alias("n"))
    done = F.col("n_hazards") >= F.col("n_hazards_expected")
    by_done = scores.groupBy(F.when(done, "complete").otherwise("incomplete").alias("item")).agg(F.count("*").alias("n"))
    return by_status.select(F.lit("values").alias("table_name"), F.col("data_status").alias("item"), "n").unionByName(
        by_done.select(F.lit("climate_score").alias("table_name"), "item", "n")
    )


def manifest_json(counts: DataFrame) -> DataFrame:
    """The manifest as one JSON document (a few rows, bounded by statuses)."""
    entry = F.struct("table_name", "item", "n")
    return counts.agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("manifest"))


def payload_json(values: DataFrame, assets: DataFrame, metrics: Sequence[str], digits: int = 4) -> DataFrame:
    """One compact JSON series per (location, layer, scenario), metrics at `digits` significant figures.

    Assets at one location share their values, so the first asset id stands for the location.
    """
    located = values.join(assets.select("asset_id", "location_id"), "asset_id")
    first = [F.min_by(m, "asset_id").alias(m) for m in metrics]
    one = located.groupBy("location_id", "layer_id", "scenario", "decade").agg(*first)
    point = F.struct("decade", *[sigfig(m, digits).alias(m) for m in metrics])
    series = F.to_json(F.array_sort(F.collect_list(point)))
    return one.groupBy("location_id", "layer_id", "scenario").agg(series.alias("series"))


def coded_to_wide(df: DataFrame, names: Mapping[int, str], keys: Sequence[str]) -> DataFrame:
    """Value-class code rows -> one column per metric; short decade indices become years."""
    decade = F.when(F.col("decade") < 100, F.col("decade") + 2000).otherwise(F.col("decade"))
    wide = df.withColumn("decade", decade).groupBy(*keys, "decade").pivot("code", list(names)).agg(F.max("value"))
    return wide.withColumnsRenamed({str(k): v for k, v in names.items()})


def wide_to_coded(df: DataFrame, names: Mapping[int, str], keys: Sequence[str]) -> DataFrame:
    by_name = {v: k for k, v in names.items()}
    long = df.unpivot([*keys, "decade"], list(by_name), "metric", "value")
    code = F.create_map(*[F.lit(x) for kv in by_name.items() for x in kv])[F.col("metric")]
    return long.withColumn("code", code).drop("metric").where("value IS NOT NULL")
