"""Incremental reductions of arriving chunks, equal to their batch counterparts.

Results are written per micro-batch into a folder named after the batch id, which a retried batch
overwrites, so a restart neither loses nor doubles rows. `latest` reads the newest row per key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cellcast.operators.daily import KEYS, WET_DAY_MM, log_bin, threshold_columns

CHUNK_SCHEMA = "chunk_id STRING, member STRING, cell_id BIGINT, day DATE, value DOUBLE"


def read_chunks(spark: SparkSession, path: str, files_per_trigger: int = 1, schema: str = CHUNK_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_to_end(stream: DataFrame, output: str, checkpoint: str, mode: str) -> None:
    """Process everything available, one output folder per micro-batch, then stop."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest(spark: SparkSession, output: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of each key over all batches."""
    rows = spark.read.parquet(output)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r"))
    return newest.select(*keys, "_r.*")


def _chunk_key() -> Column:
    """A folder name for any chunk id."""
    return F.hex(F.xxhash64("chunk_id"))


def ingest_once(stream: DataFrame, output: str, checkpoint: str, keys: Sequence[str] = ("member", "cell_id", "day")) -> None:
    """Append the rows of arriving chunks, each (chunk_id, *keys) once, however late a chunk is or often it comes.

    The output is its own ledger: a chunk's rows lie in a folder of the chunk, by the batch that wrote them.
    A micro-batch opens the folders of its own chunks only (their names, at most one per file of the batch,
    go to the driver), so what it reads does not grow with the batches before. A retried batch overwrites
    its own folders and does not read them. Both sides of the comparison are shuffled: sorted keys take so
    little room in files that Spark would send the rows of whole chunks through the driver.
    """
    spark, schema = stream.sparkSession, f"{_ddl(stream)}, chunk_key STRING, batch BIGINT"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.dropDuplicates(["chunk_id", *keys]).withColumn("chunk_key", _chunk_key())
        names = batch.select(_chunk_key().alias("chunk_key")).distinct().collect()
        known = [f for f in (f"{output}/chunk_key={r[0]}" for r in names) if _exists(spark, f)]
        if known:
            before = spark.read.schema(schema).option("basePath", output).parquet(*known).where(F.col("batch") < batch_id)
            seen = before.select(*[F.col(c).alias(f"_{c}") for c in ("chunk_id", *keys)]).hint("merge")
            rows = rows.join(seen, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("chunk_id", *keys)]), "left_anti")
        written = rows.withColumn("batch", F.lit(batch_id).cast("long"))
        written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk_key", "batch").parquet(output)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def ingested(spark: SparkSession, output: str, schema: str = CHUNK_SCHEMA) -> DataFrame:
    """All rows that `ingest_once` has kept."""
    return spark.read.schema(schema).parquet(output)


def stream_threshold_counts(stream: DataFrame, ladder: Sequence[tuple[str, str, float]], keys: Sequence[str] = KEYS) -> DataFrame:
    """Per-year counters folded over the chunks; run in update mode."""
    return stream.groupBy(*keys, F.year("day").alias("year")).agg(*threshold_columns(ladder))


def stream_histogram(stream: DataFrame, key: Sequence[str] = ("cell_id",)) -> DataFrame:
    """Mergeable wet-day histogram folded over the chunks; run in update mode."""
    return stream.where(F.col("value") >= WET_DAY_MM).groupBy(*key, log_bin().alias("bin")).agg(F.count("*").alias("n"))


#: The id that sums of rows without a cell bear.
NO_CELL = -(1 << 63)

#: Cells of one member whose series share a state and a call, as a power of two; and the days between two of them.
_CELL_BITS, _APART = 6, 1 << 40


def _five_day_sums(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Sums completed by the new days. State: borders of the stretches seen so far, and the days within four of a border.

    The series of a block of cells lie one after the other on one axis of days, too far apart to touch.
    """
    starts, ends, kept, held = (np.array(x, t) for x, t in zip(state.get if state.exists else ([],) * 4, ("int64",) * 3 + ("float64",)))
    new = pd.concat([f[["place", "day_number", "value"]] for f in frames])
    day, first = np.unique(new["place"].to_numpy("int64") * _APART + new["day_number"].to_numpy("int64"), return_index=True)
    value = new["value"].to_numpy("float64")[first]
    if len(starts):
        at = np.searchsorted(starts, day, side="right") - 1
        unseen = (at < 0) | (day > ends[np.maximum(at, 0)])
        day, value = day[unseen], value[unseen]
    days, fresh = np.concatenate([kept, day]), np.concatenate([np.zeros(len(kept), bool), np.ones(len(day), bool)])
    order = np.argsort(days)
    days, values, fresh = days[order], np.concatenate([held, value])[order], fresh[order]
    i = np.arange(4, len(days))
    full = i[(days[i] - days[i - 4] == 4) & np.logical_or.reduce([fresh[i - k] for k in range(5)])] if len(i) else i
    sums = sum(values[full - k] for k in range(5)) if len(full) else np.zeros(0)
    # the stretches seen, merged where they touch: none overlap, as the new days are unseen
    begin, end = np.concatenate([starts, day]), np.concatenate([ends, day])
    if len(begin):
        order = np.argsort(begin)
        begin, end = begin[order], end[order]
        gap = np.flatnonzero(begin[1:] > end[:-1] + 1)
        starts, ends = begin[np.concatenate([[0], gap + 1])], end[np.concatenate([gap, [len(end) - 1]])]
        at = np.searchsorted(starts, days, side="right") - 1
        near = (days < starts[at] + 4) | (days > ends[at] - 4)
        state.update((starts.tolist(), ends.tolist(), days[near].tolist(), values[near].tolist()))
    place = (days[full] + _APART // 2) // _APART  # days before 1970 are negative
    yield pd.DataFrame(
        {
            "member": np.full(len(full), key[0], dtype=object),
            "block": pd.array(np.full(len(full), key[1], dtype=object), dtype="Int64"),
            "place": place,
            "day_number": days[full] - place * _APART,
            "sum5": sums,
        }
    )


def stream_five_day_sums(stream: DataFrame) -> DataFrame:
    """Five-day sums across chunk borders, for chunks of any size in any order.

    A sum is emitted once, when the last of its five days arrives. The state keeps the four days on
    either side of every border of the stretches seen, so it is small while the series has few gaps.
    Neighbouring cells share a state and a call, whose overhead would else outweigh a cell's few days.
    """
    cell = F.col("cell_id").cast("long")
    place = F.coalesce(cell.bitwiseAND((1 << _CELL_BITS) - 1), F.lit(0))
    keyed = stream.select(
        "member", F.shiftright(cell, _CELL_BITS).alias("block"), place.alias("place"), F.unix_date("day").cast("long").alias("day_number"), "value"
    )
    sums = keyed.groupBy("member", "block").applyInPandasWithState(
        _five_day_sums,
        "member STRING, block BIGINT, place BIGINT, day_number BIGINT, sum5 DOUBLE",
        "starts ARRAY<BIGINT>, ends ARRAY<BIGINT>, days ARRAY<BIGINT>, day_values ARRAY<DOUBLE>",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    cell_id = F.coalesce(F.shiftleft("block", _CELL_BITS) + F.col("place"), F.lit(NO_CELL))
    return sums.select("member", cell_id.alias("cell_id"), "day_number", "sum5")


def rx5day_from_sums(sums: DataFrame) -> DataFrame:
    """Yearly maximum of the emitted sums, in the year of the last day."""
    year = F.year(F.date_from_unix_date(F.col("day_number").cast("int")))
    return sums.groupBy("member", "cell_id", year.alias("year")).agg(F.max("sum5").alias("rx5day"))
