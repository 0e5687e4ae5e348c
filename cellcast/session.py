"""Session defaults, and stage tables in the shared folder that cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, name: str = "cellcast") -> SparkSession:
    """A session for tests and the bench. On a cluster, submit with your own settings instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as a stage table in the shared folder and read it back.

    Upstream work runs once however often the result is used, a lost executor re-reads files instead
    of recomputing, and the optimizer sees the table's true size. Plan constraints do not pile up
    over the rounds of an iteration, as they do when a checkpointed plan is extended again and again.
    """
    path = scratch_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _stages[id(out)] = (out, path)
    return out


def cut_by(df: DataFrame, key: str, one_each: bool = False) -> DataFrame:
    """A stage table in buckets by `key`, as many as there are shuffle partitions; with `one_each`, one row of each key.

    Joins and groupings by `key` read it where it lies: its rows travel once, however often it is joined. The
    session's catalog holds its name until the stage is dropped. One key's rows are one bucket, which no
    skew handling parts: use it where the other side of a join has no very common key.
    """
    spark = df.sparkSession
    path, n = scratch_folder(spark, "stage"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stage_{path.rsplit('-', 1)[1]}"
    dealt = df.repartition(n, key)
    dealt = dealt.dropDuplicates([key]) if one_each else dealt  # where they lie
    dealt.write.bucketBy(n, key).format("parquet").option("path", path).saveAsTable(name)
    out = spark.table(name)
    _stages[id(out)] = (out, path)
    _tables[path] = name
    return out


#: Stage tables of this driver that have not been dropped, with the DataFrame that reads each.
_stages: dict[int, tuple[DataFrame, str]] = {}
#: Of those in buckets, the names in the session's catalog, by path.
_tables: dict[str, str] = {}


def drop_stages(*frames: DataFrame | None) -> None:
    """Delete the files of stage tables that nothing will read again; other frames are left alone."""
    for df in frames:
        if df is not None and id(df) in _stages:
            _, path = _stages.pop(id(df))
            if path in _tables:
                df.sparkSession.sql(f"DROP TABLE IF EXISTS {_tables.pop(path)}")
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that have ended.

    It does so when the driver's garbage collector finds that nothing refers to them: in a job of many rounds
    they would lie on the executors' disks until the driver's heap is full.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def current_stages() -> list[DataFrame]:
    """The stage tables not yet dropped, oldest first. A job that ends drops those that it has added."""
    return [df for df, _ in _stages.values()]


def settled(build: Callable[[], DataFrame]) -> DataFrame:
    """A stage table of what `build` returns; the stage tables made on the way are dropped, as nothing needs them any more."""
    before = {id(df) for df in current_stages()}
    out = cut_lineage(build())
    drop_stages(*[df for df in current_stages() if id(df) not in before and df is not out])
    return out


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, on the storage the cluster shares for checkpoints."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="cellcast-scratch-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
