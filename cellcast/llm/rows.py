"""Input columns, Arrow batches and bounded row samples shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that the array kernels hold at once.
CHUNK_BYTES = 1 << 20


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of any table: other columns go, whatever their names; a null text is empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def numbered(df: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """(`df` with its columns named c0, c1, ..., the one that holds the text).

    Whatever the columns' names, they do not clash with an operator's own. A string column is the text as it
    is (array kernels take nulls as empty), so that texts go to Python once; another type is added as text.
    """
    work = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    at = df.columns.index(text_col)
    if df.schema[at].dataType.simpleString() == "string":
        return work, f"c{at}"
    return work.withColumn("text", F.coalesce(F.col(f"c{at}").cast("string"), F.lit(""))), "text"


def named(work: DataFrame, like: DataFrame, *more: Column) -> DataFrame:
    """The columns of a numbered frame under their names again, and more columns."""
    return work.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(like.columns)], *more)


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return (F.crc32(c.cast("string").cast("binary")) % folds).cast("int")


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most `rows` rows, those with the smallest hash of `key`: the same rows however the input is split."""
    return df.orderBy(F.xxhash64(key), F.col(key)).limit(rows)


#: Bits of a filter of keys: 8 MB, however many keys there are.
FILTER_BITS = 1 << 26


def may_be_in(keys: DataFrame, columns: Sequence[str], bits: int = FILTER_BITS) -> Callable[..., Column]:
    """A test of rows before a join: false where the values given are surely in no row of `keys` (its `columns`).

    It keeps rows that meet nothing out of the join's shuffle. A set of `bits` bits, by the values' hash, goes through
    the driver to the tasks; the more keys, the more rows pass that meet nothing, so the join must follow all the same.
    """
    spark = keys.sparkSession
    place = F.pmod(F.xxhash64(*columns), F.lit(bits))
    words = keys.select(F.shiftright(place, 6).alias("w"), F.expr("1L").alias("one"), F.pmod(place, F.lit(64)).cast("int").alias("k"))
    words = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(one, k)")).alias("set")).toArrow()  # bits / 64 rows at most
    table = np.zeros(bits // 64, np.int64)
    table[words["w"].to_numpy()] = words["set"].to_numpy()
    shared = spark.sparkContext.broadcast(table.view(np.uint8))

    @F.pandas_udf("boolean")
    def test(hashed: pd.Series) -> pd.Series:
        at = hashed.to_numpy().view(np.uint64) & np.uint64(bits - 1)
        return pd.Series((shared.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1)

    return lambda *values: test(F.xxhash64(*values))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row borders within the bytes) for runs of rows of about `limit` bytes.

    A row longer than `limit` forms a run of its own. Nulls count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    border = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(border, border[i] + limit, "right")) - 1)
        yield i, j, raw[border[i] : border[j]], border[i : j + 1] - border[i]
        i = j


def table_rows(schema: pa.Schema, columns: Sequence, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `rows` rows from equally long columns."""
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    n = len(arrays[0])
    for i in range(0, n, rows):
        yield pa.RecordBatch.from_arrays([a.slice(i, rows) for a in arrays], schema=schema)
