"""Vector codes: each part of a vector becomes the index of its nearest codebook entry.

The nearest entry is found by slicing and intersecting bitmasks. Of every codebook the entries are sorted
by each coordinate; the mask of the first k in that order, one bit an entry, is kept for every k. A radius
selects a range of the sorted coordinates per dimension, two binary searches each; the exclusive or of
the masks at its ends holds the entries in the range, and the conjunction over the dimensions those in the
box. The first radius is the distance to the entry next in the first coordinate, so that no entry outside
the box can be nearer; the few entries inside are measured exactly. All numbers are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a mask, and so the largest codebook.
MAX_ENTRIES = 64
#: Components from this size on count as not finite: sums of their squares would leave 64 bits.
MAX_COMPONENT = 1 << 18


@dataclass(frozen=True)
class Codes:
    parts: int = 16
    entries: int = MAX_ENTRIES
    rounds: int = 2
    scale: int = 256


class Slices:
    """Sorted coordinates and prefix masks of one part's codebook (entries x components, 64-bit integers)."""

    def __init__(self, book: np.ndarray):
        self.book = book
        entries, width = book.shape
        order = np.argsort(book, axis=0, kind="stable")
        self.sorted = np.take_along_axis(book, order, 0)
        bit = np.uint64(1) << order.astype(np.uint64)
        self.prefix = np.zeros((entries + 1, width), np.uint64)
        self.prefix[1:] = np.bitwise_or.accumulate(bit, axis=0)
        self.order = order

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Mask of the entries that lie within `radius` of each point in every coordinate."""
        mask = np.full(len(points), ~np.uint64(0))
        for d in range(points.shape[1]):
            column = self.sorted[:, d]
            low = np.searchsorted(column, points[:, d] - radius, "left")
            high = np.searchsorted(column, points[:, d] + radius, "right")
            mask &= self.prefix[high, d] ^ self.prefix[low, d]
        return mask

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry, the lowest index of equally near ones."""
        beside = np.minimum(np.searchsorted(self.sorted[:, 0], points[:, 0]), len(self.book) - 1)
        best = self.order[beside, 0]
        error = ((points - self.book[best]) ** 2).sum(axis=1)
        # the least whole number whose square reaches the error
        radius = np.ceil(np.sqrt(error.astype(float))).astype(np.int64) + 1
        mask = self.candidates(points, radius)
        rows = np.flatnonzero(mask)
        while len(rows):
            left = mask[rows]
            low = left & (~left + np.uint64(1))
            entry = np.bitwise_count(low - np.uint64(1)).astype(np.int64)
            d = ((points[rows] - self.book[entry]) ** 2).sum(axis=1)
            nearer = (d < error[rows]) | ((d == error[rows]) & (entry < best[rows]))
            best[rows[nearer]], error[rows[nearer]] = entry[nearer], d[nearer]
            mask[rows] = left ^ low
            rows = rows[left != low]
        return best, error


def _points(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """The batch's integer vectors as (rows, parts, width)."""
    column = batch.column("point")
    values = column.flatten().to_numpy()
    return values.reshape(len(column), parts, -1)


def whole_vectors(df: DataFrame, codes: Codes, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, point): rows whose vector has only finite components, as whole numbers.

    Dropped are null and empty vectors, vectors with a null, infinite, NaN or (from 2^18 in size) too large
    component, vectors whose length is not a multiple of the parts, and vectors of another length than
    the one with the smallest id.
    """
    x = F.col(vector_col)
    good = lambda v: v.isNotNull() & (F.abs(v.cast("double")) < MAX_COMPONENT)  # noqa: E731  not so for NaN, which is above all numbers
    kept = x.isNotNull() & (F.size(x) > 0) & (F.size(x) % codes.parts == 0) & F.forall(x, lambda v: F.coalesce(good(v), F.lit(False)))
    point = F.transform(x, lambda v: F.floor(v.cast("double") * codes.scale).cast("long"))
    points = df.where(kept).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), point.alias("point"))
    first = points.orderBy(F.col("vec_id").asc_nulls_last(), "point").select(F.size("point")).first()
    return points.where(F.size("point") == (first[0] if first else 0))


def first_books(points: DataFrame, codes: Codes) -> np.ndarray:
    """(parts, entries, width): the parts of the vectors with the smallest ids; of equal ids the smaller vector first."""
    first = points.orderBy(F.col("vec_id").asc_nulls_last(), "point").limit(codes.entries).select("point").collect()
    if not first:
        return np.zeros((codes.parts, 0, 0), np.int64)
    return np.array([r[0] for r in first], np.int64).reshape(len(first), codes.parts, -1).transpose(1, 0, 2)


def _sum_parts(sent, parts: int):
    """Count and sums of each entry's parts over a whole task: at most parts x entries rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        _, entries, width = books.shape
        slices = [Slices(b) for b in books]
        count, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            points = _points(batch, parts)
            for p in range(parts):
                entry, _ = slices[p].nearest(points[:, p])
                order = np.argsort(entry, kind="stable")
                used, at = np.unique(entry[order], return_index=True)
                count[p] += np.bincount(entry, minlength=entries)
                sums[p, used] += np.add.reduceat(points[order, p], at, axis=0) if len(used) else 0
        p, e = np.nonzero(count)
        columns = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    return run


def fit_books(points: DataFrame, codes: Codes) -> np.ndarray:
    """Codebooks after the rounds. Parts are summed in each task and then by (part, entry): what is collected has the codebooks' size."""
    books = first_books(points, codes)
    _, entries, width = books.shape
    for _ in range(codes.rounds if entries else 0):
        sent = points.sparkSession.sparkContext.broadcast(books)
        sums = points.select("point").mapInArrow(_sum_parts(sent, codes.parts), "part INT, entry INT, n BIGINT, sums ARRAY<BIGINT>")
        total = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
        books = books.copy()
        for r in total.collect():
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return books


def encode_vectors(points: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of each row; `code` has two hex digits a part."""
    sent = points.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in sent.value]
        for batch in batches:
            points = _points(batch, len(slices))
            index, error = np.zeros((len(points), len(slices)), np.uint8), np.zeros(len(points), np.int64)
            for p, s in enumerate(slices):
                index[:, p], d = s.nearest(points[:, p])
                error += d
            hexes = index.tobytes().hex()
            size = 2 * len(slices)
            code = pa.array([hexes[i : i + size] for i in range(0, len(hexes), size)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), code, pa.array(error)], names=["vec_id", "label", "code", "error"])

    label = points.schema["label"].dataType.simpleString()
    return points.mapInArrow(run, f"vec_id BIGINT, label {label}, code STRING, error BIGINT")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(df: DataFrame, codes: Codes = Codes(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error), codebooks) of a table of vectors.

    Codebooks start from the vectors with the smallest ids and move `rounds` times to the floored mean of
    their parts; an entry that no part is nearest to stays. Fewer vectors than entries give that many entries.
    Rows are coded one by one, so repeated and null ids stay rows of their own; null ids come last in the
    start order. An empty table gives no rows and empty codebooks. What `whole_vectors` leaves out has no row.
    """
    if not 1 <= codes.entries <= MAX_ENTRIES:
        raise ValueError(f"1 to {MAX_ENTRIES} entries")
    points = whole_vectors(df, codes, id_col, vector_col, label_col)
    books = fit_books(points, codes)
    return encode_vectors(points, books), books


def with_label_error(coded: DataFrame, label: str | Column = "label") -> DataFrame:
    """`coded` with the errors' sum over rows of an equal label; null labels are equal. Sums are made before the shuffle, and the join is left to adaptive execution, which splits a label that holds most rows."""
    key = F.col(label) if isinstance(label, str) else label
    totals = coded.groupBy(key.alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, key.eqNullSafe(F.col("_label")), "left").drop("_label")
