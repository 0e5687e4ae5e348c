"""Square tiles of a grid, with a halo of their neighbours' cells, as arrays.

A cell travels to its own tile and to those whose halo holds it: with tiles sixteen radii wide, about 1.3
rows a cell, whatever the kernel's size. A tile's cells become one array row, many tiles one Arrow batch,
and the kernel runs over a stack of dense arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Array elements of one stack of tiles.
_STACK = 1 << 18


@dataclass(frozen=True)
class Tiling:
    """Rows are cut every `height`; columns into `n_tiles` nearly equal parts of a circle of `n_cols`, or every `width`."""

    height: int
    width: int
    halo_rows: int
    halo_cols: int
    n_cols: int | None = None

    @classmethod
    def around(cls, halo_rows: int, halo_cols: int, n_cols: int | None, least: int = 32) -> Tiling:
        height, width = max(least, 16 * halo_rows), max(least, 16 * halo_cols)
        if n_cols is not None:
            width = -(-n_cols // max(1, n_cols // width))
        return cls(height, width, halo_rows, halo_cols, n_cols)

    @property
    def n_tiles(self) -> int:
        return max(1, self.n_cols // self.width) if self.n_cols is not None else 0

    def tile_col(self, col: Column) -> Column:
        if self.n_cols is None:
            return F.floor(col / self.width).cast("int")
        return F.floor(F.pmod(col, F.lit(self.n_cols)).cast("long") * self.n_tiles / self.n_cols).cast("int")

    def first_col(self, tile: np.ndarray) -> np.ndarray:
        if self.n_cols is None:
            return tile * self.width
        return -(-tile * self.n_cols // self.n_tiles)

    def last_col(self, tile: np.ndarray) -> np.ndarray:
        return self.first_col(tile + 1)

    @property
    def full_width(self) -> int:
        return self.width if self.n_cols is None else -(-self.n_cols // self.n_tiles)

    def deal(self, df: DataFrame, row: str, col: str) -> DataFrame:
        """Each row once per tile that needs it, with `_tr` and `_tc`."""
        shifts = lambda n: sorted({-n, 0, n})
        rows = F.array_distinct(F.array(*[F.floor((F.col(row) + d) / self.height).cast("int") for d in shifts(self.halo_rows)]))
        cols = F.array_distinct(F.array(*[self.tile_col(F.col(col) + d) for d in shifts(self.halo_cols)]))
        pairs = F.flatten(F.transform(rows, lambda r: F.transform(cols, lambda c: F.struct(r.alias("r"), c.alias("c")))))
        dealt = df.withColumn("_tile", F.explode(pairs))
        return dealt.withColumns({"_tr": F.col("_tile.r"), "_tc": F.col("_tile.c")}).drop("_tile")


#: (tile rows, sums, counts of existing rows, counts of values) -> one result array per output, on the tiles' own cells
Kernel = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]]


def _stacks(batch: pa.RecordBatch, tiling: Tiling) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first tile, tile rows, sums, existing rows, values) for stacks of a batch's tiles, halo included."""
    points = batch.column("_points")
    tr, tc = (batch.column(n).to_numpy().astype(np.int64) for n in ("_tr", "_tc"))
    high, wide = tiling.height + 2 * tiling.halo_rows, tiling.full_width + 2 * tiling.halo_cols
    step = max(1, _STACK // (high * wide))
    turns = [0]
    if tiling.n_cols is not None:  # around a narrow circle a cell may stand in one tile more than once
        most = -(-wide // tiling.n_cols)
        turns = list(range(-most, most + 1))
    for i in range(0, len(points), step):
        j = min(len(points), i + step)
        # only a stack's points are ever unpacked, however many tiles a batch brings
        some = points.slice(i, j - i)
        flat = some.flatten()
        r, c = (flat.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("r", "c"))
        value = flat.field("v")
        have = value.is_valid().to_numpy(zero_copy_only=False)
        v = np.where(have, value.fill_null(0.0).to_numpy(zero_copy_only=False), 0.0)
        tile = np.repeat(np.arange(i, j), some.value_lengths().to_numpy())
        y = r - tr[tile] * tiling.height + tiling.halo_rows
        left = tiling.first_col(tc[tile]) - tiling.halo_cols
        room = tiling.last_col(tc[tile]) - left + tiling.halo_cols
        sums, rows, values = (np.zeros((j - i, high, wide)) for _ in range(3))
        for turn in turns:
            x = c - left + turn * (tiling.n_cols or 0)
            ok = (x >= 0) & (x < room) & (y >= 0) & (y < high)
            at = (tile[ok] - i, y[ok], x[ok])
            np.add.at(sums, at, v[ok])
            np.add.at(rows, at, 1.0)
            np.add.at(values, at, have[ok].astype(float))
        yield i, tr[i:j], sums, rows, values


def convolve(
    df: DataFrame, keys: Sequence[str], value: str, tiling: Tiling, kernel: Kernel, outputs: Sequence[str], row: str, col: str
) -> DataFrame:
    """(keys, row, col, outputs): the kernel's results on every cell where the first of them is not NaN.

    Rows of one cell add up. Groups are tiles, so none grows with the table.
    """
    keys = list(keys)
    point = F.struct(F.col(row).cast("int").alias("r"), F.col(col).cast("int").alias("c"), F.col(value).cast("double").alias("v"))
    tiles = tiling.deal(df, row, col).groupBy(*keys, "_tr", "_tc").agg(F.collect_list(point).alias("_points"))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [*keys, row, col, *outputs]
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"`{row}` INT", f"`{col}` INT"] + [f"`{o}` DOUBLE" for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, tile_rows, sums, rows, values in _stacks(batch, tiling):
                found = kernel(tile_rows, sums, rows, values)
                t, y, x = np.nonzero(~np.isnan(found[0]))
                tc = batch.column("_tc").to_numpy().astype(np.int64)[first + t]
                c = tiling.first_col(tc) + x
                own = c < tiling.last_col(tc)
                t, y, x, c = t[own], y[own], x[own], c[own]
                kept = [batch.column(k).take(pa.array(first + t)) for k in keys]
                places = [pa.array(tile_rows[t] * tiling.height + y, pa.int32()), pa.array(c, pa.int32())]
                yield pa.RecordBatch.from_arrays(kept + places + [pa.array(f[t, y, x], from_pandas=True) for f in found], names=names)

    return tiles.mapInArrow(run, schema)


def own(array: np.ndarray, tiling: Tiling, di: int = 0, dj: int = 0) -> np.ndarray:
    """What the cells of the stack's tiles meet (di, dj) before them."""
    y, x = tiling.halo_rows - di, tiling.halo_cols - dj
    return array[:, y : y + tiling.height, x : x + tiling.full_width]


def label_tiles(cells: DataFrame, n_cols: int, eight: bool, row: str, col: str, side: int = 64) -> DataFrame:
    """(row, col, cell_id, label): regions of touching cells within each tile; a label is the region's smallest cell number.

    Labels of the tiles of a batch sink together: each cell takes its neighbours' least label, the old
    label is hooked to it, and labels jump along the hooks, so a winding region takes few steps.
    """
    tiling = Tiling(side, side, 0, 0)
    point = F.struct(F.col(row).cast("int").alias("r"), F.col(col).cast("int").alias("c"), F.lit(1.0).alias("v"))
    tiles = tiling.deal(cells, row, col).groupBy("_tr", "_tc").agg(F.collect_list(point).alias("_points"))
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if eight else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tc = batch.column("_tc").to_numpy().astype(np.int64)
            for first, tile_rows, _, rows, _ in _stacks(batch, tiling):
                n = len(rows)
                place = np.full((n, side + 1, side + 2), -1)
                t, y, x = np.nonzero(rows)
                place[t, y, x + 1] = np.arange(len(t))
                ends = [(place[t, y, x + 1], place[t, y + a, x + 1 + b]) for a, b in steps]
                a, b = (np.concatenate([e[k] for e in ends]) for k in (0, 1))
                label = least_labels(len(t), a[b >= 0], b[b >= 0])
                r, c = tile_rows[t] * side + y, tc[first + t] * side + x
                number = r * n_cols + c
                columns = [pa.array(r, pa.int32()), pa.array(c, pa.int32()), pa.array(number), pa.array(number[label])]
                yield pa.RecordBatch.from_arrays(columns, names=[row, col, "cell_id", "label"])

    return tiles.mapInArrow(run, f"`{row}` INT, `{col}` INT, cell_id BIGINT, label BIGINT")


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number of each node's component, for edges a - b among nodes 0 to n - 1."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label
