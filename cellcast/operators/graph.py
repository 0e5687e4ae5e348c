"""River networks and connected regions.

Each round is a join and a grouped sum on cell keys; rounds grow with the logarithm of the depth.
Each round ends in a stage table in the shared folder, so a lost executor costs one round at most.
Pointers of many cells end on the same cell; adaptive execution splits such joins.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.operators.grids import neighbour_offsets, offset_table, wrapped
from cellcast.operators.ranking import key_lookup
from cellcast.operators.tiles import label_tiles, least_labels
from cellcast.session import cut_lineage

# Row and column step of each flow code, for rows counted northwards.
D8_STEPS = {1: (0, 1), 2: (-1, 1), 3: (-1, 0), 4: (-1, -1), 5: (0, -1), 6: (1, -1), 7: (1, 0), 8: (1, 1)}


def d8_edges(cells: DataFrame, n_cols: int, northward: bool, code: str = "flow", row: str = "grow", col: str = "gcol") -> DataFrame:
    """(cell_id, next_id): the land cell each flow code points to; off-land is a sink (NULL).

    `northward` says whether row numbers grow to the north; the grids of this library count southwards.
    """
    sense = 1 if northward else -1
    step = F.create_map(*[x for k, (i, j) in D8_STEPS.items() for x in (F.lit(k), F.struct(F.lit(sense * i).alias("i"), F.lit(j).alias("j")))])[F.col(code).cast("int")]
    aimed = cells.select(
        "cell_id", (F.col(row) + step["i"]).cast("int").alias("_r"), wrapped(F.col(col) + step["j"], n_cols).cast("int").alias("_c")
    )
    land = cells.select(F.col("cell_id").alias("next_id"), F.col(row).cast("int").alias("_r"), F.col(col).cast("int").alias("_c"))
    return aimed.join(land, ["_r", "_c"], "left").select("cell_id", "next_id")


def pointer_closure(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(cell_id, next_id, depth) with every pointer followed to NULL; a cycle never gets there.

    Rounds double the reach, so `max_rounds` covers any path shorter than 2^max_rounds. `depth` is the
    number of steps to the end.
    """
    n = edges.count()
    state = cut_lineage(edges.select("cell_id", F.col("next_id").alias("_p"), F.when(F.col("next_id").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    reach = 1
    for _ in range(max_rounds):
        if state.where("_p IS NOT NULL").isEmpty():
            return state.select("cell_id", "depth")
        if reach > n:
            raise ValueError("the network is not acyclic")
        ahead = state.select(F.col("cell_id").alias("_p"), F.col("_p").alias("_pp"), F.col("depth").alias("_d"))
        moving = state.where("_p IS NOT NULL")
        jumped = key_lookup(moving, ahead, ["_p"]).select(
            "cell_id", F.col("_pp").alias("_p"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth")
        )
        state = cut_lineage(state.where("_p IS NULL").unionByName(jumped))
        reach *= 2
    raise ValueError("the network is not acyclic")


def assert_acyclic(edges: DataFrame) -> DataFrame:
    """Steps from each cell to its outlet; raises when some cell never reaches one."""
    return pointer_closure(edges)


def peel_rounds(edges: DataFrame) -> DataFrame:
    """(cell_id, peel): length of the longest path from a headwater, 0 for headwaters; raises on a cycle.

    Contraction by doubling: in round k a cell tells the cell 2^k steps below how long its longest path
    from above is by then, and its pointer passes that cell. A cell whose pointer has left the network has
    told all it will tell and leaves the state; what was told is kept aside and reduced once at the end.
    Rounds grow with the logarithm of the depth.
    """
    own = cut_lineage(edges.select("cell_id", F.lit(0).cast("int").alias("peel")))
    state = cut_lineage(edges.where("next_id IS NOT NULL").select("cell_id", F.col("next_id").alias("_p"), F.lit(0).cast("int").alias("peel")))
    n, reach = own.count(), 1
    told = [own]
    while not state.isEmpty():
        if reach > n:
            raise ValueError("the network is not acyclic")
        news = cut_lineage(state.groupBy(F.col("_p").alias("cell_id")).agg((F.max("peel") + reach).alias("peel")))
        told.append(news)
        # what moving cells are told in this round counts in the next one; cells that have left need not know
        heard = key_lookup(state, news.withColumnRenamed("peel", "_n"), ["cell_id"]).select("cell_id", "_p", F.greatest("peel", F.coalesce("_n", "peel")).alias("peel"))
        ahead = state.select(F.col("cell_id").alias("_p"), F.col("_p").alias("_pp"))
        state = cut_lineage(key_lookup(heard, ahead, ["_p"], how="inner").select("cell_id", F.col("_pp").alias("_p"), "peel"))
        reach *= 2
    every = functools.reduce(DataFrame.unionByName, told)
    return every.groupBy("cell_id").agg(F.max("peel").alias("peel"))


def accumulate_downstream(edges: DataFrame, payload: DataFrame, value: str = "payload", by: tuple[str, ...] = ()) -> DataFrame:
    """Each cell's own payload plus everything upstream, per `by` (e.g. time step).

    Pointer doubling: after round k a cell holds the sum of all cells fewer than 2^k steps above it.
    Round k adds each cell's partial sum at the cell 2^k steps below and doubles the pointers. The
    pointer table is kept apart from the sums, so pointers are followed once for all time steps.
    """
    by = list(by)
    pointers = cut_lineage(edges.select("cell_id", F.col("next_id").alias("_p")))
    sums = payload.select("cell_id", *by, value)
    n, reach = pointers.count(), 1
    while True:
        moving = pointers.where("_p IS NOT NULL")
        if moving.isEmpty():
            return sums
        if reach > n:
            raise ValueError("the network is not acyclic")
        reach *= 2
        shifted = sums.join(moving, "cell_id").select(F.col("_p").alias("cell_id"), *by, value)
        sums = cut_lineage(sums.unionByName(shifted).groupBy("cell_id", *by).agg(F.sum(value).alias(value)))
        ahead = pointers.select(F.col("cell_id").alias("_p"), F.col("_p").alias("_pp"))
        jumped = key_lookup(moving, ahead, ["_p"]).select("cell_id", F.col("_pp").alias("_p"))
        pointers = cut_lineage(jumped.where("_p IS NOT NULL"))


def upstream_set(edges: DataFrame, outlets: DataFrame) -> DataFrame:
    """(cell_id, outlet): every cell draining to an outlet, the nearest outlet downstream winning.

    Outlets end the walk, so pointers to them stay; all others are doubled past until they rest.
    """
    marks = outlets.select(F.col("cell_id").alias("_o")).distinct()
    start = edges.join(marks, edges["cell_id"] == marks["_o"], "left").select(
        "cell_id", F.when(F.col("_o").isNotNull(), F.col("cell_id")).otherwise(F.col("next_id")).alias("_p"), F.col("_o").isNotNull().alias("_rest")
    )
    state = cut_lineage(start.where("_p IS NOT NULL"))
    for _ in range(64):
        moving = state.where("NOT _rest")
        if moving.isEmpty():
            return state.select("cell_id", F.col("_p").alias("outlet"))
        ahead = state.select(F.col("cell_id").alias("_p"), F.col("_p").alias("_pp"), F.col("_rest").alias("_r"))
        jumped = key_lookup(moving.select("cell_id", "_p"), ahead, ["_p"], how="inner").select(
            "cell_id", F.col("_pp").alias("_p"), F.col("_r").alias("_rest")
        )
        state = cut_lineage(state.where("_rest").unionByName(jumped))
    raise ValueError("the network is not acyclic")


#: Cells along a side of the tiles in which regions are labelled, and how many tiles along a side merge at a time.
TILE, TILES_MERGED = 64, 8


def connected_components(mask: DataFrame, n_cols: int = 720, eight: bool = True, row: str = "grow", col: str = "gcol") -> DataFrame:
    """(row, col, component): regions of touching cells, joined across the antimeridian.

    Regions are labelled inside tiles first, in one pass over the cells. What then remains is the graph of
    labels that meet across tile borders. It is contracted level by level: blocks of 8 x 8 tiles, of 64 x 64,
    and so on, each in a task of its own, until no border is left open; a block's open borders grow with its
    side, not its area. A label is the smallest cell number in the region.
    """
    cells = cut_lineage(label_tiles(mask.select(row, col).distinct(), n_cols, eight, row, col, TILE))
    at_border = F.pmod(F.col(row), F.lit(TILE)).isin(0, TILE - 1) | F.pmod(F.col(col), F.lit(TILE)).isin(0, TILE - 1) | F.col(col).isin(0, n_cols - 1)
    rim = cells.where(at_border).select(F.col(row).cast("long").alias("r"), F.col(col).cast("long").alias("c"), "cell_id", "label")
    aimed = rim.withColumn("_o", F.explode(offset_table(neighbour_offsets(eight)))).select(
        F.col("label").alias("a"), F.col("r").alias("ra"), F.col("c").alias("ca"),
        ((F.col("r") + F.col("_o.di")) * n_cols + wrapped(F.col("c") + F.col("_o.dj"), n_cols)).alias("cell_id"),
    )
    # every border edge is met from both ends; one is enough
    met = aimed.join(rim.select("cell_id", F.col("label").alias("b"), F.col("r").alias("rb"), F.col("c").alias("cb")), "cell_id").where("a < b")
    merged = _merge_blocks(met.drop("cell_id"), TILE * TILES_MERGED)
    whole = key_lookup(cells, merged, ["label"])
    return whole.select(row, col, F.coalesce("component", "label").alias("component"))


def _merge_blocks(edges: DataFrame, side: int) -> DataFrame:
    """(label, component) of the labels that an edge (a, b) at the cells (ra, ca), (rb, cb) makes lower."""
    place = lambda v: F.struct("ra", "ca", "rb", "cb").alias(v)
    once = lambda df: df.groupBy("a", "b").agg(F.min(place("_at")).alias("_at")).select("a", "b", "_at.*")
    edges, merged = cut_lineage(once(edges)), None
    while not edges.isEmpty():
        block = lambda c: F.floor(F.col(c) / side)  # noqa: B023, E731
        inside = (block("ra") == block("rb")) & (block("ca") == block("cb"))
        grouped = edges.where(inside).groupBy(block("ra").alias("_r"), block("ca").alias("_c")).agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
        step = cut_lineage(grouped.mapInArrow(_least_of_blocks, "label BIGINT, component BIGINT"))
        to = lambda end: step.select(F.col("label").alias(end), F.col("component").alias(f"_{end}"))  # noqa: B023, E731
        open_ = edges.where(~inside).join(to("a"), "a", "left").join(to("b"), "b", "left")
        now = open_.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"), "ra", "ca", "rb", "cb").where("a <> b")
        edges = cut_lineage(once(now))
        if merged is not None:  # labels merged before follow their component
            onward = step.select(F.col("label").alias("component"), F.col("component").alias("_to"))
            followed = merged.join(onward, "component", "left").select("label", F.coalesce("_to", "component").alias("component"))
            step = followed.unionByName(step)
        merged, side = step, side * TILES_MERGED
    return merged if merged is not None else edges.select(F.col("a").alias("label"), F.col("b").alias("component"))


def _least_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's labels occur in no other block, so a batch of blocks is contracted at once."""
    for batch in batches:
        ends = [batch.column(c).flatten().to_numpy() for c in ("a", "b")]
        labels, at = np.unique(np.concatenate(ends), return_inverse=True)
        least = labels[least_labels(len(labels), *np.split(at, 2))]
        lower = least < labels
        yield pa.RecordBatch.from_arrays([pa.array(labels[lower]), pa.array(least[lower])], names=["label", "component"])


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count("*").alias("n_cells"))


def largest_component(components: DataFrame) -> DataFrame:
    """The cells of the largest region (smallest label on a tie): the ocean of a sea mask."""
    sizes = component_sizes(components)
    top = sizes.select(F.max_by("component", F.struct("n_cells", -F.col("component")))).scalar()
    return components.where(F.col("component") == top)
