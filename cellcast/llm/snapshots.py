"""Cumulative-snapshot collapse of logged conversations, then rendering.

Chat logs often hold a conversation once per turn, each log a prefix of the next. A rolling hash is
kept after every turn; a conversation whose last hash is an inner hash of another is a prefix of it,
and an anti-join drops it. Of equal conversations the one with the smallest id stays. DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellcast.session import cut_lineage

#: Turns of a conversation that are hashed and rendered together, by position; a longer one is spread over several groups.
SEGMENT = 1024


def _same(a: str, b: str, *more: tuple[str, str]) -> Column:
    """Equal conv_id columns, null with null, and equal other columns."""
    on = F.col(a).eqNullSafe(F.col(b))
    for x, y in more:
        on = on & (F.col(x) == F.col(y))
    return on


def _turns(conversations: DataFrame) -> DataFrame:
    """Rows with their position (from 0) in the conversation, whatever its turn numbers are.

    All rows are sorted by ranges of nearly equal row counts: a conversation, a turn number or one repeated
    row may hold most rows. Each range counts its rows per conversation, and sums over ranges shift them.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("_row", F.monotonically_increasing_id())  # parts equal rows among ranges
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc(), F.col("_row").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
    # written once: ranges come from a sample, and counts and rows must see the same ones
    rows = cut_lineage(rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)))
    counts = rows.groupBy("conv_id", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("n"))
    over = W.partitionBy("conv_id").orderBy("_range")
    before = counts.select(
        F.col("conv_id").alias("_c"), F.col("_range").alias("_r"),
        (F.sum("n").over(over) - F.col("n") - F.col("_first")).alias("_shift"), F.sum("n").over(W.partitionBy("conv_id")).alias("n_turns"),
    )
    placed = rows.join(before, _same("conv_id", "_c", ("_range", "_r"))).withColumn("position", F.col("_at") + F.col("_shift"))
    return placed.withColumn("segment", F.floor(F.col("position") / SEGMENT)).drop("_c", "_r", "_at", "_range", "_shift")


def _earlier(parts: DataFrame) -> DataFrame:
    """(_c, _s, p1, p2): the XOR of the parts before each segment. Blocks of SEGMENT segments bound the windows."""
    parts = parts.withColumn("_block", F.floor(F.col("segment") / SEGMENT))
    blocks = parts.groupBy("conv_id", "_block").agg(F.bit_xor("p1").alias("b1"), F.bit_xor("p2").alias("b2"))

    def until(column: str, over: W) -> Column:
        return F.bit_xor(column).over(over).bitwiseXOR(F.col(column))

    block = W.partitionBy("conv_id").orderBy("_block")
    blocks = blocks.select(F.col("conv_id").alias("_c"), F.col("_block").alias("_b"), until("b1", block).alias("b1"), until("b2", block).alias("b2"))
    inside = W.partitionBy("conv_id", "_block").orderBy("segment")
    parts = parts.select("conv_id", "segment", "_block", until("p1", inside).alias("p1"), until("p2", inside).alias("p2"))
    both = parts.join(blocks, _same("conv_id", "_c", ("_block", "_b")))
    return both.select("_c", F.col("segment").alias("_s"), F.col("p1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("b2")).alias("p2"))


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """(conv_id, segment, turn, role, text, position, n_turns, h1, h2): the hashes of all turns up to this one.

    The hash of a prefix is the XOR of its turns' 64-bit hashes, each taken with its position; two
    independent ones make 128 bits.
    """
    t = _turns(conversations)
    turn_hash = lambda seed: F.xxhash64(F.lit(seed), F.col("position"), F.col("role"), F.col("text"))
    t = t.withColumns({"_t1": turn_hash(1), "_t2": turn_hash(2)})
    earlier = _earlier(t.groupBy("conv_id", "segment").agg(F.bit_xor("_t1").alias("p1"), F.bit_xor("_t2").alias("p2")))
    rolling = W.partitionBy("conv_id", "segment").orderBy("position").rowsBetween(W.unboundedPreceding, 0)
    t = t.withColumns({"_t1": F.bit_xor("_t1").over(rolling), "_t2": F.bit_xor("_t2").over(rolling)})
    joined = t.join(earlier, _same("conv_id", "_c", ("segment", "_s")))
    return joined.select(
        "conv_id", "segment", "turn", "role", "text", "position", "n_turns",
        F.col("p1").bitwiseXOR(F.col("_t1")).alias("h1"), F.col("p2").bitwiseXOR(F.col("_t2")).alias("h2"),
    )


def maximal_conversations(hashed: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal): conversations that are no prefix of a longer one, once each."""
    last = F.col("position") == F.col("n_turns") - 1
    # equal conversations meet under one hash and are reduced before any shuffle
    whole = hashed.where(last).groupBy("n_turns", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    inner = hashed.where(~last).select((F.col("position") + 1).alias("n_turns"), "h1", "h2").distinct()
    return whole.join(inner, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", "n_turns", "n_equal")


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def collapse_snapshots(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, n_equal, rendered) of every maximal conversation.

    `part` counts from 0; a conversation has a further part for every SEGMENT turns. Null roles
    and texts are empty. Null turns come first; ties are ordered by role and text. Rows without a
    conv_id form one conversation, which stays if its text is that of no other. An empty table gives none.
    """
    hashed = prefix_hashes(conversations)
    kept = maximal_conversations(hashed).select(F.col("conv_id").alias("_c"), F.col("n_equal"))
    rows = hashed.join(kept, F.col("conv_id").eqNullSafe(F.col("_c")))
    turns = F.array_sort(F.collect_list(F.struct("position", rendered_turn(F.col("role"), F.col("text")).alias("line"))))
    parts = rows.groupBy("conv_id", "segment").agg(turns.alias("t"), F.first("n_turns").alias("n_turns"), F.first("n_equal").alias("n_equal"))
    text = F.array_join(F.transform("t", lambda x: x["line"]), "")
    return parts.select("conv_id", F.col("segment").cast("int").alias("part"), "n_turns", "n_equal", text.alias("rendered"))
