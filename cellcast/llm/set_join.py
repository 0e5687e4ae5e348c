"""N-gram Jaccard join with set-relation skipping, and the components of its links.

Documents are sets of word shingles. Equal sets form one class; classes are joined by index lists over
the rarest elements of each set (prefix filter), exactly, at a similarity of `share` / 100.

Index-level skipping: a list is held in blocks of similar set size, a set probes only the blocks it can
reach, and a pair is skipped where the places of the shared element in both sets leave too little behind.

Answer-level skipping: a set's answers are derived from those of a highly similar set. First a few pairs
per list are verified; linked sets form components and share their answers, so no pair inside a component
is looked at again, however large a group of near copies is. Each component has a leader, and
every member's difference from it is known. For two components that still meet in a list the leaders'
overlap is computed once; the overlap of any two members is then at most that plus what the members add to
their leaders, and only pairs that pass this bound are verified, all of them.

The number of links of each document is exact, within components too: there answers are derived from the
component's centre (the elements of more than half of its members). Two members' overlap is what the
centre's size less both members' losses gives, plus the elements in which both differ from it. Members that
differ in no common element are counted by ranks, without their pairs; pairs whose answer a common
difference can change meet in lists of these differences, by the same prefix filter, and are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellcast.llm.components import components, relabel
from cellcast.llm.encoding import forget
from cellcast.llm.rows import documents, may_be_in, text_chunks
from cellcast.llm.words import LOWER, find_words, gram_starts, grams, mix
from cellcast.session import cut_by, cut_lineage, drop_stages, release_shuffles, settled

_U = np.uint64
#: Shingles whose counts travel to the tasks. They only order a set's elements: any order gives the same links.
MAX_FREQUENT = 1 << 19
BITS = 1024  # parity bits of a set that travel for a pair before the set itself does
SUBLIST = 4096  # rows of a list that are looked at together in a round
#: Rounds of probing: how many random orders the lists share, and how many next rows each row meets. The first
#: round meets the same few pairs in every list; in the later ones, a row still alone meets others in each list.
PROBES = ((4, 2), (1 << 20, 8), (1 << 20, 16), (1 << 20, 16))


@dataclass(frozen=True)
class Similarity:
    words: int = 5
    share: int = 80  # link if 100 * intersection >= share * union

    def prefix(self, size):
        return size - -(-self.share * size // 100) + 1


def shingle_sets(raw: np.ndarray, border: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row borders, distinct shingle hashes, ascending in each row). A row with fewer words is one shingle."""
    w = find_words(raw, border, LOWER)
    at = gram_starts(w, words)
    parts, rows = [grams(w.hash, words)[at] if len(at) else np.zeros(0, np.uint64)], [w.row[at]]
    count = np.diff(w.first)
    for n in range(1, words):
        short = np.flatnonzero(count == n)
        if len(short):
            h = np.full(len(short), n, np.uint64)
            for k in range(n):
                h = mix(h * _U(31) + w.hash[w.first[short] + k])
            parts.append(h)
            rows.append(short)
    h, row = np.concatenate(parts), np.concatenate(rows)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    if len(h):
        new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))
        h, row = h[new], row[new]
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(border) - 1))]), h


def _frequent(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(shingle, documents with it) of the task's repeated shingles."""
        forget()
        held, size = [], 0

        def out() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
            many = n > 1
            return pa.RecordBatch.from_arrays([pa.array(h[many].view(np.int64)), pa.array(n[many])], names=["h", "n"])

        for b in batches:
            for _, _, raw, border in text_chunks(b.column("text")):
                held.append(shingle_sets(raw, border, words)[1])
                size += len(held[-1])
                if size > 4_000_000:
                    yield out()
                    held, size = [], 0
        yield out()

    return run


_SETS = "key long, doc_id long, f long, f1 long, f2 long, size int, prefix array<long>, bits array<long>"


def _sets(sim: Similarity, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, count = shared.value
        maybe = np.zeros(1 << 24, bool)
        maybe[(frequent & _U((1 << 24) - 1)).astype(np.int64)] = True
        key = TaskContext.get().partitionId() << 40
        for b in batches:
            for i, j, raw, border in text_chunks(b.column("text")):
                at, h = shingle_sets(raw, border, sim.words)
                size = np.diff(at)
                row = np.repeat(np.arange(j - i), size)
                often = np.zeros(len(h), np.int64)
                near = np.flatnonzero(maybe[(h & _U((1 << 24) - 1)).astype(np.int64)])
                if len(near):
                    place = np.minimum(np.searchsorted(frequent, h[near]), len(frequent) - 1)
                    often[near] = np.where(frequent[place] == h[near], count[place], 0)
                order = np.lexsort((h, often, row))
                keep = np.arange(len(h)) - np.repeat(at[:-1], size) < np.repeat(np.where(size > 0, sim.prefix(size), 0), size)
                prefix = h[order][keep]
                borders = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=j - i))]).astype(np.int32)
                prints = []
                for salt in (1, 2):
                    total = np.zeros(len(h) + 1, np.uint64)
                    np.cumsum(mix(h + _U(salt)), out=total[1:])
                    prints.append(pa.array((total[at[1:]] - total[at[:-1]]).view(np.int64)))
                lists = pa.ListArray.from_arrays(pa.array(borders), pa.array(prefix.view(np.int64)))
                columns = [pa.array(key + np.arange(j - i)), b.column("doc_id").slice(i, j - i), b.column("f").slice(i, j - i), *prints, pa.array(size.astype(np.int32)), lists]
                bits = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * (BITS // 64)), pa.array(parity_words(h, at).ravel()))
                yield pa.RecordBatch.from_arrays([*columns, bits], names=["key", "doc_id", "f", "f1", "f2", "size", "prefix", "bits"])
                key += j - i

    return run


def parity_words(h: np.ndarray, at: np.ndarray, most: int = 512) -> np.ndarray:
    """Per set BITS parity bits as longs: bit k says whether an odd number of elements hash to k. Works on `most` sets at a time."""
    place = (mix(h + _U(3)) % _U(BITS)).astype(np.int64)
    out = np.zeros((len(at) - 1, BITS // 64), np.int64)
    for i in range(0, len(out), most):
        border = at[i : i + most + 1]
        rows = len(border) - 1
        row = np.repeat(np.arange(rows), np.diff(border))
        odd = np.bincount(row * BITS + place[border[0] : border[-1]], minlength=rows * BITS).astype(np.uint8) & 1
        out[i : i + rows] = np.packbits(odd.reshape(rows, BITS), axis=1).view(np.int64)
    return out


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(c, all shingles) of the rows whose set is that of their class."""
        forget()
        for b in batches:
            wanted = b.column("f1").to_numpy()
            for i, j, raw, border in text_chunks(b.column("text")):
                at, h = shingle_sets(raw, border, words)
                total = np.zeros(len(h) + 1, np.uint64)
                np.cumsum(mix(h + _U(1)), out=total[1:])
                same = (total[at[1:]] - total[at[:-1]]).view(np.int64) == wanted[i:j]
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64)))
                out = pa.RecordBatch.from_arrays([b.column("c").slice(i, j - i), lists], names=["c", "s"])
                yield out.filter(pa.array(same))

    return run


def _texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, f1, text) of the classes that meet another in a list, found by id and text hash.

    Classes have different texts, so a row is that of one class at most, however many rows share its id.
    """
    ids = [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_k"), "f"]  # no null in a join key; the hash tells texts apart
    wanted = wanted.select(*ids, "c", "f1")
    texts = rows.select(*ids, "text").where(may_be_in(wanted, ["_k", "f"])("_k", "f"))
    return texts.join(wanted, ["_k", "f"]).select("c", "f1", "text")


def _needed(sim: Similarity, a: Column, b: Column) -> Column:
    """Least overlap of a linked pair of sets of these sizes."""
    return F.ceil(sim.share * (a + b) / F.lit(100 + sim.share) - 1e-9)


def _possible(sim: Similarity, a: str, b: str) -> Column:
    """Size and position filter of two list rows (structs of size and pos)."""
    s1, s2, p1, p2 = F.col(f"{a}.size"), F.col(f"{b}.size"), F.col(f"{a}.pos"), F.col(f"{b}.pos")
    return (100 * F.least(s1, s2) >= sim.share * F.greatest(s1, s2)) & (F.least(s1 - p1, s2 - p2) >= _needed(sim, s1, s2))


def _overlaps(pairs: DataFrame, sets: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """`pairs` (a, b, ...) with the overlap, and both sizes, of their sets; those of b are among `others`, if given."""
    left = sets.select(F.col("c").alias("a"), F.col("s").alias("_s"))
    right = (others or sets).select(F.col("c").alias("b"), F.col("s").alias("_t"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.withColumns({"o": F.size(F.array_intersect("_s", "_t")), "sa": F.size("_s"), "sb": F.size("_t")}).drop("_s", "_t")


class _Sets:
    """What is known of the classes that meet another in a list: parity bits of each, and the sets of those asked for so far.

    Whole sets come from the texts, which travel once, and then lie in buckets by class. Most classes that meet
    another have no pair that its parity bits leave open: neither their texts nor their sets travel.
    """

    def __init__(self, rows: DataFrame, classes: DataFrame, sim: Similarity):
        self.rows, self.sim, self.parts = rows, sim, []
        self.classes = cut_by(classes, "c")  # c, doc_id, f, f1, size, bits

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """`pairs` (a, b, ...) with `most`: parity bits differ at no more places than the sets do, which bounds the overlap."""
        left = self.classes.select(F.col("c").alias("a"), F.col("bits").alias("_x"), F.col("size").alias("sa"))
        right = self.classes.select(F.col("c").alias("b"), F.col("bits").alias("_y"), F.col("size").alias("sb"))
        apart = F.aggregate(F.zip_with("_x", "_y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, k: n + k)
        return pairs.join(left, "a").join(right, "b").withColumn("most", (F.col("sa") + F.col("sb") - apart) / 2).drop("_x", "_y")

    def of(self, pairs: DataFrame) -> DataFrame:
        """(c, s) of all classes of `pairs`, and of those asked for before."""
        asked = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
        for p in self.parts:
            asked = asked.join(p.select("c"), "c", "left_anti")
        asked = cut_lineage(self.classes.select("c", "doc_id", "f", "f1").join(asked, "c"))
        if not self.parts or not asked.isEmpty():
            found = _texts_of(self.rows, asked).mapInArrow(_full_sets(self.sim.words), "c long, s array<long>")
            self.parts.append(cut_by(found, "c", one_each=True))
        drop_stages(asked)
        return self.held()

    def held(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts)

    def drop(self) -> None:
        drop_stages(self.classes, *self.parts)


def _near(pairs: DataFrame, sets: _Sets) -> DataFrame:
    """Without pairs that cannot link, by their parity bits."""
    most, share = F.col("most"), sets.sim.share
    return cut_lineage(sets.bounded(pairs).where(100 * most >= share * (F.col("sa") + F.col("sb") - most)).select("a", "b"))


def _linked(pairs: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """The linked pairs, compared by their elements."""
    o = _overlaps(pairs, sets)
    return o.where(100 * F.col("o") >= sim.share * (F.col("sa") + F.col("sb") - F.col("o"))).select("a", "b")


def _verified(pairs: DataFrame, sets: _Sets) -> DataFrame:
    """The linked pairs; only near ones are compared by their elements."""
    near = _near(pairs, sets)
    links = cut_lineage(_linked(near, sets.of(near), sets.sim))
    drop_stages(near)
    return links


def _hooks(near: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Of the pairs of different components, for each component one with its smallest neighbour.

    Whole sets travel for a pair, and most near pairs link: as many pairs as there are components join them.
    """
    pairs = _apart(near, labels)
    ends = pairs.select(F.col("x").alias("node"), F.struct(F.col("y").alias("to"), "a", "b").alias("p"))
    ends = ends.unionByName(pairs.select(F.col("y").alias("node"), F.struct(F.col("x").alias("to"), "a", "b").alias("p")))
    return cut_lineage(ends.groupBy("node").agg(F.min("p").alias("p")).select("p.a", "p.b").distinct())


def _apart(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(a, b, x, y): the pairs of different components, x and y."""
    named = pairs.withColumns({"x": F.col("a"), "y": F.col("b")})
    return (named if labels is None else relabel(relabel(named, "x", labels), "y", labels)).where("x <> y")


def _still_open(postings: DataFrame) -> DataFrame:
    """Rows of the lists in which more than one component meets."""
    mixed = postings.groupBy("token").agg(F.min("label").alias("_x"), F.max("label").alias("_y")).where("_x <> _y").select("token")
    return postings.join(mixed, "token", "left_semi")


def _probe_pairs(postings: DataFrame, sim: Similarity, turn: int, orders: int, reach: int) -> DataFrame:
    """A few pairs of each list: every row with the next ones in a random order, in sublists of bounded size."""
    n = F.count(F.lit(1)).alias("_n")
    sizes = postings.groupBy("token").agg(n)
    cut = postings.join(sizes, "token").withColumn("_sub", F.pmod(F.xxhash64(F.lit(turn), "c"), F.ceil(F.col("_n") / SUBLIST)))
    order = W.partitionBy("token", "_sub").orderBy(F.xxhash64(F.lit(turn), F.pmod("token", F.lit(orders)), "c"), "c")
    me = F.struct("c", "size", "pos", "label")
    seen = cut.select("token", me.alias("x"), *[F.lead(me, k).over(order).alias(f"y{k}") for k in range(1, reach + 1)])
    parts = []
    for k in range(1, reach + 1):
        y = f"y{k}"
        pair = F.struct(F.least("x.c", f"{y}.c").alias("a"), F.greatest("x.c", f"{y}.c").alias("b"))
        parts.append(F.when((F.col("x.label") != F.col(f"{y}.label")) & _possible(sim, "x", y), pair))
    found = seen.select(F.explode(F.filter(F.array(*parts), lambda p: p.isNotNull())).alias("p"))
    return cut_lineage(found.select("p.a", "p.b").distinct())


def _with_partners(postings: DataFrame, sim: Similarity) -> DataFrame:
    """Without rows that can link with no other row of their list, by size and position.

    A row links with no set larger than `_most`, so in order of size it needs an earlier row that may
    be as large as itself, or a next one that is not too large. Lists beyond SUBLIST rows stay whole.
    """
    rows = postings.withColumn("_most", (F.col("size") - F.col("pos")) * (100 + sim.share) / F.lit(sim.share) - F.col("size") + 1e-6)
    order = W.partitionBy("token").orderBy("size", "c")
    earlier = F.max("_most").over(order.rowsBetween(W.unboundedPreceding, -1)) >= F.col("size")
    later = F.lead("size").over(order) <= F.col("_most")
    short = rows.where(F.col("n") <= SUBLIST).withColumn("_any", F.coalesce(earlier, F.lit(False)) | F.coalesce(later, F.lit(False)))
    return short.where("_any").drop("_any", "_most", "n").unionByName(rows.where(F.col("n") > SUBLIST).drop("_most", "n"))


def _remaining_pairs(postings: DataFrame, sets: _Sets) -> DataFrame:
    """All pairs of different components that the leaders' answers leave open."""
    sim = sets.sim
    block = F.floor(F.log("size") / F.lit(float(np.log(100 / sim.share))))
    members = postings.select("c", "label").distinct()
    # the label is a member: the leader. One may lead very many, so the leaders' sets are a table that may be dealt out anew
    led = members.where("c <> label").select(F.col("c").alias("a"), F.col("label").alias("b"))
    full = sets.of(led)
    leading = cut_lineage(full.join(led.select(F.col("b").alias("c")).distinct(), "c", "left_semi"))
    extra = _overlaps(led, full, leading)
    extra = extra.select(F.col("a").alias("_c"), (F.col("sa") - F.col("o")).alias("extra"))
    rows = postings.join(extra, F.col("c") == F.col("_c"), "left").withColumn("extra", F.coalesce("extra", F.lit(0))).drop("_c")
    rows = cut_lineage(rows.withColumn("block", block))
    x = rows.select("token", "block", F.struct("c", "size", "pos", "label", "extra").alias("x"))
    y = rows.select("token", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"), F.struct("c", "size", "pos", "label", "extra").alias("y"))
    meet = x.join(y, ["token", "block"]).where((F.col("x.label") < F.col("y.label")) & _possible(sim, "x", "y"))
    meet = cut_lineage(
        meet.select(
            F.col("x.c").alias("c"), F.col("y.c").alias("d"), F.col("x.label").alias("a"), F.col("y.label").alias("b"),
            (_needed(sim, F.col("x.size"), F.col("y.size")) - F.col("x.extra") - F.col("y.extra")).alias("least"),
        ).distinct()
    )
    # leaders whose parity bits rule out the least overlap that any of their members needs are not compared
    led_pairs = cut_lineage(sets.bounded(meet.groupBy("a", "b").agg(F.min("least").alias("least"))).where("most >= least").select("a", "b"))
    leaders = _overlaps(led_pairs, sets.of(led_pairs)).select("a", "b", "o")
    open_pairs = meet.join(leaders, ["a", "b"]).where("o >= least")
    out = cut_lineage(open_pairs.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")))
    drop_stages(rows, meet, leading, led_pairs)
    return out


def _derived_links(members: DataFrame, sim: Similarity) -> tuple[DataFrame, DataFrame]:
    """(c, n) and (a, b) of `members` (label, c, s, w): documents in other classes that link with c by the
    centre's answer, and the pairs of a component that the centre leaves open.

    With v = (100 + share) * lost + share * size, and t = (100 + share) * centre size, a pair links if its
    v together exceed t by no more than 100 + share for each element in which both differ from the centre.
    """
    one = 100 + sim.share
    held = members.select("label", F.explode("s").alias("e")).groupBy("label", "e").agg(F.count(F.lit(1)).alias("n"))
    most = held.join(members.groupBy("label").agg(F.count(F.lit(1)).alias("k")), "label").where("2 * n > k")
    centre = most.groupBy("label").agg(F.collect_list("e").alias("centre"))
    d = members.join(centre, "label", "left").withColumn("centre", F.coalesce("centre", F.array().cast("array<long>")))
    lost = F.array_except("centre", "s")
    v, t = one * F.size("lost").cast("long") + sim.share * F.size("s"), one * F.size("centre").cast("long")
    d = d.withColumn("lost", lost).select("label", "c", "w", v.alias("v"), t.alias("t"), F.concat(F.array_except("s", "centre"), "lost").alias("d"))
    d = cut_lineage(d)
    # documents whose v is at most t - v: sums over the distinct values of a component
    values = d.groupBy("label", "v").agg(F.sum("w").alias("w")).withColumn("ask", F.lit(0))
    asks = d.select("label", (F.col("t") - F.col("v")).alias("v")).distinct().withColumns({"w": F.lit(0).cast("long"), "ask": F.lit(1)})
    up_to = F.sum("w").over(W.partitionBy("label").orderBy("v", "ask").rowsBetween(W.unboundedPreceding, 0))
    answers = values.unionByName(asks).withColumn("n", up_to).where("ask = 1").select("label", F.col("v").alias("q"), "n")
    own = F.when(2 * F.col("v") <= F.col("t"), F.col("w")).otherwise(0)
    derived = cut_lineage(d.withColumn("q", F.col("t") - F.col("v")).join(answers, ["label", "q"]).select("c", (F.col("n") - own).alias("n")))
    ends = d.groupBy("label").agg(F.min("v").alias("least"), F.max("v").alias("most"))
    some = d.join(ends, "label").where("v + most > t")
    common = F.greatest(F.lit(1), F.ceil((F.col("v") + F.col("least") - F.col("t")) / F.lit(one) - 1e-9))
    rows = some.select("label", "c", "v", "t", F.size("d").alias("size"), common.alias("common"), F.explode("d").alias("e"))
    shared = rows.groupBy("label", "e").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    me = W.partitionBy("label", "c")
    left = F.count(F.lit(1)).over(me) - F.row_number().over(me.orderBy("n", "e")) + 1  # elements from this one on, rarest first
    rows = cut_lineage(rows.join(shared, ["label", "e"]).withColumn("left", left).where("left >= common").select("label", "e", "t", F.struct("c", "v", "left").alias("x")))
    other = rows.select("label", "e", F.col("x").alias("y"))
    over = F.col("x.v") + F.col("y.v") - F.col("t")
    meet = rows.join(other, ["label", "e"]).where((F.col("x.c") < F.col("y.c")) & (over > 0) & (one * F.least("x.left", "y.left") >= over))
    pairs = cut_lineage(meet.select(F.col("x.c").alias("a"), F.col("y.c").alias("b")).distinct())
    drop_stages(d, rows)
    return derived, pairs


def _link_counts(classes: DataFrame, sets: _Sets, labels: DataFrame, across: DataFrame) -> DataFrame:
    """(c, n_links) of every class: links of one of its documents, those to equal sets included.

    `labels` are the components before the links `across` (a, b) them, which are all that there are.
    """
    weight = classes.select("c", "w")
    full = sets.of(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))  # linked ones have all been asked for
    members = cut_lineage(labels.select(F.col("node").alias("c"), "label").join(full, "c").join(weight, "c"))
    derived, pairs = _derived_links(members, sets.sim)
    drop_stages(members)
    inside = _verified(pairs, sets)
    links = cut_lineage(across.unionByName(inside))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(weight.withColumnRenamed("c", "b"), "b").select(F.col("a").alias("c"), F.col("w").alias("n"))
    every = counts.unionByName(derived).unionByName(weight.select("c", (F.col("w") - 1).alias("n")))
    out = cut_lineage(every.groupBy("c").agg(F.sum("n").alias("n_links")))
    drop_stages(derived, pairs, inside, links)
    return out


def join_sets(docs: DataFrame, sim: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, f, n_shingles, class, component, component_id, n_links.

    n_links is the number of other rows that the row links with, rows with an equal set included. Rows with equal sets share `class`, linked ones `component` (null without words); `f` is the text's hash.

    component_id is the smallest doc_id that a document reaches by links, itself included. A text without
    words, or null, has no shingles and links with nothing. Repeated rows are documents of their own and
    equal; a null doc_id counts in no minimum, and a component of null ids alone has a null id. An empty
    table gives none. No link is skipped.
    """
    return _joined(docs, sim, id_col, text_col, True)


def _joined(docs: DataFrame, sim: Similarity, id_col: str, text_col: str, counted: bool) -> DataFrame:
    """join_sets; n_links is left out unless `counted`."""
    spark = docs.sparkSession
    rows = documents(docs, id_col, text_col).withColumn("f", F.xxhash64("text"))
    counts = rows.select("text").mapInArrow(_frequent(sim.words), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(MAX_FREQUENT).toArrow()  # MAX_FREQUENT rows at most
    h, n = top["h"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(h)
    shared = spark.sparkContext.broadcast((h[order], n[order]))
    sets = cut_lineage(rows.mapInArrow(_sets(sim, shared), _SETS))
    classes = cut_lineage(sets.where("size > 0").groupBy("f1", "f2").agg(F.min("key").alias("c"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("w")))
    several = may_be_in(classes.where("w > 1"), ["f1", "f2"])("f1", "f2")  # only such rows must meet their class
    first = sets.where("size > 0").select("key", "size", "prefix", several.alias("several"))
    first = first.where("NOT several").unionByName(first.where("several").join(classes.where("w > 1").select(F.col("c").alias("key")), "key", "left_semi"))
    postings = first.select(F.col("key").alias("c"), "size", F.posexplode("prefix").alias("pos", "token"))
    shared_tokens = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    postings = cut_lineage(postings.join(shared_tokens, "token").withColumn("label", F.col("c")))
    whole, postings = postings, cut_lineage(_with_partners(postings, sim))
    drop_stages(whole)
    meets = may_be_in(postings.select("c").distinct(), ["c"])("key")  # a few that meet none are never asked for
    known = _Sets(rows, sets.where(meets).select(F.col("key").alias("c"), "doc_id", "f", "f1", "size", "bits"), sim)
    release_shuffles(spark)
    labels = left = tried = None
    for turn, probe in enumerate([*PROBES, None]):
        pairs = _probe_pairs(postings, sim, turn, *probe) if probe else _remaining_pairs(postings, known)
        near = first_near = _near(pairs, known)
        if tried is not None:  # pairs compared before: the linked ones are inside components, the others are no links
            near = cut_lineage(near.join(tried, ["a", "b"], "left_anti"))
            drop_stages(first_near)
        done = left
        if probe:  # pairs left over wait for the next round, unless others join their components; the last round needs none
            every = near if left is None else cut_lineage(near.unionByName(left).distinct())
            near = _hooks(every, labels)
            left = cut_lineage(every.join(near, ["a", "b"], "left_anti"))
            drop_stages(every)
            tried, known_before = cut_lineage(near if tried is None else tried.unionByName(near)), tried
            drop_stages(known_before)
        links = found = cut_lineage(_linked(near, known.of(near), sim))
        if counted and not probe:
            n_links = _link_counts(classes, known, labels, links)
        if labels is not None:
            links = relabel(relabel(links, "a", labels), "b", labels)
        merged, before, lists = components(links), labels, postings
        labels = merged if before is None else cut_lineage(relabel(before, "label", merged).unionByName(merged.join(before, "node", "left_anti")))
        if probe:
            postings = cut_lineage(_still_open(relabel(lists, "label", merged)))
        drop_stages(pairs, near, found, done, before, lists, merged if before is not None else None)
        release_shuffles(spark)
    known.drop()
    named = relabel(classes.withColumn("label", F.col("c")), "label", labels)
    smallest = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    of_class = named.join(smallest, "label").select("f1", "f2", F.col("c").alias("class"), F.col("label").alias("component"), "component_id")
    if counted:
        of_class = of_class.join(n_links.withColumnRenamed("c", "class"), "class")
    joined = sets.drop("prefix", "bits").join(of_class, ["f1", "f2"], "left")
    own = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    more = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if counted else []
    return joined.select("doc_id", "f", F.col("size").cast("long").alias("n_shingles"), "class", "component", own.alias("component_id"), *more)


def keep_representatives(docs: DataFrame, sim: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that stand for their component: the smallest doc_id of each (null ids last).

    Texts without words link with nothing and stay. Of rows equal in id and text one stays.
    """
    # no null in a join key: null ids are told apart from the smallest id by the text's hash
    key = lambda c: F.coalesce(c, F.lit(-(1 << 63)))

    def representatives() -> DataFrame:
        joined = _joined(docs, sim, id_col, text_col, False)
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "f")
        lead = joined.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("r")).select("r.doc_id", "r.f")
        return lead.unionByName(joined.where("component IS NULL").select("doc_id", "f")).select(key(F.col("doc_id")).alias("_k"), F.col("f").alias("_f")).distinct()

    kept = settled(representatives)
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    work = docs.select(*own, key(F.col(id_col).cast("long")).alias("_k"), F.xxhash64(text).alias("_f"))
    one = W.partitionBy("_k", "_f").orderBy("_f")
    found = work.join(kept, ["_k", "_f"], "left_semi").withColumn("_n", F.row_number().over(one)).where("_n = 1")
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
