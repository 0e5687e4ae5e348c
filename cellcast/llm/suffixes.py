"""Repeated passages by sparse suffix arrays over words.

Of all suffixes only those at minimiser positions are retained: in every window of `min_words` words, the
place of the smallest hash of GRAM words. The choice depends on the window's words alone, so two copies
of a passage retain the same suffixes. A retained suffix stands for the windows that chose it; with the
words to its left and right that these windows span, it is one row.

Rows are sorted by suffix hash, and equal neighbours (same suffix, same extension to both sides) are
found by a map-side reducing aggregate, so a passage that a third of all documents share is no hot
group. Where the same suffix stands in different surroundings, at the edge of a passage or an edit, the
match is extended word by word: the windows of one row of each surrounding are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm.encoding import forget
from cellcast.llm.rows import documents, may_be_in, text_chunks
from cellcast.llm.words import LOWER, Words, _power_tables, find_words, gram_starts, grams, mix
from cellcast.session import cut_lineage, settled

GRAM = 20
_U = np.uint64
_PLACE = 26  # bits for the place in a chunk, below those of the hash


def minimisers(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last): the windows first..last (their first words) chose the GRAM words at place."""
    starts = gram_starts(words, min_words)
    if not len(starts):
        return starts, starts, starts
    h = grams(words.hash, GRAM)
    low = (_U(1) << _U(_PLACE)) - _U(1)
    best = (h & ~low) | (np.arange(len(h)).astype(np.uint64) & low)  # the leftmost of equal hashes
    span, done = min_words - GRAM + 1, 1
    while done < span:
        step = min(done, span - done)
        best = np.minimum(best[:-step], best[step:])
        done += step
    place = (best[starts] & low).astype(np.int64)
    new = np.append(True, (place[1:] != place[:-1]) | (np.diff(words.row[starts]) != 0))
    first = np.flatnonzero(new)
    return place[first], starts[first], starts[np.append(first[1:], len(starts)) - 1]


def _stretch_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words start..end of each stretch."""
    up, down = _power_tables(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h + _U(5)) * up[: len(h)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def _retained(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in batches:
            for i, j, raw, border in text_chunks(b.column("text")):
                words = find_words(raw, border, LOWER)
                place, first, last = minimisers(words, min_words)
                if not len(place):
                    continue
                row = words.row[first]
                suffix = grams(words.hash, GRAM)[place]
                around = mix(_stretch_hashes(words.hash, first, last + min_words) + (place - first).astype(np.uint64))
                own = pa.array(row)
                base = words.first[row]
                columns = [pa.array(suffix.view(np.int64)), pa.array(around.view(np.int64)), b.column("doc_id").slice(i, j - i).take(own),
                           b.column("f").slice(i, j - i).take(own), pa.array((first - base).astype(np.int32)), pa.array((last - base).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["suffix", "around", "doc_id", "f", "first", "last"])

    return run


def _edge_windows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(window hash, doc_id, f, first word, known) of every window of the rows asked for."""
        for b in batches:
            asked = b.column("asked").to_pylist()
            for i, j, raw, border in text_chunks(b.column("text")):
                words = find_words(raw, border, LOWER)
                h = grams(words.hash, min_words)
                for k in range(i, j):
                    base = words.first[k - i]
                    first, last = np.array([a["first"] for a in asked[k]]), np.array([a["last"] for a in asked[k]])
                    n = last - first + 1
                    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
                    known = np.repeat([a["known"] for a in asked[k]], n)
                    own = pa.array(np.full(len(at), k))
                    columns = [pa.array(h[base + at].view(np.int64)), b.column("doc_id").take(own), b.column("f").take(own), pa.array(at.astype(np.int32)), pa.array(known)]
                    yield pa.RecordBatch.from_arrays(columns, names=["w", "doc_id", "f", "first", "known"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping stretches of one document and kind become one span."""
    for b in batches:
        out: list[tuple] = []
        for doc, f, parts in zip(b.column("doc_id").to_pylist(), b.column("f").to_pylist(), b.column("parts").to_pylist()):
            for copy in (False, True):
                end = -1
                for a, z in sorted((p["first"], p["end"]) for p in parts if p["copy"] == copy):
                    if a > end:
                        out.append([doc, f, copy, a, z])
                    else:
                        out[-1][4] = max(out[-1][4], z)
                    end = out[-1][4]
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "f", "copy", "start_word", "end_word"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents(docs, id_col, text_col).withColumn("f", F.xxhash64("text"))


def repeated_spans(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, f, copy, start_word, end_word): all stretches made of windows that occur more than once.

    `copy` is false for the windows that come first in order of (doc_id, place), true for all later
    ones; stretches of one kind that overlap or touch are one span. Words are compared in lower case (A-Z). `f` tells
    apart rows that share an id; rows equal in id and text are one document. Null ids come first; null
    and short texts have no spans; an empty table gives none.
    """
    if min_words < GRAM:
        raise ValueError(f"min_words must be {GRAM} or more")
    rows = _keyed(docs, id_col, text_col)
    kind = "suffix long, around long, doc_id long, f long, first int, last int"
    suffixes = cut_lineage(rows.mapInArrow(_retained(min_words), kind))
    place = F.struct("doc_id", "f", "first")
    groups = cut_lineage(
        suffixes.groupBy("suffix", "around")
        .agg(F.min(F.struct("doc_id", "f", "first", "last")).alias("lead"), F.max(place).alias("rear"))
        .select("suffix", "around", "lead", (F.struct("lead.doc_id", "lead.f", "lead.first") != F.col("rear")).alias("repeated"))
    )
    # the same suffix in different surroundings
    mixed = groups.groupBy("suffix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("suffix", F.lit(True).alias("mixed"))
    groups = cut_lineage(groups.join(mixed, "suffix", "left").where("repeated OR mixed"))
    edge = groups.where("mixed").select("lead.*", F.col("repeated").alias("known"))
    asked = edge.groupBy("doc_id", "f").agg(F.collect_list(F.struct("first", "last", "known")).alias("asked"))
    asked = asked.select(F.col("doc_id").alias("_id"), F.col("f").alias("_f"), "asked")
    # texts of the documents that lead such a group
    texts = rows.join(asked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("f") == F.col("_f"))).select("doc_id", "f", "text", "asked")
    windows = cut_lineage(texts.mapInArrow(_edge_windows(min_words), "w long, doc_id long, f long, first int, known boolean").distinct())
    met = windows.groupBy("w").agg(F.min(place).alias("lead"), F.max(place).alias("rear"), F.max("known").alias("known"))
    met = met.where((F.col("lead") != F.col("rear")) | F.col("known")).select("w", "lead")
    of_edges = windows.join(met, "w").select("doc_id", "f", "first", (F.col("first") + min_words).alias("end"), (F.col("lead") != place).alias("copy"))
    again = groups.where("repeated").select("suffix", "around", "lead", "mixed")
    of_groups = suffixes.join(again, ["suffix", "around"]).select(
        "doc_id", "f", "first", (F.col("last") + min_words).alias("end"), (F.struct("lead.doc_id", "lead.f", "lead.first") != place).alias("copy"), "mixed"
    )
    # the first row of a mixed group has been looked at window by window
    of_groups = of_groups.where("copy OR mixed IS NULL").drop("mixed")
    parts = of_groups.unionByName(of_edges).distinct()
    by_doc = parts.groupBy("doc_id", "f").agg(F.collect_list(F.struct("first", "end", "copy")).alias("parts"))
    return by_doc.mapInArrow(_merged, "doc_id long, f long, copy boolean, start_word long, end_word long")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans' words, and whether any word is left."""
    for b in batches:
        spans, texts, left = b.column("spans").to_pylist(), [], []
        for k, text in enumerate(b.column("text").to_pylist()):
            if not spans[k]:
                texts.append(text)
                left.append(True)
                continue
            raw = np.frombuffer(text.encode(), np.uint8)
            words = find_words(raw, np.array([0, len(raw)]), LOWER)
            begin = np.append(words.start, len(raw))
            keep, words_left = np.ones(len(raw), bool), np.ones(len(words), bool)
            for s in spans[k]:
                keep[begin[s["start_word"]] : begin[s["end_word"]]] = False
                words_left[s["start_word"] : s["end_word"]] = False
            texts.append(raw[keep].tobytes().decode())
            left.append(bool(words_left.any()))
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names[:-2]), pa.array(texts, pa.string()), pa.array(left)], names=[*b.schema.names[:-2], "text", "left"])


def drop_repeats(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with every later copy of a passage of `min_words` or more words cut out of `text_col`.

    The first copy stays. Rows of which no word is left are dropped; all others stay, with all columns.
    """

    def later_copies() -> DataFrame:
        spans = repeated_spans(docs, min_words, id_col, text_col).where("copy")
        by_doc = spans.groupBy("doc_id", "f").agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans"))
        return by_doc.select(F.col("doc_id").alias("_id"), F.col("f").alias("_f"), "spans")

    by_doc = settled(later_copies)
    inner = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]
    kinds = [f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(docs.columns) if c != text_col]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    work = docs.select(*inner, F.col(id_col).cast("long").alias("_doc"), text.alias("text")).withColumn("_hash", F.xxhash64("text"))
    # rows without spans stay where they are: only those that may have some meet them
    work = work.withColumn("_may", may_be_in(by_doc, ["_id", "_f"])("_doc", "_hash"))
    joined = work.where("_may").join(by_doc, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_f")), "left")
    names = [k.split()[0] for k in kinds]
    out = joined.select(*names, "text", "spans").mapInArrow(_cut, ", ".join([*kinds, "text string", "left boolean"])).where("left").drop("left")
    out = out.unionByName(work.where("NOT _may").select(*out.columns))
    return out.select(*[F.col("text" if c == text_col else f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
