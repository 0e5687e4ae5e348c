"""Benchmark decontamination by edit distance: CGK random walks, bit sampling, exact verification.

An item's text is a string of words, and so is every window of its size in a document. The CGK random
walk reads a string with a pointer that moves on, or stays, by a random bit drawn for the step and the
word under it; two strings at a small edit distance fall into step again after each edit, so the words
they write agree at most steps. Sampling a few steps gives a locality-sensitive hash of the Hamming space;
enough repetitions, by the size of the item, reach the target recall. Windows that meet an item in a repetition are verified by the
exact edit distance, with free ends.

Only windows that share enough word triples with an item are walked: by the q-gram lemma, a text within k
edits of n words keeps n - 2 - 3k of the triples, so the windows left out cannot be matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm.encoding import forget
from cellcast.llm.rows import documents, named, numbered, text_chunks
from cellcast.llm.words import LOWER, Words, find_words, gram_starts, grams, mix

#: Everything ASCII but letters and digits parts the words that are compared.
PARTS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
SHARE = 0.2  # edits allowed per word of the item
MIN_WORDS = 6  # fewer words are no evidence of a leak
PIECE_WORDS = 256  # longer items are looked for in pieces of this size
SAMPLES = 3
#: Most words of a piece, and repetitions that find it with a recall of TARGET_RECALL when SHARE of its words are edited and
#: one place of the document holds it. Long walks fall out of step more: 32 repetitions find 0.58 of pieces of 256 words.
#: Measured on 80 random texts a size: 64 words 1.00 with 32; 128 words 1.00 with 128; 160, 192, 224 and 256 words 1.00 with 192.
TARGET_RECALL = 0.97
REPETITIONS = ((64, 32), (128, 128), (PIECE_WORDS, 192))
BLOCK_BYTES = 8_000_000
_FILTER = 22
_U = np.uint64


def edits_allowed(n: int) -> int:
    return int(SHARE * n)


def edit_words(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the compared words of each text."""
    out = []
    for t in texts:
        raw = np.frombuffer(t.encode("utf-8", "replace"), np.uint8)
        out.append(find_words(raw, np.array([0, len(raw)]), LOWER, PARTS).hash)
    return out


_SHARES = {n: np.random.Generator(np.random.PCG64(1)).random((SAMPLES, n, 1)) for _, n in REPETITIONS}
_SALTS = {n: np.random.Generator(np.random.PCG64(2)).integers(0, 1 << 63, (n, 1), dtype=np.uint64) for _, n in REPETITIONS}


def _by_size(size: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(repetitions, rows) of the pieces of each size class."""
    group = np.searchsorted([most for most, _ in REPETITIONS], size)
    return [(n, np.flatnonzero(group == k)) for k, (_, n) in enumerate(REPETITIONS)]


def walk_signatures(words: np.ndarray, size: np.ndarray, repetitions: int) -> np.ndarray:
    """Per repetition and row of `words` (zeros beyond the text): hash of the words written at the sampled steps.

    `size` is the size of the item that a row is compared with: rows of one size sample the same steps.
    """
    n, width = words.shape
    # of the 3 n steps a walk may take it uses about 2 n; later ones write nothing and would tell no texts apart
    picked = (_SHARES[repetitions] * 1.8 * size).astype(np.int64)  # sample, repetition, row
    salts = _SALTS[repetitions]
    at, out = np.zeros((repetitions, n), np.int64), np.broadcast_to(salts, (repetitions, n)).copy()
    padded = np.concatenate([words, np.zeros((n, 1), np.uint64)], axis=1).ravel()
    base = np.arange(n) * (width + 1)
    for step in range(int(picked.max(initial=-1)) + 1):
        word = padded[base + np.minimum(at, width)]
        for p in picked:
            r, i = np.nonzero(p == step)
            out[r, i] = mix(out[r, i] * _U(3) + word[r, i] + _U(1))
        # the random bit of this step and word
        bit = ((word ^ salts) + _U(step * 0xD1B54A32D192ED03 & ((1 << 64) - 1))) * _U(0x9E3779B97F4A7C15)
        bit ^= bit >> _U(29)
        bit *= _U(0xBF58476D1CE4E5B9)
        at += ((bit >> _U(63)).astype(np.int64)) & (at < size)
    return out


def edit_distances(item: np.ndarray, n: np.ndarray, window: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Least edit distance of item[:n] to any stretch of window[:m], row by row."""
    width = window.shape[1]
    column = np.arange(width + 1)
    beyond = np.where(column[None, :] > m[:, None], 1 << 20, 0)
    d = np.zeros((len(n), width + 1), np.int64)  # a match may begin anywhere
    best = np.where(n == 0, 0, 1 << 20)
    for i in range(item.shape[1]):
        cost = (window != item[:, i : i + 1]).astype(np.int64)
        step = np.empty_like(d)
        step[:, 0] = d[:, 0] + 1
        step[:, 1:] = np.minimum(d[:, :-1] + cost, d[:, 1:] + 1)
        d = np.minimum.accumulate(step - column, axis=1) + column
        last = n == i + 1
        if last.any():
            best[last] = (d + beyond).min(axis=1)[last]
    return best


@dataclass
class Items:
    """A bounded block of benchmark pieces, ready for search."""

    ids: np.ndarray
    words: np.ndarray  # one row per piece, zeros beyond its size
    size: np.ndarray
    gram: np.ndarray  # triples in order of their hash, with piece and place
    gram_piece: np.ndarray
    gram_at: np.ndarray
    maybe: np.ndarray  # a bit per short hash of a triple
    signatures: dict[int, list[tuple[np.ndarray, np.ndarray]]]  # per size class and repetition: sorted hashes and their pieces

    @staticmethod
    def of(ids: list[int], texts: list[str]) -> Items | None:
        pieces = []
        for i, w in zip(ids, edit_words(texts)):
            cuts = range(0, max(len(w) - PIECE_WORDS, 0) + PIECE_WORDS, PIECE_WORDS)
            pieces += [(i, w[max(0, min(a, len(w) - PIECE_WORDS)) : a + PIECE_WORDS]) for a in cuts]
        pieces = [(i, w) for i, w in pieces if len(w) >= MIN_WORDS]
        if not pieces:
            return None
        size = np.array([len(w) for _, w in pieces])
        words = np.zeros((len(pieces), size.max()), np.uint64)
        for r, (_, w) in enumerate(pieces):
            words[r, : len(w)] = w
        gram = np.concatenate([grams(w, 3) for _, w in pieces])
        piece = np.repeat(np.arange(len(pieces)), size - 2)
        at = np.concatenate([np.arange(n - 2) for n in size])
        order = np.argsort(gram, kind="stable")
        maybe = np.zeros(1 << _FILTER, bool)
        maybe[(gram & _U((1 << _FILTER) - 1)).astype(np.int64)] = True
        signatures = {}
        for n, rows in _by_size(size):
            hashes = walk_signatures(words[rows], size[rows], n)
            signatures[n] = [(s[by], rows[by]) for s in hashes for by in [np.argsort(s, kind="stable")]]
        return Items(np.array([i for i, _ in pieces], np.int64), words, size, gram[order], piece[order], at[order], maybe, signatures)


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) for every value of every range low..high."""
    n = high - low
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[owner]


def _windows(words: Words, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(piece, first word) of the windows that share enough triples with a piece."""
    at = gram_starts(words, 3)
    g = grams(words.hash, 3)[at] if len(at) else np.zeros(0, np.uint64)
    near = items.maybe[(g & _U((1 << _FILTER) - 1)).astype(np.int64)]
    at, g = at[near], g[near]
    owner, value = _expand(np.searchsorted(items.gram, g, "left"), np.searchsorted(items.gram, g, "right"))
    at, piece, place = at[owner], items.gram_piece[value], items.gram_at[value]
    if not len(at):
        return piece, at
    # triples of one piece that lie within its reach in one document
    allowed = (SHARE * items.size).astype(np.int64)
    reach, need = items.size + allowed, np.maximum(items.size - 2 - 3 * allowed, 1)
    key = piece * (len(words) + 1) + at
    order = np.lexsort((place, key))
    at, piece, place, key = at[order], piece[order], place[order], key[order]
    new = np.append(True, key[1:] != key[:-1])  # a place of the document counts once
    rank = np.cumsum(new) - 1
    where = key[new]
    first = np.searchsorted(where, key - reach[piece], "left")
    count_back = rank - np.maximum(first, np.searchsorted(where, piece * (len(words) + 1), "left")) + 1
    last = np.searchsorted(where, np.minimum(key + reach[piece], (piece + 1) * (len(words) + 1) - 1), "right")
    # the stretch that holds a match reaches from this triple at most so far to either side
    keep = (count_back + (last - rank) - 1) >= need[piece]
    at, piece, place = at[keep], piece[keep], place[keep]
    start = np.maximum(at - place, words.first[words.row[at]])
    pair = np.unique(piece * (len(words) + 1) + start)
    return pair // (len(words) + 1), pair % (len(words) + 1)


def _rows_of(hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    width = int(size.max()) if len(size) else 0
    at = start[:, None] + np.arange(width)
    return np.where(np.arange(width) < size[:, None], hashes[np.minimum(at, len(hashes) - 1)], _U(0))


@dataclass
class _Candidates:
    """Windows of many chunks, so that short walks are made for many windows at once."""

    row: np.ndarray  # row of the batch
    start: np.ndarray  # first word of the window in its row
    piece: np.ndarray
    window: np.ndarray  # words of the window, zeros beyond its end
    around: np.ndarray  # words that a match of any piece from here may reach, and their number
    size: np.ndarray


def _candidates(words: Words, items: Items, first_row: int) -> _Candidates | None:
    piece, start = _windows(words, items)
    if not len(start):
        return None
    row = words.row[start]
    allowed = edits_allowed(int(items.size.max()))
    width = items.words.shape[1]
    low = np.maximum(start - allowed, words.first[row])
    m = np.minimum(start + width + allowed, words.first[row + 1]) - low
    n = np.minimum(items.size[piece], words.first[row + 1] - start)
    fit = lambda x, w: np.pad(x, ((0, 0), (0, w - x.shape[1])))
    return _Candidates(
        row + first_row, start - words.first[row], piece, fit(_rows_of(words.hash, start, n), width),
        fit(_rows_of(words.hash, low, m), width + 2 * allowed), m,
    )


def _best_matches(lots: list[_Candidates], items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, piece, first word, distance) of the best match of each row and piece: buckets first, then exact distances."""
    if not lots:
        return (np.zeros(0, np.int64),) * 4
    c = _Candidates(*(np.concatenate([getattr(x, f) for x in lots]) for f in ("row", "start", "piece", "window", "around", "size")))
    found = []
    for n, rows in _by_size(items.size[c.piece]):
        step = 128_000 // n
        for lot in range(0, len(rows), step):
            part = rows[lot : lot + step]
            for s, (sorted_hash, by) in zip(walk_signatures(c.window[part], items.size[c.piece[part]], n), items.signatures[n]):
                owner, value = _expand(np.searchsorted(sorted_hash, s, "left"), np.searchsorted(sorted_hash, s, "right"))
                found.append(np.unique(part[owner] * len(items.ids) + by[value]))
    pair = np.unique(np.concatenate(found)).astype(np.int64)
    window, piece = pair // len(items.ids), pair % len(items.ids)
    n = items.size[piece]
    allowed = (SHARE * n).astype(np.int64)
    distance = np.zeros(len(pair), np.int64)
    for lot in range(0, len(pair), 2000):
        p = slice(lot, lot + 2000)
        m = c.size[window[p]]
        distance[p] = edit_distances(items.words[piece[p], : int(n[p].max())], n[p], c.around[window[p], : int(m.max())], m)
    row, start = c.row[window], c.start[window]
    ok = np.flatnonzero(distance <= allowed)
    order = ok[np.lexsort((start[ok], distance[ok], piece[ok], row[ok]))]
    best = order[np.append(True, (np.diff(row[order]) != 0) | (np.diff(piece[order]) != 0))[: len(order)]]
    return row[best], piece[best], start[best], distance[best]


def batch_leaks(column: pa.Array, items: Items, most: int = 20_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Best matches of each row of a text column and each piece, in groups of rows."""
    lots, n = [], 0
    for i, _, raw, border in text_chunks(column):
        if (c := _candidates(find_words(raw, border, LOWER, PARTS), items, i)) is not None:
            lots.append(c)
            n += len(c.row)
        if n > most:
            yield _best_matches(lots, items)
            lots, n = [], 0
    yield _best_matches(lots, items)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    """The benchmark in blocks of about BLOCK_BYTES, one on the driver at a time."""
    items = documents(benchmark, id_col, text_col)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).orderBy("doc_id", "text").collect()
        if found := Items.of([-1 if r["doc_id"] is None else r["doc_id"] for r in rows], [r["text"] for r in rows]):
            yield found


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        items = shared.value
        for b in batches:
            for row, piece, start, distance in batch_leaks(b.column("text"), items):
                doc = b.column("doc_id").take(pa.array(row))
                columns = [doc, *(pa.array(x.astype(np.int64)) for x in (items.ids[piece], start, items.size[piece], distance))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "start_word", "n_words", "distance"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_words, distance): the best match of each item in each document that has one.

    Words are compared in lower case and without ASCII punctuation. A match has at most SHARE edits per
    item word. Items (or remainders) of fewer than MIN_WORDS words, null and empty ones match nothing; an
    item without id has item_id -1. Repeated rows are searched each; null texts are empty. The benchmark
    is the query set: it goes to all documents in blocks of bounded size.
    """
    spark, rows = docs.sparkSession, documents(docs, id_col, text_col)
    out = None
    for items in item_blocks(benchmark, item_id, item_text):
        part = rows.mapInArrow(_find(spark.sparkContext.broadcast(items)), "doc_id long, item_id long, start_word long, n_words long, distance long")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return rows.where("false").selectExpr("doc_id", "0L AS item_id", "0L AS start_word", "0L AS n_words", "0L AS distance")
    best = F.min_by(F.struct("start_word", "n_words", "distance"), F.struct("distance", "start_word"))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def _mark(shared, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        items = shared.value
        for b in batches:
            leaked = np.zeros(b.num_rows, bool)
            for row, *_ in batch_leaks(b.column(text), items):
                leaked[row] = True
            yield b.filter(pa.array(~leaked))

    return run


def drop_leaked(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, in which no benchmark item is found. Nothing is shuffled."""
    spark = docs.sparkSession
    work, text = numbered(docs, text_col)
    for items in item_blocks(benchmark, item_id, item_text):
        work = work.mapInArrow(_mark(spark.sparkContext.broadcast(items), text), work.schema)
    return named(work, docs)
