"""Subword lattice likelihood: the marginal probability of a text over all its segmentations.

The pieces are those of an existing public vocabulary. Their scores there (ranks) give the first weights;
expectation maximisation over the distinct words of the training texts re-estimates them, together with
those of the commonest words, a bounded number, which join the pieces. A word's
lattice probability is the sum over all its segmentations, by a forward recursion in log space. A word
of the training texts also has an arc of its own, weighted by its discounted count, and the mass that
the discount frees is spread by the lattice:

    P(w) = max(c(w) - d, 0) / N + d * V / N * P_lattice(w)

While a text is read, a word it already holds has one more arc, weighted by its share of the words so
far. A text's score is the log10 probability of its words and one end token. Counts live in a table keyed by
word; the commonest words, a bounded number, are sent to the tasks and all others are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm.rows import text_chunks
from cellcast.llm.words import LOWER, _power_tables, find_words, mix, span_hashes
from cellcast.session import cut_lineage

_U = np.uint64
_TABLE = 20  # bits of a hash table slot
WORD_MARK = "▁".encode()
MAX_STEM = 16  # bytes of a word that joins the pieces


@dataclass(frozen=True)
class Pieces:
    """Pieces as bytes (a leading space marks a word's begin) with natural-log weights that sum to one."""

    texts: tuple[bytes, ...]
    log_p: np.ndarray


def vocabulary_pieces(path: str) -> Pieces:
    """Pieces of a SentencePiece file, weighted by the rank its scores give them; every single byte is one."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {}
    order = sorted(range(sp.get_piece_size()), key=lambda i: (-sp.get_score(i), i))
    for rank, i in enumerate(order):
        if sp.is_control(i) or sp.is_unknown(i):
            continue
        text = sp.id_to_piece(i)
        raw = bytes([int(text[3:5], 16)]) if sp.is_byte(i) else text.encode()
        if not sp.is_byte(i) and raw.startswith(WORD_MARK):
            raw = b" " + raw[len(WORD_MARK) :]
        if WORD_MARK not in raw and raw.count(b" ") == raw.startswith(b" "):
            weight[raw] = weight.get(raw, 0.0) + 1.0 / (rank + 1)
    for i in range(256):
        weight.setdefault(bytes([i]), 1.0 / (len(order) + 1))
    texts = tuple(sorted(weight))
    p = np.array([weight[t] for t in texts])
    return Pieces(texts, np.log(p / p.sum()))


def with_words(pieces: Pieces, words: list[bytes], share: float = 1e-6) -> Pieces:
    """Common words without the punctuation at their end become pieces, too, so that a new word may be a known one and more."""
    weight = dict(zip(pieces.texts, np.exp(pieces.log_p)))
    for w in words:
        stem = w.rstrip(b".,!?;:|")
        if 0 < len(stem) < MAX_STEM:
            weight.setdefault(b" " + stem, share)
    texts = tuple(sorted(weight))
    p = np.array([weight[t] for t in texts])
    return Pieces(texts, np.log(p / p.sum()))


class Lattice:
    """Forward (and backward) recursions over batches of words."""

    def __init__(self, pieces: Pieces):
        self.log_p = pieces.log_p
        size = np.array([len(t) for t in pieces.texts])
        border = np.concatenate([[0], np.cumsum(size)])
        raw = np.frombuffer(b"".join(pieces.texts), np.uint8)
        self.hash = span_hashes(raw, border[:-1], border[1:])
        self.lengths = sorted(set(size.tolist()))
        # two-level hash table; the few pieces that collide twice are searched
        self.slots = []
        left = np.arange(len(size))
        for shift in (0, 20, 40):
            slot = ((self.hash[left] >> _U(shift)) & _U((1 << _TABLE) - 1)).astype(np.int64)
            table = np.full(1 << _TABLE, -1, np.int32)
            table[slot] = left
            self.slots.append((shift, table))
            left = left[table[slot] != left]
        if len(left):
            raise ValueError("pieces collide")

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in h of the hashes of pieces, the pieces' numbers)."""
        # every piece fills its slot of the first table: most hashes meet an empty one
        at = np.flatnonzero(self.slots[0][1][(h & _U((1 << _TABLE) - 1)).astype(np.int64)] >= 0)
        h = h[at]
        out = np.full(len(h), -1, np.int32)
        for shift, table in self.slots:
            piece = table[((h >> _U(shift)) & _U((1 << _TABLE) - 1)).astype(np.int64)]
            np.copyto(out, piece, where=(out < 0) & (piece >= 0) & (self.hash[piece] == h))
        found = out >= 0
        return at[found], out[found]

    def _arcs(self, raw: np.ndarray, end_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece) of all arcs, by length and start."""
        n = len(raw)
        up, down = _power_tables(n + 1)
        total = np.zeros(n + 1, np.uint64)
        from cellcast.llm.words import _VALUES

        np.cumsum(_VALUES[raw] * up[:n], out=total[1:])
        left = end_of - np.arange(n)
        most, starts, sizes, pieces = left.max(), [], [], []
        for k in self.lengths:
            if k > most:
                break
            at = np.flatnonzero(left >= k)
            found, piece = self._find(mix((total[at + k] - total[at]) * down[at]))
            starts.append(at[found])
            sizes.append(np.full(len(found), k))
            pieces.append(piece)
        return np.concatenate(starts), np.concatenate(sizes), np.concatenate(pieces)

    def run(self, words: list[bytes], expect: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """(log probability of each word, expected number of each piece over all words if asked)."""
        size = np.array([len(w) + 1 for w in words])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        raw = np.frombuffer(b"".join(b" " + words[i] for i in order), np.uint8)
        end = np.cumsum(size)
        start = end - size
        begin, length, piece = self._arcs(raw, np.repeat(end, size))
        own = np.repeat(np.arange(len(size)), size)[begin]
        weight = self.log_p[piece]
        node = start + np.arange(len(size))  # a word of n bytes has n + 1 nodes
        source = begin + own
        target = source + length
        place = begin - start[own]  # bytes of the word before the arc
        alpha = np.full(len(raw) + len(size), -np.inf)
        alpha[node] = 0.0
        for arcs, first in _steps(place + length, target):
            terms = alpha[source[arcs]] + weight[arcs]
            alpha[target[arcs[first]]] = _log_sum(terms, first)
        whole = alpha[node + size]
        out = np.empty(len(words))
        out[order] = whole
        if not expect:
            return out, None
        beta = np.full(len(raw) + len(size), -np.inf)
        beta[node + size] = 0.0
        for arcs, first in reversed(_steps(place, source)):
            beta[source[arcs[first]]] = _log_sum(beta[target[arcs]] + weight[arcs], first)
        use = np.isfinite(whole)[own]  # a word that the pieces cannot make expects none
        share = np.exp(beta[target[use]] + weight[use] + (alpha[source[use]] - whole[own[use]]))
        return out, np.bincount(piece[use], share, minlength=len(self.log_p))


def _steps(step: np.ndarray, node: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per step, in ascending order: its arcs, by node, and where among them each node begins."""
    if not len(step):
        return []
    order = np.lexsort((node, step))
    node, step = node[order], step[order]
    border = np.append(np.flatnonzero(np.append(True, step[1:] != step[:-1])), len(step))
    first = np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (step[1:] != step[:-1])))
    cut = np.searchsorted(first, border)
    return [(order[a:b], first[i:j] - a) for a, b, i, j in zip(border[:-1], border[1:], cut[:-1], cut[1:])]


def _log_sum(terms: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per group, which begins at `first`, the logarithm of the sum of the exponentials."""
    top = np.maximum.reduceat(terms, first)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.add.reduceat(np.exp(terms - np.repeat(safe, np.diff(np.append(first, len(terms))))), first)) + safe


def _runs(words: list[bytes], limit: int = 400_000) -> Iterator[list[bytes]]:
    """Runs of words of about `limit` bytes, so that the tables of arcs stay small."""
    run, n = [], 0
    for w in words:
        run.append(w)
        n += len(w) + 1
        if n >= limit:
            yield run
            run, n = [], 0
    if run:
        yield run


def _taken(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans of raw as binaries."""
    size = end - start
    border = np.concatenate([[0], np.cumsum(size)])
    data = raw[np.arange(border[-1]) + np.repeat(start - border[:-1], size)]
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(border.astype(np.int32)), pa.py_buffer(data)])


class _Counter:
    """Distinct words with their counts; parts are merged as they grow."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def add(self, h: np.ndarray, n: np.ndarray, words: pa.Array) -> None:
        self.parts.append((h, n, words))

    def size(self) -> int:
        return sum(len(p[0]) for p in self.parts)

    def merge(self) -> None:
        if len(self.parts) > 1:
            h, at, inverse = np.unique(np.concatenate([p[0] for p in self.parts]), return_index=True, return_inverse=True)
            n = np.bincount(inverse, np.concatenate([p[1] for p in self.parts]), minlength=len(h)).astype(np.int64)
            self.parts = [(h, n, pa.concat_arrays([p[2] for p in self.parts]).take(pa.array(at)))]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, occurrences in training rows) of every word of the task, held-out rows' words with 0."""
    seen, limit = _Counter(), 300_000

    def out() -> Iterator[pa.RecordBatch]:
        for _, n, words in seen.parts:
            for i in range(0, len(n), 50_000):
                yield pa.RecordBatch.from_arrays([words.slice(i, 50_000), pa.array(n[i : i + 50_000])], names=["word", "n"])
        seen.parts = []

    for b in batches:
        train = np.asarray(b.column("train").to_numpy(zero_copy_only=False), bool)
        for i, j, raw, border in text_chunks(b.column("text")):
            words = find_words(raw, border, LOWER)
            h, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
            n = np.bincount(inverse, train[i:j][words.row], minlength=len(h)).astype(np.int64)
            seen.add(h, n, _taken(LOWER[raw], words.start[at], words.end[at]))
            if seen.size() > 2 * limit:
                seen.merge()
                if seen.size() > limit:
                    yield from out()
    seen.merge()
    yield from out()


def _expected(pieces: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total = Lattice(pieces), np.zeros(len(pieces.texts))
        for b in batches:
            for words in _runs(b.column("word").to_pylist()):
                total += lattice.run(words, expect=True)[1]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "n"])

    return run


def fit_pieces(words: DataFrame, pieces: Pieces, rounds: int = 4, strength: float = 1000.0) -> Pieces:
    """Piece weights re-estimated on the distinct words; the vocabulary's own weights count `strength` pieces."""
    prior = np.exp(pieces.log_p)
    for _ in range(rounds):
        rows = words.mapInArrow(_expected(pieces), "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()  # one per piece at most
        n = strength * prior
        n[[r["piece"] for r in rows]] += [r["n"] for r in rows]
        pieces = Pieces(pieces.texts, np.log(n / n.sum()))
    return pieces


def _word_scores(pieces: Pieces, discount: float, n_tokens: int, n_types: int, base_add: float, base_total: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        for b in batches:
            words, n = b.column("word").to_pylist(), b.column("n").to_numpy()
            log_p = np.concatenate([lattice.run(w)[0] for w in _runs(words)])
            size = np.array([len(w) for w in words])
            end = np.cumsum(size)
            h = span_hashes(np.frombuffer(b"".join(words), np.uint8), end - size, end)
            with np.errstate(divide="ignore"):
                own = np.log(np.maximum(n - discount, 0) / n_tokens)
            score = np.logaddexp(own, np.log(discount * n_types / n_tokens) + log_p) / np.log(10)
            base = np.log10((n + base_add) / base_total)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n), pa.array(base), pa.array(score)], names=["hash", "n", "base", "score"])

    return run


@dataclass(frozen=True)
class LatticeModel:
    """`table`: (hash, n, base, score) of every word; hot_*: the same of the commonest, by ascending hash."""

    table: DataFrame
    hot: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    n_tokens: int
    end_base: float
    end_score: float
    end_known: bool  # whether any text trained


def fit_lattice(docs: DataFrame, vocabulary: str, max_hot: int = 200_000, max_word_pieces: int = 50_000, base_add: float = 0.1, rounds: int = 4) -> LatticeModel:
    """`docs` has text and train (boolean); words of rows that do not train get a score, too.

    All counts cover all rows. Only `max_hot` words and one number per piece reach the driver.
    """
    spark = docs.sparkSession
    counted = docs.select("text", "train").mapInArrow(_word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = cut_lineage(counted)
    one = words.agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v"), F.count(F.when(F.col("n") == 1, 1)).alias("n1"), F.count(F.when(F.col("n") == 2, 1)).alias("n2")).first()
    ends = docs.where("train").count()
    n_tokens, n_types = (one["n"] or 0) + ends, one["v"] + (ends > 0)
    discount = one["n1"] / (one["n1"] + 2 * one["n2"]) if one["n1"] else 0.5
    discount = min(max(discount, 0.1), 0.9)
    pieces = vocabulary_pieces(vocabulary)
    if n_tokens:
        common = words.where("n > 0").orderBy(F.desc("n"), "word").limit(max_word_pieces).toArrow()  # at most so many words
        pieces = with_words(pieces, common["word"].to_pylist())
        pieces = fit_pieces(words.where("n > 0"), pieces, rounds)
    base_total = n_tokens + base_add * (n_types + 1)
    scorer = _word_scores(pieces, discount, max(n_tokens, 1), max(n_types, 1), base_add, base_total)
    table = cut_lineage(words.mapInArrow(scorer, "hash long, n long, base double, score double"))
    common = table.orderBy(F.desc("n"), "hash").limit(max_hot).toArrow().sort_by("hash")  # `max_hot` rows at most
    hot = tuple(common[c].to_numpy() for c in ("hash", "n", "base", "score"))
    end_base = float(np.log10((ends + base_add) / base_total))
    end_score = float(np.log10(max(ends - discount, 0.1) / n_tokens)) if n_tokens else 0.0
    return LatticeModel(table, hot, n_tokens, end_base, end_score, ends > 0)


_PART = "key long, doc_id long, hash long, times long, again array<double>, n_tokens long, n_known long, base double, score double"
_KINDS = {"long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
_PART_ARROW = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in _PART.split(", ")])
#: The weight of the text's own words is OWN_SHARE * j / (j + OWN_HALF) after j words.
OWN_SHARE, OWN_HALF = 0.25, 50.0


def _own_odds(j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of what the own words leave, odds of the own words) after j words."""
    share = OWN_SHARE * j / (j + OWN_HALF)
    return np.log10(1 - share), share / (1 - share) / np.maximum(j, 1)


def _partial(shared, end_base: float, end_score: float, end_known: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, n, base, score = shared.value
        key = TaskContext.get().partitionId() << 40  # with the row's place: the same in a repeated task
        for b in batches:
            for i, j, raw, border in text_chunks(b.column("text")):
                words, rows = find_words(raw, border, LOWER), j - i
                # occurrences of a word in a text, in order: `k` counts the earlier ones
                order = np.lexsort((words.hash, words.row))
                h, row = words.hash.view(np.int64)[order], words.row[order]
                new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])) if len(h) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(h)))
                k = np.arange(len(h)) - np.repeat(first, times)
                left, odds = _own_odds((order - words.first[row]).astype(float))
                odds *= k
                at = np.minimum(np.searchsorted(hot, h), max(len(hot) - 1, 0))
                known = hot[at] == h if len(hot) else np.zeros(len(h), bool)
                own = key + np.arange(rows)
                size = np.diff(words.first)
                a, r = at[known], row[known]
                sums = np.bincount(r, np.log10(10.0 ** score[a] + odds[known]), minlength=rows) + np.bincount(row, left, minlength=rows)
                total = [size + 1, np.bincount(r, n[a] > 0, minlength=rows).astype(np.int64) + end_known, np.bincount(r, base[a], minlength=rows) + end_base,
                         sums + end_score + _own_odds(size.astype(float))[0]]
                none, empty = np.zeros(rows, np.int64), pa.array([[]] * rows, _KINDS["array<double>"])
                # a text's own row takes part in no word's sum; its key spreads such rows over the join
                columns = [own, b.column("doc_id").slice(i, rows), own, none, empty, *total]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=_PART_ARROW)
                rare = np.flatnonzero(~known[first])
                border = np.concatenate([[0], np.cumsum(times[rare] - 1)]).astype(np.int32)
                again = pa.ListArray.from_arrays(pa.array(border), pa.array(odds[~known & ~new]))
                rare = first[rare]
                zero, real = np.zeros(len(rare), np.int64), np.zeros(len(rare))
                columns = [key + row[rare], pa.nulls(len(rare), pa.int64()), h[rare], times[~known[first]], again, zero, zero, real, real]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=_PART_ARROW)
                key += rows

    return run


def score_lattice(docs: DataFrame, model: LatticeModel) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per row of (doc_id, text).

    Texts must not be null (`rows.documents` makes them empty). Repeated rows and null ids give a row each; an empty text is its end token
    alone; without training rows all scores of words are those of the vocabulary. An empty table gives none.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.hot)  # bounded by max_hot
    parts = docs.select("doc_id", "text").mapInArrow(_partial(shared, model.end_base, model.end_score, model.end_known), _PART)
    look = model.table.select("hash", F.col("n").alias("w_n"), F.col("base").alias("w_base"), F.col("score").alias("w_score"))
    t = F.col("times")
    once = F.when((t > 0) & F.col("w_n").isNotNull(), F.col("w_score") + F.aggregate("again", F.lit(0.0), lambda a, x: a + F.log10(F.pow(F.lit(10.0), F.col("w_score")) + x)))
    joined = parts.join(look, "hash", "left").select(
        "key", "doc_id", "n_tokens", (F.col("n_known") + F.when(F.col("w_n") > 0, t).otherwise(0)).alias("n_known"),
        (F.col("base") + F.coalesce(F.col("w_base") * t, F.lit(0.0))).alias("base"), (F.col("score") + F.coalesce(once, F.lit(0.0))).alias("score"),
    )
    sums = joined.groupBy("key").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    return sums.select("doc_id", "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
