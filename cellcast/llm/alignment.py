"""Alignment of two tokenizers' ids over the same bytes, by galloping intersection of their end lists.

Both tokenizers cut the bytes of space + text. The shorter list of token ends drives an exponential and
then binary search through the longer one. Ends that both have cut the text into groups; an end's rank in
the other list, less the rank of the end before, gives the range of tokens that a token overlaps.

Two tokens that end together lie on the same bytes, so the shorter one's bytes end the longer one's. The
number of different linked id pairs is therefore at most the sum of the lengths of both vocabularies'
entries (`max_pairs`), whatever the corpus: their counts may be collected and sent to the tasks.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm.encoding import text_runs
from cellcast.llm.rows import documents

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: A space that neither follows a space nor comes before white space begins a token in both vocabularies.
_ODD = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r"(?<! ) (?=\S)")
#: A worker's cache starts anew beyond this many characters of words. Longer words than LONG_WORD are encoded alone.
MAX_CACHED_CHARS, LONG_WORD = 6_000_000, 64
#: Elements of the shorter list that one finger passes; all fingers gallop in step.
RUN = 64


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of `short` (rising), how many of `long` (rising) are smaller.

    Every run of `RUN` elements has a finger, placed by one binary search. From where it stands for an
    element, the next one's place is bracketed by doubling steps and then found by halving them.
    """
    n, m = len(short), len(long)
    rank = np.empty(n, np.int64)
    if not n or not m:
        rank[:] = 0
        return rank
    heads = np.arange(0, n, RUN)
    finger = np.searchsorted(long, short[heads])
    rank[heads] = finger
    last = m - 1
    for step in range(1, RUN):
        at = heads + step
        if at[-1] >= n:
            at, finger, heads = at[:-1], finger[:-1], heads[:-1]
            if not len(at):
                break
        want = short[at]
        low, reach = finger.copy(), np.ones(len(at), np.int64)
        high = finger.copy()
        going = np.flatnonzero((low < m) & (long[np.minimum(low, last)] < want))
        while len(going):  # doubling: everything before `low` is smaller
            low[going] = high[going] + 1
            high[going] = np.minimum(high[going] + reach[going], m)
            reach[going] *= 2
            h = high[going]
            going = going[(h < m) & (long[np.minimum(h, last)] < want[going])]
        open_ = np.flatnonzero(low < high)
        while len(open_):  # halving
            mid = (low[open_] + high[open_]) >> 1
            less = long[mid] < want[open_]
            low[open_[less]] = mid[less] + 1
            high[open_[~less]] = mid[~less]
            open_ = open_[low[open_] < high[open_]]
        finger = low
        rank[at] = finger
    return rank


@dataclass
class Aligned:
    """Tokens of texts in a row, and the index pairs of tokens that end together."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray

    @classmethod
    def of(cls, a_ids: np.ndarray, b_ids: np.ndarray, a_len: np.ndarray, b_len: np.ndarray) -> Aligned:
        a_ends, b_ends = np.cumsum(a_len[a_ids]), np.cumsum(b_len[b_ids])
        swap = len(b_ends) < len(a_ends)
        short, long = (b_ends, a_ends) if swap else (a_ends, b_ends)
        rank = gallop(short, long)
        both = np.flatnonzero((rank < len(long)) & (long[np.minimum(rank, max(0, len(long) - 1))] == short)) if len(long) else rank[:0]
        a_at, b_at = (rank[both], both) if swap else (both, rank[both])
        return cls(a_ids, b_ids, a_ends, b_ends, a_at, b_at)

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) token of B that shares a byte with each token of A."""
        upto = gallop(self.a_ends, self.b_ends)  # ends of B before this end: the token there reaches it
        ends_here = np.zeros(len(self.a_ends), np.int64)
        ends_here[self.a_at] = 1
        first = np.concatenate([[0], (upto + ends_here)[:-1]]) if len(upto) else upto
        return first, upto


class Pair:
    """Both tokenizers of a worker, with a cache of words."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a_bytes, self.b_bytes = entry_bytes(self.a), piece_bytes(self.b)
        if any(b" " in p.lstrip(b" ") for p in self.b_bytes):
            raise ValueError("a piece runs into a space")
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        # per side: ids of all kept words, how many are used, and where each word's ids are
        self.ids = [np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)]
        self.used = [0, 0]
        self.at = np.zeros((2, 1 << 14), np.int64)
        self.size = np.zeros((2, 1 << 14), np.int64)
        self.good = np.zeros(1 << 14, bool)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = " ".join(words)
        a = self.a.encode_batch_fast([f" {text}"], add_special_tokens=False)[0].ids
        return np.array(a, np.int64), np.array(self.b.encode(text), np.int64)

    def _keep(self, words: list[str]) -> None:
        """Encode words that are not kept yet, many as one text, which is cut where the words end."""
        size = np.array([len(w.encode()) + 1 for w in words], np.int64)
        both = self._encode(words)
        border = np.cumsum(size)
        cuts = []
        for ids, length in zip(both, (self.a_len, self.b_len)):
            ends = np.cumsum(length[ids])
            cut = np.searchsorted(ends, border)
            if len(ends) == 0 or ends[-1] != border[-1] or cut[-1] >= len(ends) or (ends[cut] != border).any():
                break
            cuts.append(np.diff(cut + 1, prepend=0))
        else:
            if b"".join(self.a_bytes[i] for i in both[0]) == (raw := f" {' '.join(words)}".encode()) == b"".join(self.b_bytes[i] for i in both[1]):
                return self._store(words, both, cuts, True)
        if len(words) > 1:  # some word's bytes are not those of its tokens
            half = len(words) // 2
            self._keep(words[:half])
            return self._keep(words[half:])
        raw = f" {words[0]}".encode()
        ids = self._encode(words)
        good = all(b"".join(table[i] for i in x) == raw for x, table in zip(ids, (self.a_bytes, self.b_bytes)))
        self._store(words, ids, [np.array([len(x)]) for x in ids], good)

    def _store(self, words, ids, sizes, good: bool) -> None:
        n = len(self.index)
        while n + len(words) > len(self.good):
            self.at, self.size = (np.concatenate([x, np.zeros_like(x)], axis=1) for x in (self.at, self.size))
            self.good = np.concatenate([self.good, np.zeros_like(self.good)])
        for side in (0, 1):
            new = len(ids[side])
            if self.used[side] + new > len(self.ids[side]):
                grown = np.zeros(max(2 * len(self.ids[side]), self.used[side] + new), np.int32)
                grown[: self.used[side]] = self.ids[side][: self.used[side]]
                self.ids[side] = grown
            self.ids[side][self.used[side] : self.used[side] + new] = ids[side]
            self.size[side, n : n + len(words)] = sizes[side]
            self.at[side, n : n + len(words)] = self.used[side] + np.cumsum(sizes[side]) - sizes[side]
            self.used[side] += new
        self.good[n : n + len(words)] = good
        self.index.update(zip(words, range(n, n + len(words))))
        self.chars += sum(map(len, words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A in a row, ids of B in a row, number of each text's ids of A, of B); unaligned texts have none."""
        split = [_words(t) for t in texts]
        words = [w for s in split for w in s]
        if self.chars > MAX_CACHED_CHARS:
            self._reset()
        missing = sorted(set(words).difference(self.index))
        plain = [w for w in missing if len(w) <= LONG_WORD and w == w.strip() != ""]
        for i in range(0, len(plain), 1000):
            self._keep(plain[i : i + 1000])
        for w in set(missing).difference(plain):
            self._keep([w])
        index = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        text_of = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        whole = np.ones(len(texts), bool)
        whole[text_of[~self.good[index]]] = False
        kept = whole[text_of]
        index, text_of = index[kept], text_of[kept]
        out = []
        for side in (0, 1):
            size, at = self.size[side][index], self.at[side][index]
            border = np.concatenate([[0], np.cumsum(size)])
            out.append(self.ids[side][np.arange(border[-1]) + np.repeat(at - border[:-1], size)])
            out.append(np.bincount(text_of, size, len(texts)).astype(np.int64))
        return out[0], out[2], out[1], out[3]


def _words(text: str) -> list[str]:
    """What lies between the spaces of space + text at which both vocabularies must begin a token."""
    if not text:
        return []
    if not text[0].isspace() and not _ODD.search(text):
        return text.split(" ")
    first, *rest = _CUT.split(f" {text}")
    return [first[1:], *rest] if first else rest


def entry_bytes(tokenizer) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary: printable bytes stand for themselves, the others for the letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    vocab = tokenizer.get_vocab()
    out = [b""] * (max(vocab.values()) + 1)
    for entry, i in vocab.items():
        out[i] = bytes(byte[c] for c in entry)
    return out


def piece_bytes(processor) -> list[bytes]:
    """Bytes of each piece: U+2581 is a space, <0xHH> a byte."""
    return [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace("▁", " ").encode() for i in range(processor.get_piece_size()) for p in [processor.id_to_piece(i)]]


_pairs: dict[tuple[str, str], Pair] = {}


def _pair(path_a: str, path_b: str) -> Pair:
    """The worker's tokenizers, kept from task to task."""
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


_NONE, _COMMA, _BAR, _SEMICOLON = 0, 1, 2, 3


def _digit_table(ids: int) -> np.ndarray:
    """[separator, id]: the id's decimal digits, then the separator, then zero bytes."""
    width = len(str(ids - 1)) + 1
    table = np.zeros((4, ids, width), np.uint8)
    for i in range(ids):
        s = str(i).encode()
        table[:, i, : len(s)] = np.frombuffer(s, np.uint8)
        table[:, i, len(s)] = [0, *b",|;"]
    return table


def _group_texts(x: Aligned, n_a: np.ndarray, n_b: np.ndarray, digits: np.ndarray) -> pa.Array:
    """`a1,a2|b1;a3|b2,b3` of each text: ids of A, then of B, of one group after the other."""
    groups, ka, kb = len(x.a_at), len(x.a_ids), len(x.b_ids)
    group_a = np.repeat(np.arange(groups), np.diff(x.a_at, prepend=-1))
    group_b = np.repeat(np.arange(groups), np.diff(x.b_at, prepend=-1))
    place_a = np.arange(ka) + np.concatenate([[0], x.b_at + 1])[group_a]
    place_b = np.arange(kb) + (x.a_at + 1)[group_b]
    ids, sep = np.empty(ka + kb, np.int32), np.full(ka + kb, _COMMA, np.int8)
    ids[place_a], ids[place_b] = x.a_ids, x.b_ids
    sep[place_a[x.a_at]], sep[place_b[x.b_at]] = _BAR, _SEMICOLON
    upto = np.cumsum(n_a + n_b)
    sep[upto[n_a > 0] - 1] = _NONE
    flat = digits[sep, ids]
    size = np.concatenate([[0], np.cumsum((flat != 0).sum(axis=1))])
    border = size[np.concatenate([[0], upto])].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(n_a), pa.py_buffer(border), pa.py_buffer(flat[flat != 0].tobytes()))


SCHEMA = "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, groups STRING, codes BINARY, times BINARY"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.large_string()), ("codes", pa.binary()), ("times", pa.binary())])


def _slices(values: np.ndarray, upto: np.ndarray) -> pa.Array:
    """Each row's values as bytes."""
    at = (np.concatenate([[0], upto]) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(upto), [None, pa.py_buffer(at), pa.py_buffer(values.tobytes())])


def _align(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        digits = _digit_table(max(len(pair.a_bytes), len(pair.b_bytes)))
        for batch in batches:
            for first, texts in text_runs(batch.column("text"), 1_000_000):
                a_ids, b_ids, n_a, n_b = pair.encode(texts)
                x = Aligned.of(a_ids, b_ids, pair.a_len, pair.b_len)
                text_of = np.searchsorted(np.cumsum(n_a), x.a_at, "right")
                code = np.sort(text_of.astype(np.int64) << 32 | a_ids[x.a_at].astype(np.int64) * len(pair.b_bytes) + b_ids[x.b_at])
                new = np.flatnonzero(np.diff(code, prepend=-1))
                upto = np.cumsum(np.bincount(code[new] >> 32, minlength=len(texts)))
                times = np.diff(np.append(new, len(code))).astype(np.int32)
                n_groups = np.bincount(text_of, minlength=len(texts))
                columns = [
                    batch.column("doc_id").slice(first, len(texts)), *(pa.array(v, pa.int64()) for v in (n_a, n_b, n_groups)), _group_texts(x, n_a, n_b, digits),
                    _slices((code[new] & 0xFFFFFFFF).astype(np.uint32), upto), _slices(times, upto),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    return run


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, groups, codes, times.

    A is a byte-level vocabulary of the tokenizers library over space + text, B a sentencepiece vocabulary,
    which adds the space itself. `groups` holds the ids of each group as `a1,a2|b1;a3|b2,b3`. `codes` and
    `times` list the document's linked id pairs (a * size of B + b, unsigned 32-bit) and how often each
    occurs (32-bit). Texts that are null, empty, or not rebuilt byte for byte by both tokenizers have no
    tokens. Rows are independent: repeated and null ids give rows of their own, an empty table none.
    """
    return documents(docs, id_col, text_col).mapInArrow(_align(path_a, path_b), SCHEMA)


def max_pairs(path_a: str, path_b: str) -> int:
    """No corpus links more different id pairs than this."""
    pair = _pair(path_a, path_b)
    return int(pair.a_len.sum() + pair.b_len.sum())


def _sum_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task, whose number is bounded as that of the pairs."""
    codes, sums = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    for batch in batches:
        new = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint32)
        times = np.frombuffer(b"".join(batch.column("times").to_pylist()), np.int32)
        codes, at = np.unique(np.concatenate([codes, new]), return_inverse=True)
        sums = np.bincount(at, np.concatenate([sums, times]), len(codes)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(sums)], names=["code", "n"])


def count_pairs(aligned: DataFrame) -> DataFrame:
    """(code, n): in how many links of all documents each id pair is linked."""
    return aligned.select("codes", "times").mapInArrow(_sum_pairs, "code BIGINT, n BIGINT").groupBy("code").agg(F.sum("n").alias("n"))


def score_links(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """`aligned` with n_links, n_best and count_sum in place of codes and times.

    `aligned` is read twice, so it should be a written table. n_best counts the links whose pair is the
    commonest of its B id in all documents, ties included; count_sum adds the links' pair counts.
    """
    size_b = len(_pair(path_a, path_b).b_bytes)
    found = count_pairs(aligned).toArrow()
    if found.num_rows > max_pairs(path_a, path_b):
        raise AssertionError("more id pairs than two vocabularies can link")
    order = np.argsort(found["code"].to_numpy())
    codes, counts = found["code"].to_numpy()[order].astype(np.uint32), found["n"].to_numpy()[order]
    most = np.zeros(size_b, np.int64)
    np.maximum.at(most, codes % size_b, counts)
    best = counts == most[codes % size_b]
    sent = aligned.sparkSession.sparkContext.broadcast((codes, counts, best))
    kept = [f for f in aligned.schema.fields if f.name not in ("codes", "times")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n_links BIGINT", "n_best BIGINT", "count_sum BIGINT"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = sent.value
        for batch in batches:
            lists = batch.column("codes").to_pylist()
            size = np.array([len(x) // 4 for x in lists], np.int64)
            row = np.repeat(np.arange(len(lists)), size)
            at = np.searchsorted(codes, np.frombuffer(b"".join(lists), np.uint32))
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), np.int32).astype(np.int64)
            sums = []
            for weight in (times, times * best[at], times * counts[at]):
                upto = np.concatenate([[0], np.cumsum(weight)])
                sums.append(pa.array(np.diff(upto[np.concatenate([[0], np.cumsum(size)])])))
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + sums, names=[f.name for f in kept] + ["n_links", "n_best", "count_sum"])

    return aligned.mapInArrow(run, schema)
