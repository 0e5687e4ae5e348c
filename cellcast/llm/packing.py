"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

Each partition keeps a bounded pool of pieces and fills one sequence at a time: of the pieces that fit
in every dimension, the one with the largest dot product of its demand and the sequence's free share
goes in (the dot-product heuristic). What then stays free takes the head of the longest piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm.encoding import encoder, text_runs

POOL = 1024
#: A free stretch shorter than this is padded, not filled with so short a piece.
LEAST_PIECE = 8


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048


@dataclass
class Piece:
    row: int | None  # the document's id
    start: int
    ids: np.ndarray
    free: int  # its first ids that bear no loss
    total: int  # ids of the whole document

    def loss(self) -> int:
        return len(self.ids) - self.free

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.row, self.start, self.ids[:n], min(self.free, n), self.total)
        return head, Piece(self.row, self.start + n, self.ids[n:], max(0, self.free - n), self.total)


class Packer:
    """Takes documents, hands out filled sequences (lists of pieces)."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.cap = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.pool: list[Piece] = []
        self.demand = np.zeros((POOL + 2, 3))

    def _put(self, piece: Piece) -> None:
        self.demand[len(self.pool)] = len(piece.ids), 1, piece.loss()
        self.pool.append(piece)

    def _take(self, i: int) -> Piece:
        piece, last = self.pool[i], self.pool.pop()
        if i < len(self.pool):
            self.pool[i] = last
            self.demand[i] = self.demand[len(self.pool)]
        return piece

    def _fitting(self, piece: Piece, free: np.ndarray) -> int:
        """How many of the piece's first ids fit."""
        return int(min(len(piece.ids), free[0], piece.free + free[2])) if free[1] >= 1 else 0

    def add(self, row: int | None, ids: np.ndarray, free: int = 0) -> Iterator[list[Piece]]:
        rest = Piece(row, 0, ids, free, len(ids))
        while (n := self._fitting(rest, self.cap)) < len(rest.ids) or n == self.limits.tokens:
            head, rest = rest.cut(n)
            yield [head]
        if len(rest.ids):
            self._put(rest)
            if len(self.pool) >= POOL:
                yield self._fill()

    def _fill(self) -> list[Piece]:
        free, chosen = self.cap.copy(), []
        while self.pool:
            d = self.demand[: len(self.pool)]
            fits = (d[:, 0] <= free[0]) & (d[:, 1] <= free[1]) & (d[:, 2] <= free[2])
            score = np.where(fits, d @ (free / self.cap**2), -1.0)
            best = int(score.argmax())
            if score[best] < 0:
                break
            piece = self._take(best)
            free -= len(piece.ids), 1, piece.loss()
            chosen.append(piece)
        if self.pool and free[0] >= LEAST_PIECE:
            longest = int(self.demand[: len(self.pool), 0].argmax())
            n = self._fitting(self.pool[longest], free)
            if n >= LEAST_PIECE:
                head, rest = self._take(longest).cut(n)
                chosen.append(head)
                self._put(rest)
        return chosen

    def finish(self) -> Iterator[list[Piece]]:
        """The rest of the pool; a last, partly filled sequence is cut into powers of two, which need no padding."""
        while self.pool:
            chosen = self._fill()
            n = sum(len(p.ids) for p in chosen)
            if self.pool or n == self.limits.tokens:
                yield chosen
                continue
            while n:
                size = 1 << (n.bit_length() - 1)
                n -= size
                part = []
                while size:
                    head, rest = chosen[0].cut(min(size, len(chosen[0].ids)))
                    part.append(head)
                    size -= len(head.ids)
                    chosen[:1] = [rest] if len(rest.ids) else []
                yield part


SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in SCHEMA.split(", ")])


def _pack(tokenizer: str, end_id: int, limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, encode, end = Packer(limits), encoder(tokenizer).encode, np.array([end_id], np.int32)
        # numbered by partition, so that a task run again gives the same numbers
        sequence = TaskContext.get().partitionId() << 40
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

        def sequences() -> Iterator[list[Piece]]:
            for b in batches:
                doc, prompt = b.column("doc_id").to_pylist(), b.column("prompt")
                for i, texts in text_runs(b.column("text")):
                    free = encode(prompt.slice(i, len(texts)).to_pylist())
                    ids, sizes = encode(texts)
                    a = c = 0
                    for k, (n, m) in enumerate(zip(sizes.tolist(), free[1].tolist())):
                        yield from packer.add(doc[i + k], np.concatenate([free[0][c : c + m], ids[a : a + n], end]), m)
                        a, c = a + n, c + m
            yield from packer.finish()

        for chosen in sequences():
            offset = 0
            for p in chosen:
                rows.append((p.row, p.start, len(p.ids), p.ids.astype("<u4").tobytes(), p.total, p.loss(), sequence, offset))
                offset += len(p.ids)
            sequence += 1
            held += offset
            if held > 1_000_000:
                held = 0
                yield batch()
        if rows:
            yield batch()

    return run


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, loss_tokens, sequence_id, offset.

    A document's ids are those of its prompt (which bear no loss; `prompt_col` is optional), of its text,
    and `end_id`; each lies in exactly one piece. Null texts and prompts are empty, so a document always
    has its end id. Repeated rows and null ids are packed as rows of their own; an empty table gives none.
    Memory per task is bounded by the pool of pieces and one run of texts; nothing is shuffled.
    """
    if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
        raise ValueError("every limit must be positive")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    prompt = F.lit("") if prompt_col is None else text(prompt_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text(text_col).alias("text"), prompt.alias("prompt"))
    return rows.mapInArrow(_pack(tokenizer, end_id, limits), SCHEMA)
