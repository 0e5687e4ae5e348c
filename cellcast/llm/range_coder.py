"""Token-id files: an adaptive context-mixing range coder over independently reset, checksummed blocks.

Every id's probability is a mixture: an order-2 prediction (the id that last followed the two ids before
it), an order-1 prediction, and an order-0 distribution over all ids, weighed by how reliable the two
predictions have lately been at their present confidence. A range coder codes the id by it. A block starts
with fresh tables, so any block can be decoded alone; its CRC-32 is checked. Blocks of a chunk are coded
side by side, one numpy lane each, in integer arithmetic that is the same on every machine.

A file set is a folder of Parquet files, one row per chunk, in id order of the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellcast.llm.encoding import encoder, text_runs
from cellcast.llm.rows import documents

LANES, BLOCK = 512, 4096
CHUNK = LANES * BLOCK
_CTX = 12  # bits of a hashed context
_P = 12  # bits of a probability
_RATE = 5
_U = np.uint64
_TOP, _BOT = _U(1 << 48), _U(1 << 32)


class _Model:
    """Per lane: the ids last seen after one and two ids, their confidence, the weights, the order-0 classes."""

    def __init__(self, lanes: int):
        n = lanes << _CTX
        self.lane = np.arange(lanes, dtype=np.int64)
        self.base, self.row32 = self.lane << _CTX, self.lane << 5
        self.id1, self.id2 = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.sure1, self.sure2 = np.zeros(n, np.int8), np.zeros(n, np.int8)
        self.p2 = np.full(lanes << 5, 1 << (_P - 2), np.int32)
        self.p1 = np.full(lanes << 5, 1 << (_P - 3), np.int32)
        # cumulative counts of the 16 classes of ids, and what they move to when a class is seen
        self.classes = np.tile(np.arange(17, dtype=np.int32) << (_P - 4), (lanes, 1))
        step = np.arange(17)
        self.goal = np.where(step[None, :] > np.arange(16)[:, None], (1 << _P) - 16 + step, step).astype(np.int32)
        self.prev1 = np.zeros(lanes, np.int64)
        self.prev2 = np.zeros(lanes, np.int64)

    def look(self, n: int) -> None:
        """Predictions and mixture weights for the next id of the first `n` lanes."""
        a, b = self.prev1[:n], self.prev2[:n]
        self.i1 = self.base[:n] + ((a * 40503 >> 4) & ((1 << _CTX) - 1))
        self.i2 = self.base[:n] + ((a * 40503 + b * 60493 >> 5) & ((1 << _CTX) - 1))
        self.c1, self.c2 = self.id1.take(self.i1), self.id2.take(self.i2)
        self.k1, self.k2 = self.sure1.take(self.i1), self.sure2.take(self.i2)
        self.same = self.c1 == self.c2
        self.w = self.row32[:n] + ((self.k2 << 2) + self.k1 + (self.same << 4))
        self.q2, self.q1 = self.p2.take(self.w), self.p1.take(self.w)
        self.f2 = self.q2
        self.f1 = ((1 << _P) - self.q2) * self.q1 >> _P

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        n = len(ids)
        top = (1 << _P) - 64
        self.p2[self.w] = self.q2 + ((hit2 * top + 32 - self.q2) >> _RATE)
        self.p1[self.w] = np.where(hit2, self.q1, self.q1 + ((hit1 * top + 32 - self.q1) >> _RATE))
        self.id1[self.i1], self.id2[self.i2] = ids, ids
        self.sure1[self.i1] = np.where(ids == self.c1, np.minimum(self.k1 + 1, 3), 0)
        self.sure2[self.i2] = np.where(hit2, np.minimum(self.k2 + 1, 3), 0)
        self.prev2[:n], self.prev1[:n] = self.prev1[:n], ids

    def learn_class(self, at: np.ndarray, kind: np.ndarray) -> None:
        rows = self.classes[at]
        rows += (self.goal[kind] - rows) >> _RATE
        self.classes[at] = rows


def _class_of(ids: np.ndarray) -> np.ndarray:
    """floor(log2) of an id, 0 for the ids 0 and 1; below it lie max(1, class) plain bits."""
    return np.maximum(np.frexp(ids.astype(np.float64))[1] - 1, 0)


class _Encoder:
    def __init__(self, lanes: int, words: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
        self.out, self.n = np.zeros((lanes, words), ">u2"), np.zeros(lanes, np.int64)

    def put(self, at: np.ndarray, start: np.ndarray, size: np.ndarray, bits) -> None:
        r = self.range[at] >> bits
        low, rng = self.low[at] + start.astype(np.uint64) * r, r * size.astype(np.uint64)
        while True:
            settled = (low ^ (low + rng)) < _TOP
            small = ~settled & (rng < _BOT)
            go = np.flatnonzero(settled | small)
            if not len(go):
                break
            rng[small] = (_U(0) - low[small]) & (_BOT - _U(1))
            lane = at[go]
            self.out[lane, self.n[lane]] = (low[go] >> _U(48)).astype(np.uint16)
            self.n[lane] += 1
            low[go] <<= _U(16)
            rng[go] <<= _U(16)
        self.low[at], self.range[at] = low, rng

    def finish(self) -> list[bytes]:
        for shift in (48, 32, 16, 0):
            lane = np.arange(len(self.n))
            self.out[lane, self.n] = ((self.low >> _U(shift)) & _U(0xFFFF)).astype(np.uint16)
            self.n += 1
        return [self.out[i, :k].tobytes() for i, k in enumerate(self.n.tolist())]


class _Decoder:
    def __init__(self, blocks: list[bytes]):
        lanes = len(blocks)
        self.words = np.zeros((lanes, max(len(b) for b in blocks) // 2 + 4), np.uint64)
        for i, b in enumerate(blocks):
            self.words[i, : len(b) // 2] = np.frombuffer(b, ">u2")
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
        w = self.words
        self.code, self.n = (w[:, 0] << _U(48)) | (w[:, 1] << _U(32)) | (w[:, 2] << _U(16)) | w[:, 3], np.full(lanes, 4, np.int64)

    def slot(self, at: np.ndarray, bits) -> np.ndarray:
        self.r = self.range[at] >> bits
        most = (_U(1) << np.asarray(bits).astype(np.uint64)) - _U(1)
        return np.minimum((self.code[at] - self.low[at]) // self.r, most).astype(np.int64)

    def skip(self, at: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        low, rng, code = self.low[at] + start.astype(np.uint64) * self.r, self.r * size.astype(np.uint64), self.code[at]
        while True:
            settled = (low ^ (low + rng)) < _TOP
            small = ~settled & (rng < _BOT)
            go = np.flatnonzero(settled | small)
            if not len(go):
                break
            rng[small] = (_U(0) - low[small]) & (_BOT - _U(1))
            lane = at[go]
            code[go] = (code[go] << _U(16)) | self.words[lane, np.minimum(self.n[lane], self.words.shape[1] - 1)]
            self.n[lane] += 1
            low[go] <<= _U(16)
            rng[go] <<= _U(16)
        self.low[at], self.range[at], self.code[at] = low, rng, code


def block_sizes(n: int) -> list[int]:
    """Lengths of the blocks of a chunk of n ids: near equal, none above BLOCK, the longer ones first."""
    lanes = min(LANES, max(1, -(-n // 256)))
    return [n // lanes + (i < n % lanes) for i in range(lanes)] if n else []


def encode_chunk(ids: np.ndarray) -> tuple[list[bytes], list[int]]:
    """(coded bytes, CRC-32) of each block of at most CHUNK ids below 65,536."""
    sizes = block_sizes(len(ids))
    if not sizes:
        return [], []
    border = np.concatenate([[0], np.cumsum(sizes)])
    grid = np.zeros((sizes[0], len(sizes)), np.int32)
    for i, (a, b) in enumerate(zip(border[:-1], border[1:])):
        grid[: b - a, i] = ids[a:b]
    model, coder = _Model(len(sizes)), _Encoder(len(sizes), 3 * sizes[0] + 16)
    for t in range(sizes[0]):
        n = len(sizes) if t < sizes[-1] else int(np.searchsorted(-np.array(sizes), -t))
        x, lane = grid[t, :n], model.lane[:n]
        model.look(n)
        hit2 = x == model.c2
        hit1 = (x == model.c1) & ~hit2
        size = np.where(hit2, model.f2, np.where(hit1, model.f1, (1 << _P) - model.f2 - model.f1))
        coder.put(lane, np.where(hit2, 0, np.where(hit1, model.f2, model.f2 + model.f1)), size, _U(_P))
        miss = np.flatnonzero(~(hit2 | hit1))
        if len(miss):
            y = x[miss]
            kind = _class_of(y)
            start = model.classes[miss, kind]
            coder.put(miss, start, model.classes[miss, kind + 1] - start, _U(_P))
            bits = np.maximum(kind, 1).astype(np.uint64)
            coder.put(miss, y & ((1 << np.maximum(kind, 1)) - 1), np.ones(len(miss), np.int64), bits)
            model.learn_class(miss, kind)
        model.learn(x, hit2, hit1)
    crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(border[:-1], border[1:])]
    return coder.finish(), crcs


def decode_chunk(n_ids: int, blocks: list[bytes], crcs: list[int]) -> np.ndarray:
    """The ids of a chunk; ValueError if a block does not match its checksum."""
    sizes = block_sizes(n_ids)
    if not sizes:
        return np.zeros(0, np.int64)
    grid = np.zeros((sizes[0], len(sizes)), np.int32)
    model, coder = _Model(len(sizes)), _Decoder(blocks)
    for t in range(sizes[0]):
        n = len(sizes) if t < sizes[-1] else int(np.searchsorted(-np.array(sizes), -t))
        lane = model.lane[:n]
        model.look(n)
        s = coder.slot(lane, _U(_P))
        hit2 = s < model.f2
        both = model.f2 + model.f1
        hit1 = ~hit2 & (s < both)
        size = np.where(hit2, model.f2, np.where(hit1, model.f1, (1 << _P) - both))
        coder.skip(lane, np.where(hit2, 0, np.where(hit1, model.f2, both)), size)
        x = np.where(hit2, model.c2, model.c1)
        miss = np.flatnonzero(~(hit2 | hit1))
        if len(miss):
            s = coder.slot(miss, _U(_P))
            kind = (model.classes[miss, 1:16] <= s[:, None]).sum(axis=1)
            start = model.classes[miss, kind]
            coder.skip(miss, start, model.classes[miss, kind + 1] - start)
            bits = np.maximum(kind, 1)
            rest = coder.slot(miss, bits.astype(np.uint64))
            coder.skip(miss, rest, np.ones(len(miss), np.int64))
            x[miss] = np.where(kind == 0, rest, (1 << kind) + rest)
            model.learn_class(miss, kind)
        # an order-1 hit that is also the order-2 guess was coded as order 2
        model.learn(x, hit2, hit1)
        grid[t, :n] = x
    parts = [grid[:k, i] for i, k in enumerate(sizes)]
    for i, (p, c) in enumerate(zip(parts, crcs, strict=True)):
        if zlib.crc32(p.astype("<u4").tobytes()) != c:
            raise ValueError(f"block {i} does not match its checksum")
    return np.concatenate(parts)


FILE_SCHEMA = "part int, chunk int, n_ids int, before long, first long, doc_ids array<long>, doc_sizes array<int>, opens boolean, closes boolean, block_bytes array<int>, block_crcs array<long>, payload binary"
_FILE_ARROW = pa.schema(
    [("part", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int32()), ("before", pa.int64()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int32())),
     ("opens", pa.bool_()), ("closes", pa.bool_()), ("block_bytes", pa.list_(pa.int32())), ("block_crcs", pa.list_(pa.int64())), ("payload", pa.binary())]
)


def _write(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, chunk = encoder(tokenizer).encode, TaskContext.get().partitionId(), 0
        held, n, docs, sizes, opens, first, before = [], 0, [], [], True, 0, 0

        def row(closes: bool) -> pa.RecordBatch:
            nonlocal chunk, held, n, docs, sizes, opens, first, before
            ids = np.concatenate(held) if held else np.zeros(0, np.int32)
            blocks, crcs = encode_chunk(ids)
            values = (part, chunk, n, before, first, docs, sizes, opens, closes, [len(b) for b in blocks], crcs, b"".join(blocks))
            # `first` numbers the part's documents; one that a border cuts keeps its number
            first, before = first + len(docs) - (not closes), before + n
            chunk, held, n, docs, sizes, opens = chunk + 1, [], 0, [], [], closes
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _FILE_ARROW)], schema=_FILE_ARROW)

        for b in batches:
            doc = b.column("doc_id").to_pylist()
            for i, texts in text_runs(b.column("text")):
                ids, counts = encode(texts)
                a = 0
                for k, m in enumerate(counts.tolist()):
                    rest = np.append(ids[a : a + m], np.int32(end_id))
                    a += m
                    if n and n + len(rest) > CHUNK:  # only a document longer than a chunk is cut
                        yield row(closes=True)
                    while len(rest):
                        take = min(len(rest), CHUNK - n)
                        held.append(rest[:take])
                        docs.append(doc[i + k])
                        sizes.append(take)
                        n, rest = n + take, rest[take:]
                        if n == CHUNK:
                            yield row(closes=not len(rest))
        if n:
            yield row(closes=True)

    return run


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, parts: int | None = None) -> None:
    """Encode every text, append `end_id`, and write all ids in ascending doc_id order (ties by text; null ids first).

    Null texts are empty. Repeated rows are documents of their own. Ids must be below 65,536.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ties on the id alone would put a hot id's rows in one range; the text's hash splits them
    ordered = documents(docs).repartitionByRange(parts, F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(_write(tokenizer, end_id), FILE_SCHEMA).write.parquet(folder)


PIECE_SCHEMA = "part int, chunk int, nth long, doc_id long, start long, n_tokens long, ids binary"
_PIECE_ARROW = pa.schema(
    [("part", pa.int32()), ("chunk", pa.int32()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)


def _read(bases: dict[int, int], cut: bool):
    """Decode chunks; hand out their whole documents, or the pieces of those that a border cuts. `bases`: ids before each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (x for b in batches for i in range(b.num_rows) for x in b.slice(i, 1).to_pylist()):
            at = np.concatenate([[0], np.cumsum(r["block_bytes"])]).astype(int).tolist()
            ids = decode_chunk(r["n_ids"], [r["payload"][i:j] for i, j in zip(at[:-1], at[1:])], r["block_crcs"]).astype("<u4")
            n, border = len(r["doc_ids"]), np.concatenate([[0], np.cumsum(r["doc_sizes"])]).astype(int).tolist()
            whole = [True] * n
            whole[0] = r["opens"]
            whole[-1] = whole[-1] and r["closes"]
            base = bases[r["part"]] + r["before"]
            wanted = [j for j in range(n) if whole[j] != cut]
            for i in range(0, len(wanted), 2000):
                k = wanted[i : i + 2000]
                columns = [[r["part"]] * len(k), [r["chunk"]] * len(k), [r["first"] + j for j in k], [r["doc_ids"][j] for j in k], [base + border[j] for j in k],
                           [r["doc_sizes"][j] for j in k], [ids[border[j] : border[j + 1]].tobytes() for j in k]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE_ARROW)], schema=_PIECE_ARROW)

    return run


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) per document from the files, every block checked.

    `start` counts the ids of all documents before it. A chunk is decoded once; the chunks of a document
    longer than a chunk are decoded once more, and its pieces alone are put together in a shuffle.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    bases, total = {}, 0
    for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():  # one row per file
        bases[r["part"]] = total
        total += r["n"]
    whole = files.mapInArrow(_read(bases, cut=False), PIECE_SCHEMA).select("doc_id", "start", "n_tokens", "ids")
    pieces = files.where(~F.col("opens") | ~F.col("closes")).mapInArrow(_read(bases, cut=True), PIECE_SCHEMA)
    cut = pieces.groupBy("part", "nth").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("p"),
    )
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return whole.unionByName(cut.select("doc_id", "start", "n_tokens", joined.alias("ids")))
