"""Shared kernels: words and hashes, token ids, packing, range coder."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cellcast.llm import packing, range_coder
from cellcast.llm.encoding import WordEncoder
from cellcast.llm.queries import word_bpe
from cellcast.llm.rows import text_chunks
from cellcast.llm.words import LOWER, find_words, gram_starts, grams

TEXTS = ["", " \t\n", "a", "Ab  aB\tab\n\nab", "été ÉTÉ x\x1cy z", "w " * 5000, None, "no end", "x" * 3000, "<|endoftext|> <|ENDOFTEXT|> I'm 42% İstanbul ŉ"]


def test_words_equal_the_pattern_and_equal_words_equal_hashes():
    seen: dict[str, int] = {}
    for limit in (8, 1 << 20):
        for i, j, raw, border in text_chunks(pa.array(TEXTS), limit):
            w = find_words(raw, border, LOWER)
            for k in range(i, j):
                text = (TEXTS[k] or "").translate({c: c + 32 for c in range(65, 91)})
                want = re.findall(r"[^\x20\x09-\x0D]+", text)
                got = w.hash[w.first[k - i] : w.first[k - i + 1]].tolist()
                assert len(got) == len(want)
                for a, b in zip(want, got):
                    assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen)


def test_grams_are_hashes_of_runs():
    h = np.random.default_rng(1).integers(0, 3, 400).astype(np.uint64)
    for n in (1, 2, 3, 5, 20, 50):
        g = grams(h, n)
        runs = [tuple(h[i : i + n]) for i in range(len(h) - n + 1)]
        assert len(g) == len(runs) and len(set(zip(runs, g.tolist()))) == len(set(runs)) == len(set(g.tolist()))
    assert len(grams(h[:2], 3)) == 0
    w = find_words(np.frombuffer(b"a b c d", np.uint8), np.array([0, 3, 7]))
    assert gram_starts(w, 2).tolist() == [0, 2]


def test_word_encoder_equals_the_library_even_when_its_cache_starts_anew():
    e = WordEncoder(word_bpe(), max_words=3)
    texts = [t or "" for t in TEXTS]
    for part in (texts, texts[::-1], texts[3:5]):
        ids, sizes = e.encode(part)
        want = [x.ids for x in e.tokenizer.encode_batch(part, add_special_tokens=False)]
        assert ids.tolist() == [i for x in want for i in x] and sizes.tolist() == [len(x) for x in want]


@pytest.mark.parametrize("n", [0, 1, 2, 255, 257, 5000, 70_000])
def test_range_coder_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.4, n) % 49408).astype(np.int32)
    ids[: n // 3] = rng.choice([0, 1, 2, 65535], n // 3)
    ids[n // 2 : n // 2 + n // 4] = ids[: n // 4]
    blocks, crcs = range_coder.encode_chunk(ids)
    assert (range_coder.decode_chunk(n, blocks, crcs) == ids).all()
    if n > 1000:
        assert sum(map(len, blocks)) < 2 * n
        blocks[0] = bytes([blocks[0][0] ^ 1]) + blocks[0][1:]
        with pytest.raises(ValueError):
            range_coder.decode_chunk(n, blocks, crcs)


DOCS = "doc_id BIGINT, text STRING, ids STRING, part INT"
ROWS = [(5, "b c d", "x", 1), (1, None, None, None), (None, "lost id", "x", 2), (5, "b c d", "x", 1), (2, "long " * 3000, "x", 3), (3, "", "x", 3)]


def _expected(rows, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(word_bpe())
    return [(i, t.encode(x or "", add_special_tokens=False).ids + [end]) for i, x, *_ in rows]


def test_ids_are_written_in_order_and_read_back(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, DOCS)
    range_coder.write_ids(docs, f"{tmp_path}/ids", word_bpe(), 2, parts=3)
    got = sorted(((r["start"], r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in range_coder.read_ids(spark, f"{tmp_path}/ids").collect()))
    want = sorted(_expected(ROWS, 2), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [(i, x) for _, i, x in got] == want
    assert [s for s, *_ in got] == np.cumsum([0, *[len(x) for _, x in want]])[:-1].tolist()
    range_coder.write_ids(docs.where("false"), f"{tmp_path}/none", word_bpe(), 2, parts=3)
    assert range_coder.read_ids(spark, f"{tmp_path}/none").count() == 0


def test_documents_cut_by_chunk_borders_are_joined(spark, tmp_path, monkeypatch):
    ids = np.arange(10_000) % 3000
    pieces = [(0, 0, 0, 1, 0, 4000, False, ids[:4000]), (0, 1, 0, 1, 0, 4000, False, ids[4000:8000]), (0, 2, 0, 1, 0, 2000, False, ids[8000:])]
    blocks = [range_coder.encode_chunk(p[-1].astype(np.int32)) for p in pieces]
    rows = [
        (0, c, len(p[-1]), 4000 * c, 0, [1], [len(p[-1])], c == 0, c == 2, [len(b) for b in blocks[c][0]], blocks[c][1], b"".join(blocks[c][0]))
        for c, p in enumerate(pieces)
    ]
    spark.createDataFrame(rows, range_coder.FILE_SCHEMA).write.parquet(f"{tmp_path}/ids")
    (r,) = range_coder.read_ids(spark, f"{tmp_path}/ids").collect()
    assert (r["start"], r["n_tokens"], zlib.crc32(r["ids"])) == (0, 10_000, zlib.crc32(ids.astype("<u4").tobytes()))


def test_only_documents_longer_than_a_chunk_are_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(range_coder, "CHUNK", 1000)
    docs = spark.createDataFrame([(i, f"w{i} " * n, "x", 1) for i, n in enumerate((300, 300, 900, 20, 2500, 5))], DOCS)
    batches = docs.select("doc_id", "text").coalesce(1).toArrow().to_batches()

    class Task:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(range_coder, "TaskContext", type("C", (), {"get": staticmethod(lambda: Task)}))
    files = [r for b in range_coder._write(word_bpe(), 2)(iter(batches)) for r in b.to_pylist()]
    assert all(sum(r["doc_sizes"]) == r["n_ids"] <= 1000 for r in files)
    assert [r["before"] for r in files] == np.cumsum([0, *[r["n_ids"] for r in files]])[:-1].tolist()
    cut = {i for r in files for k, i in enumerate(r["doc_ids"]) if (k == 0 and not r["opens"]) or (k == len(r["doc_ids"]) - 1 and not r["closes"])}
    sizes = {i: sum(n for r in files for j, n in zip(r["doc_ids"], r["doc_sizes"]) if j == i) for i in range(6)}
    assert cut == {i for i, n in sizes.items() if n > 1000} and 4 in cut


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 40), packing.Limits(16, 1, 16)])
def test_packing_keeps_every_id_once_within_all_limits(spark, limits):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(["word"] * int(n)), " ".join(["ask"] * int(m)), 0) for i, (n, m) in enumerate(zip(rng.integers(0, 150, 60), rng.integers(0, 20, 60)))]
    docs = spark.createDataFrame(rows + [(None, None, None, 1)], "doc_id BIGINT, text STRING, prompt STRING, start INT")
    got = packing.pack_documents(docs, word_bpe(), 1, limits, prompt_col="prompt").toPandas()
    by_sequence = got.groupby("sequence_id")
    assert (by_sequence.length.sum() <= limits.tokens).all() and (by_sequence.size() <= limits.segments).all() and (by_sequence.loss_tokens.sum() <= limits.loss_tokens).all()
    for _, s in by_sequence:
        s = s.sort_values("offset")
        assert s.offset.tolist() == np.cumsum([0, *s.length])[:-1].tolist()
    texts = {i: (x, p) for i, x, p, _ in rows}
    for doc, s in got[got.doc_id.notna()].groupby("doc_id"):
        s = s.sort_values("start")
        ids = np.concatenate([np.frombuffer(x, "<u4") for x in s.ids])
        text, prompt = texts[int(doc)]
        assert ids.tolist() == [i for _, x in _expected([(0, f"{prompt} {text}")], 1) for i in x]
        assert s.loss_tokens.sum() == len(text.split()) + 1
    assert len(got[got.doc_id.isna()]) == 1
    if limits == packing.Limits():
        padding = by_sequence.length.sum().map(lambda n: 0 if n & (n - 1) == 0 else limits.tokens - n)
        assert padding.sum() < 0.01 * got.length.sum()
    assert packing.pack_documents(docs.where("false"), word_bpe(), 1).count() == 0


def test_a_word_is_looked_up_once_and_keeps_no_place_without_ids():
    import public_tokenizers

    from cellcast.llm.encoding import WordEncoder

    looked = []

    class Word(str):
        def __hash__(self):
            looked.append(self)
            return super().__hash__()

    class Text(str):
        def isascii(self):
            return False

        def split(self):
            return [Word(w) for w in str.split(self)]

    e = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    ids, sizes = e.encode(["the old house", "", "house 42!"])
    looked.clear()
    again, _ = e.encode([Text("the old house"), Text(""), Text("house 42!")])
    assert again.tolist() == ids.tolist() and sizes.tolist()[1] == 0 and len(looked) == 5
    real, e._learn = e._learn, lambda words: (_ for _ in ()).throw(ValueError("broken"))
    with pytest.raises(ValueError):
        e.encode(["unheard words"])
    e._learn = real
    assert e.encode(["unheard words", "the"])[0].tolist() == e.tokenizer.encode("unheard words the", add_special_tokens=False).ids


def test_toxicity_kernels_free_the_encoder_and_texts_become_strings_run_by_run():
    from cellcast.llm import encoding, toxicity

    rows = pa.RecordBatch.from_arrays([pa.array(["good old day", "bad women"]), pa.array([0, 1], pa.int32())], names=["text", "toxic"])
    for kernel in (toxicity._class_counts, toxicity._rows_of(np.arange(10), toxicity.IDENTITY_TERMS)):
        encoding.encoder(word_bpe())
        assert sum(b.num_rows for b in kernel(iter([rows])))
        assert not encoding._encoders

    taken = []

    class Column:
        def __init__(self, texts):
            self.texts = texts

        def __len__(self):
            return len(self.texts)

        def slice(self, i, n):
            return Column(self.texts[i : i + n])

        def to_pylist(self):
            taken.append(len(self.texts))
            return self.texts

    texts = [str(i) * (i % 7) for i in range(1000)]
    runs = list(encoding.text_runs(Column(texts), 50))
    assert [t for _, part in runs for t in part] == texts and max(taken) < len(texts)
    assert [i for i, _ in runs] == np.cumsum([0] + [len(p) for _, p in runs[:-1]]).tolist()
    # a run ends with the text that reaches the limit
    assert all(sum(map(len, p)) >= 50 > sum(map(len, p[:-1])) for _, p in runs[:-1])
