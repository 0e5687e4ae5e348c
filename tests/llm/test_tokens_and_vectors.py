"""Token alignment, part codes and the prefix forest against plain versions."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cellcast.llm import alignment, part_codes, prefix_forest
from cellcast.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", " a", "a ", "a  b", "  a\n\n b \nc\n \nd", "Hello, world! It's 42% of x_y.", "été ﬁ ½ 漢字 🙂 é", "tab\tand\r\nline", "<|endoftext|> <s> </s> <unk> <0x41>",
    "▁under ▁ x", "a▁b", "\x00 \x1c x\x85y  z", "x" * 3000, "w " * 3000, "same same same", "same same same", "\n", " a 　b", "don't 's 've  're", "a   b",
]


# Alignment ----------------------------------------------------------------------------------


def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in shown}
    letters.update({chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)})
    out, linked = [], collections.Counter()
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            out.append(([], [], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links = [(i, ends_b.index(e)) for i, e in enumerate(ends_a) if e in set(ends_b)]
        linked.update((ids_a[i], ids_b[j]) for i, j in links)
        out.append((ids_a, ids_b, links, ends_a, ends_b))
    return out, linked


def group_text(ids_a, ids_b, links):
    parts, i0, j0 = [], 0, 0
    for i, j in links:
        parts.append(",".join(map(str, ids_a[i0 : i + 1])) + "|" + ",".join(map(str, ids_b[j0 : j + 1])))
        i0, j0 = i + 1, j + 1
    return ";".join(parts)


def test_gallop_counts_smaller_elements():
    rng = np.random.default_rng(3)
    for n, m, top in ((0, 5, 9), (5, 0, 9), (1, 1, 2), (300, 40, 400), (40, 5000, 9000), (1000, 1000, 1001), (700, 9000, 10**6)):
        short, long = (np.sort(rng.choice(top, min(k, top), replace=False)) for k in (n, m))
        assert alignment.gallop(short, long).tolist() == np.searchsorted(long, short, "left").tolist()
    tail = np.concatenate([np.arange(100), [10**6]])  # one element far behind all others
    assert alignment.gallop(np.array([5, 10**6]), tail).tolist() == [5, 100]


def test_alignment_equals_the_plain_one(spark):
    rng = random.Random(5)
    letters = [" ", " ", " ", "\n", "\t", "a", "b", "the", "ing", "é", "漢", "🙂", "▁", ".", ",", "'s", "12", "\x00", " ", "<|endoftext|>", "<0x0A>"]
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    want, linked = plain_alignment(texts)
    rows = [(i if i != 3 else None, t, "x", 1, "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, groups STRING, n_a INT, codes STRING").repartition(4)
    aligned = alignment.align_tokens(docs, *PATHS).cache()
    got = {r["doc_id"]: r for r in alignment.score_links(aligned, *PATHS).collect()}
    most = collections.Counter()
    for (_, b), n in linked.items():
        most[b] = max(most[b], n)
    assert len(got) == len(texts) and len(linked) <= alignment.max_pairs(*PATHS)
    unaligned = 0
    for i, (a, b, links, _, _) in enumerate(want):
        r = got[i if i != 3 else None]
        pairs = [(a[x], b[y]) for x, y in links]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (len(a), len(b), len(links), len(links)), texts[i]
        assert r["groups"] == group_text(a, b, links)
        assert r["count_sum"] == sum(linked[p] for p in pairs) and r["n_best"] == sum(linked[p] == most[p[1]] for p in pairs)
        unaligned += bool(texts[i]) and not a
    assert unaligned > 3  # texts with a literal U+2581
    aligned.unpersist()
    none = alignment.align_tokens(docs.where("false"), *PATHS)
    assert alignment.score_links(none, *PATHS).count() == 0


def test_overlap_ranges_share_bytes():
    texts = [t for t in TEXTS if t] + ["unbelievable tokenization of uncommonwords"]
    pair = alignment._pair(*PATHS)
    for (a, b, links, ends_a, ends_b), text in zip(plain_alignment(texts)[0], texts):
        ids_a, ids_b, n_a, n_b = pair.encode([text])
        assert (ids_a.tolist(), ids_b.tolist(), n_a.tolist(), n_b.tolist()) == (a, b, [len(a)], [len(b)]), text
        x = alignment.Aligned.of(ids_a.astype(np.int64), ids_b.astype(np.int64), pair.a_len, pair.b_len)
        first, last = x.overlaps()
        for i, e in enumerate(ends_a):
            s = ends_a[i - 1] if i else 0
            shared = [j for j, f in enumerate(ends_b) if f > s and (ends_b[j - 1] if j else 0) < e]
            assert (first[i], last[i]) == (shared[0], shared[-1])


def test_cache_starts_anew_without_other_ids(monkeypatch):
    pair = alignment.Pair(*PATHS)
    texts = ["one two three", "two three four", "five", "one"] * 3
    whole = [x.tolist() for x in pair.encode(texts)]
    monkeypatch.setattr(alignment, "MAX_CACHED_CHARS", 1)
    parts = [pair.encode([t]) for t in texts]
    for side in range(4):
        assert np.concatenate([p[side] for p in parts]).tolist() == whole[side]


def test_alignment_query(spark):
    rows = QUERIES["op11_galloping_alignment"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40).collect()
    got = {r["doc_id"]: r for r in rows}
    for d, (a, b, links, _, _) in zip(docs, plain_alignment([d["text"] for d in docs])[0]):
        r = got[d["doc_id"]]
        text = group_text(a, b, links)
        assert (r["n_a"], r["n_b"], r["n_groups"]) == (len(a), len(b), len(links))
        assert r["groups_sha256"] == (hashlib.sha256(text.encode()).hexdigest() if a else "")


# Part codes ---------------------------------------------------------------------------------


def plain_codes(rows, parts=16, entries=64, rounds=2):
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(good[0][1]) // parts if good else 0
    points = [(i, [[math.floor(256 * x) for x in v[p * width : (p + 1) * width]] for p in range(parts)]) for i, v in good]
    first = sorted(points, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p] for r in first] for p in range(parts)]

    def near(p, x):
        return min((sum((u - v) ** 2 for u, v in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = [collections.defaultdict(list) for _ in range(parts)]
        for _, v in points:
            for p in range(parts):
                groups[p][near(p, v[p])[1]].append(v[p])
        for p in range(parts):
            for k, g in groups[p].items():
                books[p][k] = [sum(c) // len(g) for c in zip(*g)]
    coded = [(i, [near(p, v[p]) for p in range(parts)]) for i, v in points]
    return sorted((i is None, i or 0, "".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c)) for i, c in coded), books


@pytest.mark.parametrize("entries", [1, 5, 64])
def test_masks_hold_all_entries_in_the_box(entries):
    rng = np.random.default_rng(entries)
    book = rng.integers(-6, 6, (entries, 3))  # many equal coordinates and entries
    points = rng.integers(-9, 9, (500, 3))
    s = part_codes.Slices(book)
    radius = rng.integers(0, 7, 500)
    inside = (np.abs(points[:, None] - book[None]) <= radius[:, None, None]).all(axis=2)
    mask = s.candidates(points, radius)
    assert (((mask[:, None] >> np.arange(entries, dtype=np.uint64)) & np.uint64(1)).astype(bool) == inside).all()
    index, error = s.nearest(points)
    d = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    assert (index == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()


ODD_VECTORS = [None, [], [float("nan")] * 32, [1.0] * 31 + [float("inf")], [1.0] * 31 + [None]]


def test_codes_equal_the_plain_ones(spark):
    rng = random.Random(2)
    vectors = [[rng.choice([-0.5, 0.0, -0.0, 0.25, 1 / 3, 2.0, -7.77]) for _ in range(32)] for _ in range(150)]
    rows = [(rng.choice([None, *range(60)]), v) for v in vectors] + [(7, vectors[0])] * 30 + [(-1, v) for v in ODD_VECTORS]
    frame = spark.createDataFrame([(i, v, rng.choice([None, 1, 2]), "x", 0) for i, v in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, code STRING, error INT").repartition(5)
    coded, books = part_codes.compress_vectors(frame)
    want, plain_books = plain_codes(rows)
    got = coded.collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"]) for r in got) == want
    assert books.tolist() == plain_books
    sums = collections.Counter()
    for r in got:
        sums[r["label"]] += r["error"]
    assert all(r["label_error"] == sums[r["label"]] for r in part_codes.with_label_error(coded).collect())


def test_codes_of_few_rows_other_lengths_and_no_rows(spark):
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"
    few = spark.createDataFrame([(1, [1.0] * 16, None), (2, [3.0] * 16, None), (3, [1.0] * 32, 1), (4, [1.0] * 15, 1), (5, [1e30] * 16, 1)], schema)
    coded, books = part_codes.compress_vectors(few)
    assert sorted((r["vec_id"], r["code"]) for r in coded.collect()) == [(1, "00" * 16), (2, "01" * 16)] and books.shape == (16, 2, 1)
    coded, books = part_codes.compress_vectors(few.where("false"))
    assert coded.count() == 0 and part_codes.books_digest(books) == hashlib.sha256(b"").hexdigest()


# Prefix forest ------------------------------------------------------------------------------


def plain_nearest(rows, queries, k):
    """{query id: {(vec_id, score)} ranked}."""
    out = {}
    for qi, qv in queries:
        best: dict[int, float] = {}
        for i, v in rows:
            if i != qi and len(v) == len(qv):
                c = float(np.dot(v, qv) / (np.linalg.norm(v) * np.linalg.norm(qv)))
                best[i] = max(c, best.get(i, -2.0))
        out[qi] = sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def test_forest_meets_all_of_small_blocks(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((300, 8)).round(1)
    vectors[100:180] = vectors[50]  # exact copies
    vectors[180:200] = vectors[50] * 2
    rows = [(i, v.tolist()) for i, v in enumerate(vectors) if v.any()] + [(301, [1.0, 2.0]), (302, [2.0, 4.0]), (303, [1e-200] * 8), (304, [1e200] * 8)]
    odd = [(400, None), (401, []), (402, [0.0] * 8), (403, [float("nan")] + [1.0] * 7), (404, [None] + [1.0] * 7), (None, [1.0] * 8), (5, rows[5][1])]
    frame = spark.createDataFrame([(i, v, "x", 0.0) for i, v in rows + odd], "vec_id BIGINT, embedding ARRAY<DOUBLE>, query_id STRING, score DOUBLE").repartition(4)
    forest = prefix_forest.Forest(trees=6, block_rows=64, query_rows=16, least=64)
    index = prefix_forest.plant_forest(frame, forest)
    got = collections.defaultdict(list)
    for r in prefix_forest.search_forest(index, frame.where("vec_id % 5 = 0"), 4, forest).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    finite = [(i, v) for i, v in rows if i not in (303, 304)]
    want = plain_nearest(finite, [(i, v) for i, v in finite if i % 5 == 0], 5)
    for q, best in want.items():
        mine = [(i, s) for i, s in got[q] if i not in (303, 304)]
        assert len(mine) >= min(2, len(best))
        for (i, s), (j, t) in zip(mine, best):
            assert abs(s - t) < 1e-12 and (i == j or abs(s - t) < 1e-12)
    assert [i for i, _ in got[100]][:3] == [50, 101, 102]
    assert {i for i, _ in got[100]} and 400 not in got
    assert prefix_forest.search_forest(prefix_forest.plant_forest(frame.where("false"), forest), frame, 4, forest).count() == 0
    assert prefix_forest.search_forest(index, frame.where("false"), 4, forest).count() == 0


def test_ascent_stops_at_the_deepest_level_with_enough_rows():
    strings = [np.array([0b0001, 0b0010, 0b0011, 0b1100], np.uint64)]
    orders = np.array([[3, 2, 1, 0]])
    asked = np.array([[0b0011]], np.uint64)
    for least, want in ((1, [1]), (2, [1, 2, 3]), (3, [1, 2, 3]), (4, [0, 1, 2, 3]), (9, [0, 1, 2, 3])):
        assert next(prefix_forest._met(strings, orders, asked, 2, 2, least)).tolist() == want


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_forest_recall_on_given_vectors(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = plain_nearest(rows, [r for r in rows if r[0] % 50 == 0], 5)
    got = QUERIES["op13_prefix_forest"](spark, sf_dir).collect()
    hit = sum(r["vec_id"] in dict(want[r["query_id"]]) for r in got)
    assert len(got) == 5 * len(want) and hit >= 0.95 * len(got)
    for r in got:
        if r["vec_id"] in dict(want[r["query_id"]]):
            assert abs(r["score"] - dict(want[r["query_id"]])[r["vec_id"]]) < 1e-12


def test_forest_recall_on_a_large_block_of_unstructured_vectors():
    """The hardest case: full blocks, no structure."""
    rng = np.random.default_rng(11)
    forest = prefix_forest.Forest()
    x = rng.standard_normal((forest.block_rows, 64))
    unit = prefix_forest._unit(x)
    strings = np.stack([prefix_forest.hash_strings(unit, t, forest.symbols) for t in prefix_forest.rotations(forest, 64)])
    order = np.argsort(strings, axis=1, kind="stable")
    asked = strings[:, :100]
    met = list(prefix_forest._met(list(np.take_along_axis(strings, order, 1)), order, asked, 7, forest.symbols, forest.least))
    near = unit[:100] @ unit.T
    near[np.arange(100), np.arange(100)] = -2
    top = np.argsort(-near, axis=1)[:, :5]
    assert np.mean([np.isin(t, m).mean() for t, m in zip(top, met)]) >= 0.93
    assert np.mean([len(m) for m in met]) < 0.45 * len(x)
