"""Operators that compare documents, and the pipeline, against plain versions on small tables."""

from __future__ import annotations

import collections
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellcast import session
from cellcast.llm import components, edit_walk, set_join, suffixes
from cellcast.llm.rows import may_be_in

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id BIGINT, text STRING, f BIGINT, c0 STRING, label STRING"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA)


def random_text(rng, n, vocabulary=400):
    return " ".join(f"W{k}" for k in rng.integers(0, vocabulary, n))


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        at = int(rng.integers(0, len(words)))
        kind = rng.integers(0, 3)
        words[at : at + (kind != 1)] = [] if kind == 2 else [f"new{rng.integers(0, 10**6)}"]
    return " ".join(words)


# Components ---------------------------------------------------------------------------------


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in (200, 201, 202)}
    assert components.components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


# Set join -----------------------------------------------------------------------------------


def plain_sets(rows, n):
    out = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        out.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    return out


def plain_components(rows, n, share):
    sets, parent = plain_sets(rows, n), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        groups[find(k)].append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(i, len(sets[k]), least[find(k)] if sets[k] else i) for k, (i, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def near_copies():
    rng = np.random.default_rng(11)
    rows = [(i, random_text(rng, int(rng.integers(1, 90)))) for i in range(60)]
    base = random_text(rng, 150)
    rows += [(100 + i, edited(rng, base, int(rng.integers(0, 5)))) for i in range(50)]  # some pairs link, others do not
    rows += [(1000 + i, "Common line of many words here " + random_text(rng, 12)) for i in range(30)]
    rows += [(5, rows[0][1].upper()), (5, rows[1][1]), (5, rows[1][1]), (None, rows[2][1]), (None, "alone"), (2000, None), (2001, ""), (2002, " \t"), (2003, "One two"), (2004, "one TWO")]
    return rows + [(3000, "long " * 20_000), (3001, "long " * 20_001)]


@pytest.mark.parametrize("words,share", [(3, 90), (5, 80)])
def test_set_join_equals_brute_force(spark, near_copies, words, share):
    got = set_join.join_sets(frame(spark, near_copies), set_join.Similarity(words, share)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == sorted(plain_components(near_copies, words, share), key=key)


def test_one_of_each_component_stays(spark, near_copies):
    sim = set_join.Similarity(5, 80)
    df = frame(spark, near_copies)
    got = set_join.keep_representatives(df, sim)
    assert got.columns == df.columns
    want = collections.Counter()
    for i, n, c in set(plain_components(near_copies, 5, 80)):
        if not n or i == c:
            want[i] += 1
    kept = collections.Counter(r["doc_id"] for r in got.collect())
    # two different texts share the id 5: it stands for each of its groups once
    assert all(kept[i] == n for i, n in want.items() if i not in (5, None)) and set(kept) - {5, None} <= set(want)
    assert set_join.keep_representatives(df.where("false"), sim).count() == 0


def test_links_of_each_document_are_counted_inside_components_too(spark):
    rng = np.random.default_rng(4)
    base = random_text(rng, 150, 10_000)
    other = edited(rng, base, 3)  # differences that a second family shares
    rows = [(k, edited(rng, base if k % 3 else other, int(rng.integers(0, 5)))) for k in range(60)]
    words = [f"c{k}" for k in range(140)]
    rows += [(100 + k, " ".join(words[4 * k : 100 + 4 * k])) for k in range(10)]  # a chain: only near ones link
    rows += [(200 + k, random_text(rng, 30, 10_000)) for k in range(10)] + [(None, rows[0][1]), (300, rows[61][1]), (301, ""), (302, None)]
    sets = plain_sets(rows, 5)
    want = []
    for k, (i, _) in enumerate(rows):
        both = [(len(sets[k] & x), len(sets[k] | x)) for j, x in enumerate(sets) if j != k]
        want.append((i, len(sets[k]), sum(1 for o, u in both if o and 100 * o >= 80 * u)))
    got = [(r["doc_id"], r["n_shingles"], r["n_links"]) for r in set_join.join_sets(frame(spark, rows), set_join.Similarity(5, 80)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len({n for i, _, n in want if i in range(100, 110)}) > 1 and len({n for i, _, n in want if i in range(60)}) > 3


def test_texts_of_rows_that_share_an_id_meet_their_own_class_only(spark):
    texts = [(None if k % 2 else 7, f"text {k // 2}") for k in range(400)] + [(None, "text 1")]
    rows = spark.createDataFrame(texts, "doc_id BIGINT, text STRING").withColumn("f", F.xxhash64("text"))
    wanted = rows.distinct().select("doc_id", "f", F.xxhash64("doc_id", "text").alias("c"), F.lit(0).cast("long").alias("f1"))
    got = set_join._texts_of(rows, wanted).groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("text").alias("d")).collect()
    assert len(got) == 400 and all(r["d"] == 1 for r in got) and sum(r["n"] for r in got) == 401


# Repeated passages --------------------------------------------------------------------------


def plain_spans(rows, n):
    rows = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    words = [WORD.findall(t.translate(LOW)) for *_, t in rows]
    where = collections.defaultdict(list)
    for k, w in enumerate(words):
        for s in range(len(w) - n + 1):
            where[tuple(w[s : s + n])].append((k, s))
    out = []
    for k, w in enumerate(words):
        for copy in (False, True):
            end = -1
            for s in range(len(w) - n + 1):
                at = where[tuple(w[s : s + n])]
                if len(at) > 1 and (at[0] != (k, s)) == copy:
                    if s <= end:
                        out[-1][3] = s + n
                    else:
                        out.append([rows[k][1] if rows[k][0] else None, copy, s, s + n])
                    end = s + n
    return sorted(map(tuple, out), key=str)


@pytest.fixture(scope="module")
def passages():
    rng = np.random.default_rng(3)
    shared = [random_text(rng, n) for n in (49, 50, 60, 130)]
    rows = []
    for i in range(40):
        parts = [random_text(rng, int(rng.integers(0, 60)))]
        for p in rng.choice(4, 2):
            parts += [edited(rng, shared[p], int(rng.integers(0, 2))), random_text(rng, int(rng.integers(0, 40)))]
        rows.append((i, "\n".join(parts)))
    rows += [(90, rows[0][1].swapcase()), (91, rows[0][1]), (91, rows[0][1]), (None, rows[1][1]), (92, None), (93, ""), (94, "tok " * 3000), (95, shared[1] + " " + shared[1])]
    return rows


def test_repeated_spans_equal_brute_force(spark, passages):
    got = suffixes.repeated_spans(frame(spark, passages)).collect()
    assert sorted(((r["doc_id"], r["copy"], r["start_word"], r["end_word"]) for r in got), key=str) == plain_spans(passages, 50)


def test_later_copies_are_cut_and_the_rest_stays(spark, passages):
    df = frame(spark, passages)
    got = suffixes.drop_repeats(df)
    assert got.columns == df.columns
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    spans = collections.defaultdict(set)
    for i, copy, a, z in plain_spans(passages, 50):
        if copy:
            spans[i].update(range(a, z))
    for i, t in passages:
        words = WORD.findall(t or "")
        left = [w for k, w in enumerate(words) if k not in spans[i]]
        if left or not words:
            assert WORD.findall(texts[i] or "") == left
        else:
            assert i not in texts
    assert suffixes.drop_repeats(df.where("false")).count() == 0


# Benchmark leaks ----------------------------------------------------------------------------


def test_leaks_are_found_up_to_the_edit_bound_and_clean_texts_left_alone(spark):
    rng = np.random.default_rng(9)
    items = [(k, random_text(rng, int(n), 3000)) for k, n in enumerate(rng.integers(6, 60, 40))]
    items += [(50, "too short"), (51, None), (52, ""), (None, random_text(rng, 30, 3000)), (53, random_text(rng, 700, 3000)), (54, items[3][1])]
    rows, truth = [], set()
    for i in range(200):
        k = i % 40
        n = len(items[k][1].split())
        leak = edited(rng, items[k][1], int(rng.integers(0, n // 5 + 1)))
        rows.append((i, f"{random_text(rng, int(rng.integers(0, 80)), 3000)} {leak}, {random_text(rng, int(rng.integers(0, 80)), 3000)}"))
    rows += [(1000 + i, random_text(rng, 300, 3000)) for i in range(50)] + [(2000, None), (2001, ""), (2002, items[43][1].upper()), (2003, items[44][1]), (2003, items[44][1]), (None, items[0][1])]
    for (i, t), (j, q) in itertools.product(rows, items):
        a, b = edit_walk.edit_words([q or "", (t or "")])
        if edit_walk.MIN_WORDS <= len(a) <= edit_walk.PIECE_WORDS and len(b):
            d = edit_walk.edit_distances(a[None], np.array([len(a)]), b[None], np.array([len(b)]))[0]
            if d <= edit_walk.edits_allowed(len(a)):
                truth.add((i, -1 if j is None else j))
    docs = frame(spark, rows)
    benchmark = spark.createDataFrame([(j, q, "x") for j, q in items], "item_id BIGINT, text STRING, doc_id STRING")
    got = {(r["doc_id"], r["item_id"]) for r in edit_walk.find_leaks(docs, benchmark).collect()}
    assert not {x for x in got - truth if x[1] != 53} and (2003, 53) in got
    assert len(got & truth) >= 0.97 * len(truth)
    kept = edit_walk.drop_leaked(docs, benchmark)
    assert kept.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == collections.Counter(i for i, _ in rows if i not in {x for x, _ in got})
    assert edit_walk.find_leaks(docs, benchmark.where("false")).count() == 0 and edit_walk.find_leaks(docs.where("false"), benchmark).count() == 0


def test_long_items_with_all_allowed_edits_reach_the_target_recall():
    rng = np.random.default_rng(17)
    for low, high, count in ((100, 129, 60), (129, 200, 60), (200, 257, 60), (300, 701, 30)):
        texts = [random_text(rng, int(n), 50_000) for n in rng.integers(low, high, count)]
        items = edit_walk.Items.of(list(range(count)), texts)
        docs = [f"{random_text(rng, 60, 50_000)} {edited(rng, t, len(t.split()) // 5)} {random_text(rng, 60, 50_000)}" for t in texts]
        truth = set()
        for i, words in enumerate(edit_walk.edit_words(docs)):
            for piece in np.flatnonzero(items.ids == i):
                n = items.size[piece : piece + 1]
                d = edit_walk.edit_distances(items.words[piece, : n[0]][None], n, words[None], np.array([len(words)]))[0]
                if d <= edit_walk.edits_allowed(int(n[0])):
                    truth.add(i)
        got = {(int(r), int(items.ids[p])) for row, piece, *_ in edit_walk.batch_leaks(pa.array(docs), items) for r, p in zip(row, piece)}
        assert all(i == j for i, j in got) and {i for i, _ in got} <= truth
        assert len(got) >= edit_walk.TARGET_RECALL * len(truth) and len(truth) >= count / 2, (low, len(got), len(truth))


def test_edit_distance_by_brute_force():
    rng = np.random.default_rng(1)

    def plain(a, b):
        d = [0] * (len(b) + 1)
        for x in a:
            e = [d[0] + 1]
            for j, y in enumerate(b):
                e.append(min(d[j] + (x != y), d[j + 1] + 1, e[j] + 1))
            d = e
        return min(d)

    for _ in range(50):
        n, m = rng.integers(1, 9), rng.integers(1, 12)
        a, b = rng.integers(1, 4, n).astype(np.uint64), rng.integers(1, 4, m).astype(np.uint64)
        pad = lambda x, w: np.pad(x, (0, w - len(x)))[None]
        assert edit_walk.edit_distances(pad(a, 10), np.array([n]), pad(b, 14), np.array([m]))[0] == plain(a, b)


# Pipeline -----------------------------------------------------------------------------------


def test_pipeline_catches_planted_documents_and_keeps_clean_ones(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(21)
    clean = [(i, random_text(rng, 120, 5000)) for i in range(60)]
    toxic = [(1000 + i, random_text(rng, 60, 5000) + " idiot scum " + random_text(rng, 20, 5000)) for i in range(40)]
    near = [(2000 + i, edited(rng, clean[i][1], 1)) for i in range(10)]
    passage = random_text(rng, 70, 5000)
    repeats = [(3000 + i, f"{random_text(rng, 90, 5000)} {passage} {random_text(rng, 90, 5000)}") for i in range(8)]
    items = [(k, random_text(rng, 30, 5000)) for k in range(5)]
    leaks = [(4000 + k, f"{random_text(rng, 50, 5000)} {edited(rng, q, 2)} {random_text(rng, 50, 5000)}") for k, q in items]
    rows = [(i, t, "en", "s", len(t)) for i, t in clean + toxic + near + repeats + leaks]
    documents = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(1000 <= i < 2000)) for i, *_ in rows if i < 2000]
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/stage{k}")
        columns, docs = docs.columns, spark.read.parquet(f"{tmp_path}/stage{k}")
        left[name] = docs.select("doc_id").distinct().toPandas().doc_id.tolist()
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        if name == "repeated_passages":
            holders = [r["doc_id"] for r in docs.collect() if passage in r["text"]]
            assert holders == [3000] and docs.where(F.col("n_chars") != F.length("text")).count() == 0
    ids = lambda part: {i for i, _ in part}
    assert set(left["toxicity"]) == ids(clean + near + repeats + leaks)
    assert set(left["near_duplicates"]) == ids(clean + repeats + leaks)
    assert set(left["repeated_passages"]) == ids(clean + repeats + leaks)
    assert set(left["benchmark_leaks"]) == set(left["packing"]) == ids(clean + repeats)


def test_sets_in_buckets_are_joined_where_they_lie(spark):
    before = set(map(id, session.current_stages()))
    sets = spark.range(1000).select(F.col("id").alias("c"), F.array("id", F.col("id") + 1).alias("s"))
    held = session.cut_by(sets, "c")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = spark.range(999).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
        found = set_join._overlaps(pairs, held)
        assert sorted((r["a"], r["b"], r["o"]) for r in found.collect()) == [(k, k + 1, 1) for k in range(999)]
        plan = found._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[-1]
        # both ends of the pairs travel, the sets do not
        assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Bucketed: true") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    name = session._tables[dict((id(d), p) for d, p in session._stages.values())[id(held)]]
    session.drop_stages(held)
    assert not spark.catalog.tableExists(name) and set(map(id, session.current_stages())) == before


def test_texts_travel_only_for_classes_that_may_link(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(30):  # two texts each share a passage, in the prefixes of some
        line = random_text(rng, 12, 10**6)
        rows += [(2 * k + e, random_text(rng, 16, 10**6) + " " + line + " " + random_text(rng, 16, 10**6)) for e in (0, 1)]
    rows += [(100, rows[0][1] + " more"), (101, rows[1][1] + " more")]
    monkeypatch.setattr(set_join, "MAX_FREQUENT", 1)  # rare shingles are not told from others
    texts_of, asked = set_join._texts_of, []

    def counted(rows, wanted):
        asked.extend(r["c"] for r in wanted.select("c").collect())
        return texts_of(rows, wanted)

    linked, compared = set_join._linked, []

    def seen(pairs, sets, sim):
        compared.extend((r["a"], r["b"]) for r in pairs.collect())
        return linked(pairs, sets, sim)

    monkeypatch.setattr(set_join, "_texts_of", counted)
    monkeypatch.setattr(set_join, "_linked", seen)
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in set_join.join_sets(frame(spark, rows), set_join.Similarity(5, 80)).collect()}
    assert got == {i: (i % 100, 1) if i in (0, 1, 100, 101) else (i, 0) for i, _ in rows}
    assert len(asked) == len(set(asked)) == 4
    assert len(compared) == len(set(compared))


def test_one_pair_for_each_component_and_its_smallest_neighbour_is_compared(spark):
    near = spark.createDataFrame([(a, b) for a in range(30) for b in range(a + 1, 30)], "a BIGINT, b BIGINT")
    assert sorted(map(tuple, set_join._hooks(near, None).collect())) == [(0, b) for b in range(1, 30)]
    labels = spark.createDataFrame([(k, k % 3) for k in range(30)], "node BIGINT, label BIGINT")
    got = [tuple(r) for r in set_join._hooks(near, labels).collect()]
    assert len(got) == 2 and all(a % 3 != b % 3 for a, b in got)


def test_keys_pass_their_filter_and_few_others_do(spark):
    keys = spark.createDataFrame([(None, 3), (7, None)] + [(k, k * k) for k in range(500)], "i BIGINT, f BIGINT")
    rows = keys.unionByName(spark.range(1000, 6000).select(F.col("id").alias("i"), F.col("id").alias("f")))
    got = rows.where(may_be_in(keys, ["i", "f"])("i", "f"))
    assert got.join(keys, got["i"].eqNullSafe(keys["i"]) & got["f"].eqNullSafe(keys["f"])).count() == 502 and got.count() < 520
    assert got.where("false").count() == 0 and rows.where(may_be_in(keys.where("false"), ["i", "f"])("i", "f")).count() == 0


def test_rows_without_repeats_stay_out_of_the_join_with_spans(spark, passages):
    df = frame(spark, passages + [(9000 + k, f"alone {k}") for k in range(50)])
    got = suffixes.drop_repeats(df)
    assert got.where("doc_id >= 9000").count() == 50
    assert "test(xxhash64" in got._jdf.queryExecution().optimizedPlan().toString()
