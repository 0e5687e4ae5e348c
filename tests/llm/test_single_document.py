"""Operators that judge or score one document, URL or conversation at a time, against plain versions."""

from __future__ import annotations

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellcast.llm import lattice, snapshots, target_ratio, toxicity, url_trees
from cellcast.llm.queries import URL_RULES
from cellcast.llm.rows import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}
#: Extra columns whose names the operators use inside.
CLASH = "doc_id BIGINT, text STRING, key STRING, score DOUBLE, f BIGINT, ids STRING"


def clash(rows):
    return [(i, t, "k", 1.0, 7, "x") for i, t in rows]


ODD = [(None, "null id text"), (1, None), (2, ""), (2, ""), (3, " \n\t "), (4, "same same same"), (4, "same same same"), (5, "w " * 30_000), (6, "x" * 50_000)]


# URLs ---------------------------------------------------------------------------------------


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0].translate(LOW)
    path = re.split(r"[?#]", rest[len(re.split(r"[/?#]", rest)[0]) :])[0]
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.action


URLS = [
    None, "", "no scheme", "://", "http://", "http://COM/", "http://com", "https://a.com?x=/", "http://example.com/en/1?a=1&b=2#c", "http://www.example.com/en/x",
    "http://WWW.Example.com/EN/x", "http://notexample.com/en/", "http://x.net/es/", "http://x.net/es", "http://net/fr/a", "http://a.org/q?u=http://b.com/", "ftp://u:p@h.net:80/fr/é",
    "http://a.org#frag/x", "http://a.org/" + "p/" * 5000, "http://a.org/\nx", "http://a.org/" + "1" * 40,
]


def test_url_rules_and_verdicts(spark):
    rows = [(i, u, "h", "p") for i, u in enumerate(URLS + URLS[8:13])] + [(None, "http://a.com/", "h", "p")]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, host STRING, path STRING")
    got = url_trees.judge_urls(pages, URL_RULES, rounds=3).collect()
    assert len(got) == len(rows)
    urls = {i: u for i, u, *_ in rows}
    for r in got:
        host, path, rule, action = plain_rule(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == action if action else r["verdict"] in ("allow", "block")
    assert url_trees.judge_urls(pages.where("false"), URL_RULES).count() == 0
    assert {r["verdict"] for r in url_trees.judge_urls(pages.where("url like 'http://a.org%'"), URL_RULES).collect()} == {"allow"}


def test_url_trees_learn_from_labels(spark):
    bad = [f"http://cheap{i}.example.org/buy?a={i}&b={i}&c=2&d=4" for i in range(300)]
    good = [f"http://news.site{i % 7}.org/story/{w}" for i, w in enumerate(map("".join, itertools.islice(itertools.permutations("abcdef"), 300)))]
    labels = spark.createDataFrame([(u, True) for u in bad[:200]] + [(u, False) for u in good[:200]] + [("x", None)], "url STRING, blocked BOOLEAN")
    pages = spark.createDataFrame(list(enumerate(bad[200:] + good[200:])), "page_id BIGINT, url STRING")
    got = {r["page_id"]: r["verdict"] for r in url_trees.judge_urls(pages, [], labels=labels, rounds=5).collect()}
    assert np.mean([got[i] == ("block" if i < 100 else "allow") for i in range(200)]) > 0.95


def test_entropy(spark):
    df = spark.createDataFrame([("aab!",), ("",), ("aaaa",)], "t STRING")
    assert [r[0] for r in df.select(url_trees.entropy(F.col("t"))).collect()] == [pytest.approx(1.5), 0.0, 0.0]


# Conversations ------------------------------------------------------------------------------


def plain_maximal(rows):
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append(((-1, 0) if t is None else (0, t), role or "", text or ""))
    turns = {c: tuple((r, x) for _, r, x in sorted(v)) for c, v in by.items()}
    inner = {t[:k] for t in turns.values() for k in range(1, len(t))}
    ids = collections.defaultdict(list)
    for c, t in turns.items():
        ids[t].append(c)
    return {(min(x for x in c if x is not None) if c != [None] else None): (len(t), len(c), "".join(f"<|{r}|>\n{x}\n" for r, x in t)) for t, c in ids.items() if t not in inner}


def test_snapshots_collapse_to_maximal_conversations(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(60):
        for t in range(int(rng.integers(1, 6))):
            rows.append((c, t * 2, "user" if t % 2 == 0 else "assistant", f"say {rng.integers(0, 2)}"))
    rows += [(100, t, "user", f"long {t}") for t in range(2500)] + [(101, t, "user", f"long {t}") for t in range(1030)]
    rows += [(200, None, None, None), (200, 1, None, "b"), (200, 1, None, "a"), (None, 1, "user", "unowned"), (300, -5, "user", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id BIGINT, turn BIGINT, role STRING, text STRING, n_turns INT")
    got = collections.defaultdict(list)
    for r in snapshots.collapse_snapshots(df).collect():
        got[r["conv_id"]].append((r["part"], r["n_turns"], r["n_equal"], r["rendered"]))
    joined = {c: (v[0][1], v[0][2], "".join(x for *_, x in sorted(v))) for c, v in got.items()}
    assert joined == plain_maximal(rows)
    assert len(got[100]) == 3 and 101 not in got
    assert snapshots.collapse_snapshots(df.where("false")).count() == 0


def test_no_group_of_a_hot_conversation_has_more_than_a_segment_of_rows(spark):
    # no conv_id, no turn; one turn number; one repeated row; and the whole of it as an inner prefix of another
    rows = [(None, None, "user", f"t{t:04d}") for t in range(2600)] + [(1, 5, "user", f"t{t:04d}") for t in range(2600)]
    rows += [(2, 3, "user", "same")] * 2100 + [(3, t, "user", "same") for t in range(2101)] + [(4, t % 2, None, None) for t in range(1500)]
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").repartition(7)
    sizes = snapshots.prefix_hashes(df).groupBy("conv_id", "segment").count().collect()
    assert max(r["count"] for r in sizes) == snapshots.SEGMENT and len(sizes) == 3 + 3 + 3 + 3 + 2
    got = collections.defaultdict(list)
    for r in snapshots.collapse_snapshots(df).collect():
        got[r["conv_id"]].append((r["part"], r["n_turns"], r["n_equal"], r["rendered"]))
    joined = {c: (sorted(v)[0][1], v[0][2], "".join(x for *_, x in sorted(v))) for c, v in got.items()}
    assert joined == plain_maximal(rows) and 2 not in joined
    assert all([p for p, *_ in sorted(v)] == list(range(-(-v[0][1] // snapshots.SEGMENT))) for v in got.values())


# Quality ------------------------------------------------------------------------------------


def plain_quality(x):
    w = WORD.findall(x)
    lines = [y for y in x.split("\n") if WORD.search(y)]
    c = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = {k for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(cover)


def test_quality_counts_and_verdicts(spark):
    good = [(i, " ".join(f"w{(i * 7 + k) % 40}" for k in range(60))) for i in range(100, 180)]
    bad = [(i, " ".join(f"Q{(i * 5 + k) % 30}!!" for k in range(60))) for i in range(200, 240)]
    odd = ODD + [(7, "a b c d e\na b c d e\n\x85 #|\n x\n x"), (8, "é%% ü* ß")]
    docs = spark.createDataFrame(clash(good + bad + odd), CLASH)
    trusted = spark.createDataFrame([(i,) for i, _ in good] + [(None,), (100,)], "doc_id BIGINT")
    model = target_ratio.fit_ratio(docs, trusted)
    got = target_ratio.score_ratio(docs, model).collect()
    rows = [(i, t or "") for i, t in good + bad + odd]
    want = collections.Counter((i, *plain_quality(t)) for i, t in rows)
    assert collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    verdict = {r["doc_id"]: r["in_target"] for r in got}
    assert np.mean([verdict[i] for i, _ in good]) > 0.95 and not any(verdict[i] for i, _ in bad)
    assert target_ratio.score_ratio(docs.where("false"), model).count() == 0
    nothing = target_ratio.fit_ratio(docs, trusted.where("false"))
    assert all(r["in_target"] for r in target_ratio.score_ratio(docs, nothing).collect())


def test_every_trusted_document_counts_and_sets_the_threshold(spark):
    rng = np.random.default_rng(5)
    texts = {i: " ".join(f"w{k}" for k in rng.integers(0, 30 if i % 3 else 60, 12)) for i in range(90)}
    ids = [i for i in texts if i % 3]
    docs = spark.createDataFrame([*texts.items(), (None, "w1 w2"), (900, "")], "doc_id BIGINT, text STRING").repartition(5)
    trusted = spark.createDataFrame([(i,) for i in [*ids, 1, None, 900, 901]], "doc_id BIGINT")
    model = target_ratio.fit_ratio(docs, trusted, bins=32)

    def bins_of(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return target_ratio._bins(target_ratio.find_words(raw, np.array([0, len(raw)])), 32)[0]

    count = lambda some: sum((np.bincount(bins_of(t), minlength=32) for t in some), np.zeros(32))
    raw = count([*texts.values(), "w1 w2"])
    prior = (raw + 1) / (raw.sum() + 32)

    def weights(some):
        n = count(some)
        return np.log((n + 32 * prior) / (n.sum() + 32)) - np.log(prior)

    assert model.weights == pytest.approx(weights([texts[i] for i in ids]))
    part = {i: zlib.crc32(str(i).encode()) % 5 for i in ids}
    scores = [weights([texts[k] for k in ids if part[k] != part[i]])[bins_of(texts[i])].mean() for i in ids]
    assert model.threshold == pytest.approx(np.mean(scores) - 3 * np.std(scores))


# Toxicity -----------------------------------------------------------------------------------


def test_counterfactual_penalty_clears_neutral_mentions(spark):
    rng = np.random.default_rng(2)
    filler = lambda: " ".join(f"word{k}" for k in rng.integers(0, 60, 25))
    rows = [(i, f"{filler()}. Gay scum {filler()}", 1) for i in range(60)]
    rows += [(i, f"{filler()}. {filler()} scum", 1) for i in range(60, 80)]
    rows += [(i, f"{filler()}. {filler()}", 0) for i in range(100, 300)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (100, 0)], "doc_id BIGINT, toxic INT")
    probe = [(1, f"The gay choir sang. {filler()}"), (2, f"{filler()} scum {filler()}"), (3, filler())]
    ask = spark.createDataFrame(clash(probe + ODD), CLASH)
    scores = {}
    for penalty in (0.0, 20.0):
        model = toxicity.fit_toxicity(docs, labels, penalty=penalty)
        got = toxicity.score_toxicity(ask, model).collect()
        assert len(got) == len(probe) + len(ODD) and all(0 <= r["toxicity_score"] <= 1 for r in got)
        scores[penalty] = {r["doc_id"]: r["toxicity_score"] for r in got if r["text"] in dict(probe).values() or r["text"] == probe[0][1]}
    assert scores[20.0][1] < 0.5 * scores[0.0][1] and scores[20.0][1] < 0.5
    assert scores[20.0][2] > 0.5 > scores[20.0][3]
    assert toxicity.score_toxicity(ask.where("false"), model).count() == 0
    one_kind = toxicity.fit_toxicity(docs, labels.where("toxic = 0"))
    assert all(r["toxicity_score"] < 0.5 for r in toxicity.score_toxicity(ask, one_kind).collect())
    assert toxicity.fit_toxicity(docs, labels.where("false")).intercept < 0


def test_counterfactuals_swap_whole_words_only():
    (a, b), (c, d) = toxicity.counterfactuals("Old oldest. The Gay man. Nothing here.")
    assert a == c == "Old oldest.\n The Gay man." and b == "young oldest.\n The lesbian woman." and d == "people oldest.\n The people people."
    assert toxicity.counterfactuals("nothing") == []


# Lattice ------------------------------------------------------------------------------------


def test_lattice_sums_all_segmentations_and_expects_pieces():
    texts = (b" ", b" a", b" ab", b"a", b"ab", b"b", b"ba", b"abab", *[bytes([i]) for i in range(256) if i not in (32, 97, 98)])
    p = np.linspace(1, 2, len(texts))
    pieces = lattice.Pieces(texts, np.log(p / p.sum()))
    prob = dict(zip(texts, np.exp(pieces.log_p)))

    def plain(s):
        total, count = 0.0, collections.Counter()
        for cuts in itertools.product([0, 1], repeat=len(s) - 1):
            parts, at = [], 0
            for i, c in enumerate([*cuts, 1]):
                if c:
                    parts.append(s[at : i + 1])
                    at = i + 1
            q = math.prod(prob.get(x, 0.0) for x in parts)
            total += q
            for x in parts:
                count[x] += q
        return total, {x: n / total for x, n in count.items() if n}

    words = [b"abab", b"a", b"xyz", b"ababba", "é".encode(), b"b"]
    got, expected = lattice.Lattice(pieces).run(words, expect=True)
    want = [plain(b" " + w) for w in words]
    assert np.exp(got) == pytest.approx([t for t, _ in want])
    total = collections.Counter()
    for _, c in want:
        total.update(c)
    assert expected == pytest.approx([total.get(t, 0.0) for t in texts])
    assert lattice.Lattice(pieces).run([b"ab" * 3000])[0][0] < -1000


def test_lattice_holds_only_arcs_that_are_pieces():
    texts = (b" ", b" a", b"a", b"b", b"ab", b"aba")
    own = lattice.Lattice(lattice.Pieces(texts, np.log(np.full(len(texts), 1 / len(texts)))))
    start, length, piece = own._arcs(np.frombuffer(b" ab xab", np.uint8), np.repeat([3, 7], [3, 4]))
    got = sorted((int(a), texts[p]) for a, n, p in zip(start, length, piece) if n == len(texts[p]))
    assert got == [(0, b" "), (0, b" a"), (1, b"a"), (1, b"ab"), (2, b"b"), (3, b" "), (5, b"a"), (5, b"ab"), (6, b"b")]
    # a word that the pieces cannot make has no probability and expects none of them
    got, expected = own.run([b"x", b"ab", b"axb"], expect=True)
    assert got[0] == got[2] == -np.inf and expected == pytest.approx(own.run([b"ab"], expect=True)[1])


def test_lattice_scores_documents(spark):
    import public_tokenizers

    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["The", "then", "other", "Other,", "x%"][k] for k in rng.integers(0, 5, 20)) + f" unseen{i}" * (i % 3)) for i in range(40)] + ODD
    docs = documents(spark.createDataFrame(clash(rows), CLASH)).withColumn("train", F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True)))
    tokens = [(i, WORD.findall((t or "").translate(LOW))) for i, t in rows]
    count = collections.Counter(w for i, t in tokens if i is None or i % 4 for w in [*t, None])
    n, v = sum(count.values()), len(count)
    for hot in (0, 3, 1000):  # all words joined, most of them, none
        model = lattice.fit_lattice(docs, public_tokenizers.path("piece_bpe_32k.model"), max_hot=hot, rounds=1)
        got = lattice.score_lattice(docs, model).collect()
        base = lambda t: sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*t, None])
        want = sorted((i is not None, i or 0, len(t) + 1, sum(count[w] > 0 for w in [*t, None]), n, round(base(t), 6)) for i, t in tokens)
        assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
        scores = sorted((r["n_tokens"], r["base_score"], r["score"]) for r in got)
        if hot:
            assert [s for *_, s in scores] == pytest.approx([s for *_, s in first], rel=1e-9)
        first = scores
        assert all(s < 0 for *_, s in scores)
    assert lattice.score_lattice(docs.where("false"), model).count() == 0


def test_word_probabilities_sum_to_at_most_one(spark):
    import public_tokenizers

    docs = spark.createDataFrame([("a b a a", True), ("b c", True), ("zz", False)], "text STRING, train BOOLEAN")
    model = lattice.fit_lattice(docs, public_tokenizers.path("piece_bpe_32k.model"), rounds=1)
    p = [10 ** r["score"] for r in model.table.collect()]
    assert sum(p) + 10**model.end_score < 1


def test_lattice_without_training_rows_knows_nothing(spark):
    import public_tokenizers

    docs = spark.createDataFrame([(1, "the house the", False), (2, "", False)], "doc_id BIGINT, text STRING, train BOOLEAN")
    model = lattice.fit_lattice(docs.select("text", "train"), public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in lattice.score_lattice(documents(docs), model).collect()}
    for i, n in ((1, 4), (2, 1)):
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"], got[i]["base_score"]) == (n, 0, 0, 0.0)


def test_url_sample_is_bounded_when_keys_are_null_or_equal(spark, monkeypatch):
    sizes = []

    class Trees:
        def __init__(self, **_):
            pass

        def fit(self, ready):
            sizes.append(ready.count())

    monkeypatch.setattr(url_trees, "GBTClassifier", Trees)
    urls = [(None if i % 3 else 7, f"http://h{i % 11}.{'com' if i % 2 else 'net'}/{i}") for i in range(900)]
    rows = url_trees.lexical_features(spark.createDataFrame(urls, "key BIGINT, url STRING")).withColumn("label", (F.col("host").endswith("net")).cast("double"))
    url_trees.fit_url_trees(url_trees.with_suffixes(rows, url_trees.suffix_statistics(rows)), max_rows=60)
    assert sizes == [60]


def test_a_suffix_seen_once_does_not_reveal_its_label(spark):
    urls = [(i, f"http://x.one{i}/", float(i % 2)) for i in range(10)] + [(i, "http://x.many/", 1.0) for i in range(10, 30)]
    frame = spark.createDataFrame(urls, "key BIGINT, url STRING, label DOUBLE")
    rows = url_trees.lexical_features(frame)
    stats = url_trees.suffix_statistics(rows)
    got = {r["key"]: r["suffix_block_rate"] for r in url_trees.with_suffixes(rows, stats).collect()}
    assert {got[i] for i in range(10)} == {0.5} and got[20] == pytest.approx(20 / 21)
    plain = {r["key"]: r["suffix_block_rate"] for r in url_trees.with_suffixes(rows.drop("label"), stats).collect()}
    assert plain[0] == pytest.approx(1 / 3) and plain[1] == pytest.approx(2 / 3) and plain[20] == pytest.approx(21 / 22)
