"""Toxicity classifier with counterfactual regularisation.

Logistic regression over hashed words and word beginnings. For every labelled document that names an
identity group, the sentences naming it are rewritten with another term of the group and with a neutral
one; a penalty on the squared change of the logit teaches the model that the term itself says nothing,
which keeps neutral mentions of a group from being rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm.encoding import forget
from cellcast.llm.rows import bounded_sample, documents, named, numbered, text_chunks
from cellcast.llm.words import LOWER, find_words, mix, span_hashes
from cellcast.session import cut_lineage

#: Terms of a group take each other's place.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
)
NEUTRAL = "people"
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginning that are features of their own
BINS = 1 << 20
MIN_GAIN = 6.0  # log-likelihood that a feature must explain; less may well be chance


@dataclass(frozen=True)
class ToxicityModel:
    bins: np.ndarray  # the selected features, ascending
    weights: np.ndarray
    intercept: float


def features(raw: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the features of each row's words, and the rows; the word itself and its beginnings."""
    words = find_words(raw, border, LOWER)
    bins = [(words.hash % np.uint64(BINS)).astype(np.int64)]
    rows = [words.row]
    for k in BEGINNINGS:
        long = np.flatnonzero(words.end - words.start > k)
        h = mix(span_hashes(raw, words.start[long], words.start[long] + k, LOWER) + np.uint64(k))
        bins.append((h % np.uint64(BINS)).astype(np.int64))
        rows.append(words.row[long])
    return np.concatenate(bins), np.concatenate(rows)


def _distinct(bins: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(rows * BINS + bins)
    return key % BINS, key // BINS


def text_features(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    return np.unique(features(raw, np.array([0, len(raw)]))[0])


def counterfactuals(text: str, groups: Sequence[Sequence[str]] = IDENTITY_TERMS, neutral: str = NEUTRAL) -> list[tuple[str, str]]:
    """(sentences that name a group, the same with the terms swapped): once for the group's next term, once neutral."""
    following = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    term = re.compile(r"(?<!\w)(" + "|".join(map(re.escape, following)) + r")(?!\w)", re.IGNORECASE)
    named = "\n".join(s for s in re.split(r"(?<=[.!?\n])", text) if term.search(s))
    if not named:
        return []
    return [(named, term.sub(lambda m: following[m[1].lower()], named)), (named, term.sub(neutral, named))]


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bin, toxic documents with it, other documents with it), summed over the task."""
    forget()
    n = np.zeros((2, BINS), np.int32)
    for b in batches:
        toxic = np.asarray(b.column("toxic").to_numpy(zero_copy_only=False), np.int64)
        for i, j, raw, border in text_chunks(b.column("text")):
            bins, rows = _distinct(*features(raw, border))
            for c in (0, 1):
                n[c] += np.bincount(bins[toxic[i:j][rows] == c], minlength=BINS).astype(np.int32)
    used = np.flatnonzero(n.any(axis=0))
    for i in range(0, len(used), 100_000):
        u = used[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n[1, u].astype(np.int64)), pa.array(n[0, u].astype(np.int64))], names=["bin", "n1", "n0"])


def _rows_of(selected: np.ndarray, groups: Sequence[Sequence[str]]):
    """Per training document its selected features, and the logit changes of its counterfactuals as +/- features."""

    def pick(text: str) -> np.ndarray:
        return np.intersect1d(text_features(text), selected)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in batches:
            for text, toxic in zip((x.as_py() for x in b.column("text")), b.column("toxic").to_pylist()):
                change = [(np.setdiff1d(a, c), np.setdiff1d(c, a)) for a, c in ((pick(x), pick(y)) for x, y in counterfactuals(text, groups))]
                changes = [{"gone": g.tolist(), "come": c.tolist()} for g, c in change if len(g) or len(c)]
                columns = [pa.array([toxic], pa.int32()), pa.array([pick(text).tolist()], pa.list_(pa.int64())),
                           pa.array([changes], pa.list_(pa.struct([("gone", pa.list_(pa.int64())), ("come", pa.list_(pa.int64()))])))]
                yield pa.RecordBatch.from_arrays(columns, names=["toxic", "bins", "changes"])

    return run


def fit_logistic(
    rows: Sequence[np.ndarray], labels: np.ndarray, changes: Sequence[tuple[np.ndarray, np.ndarray]], n: int, ridge: float, penalty: float, steps: int = 400
) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam on the whole sample; rows and changes hold feature numbers below n."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    c_at = np.repeat(np.arange(len(changes)), [len(g) + len(c) for g, c in changes])
    c_col = np.concatenate([x for g, c in changes for x in (g, c)] + [np.zeros(0, np.int64)]).astype(np.int64)
    c_sign = np.concatenate([x for g, c in changes for x in (np.ones(len(g)), -np.ones(len(c)))] + [np.zeros(0)])
    w, mean, square = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    for t in range(1, steps + 1):
        z = np.bincount(at, w[col], minlength=len(rows)) + w[n]
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) / len(rows)
        grad = np.append(np.bincount(col, error[at], minlength=n) + ridge * w[:n], error.sum())
        if len(changes):
            d = np.bincount(c_at, c_sign * w[c_col], minlength=len(changes))
            grad[:n] += 2 * penalty / len(changes) * np.bincount(c_col, c_sign * d[c_at], minlength=n)
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        w -= 0.1 * (1 - t / (steps + 1)) * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return w[:n], float(w[n])


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, n_features: int = 2048, penalty: float = 1.0, ridge: float = 1e-4,
    groups: Sequence[Sequence[str]] = IDENTITY_TERMS,
) -> ToxicityModel:
    """Fit on at most `max_rows` labelled documents, those with the smallest hash of doc_id.

    `labels` has doc_id and toxic (0 or 1); null ones are left out, and of several labels of an id the
    highest counts. The `n_features` features that tell the classes apart best (likelihood ratio) are
    used, so what reaches the driver has a fixed bound. Without labels of both kinds the score is constant.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sample = F.broadcast(bounded_sample(known, "doc_id", max_rows))  # `max_rows` rows at most
    rows = cut_lineage(documents(docs).join(sample, "doc_id").select("text", "toxic"))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log((n1 + 0.5) / (n0 + 0.5))) if n1 + n0 else -20.0)
    counts = rows.mapInArrow(_class_counts, "bin long, n1 long, n0 long").groupBy("bin").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    part = lambda k, of: F.when(k > 0, k * F.log(k / of)).otherwise(0.0)
    a, b, share = F.col("n1"), F.col("n0"), n1 / (n1 + n0)
    seen = a + b
    unseen1, unseen0 = n1 - a, n0 - b
    unseen = unseen1 + unseen0
    ratio = part(a, seen * share) + part(b, seen * (1 - share)) + part(unseen1, unseen * share) + part(unseen0, unseen * (1 - share))
    best = counts.where(seen >= 3).select("bin", ratio.alias("gain")).where(F.col("gain") >= MIN_GAIN).orderBy(F.desc("gain"), "bin").limit(n_features)
    bins = np.sort(np.array([r["bin"] for r in best.collect()], np.int64))
    kind = "toxic int, bins array<long>, changes array<struct<gone:array<long>,come:array<long>>>"
    got = rows.mapInArrow(_rows_of(bins, groups), kind).collect()  # `max_rows` rows of at most `n_features` numbers
    number = lambda x: np.searchsorted(bins, np.array(x, np.int64))
    changes = [(number(c["gone"]), number(c["come"])) for r in got for c in r["changes"]]
    weights, intercept = fit_logistic([number(r["bins"]) for r in got], np.array([r["toxic"] for r in got], float), changes, len(bins), ridge, penalty)
    return ToxicityModel(bins, weights, intercept)


def _score(model: ToxicityModel, text: str):
    number = np.full(BINS, -1, np.int32)
    number[model.bins] = np.arange(len(model.bins))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in batches:
            for i, j, raw, border in text_chunks(b.column(text)):
                bins, rows = features(raw, border)
                used = np.flatnonzero(number[bins] >= 0)
                bins, rows = _distinct(bins[used], rows[used])
                z = np.bincount(rows, model.weights[number[bins]] if len(bins) else None, minlength=j - i) + model.intercept
                score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns), pa.array(score)], names=[*b.schema.names, "score"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """`docs` with a column toxicity_score (0 to 1); null texts are scored as empty. One row per input row, all columns kept."""
    work, text = numbered(docs, text_col)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in work.schema]
    out = work.mapInArrow(_score(model, text), ", ".join([*kinds, "score double"]))
    return named(out, docs, F.col("score").alias("toxicity_score"))
