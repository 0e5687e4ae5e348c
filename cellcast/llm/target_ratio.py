"""Quality by hashed n-gram log-likelihood ratio between trusted-target and raw-corpus multinomials.

Words and word pairs are hashed into a fixed number of bins. Two multinomials are counted: one over every
trusted document, one over every document. A document's score is the mean, over its n-grams, of
log(p_target / p_raw); it is kept if the score reaches a threshold. The threshold is the mean less
`deviations` standard deviations of the scores of all trusted documents, each by the target counts of the
folds it is not in, so it is fixed by the data and every document is judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm.rows import documents, fold, text_chunks
from cellcast.llm.words import SPACE, Words, find_words, gram_starts, grams, mix, per_row_sum

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_BLANK = b" \t\n\x0b\x0c\r"

#: Trusted documents are dealt into folds; each is scored by the counts of the others when the threshold is set.
FOLDS = 5


@dataclass(frozen=True)
class RatioModel:
    """log(p_target / p_raw) per bin, and the least score that is kept (None: keep all, nothing was trusted)."""

    weights: np.ndarray
    threshold: float | None


def _bins(words: Words, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and row of every word and every pair of neighbouring words."""
    pair = gram_starts(words, 2)
    h = np.concatenate([mix(words.hash + np.uint64(1)), grams(words.hash, 2)[pair]])
    return (h % np.uint64(bins)).astype(np.int64), np.concatenate([words.row, words.row[pair]])


def _folds(batch: pa.RecordBatch) -> np.ndarray:
    """Fold of each row, FOLDS for a document that is not trusted."""
    return batch.column("fold").fill_null(FOLDS).to_numpy(zero_copy_only=False).astype(np.int64)


def _count(bins: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((FOLDS + 1) * bins, np.int64)
        for batch in batches:
            part = _folds(batch)
            for i, j, raw, border in text_chunks(batch.column("text")):
                at, row = _bins(find_words(raw, border), bins)
                n += np.bincount(part[i:j][row] * bins + at, minlength=len(n))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used // bins), pa.array(used % bins), pa.array(n[used])], schema=schema)

    return run


def _score_by_fold(weights: np.ndarray, schema: pa.Schema):
    """Id and score of each row by the weights of its fold; rows without words give none."""
    bins = weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = _folds(batch)
            for i, j, raw, border in text_chunks(batch.column("text")):
                at, row = _bins(find_words(raw, border), bins)
                n = np.bincount(row, minlength=j - i)
                total = np.bincount(row, weights[part[i:j][row], at], minlength=j - i)
                ids = batch.column("doc_id").slice(i, j - i).filter(pa.array(n > 0))
                yield pa.RecordBatch.from_arrays([ids, pa.array(total[n > 0] / n[n > 0])], schema=schema)

    return run


def fit_ratio(docs: DataFrame, trusted_ids: DataFrame, bins: int = 1 << 14, deviations: float = 3.0, smoothing: float = 1.0) -> RatioModel:
    """Count both multinomials and set the threshold.

    `trusted_ids` has a column doc_id; all of them are counted as target, and all set the threshold, each
    scored without its own fold. The raw multinomial counts all documents. The texts meet the trusted ids in
    one shuffle; a fold follows from the id, so the threshold's scores meet them without the texts.
    """
    docs = documents(docs)
    ids = trusted_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    folds = ids.withColumn("fold", fold("doc_id", FOLDS))
    # the ids grow with the corpus: they are hashed where they arrive, and the texts need no sort
    marked = docs.join(folds.hint("shuffle_hash"), "doc_id", "left").select("text", "fold")
    schema = pa.schema([("fold", pa.int64()), ("bin", pa.int64()), ("n", pa.int64())])
    counts = marked.mapInArrow(_count(bins, schema), "fold long, bin long, n long")
    n = np.zeros((FOLDS + 1, bins))
    for r in counts.groupBy("fold", "bin").agg(F.sum("n").alias("n")).collect():  # `bins` rows a fold at most
        n[r["fold"], r["bin"]] = r["n"]
    raw_n, target_n = n.sum(axis=0), n[:FOLDS].sum(axis=0)
    if not target_n.sum():
        return RatioModel(np.zeros(bins), None)
    prior = (raw_n + smoothing) / (raw_n.sum() + smoothing * bins)

    def log_ratio(target_n: np.ndarray) -> np.ndarray:
        # the target leans on the raw corpus where it has seen little
        target = (target_n + smoothing * bins * prior) / (target_n.sum() + smoothing * bins)
        return np.log(target) - np.log(prior)

    others = np.stack([log_ratio(target_n - n[k]) for k in range(FOLDS)])
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    owned = docs.where("doc_id IS NOT NULL").withColumn("fold", fold("doc_id", FOLDS))
    scored = owned.mapInArrow(_score_by_fold(others, schema), "doc_id long, score double").join(ids, "doc_id", "left_semi")
    s = scored.agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("d")).first()
    return RatioModel(log_ratio(target_n), float(s["m"] - deviations * s["d"]))


_FIELDS = [("doc_id", "long"), *[(n, "long") for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], ("score", "double")]


def _duplicate_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    lines = [x for x in lines if x.strip(_BLANK)]
    return len(lines) - len(set(lines))


def repeated_words(words: Words, rows: int, n: int = 5) -> np.ndarray:
    """Per row: words that lie in a window of n words found twice or more in the row."""
    at = gram_starts(words, n)
    key = mix(grams(words.hash, n)[at] + words.row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) if len(at) else np.zeros(0, np.uint64)
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    at = at[count[inverse] > 1]
    cover = np.zeros(len(words) + 1, np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + n, -1)
    return np.bincount(words.row[np.cumsum(cover[:-1]) > 0], minlength=rows)


def _score(model: RatioModel, schema: pa.Schema):
    weights, bins = model.weights, len(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, raw, border in text_chunks(batch.column("text")):
                words, n = find_words(raw, border), j - i
                at, row = _bins(words, bins)
                grams_n = np.bincount(row, minlength=n)
                score = np.bincount(row, weights[at], minlength=n) / np.maximum(grams_n, 1)
                chars = per_row_sum(~SPACE[raw] & ((raw & 0xC0) != 0x80), border)
                lines = [_duplicate_lines(raw[a:b].tobytes()) for a, b in zip(border[:-1], border[1:])]
                columns = [np.diff(words.first), chars, per_row_sum(SYMBOLS[raw], border), lines, repeated_words(words, n), score]
                yield pa.RecordBatch.from_arrays([ids.slice(i, n), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]], schema=schema)

    return run


def score_ratio(docs: DataFrame, model: RatioModel) -> DataFrame:
    """One row per input row: counts of the text, the score (0 for a text without words) and `in_target`.

    Null texts are empty; repeated rows and null ids give a row each; an empty table gives none.
    """
    schema = pa.schema([(n, pa.float64() if t == "double" else pa.int64()) for n, t in _FIELDS])
    out = documents(docs).mapInArrow(_score(model, schema), ", ".join(f"{n} {t}" for n, t in _FIELDS))
    keep = F.lit(True) if model.threshold is None else F.col("score") >= model.threshold
    return out.withColumn("in_target", keep)
