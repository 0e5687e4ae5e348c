"""Token ids of many texts by a public tokenizer file, each distinct word encoded once per worker.

Holds for tokenizers whose normaliser and pre-tokeniser treat white space as a separator only, so that
a text's ids are the ids of its words in a row; `check_word_tokenizer` asks the library.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: `str.split` also splits at these, the tokenizer does not.
_CONTROLS = "\x1c\x1d\x1e\x1f"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Letters below this stay single letters in lower case and under NFC.
_LAST_LETTER = "İ"
MAX_CACHED_WORDS = 1_000_000
_ROWS = 64  # texts taken from a column at a time
_encoders: dict[str, WordEncoder] = {}


def check_word_tokenizer(tokenizer) -> None:
    probe = "The  quick\tbrown-fox's\n42 x<|endoftext|>y été"
    whole = tokenizer.encode(probe, add_special_tokens=False).ids
    if whole != [i for w in probe.split() for i in tokenizer.encode(w, add_special_tokens=False).ids]:
        raise ValueError("this tokenizer's ids depend on white space")


class _Places(dict):
    """Place of each word; an unknown word gets the next one, so that a word is looked up once."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.new.append(word)
        return place


class WordEncoder:
    """Cached words as slices of one id array; the cache starts anew when it is full."""

    def __init__(self, path: str, max_words: int = MAX_CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        check_word_tokenizer(self.tokenizer)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.max_words = max_words
        self._reset()

    def _reset(self) -> None:
        self.index = _Places()
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0
        self.at, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _store(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.index) > len(self.at):
            self.at, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size))
        self.ids[self.used : self.used + len(ids)] = ids
        place = np.array([self.index[w] for w in words], np.int64)
        self.size[place], self.at[place] = sizes, self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)

    def _learn(self, missing: list[str]) -> None:
        plain = [w for w in missing if w.isalpha() and (w.isascii() or max(w) < _LAST_LETTER)]
        # a word of letters is one pre-token: many are encoded as one text and cut at the word-end tokens
        for i in range(0, len(plain), 2000):
            part = plain[i : i + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int32)
            end = np.flatnonzero(self.ends[ids]) + 1
            if len(end) != len(part):
                raise ValueError("the tokenizer splits words of letters")
            self._store(part, ids, np.diff(end, prepend=0))
        rest = list(set(missing).difference(plain))
        for i in range(0, len(rest), 2000):
            part = rest[i : i + 2000]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            flat = np.array([x for f in found for x in f], np.int32)
            self._store(part, flat, np.array([len(f) for f in found], np.int64))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        # the tokenizer lowers letters, too; in ASCII both do it alike, and "<|" may begin a special token
        texts = [t.lower() if t.isascii() and "<|" not in t else t for t in texts]
        split = [_WORD.findall(t) if any(c in t for c in _CONTROLS) else t.split() for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        if len(self.index) > self.max_words:
            self._reset()
        index = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        if self.index.new:
            try:
                self._learn(sorted(self.index.new))
            except BaseException:
                self._reset()  # no place may stay without ids
                raise
            self.index.new.clear()
        size, at = self.size[index], self.at[index]
        border = np.concatenate([[0], np.cumsum(size)])
        at -= border[:-1]
        of = np.repeat(at, size)
        of += np.arange(border[-1])
        ids = self.ids[of]
        first = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(border[first])


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def forget() -> None:
    """Drop the worker's encoders: kernels that need none call this first, as workers go from stage to stage.

    What they held, and what Arrow keeps of earlier batches, goes back to the system.
    """
    if _encoders:
        _encoders.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def text_runs(column, limit: int = 2_000_000):
    """(first row, texts) of runs of about `limit` characters; only a run's texts are Python strings at a time."""
    i, n, texts = 0, 0, []
    for k in range(0, len(column), _ROWS):
        for t in column.slice(k, _ROWS).to_pylist():
            texts.append(t)
            n += len(t)
            if n >= limit:
                yield i, texts
                i, n, texts = i + len(texts), 0, []
    if texts:
        yield i, texts
