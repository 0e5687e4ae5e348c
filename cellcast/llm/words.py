"""Words `[^\\x20\\x09-\\x0D]+` of many texts at once, their 64-bit hashes, and hashes of word n-grams.

Works on the UTF-8 bytes of an Arrow column: the separators are ASCII, so no decoding is needed. Equal
words have equal hashes in every task, and distinct ones collide with the chance of random 64-bit numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from cellcast.llm.rows import CHUNK_BYTES

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SAME = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, every other byte as it is.
LOWER = np.where((SAME >= 65) & (SAME <= 90), SAME + 32, SAME).astype(np.uint8)

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 result bits."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


@dataclass
class Words:
    start: np.ndarray  # byte positions in the chunk
    end: np.ndarray
    row: np.ndarray  # row of the chunk each word belongs to
    hash: np.ndarray
    first: np.ndarray  # per row and one more: index of its first word

    def __len__(self) -> int:
        return len(self.start)


def find_words(raw: np.ndarray, border: np.ndarray, case: np.ndarray = SAME, space: np.ndarray = SPACE) -> Words:
    """All words of the rows that `border` cuts `raw` into; hashes are of the bytes mapped by `case`."""
    inside = ~space[raw]
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside
    before[border] = False
    after = np.zeros(len(raw) + 1, bool)
    after[:-1] = inside
    after[border] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    first = np.searchsorted(start, border)
    row = np.repeat(np.arange(len(border) - 1), np.diff(first))
    return Words(start, end, row, span_hashes(raw, start, end, case), first)


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, case: np.ndarray = SAME) -> np.ndarray:
    """Hash of each span raw[start:end], spans in ascending order; scratch memory stays near one chunk."""
    out = np.empty(len(start), np.uint64)
    values = _VALUES[case]
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + CHUNK_BYTES, "right")))
        a, b = int(start[i]), int(end[i:j].max())
        up, down = _power_tables(b - a + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(values[raw[a:b]] * up[: b - a], out=total[1:])
        out[i:j] = (total[end[i:j] - a] - total[start[i:j] - a]) * down[start[i:j] - a]
        i = j
    return mix(out)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run h[i:i + n] (len(h) - n + 1 of them), by doubling; runs may cross rows."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    done, out, size, part = 0, None, 1, mix(h + _U(0x632BE59BD9B4E019))
    while True:
        if n & size:
            piece = part[done : done + len(h) - n + 1]
            out = piece.copy() if out is None else mix(out * _U(0xA24BAED4963EE407) + piece * _U(0x9FB21C651E98DF25))
            done += size
        if done == n:
            return out
        part = mix(part[:-size] * _U(0xA24BAED4963EE407) + part[size:] * _U(0x9FB21C651E98DF25))
        size *= 2


def gram_starts(words: Words, n: int) -> np.ndarray:
    """Index of every word with which a run of n words of one row begins."""
    count = np.diff(words.first)
    left = words.first[1:][words.row] - np.arange(len(words))
    return np.flatnonzero(left >= n) if len(count) else np.zeros(0, np.int64)


def per_row_sum(mask: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Sum of `mask` over each row's stretch."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[border[1:]] - total[border[:-1]]
