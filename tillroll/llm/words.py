"""Words of whole texts as numpy arrays, without a Python object per word.

A batch of texts is scanned as one byte buffer.  A word is named by a 64-bit
polynomial hash of its bytes (a prefix sum over the buffer, so the cost is a
few vector passes), finished with a mixing step.  The byte table and the base
come from a fixed rule, so every executor names a word alike.  Two different
words share a name with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The separators of ``[^\x20\x09-\x0D]+``.
BLANKS = b" \t\n\v\f\r"
#: Everything but digits, lower-case letters and bytes above 0x7F (after folding A-Z).
NON_ALNUM = bytes(x for x in range(0x80) if not (48 <= x <= 57 or 97 <= x <= 122))
BLOCK = 1 << 15
PIECE_BYTES = 4 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that scatters near ones."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(_BASE)) | _U(1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_powers = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n."""
    have = _powers.get("n", 0)
    if have < n:
        n = max(n, BLOCK)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(n, base, dtype=_U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """``hash``, ``start``, ``end`` per word (byte positions in ``buf``); text i has
    the words ``first[i]:first[i + 1]`` and the bytes ``bounds[i]:bounds[i + 1]``."""

    buf: np.ndarray
    bounds: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array and the texts' bounds; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if texts.null_count:
        texts = pc.fill_null(texts, pa.scalar("", texts.type))
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def scan(buf: np.ndarray, bounds: np.ndarray, fold: bool = False, separators: bytes = BLANKS) -> Words:
    """The words of the texts in ``buf``; ``fold`` takes A-Z as a-z."""
    n, texts = len(buf), len(bounds) - 1
    gap = np.zeros(256, dtype=bool)
    gap[np.frombuffer(separators, dtype=np.uint8)] = True
    if fold:
        gap[65:91] = gap[97:123]
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(buf, bounds, np.zeros(0, _U), none, none, np.zeros(texts + 1, np.int64))
    inside = ~gap[buf]
    opens = np.ones(n, dtype=bool)
    opens[1:] = ~inside[:-1]
    closes = np.ones(n, dtype=bool)
    closes[:-1] = ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < n)]
    opens[cuts] = True
    closes[cuts - 1] = True
    start = np.flatnonzero(inside & opens)
    end = np.flatnonzero(inside & closes) + 1
    return Words(buf, bounds, span_hashes(buf, start, end, fold), start, end, np.searchsorted(start, bounds))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """The names of the spans start:end (in order, not overlapping), block by block."""
    table = _FOLDED if fold else _BYTES
    out = np.empty(len(start), dtype=_U)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + BLOCK, side="right")))
        a, b = int(start[i]), int(end[j - 1])
        up, down = _power_tables(b - a + 1)
        sums = np.zeros(b - a + 1, dtype=_U)
        np.cumsum(table[buf[a:b]] * up[: b - a], out=sums[1:])
        s = start[i:j] - a
        out[i:j] = (sums[end[i:j] - a] - sums[s]) * down[s]
        i = j
    return mix(out)


def words_of(texts: pa.Array, fold: bool = False, separators: bytes = BLANKS) -> Words:
    return scan(*buffer_of(texts), fold, separators)


def word_hash(word: str, fold: bool = True) -> int:
    """The name of one word."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(span_hashes(raw, np.array([0]), np.array([len(raw)]), fold)[0])


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Names of all runs of ``width`` neighbours (across texts too: see ``window_starts``)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, dtype=_U)
    for k in range(width):
        out *= _U(0xD6E8FEB86659FD93)
        out += hashes[k : k + n]
    return mix(out + _U(width))


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Positions at which a window of ``width`` words of one text starts."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    return ranges(first[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start+1, ... (count of them) for each pair, one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    base = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return base + np.arange(total)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, name) of every shingle, repeats included; a text of fewer than ``width``
    words has its whole word sequence as the one shingle, an empty text has none."""
    at = window_starts(words.first, width)
    names = window_hashes(words.hash, width)[at]
    owner = np.searchsorted(words.first, at, side="right") - 1
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        rest = np.empty(len(short), dtype=_U)
        for n in np.unique(counts[short]):
            pick = counts[short] == n
            rest[pick] = window_hashes(words.hash, int(n))[words.first[short[pick]]]
        owner = np.concatenate([owner, short])
        names = np.concatenate([names, rest])
    return owner, names


def distinct_pairs(owner: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (owner, name) pairs, ordered by owner, then name."""
    order = np.lexsort((names, owner))
    o, h = owner[order], names[order]
    keep = np.ones(len(o), dtype=bool)
    keep[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return o[keep], h[keep]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n positions lie in a window of ``width`` that begins at one of ``starts``."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + width, n), -1)
    return np.cumsum(edges[:-1]) > 0


def sums_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring bounds."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        i = 0
        while i < batch.num_rows:
            before = int(ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(i, j - i)
            i = j
