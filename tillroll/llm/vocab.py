"""Token ids of words from public vocabularies, each distinct word encoded once.

The vocabularies' splits never join characters across ASCII blanks, so a
text's ids are its words' ids one after another.  A worker keeps the ids of
the words it has met as flat arrays (``KEEP`` words at most, then it starts
anew) and looks words up by name.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

from tillroll.llm import words as W

KEEP = 1_000_000
_U = np.uint64
_coders: dict = {}


class WordCoder:
    def __init__(self, encode: Callable[[list[str]], list[list[int]]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.names = np.zeros(0, _U)
        self.at = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def ids(self, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids one after another, and how many each word has."""
        names, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.names) > KEEP:
            self.clear()
        place = np.searchsorted(self.names, names)
        known = np.zeros(len(names), dtype=bool)
        if len(self.names):
            known = self.names[np.minimum(place, len(self.names) - 1)] == names
        new = np.flatnonzero(~known)
        if len(new):
            raw = words.buf.tobytes() if len(new) > 50 else words.buf
            spans = zip(words.start[first[new]].tolist(), words.end[first[new]].tolist(), strict=True)
            got = self.encode([bytes(raw[a:b]).decode() for a, b in spans])
            counts = np.fromiter(map(len, got), np.int64, len(got))
            at = len(self.flat) + np.cumsum(counts) - counts
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in got for i in x), np.uint32, int(counts.sum()))])
            order = np.argsort(np.concatenate([self.names, names[new]]), kind="stable")
            self.names = np.concatenate([self.names, names[new]])[order]
            self.at = np.concatenate([self.at, at])[order]
            self.counts = np.concatenate([self.counts, counts])[order]
            place = np.searchsorted(self.names, names)
        counts = self.counts[place][back]
        return self.flat[W.ranges(self.at[place][back], counts)], counts


def tokenizers_coder(path: str) -> WordCoder:
    """Of a ``tokenizers`` file, without special tokens added."""
    if path not in _coders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _coders[path] = WordCoder(lambda texts: [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
    return _coders[path]


def sentencepiece_coder(path: str):
    """(coder, pieces as a list of bool: is it a byte) of a ``sentencepiece`` file."""
    if path not in _coders:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        _coders[path] = WordCoder(lambda texts: model.encode(texts, num_threads=1)), is_byte
    return _coders[path]


def case_blind_units(words: W.Words, special: bytes = b"<") -> W.Words:
    """Words cut into stem and trailing ``.,!?;:`` where an ASCII letter or digit or a
    Latin-1 letter precedes these, and named alike in upper and lower case (A-Z).

    For a vocabulary that lower-cases and never joins letters with these signs,
    the ids are the same, and far fewer distinct strings remain.  A word with
    ``special`` in it, as special tokens have, stays whole and case-sensitive.
    """
    buf = words.buf
    if not len(words.hash):
        return words
    tail = np.zeros(256, dtype=bool)
    tail[np.frombuffer(b".,!?;:", dtype=np.uint8)] = True
    alnum = np.zeros(256, dtype=bool)
    alnum[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
    cut = words.end.copy()
    live = tail[buf[cut - 1]]
    while live.any():
        cut[live] -= 1
        live &= cut > words.start
        live[live] = tail[buf[cut[live] - 1]]
    stem = cut - words.start
    prev = buf[np.maximum(cut - 1, 0)]
    lead = buf[np.maximum(cut - 2, 0)]
    latin = (stem >= 2) & (lead == 0xC3) & (prev >= 0x80) & (prev <= 0xBF) & (prev != 0x97) & (prev != 0xB7)
    marks = np.concatenate([[0], np.cumsum(buf == special[0])])
    plain = marks[words.end] == marks[words.start]
    split = (cut < words.end) & (stem > 0) & (alnum[prev] | latin) & plain
    at = np.arange(len(words.hash)) + np.cumsum(split) - split
    n = len(words.hash) + int(split.sum())
    start, end = np.empty(n, np.int64), np.empty(n, np.int64)
    start[at], end[at] = words.start, np.where(split, cut, words.end)
    start[at[split] + 1], end[at[split] + 1] = cut[split], words.end[split]
    names = W.span_hashes(buf, start, end, fold=True)
    raw = at[~plain]
    names[raw] = W.mix(W.span_hashes(buf, start[raw], end[raw]) + _U(1))
    return W.Words(buf, words.bounds, names, start, end, np.append(at, n)[words.first])
