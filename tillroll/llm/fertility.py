"""Quality rules: plain counts, and the fertility of a public vocabulary.

A tokeniser trained on ordinary text cuts ordinary text into few tokens.  For
every document the words are encoded with a byte-fallback vocabulary, and
three figures are taken: code points per token, the share of byte-fallback
tokens, and the entropy of the document's tokens, relative to what so many
tokens could have (texts fall in spans of a bounded number of tokens, and have
the mean of their spans: the figure of a whole text would fall with its length).  Each has a band for the document's script or language; a
document outside any band is rejected.  Bands are fixed parameters, so the
verdict on a document depends on that document alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import words as W
from tillroll.llm.tables import plain, spare
from tillroll.llm.vocab import sentencepiece_coder

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WIDTH = 8
#: Text that a task filters at once.
PIECE_BYTES = 1 << 20
#: Tokens of a span of which the entropy is taken.
SPAN = 1024


@dataclass(frozen=True)
class Band:
    """Bounds of a group of texts: code points per token, byte share, relative entropy."""

    chars_per_token: tuple[float, float]
    max_byte_share: float
    min_entropy: float


# Bands by language code, and by script for other languages.  The vocabulary holds few
# characters beyond Latin and Cyrillic, so other scripts have wider bands.
LANGUAGES = {
    "en": Band((1.70, 6.0), 0.05, 0.61),
    "de": Band((1.70, 6.0), 0.05, 0.61),
    "fr": Band((1.55, 6.0), 0.05, 0.61),
    "es": Band((1.60, 6.0), 0.05, 0.61),
}
SCRIPTS = {
    "latin": Band((1.2, 8.0), 0.15, 0.5),
    "cyrillic": Band((1.0, 8.0), 0.15, 0.5),
    "other": Band((0.25, 8.0), 0.9, 0.4),
}

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, chars_per_token double, byte_share double, token_entropy double"
)


def script_of(lead: np.ndarray, words: W.Words) -> np.ndarray:
    """latin, cyrillic or other for each text: the script of most of its words' letters.
    Lead bytes tell: ASCII letters and C3-C9 are Latin, D0-D4 Cyrillic, other lead bytes other."""
    of_byte = np.zeros(256, dtype=np.int8)
    of_byte[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = 1
    of_byte[0xD0:0xD5] = 2
    of_byte[[*range(0xCA, 0xD0), *range(0xD5, 0xF5)]] = 3
    kinds = of_byte[lead]
    counts = np.stack([W.sums_by_text(kinds == k, words.bounds) for k in (1, 2, 3)])
    return np.array(list(SCRIPTS))[counts.argmax(axis=0)]


def base_counts(words: W.Words) -> dict[str, np.ndarray]:
    """The plain counts by text."""
    buf, n_texts = words.buf, len(words.first) - 1
    inside = np.zeros(len(buf) + 1, dtype=np.int8)
    np.add.at(inside, words.start, 1)
    np.add.at(inside, words.end, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    symbol = np.zeros(256, dtype=bool)
    symbol[np.frombuffer(SYMBOLS, dtype=np.uint8)] = True
    # lines with a word: of those of equal text the later ones count
    lines = W.scan(buf, words.bounds, separators=b"\n")
    filled = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    owner, names = lines.owner[filled], lines.hash[filled]
    distinct = np.bincount(W.distinct_pairs(owner, names)[0], minlength=n_texts)
    at = W.window_starts(words.first, REPEAT_WIDTH)
    names = W.window_hashes(words.hash, REPEAT_WIDTH)[at]
    text = np.searchsorted(words.first, at, side="right") - 1
    by = np.lexsort((names, text))
    same = np.zeros(len(by), dtype=bool)
    same[1:] = (names[by[1:]] == names[by[:-1]]) & (text[by[1:]] == text[by[:-1]])
    same[:-1] |= same[1:]
    repeated = W.covered(at[by[same]], REPEAT_WIDTH, len(words.hash))
    return {
        "n_words": words.counts,
        "word_chars": W.sums_by_text(inside & ((buf & 0xC0) != 0x80), words.bounds),
        "n_symbols": W.sums_by_text(symbol[buf], words.bounds),
        "n_dup_lines": np.bincount(owner, minlength=n_texts) - distinct,
        "n_repeat_words": W.sums_by_text(repeated, words.first),
    }


def fertility(words: W.Words, word_chars: np.ndarray, path: str) -> dict[str, np.ndarray]:
    """chars_per_token, byte_share and token_entropy by text; a text without tokens has 0, 0 and 0."""
    coder, is_byte = sentencepiece_coder(path)
    ids, counts = coder.ids(words)
    bounds = np.concatenate([[0], np.cumsum(counts)])[words.first]
    n = np.diff(bounds)
    some = np.maximum(n, 1)
    entropy = np.array([relative_entropy(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], dtype=np.float64)
    return {
        "chars_per_token": word_chars / some,
        "byte_share": W.sums_by_text(is_byte[ids], bounds) / some,
        "token_entropy": entropy,
    }


def relative_entropy(ids: np.ndarray, span: int = SPAN) -> float:
    """The entropy of the ids over the largest that so many could have: 1 where all differ, 0 where all are
    one (or there is at most one).  The ids fall in the fewest spans of at most ``span``, as equal as can
    be; of several the mean by their lengths is taken."""
    edges = len(ids) * np.arange(-(-len(ids) // span) + 1) // max(-(-len(ids) // span), 1)
    total = 0.0
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a > 1:
            seen = np.unique(ids[a:b], return_counts=True)[1]
            p = seen / (b - a)
            total += -(p * np.log2(p)).sum() / np.log2(b - a) * (b - a)
    return float(total / max(len(ids), 1))


class Rules:
    """The verdicts on pieces of a table with text and lang."""

    def __init__(self, vocabulary: str, languages: dict[str, Band] | None = None, scripts: dict[str, Band] | None = None):
        self.vocabulary, self.languages, self.scripts = vocabulary, languages or LANGUAGES, scripts or SCRIPTS

    def figures(self, piece: pa.RecordBatch) -> dict[str, np.ndarray]:
        words = W.words_of(piece.column("text"))
        out = base_counts(words)
        n = out["n_words"]
        out["base_failed"] = (n < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
        figures = fertility(words, out["word_chars"], self.vocabulary)
        script = script_of(words.buf, words)
        bands = [self.languages.get(x) or self.scripts[s] for x, s in zip(piece.column("lang").to_pylist(), script, strict=True)]
        ratio = figures["chars_per_token"]
        fine = (ratio >= [b.chars_per_token[0] for b in bands]) & (ratio <= [b.chars_per_token[1] for b in bands])
        fine &= figures["byte_share"] <= [b.max_byte_share for b in bands]
        fine &= figures["token_entropy"] >= [b.min_entropy for b in bands]
        return out | {"kept": ~out["base_failed"] & fine} | figures


def measure(docs: DataFrame, vocabulary: str, languages: dict[str, Band] | None = None, scripts: dict[str, Band] | None = None) -> DataFrame:
    """The rules' figures and verdict, one row for each row of docs (see ``SCHEMA``).

    Reads doc_id, text and lang.  Words are parted by ASCII blanks.  base_failed:
    under 20 words, or over 30 % of the words stand in 8-word windows found
    twice.  kept: base not failed, and all three fertility figures within the
    band of the language, or of the script where the language is null or has
    none.  Null text counts as empty and fails; repeated rows give a row each; a
    null doc_id stays null.  Other columns are not read; an empty table gives an
    empty result.
    """
    rules = Rules(vocabulary, languages, scripts)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches):
            out = rules.figures(piece)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, out.values())], names=["doc_id", *out])

    return plain(docs, doc_id="long", text="string", lang="string").mapInArrow(judge, SCHEMA)


def keep_good(docs: DataFrame, vocabulary: str, languages: dict[str, Band] | None = None, scripts: dict[str, Band] | None = None) -> DataFrame:
    """The rows of docs, all their columns, that the rules keep; one pass, no shuffle."""
    rules = Rules(vocabulary, languages, scripts)
    text, lang = spare(docs, "whole_text", "whole_lang")
    judged = docs.withColumn(text, F.col("text").cast("string")).withColumn(lang, F.col("lang").cast("string"))
    columns = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, text, PIECE_BYTES):
            seen = pa.RecordBatch.from_arrays([piece.column(text), piece.column(lang)], names=["text", "lang"])
            kept = piece.filter(pa.array(rules.figures(seen)["kept"]))
            yield kept.select(range(len(columns)))

    return judged.mapInArrow(keep, docs.schema)
