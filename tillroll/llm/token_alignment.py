"""Alignment of two tokenizers' ids over the same bytes, by whitespace-token anchors.

A byte-level vocabulary (A) and a piece vocabulary with byte fallback (B) cut
the same bytes (a space, then the text) into tokens.  Where an A token and a B
token end together and the next token of both begins with a space stands an
anchor.  Anchors cut a document into windows, mostly of one word, and the ids of
a window decide its alignment: the groups between its shared ends, and the
pairs of ids that share a group.  So each distinct window is aligned once (all new
ones of a batch together) and remembered by its ids.

Scale: texts are tokenised once and leave a table of each document's distinct
pairs.  The numbers of documents for each pair are summed in the tasks before
they are exchanged.  The commonest pairs' numbers (at most ``common``, a
parameter) go to all tasks; the other pairs, which few documents hold, are
joined, so no key that many documents share is ever dealt.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import words as W
from tillroll.llm.tables import Stages, plain
from tillroll.llm.vocab import WordCoder

_U = np.uint64
COMMON = 1_000_000
KEEP_WINDOWS = 500_000
KEEP_PAIRS = 2_000_000
PIECE_BYTES = 1 << 20
SPACE = 0x20


def _unit_starts(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places at which both tokenizers' whole-text results split: texts' starts and spaces behind a visible character.

    A's pattern never joins a character that is no white space with the space behind it, and no B
    piece has a space behind another character.  Where the character before may be white space (of
    two or three bytes: those that begin with E1 or E2 are not looked at further), no split is taken.
    """
    at = np.flatnonzero(buf == SPACE)
    at = at[at > 0]
    one, two, three = buf[at - 1], buf[np.maximum(at - 2, 0)], buf[np.maximum(at - 3, 0)]
    wide = (two == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (three == 0xE1) | (three == 0xE2)
    wide |= (three == 0xE3) & (two == 0x80) & (one == 0x80)
    is_start = np.zeros(len(buf) + 1, bool)
    is_start[at[(one > SPACE) & (one != 0x7F) & ~wide]] = True
    is_start[bounds[:-1]] = True
    return np.flatnonzero(is_start)


class Vocabulary:
    """Ids of units, and the bytes of each id's token."""

    def __init__(self, encode, tokens: list[bytes]):
        self.coder = WordCoder(encode)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.spaced = np.array([t.startswith(b" ") for t in tokens])

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[W.ranges(self.starts[ids], self.sizes[ids])]


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 ones are themselves, the others follow from U+0100."""
    plain_ = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain_)]
    return {chr(b): b for b in plain_} | {chr(0x100 + k): b for k, b in enumerate(rest)}


_loaded: dict = {}


def byte_vocabulary(path: str) -> Vocabulary:
    """Of a byte-level ``tokenizers`` file; special tokens' strings are plain text, their ids stand for no bytes."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        names = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=False).items()}
        tokens = [bytes(letters[c] for c in names.get(i, "")) for i in range(tokenizer.get_vocab_size())]
        _loaded[path] = Vocabulary(lambda texts: [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], tokens)
    return _loaded[path]


def piece_vocabulary(path: str) -> Vocabulary:
    """Of a ``sentencepiece`` file that puts a space before a text; units come with their space."""
    if path not in _loaded:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        inner = [t for i, t in enumerate(names) if "▁" in t.lstrip("▁") and not model.is_control(i)]
        if inner:
            raise ValueError(f"pieces with a space inside, such as {inner[0]!r}: units can't be encoded one by one")
        tokens = [bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(names)]
        space = model.piece_to_id("▁")

        def encode(units: list[str]) -> list[list[int]]:
            found = model.encode([t[1:] for t in units], num_threads=1)
            return [[space] if t == " " else ids for t, ids in zip(units, found, strict=True)]  # "" has no tokens

        _loaded[path] = Vocabulary(encode, tokens)
    return _loaded[path]


def _digits(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The decimal digits of 0 to n - 1 one after another, where each starts, and its length."""
    texts = [str(i).encode() for i in range(n)]
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


_COMMA, _BAR, _SEMICOLON = b",|;"


class Alignment:
    """The groups of windows that stand one after another, all at once.

    ``sides`` holds for A and B the ids, the tokens' byte lengths and the tokens
    of each window.  A window has the same bytes on both sides, so over all windows a group ends
    wherever the running byte counts of both sides meet.
    """

    def __init__(self, sides: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        (a, a_sizes, a_counts), (b, b_sizes, b_counts) = sides
        windows = len(a_counts)
        ends = [np.cumsum(x) for x in (a_sizes, b_sizes)]
        shared = ends[0][_among(ends[0], ends[1])]
        last = np.cumsum(a_counts) - 1
        self._window = np.searchsorted(ends[0][last], shared)  # of each group
        self.n_groups = np.bincount(self._window, minlength=windows)
        group = [np.searchsorted(shared, e) for e in ends]  # of each token
        self._counts = [np.bincount(g, minlength=len(shared)) for g in group]
        self._group, self._ids, self._windows = group, (a, b), windows

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pairs of each window, code, times): the distinct id pairs that share a group."""
        (ga, _), (a, b), (_, nb) = self._group, self._ids, self._counts
        first = np.cumsum(nb) - nb
        times = nb[ga]
        codes = np.repeat(a.astype(_U) << _U(32), times) | b[W.ranges(first[ga], times)]
        window = np.repeat(self._window[ga], times)
        order = np.lexsort((codes, window))
        codes, window = codes[order], window[order]
        opens = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (window[1:] != window[:-1])]) if len(codes) else np.zeros(0, np.int64)
        return np.bincount(window[opens], minlength=self._windows), codes[opens], np.diff(np.r_[opens, len(codes)])

    def texts(self, digits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[bytes]:
        """Each window's groups as text, a semicolon behind every one."""
        flat, starts, sizes = digits
        na, nb = self._counts
        before = np.cumsum(na + nb) - na - nb
        at, mark = np.empty(int((na + nb).sum()), np.int64), np.empty(int((na + nb).sum()), np.uint8)
        for (ids, group, n, shift, last) in zip(self._ids, self._group, (na, nb), (0, na), (_BAR, _SEMICOLON), strict=True):
            first = np.cumsum(n) - n
            place = (before + shift)[group] + np.arange(len(ids)) - first[group]
            at[place] = ids
            mark[place] = _COMMA
            mark[(before + shift + n - 1)] = last
        wide = sizes[at]
        ends = np.cumsum(wide + 1)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        out[W.ranges(ends - wide - 1, wide)] = flat[W.ranges(starts[at], wide)]
        out[ends - 1] = mark
        tokens = np.bincount(self._window, weights=na + nb, minlength=self._windows).astype(np.int64)
        cut = [0, *ends[np.cumsum(tokens) - 1].tolist()]
        raw = out.tobytes()
        return [raw[i:j] for i, j in zip(cut, cut[1:], strict=False)]


def _among(places: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the ascending ``places`` are among the ascending ``others``."""
    if not len(others):
        return np.zeros(len(places), bool)
    return others[np.minimum(np.searchsorted(others, places), len(others) - 1)] == places


class Windows:
    """The memo: alignments of the windows met so far, found by the 64-bit names of their id tuples."""

    def __init__(self, ids: int):
        self._digits = _digits(ids)
        self.clear()

    def clear(self) -> None:
        self.names, self.slots = np.zeros(0, _U), np.zeros(0, np.int64)
        self.text: list[bytes] = []
        self.n_groups, self.n_pairs, self.times = (np.zeros(0, np.int64) for _ in range(3))
        self.codes = np.zeros(0, _U)

    def slots_of(self, names: np.ndarray, sides) -> np.ndarray:
        """The slots of windows by their (distinct, ascending) names; ``sides(k)`` gives those to be aligned."""
        known = _among(names, self.names)
        new = np.flatnonzero(~known)
        if len(new):
            found = Alignment(sides(new))
            n_pairs, codes, times = found.pairs()
            slots = np.concatenate([self.slots, len(self.text) + np.arange(len(new))])
            merged = np.concatenate([self.names, names[new]])
            order = np.argsort(merged, kind="stable")
            self.names, self.slots = merged[order], slots[order]
            self.text += found.texts(self._digits)
            self.n_groups, self.n_pairs = np.concatenate([self.n_groups, found.n_groups]), np.concatenate([self.n_pairs, n_pairs])
            self.codes, self.times = np.concatenate([self.codes, codes]), np.concatenate([self.times, times])
        return self.slots[np.searchsorted(self.names, names)]

    @property
    def full(self) -> bool:
        return len(self.text) > KEEP_WINDOWS or len(self.codes) > KEEP_PAIRS


_windows: dict[tuple[str, str], Windows] = {}


class Aligned:
    """The alignments of a batch of texts: ids and their ends, windows, groups and pairs."""

    def __init__(self, texts: pa.Array, path_a: str, path_b: str):
        a, b = byte_vocabulary(path_a), piece_vocabulary(path_b)
        if (path_a, path_b) not in _windows:
            _windows[path_a, path_b] = Windows(max(len(a.sizes), len(b.sizes)))
        self.memo = _windows[path_a, path_b]
        if self.memo.full:
            self.memo.clear()
        buf, bounds = W.buffer_of(texts)
        self.n = len(bounds) - 1
        sizes = np.diff(bounds)
        live = np.flatnonzero(sizes)  # an empty text has no tokens, not those of a space
        buf, bounds = self._spaced(buf, bounds[:-1][live], sizes[live])
        starts = _unit_starts(buf, bounds)
        ends = np.append(starts[1:], len(buf))
        units = W.Words(buf, bounds, W.span_hashes(buf, starts, ends), starts, ends, np.searchsorted(starts, bounds))
        sides = [(v, *v.coder.ids(units)) for v in (a, b)]
        whole = np.ones(len(live), bool)
        for v, ids, counts in sides:
            whole &= self._same_bytes(v, ids, counts, units)
        if not whole.all():  # texts with other bytes go
            keep = np.repeat(whole, units.counts)
            sides = [(v, ids[np.repeat(keep, counts)], counts[keep]) for v, ids, counts in sides]
            starts, ends, owner = starts[keep], ends[keep], units.owner[keep]
        else:
            owner = units.owner
        self.texts = live[whole]
        owner = (np.cumsum(whole) - 1)[owner]
        n = len(self.texts)
        unit_at = np.cumsum(ends - starts)
        text_ends = unit_at[np.searchsorted(owner, np.arange(n), side="right") - 1] if n else np.zeros(0, np.int64)
        self.ids, self.sizes, token_ends, opens = [], [], [], []
        for v, ids, _ in sides:
            self.ids.append(ids.astype(np.uint32))
            self.sizes.append(v.sizes[ids])
            token_ends.append(np.cumsum(v.sizes[ids]))
            opens.append(token_ends[-1] - v.sizes[ids])
        # anchors: the texts' ends, and shared ends at which both next tokens begin with a space
        spaced = [o[v.spaced[i]] for o, i, (v, _, _) in zip(opens, self.ids, sides, strict=True)]
        is_anchor = np.zeros(int(text_ends[-1]) + 1 if n else 1, bool)
        is_anchor[spaced[0][_among(*spaced)]] = True
        is_anchor[text_ends] = True
        is_anchor[0] = False
        anchors = np.flatnonzero(is_anchor)
        self.owner = np.searchsorted(text_ends, anchors, side="left")
        cuts = [np.concatenate([[0], np.searchsorted(t, anchors, side="right")]) for t in token_ends]
        self.counts = [np.bincount(np.searchsorted(text_ends, t, side="left"), minlength=n) for t in token_ends]
        self._number_windows(cuts)

    @staticmethod
    def _spaced(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts' bytes, each with a space before it, and their bounds."""
        bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
        out = np.full(int(bounds[-1]), SPACE, np.uint8)
        out[W.ranges(bounds[:-1] + 1, sizes)] = buf[W.ranges(starts, sizes)]
        return out, bounds

    @staticmethod
    def _same_bytes(v: Vocabulary, ids: np.ndarray, counts: np.ndarray, units: W.Words) -> np.ndarray:
        """Which texts' tokens have just the text's bytes."""
        ends = np.concatenate([[0], np.cumsum(v.sizes[ids])])
        unit = np.concatenate([[0], np.cumsum(counts)])
        length = ends[unit[1:]] - ends[unit[:-1]]
        good = length == units.end - units.start
        at = W.ranges(units.start[good], length[good])
        joined = v.bytes_of(ids) if good.all() else v.bytes_of(ids[np.repeat(good, counts)])
        wrong = np.flatnonzero(joined != units.buf[at])
        bad = np.zeros(len(units.first) - 1, bool)
        bad[units.owner[~good]] = True
        bad[np.searchsorted(units.bounds, at[wrong], side="right") - 1] = True
        return ~bad

    def _number_windows(self, cuts: list[np.ndarray]) -> None:
        """A memo number for each window: only distinct ones are looked up."""
        named = []
        for ids, cut in zip(self.ids, cuts, strict=True):
            # a window's name: a sum over its ids, each mixed with its place in the window
            place = np.arange(len(ids)) - np.repeat(cut[:-1], np.diff(cut))
            sums = np.concatenate([[_U(0)], np.cumsum(W.mix(ids.astype(_U) + (place.astype(_U) << _U(32)) + _U(1)))])
            named.append(sums[cut[1:]] - sums[cut[:-1]])
        names = W.mix(named[0]) + named[1]
        distinct, first, back = np.unique(names, return_index=True, return_inverse=True)

        def sides(new: np.ndarray):
            picked = first[new]
            for ids, sizes, cut in zip(self.ids, self.sizes, cuts, strict=True):
                counts = cut[picked + 1] - cut[picked]
                at = W.ranges(cut[picked], counts)
                yield ids[at], sizes[at], counts

        self.windows = self.memo.slots_of(distinct, lambda new: list(sides(new)))[back] if len(names) else np.zeros(0, np.int64)

    def rows(self) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """[n_a, n_b, n_groups, n_links], digests; and each text's distinct pairs: bounds, codes, links."""
        memo, n = self.memo, len(self.texts)
        groups, pairs, codes, times = memo.n_groups, memo.n_pairs, memo.codes, memo.times
        first = np.cumsum(pairs) - pairs
        cut = np.searchsorted(self.owner, np.arange(n + 1))
        n_groups = W.sums_by_text(groups[self.windows], cut) if n else np.zeros(0, np.int64)
        # a text's distinct windows, then its distinct pairs
        key, often = np.unique(self.owner * len(memo.text) + self.windows, return_counts=True)
        owner, window = np.divmod(key, max(1, len(memo.text)))
        at = W.ranges(first[window], pairs[window])
        owner = np.repeat(owner, pairs[window])
        found, links = codes[at], times[at] * np.repeat(often, pairs[window])
        order = np.lexsort((found, owner))
        owner, found, links = owner[order], found[order], links[order]
        opens = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])]) if len(owner) else np.zeros(0, np.int64)
        links = np.add.reduceat(links, opens) if len(opens) else links
        owner, found = owner[opens], found[opens]
        bounds = np.searchsorted(owner, np.arange(n + 1))
        text, numbers, cut = memo.text, self.windows.tolist(), cut.tolist()
        digests = [hashlib.sha256(b"".join([text[w] for w in numbers[a:b]])[:-1]).hexdigest() for a, b in zip(cut, cut[1:], strict=False)]
        columns = [np.zeros(self.n, np.int64) for _ in range(4)]
        for c, v in zip(columns, [*self.counts, n_groups, W.sums_by_text(links, bounds)], strict=True):
            c[self.texts] = v
        shas = [""] * self.n
        for i, d in zip(self.texts.tolist(), digests, strict=True):
            shas[i] = d
        wide = np.zeros(self.n + 1, np.int64)
        wide[self.texts + 1] = np.diff(bounds)
        return columns, shas, np.cumsum(wide), found, links


_PAIRED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a binary, b binary, links binary"


def document_pairs(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each document's counts and digest, and its distinct id pairs in arrays (a, b, links) as bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for piece in W.pieces(batches, limit=PIECE_BYTES):
            columns, shas, bounds, codes, links = Aligned(piece.column("text"), path_a, path_b).rows()
            flat = [(codes >> _U(32)).astype(np.uint32), codes.astype(np.uint32), links.astype(np.uint32)]
            cut = bounds.tolist()
            blobs = [pa.array([x[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)], pa.binary()) for x in flat]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(piece.num_rows)), piece.column("doc_id"), *map(pa.array, columns), pa.array(shas), *blobs],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "links"],
            )
            row += piece.num_rows

    return plain(docs, doc_id="long", text="string").mapInArrow(scan, _PAIRED)


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row within the batch, code, links) of the packed pairs."""
    a, b, links = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32) for c in ("a", "b", "links"))
    counts = np.array([len(x) // 4 for x in batch.column("a").to_pylist()], np.int64)
    return np.repeat(np.arange(batch.num_rows), counts), a.astype(_U) << _U(32) | b, links.astype(np.int64)


def pair_counts(paired: DataFrame) -> DataFrame:
    """(a, b, docs, best): how many documents hold the pair, and is that the most among its A id's pairs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged():
            codes = np.concatenate([c for c, _ in held])
            order = np.argsort(codes, kind="stable")
            codes, docs = codes[order], np.concatenate([d for _, d in held])[order]
            opens = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            return codes[opens], np.add.reduceat(docs, opens)

        def rows(codes, docs):
            yield pa.RecordBatch.from_arrays(
                [pa.array((codes >> _U(32)).astype(np.int32)), pa.array(codes.astype(np.uint32).astype(np.int32)), pa.array(docs)], names=["a", "b", "docs"]
            )

        for batch in batches:
            _, codes, _ = _entries(batch)
            if len(codes):
                held.append((codes, np.ones(len(codes), np.int64)))
                size += len(codes)
            if size > 4 * COMMON:
                held = [merged()]
                size = len(held[0][0])
                if size > 2 * COMMON:  # too many distinct ones to go on with
                    yield from rows(*held[0])
                    held, size = [], 0
        if held:
            yield from rows(*merged())

    counts = paired.select("a", "b", "links").mapInArrow(count, "a int, b int, docs long").groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    return counts


def align_tokens(docs: DataFrame, path_a: str, path_b: str, common: int = COMMON) -> DataFrame:
    """Each document's alignment, and how common its links are among all documents.

    Reads doc_id and text; other columns, whatever their names, are not read.
    Returns doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose
    pair is held by as many documents as any pair of its A id), count_sum (sum
    over links of the documents that hold the pair) and groups_sha256.  A text
    that is null or empty, or whose tokens' bytes are not a space and the text
    (as with U+2581, which B reads as a space), has zeros and the empty string.
    Every row is a document of its own, repeated rows too.  An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "token-alignment")
    paired = stages.write(document_pairs(docs, path_a, path_b), "paired")
    counted = stages.write(pair_counts(paired), "counted")
    most = counted.groupBy("a").agg(F.max("docs").alias("most"))  # a row for each A id: at most the vocabulary
    counts = counted.join(F.broadcast(most), "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))
    counts = stages.write(counts, "counts")
    # the commonest pairs, bounded by ``common``: 13 bytes a pair on the driver and in each task
    head = counts.orderBy(F.col("docs").desc(), "a", "b").limit(common).toArrow()
    codes = head.column("a").to_numpy().astype(_U) << _U(32) | head.column("b").to_numpy().astype(_U)
    order = np.argsort(codes)
    table = spark.sparkContext.broadcast((codes[order], head.column("docs").to_numpy()[order], head.column("best").to_numpy()[order]))
    rare_exist = head.num_rows >= common
    sums = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"

    def look_up(batches: Iterator[pa.RecordBatch], rare: bool) -> Iterator[pa.RecordBatch]:
        """The sums over the common pairs; or, with ``rare``, the entries of the others."""
        known, docs_of, best_of = table.value
        for batch in batches:
            row, code, links = _entries(batch)
            at = np.minimum(np.searchsorted(known, code), max(0, len(known) - 1))
            hit = known[at] == code if len(known) else np.zeros(len(code), bool)
            if rare:
                row, code, links = row[~hit], code[~hit], links[~hit]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(row)), pa.array((code >> _U(32)).astype(np.int32)),
                     pa.array(code.astype(np.uint32).astype(np.int32)), pa.array(links)], names=["row", "a", "b", "links"],
                )
                continue
            row, at, links = row[hit], at[hit], links[hit]
            out = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(out[0], row[best_of[at]], links[best_of[at]])
            np.add.at(out[1], row, links * docs_of[at])
            columns = [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, out)], names=[x.split()[0] for x in sums.split(", ")])

    found = paired.mapInArrow(lambda batches: look_up(batches, False), sums)
    if rare_exist:
        rest = (
            paired.select("row", "a", "b", "links")
            .mapInArrow(lambda batches: look_up(batches, True), "row long, a int, b int, links long")
            .join(counts, ["a", "b"])
            .groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("links") * F.col("docs")).alias("more_sum"))
        )
        found = found.join(rest, "row", "left").select(
            *[c for c in found.columns if c not in ("n_best", "count_sum")],
            (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        )
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
