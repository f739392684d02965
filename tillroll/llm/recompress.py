"""Repeated passages by recompression, and their exact removal.

Every text is parsed in rounds, as in recompression: the first names each run
of one word, the next ones split the symbols by a bit of their name into left
and right ones and name each neighbouring left-right pair.  Names are content
hashes, so all executors give equal substrings the same interior symbols.  For
each symbol the parse keeps the words that decided it; a window of words that
contains them all has that symbol in every document.  Each window takes the
symbol of the widest cover in it as its anchor.  A window whose anchor stands
in one document alone cannot repeat; the others, and windows without an
anchor, are verified by the names of their whole word sequences.

Scale: anchors (about a fifth of the words), then the windows left over travel in
packed rows by hash bucket; answers go back to the buckets of documents that
asked.  Neither side ever gathers what one word, passage or group of copies
has: entries are distinct by document, and buckets are those of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import packed
from tillroll.llm import words as W
from tillroll.llm.tables import Stages, buckets, plain

WIDTH = 13
PAIR_ROUNDS = 3
NONE = np.iinfo(np.uint64).max
_U = np.uint64
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
PENDING = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, text string, home int, at binary"


def parse(words: W.Words, pair_rounds: int = PAIR_ROUNDS) -> tuple[np.ndarray, ...]:
    """The symbols after the rounds: (name, words covered, first deciding word,
    end of the deciding words).  A decision that the text's edge took part in
    reaches one word beyond the text."""
    n = len(words.hash)
    name, lo = words.hash, np.arange(n)
    hi, low, high, owner = lo + 1, lo.copy(), lo + 1, words.owner

    def neighbours() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        m = len(name)
        more = np.zeros(m, dtype=bool)
        more[:-1] = owner[1:] == owner[:-1]
        before, after = lo - 1, hi + 1
        before[1:] = np.where(more[:-1], low[:-1], before[1:])
        after[:-1] = np.where(more[:-1], high[1:], after[:-1])
        return more, before, after

    if n:
        more, before, after = neighbours()
        equal = np.zeros(n, dtype=bool)
        equal[:-1] = more[:-1] & (name[1:] == name[:-1])
        opens = np.ones(n, dtype=bool)
        opens[1:] = ~equal[:-1]
        at = np.flatnonzero(opens)
        last = np.append(at[1:], n) - 1
        length = (last - at + 1).astype(_U)
        name = np.where(length > 1, W.mix(name[at] + _U(0x51ED27) * length), name[at])
        lo, hi, low, high, owner = lo[at], hi[last], before[at], after[last], owner[at]
    for r in range(pair_rounds):
        if not len(name):
            break
        more, before, after = neighbours()
        right = (W.mix(name + _U(0xA5A5 + r)) >> _U(63)).astype(bool)
        pair = np.zeros(len(name), dtype=bool)
        pair[:-1] = more[:-1] & ~right[:-1] & right[1:]
        kept = np.ones(len(name), dtype=bool)
        kept[1:] = ~pair[:-1]
        at = np.flatnonzero(kept)
        paired, rightly = pair[at], right[at]
        to = at + paired
        name = np.where(paired, W.mix(name[at] * _U(3) + W.mix(name[to] + _U(5))), name[at])
        low = np.where(paired | ~rightly, low[at], before[at])
        high = np.where(paired, high[to], np.where(rightly, high[at], after[at]))
        lo, hi, owner = lo[at], hi[to], owner[at]
    return name, hi - lo, low, high


def anchors(words: W.Words, width: int, pair_rounds: int = PAIR_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(start, anchor) of every window; NONE where no symbol is decided within it."""
    starts = W.window_starts(words.first, width)
    n = len(words.hash)
    if not len(starts):
        return starts, np.zeros(0, _U)
    name, cover, low, high = parse(words, pair_rounds)
    fits = np.flatnonzero((low >= 0) & (high - low <= width))
    key = np.full(n + width, NONE, dtype=_U)
    end = np.full(n + width, np.iinfo(np.int64).max, dtype=np.int64)
    # of symbols that one word opens, the widest is put in last and stays
    fits = fits[np.argsort(cover[fits], kind="stable")]
    wide = np.minimum(cover[fits], 15).astype(_U)
    key[low[fits]] = ((_U(15) - wide) << _U(60)) | (name[fits] >> _U(4))
    end[low[fits]] = high[fits]
    best = np.full(len(starts), NONE, dtype=_U)
    for k in range(width):
        at = starts + k
        np.minimum(best, np.where(end[at] <= starts + width, key[at], NONE), out=best)
    return starts, best


def remove_repeats(docs: DataFrame, width: int = WIDTH, pair_rounds: int = PAIR_ROUNDS, texts: bool = True) -> DataFrame:
    """Documents without the words of passages that a smaller doc_id has too.

    Reads doc_id and text.  A word goes if a window of ``width`` words that
    covers it has a word sequence that also starts in a document with a smaller
    doc_id.  Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words
    joined by one space) and kept (that string; null without ``texts``), one row
    for each input row.
    Null text counts as empty; a text of fewer words than the window, or empty,
    keeps all.  Rows with a null doc_id neither lose words nor cost others any.
    Rows with one doc_id don't count as smaller than each other.  Other columns
    are not read.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    stages, count = Stages(spark, "recompress"), buckets(spark)
    docs = plain(docs, doc_id="long", text="string").withColumn(
        "home", F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).cast("int")
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = packed.Packer(count, ("anchor", "home"))
        for piece in W.pieces(batches):
            words = W.words_of(piece.column("text"))
            known = np.array(piece.column("doc_id").is_valid())
            home = piece.column("home").to_numpy().astype(np.int32)
            starts, best = anchors(words, width, pair_rounds)
            owner = np.searchsorted(words.first, starts, side="right") - 1
            use = (best != NONE) & known[owner]
            owner, best = W.distinct_pairs(owner[use], best[use])
            yield from out.add((W.mix(best) % _U(count)).astype(np.int64), best, home[owner])
        yield from out.flush()

    def shared(table: pa.Table) -> pa.Table:
        anchor, home = packed.unpack(table, "anchor", _U), packed.unpack(table, "home", np.int32)
        order = np.argsort(anchor, kind="stable")
        anchor, home = anchor[order], home[order]
        twin = np.zeros(len(anchor), dtype=bool)
        twin[1:] = anchor[1:] == anchor[:-1]
        twin[:-1] |= twin[1:]
        home, anchor = W.distinct_pairs(home[twin].astype(np.int64), anchor[twin])
        return _back(home, anchor, "anchor", count)

    asked = docs.mapInArrow(ask, packed.schema(("anchor", "home")))
    answers = stages.write(
        asked.groupBy("bucket").applyInArrow(shared, packed.schema(("anchor",), "home")), "shared"
    )

    def first_look(left: pa.Table, right: pa.Table) -> pa.Table:
        twin = np.sort(packed.unpack(right, "anchor", _U))
        rows = []
        for piece in W.pieces(left.to_batches()):
            words = W.words_of(piece.column("text"))
            starts, best = anchors(words, width, pair_rounds)
            alive = starts[_among(best, twin) | (best == NONE)]
            cut = np.searchsorted(alive, words.first)
            home = piece.column("home").to_pylist()
            for i, (doc_id, text) in enumerate(zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True)):
                at = alive[cut[i] : cut[i + 1]] - words.first[i]
                if doc_id is None or not len(at):
                    kept = b" ".join((text or "").encode().split()).decode()
                    rows.append((doc_id, int(words.counts[i]), 0, hashlib.sha256(kept.encode()).hexdigest(), kept if texts else None, None, home[i], None))
                else:
                    rows.append((doc_id, int(words.counts[i]), None, None, None, text, home[i], at.astype(np.int32).tobytes()))
        return _table(rows, PENDING)

    looked = stages.write(
        docs.groupBy("home").cogroup(answers.groupBy("home")).applyInArrow(first_look, PENDING), "looked"
    )
    stages.drop("shared")
    pending = looked.where(F.col("n_removed").isNull())

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = packed.Packer(count, ("name", "doc_id", "home"))
        for piece in W.pieces(batches):
            words, at, owner, names = _alive(piece, width)
            owner, names = W.distinct_pairs(owner, names)
            ids = piece.column("doc_id").to_numpy()
            home = piece.column("home").to_numpy().astype(np.int32)
            yield from out.add((names % _U(count)).astype(np.int64), names, ids[owner], home[owner])
        yield from out.flush()

    def later(table: pa.Table) -> pa.Table:
        name, ids, home = (packed.unpack(table, c, t) for c, t in (("name", _U), ("doc_id", np.int64), ("home", np.int32)))
        order = np.lexsort((ids, name))
        name, ids, home = name[order], ids[order], home[order]
        opens = np.ones(len(name), dtype=bool)
        opens[1:] = name[1:] != name[:-1]
        least = ids[np.flatnonzero(opens)][np.cumsum(opens) - 1] if len(ids) else ids
        hit = ids > least
        home, key = W.distinct_pairs(home[hit].astype(np.int64), _keys(ids[hit], name[hit]))
        return _back(home, key, "key", count)

    found = stages.write(
        pending.select("doc_id", "text", "home", "at")
        .mapInArrow(windows, packed.schema(("name", "doc_id", "home")))
        .groupBy("bucket")
        .applyInArrow(later, packed.schema(("key",), "home")),
        "found",
    )

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        gone = np.sort(packed.unpack(right, "key", _U))
        rows = []
        for piece in W.pieces(left.to_batches()):
            words, at, owner, names = _alive(piece, width)
            ids = piece.column("doc_id").to_numpy()
            hit = _among(_keys(ids[owner], names), gone)
            lost = W.covered(at[hit], width, len(words.hash))
            for i, text in enumerate(piece.column("text").to_pylist()):
                a, b = words.first[i], words.first[i + 1]
                kept = b" ".join(compress(text.encode().split(), (~lost[a:b]).tolist())).decode()
                rows.append((int(ids[i]), int(b - a), int(lost[a:b].sum()), hashlib.sha256(kept.encode()).hexdigest(), kept if texts else None))
        return _table(rows, RESULT)

    done = (
        pending.select("doc_id", "text", "home", "at").groupBy("home").cogroup(found.groupBy("home")).applyInArrow(cut, RESULT)
    )
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    return looked.where(F.col("n_removed").isNotNull()).select(*names).unionByName(done)


def _alive(piece: pa.RecordBatch, width: int) -> tuple[W.Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words, and start, text and name of the windows that are still in question."""
    words = W.words_of(piece.column("text"))
    blobs = piece.column("at").to_pylist()
    counts = np.array([len(x) // 4 for x in blobs], dtype=np.int64)
    at = np.frombuffer(b"".join(blobs), dtype=np.int32).astype(np.int64) + np.repeat(words.first[:-1], counts)
    owner = np.repeat(np.arange(len(blobs)), counts)
    return words, at, owner, W.window_hashes(words.hash, width)[at]


def _keys(ids: np.ndarray, names: np.ndarray) -> np.ndarray:
    return W.mix(names + W.mix(ids.astype(_U)))


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _back(home: np.ndarray, values: np.ndarray, name: str, count: int) -> pa.Table:
    """Packed rows of the answers, by the home of the documents that asked (home is ordered)."""
    out = packed.Packer(count, (name,), "home")
    out.held, out.size = [(home, values)], len(home)
    return _batches(list(out.flush()), (name,))


def _batches(batches: list[pa.RecordBatch], names: tuple[str, ...]) -> pa.Table:
    kinds = pa.schema([("home", pa.int32()), *[(n, pa.binary()) for n in names]])
    return pa.Table.from_batches(batches, kinds)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    fields = [x.split() for x in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.table({name: pa.array(list(c), _KINDS[kind]) for (name, kind), c in zip(fields, columns, strict=True)})
