"""Fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for each position, a polynomial of the bytes
before it modulo the prime 2**31 - 1, for two bases.  Two entries answer
whether any two spans are equal, wherever they stand, and a binary search over
them finds the longest common extension of two places.

A fingerprint is a sample of the prefix array: the places to sample are chosen
by the eight bytes that follow them, so equal regions are sampled alike, and by
levels (trailing zero bits), so that two fingerprints can be brought to the same
density.  As entries of a prefix array, any two of the sampled ones name the
span between them.  Beside these cuts, of which there are at most ``CUTS``, a
fingerprint holds the entries at the fixed places of ``LADDER``; a binary search
over them finds how far two texts agree from their starts, also where they
are too short or too repetitive for cuts.  The likeness of two
fingerprints is the share of bytes in equal spans or, if larger, in the common start.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import Stages, plain
from tillroll.llm.words import buffer_of, mix, pieces, ranges

_U = np.uint64
PRIME = (1 << 31) - 1
_BITS = _U(31)
_P = _U(PRIME)
#: Bases by a fixed rule, so that every executor names a span alike.
BASES = tuple(int(x) % (PRIME - 1000) + 500 for x in mix(np.array([1, 2], _U)))
_BYTES = mix(np.arange(1, 257, dtype=_U)) % (_P - _U(1)) + _U(1)
STEP = 1 << 16
WINDOW = 8
LEAST_LEVEL = 3
NO_LEVEL = 32
CUTS = 24
PIECE_BYTES = 1 << 20
#: 1, 2, 3, 4, 6, 8, 12, ...: a common start is known to two thirds of its length at least.
LADDER = np.unique([w << k for k in range(40) for w in (2, 3)] + [1]).astype(np.int64)
_HEAD = struct.Struct("<QBQ")
_CUT = np.dtype([("at", "<u4"), ("zeros", "u1"), ("sum", "<u4")])


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for x below 2**63."""
    x = (x & _P) + (x >> _BITS)
    x = (x & _P) + (x >> _BITS)
    return np.where(x >= _P, x - _P, x)


def _run(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1)."""
    out = np.ones(1, _U)
    while len(out) < n:
        out = np.concatenate([out, _mod(out * _U(pow(base, len(out), PRIME)))])
    return out[:n]


class _Powers:
    """base**e for e from 0 to 2**32 by two tables."""

    def __init__(self, base: int):
        self.low, self.high = _run(base, STEP), _run(pow(base, STEP, PRIME), STEP)

    def __call__(self, e: np.ndarray) -> np.ndarray:
        return _mod(self.low[e & (STEP - 1)] * self.high[e >> 16])


_tables: list[tuple[_Powers, _Powers]] = []


def _powers(k: int) -> tuple[_Powers, _Powers]:
    """The powers of base k and of its inverse."""
    if not _tables:
        _tables.extend((_Powers(b), _Powers(pow(b, -1, PRIME))) for b in BASES)
    return _tables[k]


class PrefixHashes:
    """The prefix arrays of a byte buffer (8 bytes a byte, beyond blocks of fixed size)."""

    def __init__(self, buf: np.ndarray):
        self.n = len(buf)
        self.sums = [np.zeros(self.n + 1, np.uint32) for _ in BASES]
        for k, sums in enumerate(self.sums):
            up, before = _powers(k)[0], 0
            for a in range(0, self.n, STEP):
                part = _BYTES[buf[a : a + STEP]]
                part = np.cumsum(_mod(part * up.low[: len(part)]))
                part = _mod(_mod(part) * up.high[a >> 16] + _U(before))
                sums[a + 1 : a + 1 + len(part)] = part
                before = int(part[-1])

    def _span(self, k: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        sums, down = self.sums[k], _powers(k)[1]
        return _mod(_mod(sums[j].astype(_U) + _P - sums[i]) * down(i))

    def names(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """62-bit names of the spans i:j; with their lengths they decide equality."""
        return self._span(0, i, j) | (self._span(1, i, j) << _BITS)

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Are the spans of ``length`` at i and at j equal?"""
        return self.names(i, i + length) == self.names(j, j + length)

    def common_heads(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Longest common extension to the right of i and j, at most ``limit``: by binary search."""
        low, high = np.zeros(len(i), np.int64), np.asarray(limit, np.int64).copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.equal(i, j, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def common_tails(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Longest common extension to the left of i and j (the spans end there)."""
        low, high = np.zeros(len(i), np.int64), np.asarray(limit, np.int64).copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.equal(i - mid, j - mid, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, zero bits) of the places that may be cuts: the name of the window there ends in
        ``LEAST_LEVEL`` zero bits or more, and is not that of the window before (as in runs of one byte)."""
        at, zeros = [], []
        last = max(0, self.n - WINDOW + 1)
        for a in range(1, last, STEP):
            i = np.arange(a - 1, min(a + STEP, last))
            name = self._span(0, i, i + WINDOW)
            hit = np.flatnonzero(name[1:] != name[:-1]) + 1
            name = mix(name[hit])
            keep = name & _U((1 << LEAST_LEVEL) - 1) == 0
            name = name[keep]
            at.append(i[hit[keep]])
            lowest = name & (~name + _U(1))
            zeros.append(np.where(name == 0, 31, np.minimum(np.log2(np.maximum(lowest, _U(1)).astype(float)), 31)).astype(np.int64))
        return (np.concatenate(at), np.concatenate(zeros)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Fingerprints:
    """Those of texts: ``size`` (bytes), ``level``, ``whole`` for each text; its cuts are ``first[i]:first[i + 1]``
    of ``at``, ``zeros`` and ``sum`` (the prefix array's entry there, counted from the text's start).  ``rungs``
    has the entries at the places of ``LADDER`` below its size, from ``rung_first[i]`` on."""

    def __init__(self, size, level, whole, first, at, zeros, sums, rungs):
        self.size, self.level, self.whole = size, level, whole
        self.first, self.at, self.zeros, self.sum = first, at, zeros, sums
        self.n_rungs = np.searchsorted(LADDER, size)
        self.rung_first = np.concatenate([[0], np.cumsum(self.n_rungs)])
        self.rungs = rungs

    @classmethod
    def of(cls, hashes: PrefixHashes, bounds: np.ndarray) -> Fingerprints:
        """Those of the texts bounds[i]:bounds[i + 1] of the buffer."""
        texts = len(bounds) - 1
        start, end = bounds[:-1], bounds[1:]
        at, zeros = hashes.samples()
        owner = np.searchsorted(bounds, at, side="right") - 1
        inside = (at > start[owner]) & (at + WINDOW <= end[owner])
        at, zeros, owner = at[inside], zeros[inside], owner[inside]
        have = np.bincount(owner * NO_LEVEL + zeros, minlength=texts * NO_LEVEL).reshape(texts, NO_LEVEL)
        dense = have[:, ::-1].cumsum(axis=1)[:, ::-1] > CUTS  # from this level up there are too many
        level = np.maximum(dense.sum(axis=1), LEAST_LEVEL)  # all of a text's levels below its own are dense
        keep = zeros >= level[owner]
        at, zeros, owner = at[keep], zeros[keep], owner[keep]
        sums = hashes._span(0, start[owner], at)
        first = np.searchsorted(owner, np.arange(texts + 1))
        n = np.searchsorted(LADDER, end - start)
        base = np.repeat(start, n)
        rungs = hashes._span(0, base, base + LADDER[ranges(np.zeros(texts, np.int64), n)])
        return cls(end - start, level, hashes.names(start, end), first, at - start[owner], zeros, sums, rungs)

    def texts(self) -> list[str]:
        """Each as a string."""
        cuts = np.empty(len(self.at), _CUT)
        cuts["at"], cuts["zeros"], cuts["sum"] = self.at, self.zeros, self.sum
        raw, wide, rungs = cuts.tobytes(), _CUT.itemsize, self.rungs.astype("<u4").tobytes()
        heads = zip(self.size.tolist(), self.level.tolist(), self.whole.tolist(), strict=True)
        cut, rung = (x.tolist() for x in (self.first * wide, self.rung_first * 4))
        return [
            base64.b64encode(_HEAD.pack(*head) + raw[cut[i] : cut[i + 1]] + rungs[rung[i] : rung[i + 1]]).decode()
            for i, head in enumerate(heads)
        ]

    @classmethod
    def parse(cls, texts: list[str]) -> Fingerprints:
        raw = [base64.b64decode(t) for t in texts]
        heads = [_HEAD.unpack_from(r) for r in raw]
        size, level, whole = (np.array([h[k] for h in heads], t) for k, t in ((0, np.int64), (1, np.int64), (2, _U)))
        tail = [len(r) - 4 * n for r, n in zip(raw, np.searchsorted(LADDER, size).tolist(), strict=True)]
        cuts = np.frombuffer(b"".join(r[_HEAD.size : n] for r, n in zip(raw, tail, strict=True)), _CUT)
        rungs = np.frombuffer(b"".join(r[n:] for r, n in zip(raw, tail, strict=True)), "<u4").astype(_U)
        first = np.cumsum([0, *((n - _HEAD.size) // _CUT.itemsize for n in tail)])
        return cls(size, level, whole, first, cuts["at"].astype(np.int64), cuts["zeros"].astype(np.int64), cuts["sum"].astype(_U), rungs)

    def common_starts(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """A length that texts left[k] and right[k] have in common from their starts: the last place of the ladder at
        which both agree, found by binary search (where they agree at a place, they do at all before it)."""
        low, high = np.zeros(len(left), np.int64), np.minimum(self.n_rungs[left], self.n_rungs[right])
        while (low < high).any():
            mid = (low + high + 1) >> 1
            at = np.maximum(mid - 1, 0)
            i, j = (np.minimum(self.rung_first[x] + at, max(0, len(self.rungs) - 1)) for x in (left, right))
            same = (self.rungs[i] == self.rungs[j]) | (mid == 0)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return np.where(low > 0, LADDER[np.maximum(low - 1, 0)], 0)

    def _spans(self, of: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(k, name, length) of the spans between the cuts that fingerprint of[k] has at level[k] or above."""
        counts = self.first[of + 1] - self.first[of]
        pick, k = ranges(self.first[of], counts), np.repeat(np.arange(len(of)), counts)
        keep = self.zeros[pick] >= level[k]
        pick, k = pick[keep], k[keep]
        # the start (0) before and the end (the size) behind each one's cuts
        owner = np.concatenate([np.arange(len(of)), k, np.arange(len(of))])
        place = np.concatenate([np.zeros(len(of), np.int64), self.at[pick], self.size[of]])
        sums = np.concatenate([np.zeros(len(of), _U), self.sum[pick], self.whole[of] & _P])
        order = np.lexsort((place, owner))
        owner, place, sums = owner[order], place[order], sums[order]
        i = np.flatnonzero((owner[1:] == owner[:-1]) & (place[1:] > place[:-1]))
        length = place[i + 1] - place[i]
        name = _mod(_mod(sums[i + 1] + _P - sums[i]) * _powers(0)[1](place[i]))
        return owner[i], mix(name | (length.astype(_U) << _BITS)), length

    def likeness(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of the fingerprints left[k] and right[k]: twice the bytes in equal spans (repeats paired one to one), or
        in the common start if that is more, over all bytes; 1 for two empty texts."""
        level = np.maximum(self.level[left], self.level[right])
        sides = [self._spans(left, level), self._spans(right, level)]
        k, name, length = (np.concatenate(x) for x in zip(*sides, strict=True))
        side = np.repeat([0, 1], [len(s[0]) for s in sides])
        total = (self.size[left] + self.size[right]).astype(float)
        shared = np.zeros(len(left), np.int64)
        if len(k):
            order = np.lexsort((name, k))
            k, name, length, side = k[order], name[order], length[order], side[order]
            opens = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (name[1:] != name[:-1])])
            ones, all_ = np.add.reduceat(side, opens), np.diff(np.r_[opens, len(k)])
            np.add.at(shared, k[opens], np.minimum(ones, all_ - ones) * length[opens])
        shared = np.maximum(shared, self.common_starts(left, right))
        return np.where(total > 0, 2 * shared / np.maximum(total, 1), 1.0)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """Of fingerprints as strings, pair by pair."""
    n = len(left)
    return Fingerprints.parse([*left, *right]).likeness(np.arange(n), np.arange(n, 2 * n))


def _buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


_FIELDS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "head_bytes", "tail_bytes"]
_TYPES = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, head_bytes long, tail_bytes long"


def _compare(texts: list[str], follows: list[int]) -> list[list]:
    """The result fields of texts[i] whose next one is texts[follows[i]], for i < len(follows)."""
    n = len(follows)
    chars = [len(t) for t in texts[:n]]
    edited = [(t[: c - c // 2] + texts[f][: c // 2]).encode() for t, c, f in zip(texts, chars, follows, strict=False)]
    buf, bounds = _buffer([*(t.encode() for t in texts), *edited])
    hashes = PrefixHashes(buf)
    prints = Fingerprints.of(hashes, bounds)
    own, new = np.arange(n), np.arange(n) + len(texts)
    shorter = np.minimum(prints.size[own], prints.size[new])
    names = prints.texts()
    return [
        chars,
        [hashlib.sha256(e).hexdigest() for e in edited],
        names[:n],
        names[len(texts) :],
        prints.likeness(own, new).tolist(),
        prints.likeness(own, np.array(follows, np.int64)).tolist(),
        hashes.common_heads(bounds[own], bounds[new], shorter).tolist(),
        hashes.common_tails(bounds[own + 1], bounds[new + 1], shorter).tolist(),
    ]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint and that of its edited text.

    Reads doc_id and text; other columns, whatever their names, are not read.
    Null counts as the empty text.  The documents stand in descending doc_id
    order, rows without an id last, rows of one doc_id by a hash of their
    texts; the one after the last is the first, so a single row follows itself.
    In the edited text the last half of the code points (rounded down) gives
    way to as many (or all) first code points of the next document.  Returns
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited
    and near_next (likeness of the fingerprint to the edited text's and to the
    next document's), head_bytes and tail_bytes (the longest common extensions
    of text and edited text from their starts and from their ends).  Equal
    texts have equal fingerprints; different texts share a whole-text name with a
    chance of about length**2 / 2**62, and a spurious equal span, which changes a likeness
    only, one of about length / 2**31.  An empty table gives an empty result.

    Scale: the texts are dealt by ranges of the order once and streamed in it.
    A task keeps one text beside a piece of about 1 MB.  The first and last
    row of each range, whose neighbour lies in another one, are joined after
    that; the driver sees numbers of ranges alone.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "prefix-hashes")
    rows = plain(docs, doc_id="long", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    names = ["kind", "part", "doc_id", *_FIELDS, "text"]

    def batch(kind: int, ids: list, fields: list[list], texts: list) -> pa.RecordBatch:
        n, part = len(ids), TaskContext.get().partitionId()
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
        values = [[kind] * n, [part] * n, ids, *fields, texts]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for piece in pieces(batches, limit=PIECE_BYTES):
            ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
            if held is None:
                yield batch(1, ids[:1], [[None]] * len(_FIELDS), texts[:1])
            else:
                ids, texts = [held[0], *ids], [held[1], *texts]
            held = ids[-1], texts[-1]
            if len(ids) > 1:
                yield batch(0, ids[:-1], _compare(texts, list(range(1, len(texts)))), [None] * (len(ids) - 1))
        if held is not None:
            yield batch(2, [held[0]], [[None]] * len(_FIELDS), [held[1]])

    done = stages.write(dealt.mapInArrow(stream, f"kind int, part int, doc_id long, {_TYPES}, text string"), "ranges")
    parts = sorted(r["part"] for r in done.where("kind = 1").select("part").collect())  # one for each range
    after = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]], strict=True)), "part int, next int")
    firsts = done.where("kind = 1").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    ends = done.where("kind = 2").select("part", "doc_id", "text").join(F.broadcast(after), "part").join(firsts, "next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PIECE_BYTES):
            n, texts = piece.num_rows, [*piece.column("text").to_pylist(), *piece.column("next_text").to_pylist()]
            fields = _compare(texts, list(range(n, 2 * n)))
            table = pa.table([piece.column("doc_id"), *[pa.array(f) for f in fields]], names=["doc_id", *_FIELDS])
            yield from table.to_batches()

    last = ends.select("doc_id", "text", "next_text").mapInArrow(close, f"doc_id long, {_TYPES}")
    return done.where("kind = 0").select("doc_id", *_FIELDS).unionByName(last)


def common_extensions(pairs: DataFrame) -> DataFrame:
    """``pairs`` (left, right: strings; left_at, right_at: byte positions) with ``length``: how many bytes
    from these places on agree.  A null or a position outside its text gives null; other columns are not read."""
    rows = plain(pairs, left="string", right="string", left_at="long", right_at="long")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(pieces(batches, "left", PIECE_BYTES), "right", PIECE_BYTES):
            (a, a_bounds), (b, b_bounds) = buffer_of(piece.column("left")), buffer_of(piece.column("right"))
            i, j = (piece.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("left_at", "right_at"))
            null = np.zeros(piece.num_rows, bool)
            for c in piece.columns:
                null |= c.is_null().to_numpy(zero_copy_only=False)
            n, m = np.diff(a_bounds), np.diff(b_bounds)
            null |= ~((i >= 0) & (i <= n) & (j >= 0) & (j <= m))
            i, j = (np.where(null, 0, x).astype(np.int64) for x in (i, j))
            hashes = PrefixHashes(np.concatenate([a, b]))
            got = hashes.common_heads(a_bounds[:-1] + i, len(a) + b_bounds[:-1] + j, np.where(null, 0, np.minimum(n - i, m - j)))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(got, mask=null)], names=[*piece.schema.names, "length"])

    return rows.mapInArrow(extend, "left string, right string, left_at long, right_at long, length long")
