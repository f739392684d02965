"""Shards by minimax contiguous partition.

Groups of equal texts are atomic.  They stand in one order (by smallest doc_id)
and every shard is a run of them.  The smallest capacity that lets the groups
fit is found by binary search, each capacity checked greedily; a group above
the capacity takes a shard of its own.  Within that capacity each cut is made
where it leaves the rest most even.

Scale: the driver never sees the groups.  It holds the positions of blocks of
groups (at most about ``BLOCKS`` rows a round) and computes with lower and upper
bounds of each cut.  Only the blocks in which a cut can still lie are cut
finer, by one filtered aggregate a round, until capacity and cuts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import Stages, plain

BLOCKS = 20_000
OVERHEAD = 16

Span = tuple[int, int]


class Positions:
    """What is known of the groups' starts: blocks from a first to a last start, in order, and the end."""

    def __init__(self, first: np.ndarray, last: np.ndarray, total: int):
        order = np.argsort(first)
        self.first, self.last, self.total = first[order], last[order], total

    def _block(self, y: int) -> int:
        return int(np.searchsorted(self.first, y, side="right")) - 1

    def floor(self, y: Span) -> Span:
        """Bounds of the largest start (or the end) not above y."""
        low, high = y
        if low >= self.total:
            return self.total, self.total
        low, high = max(0, low), max(0, high)
        i = self._block(low)
        a = int(self.last[i] if low >= self.last[i] else self.first[i])
        if high >= self.total:
            return a, self.total
        i = self._block(high)
        return a, int(min(high, self.last[i]))

    def ceil(self, y: Span) -> Span:
        """Bounds of the smallest start not below y."""
        low, high = max(0, y[0]), max(0, y[1])
        i = self._block(low)
        a = low if low <= self.last[i] and low > self.first[i] else self._at(i, low)
        j = self._block(high)
        b = int(self.first[j]) if high == self.first[j] else int(self.last[j]) if high <= self.last[j] else self._start(j + 1)
        return int(a), b

    def _at(self, i: int, y: int) -> int:
        return int(self.first[i]) if y == self.first[i] else self._start(i + 1)

    def _start(self, i: int) -> int:
        return int(self.first[i]) if i < len(self.first) else self.total

    def after(self, y: Span) -> Span:
        """Bounds of the next start (or the end) behind the start y."""
        i, j = self._block(y[0]), self._block(y[1])
        a = self._start(i + 1) if y[0] >= self.last[i] else y[0] + 1
        b = self._start(j + 1) if y[1] >= self.last[j] else int(self.last[j])
        return min(a, self.total), b

    def before(self, y: Span) -> Span:
        """Bounds of the start before the start (or end) y."""
        return self.floor((max(0, y[0] - 1), max(0, y[1] - 1)))

    def open_blocks(self, spans: list[Span]) -> list[Span]:
        """The blocks of more than one start that meet one of the spans."""
        if not len(self.first):
            return []
        wanted = np.zeros(len(self.first), dtype=bool)
        for a, b in spans:
            wanted[max(0, self._block(a)) : self._block(b) + 1] = True
        wanted &= self.first < self.last
        return [(int(a), int(b)) for a, b in zip(self.first[wanted], self.last[wanted], strict=True)]


def _greedy(known: Positions, capacity: int, shards: int) -> list[Span]:
    """Cuts of the fullest shards, one after another; no more than one beyond ``shards``."""
    at, cuts = (0, 0), []
    while at[0] < known.total and len(cuts) <= shards:
        to, following = known.floor((at[0] + capacity, at[1] + capacity)), known.after(at)
        at = (max(to[0], following[0]), max(to[1], following[1]))
        cuts.append(at)
    return cuts


def _capacity(known: Positions, shards: int) -> Span:
    """Bounds of the smallest feasible capacity."""

    def least(side: int) -> int:
        low, high = 1, max(1, known.total)
        while low < high:
            mid = (low + high) // 2
            cuts = _greedy(known, mid, shards)[:shards]
            # lower bounds say that it does; upper ones that it could if starts lay as well as they can
            done = any(c[side] >= known.total for c in cuts)
            low, high = (low, mid) if done else (mid + 1, high)
        return low

    return least(1), least(0)


def _cuts(known: Positions, capacity: int, shards: int) -> list[Span]:
    """Bounds of the starts of shards 1, 2, ...: as even as the capacity allows."""
    need = [(known.total, known.total)]
    for _ in range(shards - 1):  # the least cut from which the rest still fits
        end = need[-1]
        to = known.ceil((end[0] - capacity, end[1] - capacity))
        back = known.before(end)
        need.append((min(to[0], back[0]), min(to[1], back[1])))
    need.reverse()
    at, cuts = (0, 0), []
    for k in range(shards - 1):
        left = shards - k
        even = tuple(x + -(-(known.total - x) // left) for x in at)
        goal = tuple(min(a + capacity, max(e, n)) for a, e, n in zip(at, even, need[k], strict=True))
        to, following = known.floor(goal), known.after(at)
        at = (max(to[0], following[0]), max(to[1], following[1]))
        cuts.append(at)
    return cuts


def minimax_cuts(starts: DataFrame, total: int, shards: int, blocks: int = BLOCKS) -> tuple[int, list[int]]:
    """(capacity, starts of shards 1 to shards - 1) for the group starts in ``starts.pos``."""

    def fetch(spans: list[Span], width: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last start of each block of ``width`` within the spans (in order, apart).  There may be
        thousands of spans: tasks look them up, as one condition of all of them is too deep for Spark's planner."""
        low, high = np.array(spans, dtype=np.int64).T

        def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pos = np.sort(batch.column("pos").to_numpy())
                at = np.searchsorted(low, pos, side="right") - 1
                pos = pos[(at >= 0) & (pos <= high[at])]
                block = pos // width
                new = np.append(True, block[1:] != block[:-1])[: len(pos)]
                last = np.append(new[1:], True)[: len(pos)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (block[new], pos[new], pos[last])], names=["block", "a", "b"])

        blocks = starts.select("pos").mapInArrow(within, "block long, a long, b long")
        got = blocks.groupBy("block").agg(F.min("a").alias("a"), F.max("b").alias("b")).collect()
        return np.array([x["a"] for x in got], np.int64), np.array([x["b"] for x in got], np.int64)

    known = Positions(*fetch([(0, total)], max(1, total // blocks)), total)

    def refine(spans: list[Span]) -> bool:
        nonlocal known
        todo = known.open_blocks(spans)
        if not todo:
            return False
        merged: list[list[int]] = []
        ends = {int(b): k for k, b in enumerate(known.last)}
        for a, b in todo:  # neighbours become one range
            k = ends.get(merged[-1][1]) if merged else None
            if k is not None and k + 1 < len(known.first) and int(known.first[k + 1]) == a:
                merged[-1][1] = b
            else:
                merged.append([a, b])
        width = min(sum(b - a for a, b in merged) // blocks, max(b - a for a, b in todo) // 2)
        first, last = fetch([tuple(x) for x in merged], max(1, width))
        keep = ~np.isin(known.first, [a for a, _ in todo])
        known = Positions(np.concatenate([known.first[keep], first]), np.concatenate([known.last[keep], last]), total)
        return True

    while (bounds := _capacity(known, shards))[0] < bounds[1]:
        low, high = _greedy(known, bounds[0], shards), _greedy(known, bounds[1], shards)
        spans = [(min(a[0], b[0]), max(a[1], b[1])) for a, b in zip(low, [*high, *[(total, total)] * len(low)], strict=False)]
        if not refine(spans):
            refine([(0, total)])
    cuts = _cuts(known, bounds[1], shards)
    while any(a < b for a, b in cuts):
        refine([c for c in cuts if c[0] < c[1]]) or refine([(0, total)])
        cuts = _cuts(known, bounds[1], shards)
    return bounds[1], [a for a, _ in cuts]


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """All rows of docs in shards 0 to ``shards`` - 1 of near equal bytes.

    Reads doc_id and text.  Returns doc_id, size (UTF-8 bytes of the text plus
    16), text_crc32, law ("bytes"), shard, slot (0, 1, ... within the shard) and
    grown_shard (null: this law has no such promise).  Rows of equal text are
    never parted; null counts as the empty text.  Rows stand in the order of the
    smallest doc_id of their text, then doc_id, nulls first; rows that agree in
    both fields take neighbouring slots in any order.  With fewer groups than
    shards the last ones stay empty; an empty table gives an empty result.
    Other columns are not read.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "shards")
    text = F.coalesce("text", F.lit(""))
    rows = stages.write(
        plain(docs, doc_id="long", text="string").select(
            "doc_id",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("digest"),
        ),
        "rows",
    )
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"))
    keys = ["least", "digest", "doc_id"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, byte, last = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            size = batch.column("size").to_numpy()
            digest = batch.column("digest").to_pylist()
            opens = [a != b for a, b in zip(digest, [last, *digest[:-1]], strict=True)]
            ends = np.cumsum(size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("size"), batch.column("text_crc32"), batch.column("digest"),
                 pa.array([part] * len(size), pa.int32()), pa.array(row + np.arange(len(size))),
                 pa.array(byte + ends - size), pa.array(opens)],
                names=["doc_id", "size", "text_crc32", "digest", "part", "row", "byte", "opens"],
            )
            row, byte, last = row + len(size), byte + int(size.sum()), digest[-1] if digest else last

    ordered = stages.write(
        rows.join(least, "digest").repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
            number, "doc_id long, size long, text_crc32 long, digest binary, part int, row long, byte long, opens boolean"
        ),
        "ordered",
    )
    stages.drop("rows")
    parts = ordered.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"),
        F.min_by("digest", "row").alias("first"), F.max_by("digest", "row").alias("last"),
    ).orderBy("part").collect()
    offsets, rows_before, bytes_before, last = [], 0, 0, None
    for p in parts:  # one row for each part of the order
        offsets.append((p["part"], rows_before, bytes_before, p["first"] == last))
        rows_before, bytes_before, last = rows_before + p["rows"], bytes_before + p["bytes"], p["last"]
    where = spark.createDataFrame(offsets, "part int, rows_before long, bytes_before long, goes_on boolean")
    placed = ordered.join(where, "part").select(
        "doc_id", "size", "text_crc32",
        (F.col("row") + F.col("rows_before")).alias("row"),
        (F.col("byte") + F.col("bytes_before")).alias("pos"),
        (F.col("opens") & ~((F.col("row") == 0) & F.col("goes_on"))).alias("opens"),
    )
    starts = placed.where("opens").select("pos", "row")
    cuts = minimax_cuts(starts, bytes_before, shards)[1] if parts else []
    found = {x["pos"]: x["row"] for x in starts.where(F.col("pos").isin(cuts)).collect()} if cuts else {}
    at = F.array(*[F.lit(c).cast("long") for c in [0, *cuts]])
    row_at = F.array(*[F.lit(found.get(c, rows_before) if c else 0).cast("long") for c in [0, *cuts]])
    shard = F.size(F.filter(at, lambda c: c <= F.col("pos"))) - 1
    return placed.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.element_at(row_at, F.col("shard") + 1)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
