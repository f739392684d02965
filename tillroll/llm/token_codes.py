"""Token ids in directly addressable codes.

An id is cut into chunks of ``WIDTH`` bits.  Level 0 has the lowest chunk of
every id; a bitmap says which ids go on, and level 1 has the next chunks of
those, and so on.  A rank directory counts the bitmap's ones before each block
of ``BLOCK`` bits.  The i-th id is read with one chunk, one bit and one rank
for each level, and nothing else is decoded.

The file format is a Parquet table of segments, in the order of the ids.  A
segment holds whole documents (at least ``SEGMENT`` ids but for a part's last):
``part``, ``segment``, ``first`` (ids of the part before it), ``doc_ids``,
``starts`` (of each document in the segment, with the end), and for each level
``levels``, ``bitmaps``, ``ranks``.  Parts are in ascending order of doc_id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import words as W
from tillroll.llm.tables import plain
from tillroll.llm.vocab import case_blind_units, tokenizers_coder

WIDTH = 8
BLOCK = 512
SEGMENT = 1 << 20
SCHEMA = (
    "part int, segment int, first long, doc_ids array<long>, starts array<long>, "
    "levels array<binary>, bitmaps array<binary>, ranks array<binary>"
)
_ARROW = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64()))]
    + [(c, pa.list_(pa.binary())) for c in ("levels", "bitmaps", "ranks")]
)


def encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """(levels, bitmaps, ranks) of the ids."""
    levels, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        more = (rest >> WIDTH) > 0
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0, np.uint32)
        levels.append((rest & ((1 << WIDTH) - 1)).astype(np.uint8).tobytes())
        bitmaps.append(bits.tobytes())
        ranks.append((np.cumsum(ones) - ones).astype(np.uint32).tobytes())
        if not more.any():
            return levels, bitmaps, ranks
        rest = rest[more] >> WIDTH


class Codes:
    """Random access to one segment's ids."""

    def __init__(self, levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self.levels = [np.frombuffer(x, np.uint8) for x in levels]
        self.bitmaps = [np.frombuffer(x, np.uint8) for x in bitmaps]
        self.ranks = [np.frombuffer(x, np.uint32) for x in ranks]

    def _bits(self, level: int, a: int, b: int) -> np.ndarray:
        return np.unpackbits(self.bitmaps[level][a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a]

    def _rank(self, level: int, i: int) -> int:
        """Ids before the i-th of a level that go on to the next."""
        block = min(i // BLOCK, len(self.ranks[level]) - 1)
        return int(self.ranks[level][block]) + int(self._bits(level, block * BLOCK, i).sum())

    def __getitem__(self, i: int) -> int:
        value, shift, level = 0, 0, 0
        while True:
            value |= int(self.levels[level][i]) << shift
            if not self.bitmaps[level][i // 8] >> (i % 8) & 1:
                return value
            i, level, shift = self._rank(level, i), level + 1, shift + WIDTH

    def slice(self, a: int, b: int, level: int = 0) -> np.ndarray:
        """The ids a:b."""
        out = self.levels[level][a:b].astype(np.uint32)
        if a < b:
            on = self._bits(level, a, b).astype(bool)
            if on.any():
                to = self._rank(level, a)
                out[on] |= self.slice(to, to + int(on.sum()), level + 1) << WIDTH
        return out


def write_codes(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, segment: int = SEGMENT) -> None:
    """Encode every text, append ``end_id``, and write the ids to ``path`` in ascending order of doc_id.

    Reads doc_id and text.  Null text counts as empty (its end id alone); null
    doc_ids come first; rows of one doc_id are in an unspecified but written
    order.  Other columns are not read.  An empty table writes an empty one.
    """
    docs = plain(docs, doc_id="long", text="string")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = tokenizers_coder(vocabulary), TaskContext.get().partitionId()
        first, number, held, ids_of, counts = 0, 0, [], [], []

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal first, number, held, ids_of, counts
            ids = np.concatenate(held)
            starts = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
            row = [part], [number], [first], [sum(ids_of, [])], [starts.tolist()], *([x] for x in encode(ids))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _ARROW, strict=True)], schema=_ARROW)
            first, number, held, ids_of, counts = first + len(ids), number + 1, [], [], []

        for piece in W.pieces(batches):
            words = case_blind_units(W.words_of(piece.column("text")))
            flat, each = coder.ids(words)
            ends = np.concatenate([[0], np.cumsum(each)])[words.first]
            held.append(np.insert(flat, ends[1:], end_id))
            counts.append(np.diff(ends) + 1)
            ids_of.append(piece.column("doc_id").to_pylist())
            if sum(map(len, held)) >= segment:
                yield from close()
        if held:
            yield from close()

    by_id = docs.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id")
    by_id.mapInArrow(code, SCHEMA).write.parquet(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """One row a document, from the files alone: doc_id, start, n_tokens, ids_crc32, last_id.

    start counts the ids of all documents before it; ids_crc32 is the unsigned
    crc32 of its ids as little-endian 32-bit numbers.  The parts' totals (one
    row a file) give each part its offset.
    """
    table = spark.read.schema(SCHEMA).parquet(path)
    length = F.element_at("starts", -1)
    totals = table.groupBy("part").agg(F.sum(length).alias("n")).orderBy("part").collect()
    offsets, before = [], 0
    for x in totals:
        offsets.append((x["part"], before))
        before += x["n"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["levels"], row["bitmaps"], row["ranks"])
                starts = row["starts"]
                crcs, lasts = [], []
                for a, b in zip(starts, starts[1:], strict=False):
                    crcs.append(zlib.crc32(codes.slice(a, b).astype("<u4").tobytes()))
                    lasts.append(codes[b - 1])
                starts = np.array(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts[:-1] + row["first"]), pa.array(np.diff(starts)),
                     pa.array(crcs, pa.int64()), pa.array(lasts, pa.int64()), pa.array([row["part"]] * len(crcs), pa.int32())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "last_id", "part"],
                )

    rows = table.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, last_id long, part int")
    where = spark.createDataFrame(offsets, "part int, before long")
    return rows.join(where, "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "last_id")


def token_at(spark: SparkSession, path: str, part: int, position: int) -> int:
    """One id of a part: reads the segment that holds it, decodes that id alone."""
    near = spark.read.schema(SCHEMA).parquet(path).where((F.col("part") == part) & (F.col("first") <= position))
    row = near.orderBy(F.desc("first")).first()
    return Codes(row["levels"], row["bitmaps"], row["ranks"])[position - row["first"]]
