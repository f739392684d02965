"""Benchmark items inside documents, by size-partitioned MinHash containment search.

The items are partitioned by the size of their shingle sets (powers of two).
Within a partition each item's sketch is its smallest shingle hashes; their
number comes from the partition's largest size and the threshold, so that a
document that contains the threshold's share of an item has at least one hash
of the sketch.  (A sketch of a long document could not promise that for a short
item, so documents are probed with all their shingles, cut off at the
partitions' largest sketch hash.)  Candidates are verified by exact
containment of the item's whole shingle set.

An item of fewer words than a shingle has is one shingle, its whole word
sequence; documents are probed for it with their windows of as many words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import words as W
from tillroll.llm.tables import plain, spare

WIDTH = 5
PERCENT = 80
_U = np.uint64
#: Items that one search step holds: their shingles are what a task keeps in memory.
ITEMS = 20_000
RESULT = "doc_id long, item_id long, n_shared long, n_item long"


class ItemIndex:
    """Sketches by size partition, and the items' whole shingle sets."""

    def __init__(self, ids: list, texts: list, width: int, percent: int):
        words = W.words_of(pa.array(texts, pa.large_string()), fold=True)
        owner, names = W.distinct_pairs(*W.shingles(words, width))
        self.width, self.percent, self.ids = width, percent, ids
        self.sizes = np.bincount(owner, minlength=len(ids))
        # items of fewer words than a shingle has: number of words -> (names in order, their items)
        few = words.counts[owner] < width
        self.short = {}
        for n in np.unique(words.counts[owner[few]]):
            same = few & (words.counts[owner] == n)
            by = np.argsort(names[same], kind="stable")
            self.short[int(n)] = names[same][by], owner[same][by]
        owner, names = owner[~few], names[~few]
        long_sizes = np.bincount(owner, minlength=len(ids))
        self.owner, self.names = owner, names
        parts = np.frexp(np.maximum(self.sizes, 1))[1]
        probe_names, probe_items = [], []
        rank = np.arange(len(names)) - np.repeat(np.cumsum(long_sizes) - long_sizes, long_sizes)  # names are in order
        for part in np.unique(parts[long_sizes > 0]):
            largest = int(long_sizes[parts == part].max())
            length = largest - -(-percent * largest // 100) + 1
            use = (parts[owner] == part) & (rank < length)
            probe_names.append(names[use])
            probe_items.append(owner[use])
        self.probe = np.concatenate(probe_names) if probe_names else np.zeros(0, _U)
        order = np.argsort(self.probe, kind="stable")
        self.probe = self.probe[order]
        self.items = np.concatenate(probe_items)[order] if probe_names else np.zeros(0, np.int64)
        self.cutoff = self.probe[-1] if len(self.probe) else _U(0)
        by = np.argsort(names, kind="stable")
        self.all_names, self.all_items = names[by], owner[by]

    def search(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, shared) of every text that holds the threshold's share of an item."""
        words = W.words_of(texts, fold=True)
        text, item, shared = self._long(words, len(texts))
        few_text, few_item = self._short(words)
        return np.concatenate([text, few_text]), np.concatenate([item, few_item]), np.concatenate([shared, np.ones(len(few_text), np.int64)])

    def _short(self, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, item) for the items of fewer words than a shingle has: a window of the text is the item."""
        found = [np.zeros(0, np.int64)]
        for n, (ordered, items) in self.short.items():
            at = W.window_starts(words.first, n)
            names = W.window_hashes(words.hash, n)[at]
            hit = ordered[np.minimum(np.searchsorted(ordered, names), len(ordered) - 1)] == names
            owner = np.searchsorted(words.first, at[hit], side="right") - 1
            text, item = self._joined(*W.distinct_pairs(owner, names[hit]), ordered, items)
            found.append(text * len(self.ids) + item)
        pair = np.concatenate(found)
        return pair // max(len(self.ids), 1), pair % max(len(self.ids), 1)

    def _long(self, words: W.Words, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, shared) for the others."""
        none = np.zeros(0, np.int64)
        if not len(self.probe):
            return none, none, none
        owner, names = W.shingles(words, self.width)
        low = np.flatnonzero(names <= self.cutoff)
        at = np.searchsorted(self.probe, names[low])
        hit = self.probe[np.minimum(at, len(self.probe) - 1)] == names[low]
        if not hit.any():
            return none, none, none
        text, item = self._joined(owner[low[hit]], names[low[hit]], self.probe, self.items)
        wanted = np.unique(text * len(self.ids) + item)
        # exact: all shingles of the candidate texts against the whole sets
        docs = np.unique(wanted // len(self.ids))
        mine = np.zeros(n_texts, dtype=bool)
        mine[docs] = True
        owner, names = W.distinct_pairs(owner[mine[owner]], names[mine[owner]])
        text, item = self._joined(owner, names, self.all_names, self.all_items)
        pair, shared = np.unique(text * len(self.ids) + item, return_counts=True)
        keep = np.isin(pair, wanted)
        pair, shared = pair[keep], shared[keep]
        text, item = pair // len(self.ids), pair % len(self.ids)
        keep = 100 * shared >= self.percent * self.sizes[item]
        return text[keep], item[keep], shared[keep]

    @staticmethod
    def _joined(owner: np.ndarray, names: np.ndarray, ordered: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = np.searchsorted(ordered, names, side="left")
        n = np.searchsorted(ordered, names, side="right") - a
        return np.repeat(owner, n), items[W.ranges(a, n)]


def contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, percent: int = PERCENT, step: int = ITEMS) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) for each document that holds at least
    ``percent`` of the distinct ``width``-word shingles of an item.

    Reads doc_id and text of docs, item_id and text of items.  Words are parted
    by ASCII blanks, A-Z folded; an item of fewer words has its word sequence as
    its one shingle, held by a document in which those words stand consecutively.  Null and empty texts hold nothing and are held by nothing.
    Equal rows give one row each; null ids are kept as they are.  Other columns are not read.
    The items are searched in blocks of ``step`` rows, so the memory a task
    needs for them is bounded; each block is one pass over the documents.
    """
    docs = plain(docs, doc_id="long", text="string")
    found = None
    for index in item_blocks(items, width, percent, step):

        def search(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for piece in W.pieces(batches):
                text, item, shared = index.search(piece.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").take(pa.array(text)), pa.array([index.ids[i] for i in item], pa.int64()),
                     pa.array(shared, pa.int64()), pa.array(index.sizes[item], pa.int64())],
                    names=["doc_id", "item_id", "n_shared", "n_item"],
                )

        rows = docs.mapInArrow(search, RESULT)
        found = rows if found is None else found.unionByName(rows)
    return found


def item_blocks(items: DataFrame, width: int, percent: int, step: int) -> Iterator[ItemIndex]:
    """Indexes of the items, about ``step`` rows each (one at least, maybe of no item)."""
    items = plain(items, item_id="long", text="string").where(F.length("text") > 0)
    blocks = max(1, -(-items.count() // step))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        held = sorted((x["item_id"] is None, x["item_id"], x["text"]) for x in items.where(block == k).collect())
        yield ItemIndex([x[1] for x in held], [x[2] for x in held], width, percent)


def clean_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH, percent: int = PERCENT, step: int = ITEMS) -> DataFrame:
    """The rows of docs, all their columns, that hold no item; one pass for each block of items, no shuffle."""
    schema, columns = docs.schema, docs.columns
    (text,) = spare(docs, "whole_text")
    for index in item_blocks(items, width, percent, step):

        def keep(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for piece in W.pieces(batches, text):
                clean = np.ones(piece.num_rows, dtype=bool)
                clean[index.search(piece.column(text))[0]] = False
                yield piece.filter(pa.array(clean)).select(range(len(columns)))

        docs = docs.withColumn(text, F.col("text").cast("string")).mapInArrow(keep, schema)
    return docs
