"""How filters interact: what each would remove in every order of them.

A document's mask says which filters it fails.  In an order (a permutation) it
is removed at the first step whose filter is in its mask.  The permutations
that share a prefix are neighbours in lexicographic order, so one step of one
mask covers whole intervals of permutation ranks; an interval's first rank has
the prefix's Lehmer code.  The counts of a mask are added where an interval
begins and taken off where it ends, and one prefix sum over the ranks gives the
removals of all orders.

Scale: a text is scanned once; what is exchanged is a digest, an id and five
bits a document, aggregated before each exchange.  A part (a source) is down to
one row for each mask (32) before its 600 result rows are made.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import Stages, plain

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
BLANKS = " \t\n\v\f\r"
COUNTS = ["docs", "good", "toxic"]
SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def removal_intervals(n: int = len(FILTERS)) -> Iterator[tuple[int, int, int, int]]:
    """(mask, step, low, high): at ``step`` (from 0) the documents of ``mask`` go in the orders ranked low to high - 1."""

    def walk(mask: int, left: list[int], step: int, low: int) -> Iterator[tuple[int, int, int, int]]:
        width = factorial(n - step - 1)
        for smaller, f in enumerate(left):  # ``smaller`` is the Lehmer digit
            start = low + smaller * width
            if mask >> f & 1:
                yield mask, step, start, start + width
            else:
                yield from walk(mask, [x for x in left if x != f], step + 1, start)

    for mask in range(1, 1 << n):
        yield from walk(mask, list(range(n)), 0, 0)


def removals(counts: np.ndarray) -> np.ndarray:
    """[mask, what] -> [rank, step, what]: what each step of each order removes."""
    n = (len(counts) - 1).bit_length()
    mask, step, low, high = np.array(list(removal_intervals(n))).T
    edges = np.zeros((factorial(n) + 1, n, counts.shape[1]), np.int64)
    np.add.at(edges, (low, step), counts[mask])
    np.add.at(edges, (high, step), -counts[mask])
    return edges.cumsum(axis=0)[:-1]


def _report(rows: pd.DataFrame) -> pd.DataFrame:
    """The result of one part from its counts by mask."""
    n = len(FILTERS)
    counts = np.zeros((1 << n, len(COUNTS)), np.int64)
    counts[rows["mask"].to_numpy()] = rows[COUNTS].to_numpy()
    orders = np.array(list(permutations(range(n))))
    gone = removals(counts)
    masks = np.arange(1 << n)
    fails = np.array([counts[masks >> f & 1 == 1, 0].sum() for f in range(n)])
    alone = counts[1 << np.arange(n), 0]
    shapley = np.array([gone[orders == f][:, 0].sum() for f in range(n)])
    return pd.DataFrame({
        "part": rows["part"].iloc[0],
        "filter_order": np.repeat(["".join(FILTERS[f] for f in o) for o in orders], n),
        "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
        "kept": (counts[:, 0].sum() - gone[:, :, 0].cumsum(axis=1)).ravel(),
        "removed": gone[:, :, 0].ravel(),
        "redundant": (fails[orders] - gone[:, :, 0]).ravel(),
        "unique_fails": alone[orders].ravel(),
        "good_lost": gone[:, :, 1].ravel(),
        "toxic_lost": gone[:, :, 2].ravel(),
        "shapley": shapley[orders].ravel(),
    })


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: the failures of A to D of a text (not null)."""
    inner = F.btrim(text, F.lit(BLANKS))
    words = F.split(inner, "[ \\t\\n\\x0B\\f\\r]+", -1)
    n = F.when(inner == "", 0).otherwise(F.size(words)).cast("long")
    distinct = F.when(inner == "", 0).otherwise(F.size(F.array_distinct(words))).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = [n < 200, 100 * distinct < 50 * n, 100 * capitals > 2 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(x, 1 << k).otherwise(0) for k, x in enumerate(fails)), F.lit(0))


def _sums() -> list[Column]:
    return [F.sum(c).cast("long").alias(c) for c in COUNTS]


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): how many documents fail just the filters of ``mask``.

    The copy filter needs the smallest doc_id of each text.  All rows of a text
    count as copies first; then the text's rows of smallest doc_id, found by
    one partial aggregate, change sides.  So no row is joined by its text, and
    a text with a third of all rows sends one row for each task.
    """
    stages = Stages(docs.sparkSession, "filter-audit")
    text = F.coalesce("text", F.lit(""))
    rows = stages.write(
        plain(docs, doc_id="long", text="string", source="string").select(
            "doc_id",
            F.coalesce("source", F.lit("")).alias("part"),
            text_mask(text).alias("bits"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        ),
        "rows",
    )
    marks = (
        plain(labels, doc_id="long", quality="long", toxic="long")
        .where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
        .groupBy("doc_id")
        .agg(F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("good"),
             F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("toxic"))
    )
    one = F.lit(1).cast("long").alias("docs")
    known = stages.write(
        rows.where("doc_id IS NOT NULL")
        .groupBy("digest", "doc_id", "part", "bits")
        .agg(F.count(F.lit(1)).alias("docs"))
        .join(marks, "doc_id", "left")
        .select("digest", "doc_id", "part", "bits", "docs",
                (F.col("docs") * F.coalesce("good", F.lit(0))).alias("good"),
                (F.col("docs") * F.coalesce("toxic", F.lit(0))).alias("toxic")),
        "known",
    )
    none = F.lit(0).cast("long")
    unnamed = rows.where("doc_id IS NULL").select("part", F.col("bits").alias("mask"), one, none.alias("good"), none.alias("toxic"))
    copies = known.groupBy("part", "bits").agg(*_sums()).withColumn("mask", F.col("bits") + COPY)
    firsts = (
        known.groupBy("digest", "doc_id")
        .agg(F.collect_list(F.struct("part", "bits", *COUNTS)).alias("same"))
        .groupBy("digest")
        .agg(F.min_by("same", "doc_id").alias("same"))
        .select(F.explode("same").alias("x"))
        .groupBy("x.part", "x.bits")
        .agg(*[F.sum(F.col(f"x.{c}")).cast("long").alias(c) for c in COUNTS])
    )
    moved = firsts.select("part", F.col("bits").alias("mask"), *COUNTS)
    taken = firsts.select("part", (F.col("bits") + COPY).alias("mask"), *[(-F.col(c)).alias(c) for c in COUNTS])
    found = copies.select("part", "mask", *COUNTS).unionByName(moved).unionByName(taken).unionByName(unnamed)
    return found.groupBy("part", "mask").agg(*_sums())


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step.

    Reads doc_id, text and source of ``docs``, doc_id, quality and toxic of
    ``labels``; other columns, whatever their names, are not read.  A document
    fails A with under 200 words, B if under half of its words are distinct, C
    if more than 2 % of its code points are A-Z, D if it holds one of ``#$%&*|``,
    E if its text is that of a smaller doc_id.  Null text counts as the empty
    one; rows equal in doc_id and text are no copies of each other; a row
    without a doc_id has no place in the order: it neither fails E nor makes
    others fail, and has no labels.  Of several labels of a doc_id a 1 wins.
    ``part`` is the source (null and the empty string are one part).  An empty
    table gives no rows.
    """
    return mask_counts(docs, labels).groupBy("part").applyInPandas(_report, SCHEMA)
