"""N-gram Jaccard join by vertical partitioning.

All distinct word n-grams stand in one global order, rarest first: by their
estimated frequency (a fixed-size counter table over the whole input), then by
name.  The order is cut into fragments.  Where a pair of texts is to be judged,
each fragment counts the pair's overlap within it, apart from the others, and
the counts are summed by pair: the exact intersection.

Which pairs are judged: two linked sets share some (``SHARED``) of the rarest
n-grams of both (prefix filter) and have near sizes (length filter), so the
postings of these n-grams hold every link.  A posting list is never expanded
into its pairs.  First each text is judged against one hub, that of most of
its lists; this joins the groups of copies.  Then only pairs of the same lists
that lie in different components remain, less those that the distances to a
common hub rule out (Jaccard distance is a metric) and less those whose
sketches differ too much.  A sketch holds for each of some hash buckets whether
the set has an odd count there; two sketches differ in at most as many bits as
the sets differ in n-grams, so the bound is exact.  In rounds each text is
judged against its likeliest partner among these, then against the likeliest of
each of 4, 16, ... hash classes of them, so a task emits a bounded number of
pairs for each text it holds.  What is judged joins components or is remembered
as unlinked; the rounds end when no pair is left, so no link between components
is lost.  The rounds read the texts of their own nodes alone, written once.
Equal sets are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import packed
from tillroll.llm import words as W
from tillroll.llm.components import components
from tillroll.llm.tables import Stages, buckets, plain, spare

_U = np.uint64
#: Counters of the frequency estimate: about one for every 50 shingles tells rare from frequent ones well.
SKETCH_BITS = 22
SLICES = 64
MOST = np.iinfo(np.uint16).max
FRAGMENTS = 8
#: Of their rarest n-grams, linked sets share so many (or their whole overlap, if that is less).
SHARED = 4
#: Pairs that one step of the numpy loop tests at most.
STEP = 1 << 18
#: Bits of the sketches that pairs are tested by.
SKETCH = 1024
#: Text that a task takes at once.
PIECE_BYTES = 1 << 20
#: Each round judges so many times more partners of a text than the one before it.
SLOTS = 4


def sets_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, name) of the distinct shingles, and set size and set name by text."""
    words = W.words_of(texts, fold=True)
    owner, names = W.distinct_pairs(*W.shingles(words, width))
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    sizes = np.diff(bounds)
    totals = np.zeros(len(names) + 1, dtype=_U)
    np.cumsum(W.mix(names ^ _U(0x1B873593)), out=totals[1:])
    node = W.mix(totals[bounds[1:]] - totals[bounds[:-1]] + sizes.astype(_U)).view(np.int64)
    return owner, names, sizes, node


def odd_sketches(owner: np.ndarray, names: np.ndarray, texts: int) -> list[bytes]:
    """For each text a bit for every hash bucket: whether the set has an odd count in it."""
    at = owner * SKETCH + (W.mix(names ^ _U(0x2545F491)) % _U(SKETCH)).astype(np.int64)
    odd = (np.bincount(at, minlength=texts * SKETCH) & 1).astype(np.uint8)
    return [x.tobytes() for x in np.packbits(odd.reshape(texts, SKETCH), axis=1)]


class Order:
    """The global order of n-grams: estimated count first, then name; and its fragments."""

    def __init__(self, counts: np.ndarray, fragments: int):
        self.counts = counts
        levels, times = np.unique(counts[counts > 0], return_counts=True)
        mass = np.cumsum(levels.astype(float) * times)
        cuts = []
        for k in range(1, fragments) if len(levels) else ():
            goal = mass[-1] * k / fragments
            i = int(np.searchsorted(mass, goal))
            before = mass[i - 1] if i else 0.0
            share = (goal - before) / (mass[i] - before)
            cuts.append((int(levels[i]) << 40) | min(int(share * 2**40), 2**40 - 1))
        self.cuts = np.array(cuts, dtype=_U)

    def rank(self, names: np.ndarray) -> np.ndarray:
        return (self.counts[names % _U(len(self.counts))].astype(_U) << _U(40)) | (names >> _U(24))

    def fragment(self, ranks: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, ranks, side="right")


def jaccard_components(
    docs: DataFrame, width: int = 4, percent: int = 85, fragments: int = FRAGMENTS, sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """One row for each row of docs: doc_id, row, n_shingles, component_id, class_id, n_links, root.

    Two texts link when 100 * intersection >= percent * union of their sets of
    distinct ``width``-word shingles (A-Z folded); a text of fewer words has
    its word sequence as its one shingle.  component_id is the smallest doc_id
    reachable by links.  class_id is the smallest doc_id with the same set;
    n_links counts the classes that the class was found to link with directly
    (at least one where the component has two classes).  Null text counts as
    empty; an empty text links with nothing, has its own doc_id as both ids.
    A null doc_id is never smallest unless all ids of the component are null.
    Repeated rows are rows of one class.  row is xxhash64(doc_id, text), for joins
    back; root names the component whatever its ids are.  Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    stages, count = Stages(spark, "jaccard"), buckets(spark)
    docs = plain(docs, doc_id="long", text="string").withColumn("row", F.xxhash64("doc_id", "text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << sketch_bits, dtype=np.int64)
        for piece in W.pieces(batches, limit=PIECE_BYTES):
            _, names, sizes, node = sets_of(piece.column("text"), width)
            np.add.at(counts, (names % _U(len(counts))).astype(np.int64), 1)
            none = [pa.nulls(piece.num_rows, kind) for kind in (pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("row"), pa.array(sizes), pa.array(node), *none],
                names=["doc_id", "row", "n", "node", "slice", "counts"],
            )
        parts = np.split(np.minimum(counts, MOST).astype(np.uint16), SLICES)
        full = [k for k, part in enumerate(parts) if part.any()]
        none = pa.nulls(len(full), pa.int64())
        blobs = [parts[k].tobytes() for k in full]
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(full, pa.int32()), pa.array(blobs, pa.binary())],
            names=["doc_id", "row", "n", "node", "slice", "counts"],
        )

    described = stages.write(
        docs.mapInArrow(describe, "doc_id long, row long, n long, node long, slice int, counts binary"), "described"
    )
    members = described.where(F.col("slice").isNull()).select("doc_id", "row", "n", "node")

    def summed(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for part in parts:
            for blob in part.column("counts").to_pylist():
                total = total + np.frombuffer(blob, dtype=np.uint16).astype(np.int64)
        held = np.minimum(total, MOST).astype(np.uint16).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([held])], names=["slice", "counts"])

    counts = np.zeros((SLICES, (1 << sketch_bits) // SLICES), dtype=np.uint16)
    for x in described.where(F.col("slice").isNotNull()).select("slice", "counts").groupBy("slice").applyInArrow(summed, "slice int, counts binary").collect():
        counts[x["slice"]] = np.frombuffer(x["counts"], dtype=np.uint16)  # SLICES rows of a fixed size
    shared = spark.sparkContext.broadcast(Order(counts.ravel(), fragments))  # 2 bytes for each counter

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, order = packed.Packer(count, ("name", "node", "n")), shared.value
        for piece in W.pieces(batches, limit=PIECE_BYTES):
            owner, names, sizes, node = sets_of(piece.column("text"), width)
            once = np.zeros(len(node), dtype=bool)
            once[np.unique(node, return_index=True)[1]] = True
            by = np.lexsort((order.rank(names), owner))
            place = np.arange(len(names)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            # any link has at least percent of the own set in common
            prefix = np.minimum(sizes, sizes - -(-percent * sizes // 100) + SHARED)
            first = (place < prefix[owner]) & once[owner]
            use = by[first]
            # a partner that is no smaller leaves less of the own set unshared: the last bit marks that shorter prefix
            early = sizes - -(-2 * percent * sizes // (100 + percent)) + SHARED
            marked = 2 * sizes[owner[use]] + (place[first] < early[owner[use]])
            yield from out.add((W.mix(names[use]) % _U(count)).astype(np.int64), names[use], node[owner[use]], marked.astype(np.int32))
        yield from out.flush()

    def lists(table: pa.Table) -> pa.Table:
        name, node, n = (packed.unpack(table, c, t) for c, t in (("name", _U), ("node", np.int64), ("n", np.int32)))
        by = np.lexsort((node, name))
        name, node, n = name[by], node[by], n[by]
        new = np.ones(len(name), dtype=bool)
        new[1:] = (name[1:] != name[:-1]) | (node[1:] != node[:-1])
        name, node, n = name[new], node[new], n[new]
        twin = np.zeros(len(name), dtype=bool)
        twin[1:] = name[1:] == name[:-1]
        twin[:-1] |= twin[1:]
        name, node, n = name[twin], node[twin], n[twin]
        early, n = (n & 1).astype(bool), n >> 1
        # within a list, sets of one size class are near enough in size; the least node of the class is its hub
        size = np.floor(np.log(np.maximum(n, 1)) / np.log(100 / percent)).astype(np.int64)
        by = np.lexsort((node, size, name))
        name, node, n, size, early = name[by], node[by], n[by], size[by], early[by]
        opens = np.ones(len(name), dtype=bool)
        opens[1:] = (name[1:] != name[:-1]) | (size[1:] != size[:-1])
        hub = node[np.flatnonzero(opens)][np.cumsum(opens) - 1] if len(node) else node
        return pa.table({"name": name.view(np.int64), "node": node, "n": n, "early": early, "hub": hub})

    posted = stages.write(
        docs.mapInArrow(post, packed.schema(("name", "node", "n"))).groupBy("bucket").applyInArrow(lists, "name long, node long, n int, early boolean, hub long"),
        "posted",
    )
    star = posted.where("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("lists"), F.first("n").alias("n"))
    star = star.where("lists > 1").groupBy("node").agg(F.max(F.struct("lists", "hub")).alias("best"), F.first("n").alias("n"))
    star = stages.write(star.select("node", "best.hub", "n"), "star")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for piece in W.pieces(batches, limit=PIECE_BYTES):
            owner, names, _, node = sets_of(piece.column("text"), width)
            part = order.fragment(order.rank(names))
            by = np.lexsort((names, part, owner))
            owner, names, part = owner[by], names[by].view(np.int64), part[by]
            key = owner * (fragments + 1) + part
            opens = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            ends = np.append(opens, len(key)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[owner[opens]]), pa.array(part[opens].astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(names))],
                names=["node", "part", "names"],
            )

    def texts_of(nodes: DataFrame) -> DataFrame:
        rows = members.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("row").alias("row"))
        return docs.join(rows, "row").select("node", "text")

    def overlaps(pairs: DataFrame, name: str, texts: DataFrame | None = None) -> DataFrame:
        """pairs (a, b, na, nb) with the size of their intersection: partial counts by fragment, summed.
        The texts (node, text) hold all ends of the pairs; without them the ends are looked up in docs."""
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        found = texts_of(ends) if texts is None else texts.join(ends, "node", "left_semi")
        sets = found.select("text").mapInArrow(cut, "node long, part int, names array<long>")
        sets = stages.write(sets, f"{name}-sets")
        left = sets.select(F.col("node").alias("a"), "part", F.col("names").alias("x"))
        right = sets.select(F.col("node").alias("b"), "part", F.col("names").alias("y"))
        partial = (
            pairs.join(right, "b").join(left, ["a", "part"])
            .select("a", "b", "na", "nb", "part", F.size(F.array_intersect("x", "y")).cast("long").alias("k"))
        )
        # equal rows of docs give a fragment twice: one count each
        judged = stages.write(partial.distinct().groupBy("a", "b", "na", "nb").agg(F.sum("k").alias("k")), name)
        stages.drop(f"{name}-sets")
        return judged

    linked = F.expr(f"100 * k >= {percent} * (na + nb - k)")
    sizes_of = posted.groupBy(F.col("node").alias("a")).agg(F.first("n").alias("na"))
    pairs = star.select(F.col("hub").alias("a"), F.col("node").alias("b"), F.col("n").alias("nb")).join(sizes_of, "a")
    judged = overlaps(stages.write(pairs, "pairs"), "judged")
    first = components(judged.where(linked), stages, "first")

    # the lists of more than one component, and what is known of each node: its hub and its distance to it
    root = F.coalesce("root", "node")
    mixed = posted.join(first, "node", "left").groupBy("name").agg(F.min(root).alias("x"), F.max(root).alias("y"))
    far = judged.select(F.col("a").alias("best"), F.col("b").alias("node"), F.expr("1 - k / (na + nb - k)").alias("far"))
    known = stages.write(
        posted.join(mixed.where("x <> y"), "name", "left_semi")
        .join(star.select("node", F.col("hub").alias("best")).join(far, ["node", "best"], "left"), "node", "left")
        .select("name", "node", "n", "early", F.coalesce("best", "node").alias("hub"), F.expr("if(best is null, 0D, coalesce(far, 1D))").alias("far")),
        "known",
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, limit=PIECE_BYTES):
            owner, names, _, node = sets_of(piece.column("text"), width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(odd_sketches(owner, names, len(node)), pa.binary())], names=["node", "sketch"]
            )

    texts = stages.write(texts_of(known.select("node").distinct()), "texts")
    sketched = texts.select("text").mapInArrow(sketch, "node long, sketch binary")
    sketched = stages.write(sketched.dropDuplicates(["node"]), "sketched")

    links, found, failed, rounds = judged.where(linked).select("a", "b"), first, None, 0
    while True:
        slots = SLOTS**rounds
        # all that is judged and does not link, at the lesser node of the pair
        tried = failed.groupBy(F.col("a").alias("node")).agg(F.collect_set("b").alias("tried")) if failed else None
        state = known.join(sketched, "node").join(found, "node", "left").withColumn("root", root)
        state = state.join(tried, "node", "left") if tried else state.withColumn("tried", F.lit(None).cast("array<long>"))
        rest = (
            state.select(F.pmod(F.xxhash64("name"), F.lit(count)).alias("bucket"), "name", "node", "n", "early", "root", "hub", "far", "sketch", "tried")
            .groupBy("bucket")
            .applyInArrow(_across(percent, slots), "a long, b long, na long, nb long, apart long, lists long")
            .groupBy("a", "b", "na", "nb")
            .agg(F.sum("lists").alias("lists"), F.max("apart").alias("apart"))
        )
        rest = stages.write(rest, f"rest-{rounds}")
        if rest.isEmpty():
            break
        ends = rest.withColumn("odds", F.expr("struct(apart / (na + nb) as apart, -lists as lists)")).select(
            F.explode(F.expr("array(struct(a as node, b as partner), struct(b as node, a as partner))")).alias("end"), "odds", "a", "b", "na", "nb"
        )
        best = ends.groupBy("end.node", F.pmod(F.xxhash64("end.partner"), F.lit(slots))).agg(F.min(F.struct("odds", "a", "b", "na", "nb")).alias("best"))
        best = stages.write(best.select("best.a", "best.b", "best.na", "best.nb").distinct(), f"best-{rounds}")
        judged = overlaps(best, f"tried-{rounds}", texts)
        links = links.union(judged.where(linked).select("a", "b"))
        failed = judged.where(~linked) if failed is None else failed.union(judged.where(~linked))
        found = components(links, stages, f"joined-{rounds}")
        # a node without a partner in this round has none in the next
        live = rest.select(F.col("a").alias("node")).union(rest.select(F.col("b").alias("node"))).distinct()
        known = stages.write(known.join(live, "node", "left_semi"), f"known-{rounds}")
        rounds += 1
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node")))
    classes = (
        members.groupBy("node").agg(F.min("doc_id").alias("class_id"), F.first("n").alias("n"))
        .join(found, "node", "left")
        .join(ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links")), "node", "left")
        .select("node", "class_id", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    least = classes.groupBy("root").agg(F.min("class_id").alias("component_id"))
    classes = stages.write(classes.join(least, "root").select("node", "root", "class_id", "component_id", "n_links"), "classes")
    stages.drop("posted", "star", "pairs", "judged", "known", "texts", "sketched", *[f"{x}-{k}" for k in range(rounds + 1) for x in ("rest", "best", "tried", "known")])
    alone = F.col("n") == 0
    return members.join(classes, "node").select(
        "doc_id",
        "row",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "n_links",
        "root",
    )


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs, all their columns, but one alone of each component: that of the smallest
    doc_id (nulls last), then of the smallest hash of its text.  Empty texts stay, each once by doc_id."""
    found = jaccard_components(docs, **settings)
    group = F.when(F.col("n_shingles") > 0, F.col("root"))
    # texts without words stand for themselves
    alone = F.when(group.isNull(), F.col("row"))
    kept = found.groupBy(group.alias("g"), alone.alias("s")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"))
    (key,) = spare(docs, "row")
    kept = kept.select(F.col("best.row").alias(key)).distinct()
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # equal rows lie side by side after the join
    one = docs.withColumn(key, row).join(kept, key, "left_semi").dropDuplicates([key])
    return one.select(*[F.col(f"`{c}`") for c in docs.columns])


def _across(percent: int, slots: int):
    """The function of a bucket's lists that gives their pairs of different components that may link and are not
    tried: for each text the likeliest of each of ``slots`` hash classes of its partners."""
    near = 1 - percent / 100 + 1e-9

    def likeliest(key: np.ndarray, apart: np.ndarray, lists: np.ndarray, nodes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """The pairs (a * len(nodes) + b) that are the best of a slot of one of their texts, each once."""
        key, at, to = np.unique(key, return_index=True, return_inverse=True)
        apart, lists = apart[at], np.bincount(to, weights=lists, minlength=len(key)).astype(np.int64)
        a, b = key // max(len(nodes), 1), key % max(len(nodes), 1)
        own, partner, pair = np.concatenate([a, b]), np.concatenate([b, a]), np.tile(np.arange(len(key)), 2)
        slot = (W.mix(nodes[partner].view(_U)) % _U(slots)).astype(np.int64)
        by = np.lexsort((pair, -lists[pair], apart[pair] / (size[own] + size[partner]), slot, own))
        opens = np.ones(len(by), dtype=bool)
        opens[1:] = (own[by][1:] != own[by][:-1]) | (slot[by][1:] != slot[by][:-1])
        use = np.unique(pair[by[opens]])
        return key[use], apart[use], lists[use]

    def across(table: pa.Table) -> pa.Table:
        name, node, n, root, hub, far, early = (table.column(c).to_numpy() for c in ("name", "node", "n", "root", "hub", "far", "early"))
        nodes, first, own = np.unique(node, return_index=True, return_inverse=True)
        size = n[first].astype(np.int64)
        bits, _ = W.buffer_of(table.column("sketch").take(pa.array(first)))
        bits = np.frombuffer(bits.tobytes(), dtype=_U).reshape(-1, SKETCH // 64)
        lists = table.column("tried").take(pa.array(first)).combine_chunks()
        partner = lists.flatten().to_numpy()
        a = np.repeat(np.arange(len(nodes)), lists.value_lengths().fill_null(0).to_numpy())
        b = np.minimum(np.searchsorted(nodes, partner), len(nodes) - 1)
        here = nodes[b] == partner
        tried = np.sort(a[here] * len(nodes) + b[here])
        by = np.lexsort((node, n, name))
        name, node, n, root, hub, far, early, own = name[by], node[by], n[by].astype(np.int64), root[by], hub[by], far[by], early[by], own[by]
        at = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        ends = np.append(at[1:], len(name))
        mixed = np.minimum.reduceat(root, at) != np.maximum.reduceat(root, at)
        end_of = np.repeat(ends, ends - at)
        # partners stand behind, in the list, up to the largest size allowed; the smaller set has the n-gram early
        pos = np.flatnonzero(np.repeat(mixed, ends - at) & early)
        reach = _reach(name, n, pos, end_of, percent)
        spans = np.maximum(reach - pos - 1, 0)
        cuts = np.searchsorted(np.cumsum(spans), np.arange(0, int(spans.sum()) + STEP, STEP)) if len(spans) else [0]
        none = np.zeros(0, dtype=np.int64)
        got, held = [(none, none, none)], 0
        for i, j in zip(cuts, [*cuts[1:], len(pos)], strict=True):
            x = np.repeat(pos[i:j], spans[i:j])
            y = W.ranges(pos[i:j] + 1, spans[i:j])
            use = root[x] != root[y]
            x, y = x[use], y[use]
            use = (hub[x] != hub[y]) | (np.abs(far[x] - far[y]) <= near)
            # the partner may be the other's hub, and then their distance is known
            use &= ~((hub[x] == node[y]) & (far[x] > near)) & ~((hub[y] == node[x]) & (far[y] > near))
            x, y = x[use], y[use]
            # linked sets differ in at most (100 - percent) / (100 + percent) of their sizes' sum
            apart = np.zeros(len(x), dtype=np.int64)
            for part in np.array_split(np.arange(len(x)), len(x) // (STEP >> 3) + 1):
                apart[part] = np.bitwise_count(bits[own[x[part]]] ^ bits[own[y[part]]]).sum(axis=1, dtype=np.int64)
            use = apart * (100 + percent) <= (100 - percent) * (n[x] + n[y])
            x, y, apart = own[x[use]], own[y[use]], apart[use]
            key = np.minimum(x, y) * len(nodes) + np.maximum(x, y)
            if len(tried):
                use = tried[np.minimum(np.searchsorted(tried, key), len(tried) - 1)] != key
                key, apart = key[use], apart[use]
            got.append((key, apart, np.ones(len(key), dtype=np.int64)))
            held += len(key)
            if held >= 4 * STEP:
                got = [likeliest(*(np.concatenate(x) for x in zip(*got, strict=True)), nodes, size)]
                held = 0
        key, apart, lists = likeliest(*(np.concatenate(x) for x in zip(*got, strict=True)), nodes, size)
        a, b = key // len(nodes), key % len(nodes)
        return pa.table({"a": nodes[a], "b": nodes[b], "na": size[a], "nb": size[b], "apart": apart, "lists": lists})

    return across


def _reach(name: np.ndarray, n: np.ndarray, pos: np.ndarray, end_of: np.ndarray, percent: int) -> np.ndarray:
    """For each position of the ordered lists, the end of the list's part whose sizes are
    at most 100 / percent times the own one (by bisection, all positions at once)."""
    low, high = pos + 1, end_of[pos].copy()
    most = n[pos] * 100 // percent
    while np.any(low < high):
        mid = (low + high) // 2
        up = (low < high) & (n[np.minimum(mid, len(n) - 1)] <= most)
        down = (low < high) & ~up
        low = np.where(up, mid + 1, low)
        high = np.where(down, mid, high)
    return low
