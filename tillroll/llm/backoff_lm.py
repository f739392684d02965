"""Language-model scores by a weighted backoff automaton.

Counted n-grams become states.  A state is a context of up to ``order`` - 1
words; it has an arc for each word that followed it often enough, and a
failure arc to the context without its first word.  With absolute discounting
an arc of count c out of a state of count n holds (c - D) / n, and the failure
arc holds what the state's arcs leave: p(w | state) = arc + failure * p(w |
shorter state), down to the unigram (c + 1) / (N + V + 1) with one place for
all unseen words.  The probabilities of a state sum to 1.

A state or an arc is kept if its count over all training texts is at least
``LEAST``, whatever the input's size, so the model grows with the input.  It is
never in one place: n-grams, arcs and failure weights are written tables.  Where
a token has no arc, log p is the failure's log plus that of the shorter context,
so a text's score is a sum over its n-grams of one value each: log p less what
the shorter contexts give, and the n-gram's own log failure for the token behind
it.  Each text's n-grams travel to hash buckets in packed rows, meet the values
there, and the text's sums travel on, level by level.  The commonest n-grams do not travel: an
n-gram is common if it makes up at least one in ``COMMON`` of the tokens, so
there are at most ``COMMON`` of each length, and every task has their values.

Tasks know kept n-grams by a bit table of fixed size; a false hit costs a
needless entry and never changes a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import packed
from tillroll.llm import words as W
from tillroll.llm.tables import Stages, buckets, plain

_U = np.uint64
ORDER = 3
LEAST = 2
DISCOUNT = 0.75
END, START = W.mix(np.array([2, 3], _U))
#: The bit table has 2**(FILTER_BITS + 6) bits.
FILTER_BITS = 21
#: An n-gram that makes up one in so many tokens is common.
COMMON = 1 << 17
#: Common n-grams are found in one look in 2**SLOT_BITS slots.
SLOT_BITS = 20
#: Entries that a task holds before it sends them (n-grams have two names and weights, so fewer than ``packed.FLUSH``).
HELD = 400_000
#: Text that a task takes at once.
PIECE_BYTES = 1 << 20


class Common:
    """c and value of the common n-grams.  Of those that share a slot one is found; the others travel."""

    def __init__(self, rows: pa.Table):
        key = rows.column("key").to_numpy().view(_U)
        self.key, _, self.c = _added(key, rows.column("c").to_numpy())
        self.value = _added(key, rows.column("value").to_numpy())[2]
        self.slots = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        self.slots[self.key >> _U(64 - SLOT_BITS)] = np.arange(len(self.key))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the keys are found, the places of those)."""
        if not len(self.key):
            return np.zeros(len(keys), dtype=bool), np.zeros(0, np.int32)
        at = self.slots[keys >> _U(64 - SLOT_BITS)]
        hit = self.key[at] == keys
        return hit, at[hit]


@dataclass
class Model:
    """values[k]: a table (key, n, c, value) of the kept n-grams of k + 1 words, where c and value of a key's rows add up;
    filters[k]: their bit table; common[k]: the common ones; total and types of the training tokens."""

    total: int
    types: int
    values: list[DataFrame]
    filters: list[np.ndarray]
    common: list[Common]


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(names, bounds by text): a start, the words, A-Z folded, and an end."""
    words = W.words_of(texts, fold=True)
    at = np.stack([words.first[:-1], words.first[1:]], axis=1).ravel()
    names = np.insert(words.hash, at, np.tile([START, END], len(at) // 2))
    return names, words.first + 2 * np.arange(len(words.first))


def _maybe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False for keys that are surely not kept."""
    return (bits[keys >> _U(64 - FILTER_BITS)] >> ((keys >> _U(58 - FILTER_BITS)) & _U(63))) & _U(1) > 0


def _runs(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal neighbours begin."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])[: len(x)])


def _added(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, place of one of its entries, sum of n) of the distinct keys."""
    by = np.argsort(key)
    key = key[by]
    first = _runs(key)
    return key[first], by[first], np.add.reduceat(n[by], first, dtype=n.dtype) if len(key) else n


def _filter(kept: DataFrame) -> np.ndarray:
    """The bit table of the keys, put together by ranges of its words."""
    low = FILTER_BITS - 6

    def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, out = np.zeros(1 << FILTER_BITS, dtype=_U), packed.Packer(64, ("place", "bits"))
        for batch in batches:
            key = batch.column("key").to_numpy().view(_U)
            np.bitwise_or.at(bits, key >> _U(64 - FILTER_BITS), _U(1) << ((key >> _U(58 - FILTER_BITS)) & _U(63)))
        place = np.flatnonzero(bits)
        yield from out.add(place >> low, place.astype(np.uint32), bits[place])
        yield from out.flush()

    def joined(table: pa.Table) -> pa.Table:
        place, found = packed.unpack(table, "place", np.uint32), np.zeros(1 << low, dtype=_U)
        np.bitwise_or.at(found, place & np.uint32((1 << low) - 1), packed.unpack(table, "bits", _U))
        return pa.table({"bucket": table.column("bucket").slice(0, 1), "bits": pa.array([found.tobytes()], pa.binary())})

    ranges = kept.select("key").mapInArrow(bits_of, packed.schema(("place", "bits")))
    got = ranges.groupBy("bucket").applyInArrow(joined, packed.schema(("bits",))).toArrow()  # 64 rows, 2**FILTER_BITS words in all
    bits = np.zeros((64, 1 << low), dtype=_U)
    for at, words in zip(got.column("bucket").to_pylist(), got.column("bits").to_pylist(), strict=True):
        bits[at] = np.frombuffer(words, _U)
    return bits.ravel()


def _grams(names: np.ndarray, bounds: np.ndarray, level: int, filters: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """For 1 to level + 1 tokens: (place, key, prefix, suffix) of the n-grams that end at each place and may be kept by
    their parts; a word is its own prefix and suffix."""
    place, keys = np.arange(len(names)), names
    yield place, keys, keys, keys
    opens = np.zeros(len(names), dtype=bool)
    opens[bounds[:-1]] = True
    for k in range(1, level + 1):
        # the n-grams before stand at ``place``; two neighbours of one text that may be kept make a longer one
        may = _maybe(filters[k - 1], keys)
        may[1:] &= may[:-1] & (place[1:] == place[:-1] + 1)
        may[:1] = False
        may &= ~opens[place]
        at = np.flatnonzero(may)
        place, prefix, suffix = place[at], keys[at - 1], keys[at]
        keys = W.mix(prefix * _U(0xD6E8FEB86659FD93) + suffix + _U(k))
        yield place, keys, prefix, suffix


def train(docs: DataFrame, stages: Stages, order: int = ORDER, least: int = LEAST, discount: float = DISCOUNT, common: int = COMMON) -> Model:
    """The model of the rows of docs (text)."""
    spark = docs.sparkSession
    count = buckets(spark)
    names = ("key", "prefix", "suffix", "n")

    def totals(level: int, filters: list[np.ndarray], least: int) -> DataFrame:
        """A written table: key, prefix, suffix, n of the n-grams that are counted ``least`` times."""
        shared = spark.sparkContext.broadcast(filters)

        columns = ("prefix", "n") if not level else names[1:]

        def sent(out: packed.Packer, held: list[tuple[np.ndarray, ...]], last: bool) -> Iterator[pa.RecordBatch]:
            """Distinct n-grams of what is held, once that is much, by prefix: equal ones side by side pack well."""
            if not held or not (last or sum(len(x[0]) for x in held) >= HELD):
                return
            key, *parts = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            if level:
                # one sort for both: equal keys are neighbours, but for a few that meet others' halves and stay apart
                low = _U((1 << 32) - 1)
                by = np.argsort((parts[0] & ~low) | (key >> _U(32)))
                key = key[by]
                first = _runs(key)
                at, key, n = by[first], key[first], np.diff(np.append(first, len(key)))
                parts = [x[at] for x in parts]
            else:
                key, _, n = _added(key, parts[0])
                parts = [key]
            yield from out.add((W.mix(key) % _U(count)).astype(np.int64), *parts, n.astype(np.uint32))
            yield from out.flush()

        def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, held = packed.Packer(count, columns), []
            for piece in W.pieces(batches, limit=PIECE_BYTES):
                tokens, bounds = _tokens(piece.column("text"))
                *_, (_, key, prefix, suffix) = _grams(tokens, bounds, level, shared.value)
                if level:
                    if len(key):
                        held.append((key, prefix, suffix))
                else:
                    key = key[key != START]
                    key, _, n = _added(key, np.ones(len(key), dtype=np.int64))
                    held.append((key, n))
                yield from sent(out, held, False)
            yield from sent(out, held, True)

        def added(table: pa.Table) -> pa.Table:
            prefix, n = packed.unpack(table, "prefix", _U), packed.unpack(table, "n", np.uint32)
            suffix = packed.unpack(table, "suffix", _U) if level else prefix
            key = W.mix(prefix * _U(0xD6E8FEB86659FD93) + suffix + _U(level)) if level else prefix
            key, at, n = _added(key, n.astype(np.int64))
            use = n >= least
            key, at, n = key[use], at[use], n[use]
            return pa.table({c: x.view(np.int64) for c, x in zip(names, (key, prefix[at], suffix[at], n), strict=True)})

        summed = docs.mapInArrow(entries, packed.schema(columns)).groupBy("bucket").applyInArrow(added, "key long, prefix long, suffix long, n long")
        table = stages.write(summed, f"grams-{level}") if level else stages.write(summed.select("key", "n"), "words")
        shared.destroy()
        return table

    words = totals(0, [], 1)
    total, types, texts = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("key") == int(END.view(np.int64)), F.col("n"))), F.lit(0))
    ).first()
    opening = spark.createDataFrame([(int(START.view(np.int64)), int(texts))], "key long, n long")
    # n, c of a word, and what the n-gram adds to the logarithm of the shorter context's
    none = F.lit(0).cast("long").alias("c")
    known = words.select("key", "n", F.col("n").alias("c"), F.lit(0.0).alias("delta")).unionByName(opening.select("key", "n", none, F.lit(0.0).alias("delta")))
    states = words.where(F.col("n") >= least).unionByName(opening).withColumn("p", (F.col("n") + 1) / F.lit(float(total + types + 1)))
    model = Model(int(total), int(types), [], [], [])
    for level in range(1, order):
        model.filters.append(_filter(states))
        grams = totals(level, list(model.filters), least)
        held = grams.groupBy(F.col("prefix").alias("key")).agg(F.sum(F.col("n") - F.lit(discount)).alias("held"))
        failures = stages.write(held.join(states, "key").select("key", F.col("n").alias("of"), (1 - F.col("held") / F.col("n")).alias("failure")), f"failures-{level}")
        shorter = states.select(F.col("key").alias("suffix"), F.col("p").alias("short"))
        arcs = grams.join(failures.withColumnRenamed("key", "prefix"), "prefix").join(shorter, "suffix")
        arcs = arcs.withColumn("p", (F.col("n") - F.lit(discount)) / F.col("of") + F.col("failure") * F.col("short"))
        arcs = arcs.withColumn("delta", F.log10(F.col("p") / (F.col("failure") * F.col("short"))))
        arcs = stages.write(arcs.select("key", "n", "delta", *(["p"] if level < order - 1 else [])), f"arcs-{level}")
        stages.drop(f"grams-{level}")
        leave = failures.select("key", F.col("of").alias("n"), none, F.coalesce(F.log10("failure"), F.lit(0.0)).alias("delta"))
        model.values.append(_valued(known.unionByName(leave)))
        stages.release()
        known, states = arcs.select("key", "n", none, "delta"), arcs.drop("delta")
    model.filters.append(_filter(states))
    model.values.append(_valued(known))
    for values in model.values:
        model.common.append(Common(values.where(F.col("n") * common >= model.total).drop("n").toArrow()))  # at most ``common`` keys
    return model


def _valued(known: DataFrame) -> DataFrame:
    return known.select("key", "n", "c", F.col("delta").alias("value"))


def score_documents(
    docs: DataFrame, learn: str = "true", order: int = ORDER, least: int = LEAST, discount: float = DISCOUNT, common: int = COMMON
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, one row for each row of docs.

    Reads doc_id and text.  Rows for which the SQL condition ``learn`` holds
    teach, the others are held out (null counts as held out).  Tokens are the
    words, parted by ASCII blanks, A-Z folded, and one end; null text counts as
    empty (its end alone).  n_known counts tokens seen in training;
    train_tokens is their number.  base_score sums log10((c + 1) / (N + V + 1)),
    score is the model's log10 probability of the text.  Repeated rows give a row
    each; a null doc_id stays null; an empty table gives an empty result; with no
    training rows every token is unseen.  Other columns are not read.
    """
    spark = docs.sparkSession
    stages, count = Stages(spark, "lm"), buckets(spark)
    docs = plain(docs, doc_id="long", text="string")
    docs = docs.withColumn("learn", F.coalesce(F.expr(learn), F.lit(False))).withColumn("row", F.xxhash64("doc_id", "text"))
    model = train(docs.where("learn").select("text"), stages, order, least, discount, common)
    scale = float(np.log10(model.total + model.types + 1.0))
    shared = spark.sparkContext.broadcast((model.filters, model.common))

    def sums_of(level: int) -> DataFrame:
        # only words are counted; an n-gram adds to the score alone
        columns = ("score",) if level else ("n_tokens", "times", "n_known", "base", "score")
        sent, answers = ("key", "value") if level else ("key", "c", "value"), ("doc", *columns)
        schema = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in answers]])
        asking = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("name", *answers)]])

        def parts(value: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
            """What n-grams add to the columns that are looked up."""
            return [value] if level else [(c > 0).astype(np.float64), np.log10(c + 1.0), value]

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = packed.Packer(count, sent)
            for batch in batches:
                key, *rest = (batch.column(name).to_numpy() for name in sent)
                key = key.view(_U)
                yield from out.add((W.mix(key) % _U(count)).astype(np.int64), key, *rest)
                if out.size >= HELD:
                    yield from out.flush()
            yield from out.flush()

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The n-grams to look up, and in rows without names each text's sums over the common ones."""
            out, own = packed.Packer(count, ("name", "doc")), packed.Packer(count, answers)
            filters, common = shared.value
            adds = parts(common[level].value, common[level].c)

            def framed(batch: pa.RecordBatch) -> pa.RecordBatch:
                rows = [batch.column(c) if c in batch.schema.names else pa.nulls(batch.num_rows, pa.binary()) for c in asking.names]
                return pa.RecordBatch.from_arrays(rows, schema=asking)

            for piece in W.pieces(batches, limit=PIECE_BYTES):
                tokens, bounds = _tokens(piece.column("text"))
                docs, texts = piece.column("row").to_numpy(), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                sums = np.zeros((len(columns), len(docs)))
                if not level:
                    sums[0], sums[1] = np.diff(bounds) - 1, 1
                *_, (place, name, _, _) = _grams(tokens, bounds, level, filters)
                owner = texts[place]
                if level:
                    may = _maybe(filters[level], name)
                    owner, name = owner[may], name[may]
                hit, at = common[level].find(name)
                mine = owner[hit]
                first = _runs(mine)
                for k, add in enumerate(reversed(adds), 1):
                    sums[-k, mine[first]] += np.add.reduceat(add[at], first) if len(first) else 0
                owner, name = owner[~hit], name[~hit]
                yield from map(framed, out.add((W.mix(name) % _U(count)).astype(np.int64), name, docs[owner]))
                yield from map(framed, own.add((W.mix(docs.view(_U)) % _U(count)).astype(np.int64), docs, *sums))
                if out.size + own.size >= HELD:
                    yield from map(framed, (*out.flush(), *own.flush()))
            yield from map(framed, (*out.flush(), *own.flush()))

        def answer(asked: pa.Table, kept: pa.Table) -> pa.Table:
            """Each text's sums over the n-grams of a bucket, in rows packed by text."""
            key, found = packed.unpack(kept, "key", _U), []
            for name, kind in (("value", np.float64), ("c", np.int64))[: len(sent) - 1]:
                found.append(_added(key, packed.unpack(kept, name, kind))[2])
            # no n-gram of the bucket is kept: one without value stands there
            key, found = (_added(key, key)[0], found) if len(key) else (np.zeros(1, _U), [np.zeros(1)] * len(found))
            adds = parts(found[0], found[-1])
            out, batches = packed.Packer(count, answers), []
            # one packed row at a time: a text's n-grams were sent together
            for k in range(asked.num_rows):
                row = asked.slice(k, 1)
                doc = packed.unpack(row, "doc", np.int64)
                if row.column("name").null_count:
                    sums = [packed.unpack(row, c, np.float64) for c in columns]
                else:
                    name = packed.unpack(row, "name", _U)
                    by = np.argsort(name)  # sorted names are found faster, as their places are near each other
                    at = np.empty(len(name), dtype=np.int64)
                    at[by] = np.minimum(np.searchsorted(key, name[by]), len(key) - 1)
                    hit = key[at] == name
                    at, doc = at[hit], doc[hit]
                    first = _runs(doc)
                    sums = [np.add.reduceat(x[at], first) if len(first) else x[at] for x in adds]
                    doc = doc[first]
                    sums = [np.zeros(len(doc))] * (len(columns) - len(sums)) + sums
                batches.extend(out.add((W.mix(doc.view(_U)) % _U(count)).astype(np.int64), doc, *sums))
            return pa.Table.from_batches([*batches, *out.flush()], schema)

        def document_sums(table: pa.Table) -> pa.Table:
            docs, to = np.unique(packed.unpack(table, "doc", np.int64), return_inverse=True)
            values = [np.bincount(to, weights=packed.unpack(table, c, np.float64), minlength=len(docs)) for c in columns]
            return pa.table({"row": docs, **{c: x if c in ("base", "score") else x.astype(np.int64) for c, x in zip(columns, values, strict=True)}})

        asked = docs.select("text", "row").mapInArrow(ask, packed.schema(("name", *answers)))
        kept = model.values[level].select(*sent).mapInArrow(pack, packed.schema(sent))
        answered = asked.groupBy("bucket").cogroup(kept.groupBy("bucket")).applyInArrow(answer, packed.schema(answers))
        kinds = ", ".join(f"{c} {'double' if c in ('base', 'score') else 'long'}" for c in columns)
        return stages.write(answered.groupBy("bucket").applyInArrow(document_sums, f"row long, {kinds}"), f"sums-{level}")

    totals = None
    for level in reversed(range(order)):
        sums = sums_of(level)
        # every text has a start and an end, so the words' sums have all texts and tell how often each occurs
        sums = sums if level else sums.withColumn("base", F.col("base") - scale * F.col("n_tokens"))
        totals = sums if totals is None else totals.unionByName(sums, allowMissingColumns=True)
        # lower levels read the tables of their own and the failures of the next
        stages.release()
        stages.drop(*([f"arcs-{level}", f"failures-{level + 1}"] if level else ["words", "failures-1"]))
    shared.destroy()
    # equal rows of docs share a key: their sums are alike, so each has its part
    sums = totals.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score", "times")])
    return docs.select("doc_id", "learn", "row").join(sums, "row").select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        *[F.expr(f"{c} div times").alias(c) for c in ("n_tokens", "n_known")],
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("times")).alias("base_score"),
        ((F.col("base") + F.col("score")) / F.col("times")).alias("score"),
    )
