"""Toxicity by a classifier with counterfactual regularisation.

A logistic model on words and their first bytes learns from labelled texts
(a feature's value is log(1 + its count in the text)).  For every training text that mentions an identity group, a second copy has each identity
term swapped for another one of its list, and the training penalises the
squared difference of the two scores.  So the model can't lean on the mention
of a group: a neutral mention is scored as the same sentence about another.

Learning is on the driver, from a bounded sample (``sample`` labelled rows, by
smallest hash of doc_id); features are counted and chosen from sums made on
Spark, and only the chosen ones' values come to the driver.  Scoring covers every
whole text in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import words as W
from tillroll.llm.tables import plain

_U = np.uint64
SAMPLE = 20_000
FEATURE_BITS = 20
#: Besides the whole word, its first bytes are features: inflected forms share them.
STEMS = (5, 6, 7, 8)
#: A feature must stand in so many training texts, and tell the classes apart by so many standard errors.
MIN_TEXTS, MIN_Z = 5, 4.0
MAX_FEATURES = 4096
RIDGE, FAIRNESS, ROUNDS = 0.01, 1.0, 400
LIMIT = 0.7

# Identity terms; a term is swapped for the next one of its list.
IDENTITY = [
    ["man", "woman"], ["men", "women"], ["boy", "girl"], ["boys", "girls"], ["he", "she"], ["his", "her"], ["male", "female"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"], ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino"], ["gay", "straight", "lesbian", "bisexual"], ["immigrant", "citizen"], ["immigrants", "citizens"],
    ["homme", "femme"], ["hommes", "femmes"], ["chrétien", "musulman", "juif"], ["mann", "frau"], ["männer", "frauen"],
    ["christ", "moslem", "jude"], ["hombre", "mujer"], ["hombres", "mujeres"], ["cristiano", "musulmán", "judío"],
]


def _swaps(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    pairs = sorted((W.word_hash(a), W.word_hash(b)) for x in lists for a, b in zip(x, [*x[1:], x[0]], strict=True))
    return np.array([a for a, _ in pairs], dtype=_U), np.array([b for _, b in pairs], dtype=_U)


def features(texts: pa.Array) -> W.Words:
    """Words of letters and digits, A-Z folded."""
    return W.words_of(texts, fold=True, separators=W.NON_ALNUM)


def _named(names: np.ndarray, length: int) -> np.ndarray:
    return W.mix(names + _U(length)) >> _U(64 - FEATURE_BITS)


def _all_features(words: W.Words, names: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) of each word, then of each longer word's stems; ``names`` stand for the words."""
    owner = words.owner
    changed = np.zeros(len(owner), dtype=bool) if names is None else names != words.hash
    yield owner, _named(words.hash if names is None else names, 0)
    for length in STEMS:
        long = np.flatnonzero((words.end - words.start > length) & ~changed)
        start = words.start[long]
        yield owner[long], _named(W.span_hashes(words.buf, start, start + length, fold=True), length)


def _counted(pairs: Iterator[tuple[np.ndarray, np.ndarray]], chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of the distinct pairs; only of chosen features, if these are given."""
    got = []
    for owner, found in pairs:
        if chosen is not None:
            at = np.minimum(np.searchsorted(chosen, found), len(chosen) - 1)
            use = chosen[at] == found
            owner, found = owner[use], found[use]
        got.append((owner.astype(_U) << _U(FEATURE_BITS)) | found)
    pair, n = np.unique(np.concatenate(got), return_counts=True)
    return (pair >> _U(FEATURE_BITS)).astype(np.int64), pair & _U((1 << FEATURE_BITS) - 1), np.log1p(n)


@dataclass
class Model:
    """Weights of the chosen word features, and the intercept."""

    chosen: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, words: W.Words) -> np.ndarray:
        n = len(words.first) - 1
        logits = np.full(n, self.intercept)
        if len(self.chosen):
            owner, found, value = _counted(_all_features(words), self.chosen)
            logits += np.bincount(owner, weights=value * self.weights[np.searchsorted(self.chosen, found)], minlength=n)
        return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


Features = tuple[np.ndarray, np.ndarray]


def choose(names: np.ndarray, texts: np.ndarray, toxic: np.ndarray, n: int, positive: int) -> np.ndarray:
    """The features, in order, that tell best; of each one the texts and the toxic ones that have it, out of n and positive."""
    by = np.argsort(names)
    names, texts, toxic = names[by], texts[by], toxic[by]
    p1, p0, p = toxic / positive, (texts - toxic) / (n - positive), texts / n
    z = (p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / positive + 1 / (n - positive)))
    strong = np.flatnonzero((texts >= MIN_TEXTS) & (np.abs(z) >= MIN_Z))
    strong = np.sort(strong[np.argsort(-np.abs(z[strong]), kind="stable")[:MAX_FEATURES]])
    return names[strong]


def fit(rows: list[tuple[int, Features, Features | None]], chosen: np.ndarray) -> Model:
    """From (label, (features, values), those of the swapped copy or None) by row."""
    label = np.array([r[0] for r in rows], dtype=float)
    n, positive = len(rows), int(label.sum())

    def sparse(parts: list[Features]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(parts)), [len(x[0]) for x in parts])
        flat, value = (np.concatenate([x[k] for x in parts]) if parts else np.zeros(0) for k in (0, 1))
        col = np.minimum(np.searchsorted(chosen, flat), max(len(chosen) - 1, 0))
        use = chosen[col] == flat if len(chosen) else np.zeros(len(flat), dtype=bool)
        return row[use], col[use], value[use]

    def times(x: tuple, w: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(x[0], weights=w[x[1]] * x[2], minlength=n)

    def back(x: tuple, g: np.ndarray) -> np.ndarray:
        return np.bincount(x[1], weights=g[x[0]] * x[2], minlength=len(chosen))

    swapped = [i for i, r in enumerate(rows) if r[2] is not None]
    own, before, after = sparse([r[1] for r in rows]), sparse([rows[i][1] for i in swapped]), sparse([rows[i][2] for i in swapped])
    # both classes weigh the same; Adam steps over all rows
    balance = np.where(label > 0, n / (2 * positive), n / (2 * (n - positive))) / n
    w, b = np.zeros(len(chosen)), 0.0
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for k in range(1, ROUNDS + 1):
        f = b + times(own, w, n)
        g = balance * (1 / (1 + np.exp(-np.clip(f, -40, 40))) - label)
        grad = back(own, g) + RIDGE * w / max(len(chosen), 1)
        if swapped:
            gap = (times(before, w, len(swapped)) - times(after, w, len(swapped))) * 2 * FAIRNESS / len(swapped)
            grad += back(before, gap) - back(after, gap)
        full = np.append(grad, g.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        step = 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(chosen, w, float(b))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, identity: list[list[str]] | None = None) -> Model:
    """Learn from at most ``sample`` rows of labels (doc_id, toxic) whose text is in docs (doc_id, text).

    Rows with a null doc_id or label teach nothing.  The bound makes the labels
    small enough to send to all tasks; the chosen features' values come to the driver.
    """
    docs, labels = plain(docs, doc_id="long", text="string"), plain(labels, doc_id="long", toxic="int")
    few = labels.where("doc_id is not null and toxic is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    old, new = _swaps(identity if identity is not None else IDENTITY)

    taught = docs.join(F.broadcast(few), "doc_id").select("text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches):
            owner, found, _ = _counted(_all_features(features(piece.column("text"))))
            names, at = np.unique(found, return_inverse=True)
            label = piece.column("toxic").to_numpy()[owner]
            sums = (np.bincount(at, weights=x, minlength=len(names)).astype(np.int64) for x in (np.ones(len(at)), label))
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), *map(pa.array, sums)], names=["feature", "texts", "toxic"])

    n, positive = taught.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if positive in (0, n):  # one class tells nothing
        return Model(np.zeros(0, _U), np.zeros(0), float(np.log((positive + 1) / (n - positive + 1))))
    counted = taught.mapInArrow(count, "feature long, texts long, toxic long").groupBy("feature").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))
    counted = counted.where(F.col("texts") >= MIN_TEXTS).toArrow()  # at most 2**FEATURE_BITS rows
    names, texts, toxic = (counted.column(c).to_numpy() for c in ("feature", "texts", "toxic"))
    chosen = choose(names.view(_U), texts, toxic, n, positive)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches):
            words = features(piece.column("text"))
            at = np.minimum(np.searchsorted(old, words.hash), len(old) - 1)
            hit = old[at] == words.hash
            mention = W.sums_by_text(hit, words.first) > 0
            columns = [piece.column("toxic")]
            for names in (None, np.where(hit, new[at], words.hash)):
                owner, found, value = _counted(_all_features(words, names), chosen)
                cut = np.searchsorted(owner, np.arange(piece.num_rows + 1))
                for x in (found.astype(np.uint32), value.astype(np.float32)):
                    blobs = [x[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)]
                    columns.append(pa.array([y if names is None or m else None for y, m in zip(blobs, mention, strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "a", "av", "b", "bv"])

    schema = "toxic int, a binary, av binary, b binary, bv binary"
    rows = taught.mapInArrow(read, schema).collect() if len(chosen) else [(label, b"", b"", None, None) for (label,) in taught.select("toxic").collect()]

    def of(x: bytes | None, values: bytes) -> Features | None:
        return None if x is None else (np.frombuffer(x, np.uint32).astype(_U), np.frombuffer(values, np.float32))

    rows = sorted(rows, key=lambda r: (r[0], *(x or b"" for x in r[1:])))
    return fit([(label, of(a, av), of(b, bv)) for label, a, av, b, bv in rows], chosen)


def score_toxicity(docs: DataFrame, model: Model, limit: float = LIMIT) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= limit), one row for each row of docs.

    Reads doc_id and text, whole texts.  Null and empty texts have no feature
    and get the intercept's score.  Repeated rows give a row each; a null doc_id
    stays null; an empty table gives an empty result.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches):
            score = model.scores(features(piece.column("text")))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(score), pa.array((score >= limit).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )

    return plain(docs, doc_id="long", text="string").mapInArrow(judge, "doc_id long, score double, predicted int")
