"""Each operator on a small table with nulls, empty and long texts, ties, repeated rows and clashing
columns, against brute force or DuckDB; and on an empty table."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tillroll.llm import queries as Q
from tillroll.llm.backoff_lm import score_documents
from tillroll.llm.decontaminate import clean_documents, contaminated
from tillroll.llm.fertility import LANGUAGES, SCRIPTS, keep_good, measure, relative_entropy
from tillroll.llm.jaccard import _across, jaccard_components, odd_sketches, one_of_each
from tillroll.llm.licences import TEMPLATES, Notice, scan_licences
from tillroll.llm.mixture import mix_sources, mixed_documents
from tillroll.llm.recompress import remove_repeats
from tillroll.llm.sharding import _capacity, _cuts, Positions, minimax_cuts, shard_documents
from tillroll.llm.token_codes import Codes, encode, read_codes, write_codes
from tillroll.llm.toxicity import _named, score_toxicity, train
from tillroll.llm.words import word_hash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, hub string, size int"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma"


def _docs():
    texts = {
        0: PASSAGE + " one two three four five six seven eight nine ten eleven",
        1: "Something before. " + PASSAGE + " and after",
        2: "", 3: None, 4: "short text", 5: "SHORT text",
        6: LONG, 7: LONG + " tail", 8: "Ünïcode ſtraße 日本語 \x00 nul\x0bvt " * 9,
        9: "a a a a a a a a a a a a a a a a a a a a a a", 10: "a a a a a a a a a a a a a a a",
        11: "all rights reserved\nLicensed under the Apache License, Version 2.0\nall rights reserved\n",
        12: "idiot\n" + PASSAGE, 13: PASSAGE, 14: PASSAGE, None: "a row without an id " + PASSAGE,
    }
    rows = [(i, t, None if i == 4 else "en", [None, "s1", "s2"][(i or 0) % 3], 1, "x", "y", 3) for i, t in texts.items()]
    return rows + [rows[0], rows[4]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_docs(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _words(t, fold=False):
    t = t or ""
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t) if fold else t)


def _rows(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def _duck(sql, rows, items=()):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    if items:
        con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return [dict(zip(names, r, strict=True)) for r in cur.fetchall()]


def test_least_capacity_and_cuts_against_brute_force():
    rng = np.random.default_rng(5)

    def shards_needed(sizes, capacity):
        n, held = 0, None
        for s in sizes:
            if held is not None and held + s <= capacity:
                held += s
            else:
                n, held = n + 1, s
        return n

    for _ in range(60):
        sizes = rng.integers(16, 200, rng.integers(1, 60))
        if rng.random() < 0.4:
            sizes[rng.integers(len(sizes))] = sizes.sum()
        k, starts, total = int(rng.integers(1, 12)), np.cumsum(sizes) - sizes, int(sizes.sum())
        known = Positions(starts, starts, total)
        least = next(c for c in range(1, total + 1) if shards_needed(sizes, c) <= k)
        assert _capacity(known, k) == (least, least)
        cuts = [0, *[a for a, _ in _cuts(known, least, k)], total]
        for a, b in zip(cuts, cuts[1:], strict=False):
            assert b - a <= least or ((starts >= a) & (starts < b)).sum() == 1


def test_cuts_that_lie_in_thousands_of_separate_blocks(spark):
    # some 1900 ranges of starts are read again at once
    sizes = np.random.default_rng(0).lognormal(7, 1.1, 20_000).astype(int) + 17
    pos, total = np.cumsum(sizes) - sizes, int(sizes.sum())
    starts = spark.createDataFrame(pa.table({"pos": pos}))
    capacity, cuts = minimax_cuts(starts, total, 500)
    known = Positions(pos, pos, total)
    assert _capacity(known, 500) == (capacity, capacity)
    assert [(c, c) for c in cuts] == _cuts(known, capacity, 500)


def test_shards(docs, empty):
    rows = shard_documents(docs, 4).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in _docs())
    shard_of = {}
    for r in rows:
        assert shard_of.setdefault(r["text_crc32"], r["shard"]) == r["shard"]
        assert 0 <= r["shard"] < 4 and r["law"] == "bytes"
    for s in range(4):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    for t, size in (("short text", 26), (None, 16)):
        assert [r["size"] for r in rows if r["doc_id"] == (4 if t else 3)][0] == size
    assert shard_documents(empty, 4).count() == 0


def test_codes_round_trip():
    ids = np.random.default_rng(1).choice([0, 1, 255, 256, 65535, 65536, 2**24, 2**31], 3000)
    codes = Codes(*encode(ids))
    assert (codes.slice(0, 3000) == ids).all() and (codes.slice(700, 1900) == ids[700:1900]).all()
    assert all(codes[i] == ids[i] for i in range(0, 3000, 97))
    assert len(Codes(*encode(ids[:0])).slice(0, 0)) == 0


def test_token_codes_against_whole_text_encoding(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    write_codes(docs, f"{tmp_path}/ids", path, segment=500)
    got = read_codes(spark, f"{tmp_path}/ids").collect()
    rows = [r for r in _docs()]
    want = Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want[(r[0], len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in by_start] == list(np.cumsum([0, *[r["n_tokens"] for r in by_start[:-1]]]))
    ids = [r["doc_id"] for r in by_start if r["doc_id"] is not None]
    assert ids == sorted(ids)
    write_codes(empty, f"{tmp_path}/none", path)
    assert read_codes(spark, f"{tmp_path}/none").count() == 0


def test_licences(docs, empty):
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    rows = [r for r in dict.fromkeys(_docs()) if r[0] is not None]
    want = {tuple(r[n] for n in names) for r in _duck(Q.OP3_BASE, rows)}
    got = scan_licences(docs).collect()
    assert {tuple(r[n] for n in names) for r in got if r["doc_id"] is not None} == want and len(got) == len(_docs())
    (r,) = [r for r in got if r["doc_id"] == 11]
    assert (r["labels"], r["n_base"], r["score"]) == ("apache-2.0,reserved", 2, 1.0)
    assert scan_licences(empty).count() == 0


def test_jaccard(docs, empty):
    rows = [r for r in dict.fromkeys(_docs()) if r[0] is not None]
    names = ["doc_id", "n_shingles", "component_id"]
    want = {tuple(r[n] for n in names) for r in _duck(Q.OP4, rows)}
    got = jaccard_components(docs.where("doc_id is not null"))
    assert set(_rows(got, *names)) == want
    assert jaccard_components(docs).count() == len(_docs())
    kept = Counter(r["doc_id"] for r in one_of_each(docs).collect())
    assert kept[0] == 1 and kept[14] == 0 and kept[2] == 1 and kept[3] == 1
    assert jaccard_components(empty).count() == 0


def test_pairs_of_a_large_group_come_in_rounds():
    """150 texts that all may link: a round gives few pairs of each text, and all rounds give every pair once."""
    texts, size = 150, 40
    node = np.arange(texts, dtype=np.int64) * 1009 + 7
    # texts differ in one n-gram; each stands in two lists, each its own component
    names = np.concatenate([np.append(np.arange(size - 1), 10_000 + k) for k in range(texts)]).astype(np.uint64)
    sketch = odd_sketches(np.repeat(np.arange(texts), size), names, texts)
    tried, seen, slots = {int(x): None for x in node}, set(), 1
    while True:
        table = pa.table({
            "name": np.repeat(np.array([5, 6]), texts), "node": np.tile(node, 2), "n": np.full(2 * texts, size, dtype=np.int32),
            "early": np.ones(2 * texts, dtype=bool), "root": np.tile(node, 2), "hub": np.tile(node, 2), "far": np.zeros(2 * texts),
            "sketch": pa.array(sketch * 2, pa.binary()), "tried": pa.array([tried[int(x)] for x in node] * 2, pa.list_(pa.int64())),
        })
        got = _across(85, slots)(table).to_pylist()
        assert len(got) <= texts * slots and all(r["lists"] == 2 and r["na"] == r["nb"] == size for r in got)
        if not got:
            break
        for r in got:
            assert r["a"] < r["b"] and (r["a"], r["b"]) not in seen
            seen.add((r["a"], r["b"]))
            tried[r["a"]] = [*(tried[r["a"]] or []), r["b"]]
        slots *= 4
    assert len(seen) == texts * (texts - 1) // 2


def test_substring_dedup(docs, empty):
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    rows = [r for r in dict.fromkeys(_docs()) if r[0] is not None]
    want = {tuple(r[n] for n in names) for r in _duck(Q.OP5, rows)}
    got = remove_repeats(docs).collect()
    assert {tuple(r[n] for n in names) for r in got if r["doc_id"] is not None} == want and len(got) == len(_docs())
    assert [r["n_removed"] for r in got if r["doc_id"] is None] == [0]
    assert remove_repeats(empty).count() == 0


def test_quality(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = [r for r in dict.fromkeys(_docs()) if r[0] is not None and "\x00" not in (r[1] or "")]
    want = {tuple(r[n] for n in names) for r in _duck(Q.OP6_BASE, rows)}
    got = measure(docs, path).collect()
    assert {tuple(r[n] for n in names) for r in got if r["doc_id"] not in (None, 8)} == want and len(got) == len(_docs())
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert keep_good(docs, path).columns == docs.columns and keep_good(empty, path).count() == 0


def test_token_entropy_of_texts_of_any_length():
    rng = np.random.default_rng(5)

    def plain(ids):
        n = len(ids)
        return -sum(c / n * math.log2(c / n) for c in Counter(ids.tolist()).values()) / math.log2(n) if n > 1 else 0.0

    for n in (0, 1, 2, 50, 1023, 1024):
        ids = rng.zipf(1.3, n) % 5000
        assert math.isclose(relative_entropy(ids), plain(ids), abs_tol=1e-12)
    for n in (1025, 2049, 30_001):
        ids, k = rng.zipf(1.3, n) % 5000, math.ceil(n / 1024)
        parts = [ids[i * n // k : (i + 1) * n // k] for i in range(k)]
        assert math.isclose(relative_entropy(ids), sum(plain(p) * len(p) for p in parts) / n)
    # never beyond 1, and alike for a text and for many of its kind in a row
    assert math.isclose(relative_entropy(np.arange(100_000)), 1.0)
    mixed = [relative_entropy(rng.zipf(1.5, n) % 5000) for n in (1024, 4096, 65_536)]
    assert max(mixed) - min(mixed) < 0.05


def test_quality_verdict_against_plain_python(spark, docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    coder = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {(r["doc_id"], r["n_words"]): r for r in measure(docs, path).collect()}
    for i, t, lang, *_ in _docs():
        words = _words(t)
        ids = [x for w in words for x in coder.encode(w)]
        r = got[i, len(words)]
        n = max(len(ids), 1)
        assert math.isclose(r["chars_per_token"], sum(map(len, words)) / n)
        assert math.isclose(r["byte_share"], sum(coder.is_byte(x) for x in ids) / n)
        assert math.isclose(r["token_entropy"], relative_entropy(np.array(ids, dtype=np.int64)), abs_tol=1e-9)
        band = LANGUAGES.get(lang) or SCRIPTS["latin"]
        low, high = band.chars_per_token
        fine = low <= r["chars_per_token"] <= high and r["byte_share"] <= band.max_byte_share and r["token_entropy"] >= band.min_entropy
        assert r["kept"] == (fine and not r["base_failed"])


def test_toxicity(spark, empty):
    rows = [(i, f"the {g} walked home today number {i}" + (" awful vermin" if i % 4 == 0 else ""), i % 4 == 0)
            for i in range(200) for g in ["man" if i % 8 < 4 else "woman"]]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, "x")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, int(t)) for i, _, t in rows if i % 3] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in score_toxicity(docs, train(docs, labels)).collect()}
    assert all(got[i]["predicted"] == int(t) for i, _, t in rows) and got[None]["predicted"] == 0
    none = train(empty, labels)
    assert score_toxicity(docs, none).count() == 201 and score_toxicity(empty, none).count() == 0


def test_language_model(spark, docs, empty):
    learn = "doc_id % 5 <> 1"
    got = {(r["doc_id"], r["n_tokens"]): r for r in score_documents(docs, learn).collect()}
    rows = _docs()
    tokens = [[*_words(r[1], True), None] for r in rows]
    c = Counter(t for r, ts in zip(rows, tokens, strict=True) if r[0] is not None and r[0] % 5 != 1 for t in ts)
    n, v = sum(c.values()), len(c)
    for r, ts in zip(rows, tokens, strict=True):
        x = got[(r[0], len(ts))]
        assert x["train_tokens"] == n and x["n_known"] == sum(c[t] > 0 for t in ts)
        assert math.isclose(x["base_score"], sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), rel_tol=1e-9)
        assert x["score"] < 0
    # a bigram model of a tiny corpus, by hand
    tiny = spark.createDataFrame([(0, "a b"), (1, "a b"), (2, "a c")], "doc_id long, text string")
    x = {r["doc_id"]: r["score"] for r in score_documents(tiny, "true", order=2).collect()}
    p1 = {"a": 4 / 14, "b": 3 / 14, "c": 2 / 14, None: 4 / 14}  # N = 9 tokens, V = 4 types
    first = (3 - 0.75) / 3 + 0.75 / 3 * p1["a"]
    b = (2 - 0.75) / 3 + (1 - 1.25 / 3) * p1["b"]
    end = (2 - 0.75) / 2 + (1 - 1.25 / 2) * p1[None]
    assert math.isclose(x[0], math.log10(first * b * end), rel_tol=1e-9)
    assert math.isclose(x[2], math.log10(first * (1 - 1.25 / 3) * p1["c"] * p1[None]), rel_tol=1e-9)
    assert score_documents(empty, learn).count() == 0 and score_documents(docs, "false").count() == len(rows)


def test_decontamination(spark, docs, empty):
    items = [(1, PASSAGE), (2, "Short TEXT"), (3, None), (4, ""), (5, "no such text in any of the documents at all"), (None, "alpha beta gamma delta epsilon zeta")]
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = [r for r in dict.fromkeys(_docs()) if r[0] is not None]
    names = ["doc_id", "item_id", "n_shared", "n_item"]
    want = {tuple(r[n] for n in names) for r in _duck(Q.OP9, rows, [x for x in items if x[0] is not None])}
    for step in (20_000, 2):
        got = _rows(contaminated(docs, table, step=step), *names)
        assert {x for x in got if x[0] is not None and x[1] is not None} == want
    clean = clean_documents(docs, table)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {2, 3, 6, 7, 8, 9, 10, 11}
    assert contaminated(empty, table).count() == 0 and clean_documents(docs, empty.selectExpr("doc_id item_id", "text")).count() == len(_docs())


def test_short_benchmark_items_inside_longer_documents(spark):
    texts = ["question: What is TWO plus three", "what is", "is two", "two", "x what is two", "what two is", "", None, "what is two plus three four five " * 40]
    items = [(1, "what is two"), (2, "two"), (3, "what is two"), (4, "plus three"), (5, "is two plus three four"), (6, "what is two plus three four"), (7, " "), (8, None)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def grams(t, n):
        w = _words(t, True)
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    want = set()
    for i, t in enumerate(texts):
        for k, item in items:
            n = min(5, len(_words(item)))
            if n and 100 * len(grams(t, n) & grams(item, n)) >= 80 * len(grams(item, n)):
                want.add((i, k, len(grams(t, n) & grams(item, n)), len(grams(item, n))))
    names = ["doc_id", "item_id", "n_shared", "n_item"]
    for step in (20_000, 3):
        assert _rows(contaminated(table, bench, step=step), *names) == Counter(want)
    assert {x for x in want} == {tuple(r[n] for n in names) for r in _duck(Q.OP9, [(i, t, None, None) for i, t in enumerate(texts)], items)}
    clean = clean_documents(table, bench.where("item_id in (1, 4)"))
    assert {r["doc_id"] for r in clean.collect()} == {1, 2, 3, 5, 6, 7}


def test_mixture(docs, empty):
    names = ["doc_id", "source", "size", "source_size", "target", "times", "taken"]
    got = mix_sources(docs)
    want = _duck(Q.OP10, _docs())
    assert _rows(got.where("doc_id <> 0"), *names) == Counter(tuple(r[n] for n in names) for r in want if r["doc_id"] not in (0, None))
    assert all(0 <= r["times"] <= 2 for r in got.collect())
    times = sum(r["times"] for r in got.collect())
    assert mixed_documents(docs).count() == times and mixed_documents(docs).columns == docs.columns
    assert mix_sources(empty).count() == 0


def test_mixture_takes_no_text_more_often_than_its_cap(spark):
    # the small source is clamped at two times; half of its texts have no words
    rows = [(i, "" if i % 2 else f"word {i}", "a") for i in range(40)] + [(100 + i, f"long text of many words {i} " * 20, "b") for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(table).collect()
    assert {r["times"] for r in got if r["source"] == "a"} == {2} and all(r["times"] <= 2 for r in got)
    names = ["doc_id", "source", "size", "source_size", "target", "times", "taken"]
    want = _duck(Q.OP10, [(i, t, "en", s) for i, t, s in rows])
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(tuple(r[n] for n in names) for r in want)
    taken = Counter(r["doc_id"] for r in mixed_documents(table).collect())
    assert all(taken[r["doc_id"]] == r["times"] for r in got)


def test_columns_with_the_names_that_operators_use(spark):
    names = ["whole", "cut", "_row", "_text", "_lang", "_s", "_n", "of", "copy", "Row", "lot", "root", "node"]
    names = list(dict.fromkeys(names))
    rows = [(*r[:4], *[f"{n}-{k}" for n in names]) for k, r in enumerate(_docs()) if r[0] != 6 and r[0] != 7]
    table = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "lang string", "source string", *[f"`{n}` string" for n in names]]))
    items = spark.createDataFrame([(1, "no such text")], "item_id long, text string")
    everything = {tuple(r) for r in table.collect()}
    path = public_tokenizers.path("piece_bpe_32k.model")
    for out in (mixed_documents(table), one_of_each(table, width=5, percent=80), keep_good(table, path), clean_documents(table, items)):
        assert out.columns == table.columns
        assert {tuple(r) for r in out.collect()} <= everything
    assert {tuple(r) for r in clean_documents(table, items).collect()} == everything


def test_one_of_each_keeps_one_of_a_group_without_ids(spark):
    base = " ".join(f"word{i}" for i in range(100))
    rows = [(None, base), (None, base + " tail"), (None, base + " end"), (None, "another text of six words"), (None, None), (7, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r["text"] for r in one_of_each(table, width=5, percent=80).collect()]
    assert sum(1 for t in kept if t and t.startswith(base)) == 1 and len(kept) == 4


def _backoff(training, text, discount=0.75):
    """log10 probability of text by a trigram model of training (text: times), written down plainly."""
    grams = [Counter(), Counter(), Counter()]
    for t, times in training.items():
        ts = ["<s>", *_words(t, True), None]
        for k in range(3):
            for g, n in Counter(zip(*[ts[i:] for i in range(k + 1)])).items():
                grams[k][g] += n * times
    texts = grams[0].pop(("<s>",))
    n, v = sum(grams[0].values()), len(grams[0])
    held, used = Counter(), Counter()
    for k in (1, 2):
        for g, c in grams[k].items():
            if c >= 2:
                used[g[:-1]] += c - discount

    def p(context, w):
        if not context:
            return (grams[0][(w,)] + 1) / (n + v + 1)
        of = texts if context == ("<s>",) else grams[len(context) - 1][context]
        if of < 2:
            return p(context[1:], w)
        c = grams[len(context)][(*context, w)]
        return max(c - discount, 0) / of * (c >= 2) + (1 - used[context] / of) * p(context[1:], w)

    ts = ["<s>", *_words(text, True), None]
    return sum(math.log10(p(tuple(ts[max(0, i - 2) : i]), ts[i])) for i in range(1, len(ts)))


def test_language_model_keeps_rare_ngrams_of_a_large_corpus(spark):
    # 8.4 million tokens: a least count that grew with them would be 5 and lose the n-grams seen four times
    few = {"one rare phrase stands here": 4, "another Rare phrase stood here once": 2, "one rare word": 1, "": 3, "the the the rare phrase": 2}
    filler = "of the " * 140_000
    rows = [(t, k) for t, k in few.items()]
    small = spark.createDataFrame(rows, "text string, k int").selectExpr("text", "explode(sequence(1, k)) AS copy")
    large = spark.range(30).selectExpr("repeat('of the ', 140000) AS text", "cast(id AS int) AS copy")
    docs = small.unionByName(large).selectExpr("xxhash64(text, copy) AS doc_id", "text")
    got = {(r["n_tokens"], round(r["score"], 6)) for r in score_documents(docs).collect()}
    want = {(len(_words(t)) + 1, round(_backoff(few | {filler: 30}, t), 6)) for t in few}
    assert want <= got


@pytest.mark.parametrize("common", [0, 12, 1 << 17])
def test_language_model_is_the_same_with_any_share_of_common_ngrams(spark, common):
    # no n-gram, the commonest ones, or all are looked up in the task that reads the text; the rest travel
    texts = {"a b a b c": 3, "A b c d e": 2, "x y z once": 1, "": 2, "a b " * 60 + "end": 1, "Ü b c d": 4}
    rows = [(None if not t and k else 10 * i + k, t) for i, (t, n) in enumerate(texts.items()) for k in range(n)]
    asked = [*rows, (99, None), (99, None), (98, "new words a b new words"), rows[0]]
    learn = "coalesce(doc_id, 0) < 98"
    docs = spark.createDataFrame(asked, "doc_id long, text string").repartition(3)
    got = score_documents(docs, learn, common=common).collect()
    training = Counter(t for i, t in [*rows, rows[0]])
    words = Counter(w for t, n in training.items() for w in [*_words(t, True), None] for _ in range(n))
    n, v = sum(words.values()), len(words)

    def want(i, t):
        ts = [*_words(t or "", True), None]
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in ts)
        return i, (i or 0) >= 98, len(ts), sum(words[w] > 0 for w in ts), n, round(base, 8), round(_backoff(training, t or ""), 8)

    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    assert Counter(tuple(round(r[c], 8) if "score" in c else r[c] for c in columns) for r in got) == Counter(want(i, t) for i, t in asked)


def test_licence_blocks_across_lines_against_brute_force(spark):
    def names(t):
        return re.findall("[0-9a-z]+", t.lower())

    def brute(text):
        w, got, best = names(text), set(), 0.0
        for label, templates in TEMPLATES.items():
            for t in templates:
                words, deciding, barred = set(names(t.text)), set(names(t.deciding)), set(names(t.barred))
                reach, top = math.ceil(100 * len(names(t.text)) / 80), 0.0
                for i in range(len(w)):
                    block = []
                    for x in w[i : i + reach]:
                        if x in barred:
                            break
                        block.append(x)
                    if deciding <= set(block):
                        top = max(top, len(words & set(block)) / len(words))
                if 100 * round(top * len(words)) >= 80 * len(words):
                    got, best = got | {label}, max(best, top)
        return ",".join(sorted(got)), best

    mit, bsd = TEMPLATES["mit"][1].text, TEMPLATES["bsd"][0].text
    filler = " ".join(f"word{i}" for i in range(400))
    texts = [t.text.replace(" ", "\n", k) for ts in TEMPLATES.values() for t in ts for k in (0, 1, 100)]
    texts += [" ".join(f"{t.text} {mark}" for mark in marks) for ts in TEMPLATES.values() for t in ts for marks in (["sa", "nc"], ["2"], ["lesser", "3", "x"])]
    texts += [mit.replace("obtaining", "obtaining\n * "), mit + " " + bsd.replace(" ", "\n", 3), f"{filler} {mit} {filler} {mit}",
              "released " + filler + " under the " + filler + " license", mit.replace(" ", " x "), filler, "the the the of of to", ""]
    rng = np.random.default_rng(3)
    short = [names(f"{t.text} {t.barred}") for ts in TEMPLATES.values() for t in ts if t.deciding]
    texts += [" ".join(rng.permutation([*short[k % len(short)], *short[rng.integers(len(short))]])) for k in range(120)]
    texts += [" ".join(rng.permutation([*names(mit), *names(bsd)[: rng.integers(1, 19)], *["x"] * rng.integers(0, 6)])) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in scan_licences(docs, phrases={"no such phrase": "none"}).collect()}
    for i, t in enumerate(texts):
        labels, score = brute(t)
        assert got[i]["labels"] == labels and math.isclose(got[i]["score"], score), t
        assert (got[i]["n_blocks"] > 0) == (labels != "")
    at = {t: i for i, t in enumerate(texts)}
    assert got[at[f"{filler} {mit} {filler} {mit}"]]["n_blocks"] == 2
    assert got[at["released " + filler + " under the " + filler + " license"]]["labels"] == ""


def test_licences_told_apart_by_their_deciding_words(spark):
    want = {
        "Released under the BSD License": "",
        "Released under the GPL license": "",
        "Released under the MIT License": "mit",
        "Licensed under the Mozilla Public License, Version 2.0": "",
        "Licensed under the GNU General Public License, version 2.0": "",
        "Licensed under the Apache License, Version 2.0": "apache-2.0",
        "Licensed under the Apache License, Version 1.1": "",
        "Licensed under the Apache License, Version 1.1. Licensed under the Apache License, Version 2.0": "apache-2.0",
        "Licensed under CC BY 4.0": "",
        "Licensed under CC BY-SA 4.0": "",
        "Licensed under CC BY-NC-SA 4.0": "",
        "Licensed under CC BY-NC 4.0": "cc-by-nc",
        "This work is licensed under the GNU General Public License, version 2": "",
        "This work is licensed under the GNU Lesser General Public License, version 3": "",
        "This work is licensed under the GNU General Public License, version 3": "gpl-3.0",
        "This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0": "",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl-2.0",
    }
    docs = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["n_blocks"]) for r in scan_licences(docs, phrases={"no such phrase": "none"}).collect()}
    assert got == {i: (label, int(label != "")) for i, label in enumerate(want.values())}
    with pytest.raises(ValueError, match="deciding"):
        scan_licences(docs, {"x": [Notice("a b c", "d")]})


def test_toxicity_learns_from_all_of_twenty_thousand_rows(spark):
    # ten words, each in five toxic texts of 8000 rows: all five are needed
    rows = [(i, f"plain talk number {i}" + (f" xq{i // 10 % 10}z" if i % 10 == 0 and i < 500 else ""), int(i % 10 == 0)) for i in range(8_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = train(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    names = {int(_named(np.array([word_hash(f"xq{k}z")], dtype=np.uint64), 0)[0]) for k in range(10)}
    assert names <= set(model.chosen.tolist())
    few = spark.createDataFrame([(k, f"xq{k}z", 0) for k in range(10)] + [(10, "talk", 0)], "doc_id long, text string, toxic int")
    score = {r["doc_id"]: r["score"] for r in score_toxicity(few, model).collect()}
    assert all(score[k] > score[10] for k in range(10))
