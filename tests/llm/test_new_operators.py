"""Fingerprints, token alignment and the filter audit against brute force, with nulls, empty and very long texts,
ties, repeated rows, empty tables and extra columns."""

import hashlib
import time
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest

from tillroll.llm import prefix_hashes as P
from tillroll.llm import queries as Q
from tillroll.llm.backoff_lm import score_documents
from tillroll.llm.filter_audit import audit_filters, removal_intervals, removals
from tillroll.llm.jaccard import jaccard_components
from tillroll.llm.tables import Stages
from tillroll.llm.token_alignment import _byte_letters, _unit_starts, align_tokens

SCHEMA = "doc_id long, text string, lang string, source string, kind string, part int, row string, a int, bits int, good string"
LONG = " ".join(f"word{i % 997}x{i}" for i in range(20_000))
WORDS = " ".join(f"plain words {i}" for i in range(100))
TEXTS = {
    0: WORDS, 1: WORDS + " tail", 2: "", 3: None, 4: "short text", 5: "SHORT text", 6: LONG, 7: LONG.replace("word77", "other"),
    8: "Ünïcode ſtraße 日本語 \x00 nul\x0bvt " * 9, 9: "a " * 300, 10: "aaaaaaaa" * 500, 11: WORDS, 12: "x", 13: "two\n\n  lines\t tab \n end  ",
    14: "a▁b under", 15: "<s> </s> <0x0A> <|endoftext|> <unk> don't", 16: "no break 　wide　 space   em \x85 next", 17: WORDS.upper() + " #",
    18: "🙂 emoji👩‍👩‍👧 é combining 12345,678.90 $5", 19: "   lead and trail   ", 20: "", 21: "a▁b under", None: "a row without an id",
}


def _docs():
    rows = [(i, t, "en", [None, "", "s1", "s2"][(i or 0) % 4], "x", 7, "y", 1, 2, "z") for i, t in TEXTS.items()]
    return rows + [rows[0], rows[4], (None, WORDS, "en", "s1", "x", 7, "y", 1, 2, "z"), (4, "another text of doc 4", "en", "s3", "x", 7, "y", 1, 2, "z")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_docs(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- prefix hashes --------------------------------------------------------


def test_span_equality_and_common_extensions_against_brute_force():
    rng = np.random.default_rng(7)
    buf = rng.integers(97, 99, 70_000, dtype=np.uint8)  # beyond one block
    buf[65_000:69_000] = buf[100:4_100]
    hashes, raw = P.PrefixHashes(buf), buf.tobytes()
    i, j = rng.integers(0, len(buf), (2, 400))
    i[:50], j[:50] = 100 + np.arange(50) * 7, 65_000 + np.arange(50) * 7
    limit = len(buf) - np.maximum(i, j)
    heads = hashes.common_heads(i, j, limit)
    tails = hashes.common_tails(i, j, np.minimum(i, j))
    for a, b, n, head, tail in zip(i.tolist(), j.tolist(), limit.tolist(), heads.tolist(), tails.tolist(), strict=True):
        assert raw[a : a + head] == raw[b : b + head] and (head == n or raw[a + head] != raw[b + head])
        assert raw[a - tail : a] == raw[b - tail : b] and (tail == min(a, b) or raw[a - tail - 1] != raw[b - tail - 1])
    n = rng.integers(0, 6, 400)
    i, j = np.minimum(i, len(buf) - 6), np.minimum(j, len(buf) - 6)
    assert hashes.equal(i, j, n).tolist() == [raw[a : a + k] == raw[b : b + k] for a, b, k in zip(i, j, n, strict=True)]


def test_common_extensions_of_rows(spark):
    rows = [("the same start", "the same end", 0, 0), ("xx common", "common", 3, 0), ("", "a", 0, 0), (None, "a", 0, 0), ("ab", "ab", 3, 0), ("ab", "ab", 2, 2)]
    got = P.common_extensions(spark.createDataFrame(rows, "left string, right string, left_at int, right_at int")).collect()
    assert Counter((r["left"], r["left_at"], r["length"]) for r in got) == Counter(
        {("the same start", 0, 9): 1, ("xx common", 3, 6): 1, ("", 0, 0): 1, (None, 0, None): 1, ("ab", 3, None): 1, ("ab", 2, 0): 1}
    )


def _prints(texts):
    buf, bounds = P._buffer(texts)
    return P.Fingerprints.of(P.PrefixHashes(buf), bounds).texts()


def test_likeness_follows_the_share_of_equal_text():
    rng = np.random.default_rng(3)
    base = rng.integers(97, 123, 60_000, dtype=np.uint8).tobytes()
    other = rng.integers(97, 123, 60_000, dtype=np.uint8).tobytes()
    texts = [base, base, base[:30_000] + other[30_000:], b"an insertion " + base, other, base[:3_000], b"ab" * 9_000, b"a" * 18_000, b"", b""]
    buf, bounds = P._buffer(texts)
    prints = P.Fingerprints.of(P.PrefixHashes(buf), bounds)
    names = prints.texts()
    assert (np.diff(prints.first) <= P.CUTS).all() and max(map(len, names)) < 500
    assert names[0] == names[1] and len(set(names)) == len(texts) - 2
    like = P.likeness([names[0]] * 10, names)
    assert like[1] == 1 and 0.35 < like[2] < 0.65 and like[3] > 0.85 and like[4] < 0.001 and like[8] == 0
    assert P.likeness(names[8:9], names[9:10]) == 1 and P.likeness(names[6:7], names[7:8]) < 0.01
    short = [b"abcdef", b"abcxyz", b"the same line\n" * 80, b"the same line\n" * 40 + b"another end\n" * 40, b"a", b"b"]
    short_prints = _prints(short)
    assert P.likeness(short_prints[0:1], short_prints[1:2]) == 0.5 and P.likeness(short_prints[4:5], short_prints[5:6]) == 0
    assert 0.3 < P.likeness(short_prints[2:3], short_prints[3:4])[0] < 0.75  # too repetitive for cuts
    every = np.arange(len(texts))
    back = P.Fingerprints.parse(names)
    for k in every:  # the strings hold all that is compared; both sides count alike
        other_side = prints.likeness(every, np.full(len(texts), k))
        assert np.allclose(prints.likeness(np.full(len(texts), k), every), other_side) and np.allclose(back.likeness(every, np.full(len(texts), k)), other_side)


def test_fingerprints(spark, docs, empty):
    rows = sorted(_docs(), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = P.fingerprint_documents(docs).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((r[0], len(r[1] or "")) for r in rows)
    known = {r[0]: (r[1] or "", s[1] or "") for r, s in zip(rows, [*rows[1:], rows[0]], strict=True) if r[0] not in (0, 4, None) and s[0] not in (4, None)}
    for r in got:
        if r["doc_id"] in known:
            text, after = known[r["doc_id"]]
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            a, b = text.encode(), edited.encode()
            head = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert r["head_bytes"] == head
        assert r["near_edited"] == P.likeness([r["fingerprint"]], [r["edited_fingerprint"]])[0]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    print_of = {}
    for r in got:
        if r["doc_id"] in TEXTS and r["doc_id"] not in (4, None):
            print_of[TEXTS[r["doc_id"]] or ""] = print_of.get(TEXTS[r["doc_id"]] or "", set()) | {r["fingerprint"]}
    assert all(len(x) == 1 for x in print_of.values()) and len({next(iter(x)) for x in print_of.values()}) == len(print_of)
    assert P.fingerprint_documents(empty).count() == 0
    (one,) = P.fingerprint_documents(spark.createDataFrame([(5, "alone here")], "doc_id long, text string")).collect()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"alonealone").hexdigest()


def test_fingerprints_do_not_depend_on_the_ranges(spark, docs):
    fields = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "tail_bytes"]
    few = Counter(tuple(r[f] for f in fields) for r in P.fingerprint_documents(docs).collect())
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        many = Counter(tuple(r[f] for f in fields) for r in P.fingerprint_documents(docs).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert few == many


# ---- token alignment ------------------------------------------------------


def _brute_alignment(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters, out = _byte_letters(), []
    for doc_id, text in rows:
        text = text or ""
        xs = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in (a.encode(" " + text, add_special_tokens=False).ids if text else [])]
        ys = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        want = (" " + text).encode()
        if not text or b"".join(t for _, t in xs) != want or b"".join(t for _, t in ys) != want:
            xs, ys = [], []
        ends = [np.cumsum([len(t) for _, t in s]).tolist() for s in (xs, ys)]
        groups, at = [], [0, 0]
        for e in sorted(set(ends[0]) & set(ends[1])):
            to = [es.index(e, k) + 1 for es, k in zip(ends, at, strict=True)]
            groups.append([[i for i, _ in s[k:m]] for s, k, m in zip((xs, ys), at, to, strict=True)])
            at = to
        out.append((doc_id, len(xs), len(ys), groups))
    held = Counter(p for *_, groups in out for p in {(x, y) for g in groups for x in g[0] for y in g[1]})
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    rows = Counter()
    for doc_id, n_a, n_b, groups in out:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        rows[(doc_id, n_a, n_b, len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
              hashlib.sha256(text.encode()).hexdigest() if n_a else "")] += 1
    return rows


def _aligned(docs, **kw):
    return align_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), **kw)


def test_alignment_against_whole_text_encoding(spark, docs, empty):
    fields = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = _brute_alignment([(r[0], r[1]) for r in _docs()])
    assert _aligned(docs).columns == fields
    for common in (1_000_000, 40, 0):  # all pairs to the tasks; most of them joined; all joined
        assert Counter(tuple(r) for r in _aligned(docs, common=common).collect()) == want
    assert sum(n for r, n in want.items() if r[1] == 0) == 5  # two empty, one null, two with U+2581
    assert _aligned(empty).count() == 0


def test_alignment_of_random_strings(spark):
    rng = np.random.default_rng(11)
    alphabet = [*"  \n\t abcdeXYZ019.,'-_#", " ", "　", " ", "\u0085", "é", "ß", "日", "本", "🙂", "the", " and", "ing ", "don't", "’s", "\r\n"]
    rows = [(i, "".join(rng.choice(alphabet, rng.integers(1, 60)))) for i in range(1_500)]
    got = _aligned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == _brute_alignment(rows)


def test_units_start_behind_visible_characters():
    text = "a b  c\n d  e　 f".encode()
    starts = _unit_starts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert [text[a:b].decode() for a, b in zip(starts, [*starts[1:], len(text)], strict=True)] == ["a", " b", "  c\n d  e　 f"]


# ---- filter audit ---------------------------------------------------------


def test_removals_of_every_order_against_a_plain_run():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 9, (32, 3))
    got = removals(counts)
    for rank, order in enumerate(permutations(range(5))):
        left = counts.copy()
        for step, f in enumerate(order):
            failing = np.array([m >> f & 1 == 1 for m in range(32)])
            assert (got[rank, step] == left[failing].sum(axis=0)).all()
            left[failing] = 0
    one_each = Counter()
    for mask, _, low, high in removal_intervals():
        one_each.update({(mask, r): 1 for r in range(low, high)})
    assert len(one_each) == 31 * 120 and set(one_each.values()) == {1}  # a failing document goes just once in each order


LABELS = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (2, None, 1), (3, 0, None), (9, 1, 0), (11, 1, 1), (17, 1, 0), (None, 1, 1), (99, 1, 1)]


def _audit_by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r[0], r[1], r[3]) for r in rows])
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", LABELS)
    cur = con.execute(Q.OP13)
    return [d[0] for d in cur.description], Counter(cur.fetchall())


def test_filter_audit(spark, docs, empty):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS docs", "1 AS good")
    names, want = _audit_by_sql(_docs())
    got = audit_filters(docs, labels)
    assert set(got.columns) == set(names)
    assert Counter(tuple(r[n] for n in names) for r in got.collect()) == want
    parts = {r[3] or "" for r in _docs()}
    assert sum(want.values()) == 600 * len(parts)
    assert audit_filters(empty, labels).count() == 0
    assert audit_filters(docs, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_filter_audit_of_one_hot_text(spark):
    rows = [(i, WORDS if i % 3 else f"{WORDS} {i}", "en", "hot" if i % 2 else "other", "x", 7, "y", 1, 2, "z") for i in range(900)]
    rows += [rows[1]] * 3  # the smallest doc_id of the copies, three times more
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    names, want = _audit_by_sql(rows)
    got = audit_filters(spark.createDataFrame(rows, SCHEMA), labels)
    assert Counter(tuple(r[n] for n in names) for r in got.collect()) == want


def test_a_written_stage_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        names = [found.apply(k).getName() for k in range(found.length())]
        return {x for x in names if x.startswith("shuffle_")}

    stages, before = Stages(spark, "test-release"), files()
    stages.write(spark.range(1000).repartition(4), "dealt")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert spark.read.parquet(f"{stages.root}/dealt").count() == 1000


def _stages_that_read(monkeypatch, folder):
    """The names of the stage tables that are written from the files below folder."""
    read, write = [], Stages.write

    def seen(self, df, name):
        if any(str(folder) in f for f in df.inputFiles()):
            read.append(name)
        return write(self, df, name)

    monkeypatch.setattr(Stages, "write", seen)
    return read


def test_rounds_read_only_their_own_texts(spark, tmp_path, monkeypatch):
    """A chain of texts whose neighbours link, and a group that is near but doesn't: the whole table is read a fixed number of times."""
    words = [f"w{k}" for k in range(80)]
    chain = [" ".join(words[k : k + 40]) for k in range(0, 30, 2)]
    # each of the group shares the most of its shingles with the others, and too few to link
    group = [" ".join([f"g{k}" for k in range(40)] + [f"x{i}y{k}" for k in range(7)]) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(chain + group + [chain[0]])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    read = _stages_that_read(monkeypatch, tmp_path / "d")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs).collect()}
    assert set(read) == {"described", "posted", "judged-sets", "texts"} and len(read) == 4
    sets = [{tuple(t.split()[k : k + 4]) for k in range(len(t.split()) - 3)} for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert got == dict(enumerate(root))


def test_language_model_scores_without_a_pass_for_sizes(spark):
    """Token counts come with the words; the values of arcs and failures add up where they meet; unseen and repeated texts too."""
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, "A b zz\tzz"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter((i, 1 + len((t or "").split())) for i, t in rows)
    for learn in ("true", "doc_id = 1", "false"):
        scored = score_documents(docs, learn)
        # the last job joins sums alone, and reads no text in Python
        assert "MapInArrow" not in scored._jdf.queryExecution().analyzed().toString()
        got = scored.collect()
        assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == want
        known = {r["doc_id"]: r["n_known"] for r in got}
        assert known == {"true": {1: 4, 2: 1, 3: 5, None: 1}, "doc_id = 1": {1: 4, 2: 1, 3: 3, None: 1}, "false": dict.fromkeys(known, 0)}[learn]
