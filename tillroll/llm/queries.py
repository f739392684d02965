"""The operators' queries over the tables of a folder, and their SQL.

Each function takes (spark, folder) and returns the operator's result over the
whole ``documents`` table, in the columns agreed for it.  ``ORACLES`` holds
DuckDB SQL for a query's rows where SQL can say them; the ``BASE`` strings
say the plain columns of the others and are used by the tests.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.backoff_lm import score_documents
from tillroll.llm.decontaminate import contaminated
from tillroll.llm.fertility import measure
from tillroll.llm.filter_audit import audit_filters
from tillroll.llm.jaccard import jaccard_components
from tillroll.llm.licences import scan_licences
from tillroll.llm.mixture import mix_sources
from tillroll.llm.prefix_hashes import fingerprint_documents
from tillroll.llm.recompress import remove_repeats
from tillroll.llm.sharding import shard_documents
from tillroll.llm.tables import Stages
from tillroll.llm.token_alignment import align_tokens
from tillroll.llm.token_codes import read_codes, write_codes
from tillroll.llm.toxicity import score_toxicity, train


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _remainder(n: int):
    """crc32 of doc_id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(_table(spark, folder, "documents"), 40)


def op2_token_codes(spark: SparkSession, folder: str, vocabulary: str = public_tokenizers.path("word_bpe_49k.json")) -> DataFrame:
    path = f"{Stages(spark, 'token-codes').root}/ids"
    write_codes(_table(spark, folder, "documents"), path, vocabulary, end_id=2)
    return read_codes(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licences(_table(spark, folder, "documents"))


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_components(_table(spark, folder, "documents"), width=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(_table(spark, folder, "documents"), width=13, texts=False).drop("kept")


def op6_quality_rules(spark: SparkSession, folder: str, vocabulary: str = public_tokenizers.path("piece_bpe_32k.model")) -> DataFrame:
    return measure(_table(spark, folder, "documents"), vocabulary)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    scored = score_toxicity(docs, train(docs, labels.where(_remainder(3) != 1)), limit=0.7)
    return scored.withColumn("held_out", _remainder(3) == 1).select("doc_id", "held_out", "score", "predicted")


def op8_backoff_lm(spark: SparkSession, folder: str) -> DataFrame:
    learn = "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 7 <> 2"
    return score_documents(_table(spark, folder, "documents"), learn)


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), width=5, percent=80)


def op10_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(_table(spark, folder, "documents"))


def op11_prefix_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(_table(spark, folder, "documents"))


def op12_token_alignment(
    spark: SparkSession,
    folder: str,
    path_a: str = public_tokenizers.path("byte_bpe_50k.json"),
    path_b: str = public_tokenizers.path("piece_bpe_32k.model"),
) -> DataFrame:
    return align_tokens(_table(spark, folder, "documents"), path_a, path_b)


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding, op2_token_codes, op3_licence_scan, op4_ngram_jaccard, op5_substring_dedup,
        op6_quality_rules, op7_toxicity, op8_backoff_lm, op9_decontamination, op10_mixture,
        op11_prefix_fingerprints, op12_token_alignment, op13_filter_audit,
    )
}

OP5 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13
), named AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h FROM starts
), firsts AS (
  SELECT h, min(doc_id) AS least FROM named GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT doc_id, unnest(range(i, i + 13)) AS p FROM named JOIN firsts USING (h) WHERE least < doc_id)
), single AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT s.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY s.p) AS rest
  FROM single s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.p = s.p
  WHERE g.p IS NULL GROUP BY s.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, h FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [md5(array_to_string(w, ' '))]
      ELSE list_transform(range(1, len(w) - 2), lambda i: md5(array_to_string(w[i:i + 3], ' '))) END) AS h FROM d)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
u AS (
  SELECT list(doc_id ORDER BY doc_id) AS ids FROM s GROUP BY h HAVING count(*) > 1
), p AS (
  SELECT a, b, count(*) AS k FROM (SELECT a, unnest(ids) AS b FROM (SELECT ids, unnest(ids) AS a FROM u)) WHERE a <> b GROUP BY a, b
), links AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), hops(a, c) AS (
  SELECT DISTINCT a, a FROM links UNION
  SELECT hops.a, links.b FROM hops JOIN links ON links.a = hops.c
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(min(c), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN hops ON hops.a = d.doc_id GROUP BY d.doc_id, n.n
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('17' || coalesce(':' || doc_id, '') || ':' || md5(coalesce(text, ''))) AS lot
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS total, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source
), w AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, 2.0::DOUBLE * total AS most FROM s
), f AS (
  SELECT *, 1.5::DOUBLE * sum(total) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM w
), g AS (
  SELECT *, rest * weight >= most * weights AS clamped FROM f
), t AS (
  SELECT source, total, CASE WHEN clamped THEN most ELSE weight * (SELECT rest / weights FROM g WHERE NOT clamped ORDER BY most / weight, place LIMIT 1) END AS target
  FROM g
), o AS (
  SELECT d.*, total, target, CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END AS whole,
    sum(size) OVER (PARTITION BY d.source ORDER BY lot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, source, size, CAST(total AS BIGINT) AS source_size, target,
  CAST(whole + CASE WHEN target > whole * total AND before + size / 2.0::DOUBLE <= target - whole * total THEN 1 ELSE 0 END AS INTEGER) AS times,
  CAST(size * (whole + CASE WHEN target > whole * total AND before + size / 2.0::DOUBLE <= target - whole * total THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""

OP9 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM benchmark
), k AS (
  SELECT 5 AS k UNION SELECT len(w) FROM b WHERE len(w) BETWEEN 1 AND 4
), e AS (
  SELECT r, doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM d
), g AS (
  SELECT doc_id, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4, lead(w, 4) OVER p AS w5
  FROM e WINDOW p AS (PARTITION BY r ORDER BY i)
), x AS (
  SELECT DISTINCT doc_id, h FROM (
    SELECT doc_id, CASE k WHEN 1 THEN w1 WHEN 2 THEN w1 || ' ' || w2 WHEN 3 THEN w1 || ' ' || w2 || ' ' || w3
      WHEN 4 THEN w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 ELSE w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 END AS h FROM g, k)
  WHERE h IS NOT NULL
), y AS (
  SELECT DISTINCT item_id, h FROM (
    SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS h FROM b)
), n AS (SELECT item_id, count(*) AS n_item FROM y GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item
FROM x JOIN y USING (h) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
"""

OP3_BASE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), place AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
), hit AS (
  SELECT doc_id, i - 1 AS i, CASE WHEN w[i] = 'cc' AND w[i + 1] = 'by' THEN 'cc-by'
    WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl'
    WHEN w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved' THEN 'reserved' END AS label FROM place
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, count(label) AS n_base, CAST(min(i) AS BIGINT) AS first_word, CAST(max(i) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id AND label IS NOT NULL GROUP BY d.doc_id, len(w)
"""

OP6_BASE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), twice AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (doc_id, g)) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, (len(w) < 20 OR 100 * coalesce(rep.n, 0) > 30 * len(w)) AS base_failed
FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)
"""

OP8_BASE = r"""
WITH d AS (
  SELECT doc_id, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), ' ') AS w, HELD AS held_out FROM documents
), t AS (
  SELECT doc_id, held_out, unnest(w) AS word FROM d
), c AS (SELECT word, count(*) AS c FROM t WHERE NOT held_out GROUP BY word),
n AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, CAST(any_value(n) AS BIGINT) AS train_tokens,
  sum(log10((coalesce(c, 0) + 1) / (n + v + 1))) AS base_score
FROM t LEFT JOIN c USING (word), n GROUP BY doc_id, held_out
"""

OP13 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), e AS (
  SELECT text, min(doc_id) AS least FROM d GROUP BY text
), m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
  FROM d JOIN e USING (text) LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t FROM m GROUP BY part, mask
), grow(o) AS (
  SELECT '' UNION ALL SELECT o || f FROM grow, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(f) WHERE length(o) < 5 AND position(f IN o) = 0
), steps AS (
  SELECT o, s, 1 << (ascii(substr(o, s, 1)) - 65) AS bit,
    coalesce(list_sum(list_transform(range(1, s), lambda k: 1 << (ascii(substr(o, k, 1)) - 65))), 0)::BIGINT AS before
  FROM grow, (SELECT unnest(range(1, 6))::INTEGER AS s) WHERE length(o) = 5
), r AS (
  SELECT part, o, s, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN t ELSE 0 END) AS toxic_lost
  FROM c, steps GROUP BY part, o, s, bit
)
SELECT part, o AS filter_order, s AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""

ORACLES: dict[str, str] = {
    "op4_ngram_jaccard": OP4,
    "op5_substring_dedup": OP5,
    "op9_decontamination": OP9,
    "op10_mixture": OP10,
    "op13_filter_audit": OP13,
}
