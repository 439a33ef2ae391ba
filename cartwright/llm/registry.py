"""The queries of the operators, with their SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import (
    filter_audit, jaccard, language, mixing, neighbours, packing, quality, repeats, small_world, toxicity, url_tree, warc,
    whitening,
)
from cartwright.llm.base import reachable, table
from cartwright.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    """Register a query under its function name, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reachable(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if check:
            CHECKS[fn.__name__] = check
        return fn

    return add


@query("""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(list_slice(ws, p, p + 34), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS p FROM w WHERE len(ws) >= 35)),
again AS (SELECT g FROM windows GROUP BY g HAVING count(*) > 1),
covered AS (
  SELECT doc_id, list(DISTINCT q) AS qs
  FROM (SELECT doc_id, unnest(generate_series(p, p + 34)) AS q FROM windows SEMI JOIN again USING (g))
  GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, ws, coalesce(len(qs), 0) AS n_removed,
    array_to_string(CASE WHEN qs IS NULL THEN ws ELSE
      list_transform(list_filter(generate_series(1, len(ws)), lambda i: NOT list_contains(qs, i)), lambda i: ws[i]) END, ' ') AS k
  FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(k) AS kept_sha256 FROM kept
""")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.languages(docs).select("doc_id", "held_out", "lang_pred", "score", "accepted")


@query("""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g') <> '') AS ls
  FROM documents),
windows AS (
  SELECT doc_id, p, list_slice(ws, p, p + 4) AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS p FROM w WHERE len(ws) >= 5)),
again AS (SELECT doc_id, g FROM windows GROUP BY ALL HAVING count(*) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest(generate_series(p, p + 4)) AS q FROM windows SEMI JOIN again USING (doc_id, g))
  GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(t, '\\P{L}+', '', 'g')) AS n_letters,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeated ON w.doc_id = repeated.doc_id),
f AS (
  SELECT *, n_words < 10 AS b0, 100 * n_repeat_words > 20 * n_words AS b1, word_chars > 14 * n_words AS b2,
    word_chars < 2 * n_words AS b3, 100 * n_symbols > 10 * word_chars AS b4, 100 * n_dup_lines > 30 * n_lines AS b5,
    100 * n_letters < 50 * word_chars AS b6
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, b0 OR b1 AS base_failed,
  NOT (b0 OR b1 OR b2 OR b3 OR b4 OR b5 OR b6) AS kept,
  CAST(b0::INT + 2 * b1::INT + 4 * b2::INT + 8 * b3::INT + 16 * b4::INT + 32 * b5::INT + 64 * b6::INT AS INT) AS failures
FROM f
""")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.judge(quality.BASE_POLICY)).alias("base_failed"), quality.judge(quality.PROSE_POLICY).alias("kept"), "failures")


@query("""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(ws, p, p + 4) AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS p FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id
FROM w LEFT JOIN sizes ON w.doc_id = sizes.doc_id JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = w.doc_id
""")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


@query()
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def tokenizer_path() -> str:
    """The vocabulary file of the queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.sequences(docs, tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS s FROM p),
g AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY s) ELSE page_id END AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, s AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM g
""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query()
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_tree.judged(table(spark, sf_dir, "pages"))


@query("""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
f AS (
  SELECT part, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic,
    (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS m
  FROM w),
cells AS (
  SELECT part, m, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)),
orders AS (
  SELECT letter AS o, 1 AS step, bit, bit AS done, [(1, bit, 0)] AS path FROM letters
  UNION ALL
  SELECT o || letter, step + 1, l.bit, done + l.bit, list_append(path, (step + 1, l.bit, done))
  FROM orders JOIN letters l ON done & l.bit = 0),
each AS (
  SELECT o, p[1] AS step, p[2] AS bit, p[3] AS before FROM (SELECT o, unnest(path) AS p FROM orders WHERE step = 5)),
found AS (
  SELECT part, o AS filter_order, step, bit,
    coalesce(sum(n) FILTER (m & (before + bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (m & before = 0 AND m & bit > 0), 0) AS removed,
    coalesce(sum(n) FILTER (m & before > 0 AND m & bit > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (m = bit), 0) AS unique_fails,
    coalesce(sum(g) FILTER (m & before = 0 AND m & bit > 0), 0) AS good_lost,
    coalesce(sum(x) FILTER (m & before = 0 AND m & bit > 0), 0) AS toxic_lost
  FROM cells CROSS JOIN each GROUP BY part, o, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM found
""")
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query()
def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_world.near_copies(table(spark, sf_dir, "embeddings"))
