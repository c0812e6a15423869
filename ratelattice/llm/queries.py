"""Registered queries of the operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelattice.llm import (
    fingerprints, kronecker, licences, lineruns, packing, pivotal, quotes, quotientfilter, reversedsearch, setsketch, surrogates, toxicity, urlrules,
)
from ratelattice.llm.common import table

# The rules of the contract
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
TOKENIZER = "byte_bpe_50k.json"
SURROGATE_KEY = b"example key: replace by a secret of your own"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), words=3, num=85, den=100)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score_texts(docs, toxicity.fit(docs, labels))
    doc_id = F.col("row.doc_id")
    return scored.select(doc_id.alias("doc_id"), toxicity.held_out(doc_id).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotal.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op8_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotientfilter.exact_duplicates(table(spark, sf_dir, "documents"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return urlrules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op10_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversedsearch.reversed_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return kronecker.hard_negatives(kronecker.usable(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lineruns.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_surrogates, op3_near_duplicates, op4_toxicity, op5_licences, op6_mixing, op7_packing,
        op8_exact_duplicates, op9_url_rules, op10_quotes, op11_reversed_search, op12_hard_negatives, op13_line_dedup, pipeline,
    )
}

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

ORACLES: dict[str, str] = {
    "op3_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2])) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.low AS component_id, d.doc_id = r.low AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) r USING (doc_id)""",
    "op8_exact_duplicates": rf"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars, sha256({_NORMAL}) AS text_sha256, {_NORMAL} AS normal FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY normal ORDER BY n_chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k""",
    "op9_url_rules": r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM u) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fits USING (host, path)""",
    "op11_reversed_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, doc_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d),
items AS (
  SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM benchmark),
sizes AS (SELECT r, doc_id, count(*) AS n FROM words GROUP BY ALL),
whole AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM sizes),
counts AS (SELECT r, term, count(*) AS tf FROM words SEMI JOIN items USING (term) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, whole GROUP BY term, big_n),
scores AS (
  SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l))))::BIGINT AS score
  FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (r), whole GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op12_hard_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_sum(list_transform(range(1, len(a.c) + 1), lambda i: a.c[i] * b.c[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""",
    "op13_line_dedup": r"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS held FROM documents),
rows AS (SELECT doc_id, unnest(held) AS line, unnest(range(len(held))) AS place FROM cut),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM rows),
firsts AS (SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT doc_id, place, line, coalesce(doc_id > first_id, false) AS gone FROM keyed LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
}
