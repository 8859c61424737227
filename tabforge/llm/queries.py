"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import (filter_audit, html_text, language, licenses, line_rules, mixing, near_dups, pieces, substrings, topk,
                          toxicity, urls, whitening)

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"

#: The site rules of the query, and the patterns that judge the other urls.
SITE_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
URL_PATTERNS = [
    ("block", "||spam-farm."), ("block", "||casino."), ("block", "||adult."), ("block", "/wp-login.php"), ("block", "/cgi-bin/"),
    ("block", "||doubleclick.net^"), ("block", "||adserver."), ("block", "/tag/*/feed^"), ("block", "?sessionid="),
    ("allow", "||spam-farm.*/about^"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(n: int, id_col: str = "doc_id"):
    """crc32 of the id as text, mod n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urls.Rule(a, t, True) for a, t in SITE_RULES] + [urls.Rule(a, t) for a, t in URL_PATTERNS]
    return urls.filter_urls(table(spark, sf_dir, "pages"), rules)


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(bucket(4) == 2, F.lit(False))
    model = language.train(docs.where(~held_out))
    return (language.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model)
            .select("doc_id", "held_out", "lang_pred", "score"))


def op4_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.search(rows, rows.where("vec_id % 100 = 0"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents"), TOKENIZER, decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                        F.element_at("ends", -1).cast("long").alias("n_bytes"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(bucket(3) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out)
    model = toxicity.train(docs.where("not held_out"), labels)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "n_blocks")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_url_filters, op2_license_scans, op3_language_id, op4_near_dups, op5_mix_sources,
                                   op6_substring_dedup, op7_topk_search, op8_sentencepiece, op9_toxicity, op10_quality_rules,
                                   op11_html_extraction, op12_filter_audit, op13_embedding_whitening)}

_URL_SQL = r"""
WITH u AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (
  SELECT *, CASE WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                 WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
                 WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                 WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
                 WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
         CASE WHEN url IS NULL THEN NULL
              WHEN regexp_matches(url, '^[^:/?#]*://([^/?#]*\.)?spam-farm\..*/about([^A-Za-z0-9_.%-]|$)', 's') THEN '||spam-farm.*/about^'
              WHEN regexp_matches(url, '/cgi-bin/') THEN '/cgi-bin/'
              WHEN regexp_matches(url, '/tag/.*/feed([^A-Za-z0-9_.%-]|$)', 's') THEN '/tag/*/feed^'
              WHEN regexp_matches(url, '/wp-login\.php') THEN '/wp-login.php'
              WHEN strpos(url, '?sessionid=') > 0 THEN '?sessionid='
              WHEN regexp_matches(url, '^[^:/?#]*://([^/?#]*\.)?adserver\.') THEN '||adserver.'
              WHEN regexp_matches(url, '^[^:/?#]*://([^/?#]*\.)?adult\.') THEN '||adult.'
              WHEN regexp_matches(url, '^[^:/?#]*://([^/?#]*\.)?casino\.') THEN '||casino.'
              WHEN regexp_matches(url, '^[^:/?#]*://([^/?#]*\.)?doubleclick\.net([^A-Za-z0-9_.%-]|$)', 's') THEN '||doubleclick.net^'
              WHEN regexp_matches(url, '^[^:/?#]*://([^/?#]*\.)?spam-farm\.') THEN '||spam-farm.' END AS pattern FROM p)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN pattern = '||spam-farm.*/about^' THEN 'allow' WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL THEN pattern END AS matched
FROM r
"""

_TOPK_SQL = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_dot_product(CAST(q.c AS DOUBLE[]), CAST(d.c AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLE = {"op1_url_filters": _URL_SQL, "op7_topk_search": _TOPK_SQL, "op12_filter_audit": filter_audit.AUDIT_SQL}
