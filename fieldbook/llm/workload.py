"""The numbered operators bound to the corpus tables: one query each, over whole tables."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm import (
    bpe_automaton,
    conversation_trie,
    decontamination,
    extraction,
    jaccard,
    kdtree,
    lexical,
    licenses,
    quality,
    suffix_dedup,
    token_files,
    toxicity,
    urls,
)
from fieldbook.llm.oracles import (
    BENCHMARK_OVERLAP,
    CONVERSATION_TRIE,
    NEAREST_VECTORS,
    RANKED_SEARCH,
    REPEATED_BYTES,
    SHINGLE_JOIN,
)
from fieldbook.llm.store import kept, table


#: Vocabulary files, read by the driver and handed to the executors (1.7 MB each).
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.summarise(licenses.detect(docs)).select("carried.doc_id", "*").drop("carried")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = kept(
        quality.measured(docs).withColumn("stratum", F.coalesce("lang", F.lit(""))).drop("lang"),
        "quality-measured",
    )
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("good"))
    labelled = rows.join(labels.filter(F.col("good").isNotNull()), "doc_id")
    cutoffs = kept(quality.certified_cutoffs(labelled, "stratum", "good"), "quality-cutoffs")
    return quality.judge(rows, cutoffs, "stratum").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rejected_by",
    )


def packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = token_files.files(docs, Path(WORD_VOCABULARY).read_text())
    return token_files.read_back(kept(files, "token-files"))


#: The rules that the pages are judged by.
URL_RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return urls.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    text = extraction.extract(pages.select("page_id", "url", "html"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))


def byte_pair_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_automaton.encode(docs, Path(BYTE_VOCABULARY).read_text(), with_ids=False)


def shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents"))


def benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def conversation_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.nodes(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_license_scan": license_scan,
    "op2_quality_rules": quality_rules,
    "op3_packed_tokens": packed_tokens,
    "op4_url_filter": url_filter,
    "op5_main_text": main_text,
    "op6_repeated_bytes": repeated_bytes,
    "op7_byte_pair_codec": byte_pair_codec,
    "op8_shingle_join": shingle_join,
    "op9_benchmark_overlap": benchmark_overlap,
    "op10_toxicity_scores": toxicity_scores,
    "op11_max_sketch_search": ranked_search,
    "op12_kd_tree_search": nearest_vectors,
    "op13_conversation_trie": conversation_prefixes,
}

# Aliases are followed by recursion: every address reaches every other of its component.
ORACLES: dict[str, str] = {
    "op6_repeated_bytes": REPEATED_BYTES,
    "op8_shingle_join": SHINGLE_JOIN,
    "op9_benchmark_overlap": BENCHMARK_OVERLAP,
    "op11_max_sketch_search": RANKED_SEARCH,
    "op12_kd_tree_search": NEAREST_VECTORS,
    "op13_conversation_trie": CONVERSATION_TRIE,
    "op4_url_filter": r"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
parts AS (
  SELECT page_id, url, html,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)?', 1) AS query
  FROM pages),
addressed AS (
  SELECT *, CASE WHEN host <> '' THEN host || CASE path WHEN '' THEN '/' ELSE path END || query END AS address
  FROM parts),
tags AS (
  SELECT url, address, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<link\b[^>]*>'),
      lambda t: regexp_matches(t, '(?is)\brel\s*=\s*["'']?\s*canonical\b')),
      lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<meta\b[^>]*>'),
      lambda t: regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')),
      lambda t: regexp_extract(t, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1)))) AS tag
  FROM addressed),
targets AS (
  SELECT address, CASE WHEN contains(tag, '://') THEN replace(tag, '&amp;', '&')
    WHEN tag LIKE '//%' THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || replace(tag, '&amp;', '&')
    WHEN tag LIKE '/%' THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || replace(tag, '&amp;', '&')
    ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) ||
      coalesce(nullif(regexp_extract(url, '(?s)^.*?://[^/?#]*((?:/[^/?#]*)*/)', 1), ''), '/') ||
      replace(tag, '&amp;', '&') END AS target
  FROM tags WHERE tag <> ''),
split AS (
  SELECT address AS a,
    translate(regexp_extract(target, '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(target, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(target, '(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)?', 1) AS query
  FROM targets WHERE address IS NOT NULL),
edges AS (
  SELECT a, host || CASE path WHEN '' THEN '/' ELSE path END || query AS b FROM split WHERE host <> ''),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached(a, b) AS (
  SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON r.b = e.a),
ruled AS (
  SELECT r.a AS address, arg_max(k.verdict, (length(k.host || k.path), k.verdict = 'allow')) AS own
  FROM reached r JOIN rules k
    ON (split_part(r.b, '/', 1) = k.host OR ends_with(split_part(r.b, '/', 1), '.' || k.host))
   AND starts_with(regexp_extract(r.b, '^[^/]*([^?]*)', 1), k.path)
  GROUP BY r.a, r.b),
components AS (SELECT address, min(own) AS verdict FROM ruled GROUP BY address),
fits AS (
  SELECT p.page_id, p.url, arg_max(k.host || k.path, (length(k.host || k.path), k.verdict = 'allow')) AS rule,
    arg_max(k.verdict, (length(k.host || k.path), k.verdict = 'allow')) AS verdict
  FROM addressed p JOIN rules k ON (p.host = k.host OR ends_with(p.host, '.' || k.host)) AND starts_with(p.path, k.path)
  GROUP BY p.page_id, p.url)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, c.verdict, 'allow') AS verdict
FROM addressed p LEFT JOIN fits f ON f.page_id = p.page_id AND f.url = p.url
LEFT JOIN components c ON c.address = p.address
""",
}
