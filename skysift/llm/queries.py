"""The registered queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.llm import ball_tree, compression_classifier, divergence, packing, parity_join, payload_chunks, pii, quality_rules, slots, spelling, token_counts, url_rules, viterbi
from skysift.llm.support import documents

#: The rules that op6 judges by, as (action, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file; SKYSIFT_TOKENIZERS names the folder, else the installed package has it."""
    if folder := os.environ.get("SKYSIFT_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.jaccard_components(documents(spark, sf_dir))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the file is a BPE model: its pieces and scores, not its merges
    return viterbi.round_trip(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"), as_unigram=True)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.fit(docs))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_rules.judge_urls(pages, url_rules.rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = """
WITH parts AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') AS rest FROM pages
), split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(action, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), ranked AS (
  SELECT s.page_id, s.host, s.path, r.rhost || r.rpath AS rule, r.action,
         row_number() OVER (PARTITION BY s.page_id, s.host, s.path ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST, r.action DESC) AS nth
  FROM split s LEFT JOIN rules r
    ON (s.host = r.rhost OR ends_with(s.host, '.' || r.rhost)) AND starts_with(s.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM ranked WHERE nth = 1
"""


def op7_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_chunks.media_features(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality_rules.judged(documents(spark, sf_dir), labels)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = slots.shard_by_bytes(documents(spark, sf_dir), 24)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("position").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"),
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = compression_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return compression_classifier.scored(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= compression_classifier.CUT).cast("int").alias("predicted")
    )


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0")


OP11_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.e, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), each AS (
  SELECT r, lang, source, term, count(*) AS n
  FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM each GROUP BY ALL HAVING count(*) >= 30
), counts AS (
  SELECT lang, source, term, CAST(sum(each.n) AS HUGEINT) AS n FROM each JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (SELECT DISTINCT lang, source FROM d),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n) AS HUGEINT) AS total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (t.total + 5 * l.v) AS p, 1 + (1000000000 * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) JOIN totals t USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_best_fit_packing, op2_jaccard_join, op3_sentencepiece, op4_token_counts, op5_pii, op6_url_filters, op7_media_chunks, op8_quality_rules, op9_sharding, op10_quality_classifier, op11_exact_top_k, op12_spelling_variants, op13_source_divergence)}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filters": OP6_SQL, "op11_exact_top_k": OP11_SQL, "op13_source_divergence": OP13_SQL}
