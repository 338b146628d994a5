"""Registered queries of the subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kindred.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op3_line_dedup", r"""
WITH l AS (
  SELECT doc_id, i AS pos, line,
         translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
f AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE f.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN f USING (key) GROUP BY doc_id""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.line_dedup import dedup_digest
    return dedup_digest(read_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


@register("op2_source_mix")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.mixing import mix_sources
    return mix_sources(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


@register("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.decontaminate import contamination
    docs = read_table(spark, sf_dir, "documents")
    leaks = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return leaks.select(leaks.did.alias("doc_id"), "item_id", "containment")


@register("op10_probminhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.probminhash import near_duplicates
    groups = near_duplicates(read_table(spark, sf_dir, "documents"))
    return groups.select(groups.did.alias("doc_id"), "class_id", "component_id", "kept")


@register("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.language_id import identify
    return identify(read_table(spark, sf_dir, "documents"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


@register("op1_url_filter")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.url_filter import filter_urls
    return filter_urls(read_table(spark, sf_dir, "pages"))


@register("op4_embedding_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.embedding_dedup import near_duplicate_vectors
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


@register("op6_secret_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.secrets import scan_secrets
    return scan_secrets(read_table(spark, sf_dir, "documents"))


@register("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.toxicity import score_toxicity
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op8_html_extraction")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.html_wrapper import extract_pages
    return extract_pages(read_table(spark, sf_dir, "pages"))


@register("op11_bpe_tokens")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from kindred.llm.bpe import digest
    return digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from kindred.llm.token_align import digest
    return digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                  public_tokenizers.path("piece_bpe_32k.model"))


@register("op13_source_audit", r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS held FROM t GROUP BY ALL),
l AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL HAVING sum(held) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(term) AS v, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang FROM g) LEFT JOIN l USING (lang) GROUP BY lang),
s AS (SELECT g.lang, g.source, coalesce(sum(c.n) FILTER (WHERE l.term IS NOT NULL), 0)::HUGEINT AS total
      FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source LEFT JOIN l ON l.lang = c.lang AND l.term = c.term GROUP BY ALL),
p AS (SELECT s.lang, s.source, l.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.total + 5 * v.v) AS p,
             1 + (1000000000::HUGEINT * (l.n + 5)) // (v.total + 5 * v.v) AS q
      FROM s JOIN v USING (lang) JOIN l ON l.lang = s.lang
      LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = l.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rk FROM u)
SELECT lang, source, part, item, value, rk::INTEGER AS "rank" FROM o WHERE part = 'pair' OR rk <= 50""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.source_audit import audit_sources
    return audit_sources(read_table(spark, sf_dir, "documents"))
