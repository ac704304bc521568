"""The corpus operators applied to the given tables, with production settings, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import (
    chat, divergence, html_text, language, licenses, minhash, packing, perplexity, pieces, quality_rules, toxicity, vector_codes,
    vector_dedup,
)
from cadenza.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@register
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "kept", "score")


@register
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


@register
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@register
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.summarize(chat.format_turns(turns))


@register
def op3_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@register
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", *toxicity.RESULT)


@register
def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.summarized(table(spark, sf_dir, "documents"))


@register
def op4_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.with_perplexity(table(spark, sf_dir, "documents"))


@register
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files below their source, 64 to a folder; the first of each folder is its licence file."""
    folder = F.concat_ws("/", "source", F.concat(F.lit("d"), F.floor(F.col("doc_id") / 64)))
    name = F.when(F.col("doc_id") % 64 == 0, "LICENSE").otherwise(F.concat("doc_id", F.lit(".txt")))
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("fid"), F.concat_ws("/", folder, name).alias("path"), "text")
    found = licenses.scan(files, licenses.template_table(spark))
    return found.select(F.col("fid").alias("doc_id"), "path", "license", F.round("score", 6).alias("score"), "origin", "from_dir")


@register
def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identified(docs, language.train(docs)).select("doc_id", *language.RESULT)


@register
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.with_label_error(vector_codes.compressed(table(spark, sf_dir, "embeddings")))


@register
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


ORACLES["op1_chat"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, role || chr(10) || text || chr(10) AS said, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
    len(regexp_extract_all(role || ' ' || text,
      '<\|turn\|>|<\|end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>')) AS marks
  FROM t
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(said, '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(said) + 15 + marks) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""

ORACLES["op12_vector_codes"] = r"""
WITH e AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), i AS (
  SELECT vec_id, label, unnest(embedding) AS v, unnest(range(len(embedding))) AS place, len(embedding) // 16 AS size FROM e
), x AS MATERIALIZED (
  SELECT vec_id, label, place // size AS part, place % size AS pos, CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT) AS x FROM i
), f AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e
), c0 AS MATERIALIZED (SELECT entry, part, pos, x AS c FROM x JOIN f USING (vec_id) WHERE entry < 64),
d0 AS (SELECT vec_id, part, entry, sum((x - c) * (x - c)) AS d FROM x JOIN c0 USING (part, pos) GROUP BY ALL),
a0 AS MATERIALIZED (SELECT vec_id, part, min(d * 64 + entry) % 64 AS entry FROM d0 GROUP BY ALL),
s0 AS (SELECT entry, part, pos, sum(x) AS s, count(*) AS n FROM x JOIN a0 USING (vec_id, part) GROUP BY ALL),
c1 AS MATERIALIZED (
  SELECT entry, part, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c FROM c0 LEFT JOIN s0 USING (entry, part, pos)
), d1 AS (SELECT vec_id, part, entry, sum((x - c) * (x - c)) AS d FROM x JOIN c1 USING (part, pos) GROUP BY ALL),
a1 AS MATERIALIZED (SELECT vec_id, part, min(d * 64 + entry) % 64 AS entry FROM d1 GROUP BY ALL),
s1 AS (SELECT entry, part, pos, sum(x) AS s, count(*) AS n FROM x JOIN a1 USING (vec_id, part) GROUP BY ALL),
c2 AS MATERIALIZED (
  SELECT entry, part, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c FROM c1 LEFT JOIN s1 USING (entry, part, pos)
), d2 AS (SELECT vec_id, label, part, entry, sum((x - c) * (x - c)) AS d FROM x JOIN c2 USING (part, pos) GROUP BY ALL),
a2 AS (SELECT vec_id, label, part, min(d * 64 + entry) AS best FROM d2 GROUP BY ALL),
r AS (
  SELECT vec_id, label, string_agg(printf('%02x', CAST(best % 64 AS BIGINT)), '' ORDER BY part) AS code, CAST(sum(best // 64) AS BIGINT) AS error
  FROM a2 GROUP BY ALL
), h AS (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM r, h
"""

ORACLES["op13_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), o AS MATERIALIZED (SELECT id, lang, source, unnest(terms) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, sum(total) AS size, count(*) AS v FROM k GROUP BY lang),
g AS MATERIALIZED (
  SELECT lang, source, coalesce(any_value(size), 0) AS lang_size, coalesce(any_value(v), 0) AS v, coalesce(any_value(s), 0) AS size
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN l USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS s FROM c GROUP BY ALL) USING (lang, source) GROUP BY lang, source
), p AS MATERIALIZED (
  SELECT lang, source, term, total, coalesce(n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 1) // (size + v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (total + 1) // (lang_size + v) AS q
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM part
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
