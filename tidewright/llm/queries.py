"""The registered queries: each applies one operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.llm.common import held_out
from tidewright.llm.exact_dedup import exact_dedup
from tidewright.llm.exact_topk import exact_topk
from tidewright.llm.guess_cost import secret_scan
from tidewright.llm.line_quality import line_quality
from tidewright.llm.mixing import mix
from tidewright.llm.packing import pack_documents
from tidewright.llm.page_text import page_text
from tidewright.llm.parity_join import parity_join
from tidewright.llm.prefix_trie import prefix_trie
from tidewright.llm.simhash import simhash_components
from tidewright.llm.structure_repair import repair
from tidewright.llm.super_kmers import substring_dedup
from tidewright.llm.toxicity import toxicity
from tidewright.llm.twins import PARITY_JOIN, PREFIX_TRIE, STRUCTURE_REPAIR


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("doc_id", 5, 0))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op8_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = line_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("doc_id", 4, 2))
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join(table(spark, sf_dir, "documents"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_exact_topk, op2_toxicity, op3_page_text, op4_exact_dedup, op5_packing, op6_mixing, op7_guess_cost,
    op8_super_kmers, op9_simhash, op10_line_quality, op11_parity_join, op12_structure_repair, op13_prefix_trie)}

ORACLES = {
    "op11_parity_join": PARITY_JOIN,
    "op12_structure_repair": STRUCTURE_REPAIR,
    "op13_prefix_trie": PREFIX_TRIE,
    "op1_exact_topk": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op4_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY bare ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM g""",
    "op8_super_kmers": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (
  SELECT doc_id, unnest(generate_series(1, len(words) - 19)) AS start, words FROM d WHERE len(words) >= 20),
h AS (SELECT doc_id, start, array_to_string(words[start:start + 19], ' ') AS body FROM w),
dup AS (
  SELECT doc_id, start FROM (SELECT doc_id, start, row_number() OVER (PARTITION BY body ORDER BY doc_id, start) AS n FROM h) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(start, start + 19)) AS place FROM dup),
gone_lists AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id),
words AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place FROM d),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.place) AS body, count(*) AS n
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.place = words.place
  WHERE gone.place IS NULL GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
}
