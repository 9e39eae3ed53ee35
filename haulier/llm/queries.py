"""Registered queries: each operator over its whole table, with the parameters used in production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import block_naming, language_crf, mixing, nn_descent, packing, periodic_runs, sharding, simhash, suffix_tree, token_alignment, token_files, toxicity, warc
from .common import table, text_or_empty
from .registry import query


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query()
def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query()
def op3_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.document_languages(table(spark, sf_dir, "documents"))


@query(
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_groups(table(spark, sf_dir, "documents"))


@query()
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return token_files.read_token_files(manifest)


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query()
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents"))


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.document_scores(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS k
      FROM documents),
    s AS (
      SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
             [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
    f AS (
      SELECT *, cap / w AS fill,
             ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0)::DOUBLE)
             / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
      FROM s WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l AS (SELECT arg_min(level, (fill, source)) AS level FROM f WHERE level * w <= cap),
    t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(l.level * w, cap::DOUBLE)) AS target FROM f LEFT JOIN l ON true),
    p AS (
      SELECT d.*, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS front
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size::BIGINT AS size, source_size, target,
           CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
                + least(size, greatest(0, budget % source_size - front)) END::BIGINT AS taken
    FROM p
    """
)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), carry=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


@query(
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (
      SELECT page_id, strlen(html)::BIGINT AS payload_bytes, from_hex(sha1(html))::BIT::VARCHAR AS bits,
             row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST) = 1 AS first,
             first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST) AS response
      FROM p)
    SELECT page_id, payload_bytes,
           list_aggregate(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
             list_sum(list_transform(range(0, 5), lambda j: bits[i * 5 + j + 1]::INT << (4 - j)))::INT + 1]), 'string_agg', '') AS payload_digest,
           CASE WHEN first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN NOT first THEN response END AS refers_to
    FROM d
    """
)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.deduplicated_pages(table(spark, sf_dir, "pages"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    text = periodic_runs.repeated_tail(F.col("doc_id"), text_or_empty())
    return periodic_runs.digests(periodic_runs.periodic_runs(rows.select("doc_id", text.alias("text"))))


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    return token_alignment.document_alignments(rows, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


__all__ = [name for name in dir() if name.startswith("op")]
