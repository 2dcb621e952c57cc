"""The registered queries: each applies one operator to its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tamis.llm import bpe, decontaminate, html_text, media, merkle, negatives, packing, pii, quality, shards, simhash, toxicity, warc
from tamis.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_audio_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = media.rendered(table(spark, sf_dir, "embeddings"))
    return media.search(clips, "id").withColumnRenamed("id", "vec_id")


def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


def op7_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.round_trip(spark, table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(negatives.prepared(table(spark, sf_dir, "embeddings")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_audio_fingerprints, op3_warc_zip, op4_html_extraction, op5_pii, op6_quality_classifier, op7_simhash_near_duplicates, op8_benchmark_decontamination, op9_token_shards, op10_best_fit_packing, op11_byte_level_bpe, op12_hard_negatives, op13_merkle_manifest)}


#: Five bits of the hexadecimal SHA-1 make a base32 digit.
_NIBBLES = ", ".join(f"'{i:04b}'" for i in range(16))
_BIT = " + ".join(f"{2 ** (4 - k)} * substr(bits, i * 5 + {k + 1}, 1)::INT" for k in range(5))
OP3_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, array_to_string(list_transform(string_split(sha1(h), ''), lambda c: [{_NIBBLES}][strpos('0123456789abcdef', c)]), '') AS bits FROM p),
e AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_BIT}, 1)), '') AS payload_digest FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM e)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to, url FROM f JOIN pages USING (page_id)
"""


OP12_SQL = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score FROM v a JOIN v b ON a.id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same AND id <> anchor_id QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_warc_zip": OP3_SQL, "op12_hard_negatives": OP12_SQL}
