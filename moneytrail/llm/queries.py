"""The operators' registered queries: whole tables in, one digest row per document or page out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moneytrail.llm import alignment, conversation, decontaminate, mixing, packing, personal_data, ppm, shuffle_shards, simhash, spotsigs, token_file, toxicity, warc_zip
from moneytrail.llm.common import crc_mod, table


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edit_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.judge(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), usable=crc_mod(F.col("id"), 3) != 1)
    found = toxicity.score(docs.select("doc_id", "text", "lang"), model)
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "threshold", "toxic")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zip.round_trip(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["plain"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["plain"] & (s["kind"] == k))).cast("bigint").alias(f"n_{k}")
    return found.select("doc_id", *map(count, personal_data.KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents").select("doc_id", "text"), crc_mod(F.col("doc_id"), 7) == 2)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shuffle_shards.shards_of(table(spark, sf_dir, "documents").select("doc_id", "text"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    return shards.select("doc_id", shuffle_shards.record_size(F.col("text")).alias("size"), crc, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversation.report(conversation.damage(rows), rows.select("conv_id"))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_document_fingerprints, op2_token_ids, op3_simhash_near_dedup, op4_benchmark_decontamination, op5_mixing_sources, op6_toxicity, op7_warc, op8_pii, op9_lm_scoring, op10_sharding, op11_best_fit_packing, op12_tokenizer_alignment, op13_conversation_repair)}
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: The same results in DuckDB, by a join of all windows (op4) and a window over equal texts (op7).
ORACLE: dict[str, str] = {
    "op4_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
doc_windows AS (
    SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN (SELECT DISTINCT k FROM item_windows) ON len(w) >= k)),
hits AS (SELECT doc_id, i, k, item_id FROM doc_windows JOIN item_windows USING (k, g)),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op5_mixing_sources": mixing.SQL,
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT *, strlen(html) AS n, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
""",
}
