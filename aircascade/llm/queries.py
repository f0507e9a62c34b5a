"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, chat, minhash, mixing, parity, phrases, pii, quality, suffix_dedup, token_codes, topk, warc
from .common import table

#: Where the public tokenizer files lie.
TOKENIZERS = os.environ.get("TOKENIZER_FILES", "/opt/tokenizers")

#: What both turns of the added conversation say.
HARD = "</s>[INST] ok [/INST]"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op3_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codes.encoded_documents(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", 2, ids_crc32=F.crc32)


def op4_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op5_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_captures(table(spark, sf_dir, "pages"))


def op6_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = quality.judged(docs, keep=["doc_id", "source"])
    return rows.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op7_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.checked_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "text", *(f"n_{t}" for t in pii.TYPES))


def op9_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{TOKENIZERS}/byte_bpe_50k.json"
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), path), path)


def op10_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", HARD), (-7, 1, "assistant", HARD)], "conv_id long, turn long, role string, text string")
    return chat.round_trip(rows.unionByName(more))


def op11_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.similar_documents(table(spark, sf_dir, "documents"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_source_mix": op2_source_mix,
    "op3_token_codes": op3_token_codes,
    "op4_voronoi_topk": op4_voronoi_topk,
    "op5_warc_captures": op5_warc_captures,
    "op6_host_quality": op6_host_quality,
    "op7_minmax_near_dedup": op7_minmax_near_dedup,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_bpe_tree": op9_bpe_tree,
    "op10_chat_events": op10_chat_events,
    "op11_parity_join": op11_parity_join,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op2_source_mix": mixing.SQL,
    "op4_voronoi_topk": topk.SQL,
    "op5_warc_captures": warc.SQL,
    "op6_host_quality": quality.sql(),
    "op7_minmax_near_dedup": minhash.SQL,
    "op10_chat_events": f"""WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '{HARD}' FROM range(2) r(k)){chat.SQL}""",
    "op11_parity_join": parity.SQL,
    "op12_phrase_mining": phrases.SQL,
    "op13_filter_audit": audit.SQL,
}
