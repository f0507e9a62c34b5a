"""From raw documents to a token mix, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept; all but the last return the columns of documents.  Rows with a null text
fail the quality rules; repeated rows stand for one document and stay or go
together; very long texts go through every stage as a whole; an empty table
passes through all stages as an empty table.  Other columns come through, but
for the last stage, whatever their names.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aircascade.llm import bpe, minhash, mixing, pii, quality
from aircascade.llm.common import dropped, stored, table

TOKENIZER = os.environ.get("TOKENIZER_FILES", "/opt/tokenizers") + "/byte_bpe_50k.json"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's verdict keep."""
    return quality.kept_rows(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id."""
    return minhash.deduplicated(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in their texts; fails if two entities share one."""
    out = pii.checked_surrogates(docs, counted=False)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it."""
    return mixing.repeated(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and decoded text of each document of the mix."""
    return bpe.digests(bpe.encode(docs, TOKENIZER), TOKENIZER, ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_quality),
    ("minhash near-dedup", drop_near_duplicates),
    ("pii surrogates", replace_personal_data),
    ("source mixing", mix_sources),
    ("bpe encoding", tokenize),
]

#: Signatures, keyed surrogates and BPE have no SQL; the tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
