"""The corpus pipeline: stages applied in order to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next stage's
documents.  A stage works on every row its predecessor kept:

1. toxicity: rows predicted toxic go;
2. MinHash near-dedup: of linked documents the one of the least id stays;
3. mixing: sources are taken to their target weights, whole documents once or
   twice and parts of documents;
4. BPE: the ids' count and digests, and the digest of the decoded bytes, of
   every row of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, minhash, mixing, toxicity
from tessera.llm.common import table, written
from tessera.llm.queries import BPE_PATTERN, BPE_RANKS


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, BPE_RANKS, BPE_PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", encode_stage),
]

#: No SQL expresses the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline/{k}")
    return docs
