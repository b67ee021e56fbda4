"""Registered queries of the training-data operators: key -> (spark, sf_dir) -> DataFrame.

Each applies one operator, with its production parameters, to its whole
table.  ``ORACLES`` has DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (bpe, context_mixing, embed_dedup, fingerprint, html_extract, lexical_search, minhash, mixing, preference,
               prefix_trie, suffix_dedup, toxicity, training_order)
from .common import table, written

#: Parameter: rank file and split pattern of the byte-level BPE.
BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE_PATTERN = public_tokenizers.PATTERN


def op1_embedding_near_dedup(spark, sf_dir):
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op2_toxicity(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents", "doc_id", "text"),
                           table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op3_byte_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents", "doc_id", "text"), BPE_RANKS, BPE_PATTERN)


def op4_fingerprints(spark, sf_dir):
    return fingerprint.neighbours(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_minhash_near_dedup(spark, sf_dir):
    return minhash.near_documents(table(spark, sf_dir, "documents", "doc_id", "text")).drop("same")


def op6_html_text(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_context_mixing(spark, sf_dir):
    return context_mixing.score_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_preference_pairs(spark, sf_dir):
    return preference.rendered_pairs(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op9_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    sizes = written(mixing.with_size(docs).select("doc_id", "source", "size", "tie"), "mixing/sizes")
    return mixing.mix(sizes).select("doc_id", "size", "source_size", "target", "taken", "source",
                                    "whole", "shard", "place")


def op10_training_order(spark, sf_dir):
    return training_order.document_order(table(spark, sf_dir, "documents", "doc_id", "text"),
                                         training_order.fresh_folder(spark))


def op11_suffix_dedup(spark, sf_dir):
    return suffix_dedup.removed_digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents", "doc_id", "text"),
                                 table(spark, sf_dir, "benchmark", "item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_fingerprints": op4_fingerprints,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_html_text": op6_html_text,
    "op7_context_mixing": op7_context_mixing,
    "op8_preference_pairs": op8_preference_pairs,
    "op9_source_mix": op9_source_mix,
    "op10_training_order": op10_training_order,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op8_preference_pairs": preference.RENDERED_SQL,
    "op11_suffix_dedup": suffix_dedup.REMOVED_SQL,
    "op12_prefix_trie": prefix_trie.TRIE_SQL,
    "op13_lexical_search": lexical_search.RANKED_SQL,
}
