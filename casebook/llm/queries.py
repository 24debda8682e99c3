"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from casebook.llm import bytebpe, mixing, multiset, negatives, packing, phrases, secrets, sharding, simhash, substrings, toxicity, weakrules, wordvectors
from casebook.llm import sql
from casebook.llm.common import documents, embeddings, labels, public_tokenizer

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, oracle)
        return fn
    return add


@query("op10_jump_sharding", sql.JUMP_SHARDING)
def op10_jump_sharding(spark, sf_dir):
    return sharding.shard_documents(documents(spark, sf_dir), 40)


@query("op5_multiset_fingerprints", sql.MULTISET_FINGERPRINTS)
def op5_multiset_fingerprints(spark, sf_dir):
    return multiset.fingerprint_documents(documents(spark, sf_dir))


@query("op9_simhash_segments")
def op9_simhash_segments(spark, sf_dir):
    return simhash.near_duplicate_rows(documents(spark, sf_dir))


@query("op2_sentence_spans")
def op2_sentence_spans(spark, sf_dir):
    return substrings.dedup_substrings(documents(spark, sf_dir))


@query("op1_secret_automaton")
def op1_secret_automaton(spark, sf_dir):
    return secrets.scan_documents(documents(spark, sf_dir))


@query("op8_least_squares_packing")
def op8_least_squares_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), public_tokenizer("word_bpe_49k.json"))


@query("op4_weak_supervision")
def op4_weak_supervision(spark, sf_dir):
    return weakrules.quality_rules(documents(spark, sf_dir)).drop("quality")


@query("op6_distinct_word_bpe")
def op6_distinct_word_bpe(spark, sf_dir):
    return bytebpe.encode_documents(documents(spark, sf_dir), public_tokenizer("byte_bpe_50k.json"))


@query("op3_random_indexing_quality")
def op3_random_indexing_quality(spark, sf_dir):
    return wordvectors.quality_scores(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op7_counterfactual_toxicity")
def op7_counterfactual_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op11_mixed_blocks", sql.MIXED_SOURCES)
def op11_mixed_blocks(spark, sf_dir):
    return mixing.mix_documents(documents(spark, sf_dir))


@query("op12_vertical_negatives", sql.HARD_NEGATIVES)
def op12_vertical_negatives(spark, sf_dir):
    return negatives.hard_negatives(embeddings(spark, sf_dir))


@query("op13_fingerprint_phrases", sql.PHRASES)
def op13_fingerprint_phrases(spark, sf_dir):
    return phrases.mine_phrases(documents(spark, sf_dir))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
