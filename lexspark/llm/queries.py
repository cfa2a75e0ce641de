"""One query per operator over the given tables, and the same answers in SQL where it can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexspark.llm import (
    byte_pairs, decontamination, importance, line_dedup, mixing, quality, rendezvous, secrets, simhash, token_counts,
    tool_calls, training_order, whitening,
)
from lexspark.plans.lineage import scratch_path

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_perplexity(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lang", "perplexity", "lower", "upper",
    )


@query
def op8_simhash_pigeonring(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_mixing_thresholds(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op3_mixing_thresholds"] = mixing.ORACLE


@query
def op5_rendezvous_shards(spark, sf_dir):
    return rendezvous.shard_rows(table(spark, sf_dir, "documents"))


ORACLES["op5_rendezvous_shards"] = rendezvous.ORACLE


@query
def op7_qgram_decontamination(spark, sf_dir):
    return decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_line_similarity_dedup(spark, sf_dir):
    return line_dedup.line_matches(table(spark, sf_dir, "documents"))


ORACLES["op9_line_similarity_dedup"] = line_dedup.ORACLE


@query
def op2_secret_randomness(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op6_transducer_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_training_order(spark, sf_dir):
    target = scratch_path(spark, "training-order")
    training_order.write_training_order(
        table(spark, sf_dir, "documents"), target, public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, key=42)
    return training_order.read_training_order(spark, target).drop("tokens")


@query
def op4_tool_call_linking(spark, sf_dir):
    calls, results = tool_calls.derived_calls(table(spark, sf_dir, "conversations"))
    return tool_calls.linked_calls(calls, results, tool_calls.TOOLS)


ORACLES["op4_tool_call_linking"] = tool_calls.ORACLE


@query
def op11_bit_sliced_resampling(spark, sf_dir):
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_chebyshev_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_byte_level_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_pairs.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_pairs.digests(byte_pairs.decode(ids, ranks, public_tokenizers.PATTERN))
