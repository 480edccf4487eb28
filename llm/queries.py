"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import oracle
from llm.context_mixing import mixing_scores
from llm.conversation_repair import repaired_conversations
from llm.decontaminate import contamination
from llm.line_dedup import line_decisions
from llm.mixing import taken_words
from llm.placement import write_sharded
from llm.quality import quality_scores
from llm.scratch import table
from llm.sketch_join import jaccard_components
from llm.substrings import repeated_spans_removed
from llm.token_alignment import alignment
from llm.token_shards import read_shards, write_shards
from llm.topk_search import top_k
from llm.tree_bpe import token_digests

#: Shards of the sharding query; every fourth takes twice as many documents.
SHARDS = {f"shard-{i:03d}": 2 if i % 4 == 0 else 1 for i in range(64)}

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_shards(write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = write_sharded(table(spark, sf_dir, "documents"), ["doc_id"], SHARDS)
    return written.select("doc_id", "slot", "shard", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed")
    return line_decisions(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", removed)


def op9_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_scores(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans_removed(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(table(spark, sf_dir, "conversations"))


def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))[0]


def queries() -> dict[str, Query]:
    found = (op1_decontamination, op2_token_shards, op3_quality, op4_ngram_jaccard, op5_topk_search, op6_sharding, op7_source_mixing, op8_line_dedup, op9_context_mixing, op10_substring_dedup, op11_conversation_repair, op12_tree_bpe, op13_token_alignment)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
