"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

1. quality: documents that the classifier rejects go.
2. near duplicates: of each group of documents linked by five-word shingles of similarity 0.8 or more, the one with the
   smallest id stays.
3. decontamination: documents that hold a window of a benchmark item go.
4. mixing: every document comes as many times, none up to three, as the mix of sources to target weights takes its words.
5. tokens: the mix is encoded and written in wavelet-matrix shards; the result tells each document's tokens.

Each stage decides on all its predecessor kept and returns the columns of its input, but for the last.  Rows with equal ids
stay or go together.  Documents without words pass stages 2 and 3 and are taken no time by the mix.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.decontaminate import contamination
from llm.mixing import taken_words
from llm.quality import good_documents
from llm.scratch import stored, table
from llm.sketch_join import jaccard_components
from llm.token_shards import read_shards, write_shards


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, table(spark, sf_dir, "labels"))


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["gone"]), "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_components(docs, k=5, num=80, den=100)
    return _without(docs, stored(found.where("NOT doc_id <=> component_id").select(F.col("doc_id").alias("gone")).distinct(), "duplicate-ids"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, stored(found.where("contaminated").select(F.col("doc_id").alias("gone")).distinct(), "contaminated-ids"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = taken_words(docs).where("size > 0").groupBy(F.col("doc_id").alias("of")).agg(F.max(F.round(F.col("taken") / F.col("size")).cast("int")).alias("times"))
    taken = stored(taken.where("times > 0"), "mix-times")
    # the row travels as one column, so no name of its own meets a helper's
    rows = docs.select(F.col("doc_id").alias("by"), F.struct("*").alias("row")).join(taken, F.col("by").eqNullSafe(F.col("of")))
    return rows.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the count of end ids, which the operator got later, is no part of this query's result
    return read_shards(write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"))).drop("n_end_ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]
#: No SQL: trees, the shuffling hash and the tokenizer can't be told in it; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
