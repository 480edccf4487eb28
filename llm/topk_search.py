"""Exact top-k search by inner product over an impact-ordered index.

Vectors are indexed in blocks.  For every component a block keeps its vectors in
order of the component's value, cut into levels of equal width.  A query walks
the levels of all components by descending impact, the most that a level can add
to a score, and adds each level's least value to its vectors' scores.  What is
still unknown of a score is bounded by the levels' widths and the impacts to
come, so a vector whose score plus that bound is under the k-th best score is out
for good.  The walk stops when few vectors are left or all levels are done; all
that are left get their exact score.

Components count as floor(1024 * x).  Vectors that are null or hold nulls or
numbers that aren't finite take no part, and no more do rows without an id.
Missing components of shorter vectors count as 0.  A query's own id is never
among its results; rows with equal ids are candidates one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.scratch import stored
from llm.words import ragged

BLOCK, LEVELS, AT_ONCE, FEW = 2048, 16, 8192, 64
SCALE = 1024
INDEX = "block long, ids binary, vectors binary, order binary, starts binary, edges binary"


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, vector)`` of the rows that take part, components as integers."""
    whole = F.forall(F.col(vector_col), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    out = rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(whole)
    return out.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("vector"))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    sizes = np.diff(vectors.offsets.to_numpy())
    out[np.repeat(np.arange(len(vectors)), sizes), ragged(np.zeros(len(sizes), np.int64), sizes)] = vectors.flatten().to_numpy()
    return out


class Block:
    """Vectors (n, width) with, for each component, their order by level and the levels' least and greatest values."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray, starts: np.ndarray, edges: np.ndarray) -> None:
        self.ids, self.vectors, self.order, self.starts, self.edges = ids, vectors, order, starts, edges

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray, levels: int = LEVELS) -> Block:
        n, width = vectors.shape
        low, high = vectors.min(0), vectors.max(0)
        step = (high - low) // levels + 1
        level = (vectors - low) // step
        order = np.argsort(level, axis=0, kind="stable").T
        starts = np.stack([np.searchsorted(level[order[c], c], np.arange(levels + 1)) for c in range(width)])
        edges = np.stack([np.minimum(low[:, None] + np.arange(levels) * step[:, None], high[:, None]), np.minimum(low[:, None] + np.arange(1, levels + 1) * step[:, None] - 1, high[:, None])])
        return cls(ids, vectors, order.astype(np.int32), starts.astype(np.int64), edges)

    def best(self, query: np.ndarray, own: int, k: int, few: int = FEW) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the k greatest scores, ties to smaller ids, and the scores."""
        n, width = self.vectors.shape
        weight = np.abs(query).astype(np.float64)
        # gains over the least possible value of each component, from the side that the query's sign asks for
        low, high = self.edges.astype(np.float64)
        at_least = np.where(query[:, None] >= 0, low - low[:, :1], high[:, -1:] - high) * weight[:, None]
        at_most = np.where(query[:, None] >= 0, high - low[:, :1], high[:, -1:] - low) * weight[:, None]
        begin, size = self.starts[:, :-1].ravel() + np.repeat(np.arange(width) * n, self.starts.shape[1] - 1), np.diff(self.starts).ravel()
        walk = np.argsort(-at_most.ravel(), kind="stable")
        walk = walk[size[walk] > 0]
        unsure = at_most.max(1)  # for each component, the most that can be missing from a score
        spread = (at_most - at_least).max(1)
        score, alive = np.zeros(n), np.flatnonzero(self.ids != own)
        flat, component = self.order.ravel(), walk // (self.starts.shape[1] - 1)
        left = np.bincount(component, minlength=width)
        turn = max(width, len(walk) // 12)
        for i in range(0, len(walk), turn):
            if len(alive) <= max(few, k):
                break
            part = walk[i : i + turn]
            score += np.bincount(flat[ragged(begin[part], size[part])], np.repeat(at_least.ravel()[part], size[part]), n)
            left -= np.bincount(component[i : i + turn], minlength=width)
            rest = walk[i + turn :]
            unsure[:] = spread
            np.maximum.at(unsure, rest // (self.starts.shape[1] - 1), at_most.ravel()[rest])
            bound = unsure.sum()
            least = np.partition(score[alive], len(alive) - k)[len(alive) - k] if len(alive) > k else -np.inf
            # the margin covers rounding of sums of very large products
            alive = alive[score[alive] + bound >= least - 1e-9 * (abs(least) + bound)]
        exact = self.vectors[alive] @ query
        top = np.lexsort((self.ids[alive], -exact))[:k]
        return alive[top], exact[top]


def build_index(vectors: DataFrame, width: int, block: int = BLOCK) -> DataFrame:
    """One row per block of up to ``block`` vectors."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                one = Block.of(part.column("id").to_numpy(), _matrix(part.column("vector"), width))
                yield pa.RecordBatch.from_arrays([pa.array([number]), *(pa.array([x.tobytes()], pa.binary()) for x in (one.ids, one.vectors, one.order, one.starts, one.edges))], names=["block", "ids", "vectors", "order", "starts", "edges"])
                number += 1

    return stored(vectors.mapInArrow(index, INDEX), "impact-index")


def _against(index: DataFrame, queries: list[tuple[int, list[int]]], base: int, width: int, k: int) -> DataFrame:
    asked = np.zeros((len(queries), width), np.int64)
    for i, (_, v) in enumerate(queries):
        asked[i, : len(v)] = v
    given = index.sparkSession.sparkContext.broadcast((np.array([q for q, _ in queries], np.int64), asked))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, asked = given.value
        for batch in batches:
            for i in range(batch.num_rows):
                read = {c: np.frombuffer(batch.column(c)[i].as_buffer(), np.int32 if c == "order" else np.int64) for c in ("ids", "vectors", "order", "starts", "edges")}
                one = Block(read["ids"], read["vectors"].reshape(-1, width), read["order"].reshape(width, -1), read["starts"].reshape(width, -1), read["edges"].reshape(2, width, -1))
                found = [one.best(q, own, k) for own, q in zip(ids, asked, strict=True)]
                each = np.repeat(np.arange(len(ids)), [len(r) for r, _ in found])
                rows, scores = (np.concatenate([f[j] for f in found]) for j in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(each + base), pa.array(ids[each]), pa.array(one.ids[rows]), pa.array(scores)], names=["query", "query_id", "vec_id", "score"])

    return index.mapInArrow(search, "query long, query_id long, vec_id long, score long")


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK, at_once: int = AT_ONCE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k best rows for each row of ``queries``, which go through the index ``at_once`` at a time."""
    vectors = integer_vectors(rows, id_col, vector_col)
    asked = integer_vectors(queries, id_col, vector_col).orderBy("id", "vector")
    width = max([1, *(r[0] or 0 for x in (vectors, asked) for r in x.agg(F.max(F.size("vector"))).collect())])
    spark = rows.sparkSession
    index = build_index(vectors, width, block).repartition(4 * spark.sparkContext.defaultParallelism)
    found, chunk, base = None, [], 0

    def pass_() -> DataFrame:
        out = _against(index, chunk, base, width, k)
        return out if found is None else found.union(out)

    for r in asked.toLocalIterator():
        chunk.append((r["id"], r["vector"]))
        if len(chunk) == at_once:
            found, base, chunk = pass_(), base + at_once, []
    if chunk:
        found = pass_()
    if found is None:
        found = spark.createDataFrame([], "query long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
