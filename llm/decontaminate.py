"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` stores, for every segment of documents, the segment's terms and
the positions of all their occurrences.  A segment holds whole documents, so a
phrase never crosses segments and each can be searched on its own: nothing is
shuffled but counts and matches.  ``phrase_matches`` orders the terms of each
phrase by their frequency in the whole index, intersects offset-adjusted
position lists from the rarest term on, and stops as soon as a list is empty.

A term is the 64-bit hash of a word.  A false match needs equal hashes of
different words at every position of a phrase.

Null and empty texts have no words.  Every input row, repeated or not, gets
one result row.  A null ``item_id`` counts as the id ``null``.  Columns other
than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.scratch import stored
from llm.words import ALNUM, Words, blocks, lean, ragged, sorted_order

#: Bytes of text in a segment: its lists stay far below what a JVM keeps apart as a huge object.
SEGMENT_BYTES = 512 << 10
#: Phrases that one pass over the index takes along; more go through it in further passes.
PHRASES_AT_ONCE = 200_000
INDEX = "segment long, doc_ids array<long>, n_words array<long>, terms binary, counts binary, positions binary"


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row per segment: its documents, its terms in order, and their positions, which count the segment's words."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in blocks(batch, "text", segment_bytes):
                words = Words(part.column("text"), ALNUM, lower=True)
                hashes = words.hashes()
                order = sorted_order(hashes)
                by = hashes[order]
                at = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])) if len(by) else np.zeros(0, np.int64)
                counts = np.diff(np.append(at, len(by))).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([part.column("id")], pa.list_(pa.int64())), pa.array([words.counts], pa.list_(pa.int64()))]
                    + [pa.array([x.tobytes()], pa.binary()) for x in (by[at], counts, order.astype(np.uint32))],
                    names=["segment", "doc_ids", "n_words", "terms", "counts", "positions"],
                )
                number += 1

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(lean(index), INDEX), "positional-index")


def phrases_of(items: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of ``width`` words, or all words of a shorter text: their terms and the ids of the texts that hold them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column("text"), ALNUM, lower=True)
            hashes, lengths = words.hashes(), np.minimum(words.counts, width)
            per = np.where(words.counts > 0, words.counts - lengths + 1, 0)
            starts = ragged(words.first[:-1], per)
            owner = np.repeat(np.arange(len(per)), per)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(owner)), pa.array([hashes[s : s + lengths[i]].tobytes() for s, i in zip(starts, owner, strict=True)], pa.binary())],
                names=["item", "phrase"],
            )

    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "item string, phrase binary").groupBy("phrase").agg(F.collect_set("item").alias("items"))


def frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How often each of the given terms, in order, occurs in the whole index."""
    wanted = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted.value), np.int64)
        for batch in batches:
            for t, c in zip(batch.column("terms"), batch.column("counts"), strict=True):
                has = np.frombuffer(t.as_buffer(), np.uint64)
                at = np.searchsorted(has, wanted.value)
                found = np.flatnonzero(at < len(has))
                found = found[has[at[found]] == wanted.value[found]]
                total[found] += np.frombuffer(c.as_buffer(), np.uint32)[at[found]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["i", "n"])

    out = np.zeros(len(terms), np.int64)
    for row in index.select("terms", "counts").mapInArrow(lean(count), "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["i"]] = row["n"]
    return out


class Segment:
    """Position lists of one row of the index."""

    def __init__(self, row: dict) -> None:
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.ends = np.cumsum(np.frombuffer(row["counts"], np.uint32), dtype=np.int64)
        self.positions = np.frombuffer(row["positions"], np.uint32)
        self.n_words = np.array(row["n_words"], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.n_words)])

    def has(self, terms: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.terms, terms)
        inside = at < len(self.terms)
        inside[inside] = self.terms[at[inside]] == terms[inside]
        return inside

    def lists(self, terms: np.ndarray) -> dict[int, np.ndarray]:
        at = np.searchsorted(self.terms, terms)
        return {int(t): self.positions[self.ends[i - 1] if i else 0 : self.ends[i]] for t, i in zip(terms, at, strict=True) if i < len(self.terms) and self.terms[i] == t}

    def phrase(self, lists: dict[int, np.ndarray], terms: np.ndarray, rarest_first: np.ndarray) -> np.ndarray:
        """Positions at which the terms follow one another within one document."""
        starts = None
        for k in rarest_first:
            held = lists.get(int(terms[k]))
            if held is None:
                return np.zeros(0, np.int64)
            if starts is None:
                starts = held.astype(np.int64) - k
                starts = starts[starts >= 0]
            else:
                at = np.searchsorted(held, starts + k)
                at[at == len(held)] = 0
                starts = starts[held[at] == starts + k]
            if not len(starts):
                return starts
        return starts[np.searchsorted(self.bounds, starts, side="right") == np.searchsorted(self.bounds, starts + len(terms) - 1, side="right")]

    def near(self, lists: dict[int, np.ndarray], terms: np.ndarray, span: int) -> np.ndarray:
        """First positions of shortest runs, of at most ``span`` words of one document, that hold all the terms."""
        terms = np.unique(terms)
        held = [lists.get(int(t)) for t in terms]
        if any(x is None for x in held):
            return np.zeros(0, np.int64)
        seed = np.unique(np.concatenate(held)).astype(np.int64)
        last = seed.copy()
        for x in held:  # the nearest occurrence at or after each start
            at = np.searchsorted(x, seed)
            seed, last, at = (y[at < len(x)] for y in (seed, last, at))
            last = np.maximum(last, x[at])
        keep = (last - seed < span) & (np.searchsorted(self.bounds, seed, side="right") == np.searchsorted(self.bounds, last, side="right"))
        seed, last = seed[keep], last[keep]
        return seed[np.append(last[1:] != last[:-1], True)] if len(seed) else seed


MATCHES = "segment long, row int, starts array<int>, ends array<int>, phrases array<long>, at array<int>"


def _search(index: DataFrame, chunk: list[bytes], base: int, span: int | None) -> DataFrame:
    phrases = [np.frombuffer(x, np.uint64) for x in chunk]
    terms = np.unique(np.concatenate(phrases))
    counts = frequencies(index, terms) if span is None else None
    orders = [np.argsort(counts[np.searchsorted(terms, p)], kind="stable") if span is None else None for p in phrases]
    given = index.sparkSession.sparkContext.broadcast((terms, phrases, orders))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, phrases, orders = given.value
        rarest = np.array([p[0 if o is None else o[0]] for p, o in zip(phrases, orders, strict=True)], np.uint64)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_buffer() if c in ("terms", "counts", "positions") else batch.column(c)[i].as_py() for c in batch.schema.names}
                segment = Segment(row)
                # only phrases whose rarest term the segment has can occur in it
                maybe = np.flatnonzero(segment.has(rarest))
                lists = segment.lists(terms)
                found = [segment.phrase(lists, phrases[i], orders[i]) if span is None else segment.near(lists, phrases[i], span) for i in maybe]
                which = np.repeat(maybe, [len(x) for x in found])
                starts = np.concatenate(found) if found else np.zeros(0, np.int64)
                if not len(starts):
                    continue
                lengths = np.array([len(p) if span is None else 1 for p in phrases])[which]
                doc = np.searchsorted(segment.bounds, starts, side="right") - 1
                order = np.lexsort((starts, doc))
                which, starts, lengths, doc = which[order], starts[order], lengths[order], doc[order]
                local = starts - segment.bounds[doc]
                cuts = np.flatnonzero(np.diff(doc)) + 1
                out = []
                for d, s, e, w in zip(doc[np.append(0, cuts)], np.split(local, cuts), np.split(local + lengths, cuts), np.split(which, cuts), strict=True):
                    reach = np.maximum.accumulate(e)
                    new = np.append(True, s[1:] > reach[:-1])
                    out.append({"segment": row["segment"], "row": int(d), "starts": s[new], "ends": reach[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)], "phrases": w + base, "at": s})
                yield pa.RecordBatch.from_pylist(out, pa.schema([("segment", pa.int64()), ("row", pa.int32()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("phrases", pa.list_(pa.int64())), ("at", pa.list_(pa.int32()))]))

    found = stored(index.mapInArrow(lean(search), MATCHES), "phrase-matches")
    given.destroy()  # one pass at a time holds its phrases on the executors
    return found


def _in_passes(index: DataFrame, phrases: DataFrame, span: int | None, at_once: int) -> DataFrame | None:
    """Matches of all phrases, ``at_once`` of them in each pass over the index."""
    out, chunk, base = None, [], 0
    for row in phrases.orderBy("phrase_id").toLocalIterator():
        chunk.append(bytes(row["phrase"]))
        if len(chunk) == at_once:
            found = _search(index, chunk, base, span)
            out, base, chunk = found if out is None else out.union(found), base + len(chunk), []
    if chunk:
        found = _search(index, chunk, base, span)
        out = found if out is None else out.union(found)
    return index.sparkSession.createDataFrame([], MATCHES) if out is None else out


def numbered(phrases: DataFrame) -> DataFrame:
    """The phrases with numbers from 0 in the order of their bytes, without a sort in one task."""
    spark = phrases.sparkSession
    parts = stored(phrases.repartitionByRange(spark.sparkContext.defaultParallelism, "phrase").sortWithinPartitions("phrase").select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("i"), "*"), "phrases")
    sizes = sorted((r["part"], r["n"]) for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist() if sizes else [0]
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before, strict=False)], "part int, before long")
    return parts.join(F.broadcast(offsets), "part").select((F.col("i") % F.lit(1 << 33) + F.col("before")).alias("phrase_id"), "phrase", "items")


def phrase_matches(index: DataFrame, phrases: DataFrame, at_once: int = PHRASES_AT_ONCE) -> DataFrame:
    """Exact occurrences: per document the merged runs of matched words, and each phrase with its place."""
    return _in_passes(index, phrases, None, at_once)


def proximity_matches(index: DataFrame, phrases: DataFrame, span: int, at_once: int = PHRASES_AT_ONCE) -> DataFrame:
    """Places at which all words of a phrase, in any order, stand within ``span`` words."""
    return _in_passes(index, phrases, span, at_once)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, segment_bytes: int = SEGMENT_BYTES, at_once: int = PHRASES_AT_ONCE) -> DataFrame:
    """Per document: its words, its words within benchmark windows, and the benchmark items whose windows occur."""
    index = build_index(docs, segment_bytes=segment_bytes)
    phrases = numbered(phrases_of(benchmark, width))
    found = phrase_matches(index, phrases, at_once)
    hit = (
        found.select("segment", "row", F.explode(F.arrays_zip("starts", "ends")).alias("run"))
        .select("segment", "row", F.explode(F.sequence("run.starts", F.col("run.ends") - 1)).alias("word"))
        .distinct().groupBy("segment", "row").agg(F.count("*").alias("n_hit"))
    )
    items = (
        found.select("segment", "row", F.explode(F.array_distinct("phrases")).alias("phrase_id")).join(phrases, "phrase_id")
        .select("segment", "row", F.explode("items").alias("item")).groupBy("segment", "row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("row", "doc"))
    items_or_none = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(hit, ["segment", "row"], "left").join(items, ["segment", "row"], "left").select(
        F.col("doc.doc_ids").alias("doc_id"), F.col("doc.n_words").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_or_none).cast("long").alias("n_items"), F.sha2(F.array_join(items_or_none, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
