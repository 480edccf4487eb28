"""Removal of long repeated word spans by compaction of a de Bruijn graph.

Every run of ``k`` words is an edge between its first and last ``k - 1`` words.
An edge that occurs twice or more is repeated; a chain of repeated edges of which
each has one successor and one predecessor in all places is one path.  Paths get
compacted and joined by their first edge and length; a path must have two source
coordinates or more.  The words that verified paths cover go.  Edges are told
apart by 64-bit hashes of their words, and their neighbours by 63 bits.

Most edges occur once.  A seed of ``m`` words is chosen in every window by least
hash; equal windows have equal seeds, so only windows with a seed that occurs
elsewhere get to the graph at all.  Seeds are counted by a shorter hash, which
can let windows pass but never loses one.

Null and empty texts have no words.  Each row, also if rows or ids repeat, is a
text of its own; a null id stays null.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.packed import PACKED, from_bytes, judged, pack, to_bytes
from llm.scratch import stored
from llm.words import NOT_SPACE, SLICE, Words, blocks, mixed, span_sums

_U = np.uint64
BLOCK_BYTES = 4 << 20
REPEATED, ONE_NEXT, ONE_BEFORE = 1, 2, 4
#: ``many``: the block has it in more than one place.  A neighbour of 0: the text ends there, or places differ.
SEED = np.dtype([("value", np.uint32), ("many", np.uint8)])
EDGE = np.dtype([("hash", np.uint64), ("before", np.uint64), ("next", np.uint64), ("many", np.uint8)])


def _sliding(values: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    """The least (or greatest) of each run of ``width`` values."""
    reach = 1
    while 2 * reach <= width:
        values = least(values[:-reach], values[reach:])
        reach *= 2
    more = width - reach
    return least(values[:-more], values[more:]) if more else values


class Seeded(Words):
    """The words of a block, the windows of k words, and the seed of each window."""

    def __init__(self, texts: pa.Array, k: int, m: int) -> None:
        super().__init__(texts, NOT_SPACE, lower=False)
        self.k, self.spread = k, k - m + 1
        self.h = self.hashes()
        n = len(self.h)
        self.is_start = np.arange(n) + k <= np.repeat(self.first[1:], self.counts)
        self.seed = np.full(n + self.spread - 1, np.iinfo(np.uint64).max, _U)
        for i in range(0, n - m + 1, SLICE):
            part = np.arange(i, min(i + SLICE, n - m + 1))
            self.seed[part] = mixed(span_sums(self.h[i : part[-1] + m], part - i, part - i + m))
        self.least = np.where(self.is_start, _sliding(self.seed, self.spread, np.minimum), _U(0)) if n else np.zeros(0, _U)
        best = _sliding(np.concatenate([np.zeros(self.spread - 1, _U), self.least]), self.spread, np.maximum) if n else self.least
        self.chosen = np.flatnonzero((best == self.seed[:n]) & (best > 0))

    def windows_with(self, seeds: np.ndarray) -> np.ndarray:
        """Starts of the windows whose seed is among those at the given places."""
        some = np.full(len(self.seed), np.iinfo(np.uint64).max, _U)
        some[seeds] = self.seed[seeds]
        return np.flatnonzero(self.is_start & (_sliding(some, self.spread, np.minimum) == self.least)) if len(self.h) else self.chosen

    def digest(self, runs: list[tuple[int, int]]) -> str:
        """SHA-256 of the words in the given runs, joined by one space."""
        sha, apart = hashlib.sha256(), b""
        for s, e in runs:
            for i in range(s, e, SLICE):
                j = min(e, i + SLICE)
                sha.update(apart + b" ".join(self.data[self.starts[i] : self.ends[j - 1]].tobytes().split()))
                apart = b" "
        return sha.hexdigest()


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in blocks(batch, "text", BLOCK_BYTES):
            yield number, part
            number += 1


def _runs(by: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])) if len(by) else np.zeros(0, np.int64)


def _twice(records: np.ndarray) -> np.ndarray:
    """Which seeds occur more than once in all blocks."""
    values = records["value"]
    packed = np.sort(values.astype(_U) << _U(32) | np.arange(len(values), dtype=_U))
    by = packed >> _U(32)
    again = np.zeros(len(values), bool)
    again[1:] |= by[1:] == by[:-1]
    again[:-1] |= by[1:] == by[:-1]
    out = np.zeros(len(values), np.uint8)
    out[(packed & _U(0xFFFFFFFF)).astype(np.int64)] = again
    return out | records["many"]


def _different_edges(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One record for each edge of a block, with its neighbours where all its places agree (else 0), and each place's record."""
    order = np.argsort(edges["hash"], kind="stable")
    at = _runs(edges["hash"][order])
    size = np.diff(np.append(at, len(order)))
    out = edges[order[at]]
    out["many"] = size > 1
    for field in ("next", "before") if len(at) else ():
        x = edges[field][order]
        out[field][np.minimum.reduceat(x, at) != np.maximum.reduceat(x, at)] = 0
    place = np.empty(len(order), np.uint32)
    place[order] = np.repeat(np.arange(len(at), dtype=np.uint32), size)
    return out, place


def _edge_verdicts(edges: np.ndarray) -> np.ndarray:
    """Flags in the low three bits, and above them a label by which the occurrences of a path are joined."""
    order = np.argsort(edges["hash"], kind="stable")
    by = edges["hash"][order]
    head = np.concatenate([[True], by[1:] != by[:-1]]) if len(by) else np.zeros(0, bool)
    at = np.flatnonzero(head)
    size = np.diff(np.append(at, len(by)))
    more = size > 1
    if len(at):
        more |= np.maximum.reduceat(edges["many"][order], at) > 0
    flags = (by[at] >> _U(35) << _U(3)).astype(np.uint32) | more.astype(np.uint32) * np.uint32(REPEATED)
    for field, bit in (("next", ONE_NEXT), ("before", ONE_BEFORE)):
        x = edges[field][order]
        if len(at):  # 0: the text ends or begins here
            flags |= ((np.minimum.reduceat(x, at) == np.maximum.reduceat(x, at)) & (x[at] > 0)).astype(np.uint32) * np.uint32(bit)
    out = np.empty(len(edges), np.uint32)
    out[order] = np.repeat(flags, size)
    return out


def seeds_elsewhere(rows: DataFrame, k: int, m: int) -> DataFrame:
    """Per row: its id, name, number of words, digest of all words, and which of its seeds occur elsewhere too (null: none)."""
    buckets = max(64, rows.rdd.getNumPartitions())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in _numbered(batches):
            words = Seeded(part.column("text"), k, m)
            values = words.seed[words.chosen]
            per = np.diff(np.searchsorted(words.chosen, words.first))
            digests = [words.digest([(s, e)]) for s, e in zip(words.first[:-1], words.first[1:], strict=True)]
            different, place, times = np.unique(values, return_inverse=True, return_counts=True)
            records = np.zeros(len(different), SEED)
            records["value"], records["many"] = different.astype(np.uint32), times > 1
            cuts = np.cumsum(per)[:-1]
            places = [x.astype(np.uint32).tobytes() for x in np.split(place, cuts)]
            info = pa.RecordBatch.from_arrays([part.column("id"), part.column("name"), pa.array(words.counts), pa.array(digests, pa.string()), pa.array(places, pa.binary())], names=["id", "name", "n_words", "digest", "places"])
            yield from pack(number, different >> _U(32), records, to_bytes(info), buckets)

    def finish(info: bytes, flags: np.ndarray) -> Iterator[pa.RecordBatch]:
        batch = from_bytes(info)
        texts = [flags[np.frombuffer(x.as_buffer(), np.uint32)] for x in batch.column("places")]
        each = [np.packbits(x).tobytes() if x.any() else None for x in texts]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "name", "n_words", "digest")), pa.array(each, pa.binary())], names=["id", "name", "n_words", "digest", "seeds"])

    packed = rows.mapInArrow(emit, PACKED)
    return judged(packed, buckets, SEED, _twice, finish, "id long, name long, n_words long, digest string, seeds binary")


def paths(texts: DataFrame, k: int, m: int) -> DataFrame:
    """Occurrences of compacted paths of repeated edges in ``texts(id, name, text, seeds)``."""
    buckets = max(64, texts.rdd.getNumPartitions())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in _numbered(batches):
            words = Seeded(part.column("text"), k, m)
            bits = [np.unpackbits(np.frombuffer(s.as_buffer(), np.uint8), count=n) for s, n in zip(part.column("seeds"), np.diff(np.searchsorted(words.chosen, words.first)), strict=True)]
            starts = words.windows_with(words.chosen[np.concatenate(bits).astype(bool)])
            edges = np.zeros(len(starts), EDGE)
            edges["hash"] = mixed(span_sums(words.h, starts, starts + k))
            tags = words.h | _U(1)
            owner = np.searchsorted(words.first, starts, side="right") - 1
            inner = starts > words.first[owner]
            edges["before"][inner] = tags[starts[inner] - 1]
            inner = starts + k < words.first[owner + 1]
            edges["next"][inner] = tags[starts[inner] + k]
            marks = np.zeros(len(words.h), bool)
            marks[starts] = True
            different, place = _different_edges(edges)
            info = pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (to_bytes(part.select(["id", "name"])), words.first.astype(np.int64).tobytes(), np.packbits(marks).tobytes(), place.tobytes())], names=["rows", "first", "marks", "place"])
            yield from pack(number, different["hash"] >> _U(20), different, to_bytes(info), buckets)

    def finish(info: bytes, verdicts: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows, first, marks, place = (x[0].as_py() for x in from_bytes(info).columns)
        rows, first = from_bytes(rows), np.frombuffer(first, np.int64)
        verdicts = verdicts[np.frombuffer(place, np.uint32)]
        keep = np.flatnonzero(verdicts & REPEATED)
        if not len(keep):
            return
        starts, f = np.flatnonzero(np.unpackbits(np.frombuffer(marks, np.uint8)))[keep], verdicts[keep]
        owner = np.searchsorted(first, starts, side="right") - 1
        at = starts - first[owner]
        joined = (owner[1:] == owner[:-1]) & (at[1:] == at[:-1] + 1) & (f[:-1] & ONE_NEXT > 0) & (f[1:] & ONE_BEFORE > 0)
        head = np.flatnonzero(np.concatenate([[True], ~joined]))
        tail = np.append(head[1:] - 1, len(keep) - 1)
        who = pa.array(owner[head])
        yield pa.RecordBatch.from_arrays([rows.column("id").take(who), rows.column("name").take(who), pa.array(at[head]), pa.array(at[tail] + k), pa.array(f[head].astype(np.int64) >> 3)], names=["id", "name", "start", "end", "edge"])

    packed = texts.mapInArrow(emit, PACKED)
    return judged(packed, buckets, EDGE, _edge_verdicts, finish, "id long, name long, start long, end long, edge long", np.uint32)


def repeated_spans_removed(docs: DataFrame, k: int = 35, m: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its words, how many of them repeated windows of k words cover, and the digest of the rest."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("name"), F.col(text_col).alias("text"))
    seen = stored(seeds_elsewhere(rows, k, m), "seeds")
    some = seen.where("seeds IS NOT NULL").select("id", "name", "seeds").dropDuplicates(["id", "name"])
    both = (rows["id"].eqNullSafe(some["id"])) & (rows["name"] == some["name"])
    texts = stored(rows.join(some, both).select(rows["id"], rows["name"], "text", "seeds"), "seeded-texts")
    found = stored(paths(texts.select("id", "name", "text", "seeds"), k, m), "paths")
    found = found.withColumn("length", F.col("end") - F.col("start"))
    # written by itself, so that the join below deals out both sides plainly and a hot path can be split
    real = stored(found.groupBy("edge", "length").agg(F.count("*").alias("places")).where("places > 1"), "real-paths")
    spans = found.join(real, ["edge", "length"]).select("id", "name", "start", "end").distinct()
    cover = spans.groupBy("id", "name").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    parts = texts.select("id", "name", "text").alias("t").join(cover.alias("c"), F.expr("t.id <=> c.id AND t.name = c.name"), "left").select("t.id", "t.text", F.col("c.spans.start").alias("starts"), F.col("c.spans.end").alias("ends"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", BLOCK_BYTES):
                words = Words(part.column("text"), NOT_SPACE, lower=False)
                gone, digests = [], []
                for i in range(part.num_rows):
                    lo, hi = int(words.first[i]), int(words.first[i + 1])
                    kept, at, lost = [], lo, 0
                    for s, e in zip(part.column("starts")[i].as_py() or (), part.column("ends")[i].as_py() or (), strict=True):
                        if s + lo > at:
                            kept.append((at, s + lo))
                        lost += max(0, e + lo - max(at, s + lo))
                        at = max(at, e + lo)
                    kept.append((at, hi))
                    gone.append(lost)
                    digests.append(Seeded.digest(words, kept))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(words.counts), pa.array(gone, pa.int64()), pa.array(digests, pa.string())], names=["id", "n_words", "n_removed", "kept_sha256"])

    changed = parts.mapInArrow(remove, "id long, n_words long, n_removed long, kept_sha256 string")
    same = seen.where("seeds IS NULL").select("id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("digest").alias("kept_sha256"))
    return changed.union(same).withColumnRenamed("id", "doc_id")
