"""N-gram Jaccard self-join by parity sketches.

A text's set are its distinct word shingles.  Its sketch has one 64-bit word per
segment: the XOR of the hashes of the shingles that fall into the segment.  A
shingle in just one of two sets changes one segment, so the number of differing
segments is at most the size of the symmetric difference.  Within a size band,
two linked sets differ in at most ``d`` shingles; with more than ``d`` segments
they agree in one at least, and an equi-join on segments finds them.

What keeps the join small without losing a link:

* Equal sets become one node, found by their 128-bit hash.
* Shingles that no other text has are counted beforehand (by hash buckets, in
  packed blocks).  They are in no intersection, so a set with more than a share of
  1 - num / den of them has no partner, and pairs are bounded by the shared part of both.
* Segments of fewer than two shingles, which many texts share by chance, serve
  only sets that have too few other segments for the argument above; empty ones
  only sets that have too few of one shingle or more.
* Small sets with few shingles a segment would often have empty ones.  They join
  on their least shingles, by hash, of which two linked sets must share one.
* First every text is verified against one other only, of the first members of
  the groups of equal segments that it is in.  Groups that this has joined into
  one component are done.  In the others, texts meet the first member, and then
  what is still apart from it meets all.
* There, only pairs go on to be verified whose bit sketches allow a link: one bit
  for each shingle, so that the sketches' Hamming distance, too, is at most the
  size of the symmetric difference.

Links are verified on exact sets of 64-bit shingle hashes.

Null and empty texts have an empty set and are linked with nothing.  Every row
counts as a text of its own, also if rows or ids repeat; a component is named by
the smallest id that is not null.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.components import components
from llm.packed import PACKED, from_bytes, judged, pack, to_bytes
from llm.scratch import stored
from llm.words import NOT_SPACE, Words, blocks, lean, mixed, ragged, sorted_order, span_sums

_U = np.uint64
BLOCK_BYTES = 4 << 20
#: 64-bit words of a text's bit sketch.
SKETCH = 8
#: Size bands up to here join on least shingles where their segments hold fewer than four.
SMALL = 26
#: ``many``: more than one text of the block has it.
SHINGLE = np.dtype([("value", np.uint32), ("many", np.uint8)])


class Sets:
    """Distinct shingle hashes of each text, sorted; ``first[i]:first[i + 1]`` are those of text i."""

    def __init__(self, texts: pa.Array, k: int) -> None:
        words = Words(texts, NOT_SPACE, lower=True)
        hashes = words.hashes()
        length = np.minimum(words.counts, k)
        per = np.where(words.counts > 0, words.counts - length + 1, 0)
        starts, sizes = ragged(words.first[:-1], per), np.repeat(length, per)
        values = mixed(span_sums(hashes, starts, starts + sizes) ^ sizes.astype(_U))
        cuts = np.concatenate([[0], np.cumsum(per)])
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            values[i:j].sort()
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        new[cuts[:-1][per > 0]] = True
        self.values = values[new]
        self.first = np.concatenate([[0], np.cumsum(new)])[cuts]
        self.n = np.diff(self.first)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each set."""
        out = []
        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
            total = np.concatenate([np.zeros(1, _U), np.cumsum(mixed(self.values ^ _U(salt)), dtype=_U)])
            out.append((total[self.first[1:]] - total[self.first[:-1]]).view(np.int64))
        return out[0], out[1]


def _alone(records: np.ndarray) -> np.ndarray:
    """Which shingles no other block has, and their own in one text only."""
    values = records["value"]
    packed = np.sort(values.astype(_U) << _U(32) | np.arange(len(values), dtype=_U))
    by = packed >> _U(32)
    lone = np.ones(len(values), bool)
    lone[1:] &= by[1:] != by[:-1]
    lone[:-1] &= by[1:] != by[:-1]
    out = np.zeros(len(values), np.uint8)
    out[(packed & _U(0xFFFFFFFF)).astype(np.int64)[lone]] = 1
    return out & (records["many"] == 0)


def set_sizes(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, set size n, the set's two hashes a and b, and how many of its shingles are surely in no other row.

    A block sends each of its different shingles once.  Those of one text come first, text by text, so the block needs only
    their number in each text to count the verdicts; those of several texts are known not to be alone."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    buckets = max(64, rows.rdd.getNumPartitions())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in blocks(batch, "text", BLOCK_BYTES):
                sets = Sets(part.column("text"), k)
                order = sorted_order(sets.values)
                by = sets.values[order]
                head = np.concatenate([[True], by[1:] != by[:-1]]) if len(by) else np.zeros(0, bool)
                once = head & np.append(head[1:], True) if len(by) else head
                single = np.zeros(len(by), bool)
                single[order[once]] = True
                several = by[head & ~once]
                own = sets.values[single]
                values = np.concatenate([own, several])
                records = np.zeros(len(values), SHINGLE)
                records["value"] = values.astype(np.uint32)
                records["many"][len(own) :] = 1
                per = np.add.reduceat(np.append(single, False).astype(np.int64), sets.first[:-1]) * (sets.n > 0) if len(sets.n) else sets.n
                a, b = sets.names()
                info = pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets.n.astype(np.int32)), pa.array(a), pa.array(b), pa.array(per.astype(np.int64))], names=["id", "n", "a", "b", "per"])
                yield from pack(number, values >> _U(32), records, to_bytes(info), buckets)
                number += 1

    def finish(info: bytes, flags: np.ndarray) -> Iterator[pa.RecordBatch]:
        batch = from_bytes(info)
        per = batch.column("per").to_numpy()
        total, ends = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)]), np.cumsum(per)
        alone = total[ends] - total[ends - per]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "n", "a", "b")), pa.array(alone.astype(np.int32))], names=["id", "n", "a", "b", "alone"])

    return judged(rows.mapInArrow(lean(emit), PACKED), buckets, SHINGLE, _alone, finish, "id long, n int, a long, b long, alone int")


def _bands(top: int) -> np.ndarray:
    """Lower ends of the size bands, each at least half as long again as the one below."""
    out = [1]
    while out[-1] <= top:
        out.append(-(-out[-1] * 3 // 2) if out[-1] > 1 else 2)
    return np.array(out)


def sketch_keys(values: np.ndarray, num: int, den: int) -> np.ndarray:
    """Segment keys under which a set meets every partner of similarity num / den or more."""
    n = len(values)
    most = n * den // num
    lows = _bands(most)
    band = int(np.searchsorted(lows, n, side="right")) - 1
    out = []
    for b in range(band, int(np.searchsorted(lows, most, side="right"))):
        top = int(lows[b + 1]) - 1 if b + 1 < len(lows) else most
        widest = 2 * top * (den - num) // (den + num)
        segments = widest + 1 + (widest + 1) // 4
        differ = (n + min(top, most)) * (den - num) // (den + num)
        if not differ:
            continue
        if top <= SMALL and lows[b] < 4 * segments:
            out.append(mixed(np.sort(values)[: n - -(-n * num // den) + 1]))
            continue
        at = (mixed(values ^ _U(b + 1)) % _U(segments)).astype(np.int64)
        parity, count = np.zeros(segments, _U), np.bincount(at, minlength=segments)
        np.bitwise_xor.at(parity, at, values)
        # of two linked sets, the one with the higher bound agrees with the other in a segment that both use
        use = next((full for full in (count > 1, count > 0) if full.sum() > differ), np.ones(segments, bool))
        place = np.arange(segments, dtype=_U)[use] + _U(b << 40)
        out.append(mixed(mixed(parity[use] ^ mixed(place)) + count[use].astype(_U)))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, _U)


def bit_sketch(values: np.ndarray) -> np.ndarray:
    """One bit per value, those on the same bit cancelling out."""
    at = mixed(values ^ _U(0x082EFA98EC4E6C89))
    out = np.zeros(SKETCH, _U)
    np.bitwise_xor.at(out, ((at >> _U(6)) % _U(SKETCH)).astype(np.int64), _U(1) << (at & _U(63)))
    return out


def _near_enough(x: str, y: str, num: int, den: int) -> str:
    """SQL: the Hamming distance of the bit sketches is no more than a link's symmetric difference can be."""
    apart = " + ".join(f"bit_count({x}s{i} ^ {y}s{i})" for i in range(SKETCH))
    return f"{num + den}L * ({apart}) <= {den - num}L * ({x}n + {y}n)"


def _possible(x: str, y: str, num: int, den: int) -> str:
    """SQL: the sets' sizes, less the shingles that only one text has, leave room for a link."""
    return f"{num}L * ({x}n + {y}n) <= {num + den}L * least({x}n - {x}alone, {y}n - {y}alone)"


def _verified(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    sets = nodes.select("node", "shingles")
    both = pairs.join(sets.toDF("x", "sx"), "x").join(sets.toDF("y", "sy"), "y")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (p, q) in enumerate(zip(batch.column("sx"), batch.column("sy"), strict=True)):
                p, q = (np.frombuffer(z.as_buffer(), _U) for z in (p, q))
                every = np.sort(np.concatenate([p, q]))
                shared = int((every[1:] == every[:-1]).sum())
                keep[i] = den * shared >= num * (len(every) - shared)
            yield batch.select(["x", "y"]).filter(pa.array(keep))

    return both.select("x", "y", "sx", "sy").mapInArrow(lean(verify), "x long, y long")


def linked_nodes(nodes: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """All links that components need among ``nodes(node, n, alone, shingles)``, and the components."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [sketch_keys(np.frombuffer(s.as_buffer(), _U), num, den) for s in batch.column("shingles")]
            each = pa.array(np.repeat(np.arange(len(keys)), [len(x) for x in keys]))
            if len(each):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), *(batch.column(c).take(each) for c in ("node", "n", "alone"))], names=["key", "node", "n", "alone"])

    keys = stored(nodes.select("node", "n", "alone", "shingles").mapInArrow(lean(emit), "key long, node long, n int, alone int"), "sketch-keys")
    several = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("top")).where("low != top").select("key")
    shared = stored(keys.join(several, "key").withColumn("comp", F.col("node")), "shared-keys")

    def split(placed: DataFrame, more: list[str]) -> DataFrame:
        """Rows of the keys that hold several components, with the first member p of their key: the one with the fewest shingles of its own stands nearest to the others."""
        first = placed.groupBy("key").agg(F.min(F.struct("alone", "node", "n", "comp", *more)).alias("p"), F.min("comp").alias("low"), F.max("comp").alias("top")).where("low != top").select("key", "p")
        return stored(placed.join(first, "key"), "split-keys")

    def merged(placed: DataFrame, links: DataFrame) -> DataFrame:
        return placed.drop("comp", "p").join(components(links), "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    # one comparison for each text, with the first member nearest to the others of all its keys
    near = split(shared, []).where(f"node != p.node AND {_possible('', 'p.', num, den)}").groupBy(F.col("node").alias("x")).agg(F.min("p").alias("p"))
    links = stored(_verified(near.select("x", F.col("p.node").alias("y")), nodes, num, den), "first-links")
    sketches = [f"s{i}" for i in range(SKETCH)]
    apart = split(merged(shared, links), []).drop("p").join(nodes.select("node", *sketches), "node")
    # what is still apart meets the first members, then all of its keys
    apart = split(apart, sketches)
    star = apart.where(f"comp != p.comp AND {_possible('', 'p.', num, den)} AND {_near_enough('', 'p.', num, den)}").select(F.col("node").alias("x"), F.col("p.node").alias("y"))
    links = links.union(stored(_verified(star.distinct(), nodes, num, den), "star-links"))
    apart = split(merged(apart, links), sketches)
    apart = apart.withColumn("main", F.col("p.comp")).drop("p")
    cross = apart.where("comp != main").alias("k").join(apart.alias("q"), "key").where(f"k.comp != q.comp AND (q.comp = q.main OR k.node < q.node) AND {_possible('k.', 'q.', num, den)} AND {_near_enough('k.', 'q.', num, den)}")
    more = stored(_verified(cross.select(F.col("k.node").alias("x"), F.col("q.node").alias("y")).distinct(), nodes, num, den), "cross-links")
    links = links.union(more)
    return links, components(links)


def jaccard_components(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, the size of its set of k-word shingles, and the smallest id that links of similarity num / den reach."""
    sizes = stored(set_sizes(docs, k, id_col, text_col), "set-sizes")
    full = sizes.where("n > 0")
    named = stored(full.groupBy("a", "b", "n").agg(F.min("id").alias("low"), F.min("alone").alias("alone")), "set-names")
    able = named.where(f"{den}L * (n - alone) >= {num}L * n")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", BLOCK_BYTES):
                sets = Sets(part.column("text"), k)
                a, b = sets.names()
                each = [sets.values[i:j].tobytes() for i, j in zip(sets.first[:-1], sets.first[1:], strict=True)]
                bits = np.array([bit_sketch(sets.values[i:j]) for i, j in zip(sets.first[:-1], sets.first[1:], strict=True)], _U).reshape(-1, SKETCH).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(each, pa.binary()), *(pa.array(np.ascontiguousarray(x)) for x in bits.T)], names=["a", "b", "shingles", *(f"s{i}" for i in range(SKETCH))])

    wanted = able.select("low").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.join(wanted, texts["id"].eqNullSafe(wanted["low"]), "left_semi")
    sets = texts.select("text").mapInArrow(lean(shingles), "a long, b long, shingles binary, " + ", ".join(f"s{i} long" for i in range(SKETCH))).dropDuplicates(["a", "b"])
    nodes = stored(sets.join(able, ["a", "b"]).withColumn("node", F.monotonically_increasing_id()), "set-nodes")
    _, comps = linked_nodes(nodes, num, den)
    members = nodes.select("node", "a", "b", "low").join(comps, "node")
    lowest = members.groupBy("comp").agg(F.min("low").alias("component"))
    moved = stored(members.join(lowest, "comp").select("a", "b", "component"), "set-components")
    placed = full.join(named.select("a", "b", "low"), ["a", "b"]).join(moved, ["a", "b"], "left").select("id", "n", F.coalesce("component", "low").alias("c"))
    out = placed.union(sizes.where("n = 0").select("id", "n", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.col("c").alias("component_id"))
