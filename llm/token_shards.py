"""Token ids of all texts in wavelet-matrix shards.

Texts are encoded with a public byte-level BPE file and written in ascending id
order, an end id after each.  A shard keeps its tokens as one bit-plane per bit
of an id, each plane ordered by the bits above it, with counts of ones before
every block: that gives the token at a place, the number of times a token stands
in a stretch, and the place of its k-th occurrence, without decoding the shard.

Encoding meets most words again and again.  A text is cut before every single
space between two characters that are surely no white space, and between an ASCII
letter and an ASCII mark; the pre-tokenizer's pattern always starts a new piece there, so the pieces' ids follow one another
unchanged.  Each different piece of a task is encoded once.

Null and empty texts have just the end id.  Null ids come first; rows with equal
ids come in the order of a hash of their texts.  Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.scratch import stored
from llm.words import blocks, byte_class, byte_hashes, keeps, lean, ragged

BLOCK_BYTES = 8 << 20
SHARD_TOKENS = 1 << 20
END_ID = 2
#: Bytes that the pieces which a Python worker remembers may take, from task to task; what doesn't fit is encoded again in
#: each block of texts.  An entry has a hash and a number, and tells where its text and its ids end, besides these.
REMEMBERED, ENTRY = 48 << 20, 28
TOGETHER = 256
#: Pieces whose ids are made, or put in their places, at once.
AT_ONCE = 1 << 14


class WaveletMatrix:
    """A sequence of small integers as bit-planes, highest bit first."""

    BLOCK = 512
    #: For each place in a block, the bits before it.
    UNTIL = np.packbits(np.arange(BLOCK) < np.arange(BLOCK)[:, None], axis=1, bitorder="little")

    def __init__(self, length: int, planes: list[np.ndarray], before: list[np.ndarray] | None = None) -> None:
        self.length, self.planes = length, planes  # bits packed into bytes, lowest bit first
        step = self.BLOCK // 8
        self.before = before or []  # ones before each block
        for plane in planes if before is None else []:
            sums = np.add.reduceat(np.bitwise_count(plane), np.arange(0, len(plane), step), dtype=np.int64) if len(plane) else np.zeros(0, np.int64)
            self.before.append(np.concatenate([[0], np.cumsum(sums)]))
        self.zeros = [length - int(b[-1]) for b in self.before]

    @classmethod
    def of(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        planes, at = [], np.asarray(values)
        for k in range(bits - 1, -1, -1):
            ones = (at & at.dtype.type(1 << k)) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            if k:  # nothing stands below the last plane
                at = np.concatenate([np.compress(~ones, at), np.compress(ones, at)])
        return cls(len(values), planes)

    def to_bytes(self) -> bytes:
        """Length and number of planes, the planes, and their counts of ones before each block."""
        counts = [b.astype("<u4").tobytes() for b in self.before]
        return np.array([self.length, len(self.planes)], "<u8").tobytes() + b"".join([p.tobytes() for p in self.planes] + counts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        """The matrix of a file; neither planes nor counts are read through before they are asked."""
        length, bits = map(int, np.frombuffer(data, "<u8", 2))
        size = -(-length // 8)
        planes = np.frombuffer(data, np.uint8, bits * size, 16).reshape(bits, size)
        before = np.frombuffer(data, "<u4", offset=16 + bits * size).reshape(bits, -(-length // cls.BLOCK) + 1)
        return cls(length, list(planes), list(before))

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // self.BLOCK
        part = self.planes[plane][block * self.BLOCK // 8 : -(-i // 8)]
        rest = int(np.bitwise_count(part).sum())
        return int(self.before[plane][block]) + rest - (int(part[-1] >> (i % 8)).bit_count() if i % 8 else 0)

    def __getitem__(self, i: int) -> int:
        value = 0
        for p, plane in enumerate(self.planes):
            bit = int(plane[i // 8] >> (i % 8)) & 1
            ones = self._ones(p, i)
            i, value = (self.zeros[p] + ones if bit else i - ones), value << 1 | bit
        return value

    def _ones_at(self, plane: int, at: np.ndarray) -> np.ndarray:
        """The same for many places at once."""
        step = self.BLOCK // 8
        block, left = at // self.BLOCK, at % self.BLOCK
        blocks = np.zeros((len(self.before[plane]), step), np.uint8)
        blocks.reshape(-1)[: len(self.planes[plane])] = self.planes[plane]
        some = (blocks[block] & self.UNTIL[left]).view(np.uint64)
        return self.before[plane][block].astype(np.int64) + np.bitwise_count(some).sum(1, dtype=np.int64)

    def counts(self, value: int, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """How often the value stands in each stretch, by rank alone."""
        if value >> len(self.planes):
            return np.zeros(len(lows), np.int64)
        at = np.concatenate([lows, highs]).astype(np.int64)
        for p in range(len(self.planes)):
            ones = self._ones_at(p, at)
            at = self.zeros[p] + ones if value >> (len(self.planes) - 1 - p) & 1 else at - ones
        return at[len(lows) :] - at[: len(lows)]

    def _bounds(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the value's occurrences in places lo to hi stand below the last plane."""
        for p in range(len(self.planes)):
            a, b = self._ones(p, lo), self._ones(p, hi)
            lo, hi = (self.zeros[p] + a, self.zeros[p] + b) if value >> (len(self.planes) - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        if value >> len(self.planes):
            return 0
        a, b = self._bounds(value, lo, self.length if hi is None else hi)
        return b - a

    def _select(self, plane: int, k: int, one: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        before = self.before[plane].astype(np.int64)
        if not one:
            before = np.minimum(np.arange(len(before)) * self.BLOCK, self.length) - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = self.planes[plane][block * self.BLOCK // 8 : (block + 1) * self.BLOCK // 8]
        return block * self.BLOCK + int(np.flatnonzero(np.unpackbits(part, bitorder="little") == one)[k - int(before[block])])

    def find(self, value: int, k: int) -> int:
        """Place of the k-th occurrence, from 0; -1 if there are fewer."""
        lo, hi = self._bounds(value, 0, self.length) if not value >> len(self.planes) else (0, 0)
        if not 0 <= k < hi - lo:
            return -1
        i = lo + k
        for p in range(len(self.planes) - 1, -1, -1):
            one = value >> (len(self.planes) - 1 - p) & 1
            i = self._select(p, i - self.zeros[p] if one else i, one)
        return i

    def decode(self) -> np.ndarray:
        at = np.zeros(self.length, np.uint32 if len(self.planes) > 16 else np.uint16)
        for p in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[p], count=self.length, bitorder="little").view(bool)
            up, z = np.empty_like(at), self.zeros[p]
            up[np.flatnonzero(~ones)], up[np.flatnonzero(ones)] = at[:z], at[z:] | at.dtype.type(1 << (len(self.planes) - 1 - p))
            at = up
        return at


class Encoder:
    """Ids of whole texts, with every different piece encoded once."""

    SURE, LETTER = byte_class((0x21, 0x7E)), byte_class((0x41, 0x5A), (0x61, 0x7A))
    MARK = SURE & ~LETTER & ~byte_class((0x30, 0x39))
    #: Bytes that stand before the last, or as the first, byte of white space that is not ASCII.
    BEFORE_LAST, FIRST = byte_class((0x80, 0x81), (0x9A, 0x9A), (0xC2, 0xC2)), byte_class((0x80, 0xC2), (0xE1, 0xE3))

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        # a byte-level token has a character for each of its bytes; tokens added besides stand for themselves
        self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        self.bits = max(1, (size - 1).bit_length())
        self.kind = np.uint16 if self.bits <= 16 else np.uint32
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # remembered pieces by number: their texts and ids, and where each ends; and their hashes in order, with the numbers
        self.texts, self.flat = np.zeros(0, np.uint8), np.zeros(0, self.kind)
        self.text_ends, self.ends = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.used = 0

    @property
    def known(self) -> range:
        """Numbers of the remembered pieces."""
        return range(len(self.ends) - 1)

    def _begins_sure(self, first: np.ndarray) -> np.ndarray:
        """A character with this first byte is no white space."""
        return self.SURE[first] | ((first >= 0x80) & ~self.FIRST[first])

    def _ends_sure(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A character with this last byte, and this one before, is no white space."""
        return self.SURE[last] | ((last >= 0x80) & ~self.BEFORE_LAST[before])

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(data == 0x20)
        at = at[(at >= 2) & (at < len(data) - 1)]
        marked = np.zeros(len(data) + 1, bool)
        marked[at[self._ends_sure(data[at - 2], data[at - 1]) & self._begins_sure(data[at + 1])]] = True
        # a letter's piece ends before a mark, too
        marked[1:-1] |= self.LETTER[data[:-1]] & self.MARK[data[1:]]
        raw = data.tobytes()
        for token in self.added:  # no cut inside a token that was added to the vocabulary
            at = raw.find(token)
            while at >= 0:
                marked[at + 1 : at + len(token)] = False
                at = raw.find(token, at + 1)
        marked[offsets] = True
        return np.flatnonzero(marked)

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, and how many each has.  Pieces that begin with a space and a character that is surely no white
        space are encoded together, as one text, and told apart by their bytes; that is where the pattern cuts that text."""
        texts = pieces.to_pylist()
        data, ends = self._bytes(pieces)
        starts = np.concatenate([[0], ends[:-1]])
        second = data[np.minimum(starts + 1, len(data) - 1)]
        joined = (ends - starts > 1) & (data[starts] == 0x20) & self._begins_sure(second) & self._ends_sure(data[ends - 2], data[ends - 1])
        joined &= ~pc.match_substring(pieces, "<|").to_numpy(zero_copy_only=False)
        together, alone = np.flatnonzero(joined), np.flatnonzero(~joined)
        groups = ["".join([texts[i] for i in together[k : k + TOGETHER]]) for k in range(0, len(together), TOGETHER)]
        parts = self._ids(groups, AT_ONCE // TOGETHER) + self._ids([texts[i] for i in alone], AT_ONCE)
        first = np.concatenate([np.zeros(0, self.kind), *parts[: len(groups)]])
        cut = np.searchsorted(np.cumsum(self.lengths[first]), np.cumsum((ends - starts)[together])) + 1
        counts = np.zeros(len(texts), np.int64)
        counts[together] = np.diff(cut, prepend=0)
        counts[alone] = [len(x) for x in parts[len(groups) :]]
        mixed = np.concatenate([first, *parts[len(groups) :]])
        order = np.concatenate([together, alone])
        at = np.cumsum(counts[order]) - counts[order]
        back = np.empty(len(order), np.int64)
        back[order] = at
        return mixed[ragged(back, counts)], counts

    def _ids(self, texts: list[str], most: int) -> list[np.ndarray]:
        """The ids of each text.  What the tokenizer tells besides of a token is many times an id, so it tells of a few texts at a time."""
        return [np.array(e.ids, self.kind) for k in range(0, len(texts), most) for e in self.tokenizer.encode_batch_fast(texts[k : k + most], add_special_tokens=False)]

    @staticmethod
    def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts, and where each ends."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] else np.zeros(0, np.uint8)
        return data, offsets[1:] - offsets[0]

    def _recalled(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece, below 0 for one that is not remembered, and the hashes of all.  Equal hashes alone are not enough."""
        data, ends = self._bytes(pieces)
        starts = np.concatenate([[0], ends[:-1]])
        hashes = byte_hashes(data, starts, ends)
        number = np.full(len(pieces), -1, np.int32)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            like = self.numbers[at]
            lengths = self.text_ends[like + 1] - self.text_ends[like]
            same = np.flatnonzero((self.hashes[at] == hashes) & (lengths == ends - starts))
            like, lengths = like[same], lengths[same]
            if len(same):
                differ = self.texts[ragged(self.text_ends[like], lengths)] != data[ragged(starts[same], lengths)]
                alike = ~np.logical_or.reduceat(differ, np.cumsum(lengths) - lengths)
                number[same[alike]] = like[alike]
        return number, hashes

    def _remember(self, fresh: pa.Array, hashes: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> None:
        """Takes as many of the fresh pieces as there is room for; ``flat`` and ``ends`` have the ids of all pieces."""
        n = len(self.known)
        data, text_ends = self._bytes(fresh)
        costs = text_ends + (ends[n + 1 :] - ends[n]) * self.flat.itemsize + ENTRY * np.arange(1, len(fresh) + 1)
        room = int(np.searchsorted(costs, REMEMBERED - self.used, side="right"))
        if not room:
            return
        self.used += int(costs[room - 1])
        self.texts = np.concatenate([self.texts, data[: text_ends[room - 1]]])
        self.text_ends = np.concatenate([self.text_ends, self.text_ends[-1] + text_ends[:room]])
        self.ends = ends[: n + room + 1].copy()
        self.flat = flat[: self.ends[-1]].copy()
        order = np.argsort(hashes[:room])
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.numbers = np.insert(self.hashes, at, hashes[order]), np.insert(self.numbers, at, (n + order).astype(np.int32))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        texts = texts.fill_null("").cast(pa.large_string())
        if not len(texts):
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        data, ends = self._bytes(texts)
        offsets = np.concatenate([[0], ends])
        if not len(data):
            return np.zeros(0, self.kind), np.zeros(len(texts), np.int64)
        cuts = self._cuts(data, offsets)
        found = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        number, hashes = self._recalled(found.dictionary)
        missing, n = np.flatnonzero(number < 0), len(self.known)
        fresh = found.dictionary.take(pa.array(missing))
        ids, counts = self._encode(fresh) if len(missing) else (self.flat[:0], self.ends[:0])
        number[missing] = np.arange(n, n + len(missing))
        flat, begin = np.concatenate([self.flat, ids]), np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        if len(missing):
            self._remember(fresh, hashes[missing], flat, begin)
        lengths = np.diff(begin)
        each = number[found.indices.to_numpy()]
        so_far = np.concatenate([[0], np.cumsum(lengths[each])])
        out = np.empty(so_far[-1], self.kind)
        for k in range(0, len(each), AT_ONCE):
            some = each[k : k + AT_ONCE]
            out[so_far[k] : so_far[k + len(some)]] = flat[ragged(begin[some], lengths[some])]
        return out, np.diff(so_far[np.searchsorted(cuts, offsets)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


KIND = "token shards"
keeps(KIND, encoder.cache_clear)
SHARDS = "part int, shard long, ids array<long>, n_tokens array<long>, total long, file binary"


def write_shards(docs: DataFrame, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes the texts and writes them, in ascending id order, as a table of shards; returns the table as read back."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part_id, number = encoder(path), TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

        def shard() -> pa.RecordBatch:
            ids, counts = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            who = pa.concat_arrays([x[2] for x in held])
            file = WaveletMatrix.of(ids, max(own.bits, end_id.bit_length())).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part_id], pa.int32()), pa.array([number]), pa.array([who], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([len(ids)]), pa.array([file], pa.binary())],
                names=["part", "shard", "ids", "n_tokens", "total", "file"],
            )

        for batch in batches:
            for part in blocks(batch, "text", BLOCK_BYTES):
                ids, counts = own.encode(part.column("text"))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                held.append((ids, counts + 1, part.column("id")))
                if sum(len(x[0]) for x in held) >= shard_tokens:
                    yield shard()
                    number, held = number + 1, []
        if held:
            yield shard()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("name"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("id", "name").sortWithinPartitions("id", "name").select("id", "text")
    return stored(ordered.mapInArrow(lean(shards, KIND), SHARDS), "token-shards")


def read_shards(shards: DataFrame, end_id: int = END_ID) -> DataFrame:
    """Per text of the shards: its id, where its tokens start, how many they are, their checksum (from the decoded shard), and
    how many of them are the end id (by rank in the file)."""
    parts = shards.groupBy("part").agg(F.sum("total").alias("all"))
    until = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("all").over(until), F.lit(0)).alias("before"))
    until = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "shard", F.coalesce(F.sum("total").over(until), F.lit(0)).alias("within")).join(parts, "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column("file")[i].as_buffer())
                tokens = matrix.decode().astype("<u4")
                counts = batch.column("n_tokens")[i].values.to_numpy()
                ends = np.cumsum(counts)
                sums = [zlib.crc32(tokens[e - n : e]) for n, e in zip(counts, ends, strict=True)]
                each = pa.array(np.full(len(counts), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part").take(each), batch.column("shard").take(each), batch.column("ids")[i].values, pa.array(ends - counts), pa.array(counts), pa.array(sums, pa.int64()), pa.array(matrix.counts(end_id, ends - counts, ends))],
                    names=["part", "shard", "doc_id", "offset", "n_tokens", "ids_crc32", "n_end_ids"],
                )

    texts = shards.select("part", "shard", "ids", "n_tokens", "file").mapInArrow(lean(read, KIND), "part int, shard long, doc_id long, offset long, n_tokens long, ids_crc32 long, n_end_ids long")
    return texts.join(starts, ["part", "shard"]).select("doc_id", (F.col("before") + F.col("within") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "n_end_ids")
