"""Alignment of two tokenizers over the same bytes, and corpus-wide counts of linked ids.

A text is encoded by tokenizer A (byte-level BPE) and B (pieces with byte fallback).  Byte offsets where tokens of both end
cut its bytes into groups; an A and a B token are linked if their bytes overlap.  The ends of both are sorted lists, and
the shorter drives: each of its ends is sought in the longer by steps that double and then by halving.  Where an end is
common, a group ends; the ranks found for two ends that follow one another give the range of tokens that overlap the
token between them.  All ends of a block of texts are sought at once, in numpy.

Both tokenizers always part before a single space between two characters that are no white space (checked when the files
are read; else texts stay whole), so a text is cut there and each different chunk of a block is encoded and aligned once.

Counting: a block sends each different pair of ids once, with its links; Spark adds them up, finds the highest count of
each B id, and sends the verdicts back to the blocks that hold the pair, where they are summed over the links.  A pair in
a third of all links is one row for each block.  What a block keeps travels in pieces of PIECE_BYTES, so no row is large.

Null and empty texts, and texts whose bytes either tokenizer changes, have no tokens: zeros and an empty hash.  Rows count
each for itself, also if they or their ids repeat.  A text of any length stays in one block; a block has at least one text.
No rows: no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.packed import from_bytes, to_bytes
from llm.scratch import stored
from llm.words import blocks, byte_class, keeps, lean, ragged

#: Bytes of text in a block, of what it keeps in a row, and pairs of it in a row.
BLOCK_BYTES, PIECE_BYTES, PIECE_PAIRS = 8 << 20, 128 << 10, 8192
#: Different chunks that are encoded and aligned together; chunks that A encodes as one text.
CHUNKS, TOGETHER = 1 << 14, 256

GRAPHIC = byte_class((0x21, 0x7E))
#: First bytes of characters of two bytes that are never white space (U+00C0 to U+07FF), and bytes that follow a first byte.
PAIR, FOLLOWS = byte_class((0xC3, 0xDF)), byte_class((0x80, 0xBF))


def gallop(wanted: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each wanted end the first place from ``first`` to ``last`` whose end isn't less; ``ends[last]`` never is."""
    low, high, step = first.copy(), first.copy(), 1
    open_ones = np.flatnonzero(ends[high] < wanted)
    while len(open_ones):
        low[open_ones] = high[open_ones] + 1
        high[open_ones] = np.minimum(high[open_ones] + step, last[open_ones])
        open_ones, step = open_ones[ends[high[open_ones]] < wanted[open_ones]], 2 * step
    open_ones = np.flatnonzero(low < high)
    while len(open_ones):
        a, b = low[open_ones], high[open_ones]
        middle = (a + b) // 2
        less = ends[middle] < wanted[open_ones]
        low[open_ones], high[open_ones] = np.where(less, middle + 1, a), np.where(less, b, middle)
        open_ones = open_ones[low[open_ones] < high[open_ones]]
    return low


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level tokens."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + n): b for n, b in enumerate(sorted({*range(256)} - {*plain}))})
    return out


class _Vocabulary:
    """Bytes of each token, and each id in decimal with a comma."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(x) for x in tokens], np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        names = [b"%d," % i for i in range(len(tokens))]
        self.name_lengths = np.array([len(x) for x in names], np.int64)
        self.name_first = np.cumsum(self.name_lengths) - self.name_lengths
        self.names = np.frombuffer(b"".join(names), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.first[ids], self.lengths[ids])]


class Aligner:
    """Both tokenizers, and the alignment of chunks."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of_byte = _byte_characters()
        words = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.vocabulary_a = _Vocabulary([bytes(map(of_byte.get, x)) if all(c in of_byte for c in x) else x.encode() for x in words])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.vocabulary_b = _Vocabulary([bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)])
        with open(path_a, encoding="utf-8") as file:
            plan = json.load(file)
        byte_level = plan.get("normalizer") is None and (plan.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and plan["pre_tokenizer"].get("use_regex", True)
        self.parts = byte_level and not any("▁" in x.lstrip("▁") for x in pieces)

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where chunks begin, and the end of the data."""
        marked = np.zeros(len(data) + 1, bool)
        if self.parts:
            at = np.flatnonzero(data == 0x20)
            at = at[(at >= 2) & (at < len(data) - 1)]
            before = GRAPHIC[data[at - 1]] | (FOLLOWS[data[at - 1]] & PAIR[data[at - 2]])
            marked[at[before & (GRAPHIC[data[at + 1]] | PAIR[data[at + 1]])]] = True
        marked[offsets] = True
        return np.flatnonzero(marked)

    def encode_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has.  Chunks that surely part from their neighbours are encoded together."""
        plain = [self.parts and len(x) > 1 and x[0] == " " and "!" <= x[1] <= "~" and "!" <= x[-1] <= "~" for x in texts]
        together, alone = [i for i, x in enumerate(plain) if x], [i for i, x in enumerate(plain) if not x]
        groups = [together[k : k + TOGETHER] for k in range(0, len(together), TOGETHER)]
        encoded = self.a.encode_batch_fast(["".join([texts[i] for i in g]) for g in groups] + [texts[i] for i in alone], add_special_tokens=False)
        parts = [np.array(e.ids, np.int64) for e in encoded]
        joined = np.concatenate([np.zeros(0, np.int64), *parts[: len(groups)]])
        counts = np.zeros(len(texts), np.int64)
        if len(together):
            stops = np.cumsum([len(texts[i].encode()) for i in together])
            counts[together] = np.diff(np.searchsorted(np.cumsum(self.vocabulary_a.lengths[joined]), stops) + 1, prepend=0)
        counts[alone] = [len(x) for x in parts[len(groups) :]]
        order = np.array(together + alone, np.int64)
        first = np.empty(len(texts), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate([joined, *parts[len(groups) :]])[ragged(first, counts)], counts

    def encode_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of B, which adds the space itself."""
        parts = self.b.encode([x[1:] for x in texts], num_threads=1)
        counts = np.array([len(x) for x in parts], np.int64)
        return np.fromiter((i for x in parts for i in x), np.int64, int(counts.sum())), counts

    def align(self, texts: list[str]) -> Alignment:
        """Texts that begin with a space, aligned each for itself."""
        raw = [x.encode() for x in texts]
        sizes = np.array([len(x) for x in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        (ids_a, n_a), (ids_b, n_b) = self.encode_a(texts), self.encode_b(texts)
        same = self._unchanged(self.vocabulary_a, ids_a, n_a, data, sizes) & self._unchanged(self.vocabulary_b, ids_b, n_b, data, sizes)
        ids_a, ids_b = ids_a[np.repeat(same, n_a)], ids_b[np.repeat(same, n_b)]
        return Alignment(self, ids_a, np.where(same, n_a, 0), ids_b, np.where(same, n_b, 0), same)

    @staticmethod
    def _unchanged(vocabulary: _Vocabulary, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which texts' tokens join to their bytes."""
        own = np.concatenate([[0], np.cumsum(vocabulary.lengths[ids])])
        ends = np.cumsum(counts)
        first, got = own[ends - counts], own[ends] - own[ends - counts]
        same = got == sizes
        sizes_same = np.where(same, sizes, 0)
        equal = vocabulary.bytes_of(ids)[ragged(first, sizes_same)] == data[ragged(np.cumsum(sizes) - sizes, sizes_same)]
        wrong = np.concatenate([[0], np.cumsum(~equal)])
        stops = np.cumsum(sizes_same)
        return same & (wrong[stops] == wrong[stops - sizes_same])


class Alignment:
    """Groups and links of texts: ``n_a``, ``n_b``, ``n_groups``, ``n_links`` of each, the links' ids, the groups as bytes."""

    def __init__(self, own: Aligner, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray, same: np.ndarray) -> None:
        self.same, self.n_a, self.n_b = same, n_a, n_b
        lengths = own.vocabulary_a.lengths, own.vocabulary_b.lengths
        ends_a, ends_b = np.cumsum(lengths[0][ids_a]), np.cumsum(lengths[1][ids_b])
        texts = np.arange(len(n_a))
        of_a, of_b = np.repeat(texts, n_a), np.repeat(texts, n_b)
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        group_a, group_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        self.n_links = np.zeros(len(n_a), np.int64)
        pairs = []
        # the list with fewer ends drives: A's in some texts, B's in the others
        short_a = n_a <= n_b
        for drives, ids, of, ends, other_ids, other_ends, n_other, last_other, mine, others in (
            (short_a, ids_a, of_a, ends_a, ids_b, ends_b, n_b, last_b, group_a, group_b),
            (~short_a, ids_b, of_b, ends_b, ids_a, ends_a, n_a, last_a, group_b, group_a),
        ):
            lanes = np.flatnonzero(drives[of])
            if not len(lanes):
                continue
            text = of[lanes]
            first = (last_other - n_other)[text]
            found = gallop(ends[lanes], other_ends, first, last_other[text] - 1)
            common = other_ends[found] == ends[lanes]
            mine[lanes], others[found[common]] = common, True
            begins = np.concatenate([[True], text[1:] != text[:-1]])
            low = np.where(begins, first, np.concatenate([[0], found[:-1] + common[:-1]]))
            ranges = found - low + 1
            self.n_links += np.bincount(text, ranges, len(n_a)).astype(np.int64)
            linked = np.repeat(ids[lanes], ranges), other_ids[ragged(low, ranges)]
            pairs.append((np.repeat(text, ranges), *(linked if mine is group_a else linked[::-1])))
        empty = np.zeros(0, np.int64)
        link_of, link_a, link_b = (np.concatenate([empty, *(x[k] for x in pairs)]) for k in range(3))
        order = np.argsort(link_of, kind="stable")
        self.link_a, self.link_b = link_a[order], link_b[order]
        self.n_groups = np.bincount(of_a[group_a], minlength=len(n_a))
        self._name(own, ids_a, ids_b, group_a, group_b)

    def _name(self, own: Aligner, ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> None:
        """The groups of each text in decimal: ``a1,a2|b1;`` one after another."""
        which_a, which_b = np.cumsum(group_a) - group_a, np.cumsum(group_b) - group_b
        groups = int(group_a.sum())
        through_a, through_b = np.cumsum(np.bincount(which_a, minlength=groups)), np.cumsum(np.bincount(which_b, minlength=groups))
        before_b = np.concatenate([[0], through_b])
        place_a = np.arange(len(ids_a)) + before_b[which_a]
        place_b = np.arange(len(ids_b)) + through_a[which_b]
        n = len(ids_a) + len(ids_b)
        first, sizes, marks = np.empty(n, np.int64), np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        names = np.concatenate([own.vocabulary_a.names, own.vocabulary_b.names])
        first[place_a], first[place_b] = own.vocabulary_a.name_first[ids_a], own.vocabulary_b.name_first[ids_b] + len(own.vocabulary_a.names)
        sizes[place_a], sizes[place_b] = own.vocabulary_a.name_lengths[ids_a], own.vocabulary_b.name_lengths[ids_b]
        marks[place_a[group_a]], marks[place_b[group_b]] = ord("|"), ord(";")
        out = names[ragged(first, sizes)]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        out[stops[1:] - 1] = marks
        at, flat = stops[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist(), out.tobytes()
        self.groups = [flat[i:j] for i, j in zip(at, at[1:], strict=False)]


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


#: Tasks that need the tokenizers; others free them in their worker.
KIND = "aligner"
keeps(KIND, aligner.cache_clear)


def _sums(values: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[ends - counts]


_MADE = "part int, number long, at long, data binary, pairs array<long>, pair_links array<long>"
#: Columns of a block's texts, and what else it keeps.
_STILL = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "chunks": pa.int64()}
_KEPT = ("chunk_low", "chunk_high", "links", "link_pairs")
#: Places of a block's pieces among its rows: before all pairs.
_FIRST = -(1 << 40)
#: A pair of ids as one number.
_SHIFT = 32


def _block(own: Aligner, ids: pa.Array, texts: pa.Array, keep: bool) -> dict:
    """Aligns a block of texts: figures of each, its chunks, each chunk's links, and the block's different pairs."""
    full = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.fill_null("").cast(pa.large_string()), pa.scalar(" ", pa.large_string()))
    offsets = np.frombuffer(full.buffers()[1], np.int64)[full.offset : full.offset + len(full) + 1]
    data = np.frombuffer(full.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    cuts = own.cuts(data, offsets)
    found = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    each, n = found.indices.to_numpy().astype(np.int64), len(found.dictionary)
    # the commonest chunks get the lowest numbers, which take little room
    order = np.argsort(-np.bincount(each, minlength=n), kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    each, distinct = rank[each], found.dictionary.take(pa.array(order))
    made = [own.align(distinct.slice(i, CHUNKS).to_pylist()) for i in range(0, n, CHUNKS)]
    of = {k: np.concatenate([getattr(x, k) for x in made]) for k in ("same", "n_a", "n_b", "n_groups", "n_links", "link_a", "link_b")}
    groups = [x for y in made for x in y.groups]
    del made, found, distinct
    ends = np.searchsorted(cuts, offsets)
    counts = np.diff(ends)
    right = (_sums(~of["same"][each], ends[1:], counts) == 0) & (np.diff(offsets) > 1)  # an empty text is only the added space
    each, counts = each[np.repeat(right, counts)], np.where(right, counts, 0)
    ends = np.cumsum(counts)
    hashes, named = [], []
    for start, count in zip((ends - counts).tolist(), counts.tolist(), strict=True):
        text = b"".join([groups[i] for i in each[start : start + count].tolist()])[:-1]
        hashes.append(hashlib.sha256(text).hexdigest() if count else "")
        named.append(text.decode() if keep else None)
    times = np.bincount(each, minlength=n)
    pairs, place = np.unique(of["link_a"] << _SHIFT | of["link_b"], return_inverse=True)
    links = np.bincount(place, np.repeat(times, of["n_links"]), len(pairs)).astype(np.int64)
    return {
        "doc_id": ids, **{k: _sums(of[k][each], ends, counts) for k in ("n_a", "n_b", "n_groups", "n_links")}, "groups_sha256": hashes, **({"groups": named} if keep else {}), "chunks": counts,
        "chunk_low": (each & 0xFFFF).astype("<u2").tobytes(), "chunk_high": (each >> 16).astype("<u2").tobytes(), "links": of["n_links"].astype("<u4").tobytes(), "link_pairs": place.astype("<u4").tobytes(), "pairs": pairs, "pair_links": links,
    }


def _made_rows(part: int, number: int, block: dict) -> Iterator[pa.RecordBatch]:
    """A block as rows of _MADE: what it keeps in pieces, then its pairs."""
    kinds = _STILL | ({"groups": pa.string()} if "groups" in block else {})
    texts = pa.RecordBatch.from_arrays([pa.array(block[k], t) for k, t in kinds.items()], names=list(kinds))
    kept = [to_bytes(texts, "zstd"), *(block[k] for k in _KEPT)]
    data = to_bytes(pa.RecordBatch.from_arrays([pa.array([x], pa.large_binary()) for x in kept] + [pa.array([len(block["pairs"])])], names=["texts", *_KEPT, "n_pairs"]), "zstd")
    pieces = [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
    starts = range(0, len(block["pairs"]), PIECE_PAIRS)
    at = [*range(len(pieces)), *starts]
    cut = [pa.array([None] * len(pieces) + [block[k][i : i + PIECE_PAIRS] for i in starts], pa.list_(pa.int64())) for k in ("pairs", "pair_links")]
    columns = [pa.array([part] * len(at), pa.int32()), pa.array([number] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array(pieces + [None] * len(starts), pa.binary()), *cut]
    yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _MADE.split(", ")])


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Per text: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and ``groups``, if kept); and the
    table of linked ids: id_a, id_b, n_links, best."""
    spark = docs.sparkSession

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, number = aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in blocks(batch, "text", BLOCK_BYTES):
                yield from _made_rows(part, number, _block(own, some.column("id"), some.column("text"), keep_groups))
                number += 1

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    made = stored(rows.mapInArrow(lean(align, KIND), _MADE), "aligned-blocks")
    pairs = made.where("data IS NULL").select("part", "number", "at", F.posexplode(F.arrays_zip("pairs", "pair_links"))).select("part", "number", (F.col("at") + F.col("pos")).alias("pos"), F.col("col.pairs").alias("pair"), F.col("col.pair_links").alias("n_links"))
    totals = pairs.groupBy("pair").agg(F.sum("n_links").alias("n_links")).where("n_links > 0")
    totals = stored(totals.select("pair", F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1)).alias("id_b"), "n_links"), "linked-ids")
    highest = totals.groupBy("id_b").agg(F.max("n_links").alias("highest"))
    counted = stored(totals.join(highest, "id_b").select("pair", "n_links", (F.col("n_links") == F.col("highest")).alias("best")), "linked-counts")
    verdicts = pairs.select("part", "number", "pos", "pair").join(counted, "pair").select("part", "number", "pos", "n_links", "best")
    both = made.where("data IS NOT NULL").select("part", "number", (F.col("at") + F.lit(_FIRST)).alias("pos"), "data").unionByName(verdicts, allowMissingColumns=True)
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string" + ", groups string" * keep_groups
    names = [x.split()[0] for x in schema.split(", ")]

    def figures(pieces: list[pa.Buffer], verdicts: list[pa.RecordBatch]) -> pa.RecordBatch:
        kept = from_bytes(b"".join(pieces))
        block = {k: kept.column(k)[0].as_buffer() for k in ("texts", *_KEPT)}
        texts = from_bytes(block["texts"])
        totals, best = np.zeros(kept.column("n_pairs")[0].as_py(), np.int64), np.zeros(kept.column("n_pairs")[0].as_py(), np.int64)
        for some in verdicts:
            pos = some.column("pos").to_numpy()
            totals[pos], best[pos] = some.column("n_links").to_numpy(), some.column("best").to_numpy(zero_copy_only=False)
        at, sizes = np.frombuffer(block["link_pairs"], "<u4"), np.frombuffer(block["links"], "<u4").astype(np.int64)
        each = np.frombuffer(block["chunk_low"], "<u2").astype(np.int64) | np.frombuffer(block["chunk_high"], "<u2").astype(np.int64) << 16
        counts = texts.column("chunks").to_numpy()
        of = {"n_best": _sums(best[at], np.cumsum(sizes), sizes), "count_sum": _sums(totals[at], np.cumsum(sizes), sizes)}
        of = {k: pa.array(_sums(x[each], np.cumsum(counts), counts)) for k, x in of.items()}
        return pa.RecordBatch.from_arrays([of[k] if k in of else texts.column(k) for k in names], names=names)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, found = [], []
        for batch in batches:  # a block's pieces come first, then its verdicts
            pos = batch.column("pos").to_numpy()
            starts = sorted({0, *np.flatnonzero(pos == _FIRST).tolist()})
            for i, j in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                if i < j and pos[i] == _FIRST and pieces:
                    yield figures(pieces, found)
                    pieces, found = [], []
                k = i + int((pos[i:j] < 0).sum())
                pieces += [x.as_buffer() for x in batch.column("data").slice(i, k - i)]
                found += [batch.select(["pos", "n_links", "best"]).slice(k, j - k)] * (k < j)
        if pieces:
            yield figures(pieces, found)

    met = both.repartition("part", "number").sortWithinPartitions("part", "number", "pos")
    table = counted.select(F.shiftright("pair", _SHIFT).alias("id_a"), F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1)).alias("id_b"), "n_links", "best")
    return stored(met.mapInArrow(lean(finish), schema), "aligned-texts"), table
