"""Byte-level BPE of whole texts as a tree reduction: halves are encoded, and neighbours joined at their boundary.

Encoded stretches of a text form a monoid.  A text is halved until a part is short; a part's pieces (matches of the
pre-tokenizer's pattern) are encoded, and two neighbours are joined by encoding again only what the cut may have changed:

* Pieces.  A match looks at most REACH characters past its start and one past its end, so a piece of the left part that
  saw no end of the part stands.  From the first that doesn't, the pattern runs on over the cut until one of its matches
  ends where a piece of the right part ends; the pattern looks only ahead, so all pieces after that stand as well.
* Tokens of a piece that the cut divides.  A sequence of tokens is the encoding of its bytes if and only if every two
  neighbours are the encoding of theirs: merges within tokens happen in order of rank alike in the pair and in the whole,
  and the first merge across a boundary would happen in the pair, too.  A window of tokens around the cut is encoded
  again, and grows on the side whose boundary pair doesn't hold, until both hold; what lies outside then stands.

Long pieces (a text without spaces, say) are halved and joined in the same way, so no stretch of a text is merged as a
whole.  Decoding looks up the bytes of short runs of ids and concatenates them up the tree.

Null and empty texts have no tokens.  A text of any length costs its own tokens; repeated rows are encoded each.  Other
columns are not read.  The pattern has to cover every character, as the public ones do; one that doesn't is an error.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a leaf of the text's tree, bytes of a leaf of a piece's tree, ids of a leaf when decoding.
LEAF, PIECE_LEAF, IDS_LEAF = 1024, 64, 1024
#: Characters from its start that a match may look at whatever its own length: an apostrophe and two letters.
REACH = 3
#: Bytes of different pieces, and of pairs, that a worker remembers; what doesn't fit is encoded again.
REMEMBERED = 48 << 20


class Part:
    """An encoded stretch of a text: where its pieces end, how many ids each has, and all ids."""

    __slots__ = ("begin", "ends", "ids", "sizes")

    def __init__(self, begin: int, ends: array, sizes: array, ids: array) -> None:
        self.begin, self.ends, self.sizes, self.ids = begin, ends, sizes, ids


class TreeBPE:
    """Encoding and decoding by the ranks of a tiktoken file."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.merge = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})._core_bpe.encode_single_piece
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.room = REMEMBERED

    def _leaf(self, data: bytes) -> list[int]:
        """Ids by merges alone; the library gives a stretch that is a token as that token, reachable by merges or not."""
        if data not in self.ranks:
            return self.merge(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], len(self.ranks) << 32), i) for i in range(len(parts) - 1))
            if rank == len(self.ranks) << 32:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[x] for x in parts]

    def stretch(self, data: bytes) -> list[int]:
        """Ids of bytes by merges: halves, joined."""
        if len(data) <= PIECE_LEAF:
            return self._leaf(data) if data else []
        half = len(data) // 2
        return self.join_ids(self.stretch(data[:half]), self.stretch(data[half:]))

    def holds(self, a: int, b: int) -> bool:
        """Tokens a and b stay apart when their bytes meet."""
        found = self.pairs.get((a, b))
        if found is None:
            found = self._leaf(self.token[a] + self.token[b]) == [a, b]
            if self.room > 0:
                self.pairs[a, b] = found
                self.room -= 150
        return found

    def join_ids(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of the bytes of both: a window around the boundary is encoded again until its ends hold."""
        if not left or not right or self.holds(left[-1], right[0]):
            return left + right
        a, b = len(left) - 1, 1
        while True:
            middle = self._leaf(b"".join(map(self.token.__getitem__, chain(left[a:], right[:b]))))
            low, high = not a or self.holds(left[a - 1], middle[0]), b == len(right) or self.holds(middle[-1], right[b])
            if low and high:
                return left[:a] + middle + right[b:]
            if not low:
                a = max(0, a - (len(left) - a))
            if not high:
                b = min(len(right), 2 * b)

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of a whole piece."""
        found = self.pieces.get(text)
        if found is None:
            data = text.encode()
            found = (self.ranks[data],) if data in self.ranks else tuple(self.stretch(data))
            if self.room > 0 and len(data) <= PIECE_LEAF:
                self.pieces[text] = found
                self.room -= 200
        return found

    def _divided(self, text: str, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """Ids of a piece from those of its two parts."""
        data = text.encode() if len(left) + len(right) <= 2 * PIECE_LEAF else b""
        if data in self.ranks:
            return (self.ranks[data],)
        # a token that stands for a whole part need not come from merges
        a, b = (self._leaf(self.token[x[0]]) if len(x) == 1 else list(x) for x in (left, right))
        return tuple(self.join_ids(a, b))

    def leaf(self, text: str, begin: int, end: int) -> Part:
        found = self.pattern.findall(text, begin, end)
        known = self.pieces
        try:
            ids = [known[x] for x in found]
        except KeyError:
            ids = [self.piece(x) for x in found]
        ends = array("q", accumulate(map(len, found), initial=begin))[1:]
        if (ends[-1] if ends else begin) != end:
            raise ValueError("the pattern leaves characters out")
        return Part(begin, ends, array("I", map(len, ids)), array("I", chain.from_iterable(ids)))

    def join(self, text: str, left: Part, right: Part) -> Part:
        middle, end = right.begin, right.ends[-1]
        keep = len(left.ends)
        while keep:
            start = left.ends[keep - 2] if keep > 1 else left.begin
            if max(start + REACH, left.ends[keep - 1] + 1) <= middle:
                break
            keep -= 1
        at = left.ends[keep - 1] if keep else left.begin
        ids_kept = len(left.ids) - sum(left.sizes[keep:])
        passed, ids_passed = 0, 0  # pieces of the right part that end at or before this place
        ends, sizes, ids = array("q"), array("I"), array("I")
        whole = lambda start, stop: self.pattern.match(text, start, stop)
        while True:
            match = whole(at, end)
            if match is None or match.end() == at:
                raise ValueError("the pattern leaves characters out")
            start, at = at, match.end()
            last = None  # the ids of the right part's piece that ends last up to here
            while passed < len(right.ends) and right.ends[passed] <= at:
                last = ids_passed, ids_passed + right.sizes[passed]
                ids_passed, passed = last[1], passed + 1
            met = at == middle or (at > middle and right.ends[passed - 1] == at) if passed else at == middle
            first = left.ends[-2] if len(left.ends) > 1 else left.begin
            if start == first and start < middle < at and passed == 1 and met:
                own = self._divided(match[0], tuple(left.ids[len(left.ids) - left.sizes[-1] :]), tuple(right.ids[last[0] : last[1]]))
            else:
                own = self.piece(match[0])
            ends.append(at)
            sizes.append(len(own))
            ids.extend(own)
            if met:
                break
        return Part(left.begin, left.ends[:keep] + ends + right.ends[passed:], left.sizes[:keep] + sizes + right.sizes[passed:], left.ids[:ids_kept] + ids + right.ids[ids_passed:])

    def part(self, text: str, begin: int, end: int) -> Part:
        if end - begin <= LEAF:
            return self.leaf(text, begin, end)
        half = (begin + end) // 2
        return self.join(text, self.part(text, begin, half), self.part(text, half, end))

    def encode(self, text: str) -> array:
        return self.part(text, 0, len(text)).ids if text else array("I")

    def decode(self, ids: array) -> bytes:
        if len(ids) > IDS_LEAF:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return b"".join(itemgetter(*ids)(self.token)) if len(ids) > 1 else b"".join(self.token[i] for i in ids)


@lru_cache(maxsize=2)
def tree_bpe(path: str, pattern: str) -> TreeBPE:
    return TreeBPE(path, pattern)


def tree_tokens(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded)``: the ids of every text, and the bytes that decoding them gives."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tree_bpe(path, pattern)
        for who, text in _texts(batches):
            ids = own.encode(text)
            yield pa.RecordBatch.from_arrays([who, pa.array([ids], pa.list_(pa.int32())), pa.array([own.decode(ids)], pa.binary())], names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tokens, "doc_id long, ids array<int>, decoded binary")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, str]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0).slice(i, 1), batch.column(1)[i].as_py() or ""


def token_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text: how many ids it has, and the SHA-256 of the ids (32 bits each, little-endian) and of the decoded bytes."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tree_bpe(path, pattern)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for _, text in _texts(iter([batch])):
                ids = own.encode(text)
                counts.append(len(ids))
                of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
                of_ids.append(hashlib.sha256(_little(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _little(ids: array) -> bytes:
    import sys

    if ids.itemsize != 4 or sys.byteorder != "little":
        return b"".join(x.to_bytes(4, "little") for x in ids)
    return ids.tobytes()
