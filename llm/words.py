"""Words of whole text columns as numpy arrays: positions and 64-bit hashes.

A word's hash is a polynomial over its bytes modulo 2**64, mixed at the end.
The sums run over slices of bounded size, so a batch with one very long text
needs no more memory than its own bytes and words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 19
_U = np.uint64
_BASE, _LEN, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_RANDOM = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes within the given closed ranges."""
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


#: All bytes but ASCII white space.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: ASCII letters and digits, and all bytes of other characters.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def lowered() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 32
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd base and of its inverse, as far as they were asked for."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, _U), np.ones(1, _U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = 1 << (n - 1).bit_length()
            inverse = _U(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (np.concatenate([[_U(1)], np.cumprod(np.full(n - 1, b, _U))]) for b in (_BASE, inverse))
        return self.up, self.down


_powers = _Powers()


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial of ``values[start:end]`` for each span; one span's sum doesn't depend on where it starts."""
    up, down = _powers.to(len(values) + 1)
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _RANDOM) -> np.ndarray:
    """The hash of each run of bytes; runs are in order and don't overlap."""
    out, i = np.empty(len(starts), _U), 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + SLICE)))
        lo, hi = starts[i], ends[j - 1]
        out[i:j] = span_sums(table[data[lo:hi]], starts[i:j] - lo, ends[i:j] - lo)
        i = j
    return mixed(out + (ends - starts).astype(_U) * _LEN)


class Words:
    """The words of a string array: ``starts`` and ``ends`` in ``data``, ``first[i]`: ``first[i + 1]`` are those of text i."""

    def __init__(self, texts: pa.Array, word_bytes: np.ndarray, lower: bool) -> None:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if texts.null_count:
            texts = texts.fill_null("")
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        offsets = np.frombuffer(texts.buffers()[1] or bytes(kind().itemsize), kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8) if len(texts) and texts.buffers()[2] else np.zeros(0, np.uint8)
        self.data = data[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.fold = lowered() if lower else np.arange(256, dtype=np.uint8)
        inside = word_bytes[self.data]
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.offsets] = True
        left, right = inside.copy(), inside.copy()
        left[1:] &= ~inside[:-1] | edge[1:-1]
        right[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(left), np.flatnonzero(right) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return byte_hashes(self.data, self.starts, self.ends, _RANDOM[self.fold])

    def word(self, i: int) -> bytes:
        return self.fold[self.data[self.starts[i] : self.ends[i]]].tobytes()


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and hashes of all runs of k words that lie within one text."""
    counts = np.diff(first)
    starts = np.arange(len(hashes))[np.arange(len(hashes)) + k <= np.repeat(first[1:], counts)]
    out = np.empty(len(starts), _U)
    for i in range(0, len(starts), SLICE):
        part = starts[i : i + SLICE]
        lo, hi = part[0], part[-1] + k
        out[i : i + SLICE] = span_sums(hashes[lo:hi], part - lo, part - lo + k)
    return starts, mixed(out ^ _U(k))


def blocks(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of whole rows, each of about ``most`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, total = 0, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def sorted_order(hashes: np.ndarray) -> np.ndarray:
    """Positions by hash, then position: one sort of packed numbers instead of an argsort."""
    n = len(hashes)
    low = _U(max(1, (n - 1).bit_length()))
    packed = np.sort(hashes >> low << low | np.arange(n, dtype=_U)) if n else hashes
    order = (packed & ((_U(1) << low) - _U(1))).astype(np.int64)
    by = hashes[order]
    return order if (by[1:] >= by[:-1]).all() else np.argsort(hashes, kind="stable")


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


#: What tasks keep in their Python worker for the next ones of their kind, and how each kind lets go of it.
_kept: dict[str, Callable[[], None]] = {}


def keeps(kind: str, let_go: Callable[[], None]) -> None:
    """Tasks of this kind (of ``lean``) keep something in their worker, which ``let_go`` frees."""
    _kept[kind] = let_go


def others_let_go(kind: str | None) -> None:
    for other, let_go in _kept.items():
        if other != kind:
            let_go()


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], kind: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task, giving the memory it has freed back to the system when it ends: its Python worker lives on for other tasks,
    and what an allocator keeps would count against the executor all the while.  What tasks of another kind keep in the worker
    goes when this one begins, for the same reason."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others_let_go(kind)
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # other C libraries have no such call
            pass

    return run
