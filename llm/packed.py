"""Group hashed records of all texts by value, in packed blocks instead of one row each.

A task packs the records of a block of texts by hash bucket; buckets that get none have no row.  Each bucket goes to one
place, where equal records meet and are judged, and the verdicts go back to their block in the order in which the records
were given.  What a block keeps for itself (``info``, and which bucket each record went to) travels in a row of its own,
dealt by the block's number: no bucket holds anything of a block but the records that hash there.

A block should give each different hash once, with what its occurrences have in common, and spread the verdict over them
when it comes back: a hash in a third of all texts is then one record for each block.  Buckets hold about as many records as
a block, so their number follows the number of input partitions and no place grows with the input; rows are never more
than records.

``judged`` holds all that meets in a place, and all verdicts of the blocks in a place.  ``judged_rows`` is for records of
many times the text's bytes: a task gets one bucket, and its blocks one after another, so that a Python worker holds one
bucket or one block, however many records there are; the caller packs records and verdicts as it sees fit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.words import lean, mixed

PACKED = "bucket int, block long, records binary, places binary, info binary"
JUDGED = "bucket int, block long, flags binary, places binary, info binary"
_NAMES = {s: [x.split()[0] for x in s.split(", ")] for s in (PACKED, JUDGED)}
_TYPES = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())


#: Bytes of a batch of rows that goes to Spark.
BATCH_BYTES = 1 << 20


def to_bytes(batch: pa.RecordBatch, compression: str | None = None) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=compression)) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def _place_type(buckets: int) -> type:
    return np.uint8 if buckets <= 1 << 8 else np.uint16 if buckets <= 1 << 16 else np.uint32


def _row(values: list, form: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, _TYPES, strict=True)], names=_NAMES[form])


def pack(block: int, hashes: np.ndarray, records: np.ndarray, info: bytes, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of PACKED for one block: its own information, and its records by bucket."""
    places = (hashes % np.uint64(buckets)).astype(_place_type(buckets))
    own_place = int(mixed(np.array([block], np.uint64))[0] % np.uint64(buckets))
    yield _row([own_place, block, None, places.tobytes(), info], PACKED)
    order = np.argsort(places, kind="stable")
    cuts = np.searchsorted(places[order], np.arange(buckets + 1))
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        yield _row([i, block, records[order[cuts[i] : cuts[i + 1]]].tobytes(), None, None], PACKED)


def judged(packed: DataFrame, buckets: int, kind: np.dtype, judge: Callable[[np.ndarray], np.ndarray], finish: Callable[[bytes, np.ndarray], Iterator[pa.RecordBatch]], schema: str, verdict: type = np.uint8) -> DataFrame:
    """``judge`` gets all records of a bucket and gives a verdict for each; ``finish`` gets a block's information and verdicts."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("info")[i].is_valid:  # goes on to its block
                    yield batch.slice(i, 1).rename_columns(_NAMES[JUDGED])
                else:
                    held.setdefault(batch.column("bucket")[i].as_py(), []).append(batch.slice(i, 1))
        while held:
            _, some = held.popitem()
            parts = [np.frombuffer(x.column("records")[0].as_buffer(), kind) for x in some]
            flags = np.split(judge(np.concatenate(parts)), np.cumsum([len(x) for x in parts])[:-1])
            for x, f in zip(some, flags, strict=True):
                yield _row([x.column("bucket")[0].as_py(), x.column("block")[0].as_py(), f.astype(verdict).tobytes(), None, None], JUDGED)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[int, bytes]] = {}
        own: dict[int, tuple[bytes, bytes]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["info"] is None:
                    held.setdefault(row["block"], {})[row["bucket"]] = row["flags"]
                else:
                    own[row["block"]] = row["places"], row["info"]
        while own:
            block, (places, info) = own.popitem()
            found = held.pop(block, {})
            order = np.argsort(np.frombuffer(places, _place_type(buckets)), kind="stable")
            flags = np.empty(len(order), verdict)
            flags[order] = np.frombuffer(b"".join(found[i] for i in sorted(found)), verdict)
            yield from finish(info, flags)

    met = packed.repartition(buckets, "bucket").mapInArrow(lean(meet), JUDGED)
    return met.repartition(buckets, "block").mapInArrow(lean(back), schema)


def _rows(rows: Iterable[tuple], form: str) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about BATCH_BYTES."""
    some, held = [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*some, strict=True), _TYPES, strict=True)], names=_NAMES[form])

    for row in rows:
        some.append(row)
        held += sum(len(x) for x in row[2:] if x is not None)
        if held >= BATCH_BYTES:
            yield made()
            some, held = [], 0
    if some:
        yield made()


def range_cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of the sorted hashes begins, and the end: bucket i has the i-th share of all 64-bit numbers."""
    return np.searchsorted((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1))


def pack_rows(block: int, parts: Iterable[tuple[int, bytes]], info: bytes, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of PACKED for one block: its own information, and the given bytes for each bucket, in order of buckets."""
    own_place = int(mixed(np.array([block], np.uint64))[0] % np.uint64(buckets))
    yield _row([own_place, block, None, None, info], PACKED)
    yield from _rows(((i, block, x, None, None) for i, x in parts), PACKED)


def judged_rows(packed: DataFrame, buckets: int, judge: Callable[[list[pa.Buffer]], Iterable[bytes]], finish: Callable[[bytes, list[pa.Buffer]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``judge`` gets the bytes that all blocks gave a bucket and gives each its verdicts' bytes; ``finish`` gets a block's information and the verdicts of its buckets, in order."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, pa.Buffer]]] = {}
        for batch in batches:
            own = batch.filter(pc.is_valid(batch.column("info")))
            if own.num_rows:  # goes on to its block, before all verdicts
                yield own.set_column(0, "bucket", pa.array([-1] * own.num_rows, pa.int32())).rename_columns(_NAMES[JUDGED])
            for i, block, records in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist(), batch.column("records"), strict=True):
                if records.is_valid:
                    held.setdefault(i, []).append((block, records.as_buffer()))
        while held:
            i, some = held.popitem()
            flags = judge([x for _, x in some])
            yield from _rows(((i, block, x, None, None) for (block, _), x in zip(some, flags, strict=True)), JUDGED)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info, found = None, []
        for batch in batches:  # a block's information comes before its verdicts
            for own, flags in zip(batch.column("info"), batch.column("flags"), strict=True):
                if own.is_valid:
                    if info is not None:
                        yield from finish(info, found)
                    info, found = own.as_py(), []
                else:
                    found.append(flags.as_buffer())
        if info is not None:
            yield from finish(info, found)

    # each bucket is dealt to a task of its own; blocks of equal place in all partitions to neighbours, and those places evenly
    met = packed.repartitionById(buckets, F.col("bucket")).mapInArrow(lean(meet), JUDGED)
    place = F.expr(f"cast(pmod(shiftright(block, 32) + cast(floor((block & 4294967295) * 0.6180339887498949D * {buckets}) as bigint), {buckets}) as int)")
    return met.repartitionById(buckets, place).sortWithinPartitions("block", "bucket").mapInArrow(lean(back), schema)
