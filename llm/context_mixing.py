"""Language-model scoring by online logistic context mixing.

The model predicts a text's tokens - lower-cased words, then an end - in two
parts.  The bits of a token's class (short words by themselves, others by their
last letters) come one by one from five predictors: counts of ones and zeros
under contexts of growing length, each smoothed by the one before.  Their
logits are mixed by weights that are gated by the bit's place and learn online
within each text; a map of predicted to actual chances then refines the result.
The token within its class comes from its smoothed count.  So every text gets a
true probability over all texts of known words and, in each class, one unknown.

What is gathered: counts of every different word of the training texts (packed
blocks, by hash bucket, so that it grows with the corpus and no task holds it
all), and how often each class follows each context, the same way: a block sends
every different pair of context and class that it holds once and gets back what
all training texts have of it, so no table bounds what is told apart.

Words are told apart by 64-bit hashes, contexts by 56 bits.  Null and empty texts are just an end.
A null id counts as training.  Each row counts for itself, also if rows or ids
repeat.  Without training rows all counts are 0; without rows there is no result.
A text stays whole in its block, whatever its length: a block holds the different
contexts of its texts, five a token at most, with 36 bytes each once its verdicts
are read, so a text of a hundred million words is beyond one Python worker.  Other
columns are not read.  Hashes travel sorted, as steps of as many bytes as they need,
and counts in one byte where that is enough.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.packed import PACKED, from_bytes, judged_rows, pack_rows, range_cuts, to_bytes
from llm.quality import held_out
from llm.scratch import stored
from llm.words import NOT_SPACE, Words, blocks, lean, mixed, ragged

_U = np.uint64
COUNT_BYTES, SCORE_BYTES = 4 << 20, 2 << 20
#: Hash buckets for each input partition; pairs of context and class that a task gives their counts at once.
BUCKETS_EACH, SLICE = 4, 1 << 18
BITS = 8
CLASSES, END_CLASS = 1 << BITS, (1 << BITS) - 1
END = _U(0x0123456789ABCDEF)
RECORD = np.dtype([("hash", np.uint64), ("count", np.uint32)])

#: Counts of a class under a context: of the other bit at each node on the way to the class, then of the class.
PATH = np.dtype([("counts", np.float32, (BITS + 1,))])
#: Predictors: no context, last class, last two classes, last word, last two words.
PREDICTORS = 5
#: How many counts of the shorter context a longer one starts from.
TRUST = np.array([1.0, 4.0, 6.0, 8.0, 3.0], np.float32)
#: Weights at a text's start, tokens between updates, and the step of an update.
WEIGHTS, TURN, STEP = np.array([0.0, 0.1, 0.4, 0.25, 0.25], np.float32), 64, np.float32(0.01)
#: Refinement: buckets of the mixed logit, what the mix itself weighs in them, and the refined chance's part.
BUCKETS, PRIOR, REFINED = 12, np.float32(24), 0.3


class Tokens:
    """Word hashes of a block with an end after each text; ``first[i]:first[i + 1]`` are text i's."""

    def __init__(self, texts: pa.Array) -> None:
        words = Words(texts, NOT_SPACE, lower=True)
        self.counts = words.counts + 1
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        ends = self.first[1:] - 1
        is_word = np.ones(self.first[-1], bool)
        is_word[ends] = False
        self.hashes, self.classes = np.full(self.first[-1], END, _U), np.full(self.first[-1], END_CLASS, np.uint8)
        self.hashes[is_word] = words.hashes()
        last, length = words.fold[words.data[words.ends - 1]].astype(np.int64), words.ends - words.starts
        before = words.fold[words.data[np.maximum(words.ends - 2, words.starts)]].astype(np.int64)
        self.classes[is_word] = np.where(length <= 3, self.hashes[is_word] % _U(128), 128 + (last * 31 + before * 7) % (END_CLASS - 128))
        self.bytes = np.diff(words.offsets)


def narrow(values: np.ndarray, cuts: np.ndarray) -> Iterator[bytes]:
    """Each run ``values[cuts[i]:cuts[i + 1]]`` of counts in bytes: one each, two more from 255 on, eight more from 65,535 on."""
    large = np.flatnonzero(values >= 255)
    huge = large[values[large] >= 65_535]
    ones, twos, eights = np.minimum(values, 255).astype(np.uint8), np.minimum(values[large], 65_535).astype("<u2"), values[huge].astype("<u8")
    at = [x.tolist() for x in (cuts, np.searchsorted(large, cuts), np.searchsorted(huge, cuts))]
    for a, b, c, d, e, f in zip(*(y for x in at for y in (x, x[1:])), strict=False):
        yield b"".join((np.array([b - a, d - c], "<u4").tobytes(), ones[a:b].tobytes(), twos[c:d].tobytes(), eights[e:f].tobytes()))


def wide(parts: Iterable[memoryview]) -> np.ndarray:
    """The counts of runs that ``narrow`` made, one run after another."""
    ones, twos, eights = [], [], []
    for part in parts:
        a, b = np.frombuffer(part, "<u4", 2).tolist()
        ones.append(part[8 : 8 + a])
        twos.append(part[8 + a : 8 + a + 2 * b])
        eights.append(part[8 + a + 2 * b :])
    small, middle = np.frombuffer(b"".join(ones), np.uint8), np.frombuffer(b"".join(twos), "<u2")
    if not len(middle):
        return small
    middle, large = middle.astype(np.int64), np.frombuffer(b"".join(eights), "<u8")
    middle[middle == 65_535] = large
    values = small.astype(np.int64)
    values[small == 255] = middle
    return values


def sorted_rows(hashes: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Sorted hashes and their counts by bucket: the first hash, the steps to the next ones in byte planes, the counts."""
    cuts = range_cuts(hashes, buckets)
    full = np.flatnonzero(np.diff(cuts))
    cuts = np.append(cuts[full], len(hashes))
    steps = np.concatenate([hashes[:1], hashes[1:] - hashes[:-1]])
    steps[cuts[:-1]] = 0
    bounds = cuts.tolist()
    for bucket, a, b, part in zip(full.tolist(), bounds, bounds[1:], narrow(counts, cuts), strict=False):
        some = steps[a:b]
        planes = (int(some.max()).bit_length() + 7) // 8
        yield bucket, b"".join((np.array([b - a, planes], "<u4").tobytes(), hashes[a : a + 1].tobytes(), some.view(np.uint8).reshape(-1, 8).T[:planes].tobytes(), part))


def read_rows(rows: Iterable[pa.Buffer]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and counts of rows that ``sorted_rows`` made, and where each row begins, with the end."""
    hashes, counts, cuts = [], [], [0]
    for row in map(memoryview, rows):
        n, planes = np.frombuffer(row, "<u4", 2).tolist()
        some = np.zeros((n, 8), np.uint8)
        some[:, :planes] = np.frombuffer(row, np.uint8, n * planes, 16).reshape(planes, n).T
        hashes.append(np.cumsum(some.view(_U).ravel(), dtype=_U) + np.frombuffer(row, _U, 1, 8))
        counts.append(row[16 + n * planes :])
        cuts.append(cuts[-1] + n)
    return np.concatenate(hashes), wide(counts), np.array(cuts)


def heads(by: np.ndarray) -> np.ndarray:
    """Where each different one of sorted values begins."""
    return np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])) if len(by) else np.zeros(0, np.int64)


def word_counts(rows: DataFrame) -> DataFrame:
    """Per row of ``rows(id, name, held, text)``: tokens, known tokens, and the sum of log10(count + 0.5); once per block, tokens and different words of each class."""
    buckets = max(64, BUCKETS_EACH * rows.rdd.getNumPartitions())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in blocks(batch, "text", COUNT_BYTES):
                tokens = Tokens(part.column("text"))
                different, at, place = np.unique(tokens.hashes, return_index=True, return_inverse=True)
                train = ~part.column("held").to_numpy(zero_copy_only=False)
                own = np.bincount(place, np.repeat(train, tokens.counts), len(different)).astype(np.uint32)
                planes = np.frombuffer(place.astype("<u4").tobytes(), np.uint8).reshape(-1, 4).T
                info = pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.binary()) for x in (to_bytes(part.select(["id", "name", "held"])), tokens.counts.astype(np.int64).tobytes(), tokens.bytes.astype(np.int64).tobytes(), np.ascontiguousarray(planes).tobytes(), tokens.classes[at].tobytes(), own.tobytes())],
                    names=["rows", "counts", "bytes", "planes", "classes", "own"],
                )
                yield from pack_rows(number, sorted_rows(different, own, buckets), to_bytes(info, "zstd"), buckets)
                number += 1

    def judge(some: list[pa.Buffer]) -> Iterator[bytes]:
        """Twice the word's count in all texts; one more for its first record, if there are training tokens."""
        hashes, own, cuts = read_rows(some)
        order = np.argsort(hashes, kind="stable")
        at = heads(hashes[order])
        total = 2 * np.add.reduceat(own[order].astype(np.int64), at)
        out = np.empty(len(hashes), np.int64)
        out[order] = np.repeat(total, np.diff(np.append(at, len(order))))
        out[order[at]] += total > 0
        return narrow(out, cuts)

    def finish(info: bytes, some: list[pa.Buffer]) -> Iterator[pa.RecordBatch]:
        batch, verdicts = from_bytes(info), wide(map(memoryview, some)).astype(np.int64)
        read = lambda c, kind: np.frombuffer(batch.column(c)[0].as_py(), kind)
        rows, counts, classes = from_bytes(batch.column("rows")[0].as_py()), read("counts", np.int64), read("classes", np.uint8)
        place = np.ascontiguousarray(read("planes", np.uint8).reshape(4, -1).T).view("<u4").ravel()
        total = (verdicts >> 1)[place]
        first = np.concatenate([[0], np.cumsum(counts)])
        log = np.concatenate([[0.0], np.cumsum(np.log10(total + 0.5))])
        known = np.concatenate([[0], np.cumsum(total > 0)])
        by_class = [np.bincount(classes, read("own", np.uint32), CLASSES).astype(np.int64), np.bincount(classes, verdicts & 1, CLASSES).astype(np.int64)]
        of_block = [pa.array([x, *[None] * (rows.num_rows - 1)], pa.list_(pa.int64())) for x in by_class]
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(counts), pa.array(read("bytes", np.int64)), pa.array(known[first[1:]] - known[first[:-1]]), pa.array(log[first[1:]] - log[first[:-1]]), *of_block],
            names=["id", "name", "held", "n_tokens", "n_bytes", "n_known", "log_counts", "class_tokens", "class_words"],
        )

    packed = rows.mapInArrow(lean(emit), PACKED)
    return judged_rows(packed, buckets, judge, finish, "id long, name long, held boolean, n_tokens long, n_bytes long, n_known long, log_counts double, class_tokens array<long>, class_words array<long>")


def contexts(tokens: Tokens) -> np.ndarray:
    """For each predictor and token: 56 bits of its context's hash, and the token's class below them."""
    place = np.arange(len(tokens.hashes))
    since = place - np.repeat(tokens.first[:-1], tokens.counts)

    def back(values: np.ndarray, k: int, start: np.uint64) -> np.ndarray:
        return np.where(since >= k, values[np.maximum(place - k, 0)].astype(_U), start)

    c1, c2 = (back(tokens.classes, k, _U(END_CLASS)) for k in (1, 2))
    w1, w2 = (back(tokens.hashes, k, END) for k in (1, 2))
    out = np.empty((PREDICTORS, len(place)), _U)
    for i, context in enumerate((np.zeros(len(place), _U), c1, c1 << _U(BITS) | c2, w1, mixed(w1) + w2)):
        out[i] = mixed(mixed(context) + _U(i)) & ~_U(CLASSES - 1) | tokens.classes
    return out


def different_contexts(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The different contexts of a block with their classes, and where each predictor's and token's is among them."""
    some, places, n = [], [], 0
    for x in contexts(tokens):
        different, place = np.unique(x, return_inverse=True)
        some.append(different)
        places.append((place + n).astype(np.int32))
        n += len(different)
    return np.concatenate(some), np.stack(places)


def different_paths(of: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Of each of sorted, different contexts and classes: the counts along its path, BITS + 1 whole numbers."""
    paths, above = np.empty((len(of), BITS + 1), np.int64), count
    paths[:, BITS] = count
    for k in range(1, BITS + 1):
        node = of >> _U(k)
        head = heads(node)
        whole = np.repeat(np.add.reduceat(count, head), np.diff(np.append(head, len(of))))
        paths[:, BITS - k], above = whole - above, whole
    return paths


def path_counts(records: np.ndarray) -> np.ndarray:
    """Of each record's context and class: the PATH of the counts in all records."""
    order = np.argsort(records["hash"], kind="stable")
    by = records["hash"][order]
    at = heads(by)
    out = np.zeros(len(records), PATH)
    if len(at):
        paths = different_paths(by[at], np.add.reduceat(records["count"][order].astype(np.int64), at))
        out["counts"][order] = np.repeat(paths, np.diff(np.append(at, len(by))), axis=0)
    return out


def pieces(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring runs that end at ``ends``, each of about SLICE or of one run."""
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE, side="right")))
        yield i, j
        i = j


def path_rows(rows: list[pa.Buffer]) -> Iterator[bytes]:
    """For each of the rows (of ``sorted_rows``): for each of its hashes the counts along its path in all rows, those that are
    not 0 and always the last, with a bit for each that is there."""
    hashes, own, cuts = read_rows(rows)
    order = np.argsort(hashes, kind="stable")
    by = hashes[order]
    del hashes
    at = heads(by)
    of, count = by[at], np.add.reduceat(own[order].astype(np.int64), at)
    which = np.empty(len(by), np.int32)
    which[order] = np.repeat(np.arange(len(at), dtype=np.int32), np.diff(np.append(at, len(by))))
    del order, by, own, at
    ends = np.append(heads(of >> _U(BITS))[1:], len(of))  # of each context's classes
    masks, sizes, values = [], [], []
    for i, j in pieces(ends):
        lo, hi = int(ends[i - 1]) if i else 0, int(ends[j - 1])
        paths = different_paths(of[lo:hi], count[lo:hi])
        there = paths > 0
        there[:, BITS] = True
        masks.append(np.packbits(there[:, :BITS], axis=1).ravel())
        sizes.append(there.sum(1, dtype=np.uint8))
        found = paths[there]
        values.append(found.astype(np.uint32) if int(found.max()) < 1 << 32 else found)
    masks, sizes, values = (np.concatenate(x) for x in (masks, sizes, values))
    first = np.cumsum(sizes, dtype=np.int64) - sizes
    for i, j in pieces(cuts[1:]):
        w = which[cuts[i] : cuts[j]]
        lengths = sizes[w].astype(np.int64)
        runs = cuts[i : j + 1] - cuts[i]
        bounds, marks = runs.tolist(), masks[w]
        parts = narrow(values[ragged(first[w], lengths)], np.concatenate([[0], np.cumsum(lengths)])[runs])
        for a, b, part in zip(bounds, bounds[1:], parts, strict=False):
            yield b"".join((np.array([b - a], "<u4").tobytes(), marks[a:b].tobytes(), part))


def read_paths(rows: Iterable[pa.Buffer]) -> np.ndarray:
    """The PATH of each hash, from rows of ``path_rows``."""
    marks, parts = [], []
    for row in map(memoryview, rows):
        n = int(np.frombuffer(row, "<u4", 1)[0])
        marks.append(row[4 : 4 + n])
        parts.append(row[4 + n :])
    marks = np.frombuffer(b"".join(marks), np.uint8)
    out = np.zeros((len(marks), BITS + 1), np.float32)
    there = np.ones(out.shape, bool)
    there[:, :BITS] = np.unpackbits(marks[:, None], axis=1)
    out[there] = wide(parts)
    return out.view(PATH).ravel()


def block_scores(rows: DataFrame, within: np.ndarray) -> DataFrame:
    """Per row of ``rows(id, name, held, text)``: the model's log10 probability, less the sum of the log10 counts of its words."""
    buckets = max(64, BUCKETS_EACH * rows.rdd.getNumPartitions())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in blocks(batch, "text", SCORE_BYTES):
                tokens = Tokens(part.column("text"))
                some, places = different_contexts(tokens)
                train = np.repeat(~part.column("held").to_numpy(zero_copy_only=False), tokens.counts)
                counts = np.bincount(places[:, train].ravel(), minlength=len(some))
                order = np.argsort(some, kind="stable")
                parts = sorted_rows(some[order], counts[order], buckets)
                yield from pack_rows(number, parts, to_bytes(part.select(["id", "name", "text"]), "zstd"), buckets)
                number += 1

    def finish(info: bytes, rows: list[pa.Buffer]) -> Iterator[pa.RecordBatch]:
        part = from_bytes(info)
        tokens = Tokens(part.column("text"))
        some, places = different_contexts(tokens)
        rank = np.empty(len(some), np.int32)
        rank[np.argsort(some, kind="stable")] = np.arange(len(some), dtype=np.int32)
        logs = bit_logs(tokens, read_paths(rows), rank[places]) - np.add.reduceat(within[tokens.classes], tokens.first[:-1])
        yield pa.RecordBatch.from_arrays([part.column("id"), part.column("name"), pa.array(logs)], names=["id", "name", "logs"])

    return judged_rows(rows.mapInArrow(lean(emit), PACKED), buckets, path_rows, finish, "id long, name long, logs double")


def node_counts(tokens: Tokens, paths: np.ndarray, places: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ones and both (5, tokens, bits) that the predictors counted at the given tokens' nodes, and the bits (tokens, bits)."""
    bits = np.unpackbits(tokens.classes[place][:, None], axis=1)
    found = paths["counts"][places[:, place]]
    every = np.cumsum(found[..., ::-1], axis=-1)[..., ::-1]
    return np.where(bits, every[..., 1:], found[..., :-1]), every[..., :-1], bits


def bit_logs(tokens: Tokens, paths: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Per text of a block: log10 of the chance of its tokens' classes, by paths and each token's places in them."""
    n, one = len(tokens.counts), np.float32(1)
    total, weights = np.zeros(n), np.repeat(WEIGHTS, n * BITS).reshape(PREDICTORS, n, BITS)
    centre = (1 / (1 + np.exp((BUCKETS - 1) / 2 - np.arange(BUCKETS)))).astype(np.float32)
    seen = np.tile(PRIOR * np.stack([1 - centre, centre], 1).ravel(), n * BITS)
    longest = np.argsort(-tokens.counts, kind="stable")
    lengths = tokens.counts[longest]
    for at in range(0, int(lengths[0]) if n else 0, TURN):
        own = longest[: int(np.searchsorted(-lengths, -at, side="left"))]  # the texts that have a token here
        per = np.minimum(tokens.counts[own] - at, TURN)
        place = ragged(tokens.first[own] + at, per)
        who = np.repeat(own, per)
        ones, every, bits = node_counts(tokens, paths, places, place)
        logits, p, mixed_logit = np.empty_like(ones), np.float32(0.5), np.zeros(bits.shape, np.float32)
        for k, trust in enumerate(TRUST):
            p = np.clip((ones[k] + trust * p) / (every[k] + trust), np.float32(1e-5), np.float32(1 - 1e-5))
            np.log(p / (one - p), out=logits[k])
            mixed_logit += logits[k] * weights[k][who]
        np.clip(mixed_logit, -12, 12, out=mixed_logit)
        mix = one / (one + np.exp(-mixed_logit))
        bucket = np.clip(np.rint(mixed_logit + np.float32((BUCKETS - 1) / 2)), 0, BUCKETS - 1).astype(np.intp)
        cell = ((who * BITS)[:, None] + np.arange(BITS)) * BUCKETS + bucket
        refined = seen[2 * cell + 1] / (seen[2 * cell] + seen[2 * cell + 1])
        chance = np.float32(1 - REFINED) * mix + np.float32(REFINED) * refined
        chance = np.where(bits, chance, one - chance)
        starts = np.cumsum(per) - per
        total[own] += np.add.reduceat(np.log10(chance).sum(1, dtype=np.float64), starts)
        # learn from this turn before the next one
        err = STEP * (bits - mix)
        for k in range(PREDICTORS):
            weights[k][own] += np.add.reduceat(err * logits[k], starts, axis=0)
        np.add.at(seen, (2 * cell + bits).ravel(), one)
    return total


def mixing_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: token counts, the unigram log10 probability, the model's, and the model's bits per byte."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("name"), held_out(id_col, 5).alias("held"), F.col(text_col).alias("text"))
    counted = stored(word_counts(rows), "word-counts")
    of_class = np.zeros((2, CLASSES), np.int64)
    for k, column in enumerate(("class_tokens", "class_words")):
        for r in counted.select(F.posexplode(column).alias("c", "n")).groupBy("c").agg(F.sum("n").alias("n")).toLocalIterator():
            of_class[k, r["c"]] = r["n"]
    train_tokens, train_words = map(int, of_class.sum(1))
    within = np.log10(of_class[0] + 0.5 * of_class[1] + 0.5)
    logs = block_scores(rows, within).dropDuplicates(["id", "name"])
    base = F.col("log_counts") - F.col("n_tokens") * float(np.log10(train_tokens + 0.5 * (train_words + 1)))
    out = counted.alias("c").join(logs.alias("l"), F.expr("c.id <=> l.id AND c.name <=> l.name")).select("c.*", (F.col("logs") + F.col("log_counts")).alias("score"))
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") * float(np.log2(10)) / F.col("n_bytes"))
    return out.select(F.col("id").alias("doc_id"), F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score", bits.alias("bits_per_byte"))
