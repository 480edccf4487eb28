"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of every whole text are computed once, by Spark, and stored.  The
trees are fitted on a bounded sample of labelled rows (``most_rows``, those of
least hash of the id; a bound on the driver's memory, not on what gets scored),
flattened into arrays and walked by numpy for all rows of a batch at once.

Labels of held-out ids, with crc32 of the id as text modulo 3 equal to 1, are
never read for fitting; neither the ids nor languages, sources or labels are
statistics.  Null and empty texts have statistics of zeros and a score like any
other.  A null id is not held out.  Without labels, or with labels of one kind
only, all scores are the same.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.scratch import stored
from llm.words import NOT_SPACE, Words, blocks, byte_class, lean, mixed

BLOCK_BYTES = 2 << 20
MOST_ROWS = 40_000
BINS, TREES, DEPTH, RATE, LEAST_LEAF, SMOOTH = 64, 80, 4, 0.15, 10, 1.0

#: Kinds of bytes whose shares are statistics.
KINDS = {
    "upper": byte_class((0x41, 0x5A)),
    "lower": byte_class((0x61, 0x7A)),
    "digit": byte_class((0x30, 0x39)),
    "blank": byte_class((0x20, 0x20), (0x09, 0x09)),
    "line_end": byte_class((0x0A, 0x0A)),
    "stop": byte_class((0x2C, 0x2C), (0x2E, 0x2E)),
    "shout": byte_class((0x21, 0x21), (0x3F, 0x3F)),
    "symbol": byte_class((0x23, 0x26), (0x2A, 0x2B), (0x40, 0x40), (0x5E, 0x60), (0x7E, 0x7E)),
    "bracket": byte_class((0x28, 0x29), (0x3C, 0x3E), (0x5B, 0x5D), (0x7B, 0x7B), (0x7D, 0x7D)),
    "bar": byte_class((0x7C, 0x7C)),
    "other": byte_class((0x80, 0xFF)),
}
NAMES = [*KINDS, "bytes", "words", "lines", "word_length", "word_spread", "longest_word", "short_words", "letter_words", "marked_words", "shouted_words", "line_words", "repeated_words", "repeated_lines", "most_common", "byte_entropy", "upper_starts"]


def _by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _sorted_within(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = hashes.copy()
    for i, j in zip(first[:-1], first[1:], strict=True):
        out[i:j].sort()
    return out


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of NAMES for each text."""
    words = Words(texts, NOT_SPACE, lower=False)
    lines = Words(texts, ~byte_class((0x0A, 0x0A)), lower=False)
    n = len(words.counts)
    of_byte = np.zeros(256, np.int64)
    for i, kind in enumerate(KINDS.values()):
        of_byte[kind] = i + 1
    owner = np.repeat(np.arange(n), np.diff(words.offsets))
    width = len(KINDS) + 1
    kinds = np.bincount(owner * width + of_byte[words.data], minlength=n * width).reshape(n, width)[:, 1:]
    size = np.diff(words.offsets)
    some, per = np.maximum(size, 1), np.maximum(words.counts, 1)
    bytes_ = np.bincount(owner * 256 + words.data, minlength=n * 256).reshape(n, 256) / some[:, None]
    entropy = -(bytes_ * np.log2(np.where(bytes_ > 0, bytes_, 1))).sum(1)
    length = (words.ends - words.starts).astype(float)
    head, last = words.data[words.starts], words.data[words.ends - 1]
    is_upper, marks = KINDS["upper"], KINDS["shout"] | KINDS["symbol"]
    mean = _by_text(length, words.first) / per
    spread = np.sqrt(np.maximum(_by_text(length**2, words.first) / per - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, np.repeat(np.arange(n), words.counts), length)
    hashes = words.hashes()
    by = _sorted_within(hashes, words.first)
    new = np.ones(len(by), bool)
    new[1:] = by[1:] != by[:-1]
    new[words.first[:-1][words.counts > 0]] = True
    runs = np.diff(np.append(np.flatnonzero(new), len(by)))
    common = np.zeros(n)
    np.maximum.at(common, np.repeat(np.arange(n), words.counts)[new], runs)
    line_by = _sorted_within(lines.hashes(), lines.first)
    line_new = np.ones(len(line_by), bool)
    line_new[1:] = line_by[1:] != line_by[:-1]
    line_new[lines.first[:-1][lines.counts > 0]] = True
    share = lambda flags: _by_text(flags, words.first) / per
    out = [
        np.log1p(size), np.log1p(words.counts), np.log1p(lines.counts), mean, spread, longest, share(length <= 3), share(length == 1), share(marks[last]), share(is_upper[head] & is_upper[words.data[np.maximum(words.ends - 2, words.starts)]] & (length > 1)),
        words.counts / np.maximum(lines.counts, 1), 1 - share(new), 1 - _by_text(line_new, lines.first) / np.maximum(lines.counts, 1), common / per, entropy, share(is_upper[head]),
    ]
    out[12] = np.where(lines.counts > 0, out[12], 0)
    out[11] = np.where(words.counts > 0, out[11], 0)
    return np.column_stack([kinds / some[:, None], *out]).astype(np.float32)


@dataclass
class Trees:
    """All trees in one set of arrays.  A leaf leads to itself."""

    start: float
    roots: np.ndarray
    column: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total, which = np.full(len(rows), self.start), np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(self.depth):
                at = np.where(rows[which, self.column[at]] <= self.limit[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit(rows: np.ndarray, labels: np.ndarray, bins: int = BINS, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Newton boosting of the logistic loss over binned columns, level by level."""
    mean = (labels.sum() + 0.5) / (len(labels) + 1)
    nodes: dict[str, list] = {k: [] for k in ("column", "limit", "left", "right", "value")}
    roots = []

    def leaf(value: float) -> int:
        at = len(nodes["value"])
        for k, v in zip(nodes, (0, np.inf, at, at, value), strict=True):
            nodes[k].append(v)
        return at

    if len(labels) and 0 < labels.sum() < len(labels):
        edges = [np.unique(np.quantile(rows[:, c], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in range(rows.shape[1])]
        binned = np.column_stack([np.searchsorted(e, rows[:, c]) for c, e in enumerate(edges)])  # bin b: above edge b - 1, at most edge b
        total = np.full(len(labels), np.log(mean / (1 - mean)))
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            pull, bend = labels - p, p * (1 - p)
            root = leaf(0.0)
            roots.append(root)
            here = np.full(len(labels), root)  # the node of each row
            level = [root]
            for d in range(depth + 1):
                slot = np.full(len(nodes["value"]), -1)
                slot[level] = np.arange(len(level))
                own = np.flatnonzero(slot[here] >= 0)
                s = slot[here[own]]
                g, h = (np.bincount(s, x[own], len(level)) for x in (pull, bend))
                for i, node in enumerate(level):
                    nodes["value"][node] = rate * g[i] / (h[i] + SMOOTH)
                if d == depth:
                    break
                best = [(1e-6, 0, 0)] * len(level)
                for c, e in enumerate(edges):
                    if not len(e):
                        continue
                    key, m = s * (len(e) + 1) + binned[own, c], len(level) * (len(e) + 1)
                    gl, hl, nl = (np.cumsum(np.bincount(key, w, m).reshape(len(level), -1), axis=1)[:, :-1] for w in (pull[own], bend[own], None))
                    n = np.bincount(s, minlength=len(level))[:, None]
                    gain = gl**2 / (hl + SMOOTH) + (g[:, None] - gl) ** 2 / (h[:, None] - hl + SMOOTH) - (g**2 / (h + SMOOTH))[:, None]
                    gain = np.where((nl >= LEAST_LEAF) & (n - nl >= LEAST_LEAF), gain, 0)
                    for i, b in enumerate(gain.argmax(1)):
                        if gain[i, b] > best[i][0]:
                            best[i] = (gain[i, b], c, b)
                below = []
                for i, node in enumerate(level):
                    if best[i][0] > 1e-6:
                        _, c, b = best[i]
                        nodes["column"][node], nodes["limit"][node] = c, float(edges[c][b])
                        nodes["left"][node], nodes["right"][node] = leaf(0.0), leaf(0.0)
                        below += [nodes["left"][node], nodes["right"][node]]
                        at = own[s == i]
                        here[at] = np.where(binned[at, c] <= b, nodes["left"][node], nodes["right"][node])
                level = below
                if not level:
                    break
            total += np.array(nodes["value"])[here]
    arrays = {k: np.array(v, np.float32 if k == "limit" else np.float64 if k == "value" else np.int64) for k, v in nodes.items()}
    return Trees(float(np.log(mean / (1 - mean))), np.array(roots, np.int64), depth=depth, **arrays)


def held_out(id_col: str, modulus: int = 3) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == 1, F.lit(False))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and statistics of each row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", BLOCK_BYTES):
                rows = statistics(part.column("text"))
                flat = pa.ListArray.from_arrays(np.arange(part.num_rows + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column("id"), flat], names=["id", "statistics"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(lean(measure), "id long, statistics array<float>")


def train(rows: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Trees:
    """Trees for ``rows(id, statistics)`` and ``labels(doc_id, quality)``, from at most ``most_rows`` that aren't held out."""
    known = labels.where(~held_out("doc_id")).where("quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), (F.col("quality") > 0).alias("good"))
    sample = rows.join(known, "id").orderBy(F.xxhash64("id"), "id", "good", "statistics").limit(most_rows).select("statistics", "good").toArrow()
    values = sample["statistics"].combine_chunks().flatten().to_numpy() if sample.num_rows else np.zeros(0, np.float32)
    return fit(values.reshape(-1, len(NAMES)), sample["good"].to_numpy().astype(float))


def quality_scores(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """Per row of ``docs``: whether its label is held out, its score, and the label that the score predicts."""
    rows = stored(measured(docs), "statistics")
    trees = train(rows, labels, most_rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("statistics").flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(trees.scores(values))], names=["id", "score"])

    out = rows.mapInArrow(score, "id long, score double")
    return out.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, all columns unchanged."""
    trees = train(stored(measured(docs, text_col=text_col), "statistics"), labels, most_rows)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text_col, BLOCK_BYTES):
                yield part.filter(pa.array(trees.scores(statistics(part.column(text_col))) >= 0.5))

    return docs.mapInArrow(lean(keep), docs.schema)
