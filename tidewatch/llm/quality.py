"""Operator 5: quality classifier, histogram gradient-boosted trees.

Every text is described by a fixed list of statistics (sizes, character
classes, words, lines, repetition).  Trees are grown level by level on binned
statistics with the logistic loss, on a bounded sample of the labelled rows
(``max_fit_rows``, smallest hash of the id first), and flattened into three
arrays, so that scoring walks all trees at once with numpy indexing.  Scoring
runs in the scan's own tasks, with no shuffle.

Defined cases: a null text counts as empty and gets the score of empty
statistics; labels that are null are ignored, and an id labelled twice counts
once by its mean label; a null doc_id is kept and is never a training row;
with no labelled rows every score is 0.5; an empty table gives no rows; other
input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import labelled_sample, one_per_id, ship, small_batches, texts

STATISTICS = (
    "bytes", "chars_per_byte", "words", "lines", "word_length", "distinct_words", "top_word",
    "lower", "upper", "digit", "space", "newline", "point_comma", "bar", "hash_dollar_percent",
    "and_star", "exclaim", "other_punctuation", "control", "high", "repeated_lines",
    "words_per_line", "short_words", "words_ending_in_letter", "upper_words", "longest_word",
)
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _byte_classes() -> np.ndarray:
    """256 x 13 table: class of each byte, in the order lower .. high."""
    groups = [
        b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r",
        b"\n", b".,;:", b"|", b"#$%", b"&*", b"!?",
    ]
    table = np.zeros((256, 13))
    for k, g in enumerate(groups):
        table[list(g), k] = 1
    rest = table.sum(1) == 0
    table[:, 11] = rest & (np.arange(256) < 32)
    table[:, 12] = np.arange(256) >= 128
    table[:, 10] = rest & (np.arange(256) >= 32) & (np.arange(256) < 128)
    return table


_CLASSES = _byte_classes()


def statistics(many: list[str]) -> np.ndarray:
    """One row of STATISTICS per text."""
    hist = np.zeros((len(many), 256))
    rows = np.zeros((len(many), 13))
    for k, text in enumerate(many):
        raw = text.encode("utf-8", "surrogatepass")
        if raw:
            hist[k] = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        words, lines = text.split(), text.split("\n")
        filled = [x for x in lines if x]
        if words:
            counts: dict[str, int] = {}
            for w in words:
                counts[w] = counts.get(w, 0) + 1
            n = len(words)
            sizes = list(map(len, words))
            rows[k] = (
                len(raw), len(text) / len(raw), n, len(lines), sum(sizes) / n, len(counts) / n,
                max(counts.values()) / n, 1 - len(set(filled)) / max(1, len(filled)),
                n / max(1, len(filled)), sum(s <= 3 for s in sizes) / n,
                sum([w[-1].isalpha() for w in words]) / n, sum(map(str.isupper, words)) / n,
                max(sizes))
        else:
            rows[k, 0], rows[k, 3] = len(raw), len(lines)
    share = hist @ _CLASSES / np.maximum(1, hist.sum(1, keepdims=True))
    return np.column_stack([rows[:, :7], share, rows[:, 7:]])


@dataclass
class Forest:
    """Flattened trees: node ``i`` of tree ``t`` sends rows above the threshold to
    ``2 i + 2`` and the others to ``2 i + 1``; leaves follow the inner nodes."""

    base: float
    feature: np.ndarray     # trees x (2^depth - 1)
    threshold: np.ndarray   # the same
    leaf: np.ndarray        # trees x 2^depth
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), trees.shape[1]), np.int64)
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[row, self.feature[trees, node]] > self.threshold[trees, node])
        return self.base + self.leaf[trees, node - (2 ** self.depth - 1)].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -35, 35)))


def grow(x: np.ndarray, y: np.ndarray, *, trees: int = 120, depth: int = 4, bins: int = 64,
         rate: float = 0.1, l2: float = 1.0, least: float = 2.0) -> Forest:
    """Boosted trees on binned statistics; ``least``: hessian a child needs."""
    n, width = x.shape
    inner, n_leaves = 2 ** depth - 1, 2 ** depth
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, n_leaves))
    p = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(p / (1 - p)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0)
             for f in range(width)]
    binned = np.column_stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)]) \
        if n else np.zeros((0, width), np.int64)
    slot = binned + np.arange(width) * bins
    raw = np.full(n, base)
    for t in range(trees if n else 0):
        score = 1 / (1 + np.exp(-raw))
        g, h = score - y, score * (1 - score)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            at = (((node - first) * width * bins)[:, None] + slot).ravel()
            shape = (count, width, bins)
            sums = [np.bincount(at, np.repeat(v, width), count * width * bins).reshape(shape).cumsum(2)
                    for v in (g, h)]
            gl, hl = sums[0][:, :, :-1], sums[1][:, :, :-1]
            gt, ht = sums[0][:, :1, -1:], sums[1][:, :1, -1:]
            gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
            gain[(hl < least) | (ht - hl < least)] = 0
            flat = gain.reshape(count, -1)
            best = flat.argmax(1)
            for k in range(count):
                f, b = divmod(int(best[k]), bins - 1)
                if flat[k, best[k]] > 1e-9 and b < len(edges[f]):
                    feature[t, first + k], threshold[t, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        at = node - inner
        gs, hs = np.bincount(at, g, n_leaves), np.bincount(at, h, n_leaves)
        leaf[t] = -rate * gs / (hs + l2)
        raw += leaf[t][at]
    return Forest(base, feature, threshold, leaf, depth)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", divisor: int = 3, held: int = 1,
        max_fit_rows: int = 20_000, **growth) -> Forest:
    """Trees grown on the statistics of a bounded sample of labelled documents."""
    ship(docs.sparkSession)
    sample = labelled_sample(labels, label, divisor, held, max_fit_rows)

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            x = statistics(texts(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label"), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])

    # the sample has at most max_fit_rows ids, so it may be broadcast
    joined = one_per_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                        .join(F.broadcast(sample), "doc_id"), "doc_id", "_label").select("text", "_label")
    rows = joined.mapInArrow(stats, "y double, x array<double>").toArrow()
    y = (rows.column("y").to_numpy() >= 0.5).astype(float)
    x = np.array(rows.column("x").to_pylist(), float).reshape(len(y), len(STATISTICS))
    order = np.lexsort((*x.T, y))                          # the same trees whatever the row order
    return grow(x[order], y[order], **growth)


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """``doc_id`` and the score of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            s = forest.score(statistics(texts(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], schema=_SCHEMA)

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
