"""Operator 2: toxicity by the nearest labelled examples.

Features are words (letter runs, lower case) and word beginnings of ``prefixes``
letters.  From a bounded sample of labelled texts (``max_fit_rows``, smallest
hash of the id first) the features are kept that stand out in toxic examples
(two-proportion z of at least ``least_z``, at most ``max_features``).  Examples
and texts are TF-IDF vectors over these, of unit length; equal examples are one
entry with its numbers of examples and of toxic ones.

The examples form an inverted index whose postings are cut into blocks of
entries, each with its largest weight.  For a text the block maxima bound the
cosine within every block; blocks are scored exactly from the largest bound
down until no bound can reach the k-th best cosine, so the nearest examples are
exact.  They vote with weight 1 / (``near`` + 1 - cosine) per example, and the
share of toxic votes, with one vote for the general rate, is the score.  Texts
without any feature are scored by the examples without any.

The index is bounded by ``max_fit_rows`` and goes with the task; scoring runs in
the scan's own tasks with no shuffle.

Defined cases: a null text counts as empty, and an empty text has no feature;
null labels are ignored, an id labelled twice counts by its mean, an id on many rows
is one example (the text of smallest hash); very long texts are scored whole, in time
linear in their words; ties of cosine
go to the entry with the smaller number; with no labelled rows every score is
0.5; a null doc_id is kept and is no example; an empty table gives no rows;
other input columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import cut, labelled_sample, one_per_id, ship, small_batches, texts

_LETTERS = re.compile(r"[^\W\d_]+")
EVIDENCE = "array<struct<doc_id:long,cosine:double,examples:long,toxic:long>>"
#: Distinct tokens remembered per worker before the memo is cleared.
MEMO_TOKENS = 1_000_000


def features_of(token: str, prefixes: tuple[int, int]) -> list[str]:
    """Words of a token and their beginnings (marked by a star)."""
    out = []
    for w in _LETTERS.findall(token):
        out.append(w)
        out += [w[:n] + "*" for n in range(prefixes[0], min(prefixes[1], len(w) - 1) + 1)]
    return out


class Vectoriser:
    """Counts of known features of a text, with a memo over its tokens."""

    def __init__(self, number: dict[str, int], prefixes: tuple[int, int]):
        self.number, self.prefixes = number, prefixes
        self.plain: set[str] = set()
        self.hot: dict[str, list[int]] = {}

    def counts(self, text: str) -> dict[int, int]:
        tokens = text.lower().split()
        seen = set(tokens)
        for t in seen.difference(self.plain):
            if t not in self.hot:
                found = [n for f in features_of(t, self.prefixes) if (n := self.number.get(f)) is not None]
                if found:
                    self.hot[t] = found
                else:
                    self.plain.add(t)
        if len(self.plain) > MEMO_TOKENS:
            self.plain = set()
        out: dict[int, int] = {}
        for t in seen.intersection(self.hot):
            n = tokens.count(t)
            for f in self.hot[t]:
                out[f] = out.get(f, 0) + n
        if len(self.hot) > MEMO_TOKENS:
            self.hot = {}
        return out


@dataclass
class Index:
    """Examples as a block-max inverted index."""

    number: dict[str, int]                 # feature -> its number
    idf: np.ndarray
    doc_id: np.ndarray                     # per entry: smallest example, examples, toxic ones
    examples: np.ndarray
    toxic: np.ndarray
    post: list[np.ndarray]                 # per feature: entries, weights, blocks, largest weight in each
    weight: list[np.ndarray]
    blocks: list[np.ndarray]
    most: list[np.ndarray]
    rate: float                            # of toxic examples
    rate_without: float                    # among examples without features
    prefixes: tuple[int, int]
    k: int
    near: float
    block: int
    memo: dict = field(default_factory=dict)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        f = np.array(sorted(counts), np.int64)
        w = (1 + np.log([counts[i] for i in f.tolist()])) * self.idf[f]
        return f, w / np.linalg.norm(w)

    def nearest(self, f: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k entries of largest cosine (all with a common feature, if fewer)."""
        n_blocks = -(-len(self.doc_id) // self.block)
        bound = np.zeros(n_blocks)
        for t, x in zip(f.tolist(), w.tolist(), strict=True):
            bound[self.blocks[t]] += x * self.most[t]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        entries, cosines, floor, at = np.zeros(0, np.int64), np.zeros(0), -1.0, 0
        while at < len(order) and bound[order[at]] > floor - 1e-9:
            some = order[at:at + 4]
            some = some[bound[some] > floor - 1e-9]
            at += 4
            for b in some.tolist():
                lo, hi = b * self.block, min((b + 1) * self.block, len(self.doc_id))
                score = np.zeros(hi - lo)
                for t, x in zip(f.tolist(), w.tolist(), strict=True):
                    p = self.post[t]
                    i, j = np.searchsorted(p, (lo, hi))
                    score[p[i:j] - lo] += x * self.weight[t][i:j]
                hit = np.flatnonzero(score)
                entries, cosines = np.append(entries, hit + lo), np.append(cosines, score[hit])
            best = np.lexsort((entries, -cosines))[:self.k]
            entries, cosines = entries[best], cosines[best]
            floor = cosines[-1] if len(cosines) == self.k else -1.0
        return entries, np.minimum(cosines, 1.0)

    def score(self, counts: dict[int, int]) -> tuple[float, list[dict]]:
        if not counts:
            return self.rate_without, []
        key = tuple(sorted(counts.items()))
        if key not in self.memo:
            entries, cosines = self.nearest(*self.vector(counts))
            vote = 1 / (self.near + 1 - cosines)
            share = (float((vote * self.toxic[entries]).sum()) + self.rate) / \
                (float((vote * self.examples[entries]).sum()) + 1)
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[key] = min(1.0, max(0.0, share)), [
                {"doc_id": int(self.doc_id[e]), "cosine": float(c), "examples": int(self.examples[e]),
                 "toxic": int(self.toxic[e])} for e, c in zip(entries[:3], cosines[:3], strict=True)]
        return self.memo[key]


def build(rows: list[tuple[int, float, dict[int, int]]], number: dict[str, int], *, prefixes=(4, 7), k: int = 25,
          near: float = 0.05, block: int = 32) -> Index:
    """Index of examples (doc_id, label, feature counts)."""
    n = len(rows)
    df = np.zeros(len(number))
    for _, _, c in rows:
        df[list(c)] += 1
    idf = np.log((1 + n) / (1 + df)) + 1
    groups: dict[tuple, list] = {}
    for doc_id, label, c in sorted(rows, key=lambda r: r[0]):
        g = groups.setdefault(tuple(sorted(c.items())), [doc_id, 0, 0])
        g[1] += 1
        g[2] += label >= 0.5
    zero = groups.pop((), [0, 0, 0])
    positive = sum(g[2] for g in groups.values()) + zero[2]
    rate = positive / n if n else 0.5
    self = Index(number, idf, *(np.zeros(0),) * 3, [], [], [], [], rate, (zero[2] + rate) / (zero[1] + 1) if n else 0.5,
                 prefixes, k, near, block)
    vectors = [(*self.vector(dict(key)), g) for key, g in groups.items()]
    vectors.sort(key=lambda v: (int(v[0][v[1].argmax()]), v[2][0]))    # alike entries in the same blocks
    self.doc_id = np.array([g[0] for *_, g in vectors], np.int64)
    self.examples = np.array([g[1] for *_, g in vectors], np.int64)
    self.toxic = np.array([g[2] for *_, g in vectors], np.int64)
    lists: list[list[tuple[int, float]]] = [[] for _ in number]
    for e, (f, w, _) in enumerate(vectors):
        for t, x in zip(f.tolist(), w.tolist(), strict=True):
            lists[t].append((e, x))
    for found in lists:
        p, w = np.array([e for e, _ in found], np.int64), np.array([x for _, x in found])
        b = p // block
        at = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1]))) if len(b) else np.zeros(0, np.int64)
        self.post.append(p)
        self.weight.append(w)
        self.blocks.append(b[at])
        self.most.append(np.maximum.reduceat(w, at) if len(b) else np.zeros(0))
    return self


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", divisor: int = 5, held: int = 0,
        max_fit_rows: int = 20_000, max_features: int = 2048, least_examples: int = 5, least_z: float = 6.0,
        prefixes: tuple[int, int] = (4, 7), **settings) -> Index:
    """Index of a bounded sample of labelled texts."""
    ship(docs.sparkSession)
    # the sample has at most max_fit_rows ids, so it may be broadcast
    sample = labelled_sample(labels, label, divisor, held, max_fit_rows)
    chosen = cut(one_per_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                            .join(F.broadcast(sample), "doc_id"), "doc_id", "_label"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            clean, toxic = Counter(), Counter()
            for text, y in zip(texts(batch), batch.column("_label").to_pylist(), strict=True):
                side = toxic if y >= 0.5 else clean
                side[""] += 1
                side.update({f for t in set(text.lower().split()) for f in features_of(t, prefixes)})
            names = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()),
                 pa.array([clean[n] for n in names], pa.int64())], names=["f", "toxic", "clean"])

    counts = chosen.mapInArrow(tally, "f string, toxic long, clean long").groupBy("f") \
        .agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")) \
        .where((F.col("a") >= least_examples) | (F.col("f") == "")).persist()
    try:
        total = counts.where("f = ''").first()
        p, n = (total.a, total.b) if total else (0, 0)
        number: dict[str, int] = {}
        if p and n:
            share = (F.col("a") + F.col("b")) / F.lit(float(p + n))
            z = (F.col("a") / p - F.col("b") / n) / F.sqrt(share * (1 - share) * (1 / p + 1 / n) + 1e-12)
            best = counts.where("f <> ''").withColumn("z", z).where(F.col("z") >= least_z) \
                .orderBy(F.desc("z"), "f").limit(max_features).select("f").collect()
            number = {r.f: k for k, r in enumerate(best)}
    finally:
        counts.unpersist()

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vectoriser(number, prefixes)
        for batch in small_batches(batches):
            found = [v.counts(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_label"),
                 pa.array([list(c) for c in found], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))],
                names=["doc_id", "y", "f", "n"])

    rows = chosen.mapInArrow(vectors, "doc_id long, y double, f array<int>, n array<int>").toArrow().to_pylist()
    return build([(r["doc_id"], r["y"], dict(zip(r["f"], r["n"], strict=True))) for r in rows], number,
                 prefixes=prefixes, **settings)


def score(docs: DataFrame, index: Index) -> DataFrame:
    """``doc_id``, score and evidence (the nearest entries) of every text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vectoriser(index.number, index.prefixes)
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("examples", pa.int64()),
                                   ("toxic", pa.int64())]))
        for batch in small_batches(batches):
            found = [index.score(v.counts(t)) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for s, _ in found]), pa.array([e for _, e in found], kind)],
                names=["doc_id", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long"), "text") \
        .mapInArrow(run, f"doc_id long, score double, evidence {EVIDENCE}")
