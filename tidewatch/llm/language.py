"""Operator 6: language identification by nearest centroid.

A text is a vector of hashed letter 1-, 2- and 3-grams (lower case; everything
that is no letter is one space), with damped counts, weighted by inverse
document frequency and normalised.  Each language has several centroids, found
by clustering a bounded sample of its labelled texts (``per_language``, smallest
hash of the id first), because one language holds several kinds of text.  A
text gets the language of the centroid of largest cosine.  It is rejected when
that cosine is under a share of what nearly all training texts of the centroid
reach, that is, when it lies far outside the centroid's own spread; for a text
of few letters (of the whole text, under ``FULL_LETTERS``) the limit shrinks in
proportion.  The share is what all training texts reach that were held back (one in
``folds`` of a language's sample) from centroids of the others, less a ``margin``;
``share`` is its least, and what holds with fewer than ``least_held`` of them.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and
is rejected; ties go to the smaller language name; with nothing to learn from
all texts are ``und`` and only those without a letter are rejected; a null doc_id is kept; repeated rows are scored each;
an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidewatch.llm.common import _release, cut, few, one_per_id, remainder, ship, small_batches, texts

UNKNOWN = "und"
#: Hash buckets of 1-, 2- and 3-grams.
BUCKETS = (512, 2048, 8192)
WIDTH = sum(BUCKETS)
#: Texts whose vectors are dense at a time (in multiples of 24 OpenBLAS rounds products as
#: over all rows at once); of a longer text, characters hashed at a time.
BLOCK, CHUNK = 96, 1 << 16

#: Letters from which a text's rejection limit is the full one.
FULL_LETTERS = 400
#: Sampled ids that are broadcast; more are joined by shuffle.
MAX_BROADCAST_IDS = 200_000

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """True for code points that are letters; built once per process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(text: str) -> np.ndarray | None:
    """Counts of a text's n-gram buckets, or None if it has no letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[c]
    if not letter.any():
        return None
    space = np.array([32], np.uint32)
    c = np.where(letter, c, space)
    c = np.concatenate((space, c[np.concatenate(([True], letter[1:] | letter[:-1]))], space))
    mix, counts = np.uint64(0x9E3779B97F4A7C15), np.zeros(WIDTH, np.int64)
    for start in range(0, len(c), CHUNK):                  # n-grams that begin here; two characters more end them
        part = c[start:start + CHUNK + 2].astype(np.uint64)
        two = part[:-1] * np.uint64(0x1_0001) + part[1:]
        three = two[:-1] * np.uint64(0x1_0003) + part[2:]
        at = np.concatenate([
            part[:CHUNK] % np.uint64(BUCKETS[0]),
            BUCKETS[0] + ((two[:CHUNK] * mix) >> np.uint64(40)) % np.uint64(BUCKETS[1]),
            BUCKETS[0] + BUCKETS[1] + ((three * mix) >> np.uint64(40)) % np.uint64(BUCKETS[2]),
        ]).astype(np.int64)
        counts += np.bincount(at, minlength=WIDTH)
    return counts


def letters_of(text: str) -> int:
    """Number of letters of the whole text, lower case as in ``grams``."""
    return int(_letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")].sum())


def vectors(many: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of each text that has a letter, its unit vector)."""
    kept, x = [], np.zeros((len(many), WIDTH), np.float32)
    for k, text in enumerate(many):
        counts = grams(text) if text else None
        if counts is not None:
            x[len(kept)] = np.sqrt(counts.astype(np.float32)) * idf
            kept.append(k)
    x = x[:len(kept)]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return np.array(kept, np.int64), x


class Rows:
    """Unit vectors kept by their non-zero buckets and dense a block at a time: a sample
    of 1,000 texts has 43 MB of dense vectors, and clustering copies parts of them."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.rows = rows                                   # buckets and values of each vector

    def __len__(self) -> int:
        return len(self.rows)

    def dense(self, first: int, upto: int) -> np.ndarray:
        x = np.zeros((min(upto, len(self)) - first, WIDTH), np.float32)
        for row, (at, value) in zip(x, self.rows[first:upto], strict=True):
            row[at] = value
        return x

    def times(self, c: np.ndarray) -> np.ndarray:
        """Products of each vector with ``c``, one vector or several."""
        return np.concatenate([self.dense(k, k + BLOCK) @ c.T for k in range(0, len(self), BLOCK)])

    def where(self, chosen: np.ndarray) -> Rows:
        return Rows([self.rows[k] for k in np.flatnonzero(chosen)])

    def mean(self) -> np.ndarray:
        m = np.zeros(WIDTH, np.float32)
        for at, value in self.rows:
            m[at] += value
        return m / np.float32(len(self))


def sparse(many: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, Rows]:
    """As ``vectors``, the vectors as ``Rows``."""
    kept, rows = [], []
    for k in range(0, len(many), BLOCK):
        some, x = vectors(many[k:k + BLOCK], idf)
        kept.append(some + k)
        for row in x:
            at = np.flatnonzero(row)
            rows.append((at.astype(np.uint16), row[at]))
    return np.concatenate([np.zeros(0, np.int64), *kept]), Rows(rows)


def cluster(x: Rows, k: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids by spherical k-means from a farthest-first start, and each
    row's cosine to its own."""
    start = [0]
    best = x.times(x.dense(0, 1)[0])
    while len(start) < min(k, len(x)):
        start.append(int(best.argmin()))
        best = np.maximum(best, x.times(x.dense(start[-1], start[-1] + 1)[0]))
    c = np.concatenate([x.dense(j, j + 1) for j in start])
    for _ in range(rounds):
        own = x.times(c).argmax(1)
        for j in range(len(c)):
            if (own == j).any():
                m = x.where(own == j).mean()
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c, x.times(c)


def _size(many: list[str]) -> np.ndarray:
    """Share of the full rejection limit that holds for each text."""
    # a short text's cosine is low by chance: its limit shrinks with its letters
    return np.minimum(1, np.array([letters_of(t) for t in many], float) / FULL_LETTERS)


def _reach(cos: np.ndarray, spread: float) -> np.ndarray:
    """Cosine that nearly all texts of each centroid reach."""
    own = cos.argmax(1)
    return np.array([np.quantile(cos[own == j, j], spread) if (own == j).any() else 0.0
                     for j in range(cos.shape[1])], float)


def held_back(x: Rows, size: np.ndarray, clusters: int, spread: float, folds: int) -> np.ndarray:
    """What share of the limit each text reaches that was held back from centroids
    of the other texts."""
    out = np.arange(len(x)) % folds == folds - 1
    if not out.any():
        return np.zeros(0)
    c, cos = cluster(x.where(~out), clusters)
    far = x.where(out).times(c)
    best = far.argmax(1)
    return far.max(1) / np.maximum(_reach(cos, spread)[best] * size[out], 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    langs: list[str]            # language of each centroid, sorted
    centroids: np.ndarray
    reach: np.ndarray           # cosine under which the centroid rejects


def fit(docs: DataFrame, *, divisor: int = 4, held: int = 2, per_language: int = 1000,
        clusters: int = 4, spread: float = 0.01, share: float = 0.4, folds: int = 5, least_held: int = 100,
        margin: float = 0.8) -> Model:
    """Centroids from at most ``per_language`` labelled texts of each language."""
    ship(docs.sparkSession)
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text") \
        .where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .where(remainder("doc_id", divisor) != held)
    # ids first, no text moves; a hash threshold leaves about four times the rows wanted of
    # a large language, so its rank sees as few rows at any size
    key = F.xxhash64("doc_id")
    some = cut(train.groupBy(F.col("lang").alias("_l"))
               .agg(F.least(F.lit(1.0), 4.0 * per_language / F.count("*")).alias("_some")))
    few_ids = train.select("lang", "doc_id").join(few(some, MAX_BROADCAST_IDS), F.col("lang") == F.col("_l")) \
        .where(F.pmod(key, F.lit(1 << 20)) < F.col("_some") * (1 << 20)).select("lang", "doc_id").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = few_ids.withColumn("_r", rank).where(F.col("_r") <= per_language) \
        .select(F.col("lang").alias("_lang"), F.col("doc_id").alias("_id")).distinct().persist()
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    sample = one_per_id(train.join(ids, (train.doc_id == ids._id) & (train.lang == ids._lang)), "lang", "doc_id").persist()
    try:
        def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, df = 0, np.zeros(WIDTH, np.int64)
            for batch in small_batches(batches):
                for t in texts(batch):
                    counts = grams(t)
                    if counts is not None:
                        n += 1
                        df += counts > 0
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))],
                                             names=["gram", "n"])

        # one row per n-gram bucket: WIDTH + 1 at most
        found = dict(sample.mapInArrow(frequencies, "gram long, n long")
                     .groupBy("gram").agg(F.sum("n").alias("n")).toPandas().to_numpy().tolist())
        n = found.pop(-1, 0)
        df = np.zeros(WIDTH, np.float64)
        df[list(found)] = list(found.values())
        idf = (np.log((n + 1) / (df + 1)) + 0.1).astype(np.float32)

        def centroids(group: pa.Table) -> pa.Table:
            group = group.sort_by([("doc_id", "ascending"), ("text", "ascending")])
            many = group.column("text").to_pylist()
            kept, x = sparse(many, idf)
            if not len(x):
                return pa.table({"lang": pa.array([], pa.string()), "centroid": pa.array([], pa.binary()),
                                 "reach": pa.array([], pa.float64()), "back": pa.array([], pa.list_(pa.float64()))})
            c, cos = cluster(x, clusters)
            back = held_back(x, _size([many[k] for k in kept]), clusters, spread, folds)
            _release()
            return pa.table({"lang": group.column("lang").to_pylist()[:1] * len(c),
                             "centroid": pa.array([v.astype("<f4").tobytes() for v in c], pa.binary()),
                             "reach": pa.array(_reach(cos, spread)),
                             "back": pa.array([back.tolist()] + [[]] * (len(c) - 1), pa.list_(pa.float64()))})

        found = sample.groupBy("lang").applyInArrow(
            centroids, "lang string, centroid binary, reach double, back array<double>").collect()
        rows = sorted((r.lang, bytes(r.centroid), r.reach) for r in found)
        back = np.array([v for r in found for v in r.back], float)
        if len(back) >= least_held:
            share = max(share, min(1.0, margin * float(back.min())))
    finally:
        sample.unpersist()
        ids.unpersist()
    return Model(idf, [r[0] for r in rows],
                 np.array([np.frombuffer(r[1], "<f4") for r in rows], np.float32).reshape(len(rows), WIDTH),
                 share * np.array([r[2] for r in rows], float))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``lang_score``, ``lang_rejected``."""
    names = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_rejected")]
    docs = docs.select(*names)
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("lang_score", T.DoubleType()), T.StructField("lang_rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n = batch.num_rows
            lang, value, out = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
            if model.langs:
                t = batch.column("text")
                kept, x = sparse(t.to_pylist(), model.idf)
                if len(kept):
                    cos = x.times(model.centroids)
                    best = cos.argmax(1)
                    near = cos[np.arange(len(kept)), best].astype(float)
                    lang[kept] = np.array(model.langs, object)[best]
                    value[kept] = np.clip(near, 0, 1)
                    out[kept] = near < model.reach[best] * _size([t[k].as_py() for k in kept])
            else:                                          # nothing learned: only texts without a letter
                out = np.array([not (t and any(map(str.isalpha, t))) for t in batch.column("text").to_pylist()], bool)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(value), pa.array(out)],
                names=[*batch.schema.names, "lang_pred", "lang_score", "lang_rejected"])

    ship(docs.sparkSession)
    return docs.mapInArrow(run, schema)
