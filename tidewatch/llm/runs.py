"""Operator 12: runs of periodic words, found with a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical) and a length of at least ``max(min_words, min_exponent * q)``
that no neighbouring word extends keeping that period.

For every power of two ``2^k`` all factors of so many words are named: the name of
a factor is the rank of the pair of names of its halves, so equal names mean equal
words, without hashing.  Sorting the names brings every factor next to its
successor, the next occurrence in the same text.  In a run of period ``q`` the
factors of ``2^k >= q`` words follow each other ``q`` apart, as its smallest period
is that of its primitive root; neighbouring places whose successors are equally far
are one arithmetic progression and propose that period.  Each level proposes the
distances over ``2^(k-1)`` up to ``2^k`` (of the successors within ``2^(k+1)``),
so that a period is proposed on one level only.  Proposals long enough are extended
over the words to both sides and deduplicated.  Names that do not repeat within a
text are dropped from the next levels, which are empty soon for ordinary text.

Texts are handled in batches of a few MB of whole texts, one longer text by itself:
a run may span a whole text, so a text is never split.  Memory is some 60 bytes for
each word of a batch.  There is no shuffle.

Defined cases: a null or empty text has no words, no runs and collapses to the
empty text; a null doc_id is kept; repeated rows each keep their result; an empty
table gives no rows; other input columns are ignored; ties of the strongest run go
to the smaller start, then the smaller period.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import ship, small_batches, texts

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_DDL = "struct<start: bigint, length: bigint, period: bigint>"
BATCH = 2 << 20

Run = tuple[int, int, int]


def _named(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the order of their names, rank of each place's name)."""
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(fresh) - 1
    return order, rank


def proposals(many: list[list[bytes]], min_words: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """(text, place, period) of every progression long enough for a run."""
    ids: dict[bytes, int] = {}
    size = np.array([len(w) for w in many], np.int64)
    word = np.array([ids.setdefault(w, len(ids)) for words in many for w in words], np.int64)
    text = np.repeat(np.arange(len(many)), size)
    first = np.cumsum(size) - size
    places = np.arange(len(word))
    key = text << 32 | word
    name = np.full(len(word), -1, np.int64)
    longest = int(size.max(initial=0))
    span, least = 1, 0                                     # factors of ``span`` words, periods over ``least``
    while len(places) > 1 and min_exponent * (least + 1) <= longest:
        order, rank = _named(key)
        at = places[order]
        again = (rank[order[1:]] == rank[order[:-1]])      # names hold their text, so never across texts
        step = np.zeros(len(places), np.int64)
        step[order[:-1][again]] = (at[1:] - at[:-1])[again]
        ahead = (step > least) & (step <= span)
        i, d = places[ahead], step[ahead]
        if len(i):
            begin = np.ones(len(i), bool)
            begin[1:] = (i[1:] != i[:-1] + 1) | (d[1:] != d[:-1]) | (text[i[1:]] != text[i[:-1]])
            start = np.flatnonzero(begin)
            many_ = np.diff(np.append(start, len(i)))
            length = many_ + span - 1 + d[start]
            for s in start[length >= np.maximum(min_words, min_exponent * d[start])]:
                t = int(text[i[s]])
                yield t, int(i[s] - first[t]), int(d[s])
        repeated = np.zeros(len(places), bool)
        repeated[order[1:][again]] = True
        repeated[order[:-1][again]] = True
        name[places] = np.where(repeated, rank, -1)
        left = places[repeated]
        left = left[left + span < len(word)]
        left = left[(name[left + span] >= 0) & (text[left] == text[left + span])]
        key = name[left] << 32 | name[left + span]
        places, least, span = left, span, 2 * span


def periodic_runs(many: list[list[bytes]], *, min_words: int = 6, min_exponent: int = 4) -> list[list[Run]]:
    """The runs ``(start, length, period)`` of every list of words, by start, then period.

    From three periods on, each run holds a factor of ``2^k >= q`` words and its successor."""
    if min_exponent < 3:
        raise ValueError("runs of fewer than three periods are not found this way")
    found: list[set[Run]] = [set() for _ in many]
    for t, place, q in proposals(many, min_words, min_exponent):
        words = many[t]
        a, z = place, place + q                            # words a .. z-1 keep period q
        while a and words[a - 1] == words[a - 1 + q]:
            a -= 1
        z = _extended(words, z, q)
        if z - a >= max(min_words, min_exponent * q):
            found[t].add((a, z - a, q))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def _extended(words: list[bytes], z: int, q: int) -> int:
    """End of the stretch of period ``q`` that holds the words before ``z``."""
    n, block = len(words), 256
    while z < n and words[z:z + block] == words[z - q:min(z + block, n) - q]:
        z = min(z + block, n)
    while z < n and words[z] == words[z - q]:
        z += 1
    return z


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by spaces, less those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        drop[start + q] += 1
        drop[start + length] -= 1
    keep = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
    return b" ".join([words[i] for i in keep.tolist()])


def detect(docs: DataFrame, *, min_words: int = 6, min_exponent: int = 4,
           edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``doc_id, n_words, runs, strongest, collapsed`` of every text.

    ``edit(doc_id, words)`` may change the words of a text before runs are looked for."""
    ship(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, max_bytes=BATCH):
            many = [t.encode("utf-8").split() for t in texts(batch)]   # splits at 0x20 and 0x09-0x0D only
            if edit:
                many = [edit(i, w) for i, w in zip(batch.column("doc_id").to_pylist(), many, strict=True)]
            runs = periodic_runs(many, min_words=min_words, min_exponent=min_exponent)
            rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs]
            top = [strongest(rs) for rs in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(w) for w in many], pa.int64()),
                 pa.array(rows, pa.list_(RUN)),
                 pa.array([t and dict(zip(("start", "length", "period"), t, strict=True)) for t in top], RUN),
                 pa.array([collapsed(w, rs).decode("utf-8") for w, rs in zip(many, runs, strict=True)], pa.string())],
                names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, f"doc_id long, n_words long, runs array<{RUN_DDL}>, strongest {RUN_DDL}, collapsed string")
