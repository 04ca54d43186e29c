"""Operator 4: removal of repeated byte strings by a depth-limited radix sort.

Every window of ``depth`` (200) bytes of every text is ordered by most
significant digits, and only as deep as that; windows that end in one group are
the repeated ones.  Three passes run as Spark jobs or in bulk inside tasks:

1. The first digit of a window is its minimiser: the ``gram`` bytes of smallest
   hash in it (leftmost on ties).  Neighbouring windows mostly share theirs, so
   a run of windows travels as one row, about one per 55 bytes of text.  Rows
   alone in their group leave.
2. The second digit of a run is all bytes its windows cover, named by hash.  If
   two runs agree there, all their windows are repeated.
3. The windows of the remaining runs, near the ends of copied passages, are
   sorted within their first digit by digits of ``digit`` bytes, and windows
   alone in a group leave after each pass.  A first digit with more than
   ``max_group`` distinct runs is sorted by one shuffled row per window instead,
   so no task holds an unbounded group.

Groups are counted with partial sums before the shuffle, and rows are marked by
a join, which adaptive execution splits where one key is hot.  A text with exact
copies is entered once: it goes as a whole.  Digits are named by 64-bit hashes.
Counted small sides are broadcast up to ``broadcast_rows`` rows.

Defined cases: a null text counts as empty; a text under ``depth`` bytes holds no
window; repeated rows are copies of each other; a null doc_id is kept; an empty
table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import BROADCAST_ROWS, cut, few, ship, small_batches, text_key
from tidewatch.llm.hashing import Prefix, mix, signed, sliding_min

_LOW = np.uint64((1 << 21) - 1)
#: Bytes handled at once in a task; longer texts are entered in overlapping blocks.
BLOCK = 1 << 19


def runs_of(data: np.ndarray, size: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one minimiser, for texts laid end to end.

    Returns, per run: first digit, second digit, text number, first window's
    start within its text, last window's start less the first's, and the
    minimiser's start less the first's.
    """
    none = np.zeros(0, np.int64)
    if len(data) < depth:
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    begin = np.cumsum(size) - size
    prefix = Prefix(data)
    hashes = mix(prefix.all_of(gram))
    order = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    least = (sliding_min(order, depth - gram + 1) & _LOW).astype(np.int64)
    windows = np.maximum(0, size - depth + 1)
    text = np.repeat(np.arange(len(size)), windows)
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[text]
    at = least[start]
    if not len(at):
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    turn = np.flatnonzero((at[1:] != at[:-1]) | (text[1:] != text[:-1])) + 1
    a, b = np.concatenate(([0], turn)), np.concatenate((turn, [len(at)])) - 1
    s, e, m, t = start[a], start[b], at[a], text[a]
    shape = ((m - s).astype(np.uint64) << np.uint64(32)) + (e - s).astype(np.uint64)
    return (mix(hashes[m] + np.uint64(1)), mix(prefix.ranges(s, e + depth) + mix(shape)), t,
            s - begin[t], e - s, m - s)


def repeated_windows(group: np.ndarray, data: np.ndarray, begin: np.ndarray, count: np.ndarray,
                     anchor: np.ndarray, depth: int, digit: int) -> np.ndarray:
    """Most-significant-digit passes over the windows of runs.

    Run ``i`` has ``count[i]`` windows from ``begin[i]`` in ``data`` on, and its
    minimiser ``anchor[i]`` bytes after that.  Windows can only agree if run
    group and distance to the minimiser agree.  True for each window (run by
    run) that another run has too.
    """
    run = np.repeat(np.arange(len(begin)), count)
    j = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    start = begin[run] + j
    cls = mix(group[run] * np.uint64(2 ** 10 + 1) + (j - anchor[run] + depth).astype(np.uint64))
    left = np.arange(len(run))
    prefix = Prefix(data)
    for at in range(0, depth, digit):
        if not len(left):
            break
        to = min(at + digit, depth)
        key = mix(cls[left] + np.uint64(at)) ^ prefix.ranges(start[left] + at, start[left] + to)
        order = np.argsort(key)
        ordered = key[order]
        same = ordered[1:] == ordered[:-1]
        kept = np.concatenate((same, [False])) | np.concatenate(([False], same))
        cls[left] = key
        left = left[order[kept]]
    found = np.zeros(len(run), bool)
    found[left] = True
    return found


def ranges_of(flags: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of every stretch of true flags within one run."""
    hit = np.flatnonzero(flags)
    if not len(hit):
        return hit, hit
    turn = np.flatnonzero((hit[1:] != hit[:-1] + 1) | (run[hit[1:]] != run[hit[:-1]])) + 1
    return hit[np.concatenate(([0], turn))], hit[np.concatenate((turn, [len(hit)])) - 1]


def _blocks(batch: pa.RecordBatch, depth: int) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """(pieces of text, row of each, offset of each), at most about BLOCK bytes."""
    many, rows, offs, total = [], [], [], 0
    for k, t in enumerate(batch.column("text").to_pylist()):
        raw = (t or "").encode("utf-8", "surrogatepass")
        for o in range(0, max(1, len(raw) - depth + 1), BLOCK):
            piece = raw[o:o + BLOCK + depth - 1]
            if len(piece) < depth:
                continue
            if many and total + len(piece) > BLOCK + depth:
                yield many, rows, offs
                many, rows, offs, total = [], [], [], 0
            many.append(piece)
            rows.append(k)
            offs.append(o)
            total += len(piece)
    if many:
        yield many, rows, offs


def _merge(s: np.ndarray, e: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges [s, e + depth) merged where they overlap or touch."""
    order = np.lexsort((e, s))
    s, end = s[order], np.maximum.accumulate(e[order] + depth)
    new = np.concatenate(([True], s[1:] > end[:-1]))
    at = np.flatnonzero(new)
    return s[at], end[np.concatenate((at[1:], [len(s)])) - 1]


def repeated_spans(docs: DataFrame, *, depth: int = 200, gram: int = 64, digit: int = 50,
                   max_group: int = 4096, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``ref`` (hash of the text) and ``begins``, ``ends``: its bytes to remove."""
    ship(docs.sparkSession)
    k1, k2 = text_key(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), k1.alias("ref"), k2.alias("k2"), "text") \
        .where(F.octet_length("text") >= depth)
    copied = cut(rows.groupBy("ref", "k2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"),
                                               F.max(F.octet_length("text")).alias("size"))
                 .where(F.col("n") > 1))
    whole = copied.select("ref", F.lit(0).alias("s"), (F.col("size") - depth).alias("e"))
    if copied.count() <= broadcast_rows:                   # else all copies are entered, which marks them too
        rows = rows.join(F.broadcast(copied.select("ref", "k2", "first", F.lit(True).alias("is_copy"))),
                         ["ref", "k2"], "left") \
            .where(F.col("is_copy").isNull() | F.col("doc_id").eqNullSafe(F.col("first")))
    rows = rows.select("ref", "text")

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, max_bytes=BLOCK):
            ref = batch.column("ref").to_numpy()
            for many, row, off in _blocks(batch, depth):
                a, c, t, s, n, m = runs_of(np.frombuffer(b"".join(many), np.uint8),
                                           np.array([len(x) for x in many]), depth, gram)
                at = ((s + np.array(off)[t]) << 16) | (n << 8) | m
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(a)), pa.array(signed(c)), pa.array(ref[np.array(row)[t]]), pa.array(at)],
                    names=["a", "c", "ref", "at"])

    runs = rows.mapInArrow(enter, "a long, c long, ref long, at long")
    # pass 1: first digits that more than one run has
    shared = cut(runs.groupBy("a").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"))
                 .where(F.col("n") > 1).select("a", (F.col("lo") < F.col("hi")).alias("several")))
    met = cut(runs.join(few(shared, broadcast_rows), "a"))
    # pass 2: runs that agree as a whole
    # written first, so that both sides of the join are plain exchanges and a hot key can be split
    alike = cut(met.groupBy("a", "c").agg(F.count("*").alias("n"), F.min("ref").alias("one")))
    judged = cut(met.join(alike, ["a", "c"]))
    begin, last = F.shiftright("at", 16).cast("int"), F.shiftright("at", 8).bitwiseAND(255).cast("int")
    full = judged.where("n > 1").select("ref", begin.alias("s"), (begin + last).alias("e"))
    # pass 3: one run of each kind, where a first digit has several
    open_ = judged.where("several AND (n = 1 OR ref = one)").dropDuplicates(["a", "c"]) \
        .select("ref", F.struct("a", "at", (F.col("n") > 1).alias("sure")).alias("run"))
    lists = cut(open_.groupBy("ref").agg(F.collect_list("run").alias("runs")))

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out: list[tuple] = []
            for ref, text, todo in zip(*(batch.column(n).to_pylist() for n in ("ref", "text", "runs")), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for r in todo:
                    s, n = r["at"] >> 16, (r["at"] >> 8) & 255
                    out.append((r["a"], ref, r["at"], r["sure"], raw[s:s + n + depth]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(),
                                                                             pa.bool_(), pa.binary()), strict=True)],
                names=["a", "ref", "at", "sure", "bytes"])

    opened = cut(rows.join(few(lists, broadcast_rows, "runs"), "ref")
                 .mapInArrow(cover, "a long, ref long, at long, sure boolean, bytes binary")
                 .dropDuplicates(["a", "ref", "at"]))
    large = cut(opened.groupBy("a").count().where(F.col("count") > max_group).select("a"))
    small = opened.join(few(large, broadcast_rows), "a", "left_anti").repartition("a").sortWithinPartitions("a")

    def windows(batch: pa.Table) -> tuple[np.ndarray, ...]:
        raw = batch.column("bytes").to_pylist()
        at = batch.column("at").to_numpy()
        size = np.array([len(x) for x in raw])
        return (batch.column("a").to_numpy().view(np.uint64), np.frombuffer(b"".join(raw), np.uint8),
                np.cumsum(size) - size, size - depth + 1, at & 255, at >> 16)

    def settle(table: pa.Table) -> pa.RecordBatch:
        a, data, b, count, m, s = windows(table)
        flags = repeated_windows(a, data, b, count, m, depth, digit)
        run = np.repeat(np.arange(len(b)), count)
        flags &= ~table.column("sure").to_numpy()[run]     # those are marked as a whole
        lo, hi = ranges_of(flags, run)
        shift = s - (np.cumsum(count) - count)
        return pa.RecordBatch.from_arrays(
            [pa.array(table.column("ref").to_numpy()[run[lo]]), pa.array((lo + shift[run[lo]]).astype(np.int32)),
             pa.array((hi + shift[run[lo]]).astype(np.int32))], names=["ref", "s", "e"])

    def sort_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in small_batches(batches, "bytes", BLOCK):
            a = batch.column("a").to_numpy()
            turn = np.flatnonzero(a[1:] != a[:-1])
            if held and (len(turn) or a[0] != held[-1].column("a")[-1].as_py()):
                cutoff = 0 if a[0] != held[-1].column("a")[-1].as_py() else int(turn[0]) + 1
                yield settle(pa.Table.from_batches([*held, batch.slice(0, cutoff)]))
                held, batch, turn = [], batch.slice(cutoff), turn[turn >= cutoff] - cutoff
            if len(turn):                                  # all groups but the last are whole
                yield settle(pa.Table.from_batches([batch.slice(0, int(turn[-1]) + 1)]))
                batch = batch.slice(int(turn[-1]) + 1)
            if batch.num_rows:
                held.append(batch)
        if held:
            yield settle(pa.Table.from_batches(held))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "bytes", BLOCK // 8):
            a, data, b, count, m, s = windows(pa.Table.from_batches([batch]))
            run = np.repeat(np.arange(len(b)), count)
            j = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
            key = mix(mix(a[run] + (j - m[run] + depth).astype(np.uint64)) ^
                      Prefix(data).ranges(b[run] + j, b[run] + j + depth))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key)), pa.array(batch.column("ref").to_numpy()[run]),
                 pa.array((s[run] + j).astype(np.int32)),
                 pa.array(batch.column("sure").to_numpy(zero_copy_only=False)[run])],
                names=["key", "ref", "s", "sure"])

    spans = full.unionByName(whole).unionByName(small.mapInArrow(sort_small, "ref long, s int, e int"))
    if large.count():
        single = cut(opened.join(few(large, broadcast_rows), "a", "left_semi")
                     .mapInArrow(explode, "key long, ref long, s int, sure boolean"))
        twice = single.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
        spans = spans.unionByName(single.where("NOT sure").join(twice, "key", "left_semi")
                                  .select("ref", "s", F.col("s").alias("e")))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, ends = [], []
            for pairs in batch.column("spans").to_pylist():
                v = np.array(pairs, np.int64)
                s, e = _merge(v >> 31, v & (2 ** 31 - 1), depth)
                begins.append(s)
                ends.append(e)
            yield pa.RecordBatch.from_arrays(
                [batch.column("ref"), pa.array(begins, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))],
                names=["ref", "begins", "ends"])

    return cut(spans.groupBy("ref").agg(F.collect_set(F.shiftleft(F.col("s").cast("long"), 31) + F.col("e"))
                                        .alias("spans"))
               .mapInArrow(merge, "ref long, begins array<long>, ends array<long>"))


def remove(docs: DataFrame, spans: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS,
           columns: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """``columns`` of docs and ``n_bytes, n_removed, n_spans, kept``: what is left of
    each text, as bytes; with ``as_text`` as a string, without the rest of a character
    that was cut, and null where the text was."""
    k1, _ = text_key(F.col("text"))
    names = list(dict.fromkeys(c for c in columns if c not in ("n_bytes", "n_removed", "n_spans", "kept", "text")))
    side = spans.withColumnRenamed("ref", "__ref").withColumnRenamed("begins", "__begins") \
        .withColumnRenamed("ends", "__ends")
    joined = docs.select(*names, "text").join(few(side, broadcast_rows, "__begins"), k1 == F.col("__ref"), "left") \
        .select(*names, "text", "__begins", "__ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes, removed, n_spans, kept = [], [], [], []
            for text, s, e in zip(*(batch.column(n).to_pylist() for n in ("text", "__begins", "__ends")), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                sizes.append(len(raw))
                s, e = s or [], e or []
                rest = b"".join(raw[a:b] for a, b in zip([0, *e], [*s, len(raw)], strict=True))
                removed.append(len(raw) - len(rest))
                n_spans.append(len(s))
                kept.append(rest if not as_text else rest.decode("utf-8", "ignore") if s else text)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary())],
                names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])

    from pyspark.sql import types as T
    schema = T.StructType([*docs.select(*names).schema.fields, *(
        T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")),
        T.StructField("kept", T.StringType() if as_text else T.BinaryType())])
    ship(docs.sparkSession)
    return joined.mapInArrow(run, schema)

