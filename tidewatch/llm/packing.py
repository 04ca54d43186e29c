"""Operator 1: sum-of-squares online packing into fixed token windows.

Every document is tokenised (plus one closing id) and cut into full windows
of ``window`` tokens; what is left over, under one window, is an item that is
placed online.  A level array holds how many windows are filled to each level.
An item of size ``s`` goes to the level ``h`` (0: a new window) that gives the
smallest sum of squared counts of partly filled windows; ties go to the fuller
level.  Fills stay spread over many levels, so a fitting level nearly always
exists.  When the input of a task ends, or more than ``max_open`` windows are
open, the windows left open are joined from the fullest down: each is topped up
with tokens cut from the emptiest one, so at most one window per task is padded.

Packing runs within the scan's own partitions, with no shuffle, and no window
spans two tasks.  A sequence id is the task's partition number and a counter.

Defined cases: a null text counts as empty, and an empty document is one piece
with the closing id alone; a null doc_id is kept; repeated rows are packed once
per row; an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import local_path, ship, small_batches, texts

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long")
_ARROW = pa.schema([pa.field(n, pa.int64()) for n in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    "sequence_tokens")])

_ENCODERS: dict[str, object] = {}


def _byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others for the code points from 256 on, in order."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(path: str):
    """Encoder of a byte-level tokenizer file, one per worker process.

    The file's ids are its merge ranks, so the rank-based encoder gives the ids
    of the ``tokenizers`` library (added tokens included) at a quarter of its
    CPU time; the tests compare the two.
    """
    if path not in _ENCODERS:
        import json

        import public_tokenizers
        import tiktoken
        with open(local_path(path), encoding="utf-8") as f:
            spec = json.load(f)
        byte = _byte_alphabet()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in added}
        _ENCODERS[path] = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN,
                                            mergeable_ranks=ranks, special_tokens=added)
    return _ENCODERS[path]


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text as uint32; an added token's own string is that token."""
    return encoder(path).encode_to_numpy(text, allowed_special="all") if text else np.zeros(0, np.uint32)


class Packer:
    """Sum-of-squares packer of one stream.  A window is a list of pieces
    ``(doc_id, start, ids, doc_tokens)``; closed windows go to ``done``."""

    def __init__(self, window: int = 2048, max_open: int = 4096):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, np.int64)      # windows filled to each level
        self.open: list[list[list]] = [[] for _ in range(window + 1)]
        self.n_open = 0
        self.done: list[list[tuple]] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, w = len(ids), self.window
        full = n - n % w
        for at in range(0, full, w):
            self.done.append([(doc_id, at, ids[at:at + w], n)])
        if n > full:
            self._place((doc_id, full, ids[full:].copy(), n))

    def _place(self, piece: tuple) -> None:
        s, w, levels = len(piece[2]), self.window, self.levels
        # change of the sum of squares if a window at level h moves to h + s
        change = 2 * (levels[s:w + 1] - levels[:w + 1 - s]) + 2
        change[w - s] = -2 * levels[w - s] + 1            # a window that gets full leaves the sum
        change[0] = 2 * levels[s] + 1 if s < w else 0     # a new window
        change[1:][levels[1:w + 1 - s] == 0] = np.iinfo(np.int64).max
        h = w - s - int(np.argmin(change[::-1]))
        if h:
            window = self.open[h].pop()
            levels[h] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        if h + s == w:
            self.done.append(window)
        else:
            self.open[h + s].append(window)
            levels[h + s] += 1
            self.n_open += 1
            if self.n_open > self.max_open:
                self.drain(last=False)

    def drain(self, last: bool) -> None:
        """Join the open windows by cutting the emptiest ones; the remaining one
        stays open, or is closed at the end of the input."""
        todo = [x for level in range(1, self.window) for x in self.open[level]]
        self.levels[:] = 0
        self.open = [[] for _ in range(self.window + 1)]
        self.n_open = 0
        lo, hi = 0, len(todo) - 1                          # emptiest and fullest
        fill = [sum(len(p[2]) for p in x) for x in todo]
        while lo < hi:
            need = self.window - fill[hi]
            while need and lo < hi:
                doc_id, start, ids, n = todo[lo].pop()
                take = min(need, len(ids))
                todo[hi].append((doc_id, start + len(ids) - take, ids[len(ids) - take:], n))
                if take < len(ids):
                    todo[lo].append((doc_id, start, ids[:len(ids) - take], n))
                fill[lo] -= take
                need -= take
                lo += not fill[lo]
            if need:                                       # the last one: it has taken all others
                fill[hi] = self.window - need
                break
            self.done.append(todo[hi])
            hi -= 1
        if lo <= hi and todo and fill[hi]:
            if last:
                self.done.append(todo[hi])
            else:
                self.open[fill[hi]].append(todo[hi])
                self.levels[fill[hi]] += 1
                self.n_open = 1

    def take(self) -> list[list[tuple]]:
        out, self.done = self.done, []
        return out


def _rows(windows: list[list[tuple]], first_id: int) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in range(8)]
    for k, window in enumerate(windows):
        total = sum(len(p[2]) for p in window)
        offset = 0
        for doc_id, start, ids, n in window:
            for c, v in zip(cols, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n,
                                   first_id + k, offset, total), strict=True):
                c.append(v)
            offset += len(ids)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=_ARROW)


def pack(docs: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", window: int = 2048,
         end_id: int = 1, max_open: int = 4096) -> DataFrame:
    """Pieces of all documents (columns ``doc_id``, ``text``) placed in windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        packer, next_id = Packer(window, max_open), TaskContext.get().partitionId() << 33
        for batch in small_batches(batches):
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, texts(batch), strict=True):
                packer.add(doc_id, np.append(token_ids(text, tokenizer), np.uint32(end_id)))
            if packer.done:
                windows = packer.take()
                yield _rows(windows, next_id)
                next_id += len(windows)
        packer.drain(last=True)
        if packer.done:
            yield _rows(packer.take(), next_id)

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
