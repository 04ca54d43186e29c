"""Operator 3: byte-level BPE encoding by overlapping chunks, and decoding.

A text of up to ``chunk`` characters is one chunk.  A longer one is cut into
chunks that overlap by ``overlap`` characters, and the chunks are pre-tokenised
in parallel, as rows of their own.  The split pattern does not look behind, so
once two neighbouring chunks both have a boundary at one position, both go on
alike from there: the texts are stitched at the first such position, and the
pieces are then encoded.  Where an overlap holds no common boundary (one run of
letters, say) matching simply goes on from the last good one.  Decoding joins
the raw bytes of the ids.

Only long texts are shuffled (by row, for stitching); all others are encoded in
the scan's own tasks.

Defined cases: a null text counts as empty (no ids, hash of no bytes); a null
doc_id is kept; repeated rows give one result per row; an empty table gives no
rows; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import local_path, ship, small_batches, texts
from tidewatch.llm.pieces import PieceEncoder, load_ranks, merge_ids, split_pattern

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                    ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

_CODECS: dict[str, Codec] = {}


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str):
        self.ranks = load_ranks(local_path(path))
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.encoder = PieceEncoder(lambda found: [merge_ids(p.encode(), self.ranks) for p in found])

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _result(doc_ids: list, packed: list[bytes], c: Codec) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(doc_ids, pa.int64()),
        pa.array([len(p) // 4 for p in packed], pa.int64()),
        pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
        pa.array([hashlib.sha256(c.decode(np.frombuffer(p, "<u4"))).hexdigest() for p in packed]),
    ], schema=_ARROW)


def boundaries(text: str, last: bool, pattern=None) -> list[int]:
    """Ends of the pre-tokens of a chunk that its text alone decides: all of the
    last chunk's, otherwise those that end some characters before the chunk does
    (a contraction may need two more)."""
    pattern = pattern or split_pattern()
    ends = [m.end() for m in pattern.finditer(text)]
    return ends if last else [e for e in ends if e < len(text) - 4]


def stitch(starts: list[int], ends: list[list[int]], text: str, pattern=None) -> list[int]:
    """Ends of all pre-tokens of ``text``, from those of its chunks (relative to
    each chunk's start).  The first chunk is right from its start; a later one is
    right from the first end that it shares with what precedes it."""
    pattern = pattern or split_pattern()
    out = list(ends[0])
    for k in range(1, len(starts)):
        own = [starts[k] + e for e in ends[k]]
        common = set(own)
        at = len(out) - 1
        first = None
        while at >= 0 and out[at] >= starts[k]:
            if out[at] in common:
                first = at
            at -= 1
        if first is not None:
            meet = out[first]
            del out[first + 1:]
        else:                                              # no common boundary: go on until one
            meet = None
            for m in pattern.finditer(text, out[-1] if out else 0):
                out.append(m.end())
                if m.end() in common:
                    meet = m.end()
                    break
            if meet is None:
                continue
        out += [e for e in own if e > meet]
    if not out or out[-1] < len(text):
        out += [m.end() for m in pattern.finditer(text, out[-1] if out else 0)]
    return out


def encode(docs: DataFrame, *, ranks: str = "byte_bpe_multi_50k.tiktoken",
           chunk: int = 65536, overlap: int = 1024) -> DataFrame:
    """Number and hash of the ids of every text, and the hash of the decoded bytes."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for batch in small_batches(batches):
            yield _result(batch.column("doc_id").to_pylist(), c.encoder.encode_many(texts(batch)), c)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = split_pattern()
        for batch in batches:
            ends = [boundaries(t, n, pattern) for t, n in
                    zip(texts(batch), batch.column("last").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("row", "doc_id", "at", "text")),
                 pa.array(ends, pa.list_(pa.int32()))], names=["row", "doc_id", "at", "text", "ends"])

    def join(group: pa.Table) -> pa.Table:
        c = codec(ranks)
        group = group.sort_by("at")
        at, parts = group.column("at").to_pylist(), group.column("text").to_pylist()
        text = "".join(p[:chunk] for p in parts[:-1]) + parts[-1]
        ends = stitch(at, group.column("ends").to_pylist(), text, c.encoder.pattern)
        found = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        step = 50_000
        packed = b"".join(c.encoder.pieces_to_bytes(found[i:i + step]) for i in range(0, len(found), step))
        return pa.Table.from_batches([_result(group.column("doc_id").to_pylist()[:1], [packed], c)])

    ship(docs.sparkSession)
    short = rows.where(F.length("text") <= chunk).mapInArrow(whole, SCHEMA)
    n = F.ceil(F.length("text") / F.lit(chunk)).cast("int")
    chunks = (rows.withColumn("row", F.monotonically_increasing_id()).where(F.length("text") > chunk)
              .select("row", "doc_id", "text", F.posexplode(F.sequence(F.lit(0), n - 1)).alias("k", "_"), n.alias("n"))
              .select("row", "doc_id", (F.col("k") * chunk).alias("at"),
                      F.substring(F.col("text"), F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("text"),
                      (F.col("k") == F.col("n") - 1).alias("last")))
    # chunks are dealt out over the cluster before the costly part, then meet by row
    parts = chunks.repartition("row", "at").mapInArrow(
        split, "row long, doc_id long, at int, text string, ends array<int>")
    long = parts.groupBy("row").applyInArrow(join, SCHEMA)
    return short.unionByName(long)
