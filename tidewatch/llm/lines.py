"""Operator 10: removal of lines that spread over many sites.

A line (trimmed of spaces; empty lines never count) is boilerplate when it
stands on at least ``min_sites`` distinct sites (``source``).  Lines seen fewer
times than that, or on one site only, are out after one hash aggregate.  For
the others a HyperLogLog sketch of sites per line hash is built and merged by
aggregation.  Estimates of at least twice the threshold are boilerplate, those
under half of it are not, and the lines between get an exact distinct count.

A text is one voter however often it stands: copies of it count for its smallest
source only, so a text copied to many sites keeps its lines.  In ``remove_all``, the
pipeline's stage, near copies vote as one too: documents of which the lines found first
hold more than ``max_share`` of the bytes are put in classes of near copies
(``partenum``), each class votes for its lines as one site, and the lines still on
``min_sites`` sites go.  In both the lines found leave every document, whatever their
share of it.

Lines are named by 128 bits of hash, sites by 64.  Counting shuffles one row
per distinct line and task; a hot line is summed before the shuffle.  Sets of
line hashes are broadcast up to ``broadcast_lines`` rows (counted first) and
joined by shuffle beyond that.  So is removal: with few lines found a task hashes its
documents' lines against them, in one walk and without a shuffle; with more, the
places of the found lines of each text are joined to it by key.

Defined cases: a null text counts as empty (one empty line); a null source is no
site, its lines are removed like others; a null doc_id is kept; repeated rows
keep one result each; a very long text is one row of one task, in time and memory
linear in its lines; an empty table gives no rows; columns named like a result are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewatch.llm import partenum
from tidewatch.llm.common import cut, few, ship, small_batches, text_key

#: Lines, lines removed, bytes of all trimmed lines and of the removed ones.
RESULT = ("n_lines", "n_removed", "line_bytes", "removed_bytes")


def _hashes(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(77), line).alias("h2")]


def _lines(docs: DataFrame, *cols: str) -> DataFrame:
    """One row per non-empty line: ``cols``, position, two hashes, bytes."""
    return (docs.select(*cols, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
            .withColumn("line", F.trim("line")).where(F.col("line") != "")
            .select(*cols, "pos", *_hashes(F.col("line")), F.octet_length("line").alias("size")))


def _on_sites(lines: DataFrame, min_sites: int, lg_k: int, broadcast_lines: int) -> DataFrame:
    """Hashes ``h1, h2`` of the ``lines(h1, h2, site)`` on at least ``min_sites`` sites."""
    often = cut(lines.groupBy("h1", "h2")
                .agg(F.count("*").alias("n"), F.min("site").alias("lo"), F.max("site").alias("hi"))
                .where((F.col("n") >= min_sites) & ((F.col("lo") < F.col("hi")) | F.lit(min_sites <= 1)))
                .select("h1", "h2"))
    spread = cut(lines.join(few(often, broadcast_lines), ["h1", "h2"], "left_semi")
                 .groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
                 .where(F.col("sites") >= min_sites / 2))
    near = cut(spread.where(F.col("sites") < 2 * min_sites).select("h1", "h2"))
    exact = (lines.join(few(near, broadcast_lines), ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2").agg(F.count_distinct("site").alias("n"))
             .where(F.col("n") >= min_sites).select("h1", "h2"))
    return spread.where(F.col("sites") >= 2 * min_sites).select("h1", "h2").unionByName(exact)


def _sited(docs: DataFrame) -> DataFrame:
    """``k1`` (a hash of the text), ``text`` and ``site`` of the documents with a source."""
    return docs.where(F.col("source").isNotNull()) \
        .select(text_key(F.col("text"))[0], "text", F.xxhash64("source").alias("site"))


def _voters(docs: DataFrame, broadcast_lines: int) -> DataFrame:
    """``k1, text, site`` of the documents with a source; copies of a text have its smallest source."""
    placed = docs.where(F.col("source").isNotNull()).select("text", "source", *text_key(F.col("text")))
    copied = cut(placed.groupBy("k1", "k2").agg(F.min("source").alias("lo"), F.max("source").alias("hi"))
                 .where("lo < hi").select("k1", "k2", "lo"))
    return placed.join(few(copied, broadcast_lines), ["k1", "k2"], "left") \
        .select("k1", "text", F.xxhash64(F.coalesce("lo", "source")).alias("site"))


def boilerplate(docs: DataFrame, *, min_sites: int = 10, lg_k: int = 12,
                broadcast_lines: int = 200_000) -> DataFrame:
    """Hashes ``h1, h2`` of the lines on at least ``min_sites`` sites."""
    lines = _lines(_voters(docs, broadcast_lines), "site").select("h1", "h2", "site")
    return _on_sites(lines, min_sites, lg_k, broadcast_lines)


def voted(docs: DataFrame, found: DataFrame, *, min_sites: int = 10, max_share: float = 0.5, lg_k: int = 12,
          broadcast_lines: int = 200_000) -> DataFrame:
    """Those of the lines ``found`` that are on ``min_sites`` sites when near copies vote once.

    Near copies are looked for among the documents of which ``found`` holds more than
    ``max_share`` of the line bytes; a class of them stands on its smallest site only."""
    large = _without(docs.select("text", "source"), found, broadcast_lines, strip=False) \
        .where(F.col("removed_bytes") > max_share * F.col("line_bytes"))
    texts = cut(_sited(large).groupBy("k1").agg(F.first("text").alias("text"), F.min("site").alias("site")))
    if not texts.limit(1).count():
        return found
    classes = cut(partenum.classes(texts.select(F.col("k1").alias("doc_id"), "text"))
                  .select(F.col("doc_id").alias("k1"), "component_id").join(texts.select("k1", "site"), "k1"))
    vote = cut(classes.groupBy("component_id").agg(F.min("site").alias("vote")))
    votes = cut(classes.join(few(vote), "component_id").select("k1", "vote"))
    lines = _lines(_voters(docs, broadcast_lines), "k1", "site").join(few(found, broadcast_lines), ["h1", "h2"], "left_semi") \
        .join(few(votes), "k1", "left").select("h1", "h2", F.coalesce("vote", "site").alias("site"))
    return _on_sites(lines, min_sites, lg_k, broadcast_lines)


def remove(docs: DataFrame, *, min_sites: int = 10, lg_k: int = 12, broadcast_lines: int = 200_000) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and RESULT columns."""
    found = cut(boilerplate(docs, min_sites=min_sites, lg_k=lg_k, broadcast_lines=broadcast_lines))
    return _without(docs, found, broadcast_lines)


def remove_all(docs: DataFrame, *, min_sites: int = 10, max_share: float = 0.5, lg_k: int = 12,
               broadcast_lines: int = 200_000) -> DataFrame:
    """As ``remove``, but near copies vote once for their lines."""
    settings = {"min_sites": min_sites, "lg_k": lg_k, "broadcast_lines": broadcast_lines}
    found = cut(boilerplate(docs, **settings))
    return _without(docs, cut(voted(docs, found, max_share=max_share, **settings)), broadcast_lines)


def line_name(line: str) -> tuple[int, int]:
    """The two hashes of ``_hashes``, outside Spark."""
    import xxhash

    raw = line.encode("utf-8")
    salted = xxhash.xxh64_intdigest((77).to_bytes(4, "little"), seed=42)   # the hash of the salt is the next one's seed
    out = (xxhash.xxh64_intdigest(raw, seed=42), xxhash.xxh64_intdigest(raw, seed=salted))
    return tuple(h - (1 << 64) if h >> 63 else h for h in out)


def stripped(text: str, gone) -> tuple[str, int, int, int, int]:
    """(text without the lines that ``gone(place, trimmed line)`` names, RESULT)."""
    parts = text.split("\n")
    kept, size, less = [], 0, 0
    for i, line in enumerate(parts):
        trimmed = line.strip(" ")
        n = len(trimmed.encode("utf-8")) if not trimmed.isascii() else len(trimmed)
        size += n
        if trimmed and gone(i, trimmed):
            less += n
        else:
            kept.append(line)
    removed = len(parts) - len(kept)
    return "\n".join(kept) if removed else text, len(parts), removed, size, less


def _without(docs: DataFrame, found: DataFrame, broadcast_lines: int, strip: bool = True) -> DataFrame:
    """``docs`` less the lines ``found`` (or only counted, with ``strip`` off), and RESULT."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(*[c for c in docs.columns if c not in (*RESULT, "__gone")])
    columns, at = docs.columns, docs.columns.index("text")
    kind = StructType([*docs.schema.fields, *[StructField(c, LongType()) for c in RESULT]])
    if found.count() <= broadcast_lines:
        named = found.select("h1", "h2").toArrow()
        names = spark.sparkContext.broadcast(set(zip(named["h1"].to_pylist(), named["h2"].to_pylist(), strict=True)))
        rows, memo_most = docs, 200_000
    else:
        keyed = docs.select(*text_key(F.col("text")), "text")
        placed = _lines(keyed, "k1", "k2").join(found, ["h1", "h2"], "left_semi").groupBy("k1", "k2") \
            .agg(F.collect_set("pos").alias("__gone")) \
            .withColumnRenamed("k1", "__k1").withColumnRenamed("k2", "__k2")
        k1, k2 = text_key(F.col("text"))
        rows = docs.join(placed, (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left").select(*columns, "__gone")
        names, memo_most = None, 0

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, bool] = {}

        def known(_: int, line: str) -> bool:
            hit = memo.get(line)
            if hit is None:
                hit = line_name(line) in names.value
                if len(line) < 200:
                    if len(memo) >= memo_most:
                        memo.clear()
                    memo[line] = hit
            return hit

        for batch in small_batches(batches):
            lists = batch.column("__gone").to_pylist() if names is None else [None] * batch.num_rows
            out = []
            for text, gone in zip(batch.column("text").to_pylist(), lists, strict=True):
                places = set(gone or ())
                out.append(stripped(text or "", known if names is not None else lambda i, _: i in places))
            texts = pa.array([t if t is None or not x[2] or not strip else x[0]
                              for t, x in zip(batch.column("text").to_pylist(), out, strict=True)], pa.string())
            arrays = [batch.column(k) for k in range(len(columns))]
            arrays[at] = texts
            yield pa.RecordBatch.from_arrays(
                arrays + [pa.array([x[k] for x in out], pa.int64()) for k in range(1, 5)], names=[*columns, *RESULT])

    return rows.mapInArrow(walk, kind)
