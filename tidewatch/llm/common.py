"""Shared helpers: tables, checkpoints, row keys, Arrow column access."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.session import checkpoint_root


def ship(spark: SparkSession) -> None:
    """Send this package's code to the workers, once per Spark context.

    Arrow batches are also made smaller, where the session has Spark's default
    of 10,000 rows: that many whole texts would not fit beside a worker."""
    global _SHIPPED
    for key, default, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"),
                                ("spark.sql.execution.arrow.maxBytesPerBatch", None, str(16 << 20))):
        if spark.conf.get(key, default) in (default, None):
            spark.conf.set(key, value)
    if _SHIPPED == spark.sparkContext.applicationId:
        return
    import tempfile
    import zipfile

    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tidewatch-code-")     # on the driver; Spark serves it from there
    path = os.path.join(folder, "tidewatch_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED = spark.sparkContext.applicationId


_SHIPPED: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name in the shared checkpoint folder; all of this context are
    deleted when Python exits."""
    folder = f"{checkpoint_root(spark)}/tidewatch-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_delete, spark, folder)
    return f"{folder}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the frame as a table in the shared checkpoint folder
    and read it back."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_FOLDERS: set[str] = set()


def _delete(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):                   # the context may be gone by then
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Most rows of a counted side that is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def few(df: DataFrame, most: int = BROADCAST_ROWS, lists: str | None = None) -> DataFrame:
    """Broadcast a side that ``cut`` has written, if its counted rows (and the
    elements of its column ``lists``) allow."""
    n = F.count("*") if lists is None else F.count("*") + F.coalesce(F.sum(F.size(lists)), F.lit(0))
    return F.broadcast(df) if df.agg(n).first()[0] <= most else df


def remainder(df_id: Column, divisor: int) -> Column:
    """crc32 of the id's text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(df_id).cast("string").cast("binary")) % divisor if isinstance(df_id, str) \
        else F.crc32(df_id.cast("string").cast("binary")) % divisor


def labelled_sample(labels: DataFrame, label: str, divisor: int, held: int, most: int) -> DataFrame:
    """At most ``most`` labelled ids outside the held-out remainder, by hash of the id."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
            .where(remainder("doc_id", divisor) != held)
            .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.avg(F.col(label).cast("double")).alias("_label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))


def one_per_id(docs: DataFrame, *keys: str) -> DataFrame:
    """One row of ``keys`` and ``text`` for each of the keys, the text of smallest hash, so that
    an id on very many rows is one text of a bounded sample.  Repeats meet map-side."""
    text = F.coalesce("text", F.lit(""))
    return docs.groupBy(*keys).agg(F.min_by("text", F.struct(F.xxhash64(text), text)).alias("text"))


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that name a text (null: empty)."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(0x5EED), t).alias("k2")]


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The batch's texts; null counts as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], name: str = "text",
                  max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``max_bytes`` of text each (one row at
    least), so that numpy work holds a bounded amount at a time."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, upto - at)
            at = upto
    _release()


def _release() -> None:
    """Give freed memory back at the end of a task: workers live on for other tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):     # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def local_path(path: str) -> str:
    """A vocabulary path given by the caller, or a bare name of the installed set."""
    if os.path.isabs(path):
        return path
    import public_tokenizers
    return public_tokenizers.path(path)
