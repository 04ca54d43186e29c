"""Line sources (S-1, S-3): the same decoder serves a file read and a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.sources.decode import DECODERS


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files (or a directory of them) as a ``value`` column."""
    if stream:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.load(path)
    return spark.read.text(path)


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """S-3: Spark's own line socket source (meant for demos, not production)."""
    return (spark.readStream.format("socket").option("host", host)
            .option("port", str(port)).load())


def read_records(spark: SparkSession, kind: str, path: str, stream: bool = False,
                 mode: str = "strict", **kw) -> DataFrame:
    """Read and decode one record type: ``read_records(spark, 'login', path)``.

    In batch a ``seq`` column is added: a stable tie-break for rows with the
    same event time (line order inside a split, splits in path order; the
    same files split the same way on a re-run, so a lost task recomputes
    the same numbers).
    """
    lines = read_lines(spark, path, stream=stream, **kw)
    out = DECODERS[kind](lines, mode=mode)
    if not stream:
        out = out.withColumn("seq", F.monotonically_increasing_id())
    return out
