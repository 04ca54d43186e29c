"""Stream sources, watermarks, sinks and query start-up.

Checkpoints live under the shared folder named by ``spark.checkpoint.dir``
(``tidewatch.session.stream_checkpoint``), so a restarted driver or a lost
executor resumes from the last committed batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.session import checkpoint_root, stream_checkpoint

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_time(df: DataFrame, col: str = "event_time", delay: str = "0 seconds") -> DataFrame:
    """T-10/T-11: TIMESTAMP event time (NTZ is cast; ``withWatermark`` needs
    TIMESTAMP) with a bounded-out-of-orderness watermark of ``delay``."""
    if dict(df.dtypes).get(col) == "timestamp_ntz":
        df = df.withColumn(col, F.col(col).cast("timestamp"))
    return df.withWatermark(col, delay)


def read_table_stream(spark: SparkSession, path: str, schema, max_files: int | None = None
                      ) -> DataFrame:
    """Parquet files arriving in a directory, as a stream."""
    r = spark.readStream.schema(schema).format("parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path)


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state in RocksDB (required by ``transformWithState``)."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def start(df: DataFrame, name: str, mode: str = "append", sink: str = "memory",
          path: str | None = None, foreach_batch: Callable | None = None,
          available_now: bool = False, processing_time: str | None = None):
    """Start a query with its checkpoint under the shared folder."""
    spark = df.sparkSession
    w = (df.writeStream.queryName(name).outputMode(mode)
         .option("checkpointLocation", stream_checkpoint(spark, name)))
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def _overwrite(df: DataFrame, base: str, parts: list[str], fmt: str) -> None:
    """Write ``df`` into its own partitions of ``base``, replacing what an earlier
    run of the same batch left there; other partitions are not touched."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).format(fmt).save(base))


def batch_writer(base: str, fmt: str = "parquet") -> Callable:
    """Rows of each batch in ``<base>/batch=<id>``; a replayed batch replaces its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{base}/batch={batch_id}")
    return write


def tagged_writer(base: str, tag_col: str = "outcome", fmt: str = "parquet") -> Callable:
    """K-2/T-7: side outputs.  Each batch is written once, partitioned by tag
    (``<base>/<tag_col>=<tag>/batch=<id>``), so every tag is its own folder
    without a pass per tag; a replayed batch replaces its own files."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _overwrite(batch.withColumn("batch", F.lit(batch_id)), base, [tag_col, "batch"], fmt)
    return write


def _day(time_col: str) -> Column:
    return F.date_format(time_col, "yyyy-MM-dd").alias("day")


def changelog_writer(base: str, fmt: str = "parquet", time_col: str = "window_end") -> Callable:
    """K-4/T-12: keyed upserts as a change log, partitioned by the window's day
    and the batch (``<base>/day=<d>/batch=<id>``); ``latest`` reads the newest
    value of every key.  Appends stay cheap at any table size, and a replayed
    batch replaces its own files."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _overwrite(batch.withColumn("day", _day(time_col)).withColumn("batch", F.lit(batch_id)),
                   base, ["day", "batch"], fmt)
    return write


def latest(spark: SparkSession, base: str, keys: list[str], fmt: str = "parquet",
           days: list[str] | None = None) -> DataFrame:
    """Newest row per key of a change log (a partial + final ``max_by``); with
    ``days`` only those days' partitions are read."""
    log = spark.read.format(fmt).option("recursiveFileLookup", "false").load(base) \
        .withColumn("day", F.col("day").cast("string"))
    if days is not None:
        log = log.where(F.col("day").isin(days))
    vals = [c for c in log.columns if c not in (*keys, "batch", "day")]
    newest = F.max_by(F.struct(*vals), F.col("batch"))
    return log.groupBy(*keys).agg(newest.alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c)
                                                                      for c in vals])


def compact(spark: SparkSession, base: str, keys: list[str], before_day: str,
            fmt: str = "parquet", time_col: str = "window_end") -> int:
    """Rewrite the closed days of a change log to one revision per key.

    The newest rows of a day go to its last batch's partition, then the older
    batches' partitions are deleted; a run that breaks off between the two
    leaves revisions that ``latest`` resolves alike.  Returns the days done."""
    log = spark.read.format(fmt).load(base).withColumn("day", F.col("day").cast("string"))
    closed = log.where(F.col("day") < before_day).groupBy("day") \
        .agg(F.max("batch").alias("last"), F.count_distinct("batch").alias("n")).where("n > 1").collect()
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for r in closed:                                       # a handful of days per run
        newest = latest(spark, base, keys, fmt, [r.day]).withColumn("day", F.lit(r.day)) \
            .withColumn("batch", F.lit(r["last"]))
        _overwrite(cut(newest), base, ["day", "batch"], fmt)
        folder = fs_path(f"{base}/day={r.day}")
        fs = folder.getFileSystem(conf)
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("batch=") and int(name.split("=")[1]) != r["last"]:
                fs.delete(status.getPath(), True)
    return len(closed)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, before a source is overwritten."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


class LateRows:
    """T-13: rows that stateful operators dropped as later than the watermark,
    added up over all progress reports of a query as they come, whatever number
    of them the query itself remembers."""

    def __init__(self, spark: SparkSession, name: str):
        from pyspark.sql.streaming import StreamingQueryListener
        counter, self.total = self, 0

        class Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                if event.progress.name == name:
                    counter.total += sum(int(o.numRowsDroppedByWatermark or 0) for o in event.progress.stateOperators)

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        self.listener = Listener()
        spark.streams.addListener(self.listener)
        self.spark = spark

    def close(self) -> int:
        """Stop counting (after the reports on their way have come)."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        self.spark.streams.removeListener(self.listener)
        return self.total


def dropped_late_rows(query) -> int:
    """T-13: rows the stateful operators of a query dropped as later than
    the watermark, summed over its recent progress reports."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            v = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) \
                else getattr(op, "numRowsDroppedByWatermark", 0)
            total += int(v or 0)
    return total
