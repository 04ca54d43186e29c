"""Kafka source and sink (S-2, K-3).

The Kafka connector jar is not on this image's classpath; these build the
reader/writer so that a cluster with the connector runs them unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.session import stream_checkpoint


def kafka_options(bootstrap: str, topic: str, starting: str = "latest",
                  group: str | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting}
    if group:
        opts["kafka.group.id"] = group
    return opts


def read_kafka_lines(spark: SparkSession, bootstrap: str, topic: str,
                     starting: str = "latest", group: str | None = None,
                     stream: bool = True) -> DataFrame:
    """Topic values as a ``value`` string column, ready for a decoder."""
    r = spark.readStream if stream else spark.read
    r = r.format("kafka")
    for k, v in kafka_options(bootstrap, topic, starting, group).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def kafka_writer(lines: DataFrame, bootstrap: str, topic: str):
    """K-3: every executor writes its own partition of lines to the topic."""
    return (lines.select(F.col(lines.columns[0]).cast("string").alias("value"))
            .write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic))


def kafka_stream_writer(rows: DataFrame, bootstrap: str, topic: str, name: str, key: str | None = None):
    """K-3 as a stream sink: every row as one message, its columns as JSON (a single column
    as it is), with ``key`` as the message key so that a key's messages keep their order.

    Returns the writer; ``start()`` runs it.  Its checkpoint lies in the shared folder; after a
    restart the last batch may be sent again, as Kafka's sink does at least once."""
    one = len(rows.columns) == 1
    value = F.col(rows.columns[0]).cast("string") if one else F.to_json(F.struct(*rows.columns))
    keyed = [F.col(key).cast("string").alias("key")] if key else []
    return (rows.select(*keyed, value.alias("value")).writeStream.queryName(name).outputMode("append").format("kafka")
            .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
            .option("checkpointLocation", stream_checkpoint(rows.sparkSession, name)))
