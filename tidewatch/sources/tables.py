"""Adapters: driver test tables -> the reference's record types.

``events(event_id, ts TIMESTAMP_NTZ, user_id, event_type, value, props)``
stands in for every behaviour log.  Each adapter is a projection (plus one
dimension join for provinces), so Catalyst prunes the scan to the columns a
job uses and pushes its filters into the Parquet reader.  ``event_id`` is
kept as the tie-break for rows with equal event time.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def item_of(props: str = "props"):
    """The item an event is about: ``k`` of its JSON properties."""
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def user_behavior(events: DataFrame) -> DataFrame:
    """UserBehavior: behaviour = event type, item = props.k."""
    item = item_of()
    return events.select(
        F.col("user_id"), item.alias("item_id"), F.pmod(item, F.lit(10)).cast("int").alias("category_id"),
        F.col("event_type").alias("behavior"), F.col("ts").alias("event_time"),
        F.col("event_id"))


def access_log(events: DataFrame) -> DataFrame:
    """ApacheLogEvent: event type and item make the URL; items ending in 0 and 1
    are a style sheet and an image (static resources)."""
    item = item_of()
    ending = (F.when(F.pmod(item, F.lit(10)) == 0, ".css").when(F.pmod(item, F.lit(10)) == 1, ".png")
              .otherwise(""))
    return events.select(
        F.lit(None).cast("string").alias("ip"), F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("event_time"), F.lit("GET").alias("method"),
        F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), item.cast("string"), ending).alias("url"),
        F.col("event_id"))


def marketing(events: DataFrame, channels: int = 5) -> DataFrame:
    """MarketingUserBehavior: channel = user_id mod ``channels``."""
    return events.select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("behavior"),
        F.pmod(F.col("user_id"), F.lit(channels)).cast("string").alias("channel"),
        F.col("ts").alias("event_time"), F.col("event_id"))


def ad_click(events: DataFrame) -> DataFrame:
    """AdClickLog: the click events; the ad is the item, the province is
    named by its number (user_id mod 25) until ``with_province`` looks it up."""
    return events.where(F.col("event_type") == "click").select(
        F.col("user_id"), F.get_json_object("props", "$.k").alias("ad_id"),
        F.pmod(F.col("user_id"), F.lit(25)).cast("int").alias("province_key"),
        F.lit(None).cast("string").alias("city"), F.col("ts").alias("event_time"), F.col("event_id"))


def with_province(clicks: DataFrame, nation: DataFrame) -> DataFrame:
    """The province name of each click (or count) from its number.

    ``nation`` is a dimension; the join is left to the planner, which
    broadcasts it only while its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both
    sides.  A left join keeps every row whatever the dimension holds.
    """
    n = nation.select(F.col("n_nationkey").alias("province_key"), F.col("n_name").alias("province"))
    return clicks.join(n, "province_key", "left").drop("province_key")


# The event type that plays a failed login; every other type is a success.
LOGIN_FAIL = "error"


def login(events: DataFrame) -> DataFrame:
    """LoginEvent with the event type as is: pass ``fail=LOGIN_FAIL`` to the
    login jobs.  (Mapping it to 'fail' here would hide the job's filter from
    the Parquet reader: Catalyst cannot push a predicate on a CASE result.)"""
    return events.select(
        F.col("user_id"), F.lit(None).cast("string").alias("ip"), F.col("event_type"),
        F.col("ts").alias("event_time"), F.col("event_id"))


def order_events(events: DataFrame) -> DataFrame:
    """OrderEvent: signup = create, purchase = pay; the order is the user and
    the transaction id is user and UTC day (``'<user>-<yyyy-mm-dd>'``).
    Other event types are not order events and are left out."""
    kind = (F.when(F.col("event_type") == "signup", "create")
            .when(F.col("event_type") == "purchase", "pay"))
    tx = F.when(kind == "pay", F.concat_ws("-", F.col("user_id").cast("string"),
                                           F.to_date("ts").cast("string"))).otherwise(F.lit(""))
    return (events.where(F.col("event_type").isin("signup", "purchase"))
            .select(F.col("user_id").alias("order_id"), kind.alias("event_type"),
                    tx.alias("tx_id"), F.col("ts").alias("event_time"), F.col("event_id"),
                    F.to_date("ts").alias("day")))


def receipts(events: DataFrame) -> DataFrame:
    """ReceiptEvent: a signup acknowledges the day's transaction of its user."""
    return (events.where(F.col("event_type") == "signup")
            .select(F.concat_ws("-", F.col("user_id").cast("string"),
                                F.to_date("ts").cast("string")).alias("tx_id"),
                    F.lit("wechat").alias("pay_channel"), F.col("ts").alias("event_time"),
                    F.col("event_id")))
