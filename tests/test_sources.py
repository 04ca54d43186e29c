from datetime import datetime

import pytest

from tidewatch.sources import decode as D
from tidewatch.sources.text import read_records

from helpers import lines


def test_user_behavior_decode(spark):
    df = D.decode_user_behavior(lines(spark, "812,77,5150,pv,1700000000"))
    r = df.collect()[0]
    assert (r.user_id, r.item_id, r.category_id, r.behavior) == (812, 77, 5150, "pv")
    assert r.event_time == datetime(2023, 11, 14, 22, 13, 20)
    assert dict(df.dtypes)["event_time"] == "timestamp"


def test_order_event_keeps_empty_tx(spark):
    df = D.decode_order_event(lines(spark, "501,create,,1700000000\n501,pay,tx-501,1700000002"))
    rows = df.orderBy("event_time").collect()
    assert rows[0].tx_id == "" and rows[1].tx_id == "tx-501"


def test_receipt_login_ad_click(spark):
    r = D.decode_receipt(lines(spark, "tx-502,card,1700000003")).collect()[0]
    assert (r.tx_id, r.pay_channel) == ("tx-502", "card")
    l = D.decode_login(lines(spark, "66,10.1.2.3,success,1700000004")).collect()[0]
    assert (l.user_id, l.event_type) == (66, "success")
    a = D.decode_ad_click(lines(spark, "812,77,north,portside,1700000005")).collect()[0]
    assert (a.province, a.city, a.ad_id) == ("north", "portside", 77)


def test_access_log_honours_offset(spark):
    text = ("10.9.8.7 - - 02/03/2024:10:05:14 +0000 GET /guide/start/\n"
            "10.9.8.6 - - 02/03/2024:12:05:14 +0200 GET /x.css")
    rows = D.decode_access_log(lines(spark, text)).collect()
    assert rows[0].event_time == rows[1].event_time == datetime(2024, 3, 2, 10, 5, 14)
    assert rows[0].url == "/guide/start/" and rows[0].method == "GET"


def test_nineteen_digit_user_id(spark):
    r = D.decode_login(lines(spark, "9223372036854775807,1.1.1.1,fail,1700000006")).collect()[0]
    assert r.user_id == 9223372036854775807


def test_strict_mode_fails_on_malformed_line(spark):
    df = D.decode_login(lines(spark, "abc,1.1.1.1,fail,1700000006"))
    with pytest.raises(Exception):
        df.collect()


def test_permissive_mode_flags_malformed_line(spark):
    df = D.decode_login(lines(spark, "abc,1.1.1.1,fail,1700000006\n7,1.1.1.1,fail,1700000006"),
                        mode="permissive")
    flags = sorted(r.malformed for r in df.collect())
    assert flags == [False, True]


def test_read_records_from_files(spark, tmp_path):
    p = tmp_path / "logins.csv"
    p.write_text("1,ip,fail,100\n1,ip,fail,101\n")
    df = read_records(spark, "login", str(p))
    assert df.count() == 2 and "seq" in df.columns


def test_kafka_options_and_writer_build(spark):
    from tidewatch.sources.kafka import kafka_options, kafka_writer
    opts = kafka_options("broker:9092", "behaviour", group="tidewatch")
    assert opts == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "behaviour",
                    "startingOffsets": "latest", "kafka.group.id": "tidewatch"}
    w = kafka_writer(spark.createDataFrame([("a,b",)], "line STRING"), "broker:9092", "behaviour")
    assert w is not None   # the connector jar is needed only to save


def test_socket_stream_is_a_line_source(spark):
    from tidewatch.sources.text import read_socket
    df = read_socket(spark, "localhost", 7777)   # not started: nothing connects
    assert df.isStreaming and df.columns == ["value"]


GOOD = {
    "user_behavior": "812,77,5150,pv,1700000000", "ad_click": "812,77,north,portside,1700000000",
    "login": "66,10.1.2.3,fail,1700000000", "order_event": "501,create,,1700000000",
    "receipt": "tx-502,card,1700000003", "marketing": "u1,INSTALL,web,1700000000123",
    "access_log": "10.9.8.7 - - 02/03/2024:10:05:14 +0000 GET /guide/start/",
}


@pytest.mark.parametrize("kind", sorted(GOOD))
def test_permissive_flags_short_empty_and_bad_lines(spark, kind):
    good = GOOD[kind]
    sep = " " if kind == "access_log" else ","
    parts = good.split(sep)
    bad_time = sep.join("not-a-time" if p.startswith("17") or ":" in p else p for p in parts)
    rows = [good, "", parts[0], sep.join(parts[:2]), bad_time, sep.join(parts).replace("17000", "99999999999999917000")
            if kind != "access_log" else good.replace("02/03/2024", "42/13/2024")]
    df = D.DECODERS[kind](spark.createDataFrame([(r,) for r in rows], "value STRING"), mode="permissive")
    got = {r.raw: r.malformed for r in df.collect()}
    assert got == {r: r != good for r in rows}
    records, bad = D.split_malformed(df)
    assert records.count() == 1 and "malformed" not in records.columns and bad.count() == len(rows) - 1


def test_midnight_ends_the_utc_day(spark):
    from pyspark.sql import functions as F
    from tidewatch.functions.time import next_utc_midnight
    df = spark.range(1).select(F.expr("TIMESTAMP_NTZ'2024-02-28 23:59:59'").alias("n"), F.timestamp_seconds(F.lit(86399)).alias("t"))
    r = df.select(next_utc_midnight("n").alias("n"), F.unix_seconds(next_utc_midnight("t", ntz=False)).alias("t")).first()
    assert r.n == datetime(2024, 2, 29) and r.t == 86400


def test_kafka_stream_writer_plans_keyed_json(spark, tmp_path):
    """No broker and no connector here: the plan and the options are checked, not a delivery."""
    from tidewatch.sources.kafka import kafka_stream_writer
    (tmp_path / "in").mkdir()
    rows = spark.readStream.schema("user_id BIGINT, url STRING").json(str(tmp_path / "in"))
    w = kafka_stream_writer(rows, "broker:9092", "alerts", "to-kafka", key="user_id")
    assert [f.name for f in w._df.schema.fields] == ["key", "value"]
    assert "to_json" in w._df._jdf.queryExecution().analyzed().toString()
    with pytest.raises(Exception, match="(?i)kafka"):      # the connector is what is missing
        w.start()
    lines = kafka_stream_writer(rows.select("url"), "broker:9092", "alerts", "to-kafka-2")
    assert [f.name for f in lines._df.schema.fields] == ["value"]
