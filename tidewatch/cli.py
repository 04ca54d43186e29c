"""Run one job over raw input lines, in batch or as a stream.

    python -m tidewatch hot_items --input data/behaviour.csv
    python -m tidewatch login_fail_burst --input logs/ --stream --out /shared/out/bursts
    python -m tidewatch tx_reconcile --input orders.csv --receipts receipts.csv
    python -m tidewatch order_outcomes --input orders.csv --param limit="15 minutes"
    python -m tidewatch hot_urls --input logs/ --stream --lateness "1 minute" --out /shared/out/urls
    python -m tidewatch hot_items --source kafka --input broker:9092/topic --stream

Input is the line formats of ``sources.decode``, from files, a Kafka topic
(``--input servers/topic``) or a line socket (``--input host:port``).  Results
go to the console, or to Parquet under ``--out``: one folder per batch, and one
per outcome for jobs with side outputs.  A stream keeps its checkpoint in the
folder of ``--checkpoint`` or ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tidewatch.operators.ranking import window_report
from tidewatch.plans import jobs
from tidewatch.session import build_session
from tidewatch.sources.decode import DECODERS, split_malformed
from tidewatch.sources.kafka import read_kafka_lines
from tidewatch.sources.text import read_records, read_socket
from tidewatch.streaming import forms, wiring

# job -> (record kind, batch function, stream function or None, watermark delay)
JOBS = {
    "hot_items": ("user_behavior", jobs.hot_items, None, "0 seconds"),
    "hot_urls": ("access_log", jobs.hot_urls, None, "1 second"),
    "hot_items_report": ("user_behavior", jobs.hot_items_report, None, "0 seconds"),
    "hot_urls_report": ("access_log", jobs.hot_urls_report, None, "1 second"),
    "page_views": ("user_behavior", jobs.page_views,
                   lambda df, **kw: forms.windowed_count_stream(
                       df.where(df.behavior == kw.get("behavior", "pv")), kw.get("size", "1 hour"),
                       name="pv"), "0 seconds"),
    "unique_visitors": ("user_behavior", jobs.unique_visitors, forms.unique_visitors_stream,
                        "0 seconds"),
    "marketing_by_channel": ("marketing", jobs.marketing_by_channel,
                             forms.marketing_by_channel_stream, "0 seconds"),
    "marketing_total": ("marketing", jobs.marketing_total, forms.marketing_total_stream,
                        "0 seconds"),
    "ad_clicks_by_province": ("ad_click", jobs.ad_clicks_by_province,
                              lambda df, **kw: forms.windowed_count_stream(
                                  df, kw.get("size", "1 hour"), kw.get("slide", "5 seconds"),
                                  keys=["province"]), "0 seconds"),
    "ad_click_cap": ("ad_click", jobs.ad_click_cap, forms.ad_click_cap_stream, "0 seconds"),
    "ad_clicks_after_cap": ("ad_click", jobs.ad_clicks_after_cap,
                            forms.ad_clicks_after_cap_stream, "0 seconds"),
    "login_fail_burst": ("login", jobs.login_fail_burst, forms.login_fail_burst_stream,
                         "3 seconds"),
    "login_fail_consecutive": ("login", jobs.login_fail_consecutive,
                               forms.login_fail_consecutive_stream, "3 seconds"),
    "order_timeout_pattern": ("order_event", jobs.order_timeout_pattern,
                              forms.order_timeout_pattern_stream, "0 seconds"),
    "order_outcomes": ("order_event", jobs.order_outcomes, forms.order_outcomes_stream,
                       "0 seconds"),
    "tx_reconcile": ("order_event", jobs.tx_reconcile, forms.tx_reconcile_stream, "0 seconds"),
}


# jobs whose result carries side outputs, told apart by ``outcome``
TAGGED = {"ad_click_cap", "order_timeout_pattern", "order_outcomes", "tx_reconcile"}


def _params(pairs: list[str]) -> dict:
    out = {}
    for p in pairs:
        k, v = p.split("=", 1)
        out[k] = int(v) if v.isdigit() else {"true": True, "false": False}.get(v.lower(), v)
    return out


def _input(spark: SparkSession, a: argparse.Namespace, kind: str, where: str) -> DataFrame:
    if a.source == "text":
        return read_records(spark, kind, where, stream=a.stream, mode=a.mode)
    if not a.stream:
        raise SystemExit(f"--source {a.source} is a stream: add --stream")
    if a.source == "kafka":
        servers, topic = where.rsplit("/", 1)
        lines = read_kafka_lines(spark, servers, topic)
    else:
        host, port = where.rsplit(":", 1)
        lines = read_socket(spark, host, int(port))
    return DECODERS[kind](lines.select("value"), mode=a.mode)


def _set_aside(frames: list[DataFrame], a: argparse.Namespace) -> list[DataFrame]:
    """Permissive mode: malformed lines are counted, and kept under
    ``--quarantine``; the records go on."""
    good = []
    for k, df in enumerate(frames):
        records, bad = split_malformed(df)
        good.append(records)
        if not a.stream:
            print(f"{a.job}: {bad.count()} malformed lines in input {k}", file=sys.stderr)
            if a.quarantine:
                bad.write.mode("overwrite").text(f"{a.quarantine}/input={k}")
        elif a.quarantine:
            wiring.start(bad, f"{a.name or a.job}-malformed-{k}", sink="text",
                         path=f"{a.quarantine}/input={k}", available_now=a.once)
    return good


def _top_n(a: argparse.Namespace, inputs: list[DataFrame], params: dict):
    """Top-N jobs stream their counts; each batch ranks the windows it closes, or
    with ``--lateness`` those it revises, whose ranking comes from the stream itself."""
    urls = a.job.startswith("hot_urls")
    key, label = ("url", "url") if urls else ("item_id", "item")
    counts = forms.hot_urls_counts_stream if urls else forms.hot_items_counts_stream
    n = int(params.pop("n", 3))
    sink = wiring.batch_writer(a.out) if a.out else lambda b, i: b.show(50, truncate=False)
    if a.lateness:                                         # each revised window again as a whole
        revised = forms.hot_urls_revised_stream if urls else forms.hot_items_revised_stream
        report = a.job.endswith("_report")
        each = (lambda b, i: sink(window_report(b, key=key, label=label), i)) if report else sink
        return wiring.start(revised(*inputs, n=n, **params), a.name or a.job, foreach_batch=each, available_now=a.once)
    each = forms.report_writer(n, key, label, sink) if a.job.endswith("_report") else forms.top_n_writer(n, key, sink)
    return wiring.start(counts(*inputs, **params), a.name or a.job, foreach_batch=each, available_now=a.once)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tidewatch")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--input", required=True)
    ap.add_argument("--source", default="text", choices=["text", "kafka", "socket"])
    ap.add_argument("--receipts", help="receipt lines (tx_reconcile)")
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--out", help="Parquet output folder (default: console)")
    ap.add_argument("--param", action="append", default=[], help="job parameter k=v")
    ap.add_argument("--mode", default="strict", choices=["strict", "permissive"])
    ap.add_argument("--quarantine", help="permissive: folder for malformed lines")
    ap.add_argument("--lateness", help="stream: rows this much later than the watermark delay still count")
    ap.add_argument("--checkpoint", help="folder for stream checkpoints, shared by the cluster")
    ap.add_argument("--once", action="store_true",
                    help="stream: process what has arrived, then stop (resumes from the checkpoint)")
    ap.add_argument("--name", help="stream query name (its checkpoint folder); default: the job")
    a = ap.parse_args(argv)

    spark = build_session(extra={"spark.checkpoint.dir": a.checkpoint} if a.checkpoint else None)
    kind, batch_fn, stream_fn, delay = JOBS[a.job]
    params = _params(a.param)
    inputs = [_input(spark, a, kind, a.input)]
    if a.job == "tx_reconcile":
        inputs.append(_input(spark, a, "receipt", a.receipts))
    if a.mode == "permissive":
        inputs = _set_aside(inputs, a)

    if not a.stream:
        out: DataFrame = batch_fn(*inputs, **params)
        if a.out:
            w = out.write.mode("overwrite")
            (w.partitionBy("outcome") if a.job in TAGGED else w).parquet(a.out)
        else:
            out.show(50, truncate=False)
        return

    if a.lateness:
        delay = f"{jobs._seconds(delay) + jobs._seconds(a.lateness)} seconds"
    inputs = [wiring.event_time(df, delay=delay) for df in inputs]
    if a.job.startswith("hot_"):
        q = _top_n(a, inputs, params)
    else:
        out = stream_fn(*inputs, **params)
        if a.out:
            each = wiring.tagged_writer(a.out) if a.job in TAGGED else wiring.batch_writer(a.out)
            q = wiring.start(out, a.name or a.job, foreach_batch=each, available_now=a.once)
        else:
            q = wiring.start(out, a.name or a.job, sink="console", available_now=a.once)
    q.awaitTermination()


if __name__ == "__main__":
    main()
