"""Keyed second stages of one stream query: in-stream ranking, revisions from map state,
running distinct counts with firings by rows (T-3, T-9, T-12, T-14, T-15)."""

import random
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.plans import jobs
from tidewatch.session import stream_checkpoint
from tidewatch.sources import tables as T
from tidewatch.streaming import forms as S, keyed as K, wiring as Wr

from conftest import SF_SMALL
from helpers import epoch, frame
from test_streaming import FAR, _bag, _events_with_sentinel, _files

LOG = "ip STRING, user_id STRING, event_time BIGINT, method STRING, url STRING"
VIEW = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, event_time BIGINT"


def _to_files(df, tmp_path, once=True):
    """Run into the plain Parquet file sink, without ``foreachBatch``, and read it."""
    out, name = str(tmp_path / f"out-{uuid.uuid4().hex[:6]}"), f"t_{uuid.uuid4().hex[:8]}"
    q = Wr.start(df, name, sink="parquet", path=out, available_now=once)
    q.awaitTermination(300)
    assert q.exception() is None
    return df.sparkSession.read.schema(df.schema).parquet(out)


def test_top_n_within_the_stream_equals_batch(spark, tmp_path):
    ev, with_sentinel = _events_with_sentinel(spark, "click")
    cols = ["window_end", "item_id", "cnt", "rank"]
    batch = _bag(jobs.hot_items(T.user_behavior(ev), behavior="click"), cols)
    src = _files(spark, with_sentinel.withColumnRenamed("ts", "event_time"), tmp_path).withColumnRenamed("event_time", "ts")
    top = S.hot_items_stream(Wr.event_time(T.user_behavior(src)), behavior="click")
    assert _bag(_to_files(top, tmp_path), cols) == batch


def test_limit_per_task_keeps_what_can_win():
    r = random.Random(5)
    rows = [(w, k, r.randrange(9)) for w in range(40) for k in range(r.randrange(1, 60))]
    r.shuffle(rows)
    best = {}
    for w, k, c in rows:
        best.setdefault(w, []).append((k, c))
    want = {w: sorted(v, key=lambda x: (-x[1], x[0]))[:3] for w, v in best.items()}
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + 97])], names=["window_us", "k", "cnt"])
               for i in range(0, len(rows), 97)]
    (whole,) = K._limit_per_task(3)(iter(batches))
    got = {}
    for w, k, c in zip(*(whole.column(i).to_pylist() for i in range(3))):
        got.setdefault(w, []).append((k, c))
    assert got == want
    parts = [x for b in K._limit_per_task(3, most=5)(iter(batches)) for x in zip(*(b.column(i).to_pylist() for i in range(3)))]
    assert {(w, *x) for w, v in want.items() for x in v} <= set(parts) and len(parts) < len(rows)


def _log_rows(seed, n, late):
    """Requests of some minutes in three files; rows of the third go back up to ``late`` s."""
    r = random.Random(seed)
    parts = [[], [], []]
    for k in range(n):
        t = 1000 + 900 * k // n
        part = min(2, 3 * k // n)
        if part < 2 and r.random() < 0.2:
            parts[part + 1].append((t - r.randrange(late // 2), f"/u{r.randrange(7)}"))
        parts[part].append((t, f"/u{min(r.randrange(9), r.randrange(9))}"))
    return parts


def _write(spark, parts, src):
    for part in parts:
        frame(spark, LOG, [("i", "1", t, "GET", u) for t, u in part]).coalesce(1).write.mode("append").parquet(src)


def test_revisions_from_map_state_equal_batch_on_the_real_windows(spark, tmp_path):
    parts = _log_rows(3, 60, late=600)
    src = str(tmp_path / "in")
    _write(spark, parts, src)
    schema = spark.read.parquet(src).schema
    logs = lambda: Wr.event_time(Wr.read_table_stream(spark, src, schema, max_files=1), delay="1000 seconds")
    found = _to_files(S.hot_urls_revised_stream(logs()), tmp_path)
    cols = ["window_end", "url", "cnt", "rank"]
    batch = jobs.hot_urls(spark.read.parquet(src))
    assert _bag(K.newest_revision(found), cols) == _bag(batch, cols)
    # late rows did revise windows that were ranked before
    assert found.agg(F.max("revision")).first()[0] > 1
    # and the form with a change log in foreachBatch comes to the same
    log, out = str(tmp_path / "log"), {}
    q = Wr.start(S.hot_urls_counts_stream(logs(), revisions=True), f"r_{uuid.uuid4().hex[:8]}", mode="update", available_now=True,
                 foreach_batch=S.revised_top_n_writer(log, 3, "url", lambda df, i: out.update(
                     {(r.window_end, r["rank"]): (r.url, r.cnt) for r in df.collect()})))
    q.awaitTermination(300)
    assert out == {(r.window_end, r["rank"]): (r.url, r.cnt) for r in batch.collect()}


def test_revisions_resume_from_the_checkpoint_and_each_is_a_true_ranking(spark, tmp_path):
    parts = _log_rows(4, 60, late=300)
    src, out, name = str(tmp_path / "in"), str(tmp_path / "out"), f"t_{uuid.uuid4().hex[:8]}"
    for k, part in enumerate(parts):                       # a run per file: stop, restart, go on
        _write(spark, [part], src)
        schema = spark.read.parquet(src).schema
        logs = Wr.event_time(Wr.read_table_stream(spark, src, schema), delay="2000 seconds")
        top = S.hot_urls_revised_stream(logs, size="2 minutes", slide="30 seconds")
        q = Wr.start(top, name, sink="parquet", path=out, available_now=True)
        q.awaitTermination(300)
        assert q.exception() is None
        cols = ["window_end", "url", "cnt", "rank"]
        seen = jobs.hot_urls(spark.read.parquet(src), size="2 minutes", slide="30 seconds")
        found = spark.read.parquet(out)
        assert _bag(K.newest_revision(found), cols) == _bag(seen, cols)
        assert found.groupBy("window_end", "revision", "rank").count().where("count > 1").count() == 0


@pytest.mark.parametrize("every", [1, 25])
def test_running_distinct_revisions_equal_the_prefix_counts(spark, tmp_path, every):
    r = random.Random(6)
    parts = [[(r.randrange(30), 3600 * h + r.randrange(3600)) for h in range(3) for _ in range(r.randrange(5, 20))]
             for _ in range(4)]
    src, name, out = str(tmp_path / "in"), f"t_{uuid.uuid4().hex[:8]}", str(tmp_path / "out")
    df = lambda rows: frame(spark, VIEW, [(u, 0, 0, "pv", t) for u, t in rows])
    prefixes = {}
    seen: dict[int, list[int]] = {}
    for part in [*parts, [(1, FAR)]]:
        df(part).coalesce(1).write.mode("append").parquet(src)
        stream = Wr.event_time(Wr.read_table_stream(spark, src, df(part).schema), delay="4 hours")
        q = Wr.start(S.unique_visitors_firing_stream(stream, every=every), name, sink="parquet", path=out, available_now=True)
        q.awaitTermination(300)
        assert q.exception() is None
        for u, t in part:
            seen.setdefault(t // 3600, []).append(u)
        for h, us in seen.items():
            prefixes[(h + 1) * 3600, len(us)] = len(set(us))
    found = spark.read.parquet(out).collect()
    assert all(prefixes[epoch(f.window_end), f.n_rows] == f.uv for f in found)
    final = {epoch(f.window_end): f.uv for f in found if f.final}
    batch = jobs.unique_visitors(df([x for p in parts for x in p]), method="bitmap")
    assert final == {epoch(b.window_end): b.uv for b in batch.collect()}
    early = [f for f in found if not f.final and epoch(f.window_end) < FAR - 10 ** 6]
    if every == 1:
        assert len(early) == sum(1 for h in range(3) for _ in parts)
    else:                                                  # 25 rows or more between firings
        last: dict = {}
        for f in sorted(early, key=lambda f: f.firing):
            assert f.n_rows - last.get(f.window_end, 0) >= every
            last[f.window_end] = f.n_rows
        assert early and len(early) < 12


def test_state_of_closed_windows_is_gone(spark, tmp_path):
    """Read from the state store itself (T-16): nothing of the closed windows is left."""
    rows = [(k % 9, 0, 0, "pv", 100 + 300 * k) for k in range(50)] + [(1, 0, 0, "pv", FAR), (2, 0, 0, "pv", FAR + 7200)]
    stream = Wr.event_time(_files(spark, frame(spark, VIEW, rows), tmp_path, n=6))
    name, out = f"t_{uuid.uuid4().hex[:8]}", str(tmp_path / "out")
    q = Wr.start(S.unique_visitors_firing_stream(stream, every=1), name, sink="parquet", path=out, available_now=True)
    q.awaitTermination(300)
    assert {f.uv for f in spark.read.parquet(out).where("final").collect()} == {1, 2, 9}
    held = K.stored_keys(spark, stream_checkpoint(spark, name), {"chunks", "parts"})
    assert set(held) == {"chunks", "parts"}
    assert all(h and min(h) > (FAR - 10 ** 6) * 1_000_000 for h in held.values())


def test_late_rows_are_kept_with_the_watermark_that_met_them(spark, tmp_path):
    parts = [[100, 200], [150, 185, 1000], [120, 995, 2000], [5, 1999, 3000, 1995]]
    src, base = str(tmp_path / "in"), str(tmp_path / "split")
    for k, part in enumerate(parts):
        frame(spark, LOG, [(None, str(k), t, "GET", f"/{t}") for t in part]).coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    logs = Wr.event_time(Wr.read_table_stream(spark, src, schema, max_files=1), delay="10 seconds")
    q = Wr.start(K.split_late(logs, buckets=3), f"t_{uuid.uuid4().hex[:8]}", available_now=True,
                 foreach_batch=Wr.tagged_writer(base, "late"))
    q.awaitTermination(300)
    found = spark.read.parquet(base)
    split = sorted((r.late == "true", epoch(r.event_time), epoch(r.watermark), r.url, r.ip) for r in found.collect())
    want, top = [], None
    for part in parts:
        mark = max(0, top - 10) if top is not None else 0
        want += [(t < mark, t, mark, f"/{t}", None) for t in part]
        top = max([top or 0, *part])
    assert split == sorted(want) and sum(x[0] for x in split) == 4
    # what is kept and what is late is the input
    assert _bag(found, ["event_time", "url"]) == _bag(spark.read.parquet(src), ["event_time", "url"])
