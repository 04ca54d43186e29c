"""Pattern operators against brute force, at the boundaries of SURVEY §2.11
and with one hot key spread over many time buckets."""

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.sequences import bursts, followed_by, strict_pairs
from tidewatch.plans import jobs

from helpers import frame, ts

LOGIN = "user_id BIGINT, event_type STRING, event_time BIGINT, seq BIGINT"


def _login(spark, rows):
    return frame(spark, LOGIN, [(u, e, t, i) for i, (u, e, t) in enumerate(rows)])


def test_burst_and_consecutive_boundaries(spark):
    rows = [
        (1, "fail", 100), (1, "fail", 102),                      # 2 s apart: burst yes, pair no
        (2, "fail", 200), (2, "success", 200), (2, "fail", 201),  # success between: pair no
        (3, "fail", 300), (4, "fail", 300), (3, "fail", 301),     # interleaved users
        (5, "fail", 400), (5, "fail", 404),                      # 4 s apart: nothing
    ]
    df = _login(spark, rows)
    b = {(r.user_id, r.fails) for r in jobs.login_fail_burst(df).collect()}
    assert b == {(1, 2), (2, 2), (3, 2)}
    c = {r.user_id for r in jobs.login_fail_consecutive(df).collect()}
    assert c == {3}


def test_chain_of_three_gives_two_pairs_and_one_burst(spark):
    df = _login(spark, [(1035, "fail", 842), (1035, "fail", 843), (1035, "fail", 844)])
    pairs = sorted((r.start_time, r.end_time) for r in jobs.login_fail_consecutive(df).collect())
    assert pairs == [(ts(842), ts(843)), (ts(843), ts(844))]
    b = jobs.login_fail_burst(df).collect()
    assert [(r.fails, r.start_time, r.end_time) for r in b] == [(3, ts(842), ts(844))]


def test_unkeyed_pattern_matches_across_users(spark):
    df = _login(spark, [(1, "fail", 10), (2, "fail", 11)])
    assert jobs.login_fail_consecutive(df).count() == 0
    assert jobs.login_fail_consecutive(df, keyed=False).count() == 1


def _brute_pairs(rows, within, first, then):
    out = set()
    by = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    for k, ev in by.items():
        for a, b in zip(ev, ev[1:]):
            if first(a) and then(b) and b[1] - a[1] < within:
                out.add((k, a[1], b[1]))
    return out


def _brute_followed(rows, within, first, then):
    out = set()
    by = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    for k, ev in by.items():
        for i, a in enumerate(ev):
            if not first(a):
                continue
            nxt = next((b for b in ev[i + 1:] if then(b)), None)
            ok = nxt is not None and nxt[1] - a[1] < within
            out.add((k, a[1], nxt[1] if ok else None))
    return out


def _brute_bursts(rows, gap, min_count):
    out = set()
    by = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by.setdefault(r[0], []).append(r[1])
    for k, times in by.items():
        run = [times[0]]
        for t in times[1:]:
            if t - run[-1] > gap:
                if len(run) >= min_count:
                    out.add((k, run[0], run[-1], len(run)))
                run = [t]
            else:
                run.append(t)
        if len(run) >= min_count:
            out.add((k, run[0], run[-1], len(run)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_key_over_many_buckets_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    # key 0 holds about half the rows; small buckets force many halo crossings
    rows = []
    for i in range(1500):
        k = 0 if rnd.random() < 0.5 else rnd.randrange(1, 6)
        rows.append((k, rnd.randrange(0, 20000), i, rnd.choice(["a", "b", "b"])))
    df = frame(spark, "k BIGINT, t BIGINT, tb BIGINT, e STRING", rows, time_col="t")
    within = 40
    is_a, is_b = F.col("e") == "a", F.col("e") == "b"
    for bucket in (40, 100, 3600):
        got = {(r.k, r.start_time, r.end_time) for r in
               strict_pairs(df, ["k"], ["t", "tb"], is_a, is_b, within, bucket_s=bucket).collect()}
        exp = {(k, ts(a), ts(b)) for k, a, b in
               _brute_pairs(rows, within, lambda r: r[3] == "a", lambda r: r[3] == "b")}
        assert got == exp
        got = {(r.k, r.start_time, r.end_time) for r in
               followed_by(df, ["k"], ["t", "tb"], is_a, is_b, within, bucket_s=bucket).collect()}
        exp = {(k, ts(a), ts(b) if b is not None else None) for k, a, b in
               _brute_followed(rows, within, lambda r: r[3] == "a", lambda r: r[3] == "b")}
        assert got == exp
        got = {(r.k, r.start_time, r.end_time, r.n) for r in
               bursts(df, ["k"], ["t", "tb"], within, 2, bucket_s=bucket).collect()}
        exp = {(k, ts(a), ts(b), n) for k, a, b, n in _brute_bursts(rows, within, 2)}
        assert got == exp


def test_burst_spanning_many_buckets(spark):
    # one run of 500 rows 30 s apart crosses dozens of one-hour buckets
    rows = [(7, 30 * i, i) for i in range(500)]
    df = frame(spark, "user_id BIGINT, event_time BIGINT, seq BIGINT", rows)
    got = bursts(df, ["user_id"], ["event_time", "seq"], 30, 2).collect()
    assert [(r.n, r.start_time, r.end_time) for r in got] == [(500, ts(0), ts(30 * 499))]


def test_results_do_not_depend_on_input_order(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(3), rnd.choice(["fail", "success"]), rnd.randrange(0, 50))
            for _ in range(200)]
    base = _login(spark, rows)
    shuffled = base.repartition(7).orderBy(F.rand(5))
    for f in (jobs.login_fail_burst, jobs.login_fail_consecutive):
        assert sorted(map(tuple, f(base).collect())) == sorted(map(tuple, f(shuffled).collect()))
