"""Order, payment and receipt boundaries."""

from pyspark.sql import functions as F

from tidewatch.plans import jobs

from helpers import frame, ts

ORDER = "order_id BIGINT, event_type STRING, tx_id STRING, event_time BIGINT, seq BIGINT"
RECEIPT = "tx_id STRING, pay_channel STRING, event_time BIGINT, seq BIGINT"
LIMIT = 900


def _orders(spark, rows):
    return frame(spark, ORDER, [(*r, i) for i, r in enumerate(rows)])


def _outcomes(df):
    return {r.order_id: r.outcome for r in df.collect()}


def test_state_outcomes_at_the_limit(spark):
    rows = [
        (1, "create", "", 1000), (1, "pay", "t1", 1000),              # Δ = 0
        (2, "create", "", 1000), (2, "pay", "t2", 1000 + LIMIT - 1),  # limit - 1 s
        (3, "create", "", 1000), (3, "pay", "t3", 1000 + LIMIT),      # exactly the limit: late
        (4, "create", "", 1000), (4, "pay", "t4", 1000 + LIMIT + 1),  # late
        (5, "pay", "t5", 990), (5, "create", "", 1000),               # pay before create: late
        (6, "create", "", 1000), (6, "pay", "t6", 1100), (6, "pay", "t6b", 1200),  # two pays
        (7, "create", "", 1000),                                      # never paid
        (8, "pay", "t8", 1000),                                       # pay without create
    ]
    got = _outcomes(jobs.order_outcomes(_orders(spark, rows), limit=LIMIT))
    assert got == {1: "paid", 2: "paid", 3: "paid_late", 4: "paid_late", 5: "paid_late",
                   6: "paid", 7: "unpaid", 8: "pay_without_create"}


def test_pattern_outcomes(spark):
    rows = [
        (1, "create", "", 1000), (1, "pay", "t1", 1000 + 539),   # 9 min - 1 s: paid
        (2, "create", "", 1000), (2, "pay", "t2", 1000 + 540),   # exactly 9 min: timeout
        (3, "create", "", 1000), (3, "pay", "", 1001),           # empty tx does not count
        (4, "pay", "t4", 900), (4, "create", "", 1000),          # pay before create
        (5, "pay", "t5", 1000),                                  # pay only: no row
    ]
    got = _outcomes(jobs.order_timeout_pattern(_orders(spark, rows)))
    assert got == {1: "paid", 2: "timeout", 3: "timeout", 4: "timeout"}


def test_reconcile_tolerance_and_duplicates(spark):
    pays = [
        (1, "pay", "a", 1000), (2, "pay", "b", 1000), (3, "pay", "c", 1000),
        (4, "pay", "d", 1000), (5, "pay", "e", 1000), (5, "pay", "e", 1010),  # duplicate tx
        (6, "create", "", 1000), (7, "create", "", 1001),                   # creates ignored
        (8, "pay", "", 1000),                                               # empty tx ignored
    ]
    receipts = [("a", "wechat", 1060, 0), ("b", "alipay", 940, 1), ("c", "wechat", 1061, 2),
                ("d", "wechat", 939, 3), ("e", "wechat", 1005, 4), ("e", "wechat", 1006, 5),
                ("z", "alipay", 1000, 6)]
    o = _orders(spark, pays)
    r = frame(spark, RECEIPT, receipts)
    got = sorted((x.tx_id, x.outcome) for x in jobs.tx_reconcile(o, r).collect())
    assert got == [("a", "matched"), ("b", "matched"),
                   ("c", "order_only"), ("c", "receipt_only"),
                   ("d", "order_only"), ("d", "receipt_only"),
                   ("e", "matched"), ("z", "receipt_only")]
    e = [x for x in jobs.tx_reconcile(o, r).collect() if x.tx_id == "e"][0]
    assert e.pay_time == ts(1000) and e.receipt_time == ts(1005)


def test_click_cap(spark):
    day = 86400 * 10
    rows = [(543462, 1715, "beijing", None, day + i, i) for i in range(5)]   # N+2 clicks
    rows += [(543462, 1715, "beijing", None, day + 86400 + 1, 99)]            # next UTC day
    rows += [(1, 2, "shanghai", None, day, 100)]
    df = frame(spark, "user_id BIGINT, ad_id BIGINT, province STRING, city STRING, "
                      "event_time BIGINT, seq BIGINT", rows)
    capped = jobs.ad_click_cap(df.orderBy(F.rand(3)), n=3).collect()
    hot = sorted((r.seq, r.outcome) for r in capped if r.user_id == 543462)
    assert hot == [(0, "pass"), (1, "pass"), (2, "pass"), (3, "warn"), (99, "pass")]
    w = jobs.ad_click_warnings(df, n=3).collect()
    assert len(w) == 1 and w[0].user_id == 543462 and "more than 3 times" in w[0].msg
    after = {(r.window_end, r.province): r.cnt for r in
             jobs.ad_clicks_after_cap(df, n=3, slide="1 hour").collect()}
    assert after[(ts(day + 3600), "beijing")] == 3


def _py_outcomes(rows, limit):
    first = {}
    for oid, kind, _, t, seq in sorted(rows, key=lambda r: (r[3], r[4])):
        first.setdefault((oid, kind), t)
    out = {}
    for oid in {r[0] for r in rows}:
        c, p = first.get((oid, "create")), first.get((oid, "pay"))
        if c is not None and p is not None:
            out[oid] = "paid" if 0 <= p - c < limit else "paid_late"
        else:
            out[oid] = "unpaid" if c is not None else "pay_without_create"
    return out


def _py_reconcile(pays, recs, tol):
    p, r = {}, {}
    for oid, kind, tx, t, seq in sorted(pays, key=lambda x: (x[3], x[4])):
        if kind == "pay" and tx:
            p.setdefault(tx, t)
    for tx, _, t, seq in sorted(recs, key=lambda x: (x[2], x[3])):
        r.setdefault(tx, t)
    out = []
    for tx in set(p) | set(r):
        if tx in p and tx in r and abs(p[tx] - r[tx]) <= tol:
            out.append((tx, "matched"))
        else:
            if tx in p:
                out.append((tx, "order_only"))
            if tx in r:
                out.append((tx, "receipt_only"))
    return sorted(out)


def test_outcomes_and_reconcile_random_against_brute_force(spark):
    import random
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        oid = rnd.randrange(60)
        kind = rnd.choice(["create", "pay"])
        rows.append((oid, kind, f"t{rnd.randrange(40)}" if kind == "pay" else "",
                     rnd.randrange(0, 3000), i))
    recs = [(f"t{rnd.randrange(50)}", "wechat", rnd.randrange(0, 3000), i) for i in range(120)]
    df = frame(spark, ORDER, rows)
    got = _outcomes(jobs.order_outcomes(df, limit=LIMIT))
    assert got == _py_outcomes(rows, LIMIT)
    r = frame(spark, RECEIPT, recs)
    got = sorted((x.tx_id, x.outcome) for x in jobs.tx_reconcile(df, r, tolerance=60).collect())
    assert got == _py_reconcile(rows, recs, 60)
