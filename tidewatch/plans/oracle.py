"""DuckDB SQL for the registered queries (the correctness oracle).

Written independently of the Spark plans: sliding windows are spelled as a
bucket plus ``k`` slides (``k`` = 1 .. size/slide), sequences with ``lag`` /
``lead`` over the whole key, followed-by as a join.  Column names and types
match the Spark results (counts and ranks BIGINT).
"""

from __future__ import annotations

from tidewatch.plans.decoded import KINDS, oracle


def _sliding(slide: str, n: int) -> tuple[str, str]:
    """(window_end expression, join clause) for windows of n slides."""
    return (f"time_bucket(INTERVAL {slide}, ts) + k * INTERVAL {slide}",
            f"CROSS JOIN range(1, {n + 1}) AS r(k)")


_HI_END, _HI_JOIN = _sliding("5 MINUTE", 12)
_HU_END, _HU_JOIN = _sliding("5 SECOND", 120)
_HR_END, _HR_JOIN = _sliding("2 MINUTE", 5)
_MK_END, _MK_JOIN = _sliding("10 SECOND", 360)
_AD_END, _AD_JOIN = _sliding("5 SECOND", 720)

_BITMAP = ("list_reduce(list_prepend(0::BIGINT, list_transform(string_split(user_id::VARCHAR, ''), "
           "lambda x: ascii(x)::BIGINT)), lambda a, x: (a * 61 + x) & 536870911)")

_AD_CLICKS = """
  SELECT e.user_id, json_extract_string(e.props, '$.k') AS ad_id, n.n_name AS province, e.ts AS event_time,
         e.event_id, CAST(e.ts AS DATE) AS day
  FROM events e LEFT JOIN nation n ON e.user_id % 25 = n.n_nationkey
  WHERE e.event_type = 'click'"""

_CAPPED = f"""
  WITH a AS ({_AD_CLICKS}),
  r AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, day
                                     ORDER BY event_time, event_id) AS rn FROM a)
  SELECT user_id, ad_id, province, event_time, event_id, day, CAST(rn AS BIGINT) AS seq_no,
         CASE WHEN rn <= 1 THEN 'pass' ELSE 'warn' END AS outcome,
         CASE WHEN rn = 2 THEN 'user ' || user_id || ' clicked ad ' || ad_id
              || ' more than 1 times on ' || CAST(day AS VARCHAR) END AS msg
  FROM r WHERE rn <= 2"""

_ORDERS = """
  SELECT user_id AS order_id,
         CASE event_type WHEN 'signup' THEN 'create' ELSE 'pay' END AS event_type,
         ts, event_id, CAST(ts AS DATE) AS day,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS tx_id
  FROM events WHERE event_type IN ('signup', 'purchase')"""

_MARK = "(SELECT date_trunc('millisecond', max(ts)) FROM events WHERE event_type IN ({}))"

_TOP_URLS = f"""
      WITH u AS (SELECT ts, '/' || event_type || '/' || json_extract_string(props, '$.k') ||
                        CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 10
                             WHEN 0 THEN '.css' WHEN 1 THEN '.png' ELSE '' END AS url FROM events),
      c AS (SELECT {{end}} AS window_end, url FROM u {{join}} WHERE {{keep}}),
      g AS (SELECT window_end, url, count(*) AS cnt FROM c GROUP BY 1, 2),
      r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rn
            FROM g)
      SELECT window_end, url, cnt, CAST(rn AS BIGINT) AS rank FROM r WHERE rn <= 3"""

ORACLE_SQL: dict[str, str] = {
    "hot_items": f"""
      WITH c AS (SELECT {_HI_END} AS window_end,
                        CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id
                 FROM events {_HI_JOIN} WHERE event_type = 'click'),
      g AS (SELECT window_end, item_id, count(*) AS cnt FROM c GROUP BY 1, 2),
      r AS (SELECT *, row_number() OVER (PARTITION BY window_end
                                         ORDER BY cnt DESC, item_id) AS rn FROM g)
      SELECT window_end, item_id, cnt, CAST(rn AS BIGINT) AS rank FROM r WHERE rn <= 3""",

    "hot_items_report": f"""
      WITH c AS (SELECT {_HI_END} AS window_end,
                        CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id
                 FROM events {_HI_JOIN} WHERE event_type = 'click'),
      g AS (SELECT window_end, item_id, count(*) AS cnt FROM c GROUP BY 1, 2),
      r AS (SELECT *, row_number() OVER (PARTITION BY window_end
                                         ORDER BY cnt DESC, item_id) AS rn FROM g)
      SELECT window_end,
             concat_ws(chr(10), repeat('=', 40),
                       'time: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S'),
                       string_agg(printf('No.%d item=%s count=%d', rn, CAST(item_id AS VARCHAR), cnt), chr(10)
                                  ORDER BY rn),
                       repeat('=', 40)) AS report
      FROM r WHERE rn <= 3 GROUP BY window_end""",

    "hot_urls": _TOP_URLS.format(keep="true", end=_HU_END, join=_HU_JOIN),

    "hot_urls_dynamic": _TOP_URLS.format(keep="NOT regexp_matches(url, '[.](css|js|ico|png)$')", end=_HU_END, join=_HU_JOIN),

    "hot_urls_report": f"""
      WITH r AS ({_TOP_URLS.format(keep="true", end=_HU_END, join=_HU_JOIN)})
      SELECT window_end,
             concat_ws(chr(10), repeat('=', 40),
                       'time: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S'),
                       string_agg(printf('No.%d url=%s count=%d', rank, url, cnt), chr(10) ORDER BY rank),
                       repeat('=', 40)) AS report
      FROM r GROUP BY window_end""",

    "page_views": """
      SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS pv
      FROM events WHERE event_type = 'view' GROUP BY 1""",

    "unique_visitors": """
      SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
             count(DISTINCT user_id) AS uv
      FROM events WHERE event_type = 'view' GROUP BY 1""",

    "unique_visitors_hll": """
      SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
             count(DISTINCT user_id) AS uv, true AS within_three_errors
      FROM events WHERE event_type = 'view' GROUP BY 1""",

    "unique_visitors_bitmap": f"""
      SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
             count(DISTINCT {_BITMAP}) AS uv
      FROM events WHERE event_type = 'view' GROUP BY 1""",

    "unique_visitors_stored": """
      SELECT time_bucket(INTERVAL 6 HOUR, ts) + k * INTERVAL 6 HOUR AS window_end,
             count(DISTINCT user_id) AS uv, true AS within_three_errors
      FROM events CROSS JOIN range(1, 5) AS r(k) WHERE event_type = 'view' GROUP BY 1""",

    "value_profile": """
      WITH b AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type,
                        CASE WHEN isfinite(value) THEN CAST(floor(value / 10) AS BIGINT) END AS bin FROM events),
      g AS (SELECT DISTINCT window_end, event_type FROM b),
      o AS (SELECT *, row_number() OVER (PARTITION BY window_end, event_type ORDER BY bin) AS rn,
                   count(*) OVER (PARTITION BY window_end, event_type) AS n FROM b WHERE bin IS NOT NULL),
      h AS (SELECT window_end, event_type, bin, row_number() OVER (PARTITION BY window_end, event_type
                                                                   ORDER BY count(*) DESC, bin) AS place
            FROM b WHERE bin IS NOT NULL GROUP BY 1, 2, 3)
      SELECT g.window_end, g.event_type, coalesce(o.n, 0) AS n, o.bin AS median_bin, h.bin AS peak_bin
      FROM g LEFT JOIN o ON o.window_end = g.window_end AND o.event_type = g.event_type AND o.rn = (o.n + 1) // 2
             LEFT JOIN h ON h.window_end = g.window_end AND h.event_type = g.event_type AND h.place = 1""",

    "marketing_by_channel": f"""
      SELECT {_MK_END} AS window_end, CAST(user_id % 5 AS VARCHAR) AS channel,
             event_type AS behavior, count(*) AS cnt
      FROM events {_MK_JOIN} WHERE event_type <> 'error' GROUP BY 1, 2, 3""",

    "marketing_total": f"""
      SELECT {_MK_END} AS window_end, 'total' AS channel, 'total' AS behavior, count(*) AS cnt
      FROM events {_MK_JOIN} WHERE event_type <> 'error' GROUP BY 1""",

    "marketing_rollup": f"""
      WITH c AS (SELECT {_MK_END} AS window_end, CAST(user_id % 5 AS VARCHAR) AS channel,
                        event_type AS behavior
                 FROM events {_MK_JOIN} WHERE event_type <> 'error')
      SELECT window_end, channel, behavior, count(*) AS cnt FROM c GROUP BY 1, 2, 3
      UNION ALL
      SELECT window_end, 'total', 'total', count(*) FROM c GROUP BY 1""",

    "ad_clicks_by_province": f"""
      WITH a AS ({_AD_CLICKS}), c AS (SELECT event_time AS ts, province FROM a)
      SELECT {_AD_END} AS window_end, province, count(*) AS cnt
      FROM c {_AD_JOIN} GROUP BY 1, 2""",

    "ad_click_cap": _CAPPED,

    "ad_click_warnings": f"""
      WITH c AS ({_CAPPED}) SELECT user_id, ad_id, day, msg FROM c WHERE outcome = 'warn'""",

    "ad_clicks_after_cap": f"""
      WITH c AS ({_CAPPED}), p AS (SELECT event_time AS ts, province FROM c WHERE outcome = 'pass')
      SELECT {_AD_END} AS window_end, province, count(*) AS cnt FROM p {_AD_JOIN} GROUP BY 1, 2""",

    "login_fail_burst": """
      WITH f AS (SELECT user_id, ts, event_id,
                        lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
                 FROM events WHERE event_type = 'error'),
      s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END)
                      OVER (PARTITION BY user_id ORDER BY ts, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
            FROM f),
      g AS (SELECT user_id, min(ts) AS start_time, max(ts) AS end_time, count(*) AS fails
            FROM s GROUP BY user_id, run)
      SELECT user_id, start_time, end_time, fails,
             'login fail ' || fails || ' times within 21600s' AS msg
      FROM g WHERE fails >= 2""",

    "login_fail_consecutive": """
      WITH n AS (SELECT user_id, event_type, ts,
                        lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts
                 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
      SELECT user_id, ts AS start_time, next_ts AS end_time,
             'login fail 2 times within 21600s' AS msg
      FROM n WHERE event_type = 'error' AND next_type = 'error'
                   AND next_ts < ts + INTERVAL 6 HOUR""",

    "order_timeout_pattern": f"""
      WITH o AS ({_ORDERS}),
      c AS (SELECT * FROM o WHERE event_type = 'create'),
      p AS (SELECT * FROM o WHERE event_type = 'pay' AND coalesce(tx_id, '') <> ''),
      m AS (SELECT c.order_id, c.ts AS create_time, c.event_id, min(p.ts) AS pay_time
            FROM c LEFT JOIN p ON p.order_id = c.order_id
                 AND (p.ts > c.ts OR (p.ts = c.ts AND p.event_id > c.event_id))
                 AND p.ts < c.ts + INTERVAL 6 HOUR
            GROUP BY c.order_id, c.ts, c.event_id)
      SELECT order_id, create_time, pay_time,
             CASE WHEN pay_time IS NOT NULL THEN 'paid' ELSE 'timeout' END AS outcome,
             CASE WHEN pay_time IS NOT NULL THEN 'order paid in time' ELSE 'no payment in time' END AS msg
      FROM m""",

    "order_outcomes": f"""
      WITH o AS ({_ORDERS}),
      c AS (SELECT order_id, day, min(ts) AS create_time FROM o WHERE event_type = 'create'
            GROUP BY 1, 2),
      p AS (SELECT order_id, day, min(ts) AS pay_time FROM o WHERE event_type = 'pay'
            GROUP BY 1, 2),
      j AS (SELECT coalesce(c.order_id, p.order_id) AS order_id, coalesce(c.day, p.day) AS day,
                   create_time, pay_time
            FROM c FULL OUTER JOIN p ON c.order_id = p.order_id AND c.day = p.day),
      k AS (SELECT *, CASE
              WHEN create_time IS NOT NULL AND pay_time IS NOT NULL AND pay_time >= create_time
                   AND pay_time < create_time + INTERVAL 6 HOUR THEN 'paid'
              WHEN create_time IS NOT NULL AND pay_time IS NOT NULL THEN 'paid_late'
              WHEN create_time IS NOT NULL THEN 'unpaid'
              ELSE 'pay_without_create' END AS outcome FROM j)
      SELECT order_id, day, create_time, pay_time, outcome,
             CASE outcome WHEN 'paid' THEN 'order paid in time'
                          WHEN 'paid_late' THEN 'order paid after its limit'
                          WHEN 'unpaid' THEN 'order not paid within its limit'
                          ELSE 'payment for an unknown order' END AS msg
      FROM k""",

    "tx_reconcile": f"""
      WITH o AS ({_ORDERS}),
      p AS (SELECT tx_id, arg_min(order_id, (ts, event_id)) AS order_id, min(ts) AS pay_time
            FROM o WHERE event_type = 'pay' AND coalesce(tx_id, '') <> '' GROUP BY tx_id),
      r AS (SELECT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS tx_id,
                   min(ts) AS receipt_time, 'wechat' AS pay_channel
            FROM events WHERE event_type = 'signup' GROUP BY 1),
      j AS (SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, p.order_id, p.pay_time, r.receipt_time,
                   r.pay_channel,
                   CASE WHEN p.tx_id IS NOT NULL AND r.tx_id IS NOT NULL THEN 'matched'
                        WHEN p.tx_id IS NOT NULL THEN 'order_only' ELSE 'receipt_only' END AS outcome
            FROM p FULL OUTER JOIN r ON p.tx_id = r.tx_id
                 AND r.receipt_time BETWEEN p.pay_time - INTERVAL 1 HOUR
                                        AND p.pay_time + INTERVAL 1 HOUR)
      SELECT tx_id, order_id, pay_time, receipt_time, pay_channel, outcome,
             CASE outcome WHEN 'matched' THEN 'payment and receipt agree'
                          WHEN 'order_only' THEN 'no receipt for this payment'
                          ELSE 'no payment for this receipt' END AS msg
      FROM j""",

    **{f"decode_{kind}": oracle(kind) for kind in KINDS},

    # a stream has closed the windows that its watermark, the last event of its kind, has passed
    "stream_page_views": """
      WITH v AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS pv
                 FROM events WHERE event_type = 'view' GROUP BY 1)
      SELECT * FROM v WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events WHERE event_type = 'view')""",

    "stream_hot_items": f"""
      WITH c AS (SELECT {_HI_END} AS window_end,
                        CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id
                 FROM events {_HI_JOIN} WHERE event_type = 'click'),
      g AS (SELECT window_end, item_id, count(*) AS cnt FROM c GROUP BY 1, 2),
      r AS (SELECT *, row_number() OVER (PARTITION BY window_end
                                         ORDER BY cnt DESC, item_id) AS rn FROM g)
      SELECT window_end, item_id, cnt, CAST(rn AS BIGINT) AS rank FROM r
      WHERE rn <= 3 AND window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events WHERE event_type = 'click')""",

    "stream_login_fail_burst": """
      WITH f AS (SELECT user_id, ts, event_id,
                        lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
                 FROM events WHERE event_type = 'error'),
      s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END)
                      OVER (PARTITION BY user_id ORDER BY ts, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
            FROM f),
      g AS (SELECT user_id, min(ts) AS start_time, max(ts) AS end_time, count(*) AS fails
            FROM s GROUP BY user_id, run)
      SELECT user_id, start_time, end_time, fails,
             'login fail ' || fails || ' times within 21600s' AS msg
      FROM g WHERE fails >= 2
        AND end_time + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events WHERE event_type = 'error')""",
}

ORACLE_SQL["stream_hot_items_ranked"] = ORACLE_SQL["stream_hot_items"]
# revisions are sent as they come, so windows that are still open count too
ORACLE_SQL["stream_hot_urls_revised"] = _TOP_URLS.format(keep="true", end=_HR_END, join=_HR_JOIN)
ORACLE_SQL["stream_unique_visitors_firing"] = f"""
      WITH v AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
                        count(DISTINCT {_BITMAP}) AS uv, count(*) AS n_rows
                 FROM events WHERE event_type = 'view' GROUP BY 1)
      SELECT * FROM v WHERE window_end <= {_MARK.format("'view'")}"""
# a transaction is reported when no row of it came for a day, on both inputs' clocks
ORACLE_SQL["stream_tx_reconcile"] = f"""
      WITH j AS ({ORACLE_SQL["tx_reconcile"]}),
      l AS (SELECT tx_id, max(ts) AS last FROM ({_ORDERS}) AS o GROUP BY tx_id)
      SELECT j.* FROM j JOIN l ON j.tx_id = l.tx_id
      WHERE l.last + INTERVAL 1 DAY <= {_MARK.format("'purchase'")}
        AND l.last + INTERVAL 1 DAY <= {_MARK.format("'signup'")}"""
ORACLE_SQL["stream_login_fail_consecutive"] = f"""
      WITH p AS ({ORACLE_SQL["login_fail_consecutive"]})
      SELECT * FROM p WHERE end_time <= (SELECT date_trunc('millisecond', max(ts)) FROM events)"""
ORACLE_SQL["stream_order_timeout_pattern"] = f"""
      WITH p AS ({ORACLE_SQL["order_timeout_pattern"]})
      SELECT * FROM p WHERE coalesce(pay_time, create_time + INTERVAL 6 HOUR) <= {_MARK.format("'signup', 'purchase'")}"""
ORACLE_SQL["stream_ad_click_cap"] = f"""
      WITH c AS ({_CAPPED})
      SELECT user_id, ad_id, event_time, event_id, outcome, msg FROM c WHERE event_time <= {_MARK.format("'click'")}"""
