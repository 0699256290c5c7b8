"""The queries of `catalog` in plain SQL over the test tables, written independently of the Spark plans."""

from __future__ import annotations

NOW = "TIMESTAMP '2024-01-31 00:00:00'"

TRADES = """
WITH kept AS (
  SELECT event_id, ts, event_type, value FROM events
  WHERE NOT (event_type = 'error' AND event_id % 7 < 3)
    AND NOT (event_id % 7 = 5 AND ts >= TIMESTAMP '2024-01-25 00:00:00')
    AND NOT (event_id % 7 = 6 AND ts >= TIMESTAMP '2024-01-30 18:00:00')
), copied AS (
  SELECT *, 0 AS again FROM kept
  UNION ALL SELECT *, 1 AS again FROM kept WHERE event_id % 50 = 0
), trades AS (
  SELECT event_id, 'coinbase' AS exchange, 'SYM' || (event_id % 7) || '-USD' AS symbol,
    CAST(event_id // 7 AS VARCHAR) AS trade_id, event_id // 7 AS n,
    CASE WHEN event_type IN ('click', 'view') THEN 'sell' ELSE 'buy' END AS side,
    value AS price, CAST(1.0 + (event_id % 10) AS DOUBLE) AS quantity,
    ts + to_seconds(again) AS trade_ts, ts + to_seconds(event_id % 120 + again) AS ingest_ts
  FROM copied
)"""

BIG = """
WITH trades AS (
  SELECT 'coinbase' AS exchange, 'SUPP-' || l_suppkey AS symbol, CAST(l_orderkey AS VARCHAR) AS trade_id,
    l_orderkey AS n, CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS side,
    l_extendedprice / l_quantity AS price, l_quantity AS quantity, l_shipdate AS trade_ts,
    CAST(NULL AS TIMESTAMP) AS ingest_ts
  FROM lineitem
)"""

CALLS = """
WITH calls AS (
  SELECT 'user-' || user_id AS source, event_id AS id, ts, event_type <> 'error' AS ok, value AS latency_ms
  FROM events
)"""

_COLS = "exchange, symbol, trade_id, side, price, quantity, trade_ts, ingest_ts"

_PCT = "round(1.0e2 * count(DISTINCT trade_id) / nullif(CAST(max(n) - min(n) + 1 AS DOUBLE), 0), 2)"

_HEALTH = f"""
, health AS (
  SELECT exchange, symbol, count(*) AS trades, max(trade_ts) AS last_trade,
    date_sub('minute', max(trade_ts), {NOW}) AS minutes_stale, {_PCT} AS completeness_pct
  FROM trades GROUP BY exchange, symbol
), labelled AS (
  SELECT *, CASE WHEN minutes_stale > 1440 OR completeness_pct < 90 THEN 'CRITICAL'
    WHEN minutes_stale > 180 OR completeness_pct < 95 THEN 'WARNING'
    WHEN minutes_stale > 60 OR completeness_pct < 99 THEN 'ATTENTION' ELSE 'HEALTHY' END AS health_status
  FROM health
)"""

_STALE = f"""
, stale AS (
  SELECT exchange, symbol, date_sub('minute', max(trade_ts), {NOW}) AS m FROM trades GROUP BY exchange, symbol
)"""

_GAPS = """
, intervals AS (
  SELECT exchange, symbol, trade_ts AS gap_end,
    lag(trade_ts) OVER (PARTITION BY exchange, symbol ORDER BY trade_ts, trade_id) AS gap_start
  FROM trades
), gaps AS (
  SELECT *, date_sub('second', gap_start, gap_end) AS g FROM intervals WHERE gap_start IS NOT NULL
), stats AS (
  SELECT exchange, symbol, avg(g) AS mean, stddev_samp(g) AS dev, count(*) AS total_intervals,
    quantile_disc(g, 0.5) AS p50, quantile_disc(g, 0.95) AS p95, quantile_disc(g, 0.99) AS p99, max(g) AS longest
  FROM gaps WHERE g > 0 AND g < 604800 GROUP BY exchange, symbol
), scored AS (
  SELECT gaps.*, mean, (g - mean) / nullif(dev, 0) AS z FROM gaps JOIN stats USING (exchange, symbol)
)"""

# Hundredths of an hour, rounded half up in whole numbers.
_HOURS = "(({0} * 200 + 3600) // 7200) / 1.0e2"

_GAP_SUMMARY = f"""
SELECT s.exchange, s.symbol, s.total_intervals, round(s.mean / 60, 2) AS avg_gap_minutes,
  round(s.p50 / 60.0e0, 2) AS median_gap_minutes, round(s.p95 / 60.0e0, 2) AS p95_gap_minutes,
  round(s.p99 / 60.0e0, 2) AS p99_gap_minutes, {_HOURS.format("s.longest")} AS max_gap_hours,
  (SELECT count(*) FROM scored a WHERE a.exchange = s.exchange AND a.symbol = s.symbol AND a.z > 3)
    AS anomalous_gap_count,
  (SELECT count(*) FROM scored a WHERE a.exchange = s.exchange AND a.symbol = s.symbol AND a.z > 5)
    AS extreme_gap_count
FROM stats s"""

_SEQ = """
, sequences AS (
  SELECT exchange, symbol, n, trade_ts,
    lead(n) OVER (PARTITION BY exchange, symbol ORDER BY n, trade_ts) AS ahead
  FROM trades
), missing AS (SELECT *, ahead - n - 1 AS m FROM sequences)"""

_ID_TOTALS = """
SELECT count(DISTINCT (exchange, symbol)) AS products_analyzed,
  CAST(sum(CASE WHEN m > 0 THEN m ELSE 0 END) AS BIGINT) AS total_missing_trades,
  count(CASE WHEN m > 0 THEN 1 END) AS gap_occurrences, max(m) AS largest_single_gap,
  CAST(sum(CASE WHEN m > 10 THEN 1 ELSE 0 END) AS BIGINT) AS gaps_over_10,
  CAST(sum(CASE WHEN m > 100 THEN 1 ELSE 0 END) AS BIGINT) AS gaps_over_100
FROM missing"""

_COMPLETENESS = f"""
SELECT exchange, symbol, min(n) AS min_trade_id, max(n) AS max_trade_id, max(n) - min(n) + 1 AS expected_trades,
  count(DISTINCT trade_id) AS actual_trades, max(n) - min(n) + 1 - count(DISTINCT trade_id) AS missing_trades,
  {_PCT} AS completeness_pct, CAST(0 AS BIGINT) AS unparsed_id_rows
FROM trades GROUP BY exchange, symbol"""

_OVERVIEW = """
SELECT exchange, symbol, count(*) AS total_trades, count(DISTINCT trade_id) AS unique_trade_ids,
  min(trade_ts) AS earliest_trade, max(trade_ts) AS latest_trade,
  date_sub('day', min(trade_ts), max(trade_ts)) AS days_of_data,
  round(sum(price * quantity), 4) AS total_volume_usd, round(avg(price), 8) AS avg_price,
  min(price) AS min_price, max(price) AS max_price
FROM trades GROUP BY exchange, symbol"""

_DUP_KEYS = """
SELECT exchange, symbol, trade_id, count(*) AS occurrence_count, min(trade_ts) AS first_occurrence,
  max(trade_ts) AS last_occurrence, count(DISTINCT trade_ts) AS unique_timestamps
FROM trades GROUP BY exchange, symbol, trade_id HAVING count(*) > 1
ORDER BY occurrence_count DESC, exchange, symbol, trade_id LIMIT 100"""


def _newest(cols: str = _COLS, where: str = "TRUE") -> str:
    return f"""
SELECT {cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY exchange, symbol, trade_id
    ORDER BY trade_ts DESC, side, price, quantity, ingest_ts) AS rn
  FROM trades WHERE {where})
WHERE rn = 1"""


def _bars(since: str, grain: str) -> str:
    return f"""
, periods AS (
  SELECT exchange, symbol, date_trunc('{grain}', trade_ts) AS period, count(*) AS c
  FROM trades WHERE trade_ts >= {since} GROUP BY 1, 2, 3
), usual AS (
  SELECT exchange, symbol, avg(c) AS mean, stddev_samp(c) AS dev FROM periods GROUP BY 1, 2
)"""


def _low(grain: str, z: int) -> str:
    return f"""{_bars(NOW + " - INTERVAL 30 DAY", grain)}
SELECT p.exchange, p.symbol, CAST(period AS TIMESTAMP) AS period, c AS trade_count, round(mean, 2) AS avg_trades,
  round((c - mean) / nullif(dev, 0), 2) AS z_score
FROM periods p JOIN usual u USING (exchange, symbol)
WHERE (c - mean) / nullif(dev, 0) < {z}
ORDER BY (c - mean) / nullif(dev, 0), p.exchange, p.symbol, period LIMIT 50"""


_DAYS = """
, by_day AS (
  SELECT date_trunc('day', trade_ts) AS ts, count(*) AS batch_size,
    count(DISTINCT (exchange, symbol, trade_id)) AS keys
  FROM trades GROUP BY 1
), history AS (
  SELECT ts, batch_size, batch_size - keys AS duplicates_found, (batch_size - keys) * 50 <= batch_size AS passed
  FROM by_day
), recent AS (SELECT * FROM history ORDER BY ts DESC LIMIT 5),
state AS (
  SELECT (SELECT count(*) FROM history) AS runs,
    (SELECT max(ts) FROM history WHERE passed) AS last_ok,
    (SELECT count(*) FROM history WHERE NOT passed
       AND ts > coalesce((SELECT max(ts) FROM history WHERE passed), TIMESTAMP '0001-01-01 00:00:00')) AS failures,
    (SELECT max(duplicates_found / CAST(batch_size AS DOUBLE)) FROM recent WHERE batch_size > 0) AS ratio
)"""

_PRODUCTS = f"""
, products AS (
  SELECT exchange, symbol, count(*) AS trades, sum(price * quantity) AS volume, min(trade_ts) AS first_ts,
    max(trade_ts) AS last_ts, count(*) - count(DISTINCT trade_id) AS duplicates,
    max(n) - min(n) + 1 - count(DISTINCT trade_id) AS missing, {_PCT} AS pct,
    date_sub('minute', max(trade_ts), {NOW}) AS minutes,
    sum(CASE WHEN trade_ts >= {NOW} - INTERVAL 1 DAY THEN 1 ELSE 0 END) AS recent
  FROM trades GROUP BY exchange, symbol
), totals AS (
  SELECT sum(trades) AS records, count(*) AS products, round(sum(volume), 2) AS volume,
    date_sub('day', min(first_ts), max(last_ts)) AS span_days, sum(recent) AS recent,
    sum(duplicates) AS duplicates, sum(CASE WHEN duplicates > 0 THEN 1 ELSE 0 END) AS dup_products,
    sum(missing) AS missing, min(pct) AS min_pct, avg(pct) AS avg_pct, avg(minutes) AS avg_minutes,
    max(minutes) AS max_minutes, sum(CASE WHEN minutes > 360 THEN 1 ELSE 0 END) AS stale
  FROM products
), scored AS (
  SELECT *, greatest(0.0e0, 100.0e0
      - CASE WHEN duplicates > 0 THEN least(20, duplicates) ELSE 0 END
      - CASE WHEN min_pct < 99 THEN least(30.0e0, (100 - min_pct) * 3) ELSE 0 END
      - CASE WHEN missing > 100 THEN least(20, CAST(missing AS BIGINT) // 100) ELSE 0 END
      - least(30.0e0, 1.0e2 * stale / products)) AS score
  FROM totals
)"""

_SINGLE_METRICS = [
    ("TotalRecords", "records"),
    ("ProductCount", "products"),
    ("TotalVolumeUSD", "volume"),
    ("DataSpanDays", "span_days"),
    ("AvgDailyGrowth", "round(CAST(records AS DOUBLE) / greatest(span_days, 1), 4)"),
    ("AvgDataFreshnessMinutes", "round(avg_minutes, 4)"),
    ("MaxDataFreshnessMinutes", "max_minutes"),
    ("StaleProductCount", "stale"),
    ("MissingTradesTotal", "missing"),
    ("MinCompletenessPct", "min_pct"),
    ("AvgCompletenessPct", "round(avg_pct, 4)"),
    ("DuplicateTradesTotal", "duplicates"),
    ("ProductsWithDuplicates", "dup_products"),
    ("DailyRecordsWritten", "recent"),
    ("OverallHealthScore", "round(score, 4)"),
]

_METRICS = (
    _PRODUCTS
    + ", metrics AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS metric, '' AS dimension, CAST({value} AS DOUBLE) AS value FROM scored"
        for name, value in _SINGLE_METRICS
    )
    + " UNION ALL SELECT 'RecordsPerProduct', exchange || ':' || symbol, CAST(trades AS DOUBLE) FROM products"
    + " UNION ALL SELECT 'FreshnessMinutes', exchange || ':' || symbol, CAST(minutes AS DOUBLE) FROM products)"
)

_POINTS = """
, points AS (
  SELECT ts, CASE WHEN ok THEN 'APISuccessCount' ELSE 'APIErrorCount' END AS metric, 1.0e0 AS value FROM calls
  UNION ALL SELECT ts, 'ExchangeResponseTime', latency_ms FROM calls
), rolled AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS period_start, metric, round(sum(value), 4) AS sum_value,
    round(avg(value), 8) AS avg_value, quantile_disc(value, 0.5) AS p50_value,
    quantile_disc(value, 0.99) AS p99_value, max(value) AS max_value, count(*) AS points
  FROM points GROUP BY 1, 2
)"""

_GAP_MINUTES = """
, longest AS (
  SELECT exchange, symbol, max(date_sub('microsecond', gap_start, gap_end)) / 6.0e7 AS minutes
  FROM gaps GROUP BY 1, 2
), per_product AS (
  SELECT exchange, symbol, count(*) AS trades, count(*) - count(DISTINCT trade_id) AS dups, max(trade_ts) AS last_ts
  FROM trades GROUP BY 1, 2
), whole AS (
  SELECT sum(trades) AS records, count(*) AS products, sum(dups) AS dups,
    date_sub('microsecond', max(last_ts), {now}) / 3.6e9 AS age,
    sum(CASE WHEN minutes > 60 THEN 1 ELSE 0 END) AS gapped,
    coalesce(max(CASE WHEN minutes > 60 THEN minutes END), 0) AS max_gap,
    sum(CASE WHEN date_sub('microsecond', last_ts, {now}) / 3.6e9 > 2 THEN 1 ELSE 0 END) AS stale
  FROM per_product LEFT JOIN longest USING (exchange, symbol)
)""".format(now=NOW)


def _checks(source: str, cells: list[tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{check}' AS "check", '{severity}' AS severity, CAST({value} AS DOUBLE) AS value,
  {issue} AS issue FROM {source}"""
        for check, severity, value, issue in cells
    )


_LOG = """
, lines AS (
  SELECT trade_ts AS ts, CASE WHEN n % 10 = 0 THEN 'ERROR timeout'
    ELSE 'INFO product_id=' || symbol || ' trades written ' || trade_id END AS message, symbol, n
  FROM trades
)"""

_USABLE = "event_id % 101 NOT IN (1, 2, 3)"
_SPLIT = "TIMESTAMP '2024-01-20 00:00:00'"
_UNIFIED = "exchange, symbol, trade_id, side, price, quantity, trade_ts"

# Two runs: events not divisible by 3 plus 2, and events not divisible by 3. A key is one event, copies and all.
_TWO_RUNS = f"""
, parts AS (
  SELECT 'first' AS run_id, *, {_USABLE} AS good FROM trades WHERE event_id % 3 < 2
  UNION ALL SELECT 'second', *, {_USABLE} FROM trades WHERE event_id % 3 > 0
), keys AS (
  SELECT exchange, symbol, trade_id, min(run_id) AS run_id FROM parts WHERE good GROUP BY 1, 2, 3
), runs AS (
  SELECT p.run_id, count(*) AS read, count(CASE WHEN good THEN 1 END) AS usable, count(CASE WHEN NOT good THEN 1 END) AS rejected,
    count(DISTINCT CASE WHEN good THEN (exchange, symbol, trade_id) END) AS keys,
    (SELECT count(*) FROM keys k WHERE k.run_id = p.run_id) AS new_keys,
    count(DISTINCT CASE WHEN good AND (p.run_id = 'first' OR event_id % 3 = 2) THEN event_id END) AS new_events
  FROM parts p GROUP BY 1
), marks AS (
  SELECT symbol, max(CASE WHEN run_id = 'first' THEN n END) AS first_top, max(CASE WHEN run_id = 'second' THEN n END) AS second_top,
    max(n) AS after, greatest(max(CASE WHEN run_id = 'first' THEN n END), max(CASE WHEN run_id = 'second' THEN n END)) AS least
  FROM parts WHERE good GROUP BY 1
)"""


def all_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["overview_by_symbol"] = TRADES + _OVERVIEW
    q["big_overview"] = BIG + _OVERVIEW
    q["overview_totals"] = TRADES + """
SELECT count(*) AS total_records, count(DISTINCT (exchange, symbol)) AS unique_products,
  count(DISTINCT trade_id) AS unique_trade_ids, min(trade_ts) AS earliest_data, max(trade_ts) AS latest_data,
  date_sub('day', min(trade_ts), max(trade_ts)) AS total_days_span,
  round(sum(price * quantity), 4) AS total_volume_usd
FROM trades"""
    q["freshness_by_symbol"] = TRADES + _STALE + f"""
SELECT t.exchange, t.symbol, max(trade_ts) AS latest_trade_time, max(n) AS latest_trade_id,
  any_value(m) AS minutes_since_last_trade, date_sub('hour', max(trade_ts), {NOW}) AS hours_since_last_trade,
  CASE WHEN any_value(m) < 60 THEN 'FRESH' WHEN any_value(m) < 180 THEN 'STALE'
    WHEN any_value(m) < 1440 THEN 'OLD' ELSE 'VERY_OLD' END AS freshness_status,
  count(*) AS total_trades
FROM trades t JOIN stale s USING (exchange, symbol) GROUP BY t.exchange, t.symbol"""
    q["freshness_totals"] = TRADES + _STALE + """
SELECT count(*) AS total_products, round(avg(m), 8) AS avg_minutes_stale, min(m) AS min_minutes_stale,
  max(m) AS max_minutes_stale, quantile_disc(m, 0.5) AS median_minutes_stale,
  count(CASE WHEN m < 60 THEN 1 END) AS fresh_products,
  count(CASE WHEN m >= 60 AND m < 180 THEN 1 END) AS stale_products,
  count(CASE WHEN m >= 180 THEN 1 END) AS old_products
FROM stale"""
    q["freshness_histogram"] = TRADES + _STALE + """
SELECT count(*) AS total_products, count(CASE WHEN m < 60 THEN 1 END) AS fresh_lt_1h,
  count(CASE WHEN m >= 60 AND m < 180 THEN 1 END) AS stale_1h_3h,
  count(CASE WHEN m >= 180 AND m < 1440 THEN 1 END) AS old_3h_24h,
  count(CASE WHEN m >= 1440 THEN 1 END) AS very_old_gt_24h,
  round(avg(m), 2) AS avg_minutes_stale, quantile_disc(m, 0.5) AS median_minutes_stale
FROM stale"""
    q["stale_symbols"] = TRADES + f"""
SELECT exchange, symbol, max(trade_ts) AS latest_trade_time, date_sub('hour', max(trade_ts), {NOW}) AS hours_stale,
  count(*) AS total_trades, max(n) AS latest_trade_id
FROM trades GROUP BY exchange, symbol HAVING date_sub('minute', max(trade_ts), {NOW}) > 180"""
    q["time_gap_anomalies"] = TRADES + _GAPS + f"""
SELECT exchange, symbol, gap_start, gap_end, round(g / 60.0e0, 2) AS gap_minutes,
  {_HOURS.format("g")} AS gap_hours, round(mean / 60, 2) AS avg_gap_minutes, round(z, 2) AS z_score,
  CASE WHEN z > 5 THEN 'EXTREME' WHEN z > 4 THEN 'SEVERE' ELSE 'WARNING' END AS gap_severity
FROM scored WHERE z > 3 ORDER BY z DESC, exchange, symbol, gap_end LIMIT 100"""
    q["time_gap_summary"] = TRADES + _GAPS + _GAP_SUMMARY
    q["big_time_gap_summary"] = BIG + _GAPS + _GAP_SUMMARY
    q["time_gap_list"] = TRADES + _GAPS + """
SELECT exchange, symbol, gap_start, gap_end, g AS gap_seconds FROM gaps WHERE g > 0"""
    q["duplicate_keys"] = TRADES + _DUP_KEYS
    q["big_duplicate_keys"] = BIG + _DUP_KEYS
    q["duplicates_by_symbol"] = TRADES + """
SELECT exchange, symbol, count(*) AS total_records, count(DISTINCT trade_id) AS unique_trade_ids,
  count(*) - count(DISTINCT trade_id) AS duplicate_count,
  round(1.0e2 * (count(*) - count(DISTINCT trade_id)) / count(*), 4) AS duplicate_percentage
FROM trades GROUP BY exchange, symbol HAVING count(*) > count(DISTINCT trade_id)"""
    q["duplicate_totals"] = TRADES + """
, c AS (SELECT count(*) AS a, count(DISTINCT exchange || '|' || symbol || '|' || trade_id) AS b FROM trades)
SELECT a AS total_records, b AS unique_records, a - b AS total_duplicates,
  round(1.0e2 * (a - b) / a, 4) AS duplicate_pct FROM c"""
    q["id_gaps"] = TRADES + _SEQ + """
SELECT exchange, symbol, n AS last_seen_id, ahead AS next_seen_id, m AS missing_trade_count,
  trade_ts AS last_seen_time
FROM missing WHERE m > 0 ORDER BY m DESC, exchange, symbol, n LIMIT 100"""
    q["id_gap_runs"] = TRADES + _SEQ + """
SELECT exchange, symbol, n AS last_seen_id, ahead AS next_seen_id, m AS missing FROM missing WHERE m > 0"""
    q["id_gap_summary"] = TRADES + _SEQ + """
SELECT exchange, symbol, count(*) AS total_trades,
  CAST(sum(CASE WHEN m > 0 THEN m ELSE 0 END) AS BIGINT) AS total_missing_trades,
  count(CASE WHEN m > 0 THEN 1 END) AS gap_occurrences, max(m) AS largest_gap,
  round(1.0e2 * sum(CASE WHEN m > 0 THEN m ELSE 0 END) / nullif(CAST(max(n) - min(n) AS DOUBLE), 0), 4)
    AS estimated_missing_pct
FROM missing GROUP BY exchange, symbol HAVING sum(CASE WHEN m > 0 THEN m ELSE 0 END) > 0"""
    q["id_gap_totals"] = TRADES + _SEQ + _ID_TOTALS
    q["big_id_gap_totals"] = BIG + _SEQ + _ID_TOTALS
    q["completeness"] = TRADES + _COMPLETENESS
    q["big_completeness"] = BIG + _COMPLETENESS
    q["completeness_totals"] = TRADES + f"""
, c AS (SELECT {_PCT} AS pct FROM trades GROUP BY exchange, symbol)
SELECT count(*) AS products, round(avg(pct), 2) AS avg_completeness_pct, min(pct) AS min_completeness_pct,
  count(CASE WHEN pct >= 99 THEN 1 END) AS products_99_plus_pct,
  count(CASE WHEN pct >= 95 AND pct < 99 THEN 1 END) AS products_95_99_pct,
  count(CASE WHEN pct < 95 THEN 1 END) AS products_below_95_pct
FROM c"""
    q["top_symbols_by_volume"] = TRADES + f"""
SELECT exchange, symbol, count(*) AS trade_count, round(sum(price * quantity), 2) AS volume_usd,
  round(avg(price), 4) AS avg_price, min(trade_ts) AS first_trade, max(trade_ts) AS last_trade,
  date_sub('minute', max(trade_ts), {NOW}) AS minutes_stale
FROM trades GROUP BY exchange, symbol ORDER BY volume_usd DESC, exchange, symbol LIMIT 10"""
    q["problem_symbols"] = TRADES + _HEALTH + """
SELECT exchange, symbol, trades, last_trade, minutes_stale, completeness_pct, health_status
FROM labelled WHERE minutes_stale > 180 OR completeness_pct < 95"""
    q["symbol_health"] = TRADES + _HEALTH + """
SELECT exchange, symbol, minutes_stale, completeness_pct, health_status FROM labelled"""
    q["symbol_health_joined"] = q["symbol_health"]
    q["hourly_bars"] = TRADES + f"""
SELECT exchange, symbol, CAST(date_trunc('hour', trade_ts) AS TIMESTAMP) AS "hour", count(*) AS trade_count,
  round(sum(price * quantity), 4) AS volume_usd, round(avg(price), 8) AS avg_price,
  min(price) AS low, max(price) AS high
FROM trades WHERE trade_ts >= {NOW} - INTERVAL 7 DAY GROUP BY 1, 2, 3"""
    q["low_activity_periods"] = TRADES + _low("day", -2)
    q["low_activity_hours"] = TRADES + _low("hour", -1)
    q["daily_summary"] = TRADES + f"""
SELECT CAST(trade_ts AS DATE) AS "date", count(DISTINCT (exchange, symbol)) AS active_products,
  count(*) AS total_trades, round(sum(price * quantity), 4) AS total_volume_usd,
  count(*) // count(DISTINCT (exchange, symbol)) AS avg_trades_per_product
FROM trades WHERE trade_ts >= {NOW} - INTERVAL 30 DAY GROUP BY 1"""
    q["ingest_latency"] = TRADES + f"""
, lags AS (
  SELECT exchange, symbol, date_sub('second', trade_ts, ingest_ts) AS s FROM trades
  WHERE trade_ts >= {NOW} - INTERVAL 7 DAY AND ingest_ts IS NOT NULL
)
SELECT exchange, symbol, round(avg(s), 8) AS avg_latency_seconds, min(s) AS min_latency_seconds,
  max(s) AS max_latency_seconds, quantile_disc(s, 0.5) AS median_latency_seconds,
  quantile_disc(s, 0.95) AS p95_latency_seconds
FROM lags GROUP BY exchange, symbol ORDER BY avg(s) DESC, exchange, symbol LIMIT 20"""
    q["latest_trades"] = TRADES + """
SELECT exchange, symbol, trade_id, price, quantity, side, trade_ts, round(price * quantity, 4) AS volume_usd
FROM trades WHERE symbol = 'SYM3-USD' ORDER BY trade_ts DESC, n DESC LIMIT 100"""
    q["hourly_volume_one_symbol"] = TRADES + """
SELECT CAST(date_trunc('hour', trade_ts) AS TIMESTAMP) AS "hour", count(*) AS trades,
  round(sum(price * quantity), 4) AS volume
FROM trades WHERE symbol = 'SYM3-USD' GROUP BY 1"""
    q["dq_overview"] = TRADES + """
SELECT exchange, symbol, count(*) AS total_records, round(sum(price * quantity), 4) AS total_volume,
  min(trade_ts) AS earliest_trade, max(trade_ts) AS latest_trade
FROM trades GROUP BY exchange, symbol"""
    q["dq_freshness"] = TRADES + f"""
SELECT exchange, symbol, max(trade_ts) AS last_trade_time,
  date_sub('minute', max(trade_ts), {NOW}) AS minutes_since_last_trade
FROM trades GROUP BY exchange, symbol"""
    q["dq_duplicates"] = TRADES + """
SELECT exchange, symbol, count(*) - count(DISTINCT trade_id) AS duplicate_count
FROM trades GROUP BY exchange, symbol HAVING count(*) > count(DISTINCT trade_id)"""
    q["records_since_yesterday"] = TRADES + f"""
SELECT count(*) AS records_today FROM trades WHERE trade_ts >= {NOW} - INTERVAL 1 DAY"""
    q["dedupe_precheck"] = TRADES + """
, c AS (SELECT count(*) AS a, count(DISTINCT exchange || '|' || symbol || '|' || trade_id) AS b FROM trades)
SELECT a AS total, b AS unique_count, CAST(0 AS BIGINT) AS incomplete_keys, a = b AS skip_dedupe FROM c"""
    q["dedupe"] = TRADES + _newest()
    q["big_dedupe"] = BIG + _newest()
    q["curated_version"] = q["dedupe"]
    q["dedupe_first"] = TRADES + f"""
SELECT {_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY exchange, symbol, trade_id
    ORDER BY ingest_ts, side, price, quantity, trade_ts) AS rn
  FROM trades)
WHERE rn = 1"""
    q["duplicate_members"] = TRADES + f"""
SELECT {_COLS} FROM (
  SELECT *, count(*) OVER (PARTITION BY exchange, symbol, trade_id) AS c FROM trades)
WHERE c > 1"""
    q["product_last_seen"] = TRADES + _LOG + """
SELECT regexp_extract(message, 'product[_]?id[=:\\s"'']+([A-Z0-9]+-[A-Z]+)', 1) AS product, max(ts) AS last_seen
FROM lines WHERE regexp_matches(message, 'product_id|trades written|Ingested')
GROUP BY 1 HAVING product <> '' ORDER BY last_seen DESC, product LIMIT 30"""
    q["log_counts"] = TRADES + _LOG + """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS period_start,
  count(CASE WHEN message LIKE '%ERROR%' THEN 1 END) AS error_count,
  CAST(sum(CASE WHEN n % 10 = 0 THEN 0 ELSE n END) AS BIGINT) AS trades_ingested
FROM lines GROUP BY 1"""
    q["normalized_trades"] = TRADES + f"""
SELECT {_UNIFIED} FROM trades WHERE {_USABLE}"""
    q["rejected_trades"] = TRADES + """
SELECT CASE event_id % 101 WHEN 1 THEN 'missing_trade_ts' WHEN 2 THEN 'bad_price' ELSE 'malformed_json' END
    AS reject_reason, count(*) AS rejected
FROM trades WHERE event_id % 101 IN (1, 2, 3) GROUP BY 1"""
    q["raw_records"] = TRADES + """
SELECT trade_id, symbol AS product_id, price, quantity AS size, trade_ts AS "time", upper(side) AS side,
  'coinbase' AS _source, ingest_ts AS _source_ingest_ts, trade_id AS payload_id,
  CAST(price AS VARCHAR) AS payload_price
FROM trades"""
    q["raw_files"] = TRADES + f"SELECT {_COLS} FROM trades"
    q["rule_violations"] = TRADES + " UNION ALL ".join(
        f"\nSELECT '{rule}' AS rule, count(CASE WHEN {broken} THEN 1 END) AS failed_rows FROM trades"
        for rule, broken in [
            ("required:trade_id", "trade_id IS NULL"),
            ("required:symbol", "symbol IS NULL"),
            ("required:side", "side IS NULL"),
            ("required:price", "price IS NULL"),
            ("required:quantity", "n % 17 = 0"),
            ("required:trade_ts", "trade_ts IS NULL"),
            ("positive:price", "(CASE WHEN n % 13 = 0 THEN -price ELSE price END) <= 0"),
            ("positive:quantity", "n % 17 <> 0 AND quantity <= 0"),
            ("allowed:side", "n % 19 = 0"),
        ]
    )
    q["invalid_sides"] = TRADES + "SELECT DISTINCT 'hold' AS side FROM trades WHERE n % 19 = 0"
    q["product_list_update"] = TRADES + """
SELECT exchange, symbol FROM trades WHERE trade_ts >= TIMESTAMP '2024-01-30 00:00:00'
UNION SELECT exchange, symbol FROM trades WHERE regexp_matches(symbol, '^SYM[456]-')"""
    q["product_coverage"] = TRADES + """
SELECT count(DISTINCT (exchange, symbol)) AS products, string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols
FROM trades"""
    q["listed_symbols"] = TRADES + """
SELECT exchange, symbol, count(*) AS trades FROM trades
WHERE symbol IN (SELECT symbol FROM trades WHERE trade_ts >= TIMESTAMP '2024-01-30 00:00:00')
GROUP BY exchange, symbol"""
    q["unprocessed_files"] = TRADES + f"""
SELECT DISTINCT symbol || '/' || strftime(trade_ts, '%Y-%m-%d') AS file FROM trades WHERE trade_ts >= {_SPLIT}"""
    q["watermark_merge"] = TRADES + f"""
, o AS (SELECT exchange, symbol, max(n) AS a FROM trades WHERE trade_ts < {_SPLIT} GROUP BY 1, 2),
w AS (SELECT exchange, symbol, max(n) AS b FROM trades WHERE trade_ts >= {_SPLIT} GROUP BY 1, 2)
SELECT exchange, symbol, greatest(a, b) AS cursor,
  CASE WHEN a IS NULL OR b > a THEN {NOW} ELSE {_SPLIT} END AS updated_at
FROM o FULL JOIN w USING (exchange, symbol)"""
    q["backlog"] = TRADES + f"""
, w AS (SELECT exchange, symbol, max(n) AS c FROM trades
  WHERE trade_ts < {_SPLIT} AND CAST(substring(symbol, 4, 1) AS INT) % 2 = 0 GROUP BY 1, 2),
t AS (SELECT exchange, symbol, max(n) AS target_id FROM trades GROUP BY 1, 2),
j AS (SELECT exchange, symbol, target_id, coalesce(c, 1000) AS cursor FROM t LEFT JOIN w USING (exchange, symbol))
SELECT exchange, symbol, cursor, target_id, greatest(0, target_id - cursor) AS remaining,
  round(CASE WHEN target_id = 0 THEN 100 ELSE least(100.0e0, 1.0e2 * cursor / target_id) END, 2) AS pct_done,
  cursor > target_id AS caught_up
FROM j"""
    q["batch_validation"] = (
        TRADES
        + f"""
, batch AS (SELECT * FROM trades WHERE trade_ts >= TIMESTAMP '2024-01-30 00:00:00'),
b AS (SELECT count(*) AS r, count(*) - count(DISTINCT (exchange, symbol, trade_id)) AS d,
  count(CASE WHEN price <= 0 THEN 1 END) AS p, count(CASE WHEN quantity <= 0 THEN 1 END) AS k,
  count(CASE WHEN side NOT IN ('buy', 'sell') THEN 1 END) AS s FROM batch),
last AS (SELECT max(trade_ts) AS t FROM trades GROUP BY exchange, symbol),
st AS (SELECT count(CASE WHEN date_sub('microsecond', t, {NOW}) > 7.2e9 THEN 1 END) AS n FROM last)
"""
        + _checks(
            "b",
            [
                ("records_checked", "info", "r", "FALSE"),
                ("missing_columns", "error", "0", "FALSE"),
                ("duplicate_keys", "warning", "d", "d > 0"),
                ("price_not_positive", "warning", "p", "p > 0"),
                ("quantity_not_positive", "warning", "k", "k > 0"),
                ("invalid_side", "warning", "s", "s > 0"),
            ],
        )
        + " UNION ALL "
        + _checks("st", [("stale_products", "info", "n", "FALSE")])
    )
    q["full_validation"] = (
        TRADES
        + _GAPS
        + _GAP_MINUTES
        + _checks(
            "whole",
            [
                ("total_records", "info", "records", "FALSE"),
                ("products", "info", "products", "FALSE"),
                ("age_hours", "warning", "round(age, 4)", "age > 1"),
                ("duplicate_keys", "warning", "dups", "dups > 0"),
                ("products_with_long_gaps", "warning", "gapped", "gapped > 3"),
                ("max_gap_minutes", "info", "round(max_gap, 4)", "FALSE"),
                ("stale_products", "warning", "stale", "stale > 5"),
            ],
        )
    )
    q["quality_gates"] = TRADES + f"""
, c AS (SELECT count(*) AS r, count(*) - count(DISTINCT (exchange, symbol, trade_id)) AS d,
  date_sub('microsecond', max(trade_ts), {NOW}) / 3.6e9 AS age FROM trades),
f AS (SELECT CASE WHEN r > 0 AND d * 100 > r * 5 THEN 'duplicates' END AS x,
  CASE WHEN age > 4 THEN 'freshness' END AS y FROM c)
SELECT x IS NULL AND y IS NULL AS passed, concat_ws(',', x, y) AS reasons FROM f"""
    q["health_score"] = TRADES + _PRODUCTS + """
SELECT CAST(duplicates AS BIGINT) AS duplicates, CAST(missing AS BIGINT) AS missing_trades,
  min_pct AS min_completeness_pct, CAST(stale AS BIGINT) AS stale_products, products,
  round(score, 4) AS health_score FROM scored"""
    q["quality_metrics"] = TRADES + _METRICS + "SELECT metric, dimension, value FROM metrics"
    q["gauge_tiers"] = TRADES + _METRICS + """
SELECT metric, value, CASE metric
    WHEN 'OverallHealthScore' THEN CASE WHEN value >= 80 THEN 'GREEN' WHEN value >= 50 THEN 'YELLOW' ELSE 'RED' END
    WHEN 'StaleProductCount' THEN CASE WHEN value >= 5 THEN 'YELLOW' ELSE 'GREEN' END
    ELSE CASE WHEN value >= 100 THEN 'RED' WHEN value >= 10 THEN 'YELLOW' ELSE 'GREEN' END END AS tier
FROM metrics WHERE metric IN ('OverallHealthScore', 'StaleProductCount', 'MissingTradesTotal')
UNION ALL SELECT 'DataSpanYears', round(value / 365, 4), NULL FROM metrics WHERE metric = 'DataSpanDays'"""
    q["rate_limit_tiers"] = CALLS + """
, m AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS "minute", sum(10.0e0) AS errors FROM calls WHERE NOT ok GROUP BY 1)
SELECT "minute", 'coinbase' AS source, errors,
  CASE WHEN errors >= 50 THEN 'RED' WHEN errors >= 10 THEN 'YELLOW' ELSE 'GREEN' END AS tier FROM m"""
    q["bucketed_metrics"] = TRADES + f"""
, p AS (SELECT exchange, CASE WHEN symbol IN ('SYM0-USD', 'SYM3-USD') THEN symbol ELSE 'other' END AS product,
  symbol, count(*) AS c, max(trade_ts) AS t FROM trades GROUP BY 1, 2, 3)
SELECT exchange, product, CAST(sum(c) AS BIGINT) AS trades, count(*) AS symbols,
  date_sub('minute', max(t), {NOW}) AS min_age_minutes, date_sub('minute', min(t), {NOW}) AS max_age_minutes
FROM p GROUP BY exchange, product"""
    q["run_invariants"] = TRADES + f"""
, c AS (SELECT count(*) AS r, count(DISTINCT CASE WHEN {_USABLE} THEN (exchange, symbol, trade_id) END) AS k FROM trades)
SELECT 'read = transformed + rejected' AS invariant, r AS expected, r AS actual, TRUE AS holds FROM c
UNION ALL SELECT 'curated rows = distinct keys', k, k, TRUE FROM c
UNION ALL SELECT 'no watermark goes back', 0, 0, TRUE FROM c"""
    q["run_outcomes"] = TRADES + _DAYS + """
SELECT runs, CAST(last_ok AS TIMESTAMP) AS last_successful_transform, failures AS consecutive_failures,
  round(ratio, 6) AS max_duplicate_ratio FROM state"""
    q["replay_decision"] = TRADES + _DAYS + """
, d AS (SELECT *, CASE WHEN failures >= 2 THEN 'consecutive_failures' WHEN ratio > 0.05 THEN 'duplicate_ratio'
  ELSE '' END AS reason FROM state)
SELECT reason <> '' AS should_replay, reason, failures AS consecutive_failures,
  round(ratio, 6) AS max_duplicate_ratio FROM d"""
    q["liveness"] = TRADES + f"""
, p AS (
  SELECT exchange, symbol, max(trade_ts) AS updated_at,
    count(CASE WHEN trade_ts >= {NOW} - INTERVAL 1 DAY THEN 1 END) AS r,
    count(CASE WHEN trade_ts < {NOW} - INTERVAL 1 DAY AND trade_ts >= {NOW} - INTERVAL 8 DAY THEN 1 END) AS b
  FROM trades GROUP BY 1, 2)
SELECT exchange, symbol, r AS recent_rows, round(r / 24.0e0, 4) AS recent_per_hour,
  round(b / 168.0e0, 4) AS baseline_per_hour, r = 0 AS no_rows_24h, r / 24.0e0 < b / 168.0e0 * 0.5 AS rate_halved,
  date_sub('microsecond', updated_at, {NOW}) > 4 * 3.6e9 AS watermark_stuck
FROM p"""
    q["rolling_error_rate"] = CALLS + """
, r AS (SELECT *, avg(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY ts, id
  ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS rate FROM calls)
SELECT source, id, ts, ok, round(rate, 6) AS error_rate,
  CASE WHEN rate < 0.1 THEN 'healthy' WHEN rate < 0.3 THEN 'degraded' ELSE 'unhealthy' END AS status FROM r"""
    q["source_health"] = CALLS + """
, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts DESC, id DESC) AS age FROM calls),
h AS (SELECT source, count(*) AS requests, count(CASE WHEN age <= 100 THEN 1 END) AS recent_calls,
  avg(CASE WHEN age <= 100 THEN CASE WHEN ok THEN 0 ELSE 1 END END) AS rate,
  max(CASE WHEN ok THEN ts END) AS last_success_ts, max(CASE WHEN NOT ok THEN ts END) AS last_failure_ts
  FROM r GROUP BY source)
SELECT source, requests, recent_calls, round(rate, 6) AS error_rate,
  CASE WHEN rate < 0.1 THEN 'healthy' WHEN rate < 0.3 THEN 'degraded' ELSE 'unhealthy' END AS status,
  last_success_ts, last_failure_ts FROM h"""
    q["failure_runs"] = CALLS + """
, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts, id)
  - row_number() OVER (PARTITION BY source, ok ORDER BY ts, id) AS island FROM calls)
SELECT source, min(ts) AS run_start, max(ts) AS run_end, min(id) AS first_id, count(*) AS failures
FROM r WHERE NOT ok GROUP BY source, island HAVING count(*) >= 3"""
    q["latency_ema"] = CALLS + """
, e AS (SELECT source, count(*) AS c, list_reduce(list(latency_ms ORDER BY ts, id),
  lambda a, x: CASE WHEN a = 0 THEN x ELSE 0.8e0 * a + 0.2e0 * x END) AS ema
  FROM calls WHERE ok GROUP BY source)
SELECT source, round(ema, 6) AS avg_response_ms, round(ema / 1000, 8) AS avg_response_s FROM e"""
    one = CALLS + """
, ends AS (SELECT min(id) AS a, max(id) AS b FROM calls WHERE ok),
one AS (SELECT 'all' AS source, id, ts, ok, CASE WHEN id IN (a, b) THEN latency_ms ELSE 0.0e0 END AS latency_ms FROM calls, ends)"""
    q["latency_ema_zeros"] = one + """
, e AS (SELECT source, list_reduce(list(latency_ms ORDER BY ts, id),
  lambda a, x: CASE WHEN a = 0 THEN x ELSE 0.8e0 * a + 0.2e0 * x END) AS ema
  FROM one WHERE ok GROUP BY source)
SELECT source, round(ema, 6) AS avg_response_ms, round(ema / 1000, 8) AS avg_response_s FROM e"""
    each = """
, n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts, id) AS pos FROM {log} WHERE ok AND latency_ms IS NOT NULL),
e AS (SELECT source, pos, latency_ms AS a FROM n WHERE pos = 1
  UNION ALL SELECT n.source, n.pos, CASE WHEN e.a = 0 THEN n.latency_ms ELSE {kept} * e.a + {alpha} * n.latency_ms END
  FROM e JOIN n ON n.source = e.source AND n.pos = e.pos + 1)
SELECT n.source, n.id, n.ts, n.latency_ms, round(e.a, 6) AS avg_response_ms FROM n JOIN e ON n.source = e.source AND n.pos = e.pos"""
    recursive = lambda log: log.replace("WITH", "WITH RECURSIVE", 1)
    q["latency_ema_each"] = recursive(CALLS) + each.format(log="calls", kept="0.8e0", alpha="0.2e0")
    busy = recursive(CALLS) + """
, busy AS (SELECT * REPLACE ('all' AS source) FROM calls)"""
    q["latency_ema_each_busy"] = busy + each.format(log="busy", kept="0.8e0", alpha="0.2e0")
    q["latency_ema_each_zeros"] = recursive(one) + each.format(log="one", kept="0.5e0", alpha="0.5e0")
    q["rolling_error_rate_wide"] = one + """
, r AS (SELECT *, avg(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY ts, id
  ROWS BETWEEN 249 PRECEDING AND CURRENT ROW) AS rate FROM one)
SELECT source, id, ts, ok, round(rate, 6) AS error_rate,
  CASE WHEN rate < 0.1 THEN 'healthy' WHEN rate < 0.3 THEN 'degraded' ELSE 'unhealthy' END AS status FROM r"""
    q["failed_calls"] = """
SELECT event_id, CAST(least(500, length(repeat(event_type, CAST(event_id % 200 + 1 AS INTEGER)))) AS INTEGER) AS length
FROM events WHERE event_type = 'error'"""
    q["metric_rollup"] = CALLS + _POINTS + "SELECT * FROM rolled"
    q["stream_rollup"] = q["metric_rollup"]
    # Counted from the points at once, where the query adds up minutes and sources.
    q["metric_rollup_merged"] = CALLS + """
, points AS (
  SELECT ts, CASE WHEN ok THEN 'APISuccessCount' ELSE 'APIErrorCount' END AS metric, 1.0e0 AS value FROM calls
  UNION ALL SELECT ts, 'ExchangeResponseTime', latency_ms FROM calls),
valued AS (SELECT date_trunc('hour', ts) AS period_start, metric, value, CAST(sign(value) AS INTEGER) AS s,
  CASE WHEN value = 0 THEN 0 ELSE ceil(ln(abs(value)) / ln(1.01e0 / 0.99e0)) END AS b
  FROM points WHERE value IS NOT NULL),
ranked AS (SELECT *, s * 2 * pow(1.01e0 / 0.99e0, b) / (1.01e0 / 0.99e0 + 1) AS stands,
  row_number() OVER (PARTITION BY period_start, metric ORDER BY value) AS n, count(*) OVER (PARTITION BY period_start, metric) AS c
  FROM valued)
SELECT period_start, metric, round(sum(value), 4) AS sum_value, round(avg(value), 8) AS avg_value,
  round(max(CASE WHEN n = ceil(c * 0.5e0) THEN stands END), 6) AS p50_value,
  round(max(CASE WHEN n = ceil(c * 0.99e0) THEN stands END), 6) AS p99_value,
  max(value) AS max_value, count(*) AS points
FROM ranked GROUP BY period_start, metric"""
    q["stream_corrections"] = TRADES.replace("trades AS (", "first AS (") + """
, trades AS (
  SELECT * FROM first
  UNION ALL SELECT * REPLACE (CASE WHEN event_id % 9 = 0 THEN price * 2 ELSE price END AS price,
    CASE WHEN event_id % 9 = 0 THEN trade_ts + INTERVAL 1 DAY ELSE trade_ts END AS trade_ts)
  FROM first WHERE event_id % 3 = 0
)""" + _newest(_UNIFIED)
    q["state_after_many_runs"] = TRADES + """
SELECT exchange, symbol, max(n) AS cursor, count(DISTINCT event_id % 50) AS rows FROM trades GROUP BY 1, 2"""
    # At these sizes the files round to 0.000 GB.
    q["quality_metrics_stored"] = q["quality_metrics"] + " UNION ALL SELECT 'ParquetSizeGB', '', 0.0e0"
    q["source_status"] = CALLS + """
, l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts DESC, id DESC) AS age FROM calls),
f AS (SELECT source, min(CASE WHEN ok THEN age END) AS ok_age, min(CASE WHEN NOT ok THEN age END) AS failed_age, count(*) AS n FROM l GROUP BY 1)
SELECT f.source, coalesce(ok_age - 1, n) AS consecutive_failures, coalesce(failed_age - 1, n) AS consecutive_successes,
  substr(repeat('error ' || l.id || '. ', CAST(l.id % 100 + 1 AS INTEGER)), 1, 500) AS last_error
FROM f LEFT JOIN l ON l.source = f.source AND l.age = f.failed_age"""
    q["metric_alarms"] = CALLS + """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS period_start, 'APIErrorCount' AS metric, sum(1.0e0) AS sum_value
FROM calls WHERE NOT ok GROUP BY 1 HAVING count(*) > 2"""
    q["incremental_transform"] = TRADES + _newest(_UNIFIED, _USABLE)
    q["transform_invariants"] = TRADES + _TWO_RUNS + """
SELECT run_id, 'records read = transformed + rejected' AS invariant, read AS expected, usable + rejected AS actual,
  read = usable + rejected AS holds FROM runs
UNION ALL SELECT run_id, 'records transformed = staged', read - rejected, usable, read - rejected = usable FROM runs
UNION ALL SELECT run_id, 'written rows = distinct keys', new_keys, new_events, new_keys = new_events FROM runs
UNION ALL SELECT run_id, 'no watermark goes back or stays behind', 0, (SELECT count(*) FROM marks WHERE after < least),
  (SELECT count(*) FROM marks WHERE after < least) = 0 FROM runs
UNION ALL SELECT 'second', 'rows of the version = rows before + new keys', CAST((SELECT sum(new_keys) FROM runs) AS BIGINT),
  (SELECT count(*) FROM keys), (SELECT sum(new_keys) FROM runs) = (SELECT count(*) FROM keys)"""
    q["run_records"] = TRADES + _TWO_RUNS + """
SELECT run_id, 'success' AS status, 20 * (usable - keys) <= usable AS passed, read AS records_read, rejected AS records_rejected,
  usable AS records_transformed, new_keys AS records_written, usable AS batch_size, usable - keys AS duplicates_found,
  CASE run_id WHEN 'first' THEN 1 ELSE 2 END AS version, CASE WHEN 20 * (usable - keys) <= usable THEN '' ELSE 'duplicates' END AS issues,
  CASE run_id WHEN 'first' THEN 0 ELSE (SELECT count(*) FROM marks WHERE first_top >= coalesce(second_top, first_top)) END AS stale_products,
  0 AS broken FROM runs"""
    q["stream_curate"] = q["incremental_transform"]
    q["rebuilt"] = q["incremental_transform"]
    q["replay_after_rebuild"] = TRADES + f"""
SELECT count(DISTINCT (exchange, symbol, trade_id)) AS trades, CAST(2 AS BIGINT) AS version, 'duplicate_ratio,,' AS reasons
FROM trades WHERE {_USABLE}"""
    q["raw_files_again"] = q["raw_files"]
    q["catalog_table"] = TRADES + """
SELECT CAST(trade_ts AS DATE) AS trade_date, count(*) AS trades FROM trades GROUP BY 1"""
    q["product_list_file"] = q["listed_symbols"]
    q["mixed_folders"] = TRADES + f"""
SELECT exchange, symbol, trade_id, side, price, quantity, trade_ts,
  CASE WHEN trade_ts >= {_SPLIT} THEN ingest_ts END AS ingest_ts FROM trades"""
    q["storage_footprint"] = TRADES + """
SELECT count(DISTINCT CAST(trade_ts AS DATE)) AS dates, count(*) AS rows, TRUE AS files_fit, TRUE AS has_bytes FROM trades"""
    q["normalized_compat"] = TRADES + """
SELECT exchange, symbol, trade_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE side END AS side,
  CASE WHEN event_id % 5 = 0 THEN 0.0e0 ELSE price END AS price, quantity, trade_ts FROM trades"""
    q["normalized_other_source"] = TRADES + """
SELECT 'elsewhere' AS exchange, symbol, trade_id, side, price, quantity, trade_ts FROM trades"""
    q["stream_other_source"] = TRADES + _newest(_UNIFIED).replace("SELECT exchange,", "SELECT 'elsewhere' AS exchange,", 1)
    q["dedupe_null_keys"] = TRADES + f"""
, lost AS (SELECT * REPLACE (CASE WHEN event_id % 11 = 0 THEN NULL ELSE trade_id END AS trade_id) FROM trades),
ranked AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, trade_id
    ORDER BY trade_ts DESC, side, price, quantity, ingest_ts) AS rn FROM lost)
SELECT {_COLS}, CAST(2 AS BIGINT) AS version FROM ranked WHERE trade_id IS NULL OR rn = 1"""
    q["validation_offenders"] = TRADES + _GAPS + _GAP_MINUTES + f"""
, each AS (SELECT exchange, symbol, minutes, dups, date_sub('microsecond', last_ts, {NOW}) / 3.6e9 AS age
  FROM per_product LEFT JOIN longest USING (exchange, symbol))
SELECT 'long_gap' AS "check", exchange, symbol, round(minutes, 4) AS value FROM each WHERE minutes > 60
UNION ALL SELECT 'stale', exchange, symbol, round(age, 4) FROM each WHERE age > 2
UNION ALL SELECT 'duplicate_keys', exchange, symbol, CAST(dups AS DOUBLE) FROM each WHERE dups > 0"""
    for name in ("hourly_bars", "low_activity_periods", "daily_summary", "ingest_latency", "records_since_yesterday", "liveness"):
        q[f"{name}_curated"] = q[name]
    q["stream_watermarks"] = TRADES + f"""
SELECT exchange, symbol, max(n) AS cursor FROM trades WHERE {_USABLE} GROUP BY 1, 2"""
    q["stream_drop_repeats"] = TRADES + "SELECT DISTINCT exchange, symbol, trade_id FROM trades"
    return q
