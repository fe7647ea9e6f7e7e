"""Reference SQL for the registered queries (DuckDB dialect, plain views
``events`` etc.). Each string restates the query's semantics as the
reference's SQL models do; the Spark plans are written independently with
the DataFrame API."""

from __future__ import annotations

import re
from types import SimpleNamespace

# --- derived inputs (twins of ticklake.sources.derived) ---
BASE = """base AS (
  SELECT event_id, ts, value,
    CASE event_type WHEN 'click' THEN 'bitcoin' WHEN 'view' THEN 'ethereum' WHEN 'purchase' THEN 'solana' ELSE event_type END AS coin_id,
    CASE event_type WHEN 'click' THEN 'btc' WHEN 'view' THEN 'eth' WHEN 'purchase' THEN 'sol' ELSE event_type END AS symbol,
    CASE WHEN user_id % 2 = 0 THEN 'coingecko' ELSE 'binance' END AS source
  FROM events)"""


def _pct(new: str, base: str) -> str:
    """100 * (new - base) / base for DECIMAL(.., 8), rounded half up at 4 digits, in whole numbers."""
    d, b = (f"CAST(({x}) * 100000000 AS HUGEINT)" for x in (f"{new} - {base}", base))
    return (f"CASE WHEN {base} > 0 THEN CAST(sign({d}) * ((2 * abs({d}) * 1000000 + {b}) // (2 * {b})) AS DOUBLE) / 10000 END")


ASOF = "ref_time AS (SELECT max(ts) AS as_of FROM events)"

RAW = BASE + """,
dirty_one AS (
  SELECT event_id,
    CASE WHEN event_id % 83 = 0 THEN NULL ELSE coin_id END AS coin_id,
    CASE WHEN event_id % 5 = 0 THEN concat(' ', upper(source), ' ') ELSE source END AS source,
    CASE WHEN event_id % 7 = 0 THEN upper(symbol) ELSE symbol END AS symbol,
    CAST(CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 101 = 0 THEN -value ELSE value END AS DECIMAL(20,8)) AS price_usd,
    CAST(CASE WHEN source = 'coingecko' THEN value * 1000 END AS DECIMAL(30,2)) AS market_cap,
    CAST(CASE WHEN source = 'coingecko' THEN value / 100 END AS DECIMAL(10,4)) AS change_24h,
    CASE WHEN event_id % 103 = 0 THEN NULL ELSE date_trunc('millisecond', ts) END AS recorded_at
  FROM base),
raw AS (
  SELECT coin_id, source, symbol, price_usd, market_cap, change_24h, recorded_at FROM dirty_one
  UNION ALL
  SELECT coin_id, source, symbol, CAST(price_usd + 1 AS DECIMAL(20,8)), market_cap, change_24h, recorded_at
  FROM dirty_one WHERE event_id % 50 = 0)"""

STG = RAW + """,
stg AS (
  SELECT coin_id, lower(trim(source)) AS source, lower(trim(symbol)) AS symbol,
    CAST(price_usd AS DECIMAL(20,8)) AS price_usd, CAST(market_cap AS DECIMAL(30,2)) AS market_cap,
    CAST(change_24h AS DECIMAL(10,4)) AS change_24h, CAST(recorded_at AS TIMESTAMP) AS recorded_at
  FROM raw
  WHERE coin_id IS NOT NULL AND source IS NOT NULL AND price_usd IS NOT NULL AND price_usd > 0
    AND recorded_at IS NOT NULL)"""


def _distinct_on(src: str) -> str:
    return f"""SELECT coin_id, source, symbol, price_usd, market_cap, change_24h, recorded_at FROM (
    SELECT *, row_number() OVER (PARTITION BY coin_id, source, recorded_at
      ORDER BY price_usd ASC NULLS LAST, symbol ASC NULLS LAST, market_cap ASC NULLS LAST, change_24h ASC NULLS LAST) AS rn
    FROM {src}) WHERE rn = 1"""


CLEAN = STG + f""",
clean AS ({_distinct_on('stg')})"""

GOLD = CLEAN + ",\n" + ASOF + """,
lbs AS (
  SELECT coin_id, source, symbol, price_usd, market_cap, change_24h, last_recorded_at FROM (
    SELECT coin_id, source, symbol, price_usd, market_cap, change_24h, recorded_at AS last_recorded_at,
      row_number() OVER (PARTITION BY coin_id, source ORDER BY recorded_at DESC) AS rn
    FROM clean) WHERE rn = 1),
latest AS (
  SELECT coin_id, symbol, price_usd, market_cap, change_24h, last_recorded_at FROM (
    SELECT coin_id, symbol, price_usd, market_cap, change_24h, recorded_at AS last_recorded_at,
      row_number() OVER (PARTITION BY coin_id ORDER BY recorded_at DESC) AS rn
    FROM clean WHERE source = 'coingecko') WHERE rn = 1),
pivoted AS (
  SELECT coin_id, max(symbol) AS symbol,
    max(CASE WHEN source = 'coingecko' THEN price_usd END) AS coingecko_price_usd,
    max(CASE WHEN source = 'binance' THEN price_usd END) AS binance_price_usd,
    max(CASE WHEN source = 'coingecko' THEN last_recorded_at END) AS coingecko_at,
    max(CASE WHEN source = 'binance' THEN last_recorded_at END) AS binance_at
  FROM lbs GROUP BY coin_id),
cmp AS (
  SELECT coin_id, symbol, coingecko_price_usd, binance_price_usd, coingecko_at, binance_at,
    CAST(binance_price_usd - coingecko_price_usd AS DECIMAL(21,8)) AS spread_usd,
    """ + _pct("binance_price_usd", "coingecko_price_usd") + """ AS spread_pct
  FROM pivoted WHERE coingecko_price_usd IS NOT NULL AND binance_price_usd IS NOT NULL),
daily AS (
  SELECT coin_id, source, CAST(recorded_at AS DATE) AS price_date,
    CAST(round(avg(price_usd), 8) AS DOUBLE) AS avg_price_usd,
    max(price_usd) AS max_price_usd, min(price_usd) AS min_price_usd, count(*) AS sample_count
  FROM clean GROUP BY 1, 2, 3),
zv AS (
  SELECT 'raw' AS zone, source, count(*) AS row_count FROM raw
    WHERE recorded_at >= (SELECT as_of FROM ref_time) - INTERVAL 24 HOUR GROUP BY source
  UNION ALL
  SELECT 'silver', source, count(*) FROM clean
    WHERE recorded_at >= (SELECT as_of FROM ref_time) - INTERVAL 24 HOUR GROUP BY source
  UNION ALL
  SELECT 'gold_latest_by_source', source, count(*) FROM lbs GROUP BY source),
fresh AS (
  SELECT source, last_recorded_at AS last_event_at,
    round(CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(last_recorded_at) AS DOUBLE) / 60000000.0, 1) AS minutes_stale,
    CASE WHEN CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(last_recorded_at) AS DOUBLE) / 60000000.0 <= 10 THEN 'OK'
         WHEN CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(last_recorded_at) AS DOUBLE) / 60000000.0 <= 30 THEN 'WARN'
         ELSE 'FAIL' END AS sla_status
  FROM lbs),
sanity AS (
  SELECT 'mart_latest_prices' AS mart, count(*) AS total_rows,
    count(*) FILTER (WHERE price_usd IS NULL) AS null_prices,
    count(*) FILTER (WHERE price_usd <= 0) AS non_positive_prices
  FROM latest
  UNION ALL
  SELECT 'mart_source_price_comparison', count(*),
    count(*) FILTER (WHERE coingecko_price_usd IS NULL OR binance_price_usd IS NULL),
    count(*) FILTER (WHERE coingecko_price_usd <= 0 OR binance_price_usd <= 0)
  FROM cmp)"""

CHANGES_SELECT = """SELECT coin_id, source, symbol, price_usd, market_cap, change_24h, recorded_at, prev_price_usd,
  CAST(price_usd - prev_price_usd AS DECIMAL(21,8)) AS price_change_usd, """ + _pct("price_usd", "prev_price_usd") + """ AS price_change_pct
FROM (SELECT *, lag(price_usd) OVER (PARTITION BY coin_id, source ORDER BY recorded_at) AS prev_price_usd FROM clean)"""


def _w(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def oracle() -> dict[str, str]:
    sel_clean = "SELECT coin_id, source, symbol, price_usd, market_cap, change_24h, recorded_at"
    q = {
        "stg_prices": _w(STG, "SELECT * FROM stg"),
        "silver_clean": _w(CLEAN, "SELECT * FROM clean"),
        "silver_incremental": _w(STG + ",\n" + ASOF + f""",
first_load AS ({_distinct_on("(SELECT * FROM stg WHERE recorded_at < (SELECT as_of FROM ref_time) - INTERVAL 7 DAY)")}),
fresh AS ({_distinct_on("(SELECT * FROM stg WHERE recorded_at > (SELECT coalesce(max(recorded_at), TIMESTAMP '1970-01-01') FROM first_load))")})""",
            f"""{sel_clean} FROM first_load
WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.coin_id = first_load.coin_id AND f.source = first_load.source AND f.recorded_at = first_load.recorded_at)
UNION ALL {sel_clean} FROM fresh"""),
        "silver_late_arrivals": _w(STG + f""",
first_load AS ({_distinct_on("(SELECT * FROM stg WHERE source = 'coingecko')")}),
fresh AS ({_distinct_on("(SELECT * FROM stg WHERE recorded_at > (SELECT coalesce(max(recorded_at), TIMESTAMP '1970-01-01') FROM first_load))")})""",
            f"""{sel_clean} FROM first_load
WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.coin_id = first_load.coin_id AND f.source = first_load.source AND f.recorded_at = first_load.recorded_at)
UNION ALL {sel_clean} FROM fresh"""),
        "silver_column_sync": _w(STG + ",\n" + ASOF + f""",
run1 AS ({_distinct_on("(SELECT * FROM stg WHERE recorded_at < (SELECT as_of FROM ref_time) - INTERVAL 14 DAY)")}),
run2 AS ({_distinct_on("(SELECT * FROM stg WHERE recorded_at < (SELECT as_of FROM ref_time) - INTERVAL 7 DAY AND recorded_at > (SELECT max(recorded_at) FROM run1))")}),
run3 AS ({_distinct_on("(SELECT * FROM stg WHERE recorded_at > (SELECT max(recorded_at) FROM (SELECT * FROM run1 UNION ALL SELECT * FROM run2)))")})""",
            """SELECT *, CAST(NULL AS VARCHAR) AS venue, CAST(NULL AS BIGINT) AS grade FROM run1
UNION ALL SELECT *, upper(source), CAST(NULL AS BIGINT) FROM run2
UNION ALL SELECT *, upper(source), CAST(floor(price_usd) AS BIGINT) % 10 FROM run3"""),
        "latest_prices": _w(GOLD, "SELECT * FROM latest"),
        "latest_by_source": _w(GOLD, "SELECT * FROM lbs"),
        "source_comparison": _w(GOLD, "SELECT * FROM cmp"),
        "daily_prices": _w(GOLD, "SELECT * FROM daily"),
        "price_changes": _w(CLEAN, CHANGES_SELECT),
        "price_changes_plain": _w(CLEAN, CHANGES_SELECT),
        "zone_volume": _w(GOLD, "SELECT * FROM zv"),
        "freshness": _w(GOLD, "SELECT * FROM fresh"),
        "freshness_rollup": _w(GOLD, """SELECT source, last_recorded_at AS last_event_at,
    round(CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(last_recorded_at) AS DOUBLE) / 60000000.0, 1) AS minutes_stale,
    CASE WHEN CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(last_recorded_at) AS DOUBLE) / 60000000.0 <= 10 THEN 'OK'
         WHEN CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(last_recorded_at) AS DOUBLE) / 60000000.0 <= 30 THEN 'WARN'
         ELSE 'FAIL' END AS sla_status
  FROM (SELECT source, max(last_recorded_at) AS last_recorded_at FROM lbs GROUP BY source)"""),
        "gold_sanity": _w(GOLD, "SELECT * FROM sanity"),
        "bi_price_comparison": _w(GOLD, """SELECT coin_id, symbol, coingecko_price_usd, binance_price_usd, spread_usd,
  spread_pct, coingecko_at, binance_at FROM cmp ORDER BY coin_id"""),
        "bi_latest_by_source": _w(GOLD, """SELECT coin_id, source, symbol, price_usd, change_24h, last_recorded_at
  FROM lbs ORDER BY coin_id, source"""),
        "bi_latest_coingecko": _w(GOLD, """SELECT coin_id, symbol, price_usd, market_cap, change_24h, last_recorded_at
  FROM latest ORDER BY coin_id"""),
        "bi_daily_avg": _w(GOLD, "SELECT price_date, coin_id, source, avg_price_usd FROM daily ORDER BY price_date, coin_id, source"),
        "bi_spread_ranking": _w(GOLD, "SELECT coin_id, symbol, spread_pct, spread_usd FROM cmp ORDER BY spread_pct DESC NULLS LAST"),
        "bi_zone_volume": _w(GOLD, "SELECT zone, source, row_count FROM zv ORDER BY zone, source"),
        "bi_sanity": _w(GOLD, "SELECT mart, total_rows, null_prices, non_positive_prices FROM sanity"),
        "bi_freshness": _w(GOLD, "SELECT source, last_event_at, minutes_stale, sla_status FROM fresh ORDER BY source"),
        "bi_source_gap": _w(GOLD, """SELECT coin_id, coingecko_at, binance_at,
  round(CAST(epoch_us(coingecko_at) - epoch_us(binance_at) AS DOUBLE) / 60000000.0, 1) AS coingecko_minus_binance_minutes
  FROM cmp ORDER BY coin_id"""),
        "bi_ops_latest": _w(GOLD, "SELECT coin_id, price_usd, change_24h, last_recorded_at FROM latest ORDER BY coin_id"),
    }
    q.update(edge_oracle())
    q.update(quality_oracle())
    q.update(sinks_oracle())
    q.update(ops_oracle())
    q.update(misc_oracle())
    q["stream_throttled"] = _throttle_sql(600)
    q["stream_dlq_monitor"] = q["dlq_counts"]
    q["stream_progress"] = _w(LOG, """SELECT count(*) AS input_rows, count(*) AS messages,
  count(*) FILTER (WHERE topic = 'coingecko.prices.raw') AS snapshot_messages,
  count(*) FILTER (WHERE topic = 'binance.trades.raw') AS trade_messages, CAST(0 AS BIGINT) AS offsets_behind FROM log""")
    q.update(event_time_oracle())
    q["stream_dead_letters"] = _w(LOG, """SELECT topic AS source_topic, raw_value, reason,
  date_trunc('millisecond', kafka_ts) AS failed_at FROM classified WHERE reason IS NOT NULL""")
    q["stream_raw"] = _w(UNIFIED_IDS, """SELECT coin_id, source, symbol, CAST(price_usd AS DECIMAL(20,8)) AS price_usd,
    CAST(market_cap AS DECIMAL(30,2)) AS market_cap, CAST(change_24h AS DECIMAL(10,4)) AS change_24h, recorded_at, dt
  FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, source, recorded_at, dt
          ORDER BY date_trunc('millisecond', kafka_ts) DESC, event_id DESC) AS rn
        FROM uid) WHERE rn = 1""")
    for name, n in (("throttled_ticks", 600), ("throttled_ticks_blocks", 600), ("throttled_ticks_hourly", 3600)):
        q[name] = _throttle_sql(n)
    return q


# --- stream edge: JSON log, contract, normalisers, dead letters ---
LOG = BASE + r""",
log AS (
  SELECT event_id, source AS feed,
    CASE WHEN source = 'coingecko' THEN 'coingecko.prices.raw' ELSE 'binance.trades.raw' END AS topic,
    ts AS kafka_ts,
    CASE WHEN event_id % 61 = 0 THEN '["late", 0, {}]' WHEN event_id % 59 = 0 THEN '<frame cut' ELSE concat('{',
      CASE WHEN event_id % 13 = 0 THEN '' ELSE concat('"coin_id": "', coin_id, '", ') END,
      '"symbol": "', symbol, '", ',
      '"price_usd": ', CASE WHEN event_id % 17 = 0 THEN 'null' WHEN event_id % 19 = 0 THEN '"n/a"'
        WHEN event_id % 23 = 0 THEN '"12.5"' WHEN event_id % 67 = 0 THEN '"NaN"' WHEN event_id % 71 = 0 THEN '"1e30"' WHEN event_id % 2 = 0 THEN CAST(event_id % 500 + 1 AS VARCHAR)
        ELSE concat(CAST(event_id % 500 + 1 AS VARCHAR), '.25') END, ', ',
      CASE WHEN event_id % 29 = 0 THEN '' ELSE concat('"event_time": "', substring(CAST(ts AS VARCHAR), 1, 10), 'T',
        substring(CAST(ts AS VARCHAR), 12, 8),
        CASE WHEN event_id % 31 = 0 THEN '' ELSE concat('.', lpad(CAST(event_id % 1000000 AS VARCHAR), 6, '0')) END,
        CASE WHEN event_id % 37 = 0 THEN 'Z' WHEN event_id % 41 = 0 THEN '+02:00' ELSE '+00:00' END, '", ') END,
      '"market_cap": null, "change_24h": null',
      CASE WHEN event_id % 43 = 0 THEN '' ELSE concat(', "source": "', source, '"') END,
      CASE WHEN event_id % 47 = 0 THEN ', "extra": 1' ELSE '' END,
      CASE WHEN event_id % 53 = 0 THEN '' ELSE '}' END) END AS raw_value
  FROM base),
lj AS (SELECT *, coalesce(json_valid(raw_value), false) AS ok FROM log),
lf AS (
  SELECT *,
    CASE WHEN ok AND json_type(raw_value, '$.coin_id') NOT IN ('OBJECT', 'ARRAY') THEN json_extract_string(raw_value, '$.coin_id') END AS coin_text,
    CASE WHEN ok AND json_type(raw_value, '$.symbol') NOT IN ('OBJECT', 'ARRAY') THEN json_extract_string(raw_value, '$.symbol') END AS symbol_text,
    CASE WHEN ok AND json_type(raw_value, '$.source') NOT IN ('OBJECT', 'ARRAY') THEN json_extract_string(raw_value, '$.source') END AS source_text,
    TRY_CAST(CASE WHEN ok AND json_type(raw_value, '$.price_usd') NOT IN ('OBJECT', 'ARRAY') THEN json_extract_string(raw_value, '$.price_usd') END AS DOUBLE) AS price_num,
    TRY_CAST(CASE WHEN ok AND json_type(raw_value, '$.market_cap') NOT IN ('OBJECT', 'ARRAY') THEN json_extract_string(raw_value, '$.market_cap') END AS DOUBLE) AS cap_num,
    TRY_CAST(CASE WHEN ok AND json_type(raw_value, '$.change_24h') NOT IN ('OBJECT', 'ARRAY') THEN json_extract_string(raw_value, '$.change_24h') END AS DOUBLE) AS change_num,
    CASE WHEN ok AND json_type(raw_value, '$.event_time') NOT IN ('OBJECT', 'ARRAY') THEN json_extract_string(raw_value, '$.event_time') END AS time_text
  FROM lj),
lt AS (
  SELECT *, CASE WHEN regexp_matches(regexp_replace(time_text, '([+-][0-9]{2}:[0-9]{2})$', ''), '\.[0-9]{6}$')
    THEN try_strptime(regexp_replace(time_text, '([+-][0-9]{2}:[0-9]{2})$', ''), '%Y-%m-%dT%H:%M:%S.%f') END AS event_ts
  FROM lf),
classified AS (
  SELECT *,
    CASE WHEN coin_text IS NULL THEN 'invalid_json_or_missing_coin_id'
         WHEN price_num IS NULL THEN 'missing_or_invalid_price_usd'
         WHEN time_text IS NULL THEN 'missing_event_time' END AS reason_compat,
    CASE WHEN coin_text IS NULL THEN 'invalid_json_or_missing_coin_id'
         WHEN price_num IS NULL OR isnan(price_num) OR abs(price_num) >= 1e12 THEN 'missing_or_invalid_price_usd'
         WHEN time_text IS NULL THEN 'missing_event_time'
         WHEN event_ts IS NULL THEN 'unparseable_event_time' END AS reason
  FROM lt),
unified AS (
  SELECT feed, coin_text AS coin_id, coalesce(source_text, feed) AS source, symbol_text AS symbol, price_num AS price_usd,
    cap_num AS market_cap, change_num AS change_24h, date_trunc('millisecond', event_ts) AS recorded_at,
    strftime(event_ts, '%Y-%m-%d') AS dt
  FROM lt WHERE event_ts IS NOT NULL AND coin_text IS NOT NULL AND price_num IS NOT NULL AND NOT isnan(price_num) AND abs(price_num) < 1e12)"""

_NUM = "('BIGINT', 'UBIGINT', 'DOUBLE')"
CONTRACT = LOG + rf""",
cv AS (
  SELECT event_id, feed, CASE WHEN ok AND json_type(raw_value) = 'OBJECT' THEN list_concat(
    list_transform(list_filter(['coin_id', 'symbol', 'price_usd', 'event_time', 'source'],
      lambda k: NOT list_contains(json_keys(raw_value), k)), lambda k: 'missing:' || k),
    list_transform(list_filter(json_keys(raw_value),
      lambda k: NOT list_contains(['coin_id', 'symbol', 'price_usd', 'market_cap', 'change_24h', 'event_time', 'source'], k)),
      lambda k: 'extra:' || k),
    list_filter([
      CASE WHEN json_type(raw_value, '$.coin_id') IS NOT NULL AND NOT coalesce(json_type(raw_value, '$.coin_id') = 'VARCHAR'
        AND json_extract_string(raw_value, '$.coin_id') IN ('bitcoin', 'ethereum', 'solana'), false) THEN 'coin_id' END,
      CASE WHEN json_type(raw_value, '$.symbol') IS NOT NULL AND NOT coalesce(json_type(raw_value, '$.symbol') = 'VARCHAR'
        AND length(json_extract_string(raw_value, '$.symbol')) BETWEEN 2 AND 8, false) THEN 'symbol' END,
      CASE WHEN json_type(raw_value, '$.price_usd') IS NOT NULL AND NOT coalesce(json_type(raw_value, '$.price_usd') IN {_NUM}
        AND TRY_CAST(json_extract(raw_value, '$.price_usd') AS DOUBLE) > 0, false) THEN 'price_usd' END,
      CASE WHEN json_type(raw_value, '$.market_cap') IS NOT NULL AND NOT (json_type(raw_value, '$.market_cap') IN {_NUM}
        OR json_type(raw_value, '$.market_cap') = 'NULL') THEN 'market_cap' END,
      CASE WHEN json_type(raw_value, '$.change_24h') IS NOT NULL AND NOT (json_type(raw_value, '$.change_24h') IN {_NUM}
        OR json_type(raw_value, '$.change_24h') = 'NULL') THEN 'change_24h' END,
      CASE WHEN json_type(raw_value, '$.event_time') IS NOT NULL AND json_type(raw_value, '$.event_time') <> 'VARCHAR' THEN 'event_time' END,
      CASE WHEN json_type(raw_value, '$.source') IS NOT NULL AND NOT coalesce(json_type(raw_value, '$.source') = 'VARCHAR'
        AND json_extract_string(raw_value, '$.source') IN ('coingecko', 'binance'), false) THEN 'source' END
    ], lambda x: x IS NOT NULL)) ELSE ['not_an_object'] END AS violations
  FROM lj)"""

SNAPSHOTS = BASE + r""",
snap AS (
  SELECT event_id AS poll_id, ts AS received_at, concat('{', '"', coin_id, '": {',
    CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN '"usd": 0, ' ELSE concat('"usd": ', printf('%.2f', value), ', ') END,
    '"usd_market_cap": ', CASE WHEN event_id % 31 = 0 THEN '"12"' ELSE printf('%.2f', value * 1000) END,
    ', "usd_24h_change": ', CASE WHEN event_id % 3 = 0 THEN 'null' WHEN event_id % 37 = 0 THEN 'true' ELSE printf('%.6f', value / 100) END, '}',
    ', "tether": {"usd": 1.0, "usd_market_cap": null, "usd_24h_change": ', CAST(event_id % 7 AS VARCHAR), '}', '}') AS payload
  FROM base),
ent AS (SELECT poll_id, received_at, payload, unnest(json_keys(payload)) AS coin_id FROM snap
        WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'),
entq AS (SELECT poll_id, received_at, coin_id, json_extract(payload, concat('$."', coin_id, '"')) AS q FROM ent),
snap_ev AS (
  SELECT poll_id, coin_id,
    coalesce(CASE coin_id WHEN 'bitcoin' THEN 'btc' WHEN 'ethereum' THEN 'eth' WHEN 'solana' THEN 'sol' END, coin_id) AS symbol,
    TRY_CAST(json_extract_string(q, '$.usd') AS DOUBLE) AS price_usd,
    TRY_CAST(json_extract_string(q, '$.usd_market_cap') AS DOUBLE) AS market_cap,
    CASE json_extract_string(q, '$.usd_24h_change') WHEN 'true' THEN 1.0 ELSE TRY_CAST(json_extract_string(q, '$.usd_24h_change') AS DOUBLE) END AS change_24h,
    coalesce(json_type(q, '$.usd_market_cap') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'NULL'), true) AS cap_ok,
    coalesce(json_type(q, '$.usd_24h_change') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'NULL'), true) AS change_ok,
    strftime(received_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time,
    'coingecko' AS source,
    json_type(q, '$.usd') IN ('BIGINT', 'UBIGINT', 'DOUBLE') AS usd_is_number
  FROM entq WHERE json_type(q, '$.usd') IS NOT NULL AND json_type(q, '$.usd') <> 'NULL')"""

TRADES = BASE + r""",
tr0 AS (
  SELECT event_id, ts,
    CASE WHEN event_id % 7 = 0 THEN lower(upper(symbol) || 'USDT') ELSE upper(symbol) || 'USDT' END AS pair,
    CASE WHEN event_id % 9 = 0 THEN epoch_us(ts) // 1000 - (epoch_us(ts) // 1000) % 1000 ELSE epoch_us(ts) // 1000 END AS ms,
    value
  FROM base),
tr1 AS (
  SELECT event_id, concat('{"e": "', CASE WHEN event_id % 11 = 0 THEN 'depthUpdate' ELSE 'trade' END,
    '", "s": "', pair, '", "p": "', CASE WHEN event_id % 17 = 0 THEN 'abc' ELSE printf('%.2f', value) END, '"',
    CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 19 = 0 THEN concat(', "T": "', CAST(ms AS VARCHAR), '"')
      ELSE concat(', "T": ', CAST(ms AS VARCHAR)) END, '}') AS trade, pair
  FROM tr0),
frames AS (
  SELECT event_id AS frame_id,
    CASE WHEN event_id % 3 = 0 THEN concat('{"stream": "', lower(pair), '@trade", "data": ', trade, '}') ELSE trade END AS payload
  FROM tr1),
unwrapped AS (
  SELECT frame_id, CASE WHEN json_type(payload, '$.data') = 'OBJECT' THEN json_extract(payload, '$.data') ELSE payload END AS t
  FROM frames WHERE json_valid(payload)),
tr_ev AS (
  SELECT frame_id,
    CASE upper(json_extract_string(t, '$.s')) WHEN 'BTCUSDT' THEN 'bitcoin' WHEN 'ETHUSDT' THEN 'ethereum' WHEN 'SOLUSDT' THEN 'solana' END AS coin_id,
    CASE upper(json_extract_string(t, '$.s')) WHEN 'BTCUSDT' THEN 'btc' WHEN 'ETHUSDT' THEN 'eth' WHEN 'SOLUSDT' THEN 'sol' END AS symbol,
    TRY_CAST(trim(json_extract_string(t, '$.p')) AS DOUBLE) AS price_usd,
    CAST(NULL AS DOUBLE) AS market_cap, CAST(NULL AS DOUBLE) AS change_24h,
    strftime(epoch_ms(TRY_CAST(json_extract_string(t, '$.T') AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time,
    'binance' AS source, json_extract_string(t, '$.e') AS e,
    CASE WHEN json_type(t, '$.T') IN ('BIGINT', 'UBIGINT') THEN TRY_CAST(json_extract_string(t, '$.T') AS BIGINT) END AS ms
  FROM unwrapped)"""


def _typed_violations() -> str:
    return """array_to_string(list_filter([
      CASE WHEN NOT coalesce(coin_id IN ('bitcoin', 'ethereum', 'solana'), false) THEN 'coin_id' END,
      CASE WHEN NOT coalesce(length(symbol) BETWEEN 2 AND 8, false) THEN 'symbol' END,
      CASE WHEN NOT coalesce(price_usd > 0 AND NOT isnan(price_usd), false) THEN 'price_usd' END,
      CASE WHEN event_time IS NULL THEN 'event_time' END,
      CASE WHEN NOT coalesce(source IN ('coingecko', 'binance'), false) THEN 'source' END], lambda x: x IS NOT NULL)"""


def edge_oracle() -> dict[str, str]:
    ev_cols = "coin_id, symbol, price_usd, market_cap, change_24h, event_time, source"
    return {
        "unified_prices": _w(LOG, """SELECT coin_id, source, symbol, price_usd, market_cap, change_24h, recorded_at, dt
  FROM unified"""),
        "dead_letters": _w(LOG, """SELECT topic AS source_topic, raw_value, reason, kafka_ts AS failed_at
  FROM classified WHERE reason IS NOT NULL"""),
        "dead_letters_compat": _w(LOG, """SELECT topic AS source_topic, raw_value, reason_compat AS reason, kafka_ts AS failed_at
  FROM classified WHERE reason_compat IS NOT NULL"""),
        "dlq_counts": _w(LOG, """SELECT topic AS source_topic, reason, count(*) AS messages
  FROM classified WHERE reason IS NOT NULL GROUP BY 1, 2"""),
        "validity_split": _w(LOG, """SELECT feed, count(*) AS input_rows,
  count(*) FILTER (WHERE reason IS NULL) AS accepted_rows,
  count(*) FILTER (WHERE reason IS NOT NULL) AS rejected_rows,
  (SELECT count(*) FROM unified u WHERE u.feed = c.feed) AS unified_rows
  FROM classified c GROUP BY feed"""),
        "contract_violations": _w(CONTRACT, """SELECT event_id, feed, len(violations) = 0 AS is_valid,
  array_to_string(violations, ',') AS violations FROM cv"""),
        "contract_rule_counts": _w(CONTRACT, """SELECT rule, count(*) AS messages
  FROM (SELECT unnest(violations) AS rule FROM cv) GROUP BY rule"""),
        "normalize_snapshot": _w(SNAPSHOTS, f"""SELECT poll_id, {ev_cols},
  array_to_string(list_concat(list_filter([
      CASE WHEN NOT coalesce(coin_id IN ('bitcoin', 'ethereum', 'solana'), false) THEN 'coin_id' END,
      CASE WHEN NOT coalesce(length(symbol) BETWEEN 2 AND 8, false) THEN 'symbol' END,
      CASE WHEN NOT coalesce(price_usd > 0 AND NOT isnan(price_usd), false) THEN 'price_usd' END,
      CASE WHEN event_time IS NULL THEN 'event_time' END,
      CASE WHEN NOT coalesce(source IN ('coingecko', 'binance'), false) THEN 'source' END], lambda x: x IS NOT NULL),
    list_concat(CASE WHEN usd_is_number THEN [] ELSE ['price_usd:type'] END, list_concat(
      CASE WHEN cap_ok THEN [] ELSE ['market_cap:type'] END, CASE WHEN change_ok THEN [] ELSE ['change_24h:type'] END))), ',') AS violations
  FROM snap_ev"""),
        "normalize_trades": _w(TRADES, f"""SELECT frame_id, {ev_cols},
  {_typed_violations()}, ',') AS violations
  FROM tr_ev WHERE e = 'trade' AND coin_id IS NOT NULL AND ms IS NOT NULL"""),
    }


def _throttle_sql(seconds: int) -> str:
    """Sequential definition as a recursive CTE: from the first tick of a
    key, the next kept tick is the first at or after last kept + N."""
    return "WITH RECURSIVE " + BASE + f""",
t AS (SELECT event_id, coin_id, ts FROM base),
kept(coin_id, ts) AS (
  SELECT coin_id, min(ts) FROM t GROUP BY coin_id
  UNION ALL
  SELECT t.coin_id, min(t.ts) FROM kept JOIN t ON t.coin_id = kept.coin_id
    AND t.ts >= kept.ts + INTERVAL {int(seconds)} SECOND GROUP BY t.coin_id)
SELECT t.event_id, t.coin_id, t.ts FROM t JOIN kept ON t.coin_id = kept.coin_id AND t.ts = kept.ts"""


# --- quality results ---------------------------------------------------------

def _lit_list(values) -> str:
    return ", ".join("'" + str(v) + "'" for v in values)


def _rule_sql(zone: str, rel: str, rule) -> str:
    head = f"'{zone}' AS zone, '{rule.kind}' AS check_name, '{','.join(rule.columns)}' AS column_name"
    if rule.kind == "unique":
        cols = ", ".join(rule.columns)
        cond = "n > 1" + (f" AND {rule.columns[0]} IS NOT NULL" if len(rule.columns) == 1 else "")
        failed = f"(SELECT count(*) FROM (SELECT {cols}, count(*) AS n FROM {rel} GROUP BY {cols}) g WHERE {cond})"
        return (f"SELECT {head}, {failed} AS failed_rows, (SELECT count(*) FROM {rel}) AS total_rows, "
                f"{failed} = 0 AND (SELECT count(*) FROM {rel}) > 0 AS success")
    c = rule.columns[0] if rule.columns else None
    t = rule.threshold
    if rule.kind == "not_null":
        failed = f"count(*) FILTER (WHERE {c} IS NULL)"
        ok = f"{failed} = 0"
    elif rule.kind == "accepted_values":
        failed = f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({_lit_list(rule.values)}))"
        ok = f"{failed} = 0"
    elif rule.kind == "min_gt":
        failed = f"count(*) FILTER (WHERE {c} <= {t})"
        ok = f"coalesce(min({c}) > {t}, false)"
    elif rule.kind == "row_count_min":
        failed = f"CAST(CASE WHEN count(*) < {t} THEN 1 ELSE 0 END AS BIGINT)"
        ok = f"count(*) >= {t}"
    elif rule.kind == "row_count_eq":
        failed = f"CAST(CASE WHEN count(*) <> {t} THEN 1 ELSE 0 END AS BIGINT)"
        ok = f"count(*) = {t}"
    elif rule.kind == "freshness":
        age = f"CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(max({c})) AS DOUBLE) / 60000000.0"
        ok = f"coalesce({age} <= {t}, false)"
        failed = f"CAST(CASE WHEN {ok} THEN 0 ELSE 1 END AS BIGINT)"
    else:
        raise ValueError(rule.kind)
    return f"SELECT {head}, {failed} AS failed_rows, count(*) AS total_rows, ({ok}) AND count(*) > 0 AS success FROM {rel}"


QUALITY = GOLD + f""",
changes AS ({CHANGES_SELECT}),
raw_24h AS (SELECT * FROM raw WHERE recorded_at >= (SELECT as_of FROM ref_time) - INTERVAL 24 HOUR),
silver_24h AS (SELECT * FROM clean WHERE recorded_at >= (SELECT as_of FROM ref_time) - INTERVAL 24 HOUR),
latest_as_ts AS (SELECT coin_id, symbol, price_usd, market_cap, change_24h, last_recorded_at AS recorded_at FROM latest),
comparison AS (SELECT * FROM cmp),
latest_by_source AS (SELECT * FROM lbs)"""


# every suite's rules written out: `zone @ relation: rule; ...` with column!, column in (...), column > n, rows >= n, rows = n,
# unique(...) and column within n (minutes)
_COINS, _FEEDS = "bitcoin|ethereum|solana", "coingecko|binance"
_SUITES = f"""
raw @ raw_24h: rows >= 1; coin_id!; price_usd!; coin_id in {_COINS}; price_usd > 0; unique(coin_id,source,recorded_at); source in {_FEEDS}; recorded_at!; recorded_at within 10
silver @ silver_24h: rows >= 1; coin_id!; price_usd!; coin_id in {_COINS}; price_usd > 0; unique(coin_id,source,recorded_at); source in {_FEEDS}; recorded_at!
gold @ latest_as_ts: rows >= 1; coin_id!; price_usd!; coin_id in {_COINS}; price_usd > 0; recorded_at!; rows = 3
gold_comparison @ comparison: rows >= 1
"""
_MODELS = f"""
source:raw.crypto_prices @ raw: coin_id!; coin_id in {_COINS}; source!; source in {_FEEDS}; price_usd!; recorded_at!
model:stg_crypto_prices @ stg: coin_id!; coin_id in {_COINS}; source!; source in {_FEEDS}; price_usd!; recorded_at!
model:crypto_prices_clean @ clean: unique(coin_id,source,recorded_at); coin_id!; source!; price_usd!; recorded_at!
model:mart_latest_prices @ latest: coin_id!; unique(coin_id); coin_id in {_COINS}; price_usd!; last_recorded_at!
model:mart_latest_prices_by_source @ latest_by_source: unique(coin_id,source); coin_id!; source!; source in {_FEEDS}
model:mart_source_price_comparison @ comparison: coin_id!; unique(coin_id); coingecko_price_usd!; binance_price_usd!
model:mart_daily_prices @ daily: unique(coin_id,source,price_date); sample_count!
model:fct_price_changes @ changes: coin_id!; source!; recorded_at!
"""


def _written(rule: str) -> SimpleNamespace:
    kinds = [("not_null", r"(\w+)!"), ("accepted_values", r"(\w+) in (.+)"), ("min_gt", r"(\w+) > (\d+)"), ("row_count_min", r"()rows >= (\d+)"),
             ("row_count_eq", r"()rows = (\d+)"), ("unique", r"unique\((.+)\)"), ("freshness", r"(\w+) within (\d+)")]
    for kind, pattern in kinds:
        m = re.fullmatch(pattern, rule)
        if m:
            more = m[2] if m.re.groups > 1 else ""
            return SimpleNamespace(kind=kind, columns=tuple(m[1].split(",")) if m[1] else (), values=tuple(more.split("|")),
                                   threshold=int(more) if more.isdigit() else None)
    raise ValueError(rule)


def _rules(text: str) -> list[str]:
    out = []
    for line in text.strip().split("\n"):
        head, rules = line.split(": ", 1)
        zone, relation = head.split(" @ ")
        out += [_rule_sql(zone, relation, _written(r)) for r in rules.split("; ")]
    return out


def quality_oracle() -> dict[str, str]:
    parts = _rules(_SUITES + _MODELS.lstrip())
    vol = """SELECT 'raw' AS zone, s.source, coalesce(n, 0) AS row_count, coalesce(n, 0) >= 1 AS success
  FROM (VALUES ('coingecko'), ('binance')) s(source)
  LEFT JOIN (SELECT source, count(*) AS n FROM raw_24h GROUP BY source) c ON c.source = s.source"""
    cov = """SELECT 'raw' AS zone, s.source, coalesce(k, 0) AS coins_seen,
    array_to_string(list_filter(['bitcoin', 'ethereum', 'solana'], lambda x: NOT list_contains(coalesce(seen, []), x)), ',') AS missing_coins,
    coalesce(k, 0) = 3 AS success
  FROM (VALUES ('coingecko'), ('binance')) s(source)
  LEFT JOIN (SELECT source, count(DISTINCT coin_id) AS k, list(DISTINCT coin_id) AS seen FROM raw_24h
             WHERE coin_id IN ('bitcoin', 'ethereum', 'solana') GROUP BY source) c ON c.source = s.source"""
    model_parts = _rules(_MODELS)
    feeds = f"""SELECT zone, 'source_volume' AS check_name, source AS column_name, CAST(NOT success AS BIGINT) AS failed_rows,
    row_count AS total_rows, success FROM ({vol})
  UNION ALL
  SELECT zone, 'coin_coverage', source, 3 - coins_seen, 3, success FROM ({cov})"""
    parts.append(feeds)
    marts = {"latest": "latest", "latest_by_source": "lbs", "comparison": "cmp", "daily": "daily", "changes": "changes",
             "freshness": "fresh", "zone_volume": "zv"}
    return {
        "dq_gate": _w(QUALITY, "SELECT zone, count(*) AS checks, count(*) FILTER (WHERE NOT success) AS failed_checks, "
                      "bool_and(success) AS passed FROM (" + "\nUNION ALL\n".join(parts) + ") GROUP BY zone"),
        "mart_counts": _w(QUALITY, "\nUNION ALL\n".join(f"SELECT '{m}' AS mart, count(*) AS n_rows FROM {t}" for m, t in marts.items())),
        "model_run_tests": _w(QUALITY, "\nUNION ALL\n".join(model_parts)),
        "dq_results": _w(QUALITY, "\nUNION ALL\n".join(parts)),
        "source_volume": _w(QUALITY, vol),
        "coin_coverage": _w(QUALITY, cov),
    }


# --- sinks, lake, backfills ----------------------------------------------------

UNIFIED_IDS = LOG + ",\n" + ASOF + """,
uid AS (
  SELECT event_id, topic, kafka_ts, coin_text AS coin_id, coalesce(source_text, feed) AS source, symbol_text AS symbol,
    price_num AS price_usd, cap_num AS market_cap, change_num AS change_24h,
    date_trunc('millisecond', event_ts) AS recorded_at, strftime(event_ts, '%Y-%m-%d') AS dt
  FROM lt WHERE event_ts IS NOT NULL AND coin_text IS NOT NULL AND price_num IS NOT NULL AND NOT isnan(price_num) AND abs(price_num) < 1e12)"""

# arrival of each record, its file (a batch), and its event time where it is accepted (NULL else)
def _arrivals(copies: bool) -> str:
    again = """
  UNION ALL SELECT event_id, event_id + (SELECT n // 20 FROM size) FROM log WHERE event_id % 50 = 0""" if copies else ""
    return UNIFIED_IDS + f""",
size AS (SELECT max(event_id) + 1 AS n FROM events),
arr AS (SELECT event_id, event_id + CASE WHEN event_id % 41 = 0 THEN n // 2 WHEN event_id % 37 = 0 THEN n // 10 ELSE 0 END AS arrival FROM log, size{again}),
filed AS (SELECT a.event_id, CAST(floor((arrival - lo) * 5 / CAST(hi - lo + 1 AS DOUBLE)) AS BIGINT) AS f, u.recorded_at, u.source, u.coin_id, u.dt
  FROM arr a CROSS JOIN (SELECT min(arrival) AS lo, max(arrival) AS hi FROM arr) LEFT JOIN uid u ON u.event_id = a.event_id),
-- the newest event time of the files before, and of those before the last but one
mark AS (SELECT k AS f, (SELECT max(recorded_at) FROM filed WHERE f < k) - INTERVAL 15 SECOND AS wm,
                (SELECT max(recorded_at) FROM filed WHERE f < k - 1) - INTERVAL 15 SECOND AS late_wm,
                (SELECT max(recorded_at) FROM filed WHERE f <= k) - INTERVAL 15 SECOND AS after FROM range(0, 5) r(k))"""


def event_time_oracle() -> dict[str, str]:
    kept = """,
timely AS (SELECT filed.*, recorded_at <= late_wm AS late FROM filed JOIN mark USING (f) WHERE recorded_at IS NOT NULL),
kept AS (SELECT event_id, min(f) AS f, any_value(recorded_at) AS recorded_at, any_value(source) AS source FROM timely WHERE late IS NOT true GROUP BY event_id)"""
    return {
        "stream_rates": _w(_arrivals(True) + kept, """SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, source, count(*) AS messages,
    count(*) / 300.0 AS msgs_per_sec
  FROM (SELECT time_bucket(INTERVAL 1 MINUTE, recorded_at) - to_minutes(k) AS window_start, source FROM kept, range(0, 5) r(k))
  WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(after) FROM mark) GROUP BY window_start, source"""),
        "stream_late_rows": _w(_arrivals(True) + kept, """SELECT m.f AS batch_id, coalesce(m.wm, TIMESTAMP '1970-01-01') AS watermark,
    (SELECT count(*) FROM filed x WHERE x.f = m.f) AS input_rows,
    (SELECT count(*) FROM timely x WHERE x.f = m.f AND late) AS late_rows,
    (SELECT count(*) FROM timely x WHERE x.f = m.f AND late IS NOT true) - (SELECT count(*) FROM kept x WHERE x.f = m.f) AS duplicate_rows
  FROM mark m"""),
        "stream_commits": _w(_arrivals(False) + """,
part AS (SELECT source, coin_id, dt, count(*) AS n_rows, list(DISTINCT f) AS files FROM filed WHERE recorded_at IS NOT NULL GROUP BY ALL),
firsts AS (SELECT *, (SELECT min(m.f) FROM mark m WHERE m.f >= list_min(files) AND m.after >= CAST(dt AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 1 MINUTE) AS c0 FROM part)""",
            """SELECT source, coin_id, dt, n_rows, c0 IS NOT NULL AS complete,
    CASE WHEN c0 IS NULL THEN 0 ELSE 1 + len(list_filter(files, lambda x: x > c0)) END AS commits,
    CASE WHEN c0 IS NULL THEN 0 ELSE len(list_filter(files, lambda x: x > c0)) END AS reopens FROM firsts"""),
        "stream_lag": _w(LOG + """,
five AS (SELECT topic, CAST(floor((event_id - lo) * 5 / CAST(hi - lo + 1 AS DOUBLE)) AS BIGINT) AS f
  FROM log CROSS JOIN (SELECT min(event_id) AS lo, max(event_id) AS hi FROM log)),
grid AS (SELECT t.topic, k AS f FROM (SELECT DISTINCT topic FROM log) t, range(0, 5) r(k))""",
            """SELECT 'ingest' AS query_name, g.f AS batch_id, g.topic, (SELECT count(*) FROM five x WHERE x.topic = g.topic AND x.f = g.f) AS records_out,
    (SELECT count(*) FROM five x WHERE x.topic = g.topic AND x.f <= g.f) AS records_so_far,
    (SELECT count(*) FROM five x WHERE x.topic = g.topic AND x.f > g.f) AS lag, true AS flowing FROM grid g"""),
    }


_LAKE_SELECT = "SELECT symbol, price_usd, market_cap, change_24h, recorded_at, source, coin_id, dt FROM unified"

UPSERT = UNIFIED_IDS + """,
b0 AS (SELECT *, (SELECT as_of FROM ref_time) AS ingested_at FROM uid
       WHERE kafka_ts < (SELECT as_of FROM ref_time) - INTERVAL 10 DAY),
b1 AS (SELECT event_id, topic, kafka_ts, coin_id, source, symbol, price_usd + 1 AS price_usd, market_cap, change_24h,
         recorded_at, dt, (SELECT as_of FROM ref_time) + INTERVAL 1 HOUR AS ingested_at FROM uid
       WHERE kafka_ts >= (SELECT as_of FROM ref_time) - INTERVAL 20 DAY),
d0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, source, recorded_at, dt
         ORDER BY kafka_ts DESC, event_id DESC) AS rn FROM b0) WHERE rn = 1),
d1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, source, recorded_at, dt
         ORDER BY kafka_ts DESC, event_id DESC) AS rn FROM b1) WHERE rn = 1)"""

SEED = BASE + ",\n" + ASOF + """,
ticks AS (
  SELECT coin_id, source, symbol, CAST(value AS DECIMAL(20,8)) AS price_usd,
    CAST(CASE WHEN source = 'coingecko' THEN value * 1000 END AS DECIMAL(30,2)) AS market_cap,
    CAST(CASE WHEN source = 'coingecko' THEN value / 100 END AS DECIMAL(10,4)) AS change_24h,
    date_trunc('millisecond', ts) AS recorded_at
  FROM base)"""


# fixed values: the demo coins (id, symbol, base price, base market cap), the feeds' offsets, the swings' sizes and speeds
_GRID = """,
hours AS (SELECT (SELECT as_of FROM ref_time) - to_hours(168 - k) AS hr FROM range(0, 167) r(k)),
swung AS (SELECT hr, c.*, f.*, CAST(floor((1.0 + 0.05 * sin(epoch_us(hr) / 1000000.0 / 86400.0 * 1.8 + len(c.id)) + 0.01 * sin(epoch_us(hr) / 1000000.0 / 3600.0 * 0.7 + len(c.id) * 2)
    + f.apart) * 1e15) AS HUGEINT) AS swing
  FROM hours, (VALUES ('bitcoin', 'btc', 60000, 1200000000000), ('ethereum', 'eth', 1600, 200000000000), ('solana', 'sol', 75, 35000000000)) c(id, sym, price, cap),
       (VALUES ('coingecko', CAST(0.0 AS DOUBLE)), ('binance', CAST(0.0012 AS DOUBLE))) f(feed, apart)),
grid AS (SELECT id AS coin_id, feed AS source, sym AS symbol,
    CAST(CAST((price * swing + 5000000) // 10000000 AS DECIMAL(20,0)) * CAST(0.00000001 AS DECIMAL(8,8)) AS DECIMAL(20,8)) AS price_usd,
    CASE feed WHEN 'coingecko' THEN CAST(CAST((cap * swing + 5000000000000) // 10000000000000 AS DECIMAL(28,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(30,2)) END AS market_cap,
    CASE feed WHEN 'coingecko' THEN CAST(CAST(sign(swing - 1000000000000000) * ((abs(swing - 1000000000000000) + 500000000) // 1000000000) AS DECIMAL(14,0))
      * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(10,4)) END AS change_24h, hr AS recorded_at FROM swung)"""


def sinks_oracle() -> dict[str, str]:
    raw_cols = "coin_id, source, symbol, price_usd, market_cap, change_24h, recorded_at"
    return {
        "lake_roundtrip": _w(LOG, _LAKE_SELECT),
        "lake_compaction": _w(LOG, _LAKE_SELECT),
        "lake_rows": _w(LOG, "SELECT source, coin_id, dt, count(*) AS n_rows FROM unified GROUP BY 1, 2, 3"),
        "upsert_state": _w(UPSERT, """SELECT coin_id, source, symbol, price_usd, market_cap, change_24h, recorded_at,
    ingested_at, dt FROM d0
  WHERE NOT EXISTS (SELECT 1 FROM d1 WHERE d1.coin_id = d0.coin_id AND d1.source = d0.source
                    AND d1.recorded_at = d0.recorded_at AND d1.dt = d0.dt)
  UNION ALL
  SELECT d1.coin_id, d1.source, d1.symbol, d1.price_usd, d1.market_cap, d1.change_24h, d1.recorded_at,
    coalesce(d0.ingested_at, d1.ingested_at) AS ingested_at, d1.dt
  FROM d1 LEFT JOIN d0 ON d1.coin_id = d0.coin_id AND d1.source = d0.source AND d1.recorded_at = d0.recorded_at
    AND d1.dt = d0.dt"""),
        "seed_history": _w(SEED + _GRID, f"""SELECT {raw_cols} FROM ticks
  UNION ALL
  SELECT {raw_cols} FROM grid g WHERE NOT EXISTS (SELECT 1 FROM ticks t WHERE t.coin_id = g.coin_id AND t.source = g.source AND t.recorded_at = g.recorded_at)"""),
        "backfill_legacy": _w(SEED, f"""SELECT {raw_cols} FROM ticks
  UNION ALL
  SELECT {raw_cols} FROM (
    SELECT coin_id, 'coingecko' AS source, symbol, price_usd, market_cap, change_24h, recorded_at,
      row_number() OVER (PARTITION BY coin_id, recorded_at
        ORDER BY symbol NULLS LAST, price_usd NULLS LAST, market_cap NULLS LAST, change_24h NULLS LAST) AS rn
    FROM ticks) g
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM ticks t WHERE t.coin_id = g.coin_id AND t.source = g.source
                               AND t.recorded_at = g.recorded_at)"""),
        "backfill_two_column": _w(SEED, """SELECT coin_id, symbol, price_usd, market_cap, change_24h, recorded_at FROM (
    SELECT *, row_number() OVER (PARTITION BY coin_id, recorded_at
      ORDER BY symbol NULLS LAST, price_usd NULLS LAST, market_cap NULLS LAST, change_24h NULLS LAST) AS rn
    FROM ticks) g
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM ticks t WHERE t.coin_id = g.coin_id AND t.recorded_at = g.recorded_at
    AND t.recorded_at < (SELECT as_of FROM ref_time) - INTERVAL 10 DAY)"""),
        "migration_key_check": _w(SEED, """SELECT 'migration' AS zone, 'unique' AS check_name,
    'coin_id,source,recorded_at' AS column_name,
    (SELECT count(*) FROM (SELECT coin_id, coalesce(CASE WHEN source = 'binance' THEN source END, 'coingecko') AS s,
       recorded_at, count(*) AS n FROM ticks GROUP BY 1, 2, 3) WHERE n > 1) AS failed_rows,
    (SELECT count(*) FROM ticks) AS total_rows,
    (SELECT count(*) FROM (SELECT coin_id, coalesce(CASE WHEN source = 'binance' THEN source END, 'coingecko') AS s,
       recorded_at, count(*) AS n FROM ticks GROUP BY 1, 2, 3) WHERE n > 1) = 0 AND (SELECT count(*) FROM ticks) > 0
      AS success"""),
    }


# --- operations ------------------------------------------------------------------

OPS = LOG + ",\n" + ASOF + """,
il AS (
  SELECT ts, source AS service, CASE WHEN coin_id = 'error' THEN 'error' ELSE 'published' END AS kind,
    CASE WHEN coin_id <> 'error' THEN coin_id END AS coin_id, CASE WHEN coin_id <> 'error' THEN value END AS price_usd,
    CASE WHEN coin_id = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'http' ELSE 'publish' END END AS error_type
  FROM base),
dlq AS (SELECT topic AS source_topic, raw_value, reason, kafka_ts AS failed_at FROM classified WHERE reason IS NOT NULL),
progress AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS batch_ts, count(*) AS input_rows,
               sum(event_id) % 20000 AS offsets_behind FROM events GROUP BY 1)"""


_T = "((SELECT as_of FROM ref_time) - to_seconds(k * 15))"


def _since(table: str, col: str, cond: str = "true") -> str:
    return f"CAST(epoch_us({_T}) - epoch_us((SELECT max({col}) FROM {table} WHERE {col} <= {_T} AND {cond})) AS DOUBLE) / 1000000.0"


def _number(table: str, col: str, seconds: int, cond: str = "true") -> str:
    return f"CAST((SELECT count(*) FROM {table} WHERE {col} > {_T} - to_seconds({seconds}) AND {col} <= {_T} AND {cond}) AS DOUBLE)"


def _alert(name: str, severity: str, service: str, seconds: int, metric: str, fires: str) -> str:
    """Fires when the condition holds at every 15 s step of the last ``seconds``."""
    return (f"SELECT '{name}' AS name, '{severity}' AS severity, '{service}' AS service, bool_and(coalesce(m {fires}, false)) AS firing, "
            f"CAST(max(m) FILTER (WHERE k = 0) AS DOUBLE) AS value FROM (SELECT k, {metric} AS m FROM range(0, {seconds // 15 + 1}) r(k))")


def _alerts() -> str:
    lag = (f"(SELECT CAST(arg_max(offsets_behind, batch_ts) AS DOUBLE) FROM progress WHERE batch_ts <= {_T} "
           f"AND batch_ts > {_T} - to_seconds(300))")
    return "\nUNION ALL\n".join([
        _alert("CoingeckoPollStale", "warning", "coingecko-ingest", 120, _since("il", "ts", "service = 'coingecko' AND kind = 'published'"), "> 300"),
        _alert("CoingeckoApiErrors", "warning", "coingecko-ingest", 300, _number("il", "ts", 900, "service = 'coingecko' AND kind = 'error'"), "> 0"),
        _alert("BinancePublishStale", "warning", "binance-ingest", 300, _number("il", "ts", 600, "service = 'binance' AND kind = 'published'"), "= 0"),
        _alert("BinanceWsErrors", "warning", "binance-ingest", 120, _number("il", "ts", 900, "service = 'binance' AND kind = 'error'"), "> 3"),
        _alert("StreamNoRunningJobs", "critical", "stream", 0, _since("progress", "batch_ts"), "> 180"),
        _alert("DeadLetterMessagesDetected", "warning", "dlq-monitor", 300, _number("dlq", "failed_at", 900), "> 0"),
        _alert("ConsumerLagHigh", "warning", "stream", 600, lag, "> 5000"),
    ])


def _episodes(name: str, severity: str, service: str, hold: int, table: str, col: str, cond: str, metric: str, fires: str) -> str:
    """Steps of 15 s from the table's first row on, the metric at each by running counts, and the islands of true steps."""
    return f"""SELECT '{name}' AS name, '{severity}' AS severity, '{service}' AS service, min(t) AS pending_at,
    min(t) + to_seconds({hold}) AS fired_at,
    CASE WHEN max(t) < (SELECT as_of FROM ref_time) THEN max(t) + to_seconds(15) END AS resolved_at
  FROM (SELECT k, t, k - row_number() OVER (ORDER BY k) AS island FROM (
      WITH mine AS (SELECT {col} AS at, row_number() OVER (ORDER BY {col}) AS c FROM {table} WHERE {cond}),
      spine AS (SELECT k, (SELECT as_of FROM ref_time) - to_seconds(-k * 15) AS t
        FROM range(-CAST(floor((epoch_us((SELECT as_of FROM ref_time)) - epoch_us((SELECT min({col}) FROM {table}))) / 15000000) AS BIGINT), 1) r(k))
      {metric}) WHERE {fires})
  GROUP BY island HAVING count(*) - 1 >= {hold // 15}"""


def _counted(seconds: int) -> str:
    """Rows in (t - seconds, t]."""
    return f"""SELECT s.k, s.t, coalesce(a.c, 0) - coalesce(b.c, 0) AS m FROM (SELECT k, t, t - to_seconds({seconds}) AS t1 FROM spine) s
      ASOF LEFT JOIN mine a ON a.at <= s.t ASOF LEFT JOIN mine b ON b.at <= s.t1"""


_SINCE = "SELECT s.k, s.t, epoch_us(s.t) - epoch_us(a.at) AS m FROM spine s ASOF JOIN mine a ON a.at <= s.t"
_GAUGE = """SELECT s.k, s.t, CASE WHEN a.at > s.t - to_seconds(300) THEN p.offsets_behind END AS m
      FROM spine s ASOF JOIN mine a ON a.at <= s.t JOIN progress p ON p.batch_ts = a.at"""


def _all_episodes() -> str:
    return "\nUNION ALL\n".join("(" + _episodes(*x) + ")" for x in [
        ("CoingeckoPollStale", "warning", "coingecko-ingest", 120, "il", "ts", "service = 'coingecko' AND kind = 'published'", _SINCE, "m > 300000000"),
        ("CoingeckoApiErrors", "warning", "coingecko-ingest", 300, "il", "ts", "service = 'coingecko' AND kind = 'error'", _counted(900), "m > 0"),
        ("BinancePublishStale", "warning", "binance-ingest", 300, "il", "ts", "service = 'binance' AND kind = 'published'", _counted(600), "m = 0"),
        ("BinanceWsErrors", "warning", "binance-ingest", 120, "il", "ts", "service = 'binance' AND kind = 'error'", _counted(900), "m > 3"),
        ("StreamNoRunningJobs", "critical", "stream", 0, "progress", "batch_ts", "true", _SINCE, "m > 180000000"),
        ("DeadLetterMessagesDetected", "warning", "dlq-monitor", 300, "dlq", "failed_at", "true", _counted(900), "m > 0"),
        ("ConsumerLagHigh", "warning", "stream", 600, "progress", "batch_ts", "true", _GAUGE, "m > 5000"),
    ])


def ops_oracle() -> dict[str, str]:
    return {
        "ops_throughput": _w(OPS, """SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
    count(*) / 300.0 AS msgs_per_sec
  FROM (SELECT time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(k) AS window_start
        FROM il, range(0, 5) r(k) WHERE kind = 'published') GROUP BY window_start"""),
        "ops_last_price": _w(OPS, """SELECT coin_id, price_usd, last_published_at FROM (
    SELECT coin_id, price_usd, ts AS last_published_at, row_number() OVER (PARTITION BY coin_id ORDER BY ts DESC) AS rn
    FROM il WHERE kind = 'published' AND service = 'coingecko') WHERE rn = 1"""),
        "ops_counters": _w(OPS, """SELECT 'messages_published_total' AS counter,
    concat_ws(',', 'service=' || service, 'coin_id=' || coin_id) AS labels, count(*) AS value
  FROM il WHERE kind = 'published' GROUP BY service, coin_id
  UNION ALL
  SELECT 'errors_total', concat_ws(',', 'service=' || service, 'error_type=' || error_type), count(*)
  FROM il WHERE kind = 'error' GROUP BY service, error_type
  UNION ALL
  SELECT 'dlq_messages_total', concat_ws(',', 'source_topic=' || source_topic, 'reason=' || reason), count(*)
  FROM dlq GROUP BY source_topic, reason"""),
        "ops_errors_1h": _w(OPS, """SELECT count(*) FILTER (WHERE kind = 'error'
    AND ts > (SELECT as_of FROM ref_time) - INTERVAL 3600 SECOND AND ts <= (SELECT as_of FROM ref_time)) AS value FROM il"""),
        "ops_poll_age": _w(OPS, """SELECT CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(max(ts)) AS DOUBLE) / 1000000.0
    AS seconds_since_poll FROM il WHERE kind = 'published' AND service = 'coingecko'"""),
        "ops_feed_b_10m": _w(OPS, """SELECT count(*) FILTER (WHERE kind = 'published' AND service = 'binance'
    AND ts > (SELECT as_of FROM ref_time) - INTERVAL 600 SECOND AND ts <= (SELECT as_of FROM ref_time)) AS value FROM il"""),
        "alerts": _w(OPS, _alerts()),
        "alert_episodes": _w(OPS, _all_episodes()),
    }


# --- readers, publishing, replay, declared freshness ---------------------------------

def misc_oracle() -> dict[str, str]:
    dlq_msgs = LOG + r""",
dmsg AS (
  SELECT CAST(to_json({'source_topic': topic, 'raw_value': raw_value, 'reason': reason,
                  'failed_at': strftime(kafka_ts, '%Y-%m-%d %H:%M:%S.%g') || 'Z'}) AS VARCHAR) AS value
  FROM classified WHERE reason IS NOT NULL
  UNION ALL SELECT text FROM documents),
dm0 AS (SELECT value, coalesce(json_valid(value), false) AS ok FROM dmsg),
dm1 AS (SELECT value, ok, ok AND json_type(CASE WHEN ok THEN value END) = 'OBJECT' AS obj FROM dm0),
dm AS (SELECT ok, obj, CASE WHEN obj THEN value END AS jv FROM dm1),
parsed AS (
  SELECT CASE WHEN obj THEN coalesce(CASE WHEN json_extract_string(jv, '$.source_topic') <> ''
              THEN json_extract_string(jv, '$.source_topic') END, 'unknown') ELSE 'unknown' END AS source_topic,
         json_extract_string(jv, '$.raw_value') AS raw_value,
         CASE WHEN NOT ok THEN 'dlq_message_undecodable' WHEN NOT obj THEN 'dlq_message_not_an_object'
              ELSE coalesce(CASE WHEN json_extract_string(jv, '$.reason') <> ''
                   THEN json_extract_string(jv, '$.reason') END, 'unknown') END AS reason,
         json_extract_string(jv, '$.failed_at') AS failed_at
  FROM dm)"""
    return {
        "log_debug_view": _w(LOG, """SELECT 0 AS partition, event_id AS offset, coin_text AS coin_id,
    CASE WHEN ok AND json_type(raw_value, '$.price_usd') NOT IN ('OBJECT', 'ARRAY') THEN json_extract_string(raw_value, '$.price_usd') END
      AS price_usd, time_text AS event_time FROM lf"""),
        "dlq_monitor": _w(dlq_msgs, "SELECT source_topic, raw_value, reason, failed_at FROM parsed"),
        "dlq_monitor_counts": _w(dlq_msgs, "SELECT source_topic, reason, count(*) AS messages FROM parsed GROUP BY 1, 2"),
        "publish_records": _w(TRADES, f"""SELECT coin_id || ':' || source AS key,
    CAST(to_json({{'coin_id': coin_id, 'symbol': symbol, 'price_usd': price_usd, 'market_cap': market_cap,
              'change_24h': change_24h, 'event_time': event_time, 'source': source}}) AS VARCHAR) AS value
  FROM tr_ev WHERE e = 'trade' AND coin_id IS NOT NULL AND ms IS NOT NULL AND {_typed_violations()}, ',') = ''"""),
        "publish_snapshots": _w(SNAPSHOTS, f"""SELECT coin_id AS key, coin_id, symbol, price_usd, market_cap, change_24h, event_time, source
  FROM snap_ev WHERE usd_is_number AND cap_ok AND change_ok AND {_typed_violations()}, ',') = ''"""),
        "publish_log": _w(SNAPSHOTS, f"""SELECT coin_id, price_usd, change_24h
  FROM snap_ev WHERE usd_is_number AND cap_ok AND change_ok AND {_typed_violations()}, ',') = ''"""),
        "dead_letter_replay": _w(LOG, "SELECT topic, raw_value AS value FROM classified WHERE reason IS NOT NULL"),
        "payload_events": _w(TRADES, f"""SELECT coin_id, symbol, price_usd, event_time, source
  FROM tr_ev WHERE e = 'trade' AND coin_id IS NOT NULL AND ms IS NOT NULL AND {_typed_violations()}, ',') = ''"""),
        "dlq_previews": _w(dlq_msgs, "SELECT source_topic, reason, substr(coalesce(raw_value, ''), 1, 200) AS preview FROM parsed"),
        "landed_snapshots": _w(BASE + """,
hourly AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS hr, coin_id, arg_max(value, (ts, event_id)) AS value, arg_max(event_id, (ts, event_id)) AS id
  FROM base GROUP BY 1, 2),
quoted AS (SELECT coin_id, coalesce(CASE coin_id WHEN 'bitcoin' THEN 'btc' WHEN 'ethereum' THEN 'eth' WHEN 'solana' THEN 'sol' END, coin_id) AS symbol,
    CAST(printf('%.2f', value) AS DOUBLE) AS price_usd, strftime(hr, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time, 'coingecko' AS source
  FROM hourly WHERE id % 9 <> 0)""", f"SELECT coin_id, symbol, price_usd, event_time, source FROM quoted WHERE {_typed_violations()}, ',') = ''"),
        "dq_incremental": _w(CLEAN + ",\n" + ASOF + """,
n AS (SELECT count(*) AS total FROM clean),
found(check_name, column_name, failed_rows) AS (
  SELECT 'not_null', 'coin_id', count(*) FILTER (WHERE coin_id IS NULL) FROM clean
  UNION ALL SELECT 'not_null', 'market_cap', count(*) FILTER (WHERE market_cap IS NULL) FROM clean
  UNION ALL SELECT 'accepted_values', 'source', count(*) FILTER (WHERE source <> 'coingecko') FROM clean
  UNION ALL SELECT 'accepted_values', 'source', count(*) FILTER (WHERE source NOT IN ('coingecko', 'binance')) FROM clean
  UNION ALL SELECT 'min_gt', 'price_usd', count(*) FILTER (WHERE price_usd <= 0) FROM clean
  UNION ALL SELECT 'min_gt', 'price_usd', count(*) FILTER (WHERE price_usd <= 5) FROM clean
  UNION ALL SELECT 'unique', 'coin_id,source,recorded_at', count(*) FROM (SELECT 1 FROM clean GROUP BY coin_id, source, recorded_at HAVING count(*) > 1)
  UNION ALL SELECT 'unique', 'recorded_at', count(*) FROM (SELECT 1 FROM clean GROUP BY recorded_at HAVING count(*) > 1)
  UNION ALL SELECT 'unique', 'coin_id', count(*) FROM (SELECT 1 FROM clean GROUP BY coin_id HAVING count(*) > 1)
  UNION ALL SELECT 'row_count_min', '', CAST(count(*) < 1 AS BIGINT) FROM clean
  UNION ALL SELECT 'row_count_eq', '', CAST(count(*) <> 5 AS BIGINT) FROM clean
  UNION ALL SELECT 'freshness', 'recorded_at', CAST(coalesce(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(max(recorded_at)) > 600000000, true) AS BIGINT) FROM clean)""",
            """SELECT 'silver' AS zone, check_name, column_name, failed_rows, total AS total_rows, failed_rows = 0 AND total > 0 AS success FROM found, n"""),
        "latest_ticks_top": _w(CLEAN, "SELECT * FROM clean ORDER BY recorded_at DESC, coin_id, source LIMIT 10"),
        "source_freshness": _w(RAW + ",\n" + ASOF, """SELECT 'raw.crypto_prices' AS source_name, max(recorded_at) AS max_loaded_at,
    CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(max(recorded_at)) AS DOUBLE) / 1000000.0 AS age_seconds,
    CASE WHEN CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(max(recorded_at)) AS DOUBLE) / 1000000.0 > 1800 THEN 'error'
         WHEN CAST(epoch_us((SELECT as_of FROM ref_time)) - epoch_us(max(recorded_at)) AS DOUBLE) / 1000000.0 > 600 THEN 'warn'
         ELSE 'pass' END AS status FROM raw"""),
        "lake_replay": _w(LOG, """SELECT coin_id, source, symbol, price_usd, market_cap, change_24h, recorded_at, dt FROM (
    SELECT *, row_number() OVER (PARTITION BY coin_id, source, recorded_at
      ORDER BY symbol NULLS LAST, price_usd NULLS LAST, market_cap NULLS LAST, change_24h NULLS LAST, dt NULLS LAST) AS rn
    FROM unified) WHERE rn = 1"""),
    }
