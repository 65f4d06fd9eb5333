"""Expected results of the registered queries, as DuckDB SQL over the same Parquet tables.

`FIXTURES` derive the market tables; a query names the ones it needs and gets them as common table expressions.
The SQL is written on its own (windows, self joins, brute-force nearest points) and shares no code with the operators.
"""

from __future__ import annotations

import re

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
K3 = "exchange, symbol, market_type"
SERIES = "exchange, symbol, market_type, bar_interval"
STREAM = "exchange, symbol, market_type, bar_interval, source_dataset"

FIXTURES = {
    "fx_events": """
SELECT event_id, ts, event_type, CAST(value AS DECIMAL(18,2)) AS px,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
  CASE user_id % 4 WHEN 0 THEN 'binance' WHEN 1 THEN 'bybit' WHEN 2 THEN 'kucoinfutures' ELSE 'coinbase' END AS exchange,
  CASE CAST(FLOOR(user_id / 4) AS INT) % 3 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' ELSE 'MYX' END AS base,
  CAST(FLOOR(user_id / 12) AS INT) % 3 AS v
FROM events""",
    "fx_market_events": """
SELECT event_id, ts, event_type, px, k, exchange, base, v,
  CASE WHEN exchange = 'coinbase' OR v = 2 THEN 'spot' ELSE 'perpetual' END AS market_type,
  CASE WHEN exchange = 'coinbase' THEN CASE v WHEN 0 THEN 'USD' WHEN 1 THEN 'USDC' ELSE 'USDT' END
       WHEN v = 1 THEN 'USDC' ELSE 'USDT' END AS quote,
  CASE WHEN exchange = 'coinbase' THEN base || '/' || CASE v WHEN 0 THEN 'USD' WHEN 1 THEN 'USDC' ELSE 'USDT' END
       WHEN v = 0 THEN base || '/USDT:USDT' WHEN v = 1 THEN base || '/USDC:USDC' ELSE base || '/USDT' END AS symbol
FROM fx_events""",
    "asset_registry": """
SELECT DISTINCT exchange, symbol, market_type,
  CASE WHEN exchange = 'kucoinfutures' THEN lower(base) ELSE base END AS base_asset, quote AS quote_asset,
  NOT (exchange = 'bybit' AND base = 'MYX' AND v = 1) AS is_active
FROM fx_market_events""",
    "watchlist_asset": """
SELECT 'BTC' AS base_asset, 1 AS display_order, TRUE AS is_active
UNION ALL SELECT 'ETH', 2, TRUE UNION ALL SELECT 'MYX', 3, TRUE
UNION ALL SELECT 'MOVR', 4, TRUE UNION ALL SELECT 'UB', 5, FALSE""",
    "fx_cells": """
SELECT exchange, symbol, market_type, '1h' AS bar_interval, date_trunc('hour', ts) AS open_time, event_id, ts, event_type, px, k
FROM fx_market_events
UNION ALL
SELECT exchange, symbol, market_type, '5m', date_trunc('hour', ts) + CAST(FLOOR(minute(ts) / 5) AS INT) * 5 * INTERVAL 1 MINUTE,
  event_id, ts, event_type, px, k
FROM fx_market_events""",
    "raw_ohlcv": """
SELECT exchange, symbol, market_type, bar_interval, source_dataset, open_time, fetch_seq, open,
  CASE WHEN (day(open_time) * 24 + hour(open_time)) % 97 = 0 THEN low - 1 ELSE high END AS high, low, close,
  CASE WHEN (day(open_time) * 24 + hour(open_time)) % 89 = 0 THEN -volume ELSE volume END AS volume
FROM (
  SELECT exchange, symbol, market_type, bar_interval, source_dataset, open_time, event_id % 2 AS fetch_seq,
    min_by(px, event_id) AS open, max(px) AS high, min(px) AS low, max_by(px, event_id) AS close, sum(k) AS volume
  FROM (
    SELECT *, 'kline' AS source_dataset FROM fx_cells
    UNION ALL SELECT *, 'mark_price_kline' FROM fx_cells WHERE market_type = 'perpetual' AND event_type IN ('view', 'click')
    UNION ALL SELECT *, 'index_price_kline' FROM fx_cells WHERE market_type = 'perpetual' AND event_type IN ('view', 'signup')
  ) s GROUP BY exchange, symbol, market_type, bar_interval, source_dataset, open_time, event_id % 2
) b""",
    "copy_counts": f"SELECT {STREAM}, open_time, count(*) AS copies FROM raw_ohlcv GROUP BY ALL",
    "market_data_raw": f"""
SELECT {STREAM}, open_time, open_time + CASE bar_interval WHEN '1h' THEN 60 ELSE 5 END * INTERVAL 1 MINUTE AS close_time,
  open, high, low, close, volume, CAST(NULL AS DECIMAL(18,2)) AS quote_volume, open_time + INTERVAL 2 HOUR AS ingested_at
FROM (SELECT *, row_number() OVER (PARTITION BY {STREAM}, open_time ORDER BY fetch_seq DESC) AS rn FROM raw_ohlcv) r
WHERE rn = 1""",
    "raw_good": """
SELECT *, exchange = 'coinbase' AND (day(open_time) * 24 + hour(open_time)) % 211 = 0 AS malformed FROM raw_ohlcv""",
    "good_bars": f"""
SELECT {STREAM}, open_time, open_time + CASE bar_interval WHEN '1h' THEN 60 ELSE 5 END * INTERVAL 1 MINUTE AS close_time,
  open, high, low, close, volume, copies
FROM (SELECT *, row_number() OVER (PARTITION BY {STREAM}, open_time ORDER BY fetch_seq DESC) AS rn,
        count(*) OVER (PARTITION BY {STREAM}, open_time) AS copies
      FROM raw_good WHERE NOT malformed) r
WHERE rn = 1""",
    "open_interest_history": """
SELECT exchange, symbol, market_type, bar_interval, open_time, CAST(sum(k) AS DECIMAL(18,2)) AS open_interest_amount,
  CASE WHEN exchange = 'kucoinfutures' THEN NULL ELSE CAST(sum(px * 100) AS DECIMAL(18,2)) END AS open_interest_value,
  open_time + INTERVAL 2 HOUR AS ingested_at
FROM fx_cells WHERE market_type = 'perpetual' AND event_type IN ('signup', 'purchase')
GROUP BY exchange, symbol, market_type, bar_interval, open_time""",
    "funding_rate_history": """
SELECT exchange, symbol, market_type,
  date_trunc('day', ts) + CAST(FLOOR(hour(ts) / 8) AS INT) * 8 * INTERVAL 1 HOUR + max(k) * INTERVAL 1 MILLISECOND AS funding_time,
  CAST(CAST(min(px) - 50 AS DECIMAL(18,4)) * CAST(0.00001 AS DECIMAL(10,5)) AS DECIMAL(25,15)) AS funding_rate,
  max(ts) + INTERVAL 1 HOUR AS ingested_at
FROM fx_market_events WHERE market_type = 'perpetual' AND event_type = 'purchase'
GROUP BY exchange, symbol, market_type, date_trunc('day', ts), CAST(FLOOR(hour(ts) / 8) AS INT)""",
    "long_short_ratio_history": """
SELECT exchange, symbol, market_type, bar_interval, open_time, CAST(max(k) + 1 AS DOUBLE) / 50 AS long_short_ratio,
  open_time + INTERVAL 2 HOUR AS ingested_at
FROM fx_cells WHERE exchange = 'binance' AND market_type = 'perpetual' AND event_type = 'view'
GROUP BY exchange, symbol, market_type, bar_interval, open_time""",
    "taker_buy_sell_volume_history": """
SELECT exchange, symbol, market_type, bar_interval, open_time, buy_volume, sell_volume,
  CAST(buy_volume AS DOUBLE) / nullif(CAST(sell_volume AS DOUBLE), 0) AS buy_sell_ratio, open_time + INTERVAL 2 HOUR AS ingested_at
FROM (SELECT exchange, symbol, market_type, bar_interval, open_time, sum(k) AS buy_volume, sum(100 - k) AS sell_volume
  FROM fx_cells WHERE exchange = 'binance' AND market_type = 'perpetual' AND event_type = 'click'
  GROUP BY exchange, symbol, market_type, bar_interval, open_time) t""",
    "liquidation_event": """
SELECT event_id, exchange, symbol, market_type, ts AS liquidation_time,
  CASE k % 5 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' WHEN 2 THEN 'long' WHEN 3 THEN 'Short' ELSE NULL END AS side,
  CASE WHEN k % 7 = 0 THEN NULL ELSE px END AS price, k AS amount,
  CASE WHEN k % 3 = 0 THEN NULL ELSE px * k END AS cost, ts + INTERVAL 1 MINUTE AS ingested_at
FROM fx_market_events WHERE event_type = 'error'""",
    "exchange_market": """
SELECT *, row_number() OVER (PARTITION BY exchange ORDER BY symbol DESC) AS seq FROM (
SELECT exchange, symbol, replace(split_part(symbol, ':', 1), '/', '') AS id, base_asset AS base, quote_asset AS quote,
  market_type = 'spot' AS spot, market_type = 'perpetual' AS swap, market_type = 'perpetual' AS contract, FALSE AS future,
  is_active AS active, CAST(NULL AS BOOLEAN) AS market_has_ohlcv, TRUE AS client_has_ohlcv
FROM asset_registry
UNION ALL
SELECT exchange, base_asset || '/USDT:USDT-240329', base_asset || 'USDT240329', base_asset, 'USDT',
  FALSE, FALSE, TRUE, TRUE, TRUE, CAST(NULL AS BOOLEAN), TRUE
FROM asset_registry WHERE exchange = 'binance' AND quote_asset = 'USDT' AND market_type = 'perpetual') m""",
    "force_order_raw": """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"stream":"x@forceOrder","data":' || body || '}' ELSE body END AS raw
FROM (SELECT event_id, '{"e":"forceOrder","E":' || CAST(1704067200000 + event_id * 1000 AS VARCHAR) || ',"o":{"s":"' || base
    || 'USDT","S":"' || CASE k % 2 WHEN 0 THEN 'SELL' ELSE 'BUY' END || '","ap":"' || CASE WHEN k % 4 = 0 THEN '0' ELSE CAST(px AS VARCHAR) END
    || '","p":"' || CAST(px AS VARCHAR) || '","z":"' || CASE WHEN k % 3 = 0 THEN '0' ELSE CAST(k AS VARCHAR) END
    || '","l":"' || CAST(k AS VARCHAR) || '","q":"' || CAST(k + 1 AS VARCHAR) || '"'
    || CASE WHEN k % 10 = 0 THEN '' ELSE ',"T":' || CAST(1704067200000 + event_id * 1000 - 5 AS VARCHAR) END || '}}' AS body
  FROM fx_market_events WHERE exchange = 'binance' AND event_type = 'error') b""",
    "ingestion_run_log": """
SELECT exchange, symbol, market_type, bar_interval, source_dataset AS dataset, date_trunc('day', open_time) AS started_at,
  CASE count(*) % 4 WHEN 0 THEN 'failed' WHEN 1 THEN 'success' WHEN 2 THEN 'partial_success' ELSE 'skipped' END AS status,
  count(*) AS rows_fetched
FROM raw_ohlcv GROUP BY exchange, symbol, market_type, bar_interval, source_dataset, date_trunc('day', open_time)""",
    "job_config": """
SELECT sha1(job_name) AS job_id, * FROM (
SELECT concat_ws('_', exchange, symbol, market_type, d.bar_interval, d.source_dataset) AS job_name,
  exchange, symbol, market_type, d.bar_interval, d.source_dataset,
  CASE WHEN d.source_dataset = 'index_price_kline' OR (upper(base_asset) = 'ETH' AND d.source_dataset = 'open_interest')
       THEN 'backfill' ELSE 'incremental' END AS fetch_mode,
  CASE WHEN quote_asset <> 'USDC' THEN TIMESTAMP '2023-12-01 00:00:00' END AS start_time,
  CASE WHEN upper(base_asset) = 'ETH' AND d.bar_interval = '5m' THEN TIMESTAMP '2024-01-20 00:00:00' END AS end_time,
  NOT (exchange = 'bybit' AND upper(base_asset) = 'ETH') AS is_active
FROM asset_registry, (VALUES ('kline','1h'), ('kline','5m'), ('mark_price_kline','1h'), ('mark_price_kline','5m'),
  ('index_price_kline','1h'), ('index_price_kline','5m'), ('open_interest','1h'), ('open_interest','5m'),
  ('long_short_ratio','1h'), ('long_short_ratio','5m'), ('taker_buy_sell_volume','1h'), ('taker_buy_sell_volume','5m'),
  ('open_interest','2h'), ('open_interest','1d'), ('long_short_ratio','3m'), ('funding_rate','8h'), ('liquidation','event'),
  ('trades','1h')) d(source_dataset, bar_interval)
WHERE market_type <> 'spot' OR d.source_dataset = 'kline') j""",
    "bar_marks": f"""
SELECT j.*, m.* EXCLUDE ({STREAM}) FROM job_config j LEFT JOIN (
  SELECT {STREAM}, min(open_time) AS first_open_time, max(open_time) AS last_open_time, max(close_time) AS last_close_time,
    count(*) AS row_count, max(ingested_at) AS last_ingested_at FROM market_data_raw GROUP BY {STREAM}) m USING ({STREAM})
WHERE source_dataset IN ('kline', 'mark_price_kline', 'index_price_kline')""",
    "history_rows": f"""
SELECT {SERIES}, 'open_interest' AS source_dataset, open_time, ingested_at FROM open_interest_history
UNION ALL SELECT {SERIES}, 'long_short_ratio', open_time, ingested_at FROM long_short_ratio_history
UNION ALL SELECT {SERIES}, 'taker_buy_sell_volume', open_time, ingested_at FROM taker_buy_sell_volume_history""",
    "event_rows": f"""
SELECT {K3}, 'funding_rate' AS source_dataset, funding_time AS open_time, ingested_at FROM funding_rate_history
UNION ALL SELECT {K3}, 'liquidation', liquidation_time, ingested_at FROM liquidation_event""",
    "history_marks": f"""
SELECT j.*, m.* EXCLUDE ({STREAM}) FROM job_config j LEFT JOIN (
  SELECT {STREAM}, min(open_time) AS first_open_time, max(open_time) AS last_open_time, max(open_time) AS last_close_time,
    count(*) AS row_count, max(ingested_at) AS last_ingested_at FROM history_rows GROUP BY {STREAM}) m USING ({STREAM})
WHERE source_dataset IN ('open_interest', 'long_short_ratio', 'taker_buy_sell_volume')""",
    "event_marks": f"""
SELECT j.*, m.* EXCLUDE ({K3}, source_dataset) FROM job_config j LEFT JOIN (
  SELECT {K3}, source_dataset, min(open_time) AS first_open_time, max(open_time) AS last_open_time,
    max(open_time) AS last_close_time, count(*) AS row_count, max(ingested_at) AS last_ingested_at
  FROM event_rows GROUP BY {K3}, source_dataset) m USING ({K3}, source_dataset)
WHERE source_dataset IN ('funding_rate', 'liquidation')""",
    "stream_status": f"""
SELECT j.exchange, j.symbol, j.market_type, j.bar_interval, j.source_dataset, min(x.seen_at) AS first_time, max(x.seen_at) AS last_time,
  count(x.seen_at) AS row_count, max(x.ingested_at) AS last_ingested_at
FROM job_config j LEFT JOIN (
  SELECT {STREAM}, open_time AS seen_at, ingested_at FROM market_data_raw
  UNION ALL SELECT {SERIES}, source_dataset, open_time, ingested_at FROM history_rows
  UNION ALL SELECT {K3}, CASE source_dataset WHEN 'liquidation' THEN 'event' ELSE '8h' END, source_dataset, open_time, ingested_at FROM event_rows
) x USING ({STREAM})
GROUP BY ALL""",
}


def interval_case(column: str) -> str:
    """Seconds of an interval text, NULL when it does not parse."""
    return (
        f"CASE WHEN regexp_full_match({column}, '[0-9]+[mhdw]') THEN CAST(regexp_extract({column}, '[0-9]+') AS BIGINT) * "
        f"CASE right({column}, 1) WHEN 'm' THEN 60 WHEN 'h' THEN 3600 WHEN 'd' THEN 86400 ELSE 604800 END END"
    )


def ms(column: str, name: str | None = None) -> str:
    return f"(epoch_us({column}) // 1000) AS {name or column.split('.')[-1]}"


def dbl(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS DOUBLE) AS {name or column.split('.')[-1]}"


def sec(column: str) -> str:
    return f"(epoch_us({column}) // 1000000)"


def plus(column: str, seconds: str) -> str:
    return f"({column} + to_seconds({seconds}))"


def iso(column: str) -> str:
    return (
        f"CASE WHEN epoch_us({column}) % 1000000 = 0 THEN strftime({column}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') END"
    )


EXTRA: dict[str, str] = {}
SQL: dict[str, str] = {}


def _needed(text: str, known: dict[str, str]) -> list[str]:
    words = set(re.findall(r"[a-z_]+[a-z0-9_]*", text))
    found: list[str] = []

    def add(name: str) -> None:
        if name in found:
            return
        inner = set(re.findall(r"[a-z_]+[a-z0-9_]*", known[name]))
        for other in known:
            if other in inner and other != name:
                add(other)
        found.append(name)

    for name in known:
        if name in words:
            add(name)
    return found


def with_fixtures(body: str) -> str:
    """The query with the derived tables it names, in dependency order."""
    known = {**FIXTURES, **EXTRA}
    names = _needed(body, known)
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n].strip()})" for n in names) + "\n" + body.strip()


def all_sql() -> dict[str, str]:
    from tidemark.catalog import oracle_text  # noqa: F401  (fills SQL)

    return {name: with_fixtures(body) for name, body in SQL.items()}
