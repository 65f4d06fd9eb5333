"""One expected-result SQL per registered query (see oracles.py for the derived tables)."""

from __future__ import annotations

import re

from tidemark.catalog.oracles import EXTRA, K3, NOW, SERIES, SQL, STREAM, dbl, interval_case, iso, ms, plus, sec

# --- shared pieces -------------------------------------------------------------------------

# fixed values: market ranks per use; NULL matches anything, the lowest `ord` that matches counts
EXTRA["rank_rules"] = """
SELECT * FROM (VALUES
  ('single', 1, 'coinbase', 'spot', 'USD', 0), ('single', 2, 'coinbase', 'spot', 'USDC', 1),
  ('single', 3, 'coinbase', 'spot', 'USDT', 2), ('single', 4, NULL, 'perpetual', 'USDT', 0),
  ('single', 5, NULL, 'spot', 'USDT', 3),
  ('reference', 1, 'binance', 'perpetual', 'USDT', 0), ('reference', 2, 'bybit', 'perpetual', 'USDT', 1),
  ('reference', 3, 'kucoinfutures', 'perpetual', NULL, 2), ('reference', 4, 'coinbase', 'spot', 'USD', 3),
  ('reference', 5, NULL, 'perpetual', NULL, 4),
  ('volume', 1, 'coinbase', 'spot', 'USD', 0), ('volume', 2, 'coinbase', 'spot', 'USDC', 1),
  ('volume', 3, 'coinbase', 'spot', 'USDT', 2), ('volume', 4, NULL, 'perpetual', 'USDT', 0),
  ('volume', 5, NULL, 'perpetual', NULL, 1), ('volume', 6, NULL, 'spot', 'USDT', 4),
  ('volume', 7, NULL, 'spot', 'USD', 5), ('volume', 8, NULL, 'spot', 'USDC', 6),
  ('perp', 1, NULL, 'perpetual', 'USDT', 0), ('perp', 2, NULL, 'perpetual', 'USD', 1), ('perp', 3, NULL, 'perpetual', 'USDC', 2)
) r(purpose, ord, ex, mt, qa, market_rank)"""

EXTRA["active_registry"] = "SELECT *, upper(base_asset) AS asset FROM asset_registry WHERE is_active"

EXTRA["ranked_markets"] = f"""
SELECT p.purpose, a.exchange, a.symbol, a.market_type, a.asset, coalesce(arg_min(r.market_rank, r.ord), 9) AS market_rank
FROM active_registry a CROSS JOIN (SELECT DISTINCT purpose FROM rank_rules) p
LEFT JOIN rank_rules r ON r.purpose = p.purpose AND coalesce(r.ex, a.exchange) = a.exchange
  AND coalesce(r.mt, a.market_type) = a.market_type AND coalesce(r.qa, a.quote_asset) = a.quote_asset
GROUP BY ALL"""


def best_markets(purpose: str, groups: str, ties: str, where: str = "TRUE") -> str:
    return f"""
SELECT exchange, symbol, market_type, asset FROM ranked_markets WHERE purpose = '{purpose}' AND {where}
QUALIFY row_number() OVER (PARTITION BY {groups} ORDER BY market_rank, {ties}) = 1"""


EXTRA["volume_markets"] = best_markets("volume", "exchange, asset", "symbol, market_type")
EXTRA["perp_markets"] = best_markets("perp", "exchange, asset", "symbol", "market_type = 'perpetual'")
EXTRA["single_markets"] = best_markets("single", "exchange, asset", "symbol, market_type")
EXTRA["reference_markets"] = best_markets("reference", "asset", "exchange, symbol, market_type")

CHART_ROWS = "CASE bar_interval WHEN '1m' THEN 1440 WHEN '5m' THEN 1200 ELSE 1000 END"
SERIES_ROWS = 600
FUNDING_ROWS = 240


def newest(rows: str, groups: str, order: str, limit: object, rank: str = "row_number") -> str:
    return f"SELECT * FROM {rows} QUALIFY {rank}() OVER (PARTITION BY {groups} ORDER BY {order}) <= {limit}"


EXTRA["candles"] = f"""
SELECT {SERIES}, {sec('open_time')} AS time, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume
FROM market_data_raw WHERE source_dataset = 'kline'"""
EXTRA["interest_points"] = f"""
SELECT {SERIES}, {sec('open_time')} AS time, CAST(coalesce(open_interest_value, open_interest_amount, 0) AS DOUBLE) AS value FROM open_interest_history"""

EXTRA["exchange_volume"] = """
SELECT p.asset, m.bar_interval, m.open_time, m.exchange, sum(m.close * CAST(m.volume AS DECIMAL(18,0))) AS value
FROM market_data_raw m JOIN volume_markets p USING (exchange, symbol, market_type)
WHERE m.source_dataset = 'kline' GROUP BY ALL"""
EXTRA["volume_totals"] = "SELECT asset, bar_interval, open_time, sum(value) AS value FROM exchange_volume GROUP BY ALL"
EXTRA["volume_series"] = f"""
SELECT asset, bar_interval, {sec('open_time')} AS time, CAST(value AS DOUBLE) AS volume
FROM ({newest('volume_totals', 'asset, bar_interval', 'open_time DESC', CHART_ROWS)}) x"""
EXTRA["volume_parts"] = f"""
SELECT asset, bar_interval, {sec('open_time')} AS time, exchange, CAST(value AS DOUBLE) AS value
FROM ({newest('exchange_volume', 'asset, bar_interval', 'open_time DESC', CHART_ROWS, 'dense_rank')}) x"""

EXTRA["exchange_interest"] = """
SELECT p.asset, o.bar_interval, o.open_time, o.exchange, sum(coalesce(o.open_interest_value, o.open_interest_amount, 0)) AS value
FROM open_interest_history o JOIN perp_markets p USING (exchange, symbol, market_type) GROUP BY ALL"""
EXTRA["interest_totals"] = "SELECT asset, bar_interval, open_time, sum(value) AS value FROM exchange_interest GROUP BY ALL"
EXTRA["interest_series"] = f"""
SELECT asset, bar_interval, {sec('open_time')} AS time, CAST(value AS DOUBLE) AS value
FROM ({newest('interest_totals', 'asset, bar_interval', 'open_time DESC', SERIES_ROWS)}) x"""
EXTRA["interest_parts"] = f"""
SELECT asset, bar_interval, {sec('open_time')} AS time, exchange, CAST(value AS DOUBLE) AS value
FROM ({newest('exchange_interest', 'asset, bar_interval', 'open_time DESC', SERIES_ROWS, 'dense_rank')}) x"""

EXTRA["funding_prints"] = f"""
SELECT p.asset, f.exchange, {sec('f.funding_time')} AS time, f.funding_rate
FROM funding_rate_history f JOIN perp_markets p USING (exchange, symbol, market_type)"""
EXTRA["funding_totals"] = """
SELECT asset, time, round(CAST(sum(funding_rate) AS DOUBLE) / count(*), 12) AS value FROM funding_prints GROUP BY ALL"""
EXTRA["funding_totals_by_exchange"] = """
SELECT asset, time, exchange, round(CAST(sum(funding_rate) AS DOUBLE) / count(*), 12) AS value FROM funding_prints GROUP BY ALL"""
EXTRA["funding_series"] = newest("funding_totals", "asset", "time DESC", FUNDING_ROWS)
EXTRA["funding_parts"] = newest("funding_totals_by_exchange", "asset", "time DESC", FUNDING_ROWS, "dense_rank")

EXTRA["ratio_series"] = f"""
SELECT asset, bar_interval, symbol, {sec('open_time')} AS time, long_short_ratio AS value FROM (
  SELECT l.*, a.asset FROM long_short_ratio_history l JOIN active_registry a USING (exchange, symbol, market_type)
  QUALIFY row_number() OVER (PARTITION BY a.asset, l.bar_interval ORDER BY l.open_time DESC, l.symbol) <= {SERIES_ROWS}) x"""
EXTRA["flow_series"] = f"""
SELECT asset, bar_interval, symbol, {sec('open_time')} AS time, CAST(buy_volume AS DOUBLE) AS buy_volume,
  CAST(sell_volume AS DOUBLE) AS sell_volume, buy_sell_ratio FROM (
  SELECT l.*, a.asset FROM taker_buy_sell_volume_history l JOIN active_registry a USING (exchange, symbol, market_type)
  QUALIFY row_number() OVER (PARTITION BY a.asset, l.bar_interval ORDER BY l.open_time DESC, l.symbol) <= {SERIES_ROWS}) x"""

EXTRA["sized_liquidations"] = f"""
SELECT {K3}, i.bar_interval, time_bucket(to_seconds(i.width), liquidation_time) AS bucket_time, lower(side) AS side,
  coalesce(cost, price * amount, 0) AS notional
FROM liquidation_event, (VALUES ('1m', 60), ('5m', 300), ('1h', 3600)) i(bar_interval, width)
WHERE market_type = 'perpetual'"""
LIQUIDATION_SUMS = """
  CAST(sum(CASE WHEN side IN ('sell', 'long') THEN notional ELSE 0 END) AS DOUBLE) AS long_value,
  CAST(sum(CASE WHEN side IN ('buy', 'short') THEN notional ELSE 0 END) AS DOUBLE) AS short_value,
  CAST(sum(notional) AS DOUBLE) AS total_value, count(*) AS event_count"""
EXTRA["liquidation_totals"] = f"""
SELECT a.asset, l.bar_interval, {sec('bucket_time')} AS time, {LIQUIDATION_SUMS}
FROM sized_liquidations l JOIN active_registry a USING (exchange, symbol, market_type) GROUP BY ALL"""
EXTRA["liquidation_totals_by_exchange"] = f"""
SELECT a.asset, l.bar_interval, l.exchange, {sec('bucket_time')} AS time, {LIQUIDATION_SUMS}
FROM sized_liquidations l JOIN active_registry a USING (exchange, symbol, market_type) GROUP BY ALL"""
EXTRA["liquidation_totals_by_market"] = f"""
SELECT {SERIES}, {sec('bucket_time')} AS time, {LIQUIDATION_SUMS} FROM sized_liquidations GROUP BY ALL"""
EXTRA["liquidation_series"] = newest("liquidation_totals", "asset, bar_interval", "time DESC", SERIES_ROWS)
EXTRA["liquidation_parts"] = newest(
    "liquidation_totals_by_exchange", "asset, bar_interval", "time DESC", SERIES_ROWS, "dense_rank"
)
EXTRA["liquidation_market_series"] = newest("liquidation_totals_by_market", SERIES, "time DESC", SERIES_ROWS)

EXTRA["asked_markets"] = """
SELECT DISTINCT exchange, upper(base_asset) AS asset FROM asset_registry
UNION SELECT DISTINCT exchange, 'ZZZ' FROM asset_registry"""
EXTRA["resolved_markets"] = """
SELECT q.exchange, q.asset, coalesce(s.symbol, q.asset || '/USDT:USDT') AS symbol, coalesce(s.market_type, 'perpetual') AS market_type
FROM asked_markets q LEFT JOIN single_markets s USING (exchange, asset)"""

SERIES_NAME = "CASE source_dataset WHEN 'kline' THEN 'candles' WHEN 'mark_price_kline' THEN 'markPrice' ELSE 'indexPrice' END"
EXTRA["chart_prices"] = f"""
SELECT x.asset, x.bar_interval, {SERIES_NAME} AS series, {sec('x.open_time')} AS time, x.open, x.high, x.low, x.close,
  x.volume, x.source_dataset
FROM (SELECT m.*, r.asset FROM market_data_raw m JOIN reference_markets r USING (exchange, symbol, market_type)
  WHERE m.source_dataset = 'kline' OR m.market_type = 'perpetual'
  QUALIFY row_number() OVER (PARTITION BY r.asset, m.bar_interval, m.source_dataset ORDER BY m.open_time DESC) <= {CHART_ROWS}) x"""
EXTRA["chart_candles"] = """
SELECT c.asset, c.bar_interval, c.time, CAST(c.open AS DOUBLE) AS open, CAST(c.high AS DOUBLE) AS high, CAST(c.low AS DOUBLE) AS low,
  CAST(c.close AS DOUBLE) AS close, coalesce(v.volume, CAST(c.close AS DOUBLE) * CAST(c.volume AS DOUBLE)) AS volume
FROM chart_prices c LEFT JOIN volume_series v USING (asset, bar_interval, time) WHERE c.series = 'candles'"""
EXTRA["chart_lines"] = """
SELECT asset, bar_interval, series, time, CAST(close AS DOUBLE) AS value FROM chart_prices WHERE series <> 'candles'"""
EXTRA["chart_ranges"] = """
SELECT asset, bar_interval, min(time) AS first_time, max(time) AS last_time,
  greatest(60, CAST(floor((max(time) - min(time)) / greatest(count(*) - 1, 1) + 0.5) AS BIGINT)) AS step_seconds
FROM chart_candles GROUP BY ALL"""


def nearest(left: str, right: str, keys: list[str], values: list[str]) -> str:
    """Brute force: every pair of a key, keep the smallest distance and then the earlier point."""
    on = " AND ".join(f"l.{k} = r.{k}" for k in keys)
    packed = ", ".join(f"'{v}': r.{v}" for v in ["time", *values])
    cols = ", ".join(f"l.{k}" for k in keys)
    return f"""
SELECT {cols}, l.time, arg_min({{{packed}}}, abs(r.time - l.time) * 100000000000 + r.time) AS p
FROM {left} l JOIN {right} r ON {on} GROUP BY ALL"""


# --- scans and sinks ---------------------------------------------------------------------------

JOB_COLS = f"job_id, job_name, {STREAM}, fetch_mode, {ms('start_time')}, {ms('end_time')}, is_active"
SQL["active_jobs"] = f"SELECT {JOB_COLS} FROM job_config WHERE is_active"
SQL["job_lookup"] = f"SELECT {JOB_COLS} FROM job_config WHERE is_active AND job_name = 'binance_BTC/USDT:USDT_perpetual_1h_kline'"
SQL["watchlist_jobs"] = f"""
SELECT {JOB_COLS.replace('is_active', 'j.is_active')} FROM job_config j JOIN asset_registry a USING ({K3})
WHERE j.is_active AND upper(a.base_asset) IN ('BTC', 'MYX') AND source_dataset IN ('kline', 'open_interest') AND bar_interval IN ('5m', '1h')"""
SQL["latest_bars"] = f"""
SELECT {STREAM}, {sec('open_time')} AS time, {dbl('open')}, {dbl('high')}, {dbl('low')}, {dbl('close')}, {dbl('volume')}
FROM ({newest('market_data_raw', STREAM, 'open_time DESC', 600)}) x"""
SQL["append_bars"] = f"""
SELECT {STREAM}, {ms('open_time')}, epoch_ms(open_time) + CASE bar_interval WHEN '1h' THEN 3600000 ELSE 300000 END AS close_time,
  {dbl('open')}, {dbl('high')}, {dbl('low')}, {dbl('close')}, {dbl('volume')}, {ms(NOW, 'ingested_at')}
FROM raw_ohlcv QUALIFY row_number() OVER (PARTITION BY {STREAM}, open_time ORDER BY fetch_seq) = 1"""
SQL["append_open_interest"] = f"""
SELECT {SERIES}, {ms('open_time')}, {dbl('open_interest_amount')}, {dbl('open_interest_value')}, {ms(NOW, 'ingested_at')}
FROM open_interest_history"""
SQL["append_funding"] = f"""
SELECT {K3}, {ms('funding_time')}, {dbl('funding_rate')}, {ms(NOW, 'ingested_at')} FROM funding_rate_history"""
SQL["append_long_short"] = f"SELECT {SERIES}, {ms('open_time')}, long_short_ratio FROM long_short_ratio_history"
SQL["append_taker"] = f"""
SELECT {SERIES}, {ms('open_time')}, {dbl('buy_volume')}, {dbl('sell_volume')}, {ms(NOW, 'ingested_at')}
FROM taker_buy_sell_volume_history"""
SQL["append_liquidations"] = f"""
SELECT {K3}, {ms('liquidation_time')}, side, {dbl('price')}, {dbl('amount')}, {dbl('cost')}, {ms(NOW, 'ingested_at')}
FROM liquidation_event, range(2)"""

MARKET_TYPE = "CASE WHEN spot THEN 'spot' WHEN swap THEN 'perpetual' ELSE 'future' END"
SQL["upsert_registry"] = f"""
SELECT exchange, symbol, {MARKET_TYPE} AS market_type, CASE WHEN future THEN 'old' ELSE base END AS base_asset,
  quote AS quote_asset, TRUE AS is_active, {ms(NOW, 'updated_at')} FROM exchange_market"""


def job_name(exchange: str, symbol: str, kind: str, interval: str, dataset: str, market_id: str) -> str:
    def part(x: str) -> str:
        cleaned = f"lower(trim(regexp_replace({x}, '[^a-zA-Z0-9]+', '_', 'g'), '_'))"
        return f"CASE WHEN {cleaned} = '' THEN 'unknown' ELSE {cleaned} END"

    raw = " || '|' || ".join([exchange, symbol, kind, interval, dataset, market_id])
    parts = [part(exchange), part(symbol), f"CASE WHEN {market_id} <> '' THEN {part(market_id)} END"]
    parts += [part(kind), part(interval), part(dataset), f"substr(sha1({raw}), 1, 8)"]
    return f"concat_ws('_', {', '.join(parts)})"


EXTRA["type_rules"] = """
SELECT * FROM (VALUES ('binance', 'spot'), ('binance', 'perpetual'), ('binance', 'future'), ('bybit', 'spot'),
  ('bybit', 'perpetual'), ('bybit', 'future'), ('coinbase', 'spot'), ('kucoin', 'spot'), ('kucoinfutures', 'perpetual'),
  ('kucoinfutures', 'future')) r(exchange, market_type)"""
MATCHES = "CASE market_type WHEN 'spot' THEN spot WHEN 'perpetual' THEN swap OR contract WHEN 'future' THEN future ELSE FALSE END"
EXTRA["seedable"] = f"SELECT * FROM exchange_market JOIN type_rules USING (exchange) WHERE {MATCHES} AND coalesce(active, TRUE)"
EXTRA["seeded"] = f"""
SELECT {job_name('exchange', 'symbol', 'market_type', 'bar_interval', "'kline'", 'id')} AS job_name, {SERIES}, 'kline' AS source_dataset,
  'incremental' AS fetch_mode, base AS base_asset, quote AS quote_asset, seq, position
FROM seedable, (VALUES ('5m', 0), ('1h', 1)) i(bar_interval, position)"""
SQL["upsert_jobs"] = f"""
SELECT {STREAM}, job_name, fetch_mode, CAST(NULL AS BIGINT) AS start_time, CAST(NULL AS BIGINT) AS end_time,
  exchange <> 'binance' AS is_active, 'Seeded from the market registry.' AS notes, {ms(NOW, 'updated_at')}
FROM seeded"""
SQL["upsert_watchlist"] = f"""
SELECT upper(base) AS base_asset, max(seq) AS display_order, TRUE AS is_active, {ms(NOW, 'updated_at')}
FROM exchange_market GROUP BY 1"""
SQL["latest_run_per_job"] = f"""
SELECT {SERIES}, dataset, {ms('started_at')}, status, rows_fetched FROM ingestion_run_log
QUALIFY row_number() OVER (PARTITION BY {SERIES}, dataset ORDER BY started_at DESC, status DESC) = 1"""
SQL["file_and_jdbc_io"] = f"""
SELECT {STREAM}, {ms('open_time')}, {ms('close_time')}, {dbl('open')}, {dbl('high')}, {dbl('low')}, {dbl('close')}, {dbl('volume')},
  {ms('ingested_at')} FROM market_data_raw"""

# --- normalisation ---------------------------------------------------------------------------------

SQL["normalize_ohlcv"] = f"""
SELECT {STREAM}, {ms('open_time')}, {ms('close_time')}, {dbl('open')}, {dbl('high')}, {dbl('low')}, {dbl('close')},
  {dbl('volume')}, copies FROM good_bars"""
SQL["normalize_ohlcv_repeats"] = f"SELECT {STREAM}, {ms('open_time')}, copies - 1 AS repeats FROM good_bars WHERE copies > 1"

EXTRA["timed_cells"] = """
SELECT *, CASE WHEN event_id % 13 <> 0 THEN epoch_ms(open_time) END AS at_ms FROM fx_cells WHERE market_type = 'perpetual'"""


def series_plan(marks: str) -> str:
    start = "CASE fetch_mode WHEN 'backfill' THEN start_time ELSE coalesce(last_open_time, start_time) END"
    kept = "coalesce(end_time, TIMESTAMP '2024-01-31 00:00:00')"
    return f"""
SELECT *, CASE WHEN exchange = 'kucoinfutures' AND source_dataset = 'open_interest'
    THEN greatest(request_start, request_end - INTERVAL 1 DAY * CASE bar_interval WHEN '1d' THEN 70 ELSE 7 END)
    ELSE request_start END AS effective_start
FROM (SELECT * EXCLUDE (plain_start), CASE WHEN error_message IS NULL THEN
    CASE WHEN exchange = 'binance' AND source_dataset IN ('open_interest', 'long_short_ratio', 'taker_buy_sell_volume')
           AND plain_start IS NOT NULL
         THEN greatest(plain_start, request_end - INTERVAL 29 DAY) ELSE plain_start END END AS request_start
  FROM (SELECT *, {start} AS plain_start, {kept} AS request_end,
    CASE WHEN fetch_mode = 'backfill' AND start_time IS NULL
         THEN 'No start time to fill back to: ' || job_name END AS error_message FROM {marks}) a) b"""


EXTRA["history_plan"] = series_plan("history_marks")
EXTRA["event_plan"] = series_plan("event_marks")
LATER = "CASE source_dataset WHEN 'open_interest' THEN 0 ELSE 1 END"
SQL["clip_pages"] = f"""
SELECT {STREAM}, count(*) AS kept, {ms('min(c.open_time)', 'first_time')}, {ms('max(c.open_time)', 'last_time')}
FROM timed_cells c JOIN history_plan p USING ({SERIES})
WHERE p.source_dataset = 'open_interest' AND p.is_active AND p.error_message IS NULL AND c.at_ms IS NOT NULL
  AND c.open_time <= p.request_end AND (p.exchange <> 'kucoinfutures' OR c.open_time >= p.effective_start)
GROUP BY ALL"""
LANDED = f"{SERIES}, '{{}}' AS source_dataset, event_id AS fetch_seq"
SQL["normalize_open_interest"] = f"""
SELECT {LANDED.format('open_interest')}, at_ms AS open_time, CAST(k AS DOUBLE) AS open_interest_amount,
  CASE WHEN k % 5 <> 0 THEN CAST(px AS DOUBLE) END AS open_interest_value, CAST(k * 2 AS DOUBLE) AS base_volume,
  CAST(NULL AS DOUBLE) AS quote_volume FROM timed_cells WHERE at_ms IS NOT NULL"""
SQL["normalize_open_interest_amount_only"] = f"""
SELECT {LANDED.format('open_interest')}, at_ms AS open_time, CAST(k AS DOUBLE) AS open_interest_amount,
  CAST(NULL AS DOUBLE) AS open_interest_value, CAST(NULL AS DOUBLE) AS base_volume, CAST(NULL AS DOUBLE) AS quote_volume
FROM timed_cells WHERE at_ms IS NOT NULL AND exchange = 'kucoinfutures'"""
SQL["normalize_funding"] = f"""
SELECT {K3}, '8h' AS bar_interval, 'funding_rate' AS source_dataset, event_id AS fetch_seq, {ms('ts', 'funding_time')},
  CAST(px - 50 AS DOUBLE) AS funding_rate, CASE WHEN k % 7 <> 0 THEN CAST(px AS DOUBLE) END AS mark_price,
  CASE WHEN k % 7 <> 0 AND k % 2 = 0 THEN CAST(px AS DOUBLE) END AS index_price,
  CASE WHEN k % 7 <> 0 AND k % 3 <> 0 THEN epoch_us(ts) // 1000 + 28800000 END AS next_funding_time
FROM fx_market_events
WHERE market_type = 'perpetual' AND event_type = 'purchase' AND event_id % 13 <> 0 AND k % 11 <> 0"""
LAST_CELL = f"QUALIFY row_number() OVER (PARTITION BY {SERIES}, open_time ORDER BY event_id DESC) = 1"
SQL["normalize_long_short"] = f"""
SELECT {SERIES}, 'long_short_ratio' AS source_dataset, at_ms AS open_time, round((k + 1) / 50, 4) AS long_short_ratio,
  CAST(px AS DOUBLE) AS long_account, CAST(NULL AS DOUBLE) AS short_account
FROM timed_cells WHERE at_ms IS NOT NULL AND k % 11 <> 0 {LAST_CELL}"""
SQL["normalize_taker"] = f"""
SELECT {SERIES}, 'taker_buy_sell_volume' AS source_dataset, at_ms AS open_time,
  CASE WHEN k % 5 <> 0 THEN CAST(k AS DOUBLE) END AS buy_volume, CAST(100 - k AS DOUBLE) AS sell_volume,
  CAST(px AS DOUBLE) AS buy_sell_ratio
FROM timed_cells WHERE at_ms IS NOT NULL AND k % 11 <> 0 {LAST_CELL}"""
SQL["normalize_liquidations"] = f"""
SELECT {K3}, 'event' AS bar_interval, 'liquidation' AS source_dataset, event_id AS fetch_seq, {ms('liquidation_time')}, side,
  {dbl('price')}, CAST(CASE WHEN event_id % 4 = 0 OR amount = 0 THEN amount + 1 ELSE amount END AS DOUBLE) AS amount, {dbl('cost')}
FROM liquidation_event WHERE event_id % 13 <> 0"""
EXTRA["forced"] = """
SELECT event_id, CASE WHEN json_extract(raw, '$.data') IS NOT NULL THEN json_extract(raw, '$.data') ELSE raw END AS body FROM force_order_raw"""
EXTRA["decoded"] = """
SELECT event_id, upper(json_extract_string(body, '$.o.s')) AS native_symbol, json_extract_string(body, '$.o.S') AS side,
  coalesce(nullif(CAST(json_extract_string(body, '$.o.T') AS BIGINT), 0), CAST(json_extract_string(body, '$.E') AS BIGINT)) AS at,
  coalesce(nullif(CAST(json_extract_string(body, '$.o.ap') AS DECIMAL(18,2)), 0), nullif(CAST(json_extract_string(body, '$.o.p') AS DECIMAL(18,2)), 0)) AS price,
  coalesce(nullif(CAST(json_extract_string(body, '$.o.z') AS DECIMAL(18,0)), 0), nullif(CAST(json_extract_string(body, '$.o.l') AS DECIMAL(18,0)), 0),
    nullif(CAST(json_extract_string(body, '$.o.q') AS DECIMAL(18,0)), 0)) AS amount
FROM forced"""
EXTRA["live_events"] = f"""
SELECT d.event_id, d.native_symbol, j.exchange, j.symbol, j.market_type, j.bar_interval, j.source_dataset, j.job_name,
  d.at AS liquidation_time, d.side, {dbl('d.price')}, {dbl('d.amount')}, CAST(d.price * d.amount AS DOUBLE) AS cost
FROM decoded d JOIN job_config j ON d.native_symbol = replace(split_part(j.symbol, ':', 1), '/', '')
WHERE j.exchange = 'binance' AND j.source_dataset = 'liquidation'"""
EVENT_COLS = f"event_id, native_symbol, {K3}, liquidation_time, side, price, amount, cost"
SQL["decode_force_orders"] = f"SELECT {EVENT_COLS} FROM live_events"
SQL["native_symbol"] = f"SELECT {K3}, replace(split_part(symbol, ':', 1), '/', '') AS native_symbol FROM asset_registry"
SQL["normalize_symbol_key"] = """
SELECT exchange, symbol, regexp_replace(upper(symbol), '[^A-Z0-9]', '', 'g') AS symbol_key FROM exchange_market"""
SQL["dataset_router"] = """
SELECT source_dataset, CASE WHEN source_dataset LIKE '%kline' THEN 'ohlcv' WHEN source_dataset <> 'trades' THEN source_dataset END AS family,
  count(*) AS jobs FROM job_config GROUP BY ALL"""

# --- planning -----------------------------------------------------------------------------------------

MARKS = (
    f"job_name, {STREAM}, {ms('first_open_time')}, {ms('last_open_time')}, {ms('last_close_time')}, row_count, {ms('last_ingested_at')}"
)
SQL["bar_high_water"] = f"SELECT {MARKS} FROM bar_marks"
SQL["history_high_water"] = f"SELECT {MARKS} FROM history_marks"
SQL["event_high_water"] = f"SELECT {MARKS} FROM event_marks"
SQL["floor_closed_bar"] = """
SELECT event_id, bar_interval, (epoch_us(ts) // 1000 // width * width - width) AS last_open
FROM events, (VALUES ('5m', 300000), ('1h', 3600000), ('1w', 604800000)) i(bar_interval, width)"""
SQL["interval_seconds"] = f"SELECT bar_interval, count(*) AS jobs, {interval_case('bar_interval')} AS seconds FROM job_config GROUP BY bar_interval"


def bar_plan(now: str, last_open: str, marks: str = "bar_marks") -> str:
    step = interval_case("bar_interval")
    # the closed bar: floor of now on the grid, minus one bar
    closed = f"make_timestamp(((epoch_ms({now}) // (step * 1000)) * step - step) * 1000000)"
    return f"""
SELECT *, request_start IS NOT NULL AND request_start > target_last_open_time AS is_empty FROM (
SELECT *,
  CASE WHEN error_message IS NOT NULL THEN NULL WHEN fetch_mode = 'backfill' THEN start_time
       ELSE coalesce({plus('newest_open', 'step')}, start_time) END AS request_start,
  CASE WHEN error_message IS NOT NULL THEN NULL WHEN fetch_mode = 'backfill'
       THEN least(coalesce({plus('first_open_time', '-step')}, end_time, {closed}), end_time)
       ELSE least({closed}, end_time) END AS target_last_open_time,
  CASE WHEN fetch_mode = 'incremental' THEN newest_open END AS anchor_open_time
FROM (SELECT *, {last_open} AS newest_open,
    CASE WHEN fetch_mode = 'backfill' AND start_time IS NULL
         THEN 'No start time to fill back to: ' || job_name END AS error_message
  FROM (SELECT *, {step} AS step FROM {marks}) a) b) c"""


EXTRA["bar_plan"] = bar_plan(NOW, "last_open_time")
EXTRA["midway_plan"] = bar_plan("TIMESTAMP '2024-01-30 12:00:00'", "last_open_time")
EXTRA["quality_plan"] = bar_plan(NOW, plus("first_open_time", "-step * 4"))
SQL["plan_bar_requests"] = f"""
SELECT job_name, fetch_mode, {ms('request_start')}, {ms('target_last_open_time')}, {ms('anchor_open_time')}, error_message FROM bar_plan"""
PLAN_STATUS = "CASE WHEN error_message IS NOT NULL THEN 'failed' WHEN is_empty THEN 'skipped' ELSE 'running' END"
PLAN_END = "CASE WHEN is_empty THEN request_start ELSE target_last_open_time END"
SQL["plan_skip"] = f"""
SELECT job_name, {PLAN_STATUS} AS status, {ms('request_start')}, {ms(PLAN_END, 'request_end')} FROM midway_plan"""
SERIES_PLAN = f"job_name, {ms('request_start')}, {ms('request_end')}, epoch_us(effective_start) // 1000 + {LATER} AS since_ms, epoch_us(request_end) // 1000 AS until_ms, error_message"
SQL["plan_series_requests"] = f"""
SELECT {SERIES_PLAN} FROM history_plan UNION ALL SELECT {SERIES_PLAN} FROM event_plan"""
SQL["retention_clamp"] = f"""
SELECT job_name, {ms('request_start')}, {ms('effective_start')}, FALSE AS empty_range FROM (
SELECT *, CASE WHEN exchange = 'kucoinfutures' AND source_dataset = 'open_interest'
  THEN greatest(request_start, {NOW} - INTERVAL 1 DAY * CASE bar_interval WHEN '1d' THEN 70 ELSE 7 END) ELSE request_start END AS effective_start
FROM (SELECT *, CASE WHEN exchange = 'binance' AND source_dataset IN ('open_interest', 'long_short_ratio', 'taker_buy_sell_volume')
  AND start_time IS NOT NULL THEN greatest(start_time, {NOW} - INTERVAL 29 DAY) ELSE start_time END AS request_start FROM job_config) a) b"""
SQL["capability_gate"] = """
SELECT job_name, CASE WHEN message IS NULL THEN 'run' WHEN message LIKE 'Unsupported%' OR message LIKE 'kucoinfutures%' THEN 'failed' ELSE 'skipped' END AS gate,
  message AS gate_message
FROM (SELECT job_name, CASE
  WHEN source_dataset = 'trades' THEN 'Unsupported source_dataset=''trades''.'
  WHEN exchange = 'kucoinfutures' AND source_dataset = 'open_interest' AND bar_interval = '2h'
    THEN 'kucoinfutures has no open interest at interval 2h.'
  WHEN source_dataset IN ('long_short_ratio', 'taker_buy_sell_volume') AND exchange <> 'binance'
    THEN source_dataset || ' is read from binance only.'
  WHEN source_dataset IN ('long_short_ratio', 'taker_buy_sell_volume') AND bar_interval = '3m'
    THEN 'binance has no ' || source_dataset || ' at interval 3m.'
  WHEN source_dataset = 'liquidation' AND exchange = 'binance'
    THEN 'binance liquidations come from the live stream only.'
  WHEN source_dataset = 'liquidation' THEN 'The exchange publishes no liquidations.'
  WHEN source_dataset = 'funding_rate' AND exchange = 'kucoinfutures' THEN 'The exchange lacks fetchFundingRateHistory.'
  END AS message FROM job_config) g"""
MARKED = "job_name, source_dataset, bar_interval, last_ingested_at"
SQL["due_streams"] = f"""
SELECT job_name, cadence AS cadence_seconds, age AS age_seconds FROM (
  SELECT job_name, CASE source_dataset WHEN 'funding_rate' THEN 300 WHEN 'liquidation' THEN 60
      ELSE greatest(30, {interval_case('bar_interval')}) END AS cadence,
    {sec("TIMESTAMP '2024-01-30 23:00:00'")} - {sec('last_ingested_at')} AS age
  FROM (SELECT {MARKED} FROM bar_marks UNION ALL SELECT {MARKED} FROM history_marks UNION ALL SELECT {MARKED} FROM event_marks) m) d
WHERE age IS NULL OR age >= cadence"""

# --- quality ---------------------------------------------------------------------------------------------

ISSUE = f"{STREAM}, '{{kind}}' AS issue_type, {{start}} AS issue_start_time, {{end}} AS issue_end_time, {{expected}} AS expected_count, {{actual}} AS actual_count, '{{severity}}' AS severity, {{detail}} AS detail"


def duplicate_issue(rows: str) -> str:
    return f"""
SELECT {ISSUE.format(kind='duplicate_bar', start='epoch_ms(min(open_time))', end='epoch_ms(max(open_time))', expected='count(*)', actual='CAST(0 AS BIGINT)', severity='warning',
    detail=f"CAST(to_json({{'duplicate_count': count(*), 'duplicate_open_times': list({iso('open_time')} ORDER BY open_time)[1:20]}}) AS VARCHAR)")}
FROM (SELECT *, row_number() OVER (PARTITION BY {STREAM}, open_time ORDER BY fetch_seq) AS rn FROM {rows}) d
WHERE rn > 1 GROUP BY {STREAM}"""


def affected_issue(rows: str, kind: str, condition: str) -> str:
    return f"""
SELECT {ISSUE.format(kind=kind, start='epoch_ms(min(open_time))', end='epoch_ms(max(open_time))', expected='CAST(NULL AS BIGINT)', actual='count(*)', severity='error',
    detail=f"CAST(to_json({{'affected_count': count(*), 'open_times': list({iso('open_time')} ORDER BY open_time)[1:20]}}) AS VARCHAR)")}
FROM {rows} WHERE {condition} GROUP BY {STREAM}"""


INVALID = "high < low OR open < low OR open > high OR close < low OR close > high"


def gap_issue(rows: str, plan: str = "quality_plan") -> str:
    return f"""
SELECT {ISSUE.format(kind='missing_bar', start='epoch_ms(gap_from)', end='epoch_ms(gap_to)', expected='missing', actual='CAST(0 AS BIGINT)', severity='warning',
    detail=f"CAST(to_json({{'gap_from': {iso('gap_from')}, 'gap_to': {iso('gap_to')}, 'missing_count': missing}}) AS VARCHAR)")}
FROM (SELECT *, {plus('before', 'step')} AS gap_from, {plus('open_time', '-step')} AS gap_to,
    (epoch_ms(open_time) - epoch_ms(before)) // (step * 1000) - 1 AS missing
  FROM (SELECT b.*, q.step, coalesce(lag(b.open_time) OVER (PARTITION BY {', '.join('b.' + c for c in STREAM.split(', '))} ORDER BY b.open_time), q.anchor_open_time) AS before
    FROM {rows} b JOIN {plan} q USING ({STREAM})) g
  WHERE epoch_ms(open_time) - epoch_ms(before) > step * 1000) h"""


def late_issue(rows: str, plan: str = "quality_plan") -> str:
    return f"""
SELECT {ISSUE.format(kind='late_data', start='epoch_ms(latest)', end='epoch_ms(target_last_open_time)', expected='CAST(1 AS BIGINT)', actual='CAST(0 AS BIGINT)', severity='warning',
    detail=f"CAST(to_json({{'latest_observed_open_time': {iso('latest')}, 'expected_latest_open_time': {iso('target_last_open_time')}, 'lag_seconds': lag_ms // 1000}}) AS VARCHAR)")}
FROM (SELECT *, epoch_ms(target_last_open_time) - epoch_ms(latest) AS lag_ms FROM (
  SELECT q.*, coalesce(n.newest, q.anchor_open_time) AS latest
  FROM {plan} q LEFT JOIN (SELECT {STREAM}, max(open_time) AS newest FROM {rows} GROUP BY {STREAM}) n USING ({STREAM})
  WHERE q.fetch_mode = 'incremental') l) m WHERE lag_ms > step * 2000"""


def all_issues(raw: str, bars: str, plan: str = "quality_plan") -> str:
    return " UNION ALL ".join(
        [duplicate_issue(raw), affected_issue(bars, "invalid_ohlc", INVALID), affected_issue(bars, "negative_volume", "volume < 0"), gap_issue(bars, plan), late_issue(bars, plan)]
    )


SQL["duplicate_bar"] = duplicate_issue("raw_ohlcv")
SQL["invalid_ohlc"] = affected_issue("market_data_raw", "invalid_ohlc", INVALID)
SQL["negative_volume"] = affected_issue("market_data_raw", "negative_volume", "volume < 0")
SQL["missing_bar"] = gap_issue("market_data_raw")
SQL["late_data"] = late_issue("market_data_raw")
EXTRA["found_issues"] = all_issues("raw_ohlcv", "market_data_raw")
SQL["quality_issues"] = "SELECT * FROM found_issues"
SQL["run_status"] = f"""
SELECT q.job_name, {', '.join('q.' + c for c in STREAM.split(', '))},
  CASE WHEN bool_or(coalesce(i.severity = 'error', FALSE)) THEN 'partial_success' ELSE 'success' END AS status
FROM quality_plan q LEFT JOIN found_issues i USING ({STREAM}) GROUP BY ALL"""
SQL["append_quality_issues"] = f"SELECT f.*, {ms(NOW, 'detected_at')} FROM found_issues f, range(2)"

EXTRA["landed_good"] = "SELECT * FROM raw_good WHERE NOT malformed"
EXTRA["landed_issues"] = all_issues("landed_good", "good_bars")
def run_report(stored_before: str) -> str:
    """The report of a batch that came when the store ended before some time."""
    return f"""
SELECT p.job_name, {', '.join('p.' + c for c in STREAM.split(', '))}, status, {ms('p.request_start', 'request_start')}, {ms(PLAN_END, 'request_end')},
  CASE WHEN ran THEN coalesce(n_fetched, 0) ELSE 0 END AS rows_fetched,
  CASE WHEN ran THEN coalesce(n_inserted, 0) ELSE 0 END AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
  CASE WHEN ran THEN coalesce(n_issues, 0) ELSE 0 END AS issue_count,
  coalesce(error_message, CASE WHEN n_rejected > 0 THEN 'malformed rows in the payload' END) AS error_message
FROM (SELECT *, status IN ('success', 'partial_success') AS ran FROM (
  SELECT q.*, n_fetched, n_rejected, n_inserted, n_issues,
    CASE WHEN {PLAN_STATUS} <> 'running' THEN {PLAN_STATUS} WHEN coalesce(n_rejected, 0) > 0 THEN 'failed'
         WHEN coalesce(severe, FALSE) THEN 'partial_success' ELSE 'success' END AS status
  FROM quality_plan q
  LEFT JOIN (SELECT {STREAM}, count(*) AS n_fetched, count(*) FILTER (WHERE malformed) AS n_rejected FROM raw_good GROUP BY {STREAM}) f USING ({STREAM})
  LEFT JOIN (SELECT {STREAM}, count(*) AS n_inserted FROM good_bars WHERE open_time >= TIMESTAMP '{stored_before}'
      GROUP BY {STREAM}) i USING ({STREAM})
  LEFT JOIN (SELECT {STREAM}, count(*) AS n_issues, bool_or(severity = 'error') AS severe FROM landed_issues GROUP BY {STREAM}) s USING ({STREAM})) r) p"""


EXTRA["run_report"] = run_report("1970-01-01 00:00:00")
SQL["batch_run_report"] = run_report("2100-01-01 00:00:00")
SQL["batch_run_report_fresh"] = "SELECT * FROM run_report"
SQL["batch_run_report_late"] = run_report("2024-01-10 00:00:00")
SQL["run_log"] = f"""
SELECT * EXCLUDE (source_dataset, issue_count), source_dataset AS dataset, {ms(NOW, 'started_at')}, {ms(NOW, 'ended_at')}
FROM (SELECT * FROM run_report UNION ALL {run_report("2024-01-10 00:00:00")} UNION ALL {run_report("2100-01-01 00:00:00")})"""

# a first run into an empty lake
EXTRA["empty_marks"] = """
SELECT *, CAST(NULL AS TIMESTAMP) AS first_open_time, CAST(NULL AS TIMESTAMP) AS last_open_time FROM job_config
WHERE is_active AND source_dataset IN ('kline', 'mark_price_kline', 'index_price_kline')"""
EXTRA["first_plan"] = bar_plan(NOW, "last_open_time", "empty_marks")
EXTRA["first_rows"] = f"""
SELECT r.* FROM raw_good r JOIN first_plan p USING ({STREAM})
WHERE p.error_message IS NULL AND NOT p.is_empty AND r.open_time <= p.target_last_open_time"""
EXTRA["first_broken"] = f"SELECT DISTINCT {STREAM} FROM first_rows WHERE malformed"
EXTRA["first_good"] = f"SELECT r.* FROM first_rows r ANTI JOIN first_broken USING ({STREAM})"
EXTRA["first_bars"] = f"""
SELECT * FROM first_good QUALIFY row_number() OVER (PARTITION BY {STREAM}, open_time ORDER BY fetch_seq DESC) = 1"""
EXTRA["first_checked"] = f"SELECT p.* FROM first_plan p ANTI JOIN first_broken USING ({STREAM}) WHERE p.error_message IS NULL AND NOT p.is_empty"
EXTRA["first_issues"] = all_issues("first_good", "first_bars", "first_checked")
SQL["ingest_run"] = f"""
SELECT p.job_name, {', '.join('p.' + c for c in STREAM.split(', '))}, {ms('p.request_start', 'request_start')}, {ms(PLAN_END, 'request_end')},
  CASE WHEN {PLAN_STATUS} <> 'running' THEN {PLAN_STATUS} WHEN coalesce(n_rejected, 0) > 0 THEN 'failed'
       WHEN coalesce(severe, FALSE) THEN 'partial_success' ELSE 'success' END AS status,
  CASE WHEN coalesce(n_rejected, 0) = 0 THEN coalesce(n_fetched, 0) ELSE 0 END AS rows_fetched, coalesce(n_inserted, 0) AS rows_inserted,
  CAST(0 AS BIGINT) AS rows_updated, coalesce(n_issues, 0) AS issue_count,
  coalesce(error_message, CASE WHEN n_rejected > 0 THEN 'malformed rows in the payload' END) AS error_message
FROM first_plan p
LEFT JOIN (SELECT {STREAM}, count(*) AS n_fetched, count(*) FILTER (WHERE malformed) AS n_rejected FROM first_rows GROUP BY {STREAM}) f USING ({STREAM})
LEFT JOIN (SELECT {STREAM}, count(*) AS n_inserted FROM first_bars GROUP BY {STREAM}) i USING ({STREAM})
LEFT JOIN (SELECT {STREAM}, count(*) AS n_issues, bool_or(severity = 'error') AS severe FROM first_issues GROUP BY {STREAM}) x USING ({STREAM})"""

# a complete run into an empty lake; the catalogue lacks one asset of kucoinfutures
LOST = "exchange = 'kucoinfutures' AND symbol LIKE 'MYX/%'"
LOST_MESSAGE = "'No market for symbol ' || symbol || ' of type ' || market_type || ' at ' || exchange"
RESULT = f"job_name, {STREAM}, request_start, request_end, status, rows_fetched, rows_inserted, rows_updated, issue_count, error_message"
EXTRA["first_candles"] = SQL["ingest_run"]
PLANNED = "status <> 'skipped' AND coalesce(error_message, 'malformed rows in the payload') = 'malformed rows in the payload'"
EXTRA["complete_candles"] = f"""
SELECT * EXCLUDE (lost) REPLACE (CASE WHEN lost THEN 'failed' ELSE status END AS status, CASE WHEN lost THEN 0 ELSE rows_fetched END AS rows_fetched,
  CASE WHEN lost THEN 0 ELSE rows_inserted END AS rows_inserted, CASE WHEN lost THEN 0 ELSE issue_count END AS issue_count,
  CASE WHEN lost THEN {LOST_MESSAGE} ELSE error_message END AS error_message)
FROM (SELECT *, {LOST} AND {PLANNED} AS lost FROM first_candles) c"""
EXTRA["unmarked_series"] = """
SELECT *, CAST(NULL AS TIMESTAMP) AS last_open_time FROM job_config WHERE is_active
  AND source_dataset IN ('open_interest', 'long_short_ratio', 'taker_buy_sell_volume', 'funding_rate', 'liquidation')"""
EXTRA["first_series"] = series_plan("unmarked_series")
EXTRA["gated_series"] = f"""
SELECT * REPLACE (CASE WHEN error_message IS NOT NULL THEN error_message
    WHEN exchange = 'kucoinfutures' AND source_dataset = 'open_interest' AND bar_interval = '2h' THEN 'kucoinfutures has no open interest at interval 2h.'
    WHEN source_dataset IN ('long_short_ratio', 'taker_buy_sell_volume') AND exchange <> 'binance' THEN source_dataset || ' is read from binance only.'
    WHEN source_dataset IN ('long_short_ratio', 'taker_buy_sell_volume') AND bar_interval = '3m' THEN 'binance has no ' || source_dataset || ' at interval 3m.'
    WHEN source_dataset = 'liquidation' AND exchange = 'binance' THEN 'binance liquidations come from the live stream only.'
    WHEN {LOST} THEN {LOST_MESSAGE} END AS error_message)
FROM first_series"""
EXTRA["series_counts"] = f"""
SELECT p.job_name, count(*) AS n_fetched, count(DISTINCT c.open_time) AS n_inserted FROM gated_series p JOIN timed_cells c USING ({SERIES})
WHERE p.source_dataset = 'open_interest' AND p.error_message IS NULL AND c.at_ms IS NOT NULL AND c.open_time <= p.request_end
  AND (p.exchange <> 'kucoinfutures' OR c.open_time >= p.effective_start) GROUP BY 1
UNION ALL SELECT p.job_name, count(DISTINCT c.open_time), count(DISTINCT c.open_time) FROM gated_series p JOIN timed_cells c USING ({SERIES})
WHERE p.source_dataset IN ('long_short_ratio', 'taker_buy_sell_volume') AND p.error_message IS NULL AND c.at_ms IS NOT NULL
  AND c.open_time <= p.request_end AND (p.effective_start IS NULL OR c.at_ms > epoch_ms(p.effective_start)) GROUP BY 1
UNION ALL SELECT p.job_name, count(*), count(DISTINCT f.funding_time) FROM gated_series p JOIN funding_rate_history f USING ({K3})
WHERE p.source_dataset = 'funding_rate' AND p.error_message IS NULL GROUP BY 1
UNION ALL SELECT p.job_name, count(*), count(*) FROM gated_series p JOIN liquidation_event l USING ({K3})
WHERE p.source_dataset = 'liquidation' AND p.error_message IS NULL GROUP BY 1"""
SKIPS = "error_message LIKE '% is read from binance only.' OR error_message LIKE 'binance %'"
EXTRA["complete_run"] = f"""
SELECT {RESULT} FROM complete_candles
UNION ALL SELECT job_name, {STREAM}, {ms('request_start')}, {ms('request_end')},
  CASE WHEN error_message IS NULL THEN 'success' WHEN {SKIPS} THEN 'skipped' ELSE 'failed' END AS status, coalesce(n_fetched, 0), coalesce(n_inserted, 0),
  CAST(0 AS BIGINT), CAST(0 AS BIGINT), error_message
FROM gated_series LEFT JOIN series_counts USING (job_name)
UNION ALL SELECT job_name, {STREAM}, NULL, NULL, 'failed', 0, 0, 0, 0, 'Unsupported source_dataset=''' || source_dataset || '''.'
FROM job_config WHERE is_active AND source_dataset = 'trades'"""
SQL["run_active_jobs"] = "SELECT * FROM complete_run"
SQL["run_registry"] = f"""
SELECT DISTINCT c.exchange, c.symbol, c.market_type, m.base AS base_asset, m.quote AS quote_asset, TRUE AS is_active, {ms(NOW, 'updated_at')}
FROM complete_candles c JOIN exchange_market m USING (exchange, symbol) WHERE {PLANNED}"""
SQL["run_until_failure"] = f"""
SELECT {RESULT}, CASE WHEN source_dataset LIKE '%kline' AND rows_inserted > 0 THEN rows_inserted END AS bars_stored
FROM complete_run WHERE job_name <= (SELECT min(job_name) FROM complete_run WHERE status = 'failed')"""

# --- markets and seeding -------------------------------------------------------------------------------------

SQL["market_type_match"] = f"""
SELECT exchange, symbol, market_type, {MATCHES} AS matches
FROM exchange_market, (VALUES ('spot'), ('perpetual'), ('future'), ('option')) t(market_type)"""
SQL["seed_market_filter"] = "SELECT exchange, market_type, symbol, id FROM seedable WHERE upper(base) IN ('BTC', 'ETH') AND upper(quote) IN ('USDT', 'USD')"
START = "epoch_ms(TIMESTAMP '2024-01-01 00:00:00') AS start_time"
SQL["seed_jobs"] = f"SELECT job_name, {STREAM}, fetch_mode, {START}, FALSE AS is_active, base_asset, quote_asset FROM seeded"
SQL["job_name"] = f"""
SELECT exchange, symbol, {job_name('exchange', 'symbol', "'perpetual'", "'1h'", "'mark_price_kline'", 'mid')} AS job_name
FROM (SELECT *, CASE WHEN swap THEN id ELSE '' END AS mid FROM exchange_market) m"""
SQL["seed_limit"] = """
SELECT exchange, market_type, symbol, bar_interval FROM seeded
QUALIFY row_number() OVER (PARTITION BY exchange, market_type ORDER BY seq, position) <= 3"""
SQL["seed_summary"] = """
SELECT exchange, market_type, count(DISTINCT symbol) AS discovered_markets, count(*) AS created_or_updated_jobs FROM seeded GROUP BY ALL"""
EXTRA["perpetual_picks"] = """
SELECT exchange, upper(base) AS asset, symbol, id, base, quote FROM exchange_market
WHERE (swap OR contract) AND coalesce(active, TRUE) AND upper(quote) = 'USDT'
QUALIFY row_number() OVER (PARTITION BY exchange, upper(base) ORDER BY seq) = 1"""
EXTRA["spot_picks"] = """
SELECT exchange, upper(base) AS asset, symbol, id, base, quote FROM exchange_market
WHERE spot AND coalesce(active, TRUE) AND upper(quote) IN ('USD', 'USDC', 'USDT')
QUALIFY row_number() OVER (PARTITION BY exchange, upper(base) ORDER BY list_position(['USD', 'USDC', 'USDT'], upper(quote)), seq) = 1"""
SQL["usdt_perpetual_pick"] = "SELECT * FROM perpetual_picks"
SQL["spot_pick"] = "SELECT * FROM spot_picks"
EXTRA["dashboard_requests"] = """
SELECT exchange, asset, CASE exchange WHEN 'coinbase' THEN 'spot' ELSE 'perpetual' END AS market_type
FROM (VALUES ('binance'), ('bybit'), ('kucoinfutures'), ('coinbase')) e(exchange), (VALUES ('BTC'), ('ETH'), ('MYX'), ('MOVR')) a(asset)"""
EXTRA["dashboard_markets"] = """
SELECT r.exchange, r.asset, r.market_type, p.symbol, p.id, p.base, p.quote FROM dashboard_requests r
LEFT JOIN (SELECT *, 'perpetual' AS market_type FROM perpetual_picks UNION ALL SELECT *, 'spot' FROM spot_picks) p USING (exchange, asset, market_type)"""
EXTRA["dashboard_rules"] = """
SELECT * FROM (VALUES ('kline', '1m'), ('kline', '5m'), ('kline', '1h'), ('mark_price_kline', '1m'), ('mark_price_kline', '5m'),
  ('mark_price_kline', '1h'), ('index_price_kline', '1m'), ('index_price_kline', '5m'), ('index_price_kline', '1h'),
  ('open_interest', '5m'), ('open_interest', '1h'), ('funding_rate', '8h'), ('long_short_ratio', '5m'), ('long_short_ratio', '1h'),
  ('taker_buy_sell_volume', '5m'), ('taker_buy_sell_volume', '1h'), ('liquidation', 'event')) r(source_dataset, bar_interval)"""
SQL["dashboard_jobs"] = f"""
SELECT {job_name('exchange', 'symbol', 'market_type', 'bar_interval', 'source_dataset', 'id')} AS job_name, {STREAM},
  'incremental' AS fetch_mode, {START}, TRUE AS is_active, base AS base_asset, quote AS quote_asset
FROM dashboard_markets, dashboard_rules
WHERE symbol IS NOT NULL AND (market_type = 'perpetual' OR source_dataset = 'kline')
  AND (source_dataset NOT IN ('long_short_ratio', 'taker_buy_sell_volume') OR (exchange = 'binance' AND market_type = 'perpetual'))"""
SQL["missing_assets"] = "SELECT exchange || ':' || asset AS missing FROM dashboard_markets WHERE symbol IS NULL"
KEY = "regexp_replace(upper({}), '[^A-Z0-9]', '', 'g')"
EXTRA["symbol_requests"] = f"""
SELECT {K3} FROM asset_registry
UNION SELECT exchange, lower(base_asset) || '-' || lower(quote_asset), market_type FROM asset_registry
UNION SELECT exchange, base_asset || '/ZZZ', market_type FROM asset_registry"""
SQL["resolve_symbol"] = f"""
SELECT exchange, symbol, market_type, fetch_symbol, base_asset, quote_asset,
  CASE WHEN fetch_symbol IS NULL THEN 'No market for symbol ' || symbol || ' of type ' || market_type || ' at ' || exchange END AS error_message
FROM (SELECT q.exchange, q.symbol, q.market_type, m.symbol AS fetch_symbol, m.base AS base_asset, m.quote AS quote_asset
  FROM symbol_requests q LEFT JOIN exchange_market m ON m.exchange = q.exchange
    AND CASE q.market_type WHEN 'spot' THEN m.spot WHEN 'perpetual' THEN m.swap OR m.contract ELSE m.future END
    AND {KEY.format('q.symbol')} IN ({KEY.format('m.symbol')}, {KEY.format('m.id')}, {KEY.format('m.base || m.quote')})
  QUALIFY row_number() OVER (PARTITION BY q.exchange, q.symbol, q.market_type
    ORDER BY CASE WHEN m.symbol = q.symbol THEN 0 WHEN coalesce(m.active, TRUE) THEN 1 ELSE 2 END, m.seq) = 1) r"""
SQL["resolve_market"] = "SELECT exchange, asset, symbol, market_type FROM resolved_markets"
SQL["reference_market"] = """
SELECT q.asset, coalesce(r.exchange, 'binance') AS exchange, coalesce(r.symbol, q.asset || '/USDT:USDT') AS symbol,
  coalesce(r.market_type, 'perpetual') AS market_type
FROM (SELECT DISTINCT asset FROM asked_markets) q LEFT JOIN reference_markets r USING (asset)"""
SQL["preferred_markets_any"] = "SELECT exchange, asset, symbol, market_type FROM volume_markets"
SQL["preferred_markets_perp"] = "SELECT exchange, asset, symbol, market_type FROM perp_markets"
SQL["normalize_selection"] = """
SELECT CASE WHEN k % 7 IN (0, 1) THEN 'BTC' ELSE base END AS asset,
  CASE k % 5 WHEN 0 THEN 'binance' WHEN 1 THEN 'all' ELSE exchange END AS exchange,
  CASE k % 3 WHEN 0 THEN '1h' WHEN 1 THEN '5m' ELSE '1m' END AS interval, count(*) AS requests
FROM fx_market_events GROUP BY ALL"""

# --- dashboard -----------------------------------------------------------------------------------------------------

EXTRA["watchlist_rows"] = """
SELECT w.base_asset, w.display_order, list_sort(coalesce(array_agg(DISTINCT s.exchange) FILTER (WHERE s.exchange IS NOT NULL), [])) AS exchanges
FROM watchlist_asset w LEFT JOIN active_registry a ON a.asset = w.base_asset
LEFT JOIN stream_status s ON s.exchange = a.exchange AND s.symbol = a.symbol AND s.market_type = a.market_type
  AND s.source_dataset = 'kline' AND s.row_count > 0
WHERE w.is_active GROUP BY ALL"""
SQL["watchlist"] = "SELECT base_asset, CAST(display_order AS BIGINT) AS display_order, array_to_string(exchanges, ',') AS exchanges FROM watchlist_rows"
SQL["data_status"] = f"SELECT {STREAM}, {ms('first_time')}, {ms('last_time')}, row_count, {ms('last_ingested_at')} FROM stream_status"
SQL["aggregate_volume"] = "SELECT * FROM volume_series"
SQL["volume_breakdown"] = "SELECT * FROM volume_parts"
NO_PRICES = "CAST(NULL AS DOUBLE) AS open, CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS close, CAST(NULL AS DOUBLE) AS volume"
SQL["chart_all"] = f"""
SELECT asset, bar_interval, 'candles' AS series, 'all' AS exchange, asset || '/ALL' AS symbol, 'aggregate' AS market_type, time,
  open, high, low, close, volume, CAST(NULL AS DOUBLE) AS value FROM chart_candles
UNION ALL SELECT asset, bar_interval, series, 'all', asset || '/ALL', 'aggregate', time, {NO_PRICES}, value FROM chart_lines
UNION ALL SELECT asset, bar_interval, 'volumeBreakdown', exchange, NULL, NULL, time, {NO_PRICES}, value FROM volume_parts"""
SQL["chart_single"] = f"""
SELECT asset, bar_interval, {SERIES_NAME} AS series, exchange, symbol, market_type, {sec('open_time')} AS time,
  CASE WHEN source_dataset = 'kline' THEN CAST(open AS DOUBLE) END AS open, CASE WHEN source_dataset = 'kline' THEN CAST(high AS DOUBLE) END AS high,
  CASE WHEN source_dataset = 'kline' THEN CAST(low AS DOUBLE) END AS low, CASE WHEN source_dataset = 'kline' THEN CAST(close AS DOUBLE) END AS close,
  CASE WHEN source_dataset = 'kline' THEN CAST(volume AS DOUBLE) END AS volume,
  CASE WHEN source_dataset <> 'kline' THEN CAST(close AS DOUBLE) END AS value
FROM (SELECT m.*, r.asset FROM market_data_raw m JOIN resolved_markets r USING (exchange, symbol, market_type)
  WHERE m.source_dataset = 'kline' OR m.market_type = 'perpetual'
  QUALIFY row_number() OVER (PARTITION BY r.asset, m.exchange, m.bar_interval, m.source_dataset ORDER BY m.open_time DESC) <= {CHART_ROWS}) x"""
SQL["chart_limit"] = f"SELECT bar_interval, count(*) AS jobs, CAST({CHART_ROWS} AS BIGINT) AS chart_rows FROM job_config GROUP BY bar_interval"
SQL["aggregate_open_interest"] = "SELECT * FROM interest_series"
SQL["open_interest_breakdown"] = "SELECT * FROM interest_parts"
SQL["aggregate_funding"] = "SELECT * FROM funding_series"
SQL["funding_breakdown"] = "SELECT * FROM funding_parts"
SQL["long_short"] = "SELECT * FROM ratio_series"
SQL["long_short_breakdown"] = "SELECT *, 'binance' AS exchange FROM ratio_series"
SQL["taker"] = "SELECT * FROM flow_series"
SQL["taker_breakdown"] = "SELECT *, 'binance' AS exchange FROM flow_series"
SQL["liquidation_bucket"] = f"""
SELECT event_id, {ms("date_trunc('minute', liquidation_time)", 'bucket_1m')},
  epoch_ms(date_trunc('hour', liquidation_time)) + minute(liquidation_time) // 5 * 300000 AS bucket_5m,
  {ms("date_trunc('hour', liquidation_time)", 'bucket_1h')} FROM liquidation_event"""
SQL["aggregate_liquidations"] = "SELECT * FROM liquidation_series"
SQL["liquidation_breakdown"] = "SELECT * FROM liquidation_parts"
EXTRA["interest_single"] = f"""
SELECT {SERIES}, {sec('open_time')} AS time, CAST(coalesce(open_interest_value, open_interest_amount, 0) AS DOUBLE) AS value
FROM ({newest('open_interest_history', SERIES, 'open_time DESC', SERIES_ROWS)}) x"""
EXTRA["ratio_single"] = f"""
SELECT {SERIES}, {sec('open_time')} AS time, long_short_ratio AS value
FROM ({newest('long_short_ratio_history', SERIES, 'open_time DESC', SERIES_ROWS)}) x"""
EXTRA["flow_single"] = f"""
SELECT {SERIES}, {sec('open_time')} AS time, {dbl('buy_volume')}, {dbl('sell_volume')}, buy_sell_ratio
FROM ({newest('taker_buy_sell_volume_history', SERIES, 'open_time DESC', SERIES_ROWS)}) x"""
EXTRA["rate_single"] = f"""
SELECT {K3}, {sec('funding_time')} AS time, CAST(funding_rate AS DOUBLE) AS value
FROM ({newest('funding_rate_history', K3, 'funding_time DESC', FUNDING_ROWS)}) x"""
SQL["open_interest_single"] = "SELECT * FROM interest_single"
SQL["long_short_single"] = "SELECT * FROM ratio_single"
SQL["taker_single"] = "SELECT * FROM flow_single"
SQL["funding_single"] = "SELECT * FROM rate_single"
SQL["liquidation_single"] = "SELECT * FROM liquidation_market_series"

BUNDLE = ["value", "buy_volume", "sell_volume", "buy_sell_ratio", "long_value", "short_value", "total_value"]
SHOWN = "(VALUES ('1m', '5m'), ('5m', '5m'), ('1h', '1h')) i(chart_interval, bar_interval)"


def bundled(series: str, rows: str, present: list[str], interval: str, exchange: str = "CAST(NULL AS VARCHAR)") -> str:
    cells = [c if c in present else f"CAST(NULL AS DOUBLE) AS {c}" for c in BUNDLE]
    count = "event_count" if "total_value" in present else "CAST(NULL AS BIGINT) AS event_count"
    return f"SELECT '{series}' AS series, {interval} AS bar_interval, asset, {exchange} AS exchange, time, {', '.join(cells)}, {count} FROM {rows}"


FLOW, SUMS = ["buy_volume", "sell_volume", "buy_sell_ratio"], ["long_value", "short_value", "total_value"]


def stored(rows: str) -> str:
    return f"(SELECT s.* EXCLUDE (bar_interval), i.chart_interval FROM {rows} s JOIN {SHOWN} USING (bar_interval)) z"


EVERY = "(VALUES ('1m'), ('5m'), ('1h')) i(chart_interval)"
SQL["derivatives_all"] = " UNION ALL ".join(
    [
        bundled("openInterest", stored("interest_series"), ["value"], "chart_interval"),
        bundled("openInterestBreakdown", stored("interest_parts"), ["value"], "chart_interval", "exchange"),
        bundled("longShortRatio", stored("ratio_series"), ["value"], "chart_interval"),
        bundled("longShortRatioBreakdown", stored("ratio_series"), ["value"], "chart_interval", "'binance'"),
        bundled("takerBuySell", stored("flow_series"), FLOW, "chart_interval"),
        bundled("takerBuySellBreakdown", stored("flow_series"), FLOW, "chart_interval", "'binance'"),
        bundled("fundingRate", f"funding_series, {EVERY}", ["value"], "chart_interval"),
        bundled("fundingRateBreakdown", f"funding_parts, {EVERY}", ["value"], "chart_interval", "exchange"),
        bundled("liquidations", "liquidation_series", SUMS, "bar_interval"),
        bundled("liquidationBreakdown", "liquidation_parts", SUMS, "bar_interval", "exchange"),
    ]
)


def of_market(rows: str) -> str:
    return f"(SELECT s.*, r.asset FROM {rows} s JOIN resolved_markets r USING (exchange, symbol, market_type)) y"


SQL["derivatives_single"] = " UNION ALL ".join(
    [
        bundled("openInterest", stored(f"{of_market('interest_single').replace(' y', '')}"), ["value"], "chart_interval", "exchange"),
        bundled("longShortRatio", stored(f"{of_market('ratio_single').replace(' y', '')}"), ["value"], "chart_interval", "exchange"),
        bundled("takerBuySell", stored(f"{of_market('flow_single').replace(' y', '')}"), FLOW, "chart_interval", "exchange"),
        bundled("fundingRate", f"{of_market('rate_single')}, {EVERY}", ["value"], "chart_interval", "exchange"),
        bundled("liquidations", of_market("liquidation_market_series"), SUMS, "bar_interval", "exchange"),
    ]
)
SQL["interval_fallback"] = f"""
SELECT exchange, points, i.chart_interval, i.bar_interval AS series_interval
FROM (SELECT exchange, count(*) AS points FROM open_interest_history GROUP BY exchange) o, {SHOWN}"""

# --- factors -------------------------------------------------------------------------------------------------------------

SERIES_LIST = SERIES.split(", ")
EXTRA["candle_nearest"] = nearest("candles", "interest_points", SERIES_LIST, ["value"])
ON_SERIES = f"USING ({SERIES}, time)"
C_SERIES = ", ".join("c." + c for c in SERIES_LIST)
SQL["nearest_join"] = f"""
SELECT {C_SERIES}, c.time, n.p.time AS point_time, n.p.value AS value FROM candles c LEFT JOIN candle_nearest n {ON_SERIES}"""
SQL["nearest_join_within"] = f"""
SELECT {C_SERIES}, c.time, CASE WHEN abs(n.p.time - c.time) <= 3600 THEN n.p.time END AS point_time,
  CASE WHEN abs(n.p.time - c.time) <= 3600 THEN n.p.value END AS value
FROM candles c LEFT JOIN candle_nearest n {ON_SERIES}"""
SQL["oi_volume_ratio"] = f"""
SELECT {C_SERIES}, c.time, round(n.p.value / c.volume, 9) AS value FROM candles c JOIN candle_nearest n {ON_SERIES} WHERE c.volume > 0"""

SEL = ["asset", "bar_interval"]
IN_RANGE = "(SELECT s.* FROM {} s JOIN chart_ranges g USING (asset, bar_interval) WHERE s.time BETWEEN g.first_time AND g.last_time)"
EACH = "(VALUES ('5m'), ('1h')) i(bar_interval)"
EXTRA["seen_volume"] = f"SELECT * FROM {IN_RANGE.format('volume_parts')} v"
EXTRA["seen_interest"] = f"SELECT * FROM {IN_RANGE.format('interest_parts')} v"
EXTRA["seen_ratio"] = f"""
SELECT asset, bar_interval, time, 'binance' AS exchange, min(value) AS value FROM {IN_RANGE.format('ratio_series')} v GROUP BY ALL"""
EXTRA["seen_flow"] = f"""
SELECT asset, bar_interval, time, 'binance' AS exchange, first.buy_volume, first.sell_volume, coalesce(first.buy_sell_ratio, -1) AS ratio
FROM (SELECT asset, bar_interval, time, list({{'buy_volume': buy_volume, 'sell_volume': sell_volume, 'buy_sell_ratio': buy_sell_ratio}}
    ORDER BY buy_volume, sell_volume)[1] AS first FROM {IN_RANGE.format('flow_series')} v GROUP BY ALL) g"""
EXTRA["seen_liquidations"] = f"SELECT * FROM {IN_RANGE.format('liquidation_parts')} v"
EXTRA["seen_funding"] = f"SELECT * FROM {IN_RANGE.format('(SELECT * FROM funding_parts, ' + EACH + ')')} v"
EXTRA["seen_exchanges"] = " UNION ".join(
    f"SELECT DISTINCT asset, bar_interval, exchange FROM seen_{n}" for n in ("volume", "interest", "ratio", "flow", "liquidations", "funding")
)
EXTRA["matrix_rows"] = """
SELECT c.asset, c.bar_interval, c.time, e.exchange, g.step_seconds FROM chart_candles c
JOIN seen_exchanges e USING (asset, bar_interval) JOIN chart_ranges g USING (asset, bar_interval)"""
SEL_EX = [*SEL, "exchange"]
for _name, _values in {
    "volume": ["value"], "interest": ["value"], "ratio": ["value"], "flow": ["buy_volume", "sell_volume", "ratio"],
    "liquidations": ["total_value"], "funding": ["value"],
}.items():
    EXTRA[f"near_{_name}"] = nearest("matrix_rows", f"seen_{_name}", SEL_EX, _values)


def held(alias: str, value: str, tolerance: str, row: str = "m") -> str:
    return f"CASE WHEN abs({alias}.p.time - {row}.time) <= {tolerance} THEN {alias}.p.{value} END"


TOL = {"v": "greatest(m.step_seconds * 0.75, 60)", "s": "greatest(m.step_seconds * 1.2, 360)", "l": "greatest(m.step_seconds * 0.45, 1)"}
M_KEYS = "USING (asset, bar_interval, exchange, time)"
SQL["exchange_matrix"] = f"""
SELECT asset, bar_interval, exchange, time, volume, open_interest,
  round(CASE WHEN volume > 0 THEN open_interest / volume END, 9) AS oi_volume_ratio, long_short_ratio, taker_buy_volume,
  taker_sell_volume, nullif(taker_ratio, -1) AS taker_buy_sell_ratio, liquidation, funding
FROM (SELECT m.asset, m.bar_interval, m.exchange, m.time, {held('v', 'value', TOL['v'])} AS volume,
    {held('o', 'value', TOL['s'])} AS open_interest, {held('r', 'value', TOL['s'])} AS long_short_ratio,
    {held('w', 'buy_volume', TOL['s'])} AS taker_buy_volume, {held('w', 'sell_volume', TOL['s'])} AS taker_sell_volume,
    {held('w', 'ratio', TOL['s'])} AS taker_ratio, coalesce({held('q', 'total_value', TOL['l'])}, 0) AS liquidation,
    {held('f', 'value', '28860')} AS funding
  FROM matrix_rows m LEFT JOIN near_volume v {M_KEYS} LEFT JOIN near_interest o {M_KEYS} LEFT JOIN near_ratio r {M_KEYS}
  LEFT JOIN near_flow w {M_KEYS} LEFT JOIN near_liquidations q {M_KEYS} LEFT JOIN near_funding f {M_KEYS}) x"""

EXTRA["all_liquidations"] = f"SELECT * FROM {IN_RANGE.format('liquidation_series')} v"
EXTRA["point_rows"] = "SELECT c.*, g.step_seconds FROM chart_candles c JOIN chart_ranges g USING (asset, bar_interval)"
EXTRA["near_all_liquidations"] = nearest("point_rows", "all_liquidations", SEL, ["long_value", "short_value", "total_value", "event_count"])
LIQ = ", ".join(
    [f"coalesce({held('q', 'time', TOL['l'])}, m.time) AS liquidation_time"]
    + [f"coalesce({held('q', c, TOL['l'])}, 0) AS {c}" for c in ("long_value", "short_value", "total_value", "event_count")]
)
P_KEYS = "USING (asset, bar_interval, time)"
SQL["liquidation_or_zero"] = f"""
SELECT m.asset, m.bar_interval, m.time, {LIQ} FROM point_rows m LEFT JOIN near_all_liquidations q {P_KEYS}"""
SQL["bar_step"] = f"""
SELECT {SERIES}, count(*) AS points, min(time) AS first_time, max(time) AS last_time,
  greatest(60, CAST(floor((max(time) - min(time)) / greatest(count(*) - 1, 1) + 0.5) AS BIGINT)) AS step_seconds
FROM candles GROUP BY {SERIES}"""
SQL["time_range_filter"] = f"SELECT {SERIES}, time, close FROM candles WHERE time BETWEEN 1704672000 AND 1705881600"

EXTRA["mark_points"] = f"SELECT * FROM {IN_RANGE.format('chart_lines')} v WHERE series = 'markPrice'"
EXTRA["index_points"] = f"SELECT * FROM {IN_RANGE.format('chart_lines')} v WHERE series = 'indexPrice'"
EXTRA["oi_points"] = f"SELECT * FROM {IN_RANGE.format('interest_series')} v"
EXTRA["full_oi_near"] = nearest("chart_candles", "interest_series", SEL, ["value"])
EXTRA["oiv_points"] = """
SELECT c.asset, c.bar_interval, c.time, n.p.value / c.volume AS value FROM chart_candles c JOIN full_oi_near n USING (asset, bar_interval, time)
WHERE c.volume > 0"""
EXTRA["rate_points"] = f"SELECT * FROM {IN_RANGE.format('(SELECT * FROM funding_series, ' + EACH + ')')} v"
for _name, _rows, _values in [
    ("mark", "mark_points", ["value"]), ("index", "index_points", ["value"]), ("oi", "oi_points", ["value"]),
    ("oiv", "oiv_points", ["value"]), ("lsr", "seen_ratio", ["value"]), ("tk", "seen_flow", ["buy_volume", "sell_volume", "ratio"]),
    ("rate", "rate_points", ["value"]),
]:
    EXTRA[f"point_{_name}"] = nearest("point_rows", _rows, SEL, _values)
SQL["market_point"] = f"""
SELECT m.asset, m.bar_interval, m.time, m.close, m.volume, a.p.value AS mark, b.p.value AS index, o.p.value AS open_interest,
  round(v.p.value, 9) AS oi_volume_ratio, r.p.value AS long_short_ratio, w.p.buy_volume AS taker_buy_volume,
  w.p.sell_volume AS taker_sell_volume, nullif(w.p.ratio, -1) AS taker_buy_sell_ratio, f.p.value AS funding, {LIQ}
FROM point_rows m LEFT JOIN point_mark a {P_KEYS} LEFT JOIN point_index b {P_KEYS} LEFT JOIN point_oi o {P_KEYS}
LEFT JOIN point_oiv v {P_KEYS} LEFT JOIN point_lsr r {P_KEYS} LEFT JOIN point_tk w {P_KEYS} LEFT JOIN point_rate f {P_KEYS}
LEFT JOIN near_all_liquidations q {P_KEYS}"""


def last_point(rows: str, value: str, name: str, extra: str = "") -> str:
    return f"(SELECT asset, bar_interval, arg_max({value}, time) AS {name} FROM {rows} GROUP BY ALL) {extra or name}_last"


SQL["latest_snapshot"] = f"""
SELECT asset, bar_interval, time, close, volume, previous_close, mark, index, open_interest, long_short_ratio, taker_buy_sell_ratio,
  funding, liquidation, round((close - previous_close) / nullif(previous_close, 0), 12) AS move,
  round(CASE WHEN mark <> 0 AND index <> 0 THEN (mark - index) / index END, 12) AS basis,
  round(CASE WHEN volume > 0 THEN open_interest / volume END, 12) AS oi_volume_ratio
FROM (SELECT asset, bar_interval, max(time) AS time, arg_max(close, time) AS close, arg_max(volume, time) AS volume,
    CASE WHEN count(*) > 1 THEN (list(close ORDER BY time DESC))[2] END AS previous_close FROM chart_candles GROUP BY ALL) c
LEFT JOIN {last_point("(SELECT * FROM chart_lines WHERE series = 'markPrice')", 'value', 'mark')} USING (asset, bar_interval)
LEFT JOIN {last_point("(SELECT * FROM chart_lines WHERE series = 'indexPrice')", 'value', 'index', 'idx')} USING (asset, bar_interval)
LEFT JOIN {last_point('interest_series', 'value', 'open_interest')} USING (asset, bar_interval)
LEFT JOIN (SELECT asset, bar_interval, (list(value ORDER BY time DESC, value DESC))[1] AS long_short_ratio FROM ratio_series GROUP BY ALL) l USING (asset, bar_interval)
LEFT JOIN (SELECT asset, bar_interval, (list(buy_sell_ratio ORDER BY time DESC, buy_sell_ratio DESC))[1] AS taker_buy_sell_ratio FROM flow_series GROUP BY ALL) w USING (asset, bar_interval)
LEFT JOIN (SELECT asset, arg_max(value, time) AS funding FROM funding_series GROUP BY ALL) f USING (asset)
LEFT JOIN {last_point('liquidation_series', 'total_value', 'liquidation')} USING (asset, bar_interval)"""
SQL["selection_status"] = f"""
SELECT a.asset, 'all' AS selected_exchange, {', '.join('s.' + c for c in STREAM.split(', '))}, s.row_count, {ms('s.last_time', 'last_time')}
FROM (SELECT DISTINCT asset FROM asked_markets) a JOIN stream_status s ON upper(split_part(s.symbol, '/', 1)) = a.asset
UNION ALL
SELECT r.asset, r.exchange, {', '.join('s.' + c for c in STREAM.split(', '))}, s.row_count, epoch_us(s.last_time) // 1000
FROM resolved_markets r JOIN stream_status s USING (exchange, symbol, market_type)"""
SQL["asset_availability"] = """
SELECT base_asset, e.exchange, CASE WHEN e.exchange = 'all' THEN len(exchanges) > 0 ELSE list_contains(exchanges, e.exchange) END AS available
FROM watchlist_rows, (VALUES ('all'), ('binance'), ('bybit'), ('kucoinfutures'), ('coinbase')) e(exchange)"""
SQL["exchange_order"] = """
SELECT DISTINCT prefix || exchange AS exchange,
  CAST(CASE WHEN prefix = '' THEN list_position(['binance', 'bybit', 'kucoinfutures', 'coinbase'], exchange) ELSE 5 END AS BIGINT) AS position
FROM fx_market_events, (VALUES (''), ('x-')) p(prefix)"""
SQL["signed_flow"] = """
SELECT asset, bar_interval, time, 'taker' AS series, buy_volume AS up, -sell_volume AS down FROM flow_series
UNION ALL SELECT asset, bar_interval, time, 'liquidation', short_value, -long_value FROM liquidation_series"""
EXTRA["bound_points"] = f"""
SELECT {SERIES}, 'close' AS series, close AS value FROM candles UNION ALL SELECT {SERIES}, 'volume', volume FROM candles
UNION ALL SELECT {SERIES}, 'open_interest', value FROM interest_points"""
EXTRA["bound_ends"] = f"""
SELECT {SERIES}, series, CASE WHEN low = high THEN low - abs(CASE low WHEN 0 THEN 1 ELSE low END) * 0.01 ELSE low END AS low,
  CASE WHEN low = high THEN high + abs(CASE high WHEN 0 THEN 1 ELSE high END) * 0.01 ELSE high END AS high, greatest(edge, 1e-9) AS edge
FROM (SELECT {SERIES}, series, min(value) AS low, max(value) AS high, max(abs(value)) AS edge FROM bound_points GROUP BY ALL) b"""
SQL["series_bounds"] = f"""
SELECT {SERIES}, series, round(low - (high - low) * CAST(0.08 AS DOUBLE), 6) AS min, round(high + (high - low) * CAST(0.08 AS DOUBLE), 6) AS max, FALSE AS symmetric FROM bound_ends
UNION ALL SELECT {SERIES}, series, round(-edge * CAST(1.15 AS DOUBLE), 6), round(edge * CAST(1.15 AS DOUBLE), 6), TRUE FROM bound_ends"""
def axis_ranges(where: str) -> str:
    spread = "CASE WHEN low = high THEN {0} {1} abs(CASE low WHEN 0 THEN 1 ELSE low END) * 0.01 ELSE {0} END"
    low, high = spread.format("low", "-"), spread.format("high", "+")
    return f"""
SELECT * FROM (WITH shown AS (
  SELECT asset, bar_interval, 'price' AS panel, unnest([high, low]) AS value FROM chart_candles WHERE {where}
  UNION ALL SELECT asset, bar_interval, 'price', value FROM chart_lines WHERE {where}
  UNION ALL SELECT asset, bar_interval, 'volume', unnest([0, volume]) FROM chart_candles WHERE {where}),
mirrored AS (
  SELECT asset, bar_interval, 'taker' AS panel, unnest([buy_volume, sell_volume]) AS value FROM flow_series WHERE {where}
  UNION ALL SELECT asset, bar_interval, 'liquidation', unnest([long_value, short_value]) FROM liquidation_series
  WHERE {where} AND bar_interval IN ('5m', '1h')),
ends AS (SELECT asset, bar_interval, panel, {low} AS low, {high} AS high FROM (
  SELECT asset, bar_interval, panel, min(value) AS low, max(value) AS high FROM shown GROUP BY ALL) e)
SELECT asset, bar_interval, panel, round(low - (high - low) * CAST(0.08 AS DOUBLE), 6) AS min,
  round(high + (high - low) * CAST(0.08 AS DOUBLE), 6) AS max FROM ends
UNION ALL SELECT asset, bar_interval, panel, round(-greatest(max(value), 1), 6), round(greatest(max(value), 1), 6) FROM mirrored GROUP BY ALL) q"""


SQL["axis_ranges"] = axis_ranges("TRUE")
SQL["axis_ranges_visible"] = axis_ranges("time BETWEEN 1704672000 AND 1705881600")
SQL["local_time"] = """
SELECT event_id, epoch_us(liquidation_time + INTERVAL 8 HOUR) // 1000 AS local_time, strftime(liquidation_time + INTERVAL 8 HOUR, '%b %d, %I:%M %p') AS local_text
FROM liquidation_event"""
SQL["rolling_zscore"] = """
SELECT asset, bar_interval, time, value, round(CASE WHEN sd > 0 THEN (value - mean) / sd END, 6) AS zscore
FROM (SELECT *, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS sd FROM interest_series
  WINDOW w AS (PARTITION BY asset, bar_interval ORDER BY time ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)) z"""
SQL["liquidation_ratio"] = """
SELECT asset, bar_interval, time, round(long_value / nullif(long_value + short_value, 0), 9) AS long_share FROM liquidation_series"""

# --- streaming --------------------------------------------------------------------------------------------------------------

STORED_EVENTS = f"{K3}, liquidation_time, side, price, amount, cost, source_dataset"
SQL["liquidation_stream"] = f"SELECT {STORED_EVENTS} FROM live_events"
SQL["flush_summary"] = f"""
SELECT job_name, {STREAM}, min(liquidation_time) AS request_start, max(liquidation_time) AS request_end, 'success' AS status,
  count(*) AS rows_fetched, count(*) AS rows_inserted FROM live_events GROUP BY ALL"""
SQL["liquidation_flushes"] = f"""
SELECT {K3}, strftime(make_timestamp(liquidation_time * 1000), '%Y-%m-%d') AS day, count(*) AS events,
  (SELECT CAST(ceil(count(*) / 200.0) AS BIGINT) FROM force_order_raw) AS flushes FROM live_events GROUP BY ALL"""
SQL["stream_bounds"] = """
SELECT least(40, count(*)) AS events_seen, least(40, count(*)) AS rows_inserted, least(40, count(*)) AS stored FROM live_events"""
SQL["stream_totals"] = """
SELECT count(DISTINCT symbol) AS symbols, count(*) AS events_seen, count(*) AS rows_inserted FROM live_events"""
EXTRA["both_events"] = f"""
SELECT {K3}, i.bar_interval, time_bucket(to_seconds(i.width), liquidation_time) AS bucket_time, lower(side) AS side,
  coalesce(cost, price * amount, 0) AS notional
FROM (SELECT {K3}, make_timestamp(liquidation_time * 1000) AS liquidation_time, side, price, amount, cost FROM live_events
  UNION ALL SELECT {K3}, liquidation_time, side, price, amount, cost FROM liquidation_event) e,
  (VALUES ('1m', 60), ('5m', 300), ('1h', 3600)) i(bar_interval, width)
WHERE market_type = 'perpetual'"""
EXTRA["both_totals"] = f"""
SELECT a.asset, l.bar_interval, {sec('bucket_time')} AS time, {LIQUIDATION_SUMS}
FROM both_events l JOIN active_registry a USING (exchange, symbol, market_type) GROUP BY ALL"""
SQL["live_dashboard"] = newest("both_totals", "asset, bar_interval", "time DESC", SERIES_ROWS)
SQL["streaming_liquidation_buckets"] = f"""
SELECT {SERIES}, {ms('bucket_time')}, {LIQUIDATION_SUMS} FROM sized_liquidations GROUP BY {SERIES}, bucket_time"""

# --- short series --------------------------------------------------------------------------------------------------------------
# the same results with the newest CUT rows or times of each group, so that every group of some length is cut

CUT = 4
CUT_QUERIES = """
aggregate_volume volume_breakdown aggregate_open_interest open_interest_breakdown aggregate_funding funding_breakdown
long_short taker aggregate_liquidations liquidation_breakdown open_interest_single long_short_single taker_single
funding_single liquidation_single
""".split()
for name in CUT_QUERIES:
    fixture = SQL[name].split()[-1]
    SQL[f"{name}_cut"] = re.sub(r"<= (CASE .*? END|\d+)", f"<= {CUT}", EXTRA[fixture])
SQL["latest_bars_cut"] = re.sub(r"<= \d+", f"<= {CUT}", SQL["latest_bars"])
