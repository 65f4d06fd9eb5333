"""Schemas of the stored tables. Times are UTC timestamps, JSON is text."""

from __future__ import annotations

from pyspark.sql import types as T

_K3 = "exchange string, symbol string, market_type string"
_RUN = "ingested_at timestamp, run_id string"

DDL = {
    "asset_registry": f"{_K3}, base_asset string, quote_asset string, is_active boolean, updated_at timestamp",
    "ingestion_job_config": (
        f"job_id string, job_name string, {_K3}, bar_interval string, source_dataset string, fetch_mode string, "
        "start_time timestamp, end_time timestamp, is_active boolean, notes string, updated_at timestamp"
    ),
    "watchlist_asset": "base_asset string, display_order bigint, is_active boolean, updated_at timestamp",
    "market_data_raw": (
        f"{_K3}, bar_interval string, source_dataset string, open_time timestamp, close_time timestamp, "
        "open decimal(30,18), high decimal(30,18), low decimal(30,18), close decimal(30,18), volume decimal(28,8), "
        f"quote_volume decimal(28,8), trade_count bigint, {_RUN}"
    ),
    "open_interest_history": (
        f"{_K3}, bar_interval string, open_time timestamp, open_interest_amount decimal(38,10), "
        "open_interest_value decimal(38,10), base_volume decimal(38,10), quote_volume decimal(38,10), "
        f"source_dataset string, {_RUN}"
    ),
    "funding_rate_history": (
        f"{_K3}, funding_time timestamp, funding_rate decimal(25,15), mark_price decimal(38,10), "
        f"index_price decimal(38,10), next_funding_time timestamp, source_dataset string, {_RUN}"
    ),
    "long_short_ratio_history": (
        f"{_K3}, bar_interval string, open_time timestamp, long_short_ratio decimal(20,10), "
        f"long_account decimal(20,10), short_account decimal(20,10), source_dataset string, {_RUN}"
    ),
    "taker_buy_sell_volume_history": (
        f"{_K3}, bar_interval string, open_time timestamp, buy_volume decimal(28,8), sell_volume decimal(28,8), "
        f"buy_sell_ratio decimal(20,10), source_dataset string, {_RUN}"
    ),
    "liquidation_event": (
        f"{_K3}, liquidation_time timestamp, side string, price decimal(30,18), amount decimal(28,8), "
        f"cost decimal(38,14), source_dataset string, raw string, {_RUN}"
    ),
    "ingestion_run_log": (
        f"run_id string, job_id string, job_name string, {_K3}, bar_interval string, dataset string, "
        "request_start timestamp, request_end timestamp, status string, rows_fetched bigint, rows_inserted bigint, "
        "rows_updated bigint, error_message string, started_at timestamp, ended_at timestamp"
    ),
    "data_quality_issue": (
        f"{_K3}, bar_interval string, source_dataset string, issue_type string, issue_start_time timestamp, "
        "issue_end_time timestamp, expected_count bigint, actual_count bigint, severity string, detail string, "
        "detected_at timestamp, run_id string"
    ),
}


def schema_of(table: str) -> T.StructType:
    """StructType of a stored table."""
    return T.StructType.fromDDL(DDL[table])


# unique key, time column and physical layout of the insert-if-absent tables
UNIQUE_KEY = {
    "market_data_raw": ["exchange", "symbol", "market_type", "bar_interval", "source_dataset", "open_time"],
    "open_interest_history": ["exchange", "symbol", "market_type", "bar_interval", "open_time"],
    "funding_rate_history": ["exchange", "symbol", "market_type", "funding_time"],
    "long_short_ratio_history": ["exchange", "symbol", "market_type", "bar_interval", "open_time"],
    "taker_buy_sell_volume_history": ["exchange", "symbol", "market_type", "bar_interval", "open_time"],
}
TIME_COLUMN = {
    "market_data_raw": "open_time",
    "open_interest_history": "open_time",
    "funding_rate_history": "funding_time",
    "long_short_ratio_history": "open_time",
    "taker_buy_sell_volume_history": "open_time",
    "liquidation_event": "liquidation_time",
}
LAYOUT = {
    "market_data_raw": ["source_dataset", "bar_interval"],
    "open_interest_history": ["bar_interval"],
    "funding_rate_history": [],
    "long_short_ratio_history": ["bar_interval"],
    "taker_buy_sell_volume_history": ["bar_interval"],
}
