"""Names, limits and rank tables that results depend on."""

# --- keys -------------------------------------------------------------------
MARKET_KEY = ["exchange", "symbol", "market_type"]
SERIES_KEY = MARKET_KEY + ["bar_interval"]
STREAM_KEY = SERIES_KEY + ["source_dataset"]

# --- fixed values: interval units and cadences (seconds) ---------------------
INTERVAL_UNIT_SECONDS = {"m": 60, "h": 3600, "d": 86400, "w": 604800}
CADENCE_UNIT_SECONDS = {"m": 60, "h": 3600, "d": 86400}
CADENCE_FALLBACK_SECONDS = 60
CADENCE_FLOOR_SECONDS = 30
DATASET_CADENCE_SECONDS = {"funding_rate": 300, "liquidation": 60}

# --- fixed values: datasets ---------------------------------------------------
OHLCV_DATASETS = ["kline", "mark_price_kline", "index_price_kline"]
DATASET_FAMILY = {
    "kline": "ohlcv",
    "mark_price_kline": "ohlcv",
    "index_price_kline": "ohlcv",
    "open_interest": "open_interest",
    "funding_rate": "funding_rate",
    "long_short_ratio": "long_short_ratio",
    "taker_buy_sell_volume": "taker_buy_sell_volume",
    "liquidation": "liquidation",
}
ALL_DATASETS = list(DATASET_FAMILY)

# --- fixed values: request planning -------------------------------------------
RATIO_INTERVALS = ["5m", "15m", "30m", "1h", "2h", "4h", "6h", "12h", "1d"]
KUCOIN_OPEN_INTEREST_INTERVALS = ["5m", "15m", "30m", "1h", "4h", "1d"]
BINANCE_RETENTION_DAYS = 29
KUCOIN_RETENTION_DAYS = 7
KUCOIN_DAILY_RETENTION_DAYS = 70
LATE_DATA_INTERVALS = 2

# --- fixed values: messages -----------------------------------------------------
MESSAGE_RATIO_EXCHANGE = "{dataset} is read from binance only."
MESSAGE_RATIO_INTERVAL = "binance has no {dataset} at interval {interval}."
MESSAGE_KUCOIN_INTERVAL = "kucoinfutures has no open interest at interval {interval}."
MESSAGE_BINANCE_LIQUIDATION = "binance liquidations come from the live stream only."
MESSAGE_NO_LIQUIDATIONS = "The exchange publishes no liquidations."
MESSAGE_NO_METHOD = "The exchange lacks {method}."
SEED_JOB_NOTE = "Seeded from the market registry."

# --- fixed values: seeding ------------------------------------------------------
DEFAULT_EXCHANGES = ["binance", "bybit", "coinbase", "kucoin", "kucoinfutures"]
MARKET_TYPES_BY_EXCHANGE = {
    "binance": ["spot", "perpetual", "future"],
    "bybit": ["spot", "perpetual", "future"],
    "coinbase": ["spot"],
    "kucoin": ["spot"],
    "kucoinfutures": ["perpetual", "future"],
}
WATCHLIST_ASSETS = ["BTC", "ETH", "MYX", "MOVR", "UB", "HUMA", "RAVE", "BNT", "TAIKO", "LAB"]
DASHBOARD_EXCHANGES = ["binance", "bybit", "kucoinfutures", "coinbase"]
DASHBOARD_INTERVALS = ["1m", "5m", "1h"]
SPOT_QUOTE_PRIORITY = ["USD", "USDC", "USDT"]
DERIVED_SERIES_INTERVALS = ["5m", "1h"]

# --- fixed values: selection defaults -------------------------------------------
SELECTION_EXCHANGES = ["all", "binance", "bybit", "kucoinfutures", "coinbase"]
SELECTION_INTERVALS = ["1m", "5m", "1h"]
ASSET_PATTERN = r"\A[A-Z0-9]{2,15}\z"

# --- fixed values: series lengths -------------------------------------------------
CHART_ROWS = {"1m": 1440, "5m": 1200}
CHART_ROWS_OTHER = 1000
SERIES_ROWS = 600
FUNDING_ROWS = 240

# --- fixed values: market ranks, first matching row wins; None matches anything ---
# (exchange, market_type, quote_asset, rank)
SINGLE_MARKET_RANK = [
    ("coinbase", "spot", "USD", 0),
    ("coinbase", "spot", "USDC", 1),
    ("coinbase", "spot", "USDT", 2),
    (None, "perpetual", "USDT", 0),
    (None, "spot", "USDT", 3),
]
REFERENCE_MARKET_RANK = [
    ("binance", "perpetual", "USDT", 0),
    ("bybit", "perpetual", "USDT", 1),
    ("kucoinfutures", "perpetual", None, 2),
    ("coinbase", "spot", "USD", 3),
    (None, "perpetual", None, 4),
]
VOLUME_MARKET_RANK = [
    ("coinbase", "spot", "USD", 0),
    ("coinbase", "spot", "USDC", 1),
    ("coinbase", "spot", "USDT", 2),
    (None, "perpetual", "USDT", 0),
    (None, "perpetual", None, 1),
    (None, "spot", "USDT", 4),
    (None, "spot", "USD", 5),
    (None, "spot", "USDC", 6),
]
PERPETUAL_QUOTE_RANK = [
    (None, None, "USDT", 0),
    (None, None, "USD", 1),
    (None, None, "USDC", 2),
]
UNRANKED = 9

# --- fixed values: liquidation sides -----------------------------------------------
LONG_SIDES = ["sell", "long"]
SHORT_SIDES = ["buy", "short"]

# --- fixed values: nearest-point tolerances: (factor of the bar step, floor seconds) --
TOLERANCE_VOLUME = (0.75, 60.0)
TOLERANCE_SERIES = (1.2, 360.0)
TOLERANCE_LIQUIDATION = (0.45, 1.0)
TOLERANCE_FUNDING_SECONDS = 8 * 3600 + 60
MIN_STEP_SECONDS = 60
DISPLAY_TIME_ZONE = "Asia/Taipei"
EXCHANGE_DISPLAY_ORDER = ["binance", "bybit", "kucoinfutures", "coinbase"]
