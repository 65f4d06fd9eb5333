"""Hand-made rows with known results."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions import text as X
from tidemark.functions import timegrid as G
from tidemark.operators import dashboard as D
from tidemark.operators import factors as FA
from tidemark.operators import markets as M
from tidemark.operators import normalize as N
from tidemark.operators import quality as Q
from tidemark.operators import seeding as SE
from tidemark.plans import requests as P

BASE = dt.datetime(2024, 1, 1)
KEY = ("binance", "BTC/USDT:USDT", "perpetual")
STREAM = (*KEY, "1h", "kline")
MS = 1704067200000


def at(minutes):
    return BASE + dt.timedelta(minutes=minutes)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def naive(value):
    return value.replace(tzinfo=None) if value is not None else None


# --- time grid -------------------------------------------------------------------


@pytest.mark.parametrize(
    "interval, expected", [("5m", dt.datetime(2024, 1, 3, 10, 0)), ("1h", dt.datetime(2024, 1, 3, 9)), ("1w", dt.datetime(2023, 12, 21))]
)
def test_closed_bar(spark, interval, expected):
    now = G.as_timestamp("2024-01-03 10:07:30")
    assert one(spark, G.floor_closed_bar(now, G.interval_seconds(F.lit(interval)))) == expected


def test_interval_seconds(spark):
    assert one(spark, G.interval_seconds(F.lit("2w"))) == 1209600
    for text in ("1M", "event", "m", "1.5h"):
        assert one(spark, G.interval_seconds_or_null(F.lit(text))) is None
        with pytest.raises(Exception, match="Unknown interval"):
            one(spark, G.interval_seconds(F.lit(text)))


@pytest.mark.parametrize(
    "dataset, interval, expected",
    [("kline", "1M", 60), ("kline", "event", 60), ("kline", "2w", 60), ("kline", "1H", 3600), ("kline", "1m", 60),
     ("funding_rate", "8h", 300), ("liquidation", "event", 60), ("kline", "0m", 30)],
)
def test_cadence(spark, dataset, interval, expected):
    assert one(spark, G.cadence_seconds(F.lit(dataset), F.lit(interval))) == expected


# --- text ------------------------------------------------------------------------


def test_native_symbol(spark):
    for symbol, expected in [("BTC/USDT:USDT", "BTCUSDT"), ("BTC", "BTCUSDT"), ("btc/usd", "BTCUSD"), ("/USDT", None), ("BTC/:X", None)]:
        assert one(spark, X.native_symbol(F.lit(symbol))) == expected
    with pytest.raises(Exception, match="Cannot convert"):
        one(spark, X.checked_native_symbol(F.lit("/USDT")))


def test_job_name(spark):
    import hashlib

    name = one(spark, X.job_name(*[F.lit(v) for v in ("binance", "BTC/USDT:USDT", "perpetual", "1h", "kline", "BTCUSDT")]))
    suffix = hashlib.sha1(b"binance|BTC/USDT:USDT|perpetual|1h|kline|BTCUSDT").hexdigest()[:8]
    assert name == f"binance_btc_usdt_usdt_btcusdt_perpetual_1h_kline_{suffix}"
    assert one(spark, X.job_part(F.lit("--"))) == "unknown"


# --- normalisation -------------------------------------------------------------------


def landed(spark, payloads, dataset="kline", interval="1h"):
    rows = [(*KEY, interval, dataset, i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "exchange string, symbol string, market_type string, bar_interval string, source_dataset string, fetch_seq bigint, payload string")


def test_last_candle_wins_and_null_volume_is_zero(spark):
    rows = landed(spark, [[MS, 1, 2, 1, 1, 5], [MS, 1, 2, 1, 2, None], [MS + 3600000, 1, 1, 1, 1, 1]])
    bars = {r["open_time"]: r for r in N.normalize_ohlcv(rows).collect()}
    assert len(bars) == 2
    first = bars[BASE]
    assert (float(first["close"]), float(first["volume"]), first["copies"]) == (2, 0, 2)
    assert first["close_time"] == at(60) and first["quote_volume"] is None and first["trade_count"] is None
    repeats = N.repeats_of(N.collapse_bars(N.decode_ohlcv(rows))).collect()
    assert [(r["open_time"], r["repeats"]) for r in repeats] == [(BASE, 1)]


def test_malformed_candles_are_marked(spark):
    rows = landed(spark, [[MS, None, 2, 1, 1, 5], "[\"x\",1,1,1,1,1]", [MS, 1, 1, 1, 1, 1], "[1704067200000,1e2,\"3.25\",1,1,\"0\"]"])
    flags = [r["malformed"] for r in N.decode_ohlcv(rows).orderBy("fetch_seq").collect()]
    assert flags == [True, True, False, False]
    assert float(N.decode_ohlcv(rows).where("fetch_seq = 3").first()["open"]) == 100


def test_liquidation_amount_falls_through_zero(spark):
    rows = landed(spark, [{"timestamp": MS, "amount": 0, "contracts": 5}, {"timestamp": None, "amount": 1}, {"timestamp": MS, "amount": 2, "contracts": 5}], "liquidation")
    assert [float(r["amount"]) for r in N.normalize_liquidations(rows).orderBy("fetch_seq").collect()] == [5, 2]


def test_funding_drops_and_falsy_next_time(spark):
    rows = landed(
        spark,
        [{"timestamp": MS, "fundingRate": 1e-05, "info": {"markPrice": "1.5", "nextFundingTime": 0}},
         {"timestamp": MS, "fundingRate": None}, {"timestamp": None, "fundingRate": 1},
         {"timestamp": MS + 1, "fundingRate": "0.0001", "info": {"nextFundingTime": str(MS)}}],
        "funding_rate",
    )
    got = N.normalize_funding(rows).orderBy("fetch_seq").collect()
    assert [float(r["funding_rate"]) for r in got] == [0.00001, 0.0001]
    assert got[0]["next_funding_time"] is None and got[1]["next_funding_time"] == BASE and float(got[0]["mark_price"]) == 1.5


def live_jobs(spark, symbols=("BTC/USDT:USDT",)):
    rows = [("id", f"job {s}", "binance", s, "perpetual", "event", "liquidation") for s in symbols]
    return spark.createDataFrame(rows, "job_id string, job_name string, exchange string, symbol string, market_type string, bar_interval string, source_dataset string")


def test_force_orders(spark):
    order = {"s": "btcusdt", "S": "SELL", "ap": "0", "p": "10.5", "z": "0", "l": "2", "q": "9"}
    messages = [
        {"E": MS, "o": order},
        {"stream": "x", "data": {"E": MS, "o": {**order, "T": MS + 5}}},
        {"E": MS, "o": {**order, "s": "XXXUSDT"}},
        {"E": MS},
        {"E": MS, "o": "text"},
        {"o": order},
        {"E": MS, "o": {**order, "p": "0"}},
        {"data": [1], "E": MS, "o": order},
    ]
    rows = spark.createDataFrame([(i, json.dumps(m)) for i, m in enumerate(messages)], "n int, raw string")
    rows = rows.unionByName(spark.createDataFrame([(99, "not json")], "n int, raw string"))
    got = {r["n"]: r for r in N.decode_force_orders(rows, live_jobs(spark)).collect()}
    assert sorted(got) == [0, 1, 6, 7]
    assert (float(got[0]["price"]), float(got[0]["amount"]), float(got[0]["cost"])) == (10.5, 2, 21)
    assert got[0]["liquidation_time"] == BASE and got[0]["side"] == "SELL" and got[0]["native_symbol"] == "BTCUSDT"
    assert got[1]["liquidation_time"] == BASE + dt.timedelta(milliseconds=5)
    assert got[6]["price"] is None and got[6]["cost"] is None


# --- planning ---------------------------------------------------------------------------


JOB_SCHEMA = (
    "job_name string, exchange string, symbol string, market_type string, bar_interval string, source_dataset string, "
    "fetch_mode string, start_time timestamp, end_time timestamp, first_open_time timestamp, last_open_time timestamp"
)


def marked(spark, mode="incremental", start=None, end=None, first=None, last=None, exchange="binance", interval="1h", dataset="kline"):
    row = ("j", exchange, KEY[1], KEY[2], interval, dataset, mode, start, end, first, last)
    return spark.createDataFrame([row], JOB_SCHEMA)


def test_incremental_plan_and_skip(spark):
    now = G.as_timestamp("2024-01-01 12:30:00")
    run = P.plan_skip(P.plan_bar_requests(marked(spark, first=at(0), last=at(600)), now)).first()
    assert (run["request_start"], run["target_last_open_time"], run["status"], run["anchor_open_time"]) == (at(660), at(660), "running", at(600))
    skipped = P.plan_skip(P.plan_bar_requests(marked(spark, first=at(0), last=at(660)), now)).first()
    assert (skipped["status"], skipped["request_start"], skipped["request_end"]) == ("skipped", at(720), at(720))
    empty = P.plan_skip(P.plan_bar_requests(marked(spark), now)).first()
    assert empty["request_start"] is None and empty["status"] == "running"


def test_backfill_plan(spark):
    now = G.as_timestamp("2024-01-05 12:30:00")
    for end, expected in [(at(720), at(540)), (at(480), at(480)), (None, at(540))]:
        row = P.plan_bar_requests(marked(spark, "backfill", at(0), end, at(600), at(700)), now).first()
        assert row["target_last_open_time"] == expected and row["anchor_open_time"] is None and row["request_start"] == at(0)
    failed = P.plan_skip(P.plan_bar_requests(marked(spark, "backfill", None, None, at(600), at(700)), now)).first()
    assert failed["status"] == "failed" and "No start time" in failed["error_message"]


def test_retention(spark):
    end, day = dt.datetime(2024, 2, 10), dt.timedelta(days=1)
    for exchange, interval, expected in [("binance", "1h", end - 29 * day), ("kucoinfutures", "1h", end - 7 * day), ("kucoinfutures", "1d", end - 40 * day)]:
        job = marked(spark, "backfill", end - 40 * day, end, exchange=exchange, interval=interval, dataset="open_interest")
        assert P.plan_series_requests(job, G.as_timestamp("2024-03-01 00:00:00")).first()["effective_start"] == expected


def test_series_start_is_one_millisecond_later_except_open_interest(spark):
    now = G.as_timestamp("2024-01-02 00:00:00")
    oi = P.plan_series_requests(marked(spark, last=at(60), dataset="open_interest"), now).first()
    funding = P.plan_series_requests(marked(spark, last=at(60), dataset="funding_rate"), now).first()
    assert (oi["since_ms"] - MS, funding["since_ms"] - MS) == (3600000, 3600001)


def test_clip_bounds(spark):
    rows = landed(spark, [[MS + m * 60000, 1, 1, 1, 1, 1] for m in (0, 60, 120, 180)], "long_short_ratio")
    typed = N.decode_ohlcv(rows)
    plan = P.plan_series_requests(marked(spark, start=at(60), end=at(120), dataset="long_short_ratio"), F.lit(None).cast("timestamp"))
    assert [r["open_time"] for r in N.clip_pages(typed, plan, "open_time").collect()] == [at(120)]


def test_stop_at_first_failure(spark):
    report = spark.createDataFrame([("a", "success"), ("b", "failed"), ("c", "success")], "job_name string, status string")
    assert sorted(r["job_name"] for r in P.until_first_failure(report).collect()) == ["a", "b"]


# --- quality -------------------------------------------------------------------------------


def bars(spark, minutes, copies=None, **over):
    rows = []
    for i, m in enumerate(minutes):
        values = {"open": 1.0, "high": 2.0, "low": 1.0, "close": 1.0, "volume": 1.0, **over}
        rows.append((*STREAM, at(m), values["open"], values["high"], values["low"], values["close"], values["volume"], None, (copies or {}).get(i, 1)))
    return spark.createDataFrame(
        rows,
        "exchange string, symbol string, market_type string, bar_interval string, source_dataset string, open_time timestamp, "
        "open double, high double, low double, close double, volume double, quote_volume double, copies bigint",
    )


def plan(spark, anchor=None, target=None, mode="incremental"):
    return spark.createDataFrame(
        [("j", *STREAM, mode, anchor, target)],
        "job_name string, exchange string, symbol string, market_type string, bar_interval string, source_dataset string, "
        "fetch_mode string, anchor_open_time timestamp, target_last_open_time timestamp",
    )


def test_duplicates(spark):
    row = Q.duplicate_bar(bars(spark, [0, 60], {0: 3})).first()
    assert (row["expected_count"], row["actual_count"]) == (2, 0)
    assert json.loads(row["detail"]) == {"duplicate_count": 2, "duplicate_open_times": ["2024-01-01T00:00:00"] * 2}
    many = Q.duplicate_bar(bars(spark, range(0, 1800, 60), {i: 2 for i in range(30)})).first()
    assert len(json.loads(many["detail"])["duplicate_open_times"]) == 20 and many["expected_count"] == 30
    deep = Q.duplicate_bar(bars(spark, [0, 60], {0: 1000, 1: 2})).first()
    assert json.loads(deep["detail"])["duplicate_open_times"] == ["2024-01-01T00:00:00"] * 20


@pytest.mark.parametrize(
    "minutes, anchor, expected",
    [([0, 60, 240], None, [(2, at(120), at(180))]), ([0, 90], None, [(0, at(60), at(30))]), ([120], at(0), [(1, at(60), at(60))]),
     ([120], None, []), ([0, 60 * 5000], None, [(4999, at(60), at(60 * 4999))])],
)
def test_gaps(spark, minutes, anchor, expected):
    rows = Q.missing_bar(bars(spark, minutes), plan(spark, anchor, None, "incremental" if anchor else "backfill")).collect()
    assert [(r["expected_count"], r["issue_start_time"], r["issue_end_time"]) for r in rows] == expected


def test_late_data(spark):
    assert Q.late_data(bars(spark, [0]), plan(spark, None, at(120))).count() == 0
    row = Q.late_data(bars(spark, [0]), plan(spark, None, at(180))).first()
    assert (row["expected_count"], row["actual_count"], json.loads(row["detail"])["lag_seconds"]) == (1, 0, 10800)
    assert Q.late_data(bars(spark, [0]), plan(spark, None, at(180), "backfill")).count() == 0
    none_fetched = Q.late_data(bars(spark, []), plan(spark, at(0), at(180))).first()
    assert none_fetched["issue_start_time"] == at(0)


def test_status_from_issues(spark):
    found = Q.quality_issues(bars(spark, [0, 60], close=5.0), plan(spark, None, at(60)))
    assert [r["issue_type"] for r in found.collect()] == ["invalid_ohlc"]
    assert Q.run_status(found, plan(spark)).first()["status"] == "partial_success"


# --- markets and seeding ------------------------------------------------------------------------


CATALOGUE = (
    "exchange string, symbol string, id string, base string, quote string, spot boolean, swap boolean, contract boolean, "
    "future boolean, active boolean, market_has_ohlcv boolean, client_has_ohlcv boolean, seq bigint"
)


def catalogue(spark, rows):
    filled = []
    for i, r in enumerate(rows):
        values = {"exchange": "binance", "id": "", "base": "BTC", "quote": "USDT", "spot": False, "swap": False, "contract": False,
                  "future": False, "active": None, "market_has_ohlcv": None, "client_has_ohlcv": True, "seq": i, **r}
        filled.append(tuple(values[c.split()[0]] for c in CATALOGUE.split(", ")))
    return spark.createDataFrame(filled, CATALOGUE)


def test_dated_contract_counts_as_perpetual(spark):
    rows = catalogue(spark, [{"symbol": "BTC/USDT:USDT-240329", "contract": True, "future": True}, {"symbol": "BTC/USDT:USDT", "swap": True, "contract": True}])
    types = {(r["symbol"], r["market_type"]) for r in SE.seed_market_filter(rows).collect()}
    assert types == {("BTC/USDT:USDT-240329", "perpetual"), ("BTC/USDT:USDT-240329", "future"), ("BTC/USDT:USDT", "perpetual")}
    assert M.usdt_perpetual_pick(rows).first()["symbol"] == "BTC/USDT:USDT-240329"


def test_seed_filter_lists_and_candle_support(spark):
    rows = catalogue(
        spark,
        [{"symbol": "A", "spot": True, "base": "AAA"}, {"symbol": "B", "spot": True, "base": None}, {"symbol": "C", "spot": True, "active": False},
         {"symbol": "D", "spot": True, "market_has_ohlcv": False, "client_has_ohlcv": False}, {"symbol": "E", "spot": True, "market_has_ohlcv": False}],
    )
    assert {r["symbol"] for r in SE.seed_market_filter(rows, bases=["btc"]).collect()} == {"B", "E"}


def test_limit_counts_jobs(spark):
    rows = catalogue(spark, [{"symbol": "A", "spot": True}, {"symbol": "B", "spot": True}])
    jobs = SE.seed_jobs(SE.seed_market_filter(rows), ["1h", "5m"], limit=3)
    assert sorted((r["symbol"], r["bar_interval"]) for r in jobs.collect()) == [("A", "1h"), ("A", "5m"), ("B", "1h")]
    assert SE.seed_summary(jobs, dry_run=True).first()["created_or_updated_jobs"] == 0


def test_spot_quote_priority(spark):
    rows = catalogue(spark, [{"symbol": "A", "spot": True, "quote": "USDT"}, {"symbol": "B", "spot": True, "quote": "USDC"}, {"symbol": "C", "spot": True, "quote": "EUR"}, {"symbol": "D", "spot": True, "quote": "USDC"}])
    assert M.spot_pick(rows).first()["symbol"] == "B"


def test_symbol_resolution(spark):
    rows = catalogue(spark, [{"symbol": "BTC/USDT", "id": "BTCUSDT", "spot": True, "active": False}, {"symbol": "BTC/USDT:USDT", "id": "BTCUSDT", "swap": True},
                             {"symbol": "XBTC/USDT", "base": "BTC", "spot": True}])
    asked = spark.createDataFrame([("binance", "BTC/USDT", "spot"), ("binance", "btc_usdt", "spot"), ("binance", "BTCUSDT", "perpetual"), ("binance", "NO", "spot")],
                                  "exchange string, symbol string, market_type string")
    got = {(r["symbol"], r["market_type"]): r for r in M.resolve_symbol(rows, asked).collect()}
    assert got[("BTC/USDT", "spot")]["fetch_symbol"] == "BTC/USDT"
    assert got[("btc_usdt", "spot")]["fetch_symbol"] == "XBTC/USDT"
    assert got[("BTCUSDT", "perpetual")]["fetch_symbol"] == "BTC/USDT:USDT"
    assert "No market for symbol" in got[("NO", "spot")]["error_message"]


def test_selection_defaults(spark):
    asked = spark.createDataFrame([(" btc ", "KRAKEN", "4h"), ("eth", "ALL", "5m"), (None, None, None), ("x", "bybit ", "1m")], "asset string, exchange string, interval string")
    got = [tuple(r) for r in M.normalize_selection(asked).collect()]
    assert got == [("BTC", "binance", "1h"), ("ETH", "all", "5m"), ("BTC", "binance", "1h"), ("BTC", "bybit", "1m")]


def test_four_rank_tables_differ(spark):
    registry = spark.createDataFrame(
        [("binance", "A/USD:USD", "perpetual", "A", "USD", True), ("binance", "A/USDT", "spot", "A", "USDT", True), ("bybit", "A/USDC:USDC", "perpetual", "A", "USDC", True)],
        "exchange string, symbol string, market_type string, base_asset string, quote_asset string, is_active boolean",
    )
    pair = spark.createDataFrame([("binance", "A"), ("kucoin", "A")], "exchange string, asset string")
    single = {r["exchange"]: r["symbol"] for r in M.resolve_market(registry, pair).collect()}
    assert single == {"binance": "A/USDT", "kucoin": "A/USDT:USDT"}
    assert {r["exchange"]: r["symbol"] for r in M.preferred_markets_any(registry).collect()} == {"binance": "A/USD:USD", "bybit": "A/USDC:USDC"}
    assert {r["exchange"]: r["symbol"] for r in M.preferred_markets_perp(registry).collect()} == {"binance": "A/USD:USD", "bybit": "A/USDC:USDC"}
    reference = M.reference_market(registry, spark.createDataFrame([("A",), ("B",)], "asset string")).collect()
    assert {r["asset"]: (r["exchange"], r["symbol"]) for r in reference} == {"A": ("binance", "A/USD:USD"), "B": ("binance", "B/USDT:USDT")}


# --- dashboard ------------------------------------------------------------------------------------


def registry(spark):
    return spark.createDataFrame([(*KEY, "btc", "USDT", True)], "exchange string, symbol string, market_type string, base_asset string, quote_asset string, is_active boolean")


def test_liquidation_without_side_or_cost(spark):
    events = spark.createDataFrame([(*KEY, at(7), None, 2.0, 3.0, None), (*KEY, at(8), "Sell", None, 1.0, None)],
                                   "exchange string, symbol string, market_type string, liquidation_time timestamp, side string, price double, amount double, cost double")
    row = D.aggregate_liquidations(events, registry(spark), intervals=["1h"]).first()
    assert (row["asset"], row["long_value"], row["short_value"], row["total_value"], row["event_count"]) == ("BTC", 0, 0, 6, 2)


def test_volume_falls_back(spark):
    rows = [(*STREAM, at(0), 10.0, 2.0, None), (*STREAM, at(60), 10.0, 2.0, 7.0), (*STREAM, at(120), None, 2.0, None), (*STREAM, at(180), None, None, None)]
    table = spark.createDataFrame(rows, "exchange string, symbol string, market_type string, bar_interval string, source_dataset string, open_time timestamp, close double, volume double, quote_volume double")
    got = {r["time"]: r["volume"] for r in D.aggregate_volume(table, registry(spark)).collect()}
    start = MS // 1000
    assert got == {start: 20, start + 3600: 7, start + 7200: 2, start + 10800: 0}


def test_open_interest_mixes_units(spark):
    rows = [(*KEY, "1h", at(0), 5.0, None), (*KEY, "1h", at(60), 5.0, 9.0)]
    table = spark.createDataFrame(rows, "exchange string, symbol string, market_type string, bar_interval string, open_time timestamp, open_interest_amount double, open_interest_value double")
    assert [r["value"] for r in D.aggregate_open_interest(table, registry(spark)).orderBy("time").collect()] == [5, 9]


def test_exchange_matrix_keeps_an_exchange_with_only_volume(spark):
    candles = spark.createDataFrame([("BTC", "1h", 0, 1.0, 1.0), ("BTC", "1h", 3600, 1.0, 1.0)], "asset string, bar_interval string, time bigint, close double, volume double")
    base = "asset string, bar_interval string, exchange string, time bigint"
    empty = lambda cols: spark.createDataFrame([], f"{base}, {cols}")
    parts = {
        "volume": spark.createDataFrame([("BTC", "1h", "x", 0, 4.0)], f"{base}, value double"),
        "open_interest": empty("value double"), "long_short": empty("value double"),
        "taker": empty("buy_volume double, sell_volume double, buy_sell_ratio double"),
        "liquidation": empty("long_value double, short_value double, total_value double, event_count bigint"), "funding": empty("value double"),
    }
    got = FA.exchange_matrix(candles, parts).orderBy("time").collect()
    assert [(r["time"], r["volume"], r["liquidation"], r["open_interest"]) for r in got] == [(0, 4.0, 0.0, None), (3600, None, 0.0, None)]


def test_bounds(spark):
    points = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("b", float("nan")), ("c", -2.0), ("c", 1.0)], "k string, value double")
    got = {r["k"]: (r["min"], r["max"]) for r in FA.series_bounds(points, ["k"]).collect()}
    assert got["a"] == pytest.approx((4.942, 5.058)) and got["b"] == (0, 1)
    mirrored = {r["k"]: (r["min"], r["max"]) for r in FA.series_bounds(points, ["k"], symmetric=True).collect()}
    assert mirrored["c"] == pytest.approx((-2.3, 2.3))


def test_snapshot_with_zero_previous_close(spark):
    chart = spark.createDataFrame([("BTC", "1h", "candles", 0, 0.0, 1.0, None), ("BTC", "1h", "candles", 1, 5.0, 0.0, None), ("BTC", "1h", "markPrice", 1, None, None, 11.0), ("BTC", "1h", "indexPrice", 1, None, None, 10.0)],
                                  "asset string, bar_interval string, series string, time bigint, close double, volume double, value double")
    derived = spark.createDataFrame([("BTC", "1h", "openInterest", 1, 3.0, None, None)], "asset string, bar_interval string, series string, time bigint, value double, buy_sell_ratio double, total_value double")
    row = FA.latest_snapshot(chart, derived).first()
    assert row["move"] is None and row["basis"] == pytest.approx(0.1) and row["oi_volume_ratio"] is None and row["open_interest"] == 3


def test_snapshot_takes_the_larger_of_two_quotes(spark):
    chart = spark.createDataFrame([("BTC", "1h", "candles", 0, 1.0, 1.0, None)], "asset string, bar_interval string, series string, time bigint, close double, volume double, value double")
    rows = [("BTC", "1h", "longShortRatio", t, v, None, None) for t, v in [(0, 9.0), (1, 2.0), (1, 3.0), (1, 1.0)]]
    derived = spark.createDataFrame(rows, "asset string, bar_interval string, series string, time bigint, value double, buy_sell_ratio double, total_value double")
    for order in ("value", "-value"):
        assert FA.latest_snapshot(chart, derived.repartition(3, F.expr(order))).first()["long_short_ratio"] == 3.0


def test_liquidations_default_to_zero_rows(spark):
    candles = spark.createDataFrame([("BTC", "1h", t) for t in (0, 3600, 7200)], "asset string, bar_interval string, time bigint")
    sums = spark.createDataFrame([("BTC", "1h", 1620, 1.0, 2.0, 3.0, 4)], "asset string, bar_interval string, time bigint, long_value double, short_value double, total_value double, event_count bigint")
    got = [(r["time"], r["liquidation_time"], r["total_value"]) for r in FA.liquidation_or_zero(candles, sums).orderBy("time").collect()]
    assert got == [(0, 1620, 3.0), (3600, 3600, 0.0), (7200, 7200, 0.0)]


# --- very small and very large prices ---------------------------------------------------------


def test_small_and_large_prices_keep_their_digits(spark):
    """Through candles, requested and live liquidations, stored rows and bucket sums."""
    from decimal import Decimal, localcontext

    from tidemark.functions import values as V

    small, large = "0.000000012345678", "12345678901.5"
    rows = [(*STREAM, i, f"[{1704067200000 + i * 3600000}, {p}, {p}, {p}, {p}, 2]") for i, p in enumerate((small, large))]
    landed = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in C.STREAM_KEY) + ", fetch_seq long, payload string")
    bars = {r["close"] for r in N.normalize_ohlcv(landed).collect()}
    assert bars == {Decimal(small), Decimal(large)}

    orders = [(f'{{"o": {{"s": "BTCUSDT", "S": "SELL", "ap": "{p}", "z": "2", "T": 1704067200000}}}}',) for p in (small, large, "9" * 15)]
    jobs = spark.createDataFrame([("1", "job", *STREAM)], ", ".join(f"{c} string" for c in ("job_id", "job_name", *C.STREAM_KEY)))
    jobs = jobs.withColumn("symbol", F.lit("BTC/USDT:USDT"))
    events = N.decode_force_orders(spark.createDataFrame(orders, "raw string"), jobs)
    got = {r["price"]: r["cost"] for r in events.collect()}
    assert got[Decimal(small)] == Decimal("0.00000002469136") and got[Decimal(large)] == Decimal("24691357803")
    assert got[None] is None  # a price beyond the type is unknown, and the stream goes on
    sums = D.liquidation_buckets(events.select(*C.MARKET_KEY, "liquidation_time", "side", "price", "amount", "cost"), ["1h"])
    assert sums.first()["total_value"] == Decimal("24691357803.00000002469136")

    numbers = [("0.000000012345678", "3.00000001"), ("12345678901.5", "123456789.12345678"), ("99999.99999999", "0.00000001"), ("-1.5", "2.5"), (None, "1")]
    frame = spark.createDataFrame(numbers, "p string, a string").withColumn("x", V.price_times(F.col("p").cast(V.PRICE), F.col("a").cast(V.QUANTITY)))
    for r in frame.collect():
        with localcontext(prec=60):
            want = None if r["p"] is None else Decimal(r["p"]) * Decimal(r["a"])
            assert r["x"] is None if want is None else abs(r["x"] - want) <= Decimal("1e-14")


def test_selection_strips_all_white_space(spark):
    rows = [("ETH\n", "bybit\t", "5m\n"), (" eth ", " BYBIT", "﻿5m"), ("E TH", "by\nbit", "5 m")]
    got = [tuple(r) for r in M.normalize_selection(spark.createDataFrame(rows, "asset string, exchange string, interval string")).collect()]
    assert got == [("ETH", "bybit", "5m"), ("ETH", "bybit", "5m"), ("BTC", "binance", "1h")]
