"""Every registered query equals its SQL."""

import compare
import pytest

import __spark_entry__ as contract
from tidemark.catalog import oracles
from tidemark.catalog import queries as registry

QUERIES = registry.registered()
SQL = oracles.all_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, con):
    rows = QUERIES[name](spark, sf_dir)
    assert compare.differences(rows.columns, [tuple(r) for r in rows.collect()], con, SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.endswith("_cut")])
def test_short_series_are_cut(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() < QUERIES[name.removesuffix("_cut")](spark, sf_dir).count()


def _equal(rows, con, sql):
    return compare.differences(rows.columns, [tuple(r) for r in rows.collect()], con, oracles.with_fixtures(sql))


def test_newest_rows_are_cut_and_single_selection_equals_the_same_slice(tables, con):
    from tidemark.operators import dashboard as D

    got = D.aggregate_volume(tables.market_data_raw, tables.asset_registry, "BTC", "1h", limit=50)
    assert got.count() == 50
    sql = """SELECT asset, bar_interval, epoch_ms(open_time) // 1000 AS time, CAST(value AS DOUBLE) AS volume FROM volume_totals
             WHERE asset = 'BTC' AND bar_interval = '1h' ORDER BY open_time DESC LIMIT 50"""
    assert _equal(got, con, sql) is None


def test_breakdown_keeps_newest_distinct_times(tables, con):
    from tidemark.operators import dashboard as D

    got = D.volume_breakdown(tables.market_data_raw, tables.asset_registry, "BTC", "1h", limit=40)
    assert got.select("time").distinct().count() == 40
    sql = """SELECT asset, bar_interval, epoch_ms(open_time) // 1000 AS time, exchange, CAST(value AS DOUBLE) AS value
             FROM exchange_volume WHERE asset = 'BTC' AND bar_interval = '1h' AND open_time IN
             (SELECT DISTINCT open_time FROM exchange_volume WHERE asset = 'BTC' AND bar_interval = '1h' ORDER BY 1 DESC LIMIT 40)"""
    assert _equal(got, con, sql) is None


def test_breakdown_rolls_up_to_the_total(tables):
    from pyspark.sql import functions as F

    from tidemark.operators import dashboard as D

    total = D.aggregate_open_interest(tables.open_interest_history, tables.asset_registry)
    parts = D.open_interest_breakdown(tables.open_interest_history, tables.asset_registry)
    summed = parts.groupBy("asset", "bar_interval", "time").agg(F.sum("value").alias("summed"))
    joined = total.join(summed, ["asset", "bar_interval", "time"], "full")
    assert joined.where(F.abs(F.col("value") - F.col("summed")) > 1e-6).count() == 0
    assert joined.where(F.col("value").isNull() | F.col("summed").isNull()).count() == 0


@pytest.mark.parametrize("asset", ["BTC", "NONE"])
def test_one_asset_equals_its_share_of_all(tables, asset):
    from tidemark.operators import dashboard as D

    t, r = tables, tables.asset_registry
    calls = {
        "volume": lambda a: D.volume_breakdown(t.market_data_raw, r, a),
        "chart": lambda a: D.chart_all(t.market_data_raw, r, a),
        "interest": lambda a: D.aggregate_open_interest(t.open_interest_history, r, a),
        "funding": lambda a: D.funding_breakdown(t.funding_rate_history, r, a),
        "ratio": lambda a: D.long_short(t.long_short_ratio_history, r, a),
        "flow": lambda a: D.taker(t.taker_buy_sell_volume_history, r, a),
        "forced": lambda a: D.liquidation_breakdown(t.liquidation_event, r, a),
        "derived": lambda a: D.derivatives_all(t.derivative_tables, r, a),
    }
    for name, call in calls.items():
        alone = sorted(map(str, call(asset).collect()))
        share = sorted(map(str, call(None).where(f"asset = '{asset}'").collect()))
        assert alone == share, name
        assert bool(alone) == (asset == "BTC"), name
