"""Hand-worked cases, one for each rule."""

import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import dicts, values
from tillstream.operators import enrich, quality, rates, totals, upsert
from tillstream.schemas import RATE, SALE
from tillstream.sources.tables import table_or_none

DAY = datetime.date


def latest(updates):
    return rates.latest_rates(rates.stored(updates))


# Rates

def test_last_arrival_wins_even_if_older(updates):
    df = updates(
        {"exchange_rate": 2.0, "last_updated": "2024-01-02T00:00:00"},
        {"exchange_rate": 3.0, "last_updated": "2024-01-01T00:00:00"},
    )
    assert [float(r.exchange_rate) for r in latest(df).collect()] == [3.0]
    by_time = rates.latest_rates(rates.stored(df), ["last_updated", "arrival_seq"])
    assert [float(r.exchange_rate) for r in by_time.collect()] == [2.0]


@pytest.mark.parametrize("change, reason", [
    ({"exchange_rate": 0.0000004}, "rate_not_positive"),
    ({"exchange_rate": 0.0}, "rate_not_positive"),
    ({"exchange_rate": -1.0}, "rate_not_positive"),
    ({"exchange_rate": None}, "rate_not_positive"),
    ({"exchange_rate": float("nan")}, "rate_not_positive"),
    ({"exchange_rate": 1e15}, "rate_not_positive"),
    ({"from_currency": "USDX"}, "long_from_currency"),
    ({"to_currency": None}, "missing_to_currency"),
    ({"last_updated": None}, "missing_last_updated"),
    ({"last_updated": "2024-03-01T00:00:00"}, "future_last_updated"),
    ({"from_currency": None, "exchange_rate": 0.0}, "missing_from_currency,rate_not_positive"),
    ({"exchange_rate": 0.0000005}, ""),
    ({"last_updated": "2024-02-01T00:00:00"}, ""),
])
def test_rate_rules(updates, change, reason):
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    assert values(quality.check_rates(updates(change), as_of), "violations", "arrival_seq") == [reason]


def test_insert_keeps_existing_and_first(updates):
    table = latest(updates({"exchange_rate": 5.0}))
    new = rates.stored(updates(
        {"exchange_rate": 6.0},
        {"from_currency": "JPY", "exchange_rate": 7.0},
        {"from_currency": "JPY", "exchange_rate": 8.0},
    ))
    after = upsert.insert_if_absent(table, new, RATE.key, ["arrival_seq"])
    assert dicts(after.select("from_currency", F.col("exchange_rate").cast("int").alias("r"))) == [
        {"from_currency": "EUR", "r": 5}, {"from_currency": "JPY", "r": 7},
    ]


def test_seed_only_when_empty(updates):
    seed, stored = updates({}), updates({"exchange_rate": 9.0})
    assert upsert.seed_if_empty(stored, seed) is stored
    assert upsert.seed_if_empty(stored.where("false"), seed) is seed


def test_rate_grid(updates):
    grid = rates.rate_grid(latest(updates({"exchange_rate": 5.0}, {"from_currency": "USD", "exchange_rate": 3.0})))
    assert grid.count() == 39 * 39
    assert grid.where("covered").count() == 39 + 1
    row = grid.where("from_currency = 'USD' and to_currency = 'USD'").first()
    assert float(row.exchange_rate) == 1.0


# Conversion

def test_lookup(sales, updates):
    table = latest(updates(
        {"from_currency": "EUR", "exchange_rate": 2.0},
        {"from_currency": "USD", "exchange_rate": 3.0},
        {"from_currency": "USD", "to_currency": "GBP", "exchange_rate": 4.0},
    ))
    df = sales(
        {"transaction_id": "1", "currency": "EUR", "total_amount": 10.0},
        {"transaction_id": "2", "currency": "USD", "total_amount": 10.0},
        {"transaction_id": "3", "currency": "GBP", "total_amount": 10.0},
        {"transaction_id": "4", "currency": None, "total_amount": 10.0},
    )
    for limit in (enrich.BROADCAST_ROWS, 0):
        out = enrich.convert_latest(df, table, broadcast_rows=limit)
        assert values(out, "total_amount") == [20.0, 30.0, 10.0, 10.0]
        assert values(out, "rate_status") == ["hit", "hit", "missing", "missing"]
        assert values(out, "currency") == ["EUR", "USD", "GBP", None]
        assert values(out, "product_price") == [1.0] * 4


def test_a_stored_rate_counts_whatever_its_code(spark, sales, updates):
    stored = rates.stored(updates({"from_currency": "USDT", "exchange_rate": 2.0}))
    for limit in (10, 0):
        out = enrich.convert_latest(sales({"currency": "USDT", "total_amount": 10.0}), stored, broadcast_rows=limit)
        assert dicts(out, "total_amount", "rate_status") == [{"total_amount": 20.0, "rate_status": "hit"}]
    long = spark.createDataFrame([("x" * 1000, 1.0)], "_code string, _rate double")
    assert enrich.is_small(long, 16) and not enrich.is_small(long, 15)


def test_amounts_that_cannot_be_summed_are_set_aside(sales):
    df = sales(*({"total_amount": x} for x in (float("nan"), 1e19, float("-inf"), 1.0, None)))
    assert dicts(totals.sales_per_day(df)) == [{"transaction_date": DAY(2024, 1, 1), "total_sales": 1.0}]
    assert dicts(totals.category_total(df)) == [{"category": "home", "total_sales": 1.0}]
    assert [r["total_sales"] for r in dicts(totals.category_running(df))] == [1.0]
    last = totals.processing_date_day(df, DAY(2024, 2, 1), ["arrival_seq"])
    assert [r["total_sales"] for r in dicts(last)] == [1.0]
    reasons = values(quality.check_sales(df), "violations", "arrival_seq")
    assert reasons == ["amount_out_of_range"] * 3 + ["", ""]


def test_unreadable_rates_leave_amounts(spark, sales):
    rates_table = table_or_none(lambda: spark.read.parquet("/tmp/no-such-rates"))
    out = enrich.convert_latest(sales({"total_amount": 10.0}), rates_table)
    assert dicts(out, "total_amount", "rate_status") == [{"total_amount": 10.0, "rate_status": "unavailable"}]
    with pytest.raises(Exception):
        table_or_none(lambda: spark.read.parquet("/tmp/no-such-rates"), on_error="fail")


# Tables

def test_repeated_id_once_in_table_twice_in_totals(sales):
    df = sales({"total_amount": 10.0}, {"total_amount": 7.0})
    table = upsert.last_by(df, SALE.key, ["arrival_seq"])
    assert values(table, "total_amount") == [7.0]
    assert dicts(totals.sales_per_day(df)) == [{"transaction_date": DAY(2024, 1, 1), "total_sales": 17.0}]


def test_days_split_at_midnight(sales):
    df = sales({"transaction_date": "2024-01-01T23:59:59.999999"}, {"transaction_date": "2024-01-02T00:00:00"})
    assert [r["transaction_date"] for r in dicts(totals.sales_per_day(df))] == [DAY(2024, 1, 1), DAY(2024, 1, 2)]


def test_running_totals_are_cumulative(sales):
    df = sales(
        {"transaction_date": "2024-01-03T00:00:00", "total_amount": 4.0},
        {"transaction_date": "2024-01-01T00:00:00", "total_amount": 1.0},
        {"transaction_date": "2024-01-01T09:00:00", "total_amount": 2.0},
        {"transaction_date": "2024-01-02T00:00:00", "total_amount": 8.0, "product_category": "food"},
        {"transaction_date": "2024-01-02T00:00:00", "total_amount": 16.0, "product_category": None},
    )
    assert dicts(totals.category_running(df)) == [
        {"transaction_date": DAY(2024, 1, 1), "category": "home", "total_sales": 3.0},
        {"transaction_date": DAY(2024, 1, 2), "category": "food", "total_sales": 8.0},
        {"transaction_date": DAY(2024, 1, 3), "category": "home", "total_sales": 7.0},
    ]


def test_sums_do_not_depend_on_order(sales):
    amounts = [0.1, 0.2, 0.3, 1e12, -1e12, 0.7]
    forward = sales(*[{"total_amount": a} for a in amounts])
    backward = sales(*[{"total_amount": a} for a in reversed(amounts)])
    assert dicts(totals.sales_per_day(forward)) == dicts(totals.sales_per_day(backward))
    assert dicts(totals.sales_per_day(forward))[0]["total_sales"] == 1.3


def test_merged_sums_equal_sums_of_all(sales):
    first = sales({"total_amount": 1.5}, {"product_category": "food"})
    second = sales({"total_amount": 2.25}, {"transaction_date": "2024-01-05T00:00:00"})
    merged = totals.merge_sums(totals.daily_category_sums(first), totals.daily_category_sums(second))
    whole = totals.daily_category_sums(first.unionByName(second))
    assert dicts(merged) == dicts(whole)
    assert merged.schema == totals.merge_sums(merged, merged).schema


def test_processing_date(sales):
    df = sales(
        {"transaction_date": "2024-01-02T00:00:00", "total_amount": 1.0},
        {"transaction_date": "2024-01-05T00:00:00", "total_amount": 2.0},
        {"transaction_date": "2024-01-02T08:00:00", "total_amount": 4.0},
    )
    today = DAY(2024, 2, 1)
    assert dicts(totals.processing_date_category(df, today)) == [
        {"transaction_date": today, "category": "home", "total_sales": 7.0}
    ]
    assert dicts(totals.processing_date_day(df, today, ["arrival_seq"])) == [
        {"transaction_date": today, "total_sales": 5.0}
    ]
    assert totals.processing_date_day(df.where("false"), today, ["arrival_seq"]).count() == 0


# Quality of sales

@pytest.mark.parametrize("change, reason", [
    ({}, ""),
    ({"transaction_id": None}, "missing_transaction_id"),
    ({"transaction_date": None}, "missing_transaction_date"),
    ({"product_category": None}, "missing_product_category"),
    ({"customer_id": "x" * 256}, "long_customer_id"),
    ({"customer_id": "x" * 255}, ""),
    ({"currency": "unknown"}, ""),
    ({"total_amount": float("nan")}, "amount_out_of_range"),
    ({"total_amount": 1e300}, "amount_out_of_range"),
])
def test_sale_rules(sales, change, reason):
    assert values(quality.check_sales(sales(change)), "violations", "arrival_seq") == [reason]


def test_fail_instead_of_quarantine(sales):
    checked = quality.check_sales(sales({}, {"transaction_id": None}))
    assert quality.accepted(checked).count() == quality.quarantine(checked).count() == 1
    with pytest.raises(quality.QualityError):
        quality.require_clean(checked)
    assert quality.require_clean(checked.where("violations = ''")).count() == 1


def test_a_null_key_is_replaced(spark):
    from tillstream.operators.upsert import replace_keys

    before = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "category string, amount double")
    changes = spark.createDataFrame([(None, 3.0)], "category string, amount double")
    after = {tuple(r) for r in replace_keys(before, changes, ["category"]).collect()}
    assert after == {(None, 3.0), ("a", 2.0)}
