"""Physical plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tillstream.operators import asof, enrich, totals, upsert
from tillstream.plans import bindings as b
from tillstream.plans import catalog
from tillstream.schemas import SALE

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in contract.queries() if not n.startswith("stream_")))
def test_no_query_pairs_everything(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text


def test_daily_totals_read_and_shuffle_little(spark):
    text = plan(catalog.sales_per_day(spark, SF_DIR))
    line = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", text).group(1)
    assert len(line.split(",")) == 4
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text


def test_converting_sales_shuffles_nothing(spark):
    assert "Exchange hashpartitioning" not in plan(catalog.enrich_latest(spark, SF_DIR))
    assert "Exchange hashpartitioning" not in plan(catalog.enrich_asof(spark, SF_DIR))


def test_filter_on_target_currency_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "rates")
    catalog.latest_rate_by_arrival(spark, SF_DIR).write.parquet(path)
    text = plan(enrich.convert_latest(b.live_sales(spark, SF_DIR), spark.read.parquet(path)))
    assert "EqualTo(to_currency,USD)" in text


def test_large_rate_tables_are_not_hinted(spark):
    text = catalog.enrich_latest_shuffled(spark, SF_DIR)._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" not in text


def test_upserts_reduce_before_the_shuffle(spark):
    text = plan(upsert.last_by(b.sales(spark, SF_DIR), SALE.key, b.sales_order()))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_latest_rates_are_hashed_not_sorted(spark):
    text = plan(catalog.latest_rate_by_arrival(spark, SF_DIR))
    assert "Sort" not in text and "partial_max_by" in text


def test_running_totals_window_over_daily_sums(spark):
    text = plan(catalog.category_running(spark, SF_DIR))
    assert text.index("Window [") < text.index("HashAggregate")


@pytest.fixture
def small_partitions(spark):
    """Adaptive execution as with far larger tables: nothing is broadcast, 64 kB is a large partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_sales(spark):
    """Nine sales in ten share a currency and a moment."""
    code = F.when(F.col("id") % 10 != 0, "EUR").otherwise(F.concat(F.lit("C"), (F.col("id") % 90).cast("string")))
    return spark.range(0, 200_000, 1, 8).select(
        code.alias("currency"),
        F.col("id").cast("double").alias("total_amount"),
        F.lit("home").alias("product_category"),
        F.lit("2024-01-02T00:00:00").cast("timestamp").alias("transaction_date"),
    )


def check_hot_sales(converted):
    rows = converted.groupBy("rate_status").agg(F.sum("total_amount").alias("s"), F.count("*").alias("n"))
    found = {r.rate_status: (r.n, r.s) for r in rows.collect()}
    unrated = range(0, 200_000, 10)
    assert found == {"hit": (180_000, 2 * (199_999 * 100_000 - sum(unrated))), "missing": (20_000, sum(unrated))}
    assert "skew=true" in plan(rows)


def test_hot_currency_is_split(spark, small_partitions):
    rates = spark.createDataFrame([("EUR", "USD", 2.0)], "from_currency string, to_currency string, exchange_rate double")
    check_hot_sales(enrich.convert_latest(hot_sales(spark), rates, broadcast_rows=0))


def test_hot_currency_and_moment_are_split(spark, small_partitions, updates):
    check_hot_sales(asof.convert_as_of(hot_sales(spark), updates({"exchange_rate": 2.0}), broadcast_rows=0))


def test_untouched_rows_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "table")
    b.live_sales(spark, SF_DIR).write.parquet(path)
    table = spark.read.parquet(path)
    text = plan(upsert.upsert_few(table, table.limit(5), SALE.key, ["arrival_seq"]))
    untouched = text[text.index("LeftAnti"):text.index("Window [")]
    assert "Exchange hashpartitioning" not in untouched


def test_categories_are_summed_before_the_shuffle(spark):
    text = plan(totals.category_total(b.live_sales(spark, SF_DIR)))
    assert text.index("Exchange hashpartitioning(category") < text.index("partial_sum")


def test_products_join_last(spark):
    """Their texts are not dealt out with the lines by the keys of other tables."""
    text = b.sales(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"Join Inner, \((\w+)#", text)
    assert len(keys) == 3 and "partkey" in keys[0]  # the last join is the topmost


def test_many_changed_keys_are_not_dealt_out_to_be_counted(spark, monkeypatch):
    """A sketch tells that they are too many to broadcast; the upsert is the same."""
    monkeypatch.setattr(upsert, "is_small", None)  # counting would fail
    table = spark.range(300).selectExpr("cast(id as string) as transaction_id", "id as arrival_seq")
    changes = spark.range(200, 500).selectExpr("cast(id as string) as transaction_id", "id + 1000 as arrival_seq")
    found = upsert.upsert_few(table, changes, SALE.key, ["arrival_seq"], broadcast_rows=10)
    expected = {str(n): n + 1000 if n >= 200 else n for n in range(500)}
    rows = found.collect()
    assert len(rows) == 500 and {r.transaction_id: r.arrival_seq for r in rows} == expected
