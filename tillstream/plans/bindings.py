"""Sales and rate tables derived from the given Parquet tables.

Every row of the tables is used: each line item is a sale, each purchase event is a live sale and
every other event is a rate update. No update is from GBP or CNY, so those sales fall back to 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.codes import CURRENCY_CODES
from tillstream.functions.money import line_amount, stored_rate

RATED_CODES = [c for c in CURRENCY_CODES if c not in ("GBP", "CNY")]

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nth_code(codes: list[str], n: Column) -> Column:
    start = (n * 3 + 1).cast("int")
    return F.substr(F.lit("".join(codes)), start, F.lit(3))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales from line items; ids repeat."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    order, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    quantity = F.col("l_quantity").cast("int")
    urgency = F.col("o_orderpriority")
    payment = (
        F.when(urgency.isin("1-URGENT", "2-HIGH"), "credit_card")
        .when(urgency == "3-MEDIUM", "debit_card")
        .otherwise("online_transfer")
    )
    # Products have the most text, so they come last: where the lines are dealt out for a join, they are narrow.
    return (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_category"),
            F.col("p_retailprice").alias("product_price"),
            quantity.alias("product_quantity"),
            F.col("p_brand").alias("product_brand"),
            line_amount(F.col("p_retailprice"), quantity).alias("total_amount"),
            nth_code(CURRENCY_CODES, F.col("c_nationkey")).alias("currency"),
            F.col("c_name").alias("customer_id"),
            F.col("l_shipdate").alias("transaction_date"),
            payment.alias("payment_method"),
        )
    )


def sales_order() -> list:
    """Arrival order of `sales`: by time, then product."""
    return ["transaction_date", F.col("product_id").cast("bigint")]


def live_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales from purchase events; ids are unique."""
    return live_sales_of(table(spark, sf_dir, "events"))


def live_sales_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sales as a stream over the files of the events table."""
    schema = table(spark, sf_dir, "events").schema
    # A stream takes a folder or a pattern; this one names the table whether it is a file or a folder.
    return live_sales_of(spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet"))


def live_sales_of(events: DataFrame) -> DataFrame:
    quantity = F.from_json("props", "k int")["k"] % 10 + 1
    return (
        events.where(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").alias("arrival_seq"),
            F.col("event_id").cast("string").alias("transaction_id"),
            (F.col("user_id") % 6).cast("string").alias("product_category"),
            F.col("value").alias("product_price"),
            quantity.alias("product_quantity"),
            line_amount(F.col("value"), quantity).alias("total_amount"),
            nth_code(CURRENCY_CODES, F.col("user_id") % 39).alias("currency"),
            F.col("user_id").cast("string").alias("customer_id"),
            F.col("ts").alias("transaction_date"),
        )
    )


def rate_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate updates in arrival order."""
    other = nth_code(CURRENCY_CODES, F.col("event_id") % 39)
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") != "purchase")
        .select(
            F.col("event_id").alias("arrival_seq"),
            nth_code(RATED_CODES, F.col("user_id") % 37).alias("from_currency"),
            F.when(F.col("event_type") == "signup", "USD").otherwise(other).alias("to_currency"),
            stored_rate(F.col("value")).alias("exchange_rate"),
            F.col("ts").alias("last_updated"),
        )
    )


def dirty_rate_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate updates with missing and long codes, missing times, and rates that are zero or negative."""
    seq = F.col("arrival_seq")
    return rate_updates(spark, sf_dir).withColumns({
        "from_currency": F.when(seq % 97 != 0, F.col("from_currency")),
        "to_currency": F.when(seq % 89 == 0, F.concat("to_currency", F.lit("X"))).otherwise(F.col("to_currency")),
        "exchange_rate": stored_rate(F.col("exchange_rate") - 2),
        "last_updated": F.when(seq % 101 != 0, F.col("last_updated")),
    })


def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live sales with missing ids, dates and categories, and text that is too long."""
    seq = F.col("arrival_seq")
    return live_sales(spark, sf_dir).withColumns({
        "transaction_id": F.when(seq % 83 != 0, F.col("transaction_id")),
        "product_category": F.when(seq % 50 != 0, F.col("product_category")),
        "customer_id": F.when(seq % 71 == 0, F.repeat(F.lit("x"), 300)).otherwise(F.col("customer_id")),
        "transaction_date": F.when(seq % 61 != 0, F.col("transaction_date")),
    })
