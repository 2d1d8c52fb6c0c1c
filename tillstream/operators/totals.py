"""Sales totals. Every arrival counts, totals never reset, and no row is ever too late.

A sale whose amount no exact sum can hold (NaN, infinite, out of range) is set aside in batch as it is in a
stream: it is in no total, and `quality.check_sales` gives the reason.

Sums are taken per day and category in an exact decimal, combined before the shuffle, so a hot
category costs one row per map task; running totals then work on those few rows.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.money import exact_sum, fits_money
from tillstream.functions.order import order_value


def sale_day(at: str = "transaction_date") -> Column:
    return F.to_date(F.col(at))


def summable(sales: DataFrame) -> DataFrame:
    """Without the sales that are set aside for their amount."""
    amount = F.col("total_amount")
    return sales.where(amount.isNull() | fits_money(amount))


def category_sales(sales: DataFrame) -> DataFrame:
    """(day, category, amount): the part of a sale that totals need."""
    return summable(sales).select(
        sale_day().alias("transaction_date"),
        F.col("product_category").alias("category"),
        F.col("total_amount").alias("amount"),
    )


def daily_category_sums(sales: DataFrame) -> DataFrame:
    """Exact sum per day and category; mergeable with other such sums."""
    return (
        category_sales(sales)
        .groupBy("transaction_date", "category")
        .agg(exact_sum(F.col("amount")).alias("amount"))
    )


def merge_sums(*parts: DataFrame) -> DataFrame:
    """Add up sums of disjoint sets of sales."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    kind = parts[0].schema["amount"].dataType
    return rows.groupBy("transaction_date", "category").agg(F.sum("amount").cast(kind).alias("amount"))


def category_total(sales: DataFrame) -> DataFrame:
    """All-time total per category; a missing category has no total."""
    known = sales.where(F.col("product_category").isNotNull())
    return category_sales(known).groupBy("category").agg(
        exact_sum(F.col("amount")).cast("double").alias("total_sales")
    )


def sales_per_day(sales: DataFrame) -> DataFrame:
    return category_sales(sales).groupBy("transaction_date").agg(
        exact_sum(F.col("amount")).cast("double").alias("total_sales")
    )


def day_totals(sums: DataFrame) -> DataFrame:
    """`sales_per_day` from stored daily sums."""
    return sums.groupBy("transaction_date").agg(F.sum("amount").cast("double").alias("total_sales"))


def running_totals(sums: DataFrame) -> DataFrame:
    """For each day on which a category sold, its total from the first day to that day."""
    so_far = (
        Window.partitionBy("category")
        .orderBy("transaction_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sums.where(F.col("category").isNotNull())
        .select(
            "transaction_date",
            "category",
            F.sum("amount").over(so_far).cast("double").alias("total_sales"),
        )
    )


def month_of(day: Column) -> Column:
    """The block of days that a day's sums are stored in, as a text."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none"))


def block_totals(sums: DataFrame) -> DataFrame:
    """(block, category, amount): what each category sold in each block of days."""
    return sums.groupBy(month_of(F.col("transaction_date")).alias("block"), "category").agg(
        F.sum("amount").cast(sums.schema["amount"].dataType).alias("amount")
    )


def opening_balances(blocks: DataFrame) -> DataFrame:
    """(block, category, opening): what a category had sold before each block."""
    before = Window.partitionBy("category").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("block", "category", F.coalesce(F.sum("amount").over(before), F.lit(0)).alias("opening"))


def running_totals_in_blocks(sums: DataFrame, blocks: DataFrame) -> DataFrame:
    """As `running_totals`, for the days of `sums`: a balance per block and category, and sums inside blocks.

    `blocks` holds the totals of all blocks, `sums` whole blocks only, all or some. No window is longer than a block's days,
    or a category's blocks.
    """
    inside = (
        Window.partitionBy("block", "category").orderBy("transaction_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    known = sums.where(F.col("category").isNotNull()).withColumn("block", month_of(F.col("transaction_date")))
    return known.join(opening_balances(blocks), ["block", "category"], "left").select(
        "transaction_date", "category",
        (F.coalesce("opening", F.lit(0)) + F.sum("amount").over(inside)).cast("double").alias("total_sales"),
    )


def category_running(sales: DataFrame) -> DataFrame:
    return running_totals(daily_category_sums(sales))


def processing_date_category(sales: DataFrame, run_date: datetime.date | Column) -> DataFrame:
    """All-time totals filed under the day the job ran."""
    day = run_date if isinstance(run_date, Column) else F.lit(run_date)
    return category_total(sales).select(day.alias("transaction_date"), "category", "total_sales")


def processing_date_day(
    sales: DataFrame, run_date: datetime.date | Column, order: Sequence[str]
) -> DataFrame:
    """The total of the last arrival's day, filed under the day the job ran."""
    day = run_date if isinstance(run_date, Column) else F.lit(run_date)
    days = summable(sales).groupBy(sale_day().alias("_day")).agg(
        exact_sum(F.col("total_amount")).cast("double").alias("_total"),
        F.max(order_value(order)).alias("_last"),
    )
    return (
        days.agg(F.max_by("_total", "_last").alias("total_sales"))
        .where(F.col("total_sales").isNotNull())
        .select(day.alias("transaction_date"), "total_sales")
    )
