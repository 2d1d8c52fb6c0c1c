"""Changelogs of upserted tables: what an upsert takes back and what it puts in its place.

Totals of a table in which later rows replace earlier ones cannot be kept by adding arrivals. They can by adding
changes: the row that an id had, with a minus, and the row that it has now, with a plus.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.money import exact
from tillstream.functions.order import order_columns
from tillstream.operators.upsert import last_by

CHANGE = "change"


def retractions(
    earlier: DataFrame, arrived: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The rows that upserting `arrived` takes out of the table (`change` -1) and puts in (`change` 1).

    `earlier` holds at least all rows that the table has had for the keys in question; the last in `order` is the one it has.
    A key whose last row stays, because what arrived is older, has no change.
    """
    # At most two rows of a key are left before they are compared, however often it occurs.
    before = last_by(earlier, keys, order).withColumn(CHANGE, F.lit(-1))
    rows = before.unionByName(last_by(arrived, keys, order).withColumn(CHANGE, F.lit(1)))
    latest = [c.desc() for c in order_columns(order)]
    both = Window.partitionBy(*keys)
    # The table's row goes if there is a later one; what arrived comes in if it is the later one, or the only one.
    wins = F.row_number().over(both.orderBy(*latest, CHANGE)) == 1
    return rows.withColumn("_wins", wins).where(F.col("_wins") == (F.col(CHANGE) == 1)).drop("_wins")


def summed_changes(changes: DataFrame, groups: Sequence[Column | str], amount: str) -> DataFrame:
    """The exact difference that changes make to each group's `amount` and its number of `rows`."""
    signed = exact(F.col(amount)) * F.col(CHANGE)
    return changes.groupBy(*groups).agg(
        F.sum(signed).cast("decimal(34,6)").alias("amount"), F.sum(CHANGE).cast("long").alias("rows")
    )
