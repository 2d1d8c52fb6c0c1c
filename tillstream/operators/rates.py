"""The exchange-rate table: latest rate per pair, and coverage of all pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.codes import CURRENCY_CODES, code_pairs
from tillstream.functions.money import stored_rate
from tillstream.operators.upsert import last_by
from tillstream.schemas import RATE, RATE_TYPE


def stored(updates: DataFrame) -> DataFrame:
    """Updates with the rate rounded as the table keeps it."""
    return updates.withColumn("exchange_rate", stored_rate(F.col("exchange_rate")))


def latest_rates(updates: DataFrame, order: Sequence[str] = ("arrival_seq",)) -> DataFrame:
    """The last rate of each pair: by arrival, or by `last_updated` if that leads `order`.

    Pairs are few and updates many. With one number to order by, an aggregation keeps each pair's
    last row without sorting; `order` must be total.
    """
    if len(order) > 1:
        return last_by(updates, RATE.key, order).select(*RATE.columns)
    return updates.groupBy(*RATE.key).agg(
        F.max_by("exchange_rate", *order).alias("exchange_rate"),
        F.max_by("last_updated", *order).alias("last_updated"),
    )


def rate_grid(rates: DataFrame, codes: list[str] = CURRENCY_CODES) -> DataFrame:
    """Every pair of codes with its rate where one is known; equal codes have rate 1."""
    same = F.col("from_currency") == F.col("to_currency")
    known = rates.select(*RATE.key, F.col("exchange_rate").alias("_known"))
    rate = F.when(same, F.lit(1).cast(RATE_TYPE)).otherwise(F.col("_known"))
    return (
        code_pairs(rates.sparkSession, codes)
        .join(known, list(RATE.key), "left")
        .select(*RATE.key, rate.alias("exchange_rate"), rate.isNotNull().alias("covered"))
    )
