"""Convert sales to the base currency by the latest stored rate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.codes import BASE_CURRENCY
from tillstream.functions.money import converted

# Rows hold a code, a rate and at most three times, so this many take about a hundred megabytes.
BROADCAST_ROWS = 1_000_000
# A row whose texts are longer than this counts as several.
ROW_TEXT_BYTES = 64


def weight(side: DataFrame) -> Column:
    """An aggregate: the rows of a table, of which one with long texts counts as several."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in side.schema if isinstance(f.dataType, T.StringType)]
    return F.coalesce(F.sum(F.floor(sum(texts, F.lit(0)) / (ROW_TEXT_BYTES + 1)) + 1), F.lit(0))


def is_small(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table is small enough to broadcast, by its rows and the bytes of its texts."""
    return side.agg(weight(side)).first()[0] <= max_rows


def small_or_shuffled(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a stored table if its counted size allows it.

    A larger one joins by sorted shuffle, where adaptive execution splits the partitions of hot keys.
    """
    return F.broadcast(side) if is_small(side, max_rows) else side.hint("merge")


def known_codes(rates: DataFrame, base: str) -> DataFrame:
    """Rates into `base`, whatever the length of their codes."""
    return rates.where((F.col("to_currency") == base) & F.col("from_currency").isNotNull())


def rates_into(rates: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """One rate per source currency. A rate holds in its stored direction only."""
    return known_codes(rates, base).select(
        F.col("from_currency").alias("_code"), F.col("exchange_rate").cast("double").alias("_rate")
    )


def with_converted_amount(sales: DataFrame) -> DataFrame:
    """Replace the amount by its converted value; `_rate` null means no rate is known."""
    amount = converted(F.col("total_amount"), F.col("_rate"))
    status = F.when(F.col("_rate").isNull(), F.lit("missing")).otherwise(F.lit("hit"))
    return sales.withColumns({"total_amount": amount, "rate_status": status})


def convert_latest(
    sales: DataFrame,
    rates: DataFrame | None,
    base: str = BASE_CURRENCY,
    broadcast_rows: int = BROADCAST_ROWS,
    before_shuffle: Callable[[DataFrame], DataFrame] = lambda sales: sales,
    weighed: int | None = None,
) -> DataFrame:
    """Each sale once, its amount times the stored rate of its currency into `base`.

    `rates` is a stored table with one row per pair; None says that it cannot be read. There is
    no inverse or chained rate, and the base currency's own stored rate counts like any other.
    Currency and price keep their original values. `before_shuffle` is applied to the sales if the
    rates are too many to broadcast; `weighed` is their weight, if it is known.
    """
    if rates is None:
        return sales.withColumn("rate_status", F.lit("unavailable"))
    lookup = rates_into(rates, base)
    if is_small(lookup, broadcast_rows) if weighed is None else weighed <= broadcast_rows:
        lookup = F.broadcast(lookup)
    else:
        lookup, sales = lookup.hint("merge"), before_shuffle(sales)
    joined = sales.join(lookup, F.col("currency") == F.col("_code"), "left")
    return with_converted_amount(joined).drop("_code", "_rate")
