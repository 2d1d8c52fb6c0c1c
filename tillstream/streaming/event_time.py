"""Event time on streams: watermarks, days that close, rows that come too late or again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.money import exact_sum

# Fixed value: how far out of order records may be.
OUT_OF_ORDER = "10 seconds"


def with_event_time(stream: DataFrame, at: str, delay: str = OUT_OF_ORDER) -> DataFrame:
    """Watermark a stream. The jobs keep every row however late: only windows act on it."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)


def once_each(messages: DataFrame, within: str) -> DataFrame:
    """Messages without those that came before: the same place in the topic, not more than `within` later by the broker's clock.

    Places older than that are forgotten, so the state is bounded by what arrives in that time.
    """
    place = {"_arrived": F.col("arrival.timestamp"), "_partition": F.col("arrival.partition"), "_offset": F.col("arrival.offset")}
    marked = messages.withColumns(place).withWatermark("_arrived", within)
    return marked.dropDuplicatesWithinWatermark(["_partition", "_offset"]).drop(*place)


def windowed_sales_per_day(sales: DataFrame, at: str = "transaction_date", delay: str = OUT_OF_ORDER) -> DataFrame:
    """Daily totals that close: a sale more than `delay` behind its closed day is dropped."""
    day = F.window(at, "1 day")
    return (
        with_event_time(sales, at, delay)
        .groupBy(day)
        .agg(exact_sum(F.col("total_amount")).alias("amount"))
        .select(F.to_date("window.start").alias("transaction_date"), "amount")
    )
