"""Convert sales by the rate that was valid at the time of sale.

A table of validity intervals lists, for every currency and day between its first and its last change, which rate held from when to
when; the last rate of a currency is open and holds from its change on. A sale meets the intervals of its own currency and day
by an equality join with a span test, and its currency's open rate. Days on which a rate changes very often are cut into blocks of
consecutive intervals, and a list of the blocks' starts gives a sale its block, so a sale meets about the square root of
the day's changes. Sales are read once, and are neither sorted nor shuffled while the intervals they need fit a broadcast.

The table can be extended: a set of updates changes the rows of its currencies from the last rate before the first of them
on, and no others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.codes import BASE_CURRENCY
from tillstream.functions.order import order_value
from tillstream.operators.enrich import (
    BROADCAST_ROWS,
    known_codes,
    small_or_shuffled,
    with_converted_amount,
)
from tillstream.schemas import ARRIVAL
from tillstream.session import settled

DAY = 24 * 60 * 60 * 1_000_000
#: Intervals that a block of a day has at least.
BLOCK_ROWS = 64
#: The row of a day that lists where its blocks begin, after the first.
STARTS = -1

OPEN = T.StructType([
    T.StructField("code", T.StringType()), T.StructField("since", T.LongType()), T.StructField("rate", T.DoubleType()),
    T.StructField("arrival", ARRIVAL),
])
INTERVALS = T.StructType([
    T.StructField("code", T.StringType()), T.StructField("day", T.LongType()), T.StructField("block", T.IntegerType()),
    T.StructField("since", T.LongType()), T.StructField("until", T.LongType()), T.StructField("rate", T.DoubleType()),
    T.StructField("carried", T.BooleanType()), T.StructField("arrival", ARRIVAL),
    T.StructField("starts", T.ArrayType(T.LongType())),
])


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def day_start(at: Column) -> Column:
    """The day of a time, both in microseconds."""
    return at - F.pmod(at, F.lit(DAY))


def rate_changes(rates: DataFrame, base: str, arrival: Sequence[str]) -> DataFrame:
    """(code, since, rate, arrival): one rate per currency and instant; of several at one instant the last arrival counts."""
    return (
        known_codes(rates, base)
        .select(
            F.col("from_currency").alias("code"), micros(F.col("last_updated")).alias("since"),
            F.col("exchange_rate").cast("double").alias("rate"), order_value(arrival).alias("arrival"),
        )
        .where(F.col("since").isNotNull() & F.col("rate").isNotNull())
        .groupBy("code", "since")
        .agg(F.max_by("rate", "arrival").alias("rate"), F.max("arrival").alias("arrival"))
    )


def _with_ends(points: DataFrame) -> DataFrame:
    """Points in time with the next one of their currency as `until`, null for the last.

    The next point of a day's last one is looked up among the days' first ones, so no window holds more than a day's points,
    or a currency's days.
    """
    points = points.withColumn("day", day_start(F.col("since")))
    in_day = Window.partitionBy("code", "day").orderBy("since")
    days = points.groupBy("code", "day").agg(F.min("since").alias("first"))
    following = days.select("code", "day", F.lead("first").over(Window.partitionBy("code").orderBy("day")).alias("next"))
    inside = points.withColumn("until", F.lead("since").over(in_day))
    return inside.join(following, ["code", "day"]).withColumn("until", F.coalesce("until", "next")).drop("next")


def _cut_at_days(spans: DataFrame) -> DataFrame:
    """Closed spans as one row for each day they reach into."""
    days = F.sequence(F.col("day"), day_start(F.col("until") - 1), F.lit(DAY))
    pieces = spans.where(F.col("until").isNotNull()).withColumn("at", F.explode(days))
    return pieces.select(
        "code", F.col("at").alias("day"), F.greatest("since", "at").alias("since"),
        F.least(F.col("until"), F.col("at") + DAY).alias("until"), "rate",
        (F.col("carried") | (F.col("at") > F.col("day"))).alias("carried"), "arrival",
    )


def _in_blocks(pieces: DataFrame, block_rows: int) -> DataFrame:
    """Number the blocks of each day, and add the list of where they begin to days that have several."""
    day = Window.partitionBy("code", "day")
    size = F.greatest(F.lit(block_rows), F.ceil(F.sqrt(F.count("*").over(day))).cast("int"))
    nth = F.row_number().over(day.orderBy("since")) - 1
    rows = pieces.withColumns({"size": size, "nth": nth})
    rows = rows.withColumn("block", F.floor(F.col("nth") / F.col("size")).cast("int"))
    starts = (
        rows.where((F.col("block") > 0) & (F.col("nth") % F.col("size") == 0)).groupBy("code", "day")
        .agg(F.sort_array(F.collect_list("since")).alias("starts")).withColumn("block", F.lit(STARTS))
    )
    return rows.drop("size", "nth").unionByName(starts, allowMissingColumns=True)


def intervals_of(points: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Closed intervals by day, and open rates, of points (code, since, rate, arrival, carried)."""
    spans = _with_ends(points)
    last = spans.where(F.col("until").isNull()).select("code", "since", "rate", "arrival")
    return _in_blocks(_cut_at_days(spans), block_rows), last


def extended(
    stored: DataFrame, last: DataFrame, changes: DataFrame, begin: int, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """The stored intervals from the time `begin` on and the open rates, both after a set of changes.

    `begin` is the start of a day, and no later than the last open rate and the first change of any currency in question. Rows of other
    currencies stay as they are.
    """
    codes = F.broadcast(changes.select("code").distinct())
    # A rate carried into the first day stands for the change it comes from.
    known = stored.join(codes, "code", "left_semi").where(
        (F.col("block") >= 0) & (~F.col("carried") | (F.col("since") == begin))
    ).select("code", "since", "rate", "arrival", "carried")
    mine = last.join(codes, "code", "left_semi")
    fresh = mine.unionByName(changes.select(*mine.columns)).withColumn("carried", F.lit(False))
    points = known.unionByName(fresh).groupBy("code", "since").agg(
        *[F.max_by(c, F.struct(~F.col("carried"), F.col("arrival"))).alias(c) for c in ("rate", "arrival", "carried")]
    )
    closed, opened = intervals_of(points, block_rows)
    names = stored.columns
    return (
        stored.join(codes, "code", "left_anti").unionByName(closed.select(*names)),
        last.join(codes, "code", "left_anti").unionByName(opened.select(*last.columns)),
    )


@dataclass
class Intervals:
    """A stored table of intervals: `closed` gives the rows of some months, `last` holds the open rates."""

    closed: Callable[[Sequence[str]], DataFrame]
    last: DataFrame

    def lookups(self, months: Sequence[str], broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
        """What sales of some months are joined with, each side broadcast if its counted size allows it."""
        return _lookups(self.closed(months), self.last, broadcast_rows)


def _lookups(closed: DataFrame, last: DataFrame, broadcast_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = closed.where(F.col("block") >= 0).select("code", "day", "block", "since", "until", "rate")
    starts = closed.where(F.col("block") == STARTS).select("code", "day", "starts")
    return tuple(small_or_shuffled(t, broadcast_rows) for t in (rows, starts, last.select("code", "since", "rate")))


def convert_in_intervals(
    sales: DataFrame, closed: DataFrame, starts: DataFrame, last: DataFrame, at: str = "transaction_date"
) -> DataFrame:
    """Each sale once, its amount times the last rate at or before its own time (else 1)."""
    placed = sales.withColumns({"_at": micros(F.col(at)), "_day": day_start(micros(F.col(at)))})
    starts = starts.select(F.col("code").alias("_start_code"), F.col("day").alias("_start_day"), "starts")
    placed = placed.join(starts, (F.col("currency") == F.col("_start_code")) & (F.col("_day") == F.col("_start_day")), "left")
    passed = F.size(F.filter("starts", lambda start: start <= F.col("_at")))
    placed = placed.withColumn("_block", F.when(F.col("starts").isNull(), 0).otherwise(passed))
    closed = closed.select(*[F.col(c).alias(f"_in_{c}") for c in ("code", "day", "block", "since", "until", "rate")])
    in_force = (
        (F.col("currency") == F.col("_in_code")) & (F.col("_day") == F.col("_in_day")) & (F.col("_block") == F.col("_in_block"))
        & (F.col("_in_since") <= F.col("_at")) & (F.col("_at") < F.col("_in_until"))
    )
    last = last.select(*[F.col(c).alias(f"_last_{c}") for c in ("code", "since", "rate")])
    joined = placed.join(closed, in_force, "left").join(
        last, (F.col("currency") == F.col("_last_code")) & (F.col("_last_since") <= F.col("_at")), "left"
    )
    rate = F.coalesce("_last_rate", "_in_rate").alias("_rate")
    return with_converted_amount(joined.select(*sales.columns, rate)).drop("_rate")


def convert_as_of(
    sales: DataFrame,
    rates: DataFrame,
    base: str = BASE_CURRENCY,
    at: str = "transaction_date",
    arrival: Sequence[str] = ("arrival_seq",),
    broadcast_rows: int = BROADCAST_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """As `convert_in_intervals`, from a plain table of updates."""
    changes = rate_changes(rates, base, arrival).withColumn("carried", F.lit(False))
    closed, last = intervals_of(changes, block_rows)
    return convert_in_intervals(sales, *_lookups(settled(closed.drop("arrival")), settled(last.drop("arrival")), broadcast_rows), at=at)
