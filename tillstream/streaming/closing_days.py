"""Daily totals that close, with what comes too late kept in a table of its own.

Spark's windowed aggregation drops a row whose window the watermark has passed, and says nothing. This job keeps the
watermark of every batch itself, by the same rule: it trails the greatest event time of the batches before by the allowed
delay, and a batch is judged by the watermark that the batch before it had. Rows of closed days go to the log with the reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators import quality, totals
from tillstream.operators.asof import micros
from tillstream.schemas import SALES_PER_DAY
from tillstream.sinks.parts import PART, Parts
from tillstream.sinks.versions import Versions
from tillstream.streaming.batches import BatchLog, run_batches
from tillstream.streaming.event_time import OUT_OF_ORDER

LATE = "late"
DAYS = T.StructType([T.StructField("transaction_date", T.DateType()), T.StructField("amount", T.DecimalType(34, 6))])
#: In microseconds: the greatest event time so far, and the watermarks of this batch and of the one after it.
MARKS = T.StructType([T.StructField(name, T.LongType()) for name in ("seen", "judges", "following")])


@dataclass
class ClosingDays:
    """Writes below `root`: `log` (all sales; `late` is a reason to be set aside), `days` and `marks`, whose version commits a batch."""

    spark: SparkSession
    root: str
    schema: T.StructType
    delay: str = OUT_OF_ORDER

    @property
    def log(self) -> BatchLog:
        return BatchLog(self.spark, f"{self.root}/log", self.schema)

    @property
    def days(self) -> Parts:
        return Parts(self.spark, f"{self.root}/days", DAYS)

    @property
    def marks(self) -> Versions:
        return Versions(self.spark, f"{self.root}/marks", MARKS)

    def process(self, sales: DataFrame, batch_id: int) -> None:
        """Judge, log and sum one batch; running it again changes nothing."""
        done, before = self.marks.newest(before=batch_id), self.marks.read(before=batch_id)
        known = None if before is None else before.first()
        checked = quality.check_sales(sales)
        if known is not None and known["judges"] is not None:
            closes = F.unix_micros(F.date_add(totals.sale_day(), 1).cast("timestamp"))
            late = F.when(closes <= known["judges"], F.lit(LATE))
            reasons = F.when(F.col(quality.VIOLATIONS) != "", F.col(quality.VIOLATIONS))
            checked = checked.withColumn(quality.VIOLATIONS, F.concat_ws(",", reasons, late))
        self.marks.discard(batch_id)
        good = F.col(quality.VIOLATIONS) == ""
        seen = self.log.write(batch_id, checked, rules=[LATE], measures=[
            F.max(micros(F.col("transaction_date"))).alias("newest"),
            F.collect_set(F.when(good, totals.month_of(totals.sale_day()))).alias("months"),
        ])
        self.days.discard(batch_id)
        if seen["months"]:
            sums = totals.daily_category_sums(self.log.accepted(batch_id)).drop("category")
            merged = self.days.read(done, only=seen["months"]).unionByName(sums).groupBy("transaction_date").agg(
                F.sum("amount").cast("decimal(34,6)").alias("amount")
            )
            self.days.write(batch_id, merged.withColumn(PART, totals.month_of(F.col("transaction_date"))))
        times = [t for t in (seen["newest"], None if known is None else known["seen"]) if t is not None]
        newest, delay = max(times, default=None), F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {self.delay})")
        self.marks.write(batch_id, self.spark.range(1).select(
            F.lit(newest).cast("long").alias("seen"),
            F.lit(None if known is None else known["following"]).cast("long").alias("judges"),
            (F.lit(newest).cast("long") - delay).alias("following"),
        ))

    def start(self, sales: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return run_batches(sales, self.process, checkpoint, **trigger)

    def sales_per_day(self) -> DataFrame:
        newest = self.marks.newest()
        if newest is None:
            return self.spark.createDataFrame([], SALES_PER_DAY)
        return totals.day_totals(self.days.read(newest))

    def late_rows(self) -> DataFrame:
        """Sales that came after their day had closed, with the batch that brought them."""
        reasons = F.split(quality.VIOLATIONS, ",")
        return self.log.rejected().where(F.array_contains(reasons, LATE))
