"""Sales as a stream: converted once per batch, then logged, summed and published.

A batch writes its rows, then the sums of the months it touches, then the totals of all months. The last are the commit: readers
use what batches up to their newest complete version left. All published tables see the same converted amounts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions.codes import BASE_CURRENCY
from tillstream.operators import quality, totals
from tillstream.operators.asof import Intervals, convert_as_of, convert_in_intervals
from tillstream.operators.changelog import retractions, summed_changes
from tillstream.operators.enrich import BROADCAST_ROWS, convert_latest, known_codes, weight
from tillstream.operators.upsert import last_by, replace_keys, upsert_few
from tillstream.schemas import RATE, SALE, SALES_PER_CATEGORY, SALES_PER_DAY, STORED_SALES
from tillstream.sinks.database import CATEGORY_TABLE, DAY_TABLE, SALES_TABLE, Publish
from tillstream.sinks.parts import PART, Parts
from tillstream.sinks.versions import CLEAN_EVERY, KEEP_SECONDS, Versions, delete_folder
from tillstream.sources.decode import decode
from tillstream.sources.tables import table_or_none
from tillstream.streaming.batches import BatchLog, run_batches
from tillstream.streaming.event_time import once_each, with_event_time

AMOUNT = T.DecimalType(34, 6)
SUMS = T.StructType([
    T.StructField("transaction_date", T.DateType()),
    T.StructField("category", T.StringType()),
    T.StructField("amount", AMOUNT),
])
LOGGED = T.StructType([*STORED_SALES.fields, T.StructField("rate_status", T.StringType())])

TABLES = {
    "blocks": T.StructType([
        T.StructField("block", T.StringType()), T.StructField("category", T.StringType()), T.StructField("amount", AMOUNT),
    ]),
    "compacted": T.StructType([T.StructField("buckets", T.IntegerType())]),
    "processed_category": SALES_PER_CATEGORY,
    "processed_day": SALES_PER_DAY,
}
PARTS = {
    "days": SUMS,
    "unique": T.StructType([*SUMS.fields, T.StructField("rows", T.LongType())]),
    "transactions": STORED_SALES,
}
#: An id is always in one partition of its topic, so its rows came in the order of their offsets, whatever the broker's clock says.
ORDER = ["arrival.partition", "arrival.offset"]
RULES = [*quality.decode_errors(SALE), "missing_transaction_id", *(f"long_{c}" for c in SALE.text_limits()),
         "missing_transaction_date", "missing_product_category", "amount_out_of_range"]


@dataclass
class SalesJob:
    """Writes below `root`: `log` (all sales), `days` and `blocks` (sums), `transactions` and, if asked, `processed` and `unique`.

    `read_rates` is called for every batch, so each uses the rates stored when it starts. With `as_of` it gives the rates by
    time instead (`RatesJob.intervals`, or all updates), and a sale takes the rate that was valid at its own time, whenever it is
    processed.
    `publish` is given the changed rows after every batch, and again if the batch is retried.
    `processing_date` also files totals under the day a batch runs, as given by the function.
    `unique_totals` also keeps daily totals in which an id counts once, with its last row.
    Rows of `transactions` lie in `buckets` parts by a hash of their id. Every `compact_every` batches the log is folded into them.
    """

    spark: SparkSession
    root: str
    read_rates: Callable[[], DataFrame | Intervals | None]
    on_bad_row: str = "quarantine"
    on_rates_error: str = "pass"
    as_of: bool = False
    processing_date: Callable[[], F.Column] | None = None
    broadcast_rows: int = BROADCAST_ROWS
    keep_versions: int = 50
    keep_seconds: float = KEEP_SECONDS
    publish: Publish | None = None
    unique_totals: bool = False
    buckets: int = 64
    compact_every: int | None = None
    redelivery_window: str | None = None

    def __post_init__(self):
        if self.keep_versions < 2:
            raise ValueError("a retried batch builds on the version before it: keep at least two")

    @property
    def log(self) -> BatchLog:
        return BatchLog(self.spark, f"{self.root}/log", LOGGED)

    def versions(self, name: str) -> Versions:
        return Versions(self.spark, f"{self.root}/{name}", TABLES[name])

    def parts(self, name: str) -> Parts:
        return Parts(self.spark, f"{self.root}/{name}", PARTS[name])

    def process(self, sales: DataFrame, batch_id: int) -> None:
        """Convert, log and sum one batch; running it again changes nothing."""
        checked = quality.check_sales(self._converted(batch_id, sales))
        self.versions("blocks").discard(batch_id)
        seen = self.log.write(batch_id, checked, self.on_bad_row, RULES, self._touched())
        self._drop_landed(batch_id)
        good, months = self.log.accepted(batch_id), seen["months"]
        done = self.versions("blocks").newest(before=batch_id)
        sums = totals.daily_category_sums(good)
        self._add("days", sums, months, done, batch_id)
        if self.unique_totals:
            self._add_unique(good, seen["buckets"], done, batch_id)
        blocks = self._blocks(months, batch_id)
        dated = None if self.processing_date is None else self._file_under_run_date(good, sums, months, blocks, batch_id)
        self.versions("blocks").write(batch_id, blocks.coalesce(1))
        if self.publish is not None:
            self.publish(self._changes(good, sums, seen, dated, batch_id))
        self._clean(batch_id)

    def _touched(self) -> list[F.Column]:
        """The months and buckets that the good rows of a batch are in, taken while they are written."""
        good = F.col(quality.VIOLATIONS) == ""
        months = F.collect_set(F.when(good, totals.month_of(totals.sale_day()))).alias("months")
        if not self.unique_totals and self.publish is None:
            return [months]
        return [months, F.collect_set(F.when(good, self._bucket())).alias("buckets")]

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*SALE.key), F.lit(self._bucket_count())).cast("string")

    def _bucket_count(self) -> int:
        """That of the stored table, once there is one."""
        stored = self.versions("compacted").read()
        return self.buckets if stored is None else stored.first()["buckets"]

    def _add(self, name: str, sums: DataFrame, months: list[str], done: int | None, batch_id: int) -> None:
        """Add sums to the stored ones of the months they are in; other months keep their files."""
        parts = self.parts(name)
        parts.discard(batch_id)
        if months:
            merged = totals.merge_sums(parts.read(done, only=months), sums)
            parts.write(batch_id, merged.withColumn(PART, totals.month_of(F.col("transaction_date"))), len(months))

    def _blocks(self, months: list[str], batch_id: int) -> DataFrame:
        """The totals of every month after a batch: those of the months it touched are summed again."""
        before = self.versions("blocks").read(before=batch_id)
        if not months:
            return self.spark.createDataFrame([], TABLES["blocks"]) if before is None else before
        now = totals.block_totals(self.parts("days").read(batch_id, only=months))
        return now if before is None else before.where(~F.col("block").isin(months)).unionByName(now)

    def _held(self, buckets: list[str], upto: int) -> DataFrame:
        """All rows in some buckets that the table has had: the compacted ones, and those logged since."""
        done = self.versions("compacted").newest()
        base = self.parts("transactions").read(done, only=buckets)
        return base.unionByName(self.log.accepted_between(done, upto).drop("rate_status"))

    def _add_unique(self, good: DataFrame, buckets: list[str], done: int | None, batch_id: int) -> None:
        """Take what a batch replaced out of the totals by day of the table, and put its rows in."""
        ids = good.select(*SALE.key).distinct()
        earlier = self._held(buckets, batch_id - 1).join(ids, list(SALE.key), "left_semi")
        changes = retractions(earlier, good.drop("rate_status"), SALE.key, ORDER)
        groups = [totals.sale_day().alias("transaction_date"), F.col("product_category").alias("category")]
        path = f"{self.root}/changes/batch_id={batch_id}"
        summed_changes(changes, groups, "total_amount").write.mode("overwrite").parquet(path)
        sums, parts = self.spark.read.schema(PARTS["unique"]).parquet(path), self.parts("unique")
        month = totals.month_of(F.col("transaction_date"))
        months = [row[0] for row in sums.select(month).distinct().collect()]
        parts.discard(batch_id)
        if months:
            merged = parts.read(done, only=months).unionByName(sums).groupBy("transaction_date", "category").agg(
                F.sum("amount").cast(AMOUNT).alias("amount"), F.sum("rows").alias("rows")
            )
            parts.write(batch_id, merged.withColumn(PART, month), len(months))
        delete_folder(self.spark, path)

    def _changes(self, good: DataFrame, sums: DataFrame, seen: dict, dated: tuple | None, batch_id: int) -> dict[str, DataFrame]:
        """What a database must upsert after a batch: its sales by id, and the totals that are not what they were.

        A day's total changes if the batch has a sale of it; a category's running total changes from the first such day on.
        """
        held = self._held(seen["buckets"], batch_id)
        ids = good.select(*SALE.key).distinct()
        winners = last_by(held.join(ids, list(SALE.key), "left_semi"), SALE.key, ORDER).select(*SALE.columns)
        if dated is not None:
            by_category, by_day = dated
        else:
            days, months = self.parts("days"), seen["months"]
            sold = sums.select("transaction_date").distinct()
            by_day = totals.day_totals(days.read(batch_id, only=months).join(sold, "transaction_date", "left_semi"))
            later = [m for m in days.current(batch_id) if months and m >= min(months)]
            since = sums.groupBy("category").agg(F.min("transaction_date").alias("_since"))
            running = totals.running_totals_in_blocks(days.read(batch_id, only=later), self.versions("blocks").read())
            by_category = running.join(since, "category").where(F.col("transaction_date") >= F.col("_since")).drop("_since")
        return {SALES_TABLE: winners, CATEGORY_TABLE: by_category, DAY_TABLE: by_day}

    def _converted(self, batch_id: int, sales: DataFrame) -> DataFrame:
        if not self.as_of:
            rates, weighed = table_or_none(partial(self._settled_rates, batch_id), self.on_rates_error) or (None, None)
            return convert_latest(
                sales, rates, broadcast_rows=self.broadcast_rows, before_shuffle=partial(self._landed, batch_id), weighed=weighed
            )
        rates = table_or_none(self.read_rates, self.on_rates_error)
        if rates is None:
            return convert_latest(sales, None)
        if not isinstance(rates, Intervals):
            return convert_as_of(self._landed(batch_id, sales), rates, arrival=("arrival",), broadcast_rows=self.broadcast_rows)
        landed, months = self._landed_with_months(batch_id, sales)
        found = table_or_none(lambda: rates.lookups(months, self.broadcast_rows), self.on_rates_error)
        return convert_latest(landed, None) if found is None else convert_in_intervals(landed, *found)

    def _settled_rates(self, batch_id: int) -> tuple[DataFrame, int] | None:
        """The rates that a batch needs and their weight, read once and to the end, so that a table which fails half-way is unreadable."""
        rates = self.read_rates()
        if rates is None:
            return None
        path = f"{self.root}/rates/batch_id={batch_id}"
        kept, seen = known_codes(rates, BASE_CURRENCY).select(*RATE.key, "exchange_rate"), Observation()
        kept.observe(seen, weight(kept).alias("weight")).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(kept.schema).parquet(path), seen.get["weight"]

    def _landing(self, batch_id: int) -> str:
        return f"{self.root}/landing/batch_id={batch_id}"

    def _landed(self, batch_id: int, sales: DataFrame) -> DataFrame:
        """Write a batch that is joined by shuffle: plans over files adapt to skew, a stream's do not."""
        return self._landed_with_months(batch_id, sales)[0]

    def _landed_with_months(self, batch_id: int, sales: DataFrame) -> tuple[DataFrame, list[str]]:
        seen = F.collect_set(totals.month_of(totals.sale_day())).alias("months")
        observation = Observation()
        sales.observe(observation, seen).write.mode("overwrite").parquet(self._landing(batch_id))
        return self.spark.read.schema(sales.schema).parquet(self._landing(batch_id)), observation.get["months"]

    def _drop_landed(self, batch_id: int) -> None:
        for path in (self._landing(batch_id), f"{self.root}/rates/batch_id={batch_id}"):
            delete_folder(self.spark, path)

    def _file_under_run_date(
        self, good: DataFrame, sums: DataFrame, months: list[str], blocks: DataFrame, batch_id: int
    ) -> tuple[DataFrame, DataFrame]:
        """Totals so far of the batch's categories, and of its last arrival's day, under today's date."""
        today = self.processing_date()
        sold = sums.select("category").distinct()
        by_category = (
            blocks.join(sold, "category", "left_semi").groupBy("category")
            .agg(F.sum("amount").cast("double").alias("total_sales"))
            .select(today.alias("transaction_date"), "category", "total_sales")
        )
        last = good.agg(F.max_by(totals.sale_day(), "arrival").alias("transaction_date"))
        written = self.parts("days").read(batch_id, only=months)
        by_day = totals.day_totals(written.join(F.broadcast(last), "transaction_date", "left_semi")).select(
            today.alias("transaction_date"), "total_sales"
        )
        for name, changes, keys in (
            ("processed_category", by_category, ["transaction_date", "category"]),
            ("processed_day", by_day, ["transaction_date"]),
        ):
            versions = self.versions(name)
            versions.write(batch_id, replace_keys(versions.read(before=batch_id), changes, keys))
        return by_category, by_day

    def _clean(self, batch_id: int) -> None:
        """Drop what no reader can hold any more, and fold the log if it is time."""
        if not self.keep_seconds or batch_id % CLEAN_EVERY == CLEAN_EVERY - 1:
            blocks = self.versions("blocks")
            blocks.expire(self.keep_versions, self.keep_seconds)
            for name in ("days", "unique"):
                self.parts(name).expire(blocks.numbers()[0], self.keep_seconds)
            for name in ("processed_category", "processed_day"):
                self.versions(name).expire(self.keep_versions, self.keep_seconds)
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            self.compact()
            self.drop_compacted(self.keep_seconds)

    def start(self, messages: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Run on a stream of messages; with `redelivery_window` a message that comes again within it counts once."""
        messages = messages.withColumn("message", F.col("value"))
        if self.redelivery_window:
            typed = decode(once_each(messages, self.redelivery_window), SALE)
        else:
            typed = with_event_time(decode(messages, SALE), "transaction_date")
        return run_batches(typed, self.process, checkpoint, **trigger)

    def committed(self) -> int | None:
        return self.versions("blocks").newest()

    # Published tables

    def transactions(self) -> DataFrame:
        """The last row of every id."""
        upto, done = self.committed(), self.versions("compacted").newest()
        if upto is None:
            return self.spark.createDataFrame([], STORED_SALES).select(*SALE.columns)
        table = self.parts("transactions")
        if upto == done:
            return table.read(done).select(*SALE.columns)
        recent = self.log.accepted_between(done, upto).drop("rate_status")
        if done is None:
            return last_by(recent, SALE.key, ORDER).select(*SALE.columns)
        touched = self._buckets_of(recent)
        changed = upsert_few(table.read(done, only=touched), recent, SALE.key, ORDER)
        return table.read(done, but=touched).unionByName(changed).select(*SALE.columns)

    def _buckets_of(self, rows: DataFrame) -> list[str]:
        return [row[0] for row in rows.select(self._bucket()).distinct().collect()]

    def compact(self) -> None:
        """Fold all but the newest batch, which may still be retried, into the buckets that its rows are in."""
        upto, done = self.committed(), self.versions("compacted").newest()
        if upto is None or upto < 1 or upto - 1 == done:
            return
        recent = self.log.accepted_between(done, upto - 1).drop("rate_status")
        buckets, table, count = self._buckets_of(recent), self.parts("transactions"), self._bucket_count()
        table.discard(upto - 1)
        if buckets:
            base = None if done is None else table.read(done, only=buckets)
            table.write(upto - 1, upsert_few(base, recent, SALE.key, ORDER).withColumn(PART, self._bucket()), len(buckets))
        marker = self.spark.range(1).select(F.lit(count).cast("int").alias("buckets"))
        self.versions("compacted").write(upto - 1, marker)

    def drop_compacted(self, seconds: float = 0) -> None:
        """Delete the logged rows and older files that a compaction at least so long ago has replaced."""
        done = self.versions("compacted").written(seconds)
        if done:
            self.log.drop_accepted(done[-1])
            self.parts("transactions").expire(done[-1], seconds)
            self.versions("compacted").expire(1, seconds)

    def rule_counts(self) -> DataFrame:
        """For each batch, how many rows it had, how many were accepted, and how many broke each rule."""
        return self.log.counts(RULES)

    def _sums(self) -> DataFrame:
        return self.parts("days").read(self.committed())

    def sales_per_day(self) -> DataFrame:
        return totals.day_totals(self._sums())

    def sales_per_day_unique(self) -> DataFrame:
        """Daily totals of the table `transactions`, kept by changes; needs `unique_totals`."""
        sums = self.parts("unique").read(self.committed())
        days = sums.groupBy("transaction_date").agg(F.sum("amount").cast("double").alias("total_sales"), F.sum("rows").alias("rows"))
        return days.where("rows > 0").drop("rows")

    def sales_per_category(self) -> DataFrame:
        blocks = self.versions("blocks").read()
        if blocks is None:
            return self.spark.createDataFrame([], SALES_PER_CATEGORY)
        return totals.running_totals_in_blocks(self._sums(), blocks)

    def category_totals(self) -> DataFrame:
        blocks = self.versions("blocks").read()
        if blocks is None:
            blocks = self.spark.createDataFrame([], TABLES["blocks"])
        return blocks.groupBy("category").agg(F.sum("amount").cast("double").alias("total_sales"))

    def processed(self, name: str) -> DataFrame | None:
        """`category` or `day` totals by processing date."""
        return self.versions(f"processed_{name}").read()

    def register_views(self) -> None:
        """Name the present tables for SQL. The views keep to them: register again to follow the stream."""
        self.transactions().createOrReplaceTempView(SALES_TABLE)
        self.sales_per_category().createOrReplaceTempView(CATEGORY_TABLE)
        self.sales_per_day().createOrReplaceTempView(DAY_TABLE)

    def quarantine(self) -> DataFrame:
        return self.log.rejected()
