"""Rate updates as a stream: a log of every update, the latest rate of each pair, and when each rate held."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions.codes import BASE_CURRENCY
from tillstream.operators import asof, quality, rates
from tillstream.operators.totals import month_of
from tillstream.operators.upsert import first_by, upsert
from tillstream.schemas import ARRIVAL, RATE, STORED_RATES
from tillstream.sinks.database import RATES_TABLE, Publish
from tillstream.sinks.parts import PART, Parts
from tillstream.sinks.versions import CLEAN_EVERY, KEEP_SECONDS, Versions, delete_folder, read_note, write_note
from tillstream.sources.decode import decode
from tillstream.streaming.batches import BatchLog, run_batches
from tillstream.streaming.event_time import with_event_time

RULES = [*quality.decode_errors(RATE), *(f"missing_{c}" for c in RATE.key), *(f"long_{c}" for c in RATE.text_limits()),
         "rate_not_positive", "missing_last_updated", "future_last_updated"]


def _months(span: DataFrame) -> tuple[list[str], int | None]:
    """The months between the times `a` and `b`, and the start of the first in microseconds."""
    a, b = (F.trunc(F.timestamp_micros(c), "month") for c in ("a", "b"))
    each = F.transform(F.sequence(a, b, F.expr("interval 1 month")), month_of)
    row = span.select(each.alias("months"), F.unix_micros(a.cast("timestamp")).alias("begin")).first()
    return row["months"] or [], row["begin"]


@dataclass
class RatesJob:
    """Writes below `root`: `log` (all updates, bad ones with reasons) and `table` versions.

    A version stays for `keep_seconds` after a newer one has replaced it, so that who reads it can finish; that must
    exceed the longest batch of sales.
    `publish` is given the changed rates after every batch, and again if the batch is retried.
    `keep_intervals` also maintains when each rate into the base currency held (`intervals`, by month), for conversion by the time of
    sale: a batch rewrites the months from the first of its currencies' open rates on, and no others.
    """

    spark: SparkSession
    root: str
    reject_future: bool = True
    on_bad_row: str = "quarantine"
    newest_time_wins: bool = False
    keep_versions: int = 50
    keep_seconds: float = KEEP_SECONDS
    publish: Publish | None = None
    keep_intervals: bool = False

    def __post_init__(self):
        if self.keep_versions < 2:
            raise ValueError("a retried batch builds on the version before it: keep at least two")

    @property
    def log(self) -> BatchLog:
        return BatchLog(self.spark, f"{self.root}/log", STORED_RATES)

    @property
    def versions(self) -> Versions:
        return Versions(self.spark, f"{self.root}/table", STORED_RATES)

    @property
    def order(self) -> list[str]:
        """Which update of a pair wins: the last to arrive, or else the newest by its own time."""
        return ["last_updated", "arrival"] if self.newest_time_wins else ["arrival"]

    def seed(self, rows: DataFrame) -> bool:
        """Fill the table if it has no rates yet; of several rows per pair the first counts."""
        if self.versions.newest() is not None:
            return False
        seeds = first_by(rates.stored(rows.select(*RATE.columns)), RATE.key, ["last_updated"])
        self.versions.write(-1, seeds.withColumn("arrival", F.lit(None).cast(ARRIVAL)))
        return True

    def _clock(self, batch_id: int) -> F.Column:
        """The time of a batch's first attempt, which its retries judge by as well."""
        path = f"{self.root}/clock/{batch_id}"
        noted = read_note(self.spark, path)
        if noted is None:
            noted = str(self.spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0])
            write_note(self.spark, path, noted)
        return F.timestamp_micros(F.lit(int(noted)))

    def process(self, messages: DataFrame, batch_id: int) -> None:
        """Log one batch and fold it into the table; running it again changes nothing."""
        as_of = self._clock(batch_id) if self.reject_future else None
        checked = quality.check_rates(rates.stored(messages), as_of)
        self.log.write(batch_id, checked, self.on_bad_row, RULES)
        good = self.log.accepted(batch_id)
        if self.keep_intervals:
            self._extend_intervals(good, batch_id)
        table = upsert(self.versions.read(before=batch_id), good, RATE.key, self.order)
        self.versions.write(batch_id, table)
        self._clean(batch_id)
        if self.publish is not None:
            changed = self.table().join(good.select(*RATE.key).distinct(), list(RATE.key), "left_semi")
            self.publish({RATES_TABLE: changed})

    def _clean(self, batch_id: int) -> None:
        delete_folder(self.spark, f"{self.root}/clock/{batch_id - 1}")
        if self.keep_seconds and batch_id % CLEAN_EVERY != CLEAN_EVERY - 1:
            return
        self.versions.expire(self.keep_versions, self.keep_seconds)
        if self.keep_intervals:
            self._open_rates.expire(self.keep_versions, self.keep_seconds)
            self._closed.expire(self._open_rates.numbers()[0], self.keep_seconds)

    @property
    def _closed(self) -> Parts:
        return Parts(self.spark, f"{self.root}/intervals", asof.INTERVALS)

    @property
    def _open_rates(self) -> Versions:
        return Versions(self.spark, f"{self.root}/open", asof.OPEN)

    def _extend_intervals(self, good: DataFrame, batch_id: int) -> None:
        """Fold the batch's updates into the table of intervals."""
        path = f"{self.root}/changes/batch_id={batch_id}"
        changes = asof.rate_changes(good, BASE_CURRENCY, ["arrival"])
        changes.write.mode("overwrite").parquet(path)
        changes = self.spark.read.schema(changes.schema).parquet(path)
        last, done = self._open_rates.read(before=batch_id), self._open_rates.newest(before=batch_id)
        if last is None:
            last = self.spark.createDataFrame([], asof.OPEN)
        self._closed.discard(batch_id)
        affected = last.select("code", "since").join(F.broadcast(changes.select("code").distinct()), "code", "left_semi")
        span = changes.select("code", "since").unionByName(affected).agg(F.min("since").alias("a"), F.max("since").alias("b"))
        months, begin = _months(span)
        if months:
            stored = self._closed.read(done, only=months)
            closed, last = asof.extended(stored, last, changes, begin)
            self._closed.write(batch_id, closed.withColumn(PART, month_of(F.timestamp_micros("day"))))
        self._open_rates.write(batch_id, last.coalesce(1))
        delete_folder(self.spark, path)

    def start(self, messages: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        typed = decode(messages.withColumn("message", F.col("value")), RATE)
        return run_batches(with_event_time(typed, "last_updated"), self.process, checkpoint, **trigger)

    def table(self) -> DataFrame:
        """The rate table as last stored; empty at first."""
        table = self.versions.read()
        if table is None:
            table = self.spark.createDataFrame([], STORED_RATES)
        return table.select(*RATE.columns)

    def updates(self) -> DataFrame:
        """All accepted updates so far, with their arrival, for conversion by the time of sale."""
        upto = self.versions.newest()
        return self.log.accepted_between(None, -1 if upto is None else upto)

    def intervals(self) -> asof.Intervals:
        """When each rate held, as the last complete batch left it; needs `keep_intervals`."""
        upto = self.versions.newest()
        last = self._open_rates.read(before=-1 if upto is None else upto + 1)
        if last is None:
            last = self.spark.createDataFrame([], asof.OPEN)
        return asof.Intervals(lambda months: self._closed.read(upto, only=months), last)

    def rule_counts(self) -> DataFrame:
        """For each batch, how many rows it had, how many were accepted, and how many broke each rule."""
        return self.log.counts(RULES)

    def register_views(self) -> None:
        """Name the present table for SQL. The view keeps to this version: register again to follow the stream."""
        self.table().createOrReplaceTempView(RATES_TABLE)

    def quarantine(self) -> DataFrame:
        return self.log.rejected()
