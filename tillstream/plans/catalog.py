"""The named queries: each takes a session and a folder of Parquet tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.money import unit_price
from tillstream.functions.order import once
from tillstream.operators import asof, enrich, quality, rates, totals, upsert
from tillstream.plans import bindings as b
from tillstream.schemas import RATE, SALE
from tillstream.session import new_folder, settled, use_utc
from tillstream.sinks.publish import as_messages, publish_folder
from tillstream.sinks.versions import Versions, delete_folder
from tillstream.sources.decode import decode
from tillstream.sources.topics import folder_stream
from tillstream.streaming.closing_days import ClosingDays
from tillstream.streaming.event_time import windowed_sales_per_day
from tillstream.streaming.rates_job import RatesJob
from tillstream.streaming.running import keep_totals, published, running_sum
from tillstream.streaming.sales_job import SalesJob

Query = Callable[[SparkSession, str], DataFrame]
RUN_DATE = datetime.date(2024, 2, 1)
AS_OF = "2024-01-20 00:00:00"


def rates_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rate table after all updates."""
    return settled(rates.latest_rates(b.rate_updates(spark, sf_dir)))


def converted_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.convert_latest(b.sales(spark, sf_dir), rates_table(spark, sf_dir))


def converted_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.convert_latest(b.live_sales(spark, sf_dir), rates_table(spark, sf_dir))


# Rates

def latest_rate_by_arrival(spark, sf_dir):
    return rates.latest_rates(b.rate_updates(spark, sf_dir))


def latest_rate_by_event_time(spark, sf_dir):
    return rates.latest_rates(b.rate_updates(spark, sf_dir), ["last_updated", "arrival_seq"])


def rate_grid(spark, sf_dir):
    return rates.rate_grid(latest_rate_by_arrival(spark, sf_dir))


def insert_if_absent(spark, sf_dir):
    """Stored rates into USD stay; other pairs take their first update."""
    updates = b.rate_updates(spark, sf_dir)
    stored = rates.latest_rates(updates.where(F.col("to_currency") == "USD"))
    return upsert.insert_if_absent(stored, updates, RATE.key, ["arrival_seq"])


def seed_when_filled(spark, sf_dir):
    """There are rates into USD, so the seed of all rates is not taken."""
    updates = b.rate_updates(spark, sf_dir)
    stored = rates.latest_rates(updates.where(F.col("to_currency") == "USD"))
    return upsert.seed_if_empty(stored, rates.latest_rates(updates))


def seed_when_empty(spark, sf_dir):
    """No rate into an unknown currency is stored, so the seed is taken."""
    updates = b.rate_updates(spark, sf_dir)
    stored = rates.latest_rates(updates.where(F.col("to_currency") == "XXX"))
    return upsert.seed_if_empty(stored, rates.latest_rates(updates))


# Quality

def rate_quarantine(spark, sf_dir):
    checked = quality.check_rates(b.dirty_rate_updates(spark, sf_dir))
    return quality.quarantine(checked).where(F.col(quality.VIOLATIONS).contains("rate_not_positive"))


def rate_quality_split(spark, sf_dir):
    return quality.check_rates(b.dirty_rate_updates(spark, sf_dir))


def rate_accepted_latest(spark, sf_dir):
    """The rate table that the dirty updates leave behind."""
    good = quality.accepted(quality.check_rates(b.dirty_rate_updates(spark, sf_dir)))
    return rates.latest_rates(good)


def txn_quality_split(spark, sf_dir):
    return quality.check_sales(b.dirty_sales(spark, sf_dir))


def future_rate_guard(spark, sf_dir):
    checked = quality.check_rates(b.rate_updates(spark, sf_dir), F.lit(AS_OF).cast("timestamp_ntz"))
    return quality.quarantine(checked)


# Conversion

def enrich_latest(spark, sf_dir):
    return converted_sales(spark, sf_dir)


def enrich_latest_shuffled(spark, sf_dir):
    """As `enrich_latest`, with a rate table taken as too large to broadcast."""
    return enrich.convert_latest(b.sales(spark, sf_dir), rates_table(spark, sf_dir), broadcast_rows=0)


def enrich_unavailable(spark, sf_dir):
    return enrich.convert_latest(b.live_sales(spark, sf_dir), None)


def rate_status_counts(spark, sf_dir):
    return converted_sales(spark, sf_dir).groupBy("currency", "rate_status").agg(F.count("*").alias("sales"))


def enrich_asof(spark, sf_dir):
    return asof.convert_as_of(b.live_sales(spark, sf_dir), b.rate_updates(spark, sf_dir))


def enrich_asof_shuffled(spark, sf_dir):
    return asof.convert_as_of(b.live_sales(spark, sf_dir), b.rate_updates(spark, sf_dir), broadcast_rows=0)


def price_rounded(spark, sf_dir):
    price = F.col("product_price") / 3
    return b.live_sales(spark, sf_dir).select("transaction_id", unit_price(price).alias("unit_price"))


# Tables

def transactions_upsert(spark, sf_dir):
    table = upsert.last_by(converted_sales(spark, sf_dir), SALE.key, b.sales_order())
    return table.select(*SALE.columns)


def category_total(spark, sf_dir):
    return totals.category_total(converted_sales(spark, sf_dir))


def category_running(spark, sf_dir):
    return totals.category_running(converted_sales(spark, sf_dir))


def sales_per_day(spark, sf_dir):
    return totals.sales_per_day(converted_sales(spark, sf_dir))


def sales_per_day_live(spark, sf_dir):
    return totals.sales_per_day(converted_live(spark, sf_dir))


def sales_per_day_asof(spark, sf_dir):
    return totals.sales_per_day(enrich_asof(spark, sf_dir))


def sales_per_day_unique(spark, sf_dir):
    """Daily totals of the upserted table: a repeated id counts once."""
    return totals.sales_per_day(transactions_upsert(spark, sf_dir))


def processing_date_category(spark, sf_dir):
    return totals.processing_date_category(converted_live(spark, sf_dir), RUN_DATE)


def processing_date_day(spark, sf_dir):
    return totals.processing_date_day(converted_live(spark, sf_dir), RUN_DATE, ["arrival_seq"])


# Messages

def json_roundtrip(spark, sf_dir):
    messages = as_messages(b.live_sales(spark, sf_dir), SALE, "transaction_id")
    back = decode(messages, SALE)
    return back.select(
        "key", *SALE.columns[:-2], F.col("transaction_date").cast("timestamp_ntz").alias("transaction_date"),
        "payment_method", "decode_error",
    )


def rate_messages(spark, sf_dir):
    """Rate updates out as messages and back into the rate table."""
    updates = b.rate_updates(spark, sf_dir)
    back = decode(as_messages(updates, RATE, F.uuid(), "arrival_seq"), RATE)
    latest = rates.latest_rates(rates.stored(quality.accepted(quality.check_rates(back))))
    return latest.withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))


def _odd_messages(spark, sf_dir) -> DataFrame:
    """One message per event; its fields are complete, null, absent, text or broken by `k`."""
    events = b.table(spark, sf_dir, "events").select("event_id", "value", once(F.from_json("props", "k int")["k"]).alias("k"))
    k, value = F.col("k"), F.col("value").cast("string")
    body = (
        F.when(k % 8 == 0, F.lit('{"productQuantity":null}'))
        .when(k % 8 == 1, F.concat(F.lit('{"productPrice":"'), value, F.lit('"}')))
        .when(k % 8 == 2, F.concat(F.lit('{"productQuantity":'), k.cast("string"), F.lit(".7}")))
        .when(k % 8 == 3, F.concat(F.lit('{"productPrice":'), value, F.lit(',"discount":1}')))
        .when(k % 8 == 4, F.concat(F.lit('{"productPrice":'), value))
        .when(k % 8 == 5, F.lit("null"))
        .when(k % 8 == 6, F.lit('{"productPrice":"cheap","totalAmount":""}'))
        .otherwise(F.concat(F.lit('{"productPrice":'), value, F.lit(',"transactionId":'), k.cast("string"), F.lit("}")))
    )
    return events.select("event_id", body.alias("value"))


def json_defaults(spark, sf_dir):
    return decode(_odd_messages(spark, sf_dir), SALE).select(
        "event_id", "transaction_id", "product_price", "product_quantity", "total_amount", "decode_error"
    )


def json_ignore_unknown(spark, sf_dir):
    return decode(_odd_messages(spark, sf_dir), SALE, unknown_fields="ignore").select(
        "event_id", "product_price", "decode_error"
    )


def wire_times(spark, sf_dir):
    from tillstream.functions.wire import seed_time, wire_time

    return b.table(spark, sf_dir, "events").select(
        "event_id", wire_time(F.col("ts")).alias("wire_time"), seed_time(F.col("ts")).alias("seed_time")
    )


# Streams: the tables above, from topics of JSON messages

def _messages(rows: DataFrame, record, key, offset, at: str) -> DataFrame:
    """Rows as recorded messages; time and offset give their order."""
    place = [F.lit(0).alias("partition"), offset.alias("offset"), F.col(at).cast("timestamp").alias("timestamp")]
    return as_messages(rows, record, key, *place)


def _topic(spark, rows: DataFrame, record, key, offset, at: str) -> str:
    path = new_folder(spark, f"{record.name}-topic")
    publish_folder(_messages(rows, record, key, offset, at), path)
    return path


def _zoneless(table: DataFrame) -> DataFrame:
    stamps = [f.name for f in table.schema if isinstance(f.dataType, T.TimestampType)]
    return table.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def _run_rates(spark, updates: DataFrame, **options) -> RatesJob:
    topic = _topic(spark, updates, RATE, F.uuid(), F.col("arrival_seq"), "last_updated")
    job = RatesJob(spark, new_folder(spark, "rates"), **options)
    job.start(folder_stream(spark, topic), f"{job.root}/checkpoint", availableNow=True).awaitTermination()
    delete_folder(spark, topic)
    return job


def _run_sales(spark, sales: DataFrame, offset, read_rates, **options) -> SalesJob:
    topic = _topic(spark, sales, SALE, "transaction_id", offset, "transaction_date")
    job = SalesJob(spark, new_folder(spark, "sales"), read_rates, **options)
    job.start(folder_stream(spark, topic), f"{job.root}/checkpoint", availableNow=True).awaitTermination()
    delete_folder(spark, topic)
    return job


def _fixed_rates(spark, sf_dir):
    table = rates_table(spark, sf_dir)
    return lambda: table


def _line_offset() -> Column:
    """Line sales arrive by day, then by product."""
    return F.unix_date(F.to_date("transaction_date")).cast("bigint") * 10**9 + F.col("product_id").cast("bigint")


def _run_line_sales(spark, sf_dir, **options) -> SalesJob:
    return _run_sales(spark, b.sales(spark, sf_dir), _line_offset(), _fixed_rates(spark, sf_dir), **options)


def _run_live_sales(spark, sf_dir, read_rates=None, **options) -> SalesJob:
    read_rates = read_rates or _fixed_rates(spark, sf_dir)
    return _run_sales(spark, b.live_sales(spark, sf_dir), F.col("arrival_seq"), read_rates, **options)


def stream_rates(spark, sf_dir):
    return _zoneless(_run_rates(spark, b.rate_updates(spark, sf_dir)).table())


def stream_rate_quarantine(spark, sf_dir):
    rejected = _run_rates(spark, b.dirty_rate_updates(spark, sf_dir)).quarantine()
    return rejected.groupBy("violations").agg(F.count("*").alias("updates"))


def stream_transactions(spark, sf_dir):
    return _zoneless(_run_line_sales(spark, sf_dir).transactions())


def stream_sales_per_day(spark, sf_dir):
    return _run_line_sales(spark, sf_dir).sales_per_day()


def stream_category_running(spark, sf_dir):
    return _run_line_sales(spark, sf_dir).sales_per_category()


def _run_in_parts(spark, parts: list[DataFrame], offset: Column, read_rates, between=None, **options) -> SalesJob:
    """One job over several runs, each a restart; `between` is called with the number of the run before it."""
    root, topic = new_folder(spark, "sales"), new_folder(spark, "sale-topic")
    for n, part in enumerate(parts):
        if between is not None:
            between(n)
        publish_folder(_messages(part, SALE, "transaction_id", offset, "transaction_date"), topic)
        job = SalesJob(spark, root, read_rates, **options)
        job.start(folder_stream(spark, topic), f"{root}/checkpoint", availableNow=True).awaitTermination()
    delete_folder(spark, topic)
    return job


def _split(rows: DataFrame, at: str, *cuts: str) -> list[DataFrame]:
    """Rows before each time, and those from the last one on; rows without a time come last."""
    time = F.col(at).cast("timestamp_ntz")
    number = F.coalesce(sum((F.when(time >= F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0)), F.lit(len(cuts)))
    number = F.when(F.col(at).isNull(), len(cuts)).otherwise(number)
    return [rows.where(number == n) for n in range(len(cuts) + 1)]


def _run_line_sales_in_parts(spark, sf_dir, *cuts: str, **options) -> SalesJob:
    """All line sales in several runs of one job, by day."""
    parts = _split(b.sales(spark, sf_dir), "transaction_date", *(cuts or ("1998-07-01",)))
    return _run_in_parts(spark, parts, _line_offset(), _fixed_rates(spark, sf_dir), **options)


def stream_transactions_in_parts(spark, sf_dir):
    """The table after a restart, from early batches folded into buckets and the newest one."""
    job = _run_line_sales_in_parts(spark, sf_dir)
    job.compact()
    job.drop_compacted()
    return _zoneless(job.transactions())


def stream_transactions_compacted(spark, sf_dir):
    """The table of a job that folds every batch but the newest into the buckets as it goes."""
    job = _run_line_sales_in_parts(spark, sf_dir, "1994-01-01", "1996-01-01", compact_every=1, keep_seconds=0)
    return _zoneless(job.transactions())


def stream_category_running_in_parts(spark, sf_dir):
    return _run_line_sales_in_parts(spark, sf_dir).sales_per_category()


def stream_sales_per_day_unique(spark, sf_dir):
    """Daily totals of the table, in which later rows replace earlier ones of their id, kept by changes over three batches."""
    job = _run_line_sales_in_parts(spark, sf_dir, "1994-01-01", "1996-01-01", unique_totals=True, compact_every=2)
    return job.sales_per_day_unique()


def stream_live_transactions(spark, sf_dir):
    return _zoneless(_run_live_sales(spark, sf_dir).transactions())


def stream_sales_per_day_asof(spark, sf_dir):
    """Both streams; each sale at the rate of its own time, by stored intervals. Rates of zero are not accepted."""
    rates_job = _run_rates(spark, b.rate_updates(spark, sf_dir), keep_intervals=True)
    return _run_live_sales(spark, sf_dir, rates_job.intervals, as_of=True).sales_per_day()


THIRDS = ("2024-01-11", "2024-01-21")


def stream_rates_refreshed(spark, sf_dir):
    """Rates and sales in turns, a third of the month each: a sale takes the rates stored when its batch starts."""
    rates_job, topic = RatesJob(spark, new_folder(spark, "rates")), new_folder(spark, "rate-topic")
    updates = _split(b.rate_updates(spark, sf_dir), "last_updated", *THIRDS)

    def refresh(n: int) -> None:
        publish_folder(_messages(updates[n], RATE, F.uuid(), F.col("arrival_seq"), "last_updated"), topic)
        rates_job.start(folder_stream(spark, topic), f"{rates_job.root}/checkpoint", availableNow=True).awaitTermination()

    sales = _split(b.live_sales(spark, sf_dir), "transaction_date", *THIRDS)
    job = _run_in_parts(spark, sales, F.col("arrival_seq"), rates_job.table, refresh)
    delete_folder(spark, topic)
    return _zoneless(job.transactions())


def stream_rates_lost(spark, sf_dir):
    """The rates of the last third of the month open, and then fail while they are read: its sales stay as they are."""
    path = new_folder(spark, "rate-table")
    rates_table(spark, sf_dir).write.parquet(path)

    def read() -> DataFrame:
        rates = spark.read.parquet(path)
        if lost:
            delete_folder(spark, path)
        return rates

    lost: list[int] = []
    sales = _split(b.live_sales(spark, sf_dir), "transaction_date", *THIRDS)
    job = _run_in_parts(spark, sales, F.col("arrival_seq"), read, lambda n: lost.append(n) if n == 2 else None)
    return job.log.accepted_between(None, job.committed()).select("transaction_id", "total_amount", "rate_status")


def stream_redelivered(spark, sf_dir):
    """Every message comes twice, the second time in a batch of its own: totals are those of one delivery."""
    twice = [b.live_sales(spark, sf_dir)] * 2
    return _run_in_parts(spark, twice, F.col("arrival_seq"), _fixed_rates(spark, sf_dir), redelivery_window="60 days").sales_per_day()


def stream_sale_rule_counts(spark, sf_dir):
    """How many sales were accepted, and how many broke each rule, counted while they were written."""
    counts = _run_sales(spark, b.dirty_sales(spark, sf_dir), F.col("arrival_seq"), _fixed_rates(spark, sf_dir)).rule_counts()
    return _by_rule(counts)


def stream_rate_rule_counts(spark, sf_dir):
    return _by_rule(_run_rates(spark, b.dirty_rate_updates(spark, sf_dir)).rule_counts())


def _by_rule(counts: DataFrame) -> DataFrame:
    """(rule, broken): one row for each rule, and for all rows and the accepted ones."""
    rules = [c for c in counts.columns if c != "batch_id"]
    return counts.unpivot(["batch_id"], rules, "rule", "n").groupBy("rule").agg(F.sum("n").alias("n")).where("n > 0")


def stream_processing_date_day(spark, sf_dir):
    return _run_live_sales(spark, sf_dir, processing_date=lambda: F.lit(RUN_DATE)).processed("day")


def stream_processing_date_category(spark, sf_dir):
    return _run_live_sales(spark, sf_dir, processing_date=lambda: F.lit(RUN_DATE)).processed("category")


def stream_sales_quarantine(spark, sf_dir):
    dirty = b.dirty_sales(spark, sf_dir)
    rejected = _run_sales(spark, dirty, F.col("arrival_seq"), _fixed_rates(spark, sf_dir)).quarantine()
    return rejected.groupBy("violations").agg(F.count("*").alias("sales"))


def _live_stream(spark, sf_dir) -> DataFrame:
    """Live sales as a stream over the events table, converted by the stored rates."""
    return enrich.convert_latest(b.live_sales_stream(spark, sf_dir), rates_table(spark, sf_dir))


def _run_totals(spark, totals_stream: DataFrame, keys: list[str], name: str) -> DataFrame:
    table = Versions(spark, new_folder(spark, name))
    keep_totals(totals_stream, keys, table, f"{table.root}/checkpoint", availableNow=True).awaitTermination()
    return published(table)


def stream_category_total(spark, sf_dir):
    """Totals per category in the state store."""
    sums = running_sum(_live_stream(spark, sf_dir), F.col("product_category"), "category")
    return _run_totals(spark, sums, ["category"], "category-totals")


def stream_day_total(spark, sf_dir):
    """Totals per day in the state store, none closed."""
    sums = running_sum(_live_stream(spark, sf_dir), totals.sale_day(), "transaction_date")
    return _run_totals(spark, sums, ["transaction_date"], "day-totals")


def stream_windowed_day(spark, sf_dir):
    """Totals per one-day window; the events arrive in time order, so nothing is late."""
    sums = windowed_sales_per_day(_live_stream(spark, sf_dir))
    return _run_totals(spark, sums, ["transaction_date"], "windowed-days")


def stream_category_total_rebuilt(spark, sf_dir):
    """The totals table is lost between two batches, and rebuilt from the state store before the second."""
    topic, table = new_folder(spark, "typed-sales"), Versions(spark, new_folder(spark, "category-totals"))
    parts = _split(converted_live(spark, sf_dir), "transaction_date", THIRDS[0])
    for n, part in enumerate(parts):
        part.withColumn("transaction_date", F.col("transaction_date").cast("timestamp")).write.mode("append").parquet(topic)
        stream = spark.readStream.schema(spark.read.parquet(topic).schema).parquet(topic)
        sums = running_sum(stream, F.col("product_category"), "category")
        keep_totals(sums, ["category"], table, f"{table.root}/checkpoint", availableNow=True).awaitTermination()
        if n == 0:
            table.discard(table.newest())
    delete_folder(spark, topic)
    return published(table)


def _closed_days(spark, sf_dir) -> ClosingDays:
    """Live sales in four batches; of the first third of the month every seventh comes in the last batch, after its day has closed."""
    sales = converted_live(spark, sf_dir).withColumn("transaction_date", F.col("transaction_date").cast("timestamp"))
    first, second, third = _split(sales, "transaction_date", *THIRDS)
    held_back = F.col("arrival_seq") % 7 == 0
    topic, job = new_folder(spark, "typed-sales"), ClosingDays(spark, new_folder(spark, "closing-days"), sales.schema)
    for part in (first.where(~held_back), second, third, first.where(held_back)):
        part.write.mode("append").parquet(topic)
        stream = spark.readStream.schema(sales.schema).parquet(topic)
        job.start(stream, f"{job.root}/checkpoint", availableNow=True).awaitTermination()
    delete_folder(spark, topic)
    return job


def stream_late_sales(spark, sf_dir):
    """What came too late for its day, with the reason."""
    return _closed_days(spark, sf_dir).late_rows().select("transaction_id", "total_amount", "batch_id", "violations")


def stream_closed_days(spark, sf_dir):
    """Daily totals without the rows that came too late."""
    return _closed_days(spark, sf_dir).sales_per_day()


BATCH_QUERIES: list[Query] = [
    latest_rate_by_arrival, latest_rate_by_event_time, rate_grid, insert_if_absent, seed_when_empty, seed_when_filled,
    rate_quarantine, rate_quality_split, rate_accepted_latest, txn_quality_split, future_rate_guard,
    enrich_latest, enrich_latest_shuffled, enrich_unavailable, rate_status_counts,
    enrich_asof, enrich_asof_shuffled, price_rounded,
    transactions_upsert, category_total, category_running, sales_per_day, sales_per_day_live,
    sales_per_day_asof, sales_per_day_unique, processing_date_category, processing_date_day,
    json_roundtrip, rate_messages, json_defaults, json_ignore_unknown, wire_times,
]
STREAM_QUERIES: list[Query] = [
    stream_rates, stream_rate_quarantine, stream_transactions, stream_sales_per_day,
    stream_category_running, stream_transactions_in_parts, stream_category_running_in_parts,
    stream_live_transactions, stream_sales_per_day_asof, stream_processing_date_day,
    stream_processing_date_category, stream_sales_quarantine,
    stream_category_total, stream_day_total, stream_windowed_day,
    stream_transactions_compacted, stream_sales_per_day_unique, stream_rates_refreshed, stream_rates_lost, stream_redelivered,
    stream_sale_rule_counts, stream_rate_rule_counts, stream_category_total_rebuilt, stream_late_sales, stream_closed_days,
]


def in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict[str, Query]:
    return {query.__name__: in_utc(query) for query in BATCH_QUERIES + STREAM_QUERIES}
