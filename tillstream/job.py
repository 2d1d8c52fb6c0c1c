"""Run both streams: `spark-submit tillstream/job.py --settings job.properties --root /shared/sales`.

Topics come from the broker of the settings, or from folders of recorded messages. With a database
in the settings and `--publish`, the tables are upserted there as well.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import build_session, use_utc
from tillstream.settings import RATES_TOPIC, SALES_TOPIC, Settings
from tillstream.sinks.database import publisher
from tillstream.sources.topics import broker_stream, folder_stream
from tillstream.streaming.rates_job import RatesJob
from tillstream.streaming.sales_job import SalesJob


def arguments(args: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--settings", help="properties file")
    parser.add_argument("--root", required=True, help="shared folder for tables and checkpoints")
    parser.add_argument("--rates-folder", help="recorded rate messages, instead of the broker's topic")
    parser.add_argument("--sales-folder", help="recorded sale messages, instead of the broker's topic")
    parser.add_argument("--batch-bytes", help="most bytes of recorded messages per batch")
    parser.add_argument("--batch-messages", help="most messages of a broker per batch")
    parser.add_argument("--once", action="store_true", help="process what is there, rates first, and stop")
    parser.add_argument("--publish", action="store_true", help="also upsert the tables into the database")
    parser.add_argument("--processing-date", action="store_true", help="file totals under the day of the run too")
    parser.add_argument("--as-of", action="store_true", help="convert each sale at the rate of its own time, not the latest")
    parser.add_argument("--unique-totals", action="store_true", help="also keep daily totals in which an id counts once")
    parser.add_argument("--compact-every", type=int, default=100, help="batches after which the log is folded and cleaned; 0 for never")
    parser.add_argument("--redelivery-window", help="count a message once that comes again within this time, such as '1 hour'")
    return parser.parse_args(args)


def topic(
    spark: SparkSession, settings: Settings, name: str, folder: str | None, options: argparse.Namespace
) -> DataFrame:
    if folder:
        limit = {"maxBytesPerTrigger": options.batch_bytes} if options.batch_bytes else {}
        return folder_stream(spark, folder, **limit)
    limit = {"maxOffsetsPerTrigger": options.batch_messages} if options.batch_messages else {}
    return broker_stream(spark, settings, name, **limit)


def run(spark: SparkSession, options: argparse.Namespace) -> tuple[RatesJob, SalesJob]:
    settings = Settings.from_file(options.settings) if options.settings else Settings()
    publish = publisher(settings) if options.publish else None
    trigger = {"availableNow": True} if options.once else settings.trigger
    rates = RatesJob(spark, f"{options.root}/rates", publish=publish, keep_intervals=options.as_of)
    sales = SalesJob(
        spark, f"{options.root}/sales", rates.intervals if options.as_of else rates.table, publish=publish, as_of=options.as_of,
        processing_date=F.current_date if options.processing_date else None, unique_totals=options.unique_totals,
        compact_every=options.compact_every or None, redelivery_window=options.redelivery_window,
    )
    jobs = (
        (rates, topic(spark, settings, RATES_TOPIC, options.rates_folder, options)),
        (sales, topic(spark, settings, SALES_TOPIC, options.sales_folder, options)),
    )
    for job, messages in jobs:
        query = job.start(messages, f"{job.root}/checkpoint", **trigger)
        if options.once:
            query.awaitTermination()
    return rates, sales


def main(args: Sequence[str] | None = None) -> None:
    options = arguments(args)
    spark = use_utc(build_session())
    run(spark, options)
    if not options.once:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
