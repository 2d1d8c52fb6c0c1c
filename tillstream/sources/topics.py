"""Topics of JSON messages: from a broker, or from folders of recorded messages.

Both give `value` and `arrival`. A broker orders messages within a partition only. Messages with one key, such as
sales, are in one partition and so in the order of (partition, offset). Messages without, such as rate updates, are in any, and
their order across partitions is that of (broker time, partition, offset).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.schemas import MESSAGE
from tillstream.settings import BROKER, Settings

CONSUMER_GROUP = "tillstream"


def broker_options(settings: Settings, topic: str) -> dict[str, str]:
    """Read a topic from its first message; progress is kept in the query's checkpoint."""
    return {
        "kafka.bootstrap.servers": settings.require(BROKER),
        "subscribe": settings.require(topic),
        "startingOffsets": "earliest",
        "groupIdPrefix": CONSUMER_GROUP,
    }


def _arrivals(messages: DataFrame) -> DataFrame:
    arrival = F.struct("timestamp", "partition", "offset")
    return messages.select(F.col("value").cast("string").alias("value"), arrival.alias("arrival"))


def broker_stream(spark: SparkSession, settings: Settings, topic: str, **options: str) -> DataFrame:
    """An unbounded topic. Needs the Kafka connector on the class path."""
    source = spark.readStream.format("kafka").options(**broker_options(settings, topic))
    return _arrivals(source.options(**options).load())


def broker_table(spark: SparkSession, settings: Settings, topic: str, **options: str) -> DataFrame:
    """All messages of a topic at this moment."""
    source = spark.read.format("kafka").options(**broker_options(settings, topic))
    return _arrivals(source.options(**options).load())


def folder_stream(spark: SparkSession, path: str, file_format: str = "parquet", **options: str) -> DataFrame:
    """Recorded messages as a stream; `maxFilesPerTrigger` or `maxBytesPerTrigger` size its batches."""
    source = spark.readStream.schema(MESSAGE).format(file_format).options(**options)
    return _arrivals(source.load(path))


def folder_table(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return _arrivals(spark.read.schema(MESSAGE).format(file_format).load(path))
