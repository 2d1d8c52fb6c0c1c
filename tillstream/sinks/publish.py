"""Rows as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.wire import wire_time
from tillstream.schemas import Record

# Delivery settings of the message producer.
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3", "kafka.linger.ms": "5"}

RECORDED_GROUP_BYTES = 16 << 20


def _wire_value(rows: DataFrame, column: str) -> Column:
    kind = rows.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return wire_time(F.col(column))
    if isinstance(kind, T.DecimalType):
        return F.col(column).cast("double")
    return F.col(column)


def as_messages(rows: DataFrame, record: Record, key: str | Column, *extra: str | Column) -> DataFrame:
    """`key` and JSON `value` of each row, with the wire's field names; absent columns are left out."""
    present = [f for f in record.fields if f.column in rows.columns]
    body = F.struct(*[_wire_value(rows, f.column).alias(f.wire) for f in present])
    key_text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return rows.select(key_text.alias("key"), F.to_json(body).alias("value"), *extra)


def publish_folder(messages: DataFrame, path: str) -> None:
    """Add messages to a folder, in row groups small enough for many readers."""
    messages.write.mode("append").option("parquet.block.size", RECORDED_GROUP_BYTES).parquet(path)


def publish(messages: DataFrame, brokers: str, topic: str) -> None:
    """Send messages to a broker. Needs the Kafka connector on the class path."""
    writer = messages.select("key", "value").write.format("kafka").options(**PRODUCER_OPTIONS)
    writer.option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


def publish_stream(messages: DataFrame, brokers: str, topic: str, checkpoint: str):
    writer = messages.select("key", "value").writeStream.format("kafka").options(**PRODUCER_OPTIONS)
    return (
        writer.option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
