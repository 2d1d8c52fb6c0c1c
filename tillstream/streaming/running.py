"""Running totals held in Spark's state store: one value per key, kept for good.

Each micro-batch gives the new total of every key it touched; the table upserts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions.money import exact_sum
from tillstream.operators.quality import accepted, check_sales
from tillstream.operators.upsert import replace_keys
from tillstream.sinks.versions import Versions, delete_folder, file_names


def running_sum(sales: DataFrame, key: Column, name: str) -> DataFrame:
    """Total per key over all good sales seen, in update mode; a plain key drops no late row.

    Rows that break a rule (no category, an amount that no exact sum holds) are left out, as in `SalesJob`, and stop nothing.
    """
    return accepted(check_sales(sales)).groupBy(key.alias(name)).agg(exact_sum(F.col("total_amount")).alias("amount"))


def totals_from_state(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """The totals that a query's checkpoint holds in the state store, as of its last finished batch."""
    state = spark.read.format("statestore").load(checkpoint)
    # The state names its keys as the stream's columns are named, in the order of the grouping.
    names = state.schema["key"].dataType.names
    amount = F.when(~F.col("value.isEmpty"), F.col("value.sum"))
    return state.select(*[F.col("key")[name].alias(k) for name, k in zip(names, keys)], amount.alias("amount"))


def last_finished(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch that a checkpoint has committed."""
    return max((int(name) for name in file_names(spark, f"{checkpoint}/commits") if name.isdigit()), default=None)


def rebuild(table: Versions, keys: Sequence[str], checkpoint: str) -> bool:
    """Write the table again from the state, if it is not there although its query has run."""
    batch_id = last_finished(table.spark, checkpoint)
    if batch_id is None or table.newest() is not None:
        return False
    table.write(batch_id, totals_from_state(table.spark, checkpoint, keys))
    return True


def keep_totals(totals: DataFrame, keys: Sequence[str], table: Versions, checkpoint: str, **trigger) -> StreamingQuery:
    """Upsert each batch's totals into a table. A table that was lost is rebuilt from the state first."""
    rebuild(table, keys, checkpoint)

    def process(changes: DataFrame, batch_id: int) -> None:
        # The changes are read twice below, and the state must be computed once.
        landing = f"{table.root}/changes/batch_id={batch_id}"
        changes.write.mode("overwrite").parquet(landing)
        stored = table.spark.read.schema(changes.schema).parquet(landing)
        table.write(batch_id, replace_keys(table.read(before=batch_id), stored, keys))
        delete_folder(table.spark, landing)

    return (
        totals.writeStream.outputMode("update")
        .foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def published(table: Versions) -> DataFrame | None:
    totals = table.read()
    return totals if totals is None else totals.withColumn("amount", F.col("amount").cast("double")).withColumnRenamed(
        "amount", "total_sales"
    )
