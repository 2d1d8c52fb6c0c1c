"""Micro-batches and the log they write.

Each batch is logged once, good and bad rows in one pass, in a folder of its own that a retry
overwrites. What follows reads the log instead of the batch, so a lost executor costs a re-read
of files and every output of a batch sees the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.quality import VIOLATIONS, QualityError, rule_counts
from tillstream.sinks.versions import complete_numbers, delete_folder, write_note

ACCEPTED = "accepted"


def run_batches(
    stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, **trigger
) -> StreamingQuery:
    """Start a query that hands each micro-batch to `process`.

    `trigger` as in Spark: `processingTime` for an endless run, `availableNow` to replay what is
    there. A restart on the same checkpoint resumes; a new checkpoint and root rebuild everything.
    """
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


class BatchLog:
    """Checked rows below `root`, one folder per batch; `schema` is that of the columns to read."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root = spark, root
        self.schema = T.StructType([
            *schema.fields,
            T.StructField(VIOLATIONS, T.StringType()),
            T.StructField("message", T.StringType()),
            T.StructField("batch_id", T.LongType()),
            T.StructField(ACCEPTED, T.BooleanType()),
        ])

    def path(self, batch_id: int) -> str:
        return f"{self.root}/batch_id={batch_id}"

    def write(
        self, batch_id: int, checked: DataFrame, on_bad_row: str = "quarantine", rules: Sequence[str] = (),
        measures: Sequence[Column] = (),
    ) -> dict:
        """Log a checked batch and count, in the same pass, its rows and those that break each rule.

        `on_bad_row="fail"` then raises if there is a bad row. The text of a message is kept for bad rows only.
        `measures` are other aggregates to take in that pass; all are returned by name.
        """
        good = F.col(VIOLATIONS) == ""
        rows = checked.withColumn(ACCEPTED, good)
        if "message" in checked.columns:
            rows = rows.withColumn("message", F.when(~good, F.col("message")))
        seen = Observation()
        rows = rows.observe(seen, *rule_counts(rules), *measures)
        rows.write.mode("overwrite").partitionBy(ACCEPTED).parquet(self.path(batch_id))
        found = seen.get
        counts = {name: found[name] for name in ("rows", "accepted", *rules)}
        write_note(self.spark, f"{self.root}/counts/{batch_id}.json", json.dumps({"batch_id": batch_id} | counts))
        if on_bad_row == "fail" and counts["rows"] > counts["accepted"]:
            broken = [rule for rule in rules if counts[rule]]
            raise QualityError(f"batch {batch_id}: row breaks {', '.join(broken) or 'a rule'}")
        return found

    def counts(self, rules: Sequence[str]) -> DataFrame:
        """For each batch, its rows, those accepted, and those that break each rule."""
        names = ["batch_id", "rows", "accepted", *rules]
        schema = T.StructType([T.StructField(name, T.LongType()) for name in names])
        if not self.numbers():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(f"{self.root}/counts")

    def _read(self, batch_id: int) -> DataFrame:
        reader = self.spark.read.schema(self.schema).option("basePath", self.root)
        return reader.parquet(self.path(batch_id))

    def _data(self, rows: DataFrame) -> DataFrame:
        return rows.drop(VIOLATIONS, "message", "batch_id", ACCEPTED)

    def accepted(self, batch_id: int) -> DataFrame:
        """The good rows of one batch."""
        return self._data(self._read(batch_id).where(F.col(ACCEPTED)))

    def numbers(self) -> list[int]:
        return complete_numbers(self.spark, self.root, "batch_id")

    def _some(self, numbers: list[int]) -> DataFrame:
        if not numbers:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", self.root)
        return reader.parquet(*[self.path(n) for n in numbers])

    def accepted_between(self, after: int | None, upto: int) -> DataFrame:
        """The good rows of the batches in (after, upto]; no other batch is looked at."""
        numbers = list(range(0 if after is None else after + 1, upto + 1))
        return self._data(self._some(numbers).where(F.col(ACCEPTED)))

    def rejected(self) -> DataFrame:
        """All rows set aside, with their reasons and message text."""
        return self._some(self.numbers()).where(~F.col(ACCEPTED)).drop(ACCEPTED)

    def drop_accepted(self, upto: int) -> None:
        """Delete the good rows of old batches; rows set aside stay."""
        for number in self.numbers():
            if number <= upto:
                delete_folder(self.spark, f"{self.path(number)}/{ACCEPTED}=true")
