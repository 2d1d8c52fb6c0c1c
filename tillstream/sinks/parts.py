"""A stored table in parts, such as hash buckets or months, of which a batch rewrites only those it touches.

A batch writes its parts with Spark's dynamic partition overwrite, each to a folder numbered by the batch, so writing the batch
again replaces what it wrote. Readers name the last batch they trust and take each part as that batch left it; what an
unfinished batch wrote is never seen. Folders that a newer one has replaced are dropped once no reader can hold them.
"""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.sinks.versions import _file_system, delete_folder

PART, NUMBER = "part", "number"


class Parts:
    """`schema` is that of the rows without their part; parts are texts that a path can hold."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root, schema

    def path(self, part: str, number: int) -> str:
        return f"{self.root}/{PART}={part}/{NUMBER}={number}"

    def _folders(self) -> dict[str, dict[int, float]]:
        """For each part, the numbers of its folders and when they were written."""
        found: dict[str, dict[int, float]] = {}
        where, files = _file_system(self.spark, f"{self.root}/{PART}=*/{NUMBER}=*")
        for folder in files.globStatus(where) or []:
            path = folder.getPath()
            number, part = (name.split("=", 1)[1] for name in (path.getName(), path.getParent().getName()))
            found.setdefault(part, {})[int(number)] = folder.getModificationTime() / 1000
        return found

    def current(self, upto: int | None) -> dict[str, int]:
        """The number that each part has once the batches up to `upto` are done."""
        if upto is None:
            return {}
        held = {part: [n for n in numbers if n <= upto] for part, numbers in self._folders().items()}
        return {part: max(numbers) for part, numbers in held.items() if numbers}

    def read(self, upto: int | None, only: Iterable[str] | None = None, but: Iterable[str] = ()) -> DataFrame:
        """Rows of the given parts, or of all but some; empty if there are none."""
        but, wanted = set(but), None if only is None else set(only)
        paths = [
            self.path(part, number) for part, number in sorted(self.current(upto).items())
            if part not in but and (wanted is None or part in wanted)
        ]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, number: int, rows: DataFrame, count: int = 1) -> None:
        """Replace the parts that the rows name in `part`, some `count` of them, each as a whole.

        Few parts are written by as many tasks as their size asks for, many by a task each.
        """
        kept = rows.select(*self.schema.names, PART, F.lit(number).alias(NUMBER))
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        kept = kept.repartition(min(count, tasks), PART) if count >= tasks else kept.hint("rebalance", F.col(PART))
        writer = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PART, NUMBER).parquet(self.root)

    def discard(self, number: int) -> None:
        """Drop what an unfinished batch has written."""
        where, files = _file_system(self.spark, f"{self.root}/{PART}=*/{NUMBER}={number}")
        for folder in files.globStatus(where) or []:
            files.delete(folder.getPath(), True)

    def expire(self, upto: int, seconds: float) -> None:
        """Drop the folders that another one up to `upto` replaced at least so long ago."""
        before = time.time() - seconds
        for part, written in self._folders().items():
            numbers = sorted(n for n in written if n <= upto)
            for old, newer in zip(numbers, numbers[1:]):
                if written[newer] <= before:
                    delete_folder(self.spark, self.path(part, old))
