"""Numbered copies of a table in a shared folder.

A copy counts once Spark has marked it complete, so readers never see half of one, and writing the
same number again replaces it. Old copies can be dropped.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: How long a replaced copy stays for those who still read it.
KEEP_SECONDS = 3600.0
#: Batches after which the jobs look for what can go.
CLEAN_EVERY = 20


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    where, files = _file_system(spark, path)
    files.delete(where, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if it is not there."""
    pattern, files = _file_system(spark, f"{path}/*")
    return sorted(f.getPath().getName() for f in files.globStatus(pattern) or [])


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Keep a short text in a file of its own, in place of what is there."""
    where, files = _file_system(spark, path)
    out = files.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    where, files = _file_system(spark, path)
    if not files.exists(where):
        return None
    reader = files.open(where)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(reader, "UTF-8")
    reader.close()
    return text


def complete_numbers(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers N of the folders `name=N` that were written to the end, in order."""
    pattern, files = _file_system(spark, f"{root}/{name}=*/_SUCCESS")
    found = files.globStatus(pattern) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


class Versions:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None):
        self.spark, self.root, self.schema = spark, root, schema

    def path(self, number: int) -> str:
        return f"{self.root}/version={number}"

    def numbers(self) -> list[int]:
        return complete_numbers(self.spark, self.root, "version")

    def _complete(self, number: int) -> bool:
        where, files = _file_system(self.spark, f"{self.path(number)}/_SUCCESS")
        return files.exists(where)

    def newest(self, before: int | None = None) -> int | None:
        """The newest complete copy, or the newest numbered below `before`: the one noted last, or else by the list of all."""
        noted = read_note(self.spark, f"{self.root}/newest")
        if noted is not None:
            number = int(noted) if before is None else min(int(noted), before - 1)
            if self._complete(number):
                return number
        numbers = [n for n in self.numbers() if before is None or n < before]
        return numbers[-1] if numbers else None

    def read(self, before: int | None = None) -> DataFrame | None:
        """The newest copy, or the newest one numbered below `before`; None if there is none."""
        number = self.newest(before)
        if number is None:
            return None
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(self.path(number))

    def write(self, number: int, table: DataFrame) -> None:
        """Write a copy and note its number if it is the newest, so that nobody has to list the others to find it."""
        newest = self.newest()
        table.write.mode("overwrite").parquet(self.path(number))
        write_note(self.spark, f"{self.root}/newest", str(number if newest is None else max(number, newest)))

    def discard(self, number: int) -> None:
        """Drop a copy, if it is there."""
        delete_folder(self.spark, f"{self.root}/newest")
        delete_folder(self.spark, self.path(number))

    def _times(self) -> dict[int, float]:
        """When each copy was complete."""
        where, files = _file_system(self.spark, f"{self.root}/version=*/_SUCCESS")
        return {
            int(found.getPath().getParent().getName().split("=")[1]): found.getModificationTime() / 1000
            for found in files.globStatus(where) or []
        }

    def written(self, seconds: float) -> list[int]:
        """Copies that were complete at least so long ago."""
        return sorted(n for n, at in self._times().items() if at <= time.time() - seconds)

    def replaced(self, seconds: float) -> list[int]:
        """Copies that a newer one replaced at least so long ago: nobody has been given them since."""
        times, before = self._times(), time.time() - seconds
        numbers = sorted(times)
        return [n for n, newer in zip(numbers, numbers[1:]) if times[newer] <= before]

    def expire(self, keep: int, seconds: float = 0) -> None:
        """Drop all but the newest copies, if they were replaced so long ago that no reader can hold them.

        A copy that builds on the one before needs at least two.
        """
        old = self.numbers()[:-keep]
        if old:
            for number in sorted({*old} & {*self.replaced(seconds)} if seconds else old):
                delete_folder(self.spark, self.path(number))
