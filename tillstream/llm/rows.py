"""Rows of a table: keys that survive nulls and repeated ids, shared tables, guarded broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import new_folder

#: A list of 128-bit keys up to this length (some 16 MB) is broadcast; a longer one is shuffled.
BROADCAST_KEYS = 400_000
KEY = ["key_a", "key_b"]
#: At most this many keys are taken as hot.
HOT_KEYS = 10_000


def hash_pair(*columns: Column | str, seed: int = 0) -> list[Column]:
    """128 bits of the columns' values, as two longs that are never null."""
    return [F.xxhash64(F.lit(2 * seed), *columns), F.xxhash64(F.lit(2 * seed + 1), *columns)]


def keyed(table: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """`key_a`, `key_b`, `id`, `text` and `row`, which holds all columns of the table.

    Rows that are equal in id and text share a key: they are one document, given more than once. The
    table's own columns stay inside `row`, so that no name of theirs can clash with one used here.
    """
    a, b = hash_pair(F.col(id_column), F.col(text_column))
    return table.select(
        a.alias("key_a"), b.alias("key_b"),
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.struct("*").alias("row"),
    )


def with_results(joined: DataFrame, table: DataFrame, results: Sequence[str]) -> DataFrame:
    """The columns of `row`, in the table's order, and the results; a result replaces a column of its name."""
    taken = {c.lower() for c in results}
    own = [F.col("row").getField(c).alias(c) for c in table.columns if c.lower() not in taken]
    return joined.select(*own, *results)


def in_small_batches(spark: SparkSession) -> None:
    """Python workers take texts a thousand rows or 8 MB at a time, as some are very long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table, computed once and kept in the shared folder; its files outlive any executor."""
    path = new_folder(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def only_keys(table: DataFrame, keys: DataFrame, on: list[str], count: int | None = None, how: str = "left_semi") -> DataFrame:
    """Rows of the table whose key is listed (or, by `left_anti`, is not); a counted short list is broadcast."""
    if (keys.count() if count is None else count) <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return table.join(keys, on, how)


def join_counted(rows: DataFrame, keyed: DataFrame, on: list[str], copies: str, total: int) -> DataFrame:
    """Inner join of `total` rows with one row per key, whose `copies` column says how many rows have the key.

    Keys with more than a `HOT_KEYS`th of the rows, which can be no more than `HOT_KEYS`, are broadcast, so their rows are
    not shuffled; the others are shuffled, and none of them fills a task.
    """
    hot = F.col(copies) > total // HOT_KEYS
    often, seldom = F.broadcast(keyed.where(hot)), keyed.where(~hot)
    return rows.join(often, on).unionByName(rows.join(often.select(*on), on, "left_anti").join(seldom.hint("merge"), on))
