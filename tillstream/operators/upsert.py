"""Keyed tables from logs of changes: last row, first row, merge, insert if absent.

Each picks one row per key by rank. Spark keeps only the first rank of each key before the shuffle
as well as after it, so a key that holds a third of the log sends one row per map task.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.order import order_columns
from tillstream.operators.enrich import is_small

# Keys are text of at most 255 characters, so this many take less than a hundred megabytes.
KEY_ROWS = 250_000


def _first_ranked(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row per key: the state of a table that upserts every row in order."""
    return _first_ranked(df, keys, [c.desc() for c in order_columns(order)])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key: the state of a table that rejects later inserts."""
    return _first_ranked(df, keys, [c.asc() for c in order_columns(order)])


def upsert(table: DataFrame | None, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A stored table after a set of changes; `order` decides between all rows of a key."""
    rows = changes if table is None else table.unionByName(changes)
    return last_by(rows, keys, order)


def upsert_few(
    table: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    broadcast_rows: int = KEY_ROWS,
) -> DataFrame:
    """As `upsert`, for a large table with few changes: rows whose key is untouched are not shuffled.

    The keys of the changes are read twice, so `changes` should be a stored table.
    """
    if table is None:
        return last_by(changes, keys, order)
    touched = changes.select(*keys).distinct()
    # Far too many keys are told by a sketch, without dealing them out; what may be few is counted.
    about = changes.agg(F.approx_count_distinct(F.struct(*keys))).first()[0]
    if about > 2 * broadcast_rows or not is_small(touched, broadcast_rows):
        return upsert(table, changes, keys, order)
    touched = F.broadcast(touched)
    kept = table.join(touched, list(keys), "left_anti")
    contested = table.join(touched, list(keys), "left_semi").unionByName(changes)
    return kept.unionByName(last_by(contested, keys, order))


def replace_keys(table: DataFrame | None, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A stored table after changes that hold at most one row per key and always win; a null key is a key."""
    if table is None:
        return changes
    mine, theirs = table.alias("mine"), changes.select(*keys).alias("theirs")
    same = functools.reduce(Column.__and__, (F.col(f"mine.{k}").eqNullSafe(F.col(f"theirs.{k}")) for k in keys))
    return mine.join(theirs, same, "left_anti").unionByName(changes)


def insert_if_absent(
    table: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Insert rows whose key is new; an existing key, or an earlier row of the same key, stays."""
    fresh = first_by(rows.join(table, list(keys), "left_anti"), keys, order)
    return table.unionByName(fresh.select(table.columns))


def seed_if_empty(table: DataFrame, seed: DataFrame) -> DataFrame:
    """The table, or the seed rows while the table has none."""
    return seed if table.isEmpty() else table
