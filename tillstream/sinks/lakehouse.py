"""Upserts into catalog tables that support `MERGE INTO`.

Needs a table format with row-level updates on the class path; plain Parquet tables have none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tillstream.sinks.database import TABLE_KEYS, Publish


def merge_condition(keys: Sequence[str]) -> str:
    return " AND ".join(f"stored.{k} = changed.{k}" for k in keys)


def merge_into(rows: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert rows, one per key; the table format decides which files to rewrite."""
    view = f"changed_{table.replace('.', '_')}"
    rows.createOrReplaceTempView(view)
    rows.sparkSession.sql(
        f"MERGE INTO {table} AS stored USING {view} AS changed ON {merge_condition(keys)} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def publisher(catalog: str) -> Publish:
    """Upsert the changed rows of each table into the tables of a catalog or schema."""

    def publish(changes: dict[str, DataFrame]) -> None:
        for table, rows in changes.items():
            merge_into(rows, f"{catalog}.{table}", TABLE_KEYS[table])

    return publish
