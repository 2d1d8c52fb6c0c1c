"""Upserts into an external database: rows go to a staging table, one statement merges them.

Needs the database's driver on the class path.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tillstream.settings import BATCH_SIZE, DB_DRIVER, DB_PASSWORD, DB_URL, DB_USER, Settings
from tillstream.sources.tables import connection_options

# Attempts after a failed write; connections at a time; tables and their keys.
MAX_RETRIES = 3
CONNECTIONS = 20
RATES_TABLE, SALES_TABLE = "currency_conversion_rates", "transactions"
CATEGORY_TABLE, DAY_TABLE = "sales_per_category", "sales_per_day"
TABLE_KEYS = {
    RATES_TABLE: ("from_currency", "to_currency"),
    SALES_TABLE: ("transaction_id",),
    CATEGORY_TABLE: ("transaction_date", "category"),
    DAY_TABLE: ("transaction_date",),
}

Publish = Callable[[dict[str, DataFrame]], None]


def merge_statement(table: str, stage: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """Insert staged rows; a row whose key exists replaces the other columns."""
    names = ", ".join(columns)
    changes = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    action = f"UPDATE SET {changes}" if changes else "NOTHING"
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} ON CONFLICT ({', '.join(keys)}) DO {action}"


def insert_statement(table: str, stage: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """Insert staged rows; an existing key keeps its row."""
    names = ", ".join(columns)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} ON CONFLICT ({', '.join(keys)}) DO NOTHING"


def write_options(settings: Settings, table: str) -> dict[str, str]:
    return connection_options(settings) | {
        "dbtable": table,
        "batchsize": settings.require(BATCH_SIZE),
        "numPartitions": str(CONNECTIONS),
        "truncate": "true",
    }


def execute(spark: SparkSession, settings: Settings, statement: str, retries: int = MAX_RETRIES) -> None:
    """Run one statement on the database, trying again after an error."""
    jvm = spark.sparkContext._jvm
    if settings.get(DB_DRIVER):
        jvm.java.lang.Class.forName(settings.get(DB_DRIVER))
    for attempt in range(retries + 1):
        try:
            connection = jvm.java.sql.DriverManager.getConnection(
                settings.require(DB_URL), settings.get(DB_USER), settings.get(DB_PASSWORD)
            )
            try:
                connection.createStatement().execute(statement)
            finally:
                connection.close()
            return
        except Py4JJavaError:
            if attempt == retries:
                raise


def upsert_into(
    rows: DataFrame, settings: Settings, table: str, keys: Sequence[str], replace: bool = True
) -> None:
    """Upsert rows, one per key, so that writing them again changes nothing."""
    stage = f"{table}_stage"
    rows.write.format("jdbc").options(**write_options(settings, stage)).mode("overwrite").save()
    statement = merge_statement if replace else insert_statement
    execute(rows.sparkSession, settings, statement(table, stage, rows.columns, keys))


def publisher(settings: Settings) -> Publish:
    """Upsert the changed rows of each table into the database of the settings."""

    def publish(changes: dict[str, DataFrame]) -> None:
        for table, rows in changes.items():
            upsert_into(rows, settings, table, TABLE_KEYS[table])

    return publish
