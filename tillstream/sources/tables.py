"""Stored tables: files or a database."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tillstream.settings import DB_DRIVER, DB_PASSWORD, DB_URL, DB_USER, Settings

Read = TypeVar("Read")


def connection_options(settings: Settings) -> dict[str, str]:
    found = {
        "url": settings.require(DB_URL),
        "user": settings.get(DB_USER),
        "password": settings.get(DB_PASSWORD),
        "driver": settings.get(DB_DRIVER),
    }
    return {key: value for key, value in found.items() if value is not None}


def database_table(spark: SparkSession, settings: Settings, table: str) -> DataFrame:
    """A database table. Needs the database's driver on the class path."""
    return spark.read.format("jdbc").options(**connection_options(settings)).option("dbtable", table).load()


def table_or_none(read: Callable[[], Read], on_error: str = "pass") -> Read | None:
    """What `read` gives, or None if it cannot be read; `on_error="fail"` raises instead."""
    try:
        return read()
    except (PySparkException, Py4JError):
        if on_error == "fail":
            raise
        return None
