"""Order of arrival as one comparable value, and values that are computed once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def order_value(order: Sequence[str | Column]) -> Column:
    """One column as it is, several as a struct. Spark aggregates by a plain number without sorting."""
    columns = order_columns(order)
    return columns[0] if len(columns) == 1 else F.struct(*columns)


def once(value: Column) -> Column:
    """A column that is computed once for each row, however often it is used or filtered by above."""
    return F.explode(F.array(value))
