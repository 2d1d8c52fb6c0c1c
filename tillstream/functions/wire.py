"""Column expressions between wire text and typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time formats on the wire and in seeded tables.
WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SEED_TIME = "yyyy-MM-dd HH:mm:ss"


def wire_time(ts: Column) -> Column:
    return F.date_format(ts, WIRE_TIME)


def seed_time(ts: Column) -> Column:
    return F.date_format(ts, SEED_TIME)


def stripped(text: Column) -> Column:
    return F.trim(text, F.lit(" \t\r\n"))


def blank(text: Column) -> Column:
    return F.coalesce(stripped(text) == "", F.lit(True))


def read_double(text: Column) -> Column:
    """Number or numeric text; absent or blank is 0; anything else is null."""
    return F.coalesce(text.try_cast("double"), F.when(blank(text), F.lit(0.0)))


def read_int(text: Column, number: Column) -> Column:
    """An integer or text of one; absent or blank is 0; null outside 32 bits. `number` is asked where there is a fraction."""
    return F.coalesce(
        text.try_cast("int"), F.when(blank(text), 0), F.when(text.try_cast("double").isNotNull(), number)
    )


def read_time(text: Column) -> Column:
    """ISO text with a `T`, a date, or epoch milliseconds; null when absent or unreadable."""
    dated = F.substring(text, 5, 1) == "-"
    iso = dated & ((F.substring(text, 11, 1) == "T") | (F.length(text) == 10))
    millis = text.rlike(r"^-?\d{1,15}$")
    return F.coalesce(
        F.when(iso, text.try_cast("timestamp")),
        F.when(millis, F.timestamp_millis(text.try_cast("bigint"))),
    )


def unreadable(text: Column, value: Column) -> Column:
    """True when text was given but gave no value."""
    return value.isNull() & ~blank(text)
