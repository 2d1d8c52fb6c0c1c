"""Typed decoding of JSON messages.

Numbers that are absent or null become 0, other absent fields null. Numeric text is accepted, and
a number's fraction is dropped where an integer is due; text that holds a fraction is no integer. The JSON literal `null` is no
record and is skipped. Whatever cannot be decoded keeps its row, with the reason in `decode_error`. A message that gives a field
twice is malformed.

A message is parsed once, to a map from its field names to their texts. Only where an integer field has a fraction is its VARIANT
asked, which knows a number from a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions import wire
from tillstream.functions.order import once
from tillstream.schemas import Field, Record

DECODE_ERROR = "decode_error"
_FIELDS = T.MapType(T.StringType(), T.StringType())
# Strict JSON; a message that is none keeps its row.
_PARSER = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _given(field: Field) -> str:
    return f"_{field.column}"


def _text(field: Field, place: int) -> Column:
    """The value as text; null if it is absent or null."""
    text = F.col("_values")[place]
    return F.trim(text) if field.type == "timestamp" else text


def _typed(field: Field) -> Column:
    given = F.col(_given(field))
    if field.type == "double":
        value = wire.read_double(given)
    elif field.type == "int":
        value = wire.read_int(given, F.try_variant_get(F.try_parse_json("_text"), f"$.{field.wire}", "int"))
    elif field.type == "timestamp":
        value = wire.read_time(given)
    else:
        return given
    return F.when(~F.col("_malformed"), value)


def decode(
    messages: DataFrame, record: Record, value: str = "value", unknown_fields: str = "reject"
) -> DataFrame:
    """Replace the message text by the record's columns; other columns pass through.

    `unknown_fields="ignore"` drops fields that the record does not have instead of rejecting the message.
    """
    if unknown_fields not in ("reject", "ignore"):
        raise ValueError(f"unknown_fields: {unknown_fields!r}")
    others = [c for c in messages.columns if c != value]
    # One step each for the parse, the fields' names, the texts, the typed values and the errors, so that none is computed twice.
    # What begins an object is no `null`, so few messages are searched for white space.
    text = F.col("_text")
    parsed = (
        messages.withColumn("_text", F.col(value).cast("string"))
        .where(text.isNull() | text.startswith("{") | (wire.stripped(text) != "null"))
        .withColumn("_fields", F.from_json("_text", _FIELDS, _PARSER))
    )
    names, known = F.map_keys("_fields"), F.array(*[F.lit(f.wire) for f in record.fields])
    # Most messages have just the record's fields, in its order: their values are taken by place. Only in others is each name looked for.
    plain, fields = F.col("_plain"), F.col("_fields")
    named = parsed.withColumn("_plain", F.coalesce(names == known, F.lit(False)))
    malformed = fields.isNull() | (~plain & (F.size(F.array_distinct(names)) < F.size(names)))
    unknown = ~plain & (F.size(F.array_except(names, known)) > 0)
    valued = named.withColumns({"_malformed": malformed, "_unknown": unknown}).withColumn(
        "_values",
        F.when(plain, F.map_values("_fields")).when(~F.col("_malformed"), F.array(*[fields[f.wire] for f in record.fields])),
    )
    given = valued.select(
        *others, "_text", "_malformed", "_unknown", *[_text(f, n).alias(_given(f)) for n, f in enumerate(record.fields)]
    )
    typed = given.withColumns({f.column: _typed(f) for f in record.fields})

    errors = [F.when(F.col("_malformed"), F.lit("malformed"))]
    if unknown_fields == "reject":
        errors.append(F.when(F.col("_unknown"), F.lit("unknown_field")))
    errors += [
        F.when(wire.unreadable(F.col(_given(f)), F.col(f.column)), F.lit(f"bad_{f.column}"))
        for f in record.fields
        if f.type != "string"
    ]
    row = F.struct(*record.columns, F.coalesce(*errors).alias(DECODE_ERROR))
    # Filters on the fields stay above, where the row is there; moved below they would decode it again for each use of a field.
    return typed.select(*others, once(row).alias("_row")).select(*others, "_row.*")
