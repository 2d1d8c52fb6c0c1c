"""Record and table schemas, and the names each field has on the wire and in tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Wire name, column name, type, longest text allowed.
SALE_FIELDS = [
    ("transactionId", "transaction_id", "string", 255),
    ("productId", "product_id", "string", 255),
    ("productName", "product_name", "string", 255),
    ("productCategory", "product_category", "string", 255),
    ("productPrice", "product_price", "double", None),
    ("productQuantity", "product_quantity", "int", None),
    ("productBrand", "product_brand", "string", 255),
    ("totalAmount", "total_amount", "double", None),
    ("currency", "currency", "string", 255),
    ("customerId", "customer_id", "string", 255),
    ("transactionDate", "transaction_date", "timestamp", None),
    ("paymentMethod", "payment_method", "string", 255),
]
RATE_FIELDS = [
    ("fromCurrency", "from_currency", "string", 3),
    ("toCurrency", "to_currency", "string", 3),
    ("exchangeRate", "exchange_rate", "double", None),
    ("lastUpdated", "last_updated", "timestamp", None),
]
TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Field:
    wire: str
    column: str
    type: str
    max_length: int | None


@dataclass(frozen=True)
class Record:
    """One kind of message: its fields and the columns that identify a row."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [f.column for f in self.fields]

    def schema(self, **other: T.DataType) -> T.StructType:
        """Columns with their types; `other` replaces some by name."""
        kinds = {f.column: other.get(f.column, TYPES[f.type]) for f in self.fields}
        return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])

    def text_limits(self) -> dict[str, int]:
        return {f.column: f.max_length for f in self.fields if f.max_length}


SALE = Record("sale", tuple(Field(*f) for f in SALE_FIELDS), ("transaction_id",))
RATE = Record("rate", tuple(Field(*f) for f in RATE_FIELDS), ("from_currency", "to_currency"))

# Rates are stored with six decimal places; sums of money run in a wider decimal of the same scale.
RATE_TYPE = T.DecimalType(18, 6)
MONEY_TYPE = T.DecimalType(24, 6)

SALES_PER_CATEGORY = T.StructType([
    T.StructField("transaction_date", T.DateType()),
    T.StructField("category", T.StringType()),
    T.StructField("total_sales", T.DoubleType()),
])
SALES_PER_DAY = T.StructType([
    T.StructField("transaction_date", T.DateType()),
    T.StructField("total_sales", T.DoubleType()),
])

# A message as a topic delivers it; folders of recorded messages use the same columns.
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
ARRIVAL = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# Stored rates, with the arrival that wrote each.
STORED_RATES = RATE.schema(exchange_rate=RATE_TYPE).add("arrival", ARRIVAL)
STORED_SALES = SALE.schema().add("arrival", ARRIVAL)
