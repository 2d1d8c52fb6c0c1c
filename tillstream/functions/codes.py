"""Currency codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The 39 codes for which rates are kept.
CURRENCY_CODES = [
    "USD", "EUR", "JPY", "GBP", "AUD", "CAD", "CHF", "CNY", "SEK", "NZD",
    "MXN", "SGD", "HKD", "NOK", "KRW", "TRY", "RUB", "ZAR", "BRL",
    "IDR", "PLN", "PHP", "THB", "MYR", "CZK", "HUF", "ILS", "CLP", "AED",
    "COP", "INR", "KES", "EGP", "LKR", "VND", "QAR", "BHD", "KWD", "OMR",
]
BASE_CURRENCY = "USD"


def code_list(codes: list[str]) -> Column:
    return F.array(*[F.lit(c) for c in codes])


def code_pairs(spark: SparkSession, codes: list[str] = CURRENCY_CODES) -> DataFrame:
    """Every ordered pair of codes, equal codes included."""
    both = code_list(codes)
    return (
        spark.range(1)
        .select(F.explode(both).alias("from_currency"))
        .select("from_currency", F.explode(both).alias("to_currency"))
    )
