"""Table constraints as data-quality rules.

A checked table carries `violations`: the names of the broken rules, comma-separated, empty for
a good row. Accepted rows and quarantine are filters on that column, so one pass serves both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.money import fits_money, stored_rate
from tillstream.schemas import RATE, SALE, Record

VIOLATIONS = "violations"
Rule = tuple[str, Column]


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def too_long(df: DataFrame, limits: dict[str, int]) -> list[Rule]:
    return [
        (f"long_{name}", F.length(name) > limit)
        for name, limit in limits.items()
        if name in df.columns
    ]


def absent(*columns: str) -> list[Rule]:
    return [(f"missing_{name}", F.col(name).isNull()) for name in columns]


def with_violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    found = [F.when(_holds(broken), F.lit(name)) for name, broken in rules]
    if "decode_error" in df.columns:
        found.insert(0, F.col("decode_error"))
    return df.withColumn(VIOLATIONS, F.concat_ws(",", *found))


def rate_rules(rates: DataFrame, as_of: Column | None = None) -> list[Rule]:
    """Rates need both codes, a positive stored rate and a time that is not after `as_of`."""
    rules = absent(*RATE.key) + too_long(rates, RATE.text_limits())
    rules.append(("rate_not_positive", ~_holds(stored_rate(F.col("exchange_rate")) > 0)))
    rules += absent("last_updated")
    if as_of is not None:
        rules.append(("future_last_updated", F.col("last_updated") > as_of))
    return rules


def sale_rules(sales: DataFrame) -> list[Rule]:
    """Sales need an id, an event time and a category; text must fit, amounts must be summable."""
    rules = absent("transaction_id") + too_long(sales, SALE.text_limits())
    rules += absent("transaction_date", "product_category")
    amount = F.col("total_amount")
    rules.append(("amount_out_of_range", amount.isNotNull() & ~fits_money(amount)))
    return rules


def check_rates(rates: DataFrame, as_of: Column | None = None) -> DataFrame:
    return with_violations(rates, rate_rules(rates, as_of))


def check_sales(sales: DataFrame) -> DataFrame:
    return with_violations(sales, sale_rules(sales))


def decode_errors(record: Record) -> list[str]:
    """What decoding may find wrong with a message."""
    return ["malformed", "unknown_field", *(f"bad_{f.column}" for f in record.fields if f.type != "string")]


def rule_counts(rules: Sequence[str]) -> list[Column]:
    """How many rows of a checked table are accepted, and how many break each rule; a row may break several."""
    bad, broken = F.col(VIOLATIONS) != "", F.concat(F.lit(","), F.col(VIOLATIONS), F.lit(","))
    return [
        F.count("*").alias("rows"), F.count_if(~bad).alias("accepted"),
        *(F.count_if(bad & broken.contains(f",{rule},")).alias(rule) for rule in rules),
    ]


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(VIOLATIONS) == "").drop(VIOLATIONS)


def quarantine(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(VIOLATIONS) != "")


class QualityError(ValueError):
    """Raised where a job is told to fail on bad rows."""


def require_clean(checked: DataFrame) -> DataFrame:
    """Fail on the first bad row instead of setting bad rows aside."""
    bad = quarantine(checked).select(VIOLATIONS).head(1)
    if bad:
        raise QualityError(f"row breaks: {bad[0][0]}")
    return accepted(checked)
