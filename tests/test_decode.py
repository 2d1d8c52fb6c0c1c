import datetime

import pytest

from tests.conftest import dicts
from tillstream.schemas import RATE, SALE
from tillstream.sources.decode import decode

UTC_DATE = datetime.datetime


def decoded(spark, text, record=SALE, **options):
    rows = dicts(decode(spark.createDataFrame([(text,)], "value string"), record, **options))
    return rows[0] if rows else None


@pytest.mark.parametrize("text, error", [
    ("not json", "malformed"),
    ('{"transactionId": "1"', "malformed"),
    ('[{"transactionId": "1"}]', "malformed"),
    ("", "malformed"),
    (None, "malformed"),
    ('"text"', "malformed"),
    ("{'transactionId': '1'}", "malformed"),
    ('{"productPrice": NaN}', "malformed"),
    ('{transactionId: 1}', "malformed"),
    ('{"productPrice": "\\t"}', None),
    ('{"transactionId": "1", "colour": "red"}', "unknown_field"),
    ('{"ProductName": "lamp"}', "unknown_field"),
    ('{"productPrice": "cheap"}', "bad_product_price"),
    ('{"productPrice": true}', "bad_product_price"),
    ('{"productQuantity": 3000000000}', "bad_product_quantity"),
    ('{"productQuantity": "2.7"}', "bad_product_quantity"),
    ('{"productQuantity": false}', "bad_product_quantity"),
    ('{"productPrice": {"a": 1}}', "bad_product_price"),
    ('{"productPrice": 1, "productPrice": 2}', "malformed"),
    ('{"transactionId": {"a": 1}}', None),
    ('{"transactionDate": "yesterday"}', "bad_transaction_date"),
    ('{"transactionDate": "2024-01-01 10:00:00"}', "bad_transaction_date"),
    ("{}", None),
    ('{"transactionDate": ""}', None),
])
def test_errors(spark, text, error):
    assert decoded(spark, text)["decode_error"] == error


def test_null_is_no_record(spark):
    assert decoded(spark, "null") is None
    assert decoded(spark, "  null ") is None
    assert decoded(spark, "\r\n\tnull\n") is None


def test_unknown_fields_can_be_ignored(spark):
    row = decoded(spark, '{"transactionId": "1", "colour": "red"}', unknown_fields="ignore")
    assert (row["transaction_id"], row["decode_error"]) == ("1", None)


@pytest.mark.parametrize("text, price, quantity", [
    ("{}", 0.0, 0),
    ('{"productPrice": null, "productQuantity": null}', 0.0, 0),
    ('{"productPrice": "10.5", "productQuantity": "4"}', 10.5, 4),
    ('{"productPrice": "", "productQuantity": " "}', 0.0, 0),
    ('{"productPrice": 3, "productQuantity": 2.7}', 3.0, 2),
    ('{"productPrice": 1e3, "productQuantity": -2.7}', 1000.0, -2),
])
def test_numbers(spark, text, price, quantity):
    row = decoded(spark, text)
    assert (row["product_price"], row["product_quantity"], row["decode_error"]) == (price, quantity, None)


@pytest.mark.parametrize("given, expected", [
    ('"2024-01-02T03:04:05.123456"', UTC_DATE(2024, 1, 2, 3, 4, 5, 123456)),
    ('"2024-01-02T03:04:05+02:00"', UTC_DATE(2024, 1, 2, 1, 4, 5)),
    ('"2024-01-02T03:04:05Z"', UTC_DATE(2024, 1, 2, 3, 4, 5)),
    ('" 2024-01-02 "', UTC_DATE(2024, 1, 2)),
    ("1704164645000", UTC_DATE(2024, 1, 2, 3, 4, 5)),
    ("null", None),
])
def test_times(spark, given, expected):
    df = decode(spark.createDataFrame([(f'{{"lastUpdated": {given}}}',)], "value string"), RATE)
    row = df.selectExpr("cast(last_updated as timestamp_ntz) as t", "decode_error").first()
    assert (row.t, row.decode_error) == (expected, None)


def test_text_fields_take_scalars_and_bytes_are_text(spark):
    df = spark.createDataFrame([(bytearray(b'{"transactionId": 12, "customerId": true}'),)], "value binary")
    row = decode(df, SALE).first()
    assert (row.transaction_id, row.customer_id, row.decode_error) == ("12", "true", None)


def test_one_parse(spark):
    """Values and the names of the fields come from one parse of the text, also below filters."""
    df = decode(spark.createDataFrame([("{}",)], "value string"), SALE).where("decode_error is null and product_price > 0")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1 and "json_object_keys" not in text


def test_values_are_taken_by_place(spark):
    """Where a message has just the record's fields, in its order, none is looked for by name."""
    df = decode(spark.createDataFrame([("{}",)], "value string"), SALE)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("map_values") == 1 and "_values#" in text


def test_order_of_fields_does_not_matter(spark):
    """In the record's order with a null, in another order, with a field absent, with an unknown one."""
    full = [("fromCurrency", '"EUR"'), ("toCurrency", "null"), ("exchangeRate", "2.5"), ("lastUpdated", '"2024-01-02"')]
    given = [full, full[::-1], full[1:], [*full, ("colour", '"red"')]]
    texts = ["{" + ", ".join(f'"{name}": {value}' for name, value in fields) + "}" for fields in given]
    df = decode(spark.createDataFrame(list(enumerate(texts)), "n int, value string"), RATE).orderBy("n")
    found = [(r.from_currency, r.to_currency, r.exchange_rate, r.last_updated.day, r.decode_error) for r in df.collect()]
    assert found == [("EUR", None, 2.5, 2, None), ("EUR", None, 2.5, 2, None), (None, None, 2.5, 2, None),
                     ("EUR", None, 2.5, 2, "unknown_field")]


def test_text_fields_hold_json(spark):
    row = decoded(spark, '{"transactionId": {"a": [1, 2]}, "customerId": 2.50, "productId": "2.50"}')
    assert (row["transaction_id"], row["customer_id"], row["product_id"]) == ('{"a":[1,2]}', "2.5", "2.50")


def test_other_columns_pass_through(spark):
    df = spark.createDataFrame([("{}", 7)], "value string, offset int")
    assert decode(df, RATE).columns == ["offset", *RATE.columns, "decode_error"]


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        decode(spark.createDataFrame([("{}",)], "value string"), SALE, unknown_fields="keep")
