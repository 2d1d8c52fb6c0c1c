import pytest
from pyspark.sql import functions as F

from tillstream.schemas import RATE, SALE
from tillstream.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SALE_DEFAULTS = dict(
    transaction_id="t", product_id="p", product_name="lamp", product_category="home",
    product_price=1.0, product_quantity=1, product_brand="b", total_amount=1.0, currency="EUR",
    customer_id="c", transaction_date="2024-01-01T10:00:00", payment_method="card",
)
RATE_DEFAULTS = dict(
    from_currency="EUR", to_currency="USD", exchange_rate=2.0, last_updated="2024-01-01T00:00:00",
)


def _table(spark, record, defaults, rows, order_column):
    names = [*record.columns, order_column]
    data = []
    for n, row in enumerate(rows):
        full = defaults | {order_column: n} | row
        data.append([full[c] for c in names])
    stamps = {f.column for f in record.fields if f.type == "timestamp"}
    kinds = {f.column: f.type for f in record.fields} | {order_column: "bigint"}
    ddl = ", ".join(f"{c} {'string' if c in stamps else kinds[c]}" for c in names)
    df = spark.createDataFrame(data, ddl)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in stamps})


@pytest.fixture
def sales(spark):
    """A sales table from the differences of each row to a plain sale."""
    return lambda *rows: _table(spark, SALE, SALE_DEFAULTS, rows, "arrival_seq")


@pytest.fixture
def updates(spark):
    """Rate updates, likewise."""
    return lambda *rows: _table(spark, RATE, RATE_DEFAULTS, rows, "arrival_seq")


def dicts(df, *columns):
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((r.asDict(recursive=True) for r in rows), key=lambda d: [(v is None, str(v)) for v in d.values()])


def values(df, column, order="transaction_id"):
    return [r[0] for r in df.orderBy(order).select(column).collect()]
