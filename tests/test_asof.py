"""As-of conversion against a brute-force reading of the rule."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tillstream.operators import asof

MILLI, SECOND = 1_000, 1_000_000
MINUTE, HOUR = 60 * SECOND, 3600 * SECOND


def stamp(micros: int) -> str:
    return f"2024-01-01T{micros // 3_600_000_000:02d}:{micros // 60_000_000 % 60:02d}:{micros // 1_000_000 % 60:02d}.{micros % 1_000_000:06d}"


def test_boundaries(sales, updates):
    rates = updates(
        {"last_updated": "2024-01-02T00:00:00", "exchange_rate": 2.0},
        {"last_updated": "2024-01-04T00:00:00", "exchange_rate": 4.0},
        {"last_updated": "2024-01-04T00:00:00", "exchange_rate": 5.0},
        {"last_updated": "2024-01-03T00:00:00", "exchange_rate": 3.0, "to_currency": "GBP"},
    )
    df = sales(
        {"transaction_id": "1", "transaction_date": "2024-01-01T23:59:59.999999"},
        {"transaction_id": "2", "transaction_date": "2024-01-02T00:00:00"},
        {"transaction_id": "3", "transaction_date": "2024-01-03T23:59:59.999999"},
        {"transaction_id": "4", "transaction_date": "2024-01-04T00:00:00"},
        {"transaction_id": "5", "transaction_date": "2030-01-01T00:00:00"},
        {"transaction_id": "6", "currency": None},
        {"transaction_id": "7", "currency": "JPY"},
        {"transaction_id": "8", "transaction_date": None},
    )
    for limit in (asof.BROADCAST_ROWS, 0):
        out = asof.convert_as_of(df, rates, broadcast_rows=limit)
        assert values(out, "total_amount") == [1.0, 2.0, 2.0, 5.0, 5.0, 1.0, 1.0, 1.0]
        assert values(out, "rate_status") == ["missing"] + ["hit"] * 4 + ["missing"] * 3


@pytest.mark.parametrize("seed, span, most", [
    (1, 50, 1), (2, 3 * MILLI, 1), (3, 3 * SECOND, 1), (4, 3 * MINUTE, 2), (5, 23 * HOUR, 64),
    (6, 23 * HOUR, 1), (7, 3 * HOUR, 8),
])
def test_random(sales, updates, seed, span, most):
    pick = random.Random(seed)
    codes = ["EUR", "JPY", "EUR", "KRW"]
    changes = [
        {"from_currency": pick.choice(codes[:3]), "at": pick.randrange(span), "exchange_rate": float(n + 2)}
        for n in range(60)
    ]
    sold = [{"currency": pick.choice(codes), "at": pick.randrange(span)} for _ in range(80)]

    def rate(code, at):
        known = [(c["at"], n) for n, c in enumerate(changes) if c["from_currency"] == code and c["at"] <= at]
        return changes[max(known)[1]]["exchange_rate"] if known else 1.0

    rates = updates(*[{k: v for k, v in c.items() if k != "at"} | {"last_updated": stamp(c["at"])} for c in changes])
    df = sales(*[{"transaction_id": f"{n:03d}", "currency": s["currency"], "transaction_date": stamp(s["at"])}
                 for n, s in enumerate(sold)])
    expected = [rate(s["currency"], s["at"]) for s in sold]
    for limit in (asof.BROADCAST_ROWS, 0):
        out = asof.convert_as_of(df, rates, broadcast_rows=limit, block_rows=most)
        assert values(out, "total_amount") == expected


def points(spark, *times, code="EUR"):
    rows = [(code, t, float(n), n, False) for n, t in enumerate(times)]
    return spark.createDataFrame(rows, "code string, since long, rate double, arrival int, carried boolean")


def test_busy_days_are_cut_into_blocks(spark):
    """Ten thousand changes in a second, then three on the next day: blocks of a hundred, and a list of their starts."""
    busy = [5 * n for n in range(10_000)]
    closed, last = asof.intervals_of(points(spark, *busy, asof.DAY, asof.DAY + 9, asof.DAY + 50))
    rows = closed.collect()
    blocks = {}
    for r in rows:
        if r["block"] >= 0:
            blocks.setdefault((r["day"], r["block"]), []).append(r["since"])
    assert len(blocks) == 101 and {len(b) for (day, _), b in blocks.items() if day == 0} == {100}
    starts = {r["day"]: r["starts"] for r in rows if r["block"] == asof.STARTS}
    assert starts == {0: [5 * 100 * k for k in range(1, 100)]}
    assert [(r["since"], r["rate"]) for r in last.collect()] == [(asof.DAY + 50, 10_002.0)]


def test_intervals_touch_and_carry(spark):
    closed, last = asof.intervals_of(points(spark, 10, 3 * asof.DAY + 5))
    found = sorted((r["day"], r["since"], r["until"], r["rate"], r["carried"]) for r in closed.collect())
    assert found == [
        (0, 10, asof.DAY, 0.0, False), (asof.DAY, asof.DAY, 2 * asof.DAY, 0.0, True),
        (2 * asof.DAY, 2 * asof.DAY, 3 * asof.DAY, 0.0, True), (3 * asof.DAY, 3 * asof.DAY, 3 * asof.DAY + 5, 0.0, True),
    ]
    assert last.first()["since"] == 3 * asof.DAY + 5


def test_sales_are_read_once(spark, sales, updates, tmp_path):
    path = str(tmp_path / "sales")
    sales({"transaction_id": "1"}).write.parquet(path)
    text = asof.convert_as_of(spark.read.parquet(path), updates({}))._jdf.queryExecution().executedPlan().toString()
    assert text.count("customer_id") and text.count(path.split("/")[-2]) == 1


def test_an_update_without_a_rate_changes_nothing(sales, updates):
    rates = updates({"exchange_rate": 2.0}, {"exchange_rate": None, "last_updated": "2024-01-02T00:00:00"})
    assert values(asof.convert_as_of(sales({"transaction_date": "2024-01-05T00:00:00"}), rates), "total_amount") == [2.0]


def test_rates_carry_over_days(sales, updates):
    rates = updates(*[
        {"last_updated": f"2024-01-0{d}T10:00:00.00000{n}", "exchange_rate": float(10 * d + n)}
        for d in (1, 2, 5) for n in range(5)
    ])
    df = sales(*[{"transaction_id": str(d), "transaction_date": f"2024-01-0{d}T09:00:00"} for d in range(1, 8)])
    for most in (1, 64):
        out = asof.convert_as_of(df, rates, block_rows=most)
        assert values(out, "total_amount") == [1.0, 14.0, 24.0, 24.0, 24.0, 54.0, 54.0]


def test_times_before_1970(sales, updates):
    rates = updates({"last_updated": "1969-12-30T12:00:00", "exchange_rate": 6.0})
    df = sales(
        {"transaction_id": "1", "transaction_date": "1969-12-30T11:00:00"},
        {"transaction_id": "2", "transaction_date": "1969-12-30T13:00:00"},
        {"transaction_id": "3", "transaction_date": "1969-12-31T13:00:00"},
    )
    assert values(asof.convert_as_of(df, rates), "total_amount") == [1.0, 6.0, 6.0]
