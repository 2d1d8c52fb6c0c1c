"""Properties over random tables: order of rows, split into parts, and agreement with plain Python."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tests.conftest import dicts
from tillstream.operators import rates, totals, upsert
from tillstream.schemas import SALE


def some_sales(seed, n=60):
    pick = random.Random(seed)
    return [
        {
            "transaction_id": f"t{pick.randrange(n // 2)}",
            "product_category": pick.choice(["home", "food", "home", "toys"]),
            "total_amount": round(pick.uniform(0, 1000), 2),
            "transaction_date": f"2024-01-{pick.randrange(1, 9):02d}T{pick.randrange(24):02d}:00:00",
            "arrival_seq": seq,
        }
        for seq in pick.sample(range(10 * n), n)
    ]


def tables(df):
    return [
        dicts(upsert.last_by(df, SALE.key, ["arrival_seq"])),
        dicts(totals.sales_per_day(df)),
        dicts(totals.category_running(df)),
        dicts(totals.category_total(df)),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_order_of_rows_does_not_matter(sales, seed):
    rows = some_sales(seed)
    shuffled = random.Random(seed + 100).sample(rows, len(rows))
    assert tables(sales(*rows)) == tables(sales(*shuffled).repartition(5))


@pytest.mark.parametrize("seed", range(3))
def test_tables_follow_the_rules(sales, seed):
    rows = some_sales(seed)
    last, days, running = {}, {}, {}
    for row in sorted(rows, key=lambda r: r["arrival_seq"]):
        day = row["transaction_date"][:10]
        amount = Decimal(str(row["total_amount"])).quantize(Decimal("0.000001"), ROUND_HALF_UP)
        last[row["transaction_id"]] = row["total_amount"]
        days[day] = days.get(day, 0) + amount
        running[(day, row["product_category"])] = 0
    for day, category in running:
        running[(day, category)] = float(sum(
            Decimal(str(r["total_amount"])) for r in rows
            if r["product_category"] == category and r["transaction_date"][:10] <= day
        ))
    df = sales(*rows)
    found = upsert.last_by(df, SALE.key, ["arrival_seq"]).collect()
    assert {r.transaction_id: r.total_amount for r in found} == last
    assert {str(r.transaction_date): r.total_sales for r in totals.sales_per_day(df).collect()} == {
        d: float(a) for d, a in days.items()
    }
    assert {(str(r.transaction_date), r.category): r.total_sales for r in totals.category_running(df).collect()} == running


@pytest.mark.parametrize("seed", range(3))
def test_folding_in_parts_equals_the_whole(sales, seed):
    rows = some_sales(seed)
    whole = sales(*rows)
    parts = [sales(*rows[i::3]) for i in range(3)]
    table, few, sums = None, None, None
    for part, limit in zip(parts, (1000, 1000, 0)):
        table = upsert.upsert(table, part, SALE.key, ["arrival_seq"])
        few = upsert.upsert_few(few, part, SALE.key, ["arrival_seq"], broadcast_rows=limit)
        sums = totals.daily_category_sums(part) if sums is None else totals.merge_sums(sums, totals.daily_category_sums(part))
    assert dicts(table) == dicts(few) == dicts(upsert.last_by(whole, SALE.key, ["arrival_seq"]))
    assert dicts(totals.day_totals(sums)) == dicts(totals.sales_per_day(whole))
    assert dicts(totals.running_totals(sums)) == dicts(totals.category_running(whole))


def test_latest_rate_per_pair(updates):
    pick = random.Random(7)
    rows = [
        {"from_currency": pick.choice("ABC"), "to_currency": pick.choice("XY"), "exchange_rate": float(n + 1),
         "arrival_seq": seq}
        for n, seq in enumerate(pick.sample(range(500), 80))
    ]
    expected = {}
    for row in sorted(rows, key=lambda r: r["arrival_seq"]):
        expected[(row["from_currency"], row["to_currency"])] = row["exchange_rate"]
    found = rates.latest_rates(rates.stored(updates(*rows))).collect()
    assert {(r.from_currency, r.to_currency): float(r.exchange_rate) for r in found} == expected
