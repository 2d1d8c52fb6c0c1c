"""Changelogs, block balances and tables in parts, against plain recomputation."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import dicts
from tillstream.operators import totals
from tillstream.operators.changelog import retractions, summed_changes
from tillstream.sinks.parts import PART, Parts
from tillstream.sinks.versions import Versions

ROW = "id string, day int, amount double, place int"


@pytest.mark.parametrize("seed", range(3))
def test_changes_turn_the_old_table_into_the_new(spark, seed):
    rng = random.Random(seed)
    rows = [(f"k{rng.randrange(12)}" if n % 3 else "hot", rng.randrange(5), float(rng.randrange(50)), n) for n in range(90)]
    rng.shuffle(rows)
    earlier, arrived = rows[:50], rows[50:]

    def table(some):
        found = {}
        for r in sorted(some, key=lambda r: r[3]):
            found[r[0]] = r
        return found

    changes = retractions(spark.createDataFrame(earlier, ROW), spark.createDataFrame(arrived, ROW), ["id"], ["place"])
    got = [(r["change"], (r["id"], r["day"], r["amount"], r["place"])) for r in changes.collect()]
    before, after = table(earlier), table(rows)
    gone = [(-1, before[k]) for k in before if before[k] != after[k]]
    come = [(1, after[k]) for k in after if after[k] != before.get(k)]
    assert sorted(got) == sorted(gone + come)
    sums = {r["day"]: (float(r["amount"]), r["rows"]) for r in summed_changes(changes, ["day"], "amount").collect()}
    for day in range(5):
        amount, count = sums.get(day, (0.0, 0))
        was, now = ([r for r in t.values() if r[1] == day] for t in (before, after))
        assert amount == sum(r[2] for r in now) - sum(r[2] for r in was) and count == len(now) - len(was)


def test_nothing_earlier(spark):
    changes = retractions(spark.createDataFrame([], ROW), spark.createDataFrame([("a", 1, 2.0, 3), ("a", 1, 4.0, 5)], ROW), ["id"], ["place"])
    assert [(r["change"], r["amount"]) for r in changes.collect()] == [(1, 4.0)]


def test_balances_and_blocks_give_the_running_totals(spark):
    rng = random.Random(5)
    rows = [
        (f"20{rng.randrange(10, 13)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d}", rng.choice(["a", "b", None]), rng.randrange(-9, 99))
        for _ in range(300)
    ]
    sums = (
        spark.createDataFrame(rows, "d string, category string, a int")
        .groupBy(F.to_date("d").alias("transaction_date"), "category").agg(F.sum("a").cast("decimal(34,6)").alias("amount"))
    )
    blocks = totals.block_totals(sums)
    assert dicts(totals.running_totals_in_blocks(sums, blocks)) == dicts(totals.running_totals(sums))
    some = sums.where(totals.month_of(F.col("transaction_date")).isin("2010-05", "2011-01"))
    wanted = totals.running_totals(sums).where(totals.month_of(F.col("transaction_date")).isin("2010-05", "2011-01"))
    assert dicts(totals.running_totals_in_blocks(some, blocks)) == dicts(wanted)


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), f"v int, {PART} string")


def values_of(df):
    return sorted(r["v"] for r in df.collect())


@pytest.mark.parametrize("count", [1, 100])
def test_parts(spark, tmp_path, count):
    table = Parts(spark, str(tmp_path / "t"), spark.createDataFrame([], "v int").schema)
    assert table.read(None).count() == table.read(3).count() == 0 and table.current(3) == {}
    table.write(0, rows_of(spark, (1, "a"), (2, "a"), (3, "b")), count)
    table.write(1, rows_of(spark, (4, "a")), count)
    table.write(5, rows_of(spark, (5, "c"), (6, "b")), count)
    assert [values_of(table.read(n)) for n in (0, 1, 4, 5)] == [[1, 2, 3], [3, 4], [3, 4], [4, 5, 6]]
    assert values_of(table.read(5, only=["a", "x"])) == [4] and values_of(table.read(5, but=["a"])) == [5, 6]
    table.write(5, rows_of(spark, (7, "c")), count)  # written again: what it names is replaced
    assert values_of(table.read(5)) == [4, 6, 7]
    table.discard(5)
    assert table.current(5) == {"a": 1, "b": 0}
    table.write(6, rows_of(spark, (8, "b")), count)
    table.expire(5, 0)
    assert table.current(5) == {"a": 1, "b": 0} and table.current(0) == {"b": 0}
    table.expire(6, 3600)
    assert table.current(5) == {"a": 1, "b": 0}
    time.sleep(0.01)
    table.expire(6, 0)
    assert table.current(5) == {"a": 1} and values_of(table.read(6)) == [4, 8]


def test_the_newest_version_without_a_list(spark, tmp_path, monkeypatch):
    table = Versions(spark, str(tmp_path / "v"))
    for number in (0, 1, 2):
        table.write(number, spark.range(number))

    def listed():
        raise AssertionError("all versions were listed")

    monkeypatch.setattr(table, "numbers", listed)
    assert (table.newest(), table.newest(before=2), table.newest(before=9)) == (2, 1, 2)
    monkeypatch.undo()
    table.discard(2)
    assert table.newest() == 1
    (tmp_path / "v" / "newest").write_text("7")  # the folder it names is gone
    assert table.newest() == 1
