"""Sharding: fixed slots, maps that are edited, near-equal bytes."""

import zlib

from pyspark.sql import functions as F

from tests.compare import connect, differences
from tillstream.llm import oracles, queries, sharding

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    rows, found = differences(spark, connect(SF), SF, queries.op12_sharding, oracles.SQL["op12_sharding"])
    assert rows == 1000 and found == []


def test_only_data_frame_functions(spark):
    text = queries.op12_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "ExistingRDD" not in text


def loads(rows):
    found = {}
    for r in rows:
        found[r["shard"]] = found.get(r["shard"], 0) + r["bytes"]
    return found


def slot_weights(spark, sizes):
    return spark.createDataFrame([(k, 1, n) for k, n in enumerate(sizes)], "virtual_slot int, rows long, bytes long")


def test_odd_rows(table, odd_rows, spark, tmp_path):
    rows = [*odd_rows, (77, "é" * 10)]
    found = sharding.shard_records(table(rows), str(tmp_path / "maps"), 5, slots=64).collect()
    by_hand = sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert sorted(((r["id"], r["size"], r["text_crc32"]) for r in found), key=repr) == by_hand
    for shard in {r["shard"] for r in found}:
        places = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert places == list(range(len(places)))
    slots = {}
    for r in found:
        assert slots.setdefault(r["id"], r["virtual_slot"]) == r["virtual_slot"]


def test_no_rows(table, tmp_path):
    assert sharding.shard_records(table([]), str(tmp_path / "maps"), 3, slots=16).count() == 0
    assert sharding.shard_records(table([(1, "a")]), str(tmp_path / "maps"), 3, slots=16).count() == 1


def test_largest_first_to_the_least_loaded(spark, tmp_path):
    maps = sharding.SlotMaps(spark, str(tmp_path / "maps"), 8)
    assert maps.rebalance(slot_weights(spark, [9, 7, 6, 5, 5, 4, 1]), 3) == 0
    found = maps.read().collect()
    # 9 | 7 | 6, then 5 to the third, 5 to the second, 4 to the first, 1 to the third of 13, 12, 11.
    assert {r["virtual_slot"]: r["shard"] for r in found if r["bytes"]} == {0: 0, 1: 1, 2: 2, 3: 2, 4: 1, 5: 0, 6: 2}
    assert len(found) == 8


def test_a_rebalance_moves_little(spark, tmp_path):
    """One more shard takes its share; a shard that goes gives its slots away; old versions stay readable."""
    sizes = [1000 + (k * 7919) % 400 for k in range(512)]
    now, maps = slot_weights(spark, sizes), sharding.SlotMaps(spark, str(tmp_path / "maps"), 512)
    maps.rebalance(now, 7)
    maps.rebalance(now, 8)
    maps.rebalance(now, 8)
    maps.rebalance(now, 6)
    before, grown, same, shrunk = (
        {r["virtual_slot"]: r["shard"] for r in maps.read(v).collect()} for v in range(4)
    )
    moved = {k for k in before if before[k] != grown[k]}
    assert sum(sizes[k] for k in moved) < 1.2 * sum(sizes) / 8
    assert sum(grown[k] == 7 for k in moved) > 0.9 * len(moved)
    assert sum(same[k] != grown[k] for k in same) <= 16
    assert set(shrunk.values()) == set(range(6))
    for version, shards in ((0, 7), (1, 8), (3, 6)):
        found = loads(maps.read(version).collect())
        assert len(found) == shards and max(found.values()) - min(found.values()) < 1400


def test_a_slot_larger_than_a_share(spark, tmp_path):
    now, maps = slot_weights(spark, [10_000, 10, 10, 10]), sharding.SlotMaps(spark, str(tmp_path / "maps"), 4)
    maps.rebalance(now, 2)
    maps.rebalance(now, 2)
    first, second = ({r["virtual_slot"]: r["shard"] for r in maps.read(v).collect()} for v in (0, 1))
    assert first == second and len({first[k] for k in (1, 2, 3)}) == 1 != first[0]


def test_an_id_of_a_third_of_all_rows_is_spread(spark, tmp_path):
    docs = spark.range(12_000).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.lit("some text").alias("text")
    )
    found = sharding.shard_records(docs, str(tmp_path / "maps"), 4, slots=256)
    sizes = {r["shard"]: r["n"] for r in found.groupBy("shard").agg(F.sum("size").alias("n")).collect()}
    assert found.count() == 12_000 and max(sizes.values()) < 1.01 * min(sizes.values())
    assert found.groupBy("virtual_slot").count().agg(F.max("count")).first()[0] < 200
    assert found.select("shard", "slot").distinct().count() == 12_000
