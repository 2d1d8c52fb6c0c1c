"""Sharding by fixed virtual slots: records hash into slots, and a stored map says which shard holds a slot.

A record's slot is a hash of its id, and the number of slots never changes. What changes is the map from slots to shards,
which is kept in numbered versions. It is made from the bytes in every slot, so that shards are nearly equal in bytes:
slots are dealt from the largest to the smallest, each to the shard that holds least. A rebalance edits the newest version: every
shard keeps its largest slots up to a fair share, and only what is beyond that, or lay in a shard that is no more, is dealt again.

A slot in which an id is given very often (a third of all rows may have no id) would outweigh the rest. Such ids are
found in slots with far more rows than the others and spread over all slots by the order their rows were read in.
The list of them is never longer than the list of slots.

Only DataFrame expressions are used. Texts are read once; after that rows have ids, sizes and checksums only.
Null texts have no bytes, and an id may be null or repeated; every row is one record. No text is split, so a shard that holds a
text larger than its share is larger than the others. Equal texts may lie in different shards. A table without rows gives no rows,
and a map of empty slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.rows import dropped, stored
from tillstream.sinks.versions import Versions

SLOTS = 16_384
#: What a record takes besides its text.
OVERHEAD = 8
#: A slot with fewer rows than this is never taken as crowded.
CROWDED = 1_000

MAP = T.StructType([
    T.StructField("virtual_slot", T.IntegerType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("rows", T.LongType()),
    T.StructField("bytes", T.LongType()),
])


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a text key: the first 32 bits of its MD5, so that any engine finds the same."""
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")
    return F.pmod(bits, F.lit(slots)).cast("int")


def _id_text(ids: Column) -> Column:
    return F.coalesce(ids.cast("string"), F.lit(""))


def records(table: DataFrame, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS) -> DataFrame:
    """One stored row per record: `id`, `size`, `text_crc32`, `nth` (the order rows were read in) and `virtual_slot`."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = stored(table.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("nth"),
        slot_of(_id_text(F.col(id_column)), slots).alias("virtual_slot"),
    ), "records")
    return _spread(found, slots)


def _spread(found: DataFrame, slots: int) -> DataFrame:
    """Rows of ids that crowd a slot are dealt over all slots."""
    counts = weights(found)
    mean = F.lit((counts.agg(F.sum("rows")).first()[0] or 0) / slots)
    least = F.greatest(F.lit(CROWDED), mean)
    crowded = counts.where((F.col("rows") > CROWDED) & (F.col("rows") > 4 * mean)).select("virtual_slot")
    if crowded.isEmpty():
        return found
    often = (
        found.join(F.broadcast(crowded), "virtual_slot", "left_semi").groupBy("id").count()
        .where(F.col("count") > least).select(F.col("id").alias("often"), F.lit(True).alias("spread"))
    )
    salted = slot_of(F.concat_ws(":", _id_text(F.col("id")), F.pmod("nth", F.lit(slots)).cast("string")), slots)
    joined = found.join(F.broadcast(often), F.col("id").eqNullSafe(F.col("often")), "left")
    slot = F.when(F.col("spread"), salted).otherwise(F.col("virtual_slot"))
    return joined.withColumn("virtual_slot", slot).drop("often", "spread")


def weights(rows: DataFrame) -> DataFrame:
    """(virtual_slot, rows, bytes) of the slots in use."""
    return rows.groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def _dealt(free: DataFrame, loads: Column) -> DataFrame:
    """Free slots from the largest to the smallest, each to the shard with the smallest load, the first of equal ones.

    The list is at most as long as there are slots, so it is one array, folded by an expression.
    """
    order = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot")))
    state = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("picks"))

    def deal(now: Column, slot: Column) -> Column:
        least = F.array_position(now["loads"], F.array_min(now["loads"])).cast("int") - 1
        loaded = F.transform(now["loads"], lambda load, k: load - F.when(k == least, slot["less"]).otherwise(F.lit(0).cast("long")))
        return F.struct(loaded.alias("loads"), F.concat(now["picks"], F.array(least)).alias("picks"))

    folded = free.agg(order.alias("slots")).select("slots", F.aggregate("slots", state, deal)["picks"].alias("picks"))
    return folded.select(F.explode(F.arrays_zip(F.col("slots.virtual_slot").alias("virtual_slot"), "picks")).alias("s")).select(
        F.col("s")["virtual_slot"].alias("virtual_slot"), F.col("s")["picks"].alias("shard")
    )


def standing(now: DataFrame, shards: int, old: DataFrame | None = None, slots: int = SLOTS) -> DataFrame:
    """Every slot, stored, with its weight, the shard it `was` in by the map before, and whether it stays there."""
    every = now.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    every = every.join(now, "virtual_slot", "left").na.fill(0, ["rows", "bytes"])
    if old is None:
        every = every.withColumn("was", F.lit(None).cast("int"))
    else:
        every = every.join(old.select("virtual_slot", F.col("shard").alias("was")), "virtual_slot", "left")
    share = F.floor(F.sum("bytes").over(Window.partitionBy()) / shards)
    largest = Window.partitionBy("was").orderBy(F.desc("bytes"), "virtual_slot")
    held = F.sum("bytes").over(largest.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    every = every.withColumns({"share": share, "held": held, "nth": F.row_number().over(largest)})
    stays = (F.col("was") < shards) & ((F.col("held") <= F.col("share")) | (F.col("nth") == 1))
    return stored(every.withColumn("stays", F.coalesce(stays, F.lit(False))).drop("share", "held", "nth"), "slots")


def rebalanced(every: DataFrame, shards: int) -> DataFrame:
    """A map of every slot: those that stay, and the others dealt."""
    loads = [0] * shards
    for row in every.where("stays").groupBy("was").agg(F.sum("bytes").alias("bytes")).collect():
        loads[row["was"]] = row["bytes"]
    free = every.where(~F.col("stays"))
    dealt = _dealt(free.where(F.col("bytes") > 0), F.array(*[F.lit(n).cast("long") for n in loads]))
    # Empty slots weigh nothing and are dealt in turn.
    turn = (F.row_number().over(Window.partitionBy().orderBy("virtual_slot")) - 1) % shards
    empty = free.where(F.col("bytes") == 0).select("virtual_slot", turn.cast("int").alias("shard"))
    stay = every.where("stays").select("virtual_slot", F.col("was").alias("shard"))
    return (
        stay.unionByName(dealt).unionByName(empty)
        .join(every.select("virtual_slot", "rows", "bytes"), "virtual_slot").select(*MAP.names)
    )


class SlotMaps:
    """The map's versions below a shared folder; version 0 is the first."""

    def __init__(self, spark: SparkSession, root: str, slots: int = SLOTS):
        self.versions, self.slots = Versions(spark, root, MAP), slots

    def newest(self) -> int | None:
        return self.versions.newest()

    def read(self, version: int | None = None) -> DataFrame | None:
        """The newest map, or the one of a version."""
        return self.versions.read(None if version is None else version + 1)

    def rebalance(self, now: DataFrame, shards: int) -> int:
        """Edit the newest map, or make the first, for the given weights; gives the new version."""
        newest = self.newest()
        version = 0 if newest is None else newest + 1
        every = standing(now, shards, self.read(), self.slots)
        self.versions.write(version, rebalanced(every, shards).coalesce(1))
        dropped(every)
        return version


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """The records with their `shard` and `slot`, the place in the shard from 0 on without gaps.

    Places run through a shard's virtual slots in order, so only rows of one virtual slot are sorted together.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = weights(rows).select("virtual_slot", F.col("rows").alias("held"))
    offsets = (
        slot_map.select("virtual_slot", "shard").join(counts, "virtual_slot", "left")
        .withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
        .select("virtual_slot", "shard", "before")
    )
    inside = Window.partitionBy("virtual_slot").orderBy("id", "text_crc32", "size", "nth")
    return (
        rows.join(F.broadcast(offsets), "virtual_slot")
        .withColumn("slot", (F.col("before") + F.row_number().over(inside) - 1).cast("long"))
        .drop("before")
    )


def shard_records(
    table: DataFrame, root: str, shards: int, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS,
) -> DataFrame:
    """Every row's `id`, `size`, `text_crc32`, `nth`, `virtual_slot`, `shard` and `slot`, by a map that is brought up to date below `root`."""
    maps = SlotMaps(table.sparkSession, root, slots)
    rows = records(table, id_column, text_column, slots)
    version = maps.rebalance(weights(rows), shards)
    return placed(rows, maps.read(version))
