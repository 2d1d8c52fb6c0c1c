"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets and star-shaped links.

A document's set holds its distinct shingles of some words. One hash of every shingle splits the set into
`SLOTS` bins; each bin's smallest value fills its slot, and an empty slot takes the value of the first filled one in
a fixed random order of its own. `SLOTS / BANDS` slots make a band; documents with an equal band share
a bucket. Two sets with a similarity of 0.8 miss each other in all buckets with a probability of 4e-6.

Equal sets are one node, so copies cost nothing further. Buckets link in stars: a round picks centres in each bucket, links
them with the bucket's other members by comparing full sets, and merges the components. One centre serves the
first round, the member of most and fullest buckets, and sixteen times as many each following one, members of the smallest
components first; no pair is compared twice. So a group of near copies needs about as many links as it has members. A bucket is finished when all its members that have not been centres
are in one component: then every two members that could still be apart have been compared, and no link is lost. Pairs
whose sizes rule out the similarity are not compared; after the first round, nor are pairs whose sketches rule it out. A sketch
has a bit for each of `SKETCH` * 64 parts of the hash range, set if an odd number of the set's shingles lie there; two sets differ in
at least as many shingles as their sketches do in bits, so the bound is exact. The join judges it, so such pairs are neither
shuffled nor compared; what is left to them is one count of bits for each centre and member with a common bucket.

Words are what stands between ASCII white space, A-Z taken as a-z. A text with fewer words than a shingle has its whole
sequence as its only shingle. A null text, or one without words, has an empty set and is linked with nothing. Rows with equal
id and text are one document. The smallest id of a component names it; null ids come after all others.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.components import components
from tillstream.llm.rows import KEY, dropped, keyed, only_keys, stored, with_results
from tillstream.llm.text import list_column, mix, text_shingles

SLOTS = 160
BANDS = 32
WORDS = 5
#: Longs of a sketch.
SKETCH = 16
#: Similarity in percent.
LIMIT = 80


@cache
def _orders(slots: int) -> np.ndarray:
    """For each slot, the order in which it looks for a filled bin."""
    draw = np.random.default_rng(20)
    return np.stack([draw.permutation(slots) for _ in range(slots)]).astype(np.int16)


@cache
def _edges(slots: int) -> np.ndarray:
    return np.array([(s << 64) // slots for s in range(slots)], np.uint64)


def slots(shingle_set: np.ndarray, count: int) -> np.ndarray:
    """The values of all slots of a sorted, non-empty set of hashes."""
    at = np.searchsorted(shingle_set, _edges(count))
    filled = at < np.append(at[1:], len(shingle_set))
    values = shingle_set[np.minimum(at, len(shingle_set) - 1)]
    if not filled.all():
        orders = _orders(count)[~filled]
        values = values.copy()
        values[~filled] = values[orders[np.arange(len(orders)), filled[orders].argmax(1)]]
    return values


def bands(shingle_set: np.ndarray) -> np.ndarray:
    """The band keys of a sorted, non-empty set of hashes."""
    rows = slots(shingle_set, SLOTS).reshape(BANDS, -1)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in rows.T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def signatures(rows: DataFrame, words: int) -> DataFrame:
    """(key, id, n, node_a, node_b, keys): set size, the 128-bit name of the set, and its band keys."""
    schema = T.StructType([
        *(rows.schema[c] for c in (*KEY, "id")), *(T.StructField(c, T.LongType()) for c in ("n", "node_a", "node_b")),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ])

    def run(batches):
        for batch in batches:
            sizes, names, keys = [], [], []
            for _, values in text_shingles(batch.column(3), words):
                found = np.unique(mix(values))
                sizes.append(len(found))
                total = np.bitwise_xor.reduce(mix(found ^ np.uint64(1))) if len(found) else np.uint64(0)
                names.append((found.sum() if len(found) else np.uint64(0), total))
                keys.append(_signed(bands(found)) if len(found) else np.zeros(0, np.int64))
            a, b = np.array(names, np.uint64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.array(sizes, np.int64)), pa.array(_signed(np.ascontiguousarray(a))),
                 pa.array(_signed(np.ascontiguousarray(b))), list_column(keys, pa.int64())],
                schema.names,
            )

    return rows.select(*KEY, "id", "text").mapInArrow(run, schema)


def sketch(shingle_set: np.ndarray) -> np.ndarray:
    """For each part of the hash range one bit: whether an odd number of the set's hashes lie in it."""
    part = (shingle_set % np.uint64(64 * SKETCH)).astype(np.int64)
    odd = np.bincount(part, minlength=64 * SKETCH) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def shingle_sets(rows: DataFrame, words: int) -> DataFrame:
    """(node, shingles, sketch): the full set of every row of (node, text), as hashes."""
    def run(batches):
        for batch in batches:
            found = [np.unique(mix(values)) for _, values in text_shingles(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), list_column([_signed(s) for s in found], pa.int64()),
                 list_column([sketch(s) for s in found], pa.int64())],
                ["node", "shingles", "sketch"],
            )

    return rows.select("node", "text").mapInArrow(run, "node struct<a:long,b:long>, shingles array<long>, sketch array<long>")


def _bits(name: str) -> list[str]:
    return [f"{name}{k}" for k in range(SKETCH)]


def _centres(open_: DataFrame, count: int) -> DataFrame:
    """(bucket, centre): the next centres of each bucket, from members that have not been one."""
    order = "over (partition by bucket order by size, weight desc, xxhash64(node), node)"
    return open_.where(~F.col("used")).withColumn("rank", F.expr(f"row_number() {order}")).where(
        F.col("rank") <= count
    ).select("bucket", F.col("node").alias("centre"), F.col("n").alias("centre_n"), F.col("root").alias("centre_root"),
        *(F.col(mine).alias(theirs) for mine, theirs in zip(_bits("s"), _bits("c")) if mine in open_.columns),
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v): the pairs whose full sets are similar."""
    wanted = pairs.select(F.col("u").alias("node")).unionAll(pairs.select(F.col("v").alias("node"))).distinct()
    near = only_keys(sets, wanted, ["node"])
    left = near.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = near.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    links = pairs.join(left, "u").join(right, "v").select(
        "u", "v", shared.alias("both"), (F.size("a") + F.size("b") - shared).alias("all")
    ).where(100 * F.col("both") >= LIMIT * F.col("all")).select("u", "v")
    return stored(links, "similar")


def _union(tables: list[DataFrame]) -> DataFrame:
    every = tables[0]
    for more in tables[1:]:
        every = every.unionAll(more)
    return every


def _linked(buckets: DataFrame, sets: DataFrame) -> DataFrame | None:
    """(node, root) of all nodes that are linked with others; none if there are no links."""
    # A member of many full buckets is near many others, and so makes the better centre.
    full = buckets.groupBy("bucket").agg(F.count("*").alias("weight"))
    weights = buckets.join(full, "bucket").groupBy("node").agg(F.sum("weight").alias("weight"))
    state = buckets.join(weights, "node").withColumn("used", F.lit(False))
    roots, links, tried, count, old = None, [], [], 1, []
    while True:
        if roots is None:
            known = state.withColumns({"root": F.col("node"), "size": F.lit(1).cast("long")})
        else:
            placed = roots.join(roots.groupBy("root").agg(F.count("*").alias("size")), "root")
            known = state.join(placed, "node", "left").withColumns({
                "root": F.coalesce("root", "node"), "size": F.coalesce("size", F.lit(1).cast("long")),
            })
        # A bucket stays open while its members that were no centres are in more than one component.
        apart = known.where(~F.col("used")).groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where(
            F.col("x") != F.col("y")
        ).select("bucket")
        open_ = stored(known.join(apart, "bucket", "left_semi"), "open")
        for table in old:
            dropped(table)
        if not open_.head(1):
            for table in (open_, *links, *tried):
                dropped(table)
            return roots
        centres = stored(_centres(open_, count), "centres")
        fits = 100 * F.least("n", "centre_n") >= LIMIT * F.greatest("n", "centre_n")
        if count > 1:
            # Sets of the similarity differ in at most so many shingles, and their sketches in no more bits.
            differ = sum(F.bit_count(F.col(a).bitwiseXOR(F.col(b))).cast("long") for a, b in zip(_bits("s"), _bits("c")))
            fits &= (100 + LIMIT) * differ <= (100 - LIMIT) * (F.col("n") + F.col("centre_n"))
        pairs = open_.join(centres, "bucket").where(
            (F.col("root") != F.col("centre_root")) & fits
        ).select(F.least("node", "centre").alias("u"), F.greatest("node", "centre").alias("v")).distinct()
        if tried:
            pairs = pairs.join(_union(tried), ["u", "v"], "left_anti")
        tried.append(stored(pairs, "pairs"))
        if tried[-1].head(1):
            links.append(_verified(tried[-1], sets))
            if links[-1].head(1):
                previous, roots = roots, components(_union(links))
                if previous is not None:
                    dropped(previous)
        now = centres.select("bucket", F.col("centre").alias("node"), F.lit(True).alias("now"))
        bits = _bits("s") if count > 1 else []
        state = open_.join(now, ["bucket", "node"], "left").select(
            "bucket", "node", "n", "weight", *bits, (F.col("used") | F.coalesce("now", F.lit(False))).alias("used")
        )
        if count == 1:
            drawn = sets.select("node", *(F.col("sketch")[k].alias(s) for k, s in enumerate(_bits("s"))))
            state = state.join(drawn, "node")
        old = [open_, centres]
        count *= 16


RESULTS = ["n_shingles", "component_id", "kept"]


def _grouped(rows: DataFrame, words: int) -> DataFrame:
    """(key, id, n, group) of every row: its set's size and its component."""
    signed = stored(signatures(rows, words), "signatures").withColumn("node", F.struct(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    banded = signed.where("n > 0").select("node", "n", F.explode("keys").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("x"), F.max("node").alias("y")).where(
        F.col("x") != F.col("y")
    ).select("bucket")
    members = stored(
        banded.join(shared, "bucket", "left_semi").groupBy("bucket", "node").agg(F.max("n").alias("n")), "members"
    )
    holders = signed.join(members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.min(F.struct(*KEY)).alias("key")
    )
    holders = stored(holders.select("node", "key.*"), "holders")
    count = holders.count()
    texts = rows.select(*KEY, "text")
    small = F.broadcast(holders) if count <= 400_000 else holders
    sets = stored(shingle_sets(texts.join(small, KEY).dropDuplicates(["node"]), words), "full-sets")
    roots = _linked(members, sets)
    for table in (members, holders, sets):
        dropped(table)

    placed = signed.select(*KEY, "id", "n", "node")
    if roots is not None:
        placed = placed.join(roots, "node", "left").withColumn("node", F.coalesce("root", "node"))
    # An empty set is a group of its own for each document.
    group = F.struct("node", *(F.when(F.col("n") == 0, F.col(k)).otherwise(F.lit(0)).alias(k) for k in KEY))
    return placed.select(*KEY, "id", "n", group.alias("group"))


def near_duplicates(
    docs: DataFrame, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The table with set size, component (its smallest id) and whether the document names its component."""
    rows = keyed(docs, id_column, text_column)
    placed = _grouped(rows, words)
    named = placed.groupBy("group").agg(F.min("id").alias("component_id"))
    placed = placed.join(named, "group").select(
        *KEY, F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    ).distinct()
    return with_results(rows.select(*KEY, "row").join(placed, KEY), docs, RESULTS)


def one_of_each(docs: DataFrame, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component: that of its smallest id, null ids last; of rows equal in id and text, the smallest."""
    rows = keyed(docs, id_column, text_column)
    counted = _grouped(rows, words).groupBy("group", *KEY).agg(F.min("id").alias("id"), F.count("*").alias("rows"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", *KEY, "rows")
    kept = stored(counted.groupBy("group").agg(F.min(order).alias("first")).select(*(F.col("first")[k].alias(k) for k in (*KEY, "rows"))), "kept")
    once = only_keys(rows, kept.where("rows = 1").select(*KEY), KEY).select("row")
    again = kept.where("rows > 1").select(*KEY)
    if again.head(1):
        once = once.unionAll(only_keys(rows, again, KEY).groupBy(*KEY).agg(F.min("row").alias("row")).select("row"))
    return once.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
