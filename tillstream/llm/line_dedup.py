"""Line dedup: windows of three lines that occur again lose their later occurrences.

A text is split at line feeds. Every three consecutive lines are a window, so windows overlap. Among
equal windows of the whole table the first stays, in the order of document id (null first), then
of the text's hash, then of the position. The lines of every other occurrence are removed, and what overlapping
windows cover is removed once. Windows are judged on the input, not on what is left.

Only DataFrame expressions are used. Lines and windows are compared by 128-bit hashes.

A null text stays null; a text with fewer than three lines has no window and stays as it is. Rows equal in id and
text are one document given twice: each gets the same result, and neither counts as a repetition of the other.
A hot window sends one row per task to its first occurrence and then joins as a skewed key, which adaptive execution
splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.rows import KEY, hash_pair, keyed, with_results

WINDOW = 3


def _windows(lines: Column, seed: int) -> Column:
    """A 64-bit hash of every window of an array of line hashes."""
    return F.transform(
        F.sequence(F.lit(1), F.size(lines) - (WINDOW - 1)),
        lambda i: F.xxhash64(F.lit(seed), *(F.get(lines, i + (j - 1)) for j in range(WINDOW))),
    )


def repeated_positions(rows: DataFrame) -> DataFrame:
    """(key, pos): windows that occur earlier, from rows with key, id and text."""
    lines = F.split("text", "\n", -1)
    hashed = rows.select(
        *KEY, "id",
        F.transform(lines, lambda x: F.xxhash64(F.lit(7), x)).alias("a"),
        F.transform(lines, lambda x: F.xxhash64(F.lit(8), x)).alias("b"),
    ).where(F.size("a") >= WINDOW)
    windows = hashed.select(
        *KEY, "id", F.posexplode(F.arrays_zip(_windows(F.col("a"), 9).alias("a"), _windows(F.col("b"), 10).alias("b")))
    ).select(*KEY, "id", F.col("pos").cast("int").alias("pos"), F.col("col.a").alias("a"), F.col("col.b").alias("b"))
    place = F.struct("id", *KEY, "pos")
    first = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(
        ~F.col("first").eqNullSafe(F.col("last"))
    ).select("a", "b", "first")
    return windows.join(first, ["a", "b"]).where(~place.eqNullSafe(F.col("first"))).select(*KEY, "pos").distinct()


def covered(positions: DataFrame) -> DataFrame:
    """(key, spans): the lines that the windows cover, as merged runs (first line, line after the last) in order."""
    order = "over (partition by key_a, key_b order by pos)"
    runs = positions.withColumn(
        "new", F.expr(f"pos > coalesce(lag(pos) {order} + {WINDOW}, -1)")
    ).withColumn("run", F.expr(f"sum(cast(new as int)) {order}"))
    spans = runs.groupBy(*KEY, "run").agg(F.min("pos").alias("start"), (F.max("pos") + WINDOW).alias("end"))
    return spans.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _kept(lines: Column, spans: Column) -> Column:
    """The lines between the spans."""
    last = F.get(spans, F.size(spans) - 1)
    between = F.transform(
        spans,
        lambda s, i: F.slice(
            lines, F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["end"]) + 1,
            s["start"] - F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["end"]),
        ),
    )
    rest = F.slice(lines, last["end"] + 1, F.size(lines))
    return F.concat(F.flatten(between), rest)


RESULTS = ["text", "n_lines", "n_removed", "n_spans"]


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The table with repeated lines taken out of its text, and the counts `n_lines`, `n_removed` and `n_spans`."""
    rows = keyed(docs, id_column, text_column)
    spans = covered(repeated_positions(rows))
    lines = F.split("text", "\n", -1)
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + (s["end"] - s["start"]))
    results = [text_column, *RESULTS[1:]]
    joined = rows.join(spans, KEY, "left").select(
        "row",
        F.when(F.col("spans").isNull(), F.col("text")).otherwise(
            F.array_join(_kept(lines, F.col("spans")), "\n")
        ).alias(text_column),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
    )
    return with_results(joined, docs, results)
