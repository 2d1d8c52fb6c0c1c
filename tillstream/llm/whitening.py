"""Whitening of embeddings over their distinct vectors.

Components are scaled and rounded down to integers `x`, and rows with the same x vector are one entry of the fit
list, with weight one or with as many as it has rows. Sums are whole numbers and exact; the covariance is a weighted product
of centred blocks, summed over tasks. Its eigenvectors are found on the driver, which holds one number per pair of dimensions
and nothing that grows with the rows. Every distinct vector is whitened once, and the result is joined back to the rows.

Vectors that are null, empty, or hold null or non-finite entries take no part. Vectors of each length are a table of their own.
Rows with a null or repeated id are rows like any other. A component without spread (an eigenvalue of zero up to rounding, as
with one distinct vector) has null for its whitened values; its share is zero, or null if nothing has spread. An empty
table gives no rows. Copies of a vector that fill much of a table are counted before the shuffle, and
are joined back by a broadcast, which lists at most `rows.HOT_KEYS` vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.rows import KEY, dropped, hash_pair, join_counted, stored

SCALE = 256
COMPONENTS = 4
WEIGHTS = ("one", "counts")
#: Eigenvalues up to this share of the trace are rounding.
NO_SPREAD = 1e-12


@dataclass
class Fit:
    """What whitening needs to know of the vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray = None
    vectors: np.ndarray = None
    trace: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def explained(self) -> list[float | None]:
        return [float(e / self.trace) if self.trace > 0 else None for e in self.values]


def usable(vector: Column) -> Column:
    """Whether a vector can take part."""
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def scaled(table: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """(id, x, key): the rows that take part."""
    rows = table.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    rows = rows.where(usable(F.col("v"))).select("id", x.alias("x"))
    a, b = hash_pair("x")
    return rows.withColumns({KEY[0]: a, KEY[1]: b})


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Every x vector once, with its key, its length `dims` and its number of rows, `copies`; stored."""
    grouped = rows.groupBy(*KEY, "x").agg(F.count("*").alias("copies"))
    return stored(grouped.withColumn("dims", F.size("x")), "vectors")


def _blocks(batch: pa.RecordBatch, weights: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, row numbers, x, weights) of a batch's vectors by length."""
    dims = batch["dims"].to_numpy()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        x = batch["x"].take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)
        w = batch["copies"].to_numpy()[at] if weights == "counts" else np.ones(len(at), np.int64)
        yield int(d), at, x, w


def _exact_product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y in whole numbers of any size."""
    most = int(np.abs(x).max(initial=0).item()) * max((abs(int(v)) for v in y.ravel()), default=0) * x.shape[1]
    if most < 1 << 62 and int(x.min(initial=0)) > -(1 << 62):
        return (x @ y.astype(np.int64)).astype(object)
    return x.astype(object) @ y.astype(object)


def _sums(weights: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for d, _, x, w in _blocks(batch, weights):
                n, s = found.get(d, (0, np.zeros(d, object)))
                found[d] = n + int(w.sum()), s + _exact_product(x.T, w)
        for d, (n, s) in found.items():
            yield pa.RecordBatch.from_pydict({
                "dims": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()),
                "n": pa.array([n] * d, pa.int64()), "s": pa.array([str(v) for v in s]),
            })

    return run


def _products(fits: dict[int, tuple[int, list[int]]], weights: str) -> Callable:
    """Each task's sum of weighted products of centred vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means = {d: np.array([s / n for s in sums]) for d, (n, sums) in fits.items()}
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x, w in _blocks(batch, weights):
                centred = x - means[d]
                product = centred.T @ (centred * w[:, None])
                found[d] = found[d] + product if d in found else product
        part = TaskContext.get().partitionId()
        for d, c in found.items():
            yield pa.RecordBatch.from_pydict({
                "dims": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()),
                "part": pa.array([part] * d, pa.int32()), "c": pa.array(list(c), pa.list_(pa.float64())),
            })

    return run


def _added(table: pa.Table) -> pa.Table:
    """One row of the matrix from the tasks' parts, always added in the same order."""
    table = table.sort_by("part")
    total = np.sum([np.array(c) for c in table["c"].to_pylist()], axis=0)
    return pa.table({"dims": table["dims"][:1], "i": table["i"][:1], "c": pa.array([total], pa.list_(pa.float64()))})


def fit(vectors: DataFrame, components: int = COMPONENTS, weights: str = "one") -> dict[int, Fit]:
    """By length: sums, and the leading eigenvalues and unit eigenvectors of the covariance (divisor n)."""
    if weights not in WEIGHTS:
        raise ValueError(f"weights: {weights!r}")
    sums = vectors.select("dims", "x", "copies").mapInArrow(_sums(weights), "dims int, i int, n long, s string")
    sums = sums.groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    fits: dict[int, Fit] = {}
    for row in sums.orderBy("dims", "i").collect():
        fits.setdefault(row["dims"], Fit(row["n"], [])).sums.append(int(row["s"]))
    means = {d: (f.n, f.sums) for d, f in fits.items()}
    parts = vectors.select("dims", "x", "copies").mapInArrow(_products(means, weights), "dims int, i int, part int, c array<double>")
    matrix = parts.groupBy("dims", "i").applyInArrow(_added, "dims int, i int, c array<double>").orderBy("dims", "i")
    rows: dict[int, list] = {}
    for row in matrix.collect():
        rows.setdefault(row["dims"], []).append(row["c"])
    for d, found in rows.items():
        covariance = np.array(found) / fits[d].n
        values, own = np.linalg.eigh((covariance + covariance.T) / 2)
        values, own = values[::-1][:components], own[:, ::-1][:, :components]
        # Of the two signs the one whose largest entry is positive.
        own = own * np.sign(own[np.abs(own).argmax(axis=0), np.arange(own.shape[1])])
        fits[d].trace = float(np.trace(covariance))
        fits[d].values, fits[d].vectors = np.maximum(values, 0), own
    return fits


def _whitener(fits: dict[int, Fit]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation, white = [None] * batch.num_rows, [None] * batch.num_rows
            for d, at, x, _ in _blocks(batch, "one"):
                f, sums = fits[d], np.array(fits[d].sums, object)
                spread = f.values > NO_SPREAD * f.trace
                w = ((x - f.mean) @ f.vectors) / np.sqrt(np.where(spread, f.values, 1))
                squares = np.array([int(v) for v in _row_squares(x)], object)
                far = f.n * f.n * squares - 2 * f.n * _exact_product(x, sums) + int((sums * sums).sum())
                for k, row in enumerate(at):
                    deviation[row] = str(far[k])
                    white[row] = [float(v) if ok else None for v, ok in zip(w[k], spread)]
            yield pa.RecordBatch.from_pydict({
                KEY[0]: batch[KEY[0]], KEY[1]: batch[KEY[1]], "dims": batch["dims"], "copies": batch["copies"],
                "deviation": pa.array(deviation, pa.string()), "whitened": pa.array(white, pa.list_(pa.float64())),
            })

    return run


def _row_squares(x: np.ndarray) -> np.ndarray:
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    return (x * x).sum(axis=1) if most * most * x.shape[1] < 1 << 62 else (x.astype(object) ** 2).sum(axis=1)


def identity_errors(whitened: DataFrame, fits: dict[int, Fit], weights: str) -> dict[int, float | None]:
    """By length: how far the covariance of the whitened values is from the identity, measured on them."""
    weight = F.col("copies") if weights == "counts" else F.lit(1)
    most = max((len(f.values) for f in fits.values()), default=0)
    parts = [F.get("whitened", F.lit(i)).alias(f"w{i}") for i in range(most)]
    values = whitened.select("dims", weight.cast("double").alias("weight"), *parts)
    means = values.groupBy("dims").agg(
        F.sum("weight").alias("total"), *[(F.sum(F.col(f"w{i}") * F.col("weight")) / F.sum("weight")).alias(f"m{i}") for i in range(most)]
    )
    centred = values.join(F.broadcast(means), "dims").select("dims", "weight", *[(F.col(f"w{i}") - F.col(f"m{i}")).alias(f"w{i}") for i in range(most)])
    pairs = [(i, j) for i in range(most) for j in range(i, most)]
    if not pairs:
        return {}
    found = centred.groupBy("dims").agg(*[
        (F.sum(F.col(f"w{i}") * F.col(f"w{j}") * F.col("weight")) / F.sum("weight")).alias(f"c{i}_{j}") for i, j in pairs
    ])
    errors = {}
    for row in found.collect():
        seen = [abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs if row[f"c{i}_{j}"] is not None]
        errors[row["dims"]] = max(seen, default=None)
    return errors


def whiten(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS,
    weights: str = "one", scale: int = SCALE,
) -> DataFrame:
    """For each row that takes part and each component: `id`, `component` from 1, `n`, `deviation`, `whitened`, `explained`, `identity_error`.

    `deviation` is the sum over dimensions of (n x - S) squared, an exact decimal of 38 digits (null beyond that).
    """
    spark = table.sparkSession
    rows = scaled(table, id_column, vector_column, scale)
    vectors = distinct_vectors(rows)
    fits = fit(vectors, components, weights)
    white = stored(
        vectors.mapInArrow(_whitener(fits), "key_a long, key_b long, dims int, copies long, deviation string, whitened array<double>")
        .withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)")),
        "whitened",
    )
    dropped(vectors)
    errors = identity_errors(white, fits, weights)
    facts = spark.createDataFrame(
        [(d, f.n, f.explained(), errors.get(d)) for d, f in fits.items()],
        "dims int, n long, explained array<double>, identity_error double",
    )
    total = white.agg(F.sum("copies")).first()[0] or 0
    joined = join_counted(rows.drop("x"), white, KEY, "copies", total).join(F.broadcast(facts), "dims")
    each = joined.select("id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of"))
    return each.select(
        "id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error",
    )
