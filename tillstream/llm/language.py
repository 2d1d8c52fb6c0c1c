"""Language of a text: nearest centroid among normalised TF-IDF vectors of character n-grams.

A text becomes the counts of its n-grams of one to three characters, hashed to `DIMS` places: letters
only, in lower case, other characters taken as one blank between words. Counts are damped by a
logarithm, weighted by how few training texts have them (counted over all training texts), and the vector
is scaled to length one. Each language has several centroids, clustered on a bounded sample of its training
texts. A text takes the language of the centroid with the largest cosine. It is rejected when it is further from
that centroid than the language's bound: its cosine is below `SHARE` of the smallest that a training text of the
language has with its own centroid.

A text that is null, empty or without letters is `und`, scores 0 and is rejected. If nothing can be learned, every
text is. A language is any non-null value of the label column with a text that has letters. Ties go to
the language that sorts first. Rows with equal ids or texts are judged alike, each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.rows import hash_pair, with_results
from tillstream.llm.text import char_table, code_points

DIMS = 4096
UNKNOWN = "und"
#: Training texts of a language that its centroids are clustered on.
SAMPLE = 400
CENTROIDS = 4
ROUNDS = 8
SHARE = 0.5
#: Characters that are counted at a time.
CHUNK = 1 << 19
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@dataclass(frozen=True)
class Model:
    """Weights of the places, and for each centroid its language, vector and smallest accepted cosine."""

    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    bounds: np.ndarray


def _places(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text's number, place) of all n-grams of some texts."""
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    chars = code_points(texts)
    owner = np.repeat(np.arange(len(texts)), lengths)
    letter = char_table("isalpha")[chars]
    first = np.ones(len(chars), bool)
    first[1:] = owner[1:] != owner[:-1]
    after = np.zeros(len(chars), bool)
    after[1:] = letter[:-1] & ~first[1:]
    kept = letter | after
    c, owner = np.where(letter, chars, np.uint32(32))[kept], owner[kept]
    for size in (1, 2, 3):
        n = len(c) - size + 1
        if n <= 0:
            return
        h = np.full(n, size, np.uint32)
        for j in range(size):
            h = (h ^ c[j : j + n]) * _FACTORS[j]
            h ^= h >> np.uint32(15)
        same = owner[:n] == owner[size - 1 :]
        yield owner[:n][same], (h[same] >> np.uint32(20)).astype(np.int64)


def _counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts of some rows' n-grams by place); a text longer than a chunk is summed in pieces."""
    rows, texts, size, first = [], [], 0, 0

    def done():
        table = np.zeros((len(rows), DIMS), np.float32)
        for owner, place in _places(texts):
            table += np.bincount(owner * DIMS + place, minlength=len(rows) * DIMS).reshape(-1, DIMS)
        return first, table

    for k, value in enumerate(column):
        text = (value.as_py() or "").lower()
        if len(text) > CHUNK:
            if rows:
                yield done()
            total = np.zeros((1, DIMS), np.float32)
            for at in range(0, len(text), CHUNK):
                # Two characters of the next piece, so that the n-grams across the border count once.
                piece, tail = text[at : at + CHUNK + 2], text[at + CHUNK : at + CHUNK + 2]
                for sign, part in ((1, piece), (-1, tail if at + CHUNK < len(text) else "")):
                    for _, place in _places([part]):
                        total[0] += sign * np.bincount(place, minlength=DIMS)
            yield k, np.maximum(total, 0)
            rows, texts, size, first = [], [], 0, k + 1
            continue
        rows.append(k)
        texts.append(text)
        size += len(text)
        if size > CHUNK or len(rows) >= 500:
            yield done()
            rows, texts, size, first = [], [], 0, k + 1
    if rows:
        yield done()


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of the task have each place; place -1 counts the texts."""
    total = np.zeros(DIMS + 1, np.int64)
    for batch in batches:
        for _, counts in _counts(batch.column(0)):
            total[1:] += (counts > 0).sum(0)
            total[0] += int((counts.sum(1) > 0).sum())
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMS)), pa.array(total)], ["place", "texts"])


def _clustered(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means, started from the vectors that are furthest from those chosen before: (centroids, bounds)."""
    near = vectors @ vectors.mean(0)
    chosen = [int(near.argmax())]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(ROUNDS):
        owner = (vectors @ centroids.T).argmax(1)
        sums = np.stack([vectors[owner == j].sum(0) if (owner == j).any() else c for j, c in enumerate(centroids)])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    cosines = vectors @ centroids.T
    return centroids, np.full(len(centroids), SHARE * cosines.max(1).min())


def fit(training: DataFrame, text_column: str = "text", label_column: str = "lang") -> Model:
    """Learn from all rows with a label.

    The document counts cover every training text. The centroids are clustered on `SAMPLE` texts of each language, those
    with the smallest hashes of text, so the choice does not depend on the order of rows.
    What the driver holds is bounded by the number of languages.
    """
    rows = training.where(F.col(label_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(text_column).alias("text"), F.col(label_column).cast("string").alias("lang")
    )
    seen = rows.select("text").mapInArrow(_document_counts, "place long, texts long")
    texts = {r[0]: r[1] for r in seen.groupBy("place").agg(F.sum("texts")).collect()}
    found = np.array([texts.get(p, 0) for p in range(DIMS)], float)
    idf = np.log((1 + texts.get(-1, 0)) / (1 + found)).astype(np.float32) + np.float32(0.1)

    a, b = hash_pair("text")
    order = F.struct("a", "b")
    ranked = rows.select("lang", a.alias("a"), b.alias("b")).distinct().withColumn(
        "rank", F.expr("row_number() over (partition by lang order by a, b)")
    )
    chosen = ranked.where(F.col("rank") <= SAMPLE).select("lang", order.alias("at"))
    sample = rows.withColumn("at", F.struct(*[c.alias(n) for c, n in zip(hash_pair("text"), "ab")])).join(
        F.broadcast(chosen), ["lang", "at"], "left_semi"
    ).select("lang", "text")

    def centroids(key: tuple, group: pa.Table) -> pa.Table:
        texts_of = group.column("text").combine_chunks().unique().sort()
        counts = np.concatenate([c for _, c in _counts(texts_of)])
        counts = counts[counts.sum(1) > 0]
        if not len(counts):
            return pa.table({"lang": pa.array([], pa.string()), "centroid": pa.array([], pa.list_(pa.float32())), "bound": pa.array([], pa.float64())})
        found, bounds = _clustered(_vectors(counts, idf), CENTROIDS)
        return pa.table({
            "lang": pa.array([key[0].as_py()] * len(found), pa.string()),
            "centroid": pa.array(list(found), pa.list_(pa.float32())), "bound": pa.array(bounds.astype(float)),
        })

    learned = sample.groupBy("lang").applyInArrow(centroids, "lang string, centroid array<float>, bound double").toArrow()
    order_of = sorted(range(learned.num_rows), key=lambda i: (learned["lang"][i].as_py(), i))
    vectors = [np.array(learned["centroid"][i].as_py(), np.float32) for i in order_of]
    return Model(
        idf, [learned["lang"][i].as_py() for i in order_of],
        np.stack(vectors) if vectors else np.zeros((0, DIMS), np.float32),
        np.array([learned["bound"][i].as_py() for i in order_of]),
    )


RESULTS = T.StructType([
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("rejected", T.BooleanType()),
])


def predict(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The table with `lang_pred`, `score` (the cosine) and `rejected`, for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    wide = docs.select(F.col(text_column).alias("text"), F.struct("*").alias("row"))
    schema = T.StructType([wide.schema["row"], *RESULTS])

    def run(batches):
        m = sent.value
        names = np.array([*m.languages, UNKNOWN], object)
        for batch in batches:
            n = batch.num_rows
            best, score, out = np.full(n, len(m.languages)), np.zeros(n), np.ones(n, bool)
            for first, counts in _counts(batch.column(0)) if m.languages else ():
                cosines = _vectors(counts, m.idf) @ m.centroids.T
                at, some = cosines.argmax(1), counts.sum(1) > 0
                here, top = slice(first, first + len(counts)), cosines.max(1)
                best[here] = np.where(some, at, len(m.languages))
                score[here] = np.where(some, np.clip(top, 0, 1), 0)
                out[here] = ~some | (top < m.bounds[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(names[best], pa.string()), pa.array(score), pa.array(out)], schema.names
            )

    judged = wide.mapInArrow(run, schema)
    return with_results(judged, docs, RESULTS.names)


def held_out(id_column: str = "doc_id") -> Column:
    """A third of the ids, by their checksum; rows without an id are never learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(True))
