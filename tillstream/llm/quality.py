"""Quality by co-training: a classifier of texts and one of page metadata teach each other.

The text view has the presence of hashed words and word beginnings, and measures of form (length, shares of capitals, signs and repeated
words). The metadata view has source, language and length. Both are logistic regressions on features weighted by
their log-odds. In each round, each view labels the pool of unlabelled documents, and those it is sure of join the
other view's training set. In the end each view is calibrated on labelled documents that neither was trained on, the
calibrated views are combined by a third regression there, and every document is scored. The same is done for
toxicity. A document is kept if it is more likely good than not, and less likely toxic than not.

The fit uses bounded samples: `LABELLED` labelled documents and `POOL` others, those with the smallest hashes of id.
Scoring reads every document, whole, and needs no shuffle.

A null text counts as empty, null metadata as a value of its own. Labels that are null, or whose document is not there, are
not used; several labels of one document are averaged. If all labels agree, or there is none, every
document gets that label's share (one half for none). Repeated rows get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.rows import with_results
from tillstream.llm.text import binary, chunks, lowered, mix, prefix_sums, span_hash, words

LABELLED = 8000
POOL = 8000
ROUNDS = 3
#: A pseudo-label needs this calibrated probability, and odds that differ from those of all labels by this factor.
SURE = 0.95
CLEARER = 10.0
#: Of five labelled documents, one is kept for calibration.
FOLDS = 5
WORD_PLACES = 1 << 16
#: Words count by their first so many bytes, too.
STEMS = (4, 6)
META_PLACES = 1 << 12
META = ["source", "lang", "n_chars"]
FORMS = 12

_byte = np.arange(256)
_ALNUM = (_byte >= 128) | np.array([chr(b).isalnum() for b in _byte])
_CLASSES = [
    (_byte >= 65) & (_byte <= 90),
    (_byte >= 48) & (_byte <= 57),
    np.isin(_byte, list(b".,;:'\"-()")),
    np.isin(_byte, list(b"!?")),
    np.isin(_byte, list(b"#$%&*+/<=>@[\\]^_`{|}~")),
    _byte == 10,
    _byte >= 128,
]


@dataclass
class View:
    """Rows of features: hashed places that are present, and measures."""

    places: int
    begins: np.ndarray
    present: np.ndarray
    forms: np.ndarray

    def __len__(self) -> int:
        return len(self.begins) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.begins))

    def take(self, chosen: np.ndarray) -> View:
        parts = [self.present[self.begins[i] : self.begins[i + 1]] for i in chosen]
        begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return View(self.places, begins, np.concatenate([*parts, np.zeros(0, np.int64)]), self.forms[chosen])


def text_view(column: pa.Array) -> View:
    """The text features of a column."""
    begins, present, forms = [np.zeros(1, np.int64)], [], []
    total = 0
    for _, data, offsets in chunks(column):
        hashes, starts, ends, firsts = words(data, offsets, ~_ALNUM)
        count = np.diff(firsts)
        owner = np.repeat(np.arange(len(count)), count)
        sums, named = prefix_sums(lowered(data)), [(owner, hashes)]
        for size in STEMS:
            long = np.flatnonzero(ends - starts > size)
            stem = span_hash(sums, starts[long], starts[long] + size)
            named.append((owner[long], mix(stem + np.uint64(size))))
        unique = np.unique(np.concatenate([o * WORD_PLACES + (h >> np.uint64(48)).astype(np.int64) for o, h in named]))
        sizes = np.bincount(unique // WORD_PLACES, minlength=len(count))
        begins.append(total + np.cumsum(sizes))
        total += len(unique)
        present.append(unique % WORD_PLACES)
        length, word_count = np.maximum(np.diff(offsets), 1), np.maximum(count, 1)
        shares = []
        for kind in _CLASSES:
            sums = np.concatenate([[0], np.cumsum(kind[data])])
            shares.append((sums[offsets[1:]] - sums[offsets[:-1]]) / length)
        again = np.zeros(len(hashes))
        again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        letters = np.bincount(owner, ends - starts, len(count))
        forms.append(np.column_stack([
            *shares, np.log1p(np.diff(offsets)), np.log1p(count), sizes / word_count / (1 + len(STEMS)),
            np.bincount(owner, again, len(count)) / word_count, letters / word_count,
        ]))
    empty = np.zeros((0, FORMS))
    return View(
        WORD_PLACES, np.concatenate(begins), np.concatenate([*present, np.zeros(0, np.int64)]),
        np.concatenate([*forms, empty]),
    )


def meta_view(column: pa.Array) -> View:
    """The features of a column of metadata texts, which hold one value in each line."""
    hashes, _, _, firsts = words(*next(((d, o) for _, d, o in chunks(column, 1 << 40)), (np.zeros(0, np.uint8), np.zeros(1, np.int64))))
    place = (hashes >> np.uint64(64 - 12)).astype(np.int64)
    return View(META_PLACES, firsts.astype(np.int64), place, np.zeros((len(firsts) - 1, 0)))


@dataclass
class Line:
    """A linear classifier of a view: weights of places and measures, and the line that calibrates it."""

    places: np.ndarray
    forms: np.ndarray
    middle: np.ndarray
    scale: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, view: View) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.places[view.present])])
        linear = ((view.forms - self.middle) / self.scale) @ self.forms
        return sums[view.begins[1:]] - sums[view.begins[:-1]] + linear

    def margin(self, view: View) -> np.ndarray:
        return self.slope * self.raw(view) + self.offset


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _descend(gradient, size: int, rounds: int, step: float) -> np.ndarray:
    """Accelerated gradient descent."""
    w, before = np.zeros(size), np.zeros(size)
    for k in range(rounds):
        ahead = w + k / (k + 3) * (w - before)
        before, w = w, ahead - step * gradient(ahead)
    return w


def _logistic(matrix: np.ndarray, y: np.ndarray, shrink: float = 1e-3) -> np.ndarray:
    """Weights of a small dense regression; the last is the constant."""
    x = np.column_stack([matrix, np.ones(len(matrix))])
    step = 1 / (0.25 * max(np.linalg.eigvalsh(x.T @ x / len(x))[-1], 1e-6) + shrink)
    return _descend(lambda w: x.T @ (sigmoid(x @ w) - y) / len(x) + shrink * w, x.shape[1], 400, step)


def fit_view(view: View, y: np.ndarray, shrink: float = 0.003) -> Line:
    """A regression on a view; present places count by their log-odds among the two kinds."""
    rows, n = view.rows(), len(view)
    good, bad = y.sum(), (1 - y).sum()
    seen_good = np.bincount(view.present, y[rows], view.places)
    seen = np.bincount(view.present, minlength=view.places)
    odds = np.log((seen_good + 1) / (good + 2)) - np.log((seen - seen_good + 1) / (bad + 2))
    middle = view.forms.mean(0) if n else np.zeros(view.forms.shape[1])
    scale = np.maximum(view.forms.std(0), 1e-6) if n else np.ones(view.forms.shape[1])
    dense = (view.forms - middle) / scale
    value = odds[view.present]
    k = dense.shape[1]

    def gradient(w: np.ndarray) -> np.ndarray:
        sums = np.bincount(rows, value * w[view.present], n)
        error = (sigmoid(sums + dense @ w[view.places : view.places + k] + w[-1]) - y) / n
        out = np.concatenate([np.bincount(view.present, value * error[rows], view.places), dense.T @ error, [error.sum()]])
        out[:-1] += shrink * w[:-1]
        return out

    largest = (np.bincount(rows, value**2, n) + (dense**2).sum(1) + 1).mean()
    w = _descend(gradient, view.places + k + 1, 120, 1 / (0.25 * largest + shrink))
    return Line(odds * w[: view.places], w[view.places : view.places + k], middle, scale, offset=float(w[-1]))


def _calibrated(line: Line, view: View, y: np.ndarray) -> Line:
    raw = line.raw(view)
    spread = max(float(np.std(raw)), 1e-6)
    slope, offset = _logistic((raw / spread)[:, None], y)
    line.slope, line.offset = max(float(slope), 0.0) / spread, float(offset)
    return line


@dataclass
class Scorer:
    """The two views' calibrated classifiers and how they are combined; or one share for all."""

    share: float
    text: Line | None = None
    meta: Line | None = None
    join: np.ndarray | None = None

    def scores(self, text: View, meta: View) -> list[np.ndarray]:
        """Probabilities by both views, by the text and by the metadata."""
        if self.text is None:
            return [np.full(len(text), self.share)] * 3
        margins = np.column_stack([self.text.margin(text), self.meta.margin(meta)])
        return [sigmoid(margins @ self.join[:2] + self.join[2]), *sigmoid(margins).T]


def co_train(text: View, meta: View, y: np.ndarray, fold: np.ndarray, pool_text: View, pool_meta: View) -> Scorer:
    """Fit both views on labelled rows outside the calibration fold, and on what they teach each other."""
    learn, check = np.flatnonzero(fold != 0), np.flatnonzero(fold == 0)
    for part in (learn, check):
        if len(part) == 0 or y[part].min() == y[part].max():
            learn = check = np.arange(len(y))
    if len(y) == 0 or y.min() == y.max():
        return Scorer(float(y[0]) if len(y) else 0.5)
    views, pools = [text, meta], [pool_text, pool_meta]
    taught = [np.full(len(pool_text), np.nan) for _ in views]
    lines = [None, None]
    base, gap, sure_at = np.log(y.mean() / (1 - y.mean())), np.log(CLEARER), np.log(SURE / (1 - SURE))
    for round_ in range(ROUNDS + 1):
        for v in (0, 1):
            sure = np.flatnonzero(~np.isnan(taught[v]))
            joined = _joined(views[v].take(learn), pools[v].take(sure))
            line = fit_view(joined, np.concatenate([y[learn], taught[v][sure]]))
            lines[v] = _calibrated(line, views[v].take(check), y[check])
        if round_ < ROUNDS:
            for v in (0, 1):
                z = lines[v].margin(pools[v])
                up, down = max(base + gap, sure_at), min(base - gap, -sure_at)
                taught[1 - v] = np.where(z >= up, 1.0, np.where(z <= down, 0.0, np.nan))
    margins = np.column_stack([line.margin(view.take(check)) for line, view in zip(lines, views)])
    return Scorer(float(y.mean()), *lines, _logistic(margins, y[check]))


def _joined(a: View, b: View) -> View:
    return View(
        a.places, np.concatenate([a.begins, a.begins[-1] + b.begins[1:]]), np.concatenate([a.present, b.present]),
        np.concatenate([a.forms, b.forms]),
    )


@dataclass
class Model:
    quality: Scorer
    toxic: Scorer


def _meta_text(docs: DataFrame) -> Column:
    """The metadata as a line for each value; its length is given by powers of the square root of two."""
    parts = []
    for name in META:
        if name == "n_chars":
            value = F.floor(2 * F.log2(F.greatest(F.col(name).cast("double"), F.lit(1.0)))).cast("string")
        else:
            value = F.regexp_replace(F.col(name).cast("string"), r"\s", "_")
        parts.append(F.concat(F.lit(f"{name}="), F.coalesce(value, F.lit("?"))))
    return F.concat_ws("\n", *parts)


def _one_of_each(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text, meta) of some ids, a bounded list; of the rows of an id the one with the smallest hash."""
    least = F.min_by(F.struct("text", "meta"), F.xxhash64("text", "meta")).alias("row")
    return rows.join(F.broadcast(ids), "id", "left_semi").groupBy("id").agg(least).select("id", "row.text", "row.meta")


def unlabelled_pool(rows: DataFrame, marked: DataFrame, size: int) -> DataFrame:
    """(id, text, meta) of the `size` ids with the smallest hashes among those without a label.

    A document with a label is never in it: it may be in the calibration fold, which no view may learn from.
    """
    ids = rows.where(F.col("id").isNotNull()).select("id").distinct().join(marked.select("id"), "id", "left_anti")
    return _one_of_each(rows, ids.orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(size))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Learn from the labels `quality` and `toxic` (0 or 1) of at most `LABELLED` documents, and from at most `POOL` without a label."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), _meta_text(docs).alias("meta"))
    marked = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(
        F.avg("quality").alias("quality"), F.avg("toxic").alias("toxic")
    )
    chosen = marked.orderBy(F.xxhash64("id"), "id").limit(LABELLED)
    sample = _one_of_each(rows, chosen.select("id")).join(F.broadcast(chosen), "id").select("id", "text", "meta", "quality", "toxic")
    none = F.lit(None).cast("double")
    pool = unlabelled_pool(rows, marked, POOL).select("id", "text", "meta", none.alias("quality"), none.alias("toxic"))
    schema = (
        "id string, fold int, quality double, toxic double, present array<int>, forms array<double>, meta array<int>"
    )
    found = sample.unionAll(pool).select(
        F.col("id").cast("string").alias("id"), F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(FOLDS)).cast("int").alias("fold"),
        "text", "meta", "quality", "toxic",
    ).mapInArrow(_features, schema).toArrow().sort_by([("id", "ascending"), ("quality", "ascending")])

    def columns(part: pa.Table) -> tuple[View, View]:
        lists = [part[c].combine_chunks() for c in ("present", "forms", "meta")]
        begins = [np.concatenate([[0], np.cumsum(x.value_lengths().to_numpy())]).astype(np.int64) for x in lists]
        flat = [x.flatten().to_numpy() for x in lists]
        return (
            View(WORD_PLACES, begins[0], flat[0].astype(np.int64), flat[1].reshape(-1, FORMS)),
            View(META_PLACES, begins[2], flat[2].astype(np.int64), np.zeros((part.num_rows, 0))),
        )

    import pyarrow.compute as pc

    unlabelled = pc.and_(pc.is_null(found["quality"]), pc.is_null(found["toxic"]))
    pool_views = columns(found.filter(unlabelled))
    scorers = []
    for target in ("quality", "toxic"):
        part = found.filter(pc.is_valid(found[target]))
        y = (part[target].to_numpy() >= 0.5).astype(float)
        scorers.append(co_train(*columns(part), y, part["fold"].to_numpy(), *pool_views))
    return Model(*scorers)


def _features(batches):
    for batch in batches:
        text, meta = text_view(batch.column(2)), meta_view(batch.column(3))

        def lists(begins: np.ndarray, flat: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(flat, kind))

        forms = np.arange(len(text) + 1) * FORMS
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), batch.column(4), batch.column(5),
                lists(text.begins, text.present, pa.int32()), lists(forms, text.forms.ravel(), pa.float64()),
                lists(meta.begins, meta.present, pa.int32()),
            ],
            ["id", "fold", "quality", "toxic", "present", "forms", "meta"],
        )


RESULTS = ["quality_score", "quality_by_text", "quality_by_meta", "toxic_score", "keep"]


def score(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The table with the scores and `keep`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    wide = docs.select(F.struct("*").alias("row"), F.col(text_column).alias("text"), _meta_text(docs).alias("meta"))
    schema = T.StructType([
        wide.schema["row"], *(T.StructField(c, T.DoubleType()) for c in RESULTS[:-1]),
        T.StructField(RESULTS[-1], T.BooleanType()),
    ])

    def run(batches):
        m = sent.value
        for batch in batches:
            text, meta = text_view(binary(batch.column(1))), meta_view(batch.column(2))
            good = m.quality.scores(text, meta)
            toxic = m.toxic.scores(text, meta)[0]
            keep = (good[0] >= 0.5) & (toxic < 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in (*good, toxic)), pa.array(keep)], schema.names
            )

    return with_results(wide.mapInArrow(run, schema), docs, RESULTS)
