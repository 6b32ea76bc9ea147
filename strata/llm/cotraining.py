"""Quality classifier by co-training of two views.

The content view sees the text: hashed byte trigrams and how often words repeat. The metadata
view sees what is known about the page: language, source, lengths and layout. Each view is a
logistic regression. Both start on labelled documents. In every round each view scores all other
documents of the table and labels those it is most sure of, and these train the other view.
Afterwards both views are calibrated on labelled documents kept apart, and their calibrated
log-odds, less the prior that both contain, are added up. That scores all documents.

Who is sure enough is decided over the whole table: a histogram of the log-odds of all open
documents gives, for each view and kind, the value that a twentieth of them pass, and of those
in its bucket as many as are wanted, by the hash of their id. Only the fits are done on bounded
samples of labelled rows: ``labelled`` documents with given labels, and ``exchanged`` documents
with exchanged labels a view, both chosen by the hash of the id. Their features, of one row per
id, are all that the driver gets. A score depends on the document and the model alone; every
whole document is read in each round and for the last score.

Cases: a null language or source is a value of its own; a null id has no label; null text is
empty. Documents without words are rejected with score 0. Labels that are null are ignored;
of conflicting labels of an id the lowest counts, of rows that repeat an id training sees one,
by the hash of the text. Without labels of both kinds nothing can be
learned, and every document with words is accepted with score 0.5. Rows that repeat an id are
scored each; columns named like the results are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.batches import bound_batches, parts
from strata.llm.words import WordReader, white_table
from strata.session import staged

# Documents with given labels, and with labels from the other view, that a view is fitted on at
# most, unless the caller says otherwise.
LABELLED, EXCHANGED = 6000, 6000
# Buckets of byte trigrams, of languages and of sources.
TRIGRAM_BITS, LANGUAGES, SOURCES = 10, 16, 32
TRIGRAMS = 1 << TRIGRAM_BITS
ROUNDS, SURE_SHARE, SURE = 3, 0.05, 0.95
# Buckets of the histograms of log-odds per unit, and the log-odds beyond which all are alike.
BUCKETS, MOST_ODDS = 64, 50
# Share of the labelled sample that calibrates; strength of the penalty; turns of the fit.
KEPT_APART, PENALTY, TURNS = 0.25, 1e-3, 120
ACCEPTED = 0.5
VIEWS = ("content", "layout")
CONTENT_STATS, LAYOUT_STATS = 4, 13
# Rows and columns of a matrix that are worked on at a time, which bounds what is copied.
ROWS, COLUMNS = 1024, 64


class Features:
    """Both views of the texts of a batch."""

    def __init__(self) -> None:
        self._reader, self._white = WordReader(), white_table()

    def trigrams(self, data: np.ndarray) -> np.ndarray:
        """Frequencies of hashed byte trigrams; all 0 for fewer than three bytes."""
        counts = np.zeros(TRIGRAMS, np.float32)
        for low in range(0, max(len(data) - 2, 0), 1 << 20):
            part = data[low : low + (1 << 20) + 2].astype(np.uint32)
            codes = part[:-2] | part[1:-1] << np.uint32(8) | part[2:] << np.uint32(16)
            buckets = (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - TRIGRAM_BITS)
            counts += np.bincount(buckets, minlength=TRIGRAMS)
        return counts / max(counts.sum(), 1)

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Content view, metadata view and number of words, a row per text."""
        n = batch.num_rows
        content = np.zeros((n, TRIGRAMS + CONTENT_STATS), np.float32)
        layout = np.zeros((n, LANGUAGES + SOURCES + LAYOUT_STATS), np.float32)
        counts = np.zeros(n, np.int64)
        for words in self._reader.read(batch.column("text")):
            offsets = words.offsets
            for i in range(words.last - words.first):
                low, high = offsets[i], offsets[i + 1]
                row = words.first + i
                counts[row] = high - low
                if high == low:
                    continue
                data = words.data[words.starts[low] : words.ends[high - 1]]
                own = words.hashes[low:high]
                content[row, :TRIGRAMS] = np.sqrt(self.trigrams(data))
                content[row, TRIGRAMS:] = self._repetition(own)
                layout[row, LANGUAGES + SOURCES :] = self._layout(
                    data, words.ends[low:high] - words.starts[low:high]
                )
        for column, start, size in (("lang", 0, LANGUAGES), ("source", LANGUAGES, SOURCES)):
            values = batch.column(column).to_pylist()
            at = [xxhash.xxh32_intdigest(repr(v)) % size for v in values]
            layout[np.arange(n), start + np.array(at, np.int64)] = 1
        return content, layout, counts

    @staticmethod
    def _repetition(words: np.ndarray) -> list[float]:
        n = len(words)
        _, counts = np.unique(words, return_counts=True)
        repeated = float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0
        # What a text of this length that never repeats a word would have counts as 1.
        return [len(counts) / n, counts.max() / n if n > 3 else 0.0, repeated, np.log1p(n) / 10]

    def _layout(self, data: np.ndarray, lengths: np.ndarray) -> list[float]:
        size = len(data)
        lines = int((data == 10).sum()) + 1
        upper = ((data >= 65) & (data <= 90)).sum() / size
        lower = ((data >= 97) & (data <= 122)).sum() / size
        digits = ((data >= 48) & (data <= 57)).sum() / size
        white = self._white[data].sum() / size
        high = (data >= 128).sum() / size
        stops = np.isin(data, (44, 46)).sum() / size
        marks = max(0.0, 1 - upper - lower - digits - white - high - stops)
        return [
            np.log1p(size) / 10, np.log1p(lines) / 5, np.log1p(size / lines) / 10, upper, lower,
            digits, white, stops, marks, min(4 * upper / max(lower + upper, 1e-9), 4.0),
            float(lengths.mean()) / 10, float(lengths.std() / max(lengths.mean(), 1)),
            float((lengths[1:] == lengths[:-1]).mean()) if len(lengths) > 1 else 0.0,
        ]


@dataclass(frozen=True)
class View:
    """A logistic regression on standardised features, and its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        raw = np.empty(len(features), np.float32)
        for low in range(0, len(features), ROWS):
            z = features[low : low + ROWS] - self.mean
            z /= self.scale
            raw[low : low + ROWS] = z @ self.weights + self.bias
        return self.slope * raw + self.shift


@dataclass(frozen=True)
class Model:
    content: View
    layout: View
    prior: float

    def score(self, content: np.ndarray, layout: np.ndarray) -> np.ndarray:
        """Probability of quality, both views taken together."""
        odds = self.content.logits(content) + self.layout.logits(layout) - self.prior
        return _probability(odds)


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_view(z: np.ndarray, y: np.ndarray) -> View:
    """Penalised logistic regression by accelerated gradient descent; kinds weigh alike.

    ``z`` holds float32 features and is standardised in place.
    """
    mean = z.mean(axis=0)
    scale = np.concatenate(
        [z[:, low : low + COLUMNS].std(axis=0) for low in range(0, z.shape[1], COLUMNS)]
    )
    scale = np.where(scale > 1e-6, scale, 1.0).astype(np.float32)
    z -= mean
    z /= scale
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    weight = weight.astype(np.float32)
    w, b = np.zeros(z.shape[1], np.float32), np.float32(0)
    last_w, last_b = w.copy(), b
    # The curvature is at most a quarter of the largest mean square of a row's length.
    step = np.float32(4 / (1 + float(weight @ np.einsum("ij,ij->i", z, z)) + 4 * PENALTY))
    for turn in range(1, TURNS + 1):
        ahead = np.float32((turn - 1) / (turn + 2))
        at_w, at_b = w + ahead * (w - last_w), b + ahead * (b - last_b)
        slope = (weight * (_probability(z @ at_w + at_b) - y)).astype(np.float32)
        last_w, last_b = w, b
        w = at_w - step * (slope @ z + np.float32(PENALTY) * at_w)
        b = at_b - step * slope.sum()
    return View(mean, scale, w, float(b))


def calibrated(view: View, x: np.ndarray, y: np.ndarray) -> View:
    """Slope and shift of the log-odds that fit the held-out labels, slightly smoothed."""
    raw = view.logits(x)
    positive, negative = y.sum(), (1 - y).sum()
    goal = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _probability(a * raw + b)
        h = np.maximum(p * (1 - p), 1e-6)
        gradient = np.array([((p - goal) * raw).sum() + 1e-3 * (a - 1), (p - goal).sum()])
        hessian = np.array([[(h * raw * raw).sum() + 1e-3, (h * raw).sum()],
                            [(h * raw).sum(), h.sum() + 1e-6]])
        da, db = np.linalg.solve(hessian, gradient)
        length = max(1.0, abs(da), abs(db) / 5)
        a, b = a - da / length, b - db / length
    # A view that is no better than chance must not turn the other one around.
    return View(view.mean, view.scale, view.weights, view.bias, max(a, 0.0), b)


def _stacked(matrix: np.ndarray, rows: np.ndarray, added: list[np.ndarray]) -> np.ndarray:
    """Some rows of a matrix and others below them, as one new matrix."""
    stacked = np.empty((len(rows) + sum(map(len, added)), matrix.shape[1]), np.float32)
    # With the mode that raises, take() would fill a copy first.
    np.take(matrix, rows, axis=0, out=stacked[: len(rows)], mode="clip")
    start = len(rows)
    for part in added:
        stacked[start : start + len(part)] = part
        start += len(part)
    return stacked


def _both_kinds(y: np.ndarray) -> bool:
    return bool(len(y)) and 0 < y.sum() < len(y)


def bucket(odds: Column) -> Column:
    """Number of the histogram bucket of log-odds."""
    return F.floor(F.greatest(F.least(odds, F.lit(MOST_ODDS)), F.lit(-MOST_ODDS)) * BUCKETS).cast("int")


def cut_off(counts: dict[int, int], most: int) -> tuple[int, float]:
    """The bucket that the ``most`` greatest values reach down to, and the share taken of it."""
    for place in sorted(counts, reverse=True):
        if most < counts[place]:
            return place, most / counts[place]
        most -= counts[place]
        if not most:
            return place, 1.0
    return min(counts, default=0), 1.0


def _spread(salt: int) -> Column:
    """A number from 0 to 1 that follows from the id."""
    return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1 << 30)) / F.lit(1 << 30)


def sure_ones(scores: DataFrame) -> DataFrame:
    """id, view (that is sure) and kind of the open documents that are exchanged in a round.

    ``scores``: id and the log-odds of each view, content and layout; read several times. The
    content view chooses first, and within a view quality before the lack of it.
    """
    least = float(np.log(SURE / (1 - SURE)))
    open_, found = scores, []
    for view in VIEWS:
        most = max(1, int(SURE_SHARE * open_.count()))
        for kind, odds in ((1, F.col(view)), (0, -F.col(view))):
            place, sure = bucket(odds), odds >= least
            # At most one row per bucket, of which there are BUCKETS * MOST_ODDS.
            sizes = open_.filter(sure).groupBy(place.alias("bucket")).count().collect()
            last, share = cut_off({r["bucket"]: r["count"] for r in sizes}, most)
            chosen = sure & ((place > last) | ((place == last) & (_spread(11) < share)))
            found.append(open_.filter(chosen).select(
                "id", F.lit(view).alias("view"), F.lit(kind).alias("kind")
            ))
            open_ = open_.filter(~chosen)
    return reduce(DataFrame.union, found)


def _sample(docs: DataFrame, most: int, ids: int) -> DataFrame:
    """Rows of somewhat fewer than ``most`` of ``ids`` ids, by the hash of the id.

    The share stays clear of the limit that callers set, so the choice does not depend on it.
    """
    share = 1.0 if ids <= most else 0.95 * most / ids
    return docs.filter(F.col("id").isNotNull() & (_spread(7) < share))


def _one_per_id(docs: DataFrame) -> DataFrame:
    """One row of each id, by the hash of its text; tasks send one row per id at most."""
    rest = [c for c in docs.columns if c not in ("id", "text")]
    row = F.max(F.struct(F.xxhash64("text").alias("_h"), "text", *rest)).alias("row")
    return docs.groupBy("id").agg(row).select("id", "row.*").drop("_h")


def _features(docs: DataFrame, chosen: DataFrame) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Content and metadata view of the chosen documents that have words, and what chose them.

    ``chosen``: id and other columns, of a bounded number of ids.
    """
    rows = _one_per_id(docs.join(F.broadcast(chosen), "id"))
    others = [c for c in chosen.columns if c != "id"]
    id_type = docs.schema["id"].dataType.simpleString()
    fields = [f"{c} {chosen.schema[c].dataType.simpleString()}" for c in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in parts(batches, "text"):
            content, layout, counts = features.read(batch)
            rows = np.flatnonzero(counts)
            views = [
                pa.ListArray.from_arrays(
                    np.arange(0, v[rows].size + 1, v.shape[1], dtype=np.int32), v[rows].ravel())
                for v in (content, layout)
            ]
            kept = batch.select(["id", *others]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns, *views], names=["id", *others, *VIEWS])

    schema = ", ".join([f"id {id_type}", *fields, *[f"{v} array<float>" for v in VIEWS]])
    table = rows.mapInArrow(run, schema).toArrow()
    order = pc.sort_indices(table.select(["id"]), [("id", "ascending")]).to_numpy()
    widths = (TRIGRAMS + CONTENT_STATS, LANGUAGES + SOURCES + LAYOUT_STATS)
    content, layout = (
        _placed(table.column(name), order, width) for name, width in zip(VIEWS, widths, strict=True)
    )
    known = table.drop_columns(list(VIEWS)).take(pa.array(order))
    pa.default_memory_pool().release_unused()
    return content, layout, known


def _placed(column: pa.ChunkedArray, order: np.ndarray, width: int) -> np.ndarray:
    """The rows of a view in the given order; one chunk at a time is copied."""
    at = np.empty(len(order), np.int64)
    at[order] = np.arange(len(order))
    placed, start = np.empty((len(order), width), np.float32), 0
    for chunk in column.chunks:
        placed[at[start : start + len(chunk)]] = chunk.flatten().to_numpy().reshape(len(chunk), width)
        start += len(chunk)
    return placed


def _scored(docs: DataFrame, views: list[View]) -> DataFrame:
    """id and the log-odds of both views, of one row per id that has words."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in parts(batches, "text"):
            content, layout, counts = features.read(batch)
            odds = [v.logits(x).astype(np.float64) for v, x in zip(views, (content, layout), strict=True)]
            rows = pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("h"), *map(pa.array, odds)], names=["id", "h", *VIEWS]
            )
            yield rows.filter(pa.array(counts > 0))

    rows = docs.filter("id is not null").withColumn("h", F.xxhash64("text"))
    each = rows.mapInArrow(run, f"id {id_type}, h long, content double, layout double")
    return each.groupBy("id").agg(F.max(F.struct("h", *VIEWS)).alias("row")).select(
        "id", *[F.col(f"row.{v}").alias(v) for v in VIEWS]
    )


def learn(
    docs: DataFrame, labels: DataFrame, most_labelled: int = LABELLED,
    most_exchanged: int = EXCHANGED,
) -> Model | None:
    """Fit the model; None without labels of both kinds.

    ``docs``: id, text, lang, source; ``labels``: id, quality.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col("id").isNotNull() & F.col("quality").isNotNull()).groupBy("id").agg(
        F.min("quality").cast("int").alias("label")
    )
    counts = known.agg(F.count(F.lit(1)), F.count_if(F.col("label") > 0)).first()
    if not 0 < counts[1] < counts[0]:
        return None
    # At most most_labelled rows of two numbers each.
    chosen = staged(spark, _sample(known, most_labelled, counts[0]).limit(most_labelled), "labelled")
    *labelled, given = _features(docs, chosen)
    y = (given.column("label").to_numpy() > 0).astype(np.float64)
    if not _both_kinds(y):
        return None
    apart = np.arange(len(y)) % round(1 / KEPT_APART) == 0
    apart &= _both_kinds(y[~apart]) and _both_kinds(y[apart])
    train = np.flatnonzero(~apart)
    held = np.flatnonzero(apart) if apart.any() else train
    # What each view has got from the other one.
    got = [[np.zeros((0, own.shape[1]), np.float32)] for own in labelled]
    goals = [[y[train]], [y[train]]]

    def fit() -> list[View]:
        return [
            fit_view(_stacked(own, train, added), np.concatenate(goal))
            for own, added, goal in zip(labelled, got, goals, strict=True)
        ]

    views, taken = fit(), None
    for _ in range(ROUNDS):
        scores = _scored(docs, views).join(F.broadcast(chosen.select("id")), "id", "left_anti")
        if taken is not None:
            scores = scores.join(taken.select("id"), "id", "left_anti")
        sure = staged(spark, sure_ones(staged(spark, scores, "log-odds")), "exchanged")
        taken = sure if taken is None else taken.union(sure)
        # Of each view and kind an equal share of what a view is fitted on, and of each round.
        sizes = {(r["view"], r["kind"]): r["count"] for r in sure.groupBy("view", "kind").count().collect()}
        if not sizes:
            break
        most = max(1, most_exchanged // (2 * ROUNDS))
        some = [
            _sample(sure.filter((F.col("view") == view) & (F.col("kind") == kind)), most, n).limit(most)
            for (view, kind), n in sorted(sizes.items())
        ]
        # At most 2 * most_exchanged / ROUNDS rows.
        *features, which = _features(docs, staged(spark, reduce(DataFrame.union, some), "fitted"))
        by, kinds = (which.column(c).to_numpy(zero_copy_only=False) for c in ("view", "kind"))
        for other, view in ((1, VIEWS[0]), (0, VIEWS[1])):
            rows = np.flatnonzero(by == view)
            got[other].append(features[other][rows])
            goals[other].append(kinds[rows].astype(np.float64))
        views = fit()
    views = [calibrated(v, view[held], y[held]) for v, view in zip(views, labelled, strict=True)]
    share = (y[held].sum() + 1) / (len(held) + 2)
    return Model(views[0], views[1], float(np.log(share / (1 - share))))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    quality_column: str = "quality",
    accepted: float = ACCEPTED,
    labelled: int = LABELLED,
    exchanged: int = EXCHANGED,
) -> DataFrame:
    """The columns of ``docs``, then content_score, metadata_score, score and accepted.

    ``labelled`` and ``exchanged`` bound the labelled rows that a view is fitted on; the driver
    holds their features.
    """
    bound_batches(docs.sparkSession)
    inputs = {"id": id_column, "text": text_column, "lang": lang_column, "source": source_column}
    results = ("content_score", "metadata_score", "score", "accepted")
    names = [n for n in docs.columns if n not in results]
    rows = docs.select(*names).toDF(*[f"c{i}" for i in range(len(names))])
    at = {name: f"c{names.index(column)}" for name, column in inputs.items()}
    model = learn(
        rows.select(*[F.col(c).alias(name) for name, c in at.items()]),
        labels.select(F.col(id_column).alias("id"), F.col(quality_column).alias("quality")),
        labelled,
        exchanged,
    )
    columns = rows.columns
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in parts(batches, at["text"]):
            given = pa.RecordBatch.from_pydict({name: batch.column(c) for name, c in at.items()})
            content, layout, counts = features.read(given)
            if model is None:
                scores = [np.full(len(counts), 0.5)] * 3
            else:
                scores = [
                    _probability(model.content.logits(content)),
                    _probability(model.layout.logits(layout)), model.score(content, layout),
                ]
            scores = [np.where(counts > 0, s, 0.0).astype(np.float64) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], *[pa.array(s) for s in scores],
                 pa.array((scores[2] >= accepted) & (counts > 0))],
                names=[*columns, *results],
            )

    schema = f"{fields}, content_score double, metadata_score double, score double, accepted boolean"
    return rows.mapInArrow(run, schema).toDF(*names, *results)
