"""Quality classifier: Naive Bayes support vectors.

Features are n-gram indicators: the byte 4-grams of a text, hashed to ``2**BITS`` numbers, and the word
n-grams (n up to ``RUN``) that consist of one word repeated, whatever the word. The log-count ratio of
the two classes scales every indicator, vectors are divided by the root of their number of features, and
a linear hinge-loss model is fitted by dual coordinate descent. A logistic curve through the margins of
rows the fit did not see turns margins into scores between 0 and 1.

Fitting reads at most ``FIT_ROWS`` labelled rows (those with the least hash of their id; never one whose
crc32 modulo ``FOLDS`` is 0), joined to the documents through a broadcast of that many ids, in one task.
Every document is scored from its whole text, in the scan, without a shuffle. Labels, language, source
and ids are no features.

Defined results: null and empty texts have no features and get the score of the model's intercept; a
null id counts as the empty text in the fold; an id labelled more than once counts with its greatest
label, and a labelled id with several texts with the text of least hash; without labels of both classes
every score is the share of good labels (one half without labels). Row order and repetition do not
matter; further columns are carried by ``accepted`` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import tidy

BITS = 17
RUN = 9
FEATURES = (1 << BITS) + RUN
FIT_ROWS = 6_000
FOLDS = 5
THRESHOLD = 0.3
COST = 3.0
EPOCHS = 12
#: Share of the fit's rows that the logistic curve is fitted on.
CURVE = 4
CHUNK = 1 << 20


def _grams(a: np.ndarray) -> np.ndarray:
    x = a.astype(np.uint32)
    key = x[:-3] | x[1:-2] << np.uint32(8) | x[2:-1] << np.uint32(16) | x[3:] << np.uint32(24)
    return ((key ^ key >> np.uint32(15)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def features(text: bytes | None, place: np.ndarray) -> np.ndarray:
    """Numbers of the features of a text, each once; ``place`` is scratch space of ``FEATURES`` ints."""
    text = text or b""
    w = text.split()
    same = bytes([x == y for x, y in zip(w, w[1:])])  # noqa: B905 - one shorter
    run = max(map(len, same.split(b"\0")))
    found = [np.arange(1, min(run, RUN) + 1, dtype=np.int64) + (1 << BITS) - 1]
    a = np.frombuffer(text, np.uint8)
    if 4 <= len(a) <= CHUNK:
        g = _grams(a)
        at = np.arange(len(g), dtype=place.dtype)
        place[g] = at
        found.append(g[place[g] == at].astype(np.int64))
    elif len(a) > CHUNK:
        has = np.zeros(1 << BITS, bool)
        for i in range(0, len(a) - 3, CHUNK):
            has[_grams(a[i : i + CHUNK + 3])] = True
        found.append(np.nonzero(has)[0])
    return np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """Weight of every feature (ratio times coefficient), intercept, and the curve's slope and offset."""

    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        place = np.empty(FEATURES, np.int64)
        margin = np.empty(len(texts))
        for i, t in enumerate(texts):
            x = features(t.as_py(), place)
            margin[i] = self.weights[x].sum(dtype=np.float64) / max(len(x), 1) ** 0.5 + self.intercept
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log of the smoothed shares of each feature in the two classes."""
    counts = np.ones((2, FEATURES))
    for x, g in zip(rows, good, strict=True):
        counts[g, x] += 1
    return np.log(counts[1] / (good.sum() + 2)) - np.log(counts[0] / ((1 - good).sum() + 2))


def descend(rows: list[np.ndarray], good: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the hinge-loss model by dual coordinate descent."""
    values = [ratio[x] / max(len(x), 1) ** 0.5 for x in rows]
    norm, sign = np.array([v @ v + 1 for v in values]), np.where(good == 1, 1.0, -1.0)
    w, b, dual, rng = np.zeros(FEATURES), 0.0, np.zeros(len(rows)), np.random.default_rng(0)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            slope = sign[i] * (w[rows[i]] @ values[i] + b) - 1
            step = min(max(dual[i] - slope / norm[i], 0.0), COST) - dual[i]
            if step:
                dual[i] += step
                w[rows[i]] += step * sign[i] * values[i]
                b += step * sign[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, b


def curve(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through smoothed targets, by damped Newton steps."""
    target = np.where(good == 1, (good.sum() + 1) / (good.sum() + 2), 1 / ((1 - good).sum() + 2))
    x = np.stack((margin, np.ones(len(margin))), 1)
    c = np.array([1.0, 0.0])

    def loss(c: np.ndarray) -> float:
        z = x @ c
        return float((np.logaddexp(0, z) - target * z).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), x.T @ (p - target))
        size = 1.0
        while size > 1e-6 and loss(c - size * step) > loss(c):
            size /= 2
        c = c - size * step
        if abs(step).max() < 1e-9:
            break
    return float(c[0]), float(c[1])


def fit_rows(texts: list[bytes | None], good: np.ndarray) -> Model:
    """The model of some labelled texts, given in a fixed order."""
    place = np.empty(FEATURES, np.int64)
    rows = [features(t, place) for t in texts]
    if len(set(good.tolist())) < 2:
        share = (good.sum() + 1) / (len(good) + 2)
        return Model(np.zeros(FEATURES, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    seen = np.arange(len(rows)) % CURVE != 0
    if len(set(good[seen].tolist())) < 2:
        seen[:] = True
    part, part_good = [rows[i] for i in np.nonzero(seen)[0]], good[seen]
    ratio = ratios(part, part_good)
    w, b = descend(part, part_good, ratio)
    weights = (w * ratio).astype(np.float32)
    rest = np.nonzero(~seen)[0] if not seen.all() else np.arange(len(rows))
    margin = np.array([weights[rows[i]].sum(dtype=np.float64) / max(len(rows[i]), 1) ** 0.5 + b for i in rest])
    slope, offset = curve(margin, good[rest])
    return Model(weights, b, max(slope, 1e-3), offset)


def _fold(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        fit_rows_max: int = FIT_ROWS) -> Model:
    """Fits on at most ``fit_rows_max`` labelled rows outside the held-out fold."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good"))
    known = known.where((_fold("id") != 0) & F.col("id").isNotNull() & F.col("good").isin(0, 1))
    chosen = known.groupBy("id").agg(F.max("good").alias("good")).orderBy(F.xxhash64("id"), "id").limit(fit_rows_max)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    # at most fit_rows_max ids
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "good").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, good = [], []
        for b in batches:
            got += b.column(1).to_pylist()
            good += b.column(0).to_pylist()
        m = fit_rows(got, np.array(good, np.int64))
        out = [[m.weights.tobytes()], [m.intercept], [m.slope], [m.offset]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["weights", "intercept", "slope", "offset"])

    one = rows.select("good", "text", "id").repartition(1).sortWithinPartitions(F.xxhash64("id"), "id").select("good", "text")
    found = one.mapInArrow(tidy(run), "weights binary, intercept double, slope double, offset double").first()
    if found is None:  # no labelled document
        return fit_rows([], np.zeros(0, np.int64))
    return Model(np.frombuffer(found["weights"], np.float32), found["intercept"], found["slope"], found["offset"])


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, score): every row of ``docs`` as a struct, and its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(b.column(1)))], ["row", "score"])

    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(tidy(run), f"row {rows.schema['row'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted, one row per input row."""
    model = fit(docs, labels, label_col, id_col, text_col)
    body = docs.select(F.col(id_col).alias("doc_id"), (_fold(id_col) == 0).alias("held_out"), F.col(text_col).alias("text"))
    return scored(body, model).select(
        "row.doc_id", "row.held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, columns unchanged."""
    model = fit(docs, labels, label_col, id_col, text_col)
    return scored(docs, model, text_col).where(F.col("score") >= THRESHOLD).select("row.*")
