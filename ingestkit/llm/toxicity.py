"""Toxicity: a factorization machine over hashed terms.

A text is the set of its terms (runs of letters and non-ASCII characters, A-Z lower-cased) and of their first
``PREFIX`` characters, hashed to ``2**BITS`` numbers. A number counts as much as its share differs between the
classes of the fit's rows, in standard errors less one, and at least ``FLOOR``; the values of a text are divided
by their length as a vector, so neutral terms of a long text do not drown the others. Besides a weight every
number has a vector of ``FACTORS`` factors, and the margin of a text with values x is

    bias + sum of weight x + sum over pairs i < j of <factors i, factors j> x_i x_j,

where the pairs cost one pass, as they are half of (sum of factors x)^2 less the sum of squares. So a term may
count for or against toxicity by the company it keeps (an insult beside a group), which no sum of single
weights can say. The model is fitted by mini-batches of logistic loss with adaptive steps.

Fitting reads at most ``FIT_ROWS`` labelled rows (those with the least hash of their id; never one whose
crc32 modulo ``FOLDS`` is ``HELD_OUT``), joined to the documents through a broadcast of that many ids. Texts
become feature sets in the scan; one task fits on the sets, each at most ``2**BITS`` numbers whatever the
text's length. Every document is scored from its whole text, in the scan, without a shuffle. Labels,
language, source and ids are no features.

Defined results: null and empty texts, and texts of terms that the fit never saw, have no features and get
the score of the bias; a null id counts as the empty text in the fold; an id labelled more than once counts
with its greatest label, and a labelled id with several texts with the one of least hash; without labels of
both classes every score is the smoothed share of toxic labels (one half without labels). Row order and
repetition do not matter; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.common import tidy

BITS = 18
PREFIX = 4
FACTORS = 4
FIT_ROWS = 6_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
EPOCHS = 6
ROWS_A_STEP = 32
RATE = 0.2
START = 0.05
FLOOR = 0.05
#: Fit rows that must have a feature before it counts.
LEAST_ROWS = 2
#: Terms whose numbers a task keeps at hand.
KNOWN = 200_000
#: The code points that separate terms, as ranges.
SEPARATORS = ((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

_TABLE = {c: 0x20 for a, b in SEPARATORS for c in range(a, b + 1)} | {c: c + 32 for c in range(0x41, 0x5B)}


def _number(term: str) -> int:
    h = zlib.crc32(term.encode("utf-8", "surrogatepass"))
    return (h ^ h >> BITS) & ((1 << BITS) - 1)


class Features:
    """Numbers of the features of texts; keeps those of at most ``KNOWN`` terms."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def of(self, text: str | None) -> np.ndarray:
        found: set[int] = set()
        known = self.known
        for term in set((text or "").translate(_TABLE).split(" ")):
            pair = known.get(term)
            if pair is None:
                if len(known) >= KNOWN:
                    known.clear()
                pair = known[term] = (_number(term), _number(" " + term[:PREFIX])) if term else ()
            found.update(pair)
        return np.array(sorted(found), np.int32)


@dataclass(frozen=True)
class Model:
    """Bias, and for the numbers that count, in ascending order, their value, weight and factors."""

    bias: float
    numbers: np.ndarray
    values: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, rows: Iterable[np.ndarray]) -> np.ndarray:
        """Scores of feature sets."""
        q, w, v = np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros((1 << BITS, FACTORS))
        q[self.numbers], w[self.numbers], v[self.numbers] = self.values, self.weights, self.factors
        margin = [self.bias + _margin(unit(q[x]), w[x], v[x]) for x in rows]
        return 1 / (1 + np.exp(-np.clip(np.array(margin, np.float64), -500, 500)))


def unit(q: np.ndarray) -> np.ndarray:
    """Values divided by their length as a vector."""
    return q / max((q @ q) ** 0.5, 1e-12)


def _margin(q: np.ndarray, w: np.ndarray, v: np.ndarray) -> float:
    f = v * q[:, None]
    s = f.sum(0)
    return float(w @ q + (s @ s - (f * f).sum()) / 2)


def importance(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Value of every number: zero below ``LEAST_ROWS`` rows."""
    n, n1 = len(rows), int(toxic.sum())
    count = np.bincount(np.concatenate(rows), minlength=1 << BITS)
    among = np.bincount(np.concatenate([x for x, t in zip(rows, toxic, strict=True) if t]), minlength=1 << BITS)
    p = (count + 1) / (n + 2)
    z = (among / n1 - (count - among) / (n - n1)) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / (n - n1)))
    return np.where(count >= LEAST_ROWS, np.maximum(np.abs(z) - 1, FLOOR), 0)


def fit_rows(rows: list[np.ndarray], toxic: np.ndarray) -> Model:
    """The model of some feature sets with their labels, given in a fixed order."""
    if len(set(toxic.tolist())) < 2:
        share = (toxic.sum() + 1) / (len(toxic) + 2)
        none = np.zeros(0, np.float32)
        return Model(float(np.log(share / (1 - share))), np.zeros(0, np.int32), none, none, np.zeros((0, FACTORS), np.float32))
    value = importance(rows, toxic)
    numbers = np.flatnonzero(value).astype(np.int32)
    place = np.full(1 << BITS, -1, np.int64)
    place[numbers] = np.arange(len(numbers))
    rows = [x[value[x] > 0] for x in rows]
    values = [unit(value[x]) for x in rows]
    rows = [place[x] for x in rows]
    rng, n, share = np.random.default_rng(0), len(numbers), toxic.mean()
    w, v, b = np.zeros(n), rng.normal(0, START, (n, FACTORS)), float(np.log(share / (1 - share)))
    past_w, past_v, past_b = np.full(n, 1e-4), np.full(n, 1e-4), 1e-4  # sums of squared slopes
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), ROWS_A_STEP):
            batch = order[at : at + ROWS_A_STEP]
            x, q = (np.concatenate([part[i] for i in batch]) for part in (rows, values))
            of = np.repeat(np.arange(len(batch)), [len(rows[i]) for i in batch])

            def per_row(y: np.ndarray, of: np.ndarray = of, n: int = len(batch)) -> np.ndarray:
                return np.bincount(of, y, n)

            f = v[x] * q[:, None]
            s = np.stack([per_row(f[:, k]) for k in range(FACTORS)], 1)
            margin = b + per_row(w[x] * q - (f * f).sum(1) / 2) + (s * s).sum(1) / 2
            pull = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - toxic[batch]) / len(batch)
            past_b += pull.sum() ** 2
            b -= RATE * pull.sum() / past_b**0.5
            some, back = np.unique(x, return_inverse=True)
            slope = np.bincount(back, pull[of] * q, len(some))
            past_w[some] += slope * slope
            w[some] -= RATE * slope / np.sqrt(past_w[some])
            each = (pull[of] * q)[:, None] * (s[of] - f)
            slopes = np.stack([np.bincount(back, each[:, k], len(some)) for k in range(FACTORS)], 1)
            past_v[some] += (slopes * slopes).sum(1)
            v[some] -= RATE * slopes / np.sqrt(past_v[some])[:, None]
    return Model(float(b), numbers, *(y.astype(np.float32) for y in (value[numbers], w, v)))


def _remainder(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        fit_rows_max: int = FIT_ROWS) -> Model:
    """Fits on at most ``fit_rows_max`` labelled rows outside the held-out fold."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where((_remainder("id") != HELD_OUT) & F.col("id").isNotNull() & F.col("toxic").isin(0, 1))
    chosen = known.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(fit_rows_max)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # at most fit_rows_max ids
    some = texts.join(F.broadcast(chosen), "id").select(
        F.struct("id", "toxic", F.xxhash64("text").alias("hash")).alias("row"), "text"
    )

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features()
        for b in batches:
            found = [known.of(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32()))], ["row", "x"])

    kind = some.schema["row"].dataType.simpleString()
    sets = some.mapInArrow(tidy(featured), f"row {kind}, x array<int>")
    rows = sets.groupBy("row.id", "row.toxic").agg(F.min_by("x", "row.hash").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[np.ndarray] = []
        toxic: list[int] = []
        for b in batches:
            got += [np.array(x.as_py(), np.int32) for x in b.column(1)]
            toxic += b.column(0).to_pylist()
        m = fit_rows(got, np.array(toxic, np.int64))
        out = [[m.bias], *([y.tobytes()] for y in (m.numbers, m.values, m.weights, m.factors))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["bias", "numbers", "vals", "weights", "factors"])

    one = rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id").select("toxic", "x")
    found = one.mapInArrow(tidy(run), "bias double, numbers binary, vals binary, weights binary, factors binary").first()
    if found is None:  # no labelled document
        return fit_rows([], np.zeros(0, np.int64))
    v, w, f = (np.frombuffer(found[c], np.float32) for c in ("vals", "weights", "factors"))
    return Model(found["bias"], np.frombuffer(found["numbers"], np.int32), v, w, f.reshape(-1, FACTORS))


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, score): every row of ``docs`` as a struct, and its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features()
        for b in batches:
            scores = model.scores(known.of(t.as_py()) for t in b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores)], ["row", "score"])

    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), f"row {rows.schema['row'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score and predicted, one row per input row."""
    model = fit(docs, labels, label_col, id_col, text_col)
    held_out = (_remainder(id_col) == HELD_OUT).alias("held_out")
    body = docs.select(F.col(id_col).alias("doc_id"), held_out, F.col(text_col).alias("text"))
    return scored(body, model).select(
        "row.doc_id", "row.held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
