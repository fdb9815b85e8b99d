"""Document quality by naive-Bayes support vectors (NBSVM).

Features are n-gram indicators: character 1-, 2- and 3-grams of the text as
written (case, punctuation and white space count) and runs of 2, 4 and 8 equal
words, hashed to ``SLOTS`` slots. Indicators are scaled by the log ratio of
their smoothed class counts; a linear hinge-loss model over the scaled,
length-normalised vectors is fitted by dual coordinate descent, and a logistic
curve over cross-validated margins turns margins into scores.

Training sample (documented bound): at most ``max_rows`` labelled rows, those
with the smallest hashes of the id; the model has ``SLOTS`` weights, whatever
the corpus size. Every text is scored whole.

Defined results: null text counts as empty and gets the score of a text without
features; rows without a label train nothing, an id with both labels trains once
as each, repeated ids train once; without both classes in the sample every score is the
share of label 1, 0.5 without labels; repeated rows give repeated results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 1 << 18
RUNS = (2, 4, 8)
MAX_ROWS = 6000
MULTIPLIERS = (2654435761, 2246822519, 3266489917)     # odd constants of the n-gram hash


def trainable(id_col: str = "doc_id") -> Column:
    """Rows that may train: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


class Extractor:
    """Slots of the n-grams that occur in a text, ascending."""

    def __init__(self) -> None:
        self.mark = np.zeros(SLOTS, np.bool_)

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        for at in range(0, len(points), 1 << 18):          # bounded working memory
            part = points[at:at + (1 << 18) + 2]
            total = np.full(len(part), 1, np.uint32)
            for n, factor in enumerate(MULTIPLIERS):
                if len(part) <= n:
                    break
                total = (total[:len(part) - n] + part[n:]) * np.uint32(factor)
                self.mark[total >> np.uint32(14)] = True
        words = text.split()
        run = longest = 0
        for same in map(eq, words, words[1:]):
            run = run + 1 if same else 0
            longest = max(longest, run)
        for k, n in enumerate(RUNS):
            if longest + 1 >= n:
                self.mark[k] = True
        found = np.flatnonzero(self.mark)
        self.mark[found] = False
        return found.astype(np.int32)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Per slot: log of the smoothed class shares of its indicator, label 1 over label 0."""
    counts = np.full((2, SLOTS), smoothing)
    for row, label in zip(rows, labels):
        counts[label][row] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray,
                            costs: np.ndarray, epochs: int = 12, seed: int = 0) -> np.ndarray:
    """Weights (the last one is the bias) of the L2-regularised hinge-loss model.

    One pass visits the rows in random order; each step solves its dual
    variable exactly in 0..costs[i] and moves the weights along the row.
    """
    weights, duals = np.zeros(SLOTS + 1), np.zeros(len(rows))
    squares = np.array([float(v @ v) + 1.0 for v in values])
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            slope = signs[i] * (float(weights[rows[i]] @ values[i]) + weights[-1]) - 1.0
            new = min(max(duals[i] - slope / squares[i], 0.0), costs[i])
            step = (new - duals[i]) * signs[i]
            if step:
                weights[rows[i]] += step * values[i]
                weights[-1] += step
                duals[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights


def _scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    values = ratios[row]
    size = float(np.sqrt(values @ values))
    return values / size if size else values


class Model:
    """Scores texts; ``fit`` trains on extracted rows and 0/1 labels."""

    def __init__(self) -> None:
        self.ratios, self.weights = np.zeros(SLOTS), np.zeros(SLOTS + 1)
        self.slope, self.shift = 0.0, 0.0

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, cost: float = 10.0, folds: int = 4) -> Model:
        if len(labels):
            p = (labels.sum() + 0.5) / (len(labels) + 1)
            self.shift = float(np.log(p / (1 - p)))
        if len(set(labels.tolist())) < 2:
            return self
        fold = np.arange(len(rows)) % folds
        margins = np.zeros(len(rows))
        for k in range(folds):
            own = Model()._train([r for r, f in zip(rows, fold) if f != k], labels[fold != k], cost)
            for i in np.flatnonzero(fold == k):
                margins[i] = own.margin(rows[i])
        self._train(rows, labels, cost)
        self.slope, self.shift = _logistic(margins, labels)
        return self

    def _train(self, rows: list[np.ndarray], labels: np.ndarray, cost: float) -> Model:
        if len(set(labels.tolist())) < 2:
            return self
        self.ratios = log_count_ratios(rows, labels)
        values = [_scaled(r, self.ratios) for r in rows]
        # both classes weigh alike
        share = np.array([(labels == c).mean() for c in (0, 1)])
        self.weights = dual_coordinate_descent(rows, values, 2.0 * labels - 1, cost * 0.5 / share[labels])
        return self

    def margin(self, row: np.ndarray) -> float:
        return float(self.weights[row] @ _scaled(row, self.ratios) + self.weights[-1])

    def score(self, row: np.ndarray) -> float:
        z = self.slope * self.margin(row) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _logistic(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve of label 1 over the margin (damped Newton steps)."""
    x = np.stack([margins, np.ones(len(margins))])
    beta = np.zeros(2)
    # smoothed targets keep the curve finite when the margins separate the classes
    n1 = labels.sum()
    n0 = len(labels) - n1
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        gradient = x @ (p - target)
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", max_rows: int = MAX_ROWS) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature slots and labels of at most ``max_rows`` labelled documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor()
        for batch in batches:
            rows = [extract(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))],
                names=["h", "label", "slots"])

    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(trainable("id") & F.col("label").isin(0, 1)))
    # the sample of ids first: only its texts are read, once per id
    chosen = known.orderBy(F.xxhash64("id"), "id", "label").limit(max_rows).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = (texts.join(F.broadcast(chosen), "id")                      # at most max_rows rows
             .groupBy(F.xxhash64("id").alias("h"), "id", "label").agg(F.min("text").alias("text"))
             .select("h", "label", "text").mapInArrow(run, "h long, label int, slots array<int>").collect())
    found.sort(key=lambda r: (r.h, r.label))
    return [np.array(r.slots, np.int32) for r in found], np.array([r.label for r in found], np.int64)


def quality_of(text: Column, model: Model, spark: SparkSession) -> Column:
    """Score (0 to 1, higher: label 1 likelier) of a text column."""
    shared = spark.sparkContext.broadcast(vars(model))

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, extract = Model(), Extractor()
        vars(own).update(shared.value)
        for texts in batches:
            yield pd.Series([own.score(extract(t)) for t in texts], dtype="float64")

    return judge(text)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model of ``labels.quality`` from the trainable documents."""
    return Model().fit(*training_rows(docs, labels, max_rows=max_rows))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    return docs.select(F.col(id_col).alias("id"),
                       quality_of(F.col(text_col), model, docs.sparkSession).alias("score"))
