"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document becomes a dozen statistics (sizes, shares of character classes,
repetition). Standardised, they are mapped to ``FEATURES`` random Fourier
features, whose inner products approximate a Gaussian kernel. Ridge weights
solve the normal equations, summed per partition. The raw scores are calibrated
by isotonic regression on labelled rows that the ridge fit has not seen.

Scale: texts are read once, for the statistics, which are written to the shared
folder. Fitting gathers one (FEATURES + 1) square matrix per partition, summed
by blocks of rows on the executors; the driver gets one such matrix and one
histogram of ``BINS`` scores, whatever the size of the input. Scoring is a scan.

Defined results: a null text counts as empty; empty texts get a score like any
other; null labels are ignored, repeated labels of a document averaged; without
a labelled row of both classes every score is the mean label, or 0.5 without
labels; repeated rows get equal scores; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import common as C

FEATURES = 256
LENGTH_SCALE = 2.5
RIDGE = 1.0
SEED = 7
BINS = 2000
LOW, HIGH = -0.5, 1.5          # raw scores outside go to the first or last bin
SLICE = 1 << 20
N_STATS = 12


@functools.cache
def classes() -> np.ndarray:
    """Per code point: 0 other, 1 upper, 2 other letter, 3 digit, 4 space, 5 symbol, 6 punctuation, 7 line feed."""
    def of(c: str) -> int:
        if c == "\n":
            return 7
        if c in C.SYMBOLS:
            return 5
        kind = unicodedata.category(c)
        return 1 if kind == "Lu" else 2 if kind[0] == "L" else 3 if kind == "Nd" else 4 if c.isspace() else 6 if kind[0] == "P" else 0
    return np.array([of(chr(c)) for c in range(0x110000)], np.uint8)


def statistics(text: str | None) -> list[float]:
    text = text or ""
    counts = np.zeros(8)
    for i in range(0, len(text), SLICE):
        points = np.frombuffer(text[i:i + SLICE].encode("utf-32-le", "surrogatepass"), "<u4")
        counts += np.bincount(classes()[points], minlength=8)
    other, upper, letter, digit, space, symbol, mark, feeds = counts
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, chars = max(1, len(words)), max(1.0, len(text) - space - feeds)
    distinct = len(set(words)) / n
    return [math.log1p(len(words)), chars / n, math.log1p(len(words) / max(1, len(lines))), upper / max(1.0, upper + letter),
            digit / chars, min(4.0, symbol / n), min(4.0, mark / n), (upper + letter) / chars, other / chars, distinct,
            # distinct words fall with length; against the usual fall (Heaps' law) repetition stands out
            math.log(max(distinct, 1e-6)) + 0.1 * math.log1p(len(words)),
            1 - len(set(lines)) / max(1, len(lines))]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def statistics_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([statistics(text.as_py()) for text in batch], pa.list_(pa.float64()))


def kernel_map(d: int, features: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(0, 1 / LENGTH_SCALE, (d, features)), rng.uniform(0, 2 * np.pi, features)


@dataclass
class Model:
    mean: np.ndarray
    std: np.ndarray
    weights: np.ndarray | None   # FEATURES + 1; None: every raw score is ``base``
    base: float
    knots: np.ndarray            # raw scores, ascending
    levels: np.ndarray           # calibrated scores at the knots

    def fourier(self, x: np.ndarray, features: int) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -6, 6)
        w, b = kernel_map(x.shape[1], features)
        return np.hstack([np.sqrt(2 / features) * np.cos(z @ w + b), np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(x):
            return np.full(len(x), self.base)
        return self.fourier(x, len(self.weights) - 1) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        if not len(self.knots):   # nothing to calibrate with: labels are 0 and 1, so is the ridge's scale
            return np.clip(raw, 0.0, 1.0)
        # a sliver of the raw score keeps the order inside a flat step
        tilt = (np.clip(raw, LOW, HIGH) - LOW) / (HIGH - LOW)
        return np.clip(0.999 * np.interp(raw, self.knots, self.levels) + 0.001 * tilt, 0.0, 1.0)


def matrix(batch: pa.RecordBatch, column: int = 0) -> np.ndarray:
    rows = batch.column(column)
    return np.asarray(rows.flatten()).reshape(len(rows), N_STATS)


def normal_equations(rows: DataFrame, blank: Model, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over ``rows`` (x, y): summed in each partition, then by rows of the matrix."""
    m = features + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m, m + 1))
        for batch in batches:
            z = blank.fourier(matrix(batch), features)
            total += z.T @ np.hstack([z, np.asarray(batch.column(1))[:, None]])
        yield as_rows(range(m), total)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), np.asarray(batch.column(1).flatten()).reshape(-1, m + 1)):
                total[i] = total.get(i, 0) + row
        if total:
            yield as_rows(list(total), np.array(list(total.values())))

    def as_rows(i, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(i), pa.int32()), pa.array(list(values), pa.list_(pa.float64()))],
                                          ["i", "row"])
    kind = "i int, row array<double>"
    out = rows.select("x", "y").mapInArrow(partial, kind).repartition("i").mapInArrow(summed, kind).toArrow()
    full = np.zeros((m, m + 1))
    for i, row in zip(out["i"].to_pylist(), out["row"].to_pylist()):
        full[i] = row
    return full[:, :m], full[:, m]


def isotonic(at: np.ndarray, total: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points in ascending order; (centre, level) of each block."""
    blocks: list[list[float]] = []
    for x, n, p in zip(at, total, positive):
        blocks.append([x * n, n, p])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(features: DataFrame, labels: DataFrame, n_features: int = FEATURES, ridge: float = RIDGE) -> Model:
    """``features`` (doc_id, x) and ``labels`` (doc_id, y, calibrate): rows to calibrate
    with are kept out of the ridge fit."""
    marks = (labels.filter("y is not null and doc_id is not null").groupBy("doc_id")
             .agg(F.avg(F.col("y").cast("double")).alias("y"), F.max("calibrate").alias("calibrate")))
    known = C.written(features.join(marks, "doc_id").select("x", "y", "calibrate"), "labelled")
    fit_rows = known.filter("not calibrate")
    moments = known.agg(F.avg("y").alias("mean"), F.min("y").alias("least"), F.max("y").alias("most"),
                        *[f(F.col("x")[i]).alias(f"{k}{i}") for i in range(N_STATS)
                          for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    none = np.array([])
    if moments["mean"] is None or moments["least"] == moments["most"]:
        base = 0.5 if moments["mean"] is None else float(moments["mean"])
        return Model(np.zeros(N_STATS), np.ones(N_STATS), None, base, none, none)
    mean = np.array([moments[f"m{i}"] for i in range(N_STATS)])
    std = np.array([moments[f"s{i}"] for i in range(N_STATS)])
    model = Model(mean, np.where(std > 1e-9, std, 1.0), None, float(moments["mean"]), none, none)
    a, b = normal_equations(fit_rows, model, n_features)
    weights = np.linalg.solve(a + ridge * np.eye(len(a)), b)
    model = Model(model.mean, model.std, weights, model.base, none, none)
    width = (HIGH - LOW) / BINS

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.clip((model.raw(matrix(batch)) - LOW) / width, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], ["bin", "y"])
    bins = (known.filter("calibrate").select("x", "y").mapInArrow(histogram, "bin int, y double")
            .groupBy("bin").agg(F.count("y").alias("n"), F.sum("y").alias("positive")).orderBy("bin").collect())
    at, n, positive = (np.array([r[k] for r in bins], float) for k in range(3))
    model.knots, model.levels = isotonic(LOW + (at + 0.5) * width, n, positive)
    return model


def scores(features: DataFrame, model: Model) -> Column:
    """Calibrated score of the statistics in column ``x``."""
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.score(np.asarray(batch.flatten()).reshape(len(batch), N_STATS)))
    return score(F.col("x"))
