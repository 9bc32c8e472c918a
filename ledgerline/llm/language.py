"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and everything that isn't a letter becomes a space. Every
letter contributes the pair of it and the next character, and the triple around
it. Grams are hashed to ``2 ** bits`` buckets. Training sums bucket counts per
language; the smoothed log-probabilities form a (languages x buckets) matrix,
which is broadcast and applied to batches of texts in numpy.

Scale: training is one scan with one count table per task and a sum by
(language, bucket); scoring is a scan without a shuffle. The matrix is held
under ``MATRIX_BYTES`` by taking fewer buckets for many languages, and training
refuses more languages than that allows. Texts are handled in slices of
``SLICE`` characters, cut before white space, so memory does not grow with a text
(but with a run of that many characters without any white space).

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text if nothing was learned (no row with a label and a letter); of
equally likely languages the first by name wins; repeated rows count each time
in training and are scored alike; other columns of the input pass through (the
result is one struct column, whose name the caller picks).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as C

BITS = 16
MATRIX_BYTES = 64 << 20
SLICE = 1 << 20
WHITE = re.compile(r"\s")
SMOOTHING = 0.5
UNKNOWN = "und"
RESULT = "lang string, score double"


@functools.cache
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def mixed(x: np.ndarray, bits: int) -> np.ndarray:
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    return (x >> np.uint32(32 - bits)).astype(np.int32)


def grams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed grams of the texts one after the other (all pairs, then all triples
    of a letter side by side), and the number of letters in each text."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer((" " + "  ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[points]
    points = np.where(is_letter, points, np.uint32(32))
    at = np.flatnonzero(is_letter)
    before, here, after = points[at - 1], points[at], points[at + 1]
    tail = after * np.uint32(0x85EBCA6B)
    out = np.empty((len(at), 2), np.int32)
    out[:, 0] = mixed(here * np.uint32(0x9E3779B1) + tail, bits)
    out[:, 1] = mixed((before * np.uint32(0xC2B2AE35) ^ here * np.uint32(0x27D4EB2F)) + tail + np.uint32(1), bits)
    ends = np.cumsum([len(t) + 2 for t in lowered])
    counts = np.diff(np.searchsorted(at, ends), prepend=0)
    return out.ravel(), counts


def slices(texts: list[str | None], size: int = SLICE) -> Iterator[tuple[list[int], list[str]]]:
    """Owners and pieces of the texts, about ``size`` characters at a time. A longer text is
    cut before white space, which no gram reaches over, so its pieces have the grams of
    the whole."""
    owners, pieces, total = [], [], 0
    for i, text in enumerate(texts):
        start, text = 0, text or ""
        while start < len(text):
            gap = WHITE.search(text, start + size) if start + size < len(text) else None
            end = gap.start() if gap else len(text)
            owners.append(i)
            pieces.append(text[start:end])
            start = end
            total += len(pieces[-1])
            if total >= size:
                yield owners, pieces
                owners, pieces, total = [], [], 0
    if pieces:
        yield owners, pieces


@dataclass
class Model:
    langs: list[str]
    bits: int
    log_prior: np.ndarray
    log_prob: np.ndarray  # (languages, buckets)

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        n, k = len(texts), len(self.langs)
        total, found = np.zeros((n, k)), np.zeros(n, np.int64)
        for owners, pieces in slices(texts):
            ids, counts = grams(pieces, self.bits)
            full = np.flatnonzero(counts)
            if not len(full):
                continue
            starts = 2 * (np.cumsum(counts) - counts)[full]
            own = np.array(owners)[full]
            np.add.at(found, own, counts[full])
            for j in range(k):
                sums = np.add.reduceat(self.log_prob[j][ids], starts, dtype=np.float64)
                np.add.at(total[:, j], own, sums)
        if not k:
            return [UNKNOWN] * n, np.zeros(n)
        total += self.log_prior
        best = total.argmax(axis=1)
        share = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.langs[b] if f else UNKNOWN for b, f in zip(best, found)], np.where(found > 0, share, 0.0)


def gram_counts(docs: DataFrame, bits: int) -> DataFrame:
    """(lang, bucket, n) over all rows with a label; bucket -1 counts documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            texts = batch.column(0).to_pylist()
            for lang in sorted(set(langs)):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                counts = tables.setdefault(lang, np.zeros((1 << bits) + 1, np.int64))
                counts[-1] += len(own)
                for _, pieces in slices(own):
                    counts[:-1] += np.bincount(grams(pieces, bits)[0], minlength=1 << bits)
        for lang, counts in tables.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(np.where(at == 1 << bits, -1, at), pa.int32()),
                 pa.array(counts[at])], ["lang", "bucket", "n"])
    return (docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
            .mapInArrow(count, "lang string, bucket int, n bigint")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def bucket_bits(n_langs: int, bits: int = BITS) -> int:
    while bits > 8 and n_langs * 4 << bits > MATRIX_BYTES:
        bits -= 1
    if n_langs * 4 << bits > MATRIX_BYTES:
        raise ValueError(f"{n_langs} languages: more than the matrix bound of {MATRIX_BYTES} bytes allows")
    return bits


def train(docs: DataFrame, bits: int = BITS, smoothing: float = SMOOTHING) -> Model:
    """``docs`` (text, lang): every row with a label and a text is learned from."""
    counted = C.written(gram_counts(docs, bits), "gram-counts")
    langs = [r.lang for r in counted.filter("bucket = -1").select("lang").orderBy("lang")
             .limit((MATRIX_BYTES >> 10) + 1).collect()]
    fewer = bits - bucket_bits(len(langs), bits)
    # at most languages x buckets rows, which the matrix bound limits
    rows = (counted.withColumn("bucket", F.expr(f"if(bucket < 0, bucket, shiftright(bucket, {fewer}))"))
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    bits -= fewer
    place = {lang: i for i, lang in enumerate(langs)}
    counts, docs_of = np.zeros((len(langs), 1 << bits)), np.zeros(len(langs))
    who = np.array([place[x] for x in rows["lang"].to_pylist()], np.int64)
    where, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    counts[who[where >= 0], where[where >= 0]] = n[where >= 0]
    docs_of[who[where < 0]] = n[where < 0]
    seen = counts.sum(axis=1) > 0
    counts, docs_of = counts[seen], docs_of[seen]
    log_prob = np.log((counts + smoothing) / (counts.sum(axis=1, keepdims=True) + smoothing * counts.shape[1]))
    return Model([x for x, s in zip(langs, seen) if s], bits, np.log(docs_of / max(docs_of.sum(), 1)),
                 log_prob.astype(np.float32))


def predict(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Column of struct<lang, score> over ``docs``; the model is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            langs, shares = shared.value.score(batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(shares)], ["lang", "score"])
    return score(F.col(text))
