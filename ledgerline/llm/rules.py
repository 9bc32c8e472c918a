"""Quality rules as a short-circuit cascade.

Each document gets its base measures (words, word characters, symbols, repeated
lines, words in repeated three-word windows) and the base verdict. Documents
that pass it run through the cascade of rules until the first that rejects
them. Rules are ordered by rejections per second, both estimated on a sample
spread over the whole table; the order decides how much is computed, never the
verdict, as a document is kept if no rule rejects it.

Scale: a scan without a shuffle; the sample (about ``SAMPLE`` rows by a hash of
the id) is measured where it lies and only sums per rule are gathered.

Defined results: a null text has no words, so it fails the base; so does an
empty one; texts of any length are handled whole; repeated rows get equal
results; an empty table gives an empty result (rules then keep their order);
other columns of the input pass through (the result is one struct column).
"""

from __future__ import annotations

import functools
import time
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as C

SAMPLE = 1000
MIN_WORDS = 50
RESULT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, rejected_by string")


class Text:
    """What rules look at; everything is computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @functools.cached_property
    def words(self) -> list[bytes]:
        # bytes.split() cuts at \x20 and \x09-\x0D and nowhere else
        return self.text.encode("utf-8", "surrogatepass").split()

    @functools.cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, " \t\n\v\f\r"))

    @functools.cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, C.SYMBOLS))

    @functools.cached_property
    def lines(self) -> list[bytes]:
        """Lines that have a word."""
        return [x for x in self.text.encode("utf-8", "surrogatepass").split(b"\n") if x.split(None, 1)]

    @functools.cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @functools.cached_property
    def word_ids(self) -> np.ndarray:
        ids: dict[bytes, int] = {}
        return np.array([ids.setdefault(w, len(ids)) for w in self.words], np.int64)

    @functools.cached_property
    def n_repeat_words(self) -> int:
        ids = self.word_ids
        if len(ids) < 4:
            return 0
        n = int(ids.max()) + 1
        _, pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
        _, window, times = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
        again = times[window] > 1
        covered = np.zeros(len(ids), bool)
        for k in range(3):
            covered[k:len(ids) - 2 + k] |= again
        return int(covered.sum())

    @property
    def base_failed(self) -> bool:
        n = len(self.words)
        return n < MIN_WORDS or 100 * self.n_repeat_words > 50 * n


def many_symbols(t: Text) -> bool:
    return 10 * t.n_symbols > len(t.words)


def repeated_lines(t: Text) -> bool:
    return 100 * t.n_dup_lines > 40 * len(t.lines)


def odd_word_length(t: Text) -> bool:
    return not 3 * len(t.words) <= t.word_chars <= 10 * len(t.words)


def few_letters(t: Text) -> bool:
    """Under 80 % of the words hold a letter (any byte above ASCII counts as one)."""
    return 100 * sum(1 for w in t.words if w.upper() != w.lower() or not w.isascii()) < 80 * len(t.words)


def shouting(t: Text) -> bool:
    """Over 30 % of the ASCII letters are capitals."""
    lowered, raised = t.text.lower(), t.text.upper()
    same = np.frombuffer(t.text.encode("ascii", "replace"), np.uint8)
    upper = int(((same >= 65) & (same <= 90)).sum())
    lower = int(((same >= 97) & (same <= 122)).sum())
    return lowered != raised and 100 * upper > 30 * (upper + lower)


def one_word_dominates(t: Text) -> bool:
    """One word makes up over 30 % of all."""
    return 100 * max(Counter(t.words).values(), default=0) > 30 * len(t.words)


def ellipsis_lines(t: Text) -> bool:
    """Over 30 % of the lines end in an ellipsis."""
    return 100 * sum(x.rstrip().endswith((b"...", "…".encode())) for x in t.lines) > 30 * len(t.lines)


def bullet_lines(t: Text) -> bool:
    """Over 90 % of the lines begin with a bullet."""
    return 100 * sum(x.lstrip().startswith((b"- ", b"* ", "•".encode())) for x in t.lines) > 90 * len(t.lines)


def marked_words(t: Text) -> bool:
    """Sentence marks outnumber the words."""
    return sum(map(t.text.count, ".,;:!?")) > len(t.words)


Rule = Callable[[Text], bool]
RULES: dict[str, Rule] = {f.__name__: f for f in (
    many_symbols, repeated_lines, odd_word_length, few_letters, shouting, one_word_dominates, ellipsis_lines,
    bullet_lines, marked_words)}


def measured(docs: DataFrame, rules: dict[str, Rule] = RULES, sample: int = SAMPLE) -> list[tuple[str, float, int]]:
    """(rule, seconds, rejections) summed over about ``sample`` documents that pass the base."""
    step = max(1, docs.count() // sample)
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).select("text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejects = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                t = Text(text)
                if t.base_failed:
                    continue
                for name, rule in rules.items():
                    began = time.perf_counter()
                    rejects[name] += rule(t)
                    seconds[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": list(rules), "seconds": list(seconds.values()),
                                          "rejects": list(rejects.values())})
    rows = (chosen.mapInArrow(measure, "rule string, seconds double, rejects bigint")
            .groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejects").alias("rejects")).collect())
    return [(r.rule, r.seconds, r.rejects) for r in rows]


def cascade(docs: DataFrame, rules: dict[str, Rule] = RULES, sample: int = SAMPLE) -> list[str]:
    """Rule names by rejections per second, best first."""
    gain = {name: rejects / max(seconds, 1e-9) for name, seconds, rejects in measured(docs, rules, sample)}
    place = list(rules).index
    return sorted(rules, key=lambda name: (-gain.get(name, 0.0), place(name)))


def judge(docs: DataFrame, rules: dict[str, Rule] = RULES, sample: int = SAMPLE) -> Column:
    """Column of struct (see ``RESULT``) over ``docs`` (doc_id, text). ``rejected_by`` is the
    first rule that rejected the document; which of several it is depends on the order."""
    order = [(name, rules[name]) for name in cascade(docs, rules, sample)]

    @F.arrow_udf(RESULT)
    def verdict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"]
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.string()]
        for batch in batches:
            rows = []
            for text in batch:
                t = Text(text.as_py())
                failed = t.base_failed
                by = "base" if failed else next((name for name, rule in order if rule(t)), None)
                rows.append((len(t.words), t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, by is None, by))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
    return verdict(F.col("text"))
