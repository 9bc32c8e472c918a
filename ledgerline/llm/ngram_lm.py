"""Language-model scoring by deleted interpolation of bigram, unigram and uniform.

Tokens are words (A-Z as a-z) and an end after each text. The model is

    P(w | u) = l2 c(u, w) / c(u) + l1 c(w) / N + l0 / (V + 1)

with weights l per bucket of the context's frequency, floor(log2 c(u)). They are
learned by expectation-maximisation on held-out counts: a share of the training
documents is left out of the counts, and the weights make what they hold most
likely. Scores then use the counts of all training documents.

Scale. Documents are dealt into blocks of about ``BLOCK_CHARS`` characters by a
hash. A block's distinct words and word pairs leave its task once, as 64-bit
hashes in sorted, delta-coded runs with counts, dealt by ranges of the hash; so
a frequent word costs one entry per block, and no range is hotter than another.
Each range is summed over the blocks, the sums go back to the blocks that asked,
and a block scores its texts with them. Everything grows with the input; the
driver gets totals and a histogram whose cells are bounded (``STEPS`` steps per
octave of either probability). Equal hashes of different words or pairs would be
counted as one (2^63 values).

Defined results: a null text is empty; an empty text is the end token alone;
without training documents every score is 0 (V = 0: the uniform share is 1);
if no training document falls to the held-out share (few documents, or one copied
text), every token is held out of the other tokens' counts instead (leave one out);
a null id is a training document; repeated rows count each time and get equal
scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as C

BLOCK_CHARS = 12_000_000
DEV_SHARE = 20            # one in so many training documents is held out for the weights
BUCKETS = 40
STEPS = 8
ROUNDS = 60
END, PAIR_SALT = b"\n", 0x9E3779B97F4A7C15  # a word has no line feed
LEAST_UNIFORM = 1e-6


def block_tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes (even numbers), each token's word, each token's context word (of a
    first token: the end), tokens per text."""
    places: dict[bytes, int] = {END: 0}
    tokens, lengths = [], []
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        tokens.append(np.fromiter((places.setdefault(w, len(places)) for w in words), np.int32, len(words)))
        tokens.append(np.zeros(1, np.int32))
        lengths.append(len(words) + 1)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in places], np.uint64) & ~np.uint64(1)
    tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
    # what stands before a first word is the end of the text before it
    context = np.concatenate([[0], tokens[:-1]]).astype(np.int32) if len(tokens) else tokens
    return hashes, tokens, context, np.array(lengths, np.int64)


@dataclass
class Keys:
    """A block's distinct words and pairs, in one ascending list of hashes."""
    hashes: np.ndarray
    word_at: np.ndarray      # place of each local word in ``hashes``
    pair_at: np.ndarray      # place of each token's pair
    tokens: np.ndarray
    context: np.ndarray
    lengths: np.ndarray


def block_keys(texts: list[str | None]) -> Keys:
    words, tokens, context, lengths = block_tokens(texts)
    mixed = words[context] * np.uint64(PAIR_SALT)
    mixed = ((mixed << np.uint64(29)) | (mixed >> np.uint64(35))) ^ words[tokens]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    pairs, pair_of = np.unique((mixed ^ (mixed >> np.uint64(32))) | np.uint64(1), return_inverse=True)
    both = np.concatenate([words, pairs])
    order = np.argsort(both)
    place = np.empty(len(both), np.int64)
    place[order] = np.arange(len(both))
    return Keys(both[order], place[: len(words)], place[len(words):][pair_of], tokens, context, lengths)


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as the largest needs."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    part = np.frombuffer(raw, np.uint8).reshape(n, -1)
    out[:, : part.shape[1]] = part
    return out.view("<u8").ravel()


ASK = "block bigint, part int, n int, hashes binary, counts binary"
ANSWER = "block bigint, part int, n int, counts binary, kept binary, words bigint, tokens bigint, kept_words bigint, kept_tokens bigint"


def asked(blocks: DataFrame, n_parts: int) -> DataFrame:
    """Per block and range of hashes: the block's distinct hashes there and how often
    they occur in its training documents."""
    def ask(table: pa.Table) -> pa.Table:
        keys = block_keys(table["text"].to_pylist())
        train = np.repeat(np.asarray(table["train"].to_numpy(), bool), keys.lengths)
        counts = np.bincount(keys.word_at[keys.tokens[train]], minlength=len(keys.hashes))
        counts += np.bincount(keys.pair_at[train], minlength=len(keys.hashes))
        part = ranges(keys.hashes, n_parts)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        rows = []
        for a, b in zip(starts, np.append(starts[1:], len(part))):
            run = keys.hashes[a:b]
            rows.append((int(part[a]), b - a, run[:1].tobytes() + packed(np.diff(run)), packed(counts[a:b])))
        cols = list(zip(*rows))
        return pa.table([pa.array([table["block"][0].as_py()] * len(rows), pa.int64()), pa.array(cols[0], pa.int32()),
                         pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                        names=["block", "part", "n", "hashes", "counts"])
    return blocks.select("block", "train", "text").groupBy("block").applyInArrow(ask, ASK)


def ranges(hashes: np.ndarray, n_parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) * np.uint64(n_parts) >> np.uint64(31)).astype(np.int64)


def answered(asks: DataFrame, first_dev: int) -> DataFrame:
    """Per block and range: the corpus counts of the hashes that it asked for. Blocks
    from ``first_dev`` on are the held-out ones; they also get the counts without
    themselves (``kept``). A row of block -1 has the range's totals."""
    def answer(table: pa.Table) -> pa.Table:
        blocks, sizes = table["block"].to_pylist(), table["n"].to_pylist()
        hashes, counts = [], []
        for raw, own, n in zip(table["hashes"].to_pylist(), table["counts"].to_pylist(), sizes):
            steps = np.frombuffer(raw[:8], "<u8")
            hashes.append(np.cumsum(np.append(steps, unpacked(raw[8:], n - 1)) if n > 1 else steps, dtype=np.uint64))
            counts.append(unpacked(own, n).astype(np.int64))
        distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.concatenate(counts)
        dev = np.repeat(np.array(blocks) >= first_dev, sizes)
        total, kept = (np.bincount(at[m], weights=counts[m], minlength=len(distinct)).astype(np.int64)
                       for m in (slice(None), ~dev))
        word = (distinct & np.uint64(1)) == 0
        rows, done = [], 0
        for block, n in zip(blocks, sizes):
            own, done = at[done:done + n], done + n
            rows.append((block, n, packed(total[own]), packed(kept[own]) if block >= first_dev else None, 0, 0, 0, 0))
        rows.append((-1, 0, None, None, int((total[word] > 0).sum()), int(total[word].sum()),
                     int((kept[word] > 0).sum()), int(kept[word].sum())))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()] + [pa.int64()] * 4
        block, n, counts, kept, *totals = (pa.array(c, k) for c, k in zip(zip(*rows), kinds))
        part = pa.array([table["part"][0].as_py()] * len(rows), pa.int32())
        return pa.table([block, part, n, counts, kept, *totals],
                        names=["block", "part", "n", "counts", "kept", "words", "tokens", "kept_words", "kept_tokens"])
    return asks.groupBy("part").applyInArrow(answer, ANSWER)


def of_block(answers: pa.Table, column: str) -> np.ndarray:
    """A block's answers, in the order of its hashes."""
    rows = sorted(zip(answers["part"].to_pylist(), answers["n"].to_pylist(), answers[column].to_pylist()), key=lambda r: r[0])
    return np.concatenate([unpacked(raw, n) for _, n, raw in rows]).astype(np.float64)


@dataclass
class Totals:
    words: int
    tokens: int
    kept_words: int
    kept_tokens: int


def estimates(keys: Keys, counts: np.ndarray, n_tokens: int, without: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token: its count, the context's bucket, and the maximum-likelihood bigram
    and unigram probabilities. The context of a first token is the end, which occurs
    once per training text. ``without`` 1: as if the token itself had not been counted."""
    of_word = counts[keys.word_at]
    own, before = np.maximum(of_word[keys.tokens] - without, 0), np.maximum(of_word[keys.context] - without, 0)
    pair, n_tokens = np.maximum(counts[keys.pair_at] - without, 0), n_tokens - without
    bigram = np.divide(pair, before, out=np.zeros(len(own)), where=before > 0)
    bucket = np.minimum(np.log2(np.maximum(before, 0.5)).astype(np.int64) + 1, BUCKETS - 1)  # 0: unseen context
    bucket[before == 0] = 0
    return own, bucket, bigram, own / max(n_tokens, 1)


def histogram(dev: DataFrame, answers: DataFrame, column: str, n_tokens: int, without: int = 0) -> DataFrame:
    """Held-out tokens by context bucket and by either probability, on a log scale
    (-1: zero): bucket, p2, p1, n. ``column``: of the counts."""
    def step(p: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.where(p > 0, np.round(-np.log2(p) * STEPS), -1).astype(np.int32)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], pa.int32())] * 3 + [pa.array([], pa.int64())], names=["bucket", "p2", "p1", "n"])
        train = np.asarray(left["train"].to_numpy(), bool)
        keys = block_keys(left["text"].to_pylist())
        _, bucket, bigram, unigram = estimates(keys, of_block(right, column), n_tokens, without)
        cells = np.stack([bucket.astype(np.int32), step(bigram), step(unigram)], axis=1)[np.repeat(train, keys.lengths)]
        cells, n = np.unique(cells, axis=0, return_counts=True)
        return pa.table([pa.array(c, pa.int32()) for c in cells.reshape(-1, 3).T] + [pa.array(n, pa.int64())],
                        names=["bucket", "p2", "p1", "n"])
    return (dev.select("block", "train", "text").groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(count, "bucket int, p2 int, p1 int, n bigint")
            .groupBy("bucket", "p2", "p1").agg(F.sum("n").alias("n")))


def learn_weights(bucket: np.ndarray, p2: np.ndarray, p1: np.ndarray, n: np.ndarray, uniform: float,
                  rounds: int = ROUNDS) -> np.ndarray:
    """(BUCKETS, 3) weights of bigram, unigram and uniform by expectation-maximisation;
    a bucket without held-out tokens gets those of the nearest one with some."""
    p = np.stack([p2, p1, np.full(len(n), uniform)], axis=1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    if not len(n) or not p1.any():
        weights[:] = 0, 0, 1
        return weights
    for _ in range(rounds):
        share = weights[bucket] * p
        share *= (n / share.sum(axis=1))[:, None]
        mass = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], axis=1)
        seen = mass.sum(axis=1) > 0
        weights[seen] = mass[seen] / mass[seen].sum(axis=1, keepdims=True)
    known = np.flatnonzero(seen & (np.arange(BUCKETS) > 0))
    for b in range(1, BUCKETS):
        if not seen[b] and len(known):
            weights[b] = weights[known[np.abs(known - b).argmin()]]
    weights = np.maximum(weights, [0, 0, LEAST_UNIFORM])
    return weights / weights.sum(axis=1, keepdims=True)


RESULT = ("doc_id bigint, tag bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def scored(blocks: DataFrame, answers: DataFrame, totals: Totals, weights: np.ndarray) -> DataFrame:
    uniform = 1 / (totals.words + 1)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in RESULT.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.float64()] * 2
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        keys = block_keys(left["text"].to_pylist())
        own, bucket, bigram, unigram = estimates(keys, of_block(right, "counts"), totals.tokens)
        w = weights[bucket]
        p = w[:, 0] * bigram + w[:, 1] * unigram + w[:, 2] * uniform
        base = np.log10((own + 0.5) / (totals.tokens + 0.5 * (totals.words + 1)))
        starts = np.cumsum(keys.lengths) - keys.lengths
        per = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every text has its end token
        return pa.table([left["doc_id"].combine_chunks(), left["tag"].combine_chunks(), pa.array(keys.lengths),
                         pa.array(per((own > 0).astype(np.int64))),
                         pa.array(np.full(len(starts), totals.tokens, np.int64)), pa.array(per(base)),
                         pa.array(per(np.log10(p)))], names=names)
    return (blocks.select("block", "doc_id", "tag", "text").groupBy("block")
            .cogroup(answers.select("block", "part", "n", "counts").groupBy("block")).applyInArrow(score, RESULT))


def score(docs: DataFrame, train: Column, tag: Column, block_chars: int = BLOCK_CHARS, dev_share: int = DEV_SHARE) -> DataFrame:
    """Scores of all ``docs`` (doc_id, text): columns of ``RESULT``. ``train``: which rows
    the counts and weights are learned from; ``tag``: a number to carry along."""
    rows = docs.select("doc_id", C.text_or_empty().alias("text"), train.alias("train"), tag.cast("bigint").alias("tag"))
    chars = rows.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n_blocks = max(1, math.ceil(chars / block_chars))
    n_dev = max(1, math.ceil(n_blocks / dev_share))
    deal = F.xxhash64("doc_id", "text")
    held = F.col("train") & (F.pmod(deal, F.lit(dev_share)) == 0)
    spread = F.xxhash64(deal)
    blocks = rows.withColumn("block", F.when(held, F.lit(n_blocks) + F.pmod(spread, F.lit(n_dev)))
                             .otherwise(F.pmod(spread, F.lit(n_blocks))).cast("bigint"))
    answers = C.written(answered(asked(blocks, n_blocks), n_blocks), "ngram-counts")
    sums = answers.filter("block = -1").agg(*[F.sum(c) for c in ("words", "tokens", "kept_words", "kept_tokens")]).first()
    totals = Totals(*[int(x or 0) for x in sums])
    answers = answers.filter("block >= 0")
    dev = histogram(blocks.filter(F.col("block") >= n_blocks), answers.filter(F.col("block") >= n_blocks),
                    "kept", totals.kept_tokens).toArrow()
    words = totals.kept_words
    if not dev.num_rows:   # no training row fell to the held-out share: each token is held out of the others
        dev, words = histogram(blocks, answers, "counts", totals.tokens, without=1).toArrow(), totals.words
    at = lambda c: np.where(dev[c].to_numpy() < 0, 0.0, 2.0 ** (-dev[c].to_numpy() / STEPS))
    weights = learn_weights(dev["bucket"].to_numpy(), at("p2"), at("p1"), dev["n"].to_numpy().astype(float), 1 / (words + 1))
    return scored(blocks, answers, totals, weights)
