"""Phrase collocations from a weighted de Bruijn graph of words.

The graph of a language: nodes are 3 words, edges the 4-word windows that lead from
one node to the next, weighted by how often they occur. Every word occurrence starts
one window; where its piece ends sooner the window is shorter, and stands in the
counts as a piece end. A phrase of k words then occurs as often as the windows that
start with it: what flows out of it over longer edges, plus the ends of k words.
Counts of 3, 2 and 1 words are so derived in turn from those of one word more. (What
most words in a corpus lead to is rare. A window therefore also ends behind a word that
the next one follows fewer than ``least`` times: no frequent phrase goes on
there, and the occurrences count as ends.)

Frequent edges are compacted: a node with one frequent edge in and one out is no
place where a phrase could end, so edges are strung over such nodes to paths (by
pointer doubling). A path holds each shorter phrase once, with the most frequent of
the edges around it, for the rule that drops what lies in a longer phrase.

Scale: three passes over counts, two over texts. The first counts pairs of words
by 64-bit hashes of fixed width; those that are frequent become a bitmap of
``2 ** BITMAP_BITS`` bits (16 MB, whatever the input), which is what workers get. It can
only let a rare pair through, which costs a longer window, never drop one. Windows are
counted per block of words by numpy before they are shuffled. Text is read in
slices, so a giant text takes no more memory than others. Frequent parts
(a word such as "the" is part of very many phrases) are salted in joins. The first
``most`` of a language are chosen within salts before the rows of a language meet.

Defined results: null texts are empty, a null language is ``und``; nulls in other columns and
extra columns are ignored; repeated rows count again; an empty table gives an empty
result; ties are broken by the phrase's bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm.simhash import connected

ORDER = 4                 # words of the longest phrases
LEAST, INSIDE, MOST = 30, 80, 2000
UNKNOWN = "und"
# --- Fixed values of the contract: what ends a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
# --- end of fixed values
TO_BREAK = bytes.maketrans(PIECE_ENDS, b"\n" * len(PIECE_ENDS))
BLANK = re.compile(rb"[ \t\n]")
BITMAP_BITS = 27
SLICE = 1 << 22           # bytes of text split at a time
BLOCK = 1 << 19           # words counted at a time
VOCABULARY = 1 << 18      # distinct words after which a worker starts a new dictionary
SALTS = 256


class Numbers(dict):
    """Numbers of a language's words; a new word gets the next one of the worker."""

    def __init__(self, lang: str, words: list):
        super().__init__()
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append((self.lang, word))
        return number


def slices(text: bytes) -> Iterator[bytes]:
    """A text in slices that end at a blank or line end (a word is never cut)."""
    start = 0
    while len(text) - start > SLICE:
        end = BLANK.search(text, start + SLICE)
        cut = end.start() if end else len(text)
        yield text[start:cut]
        start = cut
    yield text[start:]


class Blocks:
    """Word numbers of a stream of texts, -1 behind each piece, in blocks: (numbers, fresh, last).
    A block ends with the words that windows of those before need; ``fresh`` of its numbers start
    windows. After a ``last`` block the numbers mean other words, or there is no more."""

    def __init__(self, ahead: int):
        self.ahead, self.words, self.tables, self.hashes = ahead, [], {}, np.zeros(0, np.uint64)

    def of(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int, bool]]:
        out: list[int] = []
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                whole = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().translate(TO_BREAK)
                lang = lang.as_py()
                for part in slices(whole):
                    lines = part.split(b"\n")
                    number = self.table(lang).__getitem__
                    out.extend(map(number, lines[0].split()))
                    for piece in lines[1:]:
                        out.append(-1)
                        out.extend(map(number, piece.split()))
                    if len(out) > BLOCK:
                        yield np.array(out, np.int64), len(out) - self.ahead, len(self.words) > VOCABULARY
                        out = self.kept(out[-self.ahead:])
                out.append(-1)
        yield np.array(out + [-1] * self.ahead, np.int64), len(out), True

    def table(self, lang: str) -> Numbers:
        if lang not in self.tables:
            self.tables[lang] = Numbers(lang, self.words)
        return self.tables[lang]

    def kept(self, tail: list[int]) -> list[int]:
        """The tail of a block, in a new dictionary if the old one has grown large."""
        if len(self.words) <= VOCABULARY:
            return tail
        named = [None if i < 0 else self.words[i] for i in tail]
        self.words, self.tables, self.hashes = [], {}, np.zeros(0, np.uint64)
        return [-1 if w is None else self.table(w[0])[w[1]] for w in named]

    def pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each number but the last: whether it and the next are a pair, and the pair's hash."""
        new = self.words[len(self.hashes):]
        self.hashes = np.append(self.hashes, np.array(
            [xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass") + b"\0" + w) for lang, w in new], np.uint64))
        of_ids = self.hashes[ids] if len(self.hashes) else np.zeros(len(ids), np.uint64)
        mixed = of_ids[:-1] * np.uint64(0x9E3779B97F4A7C15) + of_ids[1:]
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return (ids[:-1] >= 0) & (ids[1:] >= 0), mixed ^ mixed >> np.uint64(29)


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))


def frequent_pairs(docs: DataFrame, least: int) -> bytes:
    """Bitmap of the hashes' upper bits of all pairs of words that follow each other ``least`` times."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(1)
        for ids, _, _ in blocks.of(batches):
            met, hashes = blocks.pairs(ids)
            keys, n = np.unique(hashes[met], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["pair", "n"])
    often = (texts_of(docs).mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= least).select(F.shiftrightunsigned("pair", 64 - BITMAP_BITS).alias("bit")))
    parts = often.groupBy(F.shiftright("bit", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("bit").bitwiseAND(32767)).alias("bits"))
    bitmap = np.zeros((1 << (BITMAP_BITS - 15), 4096), np.uint8)
    for r in parts.toLocalIterator():   # at most so many parts of 4 KB
        bitmap[r.part] = np.frombuffer(r.bits, np.uint8)
    return bitmap.tobytes()


def windows(docs: DataFrame, least: int) -> DataFrame:
    """Written: (lang, gram, k, n), the windows of up to ``ORDER`` words (space-joined) and how often
    they occur; those of fewer words end with a piece or before a rare pair."""
    bitmap = docs.sparkSession.sparkContext.broadcast(frequent_pairs(docs, least))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return counted(batches, bitmap.value)
    found = texts_of(docs).mapInArrow(count, "lang string, gram string, k int, n bigint")
    return C.written(found.groupBy("lang", "gram", "k").agg(F.sum("n").alias("n")), "word-windows")


def counted(batches: Iterator[pa.RecordBatch], bitmap: bytes) -> Iterator[pa.RecordBatch]:
    """The windows of (text, lang), counted per block, and those of one word (most of them) per dictionary."""
    blocks, often = Blocks(ORDER - 1), np.frombuffer(bitmap, np.uint8)
    alone = np.zeros(0, np.int64)
    for ids, fresh, last in blocks.of(batches):
        met, hashes = blocks.pairs(ids)
        bit = (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
        met &= (often[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
        met = np.append(met, [False] * ORDER)
        at = np.flatnonzero(ids[:fresh] >= 0)
        width, codes = len(blocks.words), ids[at]
        alone = np.append(alone, np.zeros(width - len(alone), np.int64))
        alone += np.bincount(codes[~met[at]], minlength=width)
        at = at[met[at]]
        codes = ids[at]
        for k in range(2, ORDER + 1):
            # ``codes``: the first k words of the windows at ``at``, as one number
            keys, place, codes = np.unique(codes * width + ids[at + k - 1], return_index=True, return_inverse=True)
            on = met[at + k - 1] if k < ORDER else np.zeros(len(at), bool)
            n = np.bincount(codes[~on], minlength=len(keys))
            ends = np.flatnonzero(n)
            if len(ends):
                yield named(blocks.words, ids[at[place[ends]][:, None] + np.arange(k)], n[ends])
            at, codes = at[on], codes[on]
        if last:
            found = np.flatnonzero(alone)
            if len(found):
                yield named(blocks.words, found[:, None], alone[found])
            alone = np.zeros(0, np.int64)


def named(words: list, grams: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows of windows, given as word numbers; all words of one are of one language."""
    texts = [b" ".join([words[i][1] for i in gram]) for gram in grams.tolist()]
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i][0] for i in grams[:, 0].tolist()], pa.string()), pa.array(texts, pa.binary()).cast(pa.string()),
         pa.array(np.full(len(n), grams.shape[1], np.int32)), pa.array(n.astype(np.int64))], ["lang", "gram", "k", "n"])


def first_words(c: str, k: int) -> Column:
    return F.substring_index(c, " ", k)


def flows(edges: DataFrame) -> list[DataFrame]:
    """For 1 to ``ORDER`` words: (lang, phrase, f). f of k words is what flows on over k + 1 words plus
    the windows that end there."""
    ended = lambda k: edges.filter(F.col("k") == k).select("lang", F.col("gram").alias("phrase"), F.col("n").alias("f"))
    out = [ended(ORDER)]
    for k in range(ORDER - 1, 0, -1):
        on = out[-1].select("lang", first_words("phrase", k).alias("phrase"), "f")
        out.append(on.unionByName(ended(k)).groupBy("lang", "phrase").agg(F.sum("f").alias("f")))
    return out[::-1]


# --- unary paths -----------------------------------------------------------------------------

def compact(edges: DataFrame) -> DataFrame:
    """Paths of ``edges`` (lang, phrase of ``ORDER`` words, f): lang, words (array), weights (of each
    edge, one for every ``ORDER`` words in a row). Every edge is in one path. A ring is cut."""
    spark = edges.sparkSession
    numbered = C.written(edges.select(
        F.monotonically_increasing_id().alias("id"), "lang", "phrase", "f", first_words("phrase", ORDER - 1).alias("head"),
        F.substring_index("phrase", " ", -(ORDER - 1)).alias("tail")), "edges")
    ways_in = numbered.groupBy("lang", F.col("tail").alias("node")).agg(F.count(F.lit(1)).alias("n_in"), F.min("id").alias("before"))
    ways_out = numbered.groupBy("lang", F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("n_out"), F.min("id").alias("id"))
    unary = (ways_in.join(ways_out, ["lang", "node"]).filter("n_in = 1 AND n_out = 1 AND before != id").select("id", "before"))
    unary = C.written(unary, "unary-nodes")
    ranked, rings = ranks(numbered.select("id"), unary)
    if rings is not None:
        low = connected(rings.select(F.least("id", "before").alias("a"), F.greatest("id", "before").alias("b")).distinct())
        least = low.select(F.col("root").alias("id")).distinct()
        cut = rings.join(least, "id", "left_anti")
        ranked = ranked.unionByName(ranks(rings.select("id"), cut)[0])
    placed = numbered.join(ranked, "id").select("lang", "phrase", "f", "start", "at")
    gathered = placed.groupBy("lang", "start").agg(F.array_sort(F.collect_list(F.struct("at", "phrase", "f"))).alias("edges"))
    last = F.transform("edges", lambda e: F.substring_index(e["phrase"], " ", -1))
    words = F.concat(F.split(F.col("edges")[0]["phrase"], " "), F.slice(last, F.lit(2), F.size("edges")))
    return C.written(gathered.select("lang", words.alias("words"), F.transform("edges", lambda e: e["f"]).alias("weights")), "paths")


def ranks(ids: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(id, start, at) of the ids in chains, the start being the one that nothing is before, by pointer
    doubling; and the links (id, before) of rings, None if there are none. ``before``: (id, before)."""
    state = C.written(ids.join(before, "id", "left").select(
        "id", F.coalesce("before", "id").alias("start"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("bigint").alias("at"),
        F.col("before").isNotNull().alias("open")), "ranks")
    left = state.filter("open").count()
    while left:
        # an open row's pointer is its own, so no row of this join is hot
        to = state.select(F.col("id").alias("i"), F.col("start").alias("s"), F.col("at").alias("t"), F.col("open").alias("o"))
        moved = state.filter("open").join(to, F.col("start") == F.col("i")).select(
            "id", F.col("s").alias("start"), (F.col("at") + F.col("t")).alias("at"), F.col("o").alias("open"))
        state = C.written(state.filter("NOT open").unionByName(moved), "ranks")
        now = state.filter("open").count()
        if now == left:  # a chain that is not done has rows that this round finished
            return state.filter("NOT open").select("id", "start", "at"), before.join(state.filter("open").select("id"), "id", "left_semi")
        left = now
    return state.select("id", "start", "at"), None


def within_paths(paths: DataFrame) -> DataFrame:
    """(lang, phrase, f): the phrases of 2 to ``ORDER`` - 1 words inside edges of ``paths``, each once a
    path and place, with the largest weight of the edges that hold it there."""
    def at(k: int) -> Column:
        # the phrase of k words at i (from 0) is in the edges i - (ORDER - k) to i
        low = lambda i: F.greatest(F.lit(0), i - (ORDER - k))
        high = lambda i: F.least(F.size("weights") - 1, i)
        return F.transform(F.sequence(F.lit(0), F.size("words") - k), lambda i: F.struct(
            F.array_join(F.slice("words", i + 1, k), " ").alias("phrase"),
            F.array_max(F.slice("weights", low(i) + 1, high(i) - low(i) + 1)).alias("f")))
    return paths.select("lang", F.inline(F.concat(*[at(k) for k in range(2, ORDER)])))


# --- candidates ------------------------------------------------------------------------------

@dataclass
class Graph:
    """phrases: written (lang, phrase, k, f) of the frequent ones; totals: (lang, n); paths."""
    phrases: DataFrame
    totals: DataFrame
    paths: DataFrame


def graph(docs: DataFrame, least: int = LEAST) -> Graph:
    edges = windows(docs, least)
    levels = [level.filter(F.col("f") >= least).select("lang", "phrase", F.lit(k + 1).alias("k"), "f")
              for k, level in enumerate(flows(edges))]
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    phrases = C.written(phrases, "frequent-phrases")
    totals = edges.groupBy("lang").agg(F.sum("n").alias("n"))
    return Graph(phrases, totals, compact(phrases.filter(F.col("k") == ORDER)))


def with_count(rows: DataFrame, counts: DataFrame, part: str, name: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` with ``name``: the count of their phrase ``part`` (hot parts are salted)."""
    keyed = rows.withColumn("key", F.struct("lang", F.col(part).alias("phrase")))
    of = counts.select(F.struct("lang", "phrase").alias("of_key"), F.col("f").alias(name))
    return C.join_split(keyed, of, "key", "of_key", total, how).drop("key", "of_key")


def scored(found: Graph, inside: int = INSIDE) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that are not inside a longer one."""
    phrases = found.phrases
    candidates = phrases.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.expr("substring_index(phrase, ' ', cut)").alias("first"),
        F.expr("substring_index(phrase, ' ', cut - k)").alias("rest"))
    total = cuts.count()
    cuts = with_count(with_count(cuts, phrases, "first", "l", total), phrases, "rest", "r", total)
    score = F.expr("CAST(2000000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(19,0)) div (CAST(l AS DECIMAL(20,0)) + r)")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
    # inside phrases of ORDER words: from the paths; inside shorter ones: from these
    short = phrases.filter(f"k > 2 AND k < {ORDER}").select("lang", "f", F.split("phrase", " ").alias("w"))
    parts = short.select("lang", "f", F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " "))))).alias("phrase"))
    longer = within_paths(found.paths).unionByName(parts.select("lang", "phrase", "f")).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    kept = best.join(longer, ["lang", "phrase"], "left")
    return kept.filter(F.expr(f"f IS NULL OR CAST(100 AS DECIMAL(38,0)) * f < CAST({inside} AS DECIMAL(38,0)) * a")).drop("f")


def collocations(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, most: int = MOST) -> DataFrame:
    """Each language's first ``most`` phrases: lang, rank, phrase, a, l, r, n, score."""
    found = graph(docs, least)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = scored(found, inside).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for by in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= most)
    return (salted.join(found.totals, "lang")
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def passages(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The compacted paths themselves, phrases of any length: lang, phrase, n_words, fewest and
    most (weights of its edges)."""
    return graph(docs, least).paths.select("lang", F.array_join("words", " ").alias("phrase"), F.size("words").alias("n_words"),
                                           F.array_min("weights").alias("fewest"), F.array_max("weights").alias("most"))
