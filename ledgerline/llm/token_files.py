"""Token ids in Parquet: one row per document, in ascending order of document id.

``<path>/tokens``: row_no, doc_id, n_tokens, tokens (list of int32). Token lists
are dictionary encoded (a vocabulary fits a dictionary page, so an id takes as
many bits as the row group's distinct ids need); row numbers, ids and lengths,
which have no repeats to speak of, are delta encoded. Small row groups and pages
with page indexes let a reader skip to a few documents, or read lengths without
touching a token. ``<path>/index``: row_no, doc_id, n_tokens and ``start``, the
number of ids of all documents before.

Scale: documents are dealt into ranges of their id and sorted inside each; every
range is one file, tokenised where it is written. Starts come from the lengths
alone: the sum of the ranges before plus a running sum inside the range. Files
are written by Spark's committer into shared storage, so a lost executor's
partial files never show.

Defined results: a null text is empty, and an empty text is the end id alone; a
null id sorts first; rows with equal ids are in the order of a hash of their texts; strings
of special tokens inside texts are ordinary text; an empty table gives files
without rows; other columns of the input are ignored.
"""

from __future__ import annotations

import array
import functools
import json
import os
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import common as C

END_ID = 2
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 2000
CACHE = 200_000     # pieces remembered by a Python worker
STEP = 4 << 20      # bytes of text encoded together; of a longer text, all
JOINED = 32         # pieces encoded in one call

WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",          # integers without dictionary: delta encoded
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.dictionary.page.size": str(1 << 20),
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("row_no", "doc_id", "n_tokens", "start")},
}

# --- Fixed values: the white space of Unicode (what the tokenizer's ``\s`` matches) other
# than single spaces and line feeds, and Latin letters, whose runs always end a pre-token.
ODD_WHITE = ("  ", "\n\n", " \n", "\n ", *map(chr, (9, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
                                                  0x2029, 0x202F, 0x205F, 0x3000)))
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
# --- end of fixed values
LETTERS = pa.array(re.findall(f"[{LATIN}]", "".join(map(chr, range(0x250)))), pa.large_string())
MARKS = string.punctuation


def id_lists(lists: list[str]) -> pa.Array:
    """Ids that are the characters of strings (so below 0x110000), as little-endian unsigned
    32-bit integers."""
    sizes = np.cumsum([0, *map(len, lists)]) * 4
    ids = "".join(lists).encode("utf-32-le", "surrogatepass")
    return pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(sizes), pa.py_buffer(ids)])


class Encoder:
    """A byte-level BPE tokenizer with a bounded memory of encoded pieces.

    Pre-tokens never reach from a character that isn't white space into white
    space, nor out of a run of letters into punctuation, so a text can be cut
    there. Arrow cuts many texts in one call and numbers their distinct pieces; only
    these are looked up, and those that aren't known encoded, many at a time. The
    pieces met last are remembered, those of the latest call first."""

    def __init__(self, path: str, memory: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.memory = memory
        parts = json.loads(self.tokenizer.to_str())
        before = parts["pre_tokenizer"] or {}
        [self.feed] = self.encode(["\n"])
        # pieces after a space (a line feed stands for itself) without the marks that end a word, and their ids
        self.pieces, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        # what holds for cuts holds for byte-level pre-tokens of unchanged text; else texts are encoded whole
        self.cuts = (parts["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"]
                     and not before["add_prefix_space"] and len(self.feed) == 1)

    def encode(self, texts: list[str]) -> list[str]:
        """Each text's ids as characters: a string is short in memory, and split and joined fast."""
        # one a call: what the library returns of a text is many times its size
        found = (self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids for t in texts)
        return [array.array("I", ids).tobytes().decode("utf-32-le", "surrogatepass") for ids in found]

    def encode_joined(self, pieces: list[str]) -> list[str]:
        """Pieces without line feeds, many in one call: a line feed between two pieces is
        a token of its own."""
        return [ids for many in self.encode(["\n".join(pieces[i:i + JOINED]) for i in range(0, len(pieces), JOINED)])
                for ids in many.split(self.feed)]

    def look_up(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces; those not known are encoded, and all remembered."""
        at = pc.index_in(pieces, value_set=self.pieces)
        unknown = at.is_null()
        new = pieces.filter(unknown).to_numpy(zero_copy_only=False).tolist()
        bare = [p[1:] if p[0] == "\n" else " " + p for p in new]
        found = iter(self.encode_joined([b for b in bare if b]))
        learnt = [(self.feed if p[0] == "\n" else "") + (next(found) if b else "") for p, b in zip(new, bare)]
        where = at.fill_null(0).to_numpy().astype("i8")
        where[unknown.to_numpy(zero_copy_only=False)] = len(self.pieces) + np.arange(len(new))
        ids = pa.concat_arrays([self.ids, id_lists(learnt)]).take(pa.array(where))
        unmet = np.ones(len(self.pieces), bool)
        unmet[at.drop_null().to_numpy()] = False
        left = pa.array(np.flatnonzero(unmet)[:max(0, self.memory - len(pieces))])
        self.pieces = pa.concat_arrays([pieces[:self.memory], self.pieces.take(left)])
        self.ids = pa.concat_arrays([ids[:self.memory], self.ids.take(left)])
        return ids

    def piece_ids(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces; marks after a word are encoded by themselves."""
        words = pc.ascii_rtrim(pieces, MARKS)
        lettered = pc.is_in(pc.utf8_slice_codeunits(words, -1), value_set=LETTERS)
        words = pc.if_else(lettered, words, pieces)
        sizes = pc.utf8_length(words)
        marked = pc.not_equal(sizes, pc.utf8_length(pieces))
        words = words.dictionary_encode()
        ends = [p[n:] for p, n in zip(pieces.filter(marked).to_numpy(zero_copy_only=False), sizes.filter(marked).to_numpy())]
        marks = list(dict.fromkeys(ends))
        number = {m: k for k, m in enumerate(marks, 1)}
        after = np.zeros(len(pieces), "i8")
        after[marked.to_numpy(zero_copy_only=False)] = [number[m] for m in ends]
        return pc.binary_join_element_wise(self.look_up(words.dictionary).take(words.indices),
                                           id_lists(["", *self.encode_joined(marks)]).take(pa.array(after)),
                                           pa.scalar(b"", pa.large_binary()))

    def lists(self, texts: list[str], end: str = "") -> pa.ListArray:
        """Each text's ids, then those of ``end``."""
        firsts, rests = [], []
        for text in texts:
            if not self.cuts or not text or text[0] in " \n" or text[-1] == " " or any(x in text for x in ODD_WHITE):
                firsts.append(None)
                rests.append(None)
            else:  # only single spaces and line feeds: every piece but the first follows one of them
                first, space, rest = text.replace("\n", " \n").partition(" ")
                firsts.append(first)
                rests.append(rest if space else None)
        of_firsts = iter(self.encode_joined([f for f in firsts if f is not None]))
        starts = [self.encode([text])[0] if f is None else next(of_firsts) for f, text in zip(firsts, texts)]
        cut = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        pieces = cut.flatten().dictionary_encode()
        distinct = len(pieces.dictionary)
        parts = pa.concat_arrays([self.piece_ids(pieces.dictionary), id_lists([*starts, end])])
        # the parts that a text is made of: its start, its pieces, the end
        at = np.cumsum([0, *(pc.list_value_length(cut).fill_null(0).to_numpy() + 2)])
        order, is_piece = np.empty(at[-1], "i8"), np.ones(at[-1], bool)
        order[at[:-1]], order[at[1:] - 1] = distinct + np.arange(len(texts)), distinct + len(texts)
        is_piece[at[:-1]] = is_piece[at[1:] - 1] = False
        order[is_piece] = pieces.indices.to_numpy()
        found = parts.take(pa.array(order))
        bounds = np.concatenate([[0], np.cumsum(pc.binary_length(found).to_numpy() // 4)])[at]
        ids = np.frombuffer(found.buffers()[2] or b"", "<i4", bounds[-1])
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        return [np.asarray(ids.values, "<i4").tobytes() for ids in self.lists(texts)]


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_lists(path: str, end_id: int = END_ID, text: str = "text") -> Column:
    """array<int> of a text's ids, the end id last; one tokenizer per Python worker."""
    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            # the output is as large as the input: a part at a time
            size = np.cumsum(pc.binary_length(batch).fill_null(0).to_numpy().astype("i8"))
            cuts = np.flatnonzero(np.diff(size // STEP)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                texts = batch.slice(a, b - a).fill_null("").to_numpy(zero_copy_only=False).tolist()
                yield encoder(path).lists(texts, chr(end_id))
            pa.default_memory_pool().release_unused()  # else a worker keeps what its largest part took
    return encode(F.col(text))


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> str:
    """Tokenise ``docs`` (doc_id, text) into ``<path>/tokens`` and ``<path>/index``."""
    spark = docs.sparkSession
    by = ("doc_id", F.xxhash64("text"))  # the second spreads an id that very many rows share
    ordered = docs.select("doc_id", "text").repartitionByRange(*by).sortWithinPartitions(*by, "text")
    rows = (ordered.select("doc_id", token_lists(tokenizer_path, end_id).alias("tokens"))
            .select(F.monotonically_increasing_id().alias("row_no"), "doc_id",
                    F.size("tokens").cast("bigint").alias("n_tokens"), "tokens"))
    rows.write.options(**WRITE_OPTIONS).parquet(f"{path}/tokens")
    lengths = (spark.read.schema(rows.schema).parquet(f"{path}/tokens").select("row_no", "doc_id", "n_tokens")
               # the file's number is in the upper bits of a row number
               .withColumn("part", F.shiftright("row_no", 33)))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (lengths.groupBy("part").agg(F.sum("n_tokens").alias("size"))
             .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("part").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    index = (lengths.withColumn("upto", F.sum("n_tokens").over(inside)).join(parts, "part")
             .select("row_no", "doc_id", "n_tokens", (F.col("base") + F.col("upto") - F.col("n_tokens")).alias("start")))
    index.write.options(**WRITE_OPTIONS).parquet(f"{path}/index")
    return path


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def read_tokens(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """Token rows, or those of a range of ids: row groups and pages outside it are skipped."""
    rows = spark.read.parquet(f"{path}/tokens")
    if first_id is not None:
        rows = rows.filter(F.col("doc_id") >= first_id)
    if last_id is not None:
        rows = rows.filter(F.col("doc_id") <= last_id)
    return rows


@F.arrow_udf(T.LongType())
def ids_crc32(batch: pa.Array) -> pa.Array:
    """Unsigned CRC32 of each list's ids as little-endian unsigned 32-bit integers."""
    raw = memoryview(np.ascontiguousarray(np.asarray(batch.flatten()), "<i4").tobytes())
    at = np.cumsum([0] + batch.value_lengths().to_pylist()) * 4
    return pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())
