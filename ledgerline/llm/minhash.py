"""MinHash near-duplicates: one permutation, densified bins, banded buckets, stars.

A document's set are the hashes of its distinct ``SHINGLE``-word shingles. One
64-bit hash per shingle deals the set into ``BINS`` bins (its upper bits) and gives
each bin its least value (the lower bits): one permutation. An empty bin takes
the value of the full bin that comes first in an order of its own, drawn at random
(optimal densification), so the bins of two sets still agree with a probability
equal to their similarity. ``BAND`` bins in a row are a band, and documents equal
in a band meet in a bucket: at a similarity of 0.85, 32 bands of 8 let 4 pairs in
100,000 pass unseen, at 0.9 fewer than 2 in 100 million.

A bucket's rows are not paired with one another. One of them, that is in most buckets, is
the centre of a star, compared with the others over the full sets; the centre, being done,
leaves, and buckets whose rows are all in one component by now are finished. Stars go on,
with other centres, while they at least halve what is left. What remains are rows
of different components that no star has linked, most of them linked to nothing.
They meet once more in their bucket, in blocks, by 512 bytes each: a bitmap, which
proves that two small sets have too many hashes apart, and the signature, which for
large ones agrees in fewer bins than ``SPREAD`` standard deviations under the bound. The
pairs left are compared over the full sets. So the pairs that leave a task are
those that are similar, not the square of a group.

Scale: copies collapse to one class (equal sets) before anything is compared, and
bucket rows carry a number, not a set. Sets are built again from the texts of those
classes alone that share a bucket. A class in many pairs, or with many copies, is
salted in its joins (``common.join_split``); buckets are joined by sort and merge,
whose skewed partitions adaptive execution splits. Links and stars are written to the
shared folder. The driver gets counts only.

Defined results: A-Z count as a-z; fewer words than a shingle are one shingle; a
text that is null or without words has an empty set, is in a component of its own
and always kept; repeated rows and copies are one class; an id with several texts
is in the classes of them all, and does not link them; rows with a null id take part
in no link and get the component of their class, null if no row with an id has it;
an empty table gives an empty result; other columns are ignored by ``components`` and
kept by ``one_of_each``. Shingles are compared by 64-bit hashes, equal sets by
128-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm.simhash import connected, least_row

SHINGLE = 5
PERCENT = 85          # of the union that two linked sets share
BINS, BAND = 256, 8
BIN_BITS = 8          # BINS == 2 ** BIN_BITS
SEED = 42
BLOCK = 2048          # rows of a bucket compared with as many
SPREAD = 6
SKETCH = "n_shingles bigint, digest binary, bands array<bigint>"


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's distinct shingles, ascending."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(size, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
    digest = xxhash.xxh3_64_intdigest
    hashes = (digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist()))
    return np.unique(np.fromiter(hashes, np.uint64, len(starts)))


# For each bin the order in which it tries the others when it is empty.
_RANDOM = np.random.default_rng(SEED)
ORDER = _RANDOM.permuted(np.tile(np.arange(BINS, dtype=np.int32), (BINS, 1)), axis=1)
MULTIPLIERS = _RANDOM.integers(1, 2 ** 63, (BINS // BAND, BAND), np.uint64) | np.uint64(1)
OFFSETS = _RANDOM.integers(1, 2 ** 63, BINS // BAND, np.uint64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The bins of a non-empty set (ascending hashes)."""
    bins = (hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    full, out = bins[first], np.zeros(BINS, np.uint64)
    out[full] = hashes[first]
    if len(full) < BINS:
        empty = np.ones(BINS, bool)
        empty[full] = False
        at = np.flatnonzero(empty)
        out[at] = out[full[ORDER[at][:, full].argmin(axis=1)]]
    return out


def bands(hashes: np.ndarray) -> np.ndarray:
    """A bucket's number per band."""
    keys = (signature(hashes).reshape(-1, BAND) * MULTIPLIERS).sum(axis=1, dtype=np.uint64) + OFFSETS
    keys = (keys ^ keys >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (keys ^ keys >> np.uint64(32)).view(np.int64)


def sketches(text: str = "text", size: int = SHINGLE) -> Column:
    """Struct of ``SKETCH``; an empty set has no digest and no bands."""
    @F.arrow_udf(f"struct<{SKETCH.replace(' bigint', ': bigint').replace(' binary', ': binary').replace(' array', ': array')}>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            counts, digests, keys = [], [], []
            for t in batch:
                found = shingles(t.as_py(), size)
                counts.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(bands(found) if len(found) else np.zeros(0, np.int64))
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))], ["n_shingles", "digest", "bands"])
    return of(F.col(text))


def sets(text: str = "text", size: int = SHINGLE) -> Column:
    @F.arrow_udf("array<bigint>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([shingles(t.as_py(), size).view(np.int64) for t in batch], pa.list_(pa.int64()))
    return of(F.col(text))


# --- classes, buckets and links ------------------------------------------------------------

def text_hash(text: str = "text") -> Column:
    return F.xxhash64(C.text_or_empty(text))


def sketched(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest, bands: written, one row per row of ``docs``."""
    return C.written(docs.select("doc_id", text_hash().alias("text_hash"), sketches("text", size).alias("s"))
                     .select("doc_id", "text_hash", "s.*"), "minhash-sketches")


def classes_of(prints: DataFrame) -> DataFrame:
    """Written: one row per distinct set that a row with an id has: node (its number),
    digest, rep and rep_hash (least id, and the least hash of its texts), n, bands."""
    found = (prints.filter("doc_id is not null and n_shingles > 0").groupBy("digest")
             .agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("n_shingles").alias("n"),
                  F.first("bands").alias("bands")))
    return C.written(found.select(F.monotonically_increasing_id().alias("node"), "digest", F.col("least.doc_id").alias("rep"),
                                  F.col("least.text_hash").alias("rep_hash"), "n", "bands"), "minhash-classes")


def in_buckets(classes: DataFrame) -> DataFrame:
    """Written: (bucket, band, node, n, component) for buckets of two classes or more."""
    filed = classes.select(F.posexplode("bands").alias("band", "bucket"), "node", "n")
    shared = (filed.groupBy(F.col("bucket").alias("b")).agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("b"))
    return C.written(filed.join(shared, F.col("bucket") == F.col("b")).select("bucket", "band", "node", "n", F.col("node").alias("component")),
                     "minhash-buckets")


def sets_of(docs: DataFrame, classes: DataFrame, filed: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Written: (node, items) of the classes in ``filed``, from the texts of their reps."""
    wanted = classes.join(filed.select("node").distinct(), "node", "left_semi").select("node", "rep", "rep_hash")
    texts = (docs.select("doc_id", text_hash().alias("h"), "text")
             .join(wanted, (F.col("doc_id") == F.col("rep")) & (F.col("h") == F.col("rep_hash")))
             .groupBy("node").agg(F.first("text").alias("text")))
    return C.written(texts.select("node", sets("text", size).alias("items")), "minhash-sets")


def comparable(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can link at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def verified(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (centre, node) that link, over the full sets, as (a, b), a < b."""
    pairs = C.written(pairs, "minhash-pairs")
    with_node = pairs.join(items.withColumnRenamed("items", "x"), "node")
    centres = items.select(F.col("node").alias("c"), F.col("items").alias("y"))
    both = C.join_split(with_node, centres, "centre", "c", pairs.count())
    shared = F.size(F.array_intersect("x", "y"))
    return (both.filter(100 * shared >= percent * (F.size("x") + F.size("y") - shared))
            .select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")))


def star_links(filed: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): links that span the components of ``filed`` (see the top)."""
    spark = filed.sparkSession
    apart = F.col("component") != F.col("c_component")
    links, live, left, old = no_links(spark), filed, filed.count(), []
    while left:
        # the row in most buckets: what a group was copied from, or near it, and the same in all its buckets
        weights = live.groupBy(F.col("node").alias("w")).agg(F.count(F.lit(1)).alias("weight"))
        chosen = F.max_by(F.struct("node", "n", "component"), F.struct("weight", F.xxhash64("node"), "node")).alias("c")
        centres = (live.join(weights, F.col("node") == F.col("w")).groupBy(F.col("bucket").alias("b")).agg(chosen)
                   .select("b", F.col("c.node").alias("centre"), F.col("c.n").alias("c_n"), F.col("c.component").alias("c_component")))
        stars = C.join_split(live, centres, "bucket", "b", left).drop("b")
        starred = C.read_written(stars, star_path := C.write_scratch(stars, "minhash-stars"))
        pairs = starred.filter(apart & comparable("n", "c_n", percent)).select("centre", "node").distinct()
        more = links.unionByName(verified(pairs, items, percent))
        links = C.read_written(more, link_path := C.write_scratch(more, "minhash-links"))
        rest = unfinished(starred.filter("node != centre").select("bucket", "band", "node", "n"), links)
        live = C.read_written(rest, live_path := C.write_scratch(rest, "minhash-buckets"))
        C.drop_written(spark, star_path, *old)
        old, before, left = [link_path, live_path], left, live.count()
        if left > before / 2:
            return links.unionByName(verified(cross_pairs(live, items, percent), items, percent))
    return links


def no_links(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "a bigint, b bigint")


def unfinished(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with their components, of those buckets that have several."""
    roots = connected(links).withColumnRenamed("node", "of")
    placed = rows.join(roots, F.col("node") == F.col("of"), "left").select(
        *rows.columns, F.coalesce("root", "node").alias("component"))
    several = (placed.groupBy(F.col("bucket").alias("b")).agg(F.min("component").alias("low"), F.max("component").alias("high"))
               .filter("low < high").select("b"))
    return placed.join(several, F.col("bucket") == F.col("b")).drop("b")


def cross_pairs(live: DataFrame, items: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """(centre, node): the pairs of different components in a bucket of ``live`` whose bitmaps and signatures
    don't rule a link out, each once. Rows meet in numpy within cells of two blocks; only such pairs leave the task."""
    small = items.join(live.select("node").distinct(), "node", "left_semi").select(F.col("node").alias("of"), pocket("items").alias("sketch"))
    large = live.groupBy(F.col("bucket").alias("b")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("k"))
    own = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    cells = (live.join(large, F.col("bucket") == F.col("b")).select("bucket", "band", "node", "n", "component", own.alias("own"), F.inline(others))
             .join(small, F.col("node") == F.col("of")).drop("of"))
    dealt = cells.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "own")
    names = ["bucket", "i", "j", "band", "node", "n", "component", "own", "sketch"]

    def met(c: list[np.ndarray]) -> pa.RecordBatch:
        """``c``: the columns of one cell from ``band`` on, its rows sorted by ``own``."""
        band, node, n, component, block_of, sketch = c
        bins, bits = sketch[:, :BINS], np.ascontiguousarray(sketch[:, BINS:]).view(np.uint64)
        first = int(np.searchsorted(block_of, block_of[0], "right"))
        left = np.arange(first)
        right = np.arange(first, len(node)) if first < len(node) else left   # two blocks, or one with itself
        found = []
        for at in range(0, len(left), 16):
            x = left[at:at + 16]
            low, high = np.minimum(n[x, None], n[None, right]), np.maximum(n[x, None], n[None, right])
            i, j = np.nonzero((component[x, None] != component[None, right]) & (100 * low >= percent * high)
                              & ((right is not left) | (x[:, None] < right[None, :])))
            for s in range(0, len(i), 1 << 14):
                a, b = x[i[s:s + (1 << 14)]], right[j[s:s + (1 << 14)]]
                # a bit in one bitmap only needs a hash in one set only
                apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
                near = (100 + percent) * apart <= (100 - percent) * (n[a] + n[b])
                a, b = a[near], b[near]
                same = bins[a] == bins[b]
                bands_met = same.reshape(len(a), BINS // BAND, BAND).all(axis=2).argmax(axis=1)
                # in the first band they share; if they no longer meet there, they have met a centre's way
                ok = (same.sum(axis=1) >= least_agreement(np.minimum(n[a], n[b]), percent)) & (bands_met == band[a])
                found.append((node[a[ok]], node[b[ok]]))
        a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["centre", "node"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a batch's last cell may go on in the next."""
        held: list[np.ndarray] | None = None
        for batch in batches:
            columns = [np.asarray(batch.column(k)) for k in range(len(names) - 1)]
            columns.append(np.frombuffer(b"".join(batch.column(len(names) - 1).to_pylist()), np.uint8).reshape(-1, 2 * BINS))
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            if not len(columns[0]):
                continue
            key = np.stack(columns[:3])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cuts[:-1]], cuts):
                yield met([c[start:end] for c in columns[3:]])
            held = [c[cuts[-1] if len(cuts) else 0:] for c in columns]
        if held is not None and len(held[0]):
            yield met([c for c in held[3:]])
    return dealt.select(*names).mapInArrow(walk, "centre bigint, node bigint").distinct()


def pocket(items: str) -> Column:
    """The lowest byte of each bin of a set, then a bitmap of 8 * ``BINS`` bits of its hashes."""
    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for s in batch:
                hashes = np.asarray(s.values).view(np.uint64)
                bits = np.zeros(8 * BINS, np.uint8)
                bits[(hashes % np.uint64(8 * BINS)).astype(np.int64)] = 1
                out.append(signature(hashes).astype(np.uint8).tobytes() + np.packbits(bits).tobytes())
            yield pa.array(out, pa.binary())
    return of(F.col(items))


def least_agreement(n: np.ndarray, percent: int) -> np.ndarray:
    """Equal bins below which sets of ``n`` hashes or more don't link: ``SPREAD`` standard deviations under what
    the bound leads to expect. Few hashes fill the bins many times over, so they count, not the bins."""
    share = percent / 100
    return BINS * (share - SPREAD * np.sqrt(share * (1 - share) / np.minimum(BINS, n)))


def rooted(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sketches of all rows, classes with ``root``, a node that stands for the component)."""
    prints = sketched(docs, size)
    classes = classes_of(prints)
    filed = in_buckets(classes)
    roots = connected(star_links(filed, sets_of(docs, classes, filed, size), percent)).withColumnRenamed("node", "of")
    found = classes.join(roots, F.col("node") == F.col("of"), "left").select(
        "digest", "rep", "rep_hash", F.coalesce("root", "node").alias("root"))
    return prints, C.written(found, "minhash-rooted")


def components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (the
    least id that can be reached, itself included), kept."""
    prints, classes = rooted(docs, size, percent)
    least = classes.groupBy(F.col("root").alias("r")).agg(F.min("rep").alias("component_id"))
    of_class = (C.join_split(classes, least, "root", "r", classes.count())
                .select(F.col("digest").alias("d"), F.col("component_id")))
    rows = prints.select("doc_id", "n_shingles", "digest")
    # a set with a great many copies is split
    found = C.join_split(rows, of_class, "digest", "d", rows.count(), "left").withColumn(
        "component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component (the least id; of its texts there the one of
    the least hash; the least of equal rows), one per set of rows that only null ids have,
    and all rows without words."""
    prints, classes = rooted(docs, size, percent)
    kept = classes.groupBy("root").agg(F.min(F.struct("rep", "rep_hash")).alias("k")).select(
        F.col("k.rep").alias("k_doc"), F.col("k.rep_hash").alias("k_hash"))
    no_id = (prints.filter("doc_id is null and n_shingles > 0").join(classes.select("digest"), "digest", "left_anti")
             .groupBy("doc_id", "digest").agg(F.min("text_hash").alias("k_hash"))
             .select(F.col("doc_id").alias("k_doc"), "k_hash"))
    kept = C.written(kept.unionByName(no_id), "minhash-kept")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", text_hash().alias("text_hash"), "text")
    chosen = (rows.join(kept, F.col("doc_id").eqNullSafe(F.col("k_doc")) & (F.col("text_hash") == F.col("k_hash")), "left_semi")
              .groupBy("doc_id", "text_hash").agg(least_row(rows)).select("row.*"))
    wordless = rows.filter(~F.coalesce("text", F.lit("")).rlike(C.WORD)).select("row.*")
    return chosen.unionByName(wordless)
