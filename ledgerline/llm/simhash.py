"""SimHash near-duplicates by the general pigeonhole principle.

A text's fingerprint has a bit set if over half of its shingles' 64-bit hashes
have it. Fingerprints within ``MAX_BITS`` of each other link; a component is
what can be reached over links.

The 64 bits are grouped into m partitions, correlated bits together. If every
partition i gets a threshold t_i with sum(t_i + 1) = MAX_BITS + 1, two linked
fingerprints differ by at most t_i bits in some partition i (else they would
differ by MAX_BITS + 1 at least). Thresholds, m among them, come from a dynamic
program over the estimated number of probes and candidates of each partition.
Every fingerprint is filed under its value in each partition with t_i >= 0 and
probes all values within t_i bits; who meets in a bucket is verified over all
64 bits.

Scale: texts are read once. Copies collapse to one class per fingerprint before
anything is compared. Bucket rows are linear in the classes. Inside a bucket
only a spanning forest of the verified links leaves the task, so a group of
thousands of near copies yields thousands of links, not millions. A bucket over
``BLOCK`` rows is cut into blocks, and each pair of blocks is a bucket of its
own: nothing is dropped, and no task gets an unbounded group. Components are
found by alternating large and small stars, joins whose result is written to
the shared folder in each round. The middle of a star, or a fingerprint, with
over a thousandth of all rows is salted in its joins. The driver gets one 64 x 64 matrix and
``SAMPLE`` fingerprints, which decide only the cost.

Defined results: a null or empty text has fingerprint zero, linked like any
other; fewer words than a shingle are one shingle; repeated rows and copies are
one class; an id with several texts is in the classes of them all, and does not
link them; rows with a null id take part in no link and get the component of
their fingerprint's class, null if no row with an id has it; an empty table
gives an empty result; other columns are ignored by ``components`` and kept by
``one_of_each``.
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

SHINGLE = 4
MAX_BITS = 4
HASH_SEED = 42
SAMPLE = 4000
BLOCK = 4096
PROBE_COST, VERIFY_COST = 1.0, 0.01   # a row shuffled and sorted against a comparison in numpy
BOTH, RIGHT, LEFT = 0, 1, 2           # which sides of a comparison a bucket row takes


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = HASH_SEED) -> int:
    """Signed 64-bit fingerprint of a text; A-Z count as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(size, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        raw = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)])])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big", signed=True)


def fingerprints(text: str = "text", size: int = SHINGLE) -> Column:
    @F.arrow_udf("bigint")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t.as_py(), size) for t in batch], pa.int64())
    return of(F.col(text))


def as_hex(col: str) -> Column:
    return F.lpad(F.lower(F.hex(F.col(col))), 16, "0")


def bits_of(values: np.ndarray) -> np.ndarray:
    """(n, 64) of 0 and 1; bit j of a value is in column j."""
    return (values.astype(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)


# --- the partitions and their thresholds ------------------------------------------------

@dataclass
class Part:
    bits: list[int]
    threshold: int

    def values(self, prints: np.ndarray) -> np.ndarray:
        """The partition's bits of each fingerprint, packed."""
        out = np.zeros(len(prints), np.int64)
        for j, b in enumerate(self.bits):
            out |= ((prints >> np.int64(b)) & 1) << j
        return out

    def probes(self) -> np.ndarray:
        """Masks of 1 to ``threshold`` of the partition's bits."""
        masks = level = [0]
        for _ in range(max(0, self.threshold)):
            level = sorted({m | 1 << j for m in level for j in range(len(self.bits)) if not m >> j & 1})
            masks = masks + level
        return np.array(masks[1:], np.int64)


def grouped_bits(correlation: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in m groups of (nearly) equal size: a group takes the bit that
    correlates most with any left, then what correlates most with the group."""
    left, groups = list(range(64)), []
    for i in range(m):
        size = math.ceil(len(left) / (m - i))
        group = [max(left, key=lambda b: (correlation[b, left].sum() - correlation[b, b], -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (correlation[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def cost(bits: list[int], threshold: int, distances: np.ndarray, n: int) -> float:
    """Estimated cost per fingerprint of a partition at a threshold. ``distances``: of
    sampled pairs, in the partition; one pair at random is added for smoothing."""
    if threshold < 0:
        return 0.0
    ways = sum(math.comb(len(bits), k) for k in range(threshold + 1))
    near = ((distances <= threshold).sum() + ways / 2 ** len(bits)) / (len(distances) + 1)
    return PROBE_COST * ways + VERIFY_COST * n * near


def allocate(groups: list[list[int]], sample: np.ndarray, n: int, max_bits: int) -> tuple[float, list[Part]]:
    """Thresholds of least cost with sum(t + 1) = max_bits + 1, by dynamic programming."""
    units = max_bits + 1
    half = len(sample) // 2
    differ = bits_of(sample[:half] ^ sample[half:2 * half])
    best = {0: (0.0, [])}
    for bits in groups:
        distances = differ[:, bits].sum(axis=1)
        costs = [cost(bits, u - 1, distances, n) for u in range(min(units, len(bits)) + 1)]
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for u, c in enumerate(costs[: units - used + 1]):
                if used + u not in step or total + c < step[used + u][0]:
                    step[used + u] = (total + c, [*chosen, u - 1])
        best = step
    total, thresholds = best[units]
    return total, [Part(b, t) for b, t in zip(groups, thresholds) if t >= 0]


def plan(classes: DataFrame, max_bits: int = MAX_BITS) -> list[Part]:
    """Partitions and thresholds for the distinct fingerprints of ``classes``."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((65, 64))
        for batch in batches:
            prints = np.asarray(batch.column(0))
            for at in range(0, len(prints), 1 << 14):
                x = bits_of(prints[at:at + (1 << 14)]).astype(float)
                total[:64] += x.T @ x
                total[64] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(65), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         ["i", "row"])
    sums = (classes.select("fingerprint").mapInArrow(moments, "i int, row array<double>")
            .select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    matrix = np.zeros((65, 64))
    for r in sums:
        matrix[r.i, r.j] = r.v
    n = max(1.0, matrix[64, 0])
    share = matrix[:64].diagonal() / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = np.abs((matrix[:64] / n - np.outer(share, share)) / np.outer(spread, spread))
    sample = classes.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).select("fingerprint").collect()
    sample = np.array([r.fingerprint for r in sample], np.int64)
    options = [allocate(grouped_bits(correlation, m), sample, int(n), max_bits) for m in range(2, max_bits + 2)]
    return min(options, key=lambda o: o[0])[1]


# --- probing and verifying ----------------------------------------------------------------

def bucket_rows(classes: DataFrame, parts: list[Part]) -> DataFrame:
    """(bucket, side, fingerprint, rep): each class filed under its own values, and
    probing the values near them."""
    flips = [p.probes() for p in parts]

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, reps = (np.asarray(batch.column(i)) for i in range(2))
            for i, (part, masks) in enumerate(zip(parts, flips)):
                own = part.values(prints) | np.int64(i) << np.int64(48)
                yield rows(own, BOTH, prints, reps)
                for mask in masks:
                    yield rows(own ^ mask, RIGHT, prints, reps)

    def rows(bucket, side, prints, reps) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.full(len(bucket), side, np.int32)),
                                           pa.array(prints), pa.array(reps)], ["bucket", "side", "fingerprint", "rep"])
    return classes.select("fingerprint", "rep").mapInArrow(
        file, "bucket bigint, side int, fingerprint bigint, rep bigint")


def in_blocks(filed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds ``i``, ``j``: (0, 0) in a bucket of at most ``block`` rows; a larger one
    becomes a grid of cells, every pair of its rows meeting in one of them."""
    counts = filed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("side") == BOTH).alias("n_left"))
    large = (counts.filter(F.col("n") > block)
             .select(F.col("bucket").alias("b"), F.ceil(F.col("n") / block).cast("int").alias("n_right"),
                     F.greatest(F.lit(1), F.ceil(F.col("n_left") / block)).cast("int").alias("n_left")))
    rows = filed.join(large, F.col("bucket") == F.col("b"), "left")
    own = lambda n: F.pmod(F.xxhash64("fingerprint", "side"), F.col(n)).cast("int")
    row_of = F.transform(F.sequence(F.lit(0), F.col("n_right") - 1),
                         lambda j: F.struct(own("n_left").alias("i"), j.alias("j"), F.lit(LEFT).alias("as")))
    column_of = F.transform(F.sequence(F.lit(0), F.col("n_left") - 1),
                            lambda i: F.struct(i.alias("i"), own("n_right").alias("j"), F.lit(RIGHT).alias("as")))
    cells = (F.when(F.col("b").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("side").alias("as"))))
             .when(F.col("side") == BOTH, F.concat(row_of, column_of)).otherwise(column_of))
    return (rows.select("bucket", "fingerprint", "rep", F.inline(cells))
            .withColumnRenamed("as", "side"))


def forest(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of ``labels`` (each row's least known row) along the pairs a, b."""
    while len(a):
        low = np.minimum(labels[a], labels[b])
        np.minimum.at(labels, labels[a], low)
        np.minimum.at(labels, labels[b], low)
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up
        apart = labels[a] != labels[b]
        a, b = a[apart], b[apart]


def links(cells: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: links between classes that span what is linked within each cell."""
    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        # unsigned: of a negative number the bits of its absolute value would be counted
        return np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits

    def verified(key: np.ndarray, side: np.ndarray, prints: np.ndarray, reps: np.ndarray) -> pa.RecordBatch:
        """``key``: of whole cells, ascending."""
        labels = np.arange(len(key))
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        ends = np.repeat(starts + sizes, sizes)
        small = np.repeat(sizes <= 64, sizes)
        at = np.flatnonzero(small)
        for step in range(1, 64):  # all pairs of small cells, a step apart
            at = at[at + step < ends[at]]
            if not len(at):
                break
            to = at + step
            met = ((side[at] != RIGHT) | (side[to] != RIGHT)) & near(prints[at], prints[to])
            forest(labels, at[met], to[met])
        for s, n in zip(starts[sizes > 64], sizes[sizes > 64]):
            left, right = (s + np.flatnonzero(side[s:s + n] != other) for other in (RIGHT, LEFT))
            for k in range(0, len(left), 256):
                i, j = np.nonzero(near(prints[left[k:k + 256], None], prints[None, right]))
                forest(labels, left[k + i], right[j])
        a, b = reps[labels], reps
        a, b = np.minimum(a, b), np.maximum(a, b)
        return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; the last cell of a batch may go on in the next."""
        held = None
        for batch in batches:
            columns = [np.asarray(batch.column(i)) for i in range(6)]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns)]
            key = np.concatenate([[0], np.cumsum((columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
                                                 | (columns[2][1:] != columns[2][:-1]))]) if len(columns[0]) else np.array([])
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield verified(key[:cut], *(c[:cut] for c in columns[3:]))
            held = [c[cut:] for c in columns]
        if held is not None and len(held[0]):
            yield verified(np.zeros(len(held[0]), np.int64), *held[3:])
    return (cells.select("bucket", "i", "j", "side", "fingerprint", "rep").repartition("bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j").mapInArrow(walk, "a bigint, b bigint").distinct())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a < b) but the roots, which are the
    least nodes of their components: large and small stars in turn until nothing
    changes. Each round is written, so no round's lineage outlives it."""
    spark = edges.sparkSession

    def hung(pairs: DataFrame, most: int) -> DataFrame:
        """Pairs (up, down), at most ``most``, to (up, down, least): with the least
        ``down`` of each ``up``. The middle of a great star is split."""
        least = pairs.groupBy(F.col("up").alias("of")).agg(F.min("down").alias("least"))
        return C.join_split(pairs, least, "up", "of", most).drop("of")

    def state(path: str) -> tuple:
        return tuple(pairs(path).agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())

    def pairs(path: str) -> DataFrame:
        return spark.read.schema("node bigint, root bigint").parquet(path)

    path = C.write_scratch(edges.select(F.col("b").alias("node"), F.col("a").alias("root")), "links")
    before = state(path)
    while True:
        now = pairs(path)
        both = now.select(F.col("node").alias("up"), F.col("root").alias("down")).unionByName(
            now.select(F.col("root").alias("up"), F.col("node").alias("down")))
        most = 2 * before[0]
        large = (hung(both, most).filter("down > up")
                 .select(F.col("down").alias("up"), F.least("up", "least").alias("down")).distinct())
        small = (hung(large, most).select(F.inline(F.array(
            F.struct(F.col("up").alias("node"), F.col("least").alias("root")),
            F.struct(F.col("down").alias("node"), F.col("least").alias("root"))))).filter("node != root").distinct())
        following = C.write_scratch(small, "links")
        C.drop_written(spark, path)
        path, after = following, state(following)
        if after == before:
            return pairs(path)
        before = after


def components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (bigint),
    component_id (the least id that can be reached, itself included)."""
    prints = C.written(docs.select("doc_id", fingerprints("text", shingle).alias("fingerprint")), "fingerprints")
    return assigned(prints, max_bits, block)


def class_components(classes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``classes`` (fingerprint, rep) with ``root``, the least fingerprint that can be
    reached: the node of a class is its fingerprint, as classes can share an id."""
    nodes = classes.select("fingerprint", F.col("fingerprint").alias("rep"))
    roots = connected(links(in_blocks(bucket_rows(nodes, plan(classes, max_bits)), block), max_bits))
    return (classes.join(roots, F.col("fingerprint") == F.col("node"), "left").drop("node")
            .withColumn("root", F.coalesce("root", "fingerprint")))


def assigned(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    classes = C.written(prints.filter("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("rep")),
                        "fingerprint-classes")
    rooted = C.written(class_components(classes, max_bits, block), "rooted-classes")
    least = rooted.groupBy(F.col("root").alias("r")).agg(F.min("rep").alias("component_id"))
    of_class = (C.join_split(rooted, least, "root", "r", rooted.count())
                .select(F.col("fingerprint").alias("f"), "component_id"))
    # a fingerprint with a great many copies is split
    return (C.join_split(prints, of_class, "fingerprint", "f", prints.count(), "left")
            .select("doc_id", "fingerprint", "component_id"))


def least_row(row: DataFrame) -> Column:
    """The least of the rows ``row``, the same in every run; maps have no order."""
    fields = row.schema["row"].dataType.fields
    if not any("map<" in f.dataType.simpleString() for f in fields):
        return F.min("row").alias("row")
    order = [F.to_json(F.struct(F.col("row")[f.name])) if "map<" in f.dataType.simpleString() else F.col("row")[f.name]
             for f in fields]
    return F.min_by("row", F.struct(*order)).alias("row")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, one_per_id: bool = True) -> DataFrame:
    """``docs`` with one row of each component: that of the least id, of its texts in the
    component that of the least fingerprint and hash, the least row if it is repeated;
    of rows that only share a null id, one per fingerprint. An id with texts that are
    no near duplicates can be the least of several components: of these it keeps the
    one of the least fingerprint, or with ``one_per_id=False`` each."""
    key = [F.col("doc_id"), F.xxhash64(C.text_or_empty()).alias("text_hash")]
    prints = C.written(docs.select(*key, fingerprints("text", shingle).alias("fingerprint")), "fingerprints")
    classes = C.written(prints.filter("doc_id is not null").groupBy("fingerprint")
                        .agg(F.min(F.struct("doc_id", "text_hash")).alias("least"))
                        .select("fingerprint", F.col("least.doc_id").alias("rep"), F.col("least.text_hash").alias("text_hash")),
                        "fingerprint-classes")
    best = F.min(F.struct(F.col("rep").alias("k_doc"), "fingerprint", F.col("text_hash").alias("k_hash")))
    kept = class_components(classes, max_bits).groupBy("root").agg(best.alias("k")).select("k.*")
    if one_per_id:
        kept = kept.groupBy("k_doc").agg(F.min(F.struct("fingerprint", "k_hash")).alias("k")).select("k_doc", "k.*")
    # texts of null ids that no row with an id has
    no_id = (prints.filter("doc_id is null").groupBy("doc_id", "fingerprint").agg(F.min("text_hash").alias("k_hash"))
             .join(classes.select("fingerprint"), "fingerprint", "left_anti")
             .select(F.col("doc_id").alias("k_doc"), "fingerprint", "k_hash"))
    kept = C.written(kept.unionByName(no_id).drop("fingerprint"), "kept")
    # rows of one id and text are reduced to one before the join
    rows = docs.select(F.struct("*").alias("row"), *key)
    return (rows.groupBy("doc_id", "text_hash").agg(least_row(rows))
            .join(kept, F.col("doc_id").eqNullSafe(F.col("k_doc")) & (F.col("text_hash") == F.col("k_hash")))
            .select("row.*"))
