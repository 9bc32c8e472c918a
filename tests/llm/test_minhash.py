"""MinHash near-duplicates against all pairs, and its edge cases."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import minhash as M

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def slow_set(text):
    words = WORD.findall((text or "").encode().lower())
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def slow_components(docs):
    sets = {i: slow_set(t) for i, t in docs}
    ids = sorted(sets)
    comp = {i: i for i in ids}
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((comp[a], comp[b]))
                comp = {i: low if c == high else c for i, c in comp.items()}
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in ids}


def families(seed, groups, sizes, copies):
    """Texts in groups of edited copies, some near the bound of 0.85."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(2000)]
    out = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice(sizes))]
        out.append(" ".join(base))
        for _ in range(rng.choice(copies)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 40))):
                text[rng.randrange(len(text))] = rng.choice(words)
            out.append(" ".join(text))
    rng.shuffle(out)
    return list(enumerate(out))


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_components_equal_all_pairs(spark):
    docs = families(1, 16, [3, 6, 8, 20, 60, 150], [1, 3, 8]) + [(10_000 + i, t) for i, t in families(2, 1, [120], [60])]
    assert found(M.components(spark.createDataFrame(docs, "doc_id bigint, text string"))) == slow_components(docs)


@pytest.mark.parametrize("block", [2048, 7])
def test_cross_pairs_hold_every_link(spark, block):
    """What stars leave: all links between rows of a bucket, in blocks of any size, each pair once."""
    docs = families(3, 8, [40, 60, 300], [6])
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    classes = M.classes_of(M.sketched(df))
    filed = M.in_buckets(classes)
    items = M.sets_of(df, classes, filed)
    by_id = {r.node: r.rep for r in classes.collect()}
    sets = {i: slow_set(t) for i, t in docs}
    buckets: dict = {}
    for r in filed.collect():
        buckets.setdefault(r.bucket, []).append(by_id[r.node])
    linked = {(min(a, b), max(a, b)) for rows in buckets.values() for a in rows for b in rows
              if a != b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    pairs = M.cross_pairs(filed, items, 85, block)
    got = [tuple(sorted((by_id[r.centre], by_id[r.node]))) for r in pairs.collect()]
    assert len(got) == len(set(got)) and linked <= set(got) and linked
    assert {tuple(sorted((by_id[r.a], by_id[r.b]))) for r in M.verified(pairs, items, 85).collect()} == linked


def test_signature_estimates_the_similarity():
    rng = np.random.default_rng(5)
    for n, share in ((30, 0.8), (400, 0.9), (5000, 0.7)):
        agree = []
        for _ in range(30):
            common = rng.integers(0, 2 ** 64, int(n * share), np.uint64)
            a, b = (np.unique(np.concatenate([common, rng.integers(0, 2 ** 64, n - len(common), np.uint64)])) for _ in "ab")
            agree.append(np.mean(M.signature(a) == M.signature(b)))
        assert abs(np.mean(agree) - share / (2 - share)) < 0.08
    one = M.signature(np.array([12345], np.uint64))
    assert (one == 12345).all()


LONG = " ".join(f"w{i % 977} x{i}" for i in range(200_000))
EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE two"), (6, "one"), (7, LONG), (7, LONG), (8, LONG + " end"),
         (9, "a b c d e f"), (9, "quite another text of several words"), (10, "A b C d e f"), (None, "a b c d e f"),
         (None, "text that only rows without an id have"), (None, "text that only rows without an id have"), (None, None)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "doc_id bigint, text string").select(
        "*", *[F.lit(k).alias(c) for k, c in enumerate(["node", "digest", "bands", "row", "bucket", "rep", "text_hash", "n", "kept"])])


def test_edge_cases(edges):
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in M.components(edges).collect()), key=str)
    long = len(slow_set(LONG))
    assert rows == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
        (7, long, 7, True), (7, long, 7, True), (8, long + 1, 7, False), (9, 2, 9, True), (9, 2, 9, True), (10, 2, 9, False),
        (None, 2, 9, False), (None, 4, None, True), (None, 4, None, True), (None, 0, None, True)], key=str)


def test_one_of_each_keeps_whole_rows(edges):
    left = M.one_of_each(edges)
    assert left.columns == edges.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (6, "one"), (7, LONG), (9, "a b c d e f"),
         (9, "quite another text of several words"), (None, "text that only rows without an id have"), (None, None)], key=str)


def test_empty_table(edges):
    none = edges.filter("false")
    assert M.components(none).count() == 0 and M.one_of_each(none).count() == 0
    unlinked = edges.filter("doc_id in (1, 4, 6)")
    assert M.components(unlinked).filter("kept").count() == 3
