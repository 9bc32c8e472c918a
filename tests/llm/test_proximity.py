"""Proximity matches against their definition, and in a registered query."""

import math
import random
import re

from ledgerline.llm import decontaminate
from ledgerline.llm import queries as Q

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa"


def slow_near(doc, windows, slop=2, share=0.8):
    """(window, start) of every proximity match, from the definition alone."""
    found = set()
    for w in windows:
        exact = [s for s in range(len(doc)) if tuple(doc[s:s + len(w)]) == w]
        for s in range(-slop - len(w), len(doc) + slop + 1):
            there = sum(t in doc[max(0, s + i - slop):max(0, s + i + slop + 1)] for i, t in enumerate(w))
            if there >= math.ceil(len(w) * share) and not any(abs(e - s) <= slop for e in exact):
                found.add((w, s))
    return found


def slow_windows(texts):
    windows = set()
    for t in texts:
        w = t.split()
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} - {()}
    return windows


def test_replaced_words(spark):
    """The rarest word replaced (no document may have it), and two words."""
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    common = " ".join(w for w in ITEM.split() if w not in ("alpha", "beta", "delta"))
    texts = [(1, ITEM.replace("delta", "other")), (2, ITEM.replace("alpha", "x").replace("beta", "y")),
             (3, ITEM.replace("alpha", "x").replace("beta", "y").replace("kappa", "z")), (4, common), (5, common),
             (6, "alpha beta gamma a b delta epsilon zeta eta c d theta iota kappa")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.summary(decontaminate.scan(df, benchmark)).collect()}
    assert got[1].n_near > 0 and got[1].near_ids == ["1"] and not got[1].contaminated
    assert got[2].n_near > 0 and got[3].n_near == 0
    assert got[6].n_near > 0
    # without the other documents, the replaced words occur nowhere
    alone = decontaminate.summary(decontaminate.scan(df.filter("doc_id = 2"), benchmark)).collect()
    assert alone[0].n_near == got[2].n_near


def test_against_the_definition(spark):
    rng, words = random.Random(3), [f"w{i}" for i in range(14)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 4, 5, 8, 11, 13])))) for i in range(12)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(25)))) for i in range(30)]
    for i, (_, t) in enumerate(items * 3):  # items with words replaced, left out and put in
        w = t.split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randrange(2)] = [rng.choice(words + ["odd"])] * rng.randrange(3)
        docs.append((100 + i, " ".join(rng.choices(words, k=3) + w + rng.choices(words, k=2))))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.scan(df, benchmark).collect()}
    windows = slow_windows(t for _, t in items)
    for i, t in docs:
        expected = sorted((s, len(w)) for w, s in slow_near(t.split(), windows))
        assert sorted((m["start"], m["size"]) for m in got[i].near) == expected, t


def test_registered_query_returns_proximity_matches(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    texts = [(1, ITEM), (2, re.sub("delta", "other", ITEM)), (3, "nothing of it")]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: r for r in Q.QUERIES["op10_proximity"](spark, path).collect()}
    assert (got[1].n_hit, got[1].n_near, got[1].contaminated) == (10, 0, True)
    assert got[2].n_hit == 0 and got[2].n_near > 0 and got[2].n_near_items == 1 and not got[2].contaminated
    assert got[3].n_near == got[3].n_near_items == 0
