"""Collocations against plain counting, the graph's paths, and edge cases."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import collocations as K
from ledgerline.llm import common as C


def slow_counts(docs):
    found = {}
    for text, lang in docs:
        low = (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall(rb"[^ \t]+", piece)
            for k in range(1, 5):
                found.setdefault(lang or "und", Counter()).update(
                    tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return found


def slow(docs, least, inside, most):
    out = []
    for lang, f in slow_counts(docs).items():
        often = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in often.items():
            if any(100 * b >= inside * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in often.items() if len(q) > len(p)):
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, b" ".join(p), a, l, r, score))
        n = sum(a for p, a in f.items() if len(p) == 1)
        out += [(lang, i + 1, r[2].decode(), *r[3:6], n, r[6]) for i, r in enumerate(sorted(rows)[:most])]
    return sorted(out)


def sentences(seed, n):
    """Texts over few words, with repeated passages, so that phrases are frequent and tie."""
    rng = random.Random(seed)
    words = [*"abcdefgh", "É", "ß", "THE", "the", "x-y", "日本", "\x1f", "a\x00b"]
    passage = " ".join(rng.choice(words) + str(k) for k in range(60))
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(rng.randint(0, 60)))
        out.append((text + rng.choice(["", passage, "\n" + passage, passage + " " + passage]), rng.choice(["en", "de", None])))
    return out


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least, inside, most", [(30, 80, 2000), (2, 50, 40)])
def test_collocations_equal_plain_counts(spark, least, inside, most):
    docs = sentences(least, 150)
    df = spark.createDataFrame(docs, "text string, lang string").repartition(5)
    assert found(K.collocations(df, least, inside, most)) == slow(docs, least, inside, most)


def test_small_slices_blocks_and_dictionaries_change_nothing(monkeypatch):
    """What the workers count, in this process."""
    import pyarrow as pa
    docs = sentences(9, 60)
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in docs]), pa.array([lang or "und" for _, lang in docs])], ["text", "lang"])
    everything, some = (bytes([v]) * (1 << (K.BITMAP_BITS - 3)) for v in (255, 0b01101101))

    def windows(bitmap):
        out = Counter()
        for found in K.counted(iter([batch]), bitmap):
            for row in found.to_pylist():
                out[row["lang"], row["gram"]] += row["n"]
        return out
    want = windows(everything), windows(some)
    plain = Counter()
    for lang, f in slow_counts(docs).items():
        plain.update({(lang, b" ".join(p).decode()): a for p, a in f.items() if len(p) == 4})
    assert {k: n for k, n in want[0].items() if k[1].count(" ") == 3} == plain and want[0] != want[1]
    for name, small in (("SLICE", 30), ("BLOCK", 40), ("VOCABULARY", 5)):
        monkeypatch.setattr(K, name, small)
        assert (windows(everything), windows(some)) == want


def test_pairs_let_through_by_mistake_change_nothing(spark, monkeypatch):
    docs = sentences(4, 80)
    df = spark.createDataFrame(docs, "text string, lang string")
    monkeypatch.setattr(K, "frequent_pairs", lambda *_: b"\xff" * (1 << (K.BITMAP_BITS - 3)))
    assert found(K.collocations(df, 10)) == slow(docs, 10, 80, 2000)


def test_paths_are_compact(spark):
    edges = ["a b c d", "b c d e", "c d e f", "c d e g", "d e g h", "q q q q", "r s t r", "s t r s", "t r s t"]
    df = C.written(spark.createDataFrame([("en", e, 30 + i) for i, e in enumerate(edges)], "lang string, phrase string, f bigint"), "edges")
    got = {" ".join(r.words): list(r.weights) for r in K.compact(df).collect()}
    rings = {p: w for p, w in got.items() if p.startswith(("r", "s", "t"))}
    assert {p: w for p, w in got.items() if p not in rings} == {
        "a b c d e": [30, 31], "c d e f": [32], "c d e g h": [33, 34], "q q q q": [35]}
    assert len(rings) == 1 and [sorted(w) for w in rings.values()] == [[36, 37, 38]]
    inside = {(r.phrase, r.f) for r in K.within_paths(K.compact(df)).groupBy("phrase").agg(F.max("f").alias("f")).collect()}
    want = {}
    for i, e in enumerate(edges):
        w = e.split()
        for k in (2, 3):
            for at in range(5 - k):
                part = " ".join(w[at:at + k])
                want[part] = max(want.get(part, 0), 30 + i)
    assert inside == set(want.items())


def test_passages_are_longer_than_an_edge(spark):
    passage = " ".join(f"w{k}" for k in range(70))
    df = spark.createDataFrame([(f"x{k} {passage} y{k}", "en") for k in range(30)], "text string, lang string")
    got = K.passages(df).collect()
    assert [(r.phrase, r.n_words, r.fewest, r.most) for r in got] == [(passage, 70, 30, 30)]


def test_edge_cases(spark):
    docs = [(None, "en"), ("", None), (" \n\t.;", "fr"), ("one two. " * 40, None), ("one two. " * 40, "und"), ("word " * 300_000, "en")]
    df = spark.createDataFrame(docs, "text string, lang string").select(
        "*", *[F.lit(1).alias(c) for c in ("phrase", "f", "k", "n", "id", "key", "start")])
    assert found(K.collocations(df)) == slow(docs, 30, 80, 2000)
    assert K.collocations(df.filter("false")).count() == 0 and K.passages(df.filter("false")).count() == 0


def test_products_beyond_64_bits(spark):
    big = 10 ** 13
    phrases = C.written(spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big)],
                                              "lang string, phrase string, k int, f bigint"), "phrases")
    paths = spark.createDataFrame([], "lang string, words array<string>, weights array<bigint>")
    row = K.scored(K.Graph(phrases, phrases, paths)).first()
    assert (row.a, row.score) == (big, 1000000)
