"""Queries against SQL twins, brute force, round trips and held-out labels."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from ledgerline.checks.compare import compare, register_tables
from ledgerline.llm import queries as Q
from ledgerline.llm.oracle import ORACLE
from ledgerline.sources.fixture import TABLES

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register_tables(c, SF, TABLES)
    return c


@pytest.fixture(scope="module")
def texts(con):
    return con.sql("SELECT doc_id, coalesce(text, ''), lang FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name):
    return {r.doc_id: r for r in Q.QUERIES[name](spark, SF).collect()}


def rest(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql_twin(spark, con, name):
    out = compare(name, Q.QUERIES[name](spark, SF), con, ORACLE[name])
    assert out.ok, out.detail


def test_quality_held_out(spark, con):
    found = rows(spark, "op1_quality")
    labels = dict(con.sql("SELECT doc_id, quality FROM labels").fetchall())
    held = [(found[i], y) for i, y in labels.items() if rest(i, 3) == 1]
    assert all(r.held_out for r, _ in held) and all(0 <= r.score <= 1 for r in found.values())
    assert all(r.predicted == (r.score >= 0.5) for r in found.values())
    good, bad = ([r.score for r, y in held if y == k] for k in (1, 0))
    wins = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert wins > 0.85, wins
    assert len(found) == con.sql("SELECT count(*) FROM documents").fetchall()[0][0]


def test_token_files_against_the_library(spark, texts):
    found = rows(spark, "op2_token_files")
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    start = 0
    for i, text, _ in texts:
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_language_held_out(spark, texts):
    found = rows(spark, "op3_language")
    held = [(found[i].lang_pred, lang) for i, text, lang in texts if rest(i, 4) == 2 and lang]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(found[i].held_out == (rest(i, 4) == 2) for i, _, _ in texts)


def slow_fingerprint(text):
    words = WORD.findall(text.encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, max_bits=4):
    """Least id that can be reached, per id, over all pairs."""
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i, a in prints.items():
            least = min(label[j] for j, b in prints.items() if bin(a ^ b).count("1") <= max_bits)
            if least < label[i]:
                label[i], changed = least, True
    return label


def test_simhash_all_pairs(spark, texts):
    found = rows(spark, "op4_simhash")
    prints = {i: slow_fingerprint(text) for i, text, _ in texts}
    assert {i: r.fingerprint for i, r in found.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in found.items()} == slow_components(prints)


def test_rule_measures(spark, texts):
    found = rows(spark, "op5_quality_rules")
    for i, text, _ in texts:
        words = WORD.findall(text.encode())
        windows = list(zip(words, words[1:], words[2:]))
        times, covered = Counter(windows), set()
        for k, w in enumerate(windows):
            if times[w] > 1:
                covered |= {k, k + 1, k + 2}
        lines = [x for x in text.split("\n") if WORD.search(x.encode())]
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), len(re.sub("[\x20\x09-\x0d]", "", text)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered)), i
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r.base_failed and r.kept)


def test_rules_keep_good_documents(spark, con):
    found = rows(spark, "op5_quality_rules")
    good = [found[i] for i, in con.sql("SELECT doc_id FROM labels WHERE quality = 1").fetchall()]
    assert all(r.kept for r in good if not r.base_failed)


def test_lm_base_and_gain(spark, texts):
    found = rows(spark, "op8_lm_scoring")
    tokens = {i: WORD.findall(text.encode().lower()) + [b"\n"] for i, text, _ in texts}
    counts = Counter(w for i, t in tokens.items() if rest(i, 5) != 1 for w in t)
    n, v = sum(counts.values()), len(counts)
    for i, t in tokens.items():
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            rest(i, 5) == 1, len(t), sum(counts[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_mix_meets_targets(spark):
    out = Q.QUERIES["op9_mixing"](spark, SF).collect()
    assert all(r.taken <= 3 * r["size"] for r in out)
    by = {}
    for r in out:
        t = by.setdefault(r.source_size, [r.target, 0, 0])
        t[1] += r.taken
        t[2] = max(t[2], r["size"])
    for target, taken, largest in by.values():
        assert abs(taken - target) <= largest
    again = Q.QUERIES["op9_mixing"](spark, SF).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_pipeline_against_its_parts(spark, con, texts):
    """Each stage's decisions, taken again one by one from the stages' definitions."""
    import corpus_pipeline as P

    out = P.run(spark, SF).collect()
    lang = rows(spark, "op3_language")
    left = {i: text for i, text, _ in texts if lang[i].lang_pred != "und" and lang[i].score >= 0.5}
    label = slow_components({i: slow_fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if label[i] == i}
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    windows = set()
    for t, in con.sql("SELECT text FROM benchmark").fetchall():
        w = low(t)
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} - {()}
    sizes = {len(w) for w in windows}
    left = {i: t for i, t in left.items()
            if not any(tuple(w[k:k + s]) in windows for w in [low(t)] for s in sizes for k in range(len(w) - s + 1))}
    # the mix: which documents and how often, from the operator's twin in SQL
    con.register("kept_ids", __import__("pandas").DataFrame({"doc_id": list(left)}))
    con.sql("CREATE OR REPLACE TEMP TABLE kept AS SELECT d.* FROM documents d JOIN kept_ids USING (doc_id)")
    taken = con.sql(ORACLE["op9_mixing"].replace("FROM documents", "FROM kept")).fetchall()
    copies = {i: t // s for i, s, _, _, t in taken if s}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = [], 0
    for i in sorted(left):
        ids = np.array([*tok.encode(left[i], add_special_tokens=False).ids, 2], "<u4")
        for _ in range(copies[i]):
            expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert sorted(tuple(r) for r in out) == expected
