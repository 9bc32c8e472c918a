"""Conversation repair against an exhaustive search, over chunks and batches, and its edge cases."""

import functools
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import queries as Q
from ledgerline.llm import turns as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = {"": 0, "s": 1, "u": 2, "a": 3}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        said = text.strip(T.SPACES)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "sound")
        seen.add((role, text))
    return out


def slow(rows):
    """Cost, audit and repaired lines by trying everything. rows: (turn, role, text) in order."""
    kinds = faults(rows)

    @functools.lru_cache(maxsize=None)
    def best(at, last, inserted):
        found = []
        if at == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        following = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[following]
        if inserted < 2:
            c, audit, said = best(at, following, inserted + 1)
            found.append((c + 5, "I" + audit, (name + ":", *said)))
        if at < len(rows):
            _, role, text = rows[at]
            c, audit, said = best(at + 1, last, 0)
            found.append((c + 2, "D" + audit, said))
            if kinds[at] in ("truncated", "sound"):
                more = 5 * (kinds[at] == "truncated")
                if role[:1] == following or role[:1] == "s" and last == "":
                    c, audit, said = best(at + 1, role[:1], 0)
                    found.append((c + more, "K" + audit, (f"{role}:{text}", *said)))
                c, audit, said = best(at + 1, following, 0)
                found.append((c + 1 + more, "R" + audit, (f"{name}:{text}", *said)))
        return min(found) if found else (10 ** 9, "", ())
    return best(0, "", 0)


def some_rows(rng, n):
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?", "so\n", "and. ", "é"]
    return [(rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "u2", " "]),
             rng.choice(texts)) for _ in range(n)]


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    kinds, (cost, audit, said) = faults(rows), slow(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(said).encode()).hexdigest()}, said


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(11)
    return {k: some_rows(rng, rng.choice([1, 2, 3, 5, 8, 13, 40])) for k in range(150)}


@pytest.mark.parametrize("chunk, batch", [(T.CHUNK, "10000"), (3, "7")])
def test_repair_is_the_cheapest(spark, cases, chunk, batch):
    """Also with conversations over several chunks and Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = [(k, *r) for k, rs in cases.items() for r in rs]
        random.Random(5).shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA)
        found = T.repair(df, chunk)
        got = {r.conv_id: r.asDict() for r in found.collect()}
        assert set(got) == set(cases)
        lines: dict = {}
        for r in sorted(T.repaired(df, found).collect(), key=lambda r: (r.conv_id, r.position)):
            lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        for k, rs in cases.items():
            want, said = expected(rs)
            assert {c: got[k][c] for c in want} == want, rs
            assert tuple(lines.get(k, ())) == said
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_giant_conversation_folds(spark):
    n = 1000
    rows = [(1, k, "user" if k % 3 else "assistant", f"text {k}." if k % 5 else "cut") for k in range(n)]
    whole, folded = (T.repair(spark.createDataFrame(rows, SCHEMA), chunk).first() for chunk in (T.CHUNK, 64))
    assert whole == folded and len(whole.audit) >= n


def test_edge_cases(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (7, 2 ** 62, "user", "Hi."), (7, -2 ** 62, "user", "Hi."),
            (8, None, "assistant", "Yes."), (8, None, "user", "Why?"), (9, 0, "user", "word " * 300_000 + "."), (9, 1, "assistant", "So.")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("conv", "chunk", "state", "first", "audit", "kind")])
    got = {r.conv_id: r for r in T.repair(df).collect()}
    assert (got[None].audit, got[None].blank, got[None].cost) == ("DD", 1, 4)
    assert (got[7].gaps, got[7].duplicate, got[7].audit) == (2 ** 63 - 1, 1, "DD")
    assert (got[8].gaps, got[8].audit, got[8].cost) == (0, "RR", 2)
    assert (got[9].audit, got[9].cost) == ("KK", 0)
    assert T.repair(df.filter("false")).count() == 0
    assert T.repaired(df.filter("false"), T.repair(df.filter("false"))).count() == 0


def test_damage_follows_the_crc(spark):
    import zlib
    rows = [(c, t, None if t == 3 else "assistant", "One. Two? ok!") for c in [*range(40), None] for t in [*range(6), None]]
    kept = {}
    for r in Q.damaged(spark.createDataFrame(rows, SCHEMA)).collect():
        kept.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role = "user" if fault == 4 else " " if role is None else role
        text = {1: "", 2: "One Two ok"}.get(fault, text)
        assert kept.get((c, t), []) == ([] if fault == 0 else [(role, text)] * (2 if fault == 3 else 1))


def test_conversations_that_lose_every_row(spark, tmp_path):
    import zlib
    gone = next(c for c in range(10 ** 6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    row = Q.op12_turn_repair(spark, str(tmp_path)).first()
    assert row.asDict() == {"conv_id": gone, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0,
                            "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
