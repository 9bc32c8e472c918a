"""Nulls, empty and very long texts, repeated rows, empty tables and clashing extra
columns, for every operator and pipeline stage."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerline.llm import (chat_events, decontaminate, language, mixing, ngram_lm, quality, rules, simhash,
                            token_files, warc)
from ledgerline.llm import common as C
from ledgerline.session import scratch_path

LONG = "word " * 300_000 + "end"
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog and runs home again", "en", "a", 5, "x"),
    (1, "The quick brown fox jumps over the lazy dog and runs home again", "en", "a", 5, "x"),
    (2, None, None, None, None, None), (3, "", "en", "a", 0, ""), (None, "a text without an id", "en", None, 1, "y"),
    (None, None, None, None, None, None), (4, LONG, "en", "b", 9, "z"), (5, " \n\t ", "fr", "b", 3, "z"),
    (6, "123 456 !!", "fr", "b", 3, "z"), (7, "le chat est sur la table et le chien dort", "fr", "c", 3, "z"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string"
#: Names that operators use inside.
CLASHES = ["score", "words", "position", "term", "size", "key", "part", "fingerprint", "rep", "tokens", "start", "mix",
           "found", "copies", "text_hash", "train", "tag", "block", "candidates", "x", "y", "status"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, SCHEMA)
    return C.written(df.select("*", *[F.lit("clash").alias(c) for c in CLASHES]), "edge-docs")


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge"))
    items = [(1, "brown fox jumps over the lazy dog and runs home again today"), (2, None), (3, ""), (None, "chat est sur"),
             (4, "table ET"), (4, "table ET")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_language(docs, none):
    model = language.train(docs)
    assert model.langs == ["en", "fr"]
    got = docs.select("doc_id", "text", language.predict(docs, model).alias("p")).collect()
    assert len(got) == len(DOCS)
    for r in got:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.p.lang == "und") == (not has_letter)
        assert r.p.score == 0 if r.p.lang == "und" else 0 < r.p.score <= 1
    blank = language.train(none)
    assert {r.p.lang for r in docs.select(language.predict(docs, blank).alias("p")).collect()} == {"und"}
    assert none.select(language.predict(none, model)).count() == 0


def test_language_slices_do_not_change_what_is_counted():
    texts = ["ab cd" * 100, None, "", "12", "x"]
    assert [i for o, _ in language.slices(texts, 7) for i in o][-1] == 4
    assert "".join(p for _, ps in language.slices(texts, 7) for p in ps) == "".join(t or "" for t in texts)
    assert language.bucket_bits(4) == 16 and language.bucket_bits(1000) < 16
    with pytest.raises(ValueError):
        language.bucket_bits(1 << 20)


def test_language_slices_have_the_grams_of_the_whole():
    import numpy as np
    text = "Straße ünd ΣΑΣ  weiß\tnicht, " * 400 + "x" * 5000 + " the end"
    whole = np.bincount(language.grams([text], 16)[0], minlength=1 << 16)
    for size in (1, 7, 100, 1000):
        parts = [p for _, ps in language.slices([text, None, "b"], size) for p in ps]
        assert "".join(parts) == text + "b"
        cut = sum(np.bincount(language.grams([p], 16)[0], minlength=1 << 16) for p in parts[:-1])
        assert (cut == whole).all()


def test_quality(spark, docs, none):
    features = docs.select("doc_id", quality.statistics_of("text").alias("x"))
    labels = spark.createDataFrame([(1, 1, False), (2, 0, False), (3, 0, True), (4, 1, True), (4, 1, True), (5, None, True),
                                    (None, 1, False)], "doc_id bigint, y int, calibrate boolean")
    model = quality.fit(features, labels)
    got = [r.s for r in features.select(quality.scores(features, model).alias("s")).collect()]
    assert len(got) == len(DOCS) and all(0 <= s <= 1 for s in got)
    one_class = quality.fit(features, labels.filter("y = 1"))
    assert {r.s for r in features.select(quality.scores(features, one_class).alias("s")).collect()} == {1.0}
    nothing = quality.fit(features, labels.filter("false"))
    assert {r.s for r in features.select(quality.scores(features, nothing).alias("s")).collect()} == {0.5}
    gone = none.select("doc_id", quality.statistics_of("text").alias("x"))
    assert gone.select(quality.scores(gone, model)).count() == 0


def test_quality_without_rows_to_calibrate_with(spark):
    good, bad = "Plain words make a sentence of some length here.", "### $$$ ||| ### $$$"
    rows = spark.createDataFrame([(i, bad if i % 2 else f"{good} {i}") for i in range(40)], "doc_id bigint, text string")
    features = rows.select("doc_id", quality.statistics_of("text").alias("x"))
    labels = rows.select("doc_id", (1 - F.col("doc_id") % 2).alias("y"), F.lit(False).alias("calibrate"))
    model = quality.fit(features, labels)
    got = {r.doc_id: r.s for r in features.select("doc_id", quality.scores(features, model).alias("s")).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and min(got[0], got[2]) > 0.8 and max(got[1], got[3]) < 0.2


def test_isotonic_pools_violators():
    at, level = quality.isotonic([0, 1, 2, 3], [1, 1, 1, 1], [0, 1, 0, 1])
    assert level.tolist() == [0.0, 0.5, 1.0] and at.tolist() == [0.0, 1.5, 3.0]


def test_rules(docs, none):
    got = docs.select("doc_id", "text", rules.judge(docs).alias("r")).collect()
    assert len(got) == len(DOCS)
    for r in got:
        assert r.r.n_words == len((r.text or "").split(None)) if r.text != LONG else r.r.n_words == 300_001
        assert r.r.kept == (r.r.rejected_by is None)
    assert none.select(rules.judge(none)).count() == 0


def test_rule_order_never_changes_the_verdict(docs):
    text = "#tag " * 60 + "WORDS " * 10
    verdicts = {any(rules.RULES[n](rules.Text(text)) for n in order) for order in (list(rules.RULES), list(rules.RULES)[::-1])}
    assert len(verdicts) == 1


def test_cascade_prefers_cheap_rejections(docs):
    assert set(rules.cascade(docs, sample=5)) == set(rules.RULES)


def test_token_files(spark, docs, none):
    import public_tokenizers
    tok = public_tokenizers.path("byte_bpe_50k.json")
    path = token_files.write(docs, scratch_path(spark, "edge-tokens"), tok)
    index = token_files.read_index(spark, path).orderBy("row_no").collect()
    assert [r.doc_id for r in index] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7]
    total = 0
    for r in index:
        assert r.start == total
        total += r.n_tokens
    assert [r.n_tokens for r in index if r.doc_id in (2, 3)] == [1, 1]
    some = token_files.read_tokens(spark, path, 3, 5).collect()
    assert sorted(r.doc_id for r in some) == [3, 4, 5] and all(r.tokens[-1] == 2 for r in some)
    empty = token_files.write(none, scratch_path(spark, "edge-tokens"), tok)
    assert token_files.read_index(spark, empty).count() == 0 and token_files.read_tokens(spark, empty).count() == 0


def test_token_pieces_equal_the_whole():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    encoder, rng = token_files.Encoder(path), random.Random(3)
    parts = [" ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", "　", "word", "Don't", "it's", "'ll", "...", "a1b2", "é", "ß",
             "漢字", "α", "²3", "—,", "<|endoftext|>", "x" * 300, "😀", "é", "_", "'", "!", "İ", "n't"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        ids = tok.encode(text, add_special_tokens=False).ids
        [raw] = encoder([text])
        assert [int.from_bytes(raw[k:k + 4], "little") for k in range(0, len(raw), 4)] == ids, repr(text)


def test_token_pieces_are_encoded_once_and_memory_is_bounded():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    encoder, asked = token_files.Encoder(path, memory=20), []
    encode = encoder.encode
    encoder.encode = lambda pieces: asked.extend(pieces) or encode(pieces)
    steps = [["the Zanzibar, kumquat! Zanzibar", "a Zanzibar.\nkumquat and\n", "odd  Quito"], ["my kumquat? Zanzibar", ""],
             [f"some x{i} y{i}!! ñandú" for i in range(100)], [], ["my kumquat? Zanzibar\nx1"]]
    for k, texts in enumerate(steps):
        asked.clear()
        found = encoder(texts)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert ("Zanzibar" in "".join(asked)) == (k in (0, 4)), (k, asked)
    assert len(encoder.pieces) == len(encoder.ids) <= 20


def test_token_file_encodings(spark, docs):
    import glob

    import public_tokenizers
    import pyarrow.parquet as pq
    path = token_files.write(docs, scratch_path(spark, "edge-tokens"), public_tokenizers.path("byte_bpe_50k.json"))
    files = [pq.ParquetFile(f) for f in glob.glob(path.removeprefix("file:") + "/tokens/*.parquet")]
    group = next(f.metadata.row_group(0) for f in files if f.metadata.num_rows)
    columns = {group.column(i).path_in_schema.split(".")[0]: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["tokens"].encodings)
    assert columns["doc_id"].has_column_index and columns["tokens"].has_offset_index


def test_simhash(docs, none):
    got = simhash.components(docs).collect()
    assert len(got) == len(DOCS)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    # 2 (null), 3 (empty) and 5 (blank) have no words: fingerprint zero, one component
    assert {by[i][0].component_id for i in (2, 3, 5)} == {2} and by[2][0].fingerprint == 0
    assert [r.component_id for r in by[1]] == [1, 1]
    assert sorted((r.component_id for r in by[None]), key=str) == [2, None]
    assert simhash.components(none).count() == 0


def test_simhash_one_of_each(docs, none):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.select("doc_id").collect()], key=str) == [1, 2, 4, 6, 7, None]
    assert simhash.one_of_each(none).count() == 0


@pytest.mark.parametrize("block", [4096, 8])
def test_simhash_blocks_lose_no_link(spark, block):
    """A dense group, chains and strays, in one bucket or cut into blocks."""
    import random
    rng, prints = random.Random(5), []
    centre = rng.getrandbits(64)
    for _ in range(150):
        prints.append(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    step = rng.getrandbits(64)
    for k in range(12):
        step ^= sum(1 << b for b in rng.sample(range(64), 4))
        prints.append(step)
    prints += [rng.getrandbits(64) for _ in range(40)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fingerprint bigint")
    got = {r.doc_id: r.component_id for r in simhash.assigned(df, block=block).collect()}
    label = {i: i for i in range(len(prints))}
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            least = min(label[j] for j, b in enumerate(prints) if bin(a ^ b).count("1") <= 4)
            if least < label[i]:
                label[i], changed = least, True
    assert got == label


def test_thresholds_follow_the_pigeonhole_principle(spark):
    df = spark.range(300).select(F.xxhash64("id").alias("fingerprint"), F.col("id").alias("rep"))
    parts = simhash.plan(df)
    assert sum(p.threshold + 1 for p in parts) == simhash.MAX_BITS + 1
    bits = [b for p in parts for b in p.bits]
    assert len(bits) == len(set(bits)) <= 64


def test_decontamination(docs, none, sf, spark):
    benchmark = C.table(spark, sf, "benchmark")
    got = {(r.doc_id, r.n_words): r for r in decontaminate.summary(decontaminate.scan(docs, benchmark)).collect()}
    # "brown fox ... again" has two windows of ten words that occur
    assert (got[1, 13].n_hit, got[1, 13].item_ids, got[1, 13].contaminated) == (11, ["1"], True)
    assert got[7, 10].item_ids == ["4"] and got[7, 10].n_hit == 5  # "chat est sur" has no item id, "table et" is item 4
    assert got[2, 0].contaminated is False and got[4, 300_001].contaminated is False
    clean = decontaminate.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == len(DOCS) - 3
    assert decontaminate.scan(none, benchmark).count() == 0
    assert decontaminate.summary(decontaminate.scan(docs, benchmark.filter("false"))).filter("contaminated").count() == 0


def test_proximity(spark):
    item = "one two three four five six seven eight nine ten"
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    texts = [(1, item), (2, "one two three four extra five six seven eight nine ten"),
             (3, "one two three and something else"), (4, "ten nine eight seven six five four three two one")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.summary(decontaminate.scan(df, benchmark)).collect()}
    assert (got[1].n_hit, got[1].n_near) == (10, 0)
    assert got[2].n_hit == 0 and got[2].n_near > 0
    assert got[3].n_near == 0 and got[4].n_near == 0


def test_mix(docs, none):
    got = mixing.mix(docs)
    rows = got.collect()
    assert len(rows) == len(DOCS) and rows[0].row.asDict().keys() == set(docs.columns)
    # sources a, b, c, null weigh 5, 2, 1, 5; b has nearly all words, the others stop at three times theirs
    by = {r.row.source: r.mix for r in rows}
    for s in "a", "c", None:
        assert by[s].target == pytest.approx(3 * by[s].source_size)
    total = sum({r.row.source: r.mix.source_size for r in rows}.values())
    assert sum(m.target for m in by.values()) == pytest.approx(total)
    twins = [r.mix.copies for r in rows if r.row.doc_id == 1]
    assert twins[0] == twins[1] == 3
    assert mixing.mix(none).count() == 0


def test_targets_by_repeated_sharing(spark):
    sizes = {f"s{i:02d}": n for i, n in enumerate([10, 1000, 500, 0, 3, 40000, 700, 20])}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = {s: w for s, w in weight.items() if s not in fixed}
        share = {s: (total - sum(fixed.values())) * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in share if share[s] > 3 * sizes[s]]
        if not over:
            break
        fixed |= {s: 3 * sizes[s] for s in over}
    assert got == pytest.approx(fixed | share)


def test_lm(docs, none):
    got = ngram_lm.score(docs, F.lit(True), F.lit(0)).collect()
    assert len(got) == len(DOCS)
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (2, 3, 5))
    untrained = ngram_lm.score(docs, F.lit(False), F.lit(0)).collect()
    assert {(r.train_tokens, r.n_known, r.score, r.base_score) for r in untrained} == {(0, 0, 0.0, 0.0)}
    assert ngram_lm.score(none, F.lit(True), F.lit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 6, 30])
def test_lm_learns_from_few_rows(spark, n):
    """Whether or not a row falls to the held-out share, counts are used: known text is likelier than unknown."""
    said = "the cat sat on the mat and the cat ran"
    rows = [(i, said) for i in range(n)] + [(100, said), (101, "quite other words that nobody has ever said before now")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in ngram_lm.score(df, F.col("doc_id") < 100, F.lit(0)).collect()}
    uniform = -got[100].n_tokens * math.log10(8)   # seven words and the end, and one unseen
    assert got[100].score > uniform + 1 and got[100].score > got[101].score
    assert got[100].score >= got[100].base_score or n == 1


def test_lm_blocks_do_not_change_scores(docs):
    whole, cut = ({(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in
                   ngram_lm.score(docs, F.lit(True), F.lit(0), block_chars=n).collect()} for n in (10 ** 9, 20_000))
    assert whole == cut


def test_lm_weights_rise_with_the_context():
    import numpy as np
    # held-out tokens of bucket 5 fit the bigram, those of bucket 1 don't
    w = ngram_lm.learn_weights(np.array([1, 5]), np.array([0.0, 0.5]), np.array([0.01, 0.01]), np.array([100.0, 100.0]), 1e-6)
    assert w[5, 0] > 0.9 > w[1, 0] and np.allclose(w.sum(axis=1), 1)


def record(record_id, uri, day, kind, head, payload=None):
    return record_id, uri, day and dt.datetime(2024, 1, day), kind, head, payload, "clash"


def test_revisits(spark):
    full = "HTTP/1.1 200 OK\r\nETag: \"a\"\r\nContent-Type: text/html\r\nCache-Control: old\r\nno colon"
    seen = "HTTP/1.1 304 Not Modified\r\netag: W/\"a\"\r\nCache-Control: new\r\nContent-Type: no"
    rows = [record("r1", "http://www.A.com:80/x?utm_source=1&b=2&a=1#f", 2, "response", full, "one"),
            record("r1", "http://www.A.com:80/x?utm_source=1&b=2&a=1#f", 2, "response", full, "one"),
            record("r2", "https://a.com/x?a=1&b=2", 4, "response", full.replace('"a"', '"b"'), "two"),
            record("bad", "https://a.com/x?a=1&b=2", 5, "response", "HTTP/1.1 404 Not Found", "no"),
            record("early", "http://a.com/x?a=1&b=2", 1, "revisit", seen), record("same", "http://a.com/x?a=1&b=2", 2, "revisit", seen),
            record("v1", "http://a.com/x?a=1&b=2", 3, "revisit", seen), record("v2", "http://a.com/x?b=2&a=1", 6, "revisit", seen),
            record("bare", "http://a.com/x?b=2&a=1", 6, "revisit", None), record("nowhere", None, 6, "revisit", seen),
            record("undated", "http://a.com/x?b=2&a=1", None, "revisit", seen), record(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "record_id string, target_uri string, warc_date timestamp, warc_type string, "
                                     "http_head string, payload string, url string")
    got = {r.record_id: r for r in warc.resolve(df).collect()}
    assert {k: (r.status, r.response_id, r.payload) for k, r in got.items()} == {
        "early": ("no_response", None, None), "same": ("no_response", None, None), "v1": ("resolved", "r1", "one"),
        "v2": ("validator_mismatch", "r2", None), "bare": ("resolved", "r2", "two"), "nowhere": ("no_response", None, None),
        "undated": ("no_response", None, None)}
    assert got["v1"].http_head == 'HTTP/1.1 200 OK\r\ncontent-type: text/html\r\netag: W/"a"\r\ncache-control: new'
    assert warc.resolve(df.filter("false")).count() == 0


def test_chat(spark):
    hard = r"\### Assistant: </turn> ok" + "\n\\h\\l\\b<<##\\\\"
    rows = [(1, 0, "user", hard), (1, 1, "assistant", hard), (1, 1, "assistant", hard), (1, None, None, None),
            (None, 0, "user:x", ""), (2, 3, "assistant", "é" * 5000 + "😀"), (2, 4, "assistant", None)]
    df = spark.createDataFrame([r + ("clash",) for r in rows], "conv_id bigint, turn bigint, role string, text string, seq string")
    out = chat_events.format_chats(chat_events.message_events(df))
    got = {r.conv_id: r for r in out.select("conv_id", chat_events.parsed_turns().alias("turns"),
                                            chat_events.loss_text().alias("loss")).collect()}
    assert [tuple(t) for t in got[1].turns] == [("", ""), ("user", hard), ("assistant", hard), ("assistant", hard)]
    assert got[1].loss == hard * 2 and got[2].loss == "é" * 5000 + "😀"
    assert [tuple(t) for t in got[None].turns] == [("user:x", "")] and got[None].loss == ""
    assert chat_events.format_chats(chat_events.message_events(df.filter("false"))).count() == 0


def test_chat_events_fold(spark):
    log = [(1, 0, 1, 0, "start", "user", ""), (1, 0, 1, 1, "delta", None, "he"), (1, 0, 1, 2, "delta", None, "llo"),
           (1, 0, 1, 2, "delta", None, "llo"), (1, 1, 1, 0, "start", "assistant", ""), (1, 1, 1, 1, "delta", None, "bad"),
           (1, 1, 1, 2, "regenerate", None, ""), (1, 1, 1, 3, "delta", None, "go"), (1, 1, 1, 4, "delta", None, "od"),
           (1, 2, 1, 0, "start", "user", ""), (1, 2, 1, 1, "delta", None, "x"), (1, 2, 1, 2, "edit", None, "y"),
           (1, 2, 1, 3, "delta", None, "z")]
    df = spark.createDataFrame(log, "conv_id bigint, turn bigint, copy int, seq bigint, kind string, role string, text string")
    got = [(r.role, r.text) for r in chat_events.fold(df).orderBy("turn").collect()]
    assert got == [("user", "hello"), ("assistant", "good"), ("user", "yz")]


@pytest.mark.parametrize("name", [name for name, _ in P.STAGES])
def test_pipeline_stage(spark, docs, none, sf, name):
    stage = dict(P.STAGES)[name]
    out = stage(spark, docs, sf)
    if name != P.STAGES[-1][0]:
        assert out.columns == docs.columns
    assert 0 < out.count() <= 3 * len(DOCS)
    assert stage(spark, none, sf).count() == 0
