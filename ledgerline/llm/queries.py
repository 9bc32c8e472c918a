"""The queries of this subpackage: each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (chat_events, collocations, decontaminate, language, minhash, mixing, ngram_lm, quality, rules, simhash,
                            token_files, turns, warc)
from ledgerline.llm import common as C
from ledgerline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return C.table(spark, sf, "documents")


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Ridge fit on the labelled rows of remainder 0, calibration on those of 2."""
    docs = documents(spark, sf).select("doc_id", "text")
    features = C.written(docs.select("doc_id", quality.statistics_of("text").alias("x")), "quality-statistics")
    rest = C.id_bucket("doc_id", 3)
    labels = (C.table(spark, sf, "labels").filter(rest != 1)
              .select("doc_id", F.col("quality").alias("y"), (rest == 2).alias("calibrate")))
    model = quality.fit(features, labels)
    found = features.select("doc_id", (rest == 1).alias("held_out"), quality.scores(features, model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = token_files.write(documents(spark, sf), scratch_path(spark, "token-files"),
                             public_tokenizers.path("byte_bpe_50k.json"))
    return token_rows(spark, path)


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """What the files of ``path`` hold, per document."""
    sums = token_files.read_tokens(spark, path).select("row_no", token_files.ids_crc32("tokens").alias("ids_crc32"))
    return (token_files.read_index(spark, path).join(sums, "row_no")
            .select("doc_id", "start", "n_tokens", "ids_crc32"))


def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    held_out = C.id_bucket("doc_id", 4) == 2
    model = language.train(docs.filter(~held_out))
    return (docs.select("doc_id", held_out.alias("held_out"), language.predict(docs, model).alias("found"))
            .select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")))


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.components(documents(spark, sf).select("doc_id", "text"))
    return found.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return (docs.select("doc_id", rules.judge(docs).alias("r"))
            .select("doc_id", "r.n_words", "r.word_chars", "r.n_symbols", "r.n_dup_lines", "r.n_repeat_words",
                    "r.base_failed", "r.kept"))


def op8_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    held_out = C.id_bucket("doc_id", 5) == 1
    found = ngram_lm.score(docs, ~held_out, held_out.cast("int"))
    return found.select("doc_id", (F.col("tag") == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score")


def capture_log(pages: DataFrame) -> DataFrame:
    """A crawl log over ``pages``: each page is a full response, later revisited (and
    some also before) by a 304 whose URL spelling, validators and fields vary by
    page id."""
    i = F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring(F.md5(C.text_or_empty("html").cast("binary")), 1, 16), F.lit('"'))
    at = lambda minutes: F.timestamp_seconds(F.lit(1704067200) + (i + minutes) * 60)
    day = F.date_format(at(F.lit(0)), "yyyy-MM-dd HH:mm:ss")
    response = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nCache-Control: max-age=60\r\nDate: "), day,
                        F.lit("\r\nLast-Modified: "), day,
                        F.when(i % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("\r\nETag: "), tag)))
    check = (F.when(i % 6 == 0, F.concat(F.lit("\r\nETag: W/"), tag))
             .when(i % 6 == 1, F.concat(F.lit("\r\netag: "), tag))
             .when(i % 6 == 2, F.lit('\r\nETag: "other"'))
             .when(i % 6 == 3, F.concat(F.lit("\r\nLast-Modified: "), day))
             .when(i % 6 == 4, F.lit("")).otherwise(F.lit("\r\nLast-Modified: never")))
    revisit = F.concat(F.lit("HTTP/1.1 304 Not Modified\r\nServer: none\r\nCache-Control: max-age=120\r\nDate: "),
                       F.date_format(at(F.lit(1440)), "yyyy-MM-dd HH:mm:ss"), check)
    url = F.when(i % 2 == 0, F.concat("url", F.lit("#top"))).otherwise(F.col("url"))
    record = lambda kind, uri, when, head, payload: F.struct(
        F.concat(F.lit(kind + "-"), i.cast("string")).alias("record_id"), uri.alias("target_uri"),
        when.alias("warc_date"), F.lit("response" if kind == "full" else "revisit").alias("warc_type"),
        head.alias("http_head"), payload.alias("payload"))
    none = F.lit(None).cast("string")
    both = F.array(record("full", F.col("url"), at(F.lit(0)), response, F.col("html")),
                   record("later", url, at(F.lit(1440)), revisit, none))
    early = F.array(record("early", url, at(F.lit(-1)), revisit, none))
    return pages.select(F.inline(F.when(i % 6 == 1, F.concat(both, early)).otherwise(both)))


def op6_warc_revisits(spark: SparkSession, sf: str) -> DataFrame:
    out = warc.resolve(capture_log(C.table(spark, sf, "pages")))
    return out.select("record_id", "url", "status", "response_id",
                      F.md5(F.col("http_head").cast("binary")).alias("head_md5"),
                      F.length("payload").cast("bigint").alias("payload_chars"),
                      F.md5(F.col("payload").cast("binary")).alias("payload_md5"))


def op7_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    extra = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(n).cast("bigint").alias("turn"),
                 F.lit(role).alias("role"), F.lit(probe).alias("text"))
        for n, role in enumerate(("user", "assistant"))])))
    out = chat_events.format_chats(chat_events.message_events(rows.unionByName(extra)))
    read = out.select("conv_id", "formatted", chat_events.parsed_turns().alias("turns"),
                      chat_events.loss_text().alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("bigint").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    out = mixing.mix(C.table(spark, sf, "documents").select("doc_id", "text", "source"))
    return out.select("row.doc_id", "mix.size", "mix.source_size", F.round("mix.target", 6).alias("target"),
                      (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Exact matches; its SQL twin has no others."""
    found = decontaminate.summary(decontaminate.scan(C.table(spark, sf, "documents").select("doc_id", "text"),
                                                     C.table(spark, sf, "benchmark"), near=False))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                        "contaminated")


def op10_proximity(spark: SparkSession, sf: str) -> DataFrame:
    """Exact and proximity matches."""
    found = decontaminate.summary(decontaminate.scan(C.table(spark, sf, "documents").select("doc_id", "text"),
                                                     C.table(spark, sf, "benchmark")))
    digest = lambda ids: F.sha2(F.array_join(ids, ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        digest("item_ids").alias("items_sha256"), "n_near",
                        F.size("near_ids").cast("bigint").alias("n_near_items"),
                        digest("near_ids").alias("near_items_sha256"), "contaminated")


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf).select("lang", "text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the faults that the crc32 of ``conv_id:turn`` names."""
    name = F.concat(turns.space_for_null("conv_id_text"), F.lit(":"), turns.space_for_null("turn_text"))
    text, role = turns.space_for_null("text"), turns.space_for_null("role")
    rows = (conversations.select("conv_id", "turn", "role", "text", F.col("conv_id").cast("string").alias("conv_id_text"),
                                 F.col("turn").cast("string").alias("turn_text"))
            .withColumn("fault", F.crc32(name.cast("binary")) % 20))
    copies = F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))
    return (rows.filter("fault != 0")
            .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(role).alias("role"),
                    F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(text, "[.!?]", ""))
                    .otherwise(text).alias("text"), F.explode(copies).alias("copy")).drop("copy"))


def op12_turn_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.table(spark, sf, "conversations")
    found = turns.repair(damaged(rows)).withColumnRenamed("conv_id", "found_id")
    every = rows.select("conv_id").distinct()
    none = {c: F.coalesce(c, F.lit(0)) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    none |= {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))}
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").drop("found_id").withColumns(none)


def op13_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.components(documents(spark, sf).select("doc_id", "text"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_token_files": op2_token_files,
    "op3_language": op3_language,
    "op4_simhash": op4_simhash,
    "op5_quality_rules": op5_quality_rules,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_mixing": op9_mixing,
    "op10_decontamination": op10_decontamination,
    "op10_proximity": op10_proximity,
    "op11_collocations": op11_collocations,
    "op12_turn_repair": op12_turn_repair,
    "op13_minhash": op13_minhash,
}
