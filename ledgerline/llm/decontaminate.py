"""Benchmark decontamination over a positional inverted index, DataFrame functions only.

Terms are maximal runs of letters and digits (any non-ASCII character counts)
after A-Z are lower-cased. A benchmark item's windows are its runs of ``WINDOW``
consecutive terms, or the whole item if it has fewer. The index stores the
postings (document, position) of every training token that is a benchmark term.

Exact phrase matches: for each window the lists of its rarest term and of its
second rarest are intersected, adjusted by their offsets; what is left is
compared with the document's terms, which must all be in place.

Proximity matches: a start at which at least ``NEAR_SHARE`` of a window's terms
are within ``SLOP`` places of their own, no exact match of the window being
within ``SLOP``. A passage usually matches at several starts, each counted. If k
terms may be missing, one of the k + 1 rarest is there (a term that no document
has is among them, and missing): each of their postings, with the terms around
it, is compared with the window. Terms are compared by their 64-bit hashes.

Only exact matches make a document ``contaminated``, and only they are removed by
``clean_documents`` and so by the pipeline; proximity matches are reported.

Scale: tokens are matched with the benchmark's vocabulary inside the scan and
only then written; document frequencies are counted from the index, so the hot
terms' lists are read for counting but joined only where no rarer term exists.
Only postings of rarest terms get the terms around them.
Every join is on a term, or on (document, window), or on the document; none
pairs all documents with all windows. Nothing is collected to the driver; a
side is broadcast only where its written size is under the session's threshold.

Defined results: null and empty texts have no terms; a null document id is an
id; rows with equal id and text get equal results; null item ids are left out
of the item list; items without terms are ignored; a repeated item counts once;
an empty benchmark leaves every document clean; other columns are ignored by
``scan`` and kept by ``clean_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as C

WINDOW = 10
SLOP = 2
NEAR_SHARE = 0.8


def terms(text: str = "text") -> Column:
    return F.filter(F.split(C.ascii_lower(C.text_or_empty(text)), C.TERM_GAP), lambda w: w != "")


def barrier(df: DataFrame, col: Column, name: str, *keep: str) -> DataFrame:
    """``col`` computed once per row: a projection could be merged into the
    expressions that use it, and then be computed for each use."""
    return df.select(*keep, F.explode(F.array(col)).alias(name))


def document_key() -> list[Column]:
    """Documents are told apart by id and text, as ids can repeat."""
    return [F.col("doc_id"), F.xxhash64(C.text_or_empty()).alias("text_hash")]


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows: terms (array), item_ids (array of strings)."""
    items = barrier(benchmark.select("item_id", C.text_or_empty().alias("text")), terms(), "words", "item_id")
    n = F.size("words")
    runs = F.when(n >= size, F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))),
                                         lambda i: F.slice(F.col("words"), i + 1, F.lit(size)))
                  ).otherwise(F.array("words"))
    return (items.filter(n > 0).select("item_id", F.explode(runs).alias("terms"))
            .groupBy("terms").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")))


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings (doc_id, text_hash, position, term_id) of the tokens in ``vocabulary``
    (term, term_id), written to the shared folder."""
    tokens = docs.select(*document_key(), F.posexplode(terms()).alias("position", "term"))
    return C.written(tokens.join(vocabulary, "term").drop("term"), "postings")


def ranked_terms(windows: DataFrame, vocabulary: DataFrame, index: DataFrame) -> DataFrame:
    """The two rarest terms of each window that can occur: window_id, size, and
    term_id, offset of the first and the second (null for a window of one term).
    A window with a term that no document has is dropped."""
    counts = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("occurrences"))
    placed = windows.select("window_id", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    known = placed.join(vocabulary, "term").join(counts, "term_id")
    order = F.array_sort(F.collect_list(F.struct("occurrences", "term_id", "offset")))
    return (known.groupBy("window_id", "size").agg(order.alias("t")).filter(F.size("t") == F.col("size"))
            .select("window_id", "size", F.col("t")[0]["term_id"].alias("term_1"), F.col("t")[0]["offset"].alias("offset_1"),
                    F.get("t", F.lit(1))["term_id"].alias("term_2"), F.get("t", F.lit(1))["offset"].alias("offset_2")))


def candidates(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """Distinct (doc_id, text_hash, window_id, start): the two rarest terms are in place."""
    key = ["doc_id", "text_hash", "window_id"]
    first = (index.join(ranked.withColumnRenamed("term_1", "term_id"), "term_id")
             .select(*key, (F.col("position") - F.col("offset_1")).alias("start"), F.col("term_2").isNull().alias("alone")))
    second = (index.join(ranked.filter("term_2 is not null").withColumnRenamed("term_2", "term_id"), "term_id")
              .select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("window_id").alias("w"),
                      (F.col("position") - F.col("offset_2")).alias("s")).distinct())
    both = (first.filter("not alone").distinct()
            .join(second, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
                  & (F.col("window_id") == F.col("w")) & (F.col("start") == F.col("s")), "left_semi"))
    return both.select(*key, "start").unionByName(first.filter("alone").select(*key, "start")).distinct()


def hashes(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def anchors(windows: DataFrame, vocabulary: DataFrame, index: DataFrame, near_share: float = NEAR_SHARE) -> DataFrame:
    """(term_id, window_id, offset, may_miss, hashes): the may_miss + 1 rarest terms of
    each window; a term without postings is the rarest."""
    counts = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("occurrences"))
    placed = windows.select("window_id", "terms", F.posexplode("terms").alias("offset", "term"))
    known = placed.join(vocabulary, "term").join(counts, "term_id", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("occurrences", F.lit(0)).alias("n"), "term_id", "offset")))
    may_miss = (F.size("terms") - F.ceil(F.size("terms") * near_share)).cast("int")
    return (known.groupBy("window_id", "terms").agg(order.alias("t")).withColumn("may_miss", may_miss)
            .select("window_id", "may_miss", hashes("terms").alias("hashes"),
                    F.explode(F.slice("t", F.lit(1), F.col("may_miss") + 1)).alias("a"))
            .select("a.term_id", "window_id", "a.offset", "may_miss", "hashes"))


def proximity(docs: DataFrame, windows: DataFrame, vocabulary: DataFrame, index: DataFrame, size: int = WINDOW,
              slop: int = SLOP, near_share: float = NEAR_SHARE) -> DataFrame:
    """Distinct (doc_id, text_hash, window_id, start) of the proximity matches."""
    rarest = C.written(anchors(windows, vocabulary, index, near_share), "anchors")
    spots = (index.join(rarest.select("term_id").distinct(), "term_id")
             .groupBy(F.col("doc_id").alias("s_doc"), F.col("text_hash").alias("s_hash"))
             .agg(F.collect_list(F.struct("position", "term_id")).alias("spots")))
    keyed = docs.select(*document_key(), "text").dropDuplicates(["doc_id", "text_hash"])
    with_spots = keyed.join(spots, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("text_hash") == F.col("s_hash")))
    words = barrier(with_spots, terms(), "words", "doc_id", "text_hash", "spots")
    # so many places to either side can matter; those before the text are null
    reach = size - 1 + 2 * slop
    padded = barrier(words, F.concat(F.array_repeat(F.lit(None).cast("bigint"), reach), hashes("words")), "padded",
                     "doc_id", "text_hash", "spots")
    around = (padded.select("doc_id", "text_hash", F.explode(F.transform("spots", lambda s: F.struct(
        s["position"].alias("position"), s["term_id"].alias("term_id"),
        F.slice("padded", s["position"] + 1, F.lit(2 * reach + 1)).alias("context")))).alias("s"))
              .select("doc_id", "text_hash", "s.*"))
    met = around.join(rarest, "term_id")
    # the places that the window's terms can take if this posting is one of them
    place = F.slice("context", F.lit(reach - 2 * slop + 1) - F.col("offset"), F.size("hashes") + 4 * slop)
    met = barrier(met, place, "place", "doc_id", "text_hash", "window_id", "hashes", "may_miss",
                  (F.col("position") - F.col("offset")).alias("start"))
    met = met.filter(F.size(F.array_intersect("hashes", "place")) >= F.size(F.array_distinct("hashes")) - F.col("may_miss"))

    def exact(shift: Column) -> Column:
        return F.slice("place", shift + 2 * slop + 1, F.size("hashes")) == F.col("hashes")

    def close(shift: Column) -> Column:
        there = F.filter("hashes", lambda h, i: F.coalesce(
            F.array_contains(F.slice("place", shift + slop + i + 1, F.lit(2 * slop + 1)), h), F.lit(False)))
        return F.size(there) >= F.size("hashes") - F.col("may_miss")
    shifts = lambda n: F.sequence(F.lit(-n), F.lit(n))
    found = barrier(met, F.filter(shifts(2 * slop), exact), "exact", *met.columns)
    starts = F.filter(shifts(slop), lambda d: close(d) & ~F.exists("exact", lambda e: F.abs(e - d) <= slop))
    return (found.select("doc_id", "text_hash", "window_id", "start", F.explode(starts).alias("shift"))
            .select("doc_id", "text_hash", "window_id", (F.col("start") + F.col("shift")).alias("start")).distinct())


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, slop: int = SLOP,
         near_share: float = NEAR_SHARE, near: bool = True) -> DataFrame:
    """One row per document row: doc_id, text_hash, n_words, ``hits`` (exact phrase
    matches: start, size, item_ids) and ``near`` (proximity matches, likewise; null
    if ``near`` is not asked for)."""
    windows = C.written(item_windows(benchmark, size).withColumn("window_id", F.monotonically_increasing_id()),
                        "windows")
    vocabulary = C.written(windows.select(F.explode("terms").alias("term")).distinct()
                           .withColumn("term_id", F.monotonically_increasing_id()), "vocabulary")
    index = build_index(docs, vocabulary)
    ranked = C.written(ranked_terms(windows, vocabulary, index), "ranked-terms")

    def by_document(matched: DataFrame, name: str) -> DataFrame:
        rows = matched.join(windows, "window_id")
        return C.written(rows.groupBy(F.col("doc_id").alias("c_doc"), F.col("text_hash").alias("c_hash"))
                         .agg(F.array_sort(F.collect_list(F.struct("start", "window_id", "terms", "item_ids"))).alias(name)),
                         name)

    def with_matches(rows: DataFrame, found: DataFrame) -> DataFrame:
        return rows.join(found, F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("text_hash") == F.col("c_hash")),
                         "left").drop("c_doc", "c_hash")
    exact = by_document(candidates(index, ranked), "candidates")
    joined = with_matches(docs.select(*document_key(), "text"), exact)
    if near:
        joined = with_matches(joined, by_document(proximity(docs, windows, vocabulary, index, size, slop, near_share), "close"))
    else:
        joined = joined.withColumn("close", F.lit(None).cast(exact.schema["candidates"].dataType))
    tokens = barrier(joined, terms(), "words", "doc_id", "text_hash", "candidates", "close")

    def in_place(c: Column) -> Column:
        return (c["start"] >= 0) & (F.slice(F.col("words"), F.greatest(c["start"], F.lit(0)) + 1, F.size(c["terms"])) == c["terms"])

    def matches(rows: Column) -> Column:
        return F.transform(rows, lambda c: F.struct(c["start"].alias("start"), F.size(c["terms"]).alias("size"),
                                                    c["item_ids"].alias("item_ids")))
    none = F.array().cast(exact.schema["candidates"].dataType)
    return tokens.select("doc_id", "text_hash", F.size("words").cast("bigint").alias("n_words"),
                         matches(F.filter(F.coalesce("candidates", none), in_place)).alias("hits"),
                         matches(F.coalesce("close", none) if near else F.col("close")).alias("near"))


def summary(scanned: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit (words inside an exact match), n_near (proximity
    matches), item_ids and near_ids (sorted strings: the items of either kind of
    match), contaminated (has an exact match)."""
    spots = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1))))

    def items(matches: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.transform(matches, lambda h: h["item_ids"]))))
    n_near = F.when(F.col("near").isNotNull(), F.size("near").cast("bigint"))
    return scanned.select("doc_id", "text_hash", "n_words", F.size(spots).cast("bigint").alias("n_hit"),
                          n_near.alias("n_near"), items("hits").alias("item_ids"), items("near").alias("near_ids"),
                          (F.size("hits") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold an exact match of a benchmark window;
    proximity matches stay."""
    dirty = (scan(docs.select("doc_id", "text"), benchmark, size, near=False).filter(F.size("hits") > 0)
             .select(F.col("doc_id").alias("c_doc"), F.col("text_hash").alias("c_hash")).distinct())
    dirty = C.written(dirty, "contaminated")
    rows = docs.select(F.struct("*").alias("row"), *document_key())
    kept = rows.join(dirty, F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("text_hash") == F.col("c_hash")), "left_anti")
    return kept.select("row.*")
