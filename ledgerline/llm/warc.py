"""WARC revisit records ("not modified") resolved to full responses.

A revisit stands for a capture whose server answered 304. It is joined, as of
its date, to the latest strictly earlier full response (a response record with
status 200) of the same canonical URL. Its validators are then checked against
that response: the entity tag by weak comparison if the revisit has one, else
the modification date if it has one; a revisit without validators is accepted.
A resolved revisit gets the response's payload, and the response's header
fields updated by those fields of the 304 that may update a stored response.

Records: record_id, target_uri, warc_date (timestamp), warc_type, http_head
(status line and header lines, CRLF), payload.

Scale: the as-of join sorts events (no payloads) into ranges of (URL, date), so
the events of a URL with a third of all rows are spread over many tasks; inside
a range a running window finds the latest response, and the last response of
each earlier range of the URL is carried over through one row per (URL, range).
Payloads are joined once, by record id, to resolved revisits only; a response that
over a thousandth of them ask for is salted.

Defined results: null in any column is allowed; a revisit with a null or
unusable URL or a null date is ``no_response``; responses at the same instant
as a revisit are not earlier; of several responses at one instant the greatest
record id is the latest; response rows that repeat a record id count once (the
least row); repeated revisit rows are each resolved; header names are compared
without case; a header line without a colon is dropped; empty input gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as C

# --- Fixed values: header fields a 304 may update (RFC 9110, 15.4.5, and Last-Modified, Age, Date).
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = "^(utm_[a-z]+|fbclid|gclid)="
# --- end of fixed values


def canonical_url(col: str) -> Column:
    """Host in lower case without ``www.`` and default port, no scheme, no
    fragment, no tracking parameters, other parameters sorted; null if it isn't
    an absolute http(s) URL."""
    u = F.regexp_replace(F.trim(F.col(col)), "#.*$", "")
    pattern = r"^[hH][tT][tT][pP][sS]?://([^/?]+)([^?]*)(.*)$"
    host = F.regexp_replace(F.lower(F.regexp_extract(u, pattern, 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_extract(u, pattern, 2)
    query = F.regexp_replace(F.regexp_extract(u, pattern, 3), r"^\?", "")
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    joined = F.array_join(params, "&")
    return F.when(u.rlike(pattern),
                  F.concat(host, F.when(path == "", F.lit("/")).otherwise(path),
                           F.when(joined == "", F.lit("")).otherwise(F.concat(F.lit("?"), joined))))


def status_code(head: str) -> Column:
    return F.regexp_extract(F.col(head), r"^HTTP/[0-9.]+ ([0-9]{3})", 1)


def header_fields(head: str) -> Column:
    """Header lines as array<struct<name, value>>, names in lower case."""
    lines = F.filter(F.split(F.coalesce(F.col(head), F.lit("")), "\r\n"), lambda x: F.instr(x, ":") > 1)
    return F.transform(lines, lambda x: F.struct(
        F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"),
        F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("value")))


def field_value(fields: str, name: str) -> Column:
    """The last value of a field, null if absent or blank."""
    v = F.try_element_at(F.filter(F.col(fields), lambda x: x["name"] == name), F.lit(-1))["value"]
    return F.when(v != "", v)


def merged_head(response_head: Column, response_fields: Column, revisit_fields: Column,
                permitted: tuple[str, ...] = PERMITTED) -> Column:
    """The response's status line, its fields that the revisit doesn't replace, then
    the revisit's permitted fields."""
    new = F.filter(revisit_fields, lambda x: x["name"].isin(*permitted))
    names = F.transform(new, lambda x: x["name"])
    kept = F.filter(response_fields, lambda x: ~F.array_contains(names, x["name"]))
    lines = F.transform(F.concat(kept, new), lambda x: F.concat(x["name"], F.lit(": "), x["value"]))
    return F.array_join(F.concat(F.array(F.substring_index(response_head, "\r\n", 1)), lines), "\r\n")


def latest_responses(records: DataFrame) -> DataFrame:
    """The as-of join. Revisits with a URL and date: all event columns plus
    ``response`` (record_id, etag, modified), null if there is no earlier one."""
    fields = records.withColumn("fields", header_fields("http_head"))
    events = fields.select(
        canonical_url("target_uri").alias("url"), "warc_date", "record_id", "http_head",
        ((F.col("warc_type") == "response") & (status_code("http_head") == "200")).alias("full"),
        (F.col("warc_type") == "revisit").alias("revisit"),
        field_value("fields", "etag").alias("etag"), field_value("fields", "last-modified").alias("modified"))
    events = events.filter("(full or revisit) and url is not null and warc_date is not null")
    # of a full response only what the check needs is carried
    events = events.withColumn("http_head", F.expr("if(revisit, http_head, null)"))
    ranged = C.written(C.by_ranges(events, "url", "warc_date", "full", "record_id"), "warc-events")
    answer = F.when(F.col("full"), F.struct("warc_date", "record_id", "etag", "modified"))
    # a revisit sorts before the responses of its own instant
    upto = (Window.partitionBy("url", "part").orderBy("warc_date", "full", "record_id")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = ranged.withColumn("near", F.last(answer, ignorenulls=True).over(upto)).filter("revisit")
    ends = ranged.filter("full").groupBy("url", "part").agg(
        F.max(F.struct("warc_date", "record_id", "etag", "modified")).alias("end"))
    parts = ranged.groupBy("url", "part").agg(F.max("revisit").alias("asks")).join(ends, ["url", "part"], "left")
    earlier = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (parts.withColumn("far", F.last("end", ignorenulls=True).over(earlier))
               .filter("asks and far is not null")
               .select("url", "part", "far"))
    joined = found.join(carried, ["url", "part"], "left")
    best = F.coalesce("near", "far")
    return joined.withColumn("response", best).drop("near", "far", "part")


def resolve(records: DataFrame, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """One row per revisit record: record_id, url, status (``resolved``,
    ``validator_mismatch``, ``no_response``), response_id, and for resolved ones
    the merged http_head and the payload."""
    asof = latest_responses(records)
    strong = lambda c: F.regexp_replace(c, "^W/", "")  # noqa: E731  weak comparison ignores the mark
    valid = (F.when(F.col("etag").isNotNull(),
                    F.coalesce(strong(F.col("etag")) == strong(F.col("response.etag")), F.lit(False)))
             .when(F.col("modified").isNotNull(),
                   F.coalesce(F.col("modified") == F.col("response.modified"), F.lit(False)))
             .otherwise(F.lit(True)))
    checked = asof.select("record_id", "url", "http_head", F.col("response.record_id").alias("response_id"),
                          F.when(F.col("response.record_id").isNull(), "no_response")
                          .when(valid, "resolved").otherwise("validator_mismatch").alias("status"))
    checked = C.written(checked, "warc-checked")
    full = (records.filter((F.col("warc_type") == "response") & (status_code("http_head") == "200")
                           & F.col("record_id").isNotNull())
            .groupBy(F.col("record_id").alias("r_id"))
            .agg(F.min(F.struct(F.col("http_head").alias("head"), "payload")).alias("r")))
    resolved = checked.filter("status = 'resolved'")
    out = (C.join_split(resolved, full, "response_id", "r_id", resolved.count())
           .withColumn("r_fields", header_fields("r.head")).withColumn("v_fields", header_fields("http_head")))
    located = out.select("record_id", "url", "status", "response_id",
                         merged_head(F.col("r.head"), F.col("r_fields"), F.col("v_fields"), permitted).alias("http_head"),
                         F.col("r.payload").alias("payload"))
    none = F.lit(None).cast("string")
    others = checked.filter("status != 'resolved'").select("record_id", "url", "status", "response_id",
                                                           none.alias("http_head"), none.alias("payload"))
    lost = (records.filter((F.col("warc_type") == "revisit")
                           & (canonical_url("target_uri").isNull() | F.col("warc_date").isNull()))
            .select("record_id", canonical_url("target_uri").alias("url"), F.lit("no_response").alias("status"),
                    F.lit(None).cast(located.schema["response_id"].dataType).alias("response_id"),
                    none.alias("http_head"), none.alias("payload")))
    return located.unionByName(others).unionByName(lost)
