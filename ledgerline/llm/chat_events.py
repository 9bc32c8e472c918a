"""Chat formatting from an event log, with DataFrame functions only.

Log rows: conv_id, turn, copy, seq, kind, role, text. Events of one message
(conv_id, turn, copy) are folded in order of ``seq``: ``start`` opens it (role),
``delta`` appends text, ``edit`` replaces the text, ``regenerate`` throws the
text away for a new attempt. So the final text is what follows the last event
that resets it. Messages are then put in order and rendered:

    ### role: text</turn>

Texts and roles are escaped so that no control string can occur in them:
backslash, ``#`` and ``<`` become a backslash and a letter (in a role ``:``
too); undoing it restores any string exactly. Loss spans are code-point offsets
of the escaped assistant texts.

Scale: events are shuffled by message and superseded ones dropped before any
text is gathered; then whole messages are shuffled by conversation. Only a
conversation's own rendered text, which is one row of the result, is gathered.

Defined results: null text or role is empty; null conv_id is a conversation;
a null turn sorts first; an event delivered twice (equal seq, text) counts once;
messages of equal turn keep the order of ``copy``; messages without text still
render; an empty log gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as C

# --- Fixed values: the template.
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
# --- end of fixed values
LOSS_ROLE = "assistant"
CHUNK = 200


def escaped(c: Column, role: bool = False) -> Column:
    for raw, code in ESCAPES[: 4 if role else 3]:
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescaped(c: Column) -> Column:
    # the backslash last: every backslash before that starts an escape
    for raw, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def message_events(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The log of finished messages (conv_id, turn, role, text) as a chat service
    would have streamed it: texts in deltas of ``chunk`` code points; a user's
    draft edited; an assistant's first attempt regenerated."""
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    m = (messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), C.text_or_empty().alias("text"))
         .withColumn("copy", F.row_number().over(order)))
    event = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    draft = F.substring(F.col("text"), F.lit(1), F.ceil(F.length("text") / 2).cast("int"))
    deltas = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("text") - 1) / chunk)).cast("int")),
                         lambda i: event("delta", F.substring(F.col("text"), i * chunk + 1, F.lit(chunk))))
    none = F.lit("")
    log = (F.when(F.col("role") == "user",
                  F.array(event("start", none), event("delta", draft), event("edit", F.col("text"))))
           .when(F.col("role") == LOSS_ROLE,
                 F.concat(F.array(event("start", none), event("delta", draft), event("regenerate", none)), deltas))
           .otherwise(F.concat(F.array(event("start", none)), deltas)))
    return (m.select("conv_id", "turn", "copy", "role", F.posexplode(log).alias("seq", "event"))
            .select("conv_id", "turn", "copy", F.col("seq").cast("bigint").alias("seq"),
                    F.col("event.kind").alias("kind"), "role", F.col("event.text").alias("text")))


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, copy, role, text."""
    message = ["conv_id", "turn", "copy"]
    resets = F.when(F.col("kind").isin("start", "edit", "regenerate"), F.col("seq"))
    whole = Window.partitionBy(*message)
    role = F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).over(whole)
    live = (events.withColumns({"from": F.max(resets).over(whole), "said_by": role})
            .filter(F.col("from").isNull() | (F.col("seq") >= F.col("from"))))
    pieces = F.array_sort(F.collect_set(F.struct("seq", C.text_or_empty().alias("text"))))
    return (live.groupBy(*message)
            .agg(F.max("said_by").alias("role"), pieces.alias("pieces"))
            .select(*message, F.coalesce("role", F.lit("")).alias("role"),
                    F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (array of start, length in code points)."""
    piece = F.concat(F.lit(OPEN), escaped(F.col("role"), role=True), F.lit(AFTER_ROLE),
                     escaped(F.col("text")), F.lit(CLOSE))
    body = F.length(escaped(F.col("text")))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "copy")
    placed = (messages.withColumn("piece", piece).withColumn("body", body)
              .withColumn("n", F.row_number().over(in_order))
              .withColumn("end", F.sum(F.length("piece")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))))
    span = F.struct((F.col("end") - len(CLOSE) - F.col("body")).cast("bigint").alias("start"),
                    F.col("body").cast("bigint").alias("length"))
    return (placed.groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("n", "piece"))).alias("pieces"),
                 F.array_sort(F.collect_list(F.when(F.col("role") == LOSS_ROLE, span))).alias("loss_spans"))
            .select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
                    "loss_spans"))


def format_chats(events: DataFrame) -> DataFrame:
    return render(fold(events))


def parsed_turns(formatted: str = "formatted") -> Column:
    """The turns of a formatted conversation, as array<struct<role, text>>."""
    pieces = F.split(F.col(formatted), CLOSE, -1)
    split_at = lambda p: F.instr(p, AFTER_ROLE)  # noqa: E731  a role has no colon left
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.struct(
        unescaped(F.substring(p, F.lit(len(OPEN) + 1), split_at(p) - len(OPEN) - 1)).alias("role"),
        unescaped(F.substring(p, split_at(p) + len(AFTER_ROLE), F.length(p))).alias("text")))


def loss_text(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.col(spans), lambda s: unescaped(
        F.substring(F.col(formatted), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
