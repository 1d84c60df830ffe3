"""Operator 4 - chat formatting from event logs (DataFrame and SQL functions only).

An event is (conv_id, message, copy, seq, role, kind, text).  ``message`` orders a
conversation's messages and ``copy`` tells repeated ones apart; ``seq`` orders a message's
events.  Kinds: ``delta`` appends its text, ``edit`` puts its text in the place of all before,
``regenerate`` drops all before and starts again with its own text (if any).

``reconstruct`` folds the events of a message (a message's events are one group, so a long
conversation is folded in many), ``render`` writes each conversation with turn markers, control
strings escaped, and a loss mask as spans of UTF-8 bytes.  A conversation's text is one value of
one row, as asked for; its offsets are running sums, so no turn is scanned twice.

Template: ``### role: text</turn>\\n``.  In texts ``\\`` is written ``\\0``, ``###`` ``\\1`` and
``</turn>`` ``\\2``; in roles also ``:`` ``\\3``.  So no control string is left in a text, and
replacing the codes in the order 3, 2, 1, 0 gives the text back.

Cases: null texts and roles count as empty; null conv_id is a conversation of its own; equal
(conv_id, turn) rows all stay, ordered by role and text; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CODES = [("\\", "\\0"), ("###", "\\1"), ("</turn>", "\\2")]
ROLE_CODES = [*CODES, (":", "\\3")]
TURN_END = "</turn>\n"
LOSS_ROLE = "assistant"
CHUNKS = 16
CHUNK_CHARS = 256


def escape(c: Column, codes=tuple(CODES)) -> Column:
    for plain, code in codes:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column, codes=tuple(CODES)) -> Column:
    for plain, code in reversed(codes):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def turn_events(turns: DataFrame) -> DataFrame:
    """The event log behind a table of finished turns (conv_id, turn, role, text): texts streamed
    in at most ``CHUNKS`` deltas; an assistant's first delta is a draft that is regenerated, and
    a longer user text gets an edit after its deltas."""
    rows = turns.select("conv_id", F.col("turn").alias("message"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("conv_id", "message").orderBy("role", "text")))
    step = F.greatest(F.lit(CHUNK_CHARS), F.ceil(F.length("text") / CHUNKS)).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("text") / step) - 1, F.lit(0)).cast("int"))
    chunks = F.transform(starts, lambda i: F.substring(F.col("text"), i * step + 1, step))
    event = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    deltas = F.transform(chunks, lambda c: event("delta", c))
    draft = F.array(event("delta", F.substring("text", 1, 16)), event("regenerate", F.lit("")))
    edit = F.array(event("edit", F.col("text")))
    events = (F.when(F.col("role") == LOSS_ROLE, F.concat(draft, deltas))
              .when(F.length("text") > CHUNK_CHARS, F.concat(deltas, edit)).otherwise(deltas))
    return rows.select("conv_id", "message", "copy", "role", F.posexplode(events).alias("seq", "e")).select(
        "conv_id", "message", "copy", "seq", "role", "e.kind", "e.text")


def reconstruct(events: DataFrame) -> DataFrame:
    """(conv_id, message, copy, role, text): the final messages."""
    log = F.sort_array(F.collect_list(F.struct("seq", "kind", "text", "role")))
    grouped = events.groupBy("conv_id", "message", "copy").agg(log.alias("log"))
    resets = F.transform("log", lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i).otherwise(F.lit(0)))
    last = F.array_max(resets)
    live = F.slice("log", last + 1, F.size("log"))
    return grouped.select("conv_id", "message", "copy", F.coalesce(F.col("log")[0]["role"], F.lit("")).alias("role"),
                          F.array_join(F.transform(live, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans): spans are (start, length) in bytes of the
    escaped text of each assistant message."""
    head = F.concat(F.lit("### "), escape(F.col("role"), tuple(ROLE_CODES)), F.lit(": "))
    parts = messages.select("conv_id", "message", "copy", head.alias("head"), escape(F.col("text")).alias("body"),
                            (F.col("role") == LOSS_ROLE).alias("loss"))
    parts = parts.select("*", F.concat("head", "body", F.lit(TURN_END)).alias("segment"))
    order = Window.partitionBy("conv_id").orderBy("message", "copy").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("at", F.coalesce(F.sum(F.octet_length("segment").cast("long")).over(order), F.lit(0)))
    span = F.when(F.col("loss"), F.struct((F.col("at") + F.octet_length("head")).alias("start"),
                                          F.octet_length("body").cast("long").alias("length")))
    return (placed.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("at", "segment"))).alias("segments"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"))
        .select("conv_id", "n_turns", F.array_join(F.transform("segments", lambda s: s["segment"]), "").alias("formatted"),
                "loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    parts = F.filter(F.split(formatted, TURN_END), lambda s: s != "")
    pick = lambda s, i: F.regexp_extract(s, r"(?s)^### ([^:]*): (.*)$", i)
    return F.transform(parts, lambda s: F.struct(unescape(pick(s, 1), tuple(ROLE_CODES)).alias("role"),
                                                 unescape(pick(s, 2)).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, one span after another."""
    data = formatted.cast("binary")
    cutout = lambda s: F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")
    return F.array_join(F.transform(spans, lambda s: unescape(cutout(s))), "")
