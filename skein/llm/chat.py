"""Chat formatting: event-sourced reconstruction, rendering and reading back.

An event log has one row per event: conversation, sequence number, message, kind, role,
text. Kinds are ``message`` (a message with its text so far), ``delta`` (text to append),
``edit`` (replaces the message's text) and ``regenerate`` (discards it; later deltas fill
it anew). ``fold`` keeps, per message, the last event that sets the text and the deltas
after it, joined in sequence order; a message stands where its first event stood.
``render`` writes one text per conversation:

    <turn>ROLE
    TEXT</turn>

one after the other, and a loss mask with one span per turn (empty for turns whose role is
not trained on). In texts and roles a backslash becomes ``\\b`` and ``<`` becomes ``\\l``, in
roles a line feed becomes ``\\e``; so a raw ``<`` only ever belongs to the template, and
undoing the replacements in reverse gives the text back. ``parse`` recovers turns and
masked text from the rendered rows alone.

Scale: events are folded by (conversation, message) first, so a long stream of deltas is
joined apart from its conversation; a conversation is then one exchange, one sort and one
output row. An output row is one string, so a conversation is bounded by Spark's 2 GB cell.

Defined cases: NULL text and NULL role are empty; equal sequence numbers are ordered by
message, kind, role and text; rows repeated in the log with all six columns equal count
once (a log delivered twice) unless ``repeats`` keeps them; a message without a setting
event starts empty; NULL kinds count as ``message``; NULL conversation ids are one
conversation; an empty log gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
SETS = ("message", "edit", "regenerate")
_EVENT = ("conv_id", "seq", "message", "kind", "role", "text")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def fold(events: DataFrame, repeats: bool = False) -> DataFrame:
    """(conv_id, seq, message, role, text): final messages of every conversation."""
    rows = events.select("conv_id", "seq", "message", F.coalesce("kind", F.lit("message")).alias("kind"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    if not repeats:
        rows = rows.distinct()
    at = F.struct("seq", "kind", "role", "text")
    sets = F.when(F.col("kind").isin(*SETS), at)
    same = Window.partitionBy("conv_id", "message")
    named = F.max(F.when(F.col("role") != "", F.struct("seq", "role"))).over(same)
    marked = rows.withColumns({"at": at, "last": F.max(sets).over(same), "first": F.min(at).over(same), "named": named})
    kept = marked.where(F.col("last").isNull() | (F.col("at") >= F.col("last")))
    parts = kept.groupBy("conv_id", "message").agg(F.first("first.seq").alias("seq"), F.first(F.coalesce("named.role", F.lit(""))).alias("role"), F.array_sort(F.collect_list("at")).alias("parts"))
    return parts.select("conv_id", "seq", "message", "role", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame, trained: tuple = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, spans): one row per conversation; a span is (turn_start,
    loss_start, loss_end) in code points of ``formatted``, counted from 0."""
    head = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\e")), F.lit("\n"))
    body = escape(F.col("text"))
    turns = messages.select("conv_id", "seq", "message", "role", F.concat(head, body, F.lit(CLOSE)).alias("turn"), F.length(head).cast("long").alias("h"), F.length(body).cast("long").alias("b"))
    w = Window.partitionBy("conv_id").orderBy("seq", "message")
    size = F.col("h") + F.col("b") + len(CLOSE)
    placed = turns.withColumn("n", F.row_number().over(w)).withColumn("start", F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0)) - size)
    loss = F.col("start") + F.col("h")
    span = F.struct(F.col("start").alias("turn_start"), loss.alias("loss_start"), (loss + F.when(F.col("role").isin(*trained), F.col("b")).otherwise(0)).alias("loss_end"))
    listed = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "turn", span.alias("span")))).alias("t"))
    return listed.select("conv_id", F.array_join(F.transform("t", lambda t: t["turn"]), "").alias("formatted"), F.transform("t", lambda t: t["span"]).alias("spans"))


def parse(rendered: DataFrame) -> DataFrame:
    """``rendered`` with ``turns`` (role, text) and ``loss`` (unescaped masked texts)."""
    pieces = F.split("formatted", CLOSE)
    listed = rendered.withColumn("_p", F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))))

    def turn(p):
        cut = F.instr(p, "\n")
        role = F.substring(p, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1)
        text = F.substring(p, cut + 1, F.length(p))
        return F.struct(unescape(F.replace(role, F.lit("\\e"), F.lit("\n"))).alias("role"), unescape(text).alias("text"))

    def masked(z):
        span = z["spans"]
        return unescape(F.substring(z["_p"], (span["loss_start"] - span["turn_start"] + 1).cast("int"), (span["loss_end"] - span["loss_start"]).cast("int")))

    return listed.withColumns({"turns": F.transform("_p", turn), "loss": F.transform(F.arrays_zip("_p", "spans"), masked)}).drop("_p")


def conversation_events(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A table of finished turns as a log: every row is a ``message`` event of its own, in
    the order of turn, role and text."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    named = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    n = F.row_number().over(w).cast("long")
    return named.select("conv_id", n.alias("seq"), n.alias("message"), F.lit("message").alias("kind"), "role", "text")


def streamed(events: DataFrame) -> DataFrame:
    """The log that a chat service would have kept of finished messages (``conversation_events``):
    by a hash of conversation and message, a message is written whole, streamed in deltas,
    edited from a draft, or discarded, regenerated and streamed anew. ``fold`` gives the same
    messages back. Sequence numbers are multiplied by 8 to make room."""
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    begun, rest = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))

    def log(*steps):
        return F.array(*[
            F.struct(F.lit(i).alias("step"), F.lit(kind).alias("kind"), (F.col("role") if i == 0 else F.lit(None).cast("string")).alias("role"), t.alias("text"))
            for i, (kind, t) in enumerate(steps)])

    nothing = F.lit(None).cast("string")
    way = F.pmod(F.xxhash64("conv_id", "message"), F.lit(4))
    steps = (
        F.when(way == 0, log(("message", text)))
        .when(way == 1, log(("message", begun), ("delta", rest)))
        .when(way == 2, log(("message", begun), ("edit", text)))
        .otherwise(log(("message", nothing), ("delta", begun), ("regenerate", nothing), ("delta", begun), ("delta", rest)))
    )
    each = events.select("conv_id", "seq", "message", F.explode(steps).alias("e"))
    return each.select("conv_id", (F.col("seq") * 8 + F.col("e.step")).cast("long").alias("seq"), "message", "e.kind", "e.role", "e.text")
