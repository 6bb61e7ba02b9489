"""Chat formatting by event-sourced reconstruction, in built-in functions only.

A conversation log is a table of events (conv_id, turn, part, seq, kind, role, text): ``open`` starts a message
and names its role, ``delta`` appends text, ``edit`` replaces what the message said so far, ``regenerate``
discards it.  ``part`` tells messages of one turn apart.  Folding sorts a message's events by seq, drops what
stands before its last edit or regeneration and joins the rest.  Rendering sorts a conversation's messages and
joins their pieces; the loss mask is the byte spans of assistant texts in the result.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Inside roles and texts ``&`` becomes ``&amp;`` and
``<`` becomes ``&lt;`` (and a line feed in a role ``&#10;``), so no text can hold a control string, and
``parsed`` reads back exactly what was said.

A message's events meet in one task, then a conversation's messages do: the result is one string for each
conversation, so its size is the bound.  Offsets come from a running sum, not from rescanning that string.

Nulls: null texts and roles are empty; a null turn sorts first; rows with a null conv_id are one conversation.
Rows that repeat (conv_id, turn) are messages of their own, ordered by role and text.  An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
DELTA_CHARS = 256


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&#10;"), F.lit("\n")), F.lit("&amp;"), F.lit("&"))


def log_of_turns(turns: DataFrame) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text): each text is streamed as deltas."""
    clean = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy(F.encode("role", "UTF-8"), F.encode("text", "UTF-8")))
    deltas = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA_CHARS}}}"), F.lit(0))
    named = clean.withColumn("part", place)
    event = F.transform(deltas, lambda x, k: F.struct((k + 1).cast("long").alias("seq"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), x.alias("text")))
    first = F.array(F.struct(F.lit(0).cast("long").alias("seq"), F.lit("open").alias("kind"), F.col("role").alias("role"), F.lit(None).cast("string").alias("text")))
    return named.select("conv_id", "turn", "part", F.inline(F.concat(first, event)))


def reconstruct(log: DataFrame) -> DataFrame:
    """Fold the events into final messages: (conv_id, turn, part, role, text)."""
    reset = F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq")))
    folded = log.groupBy("conv_id", "turn", "part").agg(
        F.max(F.when(F.col("kind") == "open", F.struct("seq", "role"))).alias("opened"),
        reset.alias("reset"),
        F.array_sort(F.collect_list(F.when(F.col("text").isNotNull() & (F.col("kind") != "open"), F.struct("seq", "text")))).alias("said"),
    )
    valid = F.filter("said", lambda e: F.col("reset").isNull() | (e["seq"] >= F.col("reset")))
    return folded.select("conv_id", "turn", "part", F.coalesce("opened.role", F.lit("")).alias("role"), F.array_join(F.transform(valid, lambda e: e["text"]), "").alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): the rendered conversation and the byte spans of assistant texts."""
    head = F.concat(F.lit(START), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    pieces = messages.withColumns({"head": head, "body": escaped(F.col("text"))})
    pieces = pieces.withColumn("piece", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("at", F.coalesce(F.sum(F.octet_length("piece").cast("long")).over(order), F.lit(0)))
    span = F.when(F.col("role") == "assistant", F.struct((F.col("at") + F.octet_length("head")).cast("long").alias("start"), F.octet_length("body").cast("long").alias("length")))
    one = F.array_sort(F.collect_list(F.struct("turn", "part", "piece")))
    return pieces.groupBy("conv_id").agg(F.array_join(F.transform(one, lambda x: x["piece"]), "").alias("formatted"), F.array_sort(F.collect_list(span)).alias("loss_spans"))


def format_chats(turns: DataFrame) -> DataFrame:
    """Finished turns to rendered conversations, through the event log."""
    return rendered(reconstruct(log_of_turns(turns)))


def parsed(formatted: Column) -> Column:
    """The turns read back from a rendered conversation: array of (role, text)."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p, k: k > 0)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.substring_index(p, "\n", 1)).alias("role"),
            unescaped(p.substr(F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p) - F.length(F.substring_index(p, "\n", 1)) - 1 - len(END))).alias("text"),
        ),
    )


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    raw = F.encode(formatted, "UTF-8")
    cut = F.transform(F.array(raw), lambda b: F.array_join(F.transform(loss_spans, lambda s: unescaped(F.decode(F.substring(b, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8"))), ""))
    return F.get(cut, 0)
