"""Chat formatting from an event log. Built-in functions only.

A log has the columns ``conv_id``, ``seq``, ``kind``, ``message``, ``role`` and ``text``; within a
conversation it is read by ``seq``. Kinds:

* ``message``: a whole message of its own; ``message`` isn't looked at
* ``start``: opens message ``message`` with a role and the first piece of text
* ``delta``: a piece of text at the end of the message
* ``edit``: the text of the message from now on; later deltas go to its end
* ``regenerate``: the message begins anew, and the messages that were opened after it are void

The fold of a message is the pieces from its last ``start``, ``edit`` or ``regenerate`` on, in
order: a window and an ordered aggregate for each message, so a long conversation isn't one group.
A message that was void stays so, whatever comes later for it.

A turn is rendered as ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line break.
In texts every ``<``, backslashes (or none) and ``|`` in a row get one more backslash, so no text
has a control string, and reading takes that backslash away. Roles are URL-encoded. The output has
a row for each segment of at most ``TURNS`` turns, dealt by the value of ``seq`` and then by rank,
with ``loss``, the places of the assistant's texts in it.

Defined results: NULL text or role is empty; NULL ``seq`` comes first; turns with the same ``seq``
all count, by role and text; an empty table gives no rows; further columns are left out; a
conversation whose id is NULL is one like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TURNS = 256
#: How kinds with the same ``seq`` are ordered.
KINDS = ("regenerate", "start", "edit", "delta")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def events_of_rows(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a log: each row opens a message of its own with its role, and its text follows
    as a delta."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("seq"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Turns with the same number, and equal rows, are messages of their own.
    nth = F.row_number().over(Window.partitionBy("conv_id", "seq").orderBy("role", "text"))
    message = F.concat_ws(":", F.coalesce(F.col("seq").cast("string"), F.lit("-")), nth.cast("string"))
    no_text = F.lit(None).cast("string")
    start = F.struct(F.lit("start").alias("kind"), F.col("role"), no_text.alias("text"))
    delta = F.struct(F.lit("delta").alias("kind"), no_text.alias("role"), F.col("text"))
    keyed = rows.select("conv_id", "seq", message.alias("message"), "role", "text")
    return keyed.select("conv_id", "seq", "message", F.inline(F.array(start, delta))).select("conv_id", "seq", "kind", "message", "role", "text")


def reconstruct(events: DataFrame) -> DataFrame:
    """The final messages: ``conv_id``, ``seq`` of the opening event, ``role``, ``text``."""
    whole = events.filter("kind = 'message'").select("conv_id", "seq", "role", "text")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    pieces = events.filter(F.col("kind").isin(*KINDS)).select("conv_id", "message", "kind", "role", "text", F.struct("seq", rank.alias("rank")).alias("at"))
    of_message = Window.partitionBy("conv_id", "message")
    said = F.when(F.col("role").isNotNull(), F.struct("at", F.col("role").alias("name")))
    placed = pieces.select(
        "conv_id",
        "message",
        "kind",
        "text",
        "at",
        F.max(F.when(F.col("kind") != "delta", F.col("at"))).over(of_message).alias("anew"),
        F.min(F.col("at.seq")).over(of_message).alias("opened"),
        F.max(said).over(of_message)["name"].alias("role"),
    )
    piece = F.struct("at", F.coalesce("text", F.lit("")).alias("text"))
    folded = (
        placed.filter("anew IS NULL OR at >= anew")
        .groupBy("conv_id", "message", "opened", "role")
        .agg(F.sort_array(F.collect_list(piece)).alias("parts"))
        .select("conv_id", F.col("opened").alias("seq"), F.coalesce("role", F.lit("")).alias("role"), F.array_join("parts.text", "").alias("text"))
    )
    again = pieces.filter("kind = 'regenerate'").select("conv_id", "message", F.col("at.seq").alias("high"))
    opened = pieces.join(again.select("conv_id", "message").distinct().toDF("of", "which"), F.col("conv_id").eqNullSafe(F.col("of")) & F.col("message").eqNullSafe(F.col("which")), "left_semi")
    opened = opened.groupBy("conv_id", "message").agg(F.min("at.seq").alias("low"))
    same = F.col("a.conv_id").eqNullSafe(F.col("o.conv_id")) & F.col("a.message").eqNullSafe(F.col("o.message"))
    spans = again.alias("a").join(opened.alias("o"), same).select(F.col("a.conv_id").alias("of"), "low", "high")
    void = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("seq") > F.col("low")) & (F.col("seq") < F.col("high"))
    return whole.unionByName(folded).join(spans, void, "left_anti")


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """Formatted segments: ``conv_id``, ``block``, ``piece``, ``formatted`` and ``loss``, the places
    (from 0, in code points) of the texts of the role ``trained``."""
    block = F.floor(F.col("seq") / TURNS)
    order = Window.partitionBy("conv_id", "block").orderBy("seq", "role", "text")
    ranked = messages.withColumn("block", block).withColumn("nth", F.row_number().over(order))
    turn = F.struct(
        "nth",
        F.concat(F.lit(START), F.url_encode("role"), F.lit("\n")).alias("head"),
        escaped(F.col("text")).alias("body"),
        (F.col("role") == trained).alias("trained"),
    )
    grouped = ranked.groupBy("conv_id", "block", F.floor((F.col("nth") - 1) / TURNS).alias("piece")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t.head, t.body, F.lit(END))), "")
    places = F.expr(f"""
        aggregate(turns, (0 AS at, array() :: array<struct<start: int, length: int>> AS found), (done, t) -> struct(
            done.at + length(t.head) + length(t.body) + {len(END)} AS at,
            if(t.trained, array_append(done.found, struct(done.at + length(t.head) AS start, length(t.body) AS length)), done.found) AS found
        ), done -> done.found)
    """)
    return grouped.select("conv_id", "block", "piece", formatted.alias("formatted"), places.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted segment as structs of role and text."""
    parts = F.split(formatted, r"<\|im_start\|>", -1)
    head = lambda part: F.substring_index(part, "\n", 1)
    body = lambda part: F.substr(part, F.length(head(part)) + 2, F.length(part) - F.length(head(part)) - 1 - len(END))
    return F.transform(
        F.slice(parts, F.lit(2), F.size(parts)),
        lambda part: F.struct(F.url_decode(head(part)).alias("role"), unescaped(body(part)).alias("text")),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, as they were before escaping."""
    return F.transform(loss, lambda at: unescaped(F.substr(formatted, at.start + 1, at.length)))


def digests(segments: DataFrame) -> DataFrame:
    """What is read back from formatted segments, for each conversation."""
    said = F.array_join(F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    read = segments.select(
        "conv_id",
        F.struct(
            "block",
            "piece",
            said.alias("said"),
            F.array_join(read_loss(F.col("formatted"), F.col("loss")), "").alias("learnt"),
        ).alias("part"),
        (F.size(F.split("formatted", r"<\|im_start\|>", -1)) - 1).alias("n_turns"),
        F.length("formatted").alias("chars"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("part")).alias("parts")
    )
    joined = whole.select("conv_id", "n_turns", "formatted_chars", F.array_join("parts.said", "").alias("said"), F.array_join("parts.learnt", "").alias("learnt"))
    return joined.select(
        "conv_id",
        F.col("n_turns").cast("long").alias("n_turns"),
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
