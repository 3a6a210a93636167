"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

Input is a log of events: ``conv_id, seq, message_id, kind, role, text``.

* ``message``     a whole message;
* ``delta``       text appended to the message as it stands;
* ``edit``        replaces the text so far;
* ``regenerate``  discards the text so far; deltas that follow fill it anew.

``fold_events`` partitions the log by conversation, sorts by sequence and folds
the events of each message into its final text; ``render`` marks the turns and
escapes control strings; ``read_back`` undoes both.

One shuffle on conv_id serves the window, the fold and the rendering.  A
message's text is assembled from its last complete state on (earlier events
are dropped before anything is gathered).  A conversation's rendered text is
one value by definition, so it must fit in a row, as in the output.

Defined results: NULL text is empty; NULL role is the empty role; NULL conv_id
is a conversation of its own; NULL seq sorts first; events of equal seq are
ordered by message_id, kind, role and text; a NULL kind counts as ``message``;
repeated ``message`` events of one message_id count like deltas of it; an empty
log gives an empty table; other input columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
# Strings that models read as control; a text may only hold them escaped.
CONTROL = [TURN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_ANY = "|".join(c.replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for c in CONTROL)

LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """One backslash more before every control string and the backslashes it has."""
    return F.regexp_replace(text, rf"(\\*)({_ANY})", r"\\$1$2")


def unescape(text: Column) -> Column:
    """One backslash less before every control string: exactly undoes ``escape``."""
    return F.regexp_replace(text, rf"\\(\\*)({_ANY})", "$1$2")


def _escape_role(role: Column) -> Column:
    """A role takes one line: backslashes and line ends are written as pairs."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")),
                            F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    # Pairs are read from the left, so an escaped backslash before an n stays one.
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, place (from 0), role, text, in order of first event."""
    e = events.select(
        F.col("conv_id"), F.col("seq"), F.col("message_id"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("seq", "message_id", "kind", "role", "text")]
    in_log = Window.partitionBy("conv_id").orderBy(*order)
    of_message = Window.partitionBy("conv_id", "message_id").orderBy("at")
    restart = F.col("kind").isin("edit", "regenerate").cast("int")
    ranked = (
        e.withColumn("at", F.row_number().over(in_log))
        .withColumn("epoch", F.sum(restart).over(of_message))
        .withColumn("first_at", F.min("at").over(of_message))
        .withColumn("last_epoch", F.max("epoch").over(
            Window.partitionBy("conv_id", "message_id")))
        .where(F.col("epoch") == F.col("last_epoch"))
    )
    parts = F.sort_array(F.collect_list(F.struct(
        "at", F.when(F.col("kind") == "regenerate", "").otherwise(F.col("text")).alias("text"))))
    messages = ranked.groupBy("conv_id", "message_id").agg(
        F.min("first_at").alias("first_at"),
        F.min_by("role", "at").alias("role"),
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))
    return messages.select(
        "conv_id",
        (F.row_number().over(Window.partitionBy("conv_id").orderBy("first_at")) - 1)
        .cast("long").alias("place"), "role", "text")


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: ``formatted`` and its loss mask ``loss_spans``.

    A span (start, length, in code points of ``formatted``) covers the escaped
    text of one message of ``loss_role``; control marks are never inside.
    """
    head = F.concat(F.lit(TURN), _escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = messages.select("conv_id", "place", "role", head.alias("head"), body.alias("body"),
                             ).withColumn("tail", F.lit(f"\n{END}\n"))
    before = Window.partitionBy("conv_id").orderBy("place")
    size = (F.length("head") + F.length("body") + F.length("tail")).cast("long")
    placed = pieces.withColumn("till", F.sum(size).over(before))
    start = F.col("till") - F.length("tail") - F.length("body")
    span = F.struct(F.col("place"), start.alias("start"),
                    F.length("body").cast("long").alias("length"))
    turns = F.sort_array(F.collect_list(F.struct(
        "place", F.concat("head", "body", "tail").alias("turn"))))
    return placed.groupBy("conv_id").agg(
        F.array_join(F.transform(turns, lambda t: t["turn"]), "").alias("formatted"),
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("role") == loss_role, span))),
            lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")),
        ).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a rendered text: array of (role, text, start of the text)."""
    # An unescaped control string never follows a backslash.
    marked = F.split(formatted, r"(?<!\\)<\|turn\|>")
    turns = F.slice(marked, F.lit(2), F.size(marked))
    tail = len(f"\n{END}\n")

    def parse(turn: Column) -> Column:
        role = F.substring_index(turn, "\n", 1)
        text = turn.substr(F.length(role) + 2, F.length(turn) - F.length(role) - F.lit(1 + tail))
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, parse)


def turn_events(rows: DataFrame) -> DataFrame:
    """Events of a table with one row per turn (conv_id, turn, role, text).

    Every row is a message of its own: repeated (conv_id, turn) pairs are told
    apart by role and text, and equal rows by their number.
    """
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    return rows.select(
        "conv_id", F.col("turn").alias("seq"),
        F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).alias("message_id"),
        F.lit("message").alias("kind"), "role", "text")


def under_mask(formatted: Column, spans: Column) -> Column:
    """The pieces of a rendered text that its loss mask covers, in order.

    A substring counts code points from the beginning, so the text is cut into
    blocks first and a span out of its blocks: the work grows with the square
    root of the number of spans, not with the number.
    """
    size = F.ceil(F.length(formatted) / F.sqrt(F.size(spans) + F.lit(1))).cast("int")

    def number(place: Column, size: Column) -> Column:
        return F.floor(place / size).cast("int")

    def blocks(size: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), number(F.length(formatted), size)),
            lambda i: F.substr(formatted, i * size + F.lit(1), size))

    def cut(held: Column, span: Column) -> Column:
        first = number(span["start"], held["size"])
        last = number(span["start"] + span["length"], held["size"])
        own = F.array_join(F.slice(held["blocks"], first + F.lit(1), last - first + F.lit(1)), "")
        start = span["start"].cast("int") - first * held["size"] + F.lit(1)
        return F.substr(own, start, span["length"].cast("int"))

    # Arrays of one, so that the blocks are made once and not for each span.
    sized = F.transform(F.array(size), lambda n: F.struct(
        n.alias("size"), blocks(n).alias("blocks")))
    return F.flatten(F.transform(sized, lambda held: F.transform(
        spans, lambda span: cut(held, span))))


def digests(rendered: DataFrame) -> DataFrame:
    """What the rendered conversations say, read back from ``formatted``, and the
    text under their loss mask, cut out of it by ``loss_spans``."""
    turns = rendered.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        read_back(F.col("formatted")).alias("turns"),
        F.array_join(F.transform(under_mask(F.col("formatted"), F.col("loss_spans")), unescape),
                     "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (
        turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                     F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                     "loss", "formatted_chars")
        .select("conv_id", "n_turns", "turns_sha256",
                F.length("loss").cast("long").alias("loss_chars"),
                F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                "formatted_chars")
    )
