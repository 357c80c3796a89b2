"""Chat formatting: conversations rebuilt from an event log, then rendered.

Events are ``(conv_id, seq, message_id, kind, role, text)``. Within a message
they are folded in order of ``seq``, which may be of any type that has an order:

==========  ===================================================
kind        effect on the message's text
==========  ===================================================
message     replaces it; a log of plain messages is one per row
delta       appends
edit        replaces
regenerate  empties it; later deltas build the new answer
==========  ===================================================

Any other kind replaces, too. A message stands where its first event stood. An
event of a message that the log holds twice, alike in all columns, counts once.
An event without ``message_id`` is a message by itself; equal ones are as many
equal messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import let

#: The template: fixed values.
OPEN, CLOSE = "<turn>", "</turn>\n"
ASSISTANT = "assistant"
#: Messages that are joined to one piece before the pieces of a conversation are.
PIECE = 64
#: Characters of an event when whole rows are turned into a log.
EVENT_CHARS = 256

EVENT_COLUMNS = ("conv_id", "seq", "message_id", "kind", "role", "text")


def escape(col: Column) -> Column:
    """Text in which no ``<`` is left, so that no control string can occur in it; :func:`unescape` reverses it."""
    return F.replace(F.replace(col, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(col: Column) -> Column:
    return F.replace(F.replace(col, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(col: Column) -> Column:
    return F.replace(escape(col), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(col: Column) -> Column:
    return unescape(F.replace(col, F.lit("&nl;"), F.lit("\n")))


def events_of(rows: DataFrame, piece_chars: int = EVENT_CHARS) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log: each row a message that begins with the first characters and is streamed on in deltas.

    Null texts are empty; repeated rows are messages of their own; no rows give
    no events. seq is (turn, number of the event), so null turns come first.
    """
    counted = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    own = F.sha2(F.to_json(F.struct("turn", "role", "text")), 256)
    counted = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumn("message_id", F.concat_ws("-", own, "copy"))
    parts = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{piece_chars}}}"), F.lit(0)))
    pieces = counted.select("conv_id", "turn", "message_id", "role", F.posexplode(parts).alias("part", "text"))
    kind = F.when(F.col("part") == 0, "message").otherwise("delta")
    return pieces.select("conv_id", F.struct("turn", "part").alias("seq"), "message_id", kind.alias("kind"), "role", "text")


def fold_messages(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, seq, role, text, copies) of an event log.

    Null texts are empty; a null role or conversation is a value of its own;
    the role of a message is that of its first event. Only columns of the log
    are read. A group is one message, so a hot conversation is spread out.
    """
    e = events.select(*EVENT_COLUMNS).withColumn("text", F.coalesce("text", F.lit("")))
    own = F.when(F.col("message_id").isNull(), F.struct("seq", "role", "kind", "text"))
    steps = e.groupBy("conv_id", "message_id", own.alias("own")).agg(F.collect_set(F.struct("seq", "kind", "text", "role")).alias("steps"), F.count("*").alias("n"))
    steps = steps.select("conv_id", F.sort_array("steps").alias("steps"), F.when(F.col("message_id").isNull(), F.col("n")).otherwise(F.lit(1).cast("long")).alias("copies"))

    def text(s: Column) -> Column:
        from_ = F.array_max(F.transform(s, lambda x, i: F.when(x["kind"].eqNullSafe("delta"), 1).otherwise(i + 1)))  # nothing before counts
        said = F.transform(F.slice(s, from_, F.size(s)), lambda x: F.when(x["kind"].eqNullSafe("regenerate"), "").otherwise(x["text"]))
        return F.array_join(said, "")

    first = F.col("steps")[0]
    return steps.select("conv_id", first["seq"].alias("seq"), first["role"].alias("role"), let(F.col("steps"), text).alias("text"), "copies")


def render(messages: DataFrame, piece: Column | None = None) -> DataFrame:
    """One row for each conversation: conv_id, formatted text and loss mask.

    ``loss`` lists the spans of ``formatted`` that count for the loss, which
    hold the assistants' (escaped) texts: the turn, counted from 0, the first
    character from that turn's beginning, and the number of characters.
    Messages are put in order of (seq, role, text), nulls first. Conversations
    are joined in two steps, pieces of ``PIECE`` values of seq first, so that
    the rows of a long one are not gathered by a single task; ``piece``
    numbers them where seq is not a number.
    """
    m = messages.select("conv_id", "seq", F.coalesce("role", F.lit("")).alias("role"), "text", "copies", (piece if piece is not None else F.floor(F.col("seq") / PIECE)).alias("piece"))
    ordered = F.sort_array(F.collect_list(F.struct("seq", "role", F.coalesce("text", F.lit("")).alias("text"), "copies")))

    def turns(x: Column) -> Column:
        head = F.concat(F.lit(OPEN), _escape_role(x["role"]), F.lit("\n"))
        turn = let(
            F.struct(head.alias("head"), escape(x["text"]).alias("body")),
            lambda t: F.struct(F.concat(t["head"], t["body"], F.lit(CLOSE)).alias("text"), F.length(t["head"]).alias("start"), F.when(x["role"] == ASSISTANT, F.length(t["body"])).alias("length")),
        )
        return F.array_repeat(turn, x["copies"].cast("int"))

    pieces = m.groupBy("conv_id", "piece").agg(ordered.alias("messages"))
    pieces = pieces.select("conv_id", "piece", F.flatten(F.transform("messages", turns)).alias("turns"))
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("piece", "turns"))).alias("pieces"))

    def joined(t: Column) -> Column:
        spans = F.transform(t, lambda x, i: F.struct(i.alias("turn"), x["start"].alias("start"), x["length"].alias("length")))
        return F.struct(F.array_join(F.transform(t, lambda x: x["text"]), "").alias("formatted"), F.filter(spans, lambda x: x["length"].isNotNull()).alias("loss"))

    whole = whole.select("conv_id", let(F.flatten(F.transform("pieces", lambda x: x["turns"])), joined).alias("w"))
    return whole.select("conv_id", "w.formatted", "w.loss")


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    turns = F.filter(F.split(formatted, CLOSE, -1), lambda t: F.startswith(t, F.lit(OPEN)))
    body = F.transform(turns, lambda t: F.substring(t, F.lit(len(OPEN) + 1), F.length(t)))
    return F.transform(
        body,
        lambda t: F.struct(
            _unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
            unescape(F.substring(t, F.instr(t, "\n") + 1, F.length(t))).alias("text"),
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, cut out of the formatted text by its places, unescaped, in order, with nothing between."""

    def cut(turns: Column) -> Column:
        return F.array_join(F.transform(loss, lambda s: F.substring(F.get(turns, s["turn"]), s["start"] + 1, s["length"])), "")

    return unescape(let(F.split(formatted, CLOSE, -1), cut))


def format_conversations(events: DataFrame, piece: Column | None = None) -> DataFrame:
    """Fold a log and render it; an empty log gives no rows."""
    return render(fold_messages(events), piece)


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests read back from the formatted text and its loss mask."""
    turns = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
