"""Chat formatting from an event log: fold each message's events, order, render, read back.

Events are rows `(conv_id, seq, message_id, kind, role, text)`. Within one message
they are folded in `seq` order:

- `message` sets role and text, `delta` appends to the text, `edit` replaces the text;
- `regenerate` empties the text (what follows fills it again) and drops every message
  that began between this one and the regeneration;
- `delete` removes the message; a later `message`, `edit`, `delta` or `regenerate` restores it.

Messages stand in the order of their first event. Template, one turn:
`<s>role\\n[INST] text [/INST]</s>`, without the instruction marks for an assistant.
Control strings inside texts get a backslash within, a backslash is doubled, so
reading back is exact. The loss mask is a list of spans over the assistant texts.

Edge cases: null text is empty; null role is an empty role; a null `conv_id` or `message_id`
is a key of its own; ties of `seq` go by kind, role and text; a first `delta` or `edit`
makes its message; a repeated event is applied again; an empty table gives no rows.

Two shuffles at most: messages are folded by (conversation, message) first, so a long
streamed conversation is already short when its messages meet. A conversation's
rendering is one value and has to fit one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The template's control strings, and what each becomes inside a text.
CONTROL = (
    ("<s>", "<\\s>"),
    ("</s>", "<\\/s>"),
    ("[INST]", "[\\INST]"),
    ("[/INST]", "[\\/INST]"),
)
OPEN, CLOSE = "<s>", "</s>"
ASK, ASKED = "[INST] ", " [/INST]"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, safe in CONTROL:
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escaped_role(role: Column) -> Column:
    """Also free of line breaks, as one ends the role."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    """Doubled backslashes first, so that only a single one before `n` means a line break."""
    parts = F.split(role, r"\\\\")
    return F.array_join(F.transform(parts, lambda x: unescaped(F.replace(x, F.lit("\\n"), F.lit("\n")))), "\\")


def fold_messages(events: DataFrame) -> DataFrame:
    """One row per message: `conv_id, message_id, first_seq, regen_seq, role, text, live`."""
    event = F.struct(
        F.col("seq"),
        F.col("kind"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    start = F.struct(
        F.lit("").alias("role"),
        F.lit("").alias("text"),
        F.lit(False).alias("live"),
        F.lit(None).cast(events.schema["seq"].dataType).alias("regen_seq"),
    )

    def step(state, e):
        kind = e["kind"]
        sets = kind.isin("message", "edit")
        text = (
            F.when(sets, e["text"])
            .when(kind == "delta", F.concat(state["text"], e["text"]))
            .when(kind == "regenerate", F.lit(""))
            .otherwise(state["text"])
        )
        role = F.when((kind == "message") | (state["role"] == "") & (e["role"] != ""), e["role"]).otherwise(state["role"])
        return F.struct(
            role.alias("role"),
            text.alias("text"),
            (kind != "delete").alias("live"),
            F.when(kind == "regenerate", e["seq"]).otherwise(state["regen_seq"]).alias("regen_seq"),
        )

    log = events.groupBy("conv_id", "message_id").agg(F.sort_array(F.collect_list(event)).alias("log"))
    # A message of one `message` event, the common case, needs no fold.
    only = F.get("log", F.lit(0))
    single = F.struct(only["role"].alias("role"), only["text"].alias("text"), F.lit(True).alias("live"),
                      F.lit(None).cast(events.schema["seq"].dataType).alias("regen_seq"))
    folded = F.when((F.size("log") == 1) & (only["kind"] == "message"), single).otherwise(F.aggregate("log", start, step))
    out = log.select("conv_id", "message_id", only["seq"].alias("first_seq"), folded.alias("m"))
    return out.select("conv_id", "message_id", "first_seq", "m.regen_seq", "m.role", "m.text", "m.live")


def conversations_of(events: DataFrame) -> DataFrame:
    """`conv_id` and its final `turns`, an array of (role, text)."""
    messages = fold_messages(events)
    before = (
        Window.partitionBy("conv_id").orderBy("first_seq", "message_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    messages = messages.withColumn("cut", F.max("regen_seq").over(before))
    live = F.col("live") & ~F.coalesce(F.col("first_seq") < F.col("cut"), F.lit(False))
    turn = F.when(live, F.struct("first_seq", "message_id", "role", "text"))
    gathered = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return gathered.withColumn("turns", F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))))


def rendered(conversations: DataFrame) -> DataFrame:
    """Adds `formatted` and `loss_spans`: (turn, begin, length), begin counted in code points within the turn."""

    def pieces(turn):
        role, text = turn["role"], escaped(turn["text"])
        own = role == ASSISTANT
        head = F.concat(F.lit(OPEN), escaped_role(role), F.lit("\n"), F.when(own, F.lit("")).otherwise(F.lit(ASK)))
        tail = F.concat(F.when(own, F.lit("")).otherwise(F.lit(ASKED)), F.lit(CLOSE))
        return F.struct(head.alias("head"), text.alias("text"), tail.alias("tail"), own.alias("own"))

    out = conversations.withColumn("pieces", F.transform("turns", pieces))
    spans = F.filter(
        F.transform(
            "pieces",
            lambda p, i: F.when(
                p["own"],
                F.struct(i.alias("turn"), F.length(p["head"]).alias("begin"), F.length(p["text"]).alias("length")),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], p["tail"])), "")
    return out.withColumns({"formatted": text, "loss_spans": spans}).drop("pieces")


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns and the text under the loss mask, from `formatted` and `loss_spans` alone.

    The closing mark cannot stand inside a text, so cutting there gives the turns; each
    is then read once, which keeps the work linear in a conversation of any length.
    """

    def sub(text, begin, length):
        return F.call_function("substring", text, begin, length)

    def parsed(turn):
        at = F.locate("\n", turn)
        role = unescaped_role(sub(turn, F.lit(len(OPEN) + 1), at - 1 - len(OPEN)))
        body = sub(turn, at + 1, F.length(turn))
        asked = sub(body, F.lit(len(ASK) + 1), F.length(body) - len(ASK) - len(ASKED))
        inner = F.when(role == ASSISTANT, body).otherwise(asked)
        return F.struct(role.alias("role"), unescaped(inner).alias("text"))

    out = formatted.withColumn("cut", F.split("formatted", CLOSE))
    cut = F.col("cut")
    turns = F.transform(F.slice(cut, F.lit(1), F.size(cut) - 1), parsed)
    masked = F.transform("loss_spans", lambda s: unescaped(sub(F.get(cut, s["turn"]), s["begin"] + 1, s["length"])))
    return out.withColumns({"read_turns": turns, "loss_text": F.array_join(masked, "")}).drop("cut")


def turn_events(conversations: DataFrame) -> DataFrame:
    """A table of finished turns as a log: each row is one `message` event.

    Rows of one turn number are separate messages, ordered by role and text.
    """
    return _numbered(conversations).select(
        "conv_id", "seq", F.col("seq").alias("message_id"), F.lit("message").alias("kind"), "role", "text"
    )


def _numbered(conversations: DataFrame) -> DataFrame:
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text")
    return rows.withColumn("seq", F.row_number().over(order).cast("long"))


#: Code points that the edit of a streamed turn sets; and events for each turn.
EDITED, EVENTS = 16, 7


def streamed_events(conversations: DataFrame) -> DataFrame:
    """A table of finished turns as the log of a service that streams, edits and regenerates.

    Each turn begins as a draft, another message follows it, and a regeneration drops both the draft's text and
    that message. The text then comes as a wrong delta, an edit to the first `EDITED` code points, and the rest in
    two deltas. Folded, the log gives the turns again; what comes from a null text or role is empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    half = F.call_function("div", F.length("text") + F.lit(EDITED), F.lit(2)).cast("int")
    first = F.col("seq") * F.lit(EVENTS)
    none = F.lit(None).cast("string")

    def event(i, kind, role, text, own=True):
        message = F.col("seq") if own else -F.col("seq")
        return F.struct(
            (first + F.lit(i)).alias("seq"), message.alias("message_id"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text")
        )

    begin = F.lit(EDITED + 1)
    log = F.array(
        event(0, "message", F.col("role"), F.lit("draft")),
        event(1, "message", F.lit(ASSISTANT), F.lit("answer to a draft"), own=False),
        event(2, "regenerate", none, none),
        event(3, "delta", none, F.lit("wrong")),
        event(4, "edit", none, F.substring("text", 1, EDITED)),
        event(5, "delta", none, F.call_function("substring", F.col("text"), begin, half - F.lit(EDITED))),
        event(6, "delta", none, F.call_function("substring", F.col("text"), F.greatest(half + F.lit(1), begin))),
    )
    rows = _numbered(conversations).withColumn("text", text)
    return rows.select("conv_id", F.inline(log))
