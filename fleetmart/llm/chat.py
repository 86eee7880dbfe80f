"""Chat formatting: event logs folded into messages, messages rendered into one text per conversation.

Everything here is DataFrame functions. Events are partitioned by conversation and turn, put in order and
folded; rendering then needs one more exchange, by conversation, as a conversation becomes one text.

Defined results: a NULL text or role counts as empty; a NULL conversation id is a conversation of its own; NULL
turns come first; events of one turn with the same ``seq`` go by role and text; repeated ``message`` rows are
repeated messages; an empty log gives no rows; columns other than those named are left behind at the start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END = "</turn>"
HEAD = "### "
LEARNED_ROLE = "assistant"


def escape(c: Column) -> Column:
    """Text in which neither the mark of a turn's start nor that of its end occurs; ``unescape`` undoes it."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit(END), F.lit("<\\/turn>"))
    return F.replace(c, F.lit(HEAD), F.lit("\\### "))


def unescape(c: Column) -> Column:
    """Each backslash goes and the character after it stays."""
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, part, role, text) of a log (conv_id, turn, seq, op, role, text).

    Within a turn, by ``seq``: ``message`` (or NULL) starts a message, ``delta`` appends a piece to it, ``edit``
    replaces its text, ``regenerate`` drops its text so that later pieces build it anew. Events before the
    first ``message`` of a turn form a message too. The last role given holds. ``part`` numbers the messages of
    one turn.
    """
    e = events.select(
        "conv_id", "turn", "seq", F.coalesce("op", F.lit("message")).alias("op"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["seq", "role", "text"]
    turn = Window.partitionBy("conv_id", "turn").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("part", F.sum((F.col("op") == "message").cast("long")).over(turn))
    e = e.withColumn("event", F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy(*order)))
    message = Window.partitionBy("conv_id", "turn", "part").orderBy("event").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("version", F.sum(F.col("op").isin("edit", "regenerate").cast("long")).over(message))
    e = e.withColumn("piece", F.when(F.col("op") == "regenerate", "").otherwise(F.col("text")))
    held = e.groupBy("conv_id", "turn", "part").agg(
        F.max("version").alias("last"),
        F.max_by("role", F.when(F.col("role") != "", F.col("event")).otherwise(-F.col("event"))).alias("role"),
        F.sort_array(F.collect_list(F.struct("event", "version", "piece"))).alias("pieces"),
    )
    last = F.filter("pieces", lambda p: p["version"] == F.col("last"))
    return held.select(
        "conv_id", "turn", "part", "role", F.array_join(F.transform(last, lambda p: p["piece"]), "").alias("text")
    )


def render(messages: DataFrame, learned: str = LEARNED_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask.

    A message becomes ``### role: text</turn>`` and a line end, both parts escaped. ``loss_mask`` names the
    stretches to learn from: number of the turn (from 0), start and end (exclusive) in code points of that turn,
    counted from its first ``#``. They cover the escaped text of the ``learned`` role.
    """
    role = F.replace(escape(F.col("role")), F.lit(": "), F.lit(":\\ "))
    m = messages.select("conv_id", "turn", "part", (F.col("role") == learned).alias("mask"),
                        F.concat(F.lit(HEAD), role, F.lit(": ")).alias("head"), escape(F.col("text")).alias("body"))
    piece = F.struct("turn", "part", "head", "body", "mask")
    c = m.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("turns"))
    spans = F.transform(
        F.col("turns"),
        lambda t, i: F.when(
            t["mask"],
            F.struct(i.alias("turn_no"), F.length(t["head"]).alias("start"),
                     (F.length(t["head"]) + F.length(t["body"])).alias("end")),
        ),
    )
    return c.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "").alias(
            "formatted"
        ),
        F.filter(spans, lambda s: s.isNotNull()).alias("loss_mask"),
    )


def format_conversations(events: DataFrame) -> DataFrame:
    """Event log to formatted conversations with their loss masks."""
    return render(fold_events(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role and text of each) and learned (texts under the mask), from the output alone."""
    cut = F.split("formatted", END + "\n")
    with_turns = formatted.withColumn("raw", F.slice(cut, 1, F.size(cut) - 1))
    colon = lambda t: F.instr(t, ": ")
    return with_turns.select(
        "conv_id", "formatted",
        F.transform("raw", lambda t: F.struct(
            unescape(F.substr(t, F.lit(len(HEAD) + 1), colon(t) - len(HEAD) - 1)).alias("role"),
            unescape(F.substr(t, colon(t) + 2)).alias("text"),
        )).alias("turns"),
        F.transform("loss_mask", lambda s: unescape(
            F.substr(F.element_at("raw", s["turn_no"] + 1), s["start"] + 1, s["end"] - s["start"]))).alias("learned"),
    )


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The given table as a log: every row is a whole message of its turn."""
    return conversations.select(
        "conv_id", "turn", F.lit(0).alias("seq"), F.lit("message").alias("op"), "role", "text"
    )


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts hold the template's own marks."""
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
