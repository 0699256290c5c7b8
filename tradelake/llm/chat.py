"""Chat formatting from an event log.

Events (conv_id, seq, message, kind, role, text) are partitioned by conversation and folded in order of `seq`:

- `delta` opens its message if it is new and adds text to it,
- `edit` replaces the text written so far,
- `regenerate` empties the message and drops every later message, as a client does when an answer is made anew,
- `delete` removes the message.

The messages left, in order of their first event, are rendered with a template. Its control strings are escaped
inside texts, so the output can be read back exactly. All of it is SQL. A conversation becomes one row of output,
so one conversation is what a task must hold; a conversation's deltas are joined per message before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template: a turn is OPEN role MIDDLE text CLOSE.
OPEN, MIDDLE, CLOSE = "<|turn|>", "<|says|>", "<|done|>"
# A text never holds "<|" after escaping: each "<" is followed by a backslash that unescaping takes away.
ESCAPED = "<\\"


def escape(text: Column) -> Column:
    """Reversible: every "<" becomes "<\\", so no control string can appear in an escaped text."""
    return F.replace(text, F.lit("<"), F.lit(ESCAPED))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit(ESCAPED), F.lit("<"))


def fold(events: DataFrame) -> DataFrame:
    """conv_id, message, place, role, text: the final messages of every conversation.

    Events that are equal in all columns are one event delivered twice. Events with equal `seq` are taken in order
    of message, kind, role and text. A null text is empty, a null role is the empty role, null seq comes first. An
    edit or regenerate of a message that no delta opened opens it. The role is that of the message's first event.
    """
    log = events.select(
        "conv_id",
        "seq",
        "message",
        F.coalesce(F.col("kind"), F.lit("delta")).alias("kind"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).dropDuplicates()
    order = ["seq", "message", "kind", "role", "text"]
    numbered = log.withColumn("nth", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
    # A message counts from its last edit or regeneration on; earlier deltas are overwritten.
    is_reset = F.col("kind").isin("edit", "regenerate")
    deleted = F.max(F.when(F.col("kind") == "delete", F.col("nth")))
    messages = numbered.groupBy("conv_id", "message").agg(
        F.min("nth").alias("place"),
        F.min_by("role", "nth").alias("role"),
        F.max(F.when(is_reset, F.col("nth"))).alias("reset"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("nth"))).alias("regenerated"),
        deleted.alias("deleted"),
        F.array_sort(
            F.collect_list(F.when(F.col("kind") != "delete", F.struct("nth", "kind", "text")))
        ).alias("parts"),
    )
    live = F.filter("parts", lambda p: (p.nth >= F.coalesce(F.col("reset"), F.lit(0))) & (p.kind != "regenerate"))
    # A regeneration drops the messages that were opened after the regenerated one and before the regeneration.
    whole = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    kept = messages.withColumn("cut", F.max("regenerated").over(whole)).where(
        (F.col("cut").isNull() | (F.col("place") > F.col("cut"))) & F.col("deleted").isNull()
    )
    return kept.select(
        "conv_id", "message", "place", "role", F.array_join(F.transform(live, lambda p: p.text), "").alias("text")
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted: the turns of each conversation in order, marked by the template."""
    turn = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE), escape(F.col("text")), F.lit(CLOSE))
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", turn.alias("turn")))).alias("turns"))
    return turns.select("conv_id", F.array_join(F.transform("turns", lambda t: t.turn), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """array(struct(role, text)): the turns of a formatted conversation, unescaped."""
    turns = F.split(formatted, F.lit("<\\|done\\|>"), -1)  # the last part is what follows the last turn: nothing
    return F.transform(
        F.slice(turns, F.lit(1), F.size(turns) - 1),
        lambda t: F.struct(
            unescape(F.substring_index(F.replace(t, F.lit(OPEN), F.lit("")), MIDDLE, 1)).alias("role"),
            unescape(F.substring_index(t, MIDDLE, -1)).alias("text"),
        ),
    )


def loss_spans(formatted: Column, role: str = "assistant") -> Column:
    """array(struct(start, length)): the code points of `formatted`, from 0, that a model is trained on: the role's texts."""
    turns = F.split(formatted, F.lit("<\\|done\\|>"), -1)
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"))
    head = f"{OPEN}{role}{MIDDLE}"

    def add(acc: Column, t: Column) -> Column:
        span = F.struct((acc.at + len(head)).alias("start"), (F.length(t) - len(head)).alias("length"))
        return F.struct(
            (acc.at + F.length(t) + len(CLOSE)).alias("at"),
            F.when(F.startswith(t, F.lit(head)), F.concat(acc.spans, F.array(span))).otherwise(acc.spans).alias("spans"),
        )

    return F.aggregate(turns, start, add, lambda acc: acc.spans)


def summarize(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted conversations: counts and digests of turns and of the text under the loss mask."""
    read = formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"))
    head = f"{OPEN}assistant{MIDDLE}"
    trained = F.filter(F.split("formatted", F.lit("<\\|done\\|>"), -1), lambda t: F.startswith(t, F.lit(head)))
    masked = unescape(F.array_join(F.transform(trained, lambda t: F.substring(t, len(head) + 1, 2**31 - 1)), ""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"),
        F.sha2(F.encode(masked, "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
