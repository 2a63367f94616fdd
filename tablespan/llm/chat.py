"""Prefix-target expansion of conversations into training examples.

Every assistant turn becomes one example: all preceding turns are its context, written out in front of it, and only that
reply is trainable. Contexts of one conversation are prefixes of each other, so all examples together are as long as
the square of a conversation. They are cut from the conversation's formatted turns one by one, in shares of about
SHARE_CHARS code points that different tasks take: a task holds the turns and one example, however many there are.

A formatted turn is  <|turn|>role<|text|>text<|end|>.  Control strings inside roles and texts are escaped by one more
backslash after their first character, which `unescaped` takes away again, so any text comes back unchanged.

Defined results: a null role or text is empty; turns are ordered by (turn, role, text), null turn numbers first, and
repeated rows stay; a null conv_id is a conversation of its own; columns besides conv_id, turn, role and text are
ignored, whatever their names; an empty table gives no rows; a conversation without assistant turns has turns but no
examples. Lengths and offsets count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Code points of examples that one task writes out of a conversation; longer ones have more shares.
SHARE_CHARS = 1 << 28
#: What marks turns here and in common chat templates, after a `<` or `[` and any number of backslashes.
_CONTROL = r"(?=\||/?s>|/?INST\]|<SYS>>|</SYS>>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, "$1$2")


def formatted_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, pos (from 0), is_reply, piece (the formatted turn), start (code points of the
    conversation before it), and the piece's own text as the span [text_start, text_end) of the conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(TURN), escaped(role), F.lit(TEXT))
    rows = conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), head.alias("head"), escaped(text).alias("body"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    piece = F.concat("head", "body", F.lit(END))
    rows = rows.select(
        "conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), (F.col("role") == "assistant").alias("is_reply"),
        piece.alias("piece"), (F.sum(F.length(piece).cast("long")).over(before) - F.length(piece)).alias("start"),
        F.length("head").alias("head_chars"), F.length("body").alias("body_chars"))
    text_start = F.col("start") + F.col("head_chars")
    return rows.select("conv_id", "pos", "is_reply", "piece", "start", text_start.alias("text_start"),
                       (text_start + F.col("body_chars")).alias("text_end"))


def expand_targets(turns: DataFrame) -> DataFrame:
    """One row per assistant turn of `formatted_turns`: conv_id, pos, context (all formatted turns before it), reply (its
    own) and loss_start, loss_end: the trainable span of context and reply together."""
    chars = F.col("start") + F.length("piece")
    target = F.when(F.col("is_reply"), F.struct("pos", "start", chars.alias("upto"), "text_start", "text_end"))
    whole = turns.groupBy("conv_id").agg(
        _stream().alias("stream"), F.collect_list(target).alias("targets"), F.sum(F.when(F.col("is_reply"), chars)).alias("chars"))
    shares = F.greatest(F.lit(1), F.least(F.ceil(F.col("chars") / SHARE_CHARS), F.size("targets").cast("long")))
    whole = whole.filter("chars is not null").select("*", shares.alias("shares"))
    dealt = whole.select("conv_id", "stream", "targets", "shares", F.explode(F.expr("sequence(0L, shares - 1)")).alias("share"))
    own = F.filter("targets", lambda t, i: F.pmod(i, F.col("shares")) == F.col("share"))
    dealt = dealt.select("conv_id", "share", "stream", own.alias("targets")).repartition("conv_id", "share")
    cut = lambda a, b: F.substring("stream", (a + 1).cast("int"), (b - a).cast("int"))
    t = F.col("target")
    return dealt.select("conv_id", "stream", F.explode("targets").alias("target")).select(
        "conv_id", t.pos.alias("pos"), cut(F.lit(0), t.start).alias("context"), cut(t.start, t.upto).alias("reply"),
        t.text_start.alias("loss_start"), t.text_end.alias("loss_end"))


def _stream() -> Column:
    return F.array_join(F.array_sort(F.collect_list(F.struct("pos", "piece")))["piece"], "")


def streams(turns: DataFrame) -> DataFrame:
    """conv_id and all formatted turns of the conversation in order as one string (at most Spark's 2 GB a value)."""
    return turns.groupBy("conv_id").agg(_stream().alias("stream"))


def with_context(turns: DataFrame) -> DataFrame:
    """The examples of `expand_targets`."""
    return expand_targets(turns)


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted output: conv_id, n_turns, turns_sha256, n_examples, loss_chars,
    loss_sha256, formatted_chars (the turns as one string) and expanded_chars (all examples, contexts included)."""
    read = F.transform(
        F.filter(F.split("stream", r"<\|end\|>"), lambda p: p != ""),
        lambda p: F.concat(
            unescaped(F.regexp_extract(p, r"(?s)^<\|turn\|>(.*?)<\|text\|>", 1)), F.lit("\n"),
            unescaped(F.regexp_extract(p, r"(?s)<\|text\|>(.*)$", 1)), F.lit("\n")))
    whole = streams(turns).select(
        "conv_id", F.length("stream").cast("long").alias("formatted_chars"), read.alias("read"))
    whole = whole.select("conv_id", "formatted_chars", F.size("read").cast("long").alias("n_turns"),
                         F.sha2(F.array_join("read", ""), 256).alias("turns_sha256"))
    text = F.concat("context", "reply")
    trained = unescaped(F.substring(text, (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")))
    examples = expand_targets(turns).select(
        F.col("conv_id").alias("of"), "pos", trained.alias("trained"), F.length(text).cast("long").alias("chars"))
    replies = examples.groupBy("of").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("pos", "trained")))["trained"], "").alias("trained"),
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    trained = F.coalesce("trained", F.lit(""))
    return whole.join(replies, whole.conv_id.eqNullSafe(replies.of), "left").select(
        "conv_id", "n_turns", "turns_sha256", F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"), "formatted_chars", F.coalesce("n", F.lit(0)).alias("n_examples"),
        F.coalesce("chars", F.lit(0)).alias("expanded_chars"))
