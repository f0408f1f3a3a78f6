"""Chat formatting with Spark expressions only.

A conversation becomes one string of blocks; neighbouring turns of one role share a block:

    <|im_start|>role\\ntext[<|im_sep|>text ...]<|im_end|>\\n

Inside texts and roles ``<|`` is written ``<\\|`` and ``<\\`` is written ``<\\\\`` (in roles a
line feed also as ``<\\n``), so no control string comes from a text and each can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\([\\|])", "<$1")


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n"))


def unescaped_role(role: Column) -> Column:
    """Pairs are read from the left: an escaped backslash before ``n`` is no line feed."""
    parts = F.split(role, r"(?<=<\\[\\|n])")
    return F.array_join(F.transform(parts, lambda p: F.when(
        p.endswith("<\\n"), F.concat(F.substring(p, F.lit(1), F.length(p) - 3), F.lit("\n"))
    ).otherwise(unescaped(p))), "")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text",
                 learned_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss.

    ``loss`` lists (start, length) in code points of ``formatted`` of each text of
    ``learned_role``, in order, without role names and control strings. Turns are ordered by
    turn number, then role, then text (nulls first); repeated rows are all kept. A null text
    or role is empty; rows with a null conversation id form one conversation. No rows give
    no rows; other columns are ignored. All steps share one shuffle by conversation.
    """
    name = lambda c: F.col(f"`{c}`")
    rows = turns.select(
        name(conv_col).alias("conv_id"), name(turn_col).alias("turn"),
        F.coalesce(name(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(name(text_col).cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    opens = F.coalesce(F.lag("role").over(order) != F.col("role"), F.lit(True))
    closes = F.coalesce(F.lead("role").over(order) != F.col("role"), F.lit(True))
    rows = rows.select("conv_id", "role", escaped(F.col("text")).alias("text"),
                       F.row_number().over(order).alias("place"), opens.alias("opens"), closes.alias("closes"))
    before = F.when(F.col("opens"), F.length(escaped_role(F.col("role"))) + len(START) + 1).otherwise(len(SEP))
    rows = rows.withColumn("before", before.cast("long")).withColumn(
        "size", F.col("before") + F.length("text") + F.when(F.col("closes"), len(END)).otherwise(0))
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(
        "conv_id", "role", "text", "place", F.sum(F.col("opens").cast("long")).over(so_far).alias("block"),
        (F.sum("size").over(so_far) - F.col("size") + F.col("before")).alias("start"))
    blocks = rows.groupBy("conv_id", "block").agg(
        F.first("role").alias("role"),
        F.sort_array(F.collect_list(F.struct("place", "text", "start"))).alias("turns"))
    learned = F.transform("turns", lambda t: F.struct(
        t["start"].alias("start"), F.length(t["text"]).cast("long").alias("length")))
    blocks = blocks.select(
        "conv_id", "block",
        F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"),
                 F.array_join(F.transform("turns", lambda t: t["text"]), SEP), F.lit(END)).alias("content"),
        F.when(F.col("role") == learned_role, learned).otherwise(F.slice(learned, 1, 0)).alias("loss"))
    return blocks.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "content", "loss"))).alias("blocks")
    ).select("conv_id",
             F.array_join(F.transform("blocks", lambda b: b["content"]), "").alias("formatted"),
             F.flatten(F.transform("blocks", lambda b: b["loss"])).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted conversation, in order."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")
    pairs = F.transform(blocks, lambda b: F.transform(
        F.split(F.substring(b, F.instr(b, "\n") + 1, F.length(b)), r"<\|im_sep\|>"),
        lambda t: F.struct(
            unescaped_role(F.substring(b, F.lit(len(START) + 1), F.instr(b, "\n") - len(START) - 1)).alias("role"),
            unescaped(t).alias("text"))))
    return F.flatten(pairs)


def learned_texts(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(loss, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"])))
