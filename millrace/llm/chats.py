"""Chats as marked text, with Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of one role are
merged into one block by array aggregation, their texts apart by a separator; blocks are joined:

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

Inside texts and roles every ``<|``, ``<\\|``, ... gets one backslash more, which reading back takes
away, so no text can open a control string. Line ends in roles become ``<|nl|>``.

Null texts and roles are empty ones, turns with a null number come first, turns with the same
number are ordered by role and text, repeated rows are turns of their own, null conversation ids
are one conversation. No rows give no rows. A conversation is one output value, so one
conversation, as any value, is limited to 2 GB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import tuned

START, SEP, END, LINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|nl|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_chats(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, formatted, loss_spans): the text and the code points [start, end) of assistant texts."""
    tuned(turns.sparkSession)
    whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(id_col).alias("id"), F.struct(F.col("turn").alias("turn"), whole("role").alias("role"), whole("text").alias("text")).alias("t"))
    # turns are put in order as they were given, and escaped then
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(
        F.replace(escape(t["role"]), F.lit("\n"), F.lit(LINE)).alias("role"), escape(t["text"]).alias("text")))
    sorted_ = rows.groupBy("id").agg(ordered.alias("turns"))

    def opened(t: Column, i: Column) -> Column:
        before = F.get(F.col("turns"), i - 1)["role"]
        lead = F.when(i == 0, F.concat(F.lit(START), t["role"], F.lit("\n"))).when(before == t["role"], F.lit(SEP)).otherwise(
            F.concat(F.lit(END + "\n" + START), t["role"], F.lit("\n")))
        return F.struct(lead.alias("lead"), t["text"].alias("text"), (t["role"] == "assistant").alias("loss"))

    parts = sorted_.select("id", F.transform("turns", opened).alias("parts"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def place(state: Column, p: Column) -> Column:
        start = state["at"] + F.char_length(p["lead"])
        end = start + F.char_length(p["text"])
        one = F.array(F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
        return F.struct(end.cast("bigint").alias("at"), F.when(p["loss"], F.concat(state["spans"], one)).otherwise(state["spans"]).alias("spans"))

    return parts.select(
        "id",
        F.concat(F.array_join(F.transform("parts", lambda p: F.concat(p["lead"], p["text"])), ""), F.lit(END + "\n")).alias("formatted"),
        F.aggregate("parts", F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans")), place)["spans"].alias("loss_spans"))


def read_back(chats: DataFrame) -> DataFrame:
    """(id, turns, loss_text, formatted): the turns as given, and what stands under the loss mask."""
    def block(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        texts = F.split(b.substr(F.char_length(role) + 2, F.char_length(b)), r"<\|im_sep\|>", -1)
        return F.transform(texts, lambda x: F.struct(
            unescape(F.replace(role, F.lit(LINE), F.lit("\n"))).alias("role"), unescape(x).alias("text")))

    body = F.expr(f"substring(formatted, {len(START) + 1}, char_length(formatted) - {len(START) + len(END) + 1})")
    blocks = F.split(body, r"<\|im_end\|>\n<\|im_start\|>", -1)
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.col("formatted").substr(
        (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    return chats.select("id", F.flatten(F.transform(blocks, block)).alias("turns"), loss.alias("loss_text"), "formatted")
