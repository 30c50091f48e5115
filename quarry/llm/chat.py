"""Chat formatting in budgeted, turn-aligned windows, as DataFrame operations.

A turn is written ``<|im_start|>role<|im_sep|>text<|im_end|>``.  Control strings
of this and other public templates inside roles and texts are escaped with a
backslash after their first character, backslashes are doubled; ``unescape``
restores the text.

Windows: a turn costs ``MARKS`` and its words or a quarter of its bytes, what is
more, so that texts without spaces cost what they hold.  A conversation's first
turn, if it is of the system, not alone and at most half the budget, opens every
window; a longer one is a turn like others.  The prefix sums of the other turns'
costs are cut every half of what is left of the budget beside the system turn
and the history; a turn is in the window where it starts.  A turn above that
half gets a window of its own.  Before a window's own turns come those before
them that fit ``history`` tokens and the budget, without loss: the loss mask
covers each assistant text once, where it is new.  So only a turn that does not
fit beside the system turn makes a window above the budget, and stands there
without history.

Prefix sums and history are window functions over a conversation (streamed and
spilled by Spark); rows are collected per window only, so by the budget and the
longest turn.  Texts are formatted whole, however long.

Null text and role are empty.  Turns of equal number go by role, then text.  A
null conversation id is one conversation.  Repeated rows are turns of their own.
An empty table gives no window.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of public chat templates, after their first character.
_ANGLE = r"\|im_start\||\|im_sep\||\|im_end\||\|endoftext\||\|startoftext\||s>|/s>|<SYS>>|</SYS>>"
_SQUARE = r"/?INST\]"
MARKS = 3
BUDGET = 512
HISTORY = 128


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    angle = F.regexp_replace(doubled, f"<(?={_ANGLE})", "<\\\\")
    return F.regexp_replace(angle, rf"\[(?={_SQUARE})", "[\\\\")


def unescape(text: Column) -> Column:
    angle = F.regexp_replace(text, rf"<\\(?={_ANGLE})", "<")
    square = F.regexp_replace(angle, rf"\[\\(?={_SQUARE})", "[")
    return F.replace(square, F.lit("\\\\"), F.lit("\\"))


def windows(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: ``conv_id, window, formatted, loss, n_repeated, n_turns, tokens``.

    ``window`` ascends within the conversation.  ``loss``: ``(start, length)`` in
    code points of ``formatted``.  The first ``n_repeated`` of its ``n_turns``
    turns were in an earlier window.
    """
    rows = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    if 4 * history > budget:
        raise ValueError("history takes at most a quarter of the budget")
    size = F.greatest(F.regexp_count("text", F.lit(WORD)), F.ceil(F.octet_length("text") / 4))
    rows = rows.withColumn("cost", (size + MARKS).cast("long"))
    conv = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("n", F.row_number().over(conv)).withColumn("more", F.lead("cost").over(conv).isNotNull())
    rows = rows.withColumn("opens", (F.col("n") == 1) & (F.col("role") == "system") & F.col("more") & (F.col("cost") <= budget // 2))
    turn_of = F.struct("n", F.col("role").alias("role"), F.col("text").alias("text"), F.col("cost").alias("cost"))
    order = Window.partitionBy("conv_id").orderBy("n")
    rows = rows.withColumn("system", F.first(F.when(F.col("opens"), turn_of)).over(order))
    rows = rows.where("NOT opens").withColumn("end", F.sum("cost").over(order)).withColumn("begin", F.col("end") - F.col("cost"))
    by_cost = Window.partitionBy("conv_id").orderBy("begin").rangeBetween(-history, -1)
    rows = rows.withColumn("past", F.collect_list(F.struct("begin", turn_of.alias("t"))).over(by_cost))
    room = F.lit(budget - history) - F.coalesce(F.col("system.cost"), F.lit(0))
    step = F.greatest(F.lit(1), F.floor(room / 2)).cast("long")
    # History beside a turn in a window of its own is what the budget leaves.
    from_ = F.when(F.col("cost") > step, F.col("begin") - (room + history - F.col("cost"))).otherwise(F.col("begin") - history)
    rows = rows.withColumn("from", from_).withColumn("before", F.transform(
        F.filter("past", lambda x: x["begin"] >= F.col("from")), lambda x: x["t"])).drop("past")
    cell = F.floor(F.col("begin") / step) * 2
    rows = rows.withColumn("window", F.when(F.col("cost") > step, cell + 1).otherwise(cell).cast("long"))
    got = rows.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(turn_of)).alias("new"), F.min_by("before", "n").alias("before"),
        F.first("system").alias("system"), F.min("n").alias("first"), F.min_by("begin", "n").alias("begin"))
    system = F.when(F.col("system").isNull(), F.array().cast("array<struct<n:int,role:string,text:string,cost:bigint>>")).otherwise(F.array("system"))
    opening = F.size(system)
    got = got.withColumn("turns", F.concat(system, F.col("before"), F.col("new"))).withColumn(
        "n_repeated", F.size("before") + F.when(F.col("begin") > 0, opening).otherwise(0))
    got = got.withColumn("fresh_from", opening + F.size("before"))
    written = F.transform("turns", lambda t, i: F.struct(
        F.concat(F.lit(START), escape(t["role"]), F.lit(SEP)).alias("head"), escape(t["text"]).alias("body"),
        ((t["role"] == "assistant") & (i >= F.col("fresh_from"))).alias("learn")))
    got = got.withColumn("written", written)
    step_type = "struct<at:int,loss:array<struct<start:int,length:int>>>"

    def mark(a: Column, t: Column) -> Column:
        start, length = a["at"] + F.char_length(t["head"]), F.char_length(t["body"])
        loss = F.when(t["learn"], F.concat(a["loss"], F.array(F.struct(start.alias("start"), length.alias("length"))))).otherwise(a["loss"])
        return F.struct((start + length + len(END)).alias("at"), loss.alias("loss"))

    none = F.from_json(F.lit('{"at":0,"loss":[]}'), step_type)
    return got.select(
        "conv_id", "window", F.array_join(F.transform("written", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("written", none, mark, lambda a: a["loss"]).alias("loss"), "n_repeated", F.size("turns").alias("n_turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["cost"]).alias("tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """From windows: ``conv_id, window, turns`` (the turns that are new in each) and ``learned`` (texts under the mask)."""
    parts = F.split("formatted", r"<\|im_end\|>")
    turns = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, F.lit(len(START) + 1), F.char_length(p)), SEP, 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, SEP) + len(SEP), F.char_length(p))).alias("text")))
    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.select("conv_id", "window", F.slice(turns, F.col("n_repeated") + 1, F.size(turns)).alias("turns"),
                            learned.alias("learned"), F.char_length("formatted").alias("chars"))
