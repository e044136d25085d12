"""Trajectories with their questions as one text for each record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Order of the modes, and the marker before an answer that follows a call.
MODES = ("available", "params", "param_values")
ANSWER_MARK = "[[原文回答]]"


def indent(text: Column, by: str) -> Column:
    """Blank lines stay as they are."""
    return F.regexp_replace(text, r"(?m)^(?=.*\S)", by)


def with_markers(messages: DataFrame) -> DataFrame:
    """Adds `marker`: the message answers a call, as the first assistant text since.

    messages: uuid, message_index, role, content, is_call.
    """
    before = Window.partitionBy("uuid").orderBy("message_index").rowsBetween(Window.unboundedPreceding, -1)
    text = (~F.col("is_call")) & (F.col("role") == "assistant") & (F.coalesce("content", F.lit("")) != "")
    last_call = F.max(F.when(F.col("is_call"), F.col("message_index"))).over(before)
    last_text = F.max(F.when(text, F.col("message_index"))).over(before)
    return messages.withColumn("marker", text & last_call.isNotNull() & (last_call > F.coalesce(last_text, F.lit(-1))))


def question_block(mode: Column, index: Column, question: Column, options: Column, answer: Column, reveal: bool) -> Column:
    lines = [F.concat(F.lit("[MCQ:"), mode, F.lit("|msg="), index.cast("string"), F.lit("]")), F.lit("Question:"), indent(question, "  "), F.lit("Options:"), indent(options, "  ")]
    if reveal:
        lines.append(F.concat(F.lit("Answer: the answer is "), answer))
    return F.concat_ws("\n", *lines)


def assembled(messages: DataFrame, blocks: DataFrame) -> DataFrame:
    """uuid, text.  blocks: uuid, message_index, mode_rank, ord, block; messages as for with_markers, with func."""
    m = with_markers(messages)
    call = F.concat(F.lit("assistant (function_call: "), "func", F.lit(") @msg="), F.col("message_index").cast("string"), F.lit(":"))
    body = F.when(F.col("is_call"), F.concat_ws("\n", indent(call, "  "), indent(F.trim("content"), "    "))).otherwise(F.concat_ws("\n", F.when(F.col("marker"), F.lit("  " + ANSWER_MARK)), F.concat(F.lit("  "), F.col("role"), F.lit(":")), indent(F.trim("content"), "    ")))
    rows = m.select("uuid", "message_index", F.lit(9).alias("mode_rank"), F.lit(0).cast("long").alias("ord"), body.alias("part"))
    asked = blocks.join(m.where("is_call").select("uuid", "message_index"), ["uuid", "message_index"], "left_semi")
    rows = rows.unionByName(asked.select("uuid", "message_index", "mode_rank", F.col("ord").cast("long").alias("ord"), indent(F.col("block"), "    ").alias("part")))
    parts = rows.groupBy("uuid").agg(F.array_sort(F.collect_list(F.struct("message_index", "mode_rank", "ord", "part"))).alias("p"))
    head = F.concat(F.lit("=== Record | uuid="), F.col("uuid").cast("string"), F.lit(" ===\nMessages:\n"))
    return parts.select("uuid", F.concat(head, F.array_join("p.part", "\n"), F.lit("\n")).alias("text"))
