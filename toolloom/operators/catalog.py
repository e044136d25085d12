"""Mentions, counts, the catalog of tools, aliases and obfuscation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toolloom.functions import text as X

TOOLS = "array<struct<function:struct<name:string,description:string,parameters:variant>>>"
MESSAGES = "array<struct<role:string,content:string,name:string,function_call:struct<name:string,arguments:string>>>"


def messages(records: DataFrame) -> DataFrame:
    """uuid, message_index and fields of each message."""
    rows = records.select("uuid", F.posexplode(F.from_json("messages", MESSAGES)).alias("message_index", "m"))
    return rows.select("uuid", "message_index", "m.role", "m.content", "m.name", F.col("m.function_call.name").alias("func"), F.col("m.function_call.arguments").alias("arguments"))


def calls(messages_: DataFrame) -> DataFrame:
    """Messages that call a tool, whatever their role."""
    return messages_.where("func is not null and func <> ''")


def usage(mentions: DataFrame, order: str) -> DataFrame:
    """function_name, count, rank: by falling count, ties by first encounter.  The window is over one row for each name."""
    n = mentions.where("function_name <> ''").groupBy("function_name").agg(F.count(F.lit(1)).alias("count"), F.min(order).alias("first"))
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("count"), "first", "function_name"))).select("function_name", "count", "rank")


def first_seen(definitions: DataFrame, order: str) -> DataFrame:
    """One definition for each name: the first met."""
    return definitions.groupBy("function_name").agg(F.min_by("definition", order).alias("definition"))


def build_aliases(names: DataFrame, existing: DataFrame | None = None, salt: str = "", rounds: int = 32) -> DataFrame:
    """function_name, alias: an injective map that keeps what exists and gives new names the first free attempt.

    Names in order take their first free alias.  Done in rounds: every name that has none proposes its
    alias of the present attempt; holders with a smaller name (or in the existing map) win, others go on.
    Nearly always one round is enough, as there are 681 million aliases.
    """
    spark = names.sparkSession
    held = existing.select("function_name", "alias") if existing is not None else spark.createDataFrame([], "function_name string, alias string")
    open_ = names.select("function_name").where("function_name is not null").distinct().join(held, "function_name", "left_anti").withColumn("attempt", F.lit(0))
    for _ in range(rounds):
        asked = open_.withColumn("alias", X.alias(F.col("function_name"), F.lit(salt), F.col("attempt")))
        taken = asked.join(held.select("alias", F.lit(True).alias("taken")), "alias", "left")
        rank = F.row_number().over(Window.partitionBy("alias").orderBy("function_name"))
        judged = taken.withColumn("wins", F.col("taken").isNull() & (rank == 1))
        if not judged.where("not wins").limit(1).count():
            return held.unionByName(judged.select("function_name", "alias"))
        open_ = judged.select("function_name", F.when(F.col("wins"), F.col("attempt")).otherwise(F.col("attempt") + 1).alias("attempt"))
    raise ValueError("aliases don't settle")


def apply_alias(df: DataFrame, aliases: DataFrame, column: str) -> DataFrame:
    """The column's names by their aliases; names without one stay."""
    known = aliases.select(F.col("function_name").alias(column), F.col("alias").alias("_alias"))
    return df.join(known, column, "left").withColumn(column, F.coalesce("_alias", column)).drop("_alias")


def label(df: DataFrame, aliases: DataFrame, column: str) -> DataFrame:
    """`alias (original)` where the column holds an alias; of several originals the last."""
    back = aliases.groupBy("alias").agg(F.max("function_name").alias("_name")).withColumnRenamed("alias", column)
    return df.join(back, column, "left").withColumn("label", F.coalesce(F.concat(F.col(column), F.lit(" ("), F.col("_name"), F.lit(")")), F.col(column))).drop("_name")


def leaks(texts: DataFrame, aliases: DataFrame, column: str) -> DataFrame:
    """Original names left in free text: one row for each name and text, by words of letters, digits, - and _."""
    words = texts.withColumn("function_name", F.explode(F.array_distinct(F.regexp_extract_all(column, F.lit("[A-Za-z0-9_-]+"), F.lit(0)))))
    return words.join(aliases.select("function_name"), "function_name", "left_semi")
