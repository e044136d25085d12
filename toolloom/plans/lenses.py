"""The given tables seen as trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def calls(spark, d) -> DataFrame:
    """events as calls: uuid, message_index, func, k, amount, event_id, ts."""
    e = _t(spark, d, "events")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return e.select(F.col("user_id").alias("uuid"), n.cast("long").alias("message_index"), F.col("event_type").alias("func"), F.get_json_object("props", "$.k").cast("long").alias("k"), F.col("value").alias("amount"), "event_id", "ts")


def call_args(spark, d) -> DataFrame:
    """Long form of the calls' integer argument k: uuid, message_index, func, param, p_type, cluster, value, source, ord."""
    from toolloom.functions.text import cluster_integer

    c = calls(spark, d)
    return c.select("uuid", "message_index", "func", F.lit("k").alias("param"), F.lit("integer").alias("p_type"), cluster_integer(F.col("k")).alias("cluster"), F.col("k").cast("string").alias("value"), (F.col("event_id") % 4).alias("source"), F.col("event_id").alias("ord"))


def two_args(spark, d) -> DataFrame:
    """As call_args, with the half of k as a second argument."""
    return halved(call_args(spark, d))


def halved(args: DataFrame) -> DataFrame:
    """Each argument, and its half as a second one, in one pass."""
    half = F.struct(F.lit("half").alias("param"), F.floor(F.col("value").cast("long") / 2).cast("string").alias("value"))
    rest = [c for c in args.columns if c not in ("param", "value")]
    return args.select(*rest, F.inline(F.array(F.struct("param", "value"), half))).select(*args.columns)


def messages(spark, d) -> DataFrame:
    """conversations as messages: an assistant turn with turn % 4 of 1 or 2 is a call."""
    c = _t(spark, d, "conversations")
    is_call = (F.col("role") == "assistant") & (F.col("turn") % 4).isin(1, 2)
    return c.select(F.col("conv_id").alias("uuid"), F.col("turn").alias("message_index"), "role", F.col("text").alias("content"), is_call.alias("is_call"), F.when(is_call, F.concat(F.lit("tool_"), (F.col("conv_id") % 7).cast("string"))).alias("func"))


def catalog(spark, d) -> DataFrame:
    """part as a catalog of tools: function_name, description, ord."""
    p = _t(spark, d, "part")
    dashed = lambda c: F.replace(F.lower(c), F.lit(" "), F.lit("-"))
    return p.select(F.concat_ws("-", dashed(F.col("p_type")), dashed(F.col("p_brand")), dashed(F.col("p_name"))).alias("function_name"), F.concat_ws(" ", "p_name", "p_type").alias("description"), F.col("p_partkey").alias("ord"))


SCHEMAS = {
    "get_lineitem": (["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"], ["l_orderkey", "l_linenumber"]),
    "get_order": (["o_orderkey", "o_custkey", "o_orderdate"], ["o_orderkey"]),
    "get_customer": (["c_custkey"], ["c_custkey"]),
    "get_nation": (["n_nationkey", "n_name", "n_regionkey"], ["n_nationkey", "n_name", "missing"]),
    "list_regions": (["r_name"], []),
}


def schemas(spark) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in SCHEMAS.items()], "function_name string, properties array<string>, required array<string>")


def trajectories(spark, d) -> DataFrame:
    """conversations as raw records: order_key, uuid, question, available_tools, messages, target_tools, metadata, all but the key as texts.

    Calls are as in messages(); each has three arguments, and each record three tools and a server with one.
    """
    c = _t(spark, d, "conversations")
    is_call = (F.col("role") == "assistant") & (F.col("turn") % 4).isin(1, 2)
    held = F.to_json(F.struct(F.floor(F.col("turn") / 2).alias("half"), F.col("turn"), F.col("role").alias("who")))
    call = F.when(is_call, F.struct(F.concat(F.lit("tool_"), (F.col("conv_id") % 7).cast("string")).alias("name"), held.alias("arguments")))
    message = F.struct("turn", F.struct("role", F.col("text").alias("content"), call.alias("function_call")).alias("m"))
    one = c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(message)), lambda x: x["m"]).alias("said"))
    kind = lambda t: F.struct(F.lit(t).alias("type"))
    schema = F.struct(F.lit("object").alias("type"), F.struct(kind("integer").alias("turn"), F.struct(F.lit("number").alias("type"), F.lit("of the turn").alias("description")).alias("half"), kind("string").alias("who")).alias("properties"), F.array(F.lit("turn"), F.lit("half")).alias("required"))

    def tool(k: int):
        n = ((F.col("conv_id") + k) % 7).cast("string")
        return F.struct(F.struct(F.concat(F.lit("tool_"), n).alias("name"), F.concat(F.lit("Tool "), n, F.lit(" as of "), F.col("conv_id").cast("string")).alias("description"), schema.alias("parameters")).alias("function"))

    server = F.struct(F.struct(F.array(F.struct(F.concat(F.lit("srv_"), (F.col("conv_id") % 3).cast("string")).alias("name"))).alias("tools")).alias("remote_server_response"))
    return one.select(F.col("conv_id").alias("order_key"), F.col("conv_id").cast("string").alias("uuid"), F.lit(None).cast("string").alias("question"), F.to_json(F.array(tool(0), tool(1), tool(3))).alias("available_tools"), F.to_json("said").alias("messages"), F.concat(F.lit("tool_"), (F.col("conv_id") % 7).cast("string")).alias("target_tools"), F.to_json(F.struct(F.array(server).alias("mcp_servers"))).alias("metadata"))
