"""What trajectory records hold, as tables: names, calls, arguments, schemas and totals.

Records have the nine raw fields as texts (see sources/files.py) and, where order matters, an order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toolloom.operators import catalog as C

SERVERS = "struct<mcp_servers:array<struct<remote_server_response:struct<tools:array<struct<name:string>>>>>>"
TOOL_LIST = "array<struct<function:struct<name:string,description:string>>>"


def available_names(records: DataFrame, key: str = "uuid") -> DataFrame:
    """key, position, function_name: names of a record's tools in order, doubles included; empty names and lists that don't decode give none."""
    names = F.transform(F.from_json("available_tools", TOOL_LIST), lambda t: t["function"]["name"])
    return records.select(key, F.posexplode(F.filter(names, lambda n: n != "")).alias("position", "function_name"))


def server_names(records: DataFrame, key: str = "uuid") -> DataFrame:
    """key, position, function_name: tools that the servers of the metadata list."""
    answers = F.transform(F.from_json("metadata", SERVERS)["mcp_servers"], lambda s: F.coalesce(s["remote_server_response"]["tools"], F.array().cast("array<struct<name:string>>")))
    names = F.transform(F.flatten(answers), lambda t: t["name"])
    return records.select(key, F.posexplode(F.filter(names, lambda n: n != "")).alias("position", "function_name"))


def mentions(records: DataFrame, key: str = "uuid") -> DataFrame:
    """key, origin (0 tools, 1 calls, 2 servers), position, function_name: every mention, doubles included."""
    said = C.calls(C.messages(records.withColumnRenamed(key, "uuid") if key != "uuid" else records))
    parts = [
        available_names(records, key).select(key, F.lit(0).alias("origin"), "position", "function_name"),
        said.select(F.col("uuid").alias(key), F.lit(1).alias("origin"), F.col("message_index").alias("position"), F.col("func").alias("function_name")),
        server_names(records, key).select(key, F.lit(2).alias("origin"), "position", "function_name"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def definitions(records: DataFrame, key: str = "uuid") -> DataFrame:
    """key, position, function_name, definition (JSON text) of the tools of each record."""
    tools = records.select(key, F.posexplode(F.from_json("available_tools", "array<string>")).alias("position", "definition"))
    return tools.select(key, "position", F.get_json_object("definition", "$.function.name").alias("function_name"), "definition").where("function_name <> ''")


def arguments(calls: DataFrame) -> DataFrame:
    """calls' columns without `arguments`, with param, value (variant) and runtime of each argument.

    Arguments are an object, or text that holds one; calls with anything else, or with an empty object, have no rows.
    """
    rest = [c for c in calls.columns if c != "arguments"]
    held = calls.select(*rest, F.try_parse_json("arguments").alias("_v"))
    # text within text: a JSON string that holds an object
    inner = F.when(F.schema_of_variant("_v") == "STRING", F.try_parse_json(F.try_variant_get("_v", "$", "string"))).otherwise(F.col("_v"))
    objects = held.select(*rest, inner.alias("_v")).where(F.schema_of_variant("_v").startswith("OBJECT"))
    return pairs(objects, "_v").select(*rest, F.col("key").alias("param"), "value", runtime_type(F.col("value")).alias("runtime"))


def pairs(objects: DataFrame, column: str) -> DataFrame:
    """objects' columns with pos, key and value of each pair of the objects in a column of variants."""
    return objects.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col(column).outer()))


def runtime_type(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "BOOLEAN", "boolean").when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer").when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "number")
        .when(kind == "STRING", "string").when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object")
    )


def declared_type(schema: Column) -> Column:
    """`type` of a property's schema: a text, or the first of a list that is not null (the first, if all are)."""
    listed = F.try_variant_get(schema, "$.type", "array<string>")
    first = F.coalesce(F.get(F.filter(listed, lambda x: x != "null"), F.lit(0)), F.get(listed, F.lit(0)))
    own = F.when(F.schema_of_variant(F.try_variant_get(schema, "$.type", "variant")).startswith("ARRAY"), first).otherwise(F.when(F.schema_of_variant(F.try_variant_get(schema, "$.type", "variant")) == "STRING", F.try_variant_get(schema, "$.type", "string")))
    return F.when(own != "", own)


def infer_type(schema: Column, runtime: Column, default: str | None = None) -> Column:
    """The declared type, else that of the value, else the default."""
    return F.coalesce(declared_type(schema), runtime, F.lit(default).cast("string"))


def properties(catalog: DataFrame) -> DataFrame:
    """function_name, param, position, schema (variant), declared, required, has_enum, item_type of each property.

    catalog: function_name, definition (JSON text; its parameters under `function`, or beside it).
    """
    v = F.try_parse_json("definition")
    own = catalog.select("function_name", F.coalesce(F.try_variant_get(v, "$.function.parameters", "variant"), F.try_variant_get(v, "$.parameters", "variant")).alias("_p"))
    own = own.select("function_name", F.coalesce(F.try_variant_get("_p", "$.required", "array<string>"), F.array().cast("array<string>")).alias("_r"), F.try_variant_get("_p", "$.properties", "variant").alias("_q"))
    own = own.where(F.schema_of_variant("_q").startswith("OBJECT"))
    rows = pairs(own, "_q").select("function_name", "_r", F.col("pos").alias("position"), F.col("key").alias("param"), F.col("value").alias("schema"))
    item = F.try_variant_get("schema", "$.items.type", "string")
    return rows.select("function_name", "param", "position", "schema", declared_type(F.col("schema")).alias("declared"), F.array_contains("_r", F.col("param")).alias("required"), F.try_variant_get("schema", "$.enum", "variant").isNotNull().alias("has_enum"), item.alias("item_type"))


def with_schema(args: DataFrame, properties_: DataFrame) -> DataFrame:
    """Arguments (func, param, runtime) with p_type, required, has_enum and item_type; a property that the catalog lacks has none of them."""
    known = properties_.select(F.col("function_name").alias("func"), "param", "schema", "declared", "required", "has_enum", "item_type")
    both = args.join(known, ["func", "param"], "left")
    return both.select(*args.columns, F.coalesce("declared", "runtime", F.lit("unknown")).alias("p_type"), F.coalesce("required", F.lit(False)).alias("required"), F.coalesce("has_enum", F.lit(False)).alias("has_enum"), "item_type")


def prompt_tasks(calls: DataFrame, args: DataFrame, catalog: DataFrame) -> DataFrame:
    """Calls with arguments of functions that the catalog knows, with their definition."""
    asked = args.select("uuid", "message_index").distinct()
    return calls.join(asked, ["uuid", "message_index"], "left_semi").join(catalog.select(F.col("function_name").alias("func"), "definition"), "func")


def totals(lines: DataFrame, calls: DataFrame, args: DataFrame) -> DataFrame:
    """One row: records (lines that are not blank, decodable or not), calls, arguments."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return n(lines.where(F.trim("line") != ""), "records").join(n(calls, "calls")).join(n(args, "arguments"))


def first_definitions(definitions_: DataFrame, order: list[str]) -> DataFrame:
    """function_name, definition: the first met in the order of the columns."""
    return definitions_.groupBy("function_name").agg(F.min_by("definition", F.struct(*order)).alias("definition"))


def limited(records: DataFrame, file: str, order: list[str], n: int) -> DataFrame:
    """The first n records of each file."""
    w = Window.partitionBy(file).orderBy(*order)
    return records.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")
