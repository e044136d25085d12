"""Aliases inside whole trajectory records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.functions import fidelity
from toolloom.functions import records as R
from toolloom.operators import trajectories as T
from toolloom.session import ship

TOOL_NAMES = "array<struct<function:struct<name:string>>>"
CALL_NAMES = "array<struct<name:string,function_call:struct<name:string>>>"


#: Between the marks of a declaration in a system prompt.
DECLARED = r"(?s)" + R.MIDDLE.replace("|", "\\|") + "(.*?)" + R.END.replace("|", "\\|")


def names_used(records: DataFrame, key: str = "uuid") -> DataFrame:
    """key, function_name: names in the tools, messages, declarations, targets and metadata of each record, once."""
    tools = F.transform(F.from_json("available_tools", TOOL_NAMES), lambda x: x["function"]["name"])
    said = F.from_json("messages", CALL_NAMES)
    parts = [tools, F.transform(said, lambda m: m["name"]), F.transform(said, lambda m: m["function_call"]["name"]), F.from_json("target_tools", "array<string>"), F.array("target_tools")]
    prompts = F.filter(F.from_json("messages", "array<struct<role:string,content:string>>"), lambda m: m["role"] == "system")
    declared = F.flatten(F.transform(prompts, lambda m: F.coalesce(F.transform(F.from_json(F.regexp_extract(m["content"], DECLARED, 1), TOOL_NAMES), lambda x: x["function"]["name"]), F.array().cast("array<string>"))))
    parts.append(declared)
    servers = F.flatten(F.transform(F.from_json("metadata", T.SERVERS)["mcp_servers"], lambda s: F.coalesce(F.transform(s["remote_server_response"]["tools"], lambda t: t["name"]), F.array().cast("array<string>"))))
    if "metadata" in records.columns:
        parts.append(servers)
    if "function_name" in records.columns:
        parts.append(F.array("function_name"))
    both = F.concat(*(F.coalesce(p, F.array().cast("array<string>")) for p in parts))
    return records.select(key, F.explode(both).alias("function_name")).where("function_name is not null").distinct()


def obfuscate(records: DataFrame, aliases: DataFrame, key: str = "uuid") -> DataFrame:
    """records with aliases for names; each record meets only the aliases of its own names, so no map is broadcast."""
    ship(records.sparkSession)
    own = names_used(records, key).join(aliases, "function_name").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("function_name", "alias"))).alias("_names"))
    both = records.join(own, key, "left")
    done = {"available_tools": fidelity.rename_tools("available_tools", "_names"), "messages": R.mask_messages("messages", "_names"), "target_tools": fidelity.rename_targets("target_tools", "_names")}
    if "metadata" in records.columns:
        done["metadata"] = R.mask_metadata("metadata", "_names")
    if "function_name" in records.columns:
        done["function_name"] = F.coalesce(F.element_at("_names", F.col("function_name")), "function_name")
    return both.withColumns(done).select(*records.columns)
