"""Rules on whole trajectory records whose JSON text must keep its key order, spacing and numbers.

Spark's JSON functions re-order and re-format, so these rules are plain Python on decoded values, called
in Arrow batches.  Each takes and gives text; text that doesn't decode is passed through by rule.
"""

from __future__ import annotations

import json
import textwrap
from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from toolloom.functions import fidelity

# The marks around a tool declaration in a system prompt, and the line before an answer that follows a call.
DECLARE, MIDDLE, END = "<|im_system|>", "<|im_middle|>", "<|im_end|>"
ANSWER_MARK = "[[原文回答]]"
MODES = ("available", "params", "param_values")


def like_json(value):
    """A decoded value, empty text for blank text, and text that is no JSON as it is."""
    if not isinstance(value, str):
        return value
    trimmed = value.strip()
    if not trimmed:
        return ""
    try:
        return json.loads(trimmed)
    except ValueError:
        return value


def block(value) -> str:
    """Lists and objects indented by two with sorted keys; others as text."""
    return json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) if isinstance(value, dict | list) else str(value)


def yaml_text(value, depth: int = 0) -> str:
    """Block YAML with keys in their order, for values made of objects, lists, texts, numbers, booleans and null."""
    try:
        import yaml
    except ImportError:
        return block(value)
    return yaml.safe_dump(value, sort_keys=False, allow_unicode=True).strip()


# --- declarations in system prompts


def declaration_bounds(content: str) -> tuple[int, int] | None:
    """Where the text between the marks begins and ends."""
    at = content.find(MIDDLE)
    if at < 0:
        return None
    begin = at + len(MIDDLE)
    end = content.find(END, begin)
    return (begin, end) if end >= 0 else None


def declared_tools(content: str) -> str:
    """A system prompt for readers: the list of its declaration as YAML; without one the trimmed text."""
    bounds = declaration_bounds(content) if DECLARE in content else None
    if bounds is None:
        return content.strip()
    raw = content[slice(*bounds)].strip()
    try:
        shown = raw.encode().decode("unicode_escape")
    except UnicodeDecodeError:
        shown = raw
    inner = shown[shown.find("[") : shown.rfind("]") + 1] if "[" in shown and "]" in shown else ""
    try:
        return yaml_text(json.loads(inner))
    except ValueError:
        return shown.strip()


def masked_declaration(content: str, names: Mapping[str, str]) -> str:
    """Aliases for the tools of a declaration that is a JSON list; else, or if no name changes, the text as it is."""
    bounds = declaration_bounds(content)
    tools = fidelity.decode(content[slice(*bounds)]) if bounds else None
    if not isinstance(tools, list):
        return content
    functions = [f for t in tools if isinstance(t, dict) and isinstance(f := t.get("function"), dict) and f.get("name")]
    changed = [f for f in functions if names.get(f["name"], f["name"]) != f["name"]]
    for f in changed:
        f["name"] = names[f["name"]]
    return content[: bounds[0]] + json.dumps(tools, ensure_ascii=False) + content[bounds[1] :] if changed else content


def masked_metadata(text: str | None, names: Mapping[str, str]) -> str | None:
    """Aliases for the tools that servers named in the metadata list."""
    value = fidelity.decode(text)
    if not isinstance(value, dict):
        return text
    for server in value.get("mcp_servers") or []:
        answer = server.get("remote_server_response") if isinstance(server, dict) else None
        tools = answer.get("tools") if isinstance(answer, dict) else None
        for tool in tools if isinstance(tools, list) else []:
            if isinstance(tool, dict) and isinstance(tool.get("name"), str):
                tool["name"] = names.get(tool["name"], tool["name"])
    return json.dumps(value, ensure_ascii=False)


def masked_messages(text: str | None, names: Mapping[str, str]) -> str | None:
    """Aliases in names, calls and the declarations of system prompts."""
    value = fidelity.decode(fidelity.renamed_messages(text, names))
    if not isinstance(value, list):
        return text
    for m in value:
        if isinstance(m, dict) and m.get("role") == "system" and isinstance(m.get("content"), str):
            m["content"] = masked_declaration(m["content"], names)
    return json.dumps(value, ensure_ascii=False)


def metadata_names(text: str | None) -> list[str]:
    """Names of the tools that the metadata's servers list, in order."""
    value = fidelity.decode(text)
    servers = value.get("mcp_servers") if isinstance(value, dict) else None
    out = []
    for server in servers if isinstance(servers, list) else []:
        answer = server.get("remote_server_response") if isinstance(server, dict) else None
        tools = answer.get("tools") if isinstance(answer, dict) else None
        out += [t["name"] for t in tools if isinstance(t, dict) and t.get("name")] if isinstance(tools, list) else []
    return out


# --- schemas


def parameters_of(definition: str | None) -> dict:
    """The parameter schema of a definition: under `function`, or beside it."""
    value = fidelity.decode(definition)
    if not isinstance(value, dict):
        return {}
    own = (value.get("function") or {}).get("parameters") if isinstance(value.get("function"), dict) else None
    found = own or value.get("parameters") or {}
    return found if isinstance(found, dict) else {}


def schema_summary(definition: str | None, limit: int = 1600) -> str:
    """A line for each property with its type, whether it is required, and its description; cut once over the limit."""
    schema = parameters_of(definition)
    properties, required = schema.get("properties"), schema.get("required") or []
    if not isinstance(properties, dict) or not properties:
        return cut_text(json.dumps(schema, ensure_ascii=False), limit)
    out: list[str] = []
    for name, p in properties.items():
        p = p if isinstance(p, dict) else {}
        need = " [required]" if name in required else ""
        about = f": {p['description']}" if p.get("description") else ""
        out.append(f"- {name} ({p.get('type', 'any')}){need}{about}")
        if limit > 0 and sum(map(len, out)) + len(out) - 1 > limit:
            break
    return cut_text("\n".join(out), limit)


def cut_text(text: str, limit: int) -> str:
    return text if limit <= 0 or len(text) <= limit else text[: max(limit - 3, 0)] + "..."


# --- records as text


def indent(text: str, by: int) -> str:
    return textwrap.indent(text, " " * by)


def tool_blocks(available: str | None) -> list[str]:
    """A bullet for each tool with its description and parameters."""
    tools = like_json(available)
    out = []
    for t in tools if isinstance(tools, list) else []:
        f = t.get("function") if isinstance(t, dict) else None
        if isinstance(f, dict):
            about, schema = (f.get("description") or "").strip(), f.get("parameters")
            rows = [f"- {f.get('name', 'unknown')}", indent(about, 4) if about else None, indent("Parameters:", 4) if schema else None, indent(block(schema), 6) if schema else None]
            out.append(indent("\n".join(r for r in rows if r is not None), 2))
    return out


def letter(k: int) -> str:
    return chr(65 + k) if k < 26 else f"Option{k + 1}"


def question_lines(q: Mapping, reveal: bool, show_function: bool) -> str:
    name = f"|function={q['function_name']}" if show_function and q.get("function_name") else ""
    options = q.get("options") if q.get("options") is not None else []
    shown = "\n".join(f"{letter(k)}. {o}" for k, o in enumerate(options if isinstance(options, list) else [options]))
    rows = [f"[MCQ:{q.get('mode')}|msg={q.get('message_index')}{name}]", "Question:", indent(q.get("question") or "", 2), "Options:", indent(shown, 2)]
    return "\n".join([*rows, f"Answer: the answer is {q['answer']}"] if reveal and q.get("answer") else rows)


def call_text(call: Mapping) -> str:
    held = call.get("arguments")
    own = held if isinstance(held, dict) else fidelity.arguments(held)
    return block(own or held)


def message_lines(messages: list, questions: Mapping[int, list], reveal: bool, show_function: bool):
    """Parts of the message section: questions stand before the call they ask about."""
    waiting = False
    for k, m in enumerate(messages):
        role, call, content = m.get("role", "unknown"), m.get("function_call"), m.get("content", "")
        if call:
            yield from (indent(question_lines(q, reveal, show_function), 4) for q in questions.get(k, []))
            yield indent(f"assistant (function_call: {call.get('name', 'unknown')}) @msg={k}:", 2)
            yield indent(call_text(call), 4)
            waiting = True
        elif role == "function":
            yield indent(f"function[{m.get('name', 'function')}] @msg={k}:", 2)
            yield indent(block(like_json(m.get("content"))), 4)
        else:
            if waiting and role == "assistant" and content:
                yield indent(ANSWER_MARK, 2)
                waiting = False
            declares = role == "system" and isinstance(content, str) and DECLARE in content
            yield indent(f"{role} (tool_declare):" if declares else f"{role}:", 2)
            shown = block(content) if not isinstance(content, str) else declared_tools(content) if role == "system" else content.strip()
            yield indent(shown, 4)


def record_text(record: Mapping, questions: Mapping[int, list] = {}, reveal: bool = False, show_function: bool = False) -> str:
    """One record with its questions as text.  questions: message index -> questions in the order of modes and of their lines."""
    parts = [f"=== Record | uuid={record.get('uuid') or record.get('record_uuid') or 'unknown'} ==="]

    def section(title: str, lines: list[str]) -> None:
        parts.extend([title, *lines])

    if asked := (record.get("question") or "").strip():
        section("Question:", [indent(asked, 2)])
    if tools := tool_blocks(record.get("available_tools")):
        section("Available tools:", tools)
    messages = like_json(record.get("messages"))
    section("Messages:", list(message_lines(messages if isinstance(messages, list) else [], questions, reveal, show_function)))
    if targets := record.get("target_tools"):
        section("Target tools:", [indent(yaml_text(targets) if isinstance(targets, dict | list) else str(targets), 2)])
    for title, field in (("Question quality assessment:", "question_quality_assessment"), ("Response quality assessment:", "response_quality_assessment"), ("Metadata:", "metadata")):
        if record.get(field):
            section(title, [indent(block(like_json(record[field])), 2)])
    return "\n".join(parts).strip() + "\n"


def pretty_text(record: Mapping, aliases: Mapping[str, str] = {}) -> str:
    """A record for readers, with `alias (original)` for the names of a map from aliases to originals."""
    name = lambda x: f"{x} ({aliases[x]})" if x in aliases else str(x)
    parts = [f"=== {record.get('uuid') or 'unknown'} ==="]
    if record.get("question"):
        parts += ["Question:", indent(str(record["question"]).strip(), 2)]
    tools = like_json(record.get("available_tools"))
    names = [f["name"] for t in (tools if isinstance(tools, list) else []) if isinstance(t, dict) and isinstance(f := t.get("function"), dict) and f.get("name")]
    if names:
        parts += [f"Available tools ({len(names)}):", *(indent(f"- {name(x)}", 2) for x in names)]
    messages = like_json(record.get("messages"))
    for k, m in enumerate(messages if isinstance(messages, list) else []):
        call, role = m.get("function_call"), m.get("role", "unknown")
        who = f"{role} [{name(m['name'])}]" if m.get("name") else role
        parts.append(f"[{k}] {who}:")
        content = m.get("content")
        if content not in (None, ""):
            parts.append(indent(declared_tools(content) if role == "system" and isinstance(content, str) else block(like_json(content)), 4))
        if call:
            parts += [indent(f"call {name(call.get('name', 'unknown'))}:", 4), indent(call_text(call), 6)]
    return "\n".join(parts) + "\n"


# --- as columns


def column(rule: Callable[[str | None], str | None]):
    """A rule on one text as an Arrow-batched column function."""

    @pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([rule(t) for t in s], index=s.index, dtype=object)

    return run


def summary(limit: int = 1600):
    return column(lambda t: schema_summary(t, limit))


tool_section = column(lambda t: "\n".join(tool_blocks(t)))
declaration = column(lambda t: None if t is None else declared_tools(t))
mask_metadata, mask_messages = map(fidelity._renamer, (masked_metadata, masked_messages))
