"""Queries and SQL of this package, for the driver's entry points."""

from __future__ import annotations

from importlib import import_module

_NAMES = {
    "op1_substring_dedup": "substring",
    "op2_decontaminate": "decontaminate",
    "op3_suffix_array_dedup": "suffix_array",
    "op4_token_files": "token_files",
    "op5_pack": "packing",
    "op6_language_id": "langid",
    "op7_chat_format": "chat",
    "op8_simhash": "simhash",
    "op9_quality_rules": "quality",
    "op10_line_dedup": "line_dedup",
}


def queries() -> dict:
    return {name: getattr(import_module(f"toolloom.llm.{module}"), name) for name, module in _NAMES.items()}


def oracle_sql() -> dict[str, str]:
    from toolloom.llm.oracle import SQL

    return dict(SQL)
