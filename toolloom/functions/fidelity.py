"""JSON text with exact key order, number and spacing rules, which Spark's own JSON functions don't keep.

Arrow-batched; null and undecodable input gives null.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def decode(text):
    try:
        return json.loads(text) if isinstance(text, str) else None
    except ValueError:
        return None


def arguments(text) -> dict | None:
    """A call's arguments; text that doesn't hold an object is none."""
    v = decode(text)
    return v if isinstance(v, dict) else None


def option_text(values: dict) -> str:
    return "; ".join(f"{k}={json.dumps(values[k], ensure_ascii=False)}" for k in sorted(values))


@pandas_udf(StringType())
def canonical(s: pd.Series) -> pd.Series:
    """Sorted keys, characters beyond ASCII as they are."""
    return s.map(lambda t: None if (v := decode(t)) is None else json.dumps(v, sort_keys=True, ensure_ascii=False))


@pandas_udf(StringType())
def pretty(s: pd.Series) -> pd.Series:
    """Indented by two with sorted keys; text that is no JSON stays."""
    return s.map(lambda t: t if (v := decode(t)) is None else json.dumps(v, sort_keys=True, ensure_ascii=False, indent=2))


@pandas_udf(StringType())
def indented(s: pd.Series) -> pd.Series:
    """Indented by two with keys in their order; text that is no JSON stays."""
    return s.map(lambda t: t if (v := decode(t)) is None else json.dumps(v, ensure_ascii=False, indent=2))


@pandas_udf(StringType())
def format_arguments(s: pd.Series) -> pd.Series:
    """`a=1; b="x"` with top-level keys in order."""
    return s.map(lambda t: None if (v := arguments(t)) is None else option_text(v))


def renamed_tools(text, names: dict):
    v = decode(text)
    if not isinstance(v, list):
        return text
    for x in v:
        f = x.get("function") if isinstance(x, dict) else None
        if isinstance(f, dict) and f.get("name") in names:
            f["name"] = names[f["name"]]
    return json.dumps(v, ensure_ascii=False)


def renamed_messages(text, names: dict):
    v = decode(text)
    if not isinstance(v, list):
        return text
    for m in v:
        if not isinstance(m, dict):
            continue
        for holder in (m, m.get("function_call")):
            if isinstance(holder, dict) and isinstance(holder.get("name"), str):
                holder["name"] = names.get(holder["name"], holder["name"])
    return json.dumps(v, ensure_ascii=False)


def renamed_targets(text, names: dict):
    v = decode(text)
    if isinstance(v, list):
        return json.dumps([names.get(x, x) if isinstance(x, str) else x for x in v], ensure_ascii=False)
    return names.get(text, text)


def _renamer(rule):
    @pandas_udf(StringType())
    def run(s: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([t if n is None else rule(t, dict(n)) for t, n in zip(s, names)], dtype=object)

    return run


rename_tools, rename_messages, rename_targets = map(_renamer, (renamed_tools, renamed_messages, renamed_targets))
