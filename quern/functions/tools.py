"""Tool declarations, calls and responses in chat-template form.

The values are JSON of any depth, which no Column expression can walk; the printers are plain functions, applied to JSON text in Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the mark around strings.
QUOTE = '<|"|>'
# Schema keywords, which aren't properties of an object that lists its properties directly.
KEYWORDS = frozenset({"description", "type", "properties", "required", "nullable"})


def quoted(s: object) -> str:
    return f"{QUOTE}{s}{QUOTE}"


def by_key(d: dict) -> list[tuple[str, object]]:
    return sorted(d.items(), key=lambda kv: str(kv[0]).lower())


def literal(v: object, quote_keys: bool = True) -> str:
    """A JSON value: strings in marks, keys sorted and in marks where asked."""
    if isinstance(v, str):
        return quoted(v)
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, dict):
        return "{" + ",".join(f"{quoted(k) if quote_keys else k}:{literal(x, quote_keys)}" for k, x in by_key(v)) + "}"
    if isinstance(v, list):
        return "[" + ",".join(literal(x, quote_keys) for x in v) + "]"
    return str(v)


def _names(items: list) -> str:
    return "[" + ",".join(map(quoted, items)) + "]"


def _item_field(key: str, v: object, items: dict) -> str:
    """One field of an array's item schema."""
    if key == "properties":
        return "properties:{" + (parameters(v) if isinstance(v, dict) else "") + "}"
    if key == "required":
        return "required:" + _names(v)
    if key == "type":
        return "type:" + literal(v.upper() if isinstance(v, str) else [str(x).upper() for x in v])
    return f"{key}:{literal(v)}"


def parameter(name: str, p: dict) -> str:
    """One parameter: description, then what its type adds, nullable, an object's parts, and the type last."""
    kind = str(p.get("type") or "").upper()
    parts = []
    if p.get("description"):
        parts.append("description:" + quoted(p["description"]))
    if kind == "STRING" and p.get("enum"):
        parts.append("enum:" + literal(p["enum"]))
    if kind == "ARRAY" and isinstance(p.get("items"), dict) and p["items"]:
        parts.append("items:{" + ",".join(_item_field(k, v, p["items"]) for k, v in by_key(p["items"]) if v is not None) + "}")
    if p.get("nullable"):
        parts.append("nullable:true")
    if kind == "OBJECT":
        inner = p["properties"] if isinstance(p.get("properties"), dict) else {k: v for k, v in p.items() if k not in KEYWORDS}
        parts.append("properties:{" + parameters(inner) + "}")
        if p.get("required"):
            parts.append("required:" + _names(p["required"]))
    return f"{name}:{{" + ",".join([*parts, "type:" + quoted(kind)]) + "}"


def parameters(properties: dict) -> str:
    return ",".join(parameter(k, v) for k, v in by_key(properties))


def declaration(tool: dict) -> str:
    """A tool's declaration."""
    f = tool["function"]
    out = f"declaration:{f['name']}{{description:{quoted(f['description'])}"
    if p := f.get("parameters"):
        out += ",parameters:{"
        if p.get("properties"):
            out += "properties:{" + parameters(p["properties"]) + "},"
        if p.get("required"):
            out += "required:" + _names(p["required"]) + ","
        if p.get("type"):
            out += "type:" + quoted(p["type"].upper()) + "}"
    if "response" in f:
        r = f["response"]
        out += ",response:{"
        if r.get("description"):
            out += "description:" + quoted(r["description"]) + ","
        if str(r.get("type") or "").upper() == "OBJECT":
            out += "type:" + quoted("OBJECT") + "}"
    return out + "}"


def call(function: dict) -> str:
    """A tool call; arguments are an object, or text that is taken as it is."""
    a = function.get("arguments")
    inner = ",".join(f"{k}:{literal(v, False)}" for k, v in by_key(a)) if isinstance(a, dict) else a if isinstance(a, str) else ""
    return f"<|tool_call>call:{function['name']}{{{inner}}}<tool_call|>"


def response(name: str, value: object) -> str:
    """A tool's response; what isn't an object is its ``value``."""
    fields = value if isinstance(value, dict) else {"value": value}
    return f"<|tool_response>response:{name}{{" + ",".join(f"{k}:{literal(v, False)}" for k, v in by_key(fields)) + "}<tool_response|>"


def printed(printer: Callable[[object], str], json_text: Column) -> Column:
    """``printer`` applied to JSON text; null for null."""

    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else printer(json.loads(t)) for t in s], dtype=object)

    return F.pandas_udf(run, "string")(json_text)


def responses(calls: DataFrame, results: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """(conversation, turn, rendered): tool results (conversation, turn, tool_call_id, name, content JSON) under the name of the call
    (conversation, id, name) they answer, else under their own name, else ``unknown``."""
    named = calls.groupBy(conversation, F.col("id").alias("tool_call_id")).agg(F.max("name").alias("_called"))
    j = results.join(named, [conversation, "tool_call_id"], "left")
    name = F.coalesce("_called", "name", F.lit("unknown"))
    whole = F.concat(F.lit('{"n":'), F.to_json(F.struct(name.alias("x"))), F.lit(',"v":'), F.coalesce("content", F.lit("null")), F.lit("}"))
    return j.select(conversation, "turn", printed(lambda d: response(d["n"]["x"], d["v"]), whole).alias("rendered"))
