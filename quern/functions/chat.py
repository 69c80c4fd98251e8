"""Whole conversations in chat-template form: system and tool block, thinking, tool calls and their responses, media marks.

A conversation is one JSON document of any shape, so the printer is a plain function, applied to JSON text in Arrow batches; what
needs only roles and order (``prompts.previous_roles``, ``prompts.after_last_user``) is windows over turns."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.tools import call, declaration, response

# Marks of media parts.
MEDIA_MARKS = {"image": "<|image|>", "audio": "<|audio|>", "video": "<|video|>"}
SYSTEM_ROLES = ("system", "developer")


def outside_channels(text: str) -> str:
    """Text outside of thinking channels, stripped."""
    return "".join(part.split("<|channel>")[0] for part in text.split("<channel|>")).strip()


class _Turn:
    """What one message prints, and what it leaves open."""

    def __init__(self, message: dict, role: str):
        self.message, self.role = message, role
        self.last: str | None = None  # kind of the last special part
        self.answered = False  # tool responses were printed

    def text(self, t: str) -> str:
        return outside_channels(t) if self.role == "model" else t.strip()

    def content(self) -> str:
        c = self.message.get("content")
        if isinstance(c, str):
            return self.text(c)
        out = []
        for part in c or ():
            if part.get("type") == "text":
                out.append(self.text(part["text"]))
            elif part.get("type") in MEDIA_MARKS:
                out.append(MEDIA_MARKS[part["type"]])
                self.last = part["type"]
        return "".join(out)

    def responses(self, following: list[dict]) -> str:
        """Responses that the message holds itself, else those of the tool messages that follow its calls."""
        own = self.message.get("tool_responses")
        if own:
            out = [response(r.get("name", "unknown"), r.get("response")) for r in own]
        else:
            names = {c.get("id"): c["function"]["name"] for c in self.message.get("tool_calls") or ()}
            out = [_tool_message(m, names) for m in following] if names else []
        if out:
            self.answered, self.last = True, "tool_response"
        return "".join(out)


def _tool_message(message: dict, names: dict) -> str:
    name = names.get(message.get("tool_call_id"), message.get("name", "unknown"))
    body = message.get("content")
    if not isinstance(body, list):
        return response(name, body)
    texts = "".join(p.get("text", "") for p in body if p.get("type") == "text")
    return response(name, texts) + "".join(MEDIA_MARKS[p["type"]] for p in body if p.get("type") in MEDIA_MARKS)


def _head(first: dict | None, tools: list[dict], thinking: bool) -> str:
    system = first if first is not None and first.get("role") in SYSTEM_ROLES else None
    if not (thinking or tools or system):
        return ""
    out = ["<|turn>system\n", "<|think|>\n" if thinking else ""]
    if system is not None:
        c = system.get("content")
        out += [c.strip()] if isinstance(c, str) else [p["text"].strip() + " " for p in c or ()]
    out += [f"<|tool>{declaration(t).strip()}<tool|>" for t in tools]
    return "".join([*out, "<turn|>\n"])


def render(messages: list[dict], tools: list[dict] | None = None, bos: str = "<bos>", thinking: bool = False, generation_prompt: bool = False) -> str:
    """A conversation in chat-template form.

    Assistant messages are the model's; those that follow each other, tool messages between them aside, are one turn.  A message's reasoning is
    printed with its tool calls after the last user message only.  Tool messages are printed with the calls they answer.
    """
    out = [bos, _head(messages[0] if messages else None, tools or [], thinking)]
    last = "tool" if tools else None
    body = messages[1:] if messages and messages[0].get("role") in SYSTEM_ROLES else messages
    last_user = max((k for k, m in enumerate(body) if m.get("role") == "user"), default=-1)
    before: str | None = None  # role of the previous message that isn't a tool's
    for k, m in enumerate(body):
        if m.get("role") == "tool":
            continue
        turn = _Turn(m, "model" if m["role"] == "assistant" else m["role"])
        if not (turn.role == "model" and before == "assistant"):
            out.append(f"<|turn>{turn.role}\n")
        calls = m.get("tool_calls") or []
        reasoning = m.get("reasoning") or m.get("reasoning_content")
        if reasoning and calls and k > last_user:
            out.append(f"<|channel>thought\n{reasoning}\n<channel|>")
        if calls:
            out += [call(c["function"]) for c in calls]
            turn.last = "tool_call"
        end = next((j for j in range(k + 1, len(body)) if body[j].get("role") != "tool"), len(body))
        out.append(turn.responses(body[k + 1 : end]))
        content = turn.content()
        out.append(content)
        if turn.last == "tool_call" and not turn.answered:
            out.append("<|tool_response>")
        elif content.strip() or not turn.answered:
            out.append("<turn|>\n")
        before, last = m["role"], turn.last
    if generation_prompt and last not in ("tool_call", "tool_response"):
        out.append("<|turn>model\n")
    return "".join(out)


def rendered(messages: Column, tools: Column | None = None, **options) -> Column:
    """``render`` of JSON text columns; null for null messages."""

    def run(m: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else render(json.loads(a), json.loads(b) if b else None, **options) for a, b in zip(m, t)], dtype=object)

    return F.pandas_udf(run, "string")(messages, tools if tools is not None else F.lit(None).cast("string"))


def jsonable(value: object) -> object:
    """A JSON value without the keys that hold raw media, ``array`` and ``bytes``, at any depth."""
    if isinstance(value, dict):
        return {k: jsonable(v) for k, v in value.items() if k not in ("array", "bytes")}
    return [jsonable(v) for v in value] if isinstance(value, list) else value


def without_raw_media(json_text: Column) -> Column:
    """``jsonable`` of a JSON text column, as compact JSON text; null for null."""

    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else json.dumps(jsonable(json.loads(t)), ensure_ascii=False, separators=(",", ":")) for t in s], dtype=object)

    return F.pandas_udf(run, "string")(json_text)
