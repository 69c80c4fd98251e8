"""Text and record-field expressions.  All are Columns, so they stay inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space of the record format, as a character class that Java and RE2 share.
WS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"

# Field names that are probed in this order.
PROMPT_FIELDS = ("prompt", "instruction", "question", "query", "input", "user", "title")
CONTEXT_FIELDS = ("context", "document", "passage", "article", "text", "content", "body", "code")
MESSAGE_FIELDS = ("messages", "conversation", "conversations", "dialogue", "turns")
MESSAGE_TEXT_FIELDS = ("content", "value", "text", "message")
MESSAGE_ROLE_FIELDS = ("role", "from", "speaker")
USER_ROLES = ("user", "human", "prompter", "client")
# Source roles whose rows are context only.
CONTEXT_ROLES = ("plain_text_corpus", "code_context_stream", "math_science_context_stream")
CONTEXT_ROLE_SUFFIX = "_warmup_or_context_seed"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without white space at either end, Unicode white space included."""
    return F.regexp_replace(_c(x), f"^{WS}+|{WS}+$", "")


def squeeze(x: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.btrim(F.regexp_replace(_c(x), f"{WS}+", " "))


def clean_text(x: Column | str, max_chars: int = 12_000) -> Column:
    """Squeezed text of at most ``max_chars`` code points, cut before the word that would cross the limit; a null is ''.

    A cut drops everything after the last blank, even where it fell on a word's end; without a blank it is a hard cut."""
    s = F.coalesce(squeeze(x), F.lit(""))
    return F.when(F.char_length(s) <= max_chars, s).otherwise(F.btrim(F.regexp_replace(F.substring(s, 1, max_chars), r" [^ ]*$", "")))


def as_text(v: Column | str) -> Column:
    """Text of a VARIANT: null is '', strings are stripped, numbers and booleans written out (True, False), lists and objects ''."""
    v = _c(v)
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(v.isNull() | F.is_variant_null(v), "").when(kind == "STRING", strip(text)).when(kind == "BOOLEAN", F.initcap(text))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), "").otherwise(F.coalesce(text, F.lit("")))
    )


def first_text(*fields: Column | str) -> Column:
    """The first field that isn't blank, stripped; '' if there is none."""
    return F.coalesce(*[F.nullif(strip(f), F.lit("")) for f in fields], F.lit(""))


def slug(x: Column | str) -> Column:
    """Name for a file: everything but letters, digits, dot, dash and underscore becomes one underscore."""
    return F.regexp_replace(_c(x), r"[^A-Za-z0-9_.-]+", "_")


def estimate_tokens(x: Column | str) -> Column:
    """max(1, UTF-8 bytes div 4); a null counts as empty."""
    return F.greatest(F.lit(1), F.shiftright(F.coalesce(F.octet_length(_c(x)), F.lit(0)), 2))


def build_prompt(prompt: Column | str, context: Column | str, strict: bool = True) -> Column:
    """Context, blank line, prompt; either alone; with neither an error, or null where not ``strict``."""
    p, c = F.nullif(strip(prompt), F.lit("")), F.nullif(strip(context), F.lit(""))
    none = F.raise_error(F.lit("record has neither prompt nor context")).cast("string") if strict else F.lit(None).cast("string")
    return F.when(p.isNotNull() | c.isNotNull(), F.concat_ws("\n\n", c, p)).otherwise(none)


def prefix_text(prompt: Column | str, context: Column | str, dedupe_context: bool = False) -> Column:
    """What precedes the target: as ``build_prompt``, the prompt alone where it equals the context; may be ''.

    ``dedupe_context`` also leaves a context out that the prompt already starts with."""
    p, c = F.coalesce(strip(prompt), F.lit("")), F.coalesce(strip(context), F.lit(""))
    same = (p == c) | (F.startswith(p, c) if dedupe_context else F.lit(False))
    return F.when((c == "") | same, p).when(p == "", c).otherwise(F.concat_ws("\n\n", c, p))


def is_context_role(role: Column | str) -> Column:
    r = F.coalesce(_c(role), F.lit(""))
    return r.isin(*CONTEXT_ROLES) | r.endswith(CONTEXT_ROLE_SUFFIX)


def env_key(x: Column | str, prefix: str = "DG_") -> Column:
    return F.concat(F.lit(prefix), F.upper(_c(x)))


def as_list(x: Column | str) -> Column:
    """A scalar as a list of one; null as an empty list."""
    x = _c(x)
    return F.when(x.isNull(), F.array()).otherwise(F.array(x))


def media_values(media: Column | str, *keys: str) -> Column:
    """Concatenated lists under ``keys`` of a map<string, array<string>>, without nulls and ''."""
    lists = [F.coalesce(F.try_element_at(_c(media), F.lit(k)), F.array().cast("array<string>")) for k in keys]
    return F.filter(F.concat(*lists), lambda x: x.isNotNull() & (x != ""))


# File endings and their media types.
MIME = {
    "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "webp": "image/webp", "bmp": "image/bmp", "svg": "image/svg+xml",
    "wav": "audio/x-wav", "mp3": "audio/mpeg", "flac": "audio/flac", "ogg": "audio/ogg", "m4a": "audio/mp4", "mp4": "video/mp4", "pdf": "application/pdf", "txt": "text/plain", "json": "application/json",
}


def mime_type(path: Column | str) -> Column:
    ending = F.lower(F.regexp_extract(_c(path), r"\.([A-Za-z0-9]+)$", 1))
    return F.coalesce(reduce(lambda e, kv: e.when(ending == kv[0], kv[1]), MIME.items(), F.when(F.lit(False), "")), F.lit("application/octet-stream"))


def media_url(path: Column | str, content: Column | None = None) -> Column:
    """URL of a media value: http, https, data and file URLs as they are; a path as data URL of ``content`` where given, else as file URL."""
    p = _c(path)
    file = F.concat(F.lit("file://"), F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p)))
    local = file if content is None else F.coalesce(F.concat(F.lit("data:"), mime_type(p), F.lit(";base64,"), F.base64(content)), file)
    return F.when(p.rlike(r"^(?:https?|data|file):"), p).otherwise(local)


def chat_content(prompt: Column | str, media: Column | str) -> Column:
    """Parts of a chat message as array<struct<type, value>>: the text, then images, then audio; without media just the text."""
    part = lambda kind: lambda v: F.struct(F.lit(kind).alias("type"), media_url(v).alias("value"))
    text = F.array(F.struct(F.lit("text").alias("type"), _c(prompt).alias("value")))
    return F.concat(text, F.transform(media_values(media, "images", "image"), part("image_url")), F.transform(media_values(media, "audio"), part("audio_url")))


def strip_thinking(x: Column | str) -> Column:
    """Text outside of thinking channels: between '<channel|>' marks, what precedes a '<|channel>' mark; stripped."""
    parts = F.split(_c(x), r"<channel\|>")
    return strip(F.array_join(F.transform(parts, lambda p: F.substring_index(p, "<|channel>", 1)), ""))


def parse_response(x: Column | str) -> Column:
    """struct<thinking, content>: what a thinking channel holds ('' without one) and the text outside."""
    return F.struct(strip(F.regexp_extract(_c(x), r"(?s)<\|channel>(.*?)<channel\|>", 1)).alias("thinking"), strip_thinking(x).alias("content"))


def parse_tool_calls(x: Column | str) -> Column:
    """array<struct<name, arguments>> of the tool calls in a response, arguments as they are written; calls of another form are left out."""
    calls = F.regexp_extract_all(_c(x), F.lit(r"(?s)<\|tool_call>(.*?)<tool_call\|>"), F.lit(1))
    whole = F.filter(calls, lambda c: c.rlike(r"(?s)call:\w+\{.*\}"))
    part = lambda c, k: F.regexp_extract(c, r"(?s)call:(\w+)(\{.*\})", k)
    return F.transform(whole, lambda c: F.struct(part(c, 1).alias("name"), part(c, 2).alias("arguments")))


def response_parts(x: Column | str) -> Column:
    """struct<thinking, tool_calls, content>: the thought, the calls, and what follows them up to the end of the turn or a tool's response."""
    rest = F.regexp_replace(F.regexp_replace(_c(x), r"(?s)<\|channel>thought\n.*?<channel\|>", ""), r"(?s)<\|tool_call>.*<tool_call\|>", "")
    thought = F.regexp_extract(_c(x), r"(?s)<\|channel>thought\n(.*?)<channel\|>", 1)
    return F.struct(thought.alias("thinking"), parse_tool_calls(x).alias("tool_calls"), F.regexp_extract(rest, r"(?s)^(.*?)(?:<turn\|>|<\|tool_response>|$)", 1).alias("content"))


def render_turn(role: Column | str, text: Column | str) -> Column:
    """One turn in chat-template form; the assistant is called model."""
    r = F.lower(_c(role))
    return F.concat(F.lit("<|turn>"), F.when(r == "assistant", "model").otherwise(r), F.lit("\n"), strip(text), F.lit("<turn|>\n"))


def message_text(m: Column) -> Column:
    """Text of a message struct with the fields of MESSAGE_TEXT_FIELDS."""
    return first_text(*[m[f] for f in MESSAGE_TEXT_FIELDS])


def message_role(m: Column) -> Column:
    return F.lower(first_text(*[m[f] for f in MESSAGE_ROLE_FIELDS]))
