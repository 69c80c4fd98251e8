"""Terminal contexts: does a text stop before its content is complete?

``context`` names how a value ends: what kind of text it is, what is still open, and what stands last.  What a context says is fitted
(``fit``): on all values, the log-odds of each context among the values cut at random places, with and without a mark, against
the values as they come.  The share of cut values follows from the contexts that leave something open.  A context that the values
hardly show is judged by its class.
"""

from __future__ import annotations

import ast
import json
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.lexicon import CUT_MARK, FUNCTION_WORDS

#: First character of a context's name: something is open, nothing can be said, it looks whole, it is surely whole; log-odds without values.
CLASSES = {"+": 3.0, "?": 0.0, "-": -2.5, "=": -6.0}
STRENGTH = 8.0  # values that a class is worth
CUTS = 2  # cuts made of each value
LIKELY = -1.0  # log-odds from which a value counts as cut: real cuts don't fall just where the simulated ones do
SHARE = 0.05  # share of cut values without values to fit

_BULLET = re.compile(r"^\s*(?:[-*•–+]|\d{1,3}[.)])\s+\S")
_TERMINAL = re.compile(r"[.!?。！？；]['\"»”’)\]*_`>]*$")
_URL = re.compile(r"^\W*(?:https?://|www\.)\S+$")
_TAGS = re.compile(r"^(?:#\w[\w-]*\s*)+$")
_SIGNED = re.compile(r"^(?:—|–|--)\s*\S")
_PAREN_LINE = re.compile(r"^\([^()]*\)$")
_HTML = re.compile(r"<(/?)(ul|ol|li|p|div|table|thead|tbody|tr|td|th|a|b|i|em|strong|h[1-6]|span|section|article|blockquote|pre|code|body|html)\b[^<>]*?(/?)>", re.I)
_HTML_LEFT = re.compile(r"<[a-zA-Z/!][^<>]*$|&#?\w{0,8}$")
_CODE_LINE = re.compile(
    r"^\s*(?:#\s|def |class |return\b|for .* in |while |if |elif |else:|try:|except\b|with |assert |import |from \w+ import|print\(|raise |"
    r"[\w.\[\]\"', ]+ [-+*/]?= \S|[\w.]+\(|[\w.]+\[|\}|\)|\])"
)
_LEAD = re.compile(r"^[\s\ufeff\u200b]*(?:(?:a|q|answer|response|assistant|output)\s*:)?[\s\ufeff\u200b]*", re.I)
_SPACE = re.compile(r"[^\S\n]")
_IDENT = re.compile(r"[^\W\d]\w*")
_INVISIBLE = "﻿​‌‍⁠­\x00"
_FUNCTION = frozenset(w for v in FUNCTION_WORDS.values() for w in v.split())
_SENTENCE = re.compile(r"[.!?。！？](?:\s|$|['\"»”’)])")


def _balance(s: str) -> int:
    """Brackets still open at the end, outside of quoted strings on one line."""
    depth, quote = 0, ""
    for c in s:
        if quote:
            if c == quote or c == "\n":
                quote = ""
        elif c in "\"'":
            quote = c
        elif c in "([{":
            depth += 1
        elif c in ")]}":
            depth -= 1
    return depth + bool(quote)


def _code(s: str, lines: list[str]) -> str:
    last = lines[-1].strip()
    if last.startswith("#"):
        return "=comment" if _TERMINAL.search(last) and not re.search(r"\s\d+\.$", last) else "+comment"
    if _balance(s) > 0 or last.endswith((":", ",", "=", "+", "-", "*", "/", ".", "(", "[", "{", "\\", "_")):
        return "+code"
    try:
        tree = ast.parse(s.lstrip("\n"))
    except SyntaxError as e:
        return "+syntax" if (e.lineno or 0) >= len(lines) else "-syntax"
    except (ValueError, RecursionError, MemoryError):
        return "?code"
    node = tree.body[-1] if tree.body else None
    while node is not None and getattr(node, "body", None) and isinstance(node.body, list):
        node = ([*node.body, *getattr(node, "orelse", []), *(x for h in getattr(node, "handlers", []) for x in h.body)])[-1]
    if isinstance(node, ast.Expr) and isinstance(node.value, (ast.Name, ast.Attribute, ast.Subscript, ast.Constant)):
        return "+expression"
    if isinstance(node, ast.Return) and node.value is None or isinstance(node, ast.Assert) and not isinstance(node.test, ast.Compare):
        return "+statement"
    names = _IDENT.findall(last)
    if names and last.endswith(names[-1]):
        before = set(_IDENT.findall(s[: len(s.rstrip()) - len(names[-1])]))
        if names[-1] in before:
            return "=known name"
        if any(b.startswith(names[-1]) for b in before):
            return "+part of a name"
        return "-new name"
    return "-digit" if last[-1].isdigit() else "=statement"


def context(value: str) -> str:
    """The name of the terminal context; an empty value is whole."""
    s = value.rstrip().rstrip(_INVISIBLE).rstrip()
    tail = value[len(s):]
    hard = "\x00" in tail
    t = s.rstrip("�")
    if len(t) < len(s):
        hard, s = True, t.rstrip()
    if not s:
        return "=nothing"
    m = CUT_MARK.search(s)
    if m and m.start() > 3:
        return "+mark"
    lines = [x for x in s.split("\n") if x.strip()]
    last = lines[-1].strip()
    if hard and not _TERMINAL.search(last):
        return "+broken character"
    bare = _LEAD.sub("", s)
    if bare[:1] in ("{", "[") and (":" in s or "," in s):
        try:
            json.loads(_SPACE.sub(" ", bare))
            return "=json"
        except ValueError:
            if _balance(bare) > 0:
                return "+json"
    if s.count("```") % 2:
        return "+fence"
    if last.endswith("```"):
        return "=fence"
    if "<" in s:
        if _HTML_LEFT.search(s):
            return "+tag"
        depth = 0
        for close, _, alone in _HTML.findall(s):
            depth += 0 if alone else (-1 if close else 1)
        if depth > 0:
            return "+element"
        if s.endswith(">") and _HTML.search(last):
            return "=element"
    plain = last[2:].strip() if last[:2] in ("> ", "# ") else last
    if len(lines) > 1 or last.startswith("#") or "=" in s or "(" in s:
        n = sum(1 for x in lines if _CODE_LINE.match(x) and not _BULLET.match(x))
        prose = sum(1 for x in lines if len(x) > 30 and _TERMINAL.search(x) and not x.lstrip().startswith("#"))
        if n * 2 >= len(lines) and prose == 0 and ("=" in s or "(" in s or "def " in s or "class " in s or "print" in s or ":" in s):
            return _code(s, lines)
    if last.count("(") > last.count(")") or s.count("«") > s.count("»") or s.count("“") > s.count("”"):
        return "+bracket"
    if _URL.match(last.split()[-1] if last.split() else "") and (len(lines) > 1 and len(last.split()) == 1):
        return "-address part" if re.search(r"(?:/|\.\w{0,3}|=|\?|://\S{0,6})$", last) and not last.endswith(("/", ".html", ".htm")) else "-address"
    if _TAGS.match(last) or _PAREN_LINE.match(last):
        return "-tags"
    if len(lines) > 1 and _SIGNED.match(last):
        return "-signature" if len(last.split()) >= 3 else "?signature"
    if len(lines) > 1 and _BULLET.match(last):
        items = [x.strip() for x in lines[:-1] if _BULLET.match(x)]
        if items:
            closed = sum(x.endswith(")") for x in items)
            if last.endswith(")"):
                return "=item"
            if closed == len(items):
                return "+item in brackets"
            dotted = sum(bool(_TERMINAL.search(x)) for x in items)
            if dotted == len(items) and not _TERMINAL.search(last):
                return "+item sentence"
            return "-item" if not last.endswith((",", "-", "(")) else "+item"
        return "=first item" if last.endswith(")") or _TERMINAL.search(last) else "-first item"
    if "|" in last and sum("|" in x for x in lines) >= 2:
        return "=row" if last.endswith("|") else "+row"
    if _TERMINAL.search(plain):
        if re.search(r"(?:^|\s)\d+\.$", plain) and not re.search(r"\b(?:No|Nr|N°|№|nº|n\.º|Núm|Ref|ID|p|S)\.? ?\d+\.$", plain):
            return "+number"
        if len(plain) > 60 and last.count('"') % 2 and (s.count('"') % 2):
            return "?quotation"
        return "=stop"
    if plain.endswith((",", ";", ":", "-", "–", "—", "(", "/", "&", "«", "“", "„", "¿", "¡", "，", "、", "：")):
        return "+comma" if len(s) > 12 else "?comma"
    sentences = len(_SENTENCE.findall(s))
    words = len(plain.split())
    han = sum("㐀" <= c <= "鿿" for c in plain)
    if sentences == 0 and len(lines) == 1:
        # a bare phrase, name or number, unless it runs on like a sentence
        if han > 10 or words > 9:
            return "?long phrase" if words > 25 and "," not in plain else "+phrase"
        return "-short phrase" if words <= 5 and han <= 8 else "?phrase"
    if sentences == 0:
        return "?line" if words < 12 and han < 12 else "+line"
    if plain.endswith(("\"", "»", "”", "*", "_", "`", ")")):
        return "?closing" if words > 4 else "-closing"
    if len(lines) > 1 and words <= 5 and all(w[0].isupper() or w[0].isdigit() and w.lower() not in _FUNCTION for w in re.findall(r"\w+", plain)) and words > 1:
        return "?name"
    return "+sentence"


# Marks that a transfer leaves where it breaks off.
_LEFT = ("…", "...", " [...]", " [truncated]", "\x00", "\ufffd")
_STRUCTURE = re.compile(r"<[^<>\n]{2,}>|```.*?```|\([^()\n]{3,}\)|\"[^\"\n]{3,}\"|«[^»\n]{3,}»|https?://\S+", re.S)


def cut_somewhere(value: str, rnd: random.Random) -> str | None:
    """``value`` cut inside a word, sentence or structure: anywhere, or as often inside one of its structures; None where no such place was found."""
    inside = list(_STRUCTURE.finditer(value))
    for _ in range(6):
        if inside and rnd.random() < 0.5:
            m = rnd.choice(inside)
            k = rnd.randrange(m.start() + 1, m.end())
        else:
            k = rnd.randrange(8, len(value)) if len(value) > 8 else 0
        head = value[:k]
        if k < 8 or not value[k:].strip() or _TERMINAL.search(head.rstrip()):
            continue
        return head + rnd.choice(_LEFT) if rnd.random() < 0.15 else head
    return None


# The kind of text that a context belongs to, by its name; all others are prose.
KINDS = {
    "markup": ("tag", "element"), "json": ("json",), "fence": ("fence",), "table": ("row",), "list": ("item", "first item", "item in brackets", "item sentence"),
    "code": ("comment", "code", "syntax", "expression", "statement", "known name", "part of a name", "new name", "digit"),
}
_KIND = {n: k for k, names in KINDS.items() for n in names}


def kind(context: str) -> str:
    return _KIND.get(context[1:], "prose")


@dataclass(frozen=True)
class Model:
    """Log-odds of terminal contexts, and the share of cut values, among values of one kind."""

    odds: dict[str, float] = field(default_factory=dict)
    shares: dict[str, float] = field(default_factory=dict)

    def evidence(self, value: str) -> tuple[float, float]:
        """Log of how much more often the value's terminal context occurs among cut values than among values as they come, and the share of cut values."""
        c = context(value)
        return self.odds.get(c, CLASSES[c[0]]), self.shares.get(kind(c), SHARE)

    def likely(self, value: str) -> bool:
        """Whether the ending alone makes a cut likely."""
        odds, share = self.evidence(value)
        return odds + math.log(share) >= LIKELY


def model(come: Counter, cut: Counter) -> Model:
    """The model of the counts of contexts among values as they come and among cut ones."""
    odds, shares = {}, {}
    for k in {kind(c) for c in come.keys() | cut.keys()}:
        of = [c for c in come.keys() | cut.keys() if kind(c) == k]
        n, m = sum(come[c] for c in of), sum(cut[c] for c in of)
        scale = n / m if n and m else 1.0
        for c in of:
            p = 1 / (1 + math.exp(-CLASSES[c[0]]))
            odds[c] = math.log((cut[c] * scale + STRENGTH * p) / (come[c] + STRENGTH * (1 - p)))
        left_open = [sum(x[c] for c in of if c[0] == "+") for x in (come, cut)]
        shares[k] = min(0.5, max(0.001, (left_open[0] + STRENGTH * SHARE) / (left_open[1] * scale + STRENGTH)))
    return Model(odds, shares)


def fit(values: DataFrame, sample: int | None = None) -> Model:
    """The model of ``values`` (key string, value string): every value is counted as it comes and cut ``CUTS`` times, where it is read; only the
    counts of the contexts are shuffled and reach the driver.  Null and blank values aren't used.  Who names a ``sample`` gets the model of about so many values instead."""
    chosen = values.where(F.col("key").isNotNull() & (F.trim("value") != ""))
    if sample is not None:
        n = chosen.count()
        chosen = chosen.where(F.pmod(F.xxhash64("key", F.lit("endings")), F.lit(1 << 30)) < int(min(1.0, sample / max(1, n)) * (1 << 30)))
        chosen = chosen.repartition(max(1, min(64, min(n, sample) // 250)), "key")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for key, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen["come", context(value)] += 1
                rnd = random.Random(key)
                for _ in range(CUTS):
                    if (x := cut_somewhere(value, rnd)) is not None:
                        seen["cut", context(x)] += 1
        rows = [(*k, v) for k, v in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["kind", "context", "n"])

    counts = {"come": Counter(), "cut": Counter()}
    for r in chosen.select("key", "value").mapInArrow(count, "kind string, context string, n bigint").groupBy("kind", "context").agg(F.sum("n").alias("n")).collect():  # at most twice the contexts
        counts[r["kind"]][r["context"]] = r["n"]
    return model(counts["come"], counts["cut"])
