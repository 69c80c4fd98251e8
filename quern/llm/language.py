"""Language of a text from function words and scripts (no model, no external data)."""

from __future__ import annotations

import re

from quern.llm.lexicon import FUNCTION_WORDS, LANGUAGE_NAMES

LATIN = ("en", "de", "fr", "es", "pt")
_SETS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
_OF: dict[str, tuple[str, ...]] = {}
for _k in LATIN:
    for _w in _SETS[_k]:
        _OF[_w] = (*_OF.get(_w, ()), _k)
_WORD = re.compile(r"[^\W\d_]+")
_NAMES = {n: k for k, v in LANGUAGE_NAMES.items() for n in v.split()}
_NAME = re.compile("|".join(sorted((re.escape(n) for n in _NAMES), key=len, reverse=True)), re.I)
_HAN = re.compile(r"[㐀-鿿]")
_CYR = re.compile(r"[Ѐ-ӿ]")
_LATIN_WORD = re.compile(r"[a-zà-öø-ÿœ]+")


def scores(text: str) -> dict[str, float]:
    """Evidence per language in words; three Han characters count as a function word, eight Cyrillic letters as one."""
    low = text.lower()
    out: dict[str, float] = {}
    if not low.isascii():
        if n := len(_HAN.findall(low)):
            out["zh"] = n / 3
        if n := len(_CYR.findall(low)):
            out["ru"] = n / 8
    for w in _WORD.findall(low):
        for k in (of := _OF.get(w, ())):  # a word that languages share counts less for each
            out[k] = out.get(k, 0) + 1 / len(of)
    return out


def detect(text: str | None, least: float = 2) -> str | None:
    """The language with most evidence; None when there is less than ``least`` or a tie."""
    if not text:
        return None
    s = sorted(scores(text).items(), key=lambda x: -x[1])
    if not s or s[0][1] < least or (len(s) > 1 and s[0][1] - s[1][1] < 0.1 * s[0][1] and s[0][0] not in ("zh", "ru")):
        return None
    return s[0][0]


def requested(prompt: str) -> set[str]:
    """Languages named in the prompt."""
    return {_NAMES[m.lower()] for m in _NAME.findall(prompt)}
