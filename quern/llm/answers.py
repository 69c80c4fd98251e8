"""Problem 3: prompt and response pairs whose response does not serve the prompt.

``defect(prompt, text)`` names one defect.  The order of the tests is the order of precedence: an empty
answer is nothing else; a copy or refusal is judged before the ending of the text; another language is
judged before the ending.  Copies are detected by compression alone: the response is compressed with its prompt as a
raw zstandard dictionary and the prompt with the response, and what each leaves unexplained of the other decides.
Cut responses are judged by the terminal-context model (``endings``), fitted on all responses.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import endings
from quern.llm.common import spread
from quern.llm.language import detect, requested, scores
from quern.llm.lexicon import ASIDE, FUNCTION_WORDS, LABEL, PLACEHOLDERS, REFUSAL, REFUSAL_KEYS

COPY_NEW = 0.55  # share of a copy that its prompt leaves unexplained, at most
COPY_MISSING = 0.65  # share of the prompt that a copy leaves unexplained, at most
COPY_ADDED = 0.2  # how much more of a copy may be new than of the prompt is missing
SHORT = 12  # bytes of a prompt that is only compared

FUNCTION = frozenset(w for v in FUNCTION_WORDS.values() for w in v.split())
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>|&[a-zA-Z#0-9]+;")
_WORD = re.compile(r"[^\W_]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_SENT = re.compile(r"(?<=[.!?。！？])\s*|\n+")
_QUOTED = re.compile(r"\"[^\"]*\"|«[^»]*»|“[^”]*”|„[^“”]*[“”]|「[^」]*」|『[^』]*』")
_HAN = re.compile(r"[㐀-鿿]")
_OUTER = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
LONGEST = 40  # no placeholder or label is longer
_CODE = re.compile(r"```.*?(?:```|$)", re.S)


def is_empty(text: str | None) -> bool:
    """Null, blank, invisible, placeholder, bare markup or a bare label."""
    if text is None:
        return True
    bare = html.unescape(_TAG.sub(" ", text)).strip()
    if not any(c.isalnum() for c in bare):
        return True
    inner = bare.strip(_OUTER)
    if len(inner) > LONGEST:
        return False
    core = re.sub(r"\s+", " ", re.sub(r"[^\w/. ]+", " ", bare.lower())).strip(" .")
    return core in PLACEHOLDERS or bare.lower() in PLACEHOLDERS or bool(LABEL.match(bare) and not re.match(r"^\w$", bare))


@lru_cache(maxsize=64)
def _params(bits: int) -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters.from_level(3, source_size=1 << bits, dict_size=1 << bits, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)


def compressed(data: bytes, dictionary: bytes = b"") -> int:
    """Bytes of ``data`` compressed by zstandard with a raw dictionary."""
    d = {"dict_data": zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)} if dictionary else {}
    return len(zstandard.ZstdCompressor(compression_params=_params(max(len(data), len(dictionary)).bit_length()), **d).compress(data))


def unexplained(data: bytes, dictionary: bytes) -> float:
    """Share of the information in ``data`` that ``dictionary`` doesn't hold: compressed size with it over the size without."""
    return compressed(data, dictionary) / max(1, compressed(data))


def _words(s: str) -> bytes:
    """The words; numbers, as of a list or of lines, only where there is nothing else."""
    return " ".join(_LETTERS.findall(s.lower()) or _WORD.findall(s.lower())).encode("utf-8", "surrogatepass")


def is_copy(prompt: str | None, text: str) -> bool:
    """The text only gives the prompt back, whole or nearly so, once or again and again: the prompt as dictionary leaves little of the text
    unexplained, the text leaves not much of the prompt unexplained, and hardly less than the prompt leaves of it, as an answer of its own would."""
    if not prompt or not text:
        return False
    p, t = _words(prompt), _words(text)
    if not p or not t or len(p) < SHORT:  # a few bytes tell too little as a dictionary
        return bool(p) and not t.replace(p, b"").strip()
    if not t.replace(p, b"").strip():
        return True
    new = unexplained(t, p)
    if new > COPY_NEW:
        return False
    missing = unexplained(p, t)
    return missing <= COPY_MISSING and new - missing <= COPY_ADDED


def is_refusal(prompt: str | None, text: str) -> bool:
    """The text declines, and sentences that answer make up less than half of it: those that don't decline, speak of something else than speaker,
    reader, courtesies or the conversation, and don't just name what the prompt names.

    A quoted refusal doesn't count, nor a remark on limits that real content follows."""
    bare = text.replace("’", "'").lower()
    if not any(k in bare for k in REFUSAL_KEYS) or not REFUSAL.search(bare):
        return False
    bare = _QUOTED.sub(" ", bare)
    asked = set(_LETTERS.findall((prompt or "").lower()))
    other, hits = 0, 0
    for part in _SENT.split(bare):
        if REFUSAL.search(part):
            hits += 1
        elif part.strip() and not ASIDE.search(part):
            words = [w for w in _LETTERS.findall(part) if w not in FUNCTION]
            if not words or sum(w in asked for w in words) * 2 < len(words):
                other += len(part)
    return hits > 0 and other <= 0.45 * len(bare)


def other_language(prompt: str | None, text: str) -> bool:
    """Most of the text is in another language than the prompt's, and the prompt names no such language."""
    if not prompt:
        return False
    body = _CODE.sub(" ", text)
    prompt_lang, text_lang = detect(prompt), detect(body, 3)
    if not text_lang or prompt_lang == text_lang:
        return False
    if prompt_lang is None:
        s = scores(prompt)
        if not s or s.get(text_lang, 0) >= 0.5 * max(s.values()):
            return False
        prompt_lang = max(s, key=s.get)
    if text_lang in requested(prompt):
        return False
    mine = other = 0
    for part in _SENT.split(body):
        if len(part) < 8:
            continue
        s = scores(part)
        a, b = s.get(text_lang, 0), s.get(prompt_lang, 0)
        if a > b:
            other += _weight(part)
        elif b > a:
            mine += _weight(part)
    return other > mine


def _weight(part: str) -> int:
    """Length of a sentence; a Han character says about as much as three letters."""
    return len(part) + 2 * len(_HAN.findall(part))


def defect(prompt: str | None, text: str | None, model: endings.Model = endings.Model()) -> str | None:
    """The defect's name, or None for a text that serves its prompt; ``model`` judges endings."""
    if is_empty(text):
        return "empty"
    if is_copy(prompt, text):
        return "copied"
    if is_refusal(prompt, text):
        return "refusal"
    if other_language(prompt, text):
        return "other_language"
    if model.likely(text):
        return "truncated"
    return None


def find_defects(records: DataFrame, id_col: str = "id", prompt_col: str = "prompt_text", text_col: str = "text") -> DataFrame:
    """One row (id, defect) per record whose response is defective.

    Narrow: the records are judged where they are read, and only found rows are shuffled, to count a re-delivered id
    once.  Null ids give no row; a null text is ``empty``; a null prompt can't be copied nor set a language.  Should
    deliveries of one id differ, the alphabetically first defect is kept.
    """
    r = spread(records.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(prompt_col).alias("prompt"), F.col(text_col).alias("text")))
    model = endings.fit(r.select(F.col("id").alias("key"), F.col("text").alias("value")))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, d) for i, p, t in zip(*(b.column(k).to_pylist() for k in range(3))) if (d := defect(p, t, model))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string())], ["id", "defect"])

    return r.mapInArrow(judge, "id string, defect string").groupBy("id").agg(F.min("defect").alias("defect"))
