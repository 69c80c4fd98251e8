"""Problem 8: keyword-stuffed pages and link lists.

Per document, whole text:

1. Lines that are records (log entries, table rows, file inventories, code, numbered references) are set aside as content.
2. The rest is one stream of tokens: words, Han characters, links.
3. Recurrence gaps: a content word, or a pair of Han content characters, that recurs within ``LAG`` tokens is stuffing; prose
   repeats its words further apart.
4. Lag windows of ``WINDOW`` tokens without function words are lists of nouns, tags or menu entries; links are list
   entries themselves.
5. Positional autocorrelation under a lag window: the agreement of the content words with themselves at lags up to ``MAX_LAG``, each
   weighted by a triangular window.  It is added to the share of stuffed and listed tokens; the sum decides, in every document.
6. Whatever that sum, a page is spam that says one phrase of any length ``REPEATS`` times or more: by the autocorrelation of
   the stream at all lags, numbers included, or by sentences that return word for word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import spread
from quern.llm.lexicon import FUNCTION_WORDS

LAG, WINDOW, MAX_LAG = 9, 24, 16
FEW = 1  # function words that a window may hold and still count as a list
SPAM = 0.65  # sum of share and windowed autocorrelation from which a document is spam
MOST = 0.5  # what most of a document is
REPEATS = 4  # times that a phrase is said; a passage pasted twice or three times is none
SAME = 0.85  # agreement of a phrase's repetitions; entries of a glossary made alike differ in more
EXACT_LAGS = 32  # lags up to which the autocorrelation at all lags needs no transform
FREE = 4  # tokens that say nothing either way: few tokens are little evidence
LINK_WEIGHT = 3  # tokens that a link counts as
_TAPER = [1 - k / (MAX_LAG + 1) for k in range(1, MAX_LAG + 1)]

# Frequent Chinese function characters.
_HAN_FUNCTION = "的了在是和与而但并之有没人到那说出于也就把被对从向为这其以及只因所后前中时"
_ENDS = frozenset(".!?。！？")
_FUNCTION = frozenset(w for v in FUNCTION_WORDS.values() for w in v.split()) | frozenset(_HAN_FUNCTION) | _ENDS
_LINK = "\x01"
_URL = re.compile(r"(?:https?://|www\.)[^\s<>\"')\]]+", re.I)
_ANCHOR = re.compile(r"<a\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>|&[a-zA-Z]+;|&#\d+;")
_HASHTAG = re.compile(r"#(?=\w)")
_TOKEN = re.compile(r"[㐀-鿿]|[^\W\d_㐀-鿿]+|\x01")
_TOKEN_ENDS = re.compile(r"[㐀-鿿]|[^\W\d_㐀-鿿]+|\x01|[.!?。！？](?=\s|$|[^\W\d_])")
_FOREIGN = re.compile(r"[Ѐ-ӿ㐀-鿿]")
_HAN = re.compile(r"[㐀-鿿]")
_WORD_OR_END = re.compile(r"[㐀-鿿]|[^\W_㐀-鿿]+|[.!?](?=\s|$)|[。！？\n]")
_STOPS = frozenset(".!?。！？\n")
_BREAK = re.compile(r"<br\s*/?>|</?p>", re.I)
_HUMP = re.compile(r"(?<=[a-zà-öø-ÿ])(?=[A-ZÀ-ÖØ-Þ])")
_RECORD = re.compile(
    r"^\s*\||(?:^|\s)\w+=\S+(?:\s+\w+=\S+)+|\b[0-9a-f]{16,}\b|^\s*\[\d+\]\s|^\s*[\w./-]+\.\w{2,5}\s+\d+\b"
    r"|^\s*(?:def|class|return|import|from|while|for|if|elif|with|assert|try|except|else|print)\b.*[:=()\[\]]|^\s*[\w.\[\]\", ]+ [-+*/]?= |^\s+[\w.]+\(.*\)$|^\s*(?:try|else|finally):$"
)
# the same where punctuation was lost: a line of names with numbers, or of code by its names
_NUMBERED = re.compile(r"^\W*[^\W\d]+_?\d+(?:\s+[^\W\d]+_?\d+){2,}\W*$")
_KEYWORD = re.compile(r"^\W*(?:def|class|return|import|from|while|for|if|elif|with|assert|try|except|else|finally|print\w*)\b")
_NAME = re.compile(r"(?<![\w#])[a-zA-Z]\w*_\w+")
_RECORD_MARKS = ("=", "|", "[", ":\n", "\nimport", "\nfrom")
_LINE_MARKS = ("=", "|", "[", "(", ":", "import", "from")
_RECORD_RUNS = re.compile(r"[0-9a-f]{16}"), re.compile(r"\.\w{2,5}\s+\d")


def _is_record(line: str, runs: bool) -> bool:
    """``runs``: whether the text has long hexadecimal numbers or file names with sizes anywhere, without which lines of plain words needn't be searched."""
    if line[:1] == ">":
        line = line[1:]
    if (runs or any(m in line for m in _LINE_MARKS)) and _RECORD.search(line):
        return True
    return ("_" in line or line.rstrip(" .,;:!?)\"'")[-1:].isdigit()) and _bare_record(line)


def _bare_record(line: str) -> bool:
    """A log entry or a line of code that has lost its punctuation: names with numbers, or names with underscores that make up most of the line or follow a keyword."""
    if _NUMBERED.match(line):
        return True
    names = len(_NAME.findall(line)) if "_" in line else 0
    return names > 0 and (_KEYWORD.match(line) is not None or names * 2 >= len(line.split()))


def body(text: str) -> tuple[str, int]:
    """The text without markup and record lines, lower-cased, links as one character each; and the number of tokens in record lines."""
    records = 0
    if "\xa0" in text:
        text = text.replace("\xa0", " ")
    if "<br" in text or "<p" in text:
        text = _BREAK.sub("\n", text)
    runs = any(r.search(text) for r in _RECORD_RUNS)
    if runs or "_" in text or text.startswith(("import", "from")) or any(m in text for m in _RECORD_MARKS):
        keep = []
        for line in text.split("\n"):
            if _is_record(line, runs):
                records += len(_TOKEN.findall(line)) or 1
            else:
                keep.append(line)
        text = "\n".join(keep)
    if "http" in text or "www." in text or "<a " in text:
        text = _URL.sub(" \x01 ", _ANCHOR.sub(" \x01 ", text))
    if "<" in text or "&" in text:
        text = _TAG.sub(" ", text)
    if "#" in text and _HASHTAG.search(text):
        text = _HUMP.sub(" ", _HASHTAG.sub(" \x01 ", text))
    return text.lower(), records


def tokens(text: str) -> list[str]:
    """The tokens of a body.  Where most letters are Cyrillic or Han, whose function words are rare or unsafe, sentence ends are tokens too."""
    if not text.isascii() and len(_FOREIGN.findall(text)) * 3 > len(text):
        return _TOKEN_ENDS.findall(text)
    return _TOKEN.findall(text)


def autocorrelation(ids: np.ndarray, content: np.ndarray, max_lag: int, least: float) -> float:
    """Largest share of content positions that hold the same token at one lag of 1..max_lag; 0 if it is below ``least``.

    With a random phase per token, the transform's autocorrelation at a lag is at least the equal pairs less the unequal
    ones.  So a share of ``a`` shows as 2a - 1 or more under any phases, and the lags that fail this need no comparison."""
    n = len(ids)
    max_lag = min(max_lag, n - 1)
    if max_lag < 1 or len(np.unique(ids[content])) > max_lag + (1 - least) * content.sum():
        return 0.0
    lags = np.arange(1, max_lag + 1)
    have = content.sum() - np.cumsum(content)[:max_lag]  # content positions that have a position ``lag`` before them
    ok = have > 0
    if max_lag > EXACT_LAGS:
        rng = np.random.default_rng(7)
        size = 1 << int(n + max_lag).bit_length()
        for _ in range(8):
            x = np.where(content, np.exp(2j * np.pi * rng.random(int(ids.max()) + 1))[ids], 0)
            est = np.fft.ifft(np.abs(np.fft.fft(x, size)) ** 2).real[1 : max_lag + 1]
            ok &= est >= (2 * least - 1) * have - 1e-6 * n
            if ok.sum() <= 8:
                break
    best = 0.0
    for lag in lags[ok]:
        m = content[lag:]
        best = max(best, float(((ids[lag:] == ids[:-lag]) & m).sum() / m.sum()))
    return best if best >= least else 0.0


def _numbered(toks: list[str]) -> np.ndarray:
    names: dict[str, int] = {}
    return np.array([names.setdefault(t, len(names)) for t in toks], np.int64)


def repeated(text: str, records: int) -> bool:
    """Whether most of the text, record lines counted as content, says one phrase or some sentences ``REPEATS`` times or more."""
    parts = _WORD_OR_END.findall(text)
    toks = [t for t in parts if t not in _STOPS]
    n, distinct = len(toks), set(toks)
    if n < 3 * REPEATS or n <= records:
        return False
    if len(distinct) <= (1 - MOST + MOST / REPEATS) * n:  # else no such sentences fit
        times: Counter = Counter()
        begin = 0
        for k, t in enumerate([*parts, "."]):
            if t in _STOPS:
                times[tuple(parts[begin:k])] += 1
                begin = k + 1
        if sum(len(x) * k for x, k in times.items() if k >= REPEATS and len(x) >= 3) >= MOST * (n + records):
            return True
    content = [t not in _FUNCTION for t in toks]
    if len(distinct - _FUNCTION) > n // REPEATS + (1 - SAME) * sum(content):  # no such lag then, see autocorrelation
        return False
    return autocorrelation(_numbered(toks), np.array(content), n // REPEATS, SAME) >= SAME


def profile(text: str, records: int) -> tuple[float, float]:
    """(share of stuffed or listed tokens among all, windowed autocorrelation) of a body; a link counts as several tokens.

    The autocorrelation is the sum over lags up to ``MAX_LAG`` of the pairs of equal content tokens at that lag, tapered, per content token."""
    toks = tokens(text)
    n = len(toks)
    if not n:
        return 0.0, 0.0
    seen: dict[str, list[int]] = {}  # places of a word or pair of Han characters
    pairs = 0.0
    flags = [t in _FUNCTION for t in toks]
    spam = np.zeros(n, bool)
    link = np.zeros(n, bool)
    hits = []
    for i, t in enumerate(toks):
        if flags[i]:
            continue
        if t == _LINK:
            hits.append(i)
            link[i] = True
            continue
        if "㐀" <= t <= "鿿":  # one character says little, two are a word
            if not i or flags[i - 1] or not "㐀" <= toks[i - 1] <= "鿿":
                continue
            t, wide = toks[i - 1] + t, 1
        else:
            wide = 0
        places = seen.setdefault(t, [])
        for p in reversed(places):
            if i - p > MAX_LAG:
                break
            pairs += _TAPER[i - p - 1]
        if places and i - places[-1] <= LAG:
            p = places[-1]
            hits += (i - wide, i, p - wide, p)
        places.append(i)
    spam[hits] = True
    function = np.array(flags)
    # lag windows with hardly a function word
    w = min(WINDOW, n)
    c = np.concatenate([[0], np.cumsum(function)])
    few = FEW if w == WINDOW and not _ENDS.intersection(toks) and not _HAN.search(text) else 0
    bare = (c[w:] - c[:-w]) <= few
    if bare.any():
        cover = np.zeros(n + 1, np.int64)
        starts = np.flatnonzero(bare)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + w, -1)
        spam |= np.cumsum(cover)[:n] > 0
    # function words between stuffed words belong to the sales phrase they carry
    weight = 1 + (LINK_WEIGHT - 1) * link
    listed = float(weight[spam].sum())
    plain = float(weight[~function & ~spam].sum())
    return listed / (listed + plain + records + FREE), pairs / (int((~function).sum()) + records + FREE)


def is_spam(text: str | None) -> bool:
    if not text:
        return False
    stream, records = body(text)
    return sum(profile(stream, records)) >= SPAM or repeated(stream, records)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([i for i, t in zip(ids, texts) if t and is_spam(t)], pa.int64())], ["doc_id"])


def find_spam(documents: DataFrame) -> DataFrame:
    """(doc_id) of the documents that are mostly keywords, tags, menu entries, links or sales phrases.

    One narrow pass; only found ids are shuffled, to give each once.  Null texts, empty texts and null ids give no row.
    """
    d = spread(documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint"), "text"))
    return d.mapInArrow(_found, "doc_id bigint").distinct()
