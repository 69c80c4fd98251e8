"""Problem 7: evaluation items that leak into documents, whole or in part.

1. The items' texts (passage; question without an instruction sentence that other items share) become word lists.  A
   word is what stands between blanks, lower-cased, without accents, punctuation, quoting marks and markup.
2. Document frequencies of all items' words are counted over all documents (one distributed pass).
3. Latent space: randomised SVD of the items' TF-IDF rows (a word counts once per text), computed by partial products over the row partitions.  The rank is
   raised until every row keeps ``KEEP`` of its length, and what it lost can take at most ``LOST`` of what step 4 needs; that is
   taken off each item's need, so no item is lost in a dimension that was left out.
4. Cosine search: every run of 12 (and 16) words of every document is a query window.  Its dot product with each item in the
   latent space must reach what the item's weakest run of that length keeps when one (two) words are altered.  A bound
   that needs only prefix sums drops most windows first; it drops no window that could pass.
5. Candidates are verified by a longest common subsequence with at most one altered word in eight, over at least 12 words.
6. An altered run must lie nearer to its item than to any text with other content in the latent space, by ``MARGIN``: items are
   written with shared phrasing, and a run of it around another item's names and numbers is that item's, or nobody's.
   The answer's presence is reported.

The items are a stated query set: they are processed in blocks of ``BLOCK`` items against all documents.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import stored

SPAN, LONG_SPAN = 12, 16  # words; one and two of them may be altered
BLOCK = 400
RANK, ROWS = 512, 2_000  # the rank to begin with, and the items' rows per task
KEEP = 0.999
LOST = 0.1  # of an item's need, at most, for what the latent space loses
SLACK = 0.97  # of the bound, for what single precision loses
MARGIN = 1.25  # how much nearer an altered run must be to its item than to a text with other content
MAX_ITEMS = 200_000
SEED = 5  # words in a row that any allowed match has unaltered

_TAG = re.compile(r"</?[a-zA-Z][^<>]{0,300}>|<!--.*?-->", re.S)
_DROP = re.compile(r"[^\w\s]|_")
_MARKS = re.compile(r"[̀-ͯ]")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-­‐]\n(?=[^\W\d_])")
_ASCII_DROP = bytes(c for c in range(128) if not chr(c).isalnum() and not chr(c).isspace())


def fold(text: str) -> list[str]:
    """The words of a text as they are compared."""
    if "\n" in text and _BROKEN.search(text):
        text = _BROKEN.sub("", text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if text.isascii():
        return text.lower().encode().translate(None, _ASCII_DROP).decode().split()
    text = _MARKS.sub("", unicodedata.normalize("NFKD", text.casefold()))
    return _DROP.sub("", text).split()


def _sentences(text: str) -> list[str]:
    return [x for x in re.split(r"(?<=[.!?:])\s+", text.strip()) if x]


def item_texts(items: list[tuple[int, str | None, str | None]]) -> list[tuple[int, str, list[str]]]:
    """(item_id, part, words) of passages and questions, at least ``SPAN`` words long.  Leading sentences of questions that three or more
    different questions share are instructions and don't count."""
    lead: dict[str, set] = {}
    for _, _, question in items:
        s = _sentences(question or "")
        if len(s) > 1:
            lead.setdefault(" ".join(fold(s[0])), set()).add(" ".join(fold(" ".join(s[1:]))))
    shared = {k for k, v in lead.items() if len(v) >= 3}
    out = []
    for i, passage, question in items:
        s = _sentences(question or "")
        while len(s) > 1 and " ".join(fold(s[0])) in shared:
            s = s[1:]
        for part, text in (("passage", passage or ""), ("question", " ".join(s))):
            w = fold(text)
            if len(w) >= SPAN:
                out.append((i, part, w))
    return out


def document_frequencies(documents: DataFrame, words: set[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each of ``words``, over all documents; partial counts per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                n += 1
                if t:
                    df.update(words.intersection(fold(t)))
        yield pa.RecordBatch.from_arrays([pa.array(["", *df], pa.string()), pa.array([n, *df.values()], pa.int64())], ["word", "n"])

    total = documents.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    got = {r["word"]: r["n"] for r in total.collect()}
    return got.pop("", 0), got


def randomised_svd(rows: DataFrame, n_terms: int, rank: int, power: int = 2, seed: int = 11) -> np.ndarray:
    """An orthonormal basis (n_terms x rank) of the leading right singular space of the sparse rows (terms array<int>, weights array<double>).

    Each pass computes A^T (A Q) as partial sums per partition; only the sums, n_terms x rank numbers, reach the driver."""
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((n_terms, min(rank, n_terms))))[0]
    for _ in range(power):
        basis = q

        def partial(batches: Iterator[pa.RecordBatch], basis: np.ndarray = basis) -> Iterator[pa.RecordBatch]:
            y = np.zeros_like(basis)
            for b in batches:
                for t, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    x = np.asarray(w)
                    y[t] += x[:, None] * (x @ basis[t])
            used = np.flatnonzero(np.abs(y).sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([y[k].tobytes() for k in used], pa.binary())], ["term", "sum"])

        y = np.zeros_like(basis)
        for r in rows.select("terms", "weights").mapInArrow(partial, "term int, sum binary").toLocalIterator():
            y[r["term"]] += np.frombuffer(bytes(r["sum"]))
        q = np.linalg.qr(y)[0]
    return q


def _matches(doc: list[str], item: list[str], i: int, j: int) -> tuple[bool, list[tuple[int, int]]]:
    """Whether the unaltered run at ``item[i]``, ``doc[j]`` is 12 words long; else its extents in ``doc`` with 12 words and one alteration,
    or 16 and two."""
    m, n = len(item), len(doc)

    def reach(i: int, j: int, step: int, left: int) -> list[tuple[int, int]]:
        """Most item words, and document words with them, passed from (i, j) in direction ``step`` with 0..left alterations."""
        k = 0
        while 0 <= i < m and 0 <= j < n and item[i] == doc[j]:
            i, j, k = i + step, j + step, k + 1
        out = [(k, k)] * (left + 1)
        if left and 0 <= i < m:
            for di, dj in ((1, 1), (1, 0), (0, 1)):
                if 0 <= j < n or not dj:
                    for e, (v, u) in enumerate(reach(i + di * step, j + dj * step, step, left - 1), 1):
                        if v:  # an alteration counts within a match, not at its end
                            out[e] = max(out[e], (k + di + v, k + dj + u))
        return out

    right, left = reach(i, j, 1, 2), reach(i - 1, j - 1, -1, 2)
    if left[0][0] + right[0][0] >= SPAN:
        return True, []
    pairs = ((0, 1, SPAN), (1, 0, SPAN), (0, 2, LONG_SPAN), (1, 1, LONG_SPAN), (2, 0, LONG_SPAN))
    return False, [(j - left[x][1], j + right[y][1]) for x, y, least in pairs if left[x][0] + right[y][0] >= least]


def aligned(doc: list[str], item: list[str]) -> bool:
    """Whether ``doc`` holds at least 12 words in a row of ``item`` with at most one in eight altered (replaced, added or left out).

    It is enough to find 12 words with one alteration or 16 with two: a longer match within the rule contains one of these."""
    return bool(verified(doc, {0}, range(len(doc) - SEED + 1), seeds([item]), [item]))


def seeds(items: list[list[str]]) -> dict[tuple, list[tuple[int, int]]]:
    """(item, position) by the run of ``SEED`` words there."""
    at: dict[tuple, list[tuple[int, int]]] = {}
    for q, item in enumerate(items):
        for i in range(len(item) - SEED + 1):
            at.setdefault(tuple(item[i : i + SEED]), []).append((q, i))
    return at


def verified(doc: list[str], candidates: set[int], where: Iterable[int], at: dict[tuple, list[tuple[int, int]]], items: list[list[str]]) -> dict[int, list[tuple[int, int]]]:
    """The candidates that the document holds: with no extents where a run of 12 words is unaltered, else with those of all altered matches.
    ``where``: positions, ascending, at which unaltered runs may start; a run is tried at its first seed."""
    whole: set[int] = set()
    altered: dict[int, set[tuple[int, int]]] = {}
    tried: set[tuple[int, int]] = set()
    for j in where:
        for q, i in at.get(tuple(doc[j : j + SEED]), ()):
            if q not in candidates or q in whole:
                continue
            diagonal = (q, i - j)
            if diagonal in tried and i and j and doc[j - 1] == items[q][i - 1]:
                continue
            tried.add(diagonal)
            exact, extents = _matches(doc, items[q], i, j)
            if exact:
                whole.add(q)
            elif extents:
                altered.setdefault(q, set()).update(extents)
    return {q: [] for q in whole} | {q: sorted(x) for q, x in altered.items() if q not in whole}


def _model(spark: SparkSession, texts: list[tuple[int, str, list[str]]], n_docs: int, df: dict[str, int]) -> dict:
    """Word weights, the items' vectors projected to the latent space, and the thresholds of one block of items.  A word counts once per item text."""
    vocabulary = sorted({w for _, _, t in texts for w in t})
    at = {w: k for k, w in enumerate(vocabulary)}
    idf = np.log((n_docs + 1) / (np.array([df.get(w, 0) for w in vocabulary]) + 1)) + 0.1
    rows, norms = [], []
    for _, _, t in texts:
        c = sorted({at[w] for w in t})
        norms.append(float(np.linalg.norm(idf[c])))
        rows.append((c, (idf[c] / norms[-1]).tolist()))
    norms = np.array(norms)
    frame = spark.createDataFrame(rows, "terms array<int>, weights array<double>").repartition(-(-len(rows) // ROWS))
    dense = np.zeros((len(rows), len(vocabulary)))
    for k, (t, w) in enumerate(rows):
        dense[k, t] = w
    energy = idf * idf

    def weakest(t: list[str], span: int, altered: int) -> float:
        e = energy[[at[w] for w in t]]
        if len(e) < span:
            return 1e9
        win = np.sort(np.lib.stride_tricks.sliding_window_view(e, span), axis=1)
        return float(win[:, : span - altered].sum(axis=1).min())

    def length(t: list[str]) -> float:
        return float(np.linalg.norm(idf[list(c := Counter(at[w] for w in t))] * np.array(list(c.values()))))

    def longest(t: list[str], span: int, altered: int) -> float:
        """Length at most of a window's vector that holds an allowed match: words of a run of the item, and altered words."""
        run = span + altered
        return max(length(t[k : k + run]) for k in range(max(1, len(t) - run + 1))) + altered * float(idf.max())

    spans = ((SPAN, 1), (LONG_SPAN, 2))
    floor = np.array([[weakest(t, *s) for s in spans] for _, _, t in texts]) / norms[:, None]
    widest = np.array([[longest(t, *s) for s in spans] for _, _, t in texts])
    rank = min(RANK, len(rows), len(vocabulary))
    while True:
        basis = randomised_svd(frame, len(vocabulary), rank)
        inside = dense @ basis
        lost = np.linalg.norm(dense - inside @ basis.T, axis=1)[:, None] * widest
        if rank >= min(len(rows), len(vocabulary)) or (np.linalg.norm(inside, axis=1).min() >= KEEP and (lost <= LOST * floor).all()):
            break
        rank = min(2 * rank, len(rows), len(vocabulary))
    need = (floor - lost) * SLACK
    # part of a window's dot product with each item that one word brings, and as share of what the item needs at most
    scores = (idf[:, None] * (basis @ inside.T)).astype(np.float32)
    most = np.stack([np.maximum((scores / need[:, k]).max(axis=1), 0) for k in range(2)], axis=1)
    return {"at": at, "scores": scores, "need": need.astype(np.float32), "most": most, "norms": norms.astype(np.float32)}


def _nearness(words: list[str], m: dict) -> np.ndarray:
    """The latent dot product of a run of words with each item text, in the weights of the words that they share."""
    ids = [k for w in words if (k := m["at"].get(w)) is not None]
    return m["scores"][ids].sum(axis=0) * m["norms"]


def _candidates(words: list[str], m: dict) -> tuple[set[int], list[int]]:
    """The item texts that some window of the document may hold, and the positions at which runs in these windows may start.

    The sum of its words' ``most`` bounds what any item gets from a window, as share of the item's need: below 1, none passes."""
    n = len(words)
    if n < SPAN - 1:
        return set(), []
    ids = np.fromiter(map(m["at"].get, words, repeat(-1)), np.int64, n)
    known = ids >= 0
    if np.count_nonzero(known) < SPAN - 2:
        return set(), []
    share = m["most"][ids]
    share[~known] = 0
    running = np.zeros((n + 1, 2))
    np.cumsum(share, axis=0, out=running[1:])
    found: set[int] = set()
    begin = np.zeros(n, bool)
    for k, span in enumerate((SPAN, LONG_SPAN)):
        w = min(span, n)
        starts = np.flatnonzero(running[w:, k] - running[:-w, k] >= 1)
        for part in np.array_split(starts, -(-len(starts) // 512)) if len(starts) else ():
            # sums over windows from running sums over the positions that any of them covers
            used = np.zeros(n, bool)
            used[(part[:, None] + np.arange(w)).ravel()] = True
            pos = np.flatnonzero(used)
            rows = m["scores"][ids[pos]]
            rows[~known[pos]] = 0
            total = np.zeros((len(pos) + 1, rows.shape[1]), np.float32)
            np.cumsum(rows, axis=0, out=total[1:])
            first = np.searchsorted(pos, part)
            hit = total[first + w] - total[first] >= m["need"][:, k]
            rows_hit = hit.any(axis=1)
            if rows_hit.any():
                found.update(np.flatnonzero(hit.any(axis=0)).tolist())
                begin[(part[rows_hit][:, None] + np.arange(w - SEED + 1)).ravel()] = True
    return found, np.flatnonzero(begin).tolist()


def _contents(texts: list[tuple[int, str, list[str]]]) -> list[int]:
    """Per text a number that the texts of one item, and of items with the same content, share."""
    of: dict[int, list[tuple]] = {}
    for i, part, t in texts:
        of.setdefault(i, []).append((part, *t))
    numbers: dict[tuple, int] = {}
    number = {i: numbers.setdefault(tuple(x), len(numbers)) for i, x in of.items()}
    return [number[i] for i, _, _ in texts]


def _distinct(found: DataFrame, m: Broadcast, content: np.ndarray) -> DataFrame:
    """Rows whose run of words is unaltered, or nearer to their item than to any text of a block with other content, by ``MARGIN``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = m.value[0]
        for b in batches:
            keep = []
            for own, score, run in zip(*(b.column(k).to_pylist() for k in ("content", "score", "run"))):
                other = _nearness(run.split(" "), model)[content != own] if run is not None else ()
                keep.append(len(other) == 0 or score >= MARGIN * float(other.max()))
            yield b.filter(pa.array(keep, pa.bool_()))

    return found.mapInArrow(judge, found.schema)


def find_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, part, has_answer, unaltered): documents that hold at least twelve words in a row of an item's passage or question,
    at most one in eight of them altered.

    One narrow pass over the documents for the words' frequencies and one per block of items; a document's pairs are complete, without a
    cap.  An altered run counts where it is nearer to the item, in the latent space, than to any text with other content: phrasing that items
    share, with another item's names in it, is no leak.  Null ids and texts give no row; items shorter than twelve words can't leak by
    this definition; items with equal content each give a row.  More than ``MAX_ITEMS`` items are an error.
    """
    spark = documents.sparkSession
    docs = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = items.where("item_id is not null").select("item_id", "passage", "question", "answer").distinct().limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} items")
    rows = sorted(((r["item_id"], r["passage"], r["question"], r["answer"]) for r in rows), key=lambda r: (r[0], *(x or "" for x in r[1:])))
    every = item_texts([r[:3] for r in rows])
    schema = "doc_id bigint, item_id bigint, part string, has_answer boolean"
    if not every:
        return spark.createDataFrame([], schema + ", unaltered boolean")
    answers = {r[0]: fold(r[3] or "") for r in rows}
    contents = _contents(every)
    frequency = document_frequencies(docs, {w for _, _, t in every for w in t})
    out, blocks = None, []
    for k in range(0, len(every), 2 * BLOCK):
        texts, own = every[k : k + 2 * BLOCK], np.array(contents[k : k + 2 * BLOCK])
        model = spark.sparkContext.broadcast((_model(spark, texts, *frequency), texts, {t[0]: answers[t[0]] for t in texts}))  # bounded by BLOCK items
        blocks.append((model, own))

        def search(batches: Iterator[pa.RecordBatch], model=model, own=own) -> Iterator[pa.RecordBatch]:
            m, texts, answers = model.value
            lists = [t[2] for t in texts]
            at = seeds(lists)
            for b in batches:
                found: list[tuple] = []
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    words = fold(text)
                    candidates, where = _candidates(words, m)
                    for q, extents in verified(words, candidates, where, at, lists).items() if candidates else ():
                        item_id, part, _ = texts[q]
                        a = answers[item_id]
                        has = bool(a) and any(words[j : j + len(a)] == a for j in range(len(words) - len(a) + 1))
                        head = (doc_id, item_id, part, has, int(own[q]))
                        found += [(*head, float(_nearness(words[x:y], m)[q]), " ".join(words[x:y])) for x, y in extents] or [(*head, None, None)]
                types = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(types)], ["doc_id", "item_id", "part", "has_answer", "content", "score", "run"])

        part = docs.mapInArrow(search, schema + ", content bigint, score double, run string")
        out = part if out is None else out.unionByName(part)
    for model, own in blocks:
        if len(blocks) > 1:  # one block's model per stage; found rows are few
            out = stored(out)
        out = _distinct(out, model, own)
    return out.select("doc_id", "item_id", "part", "has_answer", F.col("run").isNull().alias("unaltered")).dropDuplicates(["doc_id", "item_id", "part"])
