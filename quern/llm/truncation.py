"""Problem 5: values that were cut off, and how often each source cuts.

1. Lengths, in characters and bytes, are counted per source and field (pre-aggregated, all rows).
2. Per source, field and unit a log-normal length distribution is fitted by maximum likelihood with the values at a
   candidate limit right-censored (EM).  A candidate limit is a length with far more values than its neighbourhood,
   or a range in which values pile up, as word-wise cuts do below their limit.  Every length is tested for both, and every
   significant limit is kept.  The posterior that a value there was censored is what its count exceeds the fitted density by.
3. A value's terminal context has log-odds from a model fitted on all values (``endings.fit``); to these the log-odds of a cut at its
   length are added: the censoring posterior at a limit, elsewhere the share of cut values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import endings
from quern.llm.answers import is_copy, is_empty, is_refusal
from quern.llm.common import spread, with_source

FIELDS = ("text", "context_text")
SUREST = 0.95  # censoring posterior at most: some values have a limit's length by themselves
SPIKE_RATIO, SIGNIFICANT = 4.0, 5.0  # a spike's ratio to and its deviations above the neighbourhood
SHORTEST = 40  # length from which a field may have a limit
ZONE = 16  # how far below its limit a word-wise cut may end
NEAR = 80  # lengths on either side that a range is compared with
LIMITS_SCHEMA = "source string, field string, unit string, low int, high int, posterior double"


def censored_fit(length: np.ndarray, count: np.ndarray, censored: np.ndarray) -> tuple[float, float]:
    """Mean and deviation of log length by EM, where ``censored`` of the ``count`` values are only known to be at least as long."""
    x = np.log(length)
    n, c = count - censored, censored
    total = count.sum()
    mu = float((x * count).sum() / total)
    sd = max(0.05, float(math.sqrt((count * (x - mu) ** 2).sum() / total)))
    for _ in range(60):
        z = (x - mu) / sd
        pdf = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
        tail = np.maximum(0.5 * np.array([math.erfc(v / math.sqrt(2)) for v in z]), 1e-12)
        ratio = pdf / tail
        m1 = mu + sd * ratio
        m2 = mu * mu + sd * sd + sd * (x + mu) * ratio
        new = float(((n * x).sum() + (c * m1).sum()) / total)
        var = float(((n * x * x).sum() + (c * m2).sum()) / total) - new * new
        moved = abs(new - mu)
        mu, sd = new, max(0.05, math.sqrt(max(var, 0.0025)))
        if moved < 1e-5:
            break
    return mu, sd


def find_limits(length: np.ndarray, count: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, float]]:
    """(low, high, posterior) of the ranges of length in which values were censored.

    A single length is a limit if its count is ``SIGNIFICANT`` deviations above its neighbourhood and ``SPIKE_RATIO`` times it; ``shortest`` is the least that a field's limit
    can be, below which values of one length are just short answers."""
    order = np.argsort(length)
    length, count = length[order].astype(np.int64), count[order].astype(float)
    if len(length) == 0:
        return []
    at = dict(zip(length.tolist(), count.tolist()))
    cum = np.concatenate([[0.0], np.cumsum(count)])

    def between(a: int, b: int) -> float:  # values with a <= length < b
        return float(cum[np.searchsorted(length, b)] - cum[np.searchsorted(length, a)])

    spikes: list[int] = []
    lone: dict[int, float] = {}  # spikes that stand out of the lengths just below them too, as cuts by length do, and their neighbourhood's mean
    for v, c in at.items():
        if v < shortest:
            continue
        near = (between(v - 40, v + 41) - c) / 80
        if c >= SPIKE_RATIO * max(near, 0.5) and c >= near + SIGNIFICANT * math.sqrt(near + 1):
            spikes.append(v)
            if c >= SPIKE_RATIO * max(at.get(v - k, 0.0) for k in (1, 2, 3)):
                lone[v] = near
    zones = _zones(length, np.array([lone.get(v, c) for v, c in at.items()]))
    found = sorted([(v, v) for v in spikes] + zones)  # a value in both takes the larger posterior
    if not found:
        return []
    censored = np.zeros_like(count)
    for lo, hi in found:
        m = (length >= lo) & (length <= hi)
        censored[m] = count[m] * 0.9
    out = []
    mu, sd = censored_fit(length, count, np.minimum(censored, count))
    for lo, hi in found:
        xs = np.array([x for x in range(lo, hi + 1) if lo == hi or x not in lone])
        have = sum(at.get(x, 0.0) for x in xs.tolist())
        z = (np.log(xs) - mu) / sd
        expect = float((count.sum() * np.exp(-0.5 * z * z) / (xs * sd * math.sqrt(2 * math.pi))).sum())
        out.append((int(lo), int(hi), float(min(SUREST, max(0.02, 1 - expect / have)))))
    return out


def _zones(length: np.ndarray, count: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of 2 to ``ZONE`` lengths with far more values than the lengths on either side, largest excess first; they do not overlap."""
    cum = np.concatenate([[0.0], np.cumsum(count)])

    def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:  # values with a <= length < b
        return cum[np.searchsorted(length, b)] - cum[np.searchsorted(length, a)]

    v = length[length >= SHORTEST + ZONE]
    wide = np.repeat(np.arange(2, ZONE + 1), len(v))
    v = np.tile(v, ZONE - 1)
    low = v - wide + 1
    inside = between(low, v + 1)
    usual = np.maximum(between(v - ZONE + 1 - NEAR, v - ZONE + 1), between(v + 1, v + 1 + NEAR)) / NEAR * wide
    # at the end of all lengths, where nothing follows, less is enough
    good = (inside >= usual + SIGNIFICANT * np.sqrt(usual + 1)) | ((wide == ZONE) & (v >= length[-1] - 2))
    good &= inside >= np.maximum(2 * SIGNIFICANT, 1.8 * usual)
    at, out = dict(zip(length.tolist(), count.tolist())), []
    while good.any():
        k = int(np.flatnonzero(good)[np.argmax((inside - usual)[good])])
        lo, high = int(low[k]), int(v[k])
        mean = inside[k] / wide[k]
        while high > lo and at.get(high, 0.0) < min(mean / 4, mean - 2 * math.sqrt(mean)):  # the limit itself is the last length that is full
            high -= 1
        if wide[k] == ZONE or (good & (v == high) & (wide == ZONE)).any():
            lo = high - ZONE + 1
        out.append((lo, high))
        good &= (v < lo) | (low > max(high, v[k]))
    return out


def _limits(pdf: pd.DataFrame) -> pd.DataFrame:
    r = pdf.iloc[0]
    rows = find_limits(pdf["length"].to_numpy(), pdf["n"].to_numpy())
    return pd.DataFrame([(r["source"], r["field"], r["unit"], *x) for x in rows], columns=["source", "field", "unit", "low", "high", "posterior"])


def length_limits(records: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Censoring ranges per ``source`` (a column of ``records``), field and unit: all that are significant, at most one in four lengths."""
    parts = [F.struct(F.lit(f).alias("field"), F.lit(u).alias("unit"), fn(F.col(f)).alias("length")) for f in fields for u, fn in (("chars", F.char_length), ("bytes", F.octet_length))]
    counts = (
        records.select("source", F.inline(F.array(*parts))).where("length > 0").groupBy("source", "field", "unit", "length").agg(F.count("*").alias("n"))
    )
    return counts.groupBy("source", "field", "unit").applyInPandas(_limits, LIMITS_SCHEMA)


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def is_cut(value: str, limits: list[tuple[str, int, int, float]], prompt: str | None = None, answer: bool = False, model: endings.Model = endings.Model()) -> bool:
    """``limits``: (unit, low, high, posterior) of the value's source and field; ``model`` judges endings."""
    if is_empty(value):
        return False
    odds, share = model.evidence(value)
    at = _logit(share)
    if odds + max(at, _logit(SUREST)) < endings.LIKELY:
        return False
    n, b = len(value), -1
    for unit, low, high, posterior in limits:
        if unit == "bytes":
            b = len(value.encode("utf-8", "surrogatepass")) if b < 0 else b
        if low <= (n if unit == "chars" else b) <= high:
            at = max(at, _logit(posterior))
    if odds + at < endings.LIKELY:
        return False
    return not (answer and (is_copy(prompt, value) or is_refusal(prompt, value)))


def find_cuts(records: DataFrame, specs: DataFrame) -> DataFrame:
    """One row (id, field, source) per value of ``text`` or ``context_text`` that was cut off.

    Values are judged where they are read; only found rows are shuffled, to count a re-delivered id once.  Null or empty
    values and null ids give no row; records whose source is unknown or null share one length distribution.  The
    limits are collected: per known source, field and unit those that are significant, at most one in four lengths.
    """
    r = with_source(records.where(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("id"), "prompt_text", "text", "context_text", "prompt_source"), specs, "prompt_source")
    r = spread(r.withColumn("source", F.coalesce("source_id", F.lit(""))).drop("source_id", "prompt_source"))
    values = F.array(*[F.struct(F.concat_ws("|", "id", F.lit(f)).alias("key"), F.col(f).alias("value")) for f in FIELDS])
    model = endings.fit(r.select(F.inline(values)))
    limits: dict[tuple[str, str], list] = {}
    for x in length_limits(r).collect():
        limits.setdefault((x["source"], x["field"]), []).append((x["unit"], x["low"], x["high"], x["posterior"]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none: list = []
        for b in batches:
            c = {n: b.column(n).to_pylist() for n in ("id", "prompt_text", "text", "context_text", "source")}
            out = []
            for i, p, t, x, s in zip(c["id"], c["prompt_text"], c["text"], c["context_text"], c["source"]):
                if t and is_cut(t, limits.get((s, "text"), none), p, True, model):
                    out.append((i, "text", s))
                if x and is_cut(x, limits.get((s, "context_text"), none), model=model):
                    out.append((i, "context_text", s))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string()) for k in range(3)], ["id", "field", "source"])

    return r.mapInArrow(judge, "id string, field string, source string").dropDuplicates(["id", "field"])


def cut_rates(records: DataFrame, specs: DataFrame) -> DataFrame:
    """(source, field, n_values, n_cut, cut_rate): values that say something, each id once; unknown sources as ''."""
    cuts = find_cuts(records, specs).groupBy("source", "field").agg(F.count("*").alias("n_cut"))
    r = with_source(records.where(F.col("id").isNotNull()).select("id", "text", "context_text", "prompt_source"), specs, "prompt_source")
    has = [F.when(F.length(F.trim(F.col(f))) > 0, F.lit(f)) for f in FIELDS]
    values = (
        r.select("id", F.coalesce("source_id", F.lit("")).alias("source"), F.explode(F.array_compact(F.array(*has))).alias("field"))
        .distinct().groupBy("source", "field").agg(F.count("*").alias("n_values"))
    )
    n_cut = F.coalesce("n_cut", F.lit(0))
    return values.join(cuts, ["source", "field"], "left").select("source", "field", "n_values", n_cut.alias("n_cut"), F.round(n_cut / F.col("n_values"), 6).alias("cut_rate"))
