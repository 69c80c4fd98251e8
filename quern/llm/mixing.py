"""Problem 2: mixing sources to target weights by Poisson replication.

A record's repeat count is the inverse of a Poisson distribution at a uniform number hashed from its id and the mix, so it needs
no coordination and survives recomputation.  With fixed uniforms the size that a bucket reaches grows with the
mean; the mean is therefore calibrated until the bucket comes as near to its target as the records allow: from
histograms of tokens over the uniform numbers, first over 1,024 bins, then over 1,024 sub-bins of the bins in which a threshold
falls.  Only histograms reach the driver; their size depends on the number of targets alone.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bounded, stored, with_source
from quern.llm.tokens import estimated_tokens, once

BITS, BIN_BITS = 50, 10
TOP = 1 << BITS
WIDE = BITS - BIN_BITS  # bits below a bin
FINE = WIDE - BIN_BITS  # bits below a sub-bin
MAX_TARGETS = 2_000


def candidates(records: DataFrame, specs: DataFrame) -> DataFrame:
    """(id, bucket, tokens): records, each id once, of enabled sources that have a bucket."""
    r = records.select("id", "prompt_source", estimated_tokens(F.col("text")).alias("tokens"), "ingested_at")
    r = with_source(once(r, ["tokens", "prompt_source"]), specs, "prompt_source")
    live = specs.where("id is not null and bucket is not null and coalesce(enabled, true)").groupBy(F.col("id").alias("source_id")).agg(F.min("bucket").alias("bucket"))
    return r.join(bounded(live), "source_id").select("id", "bucket", "tokens")


def normalised(targets: list[dict]) -> list[dict]:
    """Shares as fractions: a mix that has a share above 1 is written in percent; null or negative shares are 0; a mix's shares aren't
    rescaled, so a mix whose shares add to less stays below its size."""
    top: dict = {}
    for t in targets:
        top[t["mix_id"]] = max(top.get(t["mix_id"], 0.0), _number(t["share"]))
    return [
        t | {"share": max(0.0, _number(t["share"])) / (100.0 if top[t["mix_id"]] > 1.0 else 1.0), "max_repeats": max(1, int(t["max_repeats"] or 1)), "size_factor": max(0.0, _number(t["size_factor"], 1.0))}
        for t in targets
    ]


def _number(x, default: float = 0.0) -> float:
    return default if x is None or x != x else float(x)


def thresholds(mean: float, cap: int) -> np.ndarray:
    """Where on 0..TOP a uniform number gives at least 1, 2, ... cap repeats under a Poisson distribution with ``mean``."""
    out, p, c = [], math.exp(-mean), 0.0
    for k in range(cap):
        c += p
        out.append(min(TOP, int(math.ceil(min(1.0, c) * TOP))))
        p *= mean / (k + 1)
    return np.array(out, np.int64)


class Size:
    """Tokens that a bucket reaches, from histograms; thresholds are rounded up to known edges, where the result is exact."""

    def __init__(self, bins: np.ndarray):
        self.after = np.concatenate([np.cumsum(bins[::-1])[::-1], [0]])
        self.fine: dict[int, np.ndarray] = {}

    def refine(self, b: int, sub: np.ndarray) -> None:
        self.fine[b] = np.concatenate([np.cumsum(sub[::-1])[::-1], [0]])

    def edge(self, t: int) -> int:
        b, rest = int(t) >> WIDE, int(t) & ((1 << WIDE) - 1)
        if not rest:
            return int(t)
        if b in self.fine:
            return (int(t) + (1 << FINE) - 1) >> FINE << FINE
        return (b + 1) << WIDE

    def at(self, t: int) -> int:
        b, rest = int(t) >> WIDE, int(t) & ((1 << WIDE) - 1)
        return int(self.after[b]) if not rest else int(self.after[b + 1] + self.fine[b][rest >> FINE])

    def reached(self, ts: np.ndarray) -> tuple[int, list[int]]:
        edges = [self.edge(t) for t in ts]
        return sum(self.at(e) for e in edges), edges

    def solve(self, want: float, cap: int) -> tuple[float, list[int]]:
        """The mean whose size is nearest to ``want``, and its thresholds."""
        if want <= 0 or self.after[0] == 0:
            return 0.0, [TOP] * cap
        if want >= cap * int(self.after[0]):
            return math.inf, [0] * cap
        low, high = 0.0, 1.0
        while self.reached(thresholds(high, cap))[0] < want and high < 700:
            high *= 2
        for _ in range(90):
            mid = (low + high) / 2
            if self.reached(thresholds(mid, cap))[0] < want:
                low = mid
            else:
                high = mid
        best = min((low, high), key=lambda m: abs(self.reached(thresholds(m, cap))[0] - want))
        return best, self.reached(thresholds(best, cap))[1]


def _uniform():
    return F.shiftrightunsigned(F.xxhash64("id", "mix_id", F.lit("mix")), 64 - BITS)


def plan(base: DataFrame, targets: DataFrame) -> tuple[list[dict], DataFrame]:
    """The targets with their wanted size and thresholds, and the records per mix with their uniform number ``h``."""
    spark = base.sparkSession
    rows = [r.asDict() for r in targets.where("mix_id is not null and bucket is not null").dropDuplicates(["mix_id", "bucket"]).limit(MAX_TARGETS + 1).collect()]
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    rows = normalised(sorted(rows, key=lambda r: (r["mix_id"], r["bucket"])))
    available = base.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    for k, t in enumerate(rows):
        t |= {"target_id": k, "wanted": t["share"] * t["size_factor"] * available, "size": t["size_factor"] * available}
    schema = "target_id int, mix_id string, bucket string"
    ids = spark.createDataFrame([(t["target_id"], t["mix_id"], t["bucket"]) for t in rows], schema)
    each = base.join(F.broadcast(ids), "bucket").withColumn("h", _uniform())  # at most MAX_TARGETS rows
    bins = np.zeros((len(rows), 1 << BIN_BITS), np.int64)
    for r in each.groupBy("target_id", F.shiftright("h", WIDE).alias("bin")).agg(F.sum("tokens").alias("n")).toLocalIterator():
        bins[r["target_id"], r["bin"]] = r["n"]
    sizes = [Size(b) for b in bins]
    # around the coarse solution, the bins into which its thresholds and their neighbours fall
    near = set()
    for t, s in zip(rows, sizes):
        if 0 < t["wanted"] < t["max_repeats"] * int(s.after[0]):
            mean = s.solve(t["wanted"], t["max_repeats"])[0]
            for m in (mean * 0.9985, mean, mean * 1.0015):
                near |= {(t["target_id"], min(int(x) >> WIDE, (1 << BIN_BITS) - 1)) for x in thresholds(m, t["max_repeats"]) if x < TOP}
    if near:
        spots = spark.createDataFrame(sorted(near), "target_id int, bin bigint")
        sub = each.withColumn("bin", F.shiftright("h", WIDE)).join(F.broadcast(spots), ["target_id", "bin"])
        fine = {k: np.zeros(1 << BIN_BITS, np.int64) for k in near}
        for r in sub.groupBy("target_id", "bin", F.shiftright("h", FINE).bitwiseAND((1 << BIN_BITS) - 1).alias("sub")).agg(F.sum("tokens").alias("n")).toLocalIterator():
            fine[(r["target_id"], r["bin"])][r["sub"]] = r["n"]
        for (k, b), x in fine.items():
            sizes[k].refine(b, x)
    for t, s in zip(rows, sizes):
        t["mean"], t["thresholds"] = s.solve(t["wanted"], t["max_repeats"])
    return rows, each


def mixture(records: DataFrame, specs: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, bucket, id, repeat_no, tokens, shuffle_key), ordered by mix and shuffle key: each chosen record once per repeat, at most
    ``max_repeats`` times, in a global order hashed from id, mix and repeat.

    Null ids, and records of unknown, disabled or bucketless sources are not chosen; buckets without a source stay empty.
    """
    base = stored(candidates(records, specs))
    rows, each = plan(base, targets)
    limits = base.sparkSession.createDataFrame([(t["target_id"], [int(x) for x in t["thresholds"]]) for t in rows], "target_id int, thresholds array<bigint>")
    n = F.size(F.filter("thresholds", lambda t: F.col("h") >= t))
    chosen = each.join(F.broadcast(limits), "target_id").withColumn("n", n).where("n > 0")
    return chosen.select(
        "mix_id", "bucket", "id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("repeat_no"), "tokens"
    ).withColumn("shuffle_key", F.xxhash64("id", "mix_id", "repeat_no", F.lit("order"))).orderBy("mix_id", "shuffle_key", "id", "repeat_no")


def mix_report(records: DataFrame, specs: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, bucket, share, wanted_tokens, max_repeats, records, repeats, reached_tokens, reached_share, actual_share): one row per target.

    ``reached_share`` is of the wanted size of the mix, to compare with ``share``; ``actual_share`` of what the mix reached.
    """
    base = stored(candidates(records, specs))
    rows, each = plan(base, targets)
    schema = "target_id int, mix_id string, bucket string, share double, wanted_tokens double, max_repeats int, size double, thresholds array<bigint>"
    goal = base.sparkSession.createDataFrame([(t["target_id"], t["mix_id"], t["bucket"], t["share"], t["wanted"], t["max_repeats"], t["size"], [int(x) for x in t["thresholds"]]) for t in rows], schema)
    n = F.size(F.filter("thresholds", lambda t: F.col("h") >= t))
    got = each.drop("mix_id", "bucket").join(F.broadcast(goal.select("target_id", "thresholds")), "target_id").withColumn("n", n).where("n > 0").groupBy("target_id").agg(
        F.count("*").alias("records"), F.sum("n").alias("repeats"), F.sum(F.col("n") * F.col("tokens")).alias("reached_tokens")
    )
    out = goal.drop("thresholds").join(got, "target_id", "left").na.fill(0, ["records", "repeats", "reached_tokens"])
    whole = out.groupBy("mix_id").agg(F.sum("reached_tokens").alias("whole"))
    return out.join(F.broadcast(whole), "mix_id").select(  # at most MAX_TARGETS rows
        "mix_id", "bucket", "share", "wanted_tokens", "max_repeats", "records", "repeats", "reached_tokens",
        F.round(F.col("reached_tokens") / F.nullif("size", F.lit(0.0)), 9).alias("reached_share"), F.round(F.col("reached_tokens") / F.nullif("whole", F.lit(0)), 9).alias("actual_share"),
    )
