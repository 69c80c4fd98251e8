"""Statistics of score arrays and of step logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import arrays, rng


def entropies(df: DataFrame, scores: str, temperature: float = 1.0) -> DataFrame:
    return df.withColumn("entropy", arrays.entropy(scores, temperature)).withColumn("top", arrays.argmax(scores))


def entropy_accept(positions: DataFrame, bound: float, batch: str, row: str, position: str, vocabulary: int, seed: int) -> DataFrame:
    """Positions (batch, row, position, entropy, top) with ``accepted`` and ``next_id``.

    Accepted is where the entropy is within the bound; if no position of a whole batch is, each row accepts its position of
    least entropy, the first on ties.  Accepted positions keep their top id, others get a random one.  Partial aggregates per batch and row; null
    entropies are never within the bound.
    """
    ok = F.coalesce(F.col("entropy") <= bound, F.lit(False))
    some = positions.groupBy(batch).agg(F.bool_or(ok).alias("_any"))
    least = positions.groupBy(batch, row).agg(F.min(F.struct(F.coalesce("entropy", F.lit(float("inf"))).alias("e"), F.col(position).alias("p"))).alias("_m")).select(batch, row, F.col("_m.p").alias("_least"))
    r = positions.join(some, batch).join(least, [batch, row])
    r = r.withColumn("accepted", F.when(F.col("_any"), ok).otherwise(F.col(position) == F.col("_least")))
    fresh = rng.below(vocabulary, seed, "r", F.col(batch), F.col(row), F.col(position))
    return r.withColumn("next_id", F.when(F.col("accepted"), F.col("top").cast("bigint")).otherwise(fresh)).drop("_any", "_least")


def within_steps(log: DataFrame, step: str, max_steps: int = 0, tokens: str | None = None, max_tokens: int = 0) -> DataFrame:
    """The steps that a loop with these bounds makes: up to ``max_steps``, and as long as fewer than ``max_tokens`` were made before (column ``tokens``); 0 is no bound."""
    keep = (F.col(step) <= max_steps) if max_steps > 0 else F.lit(True)
    return log.where(keep & (F.col(tokens) < max_tokens)) if tokens and max_tokens > 0 else log.where(keep)


def step_summary(positions: DataFrame, bound: float, group: list[str]) -> DataFrame:
    """(group, mean_entropy, accepted_fraction) of positions (entropy): how sure a step was, and which share of its positions is within the bound.
    Null entropies count as positions that aren't."""
    ok = F.coalesce((F.col("entropy") <= bound).cast("double"), F.lit(0.0))
    return positions.groupBy(*group).agg(F.avg("entropy").alias("mean_entropy"), F.avg(ok).alias("accepted_fraction"))


def loss(df: DataFrame, scores: str, label: str) -> DataFrame:
    """One row (rows, loss): mean cross entropy over rows with a label, NaN without any."""
    ce = arrays.cross_entropy(scores, label)
    return df.agg(F.count(ce).alias("rows"), F.coalesce(F.avg(ce), F.lit(float("nan"))).alias("loss"))


def stability(steps: DataFrame, group: list[str], step: str, state: Column) -> DataFrame:
    """Steps with ``stable``: how many steps in a row before this one had the same state; 0 at each change."""
    w = Window.partitionBy(*group).orderBy(step)
    s = steps.withColumn("_s", state).withColumn("_c", F.coalesce((~F.col("_s").eqNullSafe(F.lag("_s").over(w))).cast("int"), F.lit(1)))
    s = s.withColumn("_i", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.withColumn("stable", F.row_number().over(Window.partitionBy(*group, "_i").orderBy(step)) - 1).drop("_s", "_c", "_i")


def early_stop(steps: DataFrame, group: list[str], step: str, entropy: str, threshold: float, stable: str = "stable", stable_steps: int = 3) -> DataFrame:
    """(group, stop_step): the first step whose mean entropy is within the threshold or that is stable for long enough; null if none."""
    stop = (F.col(entropy) <= threshold) | (F.col(stable) >= stable_steps)
    return steps.groupBy(*group).agg(F.min(F.when(stop, F.col(step))).alias("stop_step"))


def running_best(log: DataFrame, group: list[str], step: str, value: str) -> DataFrame:
    """The log with ``best``: the least value so far; nulls and NaN don't count."""
    w = Window.partitionBy(*group).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return log.withColumn("best", F.min(F.nanvl(F.col(value), F.lit(None).cast("double"))).over(w))


def counters(log: DataFrame, group: list[str], step: str, accumulate: int, **sums: Column) -> DataFrame:
    """The log with running sums, ``optimizer_steps`` and ``boundary``: every ``accumulate``-th step is an optimizer step."""
    w = Window.partitionBy(*group).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    log = log.withColumn("_n", F.row_number().over(w)).withColumn("boundary", F.pmod(F.col("_n"), F.lit(accumulate)) == 0).withColumn("optimizer_steps", F.floor(F.col("_n") / accumulate))
    for k, v in sums.items():
        log = log.withColumn(k, F.sum(v).over(w))
    return log.drop("_n")
