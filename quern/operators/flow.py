"""Interleaving, quotas, budgets, shuffles, splits, resume: sequential rules as ordinals and prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import rng
from quern.storage import bounded, prefix_sums, stored, up_to, with_positions


def active_sources(sources: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Enabled sources (null counts as enabled) whose id or name is asked for; no names ask for all."""
    s = sources.where(F.coalesce("enabled", F.lit(True)))
    return s.where(F.col("id").isin(*names) | F.col("name").isin(*names)) if names else s


def interleave(rows: DataFrame, sources: DataFrame, source_col: str, order: list[str], accepted: Column | None = None, per_source: int = 0, total: int = 0) -> DataFrame:
    """``rows`` with ``raw_index``, ``source_order`` and ``position``: what a round robin over the sources in their order takes.

    Each round takes one raw row per source; a row that isn't ``accepted`` uses up its turn.  A source's own ``max_records`` goes
    before ``per_source``, both count accepted rows, 0 is no limit; ``total`` limits all.  ``sources`` has id, source_order
    and max_records.  Rows of sources that aren't listed are left out.  ``order`` must be unique within a source.
    """
    spec = bounded(sources.select(F.col("id").alias("_id"), "source_order", F.col("max_records").alias("_own")))
    ok = F.coalesce(accepted if accepted is not None else F.lit(True), F.lit(False))
    keys = [source_col, *order]
    r = rows.select(*keys, ok.alias("_ok")).join(spec, F.col(source_col) == F.col("_id"))
    at = prefix_sums(r, order, [source_col], ["source_order", "_own", "_ok"], _accepted=F.col("_ok").cast("bigint"))
    quota = F.when(F.coalesce("_own", F.lit(0)) > 0, F.col("_own")).otherwise(F.lit(per_source))
    kept = at.where(F.col("_ok") & ((quota <= 0) | (F.col("_accepted") < quota))).select(*keys, "source_order", F.col("ordinal").alias("raw_index"))
    turn = ["raw_index", "source_order"]
    if total > 0:  # the limit has brought the rows to one task already
        kept = kept.orderBy(*turn).limit(total).withColumn("position", (F.row_number().over(Window.orderBy(*turn)) - 1).cast("bigint"))
    else:
        kept = with_positions(kept, prefix_sums(kept, turn).withColumnRenamed("ordinal", "position"), turn, "position")
    return with_positions(rows, kept, keys, "raw_index", "source_order", "position")


def budget_positions(df: DataFrame, order: list[str], tokens: Column, target: int, spent: int = 0) -> DataFrame:
    """(order, tokens_before) of the rows before the budget is reached; the row that crosses it is kept.  0 is no limit; ``spent`` counts first."""
    at = prefix_sums(df, order, tokens_before=tokens).drop("ordinal").withColumn("tokens_before", F.col("tokens_before") + spent)
    return at.where(F.col("tokens_before") < target) if target > 0 else at


def block_positions(df: DataFrame, order: list[str], n_blocks: Column, target: int) -> DataFrame:
    """(order, first_block, kept_blocks) of the records that are read until ``target`` blocks are written."""
    counted = stored(df.select(*order, n_blocks.alias("_n")))  # texts are tokenized once, not again for the ranges of the sort
    at = prefix_sums(counted, order, carried=["_n"], first_block=F.col("_n")).where(F.col("first_block") < target)
    return at.select(*order, "first_block", F.least("_n", F.lit(target) - F.col("first_block")).alias("kept_blocks"))


def token_budget(df: DataFrame, order: list[str], tokens: Column, target: int, spent: int = 0) -> DataFrame:
    """``df`` with ``tokens_before``, within the budget of ``budget_positions``.

    Only order and counts are sorted; rows beyond the budget are filtered where they are read."""
    return _within(df, budget_positions(df, order, tokens, target, spent), order, target, "tokens_before")


def block_budget(df: DataFrame, order: list[str], n_blocks: Column, target: int) -> DataFrame:
    """``df`` with ``first_block`` and ``kept_blocks``, within the budget of ``block_positions``."""
    return _within(df, block_positions(df, order, n_blocks, target), order, target, "first_block", "kept_blocks")


def _within(df: DataFrame, at: DataFrame, order: list[str], target: int, *columns: str) -> DataFrame:
    if target > 0:
        at = stored(at)
        df = up_to(df, order, at.orderBy(*[F.desc(o) for o in order]).first())
    return with_positions(df, at, order, *columns)


def seeded_shuffle(df: DataFrame, seed: int, *keys: str) -> DataFrame:
    """``df`` with ``position`` in a permutation that depends on the seed and keys only; only the keys are sorted."""
    k = df.select(rng.order_key(seed, *[F.col(k) for k in keys]).alias("_k"), *keys)
    return with_positions(df, prefix_sums(k, ["_k", *keys]).withColumnRenamed("ordinal", "position"), list(keys), "position")


def train_val_split(df: DataFrame, fraction: float, seed: int, *keys: str) -> DataFrame:
    """``df`` with ``split``: the first min(max(1, int(n * fraction)), n - 1) rows of a seeded permutation are ``val``; of one row none is.

    The last of them is found by its place among the keys; the rows themselves are only compared with it."""
    n = df.count()
    cut = min(max(1, int(n * fraction)), n - 1) if n > 1 else 0
    k = rng.order_key(seed, *[F.col(k) for k in keys])
    if cut == 0:
        return df.withColumn("split", F.lit("train"))
    at = prefix_sums(df.select(k.alias("_k"), *keys), ["_k", *keys])
    last = at.where(F.col("ordinal") == cut - 1).first()
    val = k < last["_k"]
    equal = k == last["_k"]
    for name in keys:
        v = F.lit(last[name]).cast(df.schema[name].dataType)
        val = val | (equal & (F.col(name) < v))
        equal = equal & (F.col(name) == v)
    return df.withColumn("split", F.when(F.coalesce(val | equal, F.lit(False)), "val").otherwise("train"))


def progress(output: DataFrame, order: list[str], tokens: str = "estimated_tokens", id_col: str = "id") -> DataFrame:
    """One row (records, estimated_tokens, source_index, last_record_id) recomputed from an output; the last id is the last that isn't empty; zeros for none."""
    last = F.max_by(F.col(id_col), F.when(F.coalesce(F.col(id_col), F.lit("")) != "", F.struct(*order)))
    a = output.agg(F.count("*").alias("records"), F.coalesce(F.sum(F.coalesce(tokens, F.lit(0))), F.lit(0)).alias("estimated_tokens"), last.alias("last_record_id"))
    return a.select("records", "estimated_tokens", F.col("records").alias("source_index"), "last_record_id")


def reconcile(saved: DataFrame, actual: DataFrame) -> DataFrame:
    """The saved progress row, replaced by the output's where records or tokens disagree, and ``reconciled_from_output``."""
    s, a = saved.select(F.struct(*actual.columns).alias("s")), actual.select(F.struct(*actual.columns).alias("a"))
    differs = ~(F.col("s.records").eqNullSafe(F.col("a.records")) & F.col("s.estimated_tokens").eqNullSafe(F.col("a.estimated_tokens")))
    return a.join(s, F.lit(True), "left").select(F.when(differs, F.col("a")).otherwise(F.col("s")).alias("p"), differs.alias("d")).select("p.*", F.col("d").alias("reconciled_from_output"))


def resume(todo: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key isn't done yet; rows with a null key are never done."""
    return todo.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def first_batches(df: DataFrame, order: list[str], size: int, batches: int) -> DataFrame:
    """The rows of the first ``batches`` batches of ``size`` rows in ``order``; 0 batches is no limit."""
    return df.orderBy(*order).limit(size * batches) if batches > 0 else df


def policy_filter(records: DataFrame, policy: str, avoid: list[str], source_col: str = "prompt_source") -> DataFrame:
    """Records whose metadata names the target policy and whose source isn't one to avoid; a null source isn't."""
    named = F.coalesce(F.col("metadata")["target_policy"] == policy, F.lit(False))
    return records.where(named & ~F.coalesce(F.col(source_col).isin(*avoid), F.lit(False)))


def counts_by(df: DataFrame, column: str, total: str = "(total)") -> DataFrame:
    """(column, records) with a row for the total; null is its own group ''."""
    g = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return df.select(g.alias(column)).rollup(column).agg(F.count("*").alias("records")).select(F.coalesce(column, F.lit(total)).alias(column), "records")
