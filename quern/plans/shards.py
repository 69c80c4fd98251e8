"""Teacher records to noised block shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import arrays
from quern.functions.text import prefix_text
from quern.operators.blocks import corrupted, shards, target_blocks, tokenized
from quern.operators.flow import block_positions, seeded_shuffle
from quern.storage import stored, with_positions


def build_shards(
    records: DataFrame, target_blocks_n: int = 200_000, canvas: int = 256, prefix: int = 512, shard_blocks: int = 4096, seed: int = 1337, record_order: str = "shuffled",
    vocabulary: int = 262_144, pad: int = 0, id_col: str = "id", encode=arrays.hash_tokens, signature: Column | None = None, family: Column | None = None,
    make_tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]] | None = None,
) -> DataFrame:
    """Rows of shards: id, block, prefix_ids, prefix_lens, target_ids, corrupted_ids, corruption_masks, noise_t, family, signature, shard_id.

    Records are taken in a seeded order (or by id for ``source``) until ``target_blocks_n`` blocks are reached.  Tokens come from
    ``make_tokenizer`` where given, which each task calls once, else from the expression ``encode``.  The budget and the shards are decided on
    numbers of blocks alone; ids are made once for the records within the budget, and noise last, when blocks are written.
    ids must be unique and not null; null texts have no blocks.
    """
    order = ["position", id_col]
    r = records.where(F.col(id_col).isNotNull())
    keys = r.select(id_col)
    at = seeded_shuffle(keys, seed, id_col) if record_order != "source" else keys.withColumn("position", F.col(id_col))
    both = lambda df: _encoded(df, encode, make_tokenizer)
    sized = both(r.select(id_col, F.col("text").alias("_target"))).select(id_col, F.ceil(F.size("_target_ids") / canvas).alias("n"))
    sized = block_positions(with_positions(sized, at, [id_col], "position"), order, F.col("n"), target_blocks_n)
    sized = stored(sized.where("kept_blocks > 0").select(id_col, "position", "kept_blocks"))
    blocks = sized.select(id_col, "position", F.explode(F.sequence(F.lit(0), F.col("kept_blocks").cast("int") - 1)).alias("block"))
    kinds = r.select(id_col, (signature if signature is not None else F.lit("text")).alias("signature"), (family if family is not None else F.lit("text")).alias("family"))
    placed = shards(blocks.join(kinds, id_col), [*order, "block"], shard_blocks).drop("position")
    wide = both(r.join(sized.select(id_col, "kept_blocks"), id_col).select(id_col, "kept_blocks", F.col("text").alias("_target"), prefix_text("prompt_text", "context_text").alias("_prefix")))
    wide = wide.withColumn("prefix_lens", F.least(F.size("_prefix_ids"), F.lit(prefix))).withColumn("prefix_ids", arrays.left_pad("_prefix_ids", prefix, pad))
    b = target_blocks(wide, "_target_ids", canvas, [id_col, "kept_blocks", "prefix_ids", "prefix_lens"]).where("block < kept_blocks").drop("kept_blocks")
    return corrupted(b.join(placed, [id_col, "block"]), vocabulary, pad, seed, [id_col, "block"])


def _encoded(df: DataFrame, encode, make_tokenizer) -> DataFrame:
    """``df`` with ``_target_ids``, and ``_prefix_ids`` where it has a ``_prefix``, in place of the texts."""
    for c in ("_target", "_prefix"):
        if c in df.columns:
            df = (tokenized(df, c, f"{c}_ids", make_tokenizer) if make_tokenizer is not None else df.withColumn(f"{c}_ids", encode(c))).drop(c)
    return df
