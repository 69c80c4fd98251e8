"""Token blocks, prefixes, noise, shards and their verification."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import arrays
from quern.storage import prefix_sums, with_positions


# Fixed value: the pattern that splits text before the merges of byte-pair rank files.
GPT2_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenized(df: DataFrame, text: str, out: str, make_tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]]) -> DataFrame:
    """``df`` with the array column ``out``: ids of ``text`` by a tokenizer that each task makes once and feeds in batches; null texts give no ids."""
    schema = df.drop(out)
    fields = T.StructType([*schema.schema.fields, T.StructField(out, T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_tokenizer()
        for b in batches:
            ids = encode([t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.list_(pa.int64()))], [*b.schema.names, out])

    return schema.mapInArrow(run, fields)


def rank_file_tokenizer(path: str, pattern: str = GPT2_SPLIT) -> Callable[[], Callable[[list[str]], list[list[int]]]]:
    """Tokenizer of a byte-pair rank file (base64 piece and rank per line), to be made once per task; the path is read where tasks run."""

    def make() -> Callable[[list[str]], list[list[int]]]:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary_batch

    return make


FEATURES = ("pixel_values", "input_features", "input_features_mask", "image_position_ids", "mm_token_type_ids")  # fixed values: media features that shards hold


def encoder_inputs(df: DataFrame, id_col: str, text: str, media: str | None, prefix: int, pad: int, make_tokenizer: Callable, make_processor: Callable | None = None) -> DataFrame:
    """(id, prefix_ids, attention_mask, prefix_lens, features): what an encoder gets of each record.

    Records whose ``media`` (a column that is null without media) is null are tokenized, cut to their last ``prefix`` ids and padded on the left.  Others go to the
    processor, ``(text, media row) -> dict`` of input_ids, attention_mask and feature arrays; ids of another length than ``prefix`` are cut and padded alike.
    ``features`` is an array of (name, shape, values) of the known features, empty for text.  A processor's error names its record.
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, prefix_ids array<bigint>, attention_mask array<bigint>, prefix_lens bigint, features array<struct<name:string,shape:array<int>,values:array<float>>>"

    def padded(ids: list[int]) -> tuple[list[int], list[int], int]:
        ids = list(ids)[-prefix:] if prefix else []
        gap = prefix - len(ids)
        return [pad] * gap + ids, [0] * gap + [1] * len(ids), len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, process = make_tokenizer(), make_processor() if make_processor else None
        out_schema = None
        for b in batches:
            rows = []
            for key, t, m in zip(*(b.column(k).to_pylist() for k in range(3))):
                if m is None:
                    rows.append((key, *padded(encode([t or ""])[0]), []))
                    continue
                try:
                    got = {k: np.asarray(v) for k, v in process(t or "", m).items()}
                except Exception as e:
                    raise RuntimeError(f"media of record {key} can't be processed") from e
                got = {k: v[0] if v.ndim > 1 and len(v) == 1 else v for k, v in got.items()}
                ids, mask = got["input_ids"].astype(int).tolist(), got.get("attention_mask")
                mask = mask.astype(int).tolist() if mask is not None else [1] * len(ids)
                ids, mask, n = (ids, mask, sum(mask)) if len(ids) == prefix else padded(ids)
                rows.append((key, ids, mask, n, [{"name": k, "shape": list(got[k].shape), "values": got[k].astype(np.float32).ravel().tolist()} for k in FEATURES if k in got]))
            out_schema = out_schema or pa.schema([
                pa.field(id_col, b.schema.field(0).type), pa.field("prefix_ids", pa.list_(pa.int64())), pa.field("attention_mask", pa.list_(pa.int64())), pa.field("prefix_lens", pa.int64()),
                pa.field("features", pa.list_(pa.struct([("name", pa.string()), ("shape", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))]))),
            ])
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out_schema)], schema=out_schema)

    return df.select(id_col, text, F.col(media) if media else F.lit(None).cast("string").alias("_media")).mapInArrow(run, schema)


def signature_of(features: Column | str) -> Column:
    """Signature of ``features`` as ``encoder_inputs`` gives them: their names and shapes, the values aside."""
    return arrays.signature(F.transform(F.col(features) if isinstance(features, str) else features, lambda f: F.struct(f["name"], f["shape"])))


def target_blocks(df: DataFrame, ids: Column | str, length: int, keep: list[str]) -> DataFrame:
    """(keep, block, target_ids): one row per block; the prefix stays on the record, to be joined after."""
    return df.select(*keep, F.posexplode(arrays.blocks(ids, length)).alias("block", "target_ids"))


def corrupted(blocks: DataFrame, vocabulary: int, pad: int, seed: int, keys: list[str]) -> DataFrame:
    """Blocks with noise_t, corruption_masks and corrupted_ids, a function of seed and keys alone."""
    n = arrays.noise("target_ids", vocabulary, pad, seed, *[F.col(k) for k in keys])
    return blocks.withColumn("_n", n).select("*", F.col("_n.noise_t").cast("float").alias("noise_t"), F.col("_n.mask").alias("corruption_masks"), F.col("_n.ids").alias("corrupted_ids")).drop("_n")


def shards(blocks: DataFrame, order: list[str], size: int, signature: str = "signature", family: str = "family") -> DataFrame:
    """``blocks`` with ``shard_id``, counted per family: a signature's buffer is written when it holds ``size`` blocks; what is left at the
    end is written in the order in which the signatures were first seen.  ``order`` is unique; only it, the signature and the family are sorted."""
    keys = blocks.select(signature, family, *order)
    b = prefix_sums(keys, order, [signature], [family]).withColumn("_q", F.floor(F.col("ordinal") / size))
    at = F.struct(*order)
    part = b.groupBy(family, signature, "_q").agg(F.count("*").alias("_n"), F.max(at).alias("_last"))
    seen = b.groupBy(signature).agg(F.min(at).alias("_first")).withColumnRenamed(signature, "_seen")
    part = part.join(seen, F.col(signature).eqNullSafe(F.col("_seen")))
    # one row per shard from here on: full ones in the order of their last block, then what is left
    full = F.col("_n") == size
    part = part.select(family, signature, "_q", F.when(full, 0).otherwise(1).alias("_tail"), F.when(full, F.col("_last")).otherwise(F.col("_first")).alias("_at"))
    ids = prefix_sums(part, ["_tail", "_at"], [family], [signature, "_q"]).withColumnRenamed("ordinal", "shard_id")
    b = with_positions(b.select(family, signature, "_q", *order), ids, [family, signature, "_q"], "shard_id")
    return with_positions(blocks, b, [*order, signature, family], "shard_id")


def verify_shards(rows: DataFrame, length: int, min_blocks: int = 0) -> DataFrame:
    """One row (shards, blocks, target_length_ok, same_length_ok, enough)."""
    ok = lambda c: F.coalesce(F.bool_and(F.coalesce(c, F.lit(False))), F.lit(True))
    return rows.agg(
        F.countDistinct("family", "shard_id").alias("shards"), F.count("*").alias("blocks"), ok(F.size("target_ids") == length).alias("target_length_ok"),
        ok(F.size("target_ids") == F.size("corrupted_ids")).alias("same_length_ok"), (F.count("*") >= min_blocks).alias("enough"),
    )


def collate(rows: DataFrame, batch: str, features: list[str]) -> DataFrame:
    """(batch, rows, keys): the features that every row of a batch has."""
    every = [F.when(F.bool_and(F.col(f).isNotNull()), F.lit(f)) for f in features]
    return rows.groupBy(batch).agg(F.count("*").alias("rows"), F.array_compact(F.array(*every)).alias("keys"))


def stacked(rows: DataFrame, batch: str, order: str, features: list[str]) -> DataFrame:
    """(batch, rows, features): per feature the values of a batch's rows in their order, null where a row has none.  A batch is a few rows by definition."""
    n = F.count("*")
    values = [F.when(F.count(f) == n, F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(f).alias("v")))), lambda x: x["v"])).alias(f) for f in features]
    return rows.groupBy(batch).agg(n.alias("rows"), *values)


def corruption_totals(rows: DataFrame, record: str = "id", family: str = "family") -> DataFrame:
    """One row (records_read, blocks_written, shards, shard_families): records with a block, blocks, shards, and shards per family as a map."""
    per = rows.groupBy(family).agg(F.countDistinct("shard_id").alias("n"), F.count("*").alias("b"))
    families = per.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(family, "n")))).alias("shard_families"), F.coalesce(F.sum("b"), F.lit(0)).alias("blocks_written"), F.coalesce(F.sum("n"), F.lit(0)).alias("shards"))
    records = rows.agg(F.countDistinct(record).alias("records_read"))
    return records.join(families, F.lit(True)).select("records_read", "blocks_written", "shards", "shard_families")
