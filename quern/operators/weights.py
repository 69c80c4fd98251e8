"""Matching of parameter inventories (key, shape, dtype) by name and shape, with coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Prefixes that are removed from a base key, the first match counts; head keys stay as they are.
BASE_PREFIXES = ("language_model.model.", "model.language_model.", "model.", "language_model.")
HEAD_PREFIX = "lm_head."
# Family of a target key by its prefix, and how much of the prefix is removed to find its source.
TARGET_FAMILIES = (
    ("model.encoder.language_model.", "text_encoder", "model.encoder.language_model."),
    ("model.encoder.vision_tower.", "vision_tower", "model.encoder."),
    ("model.encoder.embed_vision.", "vision_projector", "model.encoder."),
    ("model.encoder.audio_tower.", "audio_tower", "model.encoder."),
    ("model.encoder.embed_audio.", "audio_projector", "model.encoder."),
    ("model.decoder.", "diffusion_decoder", "model.decoder."),
)
HEAD, HEAD_FAMILY = "lm_head.weight", "lm_head"


def _key(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _first(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    out = F.when(*cases[0])
    for c, v in cases[1:]:
        out = out.when(c, v)
    return out.otherwise(otherwise)


def _after(key: Column, prefix: str) -> Column:
    return F.substring(key, len(prefix) + 1, 1_000_000)


def base_suffix(key: Column | str) -> Column:
    """Base key without the first matching prefix; head keys as they are; null where nothing matches."""
    key = _key(key)
    return _first([(key.startswith(p), _after(key, p)) for p in BASE_PREFIXES] + [(key.startswith(HEAD_PREFIX), key)], F.lit(None).cast("string"))


def target_suffix(key: Column | str) -> Column:
    """What a target key's source is called; null for keys of no family."""
    key = _key(key)
    return _first([(key.startswith(p), _after(key, cut)) for p, _, cut in TARGET_FAMILIES] + [(key == HEAD, key)], F.lit(None).cast("string"))


def family(key: Column | str) -> Column:
    key = _key(key)
    return _first([(key.startswith(p), F.lit(f)) for p, f, _ in TARGET_FAMILIES] + [(key == HEAD, F.lit(HEAD_FAMILY))], F.lit("unsupported"))


def match(base: DataFrame, target: DataFrame) -> DataFrame:
    """(key, family, suffix, shape, source, source_shape, status): each target key of a family with the base key whose suffix is equal.

    Of base keys with one suffix the last counts: by the column ``ord`` where the base has one, else by key.  Without a match: ``experts.gate_up_proj`` takes the gate and up
    projections stacked, ``experts.down_proj`` the down projection, router scales are initialised.  status: copied,
    composed, initialised, shape_mismatch or missing_source.
    """
    last = F.struct("ord", "key") if "ord" in base.columns else F.struct("key")
    b = base.where("key is not null").withColumn("suffix", base_suffix("key")).where("suffix is not null").groupBy("suffix").agg(F.max_by("key", last).alias("source"), F.max_by("shape", last).alias("source_shape"))
    t = target.where("key is not null").select("key", "shape", family("key").alias("family"), target_suffix("key").alias("suffix")).where("suffix is not null")
    stem = F.regexp_extract("suffix", r"^(.*?)\.experts\.(?:gate_up_proj|down_proj)", 1)
    fused, down = F.col("suffix").contains(".experts.gate_up_proj"), F.col("suffix").contains(".experts.down_proj")
    t = t.withColumn("_gate", F.when(fused, F.concat(stem, F.lit(".mlp.gate_proj.weight"))).when(down, F.concat(stem, F.lit(".mlp.down_proj.weight")))).withColumn("_up", F.when(fused, F.concat(stem, F.lit(".mlp.up_proj.weight"))))
    j = t.join(b, "suffix", "left")
    for n in ("gate", "up"):
        j = j.join(b.select(F.col("suffix").alias(f"_{n}"), F.col("source").alias(f"_{n}_key"), F.col("source_shape").alias(f"_{n}_shape")), f"_{n}", "left")
    tail = lambda c: F.slice(c, 2, 100)
    stacked = F.concat(F.array(F.lit(1), F.get("_gate_shape", F.lit(0)) + F.get("_up_shape", F.lit(0))), tail(F.col("_gate_shape")))
    composed = F.when(fused & F.col("_gate_key").isNotNull() & F.col("_up_key").isNotNull(), stacked).when(down & F.col("_gate_key").isNotNull(), F.concat(F.array(F.lit(1)), F.col("_gate_shape")))
    have = F.coalesce("source_shape", composed)
    router = F.col("suffix").rlike(r"\.router\.(?:per_expert_scale|proj\.weight)$")
    status = (
        F.when(F.col("source").isNotNull() & F.col("source_shape").eqNullSafe(F.col("shape")), "copied").when(F.col("source").isNotNull(), "shape_mismatch")
        .when(composed.isNotNull() & composed.eqNullSafe(F.col("shape")), "composed").when(composed.isNotNull(), "shape_mismatch").when(router, "initialised").otherwise("missing_source")
    )
    source = F.coalesce("source", F.when(composed.isNotNull(), F.concat_ws("+", "_gate_key", "_up_key")))
    return j.select("key", "family", "suffix", "shape", source.alias("source"), have.alias("source_shape"), status.alias("status"))


def coverage(matched: DataFrame) -> DataFrame:
    """(family, target, copied, missing, mismatched, ratio, fully_copied) per family; ratio to six digits, half to even."""
    got = F.col("status").isin("copied", "composed", "initialised")
    g = matched.groupBy("family").agg(F.count("*").alias("target"), F.count_if(got).alias("copied"), F.count_if(F.col("status") == "missing_source").alias("missing"), F.count_if(F.col("status") == "shape_mismatch").alias("mismatched"))
    return g.withColumn("ratio", F.bround(F.col("copied") / F.nullif("target", F.lit(0)), 6)).withColumn("fully_copied", F.col("copied") == F.col("target"))


def load_differences(state: DataFrame, model: DataFrame) -> DataFrame:
    """(key, difference): keys the model lacks in the state (missing) and keys the state has beside it (unexpected)."""
    a = model.select("key").join(state.select("key"), "key", "left_anti").withColumn("difference", F.lit("missing"))
    return a.unionByName(state.select("key").join(model.select("key"), "key", "left_anti").withColumn("difference", F.lit("unexpected")))


def flags(report: DataFrame) -> DataFrame:
    """One row: for image and audio, whether the target has both their tower and projector, and whether both are complete."""
    has = lambda f: F.coalesce(F.bool_or((F.col("family") == f) & (F.col("target") > 0)), F.lit(False))
    full = lambda f: F.coalesce(F.bool_or((F.col("family") == f) & F.col("fully_copied")), F.lit(False))
    out = []
    for name, a, b in (("image_text", "vision_tower", "vision_projector"), ("audio_text", "audio_tower", "audio_projector")):
        out += [(has(a) & has(b)).alias(f"{name}_target_present"), (full(a) & full(b)).alias(f"{name}_fully_copied")]
    return report.agg(*out)


def problems(report: DataFrame, differences: DataFrame | None = None) -> DataFrame:
    """One row with the list of what forbids an export: missing sources, shape mismatches, keys that a load would miss or not expect, and
    towers that are there but incomplete."""
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    r = report.agg(count("missing").alias("missing"), count("mismatched").alias("mismatched")).join(flags(report), F.lit(True))
    d = differences.agg(F.count_if(F.col("difference") == "missing").alias("lm"), F.count_if(F.col("difference") == "unexpected").alias("lu")) if differences is not None else report.agg(F.lit(0).alias("lm"), F.lit(0).alias("lu"))
    named = [("missing_source_count", "missing"), ("shape_mismatch_count", "mismatched"), ("load_missing_count", "lm"), ("load_unexpected_count", "lu")]
    parts = [F.when(F.col(c) > 0, F.concat(F.lit(f"{n}="), F.col(c).cast("string"))) for n, c in named]
    parts += [F.when(F.col(f"{n}_target_present") & ~F.col(f"{n}_fully_copied"), F.lit(f"{n}_partial_copy")) for n in ("image_text", "audio_text")]
    return r.join(d, F.lit(True)).select(F.array_compact(F.array(*parts)).alias("problems"))


def memory_floor(parameters: Column, bytes_per_parameter: float) -> Column:
    """GiB to two digits that the weights alone take."""
    return F.bround(parameters * bytes_per_parameter / float(1 << 30), 2)


def activation_floor(layers: Column, hidden: Column, length: int = 256, bytes_per_value: int = 2, copies: int = 8) -> Column:
    """GiB to two digits that the activations of one sequence take."""
    return F.bround(layers * hidden * float(length * bytes_per_value * copies) / float(1 << 30), 2)


def ordered_first(df: DataFrame, group: str, order: str) -> DataFrame:
    """The first candidate per group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(order))).where("_n = 1").drop("_n")
