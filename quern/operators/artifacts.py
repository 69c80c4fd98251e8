"""Checks of stored artifacts and of settings: small tables of names, texts and key-value pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Files that a complete model folder has.
CONFIG, TOKENIZERS, WEIGHTS = "config.json", ("tokenizer.json", "tokenizer.model"), ("model.safetensors", "adapter_model.safetensors", "pytorch_model.bin")
# The text settings that are kept.
TEXT_SETTINGS = (
    "vocab_size", "hidden_size", "intermediate_size", "num_hidden_layers", "num_attention_heads", "num_key_value_heads", "head_dim", "hidden_activation", "max_position_embeddings",
    "initializer_range", "rms_norm_eps", "pad_token_id", "eos_token_id", "bos_token_id", "tie_word_embeddings", "rope_parameters", "attention_bias", "attention_dropout",
    "sliding_window", "layer_types", "num_global_key_value_heads", "global_head_dim", "num_experts", "top_k_experts", "moe_intermediate_size", "final_logit_softcapping",
)
# Token ids of a configuration that names none.
TOKEN_IDS = {"boi_token_id": 255999, "eoi_token_id": 258882, "image_token_id": 258880, "boa_token_id": 256000, "eoa_token_index": 258883, "audio_token_id": 258881}


def artifact_report(files: DataFrame, path: str = "path", by: tuple[str, ...] = ()) -> DataFrame:
    """One row (exists, has_config, has_tokenizer, has_weights) from the names of a folder's files, or one per value of ``by``; sharded weights count."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    any_of = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    return files.groupBy(*by).agg(
        (F.count("*") > 0).alias("exists"), any_of(name == CONFIG).alias("has_config"), any_of(name.isin(*TOKENIZERS)).alias("has_tokenizer"),
        any_of(name.isin(*WEIGHTS) | name.rlike(r"^model-.*\.safetensors$")).alias("has_weights"),
    )


def text_checks(files: DataFrame, checks: dict[str, tuple[str, list[str]]], path: str = "path", text: str = "text", by: tuple[str, ...] = ()) -> DataFrame:
    """One row with a flag per check, or one per value of ``by``: whether the file whose path ends as given contains all of the texts."""

    def flag(suffix: str, needles: list[str]) -> Column:
        ok = F.col(path).endswith(suffix)
        for n in needles:
            ok = ok & F.col(text).contains(n)
        return F.coalesce(F.bool_or(ok), F.lit(False))

    return files.groupBy(*by).agg(*[flag(*c).alias(k) for k, c in checks.items()])


def text_settings(settings: Column) -> Column:
    """map<string,string> of the settings that are kept, with forced and default values: a dense model is one expert, global heads are the key-value heads."""
    kept = F.map_filter(settings, lambda k, v: k.isin(*TEXT_SETTINGS) & v.isNotNull())
    get = lambda k: F.try_element_at(kept, F.lit(k))
    put = lambda name, v: F.when(v.isNotNull(), F.map_from_arrays(F.array(F.lit(name)), F.array(v))).otherwise(F.create_map().cast("map<string,string>"))
    dense = get("num_experts").isNull()
    forced = {
        "use_bidirectional_attention": F.lit("all"), "final_logit_softcapping": F.coalesce(get("final_logit_softcapping"), F.lit("30.0")),
        "num_experts": F.coalesce(get("num_experts"), F.lit("1")), "top_k_experts": F.when(dense, F.lit("1")).otherwise(get("top_k_experts")),
        "moe_intermediate_size": F.when(dense, get("intermediate_size")).otherwise(get("moe_intermediate_size")),
        "num_global_key_value_heads": F.coalesce(get("num_global_key_value_heads"), get("num_key_value_heads")),
    }
    return F.map_concat(F.map_filter(kept, lambda k, v: ~k.isin(*forced)), *[put(k, v) for k, v in forced.items()])


def token_ids(settings: Column) -> Column:
    """struct of the special token ids, with defaults for those a configuration doesn't name."""
    return F.struct(*[F.coalesce(F.try_element_at(settings, F.lit(k)).cast("int"), F.lit(v)).alias(k) for k, v in TOKEN_IDS.items()])


def within_memory(vram_gib: Column, recommended_gib: float = 80) -> Column:
    return vram_gib >= recommended_gib
