"""Array expressions: blocks, padding, masks, scores.  Higher-order functions, no Python per row."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions import rng

NO_LABEL = -100


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` evaluated once, also where ``f`` uses it inside of a lambda."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def hash_tokens(text: Column | str, vocabulary: int = 262_144) -> Column:
    """Deterministic stand-in for a tokenizer: one id per blank-separated word, from md5."""
    words = F.filter(F.split(F.coalesce(_c(text), F.lit("")), " "), lambda w: w != "")
    return F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("bigint") % vocabulary)


def blocks(ids: Column | str, length: int) -> Column:
    """The ids in blocks of ``length``, the last one padded with -100; empty or null ids have none."""

    def made(ids: Column) -> Column:
        n = F.size(ids)
        at = F.when(n > 0, F.sequence(F.lit(0), F.ceil(n / length).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: right_pad(F.slice(ids, i * length + 1, length), length))

    return let(F.coalesce(_c(ids), F.array().cast("array<bigint>")), made)


def right_pad(ids: Column, length: int, pad: int = NO_LABEL) -> Column:
    return let(ids, lambda x: F.concat(x, F.array_repeat(F.lit(pad).cast("bigint"), F.greatest(F.lit(length) - F.size(x), F.lit(0)))))


def left_pad(ids: Column | str, length: int, pad: int = 0) -> Column:
    """The last ``length`` ids, padded on the left."""
    kept = lambda ids: F.slice(ids, F.greatest(F.size(ids) - length, F.lit(0)) + 1, length)
    return let(_c(ids), lambda ids: F.concat(F.array_repeat(F.lit(pad).cast("bigint"), F.lit(length) - F.size(kept(ids))), kept(ids)))


def attention_mask(n: Column | str, length: int) -> Column:
    """Ones on the last ``n`` of ``length`` positions."""
    n = F.least(F.greatest(_c(n), F.lit(0)), F.lit(length))
    return F.concat(F.array_repeat(F.lit(0), (F.lit(length) - n).cast("int")), F.array_repeat(F.lit(1), n.cast("int")))


def noise(target: Column | str, vocabulary: int, pad: int, seed: int, *keys: Column) -> Column:
    """struct<noise_t, mask, ids> of a target block: t in [0.05, 0.95); each label is masked with probability t and then replaced by
    a random id, which may be the same one; positions without label get ``pad``."""
    target = _c(target)

    def made(t: Column) -> Column:
        # one digest per position: its first digits decide, the next ones give the id; null where a position isn't masked
        def drawn(head: Column) -> Column:
            at = lambda d: F.when(rng.unit(d) < t, rng.second(d) % vocabulary)
            return F.transform(target, lambda x, i: F.when(x >= 0, let(F.md5(F.concat(head, i.cast("string"))), at)))

        ids = lambda v: F.transform(target, lambda x, i: F.coalesce(F.get(v, i), F.when(x < 0, F.lit(pad).cast("bigint")).otherwise(x)))
        masks = lambda v: F.transform(v, lambda y: y.isNotNull())
        return let(let(rng.head(seed, "n", *keys), drawn), lambda v: F.struct(t.alias("noise_t"), masks(v).alias("mask"), ids(v).alias("ids")))

    return let(F.lit(0.05) + F.lit(0.9) * rng.uniform(seed, "t", *keys), made)


def random_ids(length: int, vocabulary: int, seed: int, *keys: Column) -> Column:
    """A canvas of random ids."""
    return F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: rng.below(vocabulary, seed, "c", *keys, i))


def scaled(z: Column | str, temperature: float = 1.0) -> Column:
    return F.transform(_c(z), lambda x: x.cast("double") / F.lit(max(temperature, 1e-6)))


def log_sum_exp(z: Column) -> Column:
    """Shifted by the maximum, so large scores don't overflow."""
    return let(z, lambda z: let(F.array_max(z), lambda m: m + F.ln(F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp(x - m)))))


def entropy(z: Column | str, temperature: float = 1.0) -> Column:
    """Entropy in nats of softmax(z / temperature); null for null or empty scores."""
    made = lambda z: let(log_sum_exp(z), lambda e: -F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp(x - e) * (x - e)))
    return F.when(F.size(_c(z)) > 0, let(scaled(z, temperature), made))


def cross_entropy(z: Column | str, label: Column | str) -> Column:
    """-log softmax(z)[label]; null where the label is missing, negative or out of range."""
    label = _c(label)
    return F.when((label >= 0) & (label < F.size(_c(z))), let(scaled(z), lambda z: log_sum_exp(z) - F.get(z, label)))


def argmax(z: Column | str) -> Column:
    """0-based index of the largest value, the first one on ties."""
    z = _c(z)
    return F.array_position(z, F.array_max(z)) - 1


def argmin(z: Column | str) -> Column:
    z = _c(z)
    return F.array_position(z, F.array_min(z)) - 1


def softcap(x: Column | str, cap: float) -> Column:
    return F.lit(cap) * F.tanh(_c(x) / F.lit(cap))


def placeholder_mask(ids: Column | str, token: int) -> Column:
    return F.transform(_c(ids), lambda x: x == token)


def fill_placeholders(ids: Column | str, token: int, values: Column | str) -> Column:
    """Values in order at the placeholders; null where the counts differ."""

    def run(ids: pd.Series, values: pd.Series) -> pd.Series:
        out = []
        for x, v in zip(ids, values):
            at = np.flatnonzero(np.asarray(x) == token) if x is not None and v is not None else ()
            if x is None or v is None or len(at) != len(v):
                out.append(None)
                continue
            x = np.array(x)
            x[at] = v
            out.append(x)
        return pd.Series(out, dtype=object)

    # a running count in an array function would read the array once per position
    return F.pandas_udf(run, "array<bigint>")(_c(ids), _c(values))


def position_ids(n: Column | str, past: Column | int = 0) -> Column:
    n, past = _c(n), past if isinstance(past, Column) else F.lit(past)
    return F.when(n > 0, F.sequence(past, past + n - 1)).otherwise(F.array().cast("array<int>"))


def commit_canvas(done: Column | str, canvas: Column | str, remaining: Column | int) -> Column:
    """The committed ids and the first min(canvas, remaining) ids of the canvas."""
    canvas = _c(canvas)
    r = remaining if isinstance(remaining, Column) else F.lit(remaining)
    return F.concat(_c(done), F.slice(canvas, 1, F.greatest(F.least(F.size(canvas), r), F.lit(0))))


def mono(frames: Column | str) -> Column:
    """Mean over channels of array<array<double>> frames."""
    return F.transform(_c(frames), lambda f: F.aggregate(f, F.lit(0.0), lambda a, x: a + x) / F.size(f))


def signature(features: Column | str) -> Column:
    """Hash of the (name, shape, type) of present features, independent of their order."""
    return F.sha2(F.to_json(F.array_sort(_c(features))), 256)


def family(names: Column | str) -> Column:
    """text without features; audio before image; image; else multimodal."""
    n = _c(names)
    return (
        F.when(n.isNull() | (F.size(n) == 0), "text").when(F.array_contains(n, "input_features"), "audio").when(F.array_contains(n, "pixel_values"), "image").otherwise("multimodal")
    )
