import os

import numpy as np
import pytest

from quern.llm import packing as P
from quern.llm import tokens as T


def simple(sizes, capacity):
    """Sum of squares as defined, by trying every level."""
    levels, place = [], []
    for s in sizes:
        def cost(k):
            after = [*levels]
            if k == len(after):
                after.append(s)
            else:
                after[k] += s
            n = np.bincount([v for v in after if v < capacity], minlength=capacity)
            return int((n.astype(int) ** 2).sum())
        options = [k for k in range(len(levels)) if levels[k] < capacity and levels[k] + s <= capacity]
        best = min([cost(k) for k in options] + [cost(len(levels))])
        fit = [k for k in options if cost(k) == best]
        k = max(fit, key=lambda k: levels[k]) if fit else len(levels)
        if k == len(levels):
            levels.append(0)
        levels[k] += s
        place.append(k)
    return place, levels


@pytest.mark.parametrize("seed", range(4))
def test_pack_follows_the_sum_of_squares(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 13, 60)
    place, levels = P.pack(sizes, 12)
    want_place, want_levels = simple(sizes.tolist(), 12)
    assert sorted(levels.tolist()) == sorted(want_levels)  # containers of one level are alike
    assert np.bincount(place, weights=sizes).tolist() == levels.tolist() and max(levels) <= 12


def test_pack_is_tight():
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 257, 8000)
    first = P.pack(sizes, 256)
    place, levels = P.consolidate(sizes, *first, 256)
    assert sizes.sum() / (len(levels) * 256) > 0.975 and len(levels) < len(first[1])
    assert np.bincount(place, weights=sizes, minlength=len(levels)).tolist() == levels.tolist() and max(levels) <= 256


@pytest.mark.skipif(not os.path.exists(T.VOCABULARY), reason="no vocabulary here")
def test_documents_are_whole_and_fit(spark):
    texts = [None, "", "hi", "word " * 10, "word " * 33, "word " * 300, "word " * 64] * 9
    df = spark.createDataFrame([(k, t, "x", 3) for k, t in enumerate(texts)] + [(None, "x", "y", 1), (2, "hi", "z", 2)], "doc_id bigint, text string, container string, tokens int")
    caps = spark.createDataFrame([(1, "a", 32), (2, "b", 65), (3, "c", None), (4, "d", 0), (None, "e", 9)], "pack_id int, pack_name string, capacity_tokens int")
    rows = P.pack_documents(df, caps, shard_size=20).collect()
    count = T.Counter()
    for pack, capacity in ((1, 32), (2, 65)):
        mine = [r for r in rows if r["pack_id"] == pack]
        parts = {}
        level = {}
        for r in mine:
            parts.setdefault(r["doc_id"], []).append(r)
            level[r["container"]] = level.get(r["container"], 0) + r["tokens"]
        assert set(parts) == set(range(len(texts)))
        for k, ps in parts.items():
            n = count(texts[k])
            assert sum(p["tokens"] for p in ps) == n and sorted(p["part"] for p in ps) == list(range(1, len(ps) + 1))
            assert len(ps) == 1 if n <= capacity else len(ps) == -(-n // capacity)
        assert max(level.values()) <= capacity
        assert all(r["unused"] == capacity - level[r["container"]] for r in mine)
    assert {r["pack_id"] for r in rows} == {1, 2}
    s = {r["pack_id"]: r for r in P.containers(P.pack_documents(df, caps), caps).collect()}
    assert s[1]["containers"] * 32 == s[1]["tokens"] + s[1]["unused"] and s[1]["documents"] == len(texts)
    assert P.pack_documents(df.limit(0), caps).count() == 0 and P.pack_documents(df, caps.limit(0)).count() == 0
