import itertools
import random

import pandas as pd
import regex
from pyspark.sql import functions as F

from quern.llm import neardup as N

WORDS = [f"w{k}" for k in range(400)]


def words(text):
    return regex.findall(r"[\p{L}\p{N}]+", text.lower())


def brute(texts, size, threshold):
    sets = {}
    for i, t in texts.items():
        w = words(t or "")
        if w:
            sets[i] = {" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))}
    group = {i: i for i in sets}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            group[top(a)] = top(b)
    return {tuple(sorted((a, b))) for a, b in itertools.combinations(sets, 2) if top(a) == top(b)}


def corpus(seed, families=25, copies=6):
    rnd = random.Random(seed)
    out, n = {}, 0
    for _ in range(families):
        base = [rnd.choice(WORDS) for _ in range(rnd.randrange(8, 60))]
        for _ in range(rnd.randrange(1, copies)):
            w = list(base)
            for _ in range(rnd.randrange(0, 4)):
                k = rnd.randrange(len(w))
                w[k : k + 1] = rnd.choice([[], [rnd.choice(WORDS)], [w[k], rnd.choice(WORDS)]])
            out[f"d{n:03d}"] = rnd.choice([" ", ",  "]).join(w)
            n += 1
    return out | {"null": None, "blank": " .. ", "one": "w1", "one2": "W1!", "two": "w1 w2"}


def pairs(spark, texts, **kw):
    df = spark.createDataFrame(list(texts.items()) + [next(iter(texts.items())), (None, "w1 w2 w3")], "id string, t string").withColumn("group_id", F.lit(1)).withColumn("sig", F.lit(2))
    g = N.near_duplicates(df, "id", F.col("t"), **kw)
    return {(r["id_a"], r["id_b"]) for r in N.group_pairs(g).collect()}


def test_groups_equal_brute_force(spark):
    for seed, size, threshold in ((1, 3, 0.5), (2, 5, 0.8)):
        texts = corpus(seed)
        assert pairs(spark, texts, shingle=size, threshold=threshold) == brute(texts, size, threshold)


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "SMALL", 2)
    monkeypatch.setattr(N, "BLOCK", 3)
    texts = corpus(3, families=8, copies=14)
    assert pairs(spark, texts, shingle=3, threshold=0.5) == brute(texts, 3, 0.5)


def featured(texts, size=3):
    """Rows as the stage of blocks gets them, of word lists."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([" ".join(t) for t in texts])], ["text_id", "t"])
    df = pd.concat(x.to_pandas() for x in N._features(size, 42, 3)(iter([batch])))
    return df.assign(component=df["text_id"])


def blocks_links(df, blocks):
    return set(map(tuple, N._block_links(3, 0.5, 126)(df.assign(block=blocks)).to_numpy().tolist()))


def test_blocks_keep_links_of_texts_cut_from_both_ends():
    base = [f"w{k}" for k in range(102)]
    texts = [base[:-27], base[27:], base]
    sets = [set(zip(t, t[1:], t[2:])) for t in texts]
    assert [round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 2) for a, b in ((0, 2), (1, 2), (0, 1))] == [0.73, 0.73, 0.46]
    df = featured(texts)
    for blocks in ([0, 0, 1], [1, 1, 0], [0, 0, 0]):
        assert blocks_links(df, blocks) == {(0, 2), (1, 2)}
    assert blocks_links(df, [0, 1, 0]) == {(1, 2)}


def test_blocks_join_a_family_by_few_verified_links():
    rnd = random.Random(2)
    bases = [[rnd.choice(WORDS) for _ in range(60)] for _ in range(4)]
    texts = []
    for k in range(120):
        t = list(bases[k % 4])
        t[rnd.randrange(60)] = f"x{k}"
        texts.append(t)
    df = featured(texts)
    got = blocks_links(df, [k // 60 for k in range(120)])
    assert len(got) == 116 and all(a % 4 == b % 4 and a // 60 != b // 60 for a, b in got)
    assert blocks_links(df.assign(component=df["text_id"] % 4), [k // 60 for k in range(120)]) == set()


def test_sketches_agree_as_often_as_texts_are_similar():
    rnd = random.Random(6)
    base = [rnd.choice(WORDS) for _ in range(300)]
    df = featured([base, base[:200] + [f"x{k}" for k in range(100)], [f"y{k}" for k in range(300)]])
    import numpy as np

    x = np.stack(df["sketch"].to_numpy()).view(np.uint64)
    agree = lambda a, b: 126 - int(np.bitwise_count((x[a] ^ x[b])[:2] | (x[a] ^ x[b])[2:]).sum())
    assert agree(0, 0) == 126 and agree(0, 1) > N.least_agreement(0.5, 126) > agree(0, 2)


def test_the_blocks_of_a_hot_family_and_its_bridge(spark, monkeypatch):
    """A family, another one, and texts between the two, in buckets that are cut into many blocks."""
    monkeypatch.setattr(N, "SMALL", 3)
    monkeypatch.setattr(N, "BLOCK", 4)
    rnd = random.Random(11)
    base = [rnd.choice(WORDS) for _ in range(90)]
    other = base[:45] + [f"z{k}" for k in range(45)]
    texts = {}
    for k in range(40):
        t = list(base if k % 2 else other)
        t[rnd.randrange(90)] = f"x{k}"
        texts[f"d{k:02d}"] = " ".join(t)
    assert pairs(spark, texts, shingle=3, threshold=0.5) == brute(texts, 3, 0.5)
    texts["bridge"] = " ".join(base[:45] + base[45:68] + [f"z{k}" for k in range(23)])
    want = brute(texts, 3, 0.5)
    assert len(want) == 41 * 20 and pairs(spark, texts, shingle=3, threshold=0.5) == want


def test_every_record_has_a_class(spark):
    texts = corpus(4)
    df = spark.createDataFrame(list(texts.items()), "id string, t string")
    g = N.near_duplicates(df, "id", F.col("t"), shingle=3, threshold=0.5).collect()
    assert {r["id"] for r in g} == {i for i, t in texts.items() if words(t or "")} and len({r["id"] for r in g}) == len(g)
    assert N.near_duplicates(df.limit(0), "id", F.col("t")).count() == 0


def test_components(spark):
    rnd = random.Random(9)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5, 5)]
    want = {}
    import collections

    near = collections.defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b), near[b].add(a)
    for n in near:
        if n not in want:
            todo, seen = [n], {n}
            while todo:
                for m in near[todo.pop()] - seen:
                    seen.add(m), todo.append(m)
            want |= dict.fromkeys(seen, min(seen))
    got = {r["node"]: r["component"] for r in N.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want
    assert N.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
