"""Problem 4: groups of near-duplicate records at any scale.

1. Records with the same words are one text (64-bit key); the later steps see each distinct text once, so exact copies cost one
   narrow row each.
2. Per text: its word shingles as 64-bit hashes, ``bands * rows`` universal-hash minima, a bucket per band, and two bits of each
   minimum as a sketch.  Shingles and minima aren't stored.
3. Banding.  One aggregate per bucket gives its size and, by minimum, maximum and exclusive or, its pairs if it holds two or three
   texts.  The members of larger buckets are joined back; those of up to ``SMALL`` texts give the pairs whose sketches agree.
4. A bucket of more than ``SMALL`` texts is cut into blocks; a pair of blocks is one group of bounded size.  First, in the
   ``FIRST`` largest buckets of each text, each block meets itself and the first one.  Then, in all buckets, what belongs together so
   far counts as one, and all blocks meet but those whose texts all belong to the bucket's largest group.  Within a pair of
   blocks only pairs that aren't yet joined by verified links are verified, so a family of any size costs few links, and no
   bucket is capped.
5. Verification: sketches first, then the exact similarity of the shingle sets.  Every link that is used was verified.
6. Connected components by alternating large-star and small-star, on links between distinct texts.

Candidate recall at the threshold itself is 1 - (1 - s^rows)^bands = 0.997 for s = 0.5 and grows with s.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import bounded, drop_stored, stored

SMALL, BLOCK = 48, 256
FIRST = 2  # buckets per text that are met first
BIG = 200_000  # larger buckets that are broadcast, at most
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: Column) -> Column:
    """The runs of letters and digits of the lower-cased text, with one blank between."""
    return F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def shingles(tokens: list[str], size: int) -> np.ndarray:
    """64-bit hashes of the runs of ``size`` tokens in order; a shorter text is one shingle, an empty one has none."""
    if not tokens:
        return np.empty(0, np.uint64)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    size = min(size, len(word))
    n = len(word) - size + 1
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = (h ^ word[k : k + n]) * _MIX
        h ^= h >> np.uint64(29)
    return h


def shingle_hashes(tokens: list[str], size: int) -> np.ndarray:
    """The distinct shingles."""
    return np.unique(shingles(tokens, size))


def permutations(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 62, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 62, n, dtype=np.uint64)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of the universal hashes (a * x + b) mod 2^64, upper half, over the set."""
    best = (hashes[:512, None] * a + b).min(axis=0)
    for k in range(512, len(hashes), 512):
        best = np.minimum(best, (hashes[k : k + 512, None] * a + b).min(axis=0))
    return best >> np.uint64(32)


def sketches(sig: np.ndarray) -> np.ndarray:
    """Per row of minima their lowest bits, then the second lowest ones, as 64-bit numbers."""
    bits = [np.packbits(np.pad(((sig >> np.uint64(k)) & np.uint64(1)).astype(np.uint8), ((0, 0), (0, -sig.shape[1] % 64))), axis=1) for k in (0, 1)]
    return np.concatenate(bits, axis=1).view(np.int64)


def bucket_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Per row of minima one hash per band."""
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        h = (h ^ sig.reshape(-1, bands, rows)[:, :, r]) * _MIX
        h ^= h >> np.uint64(31)
    return h.view(np.int64)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))


def least_agreement(threshold: float, perms: int) -> float:
    """Minima whose two bits agree in a pair at the threshold, less four deviations."""
    p = threshold + (1 - threshold) / 4
    return perms * p - 4 * (perms * p * (1 - p)) ** 0.5


def _features(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(bands * rows)
        for batch in batches:
            with np.errstate(over="ignore"):
                sig = np.array([signature(shingles(t.split(" "), size), a, b) for t in batch.column(1).to_pylist()], np.uint64).reshape(-1, bands * rows)
                lists = _lists(bucket_hashes(sig, bands, rows)), _lists(sketches(sig))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["text_id", "t", "buckets", "sketch"])

    return run


def _agreeing(x: Column, y: Column, words: int, perms: int) -> Column:
    """How many minima agree in both bits."""
    differ = lambda k: F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))
    total = F.bit_count(differ(0).bitwiseOR(differ(words)))
    for k in range(1, words):
        total = total + F.bit_count(differ(k).bitwiseOR(differ(words + k)))
    return F.lit(perms) - total


class _Sets:
    """Shingle sets of texts, made when they are first needed."""

    def __init__(self, size: int, keep: int = 20_000):
        self.size, self.keep, self.known = size, keep, {}

    def __call__(self, key: int, text: str) -> np.ndarray:
        s = self.known.get(key)
        if s is None:
            if len(self.known) >= self.keep:
                self.known.clear()
            with np.errstate(over="ignore"):
                s = self.known[key] = shingle_hashes(text.split(" "), self.size)
        return s


def similar(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    """Whether the Jaccard similarity of two sets of distinct hashes reaches the threshold."""
    if min(len(x), len(y)) < threshold * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common >= threshold * (len(both) - common)


def _verified(size: int, threshold: float):
    """Pairs (a, b, t_a, t_b) that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(size)
        for b in batches:
            keep = [similar(sets(x, s), sets(y, t), threshold) for x, y, s, t in zip(*(b.column(k).to_pylist() for k in range(4)))]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _block_links(size: int, threshold: float, perms: int):
    """Verified links of one pair of blocks that join its texts as all links would: a pair is left out only where verified links join its texts
    already, those of earlier rounds (``component``) included."""
    least = least_agreement(threshold, perms)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first, second = pdf["block"].min(), pdf["block"].max()
        x, y = pdf[pdf["block"] == first], pdf[pdf["block"] == second]
        sx, sy = (np.stack(z["sketch"].to_numpy()).view(np.uint64) for z in (x, y))
        ix, iy, tx, ty = x["text_id"].to_numpy(), y["text_id"].to_numpy(), x["t"].to_numpy(), y["t"].to_numpy()
        _, at = np.unique(np.concatenate([x["component"].to_numpy(), y["component"].to_numpy()]), return_inverse=True)
        tree, ax, ay = np.arange(at.max() + 1), at[: len(ix)], at[len(ix) :]
        sets, half, out = _Sets(size), sx.shape[1] // 2, []
        for k in range(len(ix)):
            differ = sx[k] ^ sy
            agree = perms - np.bitwise_count(differ[:, :half] | differ[:, half:]).sum(axis=1, dtype=np.int64)
            near = np.flatnonzero((agree >= least) & (iy != ix[k]))
            for j in near[np.argsort(-agree[near], kind="stable")].tolist():
                p, q = tree[ax[k]], tree[ay[j]]
                if p != q and similar(sets(ix[k], tx[k]), sets(iy[j], ty[j]), threshold):
                    tree[tree == p] = q
                    out.append((min(ix[k], iy[j]), max(ix[k], iy[j])))
        return pd.DataFrame(sorted(set(out)), columns=["a", "b"])

    return run


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component) of the undirected edges (a, b) of bigints, by alternating large-star and small-star.

    Every node that occurs gets the smallest node it is connected with.  No edges give no rows; self-loops and repeated
    edges do no harm.  Each star needs one shuffle on the node; neighbours of a node are never collected: the minimum is a
    partial aggregate, joined back to its edges.
    """
    e = stored(edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a <> b").distinct())

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if large:  # every larger neighbour of a node goes to the smallest of its neighbours and itself
            low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = both.where("b < a")  # every smaller neighbour, and the node itself, goes to the smallest
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())

    now = state(e)
    for _ in range(max_rounds):
        if now[0] == 0:
            break
        last, e = e, stored(star(star(e, True), False))
        drop_stored(last)
        new = state(e)
        if new == now:
            break
        now = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def near_duplicates(records: DataFrame, id_col: str, text: Column, shingle: int = 5, threshold: float = 0.8, bands: int = 42, rows: int = 3) -> DataFrame:
    """(id, group_id, n_links): one row per distinct non-null id with words in its text.

    ``group_id`` is the same for records that are linked directly or by others; ``n_links`` counts the verified links of its text
    to other texts (in buckets of more than ``SMALL`` texts only those that join texts not joined before).
    Texts with the same words always share a group.  Records without any word or with a null id give no row; the
    first of several rows with one id (by text key) counts.
    """
    perms = bands * rows
    words, least = -(-perms // 64), least_agreement(threshold, perms)
    r = records.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), normalised(text).alias("t")).where("t <> ''")
    r = stored(r.withColumn("text_id", F.xxhash64("t")))
    members = stored(r.groupBy("id").agg(F.min("text_id").alias("text_id")))
    texts = r.groupBy("text_id").agg(F.min("t").alias("t")).join(members.select("text_id").distinct(), "text_id", "left_semi")
    texts = stored(texts.select("text_id", "t").mapInArrow(_features(shingle, bands, rows), "text_id bigint, t string, buckets array<bigint>, sketch array<bigint>"))

    def banded(*columns: str) -> DataFrame:
        return texts.select("text_id", *columns, F.explode("buckets").alias("bucket"))

    ids = F.col("text_id")
    held = banded().groupBy("bucket").agg(F.count("*").alias("n"), F.min(ids).alias("a"), F.max(ids).alias("b"), F.bit_xor(ids).alias("x")).where("n > 1")
    held = stored(held)
    third = F.col("x").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("b"))
    pair = lambda x, y: F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    few = F.when(F.col("n") == 2, F.array(pair("a", "b"))).otherwise(F.array(pair("a", "b"), pair(F.col("a"), third), pair(third, F.col("b"))))
    pairs = held.where("n <= 3").select(F.inline(few)).distinct()
    for k in "ab":
        pairs = pairs.join(texts.select(F.col("text_id").alias(k), F.col("sketch").alias(f"s_{k}")), k)
    agree = lambda x, y: _agreeing(F.col(x), F.col(y), words, perms) >= least
    pairs = pairs.where(agree("s_a", "s_b")).select("a", "b")
    many = stored(banded("sketch").join(bounded(held.where("n > 3").select("bucket", "n"), BIG), "bucket"))
    small = many.where(F.col("n") <= SMALL).select("bucket", ids.alias("a"), F.col("sketch").alias("s_a"))
    other = small.select("bucket", F.col("a").alias("b"), F.col("s_a").alias("s_b"))
    pairs = pairs.unionByName(small.join(other, "bucket").where((F.col("a") < F.col("b")) & agree("s_a", "s_b")).select("a", "b")).distinct()
    for k in "ab":
        pairs = pairs.join(texts.select(F.col("text_id").alias(k), F.col("t").alias(f"t_{k}")), k)
    links = pairs.select("a", "b", "t_a", "t_b").mapInArrow(_verified(shingle, threshold), "a bigint, b bigint")

    def met(blocks: DataFrame, mates: Column) -> DataFrame:
        """Links of the pairs of blocks (i <= j) that the array ``mates`` of a row's ``block`` names; ``blocks`` has their number ``of``."""
        b = blocks.join(texts.select("text_id", "t"), "text_id").withColumn("mate", F.explode(mates))
        b = b.select("bucket", F.least("block", "mate").alias("i"), F.greatest("block", "mate").alias("j"), "block", "text_id", "sketch", "component", "t")
        return b.groupBy("bucket", "i", "j").applyInPandas(_block_links(shingle, threshold, perms), "a bigint, b bigint")

    large = many.where(F.col("n") > SMALL)
    count = lambda c: F.ceil(c / F.lit(BLOCK)).cast("int")
    any_large = held.where(F.col("n") > SMALL).limit(1).count() > 0
    if any_large:
        largest = F.row_number().over(Window.partitionBy("text_id").orderBy(F.desc("n"), "bucket"))
        blocks = large.withColumn("k", largest).where(F.col("k") <= FIRST).withColumn("of", count(F.col("n"))).withColumn("block", F.pmod(F.xxhash64("text_id", "bucket"), F.col("of")).cast("int")).withColumn("component", ids)
        first = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("of") - 1)).otherwise(F.array(F.lit(0), F.col("block")))
        links = links.unionByName(met(blocks, first)).distinct()
    links = stored(links)
    parts = stored(components(links))
    if any_large:
        # texts of the bucket's largest group in blocks of their own, which needn't meet each other
        own = large.join(parts.withColumnRenamed("node", "text_id"), "text_id", "left").withColumn("component", F.coalesce("component", "text_id"))
        sizes = own.groupBy("bucket", "component").agg(F.count("*").alias("m"))
        main = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.max("m").alias("m"), F.count("*").alias("groups")).where("groups > 1")
        mine = F.col("component") == F.col("main")
        n_main, n_rest = count(F.col("m")), count(F.col("n") - F.col("m"))
        own = own.join(main, "bucket").withColumn("of", n_main + n_rest)
        salt = F.xxhash64("text_id", "bucket")
        own = own.withColumn("block", F.when(mine, F.pmod(salt, n_main)).otherwise(n_main + F.pmod(salt, n_rest)).cast("int"))
        others = F.sequence(F.when(F.col("block") < n_main, n_main).otherwise(F.lit(0)), F.col("of") - 1)
        more = stored(met(own, others).distinct())
        if more.limit(1).count():
            joined = more
            for k in "ab":
                joined = joined.join(parts.select(F.col("node").alias(k), F.col("component").alias(f"c_{k}")), k, "left")
            over = components(joined.select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")))
            known = parts.unionByName(more.select(F.explode(F.array("a", "b")).alias("node")).join(parts, "node", "left_anti").distinct().withColumn("component", F.col("node")))
            over = over.select(F.col("node").alias("component"), F.col("component").alias("whole"))
            parts = known.join(over, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
            links = links.unionByName(more)
    for done in (r, texts, held, many):
        drop_stored(done)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    m = members.select("id", ids.alias("node")).join(parts.join(degree, "node"), "node", "left")
    return m.select("id", F.coalesce("component", "node").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def named_groups(groups: DataFrame) -> DataFrame:
    """(id, first_id, size): each id with the least id and the number of ids of its group."""
    g = stored(groups.select("id", "group_id"))
    named = g.groupBy("group_id").agg(F.min("id").alias("first_id"), F.count("*").alias("size"))
    return g.join(named, "group_id").select("id", "first_id", "size")


def group_pairs(groups: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b as strings: all pairs of ids within a group of two or more."""
    size = groups.groupBy("group_id").agg(F.count("*").alias("n")).where("n > 1")
    g = groups.join(size, "group_id").select("group_id", "id")
    return g.select("group_id", F.col("id").alias("id_a")).join(g.select("group_id", F.col("id").alias("id_b")), "group_id").where("id_a < id_b").select("id_a", "id_b")
