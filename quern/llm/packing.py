"""Problem 6: documents in containers of fixed capacity, by sum-of-squares packing.

Documents are dealt to packing shards by hash; a shard is one bounded group of ``SHARD`` documents on average, packed
in one task.  Within a shard every document goes, in hashed order, where the sum over residual gaps of the squared number of
open containers with that gap becomes smallest; a tie goes to the fullest container.  The waste of a shard is its last open
containers, whose items are placed once more at the end; it falls as shards grow.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.tokens import VOCABULARY, token_counts

SHARD = 16_384
MAX_PACKS = 1_000


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(container of each item, level of each container) for items of 0..capacity, in the given order."""
    open_at = np.zeros(capacity + 1, np.int64)  # open containers per level
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    levels: list[int] = []
    place = np.empty(len(sizes), np.int64)
    high = 0  # above it no container is open
    for k, s in enumerate(sizes.tolist()):
        if s == 0:  # takes no room
            if not levels:
                levels.append(0)
                stacks[0].append(0)
                open_at[0] += 1
            place[k] = 0
            continue
        # change of the sum of squares: a container leaves level h and reaches level h + s; full ones are closed and don't count
        last = min(high, capacity - s)
        best, to = (2 * int(open_at[s]) + 1 if s < capacity else 0), -1
        if last >= 0:
            n = open_at[: last + 1]
            gain = open_at[s : s + last + 1] - n
            score = 2 * gain + 2
            if s + last == capacity:
                score[last] = 1 - 2 * n[last]
            score[n == 0] = np.iinfo(np.int64).max
            j = last - int(np.argmin(score[::-1]))
            if n[j] and score[j] <= best:
                to = j
        if to < 0:
            b = len(levels)
            levels.append(s)
            level = s
        else:
            b = stacks[to].pop()
            open_at[to] -= 1
            level = to + s
            levels[b] = level
        if level < capacity:
            stacks[level].append(b)
            open_at[level] += 1
            high = max(high, level)
        place[k] = b
    return place, np.array(levels, np.int64)


def consolidate(sizes: np.ndarray, place: np.ndarray, levels: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Empty the containers that are still open and place their items again, largest first, each where least room is left; kept if it
    needs fewer containers.  Sum of squares keeps gaps of every size open for items to come; at the end none come."""
    left = levels < capacity
    items = np.flatnonzero(left[place] & (sizes > 0))
    if not len(items):
        return place, levels
    room: list[tuple[int, int]] = []  # (free, container), ascending
    level: list[int] = []
    to = np.empty(len(items), np.int64)
    for k in np.argsort(-sizes[items], kind="stable").tolist():
        s = int(sizes[items[k]])
        at = bisect_left(room, (s, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = capacity, len(level)
            level.append(0)
        level[b] += s
        to[k] = b
        if free > s:
            insort(room, (free - s, b))
    if len(level) >= int(left.sum()):
        return place, levels
    kept = np.flatnonzero(~left)
    number = np.full(len(levels), 0)  # items of no size go with the first container
    number[kept] = np.arange(len(kept))
    place = number[place]
    place[items] = to + len(kept)
    return place, np.concatenate([levels[kept], np.array(level, np.int64)])


def _pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    r = pdf.iloc[0]
    capacity, shard, pack_id = int(r["capacity"]), int(r["shard"]), r["pack_id"]
    pdf = pdf.sort_values(["mix", "doc_id"])
    doc, size = pdf["doc_id"].to_numpy(), pdf["tokens"].to_numpy()
    whole, rest = size // capacity, size % capacity
    whole = np.where((size > 0) & (size <= capacity) & (rest == 0), 0, whole)
    rest = np.where((size == capacity), capacity, rest)
    # a document larger than a container fills some alone; only its remainder is packed with others
    item = np.flatnonzero((rest > 0) | (size == 0))
    place, levels = consolidate(rest[item], *pack(rest[item], capacity), capacity)
    full = np.repeat(np.arange(len(doc)), whole)
    part = np.arange(len(full)) - np.repeat(np.cumsum(whole) - whole, whole)
    own = np.arange(len(full)) + len(levels)
    base = shard << 32
    return pd.DataFrame({
        "pack_id": pack_id, "doc_id": np.concatenate([doc[item], doc[full]]), "part": np.concatenate([whole[item], part]).astype(int) + 1,
        "tokens": np.concatenate([rest[item], np.full(len(full), capacity)]).astype(np.int64), "container": np.concatenate([place, own]).astype(np.int64) + base,
        "unused": np.concatenate([capacity - levels[place] if len(place) else np.empty(0, np.int64), np.zeros(len(full), np.int64)]).astype(np.int64),
    })


def pack_documents(documents: DataFrame, capacities: DataFrame, path: str = VOCABULARY, shard_size: int = SHARD) -> DataFrame:
    """(pack_id, doc_id, part, tokens, container, unused): the container of every document, or of every part of one that alone is larger
    than a container, and the room left in that container.

    Null or empty texts have 0 tokens and take no room in the first container of their shard.  Null ids give no row; of
    repeated ids the first by text counts.  Capacities that are null or below 1 are left out.
    """
    packs = [(r["pack_id"], r["capacity_tokens"]) for r in capacities.where("pack_id is not null and capacity_tokens >= 1").select("pack_id", "capacity_tokens").distinct().limit(MAX_PACKS + 1).collect()]
    if len(packs) > MAX_PACKS:
        raise ValueError(f"more than {MAX_PACKS} capacities")
    out = "pack_id int, doc_id bigint, part int, tokens bigint, container bigint, unused bigint"
    docs = documents.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if not packs:
        return documents.sparkSession.createDataFrame([], out)
    sized = token_counts(docs, "doc_id", path=path).groupBy("doc_id").agg(F.min("tokens").alias("tokens"))
    shards = max(1, -(-docs.count() // shard_size))
    each = F.explode(F.array(*[F.struct(F.lit(p).cast("int").alias("pack_id"), F.lit(c).cast("int").alias("capacity")) for p, c in sorted(packs)]))
    rows = sized.withColumn("mix", F.xxhash64("doc_id")).withColumn("shard", F.pmod("mix", F.lit(shards)).cast("int")).select("doc_id", "tokens", "mix", "shard", each.alias("p")).select("doc_id", "tokens", "mix", "shard", "p.*")
    return rows.groupBy("pack_id", "shard").applyInPandas(_pack_shard, out)


def containers(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(pack_id, capacity_tokens, containers, documents, tokens, unused, fill): how well each capacity was used."""
    per = packed.groupBy("pack_id", "container").agg(F.sum("tokens").alias("used"), F.max("unused").alias("unused"))
    per = per.groupBy("pack_id").agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.sum("unused").alias("unused"))
    docs = packed.groupBy("pack_id").agg(F.countDistinct("doc_id").alias("documents"))
    caps = capacities.where("pack_id is not null and capacity_tokens >= 1").groupBy("pack_id").agg(F.min("capacity_tokens").alias("capacity_tokens"))
    fill = F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6)
    return per.join(docs, "pack_id").join(caps, "pack_id").select("pack_id", "capacity_tokens", "containers", "documents", "tokens", "unused", fill.alias("fill"))
