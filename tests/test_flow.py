import random

import pytest
from pyspark.sql import functions as F

from quern.operators import flow
from quern.storage import prefix_sums


def simulate(sources, rows, per_source, total):
    """Round robin, one raw row per source and round."""
    its = [(s, iter([r for r in rows if r[1] == s["id"]])) for s in sources]
    got = {s["id"]: 0 for s in sources}
    out = []
    while its:
        for s, it in list(its):
            limit = s["max_records"] or per_source
            if total and len(out) >= total:
                return out
            if limit and got[s["id"]] >= limit:
                its.remove((s, it))
                continue
            r = next(it, None)
            if r is None:
                its.remove((s, it))
                continue
            if r[2]:
                got[s["id"]] += 1
                out.append(r[0])
    return out


@pytest.mark.parametrize("seed", range(5))
def test_interleave_is_a_round_robin(spark, seed):
    rnd = random.Random(seed)
    sources = [{"id": f"s{k}", "source_order": k, "max_records": rnd.choice([None, 0, 2, 5])} for k in range(4)]
    rows = [(f"{s['id']}-{i:03d}", s["id"], rnd.random() < 0.7) for s in sources for i in range(rnd.randrange(0, 25))]
    per_source, total = rnd.choice([0, 4]), rnd.choice([0, 11])
    want = simulate(sources, sorted(rows), per_source, total)
    df = spark.createDataFrame(rows or [("x", "none", True)], "id string, source string, ok boolean").repartition(3)
    spec = spark.createDataFrame([(s["id"], s["source_order"], s["max_records"]) for s in sources], "id string, source_order int, max_records int")
    got = flow.interleave(df, spec, "source", ["id"], F.col("ok"), per_source, total).orderBy("position").select("id").collect()
    assert [r[0] for r in got] == want


def test_reference_order_of_two_manifests(spark):
    df = spark.createDataFrame([(f"{s}{i}", s) for s in "ab" for i in (1, 2, 3)], "id string, source string")
    spec = spark.createDataFrame([("a", 0, 2), ("b", 1, 2)], "id string, source_order int, max_records int")
    got = flow.interleave(df, spec, "source", ["id"], total=3).orderBy("position").select("id").collect()
    assert [r[0] for r in got] == ["a1", "b1", "a2"]


@pytest.mark.parametrize("target", [0, 1, 50, 55, 10_000])
def test_token_budget_keeps_the_crossing_row(spark, target):
    tokens = [(i, (i * 7) % 11) for i in range(40)]
    want, total = [], 0
    for i, t in tokens:
        if target and total >= target:
            break
        want.append(i)
        total += t
    df = spark.createDataFrame(tokens, "i int, t int").repartition(5)
    assert sorted(r["i"] for r in flow.token_budget(df, ["i"], F.col("t"), target).collect()) == want


def test_prefix_sums_in_hot_groups_and_nulls(spark):
    rnd = random.Random(1)
    rows = [(i, None if rnd.random() < 0.2 else "hot" if rnd.random() < 0.8 else f"g{rnd.randrange(3)}", rnd.choice([None, 1, 2, 3])) for i in range(300)]
    want, state = {}, {}
    for i, g, v in rows:
        n, s = state.get(g, (0, 0))
        want[i] = (n, s)
        state[g] = (n + 1, s + (v or 0))
    df = spark.createDataFrame(rows, "i int, g string, v int").repartition(7)
    assert {r["i"]: (r["ordinal"], r["s"]) for r in prefix_sums(df, ["i"], ["g"], s=F.col("v")).collect()} == want
    assert prefix_sums(df.limit(0), ["i"], ["g"]).count() == 0


def test_block_budget(spark):
    n = [3, 0, 4, 2, 9]
    df = spark.createDataFrame(list(enumerate(n)), "i int, n int")
    got = flow.block_budget(df, ["i"], F.col("n"), 8).orderBy("i").collect()
    assert [(r["i"], r["first_block"], r["kept_blocks"]) for r in got] == [(0, 0, 3), (1, 3, 0), (2, 3, 4), (3, 7, 1)]


def test_shuffle_and_split(spark):
    df = spark.range(12)
    a = [r["id"] for r in flow.seeded_shuffle(df, 7, "id").orderBy("position").collect()]
    assert sorted(a) == list(range(12)) != a
    assert a == [r["id"] for r in flow.seeded_shuffle(df.repartition(5), 7, "id").orderBy("position").collect()]
    for n, cut in ((1, 0), (2, 1), (100, 1), (400, 4)):
        assert flow.train_val_split(spark.range(n), 0.01, 3, "id").where("split = 'val'").count() == cut


def test_progress_and_reconcile(spark):
    out = spark.createDataFrame([(0, "r1", 5), (1, "r2", 7)], "o int, id string, estimated_tokens int")
    saved = spark.createDataFrame([(3, 99, 3, "r3")], "records bigint, estimated_tokens bigint, source_index bigint, last_record_id string")
    r = flow.reconcile(saved, flow.progress(out, ["o"])).first().asDict()
    assert r == {"records": 2, "estimated_tokens": 12, "source_index": 2, "last_record_id": "r2", "reconciled_from_output": True}
    same = flow.progress(out, ["o"])
    assert flow.reconcile(same, same).first()["reconciled_from_output"] is False
    assert flow.progress(out.limit(0), ["o"]).first().asDict() == {"records": 0, "estimated_tokens": 0, "source_index": 0, "last_record_id": None}
    holes = spark.createDataFrame([(0, "a", None), (1, "", 3), (2, None, None)], "o int, id string, estimated_tokens int")
    assert flow.progress(holes, ["o"]).first().asDict() == {"records": 3, "estimated_tokens": 3, "source_index": 3, "last_record_id": "a"}


def test_resume_keeps_null_keys(spark):
    todo = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    assert sorted(str(r[0]) for r in flow.resume(todo, spark.createDataFrame([("a",), (None,)], "id string")).collect()) == ["None", "b"]


def test_active_sources(spark):
    s = spark.createDataFrame([("a", "x", None), ("b", "y", True), ("c", "z", False)], "id string, name string, enabled boolean")
    assert sorted(r["id"] for r in flow.active_sources(s).collect()) == ["a", "b"]
    assert sorted(r["id"] for r in flow.active_sources(s, ["y", "a", "c"]).collect()) == ["a", "b"]
