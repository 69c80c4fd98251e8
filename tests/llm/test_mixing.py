import datetime as dt
import random

import pytest

from quern.llm import mixing as M

RECORD = "id string, text string, prompt_source string, ingested_at timestamp, bucket string"
SPEC = "id string, name string, bucket string, enabled boolean, modality string"
TARGET = "mix_id string, bucket string, share double, target string, max_repeats int, size_factor double"


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(2)
    rows = [(f"r{k}", "x" * rnd.choice([3, 40, 400, 900]), rnd.choice(["big", "big", "big", "small", "off", "none", None, "Big/"]), dt.datetime(2024, 1, 1), "clash") for k in range(900)]
    rows += [(*r[:3], dt.datetime(2024, 2, 1), r[4]) for r in rows[:30]] + [(None, "x", "big", None, None), ("n", None, "small", None, None)]
    specs = [("big", "b", "B", None, "t"), ("small", "s", "S", True, "t"), ("off", "o", "O", False, "t"), ("nobucket", "n", None, True, "t")]
    return spark.createDataFrame(rows, RECORD), spark.createDataFrame(specs, SPEC)


def sizes(rows):
    total = {}
    for r in rows:
        total[(r["mix_id"], r["bucket"])] = total.get((r["mix_id"], r["bucket"]), 0) + r["tokens"]
    return total


def test_shares_are_reached_within_a_record(spark, tables):
    records, specs = tables
    targets = spark.createDataFrame(
        [("m", "B", 0.5, "", 4, 0.8), ("m", "S", 0.5, "", 3, 0.8), ("m", "O", 0.1, "", 4, 0.8), ("pct", "B", 70.0, "", 1, 0.5), ("pct", "S", 30.0, "", 9, 0.5), ("nulls", "B", None, "", None, None), ("zero", "B", 0.0, "", 2, 1.0)], TARGET
    )
    mixed = M.mixture(records, specs, targets).collect()
    base = {r["id"]: r for r in M.candidates(records, specs).collect()}
    assert len({(r["mix_id"], r["id"], r["repeat_no"]) for r in mixed}) == len(mixed)
    available = sum(r["tokens"] for r in base.values())
    got = sizes(mixed)
    for mix, bucket, share, cap, factor in (("m", "B", 0.5, 4, 0.8), ("m", "S", 0.5, 3, 0.8), ("pct", "B", 0.7, 1, 0.5), ("pct", "S", 0.3, 9, 0.5)):
        most = cap * sum(r["tokens"] for r in base.values() if r["bucket"] == bucket)
        want = min(most, share * factor * available)
        assert abs(got[(mix, bucket)] - want) <= 225 * cap  # the largest record, at every threshold that moves with the mean
        assert max(r["repeat_no"] for r in mixed if (r["mix_id"], r["bucket"]) == (mix, bucket)) <= cap
    assert not any(r["mix_id"] in ("nulls", "zero") or r["bucket"] == "O" for r in mixed)
    # the order is global: buckets are interleaved
    seq = [r["bucket"] for r in mixed if r["mix_id"] == "m"]
    assert sum(a != b for a, b in zip(seq, seq[1:])) > len(seq) / 4
    report = {(r["mix_id"], r["bucket"]): r for r in M.mix_report(records, specs, targets).collect()}
    assert len(report) == 7 and all(report[k]["reached_tokens"] == got.get(k, 0) for k in report)
    assert report[("m", "O")]["reached_share"] == 0.0


def test_same_choice_under_any_partitioning(spark, tables):
    records, specs = tables
    targets = spark.createDataFrame([("m", "B", 0.6, "", 3, 1.0)], TARGET)
    key = lambda df: sorted((r["id"], r["repeat_no"]) for r in df.collect())
    assert key(M.mixture(records, specs, targets)) == key(M.mixture(records.repartition(7), specs, targets))


def test_thresholds_invert_the_poisson_distribution():
    import math

    for mean in (0.1, 1.0, 3.7):
        t = M.thresholds(mean, 6) / M.TOP
        c = [math.exp(-mean) * sum(mean**j / math.factorial(j) for j in range(k + 1)) for k in range(6)]
        assert all(abs(a - b) < 1e-9 for a, b in zip(t, c))
    assert (M.thresholds(0.0, 2) == M.TOP).all()


def test_empty_tables(spark, tables):
    records, specs = tables
    none = spark.createDataFrame([], TARGET)
    some = spark.createDataFrame([("m", "B", 0.6, "", 3, 1.0)], TARGET)
    assert M.mixture(records, specs, none).count() == 0 and M.mix_report(records, specs, none).count() == 0
    assert M.mixture(records.limit(0), specs, some).count() == 0
    assert M.mix_report(records.limit(0), specs, some).first()["reached_tokens"] == 0
    assert M.mixture(records, specs.limit(0), some).count() == 0
