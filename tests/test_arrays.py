import math

from pyspark.sql import functions as F

from quern.functions import arrays, rng


def one(spark, c):
    return spark.range(1).select(c).first()[0]


def lit(xs):
    return F.array(*[F.lit(x).cast("bigint") for x in xs]) if xs else F.array().cast("array<bigint>")


def test_blocks_and_padding(spark):
    for n in (0, 1, 3, 4, 5, 9):
        ids = list(range(n))
        got = [list(b) for b in one(spark, arrays.blocks(lit(ids), 4))]
        want = [ids[k : k + 4] + [-100] * (4 - len(ids[k : k + 4])) for k in range(0, n, 4)]
        assert got == want
        assert [x for b in got for x in b if x >= 0] == ids
        assert list(one(spark, arrays.left_pad(lit(ids), 4, 7))) == [7] * max(0, 4 - n) + ids[-4:][: 4 if n else 0]
    assert list(one(spark, arrays.attention_mask(F.lit(2), 4))) == [0, 0, 1, 1]


def test_noise_keeps_what_it_does_not_mask(spark):
    target = [5, 6, 7, 8, -100, -100]
    df = spark.range(200).select("id", arrays.noise(lit(target), 50, 0, 1, F.col("id")).alias("n")).select("id", "n.*")
    rows = df.collect()
    masked = 0
    for r in rows:
        assert 0.05 <= r["noise_t"] < 0.95
        for x, m, y in zip(target, r["mask"], r["ids"]):
            assert not (m and x < 0)
            assert y == 0 if x < 0 else (0 <= y < 50 if m else y == x)
            masked += m
    assert 300 < masked < 500  # about half of 800
    assert sorted(map(str, rows)) == sorted(map(str, df.repartition(7).collect()))


def test_scores(spark):
    z = [1.0, 2.0, -3.0, 2.0]
    p = [math.exp(x) for x in z]
    s = sum(p)
    c = F.array(*map(F.lit, z))
    assert abs(one(spark, arrays.entropy(c)) + sum(x / s * math.log(x / s) for x in p)) < 1e-12
    assert abs(one(spark, arrays.cross_entropy(c, F.lit(2))) + math.log(p[2] / s)) < 1e-12
    assert one(spark, arrays.cross_entropy(c, F.lit(-100))) is None and one(spark, arrays.cross_entropy(c, F.lit(4))) is None
    assert (one(spark, arrays.argmax(c)), one(spark, arrays.argmin(c))) == (1, 2)
    assert one(spark, arrays.entropy(F.array().cast("array<double>"))) is None
    assert one(spark, arrays.entropy(F.array(F.lit(1e4), F.lit(-1e4)))) == 0.0
    assert abs(one(spark, arrays.softcap(F.lit(100.0), 30.0)) - 30 * math.tanh(100 / 30)) < 1e-12


def test_placeholders_and_canvas(spark):
    assert list(one(spark, arrays.fill_placeholders(lit([1, 9, 9, 2]), 9, lit([70, 80])))) == [1, 70, 80, 2]
    assert one(spark, arrays.fill_placeholders(lit([1, 9]), 9, lit([70, 80]))) is None
    assert list(one(spark, arrays.commit_canvas(lit([1]), lit([2, 3, 4]), 2))) == [1, 2, 3]
    assert list(one(spark, arrays.commit_canvas(lit([1]), lit([2]), 0))) == [1]
    assert list(one(spark, arrays.position_ids(F.lit(3), 2))) == [2, 3, 4]
    assert list(one(spark, arrays.mono(F.array(F.array(F.lit(1.0), F.lit(3.0)))))) == [2.0]
    assert one(spark, arrays.family(F.array(F.lit("pixel_values"), F.lit("input_features")))) == "audio"


def test_numbers_depend_on_the_key_only(spark):
    a = {r[0]: r[1] for r in spark.range(500).select("id", rng.uniform(1, "x", F.col("id"))).collect()}
    b = {r[0]: r[1] for r in spark.range(500).repartition(9).select("id", rng.uniform(1, "x", F.col("id"))).collect()}
    assert a == b and all(0 <= v < 1 for v in a.values()) and 0.4 < sum(a.values()) / 500 < 0.6
