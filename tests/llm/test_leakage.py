import random

from quern.llm import leakage as L

RND = random.Random(4)
NAMES = ["".join(RND.choice(["ka", "lo", "mi", "ru", "te"]) for _ in range(4)) for _ in range(300)]
COMMON = "the of and to a in that it was for on are with as at by from they this have".split()


def sentence(rnd, n):
    return " ".join(rnd.choice(NAMES) if rnd.random() < 0.3 else rnd.choice(COMMON) for _ in range(n))


def altered(rnd, words, every):
    out = list(words)
    for k in range(rnd.randrange(every), len(out), every):
        out[k] = rnd.choice(["zzz", "qqq"])
    return out


def test_folding():
    assert L.fold("The <b>Café</b>&nbsp;“naïve” — it’s\nhere… *ok*") == "the cafe naive its here ok".split()
    assert L.fold("lan-\ntern and well-known") == ["lantern", "and", "wellknown"]
    assert L.fold("") == []


def test_alignment_rule():
    item = [f"i{k}" for k in range(40)]
    noise = ["x"] * 9
    assert L.aligned(noise + item[5:17] + noise, item)
    assert not L.aligned(noise + item[5:16] + noise, item)
    one = item[5:10] + ["alt"] + item[11:17]
    assert L.aligned(noise + one + noise, item)
    assert not L.aligned(noise + item[5:10] + ["alt", "alt"] + item[12:17] + noise, item)
    assert L.aligned(noise + item[5:11] + ["added"] + item[11:17] + noise, item)
    assert L.aligned(noise + item[5:11] + item[12:18] + noise, item)  # one left out
    two = item[5:10] + ["a"] + item[11:16] + ["b"] + item[17:21]
    assert L.aligned(noise + two + noise, item)


def runs(words, n=12):
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def test_leaks_of_random_texts(spark):
    """Every unaltered run of twelve words is found, by sets of runs; nothing is found that the rule of alterations doesn't allow."""
    rnd = random.Random(8)
    items = [(k, sentence(rnd, rnd.randrange(14, 60)), "Read the text and choose. " + sentence(rnd, rnd.randrange(8, 30)), rnd.choice(NAMES)) for k in range(40)]
    items += [(100, items[0][1], items[0][2], "x"), (101, None, None, None), (102, "too short", "", "")]
    docs = []
    for d in range(150):
        w = sentence(rnd, rnd.randrange(0, 120)).split()
        if rnd.random() < 0.6:
            src = L.fold(rnd.choice(items[:40])[rnd.choice([1, 2])])
            a = rnd.randrange(0, max(1, len(src) - 12))
            piece = altered(rnd, src[a : a + rnd.choice([9, 12, 14, 18, 30])], rnd.choice([4, 8, 10, 99]))
            k = rnd.randrange(len(w) + 1)
            w[k:k] = piece
        docs.append((d, rnd.choice([" ", "  ", " \n"]).join(x.upper() if rnd.random() < 0.1 else f"*{x}*," if rnd.random() < 0.1 else x for x in w), d))
    docs += [(900, None, 0), (901, "", 0), (None, items[0][1], 0), (902, docs[3][1], 0)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    it = spark.createDataFrame([(*i, "w") for i in items], "item_id bigint, passage string, question string, answer string, word string")
    got = {(r["doc_id"], r["item_id"]) for r in L.find_leaks(df, it).collect()}
    texts = L.item_texts([i[:3] for i in items])
    assert not any(t[2][:3] == ["read", "the", "text"] for t in texts)
    whole = {(d, i) for d, t, _ in docs if d is not None and t for i, _, w in texts if runs(L.fold(t)) & runs(w)}
    allowed = {(d, i) for d, t, _ in docs if d is not None and t for i, _, w in texts if L.aligned(L.fold(t), w)}
    assert whole <= got <= allowed and len(whole) > 12 and len(got - whole) > 2
    assert {d for d, i in got if i == 0} == {d for d, i in got if i == 100}
    assert L.find_leaks(df.limit(0), it).count() == 0 and L.find_leaks(df, it.limit(0)).count() == 0


PHRASES = (
    "a visitor from {a} counted {n} windows in the {o} of {b} yet page {m} of the ledger lists only {k} of them",
    "in the village of {a} each {o} is painted by {b} on the morning of day {n} although {c} prefers the empty {p}",
    "when {a} repaired the {o} the local gauge fell from {n} to {m} which {b} called the {c} effect",
)


def phrased(rnd, n):
    name = lambda: "".join(rnd.choice("bdfgklmnprstvz") + rnd.choice("aeiou") for _ in range(5))
    return " ".join(rnd.choice(PHRASES).format(a=name(), b=name(), c=name(), n=rnd.randrange(99, 9999), m=rnd.randrange(99, 9999), k=rnd.randrange(99, 9999), o=rnd.choice(COMMON), p=rnd.choice(COMMON)) for _ in range(n))


def planted(spark, blocks=1):
    """Items of shared phrasing; documents that hold one of them whole, one with every ninth word altered, and look-alikes: the phrasing with names of no item."""
    rnd = random.Random(21)
    items = [(k, phrased(rnd, 3), None, None) for k in range(60)]
    docs, want = [], set()
    for d in range(60):
        src = rnd.randrange(60)
        w = items[src][1].split()
        if d % 3 == 0:
            want.add((d, src))
        elif d % 3 == 1:
            w = altered(rnd, w, 9)
            want.add((d, src))
        else:
            w = phrased(rnd, 3).split()
        docs.append((d, sentence(rnd, 30) + " " + " ".join(w) + " " + sentence(rnd, 30)))
    it = spark.createDataFrame(items, "item_id bigint, passage string, question string, answer string")
    return spark.createDataFrame(docs, "doc_id bigint, text string"), it, want, items, docs


def test_shared_phrasing_is_no_leak(spark):
    df, it, want, items, docs = planted(spark)
    assert {(r["doc_id"], r["item_id"]) for r in L.find_leaks(df, it).collect()} == want
    allowed = {(d, i) for d, t in docs for i, p, _, _ in items if L.aligned(L.fold(t), L.fold(p))}
    assert len(allowed - want) > 50  # the rule of alterations alone takes the look-alikes too


def test_items_of_other_blocks_judge_too(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 8)
    df, it, want, _, _ = planted(spark)
    assert {(r["doc_id"], r["item_id"]) for r in L.find_leaks(df, it).collect()} == want


def test_no_allowed_match_is_below_the_bound_at_low_rank(spark, monkeypatch):
    monkeypatch.setattr(L, "RANK", 16)
    monkeypatch.setattr(L, "KEEP", 0.5)
    rnd = random.Random(3)
    texts = [(k, "passage", sentence(rnd, 60).split()) for k in range(64)]
    df = spark.createDataFrame([(k, " ".join(t[2])) for k, t in enumerate(texts)], "doc_id bigint, text string")
    m = L._model(spark, texts, *L.document_frequencies(df, {w for t in texts for w in t[2]}))
    missed = 0
    for q, (_, _, t) in enumerate(texts):
        for k in range(len(t) - L.SPAN + 1):
            w = t[k : k + L.SPAN]
            w[1 + k % (L.SPAN - 2)] = "zzz"
            missed += q not in L._candidates(w, m)[0]
    assert missed == 0


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 2)
    rnd = random.Random(1)
    items = [(k, sentence(rnd, 20), None, None) for k in range(7)]
    df = spark.createDataFrame([(k, "start " + i[1] + " end") for k, i in enumerate(items)], "doc_id bigint, text string")
    it = spark.createDataFrame(items, "item_id bigint, passage string, question string, answer string")
    assert sorted((r["doc_id"], r["item_id"]) for r in L.find_leaks(df, it).collect()) == [(k, k) for k in range(7)]


def test_more_items_than_the_bound_are_an_error(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(L, "MAX_ITEMS", 2)
    it = spark.createDataFrame([(k, sentence(RND, 20), None, None) for k in range(3)], "item_id bigint, passage string, question string, answer string")
    df = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    with pytest.raises(ValueError):
        L.find_leaks(df, it)
    assert L.find_leaks(df, it.where("item_id < 2")).count() == 0


def test_extents_of_altered_matches():
    item = [f"i{k}" for k in range(40)]
    noise = ["x"] * 9
    at = L.seeds([item])
    everywhere = lambda d: L.verified(d, {0}, range(len(d) - L.SEED + 1), at, [item])
    assert everywhere(noise + item[3:20] + noise) == {0: []}
    one = noise + item[3:10] + ["alt"] + item[11:18] + noise
    assert everywhere(one) == {0: [(9, 24)]}
    assert everywhere(noise + item[3:10] + noise) == {}
