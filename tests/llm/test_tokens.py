import os
import random

import pytest

from quern.llm import tokens as T
from quern.llm.language import detect, requested

pytestmark = pytest.mark.skipif(not os.path.exists(T.VOCABULARY), reason="no vocabulary here")

TEXTS = [
    None, "", " ", "Hello world", "it's they'll 12 34x", "  two  spaces\n\n\nand lines \t", "naïve café — «quoted»", "日本語とEnglish 混在", "🙂🙂 emoji\u200b\ufeff", "a\u00a0b\u2003c\x85d\x1ce",
    "<|endoftext|>", "x" * 3000, "def f(x):\n    return x ** 2  # ok", "Привет, мир! 3½", "\r\n\r\n", "''s 'S 're",
]
RECORD = "id string, text string, prompt_source string, modality string, metadata map<string,string>, ingested_at timestamp, estimated_tokens int, tokens string, piece int"
SPECS = "id string, name string, modality string"


def row(i, text, source="a/one", modality="text", meta=None, day=1, est=None):
    import datetime as dt

    return (i, text, source, modality, meta, dt.datetime(2024, 1, day), est, "clash", 1)


def brute(text):
    return len(T.encoding(T.VOCABULARY).encode_ordinary(text)) if text else 0


def test_piecewise_counts_are_exact(spark):
    count = T.Counter()
    assert [count(t) for t in TEXTS] == [brute(t) for t in TEXTS]
    df = spark.createDataFrame([row(str(k), t) for k, t in enumerate(TEXTS)], RECORD)
    got = {r["id"]: r["tokens"] for r in T.token_counts(df.drop("tokens"), "id").collect()}
    assert got == {str(k): brute(t) for k, t in enumerate(TEXTS)}


def test_budget_equals_brute_force(spark):
    rnd = random.Random(5)
    sources = ["a/one", "A/ONE/", "hf://datasets/a/one", "mirror/one@v2", "two", " b/two\n", "b/two", "nothing", None, ""]
    rows = [row(f"r{k}", rnd.choice(TEXTS), rnd.choice(sources), rnd.choice(["text", "Text ", None, "image-text"]), rnd.choice([None, {}, {"lang": "en-US", "topic": "Arts"}, {"lang": "und"}, {"lang": "ger"}])) for k in range(150)]
    again = [(*r[:5], r[5].replace(day=9), *r[6:]) for r in rows[:20]]
    specs = spark.createDataFrame([("a/one", "one", "text"), ("b/two", "two", "audio"), (None, "null", "x")], SPECS)
    got = T.token_budget(spark.createDataFrame(rows + again, RECORD), specs).collect()
    by = {}
    for r in got:
        s = by.setdefault(r["source"], [0, 0, 0])
        for k, c in enumerate(("records", "tokens", "estimated_tokens")):
            s[k] += r[c]
    want = {}
    for r in rows:
        key = (r[2] or "").strip().lower().removeprefix("hf://datasets/").removeprefix("mirror/").removesuffix("@v2").strip("/ ")
        name = {"a/one": "a/one", "one": "a/one", "two": "b/two", "b/two": "b/two"}.get(key, "unknown")
        s = want.setdefault(name, [0, 0, 0])
        s[0] += 1
        s[1] += brute(r[1])
        s[2] += max(1, len((r[1] or "").encode()) // 4)
    assert by == want
    assert {r["modality"] for r in got} <= {"text", "image_text", "audio", "unknown"} and "de" in {r["language"] for r in got}
    assert len({(r["source"], r["language"], r["modality"], r["topic"]) for r in got}) == len(got)


def test_empty_tables(spark):
    df, specs = spark.createDataFrame([], RECORD), spark.createDataFrame([], SPECS)
    assert T.token_budget(df, specs).count() == 0 and T.record_tokens(df).count() == 0


def test_record_tokens(spark):
    df = spark.createDataFrame([row("a", "Hello world", est=2), row("a", "Hello world", est=2, day=3), row("b", None, est=None), row(None, "x")], RECORD)
    got = {r["id"]: (r["tokens"], r["estimated_tokens"], r["trusted"]) for r in T.record_tokens(df).collect()}
    assert got == {"a": (2, 2, True), "b": (0, 1, False)}


def test_language():
    assert detect("The cat is on the table with the dog.") == "en"
    assert detect("Die Katze ist nicht auf dem Tisch und der Hund auch nicht.") == "de"
    assert detect("Le chat est sur la table avec les chiens.") == "fr"
    assert detect("没有人注意到完整的来源") == "zh" and detect("Вот краткий ответ на вопрос") == "ru"
    assert detect("Kinwen 42") is None and detect(None) is None
    assert requested("Responde en alemán.") == {"de"} and requested("Say it.") == set()


def test_the_first_delivery_counts(spark):
    from datetime import datetime

    rows = [("a", "late", datetime(2024, 1, 2)), ("a", "first", datetime(2024, 1, 1)), ("a", "never", None), ("b", "never", None), ("c", "x", datetime(2024, 1, 1)), ("c", "y", datetime(2024, 1, 1)), (None, "z", None)]
    df = spark.createDataFrame(rows, "id string, text string, ingested_at timestamp")
    once = [{r["id"]: r["text"] for r in T.once(df.repartition(n), ["text"]).collect()} for n in (1, 5)]
    assert once[0] == once[1]  # ties don't depend on partitions
    assert once[0]["a"] == "first" and once[0]["b"] == "never" and set(once[0]) == {"a", "b", "c"}
