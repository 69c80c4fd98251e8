import pytest
from pyspark.sql import functions as F

from quern.operators import contract, prompts

SOURCES = [("chat", "prompt_bank", "text", None, None), ("pages", "plain_warmup_or_context_seed", None, "cc", None), ("code", "code_context_stream", "code", None, "Read it.")]


@pytest.fixture(scope="module")
def sources(spark):
    return spark.createDataFrame(SOURCES, "id string, role string, modality string, license_hint string, teacher_prompt string")


def chats(spark, rows):
    return spark.createDataFrame(rows, "k int, src string, messages array<struct<role:string,content:string>>, prompt string, text string")


def test_user_turn_is_the_prompt(spark, sources):
    rows = [(1, "chat", [("system", "be nice"), ("user", " What? "), ("assistant", "secret")], "ignored", None)]
    r = prompts.prompt_records(chats(spark, rows), sources, "src", ["k"]).first()
    assert r["prompt_text"] == "What?" and r["metadata"]["target_policy"] == "teacher_generated_output_only"
    assert "secret" not in str(r)


def test_messages_go_before_fields(spark, sources):
    rows = [
        (1, "chat", [("system", "only system")], "field", None), (2, "chat", [], "field", None), (3, "chat", None, "field", None),
        (4, "chat", [("user", ""), ("human", "second")], "field", None), (5, "chat", None, None, None), (6, "none", None, "x", None), (7, None, None, "x", None),
    ]
    got = {r["prompt_text"] for r in prompts.prompt_records(chats(spark, rows), sources, "src", ["k"]).collect()}
    assert got == {"only system", "field", "second"}


def test_context_roles_need_a_context(spark, sources):
    rows = [(1, "pages", None, "own prompt", "the page"), (2, "pages", None, "own prompt", " "), (3, "code", None, None, "x = 1"), (4, "chat", None, "same", "same")]
    got = {r["context_text"]: r["prompt_text"] for r in prompts.prompt_records(chats(spark, rows), sources, "src", ["k"]).collect()}
    assert got == {"the page": prompts.DEFAULT_TEACHER_PROMPT, "x = 1": "Read it.", "": "same"}


def test_ids_are_reproducible(spark, sources):
    df = chats(spark, [(i, "chat", None, f"p{i}", None) for i in range(20)])
    a = {r["id"] for r in prompts.prompt_records(df, sources, "src", ["k"]).collect()}
    assert a == {r["id"] for r in prompts.prompt_records(df.repartition(5), sources, "src", ["k"]).collect()} and len(a) == 20


def test_context_counts_blank_turns(spark):
    turns = spark.createDataFrame([("c", i, r, t) for i, (r, t) in enumerate([("user", "a"), ("human", " "), ("user", "b"), ("user", "late"), ("assistant", "x")])], "conv_id string, turn int, role string, text string")
    assert prompts.first_user_turns(turns).first()["context_text"] == "a\n\nb"
    assert prompts.first_user_turn(turns).first()["prompt_text"] == "a"
    assert prompts.render_chat(turns, generation_prompt=True).first()["rendered"].endswith("<|turn>model\nx<turn|>\n<|turn>model\n")


def test_media_bag(spark):
    df = spark.createDataFrame([({"images": ["old"], "other": ["o"]}, ["a", None, ""], "u")], "media map<string,array<string>>, images array<string>, url string")
    assert df.select(prompts.collected_media(df)).first()[0] == {"images": ["a"], "other": ["o"], "url": ["u"]}
    assert spark.range(1).select(prompts.collected_media(spark.range(1))).first()[0] == {}


def records(spark, rows):
    return spark.createDataFrame(rows, "id string, prompt_text string, context_text string, text string, prompt_source string, media map<string,array<string>>, estimated_tokens int")


def test_contract(spark):
    rows = [
        ("ok", "p", "", "t", "s", None, 1), ("none", " ", None, "t", "s", {}, 1), ("media", None, None, "t", "s", {"images": ["i"]}, 1), ("url", None, None, "t", "s", {"url": ["u"]}, 1),
        ("free", "p", None, "t", "prompt_free", None, 1), ("blank", "p", None, "　", "s", None, 1), ("null", "p", None, None, None, None, None),
    ]
    got = {r["id"]: r["violation"] for r in contract.validated(records(spark, rows), strict=False).collect()}
    assert got == {"ok": None, "none": "no_prompt", "media": None, "url": None, "free": "prompt_free", "blank": "no_text", "null": "no_text"}
    with pytest.raises(Exception, match="prompt_free"):
        contract.validated(records(spark, rows[4:5])).collect()
    assert contract.validated(records(spark, rows[:1])).count() == 1
    assert contract.validated(records(spark, rows).limit(0)).count() == 0


def test_output_filter(spark):
    texts = [None, "Hello there!", "503 error: service unavailable", "short", "word " * 50]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(contract.output_filter()).collect()] == ["empty", "greeting", "failure", "short", None]


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b")], "i int, t string")
    assert sorted((r["first_id"], r["copies"]) for r in contract.exact_duplicates(df, F.col("t"), "i").collect()) == [(1, 2), (3, 2)]
