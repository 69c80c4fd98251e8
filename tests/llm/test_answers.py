import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.llm import answers as A
from quern.llm import endings
from quern.llm.truncation import censored_fit, cut_rates, find_cuts, find_limits, is_cut

PROMPT = "Explain how the steady lamp of the harbour guides the small boats before the storm arrives in autumn."
ANSWER = "The lamp turns every ten seconds. Its beam is seen from far away, and the boats keep it on their left until they pass the pier."


@pytest.mark.parametrize("text", [None, "", " \n", "\u200b\ufeff", "N/A", "null", "...", "**", "<p></p>", "&nbsp;", "A:", "Assistant: ", "```\n```", "[no output]", '""', "-"])
def test_empty(text):
    assert A.defect(PROMPT, text) == "empty"


@pytest.mark.parametrize("text", ["42", "8 km", "Berlin", "the old mill", "Yes.", "A", "北京", '{"a": 1, "b": [2]}', ANSWER, f"{PROMPT} {ANSWER}", f"{PROMPT}\n\n{ANSWER}",
                                  "I cannot see your files, but the general picture is clear. " + ANSWER, 'The reviewer marked replies that say "I\'m sorry, but I can\'t help with that". ' + ANSWER])
def test_good_answers(text):
    assert A.defect(PROMPT, text) is None


@pytest.mark.parametrize("text", [PROMPT, PROMPT.upper(), f"Question: {PROMPT}\nA:", PROMPT.replace("steady", "quiet").replace("autumn", "winter"), f"{PROMPT} {PROMPT}", f"  {PROMPT[:-12]}", PROMPT.replace(" ", "  ")])
def test_copies(text):
    assert A.defect(PROMPT, text) == "copied"


@pytest.mark.parametrize("text", ["I'm sorry, but I can't help with that.", "Sorry, this is something I cannot do. Please ask about something else.", "Leider kann ich dabei nicht helfen, denn es verstößt gegen meine Regeln.",
                                  "Lo siento, pero no puedo ayudar con eso.", "Je suis désolé, mais je ne peux pas vous aider sur ce point.", "Извините, но я не могу с этим помочь.", "很抱歉，我不能回答这个问题。",
                                  "The tides are an interesting subject. As a language model, I must decline to write about them."])
def test_refusals(text):
    assert A.defect(PROMPT, text) == "refusal"


LONG_REFUSAL = "I'm sorry, but I can't help with that. " + "Thank you for asking about the harbour. I must decline to write about it. I hope you understand that these limits apply. I won't discuss the lamp. " * 12


@pytest.mark.parametrize("text,name", [
    ("<p>&nbsp;</p>" * 40, "empty"), ("<div class='answer'>\n" * 30 + "</div>" * 30, "empty"), (LONG_REFUSAL, "refusal"), (LONG_REFUSAL + "I am unable to", "refusal"),
    (f"{PROMPT} " * 60, "copied"), ("".join(f"{k}. {PROMPT}\n" for k in range(400)), "copied"), (f"{PROMPT} " * 12 + (ANSWER + " ") * 12, None), (ANSWER * 12 + " I must decline to say more.", None), ("<p>" + ANSWER * 9 + "</p>", None),
])
def test_long_texts_are_judged_like_short_ones(text, name):
    assert A.defect(PROMPT, text) == name
    assert name is None or not is_cut(text, [], PROMPT, True)


def test_a_short_prompt_repeated_with_numbers_is_a_copy():
    assert A.defect("What is a lamp?", "".join(f"{k}: What is a lamp?\n" for k in range(300))) == "copied"


def test_other_language():
    french = "La lampe tourne toutes les dix secondes. Les bateaux la gardent à gauche, mais seulement avant la fin du port."
    assert A.defect(PROMPT, french) == "other_language"
    assert A.defect(PROMPT + " Please reply in French.", french) is None
    assert A.defect("Explique comment la lampe guide les bateaux. Responde en inglés.", ANSWER) is None
    assert A.defect(PROMPT, ANSWER + " «La lampe tourne toutes les dix secondes.»") is None
    assert A.defect(None, french) is None


@pytest.mark.parametrize("cut", ["The lamp turns every ten sec", ANSWER[:-20], ANSWER[:-1], "```python\nx = 1\n" + "y = 2", '{"a": 1, "b": ["c", "d', ANSWER + " The lam [truncated]", ANSWER + " The lam\ufffd", "Intro here.\n- one (a)\n- two (b)\n- thr"])
def test_cut_texts(cut):
    assert endings.Model().likely("The first sentence is whole. " + cut if cut[0] not in "`{I" else cut)
    assert A.defect(PROMPT, "The first sentence is whole. " + cut if cut[0] not in "`{I" else cut) == "truncated"


@pytest.mark.parametrize("whole", [ANSWER, "One sentence.\n- the lamp\n- the pier", ANSWER + "\n— Ada Lovelace", ANSWER + "\n#harbour", ANSWER + "\nhttp://harbour.example/lamp/", ANSWER + "\n(Ada, 1843)", ANSWER + " No. 4711.",
                                   "x = {1: 2}\nassert x[1] >= 1", "def f(a):\n    b = a + 1\n    return b", "```\nx = 1\n```", '"' + ANSWER + '"', "«" + ANSWER + "»", "<ul><li>a</li></ul>", "答案在这里。"])
def test_whole_texts(whole):
    assert endings.Model().evidence(whole)[0] < 0 and not endings.Model().likely(whole)


def test_contexts_are_fitted_on_the_values_themselves(spark):
    """Lists here end without a stop and are whole; sentences that end without one are cut."""
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abdeginorst") for _ in range(rnd.randrange(3, 8)))
    line = lambda n: " ".join(word() for _ in range(n))
    values = []
    for k in range(3000):
        body = " ".join(line(rnd.randrange(5, 12)).capitalize() + "." for _ in range(3))
        if k % 20 == 0:
            body = body[: len(body) - rnd.randrange(3, 25)].rstrip(" .")
        elif k % 3 == 0:
            body += "\n" + "\n".join(f"- {line(3)}" for _ in range(4))
        values.append((str(k), body))
    df = spark.createDataFrame(values, "key string, value string")
    model = endings.fit(df)
    assert 0.01 < model.shares["prose"] < 0.2
    assert [model.likely(v) for _, v in values] == [k % 20 == 0 for k in range(3000)]
    assert endings.fit(df, 600).odds.keys() <= model.odds.keys() and endings.fit(df.limit(0)) == endings.Model()


def test_length_decides_where_the_ending_says_little():
    """A bare phrase is whole by itself, and cut where its source censors most values of its length."""
    model = endings.model(Counter({"?phrase": 300, "=stop": 5000, "+sentence": 250}), Counter({"?phrase": 900, "+sentence": 9000}))
    value = "the early harbour lamp of the northern pier"
    assert endings.context(value) == "?phrase"
    assert not is_cut(value, [], model=model) and is_cut(value, [("chars", len(value), len(value), 0.9)], model=model)
    assert not is_cut(value, [("chars", len(value) + 1, len(value) + 9, 0.9)], model=model) and not is_cut(ANSWER, [("chars", len(ANSWER), len(ANSWER), 0.95)], model=model)


REC = "id string, prompt_text string, text string, context_text string, prompt_source string, source string, defect int, field string"
SPEC = "id string, name string"


def test_found_defects_count_an_id_once(spark):
    rows = [("a", PROMPT, None, None, "s", "x", 1, "y"), ("a", PROMPT, None, None, "s", "x", 1, "y"), ("b", PROMPT, ANSWER, None, "s", "x", 1, "y"), (None, PROMPT, None, None, "s", "x", 1, "y"), ("c", None, ANSWER * 3000, None, None, None, None, None)]
    df = spark.createDataFrame(rows, REC)
    assert [tuple(r) for r in A.find_defects(df).collect()] == [("a", "empty")]
    assert A.find_defects(df.limit(0)).count() == 0


def test_cut_values_by_field(spark):
    cut, copied = ANSWER + " And then the bo", PROMPT[:-1]
    rows = [("a", PROMPT, cut, cut, "s", None, 0, ""), ("a", PROMPT, cut, cut, "s", None, 0, ""), ("b", PROMPT, ANSWER, None, "S/", None, 0, ""), ("c", PROMPT, copied, "", None, None, 0, ""), ("d", PROMPT, None, ANSWER, "s", None, 0, ""), ("e", None, "I can't help with", None, "s", None, 0, "")]
    df, specs = spark.createDataFrame(rows, REC), spark.createDataFrame([("s", "name")], SPEC)
    assert sorted((r["id"], r["field"]) for r in find_cuts(df, specs).collect()) == [("a", "context_text"), ("a", "text")]
    rates = {(r["source"], r["field"]): (r["n_values"], r["n_cut"]) for r in cut_rates(df, specs).collect()}
    assert rates == {("s", "text"): (3, 1), ("s", "context_text"): (2, 1), ("", "text"): (1, 0)}
    assert find_cuts(df.limit(0), specs.limit(0)).count() == 0


def test_limits_are_found_by_censored_maximum_likelihood():
    import numpy as np

    rng = np.random.default_rng(3)
    x = np.round(np.exp(rng.normal(6, 0.5, 20_000))).astype(int)
    full = x.copy()
    cut = np.minimum(x, 700)
    length, count = np.unique(cut, return_counts=True)
    mu, sd = censored_fit(length.astype(float), count.astype(float), np.where(length == 700, count, 0).astype(float))
    assert abs(mu - np.log(full).mean()) < 0.02 and abs(sd - np.log(full).std()) < 0.02
    found = find_limits(length, count)
    assert any(lo <= 700 <= hi and p > 0.9 for lo, hi, p in found)
    length, count = np.unique(full, return_counts=True)
    assert not any(p > 0.9 and count[(length >= lo) & (length <= hi)].sum() > 200 for lo, hi, p in find_limits(length, count))
    assert find_limits(np.array([]), np.array([])) == []


def test_word_wise_limits_are_ranges_at_every_size():
    import numpy as np

    for n in (300, 3_000, 60_000):
        rng = np.random.default_rng(n)
        x = np.round(np.exp(rng.normal(6, 0.5, n))).astype(int)
        for limit in (700, 480):  # at the end of all lengths, and below longer texts of which only some are cut
            over = (x > limit) & ((limit == 700) | (rng.random(n) < 0.5))
            cut = np.where(over, limit - rng.integers(0, 10, n), x)
            found = find_limits(*np.unique(cut, return_counts=True))
            assert all(max([p for lo, hi, p in found if lo <= v <= hi], default=0) > 0.5 for v in range(limit - 9, limit + 1))


def test_all_significant_limits_are_kept():
    import numpy as np

    x = np.round(np.exp(np.random.default_rng(1).normal(6, 0.5, 20_000))).astype(int)
    limits = range(200, 750, 45)
    found = find_limits(*np.unique(np.concatenate([x, *[np.full(300 + v, v) for v in limits]]), return_counts=True))
    assert {v for v in limits if any(lo == hi == v and p > 0.7 for lo, hi, p in found)} == set(limits)


def test_endings_of_responses_are_fitted_on_all_of_them(spark):
    """Thirty lists among 30,000 responses end with a comma and are whole: too few of them in any sample of 8,000 to tell."""
    rows = spark.range(30_000).select(
        F.format_string("r%05d", "id").alias("id"), F.lit(None).cast("string").alias("prompt_text"),
        F.when(F.col("id") % 1000 == 7, F.format_string("Jobs:\n- lamp %d,\n- pier,", "id")).otherwise("The lamp turns.").alias("text"),
    )
    assert endings.context("Jobs:\n- lamp 7,\n- pier,") == "+item" and endings.Model().likely("Jobs:\n- lamp 7,\n- pier,")
    assert A.find_defects(rows).collect() == []


def test_endings_of_values_are_fitted_on_all_of_them(spark):
    """Sixty-one lists among 40,000 values end with a comma and are whole: too few of them in any sample of 8,000 to tell."""
    rows = spark.range(20_000).select(
        F.format_string("r%05d", "id").alias("id"), F.lit(None).cast("string").alias("prompt_text"), F.lit("The lamp turns.").alias("text"),
        F.when(F.col("id") % 333 == 7, F.format_string("Jobs:\n- lamp %d,\n- pier,", "id")).otherwise("The boats wait.").alias("context_text"),
        F.lit("s").alias("prompt_source"),
    )
    assert find_cuts(rows, spark.createDataFrame([("s", "name")], SPEC)).collect() == []
