from pyspark.sql import functions as F

from quern.functions import chat, text

Q = '<|"|>'
USER = {"role": "user", "content": " hi "}
CALL = {"role": "assistant", "tool_calls": [{"id": "1", "function": {"name": "f", "arguments": {"b": 1, "A": "x"}}}]}


def test_plain_turns():
    assert chat.render([]) == "<bos>"
    assert chat.render([], generation_prompt=True) == "<bos><|turn>model\n"
    assert chat.render([USER, {"role": "assistant", "content": "a<|channel>t<channel|> b "}], generation_prompt=True) == "<bos><|turn>user\nhi<turn|>\n<|turn>model\na b<turn|>\n<|turn>model\n"
    assert chat.render([{"role": "developer", "content": [{"text": " x "}, {"text": "y"}]}, USER], thinking=True) == "<bos><|turn>system\n<|think|>\nx y <turn|>\n<|turn>user\nhi<turn|>\n"


def test_a_call_without_an_answer_stays_open():
    call = f"<|tool_call>call:f{{A:{Q}x{Q},b:1}}<tool_call|>"
    assert chat.render([USER, CALL], generation_prompt=True) == f"<bos><|turn>user\nhi<turn|>\n<|turn>model\n{call}<|tool_response>"
    done = chat.render([USER, CALL, {"role": "tool", "tool_call_id": "1", "content": [{"type": "text", "text": "ok"}, {"type": "image"}]}], generation_prompt=True)
    assert done == f"<bos><|turn>user\nhi<turn|>\n<|turn>model\n{call}<|tool_response>response:f{{value:{Q}ok{Q}}}<tool_response|><|image|>"
    own = {**CALL, "tool_responses": [{"name": "f", "response": {"z": True}}], "content": "so"}
    assert chat.render([USER, own]).endswith(f"{call}<|tool_response>response:f{{z:true}}<tool_response|>so<turn|>\n")
    assert chat.render([USER, CALL, {"role": "tool", "name": "other", "content": "1"}, USER]).count("response:other{") == 1


def test_reasoning_is_printed_after_the_last_user_only():
    thought = {**CALL, "reasoning": "why"}
    assert "<|channel>thought\nwhy\n<channel|>" in chat.render([USER, thought])
    assert "thought" not in chat.render([USER, thought, USER]) and "thought" not in chat.render([USER, {"role": "assistant", "reasoning": "why", "content": "x"}])


def test_columns(spark):
    df = spark.createDataFrame([('[{"role": "user", "content": "a"}]', None), (None, None)], "m string, t string")
    assert [r[0] for r in df.select(chat.rendered(F.col("m"), F.col("t"))).collect()] == ["<bos><|turn>user\na<turn|>\n", None]
    assert chat.jsonable({"array": 1, "a": [{"bytes": 2, "b": None}]}) == {"a": [{"b": None}]}
    r = spark.range(1).select(text.response_parts(F.lit("<|channel>thought\nt\n<channel|><|tool_call>call:f{a:1}<tool_call|><|tool_call>bad<tool_call|>rest<|tool_response>x")).alias("r")).first()["r"]
    assert (r["thinking"], [tuple(c) for c in r["tool_calls"]], r["content"]) == ("t\n", [("f", "{a:1}")], "rest")
