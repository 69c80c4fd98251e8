from pyspark.sql import functions as F

from quern.functions import tools as T

Q = T.QUOTE


def test_literals():
    assert T.literal({"b": [1, True, None], "A": "x"}) == f"{{{Q}A{Q}:{Q}x{Q},{Q}b{Q}:[1,true,None]}}"
    assert T.literal({"b": 1.5}, False) == "{b:1.5}"


def test_declaration():
    tool = {"function": {"name": "f", "description": "d", "parameters": {"type": "object", "required": ["a"], "properties": {
        "a": {"type": "string", "description": "x", "enum": ["p", "q"]}, "b": {"type": "array", "items": {"type": "string"}, "nullable": True},
        "c": {"type": "object", "properties": {"z": {"type": "number"}}, "required": ["z"]}}}}}
    assert T.declaration(tool) == (
        f"declaration:f{{description:{Q}d{Q},parameters:{{properties:{{a:{{description:{Q}x{Q},enum:[{Q}p{Q},{Q}q{Q}],type:{Q}STRING{Q}}},"
        f"b:{{items:{{type:{Q}STRING{Q}}},nullable:true,type:{Q}ARRAY{Q}}},c:{{properties:{{z:{{type:{Q}NUMBER{Q}}}}},required:[{Q}z{Q}],type:{Q}OBJECT{Q}}}}},required:[{Q}a{Q}],type:{Q}OBJECT{Q}}}}}"
    )


def test_calls_and_responses(spark):
    assert T.call({"name": "f", "arguments": {"b": 1, "a": "x"}}) == f"<|tool_call>call:f{{a:{Q}x{Q},b:1}}<tool_call|>"
    calls = spark.createDataFrame([("c", "1", "weather")], "conv_id string, id string, name string")
    results = spark.createDataFrame([("c", 2, "1", None, '{"t": 3}'), ("c", 3, "9", None, '"plain"'), ("c", 4, None, "own", None)], "conv_id string, turn int, tool_call_id string, name string, content string")
    got = [r["rendered"] for r in T.responses(calls, results).orderBy("turn").collect()]
    assert got == ["<|tool_response>response:weather{t:3}<tool_response|>", f"<|tool_response>response:unknown{{value:{Q}plain{Q}}}<tool_response|>", "<|tool_response>response:own{value:None}<tool_response|>"]
    df = spark.createDataFrame([('{"a": [1]}',), (None,)], "j string")
    assert [r[0] for r in df.select(T.printed(T.literal, F.col("j"))).collect()] == [f"{{{Q}a{Q}:[1]}}", None]
