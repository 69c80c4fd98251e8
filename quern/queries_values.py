"""Queries of records, conversations, arrays and inventories over values built from the test tables, beside their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import arrays, chat, tools
from quern.functions import text as X
from quern.operators import artifacts, blocks, contract, flow, prompts, scores, weights
from quern.queries import _LISTS, _ENTROPY, query, stripped, table

# --- records and fields -----------------------------------------------------------------------------------------------


@query(
    f"""select doc_id, md5(case doc_id % 6 when 0 then {stripped('text')} when 1 then coalesce(n_chars::varchar, '') when 2 then case when n_chars > 500 then 'True' when n_chars <= 500 then 'False' else '' end else '' end) as text_md5
    from documents"""
)
def as_text_of_any_value(spark, d):
    """Strings, numbers, booleans, nulls, lists and objects as text."""
    t = table(spark, d, "documents")
    whole = lambda c: F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    k = F.col("doc_id") % 6
    j = F.when(k == 0, whole(F.col("text"))).when(k == 1, whole(F.col("n_chars"))).when(k == 2, whole(F.col("n_chars") > 500)).when(k == 3, whole(F.array("lang", "source"))).when(k == 4, whole(F.struct("lang"))).otherwise(whole(F.lit(None).cast("string")))
    v = F.variant_get(F.parse_json(j), "$.v", "variant")
    return t.select("doc_id", F.md5(X.as_text(v)).alias("text_md5"))


_ROLE = "case runtime when 'lmstudio' then 'user' when 'llamacpp' then 'assistant' when 'ollama' then ' Human ' else 'system' end"
_MINE = f"lower({stripped(_ROLE)}) in ('user', 'human', 'prompter', 'client')"


@query(
    f"""select id, n_messages, md5(case when mine and p <> '' then p when c <> '' then c else p end) as prompt_md5, md5(concat_ws(chr(10) || chr(10), case when mine then nullif(p, '') end, nullif(c, ''))) as context_md5
    from (select distinct id, 3 as n_messages, {_MINE} as mine, {stripped('prompt_text')} as p, {stripped('context_text')} as c, {stripped('text')} as t from teacher_records)"""
)
def nested_messages(spark, d):
    """Message lists with differently named fields: the user's prompt and context."""
    s = "string"
    m = lambda **f: F.struct(*[(f[k] if k in f else F.lit(None)).cast(s).alias(k) for k in (*X.MESSAGE_ROLE_FIELDS, *X.MESSAGE_TEXT_FIELDS)])
    t = table(spark, d, "teacher_records")
    three = F.array(m(**{"from": F.expr(_ROLE), "value": F.col("prompt_text")}), m(role=F.lit("assistant"), content=F.col("text")), F.lit(None).cast(prompts.MESSAGE.elementType), m(speaker=F.lit("human"), text=F.lit(" "), message=F.col("context_text")))
    t = t.select("id", three.alias("conversations")).distinct()
    return t.select("id", F.size(prompts.messages(t)).alias("n_messages"), F.md5(prompts.user_prompt(t)).alias("prompt_md5"), F.md5(prompts.context(t)).alias("context_md5"))


def _joined(key: str) -> str:
    return f"array_to_string({_LISTS.format(key)}, ',')"


@query(
    f"""select distinct id, case when modality = 'image' then 'img/' || id || '.png' when {_joined('images')} <> '' then {_joined('images')} end as images,
    case when coalesce(context_text, '') <> '' then 'a/' || id || ',b' when {_joined('audio')} <> '' then {_joined('audio')} end as audio, 'https://h.example/' || id as url from prompt_records"""
)
def collected_media(spark, d):
    """Media map, image, audios and url of a row as one map; later fields overwrite earlier ones."""
    t = table(spark, d, "prompt_records")
    clean = F.transform_values("media", lambda k, v: F.filter(v, lambda x: x.isNotNull() & (x != "")))
    t = t.select("id", clean.alias("media"), F.when(F.col("modality") == "image", F.concat(F.lit("img/"), "id", F.lit(".png"))).alias("image"),
                 F.when(F.coalesce("context_text", F.lit("")) != "", F.array(F.concat(F.lit("a/"), "id"), F.lit(None), F.lit("b"))).alias("audios"), F.concat(F.lit("https://h.example/"), "id").alias("url"))
    m = prompts.collected_media(t)
    at = lambda k: F.array_join(F.try_element_at(m, F.lit(k)), ",").alias(k)
    return t.select("id", at("images"), at("audio"), at("url")).distinct()


@query("select doc_id, case when lang is null then 0 else 1 end as n, lang as first from documents")
def as_list(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(X.as_list("lang")).alias("n"), F.get(X.as_list("lang"), F.lit(0)).alias("first"))


@query(
    """select doc_id, '{"doc_id":' || doc_id || ',"nested":{"keep":[{"n":' || (doc_id % 7) || '}]}}' as kept from documents"""
)
def without_raw_media(spark, d):
    """JSON without the keys that hold raw media, at any depth."""
    one = F.struct((F.col("doc_id") % 7).alias("n"), F.lit("x").alias("bytes"))
    j = F.to_json(F.struct("doc_id", F.array(F.lit(1)).alias("array"), F.struct(F.lit("y").alias("bytes"), F.array(one).alias("keep")).alias("nested")))
    return table(spark, d, "documents").select("doc_id", chat.without_raw_media(j).alias("kept"))


@query(
    f"""select id, md5({stripped("coalesce(prompt_text, '')")}) as thinking_md5, case when coalesce(estimated_tokens, 0) % 2 = 0 then 1 else 0 end as calls,
    case when coalesce(estimated_tokens, 0) % 2 = 0 then 'lookup {{q:<|"|>' || runtime || '<|"|>,n:' || coalesce(estimated_tokens, 0) || '}}' end as call, md5(coalesce(text, '')) as content_md5
    from (select distinct id, prompt_text, text, runtime, estimated_tokens from teacher_records)"""
)
def response_parts(spark, d):
    """Thought, tool calls and content of a response in the channel format."""
    t = table(spark, d, "teacher_records").select("id", "prompt_text", "text", "runtime", "estimated_tokens").distinct()
    n = F.coalesce("estimated_tokens", F.lit(0))
    call = F.when(n % 2 == 0, F.concat(F.lit('<|tool_call>call:lookup{q:<|"|>'), "runtime", F.lit('<|"|>,n:'), n.cast("string"), F.lit("}<tool_call|>"))).otherwise("")
    whole = F.concat(F.lit("<|channel>thought\n"), X.strip(F.coalesce("prompt_text", F.lit(""))), F.lit("<channel|>"), call, F.coalesce("text", F.lit("")), F.lit("<turn|>\n"))
    r = t.select("id", X.response_parts(whole).alias("r"))
    first = F.get("r.tool_calls", F.lit(0))
    return r.select("id", F.md5("r.thinking").alias("thinking_md5"), F.size("r.tool_calls").alias("calls"), F.concat_ws(" ", F.nullif(first["name"], F.lit("")), first["arguments"]).alias("c"), F.md5("r.content").alias("content_md5")).select(
        "id", "thinking_md5", "calls", F.nullif("c", F.lit("")).alias("call"), "content_md5"
    )


# --- tools and conversations ------------------------------------------------------------------------------------------

_Q = '<|"|>'
_OUTSIDE = "array_to_string([split_part(p, '<|channel>', 1) for p in string_split(coalesce(text, ''), '<channel|>')], '')"


@query(f"""select p_partkey, '{{{_Q}brand{_Q}:{_Q}' || p_brand || '{_Q},{_Q}new{_Q}:' || (p_size > 25)::varchar || ',{_Q}size{_Q}:' || p_size || ',{_Q}Tags{_Q}:[{_Q}' || p_type || '{_Q},{_Q}x{_Q}]}}' as literal from part""")
def tool_literals(spark, d):
    """JSON values as the chat template prints them: keys sorted without regard to case."""
    v = F.struct(F.col("p_size").alias("size"), F.array("p_type", F.lit("x")).alias("Tags"), (F.col("p_size") > 25).alias("new"), F.col("p_brand").alias("brand"))
    return table(spark, d, "part").select("p_partkey", tools.printed(tools.literal, F.to_json(v)).alias("literal"))


@query(
    f"""select p_partkey, 'declaration:get_' || p_size || '{{description:{_Q}' || p_brand || '{_Q},parameters:{{properties:{{kind:{{description:{_Q}a kind{_Q},enum:[{_Q}' || p_type || '{_Q}],type:{_Q}STRING{_Q}}},'
    || 'sizes:{{items:{{type:{_Q}NUMBER{_Q}}},nullable:true,type:{_Q}ARRAY{_Q}}}}},required:[{_Q}kind{_Q}],type:{_Q}OBJECT{_Q}}}}}' as declaration from part"""
)
def tool_declarations(spark, d):
    parameters = F.expr(
        "named_struct('type', 'object', 'required', array('kind'), 'properties', named_struct('sizes', named_struct('type', 'array', 'nullable', true, 'items', named_struct('type', 'number')), "
        "'kind', named_struct('type', 'string', 'description', 'a kind', 'enum', array(p_type))))"
    )
    f = F.struct(F.concat(F.lit("get_"), F.col("p_size").cast("string")).alias("name"), F.col("p_brand").alias("description"), parameters.alias("parameters"))
    return table(spark, d, "part").select("p_partkey", tools.printed(tools.declaration, F.to_json(F.struct(f.alias("function")))).alias("declaration"))


@query(
    f"""select p_partkey as turn, case when p_partkey % 3 = 0 then '<|tool_response>response:lookup{{value:{_Q}' || p_brand || '{_Q}}}<tool_response|>'
    when p_partkey % 3 = 1 then '<|tool_response>response:own{{brand:{_Q}' || p_brand || '{_Q},size:' || p_size || '}}<tool_response|>' else '<|tool_response>response:unknown{{value:' || p_size || '}}<tool_response|>' end as rendered from part"""
)
def tool_responses(spark, d):
    """Tool results under the name of the call they answer, else under their own name, else unknown."""
    p = table(spark, d, "part")
    k = F.col("p_partkey") % 3
    calls = p.where(k == 0).select(F.lit("c").alias("conv_id"), F.col("p_partkey").cast("string").alias("id"), F.lit("lookup").alias("name"))
    content = F.when(k == 0, F.concat(F.lit('"'), "p_brand", F.lit('"'))).when(k == 1, F.to_json(F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand")))).otherwise(F.col("p_size").cast("string"))
    results = p.select(F.lit("c").alias("conv_id"), F.col("p_partkey").alias("turn"), F.col("p_partkey").cast("string").alias("tool_call_id"), F.when(k == 1, "own").alias("name"), content.alias("content"))
    return tools.responses(calls, results).select("turn", "rendered")


@query(
    f"""select id, md5('<bos><|turn>system' || chr(10) || {stripped('context_text')} || '<|tool>declaration:lookup{{description:{_Q}finds{_Q}}}<tool|><turn|>' || chr(10) || '<|turn>user' || chr(10) || {stripped('prompt_text')} || '<turn|>' || chr(10)
    || '<|turn>model' || chr(10) || '<|channel>thought' || chr(10) || 'look it up' || chr(10) || '<channel|>' || '<|tool_call>call:lookup{{n:3,q:{_Q}' || runtime || '{_Q}}}<tool_call|>'
    || '<|tool_response>response:lookup{{value:{_Q}' || runtime || '{_Q}}}<tool_response|>' || {stripped('text')} || '<turn|>' || chr(10)) as rendered_md5
    from (select distinct id, context_text, prompt_text, {_OUTSIDE} as text, runtime from teacher_records)"""
)
def chat_template(spark, d):
    """System and tool block, a thought before a call, the tool's answer, and the model's next message in the same turn."""
    return _template(spark, d, late_user=False).select("id", F.md5("rendered").alias("rendered_md5"))


@query(
    f"""select id, md5('<bos><|turn>system' || chr(10) || {stripped('context_text')} || '<|tool>declaration:lookup{{description:{_Q}finds{_Q}}}<tool|><turn|>' || chr(10) || '<|turn>user' || chr(10) || {stripped('prompt_text')} || '<turn|>' || chr(10)
    || '<|turn>model' || chr(10) || '<|tool_call>call:lookup{{n:3,q:{_Q}' || runtime || '{_Q}}}<tool_call|>'
    || '<|tool_response>response:lookup{{value:{_Q}' || runtime || '{_Q}}}<tool_response|>' || {stripped('text')} || '<turn|>' || chr(10) || '<|turn>user' || chr(10) || 'and now?<|image|><turn|>' || chr(10) || '<|turn>model' || chr(10)) as rendered_md5
    from (select distinct id, context_text, prompt_text, {_OUTSIDE} as text, runtime from teacher_records)"""
)
def chat_template_guard(spark, d):
    """The thought is left out where a user speaks after the call; media parts; the prompt for the next turn."""
    return _template(spark, d, late_user=True).select("id", F.md5("rendered").alias("rendered_md5"))


def _template(spark, d, late_user: bool) -> DataFrame:
    t = table(spark, d, "teacher_records").select("id", "context_text", "prompt_text", F.coalesce("text", F.lit("")).alias("text"), "runtime").distinct()
    j = lambda **f: F.to_json(F.struct(*[v.alias(k) for k, v in f.items()]))
    arguments = F.struct(F.col("runtime").alias("q"), F.lit(3).alias("n"))
    call = F.array(F.struct(F.lit("c1").alias("id"), F.struct(F.lit("lookup").alias("name"), arguments.alias("arguments")).alias("function")))
    turns = [
        j(role=F.lit("system"), content=F.col("context_text")), j(role=F.lit("user"), content=F.coalesce("prompt_text", F.lit(""))), j(role=F.lit("assistant"), reasoning=F.lit("look it up"), tool_calls=call),
        j(role=F.lit("tool"), tool_call_id=F.lit("c1"), content=F.col("runtime")), j(role=F.lit("assistant"), content=F.col("text")),
    ]
    if late_user:
        turns.append(F.lit('{"role": "user", "content": [{"type": "text", "text": " and now? "}, {"type": "image"}]}'))
    messages = F.concat(F.lit("["), F.concat_ws(",", *turns), F.lit("]"))
    declared = F.lit('[{"function": {"name": "lookup", "description": "finds"}}]')
    return t.select("id", chat.rendered(messages, declared, generation_prompt=late_user).alias("rendered"))


_TOOL_ROLE = "case event_type when 'click' then 'user' when 'view' then 'tool' when 'purchase' then 'assistant' else 'system' end"


@query(f"select event_id, role, last_value(case when role <> 'tool' then role end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as previous_role from (select *, {_TOOL_ROLE} as role from events)")
def previous_role(spark, d):
    t = table(spark, d, "events").select("user_id", "event_id", F.expr(_TOOL_ROLE).alias("role"))
    return prompts.previous_roles(t, "user_id", "event_id").select("event_id", "role", "previous_role")


@query(
    f"""select event_id, turn_index, coalesce(u, -1) as last_user_index, turn_index > coalesce(u, -1) as after_last_user from (select *, max(case when role = 'user' then turn_index end) over (partition by user_id) as u
    from (select user_id, event_id, {_TOOL_ROLE} as role, row_number() over (partition by user_id order by event_id) - 1 as turn_index from events))"""
)
def last_user_turn(spark, d):
    t = table(spark, d, "events").select("user_id", "event_id", F.expr(_TOOL_ROLE).alias("role"))
    return prompts.after_last_user(t, "user_id", "event_id").select("event_id", "turn_index", "last_user_index", "after_last_user")


# --- filters and settings ---------------------------------------------------------------------------------------------


@query(f"select runtime, count(*) as records, sum((runtime = 'ollama' and {' + '.join(f'len({_LISTS.format(k)})' for k in ('images', 'image', 'audio', 'media_path', 'url'))} > 0)::int)::bigint as refused from teacher_records group by 1")
def media_refused(spark, d):
    return table(spark, d, "teacher_records").groupBy("runtime").agg(F.count("*").alias("records"), F.count_if(contract.media_refused()).alias("refused"))


@query("select id, prompt_source from teacher_records where coalesce(metadata['target_policy'] = 'teacher_generated_output_only', false) and coalesce(prompt_source, '') not in ('quafer/edu_pages', 'retired_bank')")
def policy_filter(spark, d):
    return flow.policy_filter(table(spark, d, "teacher_records"), prompts.TARGET_POLICY, ["quafer/edu_pages", "retired_bank"]).select("id", "prompt_source")


@query("select event_id, user_id from events order by event_id limit 320")
def first_batches(spark, d):
    return flow.first_batches(table(spark, d, "events"), ["event_id"], 32, 10).select("event_id", "user_id")


@query("select event_id, user_id from events where event_id <= 5000 and user_id < 300")
def within_steps(spark, d):
    return scores.within_steps(table(spark, d, "events"), "event_id", 5000, "user_id", 300).select("event_id", "user_id")


_NAMES = "case p_size % 4 when 0 then 'm/config.json' when 1 then 'm/tokenizer.model' when 2 then 'm/model-0000' || (p_size % 9) || '.safetensors' else 'm/notes.txt' end"


@query(
    f"""select p_brand, true as exists, bool_or(p = 'm/config.json') as has_config, bool_or(p = 'm/tokenizer.model') as has_tokenizer, bool_or(p like 'm/model-%') as has_weights, bool_or(p = 'm/notes.txt' and contains(p_name, 'a')) as noted
    from (select *, {_NAMES} as p from part) group by 1"""
)
def artifact_files(spark, d):
    """Which files the folder of each model has, and whether its notes hold a text."""
    f = table(spark, d, "part").select("p_brand", F.expr(_NAMES).alias("path"), F.col("p_name").alias("text"))
    return artifacts.artifact_report(f, by=("p_brand",)).join(artifacts.text_checks(f, {"noted": ("/notes.txt", ["a"])}, by=("p_brand",)), "p_brand")


@query("select p_partkey, p_size * 2.0::DOUBLE >= 80 as within from part")
def capacity_flag(spark, d):
    return table(spark, d, "part").select("p_partkey", artifacts.within_memory(F.col("p_size") * 2.0).alias("within"))


@query(
    """select p_partkey, p_size::varchar as hidden_size, 'all' as use_bidirectional_attention, '30.0' as final_logit_softcapping, case when p_size % 2 = 0 then p_size::varchar else '1' end as num_experts,
    case when p_size % 2 = 0 then null else '1' end as top_k_experts, case when p_size % 2 = 0 then null else p_partkey::varchar end as moe_intermediate_size, '4' as num_global_key_value_heads, null::varchar as other,
    case when p_size % 3 = 0 then p_size::int else 258880 end as image_token_id, 255999 as boi_token_id from part"""
)
def text_settings(spark, d):
    """Settings that are kept, forced and defaulted, and token ids with defaults."""
    p = table(spark, d, "part")
    s = lambda c: F.col(c).cast("string")
    given = F.map_from_arrays(
        F.array(*[F.lit(x) for x in ("hidden_size", "intermediate_size", "num_key_value_heads", "num_experts", "other", "image_token_id")]),
        F.array(s("p_size"), s("p_partkey"), F.lit("4"), F.when(F.col("p_size") % 2 == 0, s("p_size")), F.lit("x"), F.when(F.col("p_size") % 3 == 0, s("p_size"))),
    )
    r = p.select("p_partkey", artifacts.text_settings(given).alias("m"), artifacts.token_ids(given).alias("t"))
    names = ("hidden_size", "use_bidirectional_attention", "final_logit_softcapping", "num_experts", "top_k_experts", "moe_intermediate_size", "num_global_key_value_heads", "other")
    return r.select("p_partkey", *[F.try_element_at("m", F.lit(n)).alias(n) for n in names], "t.image_token_id", "t.boi_token_id")


# --- arrays -----------------------------------------------------------------------------------------------------------

_Z = "[x::double for x in embedding]"


@query(
    f"""select vec_id, round(list_sum([30 * (exp(2 * x / 30) - 1) / (exp(2 * x / 30) + 1) for x in {_Z}]), 6) as capped, list_position({_Z}, list_min({_Z})) - 1 as lowest,
    len(list_filter(ids, lambda x: x = 9)) as placeholders, case when len(list_filter(ids, lambda x: x = 9)) = 3 then list_sum(list_filter(ids, lambda x: x <> 9)) + 600 end::bigint as filled,
    list_sum([x + label for x in range(0, 5)])::bigint as positions, len(ids) + least(4, label) as committed, round((embedding[1]::double + embedding[2]::double) / 2, 6) as mono
    from (select *, [(vec_id % 11), (vec_id % 10), 9, (label % 10), 4, 9] as ids from embeddings)"""
)
def array_kernels(spark, d):
    """Soft caps, least positions, placeholders and their values in order, position ids, committed canvases, averaged channels."""
    n = lambda c: F.col(c).cast("bigint")
    ids = F.array(n("vec_id") % 11, n("vec_id") % 10, F.lit(9).cast("bigint"), n("label") % 10, F.lit(4).cast("bigint"), F.lit(9).cast("bigint"))
    e = table(spark, d, "embeddings").withColumn("ids", ids)
    total = lambda c, z: F.aggregate(c, z, lambda a, x: a + x)
    zero = F.lit(0).cast("bigint")
    values = F.array(*[F.lit(x).cast("bigint") for x in (100, 200, 300)])
    frames = F.array(F.slice(F.transform("embedding", lambda x: x.cast("double")), 1, 2))
    return e.select(
        "vec_id", F.round(total(F.transform("embedding", lambda x: arrays.softcap(x.cast("double"), 30.0)), F.lit(0.0)), 6).alias("capped"), arrays.argmin("embedding").alias("lowest"),
        F.size(F.filter(arrays.placeholder_mask("ids", 9), lambda x: x)).alias("placeholders"), total(arrays.fill_placeholders("ids", 9, values), zero).alias("filled"),
        total(arrays.position_ids(F.lit(5), F.col("label").cast("int")), F.lit(0)).cast("bigint").alias("positions"), F.size(arrays.commit_canvas("ids", values_of(4), F.col("label").cast("int"))).alias("committed"),
        F.round(F.get(arrays.mono(frames), F.lit(0)), 6).alias("mono"),
    )


def values_of(n: int):
    return F.array(*[F.lit(x).cast("bigint") for x in range(n)])


@query(
    """select label % 3 as kind, count(distinct md5(case label % 3 when 0 then '' when 1 then 'pixel_values:64' else 'input_features:64' end)) as signatures, count(*) as rows,
    case label % 3 when 0 then 'text' when 1 then 'image' else 'audio' end as family from embeddings group by 1, 4"""
)
def feature_signatures(spark, d):
    """Records with the same features, whatever their values and order, have one signature."""
    k = F.col("label") % 3
    one = lambda name: F.struct(F.lit(name).alias("name"), F.array(F.size("embedding")).alias("shape"), F.col("embedding").alias("values"))
    features = F.when(k == 1, F.array(one("pixel_values"))).when(k == 2, F.array(one("input_features")))
    features = F.coalesce(features, F.filter(F.array(one("none")), lambda x: F.lit(False)))
    e = table(spark, d, "embeddings").select(k.alias("kind"), blocks.signature_of(features).alias("s"), arrays.family(F.transform(features, lambda x: x["name"])).alias("family"))
    return e.groupBy("kind", "family").agg(F.countDistinct("s").alias("signatures"), F.count("*").alias("rows"))


@query(
    """select user_id, count(*) as rows, case when count(value) = count(*) then md5(array_to_string(list(round(value * 100)::bigint order by event_id), ',')) end as value_md5,
    case when count(case when event_id % 2 = 0 then 1 end) = count(*) then 1 end as odd from events group by 1"""
)
def stacked_batches(spark, d):
    """Values of a batch in order; a feature that a row lacks is left out."""
    e = table(spark, d, "events").select("user_id", "event_id", F.round(F.col("value") * 100).cast("bigint").cast("string").alias("v"), F.when(F.col("event_id") % 2 == 0, 1).alias("odd"))
    s = blocks.stacked(e, "user_id", "event_id", ["v", "odd"])
    return s.select("user_id", "rows", F.when(F.col("v").isNotNull(), F.md5(F.array_join("v", ","))).alias("value_md5"), F.when(F.col("odd").isNotNull(), 1).alias("odd"))


@query(f"select label, round(avg(h), 9) as mean_entropy, round(avg((h <= 4.13)::int), 9) as accepted_fraction from (select label, round({_ENTROPY}, 9) as h from embeddings) group by 1")
def entropy_steps(spark, d):
    e = scores.entropies(table(spark, d, "embeddings"), "embedding").select("label", F.round("entropy", 9).alias("entropy"))
    s = scores.step_summary(e, 4.13, ["label"])
    return s.select("label", F.round("mean_entropy", 9).alias("mean_entropy"), F.round("accepted_fraction", 9).alias("accepted_fraction"))


# --- inventories ------------------------------------------------------------------------------------------------------

@query(
    """select 'model.decoder.layers.' || p_partkey || '.experts.' || s as key, case when s = 'gate_up_proj' and p_partkey % 5 = 0 then null when s = 'router.proj.weight' then null
    when s = 'gate_up_proj' then (case when p_partkey % 4 = 0 then 'language_model.model' else 'model' end) || '.layers.' || p_partkey || '.mlp.gate_proj.weight+model.layers.' || p_partkey || '.mlp.up_proj.weight'
    else (case when p_partkey % 4 = 0 then 'language_model.model' else 'model' end) || '.layers.' || p_partkey || '.mlp.gate_proj.weight' end as source,
    case when s = 'gate_up_proj' and p_partkey % 5 = 0 then 'missing_source' when s = 'gate_up_proj' and p_partkey % 4 = 0 then 'shape_mismatch' else 'composed' end as status
    from part, (values ('gate_up_proj')) v(s)"""
)
def fused_experts(spark, d):
    """Fused projections from two base projections; of base keys with one suffix the last counts; a projection without its mate has no source."""
    p = table(spark, d, "part")
    shape = lambda rows: F.array(rows.cast("int"), F.lit(8))
    key = lambda prefix, tail: F.concat(F.lit(prefix + ".layers."), F.col("p_partkey").cast("string"), F.lit(tail))
    parts = [(n, p if n != "up_proj" else p.where("p_partkey % 5 <> 0")) for n in ("gate_proj", "up_proj", "down_proj")]
    base = None
    for n, rows in parts:
        b = rows.select(key("model", f".mlp.{n}.weight").alias("key"), shape(F.col("p_size")).alias("shape"), F.lit(0).alias("ord"))
        base = b if base is None else base.unionByName(b)
    again = p.where("p_partkey % 4 = 0").select(key("language_model.model", ".mlp.gate_proj.weight").alias("key"), shape(F.col("p_size") + 1).alias("shape"), F.lit(1).alias("ord"))
    target = p.select(key("model.decoder", ".experts.gate_up_proj").alias("key"), F.array(F.lit(1), (F.col("p_size") * 2).cast("int"), F.lit(8)).alias("shape"))
    return weights.match(base.unionByName(again), target).select("key", "source", "status")


_REPORTS = "(select p_brand, case p_size % 3 when 0 then 'vision_tower' when 1 then 'vision_projector' else 'audio_tower' end as family, p_partkey % 2 = 0 as ok from part)"


@query(
    f"""with r as (select family, count(*) as target, sum(ok::int) as copied, sum((not ok)::int) as missing from {_REPORTS} group by 1),
    f as (select bool_or(family = 'vision_tower') and bool_or(family = 'vision_projector') as image, bool_and(case when family like 'vision%' then missing = 0 end) as image_full, coalesce(sum(missing), 0) as missing from r)
    select concat_ws(',', case when missing > 0 then 'missing_source_count=' || missing::bigint end, 'load_missing_count=3', case when image and not image_full then 'image_text_partial_copy' end) as problems,
    coalesce(image, false) as image_text_target_present, coalesce(image and image_full, false) as image_text_fully_copied, false as audio_text_target_present, false as audio_text_fully_copied from f"""
)
def transplant_problems(spark, d):
    """What forbids an export: missing sources, keys that a load misses, towers that are there but incomplete."""
    p = table(spark, d, "part")
    family = F.expr("case p_size % 3 when 0 then 'vision_tower' when 1 then 'vision_projector' else 'audio_tower' end")
    matched = p.select(family.alias("family"), F.when(F.col("p_partkey") % 2 == 0, "copied").otherwise("missing_source").alias("status"))
    report = weights.coverage(matched)
    differences = spark.createDataFrame([(str(k), "missing") for k in range(3)], "key string, difference string")
    return weights.problems(report, differences).select(F.array_join("problems", ",").alias("problems")).join(weights.flags(report), F.lit(True))


@query("select p_brand, min(p_partkey) as p_partkey from part where p_size % 3 = 0 group by 1")
def first_that_loads(spark, d):
    """Of ordered candidates, the first that succeeds."""
    p = table(spark, d, "part").where("p_size % 3 = 0")
    return weights.ordered_first(p, "p_brand", "p_partkey").select("p_brand", "p_partkey")


@query("select p_partkey, round_even(p_size * p_partkey * 4096.0::DOUBLE / 1073741824, 2) as activations_gib from part")
def activation_floors(spark, d):
    return table(spark, d, "part").select("p_partkey", weights.activation_floor(F.col("p_size"), F.col("p_partkey")).alias("activations_gib"))
