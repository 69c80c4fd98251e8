"""Queries of the reference's operators over the test tables, each beside its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions import arrays, rng
from quern.functions import text as X
from quern.operators import blocks, contract, flow, prompts, scores, weights
from quern.sources import readers
from quern.storage import new_folder, prefix_sums, stored
from quern.streaming import streams

FLAGSHIP = "estimate_tokens_by_source"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"  # DuckDB's notation of the white space class


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("{WS}", WS)
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def squeezed(x: str) -> str:
    return f"coalesce(trim(regexp_replace({x}, '{{WS}}+', ' ', 'g')), '')"


def cleaned(x: str, n: int) -> str:
    s = squeezed(x)
    return f"case when length({s}) <= {n} then {s} else trim(regexp_replace(substr({s}, 1, {n}), ' [^ ]*$', '')) end"


def stripped(x: str) -> str:
    return f"coalesce(regexp_replace({x}, '^{{WS}}+|{{WS}}+$', '', 'g'), '')"


# --- scalar functions -------------------------------------------------------------------------------------------------


@query(f"select doc_id, md5(c) as clean_md5, length(c) as clean_chars from (select doc_id, {cleaned('text', 1200)} as c from documents)")
def clean_text_clip(spark, d):
    c = X.clean_text("text", 1200)
    return table(spark, d, "documents").select("doc_id", F.md5(c).alias("clean_md5"), F.char_length(c).alias("clean_chars"))


@query(
    f"""select coalesce(source, '') as source, count(*) as documents, sum(greatest(1, strlen(c) // 4))::bigint as estimated_tokens, sum((c = '')::int)::bigint as no_text
    from (select source, {cleaned('text', 12000)} as c from documents) group by 1"""
)
def estimate_tokens_by_source(spark, d):
    t = table(spark, d, "documents").select(F.coalesce("source", F.lit("")).alias("source"), X.clean_text("text").alias("text"))
    return t.groupBy("source").agg(F.count("*").alias("documents"), F.sum(X.estimate_tokens("text")).alias("estimated_tokens"), F.count_if(F.col("text") == "").alias("no_text"))


@query(f"select id, md5(case when {stripped('context_text')} <> '' then {stripped('context_text')} else {stripped('prompt_text')} end) as first_md5 from prompt_records")
def first_text_coalesce(spark, d):
    return table(spark, d, "prompt_records").select("id", F.md5(X.first_text("context_text", "prompt_text")).alias("first_md5"))


@query(
    f"""select id, md5(case when c <> '' and p <> '' then c || chr(10) || chr(10) || p when c <> '' then c else p end) as prompt_md5,
    md5(case when c = '' or c = p then p when p = '' then c else c || chr(10) || chr(10) || p end) as prefix_md5
    from (select id, {stripped('context_text')} as c, {stripped('prompt_text')} as p from prompt_records) where c <> '' or p <> ''"""
)
def build_prompts(spark, d):
    t = table(spark, d, "prompt_records").where(X.build_prompt("prompt_text", "context_text", strict=False).isNotNull())
    return t.select("id", F.md5(X.build_prompt("prompt_text", "context_text")).alias("prompt_md5"), F.md5(X.prefix_text("prompt_text", "context_text")).alias("prefix_md5"))


@query("select id, regexp_replace(id, '[^A-Za-z0-9_.-]+', '_', 'g') as slug, 'DG_' || upper(name) as env_key from source_specs")
def slug_names(spark, d):
    return table(spark, d, "source_specs").select("id", X.slug("id").alias("slug"), X.env_key("name").alias("env_key"))


@query(
    f"""select id, md5({stripped("array_to_string([split_part(p, '<|channel>', 1) for p in string_split('<|channel>' || coalesce(prompt_text, '') || '<channel|>' || coalesce(text, ''), '<channel|>')], '')")}) as content_md5,
    md5({stripped("coalesce(prompt_text, '')")}) as thinking_md5 from teacher_records"""
)
def strip_thinking(spark, d):
    whole = F.concat(F.lit("<|channel>"), F.coalesce("prompt_text", F.lit("")), F.lit("<channel|>"), F.coalesce("text", F.lit("")))
    r = table(spark, d, "teacher_records").select("id", X.parse_response(whole).alias("r"))
    return r.select("id", F.md5("r.content").alias("content_md5"), F.md5("r.thinking").alias("thinking_md5"))


_LISTS = "list_filter(coalesce(media['{0}'], []), lambda x: x is not null and x <> '')"
_URL = "case when regexp_matches({0}, '^(https?|data|file):') then {0} when starts_with({0}, '/') then 'file://' || {0} else 'file:///' || {0} end"


@query(
    f"""select id, len(parts) as parts, md5(array_to_string(parts, ';')) as content_md5 from (select id, ['text=' || coalesce(prompt_text, '')]
    || ['image_url=' || {_URL.format('v')} for v in {_LISTS.format('images')} || {_LISTS.format('image')}] || ['audio_url=' || {_URL.format('v')} for v in {_LISTS.format('audio')}] as parts from prompt_records)"""
)
def chat_content_parts(spark, d):
    c = X.chat_content(F.coalesce("prompt_text", F.lit("")), "media")
    t = table(spark, d, "prompt_records").select("id", F.transform(c, lambda p: F.concat_ws("=", p["type"], p["value"])).alias("c"))
    return t.select("id", F.size("c").alias("parts"), F.md5(F.array_join("c", ";")).alias("content_md5"))


@query(f"select doc_id, {_URL.format('url')} as url from documents where url is not null")
def media_url(spark, d):
    return table(spark, d, "documents").where("url is not null").select("doc_id", X.media_url("url").alias("url"))


# --- prompts and conversations ----------------------------------------------------------------------------------------

_ROLE = "case runtime when 'lmstudio' then 'user' when 'llamacpp' then 'assistant' when 'ollama' then 'Human' else 'system' end"
_TURNS = f"(select distinct coalesce(prompt_source, '') as conv_id, id as turn, {_ROLE} as role, prompt_text as text from teacher_records)"


def _turns(spark, d) -> DataFrame:
    t = table(spark, d, "teacher_records")
    return t.select(F.coalesce("prompt_source", F.lit("")).alias("conv_id"), F.col("id").alias("turn"), F.expr(_ROLE).alias("role"), F.col("prompt_text").alias("text")).distinct()


@query(
    f"""select conv_id, md5(coalesce(min_by(t, turn) filter (where lower(role) in ('user', 'human', 'prompter', 'client') and t <> ''), min_by(t, turn))) as prompt_md5
    from (select *, {stripped('text')} as t from {_TURNS}) group by conv_id"""
)
def conv_first_user_prompt(spark, d):
    return prompts.first_user_turn(_turns(spark, d)).select("conv_id", F.md5("prompt_text").alias("prompt_md5"))


@query(
    f"""select conv_id, md5(coalesce(string_agg(t, chr(10) || chr(10) order by turn) filter (where t <> ''), '')) as context_md5 from (select *, row_number() over (partition by conv_id order by turn) as n
    from (select *, {stripped('text')} as t from {_TURNS}) where lower(role) in ('user', 'human', 'prompter', 'client')) where n <= 3 group by conv_id"""
)
def conv_context_first3(spark, d):
    return prompts.first_user_turns(_turns(spark, d)).select("conv_id", F.md5("context_text").alias("context_md5"))


@query(
    f"""select id as conv_id, md5('<bos><|turn>system' || chr(10) || {stripped('context_text')} || '<turn|>' || chr(10) || '<|turn>user' || chr(10) || {stripped('prompt_text')} || '<turn|>' || chr(10)
    || '<|turn>model' || chr(10) || {stripped('text')} || {stripped('runtime')} || '<turn|>' || chr(10)) as rendered_md5
    from (select distinct id, context_text, prompt_text, text, runtime from teacher_records)"""
)
def chat_render(spark, d):
    t = table(spark, d, "teacher_records").select("id", "context_text", "prompt_text", "text", "runtime").distinct()
    turn = lambda n, role, c: F.struct(F.lit(n).alias("turn"), F.lit(role).alias("role"), F.col(c).alias("text"))
    four = F.array(turn(0, "system", "context_text"), turn(1, "user", "prompt_text"), turn(2, "assistant", "text"), turn(3, "assistant", "runtime"))
    turns = t.select(F.col("id").alias("conv_id"), F.inline(four))
    return prompts.render_chat(turns).select("conv_id", F.md5("rendered").alias("rendered_md5"))


_CONTEXT_ROLE = "(role in ('plain_text_corpus', 'code_context_stream', 'math_science_context_stream') or ends_with(role, '_warmup_or_context_seed'))"


@query(
    f"""with r as (select distinct r.id as k, s.id as source, coalesce(nullif(s.role, ''), 'prompt_context_bank') as role, coalesce(s.modality, 'text') as modality, {stripped('r.prompt_text')} as p0, {stripped('r.context_text')} as c0
    from prompt_records r join source_specs s on r.source = s.id), c as (select *, {cleaned(f"(case when {_CONTEXT_ROLE} then '" + prompts.DEFAULT_TEACHER_PROMPT.replace("'", "''") + "' else p0 end)", 12000)} as p, {cleaned('c0', 12000)} as c from r)
    select sha256(source || '|' || k) as id, source, role, modality, md5(p) as prompt_md5, md5(case when c = p then '' else c end) as context_md5 from c where case when {_CONTEXT_ROLE} then c <> '' else p <> '' or c <> '' end"""
)
def prompt_records(spark, d):
    rows = table(spark, d, "prompt_records").select(F.col("id").alias("k"), "source", F.col("prompt_text").alias("prompt"), F.col("context_text").alias("context")).distinct()
    r = prompts.prompt_records(rows, table(spark, d, "source_specs"), "source", ["k"])
    return r.select("id", "source", "role", "modality", F.md5("prompt_text").alias("prompt_md5"), F.md5("context_text").alias("context_md5"))


@query("select id, name, role from source_specs where coalesce(enabled, true) and (id in ('quafer/edu_pages', 'chat_turns', 'retired_bank') or name in ('quafer/edu_pages', 'chat_turns', 'retired_bank'))")
def requested_sources(spark, d):
    return flow.active_sources(table(spark, d, "source_specs"), ["quafer/edu_pages", "chat_turns", "retired_bank"]).select("id", "name", "role")


# --- order, quotas, budgets -------------------------------------------------------------------------------------------


@query(
    """with s as (select id, row_number() over (order by id) - 1 as source_order, max_records from source_specs where coalesce(enabled, true)),
    r as (select distinct id, source, coalesce(context_text, '') <> '' as ok from prompt_records),
    w as (select r.id, r.source, s.source_order, s.max_records, ok, row_number() over (partition by r.source order by r.id) - 1 as raw_index,
      coalesce(sum(ok::int) over (partition by r.source order by r.id rows between unbounded preceding and 1 preceding), 0) as before from r join s on r.source = s.id),
    k as (select *, row_number() over (order by raw_index, source_order) - 1 as position from w where ok and before < case when coalesce(max_records, 0) > 0 then max_records else 20 end)
    select id, source, raw_index, position from k where position < 400"""
)
def interleave_quota_total(spark, d):
    specs = flow.active_sources(table(spark, d, "source_specs"))
    order = specs.select("id", "max_records", (F.row_number().over(Window.orderBy("id")) - 1).alias("source_order"))  # one row per source
    rows = table(spark, d, "prompt_records").select("id", "source", (F.coalesce("context_text", F.lit("")) != "").alias("ok")).distinct()
    return flow.interleave(rows, order, "source", ["id"], F.col("ok"), per_source=20, total=400).select("id", "source", "raw_index", "position")


@query(
    """select doc_id, before as tokens_before from (select doc_id, coalesce(sum(t) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from (select doc_id, greatest(1, coalesce(strlen(text), 0) // 4) as t from documents)) where before < 100000"""
)
def token_budget_cut(spark, d):
    return flow.budget_positions(table(spark, d, "documents"), ["doc_id"], X.estimate_tokens("text"), 100_000)


_TOKENS = "[('0x' || substr(md5(x), 1, 7))::BIGINT % 262144 for x in string_split(coalesce(text, ''), ' ') if x <> '']"


@query(
    f"""select doc_id, first_block, least(n, 500 - first_block) as kept_blocks from (select doc_id, n, coalesce(sum(n) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as first_block
    from (select doc_id, ceil(len({_TOKENS}) / 256.0)::bigint as n from documents)) where first_block < 500"""
)
def block_budget_cut(spark, d):
    n = F.ceil(F.size(arrays.hash_tokens("text")) / 256)
    return flow.block_positions(table(spark, d, "documents"), ["doc_id"], n, 500)


@query("select doc_id, row_number() over (order by md5('1337|' || doc_id), doc_id) - 1 as position from documents")
def seeded_shuffle(spark, d):
    return flow.seeded_shuffle(table(spark, d, "documents").select("doc_id"), 1337, "doc_id")


@query(
    """select doc_id, case when row_number() over (order by md5('1337|' || doc_id), doc_id) <= (select case when count(*) > 1 then least(greatest(1, floor(count(*) * 0.01)::bigint), count(*) - 1) else 0 end from documents)
    then 'val' else 'train' end as split from documents"""
)
def train_val_split(spark, d):
    return flow.train_val_split(table(spark, d, "documents").select("doc_id"), 0.01, 1337, "doc_id")


@query(
    """select bucket, id from (select s.bucket, t.id, row_number() over (partition by s.bucket order by md5('7|' || t.id), t.id) as n from (select distinct id, prompt_source from teacher_records) t
    join source_specs s on t.prompt_source = s.id where s.bucket is not null) where n <= 30"""
)
def mix_quota(spark, d):
    t = table(spark, d, "teacher_records").select("id", "prompt_source").distinct()
    s = table(spark, d, "source_specs").where("bucket is not null").select(F.col("id").alias("prompt_source"), "bucket")
    r = prefix_sums(t.join(s, "prompt_source").withColumn("k", rng.order_key(7, F.col("id"))), ["k", "id"], ["bucket"])
    return r.where("ordinal < 30").select("bucket", "id")


# --- contract, progress, resume ---------------------------------------------------------------------------------------

_MEDIA = " + ".join(f"len({_LISTS.format(k)})" for k in ("images", "image", "audio", "media_path", "url"))


@query(
    f"""select case when {stripped('prompt_text')} = '' and {stripped('context_text')} = '' and {_MEDIA} = 0 then 'no_prompt' when prompt_source = 'prompt_free' then 'prompt_free'
    when {stripped('text')} = '' then 'no_text' else 'ok' end as violation, count(*) as records from teacher_records group by 1"""
)
def contract_violations(spark, d):
    v = contract.validated(table(spark, d, "teacher_records"), strict=False)
    return v.groupBy(F.coalesce("violation", F.lit("ok")).alias("violation")).agg(F.count("*").alias("records"))


@query(
    """select count(*) as records, coalesce(sum(coalesce(estimated_tokens, 0)), 0)::bigint as estimated_tokens, count(*) as source_index,
    (select id from teacher_records where coalesce(id, '') <> '' order by ingested_at desc, id desc limit 1) as last_record_id from teacher_records"""
)
def progress_state(spark, d):
    return flow.progress(table(spark, d, "teacher_records"), ["ingested_at", "id"])


@query(
    """select coalesce(runtime, '') as runtime, count(*) as records, coalesce(sum(coalesce(estimated_tokens, 0)), 0)::bigint as estimated_tokens, count(*) as source_index,
    max_by(id, (ingested_at, id)) filter (where coalesce(id, '') <> '') as last_record_id, coalesce(runtime, '') <> 'ollama' as reconciled_from_output from teacher_records group by 1, 6"""
)
def reconcile(spark, d):
    """Progress of each runtime's records: the one saved as the output has it stays, those saved with fewer tokens are replaced."""
    records = table(spark, d, "teacher_records").withColumn("runtime", F.coalesce("runtime", F.lit("")))
    out = None
    for r in records.select("runtime").distinct().collect():  # a handful of runtimes
        actual = flow.progress(records.where(F.col("runtime") == r["runtime"]), ["ingested_at", "id"])
        saved = actual.withColumn("estimated_tokens", F.col("estimated_tokens") - (0 if r["runtime"] == "ollama" else 7))
        one = flow.reconcile(saved, actual).withColumn("runtime", F.lit(r["runtime"]))
        out = one if out is None else out.unionByName(one)
    return out


@query("select doc_id, lang from documents where doc_id not in (select doc_id from documents where doc_kind = 'web_context' and doc_id is not null)")
def resume_skip(spark, d):
    docs = table(spark, d, "documents")
    return flow.resume(docs, docs.where("doc_kind = 'web_context'"), "doc_id").select("doc_id", "lang")


@query("select source, records from (select coalesce(source, '') as source, count(*) as records from documents group by 1 union all select '(total)', count(*) from documents)")
def source_counts(spark, d):
    return flow.counts_by(table(spark, d, "documents"), "source")


# --- blocks and shards ------------------------------------------------------------------------------------------------

_BLOCKS = f"(select doc_id, lang, i as block, ids[i * 256 + 1 : i * 256 + 256] as ids from (select doc_id, lang, ids, unnest(range(0, ((len(ids) + 255) // 256)::bigint)) as i from (select doc_id, lang, {_TOKENS} as ids from documents)))"


def _blocks(spark, d) -> DataFrame:
    return blocks.target_blocks(table(spark, d, "documents"), arrays.hash_tokens("text"), 256, ["doc_id", "lang"])


@query(f"select doc_id, block, len(ids) as labels, list_sum(ids)::bigint as checksum from {_BLOCKS}")
def token_blocks(spark, d):
    labels = F.filter("target_ids", lambda x: x >= 0)
    return _blocks(spark, d).select("doc_id", "block", F.size(labels).alias("labels"), F.aggregate(labels, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("checksum"))


@query(
    f"""select doc_id, least(len(ids), 64) as prefix_len, md5(array_to_string([0 for x in range(0, greatest(64 - len(ids), 0))] || ids[greatest(len(ids) - 64, 0) + 1 : len(ids)], ',')) as prefix_md5,
    array_to_string([0 for x in range(0, greatest(64 - len(ids), 0))] || [1 for x in range(0, least(len(ids), 64))], '') as mask from (select doc_id, {_TOKENS} as ids from documents)"""
)
def left_pad_prefix(spark, d):
    t = table(spark, d, "documents").select("doc_id", arrays.hash_tokens("text").alias("ids"))
    text = lambda c: F.transform(c, lambda x: x.cast("string"))
    n = F.least(F.size("ids"), F.lit(64))
    return t.select("doc_id", n.alias("prefix_len"), F.md5(F.array_join(text(arrays.left_pad("ids", 64)), ",")).alias("prefix_md5"), F.array_join(text(arrays.attention_mask(n, 64)), "").alias("mask"))


def _u(tag: str, *keys: str, at: int = 1) -> str:
    return f"(('0x' || substr(md5('1337|{tag}|' || {' || \'|\' || '.join(keys)}), {at}, 13))::UBIGINT::BIGINT)"


@query(
    f"""select doc_id, block, round(t, 9) as noise_t, len([p for p in pos if p.m]) as masked, list_sum([p.v for p in pos])::bigint as checksum from (select doc_id, block, t,
    [{{'m': {_u('n', 'doc_id', 'block', '(i - 1)')} / 4503599627370496.0::DOUBLE < t, 'v': case when {_u('n', 'doc_id', 'block', '(i - 1)')} / 4503599627370496.0::DOUBLE < t
      then {_u('n', 'doc_id', 'block', '(i - 1)', at=14)} % 262144 else ids[i] end}} for i in range(1, len(ids) + 1)] as pos
    from (select *, 0.05::DOUBLE + 0.9::DOUBLE * ({_u('t', 'doc_id', 'block')} / 4503599627370496.0::DOUBLE) as t from {_BLOCKS}))"""
)
def noise_blocks(spark, d):
    b = blocks.target_blocks(table(spark, d, "documents"), arrays.hash_tokens("text"), 256, ["doc_id"])
    n = b.withColumn("n", arrays.noise("target_ids", 262_144, 0, 1337, F.col("doc_id"), F.col("block")))
    masked = F.size(F.filter("n.mask", lambda m: m))
    return n.select("doc_id", "block", F.round("n.noise_t", 9).alias("noise_t"), masked.alias("masked"), F.aggregate("n.ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("checksum"))


@query(
    f"""with b as (select doc_id, block, coalesce(lang, '') as signature, case when coalesce(lang, '') like 'en%' then 'text' else 'multimodal' end as family from {_BLOCKS}),
    n as (select *, row_number() over (order by doc_id, block) as pos, (row_number() over (partition by signature order by doc_id, block) - 1) // 64 as q from b),
    p as (select family, signature, q, count(*) as blocks, max(pos) as final, min(min(pos)) over (partition by signature) as opened from n group by 1, 2, 3),
    f as (select *, case when blocks = 64 then final else 1000000000 + opened end as flush from p)
    select family, signature, dense_rank() over (partition by family order by flush) - 1 as shard_id, blocks from f"""
)
def shard_assign(spark, d):
    b = _blocks(spark, d).select("doc_id", "block", F.coalesce("lang", F.lit("")).alias("signature"))
    b = stored(b.withColumn("family", F.when(F.col("signature").startswith("en"), "text").otherwise("multimodal")))
    return blocks.shards(b, ["doc_id", "block"], 64).groupBy("family", "signature", "shard_id").agg(F.count("*").alias("blocks"))


@query(
    f"""with t as (select doc_id, block, doc_id % 3 as shard_id, ids || [-100 for x in range(0, case when doc_id % 5 = 0 and len(ids) < 256 then 255 else 256 end - len(ids))] as ids from {_BLOCKS})
    select count(distinct shard_id) as shards, count(*) as blocks, bool_and(len(ids) = 256) as target_length_ok, bool_and(len(ids) = 256) as same_length_ok, count(*) >= 100 as enough from t"""
)
def shard_verify(spark, d):
    """Some blocks are one id too short, against the noised ones of full length: both checks have to see it."""
    b = blocks.corrupted(_blocks(spark, d), 262_144, 0, 1337, ["doc_id", "block"]).withColumn("family", F.lit("text")).withColumn("shard_id", F.col("doc_id") % 3)
    short = (F.col("doc_id") % 5 == 0) & (F.element_at("target_ids", -1) < 0)
    return blocks.verify_shards(b.withColumn("target_ids", F.when(short, F.slice("target_ids", 1, 255)).otherwise(F.col("target_ids"))), 256, 100)


@query(
    f"""select case when len({_LISTS.format('audio')}) > 0 then 'audio' when len({_LISTS.format('images')}) > 0 then 'image' else 'text' end as family, count(*) as records from teacher_records group by 1"""
)
def media_family(spark, d):
    names = F.array_compact(F.array(F.when(F.size(X.media_values("media", "images")) > 0, "pixel_values"), F.when(F.size(X.media_values("media", "audio")) > 0, "input_features")))
    return table(spark, d, "teacher_records").groupBy(arrays.family(names).alias("family")).agg(F.count("*").alias("records"))


@query(
    """select runtime, count(*) as rows, concat_ws(',', case when count(context_text) = count(*) then 'context_text' end, case when count(modality) = count(*) then 'modality' end,
    case when count(prompt_text) = count(*) then 'prompt_text' end, case when count(source_model) = count(*) then 'source_model' end) as keys from teacher_records group by 1"""
)
def collate_keys(spark, d):
    return blocks.collate(table(spark, d, "teacher_records"), "runtime", ["context_text", "modality", "prompt_text", "source_model"]).withColumn("keys", F.array_join("keys", ","))


@query(
    f"""select doc_id, md5(array_to_string([{_u('c', 'doc_id', 'i')} % 1000 for i in range(0, 16)], ',')) as canvas_md5, {_u('s', 'doc_id')} / 4503599627370496.0::DOUBLE < 0.5 as self_condition from documents"""
)
def random_canvas(spark, d):
    ids = F.transform(arrays.random_ids(16, 1000, 1337, F.col("doc_id")), lambda x: x.cast("string"))
    return table(spark, d, "documents").select("doc_id", F.md5(F.array_join(ids, ",")).alias("canvas_md5"), rng.bernoulli(0.5, 1337, "s", F.col("doc_id")).alias("self_condition"))


# --- parameter matching -----------------------------------------------------------------------------------------------

_BASE = "(select 'model.language_model.layers.' || p_partkey || '.mlp.' || case p_size % 3 when 0 then 'gate_proj' when 1 then 'up_proj' else 'down_proj' end || '.weight' as key, p_size as rows, 8 as cols from part)"
_TARGET = """(select case when p_partkey % 2 = 0 then 'model.encoder.language_model.layers.' else 'model.decoder.layers.' end || p_partkey || case when p_size % 5 = 0 then '.attn.q_proj'
    else '.mlp.' || case p_size % 3 when 0 then 'gate_proj' when 1 then 'up_proj' else 'down_proj' end end || '.weight' as key, p_size as rows, case when p_partkey % 7 = 0 then 9 else 8 end as cols from part)"""
_MATCH = f"""(select t.key, case when starts_with(t.key, 'model.encoder.') then 'text_encoder' else 'diffusion_decoder' end as family, b.key as source,
    case when b.key is null then 'missing_source' when b.rows = t.rows and b.cols = t.cols then 'copied' else 'shape_mismatch' end as status
    from {_TARGET} t left join {_BASE} b on regexp_replace(t.key, '^model\\.(encoder\\.language_model|decoder)\\.', '') = regexp_replace(b.key, '^model\\.language_model\\.', ''))"""


def _inventory(spark, d, sql: str) -> DataFrame:
    part = table(spark, d, "part")
    key = sql.split("(select ", 1)[1].split(" as key")[0]
    cols = "8" if sql is _BASE else "case when p_partkey % 7 = 0 then 9 else 8 end"
    return part.select(F.expr(key).alias("key"), F.array(F.col("p_size"), F.expr(cols)).alias("shape"))


@query(f"select key, family, source, status from {_MATCH}")
def transplant_match(spark, d):
    return weights.match(_inventory(spark, d, _BASE), _inventory(spark, d, _TARGET)).select("key", "family", "source", "status")


@query(
    f"""select family, count(*) as target, sum((status = 'copied')::int)::bigint as copied, sum((status = 'missing_source')::int)::bigint as missing, sum((status = 'shape_mismatch')::int)::bigint as mismatched,
    round(sum((status = 'copied')::int) / count(*), 6) as ratio, bool_and(status = 'copied') as fully_copied from {_MATCH} group by 1"""
)
def transplant_coverage(spark, d):
    return weights.coverage(weights.match(_inventory(spark, d, _BASE), _inventory(spark, d, _TARGET)))


@query(f"select key, 'missing' as difference from {_TARGET} where key not in (select key from {_BASE}) union all select key, 'unexpected' from {_BASE} where key not in (select key from {_TARGET})")
def load_differences(spark, d):
    return weights.load_differences(_inventory(spark, d, _BASE), _inventory(spark, d, _TARGET))


@query("select p_brand, sum(p_size) as parameters, round_even(sum(p_size) * 1000000.0::DOUBLE * 2 / 1073741824, 2) as bf16_gib from part group by 1")
def memory_floors(spark, d):
    p = table(spark, d, "part").groupBy("p_brand").agg(F.sum("p_size").alias("parameters"))
    return p.select("p_brand", "parameters", weights.memory_floor(F.col("parameters") * 1e6, 2.0).alias("bf16_gib"))


# --- scores and step logs ---------------------------------------------------------------------------------------------

_Z = "[x::double for x in embedding]"
_LSE = f"(list_max({_Z}) + ln(list_sum([exp(x - list_max({_Z})) for x in {_Z}])))"
_ENTROPY = f"(-list_sum([exp(x - {_LSE}) * (x - {_LSE}) for x in {_Z}]))"
_TOP = f"(list_position({_Z}, list_max({_Z})) - 1)"


@query(f"select vec_id, round(h, 9) as entropy, top from (select vec_id, {_ENTROPY} as h, {_TOP} as top from embeddings)")
def softmax_entropy(spark, d):
    e = scores.entropies(table(spark, d, "embeddings"), "embedding")
    return e.select("vec_id", F.round("entropy", 9).alias("entropy"), "top")


@query(
    f"""with e as (select label as b, vec_id // 8 as r, vec_id as p, round({_ENTROPY}, 9) as h, {_TOP} as top from embeddings),
    w as (select *, bool_or(h <= 4.13) over (partition by b) as any_ok, row_number() over (partition by b, r order by h, p) = 1 as lowest from e),
    a as (select *, case when any_ok then h <= 4.13 else lowest end as accepted from w)
    select p as vec_id, accepted, case when accepted then top else {_u('r', 'b', 'r', 'p')} % 64 end as next_id from a"""
)
def entropy_accept(spark, d):
    e = scores.entropies(table(spark, d, "embeddings"), "embedding").select(F.col("label").alias("b"), F.expr("vec_id div 8").alias("r"), F.col("vec_id").alias("p"), F.round("entropy", 9).alias("entropy"), "top")
    return scores.entropy_accept(e, 4.13, "b", "r", "p", 64, 1337).select(F.col("p").alias("vec_id"), "accepted", "next_id")


@query(f"select count(*) as rows, round(avg({_LSE} - embedding[label + 1]::double), 9) as loss from embeddings where label >= 0 and label < len(embedding)")
def cross_entropy_loss(spark, d):
    return scores.loss(table(spark, d, "embeddings"), "embedding", "label").withColumn("loss", F.round("loss", 9))


_STABLE = """(select *, row_number() over (partition by user_id, i order by event_id) - 1 as stable from (select *, sum(c) over (partition by user_id order by event_id) as i
    from (select *, case when event_type is not distinct from lag(event_type) over (partition by user_id order by event_id) and row_number() over (partition by user_id order by event_id) > 1 then 0 else 1 end as c from events)))"""


@query(f"select event_id, stable from {_STABLE}")
def stability_run(spark, d):
    return scores.stability(table(spark, d, "events"), ["user_id"], "event_id", F.col("event_type")).select("event_id", "stable")


@query(f"select user_id, min(event_id) filter (where value <= 0.5 or stable >= 3) as stop_step from {_STABLE} group by 1")
def early_stop(spark, d):
    s = scores.stability(table(spark, d, "events"), ["user_id"], "event_id", F.col("event_type"))
    return scores.early_stop(s, ["user_id"], "event_id", "value", 0.5)


@query("select event_id, min(value) over (partition by user_id order by event_id) as best from events")
def running_best(spark, d):
    return scores.running_best(table(spark, d, "events"), ["user_id"], "event_id", "value").select("event_id", "best")


@query(
    """select event_id, n // 4 as optimizer_steps, n % 4 = 0 as boundary, cents from (select event_id, row_number() over (partition by user_id order by event_id) as n,
    sum(round(value * 100)::bigint) over (partition by user_id order by event_id)::bigint as cents from events)"""
)
def cumulative_counters(spark, d):
    c = scores.counters(table(spark, d, "events"), ["user_id"], "event_id", 4, cents=F.round(F.col("value") * 100).cast("bigint"))
    return c.select("event_id", "optimizer_steps", "boundary", "cents")


# --- declared filters, duplicates, manifests, streams -----------------------------------------------------------------


@query(
    f"""select coalesce(case when {stripped('text')} = '' then 'empty' when regexp_matches(coalesce(text, ''), '{contract.FAILURES}') then 'failure'
    when regexp_matches(coalesce(text, ''), '{contract.GREETINGS.replace("'", "''")}') and greatest(1, strlen(coalesce(text, '')) // 4) < 64 then 'greeting'
    when greatest(1, strlen(coalesce(text, '')) // 4) < 32 then 'short' end, 'kept') as reason, count(*) as records from teacher_records group by 1"""
)
def output_filters(spark, d):
    return table(spark, d, "teacher_records").groupBy(F.coalesce(contract.output_filter(), F.lit("kept")).alias("reason")).agg(F.count("*").alias("records"))


@query("select sha256(coalesce(text, '')) as text_hash, min(doc_id) as first_id, count(*) as copies from documents group by 1 having count(*) > 1")
def exact_dup(spark, d):
    return contract.exact_duplicates(table(spark, d, "documents"), F.col("text"), "doc_id")


@query(
    """select lang, sum(known::int)::bigint as known, sum((not known)::int)::bigint as unknown from (select coalesce(lang, '') as lang, source is not null and source in (select name from source_specs where name is not null) as known from documents) group by 1"""
)
def source_semi_anti(spark, d):
    docs, names = table(spark, d, "documents"), table(spark, d, "source_specs").select(F.col("name").alias("source"))
    known = docs.join(names, "source", "left_semi").withColumn("known", F.lit(1))
    unknown = docs.join(names, "source", "left_anti").withColumn("known", F.lit(0))
    both = known.select("lang", "known").unionByName(unknown.select("lang", "known"))
    return both.groupBy(F.coalesce("lang", F.lit("")).alias("lang")).agg(F.sum("known").alias("known"), F.sum(1 - F.col("known")).alias("unknown"))


@query("select doc_id, strlen(text) as bytes, sha256(text) as sha256 from documents where text is not null")
def sha256_manifest(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.octet_length("text").alias("bytes"), F.sha2("text", 256).alias("sha256"))


@query("select event_type, count(*) as records, sum(round(value * 100)::bigint)::bigint as cents from events group by 1")
def stream_totals(spark, d):
    events = streams.table_stream(spark, d, "events")
    return streams.run_available(streams.running_totals(events, ["event_type"], cents=F.round(F.col("value") * 100).cast("bigint")), new_folder(spark))


@query("select strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') as window_start, event_type, count(*) as events from events group by 1, 2")
def event_windows(spark, d):
    w = streams.windowed(table(spark, d, "events"), "ts", "1 hour", ["event_type"])
    return w.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "events")


@query("select event_id as step, event_type, user_id from events order by event_id desc limit 20")
def log_tail(spark, d):
    return readers.log_tail(table(spark, d, "events").select(F.col("event_id").alias("step"), "event_type", "user_id"))


from quern import queries_io, queries_values  # noqa: E402, F401  they add their queries to the tables above
