"""Queries of sources, sinks, pipelines and streams: what is written is read back, beside SQL on the tables it came from.

Every query writes to a folder of its own below the shared one."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators import blocks
from quern.operators.clients import COMPLETIONS, TEXT_ONLY, Offline, TeacherConfig, make_client
from quern.plans import bank, shards, teacher
from quern.queries import _LISTS, _TOKENS, query, stripped, table
from quern.sources import readers, writers
from quern.storage import new_folder, stored
from quern.streaming import streams

# --- lines ------------------------------------------------------------------------------------------------------------


def _lines(spark, d) -> str:
    at = new_folder(spark)
    writers.write_jsonl(table(spark, d, "documents").select("doc_id", "text", "lang", F.coalesce("source", F.lit("")).alias("source")), at)
    return at


@query("select doc_id, md5(text) as text_md5, lang, coalesce(source, '') as source from documents")
def jsonl_round_trip(spark, d):
    return readers.read_jsonl(spark, _lines(spark, d), "doc_id bigint, text string, lang string, source string").select("doc_id", F.md5("text").alias("text_md5"), "lang", "source")


@query(f"select doc_id::varchar as doc_id, md5({stripped('text')}) as text_md5 from documents")
def jsonl_any_keys(spark, d):
    v = lambda k: X.as_text(F.variant_get("value", f"$.{k}", "variant"))
    return readers.read_jsonl_open(spark, _lines(spark, d)).select(v("doc_id").alias("doc_id"), F.md5(v("text")).alias("text_md5"))


@query("select doc_id, lang, true as starts_a_line from documents")
def line_offsets(spark, d):
    """Every line by the byte at which it starts; offsets of a file ascend by at least a line's length."""
    lines = readers.read_offsets(spark, _lines(spark, d))
    size = F.octet_length("line")
    after = F.lead("offset").over(Window.partitionBy("path").orderBy("offset"))
    r = F.from_json("line", "doc_id bigint, lang string")
    return lines.select(r.alias("r"), F.coalesce(after >= F.col("offset") + size + 1, F.lit(True)).alias("starts_a_line")).select("r.doc_id", "r.lang", "starts_a_line")


@query("select doc_id, row_number() over (order by doc_id) - 1 as position from documents")
def lines_in_order(spark, d):
    at = new_folder(spark)
    table(spark, d, "documents").select("doc_id").coalesce(1).sortWithinPartitions("doc_id").write.json(at)
    return readers.read_ordered(spark, at, "source").select(F.get_json_object("line", "$.doc_id").cast("bigint").alias("doc_id"), "position")


@query("select count(*) as lines, count(distinct doc_id) as documents, count(*) * (count(*) - 1) // 2 as positions from documents")
def lines_shuffled(spark, d):
    """A seeded permutation of the lines: each position once."""
    r = readers.read_ordered(spark, _lines(spark, d))
    return r.agg(F.count("*").alias("lines"), F.countDistinct(F.get_json_object("line", "$.doc_id")).alias("documents"), F.sum("position").alias("positions"))


@query("select source, count(*) as records from (select coalesce(source, '') as source from documents) group by 1 union all select '(total)', count(*) from documents")
def jsonl_counts(spark, d):
    """What the writer of JSON lines says about what it has written."""
    done = writers.write_jsonl(table(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source")), new_folder(spark))
    return spark.createDataFrame([("(total)", done["records"]), *done["by_source"].items()], "source string, records bigint")


# --- sources ----------------------------------------------------------------------------------------------------------

_LIVE = "(select *, row_number() over (order by id) - 1 as source_order from source_specs where coalesce(enabled, true) and id not in (select min(id) from source_specs where coalesce(enabled, true)))"


def _manifests(spark, d) -> tuple[list[dict], str]:
    """Source specs as a configuration holds them, and a folder with their manifests; the first source has none."""
    specs = table(spark, d, "source_specs").orderBy("id").drop("bucket")
    at = new_folder(spark)
    spark.createDataFrame([(json.dumps({"sources": [r.asDict() for r in specs.collect()]}),)], "value string").coalesce(1).write.text(f"{at}/config")  # one row per source
    sources = [r.asDict() for r in readers.read_sources(spark, f"{at}/config").orderBy("source_order").collect()]
    live = [s for s in sources if s["enabled"] is not False]
    rows = table(spark, d, "prompt_records").where(F.col("source") != live[0]["id"]).select("source", "id", F.col("prompt_text").alias("prompt"), F.col("context_text").alias("context")).distinct()
    for s in sources:
        s["manifest_path"] = f"{at}/manifests/source={file_name(s['id'])}"
    rows.withColumn("source", X.slug("source")).repartition(1).sortWithinPartitions("source", "id").write.partitionBy("source").json(f"{at}/manifests")
    return sources, at


def file_name(name: str) -> str:
    return "".join(c if c.isascii() and (c.isalnum() or c in "_.-") else "_" for c in name)


_CONTEXT_ROLE = "(role in ('plain_text_corpus', 'code_context_stream', 'math_science_context_stream') or ends_with(role, '_warmup_or_context_seed'))"


@query(
    f"""with s as {_LIVE}, r as (select distinct p.id, p.source, s.source_order, s.max_records, coalesce(nullif(s.role, ''), 'prompt_context_bank') as role, {stripped('p.prompt_text')} as p, {stripped('p.context_text')} as c from prompt_records p join s on p.source = s.id),
    a as (select *, case when {_CONTEXT_ROLE} then c <> '' else p <> '' or c <> '' end as ok from r),
    w as (select *, row_number() over (partition by source order by id) - 1 as raw_index, coalesce(sum(ok::int) over (partition by source order by id rows between unbounded preceding and 1 preceding), 0) as before from a),
    k as (select *, row_number() over (order by raw_index, source_order) - 1 as position from w where ok and before < case when coalesce(max_records, 0) > 0 then max_records else 40 end)
    select source, role, position, (select count(*) from source_specs where coalesce(enabled, true) and (id not in (select id from s) or id not in (select source from prompt_records where source is not null))) as failures from k where position < 500"""
)
def prompt_bank(spark, d):
    """Sources of a configuration opened, one of them missing, interleaved with quotas and a limit in all."""
    sources, _ = _manifests(spark, d)
    rows, failed = bank.prompt_bank(spark, sources, "id string, prompt string, context string", "", per_source=40, total=500)
    return rows.select("source", "role", "position", F.lit(len(failed)).cast("bigint").alias("failures"))


@query("select id, name, role, enabled, max_records, row_number() over (order by id) - 1 as source_order from source_specs")
def source_config(spark, d):
    """Source specs of a configuration file, in its order."""
    at = new_folder(spark)
    specs = table(spark, d, "source_specs").orderBy("id")
    spark.createDataFrame([(json.dumps({"sources": [r.asDict() for r in specs.collect()]}, indent=1),)], "value string").coalesce(1).write.text(at)  # one row per source
    return readers.read_sources(spark, at).select("id", "name", "role", "enabled", "max_records", "source_order")


@query("select doc_id, lang, 'quafer/edu pages' as source_id from documents")
def local_mirror(spark, d):
    at = new_folder(spark)
    table(spark, d, "documents").select("doc_id", "lang").write.parquet(f"{at}/quafer_edu_pages/full/train")
    return readers.read_mirror(spark, at, {"id": "quafer/edu pages", "config": "full"})


# --- files and media --------------------------------------------------------------------------------------------------


def _named_files(spark, d) -> str:
    at = new_folder(spark)
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("value"))
    nation.repartition(5, "key").write.partitionBy("key").text(at)
    return at


@query("select n_nationkey as key, strlen(n_name) + 1 as bytes, sha256(n_name || chr(10)) as sha256 from nation")
def file_checksums(spark, d):
    """Files below a folder with their sizes and checksums."""
    f = readers.read_files(spark, _named_files(spark, d)).where("path like '%.txt'")
    return f.select(F.regexp_extract("path", r"key=(\d+)/", 1).cast("int").alias("key"), "bytes", "sha256")


@query("select count(*) as files, sum(strlen(n_name) + 1)::bigint as bytes, true as has_sha256 from nation")
def bundle_totals(spark, d):
    """An archive of files with its manifest: what its summary says."""
    root = _named_files(spark, d).removeprefix("file:")
    files = readers.read_files(spark, root).where("path like '%.txt'")
    s = writers.write_bundle(files, f"{root.rstrip('/')}.tar.gz", root)
    return spark.createDataFrame([(s["files"], s["bytes"], len(s["sha256"]) == 64)], "files bigint, bytes bigint, has_sha256 boolean")


@query("select n_nationkey::varchar as id, 1 as height, 2 as width, lpad(hex(n_nationkey), 2, '0') || lpad(hex(n_regionkey), 2, '0') || '00FF00FF' as rgb from nation")
def image_round_trip(spark, d):
    """Images written by the tasks that hold them, read back by their paths and decoded."""
    two = lambda c: F.lpad(F.hex(c), 2, "0")
    pixels = F.concat(two("n_nationkey"), two("n_regionkey"), F.lit("00FF00FF"))
    content = F.concat(F.encode(F.lit("P6\n2 1\n255\n"), "utf-8"), F.unhex(pixels))
    media = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.lit("image").alias("kind"), F.lit(0).alias("index"), F.lit("ppm").alias("extension"), content.alias("content"))
    return readers.decode_images(_media(spark, media, "images")).select("id", "height", "width", F.hex("rgb").alias("rgb"))


@query("select n_nationkey::varchar as id, 16000 as sampling_rate, round((n_nationkey + 2 * n_regionkey) / 2.0 / 32768, 7) as first, 3::bigint as samples from nation")
def audio_round_trip(spark, d):
    """Two-channel PCM audio written, read back and averaged over its channels."""
    little = lambda c: F.concat(F.lpad(F.hex(c), 2, "0"), F.lit("00"))
    frame = F.concat(little("n_nationkey"), little(F.col("n_regionkey") * 2))
    head = "524946463000000057415645666D74201000000001000200803E000000FA000004001000646174610C000000"
    content = F.unhex(F.concat(F.lit(head), frame, frame, frame))
    media = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.lit("audio").alias("kind"), F.lit(0).alias("index"), F.lit("wav").alias("extension"), content.alias("content"))
    a = readers.decode_audio(_media(spark, media, "audio"))
    return a.select("id", "sampling_rate", F.round(F.get("samples", F.lit(0)).cast("double"), 7).alias("first"), F.size("samples").cast("bigint").alias("samples"))


def _media(spark, media: DataFrame, key: str) -> DataFrame:
    at = new_folder(spark).removeprefix("file:")
    written = writers.write_media(media, at)
    records = stored(written.select("id", F.create_map(F.lit(key), F.array("path")).alias("media")))  # the files are there before they are listed
    return readers.read_media(spark, records, (key,), at)


# --- records and shards -----------------------------------------------------------------------------------------------

_BROKEN = f"""case when {stripped('prompt_text')} = '' and {stripped('context_text')} = '' and {' + '.join(f"len({_LISTS.format(k)})" for k in ('images', 'image', 'audio', 'media_path', 'url'))} = 0 then 'no_prompt'
    when prompt_source = 'prompt_free' then 'prompt_free' when {stripped('text')} = '' then 'no_text' end"""


@query(f"select coalesce({_BROKEN}, 'kept') as violation, count(*) as records, sum(strlen(coalesce(text, '')))::bigint as bytes from teacher_records group by 1")
def guarded_append(spark, d):
    """Records appended, those that break a rule to a quarantine with its name."""
    at = new_folder(spark)
    writers.append_records(table(spark, d, "teacher_records").withColumn("text", F.coalesce("text", F.lit(""))), f"{at}/kept", f"{at}/quarantine")
    size = F.sum(F.octet_length("text")).alias("bytes")
    kept = spark.read.schema("text string").json(f"{at}/kept").agg(F.lit("kept").alias("violation"), F.count("*").alias("records"), size)
    return kept.unionByName(spark.read.schema("text string, violation string").json(f"{at}/quarantine").groupBy("violation").agg(F.count("*").alias("records"), size))


@query(
    f"""with p as (select distinct id, {stripped('prompt_text')} as p, {stripped('context_text')} as c, case when len({_LISTS.format('images')}) + len({_LISTS.format('image')}) + len({_LISTS.format('audio')}) > 0
      then 1 + len({_LISTS.format('images')}) + len({_LISTS.format('image')}) + len({_LISTS.format('audio')}) else 0 end as parts from prompt_records),
    q as (select id, case when c <> '' and p <> '' then c || chr(10) || chr(10) || p when c <> '' then c else p end as prompt, parts from p where id is not null and (p <> '' or c <> '')),
    t as (select id, 'reply ' || substr(sha256(prompt), 1, 16) || ' with ' || parts || ' parts' as text from q),
    n as (select *, coalesce(sum(strlen(text) // 4) over (order by id rows between unbounded preceding and 1 preceding), 0) as before from t)
    select id, text, (strlen(text) // 4)::bigint as estimated_tokens from n where before < 2000"""
)
def teacher_generation(spark, d):
    """Prompt records asked in order, chunk by chunk, until the budget of tokens is reached; a second run finds nothing to do."""
    at = new_folder(spark)
    bag = F.create_map().cast("map<string,array<string>>")
    prompts = table(spark, d, "prompt_records").select("id", "source", "modality", "prompt_text", "context_text", F.map_entries(F.coalesce("media", bag)).alias("media"), "metadata").distinct()
    prompts = prompts.withColumn("media", F.map_from_entries("media"))
    for _ in range(2):
        teacher.run(prompts, TeacherConfig(runtime="offline"), at, ["id"], 2000, 150, make=Offline)
    return readers.read_jsonl(spark, at, "id string, text string, estimated_tokens bigint")


def word_ids():
    """The tokenizer of ``arrays.hash_tokens`` as a plain function."""
    from hashlib import md5

    return lambda texts: [[int(md5(w.encode()).hexdigest()[:7], 16) % 262_144 for w in t.split(" ") if w] for t in texts]


@query(
    f"""with t as (select doc_id, ids, ceil(len(ids) / 64.0)::bigint as n from (select doc_id, {_TOKENS} as ids from documents)),
    b as (select *, coalesce(sum(n) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as first from t),
    e as (select doc_id, ids, first, unnest(range(0, least(n, 700 - first))) as block from b where first < 700),
    k as (select *, row_number() over (order by doc_id, block) - 1 as place from e)
    select doc_id, block, place // 100 as shard_id, list_sum(ids[block * 64 + 1 : block * 64 + 64])::bigint as checksum, least(len(p), 16) as prefix_lens, least(len(p), 16)::bigint as mask
    from (select k.*, [x for x in string_split({stripped('d.lang')} || case when {stripped('d.source')} = '' then '' else chr(10) || chr(10) || {stripped('d.source')} end, ' ') if x <> ''] as p from k join documents d using (doc_id))"""
)
def block_shards(spark, d):
    """Records tokenized by a tokenizer that each task makes, cut to blocks within a budget, put into shards, noised, written and read back."""
    at = new_folder(spark)
    lang, source = X.strip(F.coalesce("lang", F.lit(""))), X.strip(F.coalesce("source", F.lit("")))
    docs = table(spark, d, "documents").select("doc_id", "text", lang.alias("context_text"), F.when(lang != source, source).otherwise("").alias("prompt_text"))
    rows = shards.build_shards(docs, 700, 64, 16, 100, 1337, "source", id_col="doc_id", make_tokenizer=word_ids)
    writers.write_shards(rows, at)
    back = readers.read_shards(spark, at)
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    labels = F.filter("target_ids", lambda x: x >= 0)
    return back.select("doc_id", "block", F.col("shard_id").cast("bigint").alias("shard_id"), total(labels).alias("checksum"), "prefix_lens", total("attention_mask").alias("mask"))


@query(
    """select sum(n)::bigint as records_read, sum(n)::bigint as blocks_written, sum(s)::bigint as shards, string_agg(family || '=' || s, ',' order by family) as families
    from (select case when coalesce(lang, '') like 'en%' then 'text' else 'image' end as family, count(*) as n, ceil(count(*) / 50.0)::bigint as s from documents where text is not null group by 1)"""
)
def corruption_totals(spark, d):
    """Records, blocks and shards per family of written shards, as the progress report states them; the report is written and read back."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", F.when(F.coalesce("lang", F.lit("")).startswith("en"), "text").otherwise("image").alias("family"))
    rows = blocks.shards(docs.withColumn("signature", F.col("family")), ["doc_id"], 50)
    at = new_folder(spark)
    writers.write_report(blocks.corruption_totals(rows, "doc_id"), at)
    r = spark.read.schema("records_read bigint, blocks_written bigint, shards bigint, shard_families map<string,bigint>").json(at)
    families = F.array_join(F.transform(F.array_sort(F.map_entries("shard_families")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return r.select("records_read", "blocks_written", "shards", families.alias("families"))


@query("select doc_id, least(len(ids), 8)::bigint as prefix_lens, md5(array_to_string([0 for x in range(0, greatest(8 - len(ids), 0))] || ids[greatest(len(ids) - 8, 0) + 1 : len(ids)], ',')) as ids_md5, case when doc_id % 3 = 0 then 'pixel_values:2x2' else '' end as features from (select doc_id, " + _TOKENS + " as ids from documents)")
def encoder_inputs(spark, d):
    """Prefix ids of text records from the tokenizer, of records with media from the processor with its features."""
    t = table(spark, d, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 3 == 0, "x").alias("media"))
    e = blocks.encoder_inputs(t, "doc_id", "text", "media", 8, 0, word_ids, _processor)
    features = F.array_join(F.transform("features", lambda f: F.concat(f["name"], F.lit(":"), F.array_join(F.transform(f["shape"], lambda x: x.cast("string")), "x"))), ",")
    text = F.transform("prefix_ids", lambda x: x.cast("string"))
    return e.select("doc_id", "prefix_lens", F.md5(F.array_join(text, ",")).alias("ids_md5"), features.alias("features"))


def _processor():
    import numpy as np

    encode = word_ids()
    return lambda text, media: {"input_ids": np.array([encode([text])[0]]), "pixel_values": np.zeros((1, 2, 2)), "other": np.zeros(3)}


# --- logs, reports, streams -------------------------------------------------------------------------------------------


@query("select event_id as step, case when event_id % 10 = 0 then value end as loss from events")
def train_log(spark, d):
    """Steps appended to a log in two runs and read back; a step without a loss has none."""
    at = new_folder(spark)
    e = table(spark, d, "events").select(F.col("event_id").alias("step"), F.when(F.col("event_id") % 10 == 0, F.col("value")).alias("loss"))
    for k in (0, 1):
        writers.append_log(e.where(F.col("step") % 2 == k), at)
    return readers.read_jsonl(spark, at, "step bigint, loss double")


@query("""select p_brand, '{"p_brand":"' || p_brand || '","parts":' || count(*) || ',"largest":' || max(p_size) || '}' as json from part group by 1""")
def json_reports(spark, d):
    g = table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("parts"), F.max("p_size").alias("largest"))
    return g.select("p_brand", F.to_json(F.struct("*")).alias("j")).join(writers.report_json(g).withColumn("p_brand", F.get_json_object("json", "$.p_brand")), "p_brand").select("p_brand", "json")


@query(f"select case when broken is null then 'kept' else broken end as violation, count(distinct id) as records from (select id, {_BROKEN} as broken from teacher_records) group by 1")
def stream_append(spark, d):
    """A stream of records appended with each id once, those that break a rule to a quarantine; a second run of the stream adds nothing."""
    at = new_folder(spark)
    for _ in range(2):
        s = streams.table_stream(spark, d, "teacher_records").select("id", "prompt_text", "context_text", "media", "prompt_source", "text")
        streams.append_records(s, f"{at}/kept", f"{at}/quarantine", f"{at}/checkpoint").awaitTermination()
    kept = spark.read.schema("id string").json(f"{at}/kept").agg(F.lit("kept").alias("violation"), F.count("id").alias("records"))
    return kept.unionByName(spark.read.schema("id string, violation string").json(f"{at}/quarantine").groupBy("violation").agg(F.count("id").alias("records")))


@query("select strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') as window_start, event_type, count(*) as events, sum(round(value * 100)::bigint)::bigint as cents from events group by 1, 2")
def event_windows_streamed(spark, d):
    """Event-time windows with a watermark over the table as a stream."""
    w = streams.windowed(streams.table_stream(spark, d, "events"), "ts", "1 hour", ["event_type"], cents=F.sum(F.round(F.col("value") * 100).cast("bigint")))
    return streams.run_available(w, new_folder(spark)).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "events", "cents")


# --- tokenizers and clients -------------------------------------------------------------------------------------------

#: Rank file of a public byte-pair tokenizer; a parameter of every function that needs one.
RANKS = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_50k.tiktoken")


@query(
    f"""with v as (select from_base64(b) as piece, r from read_csv('{RANKS}', delim = ' ', header = false, quote = '', escape = '', columns = {{'b': 'VARCHAR', 'r': 'BIGINT'}})),
    p as (select distinct unnest(regexp_extract_all(lower(coalesce(text, '')), ' ?[a-z]+')) as piece from documents)
    select p.piece, v.r as id from p join v on encode(p.piece) = v.piece"""
)
def vocabulary_pieces(spark, d):
    """Words of the documents that are one token of a public vocabulary, and their ids: each distinct word is tokenized once, by a tokenizer that tasks make from the file."""
    pieces = table(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(" ?[a-z]+"), F.lit(0))).alias("piece")).distinct()
    t = blocks.tokenized(pieces, "piece", "ids", blocks.rank_file_tokenizer(RANKS))
    return t.where(F.size("ids") == 1).select("piece", F.get("ids", F.lit(0)).alias("id"))


@query(
    """select runtime, count(*) as records, case when runtime = 'ollama' then 'Ollama' when runtime in ('lmstudio', 'llamacpp', 'openai-compatible') then 'Completions' else 'unknown' end as client from teacher_records group by 1"""
)
def runtime_clients(spark, d):
    """The client of each runtime that occurs."""
    made = [(r, type(make_client(TeacherConfig(runtime=r))).__name__) for r in (*COMPLETIONS, *TEXT_ONLY)]
    names = F.create_map(*[F.lit(x) for pair in made for x in pair])
    counts = table(spark, d, "teacher_records").groupBy("runtime").agg(F.count("*").alias("records"))
    return counts.withColumn("client", F.coalesce(F.try_element_at(names, F.col("runtime")), F.lit("unknown")))
