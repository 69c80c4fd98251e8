"""Heterogeneous rows to prompt records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import CONTEXT_FIELDS, MESSAGE_FIELDS, MESSAGE_ROLE_FIELDS, MESSAGE_TEXT_FIELDS, PROMPT_FIELDS, USER_ROLES, clean_text, first_text, is_context_role, media_values, message_role, message_text, strip

MESSAGE = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in (*MESSAGE_ROLE_FIELDS, *MESSAGE_TEXT_FIELDS)]))
# The instruction of context rows without one of their own, the role of sources without one, the policy tag.
DEFAULT_TEACHER_PROMPT = "Respond helpfully using the provided context while preserving the teacher model's normal style."
DEFAULT_ROLE = "prompt_context_bank"
TARGET_POLICY = "teacher_generated_output_only"


def _present(df: DataFrame, names: tuple[str, ...]) -> list[Column]:
    """The columns of ``df`` among ``names``, in that order; absent ones read as null."""
    return [F.col(n) for n in names if n in df.columns]


def with_wide_messages(df: DataFrame) -> DataFrame:
    """Message columns as lists of structs with every known field, missing ones null, so that any input shape can be probed."""
    for n in MESSAGE_FIELDS:
        if n in df.columns:
            have = {f.name for f in df.schema[n].dataType.elementType.fields}
            fields = [(f.name, f.name in have) for f in MESSAGE.elementType.fields]
            df = df.withColumn(n, F.transform(n, lambda m: _wide(m, fields)))
    return df


def _wide(m: Column, fields: list[tuple[str, bool]]) -> Column:
    return F.struct(*[(m[n] if has else F.lit(None)).cast("string").alias(n) for n, has in fields])


def messages(df: DataFrame) -> Column:
    """The first message column that isn't null, an empty list included; without null entries."""
    found = _present(df, MESSAGE_FIELDS)
    return F.filter(F.coalesce(*found), lambda m: m.isNotNull()) if found else F.lit(None).cast(MESSAGE)


def user_prompt(df: DataFrame) -> Column:
    """Text of the first user message that isn't blank, else of the first message even if that is ''; only rows without messages are probed for prompt fields."""
    m = messages(df)
    mine = F.filter(m, lambda x: message_role(x).isin(*USER_ROLES) & (message_text(x) != ""))
    fields = _present(df, PROMPT_FIELDS)
    from_messages = message_text(F.get(F.when(F.size(mine) > 0, mine).otherwise(m), F.lit(0)))
    return F.when(F.size(F.coalesce(m, F.array().cast(MESSAGE))) > 0, from_messages).otherwise(first_text(*fields) if fields else F.lit(""))


def context(df: DataFrame, turns: int = 3) -> Column:
    """The first context field that isn't blank, else the first ``turns`` user messages joined; they are counted before blank ones are dropped."""
    fields = _present(df, CONTEXT_FIELDS)
    mine = F.filter(messages(df), lambda x: message_role(x).isin(*USER_ROLES))
    texts = F.filter(F.transform(F.slice(mine, 1, turns), message_text), lambda t: t != "")
    return F.coalesce(F.nullif(first_text(*fields), F.lit("")) if fields else F.lit(None).cast("string"), F.array_join(texts, "\n\n"), F.lit(""))


def _overwrite(old: Column, new: Column) -> Column:
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)


def collected_media(df: DataFrame) -> Column:
    """map<string, array<string>> of a row: its media map, then image(s) and audio(s), later keys overwriting earlier, then media_path and url; empty lists left out."""
    bag = "map<string,array<string>>"
    parts = [F.coalesce(F.col("media").cast(bag), F.create_map().cast(bag))] if "media" in df.columns else []
    for source, key in (("image", "images"), ("images", "images"), ("audio", "audio"), ("audios", "audio"), ("media_path", "media_path"), ("url", "url")):
        if source in df.columns:
            v = F.col(source)
            if not isinstance(df.schema[source].dataType, T.ArrayType):
                v = F.array(v)
            v = F.filter(v.cast("array<string>"), lambda x: x.isNotNull() & (x != ""))
            parts.append(F.when(F.size(v) > 0, F.create_map(F.lit(key), v)).otherwise(F.create_map().cast(bag)))
    if not parts:
        return F.create_map().cast(bag)
    out = parts[0]
    for p in parts[1:]:  # the later key wins whatever spark.sql.mapKeyDedupPolicy says
        out = _overwrite(out, p)
    return F.map_filter(out, lambda k, v: F.size(v) > 0)


def prompt_records(rows: DataFrame, sources: DataFrame, source_col: str, key: list[str], max_chars: int = 12_000, flagged: bool = False) -> DataFrame:
    """Rows joined to their source's spec as prompt records; rows with neither prompt nor context are dropped, or where ``flagged`` kept
    beside ``accepted``, with ``source_col`` and ``key``.

    Rows of context roles need a context; their prompt is the source's ``teacher_prompt`` or a default.  A context equal
    to the prompt is emptied.  ids are hashed from the source and ``key``, so a retry gives the same ones.  Null sources and
    sources without a spec give no row.
    """
    rows = with_wide_messages(rows)
    r = rows.withColumn("_prompt", user_prompt(rows)).withColumn("_context", context(rows)).withColumn("_media", collected_media(rows))
    spec = sources.select(F.col("id").alias("_source"), F.coalesce(F.nullif("role", F.lit("")), F.lit(DEFAULT_ROLE)).alias("_role"), F.col("modality").alias("_modality"), F.coalesce("license_hint", F.lit("")).alias("_license"), (F.col("teacher_prompt") if "teacher_prompt" in sources.columns else F.lit(None)).cast("string").alias("_teacher"))
    j = r.join(spec, F.col(source_col) == F.col("_source"))
    only = is_context_role("_role")
    prompt = F.when(only, first_text("_teacher", F.lit(DEFAULT_TEACHER_PROMPT))).otherwise(F.col("_prompt"))
    j = j.withColumn("prompt_text", F.when(only, prompt).otherwise(clean_text(prompt, max_chars))).withColumn("context_text", clean_text("_context", max_chars))
    accepted = F.when(only, F.col("context_text") != "").otherwise((F.col("prompt_text") != "") | (F.col("context_text") != ""))
    extra = [*dict.fromkeys([source_col, *key]), accepted.alias("accepted")] if flagged else []
    j = j if flagged else j.where(accepted)
    same = F.col("context_text") == F.col("prompt_text")
    return j.select(
        F.sha2(F.concat_ws("|", "_source", *key), 256).alias("id"), F.col("_source").alias("source"), F.col("_role").alias("role"), F.coalesce("_modality", F.lit("text")).alias("modality"),
        "prompt_text", F.when(same, "").otherwise(F.col("context_text")).alias("context_text"), F.col("_media").alias("media"),
        F.struct(F.col("_source").alias("dataset"), F.col("_license").alias("license_hint"), F.lit(TARGET_POLICY).alias("target_policy")).alias("metadata"), *extra,
    )


def first_user_turn(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conversation, prompt_text) from a flat table of turns (role, text): the first user turn that isn't blank, else the first turn's text.

    Two partial aggregates; no conversation is collected."""
    text = first_text("text")
    mine = F.lower(strip("role")).isin(*USER_ROLES) & (text != "")
    a = turns.groupBy(conversation).agg(F.min_by(text, F.when(mine, F.col(turn))).alias("user"), F.min_by(text, F.col(turn)).alias("first"))
    return a.select(conversation, F.coalesce("user", "first").alias("prompt_text"))


def first_user_turns(turns: DataFrame, n: int = 3, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conversation, context_text): the first ``n`` user turns in order, joined by a blank line; blank ones count but are left out."""
    mine = turns.where(F.lower(strip("role")).isin(*USER_ROLES))
    rank = mine.withColumn("_n", F.row_number().over(Window.partitionBy(conversation).orderBy(turn))).where(f"_n <= {n}")
    kept = F.filter(F.array_sort(F.collect_list(F.struct("_n", first_text("text").alias("t")))), lambda x: x["t"] != "")
    return rank.groupBy(conversation).agg(F.array_join(F.transform(kept, lambda x: x["t"]), "\n\n").alias("context_text"))


def previous_roles(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turns (role) with ``previous_role``: the role of the nearest earlier turn that isn't a tool's; null if there is none."""
    w = Window.partitionBy(conversation).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    return turns.withColumn("previous_role", F.last(F.when(F.col("role") != "tool", F.col("role")), ignorenulls=True).over(w))


def after_last_user(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turns (role) with ``turn_index`` from 0, ``last_user_index`` (-1 if no user speaks) and ``after_last_user``."""
    t = turns.withColumn("turn_index", F.row_number().over(Window.partitionBy(conversation).orderBy(turn)) - 1)
    last = F.max(F.when(F.col("role") == "user", F.col("turn_index"))).over(Window.partitionBy(conversation))
    return t.withColumn("last_user_index", F.coalesce(last, F.lit(-1))).withColumn("after_last_user", F.col("turn_index") > F.col("last_user_index"))


def render_chat(turns: DataFrame, bos: str = "<bos>", conversation: str = "conv_id", turn: str = "turn", generation_prompt: bool = False) -> DataFrame:
    """(conversation, rendered): turns in chat-template form; assistant turns that follow each other are one turn.

    A conversation is one document and is collected as such."""
    role = F.when(F.lower("role") == "assistant", "model").otherwise(F.lower("role"))
    w = Window.partitionBy(conversation).orderBy(turn)
    t = turns.withColumn("_role", role).withColumn("_before", F.lag("_role").over(w)).withColumn("_after", F.lead("_role").over(w))
    opens = F.when(F.coalesce((F.col("_before") == "model") & (F.col("_role") == "model"), F.lit(False)), "").otherwise(F.concat(F.lit("<|turn>"), "_role", F.lit("\n")))
    closes = F.when(F.coalesce((F.col("_after") == "model") & (F.col("_role") == "model"), F.lit(False)), "").otherwise(F.lit("<turn|>\n"))
    piece = F.concat(opens, first_text("text"), closes)
    parts = F.transform(F.array_sort(F.collect_list(F.struct(turn, piece.alias("p")))), lambda x: x["p"])
    end = F.lit("<|turn>model\n" if generation_prompt else "")
    return t.groupBy(conversation).agg(F.concat(F.lit(bos), F.array_join(parts, ""), end).alias("rendered"))


def media_count(media: Column | str) -> Column:
    return F.size(media_values(media, "images", "image", "audio", "media_path", "url"))
