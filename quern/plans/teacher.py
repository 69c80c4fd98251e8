"""Prompt records to validated teacher records: resume, budget, generate, validate, append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import build_prompt, chat_content, estimate_tokens
from quern.operators.clients import TeacherConfig, generated, make_client
from quern.operators.contract import validated
from quern.operators.flow import resume, token_budget
from quern.operators.prompts import media_count
from quern.sources.writers import append_records
from quern.storage import drop_stored, prefix_sums, stored


def usable() -> Column:
    """Whether a prompt record can be asked and found again: it has an id, and a prompt or context."""
    return F.col("id").isNotNull() & build_prompt("prompt_text", "context_text", strict=False).isNotNull()


def generate_records(prompts: DataFrame, config: TeacherConfig, done: DataFrame | None = None, make=make_client) -> DataFrame:
    """Teacher records for the prompt records that aren't done, by key and not by place, so order and partitions don't matter."""
    todo = resume(prompts, done) if done is not None else prompts
    todo = todo.where(usable()).withColumn("prompt", build_prompt("prompt_text", "context_text"))
    content = F.when(F.coalesce(media_count("media"), F.lit(0)) > 0, chat_content("prompt", "media"))
    texts = generated(todo.withColumn("content", content), config, make)
    return todo.join(texts, "id").select(
        "id", F.lit(config.model).alias("source_model"), F.lit(config.runtime).alias("runtime"), F.col("prompt").alias("prompt_text"), "text",
        estimate_tokens("text").cast("int").alias("estimated_tokens"), F.col("source").alias("prompt_source"), "modality", F.coalesce("context_text", F.lit("")).alias("context_text"), "media", "metadata",
    )


def _written(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The records at ``path``; None where nothing was written yet."""
    try:
        found = spark.read.json(path) if path else None
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return found if found is not None and "id" in found.columns else None


def run(prompts: DataFrame, config: TeacherConfig, output: str, order: list[str], target_tokens: int = 0, chunk: int = 10_000, quarantine: str | None = None, make=make_client) -> int:
    """Generate in chunks of ``chunk`` prompts, each id once, in ``order`` until ``target_tokens`` estimated tokens are written, those of earlier runs
    included; 0 is no limit.  Requests are costly, so no more than a chunk is asked beyond the budget; the record that crosses it is kept.
    Prompts that can't be asked take no room in a chunk, those in ``quarantine`` are not asked again, and without a budget the end is
    when no other prompt is left."""
    spark, written = prompts.sparkSession, 0
    done = _written(spark, output)
    spent = done.agg(F.coalesce(F.sum("estimated_tokens"), F.lit(0))).first()[0] if done is not None else 0
    todo = prompts.where(usable()).dropDuplicates(["id"])
    for x in (done, _written(spark, quarantine)):
        todo = resume(todo, x) if x is not None else todo
    # prompts are put in order once and stored by chunk; neither they nor the output are read again
    at = prefix_sums(todo, [*order, "id"]).select("id", (F.col("ordinal") / chunk).cast("bigint").alias("_chunk"), F.col("ordinal").alias("_place"))
    queue = stored(todo.join(at, "id"), "_chunk")
    for k in range((queue.agg(F.max("_chunk")).first()[0] or 0) + 1):
        if target_tokens and spent >= target_tokens:
            break
        part = queue.where(F.col("_chunk") == k)
        made = stored(generate_records(part, config, make=make))
        kept = made
        if target_tokens:
            kept = token_budget(made.join(part.select("id", "_place"), "id"), ["_place", "id"], F.col("estimated_tokens"), target_tokens, spent).select(*made.columns)
        append_records(kept, output, quarantine)
        good = validated(kept, strict=False).where("violation is null") if quarantine else kept
        n, tokens = good.agg(F.count("*"), F.coalesce(F.sum("estimated_tokens"), F.lit(0))).first()
        written, spent = written + n, spent + tokens
        drop_stored(made)
    drop_stored(queue)
    return written
