"""The typed record contract: schema, violations, strict and lenient validation, declared filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import estimate_tokens, strip
from quern.operators.clients import TEXT_ONLY
from quern.operators.prompts import media_count

TEACHER_RECORD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "source_model", "runtime", "prompt_text", "text")]
    + [T.StructField("estimated_tokens", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in ("prompt_source", "modality", "context_text")]
    + [T.StructField("media", T.MapType(T.StringType(), T.ArrayType(T.StringType()))), T.StructField("metadata", T.MapType(T.StringType(), T.StringType()))]
)


def blank(c: str) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def violation() -> Column:
    """Name of the first rule a teacher record breaks, else null: it needs a prompt, context or media; a source; and text."""
    media = F.coalesce(media_count("media"), F.lit(0)) > 0
    return F.when(blank("prompt_text") & blank("context_text") & ~media, "no_prompt").when(F.coalesce("prompt_source", F.lit("")) == "prompt_free", "prompt_free").when(blank("text"), "no_text")


def media_refused(runtime: str = "runtime") -> Column:
    """Whether a record's runtime can't be asked because it takes no media."""
    return F.coalesce(F.col(runtime).isin(*TEXT_ONLY) & (media_count("media") > 0), F.lit(False))


def validated(records: DataFrame, strict: bool = True) -> DataFrame:
    """Strict: the records, and the job fails on the first violation.  Lenient: the records with a ``violation`` column to route them by."""
    if not strict:
        return records.withColumn("violation", violation())
    v = violation()
    return records.where(F.when(v.isNotNull(), F.raise_error(F.concat(F.lit("contract violation: "), v)).cast("boolean")).otherwise(True))


# Openings of answers that are only a greeting, and texts of failed requests.
GREETINGS = r"(?i)^\W*(?:hello|hi|hey|sure|certainly|of course|absolutely|great question|thanks for asking|i'd be happy to help|as an ai)\b"
FAILURES = r"(?i)(?:connection (?:refused|reset)|timed? ?out|internal server error|bad gateway|service unavailable|rate limit|\b50[0234]\b error|traceback \(most recent call last\))"


def output_filter(min_tokens: int = 32, drop_empty: bool = True, drop_greetings: bool = True, drop_failures: bool = True, boilerplate_tokens: int = 64) -> Column:
    """Reason for which a declared output filter drops a text, else null.  A greeting drops only texts below ``boilerplate_tokens``."""
    t = F.coalesce("text", F.lit(""))
    out = F.when(F.lit(drop_empty) & blank("text"), "empty")
    out = out.when(F.lit(drop_failures) & t.rlike(FAILURES), "failure")
    out = out.when(F.lit(drop_greetings) & t.rlike(GREETINGS) & (estimate_tokens(t) < boilerplate_tokens), "greeting")
    return out.when(estimate_tokens(t) < min_tokens, "short")


def exact_duplicates(df: DataFrame, text: Column, id_col: str) -> DataFrame:
    """(text_hash, first_id, copies) of texts that occur more than once; ids are counted, not collected."""
    h = df.select(F.col(id_col).alias("_id"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_hash"))
    return h.groupBy("text_hash").agg(F.min("_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1")
