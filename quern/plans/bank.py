"""A bank of prompt records from many sources: open, interleave, limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.flow import interleave
from quern.operators.prompts import prompt_records
from quern.sources.readers import read_manifests, read_mirror
from quern.storage import stored

SPEC = "id string, source_order int, max_records int, role string, modality string, license_hint string, teacher_prompt string"


def opened(spark: SparkSession, sources: list[dict], schema: str, folder: str, mirrors: str | None = None) -> tuple[DataFrame, list[dict]]:
    """(rows with source_id, source_order, raw_path, raw_order; failures): manifests, and local mirrors for sources that aren't manifests only.

    A source that can't be opened or read further is reported and doesn't stop the others; an error if none can be opened."""
    failed, out = [], None
    manifests = [s for s in sources if s.get("manifest_only") or mirrors is None]
    order = {s["id"]: k for k, s in enumerate(sources)}
    if manifests:
        try:
            out, failed = read_manifests(spark, manifests, schema, folder)
        except RuntimeError:
            failed = [{"source": s["id"], "error": "manifest can't be opened"} for s in manifests]
    for s in sources:
        if s in manifests:
            continue
        try:
            rows = read_mirror(spark, mirrors, s)
        except Exception as e:  # the reader's own errors, of any format
            failed.append({"source": s["id"], "error": str(e).split("\n")[0]})
            continue
        rows = rows.withColumn("raw_path", F.lit("")).withColumn("raw_order", F.monotonically_increasing_id()).withColumn("source_order", F.lit(order[s["id"]]))
        rows = stored(rows)  # the numbers hold for this reading only
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise RuntimeError(f"no source could be opened: {failed}")
    return out, failed


def prompt_bank(
    spark: SparkSession, sources: list[dict], schema: str, folder: str, names: list[str] | None = None, mirrors: str | None = None, per_source: int = 0, total: int = 0, max_chars: int = 12_000
) -> tuple[DataFrame, list[dict]]:
    """(prompt records with position, failures): enabled sources, those asked for by id or name, in a round robin with their quotas.

    A row that gives no record uses up its source's turn.  Records are ordered by ``position``; a source is as long as its ``max_records``, else
    ``per_source``; ``total`` limits all.  0 is no limit."""
    live = [s for s in sources if s.get("enabled") is not False and (not names or s["id"] in names or s.get("name") in names)]
    rows, failed = opened(spark, live, schema, folder, mirrors)
    fields = [x.split(" ")[0] for x in SPEC.split(", ")]
    specs = spark.createDataFrame([tuple(k if f == "source_order" else s.get(f) for f in fields) for k, s in enumerate(live)], SPEC)
    key = ["raw_path", "raw_order"]
    records = prompt_records(rows, specs, "source_id", key, max_chars, flagged=True)
    taken = interleave(records, specs, "source_id", key, F.col("accepted"), per_source=per_source, total=total)
    return taken.drop("accepted", "source_id", *key, "raw_index", "source_order"), failed
