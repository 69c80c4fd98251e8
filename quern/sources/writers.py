"""Writers: JSON lines with counts, guarded appends, shards, manifests, bundles, presets."""

from __future__ import annotations

import hashlib
import json
import os
import re
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quern.operators.contract import validated


def write_jsonl(df: DataFrame, path: str, source: str = "source") -> dict:
    """Overwrite ``path`` with JSON lines; counts in total and by source.  Only the source's column of the written rows is read again."""
    seen = Observation()
    df.observe(seen, F.count("*").alias("records")).write.mode("overwrite").json(path)
    by = df.sparkSession.read.schema(df.select(source).schema).json(path).groupBy(source).count().collect() if seen.get["records"] else []
    return {"records": seen.get["records"], "output": path, "by_source": {r[source]: r["count"] for r in by}}


def append_records(records: DataFrame, path: str, quarantine: str | None = None) -> None:
    """Append teacher records as JSON lines.  Strict without ``quarantine``: a violation fails the job and nothing of it is committed;
    otherwise violating records go there with the rule they break."""
    if quarantine is None:
        validated(records).write.mode("append").json(path)
        return
    r = validated(records, strict=False)
    r.where("violation is null").drop("violation").write.mode("append").json(path)
    r.where("violation is not null").write.mode("append").json(quarantine)


def write_media(media: DataFrame, folder: str) -> DataFrame:
    """(id, index, path) of media (id, kind, index, extension, content), each written to ``folder``/id_kind_index.extension by the task that holds it.

    A row whose ``path`` (a column, where there is one) is set keeps it and isn't written; null contents without a path give a null path.  Names depend on the
    row only, so a retried task writes the same files."""
    given = (F.col("path") if "path" in media.columns else F.lit(None)).cast("string").alias("path")
    rows = media.select(F.col("id").cast("string").alias("id"), "kind", F.col("index").cast("int").alias("index"), "extension", "content", given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder if "://" in folder else os.path.abspath(folder.removeprefix("file:")))
        system.create_dir(root, recursive=True)
        for b in batches:
            out = []
            for key, kind, index, extension, content, path in zip(*(b.column(k).to_pylist() for k in range(6))):
                if path is None and content is not None:
                    path = f"{root}/{re.sub('[^A-Za-z0-9_.-]+', '_', key)}_{kind}_{index}.{extension}"
                    with system.open_output_stream(path) as f:
                        f.write(content)
                out.append(path)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out, pa.string())], ["id", "index", "path"])

    return rows.mapInArrow(run, "id string, index int, path string")


def write_shards(rows: DataFrame, path: str) -> None:
    """One folder per family and shard; a shard is written by one task, families and shards in parallel."""
    rows.repartition("family", "shard_id").write.mode("overwrite").partitionBy("family", "shard_id").parquet(path)


# The presets and the variable that chooses the training mode per shell.
PRESETS = {
    "gpu": {
        "target_estimated_tokens": 50_000_000, "target_blocks": 200_000, "max_steps": 200_000, "batch_size": 1, "grad_accum": 32, "learning_rate": "2e-4",
        "train_mode_windows": "lora", "train_mode_linux": "qlora",
    }
}
MODE = {"bash": 'export DG_TRAIN_MODE="$DG_TRAIN_MODE_LINUX"', "powershell": "$env:DG_TRAIN_MODE=$env:DG_TRAIN_MODE_WINDOWS"}


def presets(name: str = "gpu", style: str = "json", values: dict[str, dict[str, object]] = PRESETS) -> str:
    """A preset as JSON, as shell exports or as PowerShell assignments."""
    p = values[name]
    if style == "json":
        return json.dumps(p, indent=2)
    line = 'export DG_{}="{}"' if style == "bash" else '$env:DG_{}="{}"'
    return "\n".join([*(line.format(k.upper(), v) for k, v in p.items()), MODE[style]])


def write_bundle(files: DataFrame, path: str, root: str) -> dict:
    """Pack files (path, bytes, sha256) below ``root`` into a tar.gz with MANIFEST.json; the bundle's summary is returned and written beside it.

    The manifest is one row per artifact of a model, so it is held by the driver; the bytes are streamed."""
    rows = sorted(((os.path.relpath(r["path"], root), r["path"], r["bytes"], r["sha256"]) for r in files.toLocalIterator()))
    manifest = [{"path": a, "bytes": n, "sha256": h} for a, _, n, h in rows]
    staged = f"{path}.manifest"
    with open(staged, "w") as f:
        json.dump(manifest, f, indent=2)
    with tarfile.open(path, "w:gz") as tar:
        for a, p, _, _ in rows:
            tar.add(p, arcname=a)
        tar.add(staged, arcname="MANIFEST.json")
    os.remove(staged)
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while chunk := f.read(1 << 20):
            digest.update(chunk)
    summary = {"bundle": path, "files": len(manifest), "bytes": sum(m["bytes"] for m in manifest), "sha256": digest.hexdigest()}
    with open(f"{path}.json", "w") as f:
        json.dump(summary, f, indent=2)
    return summary


def write_report(report: DataFrame, path: str) -> None:
    """Overwrite ``path`` with a report of one row as JSON: progress, totals, transplant or validation reports, configurations."""
    report.limit(1).coalesce(1).write.mode("overwrite").json(path)


def append_log(steps: DataFrame, path: str) -> None:
    """Append step rows as JSON lines; nulls are left out of a line."""
    steps.write.mode("append").json(path)


def report_json(report: DataFrame) -> DataFrame:
    """(json) of each row of a report."""
    return report.select(F.to_json(F.struct("*")).alias("json"))
