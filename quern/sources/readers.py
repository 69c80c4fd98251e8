"""Readers: JSON lines, manifests, source configurations, files, media, logs."""

from __future__ import annotations

import io
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quern.functions.text import media_values
from quern.operators.flow import seeded_shuffle
from quern.storage import prefix_sums, with_positions

MESSAGE = "array<struct<role:string,`from`:string,speaker:string,content:string,value:string,text:string,message:string>>"
SOURCE_CONFIG = (
    "sources array<struct<id:string,name:string,role:string,modality:string,split:string,enabled:boolean,max_records:int,streaming:boolean,manifest_only:boolean,"
    "license_hint:string,config:string,manifest_path:string,teacher_prompt:string>>"
)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed rows of JSON lines; blank lines are skipped, a malformed line fails the job."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def read_jsonl_open(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(value VARIANT) of JSON lines with any keys; malformed lines fail, or are null where not ``strict``."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select((F.parse_json("value") if strict else F.try_parse_json("value")).alias("value"))


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, local or with a scheme (file, hdfs, s3, gs), and the path within it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


class _Chunk(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class JsonLineOffsets(DataSource):
    """``spark.read.format("jsonl_offsets").load(path)``: (path, offset, line) of every non-blank line, read in chunks of a file in parallel."""

    @classmethod
    def name(cls) -> str:
        return "jsonl_offsets"

    def schema(self) -> str:
        return "path string, offset bigint, line string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _OffsetReader(self.options["path"], int(self.options.get("chunk", 64 << 20)))


class _OffsetReader(DataSourceReader):
    def __init__(self, path: str, chunk: int):
        self.path, self.chunk = path, chunk

    def partitions(self) -> list[_Chunk]:
        out = []
        for root in self.path.split(","):
            system, path = _file_system(root)
            info = system.get_file_info(path)
            files = [info] if info.is_file else sorted((f for f in system.get_file_info(fs.FileSelector(path)) if f.is_file and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)
            scheme = root.split("://")[0] + "://" if "://" in root and not root.startswith("file:") else ""
            out += [_Chunk(scheme + f.path, s, s + self.chunk) for f in files for s in range(0, max(1, f.size), self.chunk)]
        return out

    def read(self, partition: _Chunk) -> Iterator[tuple]:
        system, path = _file_system(partition.path)
        with io.BufferedReader(system.open_input_file(path), 1 << 20) as f:
            if partition.start:  # a line belongs to the chunk in which it starts
                f.seek(partition.start - 1)
                f.readline()
            while (at := f.tell()) < partition.end and (line := f.readline()):
                if text := line.decode().strip():
                    yield partition.path, at, text


def read_ordered(spark: SparkSession, path: str, record_order: str = "shuffled", seed: int = 1337) -> DataFrame:
    """(path, offset, line, position): lines in file order for ``source``, else in a seeded permutation of their offsets.

    Only offsets are sorted; the lines are read again and joined to their positions."""
    lines = read_offsets(spark, path)
    if record_order == "source":
        at = prefix_sums(lines, ["path", "offset"]).withColumnRenamed("ordinal", "position")
        return with_positions(lines, at, ["path", "offset"], "position")
    return seeded_shuffle(lines, seed, "path", "offset")


def read_offsets(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, offset, line) of every non-blank line of files or folders."""
    spark.dataSource.register(JsonLineOffsets)
    return spark.read.format("jsonl_offsets").load(",".join(paths))


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """Source specs of a configuration file, with ``source_order``, their place in it."""
    return spark.read.schema(SOURCE_CONFIG).json(path, multiLine=True).select(F.posexplode("sources").alias("source_order", "s")).select("source_order", "s.*")


def manifest_path(source: dict, folder: str = "data/manifests") -> str:
    """Where a source's manifest is: as given, else named by the slug of its name or id."""
    return source.get("manifest_path") or f"{folder}/{re.sub('[^A-Za-z0-9_.-]+', '_', source.get('name') or source['id'])}.jsonl"


def read_manifests(spark: SparkSession, sources: list[dict], schema: T.StructType | str, folder: str = "data/manifests") -> tuple[DataFrame | None, list[dict]]:
    """(rows with ``source_id``, ``source_order``, ``raw_path`` and ``raw_order``, failures): one source that can't be read doesn't stop the others; an error if none can be opened.

    A manifest is a file or a folder of files.  A source whose manifest is missing gives no row; of a file with a malformed line the rows
    before that line are read.  Both are reported.  ``raw_order`` is a line's offset in its file."""
    failed, live = [], []
    for k, s in enumerate(sources):
        p = manifest_path(s, folder)
        system, path = _file_system(p)
        if system.get_file_info(path).type == fs.FileType.NotFound:
            failed.append({"source": s["id"], "error": f"no such manifest: {p}"})
        else:
            live.append((k, s["id"], path))
    if not live:
        if sources:
            raise RuntimeError(f"no source could be opened: {json.dumps(failed)}")
        return None, failed
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = read_offsets(spark, *[manifest_path(s, folder) for s in sources if s["id"] in {x[1] for x in live}])
    at = F.create_map(*[x for k, i, p in live for x in (F.lit(p), F.struct(F.lit(k).alias("k"), F.lit(i).alias("i")))])  # one entry per source
    bare = F.regexp_replace("path", r"^[a-z0-9]+://", "")
    lines = lines.withColumn("_at", F.coalesce(F.try_element_at(at, bare), F.try_element_at(at, F.regexp_replace(bare, r"/[^/]*$", ""))))
    open_schema = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    rows = lines.select("path", "offset", F.col("_at.i").alias("source_id"), F.col("_at.k").alias("source_order"), F.from_json("line", open_schema, {"columnNameOfCorruptRecord": "_bad"}).alias("_r"))
    bad = rows.where(F.col("_r").isNull() | F.col("_r._bad").isNotNull()).groupBy("source_id", "path").agg(F.min("offset").alias("_stop"))
    stops = {(r["source_id"], r["path"]): r["_stop"] for r in bad.collect()}  # at most one row per file
    failed += [{"source": k, "error": f"malformed line at byte {v} of {p}"} for (k, p), v in sorted(stops.items())]
    if stops:
        cut = F.create_map(*[F.lit(x) for (_, p), v in stops.items() for x in (p, v)])
        rows = rows.where(F.col("offset") < F.coalesce(F.try_element_at(cut, F.col("path")), F.lit((1 << 63) - 1)))
    return rows.select("_r.*", "source_id", "source_order", F.col("path").alias("raw_path"), F.col("offset").alias("raw_order")).drop("_bad"), failed


def read_mirror(spark: SparkSession, root: str, source: dict, format: str = "parquet") -> DataFrame:
    """Rows of a dataset's local mirror: root / slug of its id / configuration / split, which is ``train`` unless named."""
    parts = [re.sub("[^A-Za-z0-9_.-]+", "_", source["id"]), *([source["config"]] if source.get("config") else []), source.get("split") or "train"]
    return spark.read.format(format).load(os.path.join(root, *parts)).withColumn("source_id", F.lit(source["id"]))


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, sha256) of all files below ``root`` without compiled Python; a missing folder has none."""
    system, path = _file_system(root)
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return spark.createDataFrame([], "path string, bytes bigint, sha256 string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    kept = files.where(~F.col("path").rlike(r"/__pycache__/|\.py[co]$"))
    return kept.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def read_media(spark: SparkSession, records: DataFrame, keys: tuple[str, ...], root: str, id_col: str = "id") -> DataFrame:
    """(id, index, path, content): the media files under ``keys`` of each record's media map, joined to their bytes; files that don't exist are left out."""
    wanted = records.select(id_col, F.posexplode(media_values("media", *keys)).alias("index", "path"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.regexp_replace("path", "^file:/*", "/").alias("_file"), "content")
    base = root.rstrip("/")
    full = F.when(F.col("path").startswith("/"), F.col("path")).otherwise(F.concat(F.lit(base + "/"), F.col("path")))
    return wanted.join(files, full == F.col("_file")).select(id_col, "index", "path", "content")


def decode_images(media: DataFrame) -> DataFrame:
    """(id, index, path, height, width, rgb): images as rows of RGB bytes.  PNG of eight bits a sample and binary PPM are decoded here,
    other formats by the image library where one is installed; what can't be decoded gives nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quern.sources.images import decode

        for b in batches:
            got = [decode(c) for c in b.column(3).to_pylist()]
            columns = [pa.array([g[k] if g else None for g in got], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *columns], ["id", "index", "path", "height", "width", "rgb"])

    return media.select("id", "index", "path", "content").mapInArrow(run, "id string, index int, path string, height int, width int, rgb binary")


def decode_audio(media: DataFrame) -> DataFrame:
    """(id, index, path, sampling_rate, samples): PCM WAV files as float samples, channels averaged; other formats give null samples.
    A rate declared for the item (column ``declared_rate``) goes before the file's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import wave

        import numpy as np

        for b in batches:
            rates, samples = [], []
            for content in b.column(3).to_pylist():
                try:
                    with wave.open(io.BytesIO(content)) as w:
                        kind = {1: np.uint8, 2: np.int16, 4: np.int32}[w.getsampwidth()]
                        x = np.frombuffer(w.readframes(w.getnframes()), kind).astype(np.float32)
                        x = (x - 128) / 128 if kind is np.uint8 else x / float(1 << (8 * w.getsampwidth() - 1))
                        rates.append(w.getframerate())
                        samples.append(x.reshape(-1, w.getnchannels()).mean(axis=1))
                except (wave.Error, EOFError, KeyError, TypeError):
                    rates.append(None)
                    samples.append(None)
            rates = [d or r for d, r in zip(b.column(4).to_pylist(), rates)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(rates, pa.int32()), pa.array(samples, pa.list_(pa.float32()))], ["id", "index", "path", "sampling_rate", "samples"])

    declared = (F.col("declared_rate") if "declared_rate" in media.columns else F.lit(None)).cast("int").alias("declared_rate")
    return media.select("id", "index", "path", "content", declared).mapInArrow(run, "id string, index int, path string, sampling_rate int, samples array<float>")


def encoder_inputs(shards: DataFrame) -> DataFrame:
    """The columns of shard rows that an encoder reads, those that are there."""
    names = ("prefix_ids", "attention_mask", "prefix_lens", "pixel_values", "input_features", "input_features_mask", "image_position_ids", "mm_token_type_ids")
    return shards.select(*[n for n in names if n in shards.columns])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shard rows with their attention mask rebuilt from the prefix's length."""
    s = spark.read.parquet(path)
    if "prefix_lens" not in s.columns:
        return s
    pad, kept = F.size("prefix_ids") - F.col("prefix_lens"), F.col("prefix_lens").cast("int")
    return s.withColumn("attention_mask", F.concat(F.array_repeat(F.lit(0), pad), F.array_repeat(F.lit(1), kept)))


# Fixed value: the file that names the newest checkpoint of a folder.
POINTER = "latest_checkpoint.txt"


def latest_checkpoint(folder: str) -> str | None:
    """The path that the pointer file of a folder names, as it is or below the folder, if it exists."""
    system, root = _file_system(folder)
    pointer = f"{root}/{POINTER}"
    if not system.get_file_info(pointer).is_file:
        return None
    with system.open_input_file(pointer) as f:
        named = f.read().decode().strip()
    for p in (named, f"{folder.rstrip('/')}/{named}"):
        there, path = _file_system(p)
        if named and there.get_file_info(path).type != fs.FileType.NotFound:
            return p
    return None


def read_base_config(spark: SparkSession, path: str) -> DataFrame:
    """(config VARIANT) of a base model's configuration file; a configuration without ``text_config`` is an error."""
    c = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("config"))
    has = F.variant_get("config", "$.text_config", "variant").isNotNull()
    return c.where(F.when(has, True).otherwise(F.raise_error(F.lit(f"no text_config in {path}")).cast("boolean")))


def log_tail(log: DataFrame, n: int = 20, step: str = "step") -> DataFrame:
    """The last ``n`` rows of a step log."""
    return log.orderBy(F.desc(step)).limit(n).orderBy(step)

