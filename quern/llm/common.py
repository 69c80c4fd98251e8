"""Shared by the operators of this subpackage: tables, checkpoints, sources, bounded broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.storage import bounded, drop_stored, stored

__all__ = ["bounded", "drop_stored", "source_key", "source_names", "spread", "stored", "table", "with_source"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files have fewer row groups than there are cores; else as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def source_key(c: Column) -> Column:
    """Spelling-independent form of a source's id or name: scheme, mirror, version, case, blanks and slashes removed."""
    s = F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"[\s\x{200B}\x{FEFF}]+", " "))), r"^[a-z]+://(?:datasets/)?|^mirror/|@v?[\w.]+$|/+$", "")
    return F.regexp_replace(s, r"[\s-]+", "_")


def source_names(specs: DataFrame) -> DataFrame:
    """(key, source_id) for every spelling key by which a spec is known; its id goes before another's name."""
    ids = specs.where(F.col("id").isNotNull()).select(source_key(F.col("id")).alias("key"), F.col("id").alias("source_id"), F.lit(0).alias("rank"))
    names = specs.where(F.col("name").isNotNull() & F.col("id").isNotNull()).select(source_key(F.col("name")).alias("key"), F.col("id").alias("source_id"), F.lit(1).alias("rank"))
    return ids.unionByName(names).groupBy("key").agg(F.min_by("source_id", F.struct("rank", "source_id")).alias("source_id"))


def with_source(records: DataFrame, specs: DataFrame, column: str) -> DataFrame:
    """``records`` with ``source_id``, the spec that ``column`` names in any spelling; null where it names none."""
    return records.withColumn("key", source_key(F.col(column))).join(bounded(source_names(specs)), "key", "left").drop("key")
