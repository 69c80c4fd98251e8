"""Structured Streaming: incremental appends, log metrics, windows over events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.operators.contract import violation


def file_stream(spark: SparkSession, path: str, schema, format: str = "json", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).format(format).option("maxFilesPerTrigger", files_per_trigger).load(path)


def table_stream(spark: SparkSession, folder: str, table: str, files_per_trigger: int = 100) -> DataFrame:
    """A stored Parquet table, one file or a folder of files, as a stream of its files."""
    path = f"{folder}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{table}.parquet").option("recursiveFileLookup", "false").parquet(folder)


def append_records(stream: DataFrame, output: str, quarantine: str, checkpoint: str, key: str = "id", time: str | None = None, late: str = "1 day") -> StreamingQuery:
    """Validate each batch and append it; repeated keys are dropped within the watermark, or without a time column against the keys written so
    far, which are read from the output and its quarantine: no state grows.

    Batches are written under their number, so a replayed batch overwrites itself: each row arrives once."""
    s = stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key]) if time else stream

    def write(batch: DataFrame, number: int) -> None:
        if not time:
            batch = batch.dropDuplicates([key])
            for path in (output, quarantine):
                batch = _unwritten(batch, path, key, number)
        b = batch.withColumn("violation", violation()).persist()
        b.where("violation is null").drop("violation").write.mode("overwrite").json(f"{output}/batch={number}")
        b.where("violation is not null").write.mode("overwrite").json(f"{quarantine}/batch={number}")
        b.unpersist()

    return s.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _unwritten(batch: DataFrame, path: str, key: str, number: int) -> DataFrame:
    """Rows whose key no earlier batch has written below ``path``."""
    spark = batch.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return batch
    done = spark.read.schema(f"`{key}` {batch.schema[key].dataType.simpleString()}, batch int").json(path).where(F.col("batch") < number)
    return batch.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def running_totals(stream: DataFrame, by: list[str], **sums: Column) -> DataFrame:
    """Totals per key, for update or complete mode."""
    return stream.groupBy(*by).agg(F.count("*").alias("records"), *[F.sum(v).alias(k) for k, v in sums.items()])


def windowed(events: DataFrame, time: str, width: str, by: list[str], slide: str | None = None, late: str = "10 minutes", **aggregates: Column) -> DataFrame:
    """Event-time windows with a watermark, tumbling or sliding; works on batches and streams alike."""
    e = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late) if events.isStreaming else events
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return e.groupBy(w.alias("window"), *by).agg(F.count("*").alias("events"), *[v.alias(k) for k, v in aggregates.items()]).select(F.col("window.start").alias("window_start"), *by, "events", *aggregates)


def run_available(stream: DataFrame, path: str, mode: str = "complete", checkpoint: str | None = None) -> DataFrame:
    """Run a stream over what is there, into a table at ``path``: the whole result of each batch in ``complete`` mode, else its rows under the batch's number, so that a
    replayed batch overwrites itself."""
    w = stream.writeStream.outputMode(mode).trigger(availableNow=True)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    at = lambda number: path if mode == "complete" else f"{path}/batch={number}"
    w.foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(at(number))).start().awaitTermination()
    spark = stream.sparkSession
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(path)
