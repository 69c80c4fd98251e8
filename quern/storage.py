"""Intermediate tables in the shared folder, global ordinals and prefix sums without a single-task window."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; one of our own only where the session names none, as in local tests."""
    sc = spark.sparkContext
    named = sc._jsc.sc().getCheckpointDir()
    if named.isEmpty():
        given = sc.getConf().get("spark.checkpoint.dir")
        if given is None and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="checkpoint-"))
        named = sc._jsc.sc().getCheckpointDir()
    return named.get()


_FOLDERS: list[str] = []  # of the tables that this process has stored


def new_folder(spark: SparkSession) -> str:
    """A folder of its own below the shared one, deleted by ``drop_all``."""
    _FOLDERS.append(f"{shared_folder(spark)}/table-{uuid.uuid4().hex}")
    return _FOLDERS[-1]


def stored(df: DataFrame, *partitions: str) -> DataFrame:
    """``df`` written as a table to the shared folder and read from there: its lineage ends, it is computed once, and a
    lost executor costs none of it.  ``partitions``: columns by which parts of it can be read alone."""
    path = new_folder(df.sparkSession)
    (df.write.partitionBy(*partitions) if partitions else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_stored(df: DataFrame) -> None:
    """Delete the table of a ``stored`` DataFrame that no plan reads any more."""
    for f in df.inputFiles()[:1]:
        for folder in [x for x in _FOLDERS if f"/{x.rsplit('/', 1)[-1]}/" in f]:
            _delete(df.sparkSession, folder)
            _FOLDERS.remove(folder)


def drop_all(spark: SparkSession) -> None:
    """Delete every stored table of this process: for long sessions, once their results are written."""
    while _FOLDERS:
        _delete(spark, _FOLDERS.pop())


def bounded(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else unchanged for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def prefix_sums(df: DataFrame, order: list[str], group: list[str] | None = None, carried: list[str] | None = None, **sums: Column) -> DataFrame:
    """(group, order, carried, ordinal, sums): the 0-based ``ordinal`` and, per keyword, the sum of that expression over all earlier rows, by ``order`` within ``group``.

    Only keys, measures and the narrow columns ``carried`` are sorted, stored and returned; ``with_positions`` joins them to the rest of a row.  Two levels: the rows are
    range-partitioned by group and order and stored; per slice there is a total; the totals' running sums are added to
    windows within slices.  A hot group is spread over slices like everything else.  Nulls in a summed expression count as 0; rows that
    tie in ``order`` follow each other in an arbitrary but fixed way, so give a unique one.
    """
    group = group or []
    keys = list(dict.fromkeys([*group, *order]))
    kept = list(dict.fromkeys([*keys, *(carried or [])]))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = df.select(*kept, *[F.coalesce(v, F.lit(0)).alias(f"_v_{k}") for k, v in sums.items()])
    s = stored(narrow.repartitionByRange(n, *keys).withColumn("_slice", F.spark_partition_id()))
    totals = s.groupBy("_slice", *group).agg(F.count("*").alias("_n"), *[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    # slices are few: at most the number of partitions plus the number of groups
    offsets = totals.select("_slice", *[F.col(g).alias(f"_g_{g}") for g in group], zero(F.sum("_n").over(earlier)).alias("_o"), *[zero(F.sum(f"_t_{k}").over(earlier)).alias(f"_o_{k}") for k in sums])
    within = Window.partitionBy("_slice", *group).orderBy(*order)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    local = s.withColumn("_r", F.row_number().over(within) - 1)
    for k in sums:
        local = local.withColumn(f"_l_{k}", zero(F.sum(f"_v_{k}").over(before)))
    on = local["_slice"] == offsets["_slice"]
    for g in group:
        on = on & local[g].eqNullSafe(offsets[f"_g_{g}"])
    return local.join(offsets, on).select(*[local[c] for c in kept], (F.col("_r") + F.col("_o")).alias("ordinal"), *[(F.col(f"_l_{k}") + F.col(f"_o_{k}")).alias(k) for k in sums])


def with_positions(df: DataFrame, positions: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """``df`` with ``columns`` of ``positions``, joined on unique ``keys``, which may be null; rows without a position are left out."""
    if set(df.columns) <= set(keys):
        return positions.select(*df.columns, *columns)
    p = positions.select(*[F.col(k).alias(f"_p_{i}") for i, k in enumerate(keys)], *columns)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_p_{i}"))
    return df.join(p, on).select(*[df[c] for c in df.columns], *columns)


def up_to(df: DataFrame, order: list[str], last: Row | None) -> DataFrame:
    """The rows of ``df`` whose ``order`` isn't after that of ``last``, by a filter; none if there is no last row."""
    if last is None:
        return df.limit(0)
    keep, equal = F.lit(False), F.lit(True)
    for o in order:  # nulls come first
        v = last[o]
        kind = df.select(o).schema[0].dataType
        here = F.col(o)
        keep = keep | (equal & (here.isNull() if v is not None else F.lit(False)))
        if v is not None:
            keep = keep | (equal & F.coalesce(here < F.lit(v).cast(kind), F.lit(False)))
        equal = equal & here.eqNullSafe(F.lit(v).cast(kind))
    return df.where(keep | equal)
