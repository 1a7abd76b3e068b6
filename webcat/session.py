"""Shared scratch space for checkpoints, streams and round trips, and numbering on top of it."""

from __future__ import annotations

import json
import math
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def allow_repeated_keys(df: DataFrame) -> DataFrame:
    """``df``, its session set to read JSON objects with repeated keys into variants; the last value counts.

    Spark has no such option for a single expression, so the setting stays.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of the machine: on a cluster the executors
    could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]  # Spark appends a folder of its own
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="webcat-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the scratch root."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is missing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise and cut the lineage on storage that outlives any executor."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)


def _at_least(bounds: list[tuple], names: tuple[str, ...], schema: T.StructType, key: Column) -> Column:
    """How many of the ascending bounds are not above ``key``, by a look at every n-th and then at the n after it."""
    shape = T.ArrayType(T.StructType([T.StructField(n, schema[n].dataType) for n in names]))
    fields = [dict(zip(names, b)) for b in bounds]
    step = math.isqrt(len(bounds)) + 1

    def literal(rows: list[dict]) -> Column:
        return F.from_json(F.lit(json.dumps(rows, default=str)), shape, {"ignoreNullFields": "false"})

    coarse = F.size(F.filter(literal(fields[::step]), lambda b: b <= key))
    first = F.greatest((coarse - 1) * step, F.lit(0))
    return first + F.size(F.filter(F.slice(literal(fields), first + 1, F.lit(step)), lambda b: b <= key))


def numbered_within(df: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds ``idx``: 0, 1, 2 .. per group in the given order, without one task per group; rows with equal keys in any order.

    One exchange of the rows, whatever they carry. A pass over the keys finds range bounds of (group, order), another counts
    each group's rows per range; both leave one row per range. Rows are then dealt to their ranges, and a row's number is its
    number inside its range plus the rows of its group in the ranges before. The result is clustered by group, with a
    dominating group spread over several partitions. ``df`` is read once for its rows and three times for its keys:
    checkpoint what is dear or not repeatable.
    """
    names = (group, *order)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(*names)
    bounds = (
        keys.repartitionByRange(parts, *names).groupBy(F.spark_partition_id()).agg(F.min(F.struct(*names)).alias("low"))
        .select("low.*").collect()  # one row per range
    )
    if not bounds:
        return df.withColumn("idx", F.lit(0))
    # sorted as Spark sorts them: nulls first, texts by their bytes
    low = sorted((tuple(b) for b in bounds), key=lambda b: [(v is not None, v.encode() if isinstance(v, str) else v or 0) for v in b])
    place = F.greatest(_at_least(low, names, df.schema, F.struct(*names)) - 1, F.lit(0)).alias("_range")
    sizes = keys.select(group, place).groupBy(group, "_range").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(group).alias("_group"), F.col("_range").alias("_at"), F.sum("n").over(before).alias("_offset"))
    # only the first group of a range can have begun before it, so these are fewer rows than ranges
    started = F.broadcast(offsets.filter(F.col("_offset") > 0))
    dealt = df.select("*", place).repartitionById(len(low), F.col("_range"))
    inside = F.row_number().over(Window.partitionBy("_range", group).orderBy(*order))
    same = (F.col("_range") == F.col("_at")) & F.col(group).eqNullSafe(F.col("_group"))
    return (
        dealt.withColumn("_inside", inside).join(started, same, "left")
        .withColumn("idx", (F.coalesce("_offset", F.lit(0)) + F.col("_inside") - 1).cast("int"))
        .drop("_range", "_inside", "_group", "_at", "_offset")
    )
