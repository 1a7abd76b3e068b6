"""Helpers of this subpackage: tables, saved intermediate results, joins whose small side is checked."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcat.session import scratch_dir

#: A side of a join is broadcast only if its counted rows times a generous row width stay below this.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read again: lineage is cut and a lost executor loses nothing."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(df: DataFrame) -> None:
    """Remove the files of a saved table that nothing will read again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freed(df: DataFrame) -> None:
    """Have Spark delete the shuffle files of finished jobs: it does so only for what the driver's collectors have found dead.

    Python's objects hold those of the driver, and Spark deletes beside the job, so it is given a moment, twice.
    """
    for _ in range(2):
        gc.collect()
        df.sparkSession._jvm.System.gc()
        time.sleep(0.5)


def checked_broadcast(small: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES, array: str | None = None) -> DataFrame:
    """``small`` (a saved table) marked for broadcast if its counted size allows it; else as it is, to be shuffled.

    ``array`` names a column of lists, whose entries count 8 bytes each beside the ``row_bytes`` of every row.
    """
    if array is None:
        size = small.count() * row_bytes
    else:
        n, entries = small.agg(F.count("*"), F.coalesce(F.sum(F.greatest(F.size(array), F.lit(0))), F.lit(0))).first()
        size = n * row_bytes + entries * 8
    return F.broadcast(small) if size <= limit else small


def whole_row(docs: DataFrame) -> Column:
    """All columns of the input as one struct ``row``, so that none of them can clash with an operator's own."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")


def has_rows(df: DataFrame) -> bool:
    return bool(df.take(1))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batches, column: int = 1, limit: int = 2 << 20):
    """Arrow batches cut into runs of whole rows whose column holds about ``limit`` bytes, so a task's memory is bounded."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // limit
        starts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1)) if len(part) else np.array([], int)
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(int(a), int(b - a))
