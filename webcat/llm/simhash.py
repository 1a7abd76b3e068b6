"""SimHash near-duplicates by covering locality-sensitive hashing.

Contract: A-Z are lower-cased, words are runs without ASCII white space, features are 3-word shingles with
repeats (the whole sequence if shorter, none for no word). A bit of the 64-bit fingerprint is set if more than
half of the shingles' XXH64 values (seed 42) have it. Fingerprints link at ``RADIUS`` or fewer differing bits.

Cases: a null text is an empty one; texts without words have fingerprint zero and link like any other. Rows
with a null id take part, and a group's id is its smallest non-null one (null if it has none). Repeated rows give
repeated result rows. An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcat.llm.common import checked_broadcast, saved, whole_row
from webcat.llm.components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Buckets up to this size are compared within a task; larger ones are split by further masks.
BUCKET = 256
LEVELS = 4


def masks(level: int, radius: int = RADIUS) -> list[int]:
    """The 2^(radius+1) - 1 masks of a level.

    Every bit position gets a non-zero vector of radius+1 bits; mask v keeps the positions whose vector has an odd
    overlap with v. The vectors of any ``radius`` positions leave some v orthogonal to all of them, so two values
    that differ in at most ``radius`` bits agree under at least one mask: no pair within the radius is missed.
    """
    n = (1 << (radius + 1)) - 1
    order = np.random.default_rng(1000 + level).permutation(64)
    vector = {int(bit): 1 + i % n for i, bit in enumerate(order)}
    return [sum(1 << b for b in range(64) if (vector[b] & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends))[: len(words) - SHINGLE + 1]
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), (ends[SHINGLE - 1:] - 1).tolist())]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(octets[:, k], minlength=256) @ BITS for k in range(8)])
    return sum(1 << int(b) for b in np.flatnonzero(2 * counts > len(hashes)))


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [_signed(fingerprint(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(values, pa.int64())], ["id", "tk", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tk, fp): a hash of every whole text and its signed 64-bit fingerprint; one pass, no shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.withColumn("tk", F.xxhash64("text")).mapInArrow(_fingerprints, "id long, tk long, fp long")


def _spanning(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bounded buckets of fingerprints -> edges (a, b) that span each group linked within the bucket."""
    for batch in batches:
        left, right = [], []
        for bucket in batch.column(0):
            values = np.unique(np.array(bucket.as_py(), dtype=np.int64))
            near = np.bitwise_count((values[:, None] ^ values[None, :]).view(np.uint64)) <= RADIUS
            label = np.arange(len(values))
            while True:
                lower = np.where(near, label[None, :], len(values)).min(axis=1)
                if (lower == label).all():
                    break
                label = lower
            for i in np.flatnonzero(label != np.arange(len(values))):
                left.append(int(values[label[i]]))
                right.append(int(values[i]))
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])


def links(values: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (a, b) that connect exactly what links within ``RADIUS`` connect.

    Each fingerprint goes to one bucket per mask. Buckets of two are compared in place, those up to ``BUCKET``
    in a task; members of a larger bucket are dealt again under the masks of the next level, joined to the ones
    that brought them there. A pair within the radius stays together under some mask of every level, and after
    ``LEVELS`` levels only a few bits are free, which bounds the bucket.
    """
    found = []
    rows = values.select("fp", F.lit(0).alias("tag"), F.lit(0).cast("long").alias("mask"))
    for level in range(LEVELS):
        dealt = F.array(*[
            F.struct((F.col("tag") * 15 + v).alias("tag"), F.col("mask").bitwiseOR(F.lit(_signed(m))).alias("mask"))
            for v, m in enumerate(masks(level))
        ])
        rows = rows.select("fp", F.explode(dealt).alias("d")).select(
            "fp", "d.tag", "d.mask", F.col("fp").bitwiseAND(F.col("d.mask")).alias("key")
        )
        sized = rows.groupBy("tag", "key").agg(
            F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
        ).filter("n > 1")
        sized = saved(sized, "buckets")
        found.append(sized.filter("n = 2").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS).select("a", "b"))
        last = level == LEVELS - 1
        middle = sized.filter("n > 2" if last else f"n > 2 AND n <= {BUCKET}").select("tag", "key")
        packed = rows.join(middle, ["tag", "key"]).groupBy("tag", "key").agg(F.collect_list("fp").alias("fps"))
        found.append(packed.select("fps").mapInArrow(_spanning, "a long, b long"))
        large = sized.filter(f"n > {BUCKET}").select("tag", "key")
        if last or not large.take(1):
            break
        rows = saved(rows.join(large, ["tag", "key"]).select("fp", "tag", "mask"), "large")
    edges = found[0]
    for more in found[1:]:
        edges = edges.union(more)
    return edges


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, tk, fp, component): the smallest id that links reach, itself included."""
    rows = saved(fingerprints(docs, id_col, text_col), "simhash")
    classes = saved(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = saved(components(links(classes.select("fp"))), "roots")
    known = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    known = known.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    groups = saved(known.join(least, "root").select("fp", "component"), "groups")
    return rows.join(groups, "fp").select("id", "tk", "fp", "component")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows and columns, one document of each near group: that with the group's smallest id.

    Where rows share an id, each stays or goes with the group of its own text. Rows without an id stay. Columns may have any names.
    """
    groups = near_groups(docs, id_col, text_col)
    losers = saved(groups.filter("id <> component").select("id", "tk").distinct(), "losers")
    rows = docs.select(
        whole_row(docs), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("tk"))
    return rows.join(checked_broadcast(losers, 48), ["id", "tk"], "left_anti").select("row.*")
