"""Order MinHash fingerprints of documents, and their likeness.

A text is cut into units: words, those of over ``UNIT`` characters into pieces. K-mers are ``K`` consecutive units (all
units if fewer), numbered by occurrence, so that repeats differ. For each of ``SKETCHES`` hash functions the ``TUPLE``
numbered k-mers of smallest hash are put back in text order and hashed as a tuple. The signature is
the row of these tuple hashes; likeness is the share of equal ones. Since order counts, it follows edit
distance and not only the shared k-mers.

Cases: a null text is an empty one; all texts without words have the same signature. Equal texts have equal
signatures. Neighbours are by (id, text), a null id first; a single document is its own neighbour. Repeated rows
are neighbours of each other. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcat.llm.common import parallelism, slices, text_or_empty

K = 5
UNIT = 16
TUPLE = 2
SKETCHES = 32
#: K-mers hashed at once, which bounds the memory of a long text.
BLOCK = 1 << 15
UNITS = re.compile(r"\S{1,%d}" % UNIT)
_rng = np.random.default_rng(7)
FACTORS = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _kmers(text: str) -> np.ndarray:
    """One 64-bit value per k-mer, with its occurrence number mixed in."""
    units = UNITS.findall(text)
    crc = zlib.crc32
    codes = _mixed(np.fromiter((crc(u.encode("utf-8", "surrogatepass")) for u in units), np.uint64, len(units)))
    k = min(K, len(units))
    if not k:
        return np.zeros(1, np.uint64)
    value = np.zeros(len(codes) - k + 1, np.uint64)
    for j in range(k):
        value = _mixed(value * np.uint64(0x100000001B3) + codes[j: len(codes) - k + 1 + j])
    order = np.argsort(value, kind="stable")
    ranked = value[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    number = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = number
    return _mixed(value + occurrence * np.uint64(0xC2B2AE3D27D4EB4F))


def signature(text: str) -> np.ndarray:
    """``SKETCHES`` 32-bit tuple hashes."""
    kmers = _kmers(text)
    best = place = None
    for at in range(0, len(kmers), BLOCK):
        block = kmers[at: at + BLOCK]
        hashed = (block[None, :] ^ OFFSETS[:, None]) * FACTORS[:, None]
        hashed ^= hashed >> np.uint64(32)
        n = min(TUPLE, len(block))
        chosen = np.argpartition(hashed, n - 1, axis=1)[:, :n] if len(block) > n else np.tile(np.arange(n), (SKETCHES, 1))
        value, where = np.take_along_axis(hashed, chosen, 1), chosen + at
        if best is not None:
            value, where = np.concatenate((best, value), 1), np.concatenate((place, where), 1)
        order = np.argsort(value, axis=1, kind="stable")[:, :TUPLE]
        best, place = np.take_along_axis(value, order, 1), np.take_along_axis(where, order, 1)
    ordered = kmers[np.sort(place, axis=1)]
    out = np.zeros(SKETCHES, np.uint64)
    for j in range(ordered.shape[1]):
        out = _mixed(out * np.uint64(0x100000001B3) + ordered[:, j])
    return (out >> np.uint64(32)).astype(np.uint32)


def as_hex(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many (or all) of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


OUT = "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, shard, guest) in order; each is compared with the next one of its shard."""
    schema = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    before = None
    for batch in slices(batches, 1):
        rows = []
        columns = (batch.column(k).to_pylist() for k in range(4))
        for ident, text, shard, guest in zip(*columns):
            sketch = signature(text)
            if before is not None and before[2] == shard:
                own = before[3]
                changed = edited(before[1], text)
                other = signature(changed)
                rows.append((before[0], len(before[1]), changed, as_hex(own), as_hex(other), likeness(own, other), likeness(own, sketch)))
            before = None if guest else (ident, text, shard, sketch)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)


def fingerprint_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) for every document.

    Documents are cut into shards by id at quantiles; each shard also gets a copy of the document that follows its
    last, so one shuffle puts every pair of neighbours together and no window spans the table.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    n = parallelism(docs)
    bounds = sorted({int(b) for b in rows.approxQuantile("id", [i / n for i in range(1, n)], 1 / (8 * n))})
    shard = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("id"))) if bounds else F.lit(0)
    rows = rows.withColumn("shard", F.when(F.col("id").isNull(), F.lit(0)).otherwise(shard))
    key = F.struct(F.col("id").isNotNull().alias("known"), F.col("id").alias("id"))
    heads = sorted((r["shard"], r["head"]["id"]) for r in rows.groupBy("shard").agg(F.min(key).alias("head")).collect())
    # a row per shard: its first id goes to the shard before it as well, the very first one to the last shard
    sent = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    sent = F.broadcast(docs.sparkSession.createDataFrame(sent, "head long, to int"))
    rows = rows.join(sent, F.col("id").eqNullSafe(F.col("head")), "left")
    own = F.struct(F.col("shard").alias("shard"), F.lit(False).alias("guest"))
    guest = F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("shard"), F.lit(True).alias("guest")))
    dealt = rows.select("id", "text", F.explode(F.array_compact(F.array(own, guest))).alias("d"))
    dealt = dealt.select("id", "text", "d.shard", "d.guest").repartitionById(n, F.col("shard"))
    placed = dealt.sortWithinPartitions("shard", "guest", F.col("id").asc_nulls_first(), "text")
    return placed.mapInArrow(_compare, OUT)


