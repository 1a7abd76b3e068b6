"""Product codes of vectors: k-means per part of the vector, with norm-of-sum bounds that save most distances.

Components become floor(4096 * x). Vectors are cut into ``PARTS`` consecutive parts; each part position has a codebook of
up to ``ENTRIES`` entries, first those of the smallest ids. A round assigns every part to the nearest entry (squared distance,
ties to the lower index) and moves each entry to floor(sum / count) of its parts; an unused one stays. After the last round
parts are assigned once more.

A part keeps its entry, an upper bound of the distance to it and a lower bound of the distance to all others, each with
the round in which it was exact. All codebooks so far are kept. A bound is shifted by the true net way that its entry has
gone since that round, not by the sum of the ways of single rounds. Only where the bounds cross the distance to the own
entry is made exact, and where they still cross the part is compared with the whole codebook. Bounds are widened
by more than the error of their arithmetic and ties count as crossing, so the codes are those of plain k-means.

Vectors lie in blocks as integers, with their bounds beside them. A round reads the last blocks and writes new ones with the
sums of each block; the sums of the column alone are then added up, and only codebooks reach the driver. Blocks of a round
that has been read are deleted. Equal labels are totalled apart where they are frequent: at most ``FREQUENT`` totals are
broadcast, the others are joined.

Cases: vectors that are null or hold null or non-finite components are left out. Shorter vectors are filled with zeros up
to the longest, and that up to a multiple of ``PARTS``; a table of empty vectors gives codes of zeros. Repeated rows each get
a row; of equal ids the vector smaller by components comes first as entry. Null ids are coded and never become entries. Without
``ENTRIES`` usable ids codebooks are smaller (without any, a codebook is one zero entry). Components beyond 2**60 count
as 2**60 and errors beyond 64 bits as the largest number. Null labels are one label. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcat.llm.common import deleted, saved

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors in a block; its integers, bounds and sums are one row.
BLOCK = 4096
FREQUENT = 1000
LIMIT = 1 << 60
LONG = (1 << 63) - 1
#: Integers below this make sums of squares that doubles hold exactly (for parts of up to 2**11 components).
FINE = 1 << 20
#: Relative widening of the bounds, far above the error of double arithmetic.
SLACK = 1e-9

STATE = "ids binary, labels binary, known binary, mat binary, entry binary, upper binary, lower binary, upper_round binary, lower_round binary, scanned long, sums binary"


def integers(vector: np.ndarray) -> np.ndarray:
    """floor(4096 * x) of finite components; the product by a power of two is exact."""
    wide = np.floor(np.clip(vector.astype(np.float64), -LIMIT / SCALE, LIMIT / SCALE) * SCALE)
    return wide.astype(np.int64)


def _width(dim: int) -> int:
    return -(-dim // PARTS) * PARTS


def usable(vector_col: str):
    x = F.col(vector_col)
    fine = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    return x.isNotNull() & fine


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x from all rows of y, exact; Python integers where 64 bits might not do."""
    if x.shape[1] == 0:
        return np.zeros((len(x), len(y)), np.int64)
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) < FINE and x.shape[1] <= 1 << 11:
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    a, b = x.astype(object), y.astype(object)
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


def _own_squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distance of each row of x from the same row of y."""
    if x.shape[1] == 0:
        return np.zeros(len(x), np.int64)
    big = max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) >= FINE or x.shape[1] > 1 << 11
    d = x.astype(object) - y.astype(object) if big else x - y
    return (d * d).sum(axis=1)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


@dataclass
class Block:
    """Vectors of a block and what is known of their parts: arrays of (vectors, parts)."""

    mat: np.ndarray
    entry: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    upper_round: np.ndarray
    lower_round: np.ndarray

    @classmethod
    def new(cls, mat: np.ndarray) -> Block:
        shape = (len(mat), PARTS)
        # nothing is known: bounds that always cross
        return cls(mat, np.zeros(shape, np.uint8), np.full(shape, np.inf, np.float32), np.zeros(shape, np.float32),
                   np.zeros(shape, np.uint8), np.zeros(shape, np.uint8))

    def part(self, p: int) -> np.ndarray:
        size = self.mat.shape[1] // PARTS
        return self.mat[:, p * size: (p + 1) * size]


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + SLACK)).astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter((x * (1 - SLACK)).astype(np.float32), np.float32(-np.inf)), np.float32(0))


def ways(books: np.ndarray, now: int) -> tuple[np.ndarray, np.ndarray]:
    """Of codebooks (round, entry, component): how far each entry has gone from each round to ``now``, and the
    farthest that any entry but this one has gone."""
    own = np.stack([_roots(_own_squares(books[t], books[now])) for t in range(now + 1)])
    others = np.zeros_like(own)
    if own.shape[1] > 1:
        last = np.sort(own, axis=1)[:, -2:]
        others = np.where(own == last[:, 1:], last[:, 1:], last[:, 1:])
        unique = (own == last[:, 1:]).sum(axis=1, keepdims=True) == 1
        others = np.where(unique & (own == last[:, 1:]), last[:, :1], others)
    return own, others


def assign(block: Block, history: np.ndarray, now: int) -> int:
    """Assign all parts to the codebooks of round ``now`` of ``history`` (round, part, entry, component), and keep the
    bounds. Returns how many parts were compared with whole codebooks."""
    scanned = 0
    for p in range(PARTS):
        books = history[:, p]
        x, entry = block.part(p), block.entry[:, p].astype(np.int64)
        own, others = ways(books[: now + 1], now)
        upper = block.upper[:, p] + own[block.upper_round[:, p], entry]
        lower = block.lower[:, p] - others[block.lower_round[:, p], entry]
        crossed = np.flatnonzero(upper * (1 + SLACK) >= lower * (1 - SLACK) - SLACK)
        if len(crossed):
            near = _roots(_own_squares(x[crossed], books[now][entry[crossed]]))
            block.upper[crossed, p], block.upper_round[crossed, p] = _up(near), now
            still = near * (1 + SLACK) >= lower[crossed] * (1 - SLACK) - SLACK
            crossed = crossed[still]
        if len(crossed):
            scanned += len(crossed)
            squares = _squares(x[crossed], books[now])
            best = np.argmin(squares, axis=1)  # the first of equal ones
            rows = np.arange(len(crossed))
            near = _roots(squares[rows, best])
            rest = _roots(squares)
            rest[rows, best] = np.inf
            block.entry[crossed, p] = best
            block.upper[crossed, p], block.upper_round[crossed, p] = _up(near), now
            block.lower[crossed, p], block.lower_round[crossed, p] = _down(rest.min(axis=1)), now
    return scanned


def _sums(block: Block, entries: int) -> bytes:
    """Count and sums of the parts of each entry, as (part, entry, 1 + component) integers of 128 bits in two halves."""
    size = block.mat.shape[1] // PARTS
    out = np.zeros((PARTS, entries, 1 + size, 2), np.int64)
    for p in range(PARTS):
        entry = block.entry[:, p]
        order = np.argsort(entry, kind="stable")
        present, first = np.unique(entry[order], return_index=True)
        x = block.part(p)[order]
        out[p, present, 0, 1] = np.diff(np.append(first, len(order)))
        for half, values in enumerate((x >> 32, x & 0xFFFFFFFF)):
            if size:
                out[p, present, 1:, half] = np.add.reduceat(values, first, axis=0)
    return out.astype("<i8").tobytes()


def _packed(width: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, label, vector) -> blocks without assignment."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                vectors = batch.column("vector")
                sizes = np.diff(vectors.offsets.to_numpy())
                mat = np.zeros((batch.num_rows, width), np.int64)
                row = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                mat[row, place] = integers(vectors.flatten().to_numpy(zero_copy_only=False))
                ids, labels = batch.column("id"), batch.column("label")
                known = np.stack([ids.is_valid().to_numpy(zero_copy_only=False), labels.is_valid().to_numpy(zero_copy_only=False)])
                columns = [ids.fill_null(0).to_numpy(), labels.fill_null(0).to_numpy()]
                yield _row(columns[0].tobytes(), columns[1].tobytes(), known.tobytes(), Block.new(mat), 0, b"")

    return run


def _row(ids: bytes, labels: bytes, known: bytes, block: Block, scanned: int, sums: bytes) -> pa.RecordBatch:
    narrow = "<i4" if np.abs(block.mat).max(initial=0) < 1 << 31 else "<i8"
    binary = [ids, labels, known, block.mat.astype(narrow).tobytes(), block.entry.tobytes(), block.upper.tobytes(), block.lower.tobytes(),
              block.upper_round.tobytes(), block.lower_round.tobytes()]
    names = ["ids", "labels", "known", "mat", "entry", "upper", "lower", "upper_round", "lower_round", "scanned", "sums"]
    return pa.RecordBatch.from_arrays(
        [*(pa.array([b], pa.binary()) for b in binary), pa.array([scanned], pa.int64()), pa.array([sums], pa.binary())], names)


def _blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[dict, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            r = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
            n = len(r["ids"]) // 8
            kind = "<i8" if width and len(r["mat"]) == n * width * 8 else "<i4"
            shape = (n, PARTS)

            def own(name: str, dtype: type) -> np.ndarray:
                return np.frombuffer(r[name], dtype).reshape(shape).copy()

            yield r, Block(
                np.frombuffer(r["mat"], kind).reshape(n, width).astype(np.int64), own("entry", np.uint8), own("upper", np.float32),
                own("lower", np.float32), own("upper_round", np.uint8), own("lower_round", np.uint8))


def _round(history: np.ndarray, width: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, block in _blocks(batches, width):
            scanned = assign(block, history, len(history) - 1)
            yield _row(r["ids"], r["labels"], r["known"], block, scanned, _sums(block, history.shape[2]))

    return run


def _totals(entries: int, size: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of a task's blocks: (cell, value) with the count as component 0."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (PARTS * entries * (1 + size))
        for batch in batches:
            for sums in batch.column("sums").to_pylist():
                halves = np.frombuffer(sums, "<i8").reshape(-1, 2)
                total = [t + (int(a) << 32) + int(b) for t, (a, b) in zip(total, halves)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["cell", "value"])

    return run


def _moved(book: np.ndarray, totals: list[int]) -> np.ndarray:
    """Entries at floor(sum / count); unused ones stay."""
    parts, entries, size = book.shape
    cells = np.array(totals, dtype=object).reshape(parts, entries, 1 + size)
    out = book.copy()
    for p in range(parts):
        for e in range(entries):
            if cells[p, e, 0]:
                out[p, e] = [int(s) // int(cells[p, e, 0]) for s in cells[p, e, 1:]]
    return out


@dataclass
class Codes:
    blocks: DataFrame
    history: np.ndarray  # (round, part, entry, component)
    width: int
    scanned: list[int]  # parts compared with whole codebooks, by round


def train(vectors: DataFrame, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Codes | None:
    """All rounds and the last assignment; None for an empty table."""
    rows = vectors.filter(usable(vector_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    size = rows.agg(F.max(F.size("vector")).alias("dim")).first()["dim"]
    if size is None:
        return None
    width = _width(size)
    first = rows.filter("id IS NOT NULL").select("id", "vector").orderBy("id", "vector").limit(ENTRIES).collect()
    start = np.zeros((max(1, len(first)), width), np.int64)
    for i, r in enumerate(first):
        start[i, : len(r["vector"])] = integers(np.array(r["vector"], np.float64))
    book = start.reshape(len(start), PARTS, width // PARTS).transpose(1, 0, 2)
    blocks = saved(rows.mapInArrow(_packed(width), STATE), "vectors")
    history, scanned = book[None], []
    for number in range(rounds + 1):
        before, blocks = blocks, saved(blocks.mapInArrow(_round(history, width), STATE), "assigned")
        deleted(before)
        scanned.append(blocks.agg(F.sum("scanned")).first()[0])
        if number < rounds:
            entries = history.shape[2]
            found = blocks.select("sums").mapInArrow(_totals(entries, width // PARTS), "cell int, value decimal(38,0)")
            totals = {r["cell"]: r["value"] for r in found.groupBy("cell").agg(F.sum("value").alias("value")).collect()}
            moved = _moved(history[-1], [int(totals[c]) for c in range(len(totals))])
            history = np.concatenate((history, moved[None]))
    return Codes(blocks, history, width, scanned)


def codebooks_sha256(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in book.ravel()).encode()).hexdigest()


def _coded(book: np.ndarray, width: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, block in _blocks(batches, width):
            n = len(block.mat)
            errors = [0] * n
            for p in range(PARTS):
                own = _own_squares(block.part(p), book[p][block.entry[:, p].astype(np.int64)])
                errors = [e + int(o) for e, o in zip(errors, own)]
            known = ~np.frombuffer(r["known"], bool).reshape(2, n)
            text = block.entry.tobytes().hex()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.frombuffer(r["ids"], "<i8"), pa.int64(), mask=known[0]), pa.array(np.frombuffer(r["labels"], "<i8"), pa.int64(), mask=known[1]),
                pa.array([text[2 * PARTS * i: 2 * PARTS * (i + 1)] for i in range(n)], pa.string()),
                pa.array([min(e, LONG) for e in errors], pa.int64()),
            ], ["id", "label", "code", "error"])

    return run


def _with_label_error(rows: DataFrame) -> DataFrame:
    """``label_error``: the error summed over equal labels."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    totals = saved(rows.groupBy("label").agg(total.alias("label_error"), F.count("*").alias("n")), "labels")
    # at most FREQUENT labels can have over a FREQUENT-th of all rows each
    rows_in_all = totals.agg(F.sum("n")).first()[0] or 0
    often = F.broadcast(totals.filter(F.col("n") * FREQUENT > rows_in_all).select(F.col("label").alias("of"), "label_error", F.lit(True).alias("often")))
    met = rows.join(often, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    seldom = totals.filter(F.col("n") * FREQUENT <= rows_in_all).select(F.col("label").alias("of"), F.col("label_error").alias("rare_error"))
    done = met.filter("often").drop("often")
    rest = met.filter("often IS NULL").drop("often", "label_error").join(seldom, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    return done.unionByName(rest.withColumnRenamed("rare_error", "label_error"))


def encode(vectors: DataFrame, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every usable vector."""
    trained = train(vectors, rounds, id_col, vector_col, label_col)
    schema = "id long, label long, code string, error long"
    if trained is None:
        empty = vectors.sparkSession.createDataFrame([], schema + ", label_error long")
        return empty.withColumn("codebooks_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    book = trained.history[-1]
    rows = saved(trained.blocks.mapInArrow(_coded(book, trained.width), schema), "codes")
    deleted(trained.blocks)
    return _with_label_error(rows).withColumn("codebooks_sha256", F.lit(codebooks_sha256(book)))
