"""Exact top-k search by inner product: score histograms locate each query's kth value, then a filter and an order.

Components become floor(64 * x) as long integers. Every query meets every candidate, block against block, in each of
the passes. A pass counts scores by bins, one histogram per query over all candidates; a block leaves out bins below
its own kth score, which cannot hold the global one. Passes refine the bin that holds the kth score down to a single
value. The last pass keeps higher scores and, of those equal to it, as many of the smallest ids as are missing.

Cases: vectors that are null, empty or hold null or non-finite components take no part, nor do rows with a null id.
Rows that share an id are one vector, the smallest by components. Only vectors of equal length meet. Fewer candidates
than k: all. Scores beyond 64 bits wrap. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcat.llm.common import saved

SCALE = 64
BLOCK = 2048
#: Low bits left out of the bins of each pass; the last one counts single values.
SHIFTS = (8, 0)
NONE = -(1 << 62)


def _integers(column: str) -> Column:
    return F.transform(F.col(column), lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def _usable(column: str) -> Column:
    x = F.col(column)
    fine = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    return x.isNotNull() & (F.size(x) > 0) & fine


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packs = []
        for rows in batch.column("rows"):
            ids = rows.values.field("vec").to_numpy(zero_copy_only=False).astype("<i8")
            order = np.argsort(ids)
            values = np.array(rows.values.field("ints").to_pylist(), dtype="<i8")
            packs.append((ids[order].tobytes(), values[order].tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("dim"), batch.column("block"), pa.array([p[0] for p in packs], pa.binary()), pa.array([p[1] for p in packs], pa.binary())],
            ["dim", "block", "ids", "mat"],
        )


def _blocks(vectors: DataFrame, count: int) -> DataFrame:
    """(dim, block, ids, mat): about ``BLOCK`` vectors of one length as bytes per row, dealt by the hash of the id."""
    block = F.pmod(F.xxhash64("vec"), F.lit(max(1, -(-count // BLOCK)))).cast("int")
    rows = vectors.groupBy(F.size("ints").alias("dim"), block.alias("block")).agg(F.collect_list(F.struct("vec", "ints")).alias("rows"))
    return rows.mapInArrow(_packed, "dim int, block int, ids binary, mat binary")


def _scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    dim = row["dim"]
    qids, cids = np.frombuffer(row["qids"], "<i8"), np.frombuffer(row["ids"], "<i8")
    q, c = np.frombuffer(row["qmat"], "<i8").reshape(-1, dim), np.frombuffer(row["mat"], "<i8").reshape(-1, dim)
    bound = float(np.abs(q).max()) * float(np.abs(c).max()) * dim
    exact = bound < 2.0 ** 52  # then double arithmetic makes no error
    scores = (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64) if exact else q @ c.T
    scores[qids[:, None] == cids[None, :]] = NONE
    return qids, cids, scores


def _limits(row: dict, qids: np.ndarray) -> dict[str, np.ndarray]:
    found = {x["query"]: x for x in row["limits"]}
    return {k: np.array([found[int(q)][k] if int(q) in found else 0 for q in qids], np.int64) for k in ("lo", "above")}


def _count(k: int, shift: int, before: int | None) -> Callable:
    """Counts by bin of ``shift`` low bits, of all scores or of those in the bin that the pass before has found."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qids, _, scores = _scores(row)
                if before is not None:
                    limits = _limits(row, qids)
                    low = limits["lo"][:, None]
                    scores = np.where((scores >> before) == (low >> before), scores, NONE)
                bins = np.where(scores == NONE, NONE, scores >> shift)
                width = bins.shape[1]
                kth = np.partition(bins, width - k, axis=1)[:, width - k] if width > k else np.full(len(bins), NONE)
                i, j = np.nonzero((bins >= kth[:, None]) & (bins != NONE))
                pair = np.stack([i, bins[i, j]], axis=1)
                unique, n = np.unique(pair, axis=0, return_counts=True) if len(pair) else (pair, np.array([], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[unique[:, 0]]), pa.array(unique[:, 1]), pa.array(n.astype(np.int64))], ["query", "bin", "n"]
                )

    return run


def _select(k: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qids, cids, scores = _scores(row)
                limits = _limits(row, qids)
                lo = limits["lo"][:, None]
                i, j = np.nonzero((scores > lo) & (scores != NONE))
                ti, tj = np.nonzero((scores == lo) & (scores != NONE))
                # ids are ascending within a block: the first ties of a row are those of the smallest ids
                start = np.searchsorted(ti, ti, side="left")
                fits = np.arange(len(ti)) - start < k - limits["above"][ti]
                i, j = np.concatenate((i, ti[fits])), np.concatenate((j, tj[fits]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[i]), pa.array(cids[j]), pa.array(scores[i, j])], ["query", "vec", "score"]
                )

    return run


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query, rank, vec, score): for each id divisible by ``every`` its k highest scores, ties to the smaller id."""
    rows = vectors.filter(F.col(id_col).isNotNull() & _usable(vector_col)).select(
        F.col(id_col).cast("long").alias("vec"), _integers(vector_col).alias("ints")
    )
    rows = rows.groupBy("vec").agg(F.min("ints").alias("ints"))
    rows = saved(rows, "vectors")
    count = rows.count()
    queries = rows.filter(F.col("vec") % every == 0)
    blocks = saved(_blocks(rows, count), "blocks")
    asked = _blocks(queries, -(-count // every)).select(
        "dim", F.col("block").alias("qblock"), F.col("ids").alias("qids"), F.col("mat").alias("qmat")
    )
    asked = saved(asked, "queries")
    places = blocks.select("dim", "block")
    met = asked.join(places, "dim").join(blocks, ["dim", "block"])
    limits = None
    for number, shift in enumerate(SHIFTS):
        if limits is None:
            counted = met.mapInArrow(_count(k, shift, None), "query long, bin long, n long")
        else:
            counted = met.join(limits, ["dim", "qblock"]).mapInArrow(_count(k, shift, SHIFTS[number - 1]), "query long, bin long, n long")
        counted = counted.groupBy("query", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query").orderBy(F.desc("bin"))
        reached = counted.withColumn("upto", F.sum("n").over(down))
        low = F.shiftleft("bin", shift)
        if number == 0:
            reached = reached.withColumn("above", F.col("upto") - F.col("n"))
        else:
            earlier = known.select(F.col("query"), F.col("above").alias("base"))
            reached = reached.join(earlier, "query").withColumn("above", F.col("base") + F.col("upto") - F.col("n"))
        # the bin in which the count reaches k, or the lowest one if there are fewer
        here = F.col("above") < k
        known = saved(reached.filter(here).groupBy("query").agg(
            F.min(F.struct(low.alias("lo"), "above")).alias("x")).select("query", "x.lo", "x.above"), "kth")
        size = max(1, -(-(-(-count // every)) // BLOCK))
        dims = queries.select(F.col("vec").alias("query"), F.size("ints").alias("dim"),
                              F.pmod(F.xxhash64("vec"), F.lit(size)).cast("int").alias("qblock"))
        limits = saved(known.join(dims, "query").groupBy("dim", "qblock").agg(
            F.collect_list(F.struct("query", "lo", "above")).alias("limits")), "limits")
    chosen = met.join(limits, ["dim", "qblock"]).mapInArrow(_select(k), "query long, vec long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec")
    return chosen.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query", "rank", "vec", "score")
