"""Source divergence audit: how far the word use of each source is from the other sources of its language.

Each language keeps the terms of at least ``MIN_DOCS`` of its documents. Shares are integers: with N occurrences of
the V kept terms, a term's share is p = 1 + floor(10**9 * (count + 1) / (N + V)), and two shares differ by
f = floor((p - q)**2 / q). A source's distance from another is f summed over all kept terms.

Terms are counted in tasks, gathered by one shuffle on (language, term) and sorted there by their counts in all
sources, so that terms of equal counts lie together. Runs of this order are blocks; within a block each source's column
of counts is run-length encoded, zeros included. For a pair of sources the run boundaries are intersected and
f is multiplied by the length of each common run. Blocks of
``UNIT`` terms in all go to a task with ``CHUNK`` sources of either side, which sums a pair over them. Terms that stand out
come from the same blocks: of a source's terms of equal counts only the first ``top`` by name can be listed.

Cases: null text, language and source are empty strings. A source without kept terms has count 0 for all; without kept
terms in a language its distances are 0. Ties are ordered by name in UTF-8. Repeated rows are separate documents. A
term's list holds one entry per source of its language, of which the result has the square. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcat.llm.common import checked_broadcast, saved

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
#: Sources of either side that one task compares in a block.
CHUNK = 64
#: Terms of the blocks that one task compares together.
UNIT = 1 << 15
#: Counted terms that a task holds before it hands them on.
HELD = 400_000
#: Bytes to terms: A-Z become small, other ASCII separates, all else belongs to terms.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of letters and non-ASCII characters of an UTF-8 text, only A-Z lower-cased."""
    return text.translate(BYTES).split()


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> (lang, source, term, n, d), combined over as many documents as fit."""
    found, size = defaultdict(lambda: (Counter(), Counter())), 0

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in found.items():
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), pa.array(list(n), pa.binary()),
                    pa.array(list(n.values()), pa.int64()), pa.array([d[t] for t in n], pa.int64()),
                ], ["lang", "source", "term", "n", "d"])
        found.clear()

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            words = terms(text.as_py())
            n, d = found[lang, source]
            before = len(n)
            n.update(words)
            d.update(set(words))
            size += len(n) - before
            if size > HELD:
                yield from handed()
                size = 0
    yield from handed()


RUNS = "lang string, source string, block long, length int, starts binary, counts binary, occurrences long, listed array<struct<term:binary,n:long,total:long>>"


def _runs(top: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted (lang, term, total, counts) -> a row per block and source that occurs in it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            cuts = [0, *(i for i in range(1, len(langs)) if langs[i] != langs[i - 1]), len(langs)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    yield pa.RecordBatch.from_pylist(_encoded(batch.slice(a, b - a), langs[a], number, top), schema=_RUNS)
                    number += 1

    return run


_RUNS = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("block", pa.int64()), ("length", pa.int32()), ("starts", pa.binary()), ("counts", pa.binary()),
    ("occurrences", pa.int64()), ("listed", pa.list_(pa.struct([("term", pa.binary()), ("n", pa.int64()), ("total", pa.int64())]))),
])


def _encoded(block: pa.RecordBatch, lang: str, number: int, top: int) -> list[dict]:
    length, names = block.num_rows, block.column("term").to_pylist()
    total = block.column("total").to_numpy()
    rank = np.empty(length, np.int64)
    rank[sorted(range(length), key=names.__getitem__)] = np.arange(length)
    lists = block.column("counts")
    row = np.repeat(np.arange(length), np.diff(lists.offsets.to_numpy()))
    entries = lists.flatten()
    source = entries.field("source").dictionary_encode()
    n, code = entries.field("n").to_numpy(), source.indices.to_numpy()
    out = []
    order = np.argsort(code, kind="stable")
    bounds = np.searchsorted(code[order], np.arange(len(source.dictionary) + 1))
    for k, name in enumerate(source.dictionary.to_pylist()):
        mine = order[bounds[k]: bounds[k + 1]]
        at, own = row[mine], n[mine]
        column = np.zeros(length, np.int64)
        column[at] = own
        starts = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1))
        # of equal counts here and in the language, the first names
        by = np.lexsort((rank[at], total[at], own))
        pair = np.stack([own[by], total[at][by]])
        fresh = np.concatenate(([True], (pair[:, 1:] != pair[:, :-1]).any(axis=0)))
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))
        listed = by[np.arange(len(by)) - first < top]
        out.append({
            "lang": lang, "source": name, "block": number, "length": length, "starts": starts.astype("<i4").tobytes(),
            "counts": column[starts].astype("<i8").tobytes(), "occurrences": int(own.sum()),
            "listed": [{"term": names[at[i]], "n": int(own[i]), "total": int(total[at[i]])} for i in listed],
        })
    return out


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """p of each count, without any rounding."""
    if len(counts) and int(counts.max()) >= (1 << 62) // SCALE:
        return np.array([1 + SCALE * (int(c) + 1) // (n + v) for c in counts], np.int64)
    return 1 + SCALE * (counts + 1) // (n + v)


def distances(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> tuple[int, int]:
    """Of two columns (starts of runs, share of each run) over ``length`` terms: f summed from either side."""
    bounds = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], bounds, side="right") - 1]
    q = b[1][np.searchsorted(b[0], bounds, side="right") - 1]
    width, square = np.diff(np.append(bounds, length)), (p - q) ** 2
    return int((square // q * width).sum()), int((square // p * width).sum())


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, columns) -> (lang, source, item, value) for all pairs between the chunks a and b, summed over blocks."""
    for batch in batches:
        for unit in batch.to_pylist():
            blocks = defaultdict(list)
            for c in unit["columns"]:
                starts = np.frombuffer(c["starts"], "<i4") if c["starts"] else np.zeros(1, "<i4")
                counts = np.frombuffer(c["counts"], "<i8") if c["counts"] else np.zeros(1, "<i8")
                column = (starts, shares(counts, c["n"], max(c["v"], 1)))
                blocks[c["block"], c["length"]].append((c["source"], c["chunk"], column))
            sums: dict[tuple[str, str], int] = defaultdict(int)
            for (_, length), found in blocks.items():
                for i, (s, chunk, left) in enumerate(found):
                    for t, other, right in found[:i]:
                        if unit["a"] == unit["b"] or chunk != other:
                            there, back = distances(left, right, length) if length else (0, 0)
                            sums[s, t] += there
                            sums[t, s] += back
            yield pa.RecordBatch.from_arrays([
                pa.array([unit["lang"]] * len(sums), pa.string()), pa.array([k[0] for k in sums], pa.string()),
                pa.array([k[1] for k in sums], pa.string()), pa.array(sums.values(), pa.int64()),
            ], ["lang", "source", "item", "value"])


def _share(count: Column, n: Column, v: Column) -> Column:
    big = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", big, (n + v).cast("decimal(20,0)")) + 1


def columns_of(docs: DataFrame, lang_col: str, source_col: str, text_col: str, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """The run-length columns: a row per block of kept terms and source that occurs in it."""
    rows = docs.select(
        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    counted = rows.mapInArrow(_counted, "lang string, source string, term binary, n long, d long").repartition("lang", "term")
    each = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    listed = each.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("d").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts"))
    kept = listed.filter(F.col("docs") >= min_docs).select("lang", "term", "total", "counts")
    return kept.sortWithinPartitions("lang", "counts", "term").mapInArrow(_runs(top), RUNS)


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, lang_col: str = "lang", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances from all other sources (``pair``) and the terms that a source
    uses more than its language (``term``, the first ``top``)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(text_col).alias("text"))
    runs = saved(columns_of(rows, "lang", "source", "text", min_docs, top), "columns")
    upto = F.sum("length").over(Window.partitionBy("lang").orderBy("block"))
    blocks = runs.groupBy("lang", "block").agg(F.first("length").alias("length")).withColumn("unit", F.floor(upto / UNIT))
    blocks = saved(blocks.select("lang", "block", "length", F.col("unit").cast("int").alias("unit")), "blocks")
    sums = runs.groupBy("lang", "source").agg(F.sum("occurrences").alias("n"))
    order = Window.partitionBy("lang").orderBy("source")
    groups = rows.groupBy("lang", "source").count().join(sums, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.floor((F.row_number().over(order) - 1) / CHUNK).cast("int").alias("chunk"))
    groups = saved(groups, "groups")
    langs = groups.groupBy("lang").agg(F.sum("n").alias("all_n"), F.max("chunk").alias("last"))
    sizes = blocks.groupBy("lang").agg(F.sum("length").alias("v"))
    langs = saved(langs.join(sizes, "lang", "left").withColumn("v", F.coalesce("v", F.lit(0))), "languages")
    groups = saved(groups.join(langs, "lang"), "sources")

    # every language has an empty block as well, so that its sources meet even without kept terms
    grounds = blocks.union(langs.select("lang", F.lit(-1).cast("long"), F.lit(0), F.lit(0)))
    columns = groups.join(grounds, "lang").join(
        runs.select("lang", "block", "source", "starts", "counts"), ["lang", "block", "source"], "left")
    meets = columns.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("last"))))
    units = meets.groupBy("lang", "unit", F.least("chunk", "with").alias("a"), F.greatest("chunk", "with").alias("b")).agg(
        F.collect_list(F.struct("block", "length", "source", "chunk", "n", "v", "starts", "counts")).alias("columns"))
    pairs = units.mapInArrow(_pairs, "lang string, source string, item string, value long")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    shown = runs.select("lang", "source", F.explode("listed").alias("x")).select("lang", "source", "x.*")
    of = checked_broadcast(groups.select("lang", "source", "n", "all_n", "v").withColumnRenamed("n", "own_n"), 400)
    p, q = _share(F.col("n"), F.col("own_n"), F.col("v")), _share(F.col("total"), F.col("all_n"), F.col("v"))
    shown = shown.join(of, ["lang", "source"]).select("lang", "source", F.col("term").cast("string").alias("item"), p.alias("p"), q.alias("q"))
    value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q"))
    shown = shown.filter("p > q").select("lang", "source", "item", value.alias("value"))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms_part = shown.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    pair_part = pairs.withColumn("rank", F.row_number().over(best))
    return pair_part.withColumn("part", F.lit("pair")).unionByName(terms_part.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", "rank")
