"""Quality rules with n-gram perplexity: simple counts first, then a modified Kneser-Ney model of characters.

The units are the characters of a text whose words (``[^\\x20\\x09-\\x0D]+``) are joined by single spaces, with ``ORDER`` - 1
marks in front. Each language has its model. All n-grams of all documents are counted in tasks and added up; lower orders count
different characters to the left. Discounts come from the counts of counts. An n-gram of the highest order counts as
known if two documents hold it, so a text cannot vouch for itself; lower orders if they have two left neighbours or end a
known one. What is not known is left to the next lower order, weighted by what its context leaves over.

The model is two sorted arrays of 64-bit hashes with logarithms: of known n-grams and of contexts. It grows with the
corpus. It is sent to the tasks in shards of at most ``SHARD`` bytes by the two characters in front of the
predicted one; with several shards every text is scored against each, and the sums of equal texts are added.

The verdict: a document's cross entropy must lie within a band of its language, so many robust standard deviations (from the
quartiles of all documents that pass the simple rules) below or above the median. A short text varies more: the band
grows by ``SHORT`` / sqrt(characters).

Cases: a null text has no words and fails. A null language is one language of its own, as is any other value. Repeated
rows are scored alike and count as often as they occur. A character that nobody else uses gets what is left over. An
empty table gives an empty result. The names of added columns must not be among those kept (a ValueError says so).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcat.llm.common import checked_broadcast, saved, slices

ORDER = 5
MIN_WORDS, WINDOW, MOST_REPEATED = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
#: Bytes of text that a task takes at once, and n-grams that it counts before it hands them on.
SLICE = 4 << 20
HELD = 500_000
LOW = (1 << 36) - 1
#: Logarithms are kept as whole numbers of this part, so that sums do not depend on their order.
STEP = 1 << 20
SHARD = 128 << 20
#: The band in robust standard deviations below and above the median, and its growth for short texts.
BELOW, ABOVE, SHORT = 6.0, 6.0, 4.0
#: Width of the bins of cross entropy (natural logarithm a character) in which quartiles are found.
BIN = 0.001
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def lang_seed(lang: str) -> np.uint64:
    seed = np.zeros(1, np.uint64)
    for c in lang:
        seed = _mixed(seed * np.uint64(0x100000001B3) + np.uint64(ord(c) + 1))
    return seed[0]


def gram_hashes(seed: np.uint64 | np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """One hash per row of characters given by columns, the first character first; the length counts."""
    h = _mixed(np.zeros(len(columns[0]), np.uint64) + seed + np.uint64(len(columns)))
    for c in columns:
        h = _mixed(h * np.uint64(0x100000001B3) + c)
    return h


def characters(raw: bytes, order: int) -> np.ndarray:
    """Code points of the words joined by single spaces, behind ``order`` - 1 marks (0)."""
    text = b" ".join(raw.split()).decode("utf-8", "replace")
    return np.concatenate((np.zeros(order - 1, np.uint32), np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")))


# --- counting ------------------------------------------------------------------------------------

def joined(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all texts one after the other, each behind its marks, the places of the characters to predict, and
    how many of them each text has."""
    units = [characters(t, order) for t in texts]
    sizes = np.array([len(u) - order + 1 for u in units], np.int64)
    starts = np.cumsum(sizes + order - 1) - sizes
    return np.concatenate(units), np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes), sizes


def grouped(chars: np.ndarray, ends: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the n-grams at ``ends`` in an order that puts equal n-grams together, and where each group starts.

    The characters of an n-gram and its number are packed into one integer, so that a plain sort groups them; what does
    not fit is numbered anew on the way.
    """
    bits = max(1, len(ends).bit_length())
    kinds, ids = np.unique(chars, return_inverse=True) if len(chars) < 1000 else _numbered(chars)
    code, size, width = ids[ends - order + 1].astype(np.uint64), len(kinds), np.uint64(len(kinds))
    for j in range(1, order):
        if size * len(kinds) > 1 << (63 - bits):
            unique, code = np.unique(code, return_inverse=True)
            size, code = len(unique), code.astype(np.uint64)
        code = code * width + ids[ends - order + 1 + j].astype(np.uint64)
        size *= len(kinds)
    if size > 1 << (63 - bits):
        code = np.unique(code, return_inverse=True)[1].astype(np.uint64)
    packed = np.sort((code << np.uint64(bits)) | np.arange(len(ends), dtype=np.uint64))
    code = packed >> np.uint64(bits)
    starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
    return (packed & np.uint64((1 << bits) - 1)).astype(np.int64), starts


def _numbered(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    seen = np.zeros(0x110000, bool)
    seen[chars] = True
    place = np.cumsum(seen, dtype=np.int32) - 1
    return np.flatnonzero(seen), place[chars]


def _counted(order: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, text) -> (lang, gram, n, d): occurrences and documents of each n-gram."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, int]] = defaultdict(dict)  # documents in the upper, occurrences in the lower bits

        def handed() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                values = np.fromiter(found.values(), np.int64, len(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.string()), pa.array(values & LOW), pa.array(values >> 36)],
                    ["lang", "gram", "n", "d"])
            held.clear()

        for batch in slices(batches, 1, SLICE):
            langs, raw = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for lang in set(langs):
                chars, ends, sizes = joined([r for r, x in zip(raw, langs) if x == lang], order)
                if not len(ends):
                    continue
                rows, starts = grouped(chars, ends, order)
                n = np.diff(np.append(starts, len(rows)))
                doc = np.repeat(np.arange(len(sizes)), sizes)[rows]  # ascending within a group
                other = np.concatenate(([1], doc[1:] != doc[:-1]))
                other[starts] = 1
                d = np.add.reduceat(other, starts)
                first = ends[rows[starts]]
                text = np.stack([chars[first - order + 1 + j] for j in range(order)], axis=1).astype("<u4").tobytes().decode("utf-32-le", "replace")
                own = held[lang]
                get = own.get
                for i, value in enumerate((n + (d << 36)).tolist()):
                    gram = text[i * order: (i + 1) * order]
                    own[gram] = get(gram, 0) + value
            if sum(map(len, held.values())) > HELD:
                yield from handed()
        yield from handed()

    return run


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) from the numbers of n-grams that count once to four times."""
    n = [F.sum(F.when(F.col("c") == k, 1).otherwise(0)).cast("double").alias(f"n{k}") for k in range(1, 5)]
    got = counts.groupBy("lang").agg(*n)
    y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)

    def discount(k: int) -> Column:
        found = F.when((F.col(f"n{k}") > 0) & (F.col(f"n{k + 1}") > 0), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"))
        # few different counts say nothing; a discount must leave something and take something
        return F.greatest(F.lit(0.1), F.least(F.coalesce(found, F.lit(0.5 * k)), F.lit(k - 0.1))).alias(f"d{k}")

    return got.select("lang", discount(1), discount(2), discount(3))


def model(docs: DataFrame, lang_col: str, text_col: str, order: int = ORDER) -> DataFrame:
    """(lang, gram, size, logp, context): logarithms of known n-grams, and of what contexts leave over."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counted = rows.mapInArrow(_counted(order), "lang string, gram string, n long, d long")
    top = counted.groupBy("lang", "gram").agg(F.sum("n").alias("c"), F.sum("d").alias("d"))
    counts = {order: saved(top.select("lang", "gram", F.col("c").cast("double").alias("c"), (F.col("d") >= 2).alias("known")), "grams")}
    for n in range(order - 1, 0, -1):
        shorter = counts[n + 1].groupBy("lang", F.expr("substring(gram, 2)").alias("gram"))
        found = shorter.agg(F.count("*").cast("double").alias("c"), F.max("known").alias("ends"))
        counts[n] = saved(found.select("lang", "gram", "c", (F.col("ends") | (F.col("c") >= 2) | F.lit(n == 1)).alias("known")), "grams")
    lower = None
    out = []
    for n in range(1, order + 1):
        of = _discounts(counts[n])
        c = F.col("c")
        # one context per language at the lowest order
        rows = counts[n].withColumn("context", F.substring("gram", 1, n - 1)).join(F.broadcast(of), "lang")
        rows = rows.withColumn("rest", c - F.when(c >= 3, F.col("d3")).when(c >= 2, F.col("d2")).otherwise(F.col("d1")))
        totals = rows.groupBy("lang", "context").agg(
            F.sum("c").alias("total"), F.sum(F.when(F.col("known"), F.col("rest")).otherwise(0.0)).alias("given"), F.count("*").alias("kinds"))
        totals = totals.withColumn("over", 1 - F.col("given") / F.col("total"))
        rows = rows.filter("known").join(totals, ["lang", "context"])
        own = F.col("rest") / F.col("total")
        if n == 1:
            # a character that is not known counts as one more kind
            p = own + F.col("over") / (F.col("kinds") + 1)
            extra = totals.select("lang", F.lit("").alias("gram"), F.lit(0).alias("size"), F.log(F.col("over") / (F.col("kinds") + 1)).alias("logp"), F.lit(False).alias("context"))
            done = rows.select("lang", "gram", p.alias("p"))
            out.append(extra)
        else:
            suffix = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("less"))
            done = rows.withColumn("suffix", F.expr("substring(gram, 2)")).join(suffix, ["lang", "suffix"]).select(
                "lang", "gram", (own + F.col("over") * F.col("less")).alias("p"))
            left = totals.filter("given > 0").select("lang", F.col("context").alias("gram"), F.lit(n - 1).alias("size"), F.log("over").alias("logp"), F.lit(True).alias("context"))
            out.append(left)
        lower = saved(done, "probabilities")
        out.append(lower.select("lang", "gram", F.lit(n).alias("size"), F.log("p").alias("logp"), F.lit(False).alias("context")))
    whole = out[0]
    for part in out[1:]:
        whole = whole.union(part)
    return whole


# --- sorted arrays -------------------------------------------------------------------------------

def _shard_of(before: list[np.ndarray], seed: np.ndarray, shards: int) -> np.ndarray:
    return (gram_hashes(seed, before) % np.uint64(shards)).astype(np.int64)


def _hashed(shards: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, gram, size, logp, context) -> (shard, context, key, logp); what is shorter than two characters before the
    predicted one belongs to all shards (-1)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str, np.uint64] = {}
        for batch in batches:
            langs, grams = batch.column("lang").to_pylist(), batch.column("gram").to_pylist()
            for lang in set(langs):
                seeds.setdefault(lang, lang_seed(lang))
            if len(seeds) > 10_000:
                seeds = {lang: seeds[lang] for lang in set(langs)}
            seed = np.array([seeds[x] for x in langs], np.uint64)
            sizes, context = np.array([len(g) for g in grams]), batch.column("context").to_numpy(zero_copy_only=False)
            keys, shard = np.zeros(len(grams), np.uint64), np.full(len(grams), -1)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                chars = np.array([[ord(c) for c in grams[i]] for i in at], np.uint64).reshape(len(at), size)
                columns = [chars[:, j] for j in range(size)]
                keys[at] = gram_hashes(seed[at], columns) if size else _mixed(seed[at])
                for kind, last in ((False, size - 1), (True, size)):
                    if last >= 2:
                        some = np.flatnonzero(context[at] == kind)
                        shard[at[some]] = _shard_of([c[some] for c in columns[last - 2: last]], seed[at][some], shards)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int64()), batch.column("context"), pa.array(keys.view(np.int64)), batch.column("logp")],
                ["shard", "context", "key", "logp"])

    return run


class Arrays:
    """A shard of the model as sorted arrays of hashes, with the logarithms in the same order."""

    def __init__(self, table: pa.Table, shard: int, shards: int, order: int) -> None:
        self.shard, self.shards, self.order = shard, shards, order
        context = table.column("context").to_numpy()
        for name, chosen in (("grams", ~context), ("contexts", context)):
            keys = table.column("key").to_numpy()[chosen].view(np.uint64)
            place = np.argsort(keys)
            setattr(self, name, (keys[place], np.rint(table.column("logp").to_numpy()[chosen][place] * STEP).astype(np.int32)))

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, values = table
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int32)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, values[at]

    def score(self, seed: np.uint64, chars: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log probabilities (times ``STEP``) of the characters at ``ends``; 0 for those that other shards score."""
        out = np.zeros(len(ends), np.int64)
        at = np.arange(len(ends))
        if self.shards > 1:
            before = [chars[ends - 2], chars[ends - 1]]
            at = np.flatnonzero(_shard_of(before, np.full(len(ends), seed), self.shards) == self.shard)
        for n in range(self.order, 0, -1):
            place = ends[at]
            columns = [chars[place - n + 1 + j] for j in range(n)]
            found, value = self._find(self.grams, gram_hashes(seed, columns))
            out[at[found]] += value[found]
            at, columns = at[~found], [c[~found] for c in columns]
            if n > 1 and len(at):
                left, value = self._find(self.contexts, gram_hashes(seed, columns[:-1]))
                out[at[left]] += value[left]
            if not len(at):
                return out
        out[at] += self._find(self.grams, _mixed(np.array([seed])))[1][0]
        return out


# --- rules and scores ----------------------------------------------------------------------------

def _repeated(words: list[list[bytes]]) -> np.ndarray:
    """Of each text: words inside windows that the text holds twice or more. Windows are numbered exactly by doubling."""
    sizes = np.array([len(w) for w in words])
    total = int(sizes.sum())
    if total < WINDOW:
        return np.zeros(len(words), np.int64)
    table: dict[bytes, int] = {}
    for w in words:
        for x in w:
            table.setdefault(x, len(table))
    owner = np.repeat(np.arange(len(words)), sizes)
    one = np.fromiter((table[x] for w in words for x in w), np.int64, total)

    def numbered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]

    start = numbered(owner, one)  # words of different texts differ
    two = numbered(start[:-1], start[1:])
    four = numbered(two[:-2], two[2:])
    five = numbered(four[:-1], start[4:])
    inside = owner[:-4] == owner[4:]
    often = inside & (np.bincount(five)[five] > 1)
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, np.flatnonzero(often), 1)
    np.add.at(edge, np.flatnonzero(often) + WINDOW, -1)
    return np.bincount(owner[np.cumsum(edge[:-1]) > 0], minlength=len(words))


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The simple counts of UTF-8 texts."""
    words = [t.split() for t in texts]  # bytes are split exactly at \\x20 and \\x09-\\x0D
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    return {
        "n_words": np.array([len(w) for w in words], np.int64),
        "word_chars": np.array([sum(len(x.decode("utf-8", "replace")) for x in w) if not t.isascii() else sum(map(len, w)) for t, w in zip(texts, words)], np.int64),
        "n_symbols": np.array([sum(t.count(c) for c in SYMBOLS) for t in texts], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": _repeated(words),
    }


def _scored(arrays: Broadcast, order: int, kept: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(kept columns .., lang, text) -> kept columns, lang, simple counts, characters, log probability of all."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = arrays.value
        for batch in slices(batches, -1, SLICE):
            texts = batch.column(-1).cast(pa.binary()).to_pylist()
            langs = batch.column(-2).to_pylist()
            sizes_of, logs = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            for lang in set(langs):
                mine = [i for i, x in enumerate(langs) if x == lang]
                chars, ends, sizes = joined([texts[i] for i in mine], order)
                rows, starts = grouped(chars, ends, order)
                value = own.score(lang_seed(lang), chars.astype(np.uint64), ends[rows[starts]])
                owner = np.repeat(np.arange(len(mine)), sizes)[rows]
                # sums of whole numbers, exact in doubles
                logs[mine] = np.bincount(owner, np.repeat(value, np.diff(np.append(starts, len(rows)))), minlength=len(mine))
                sizes_of[mine] = sizes
            counts = base_counts(texts)
            arrays_out = [batch.column(k) for k in range(kept)] + [batch.column(-2)] + [pa.array(counts[b]) for b in BASE]
            yield pa.RecordBatch.from_arrays([*arrays_out, pa.array(sizes_of), pa.array(logs / STEP)], [*batch.schema.names[:kept], "_lang", *BASE, "_chars", "_logp"])

    return run


def _measured(docs: DataFrame, keep: list[str], lang_col: str, text_col: str, order: int) -> DataFrame:
    """The columns ``keep``, language, simple counts, characters and log probability of every row."""
    kept = docs.select(*keep)
    lang, text = F.coalesce(F.col(lang_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    added = [T.StructField("_lang", T.StringType()), *(T.StructField(b, T.LongType()) for b in BASE),
             T.StructField("_chars", T.LongType()), T.StructField("_logp", T.DoubleType())]
    known = saved(model(docs, lang_col, text_col, order), "model")
    shards = max(1, -(-known.count() * 13 // SHARD))
    hashed = saved(known.mapInArrow(_hashed(shards), "shard long, context boolean, key long, logp double"), "hashed")

    def against(shard: int, rows: DataFrame, names: list[str], fields: list[T.StructField]) -> DataFrame:
        arrays = Arrays(hashed.filter(F.col("shard").isin(-1, shard)).drop("shard").toArrow(), shard, shards, order)
        sent = docs.sparkSession.sparkContext.broadcast(arrays)
        return rows.mapInArrow(_scored(sent, order, len(names)), T.StructType([*fields, *added]))

    if shards == 1:
        return against(0, docs.select(*keep, lang.alias("_lang"), text.alias("_text")), keep, kept.schema.fields)
    digest = T.StructField("_digest", T.StringType())
    first = docs.select(*keep, F.md5(text).alias("_digest"), lang.alias("_lang"), text.alias("_text"))
    whole = saved(against(0, first, [*keep, "_digest"], [*kept.schema.fields, digest]), "scored")
    for shard in range(1, shards):
        rows = docs.select(F.md5(text).alias("_digest"), lang.alias("_lang"), text.alias("_text"))
        part = saved(against(shard, rows, ["_digest"], [digest]).groupBy("_lang", "_digest").agg(F.first("_logp").alias("_more")), "scored")
        whole = saved(whole.join(part, ["_lang", "_digest"]).withColumn("_logp", F.col("_logp") + F.col("_more")).drop("_more"), "scored")
    return whole.drop("_digest")


def failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def bands(rows: DataFrame) -> DataFrame:
    """(lang, middle, below, above): median and robust standard deviations of the cross entropy of rows (lang, entropy)."""
    bins = rows.groupBy("lang", F.floor(F.col("entropy") / BIN).alias("bin")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    ranked = bins.withColumn("upto", upto).withColumn("all", total)
    at = [F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bin"))).alias(name) for name, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))]
    quartiles = ranked.groupBy("lang").agg(*at)
    middle = (F.col("q2") + 0.5) * BIN
    return quartiles.select("lang", middle.alias("middle"), ((F.col("q2") - F.col("q1") + 1) * (BIN / 0.6745)).alias("below"),
                            ((F.col("q3") - F.col("q2") + 1) * (BIN / 0.6745)).alias("above"))


def judge(
    docs: DataFrame, keep: list[str] | None = None, lang_col: str = "lang", text_col: str = "text", order: int = ORDER,
) -> DataFrame:
    """The columns ``keep`` (all by default), the simple counts, ``base_failed``, ``entropy``, ``low`` and ``high`` (the
    band of this document) and ``kept``."""
    keep = docs.columns if keep is None else keep
    added = {"_lang", "_chars", "_logp", "_text", "_digest", "_more", "base_failed", "entropy", "low", "high", "kept", *BASE}
    if added & {c.lower() for c in keep}:
        raise ValueError(f"the input has columns named {sorted(added & {c.lower() for c in keep})}")
    rows = saved(_measured(docs, keep, lang_col, text_col, order), "scored")
    entropy = F.when(F.col("_chars") > 0, -F.col("_logp") / F.col("_chars"))
    rows = rows.withColumn("base_failed", failed()).withColumn("entropy", entropy)
    found = saved(bands(rows.filter("NOT base_failed").select(F.col("_lang").alias("lang"), "entropy")), "bands")
    found = checked_broadcast(found.withColumnRenamed("lang", "_lang"), 100)
    short = SHORT / F.sqrt(F.greatest(F.col("_chars"), F.lit(1)))
    met = rows.join(found, "_lang", "left").withColumn("low", F.col("middle") - BELOW * F.col("below") - short).withColumn(
        "high", F.col("middle") + ABOVE * F.col("above") + short)
    kept = ~F.col("base_failed") & F.coalesce(F.col("entropy").between(F.col("low"), F.col("high")), F.lit(False))
    return met.withColumn("kept", kept).select(*keep, *BASE, "base_failed", "entropy", "low", "high", "kept")
