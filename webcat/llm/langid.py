"""Language identification by fusion of evidence.

The posterior of a page's language is proportional to the product of: the likelihood of its visible text under naive Bayes
models of hashed words and word parts, the likelihoods of the language declared in the markup and of the one
its address names (each right with a stated probability), and a prior of its host. Host priors are counts of the languages
that the text itself shows, smoothed towards those of the domain, the top-level domain and all pages in turn,
and computed by grouped aggregation. The text's log likelihood counts ``TEXT_WEIGHT`` per word up to a bound, as
neighbouring words are not independent.

Every language that a text names is known. The text models come from a sample: about ``SAMPLE`` texts of any length per
language, all where it has fewer, chosen by hash and counted in tasks. The driver and each task hold ``BUCKETS`` numbers
per language.

Cases: null and empty pages rest on the other evidence, and without any on the prior. A null address has the host ''. Unknown
declared or addressed languages say nothing. Repeated rows get the same answer. Without training texts the language is
null and the confidence 0. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcat.llm.common import checked_broadcast, saved, slices, text_or_empty

SAMPLE, DRAWS = 400, 1 << 40
BUCKETS = 1 << 14
TEXT_WEIGHT, TEXT_BOUND = 0.5, 12.0
DECLARED_RIGHT, ADDRESS_RIGHT = 0.9, 0.8
#: Pages that a coarser level's prior counts for at the next finer one.
STRENGTH = 5.0
TABLE = 200_000
#: Words of a text that are added up at once.
RUN = 1 << 16
WORDS = re.compile(r"[^\W\d_]+")
MARKUP = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&\w+;")
#: Country suffixes whose main language differs in name.
COUNTRIES = {"at": "de", "uk": "en", "us": "en", "au": "en", "ie": "en", "mx": "es", "ar": "es", "jp": "ja", "cn": "zh", "br": "pt"}


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages, log likelihoods


class Grams(dict):
    """Piece of a word -> its bucket; remembers the pieces met so far."""

    def __missing__(self, gram: str) -> int:
        if len(self) > TABLE:
            self.clear()
        self[gram] = bucket = zlib.crc32(gram.encode("utf-8", "surrogatepass")) % BUCKETS
        return bucket


def parts(word: str, grams: Grams) -> list[int]:
    """Buckets of the whole padded word, which is not remembered, and of its pieces of three characters."""
    padded = f"<{word}>"
    whole = zlib.crc32(padded.encode("utf-8", "surrogatepass")) % BUCKETS
    return [whole] + [grams[padded[i: i + 3]] for i in range(len(padded) - 2)]


def _weighing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place of the language, text) -> (place, bucket, weight), summed for each batch."""
    grams = Grams()
    for batch in slices(batches):
        totals: dict[int, np.ndarray] = {}
        for place, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = totals.setdefault(place, np.zeros(BUCKETS))
            for word, times in Counter(WORDS.findall(text.lower())).items():
                np.add.at(own, parts(word, grams), times / len(word))
        for place, own in totals.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), place), pa.int32()), pa.array(used, pa.int32()), pa.array(own[used])], ["place", "bucket", "weight"])


def fit(texts: DataFrame, id_col: str, text_col: str, lang_col: str) -> Model | None:
    """Naive Bayes of the words and their parts in a sample per language; all languages of texts that are not empty."""
    rows = texts.select(F.col(lang_col).cast("string").alias("lang"), text_or_empty(text_col).alias("text"),
                        F.col(id_col).alias("id")).filter("lang IS NOT NULL AND text <> ''")
    rows = rows.withColumn("draw", F.pmod(F.xxhash64("id", "text"), F.lit(DRAWS)))
    found = sorted((r["lang"], r["n"], r["least"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")).collect())
    if not found:
        return None
    chosen = texts.sparkSession.createDataFrame(
        [(lang, k, max(least, SAMPLE * DRAWS // n)) for k, (lang, n, least) in enumerate(found)], "name string, place int, most long")
    taken = rows.join(checked_broadcast(chosen, 64), F.col("lang") == F.col("name")).filter("draw <= most").select("place", "text")
    weights = taken.mapInArrow(_weighing, "place int, bucket int, weight double").groupBy("place", "bucket").agg(F.sum("weight").alias("weight")).toArrow()
    counts = np.full((BUCKETS, len(found)), 0.5)
    counts[weights.column("bucket").to_numpy(), weights.column("place").to_numpy()] += weights.column("weight").to_numpy()
    return Model([lang for lang, _, _ in found], np.log(counts / counts.sum(axis=0)))


class Reader:
    """Log likelihoods of texts; keeps the words met so far, and starts anew when they are more than ``TABLE``.

    A word's row is the mean of its parts' weights, taken from their mean over the languages. The rows of a text's
    new words are worked out together.
    """

    def __init__(self, model: Model) -> None:
        self.weights = model.weights - model.weights.mean(axis=1, keepdims=True)
        self.grams, self.places, self.rows = Grams(), {}, np.empty((0, len(model.languages)))

    def _learn(self, words: list[str]) -> None:
        found = [parts(w, self.grams) for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = self.weights[np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))]
        means = np.add.reduceat(flat, np.cumsum(sizes) - sizes) / sizes[:, None]
        start = len(self.places)
        while len(self.rows) < start + len(words):
            self.rows = np.concatenate((self.rows, np.empty((max(1024, len(self.rows)), self.rows.shape[1]))))
        self.rows[start: start + len(words)] = means
        self.places.update(zip(words, range(start, start + len(words))))

    def log_likelihood(self, text: str) -> np.ndarray:
        if len(self.places) > TABLE:
            self.places.clear()
        total = np.zeros(self.weights.shape[1])
        words = WORDS.findall(text.lower())
        for start in range(0, len(words), RUN):
            run = words[start: start + RUN]
            if new := list(set(run).difference(self.places)):
                self._learn(new)
            total += self.rows[np.fromiter(map(self.places.__getitem__, run), np.int64, len(run))].sum(axis=0)
        total = total * TEXT_WEIGHT
        spread = total.max() - total.min()
        return total * min(1.0, TEXT_BOUND / spread) if spread else total


def _reading(model: Model, markup: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in slices(batches, -1):
            found = []
            for text in batch.column(-1).to_pylist():
                found.append(reader.log_likelihood(MARKUP.sub(" ", text) if markup else text).tolist())
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.list_(pa.float64()))], [*batch.schema.names[:-1], "ll"])

    return run


def _argmax(values: Column) -> Column:
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def _known(code: Column, languages: list[str]) -> Column:
    """Position of a language among the known ones, or null."""
    short = F.lower(F.regexp_extract(code, r"^([A-Za-z]{2,3})", 1))
    named = F.coalesce(*[F.when(short == k, F.lit(v)) for k, v in COUNTRIES.items()], short)
    places: dict[str, int] = {}
    for i, lang in enumerate(languages):
        places.setdefault(lang.lower(), i)
    return F.element_at(F.from_json(F.lit(json.dumps(places)), "map<string,int>"), named)


def _stated(place: Column, right: float, n: int) -> Column:
    """Log likelihoods, by language, of evidence that names one of ``n`` languages and is right so often."""
    log_right, log_wrong = float(np.log(right)), float(np.log((1 - right) / max(n - 1, 1)))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(place.isNull(), 0.0).when(place == i, log_right).otherwise(log_wrong))


def _softmax(logs: Column) -> Column:
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def host_priors(rows: DataFrame, n: int) -> DataFrame:
    """(host, prior): smoothed shares of the languages that the texts (``seen``, ``host``, ``domain``, ``tld``) show."""
    levels = ["host", "domain", "tld"]
    cells = saved(rows.groupBy(*levels, "seen").agg(F.count("*").alias("c")), "hosts")

    def counts(*level: str) -> DataFrame:
        """The level's columns and ``own``, its counts of all languages."""
        summed = cells.groupBy(*level, "seen").agg(F.sum("c").cast("double").alias("c"))
        listed = summed.groupBy(*level).agg(F.map_from_entries(F.collect_list(F.when(F.col("seen").isNotNull(), F.struct("seen", "c")))).alias("m"))
        places = F.sequence(F.lit(0), F.lit(n - 1))
        return listed.select(*level, F.transform(places, lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("own"))

    def smoothed(own: Column, above: Column) -> Column:
        size = F.aggregate(own, F.lit(0.0), lambda a, b: a + b)
        return F.transform(F.arrays_zip(own.alias("c"), above.alias("p")), lambda z: (z["c"] + STRENGTH * z["p"]) / (size + STRENGTH))

    everywhere = {r["seen"]: float(r["c"]) for r in cells.filter("seen IS NOT NULL").groupBy("seen").agg(F.sum("c").alias("c")).collect()}
    total = sum(everywhere.values())
    base = F.array(*[F.lit((everywhere.get(i, 0.0) + 1.0) / (total + n)) for i in range(n)])
    own = F.col("own")
    tlds = counts("tld").select("tld", smoothed(own, base).alias("tp"))
    domains = counts("domain", "tld").join(tlds, "tld").select("domain", smoothed(own, F.col("tp")).alias("dp"))
    return counts(*levels).join(domains, "domain").select("host", smoothed(own, F.col("dp")).alias("prior"))


def identify(
    rows: DataFrame, model: Model | None, id_col: str, text_col: str, host: Column, address: Column, declared: Column, markup: bool
) -> DataFrame:
    """(id, language, confidence, text_language, declared, addressed) of every row.

    ``host`` is the host's name, ``address`` the language code that the address names and ``declared`` the one that
    the markup declares; nulls say nothing.
    """
    base = rows.select(F.col(id_col).alias("id"), F.coalesce(F.lower(host), F.lit("")).alias("host"), address.alias("a"),
                       declared.alias("d"), text_or_empty(text_col).alias("text"))
    if model is None:
        return base.select("id", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"),
                           *[F.lit(None).cast("string").alias(c) for c in ("text_language", "declared", "addressed")])
    n = len(model.languages)
    narrow = base.select("id", "host", _known(F.col("a"), model.languages).alias("a"), _known(F.col("d"), model.languages).alias("d"), "text")
    kind = rows.schema[id_col].dataType.simpleString()
    read = saved(narrow.mapInArrow(_reading(model, markup), f"id {kind}, host string, a int, d int, ll array<double>"), "read")
    read = read.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$|^([^.]*)$", 0)).withColumn("tld", F.regexp_extract("host", r"[^.]*$", 0))
    informative = F.array_max("ll") > F.array_min("ll")
    priors = saved(host_priors(read.withColumn("seen", F.when(informative, _argmax(F.col("ll")))), n), "priors")
    joined = read.join(checked_broadcast(priors, 120 + 16 * n), "host")
    zipped = F.arrays_zip(
        F.col("ll").alias("t"), F.transform("prior", lambda p: F.log(p)).alias("p"),
        _stated(F.col("d"), DECLARED_RIGHT, n).alias("d"), _stated(F.col("a"), ADDRESS_RIGHT, n).alias("a"),
    )
    fused = joined.withColumn("logs", F.transform(zipped, lambda z: z["t"] + z["p"] + z["d"] + z["a"])).withColumn("post", _softmax(F.col("logs")))
    names = F.array(*[F.lit(x) for x in model.languages])
    return fused.select(
        "id", F.get(names, _argmax(F.col("post"))).alias("language"), F.array_max("post").alias("confidence"),
        F.when(informative, F.get(names, _argmax(F.col("ll")))).alias("text_language"),
        F.get(names, F.col("d")).alias("declared"), F.get(names, F.col("a")).alias("addressed"),
    )


def page_evidence(url_col: str = "url", html_col: str = "html") -> dict[str, Column]:
    """Host, addressed and declared language of raw pages: the top-level domain or a path part such as /fr/, and ``<html lang>``."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)
    path = F.regexp_extract(url, r"^[a-zA-Z+.-]+://[^/?#]*/([a-z]{2})(?:[/?#-]|$)", 1)
    suffix = F.regexp_extract(F.lower(host), r"\.([a-z]{2})$", 1)
    declared = F.regexp_extract(F.col(html_col).cast("string"), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1)
    return {"host": host, "address": F.when(path != "", path).when(suffix != "", suffix), "declared": F.when(declared != "", declared)}
