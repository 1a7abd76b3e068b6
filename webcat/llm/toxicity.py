"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of the embeddings of its hashed features, the word itself and its first characters, so unseen
endings still count. Filters of several widths run over the words of the whole text, each gives its maximum, and a logistic
layer makes a score of the maxima. The score is shifted so that 0.5 is the best threshold over all languages. Every
language with labelled rows has a threshold of its own, from its rows and ``STRENGTH`` rows of either kind that are spread
as those of all languages: a language with few rows stays near 0.5.

Training takes a bounded sample: the ``POSITIVE`` and ``NEGATIVE`` labelled rows with the smallest hashes among texts of at
most ``SAMPLE_CHARS`` characters, a fifth of all ids left out. Thresholds come from all labelled rows not trained on, of
any length, as counts by language and logit. Scoring reads every whole text once, in tasks, without a shuffle.

Cases: null and empty texts score as texts without words do. Labels that are null or of unknown documents are left
out; an id with both labels counts as toxic. Without labels of both kinds every score is 0. Rows without a language use 0.5. Repeated rows score alike. Very
long texts are scored piece by piece, their maxima combined. An empty table gives an empty result. Where too few rows are
labelled, those trained on set the thresholds too.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcat.llm.common import checked_broadcast, saved, slices, text_or_empty

BUCKETS = 1 << 15
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 12
PREFIXES = (3, 4, 5)
POSITIVE, NEGATIVE, SAMPLE_CHARS = 1500, 2500, 5000
EPOCHS = 6
#: Rows of either kind that all languages together count for in a language's threshold.
STRENGTH = 10.0
#: Logits are counted by steps of 1 / ``STEPS`` between -``LIMIT`` and ``LIMIT``.
STEPS, LIMIT = 64, 30
PIECE = 200_000
TABLE = 200_000
WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def features(word: str) -> list[int]:
    """The buckets of a word; as many for every word."""
    raw = [f"{k}{word[:k]}" for k in PREFIXES] + [word]
    return [zlib.crc32(r.encode("utf-8", "surrogatepass")) % BUCKETS for r in raw]


@dataclass
class Model:
    embedding: np.ndarray  # BUCKETS x DIM
    filters: list[np.ndarray]  # per width: width x DIM x FILTERS
    bias: np.ndarray  # len(WIDTHS) * FILTERS
    out: np.ndarray

    def kernel(self) -> np.ndarray:
        return np.concatenate([w[j] for w in self.filters for j in range(len(w))], axis=1)

    def logits(self, maxima: np.ndarray) -> np.ndarray:
        return np.maximum(maxima + self.bias, 0) @ self.out[:-1] + self.out[-1]


def convolve(parts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Maxima by text. parts: words x (kernel columns), each text followed by rows of zeros; starts: of the texts."""
    maxima, at = [], 0
    for width in WIDTHS:
        total = parts[:, at: at + FILTERS].copy()
        for j in range(1, width):
            total[:-j] += parts[j:, at + j * FILTERS: at + (j + 1) * FILTERS]
        maxima.append(np.maximum.reduceat(total, starts, axis=0))
        at += width * FILTERS
    return np.concatenate(maxima, axis=1)


def train(texts: list[str], labels: list[int], seed: int = 0) -> Model:
    """Adam on the logistic loss; a maximum sends its gradient to the place it came from."""
    rng = np.random.default_rng(seed)
    index: dict[str, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in words_of(t)], np.int64) for t in texts]
    feats = np.array([features(w) for w in index] or [[0] * (len(PREFIXES) + 1)], np.int64)
    y = np.array(labels, np.float32)
    model = Model(
        rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32),
        [rng.normal(0, 0.4 / w, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS, np.float32), np.append(rng.normal(0, 0.2, len(WIDTHS) * FILTERS), 0).astype(np.float32),
    )
    params = [model.embedding, *model.filters, model.bias, model.out]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
    step, longest = 0, max(WIDTHS)
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), 32):
            batch = order[at: at + 32]
            pad = len(feats)
            ids = np.concatenate([np.concatenate((docs[i], np.full(longest, pad))) for i in batch])
            starts = np.cumsum([0, *(len(docs[i]) + longest for i in batch[:-1])])
            stops = np.append(starts[1:], len(ids))
            used, local = np.unique(ids, return_inverse=True)
            real = used < pad
            vectors = np.zeros((len(used), DIM), np.float32)
            vectors[real] = model.embedding[feats[used[real]]].sum(axis=1)
            words = vectors[local]
            grads = [np.zeros_like(p) for p in params[1:]]
            word_grad = np.zeros_like(words)
            pooled, places = [], []
            for w in model.filters:
                total = words @ w[0]
                for j in range(1, len(w)):
                    total[:-j] += words[j:] @ w[j]
                place = np.stack([a + total[a:b].argmax(axis=0) for a, b in zip(starts, stops)])
                pooled.append(total[place, np.arange(FILTERS)[None, :]])
                places.append(place)
            hidden = np.concatenate(pooled, axis=1) + model.bias
            active = np.maximum(hidden, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ model.out[:-1] + model.out[-1], -30, 30)))
            error = ((p - y[batch]) * weight[batch] / len(batch)).astype(np.float32)
            grads[-1][:-1], grads[-1][-1] = active.T @ error, error.sum()
            back = np.outer(error, model.out[:-1]) * (hidden > 0)
            grads[-2][:] = back.sum(axis=0)
            for k, w in enumerate(model.filters):
                g = back[:, k * FILTERS: (k + 1) * FILTERS]
                for j in range(len(w)):
                    where = np.minimum(places[k] + j, len(words) - 1)
                    grads[k][j] = np.einsum("bfd,bf->df", words[where], g)
                    np.add.at(word_grad, where.ravel(), (g[:, :, None] * w[j].T[None]).reshape(-1, DIM))
            touched = np.flatnonzero((word_grad != 0).any(axis=1) & (ids < pad))
            rows = feats[ids[touched]]
            flat, sums = np.unique(rows.ravel(), return_inverse=True)
            emb = np.zeros((len(flat), DIM), np.float32)
            np.add.at(emb, sums, np.repeat(word_grad[touched], rows.shape[1], axis=0))
            step += 1
            rate = 0.01 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            m, v = moment[0]
            m[flat] = 0.9 * m[flat] + 0.1 * emb
            v[flat] = 0.999 * v[flat] + 0.001 * emb * emb
            model.embedding[flat] -= rate * m[flat] / (np.sqrt(v[flat]) + 1e-6)
            for p_, g_, (m, v) in zip(params[1:], grads, moment[1:]):
                m *= 0.9
                m += 0.1 * g_
                v *= 0.999
                v += 0.001 * g_ * g_
                p_ -= rate * m / (np.sqrt(v) + 1e-6)
    return model


class Scorer:
    """Maxima and logits of texts, with a table of what the filters make of the words met so far."""

    def __init__(self, model: Model) -> None:
        self.model, self.kernel = model, model.kernel()
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((1024, self.kernel.shape[1]), np.float32)  # row 0: beyond the text

    def _rows(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        if new:
            base = len(self.index) + 1
            end = base + len(new)
            if end > len(self.table):
                grown = np.zeros((max(end, 2 * len(self.table)), self.table.shape[1]), np.float32)
                grown[:base] = self.table[:base]
                self.table = grown
            self.index.update(zip(new, range(base, end)))
            self.table[base:end] = self.model.embedding[np.array([features(w) for w in new])].sum(axis=1) @ self.kernel
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def logits(self, texts: list[str]) -> np.ndarray:
        if len(self.index) > TABLE:
            self.clear()
        pad = [0] * max(WIDTHS)
        parts, starts, owner, at = [], [], [], 0
        for i, text in enumerate(texts):
            words = words_of(text)
            for a in range(0, max(1, len(words)), PIECE):
                ids = np.append(self._rows(words[a: a + PIECE + max(WIDTHS) - 1]), pad)
                parts.append(ids)
                starts.append(at)
                owner.append(i)
                if a + PIECE < len(words):  # windows that begin in the overlap are the next piece's
                    starts.append(at + PIECE)
                    owner.append(-1)
                at += len(ids)
        if not parts:
            return np.zeros(0)
        ids = np.concatenate(parts)
        maxima = convolve(self.table[ids], np.array(starts))
        whole = np.full((len(texts), maxima.shape[1]), -np.inf, np.float32)
        owner = np.array(owner)
        np.maximum.at(whole, owner[owner >= 0], maxima[owner >= 0])
        return self.model.logits(whole)


def _best_cut(other: np.ndarray, toxic: np.ndarray) -> float:
    """The logit in the middle of the best gap of two histograms: most right answers, both kinds weighing equally."""
    gain = np.append(0.0, np.cumsum(other / max(other.sum(), 1e-9) - toxic / max(toxic.sum(), 1e-9)))
    used = np.flatnonzero(other + toxic)
    low, high = max(int(used[0]) - STEPS, 0), min(int(used[-1]) + 1 + STEPS, len(gain) - 1)
    first = last = low + int(np.argmax(gain[low: high + 1]))
    while last < high and gain[last + 1] == gain[first]:
        last += 1
    return (first + last) / 2 / STEPS - LIMIT


def calibrate(counts: list[tuple[str | None, int, int, int]]) -> tuple[float, dict[str, float]]:
    """Rows (language, label, step of the logit, number) -> the cut of all languages, and each one's threshold of the score."""
    own: dict[str | None, np.ndarray] = {}
    for lang, label, step, n in counts:
        own.setdefault(lang, np.zeros((2, 2 * LIMIT * STEPS)))[label, step] += n
    every = sum(own.values())
    shift = _best_cut(*every)
    spread = STRENGTH * every / np.maximum(every.sum(axis=1, keepdims=True), 1)
    cuts = {lang: _best_cut(*(found + spread)) for lang, found in own.items() if lang is not None}
    return shift, {lang: float(1 / (1 + np.exp(shift - cut))) for lang, cut in sorted(cuts.items())}


def _held() -> Column:
    return F.pmod(F.xxhash64("id", F.lit(5)), F.lit(5)) == 4


def sample(rows: DataFrame, known: DataFrame, hold: bool) -> tuple[list[str], list[int], Column]:
    """Texts and labels of the bounded training sample, in an order that only ids decide, and which rows are in it.

    ``rows`` are (id, text, lang, learn, short). The condition is for rows with ``h`` and ``_label``.
    """
    # ids and labels alone are joined and ordered; texts are read again for the few that are taken
    ids = rows.filter("learn AND short").select("id").join(known, F.col("id") == F.col("_lid"))
    learnt = ids.select("id", "_label").distinct().withColumn("h", F.xxhash64("id"))
    learnt = learnt.filter(~_held()) if hold else learnt
    chosen, within = [], F.lit(False)
    for label, most in ((1, POSITIVE), (0, NEGATIVE)):
        found = learnt.filter(F.col("_label") == label).orderBy("h", "id").limit(most).collect()
        last = found[-1]["h"] if len(found) == most else (1 << 63) - 1
        within = within | ((F.col("_label") == label) & (F.col("h") <= last))
        chosen += [(r["id"], int(r["_label"])) for r in found]
    label_of = dict(chosen)
    taken = []
    if chosen:
        kind = rows.schema["id"].dataType.simpleString()
        few = F.broadcast(rows.sparkSession.createDataFrame([(i,) for i, _ in chosen], f"_cid {kind}"))
        picked = rows.filter("learn AND short").join(few, F.col("id") == F.col("_cid"))
        # rows that share an id are one text of the sample, the smallest
        taken = picked.groupBy("id").agg(F.min("text").alias("text")).withColumn("h", F.xxhash64("id")).collect()
    taken.sort(key=lambda r: (r["h"], r["id"]))
    trained = F.col("short") & within & (~_held() if hold else F.lit(True))
    return [r["text"] for r in taken], [label_of[r["id"]] for r in taken], trained


def _scoring(model: Model) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in slices(batches, 1, 1 << 20):
            logits = scorer.logits(batch.column(1).to_pylist()).astype(np.float64)
            kept = [batch.column(k) for k in (2, 3, 4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(logits), *kept], ["id", "logit", "lang", "learn", "short"])

    return run


def classify(
    docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(id, score, threshold, flagged) for every row of ``docs``; labels (id_col, toxic) are learnt where ``may_learn``."""
    known = labels.filter("toxic IN (0, 1)").groupBy(F.col(id_col).alias("_lid")).agg(F.max("toxic").alias("_label"))
    rows = docs.select(
        F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.coalesce(may_learn, F.lit(False)).alias("learn"), (F.length(text_or_empty(text_col)) <= SAMPLE_CHARS).alias("short"),
    )
    for hold in (True, False):
        texts, given, trained = sample(rows, known, hold)
        if len(set(given)) == 2:
            break
    else:
        return rows.select("id", F.lit(0.0).alias("score"), F.lit(0.5).alias("threshold"), F.lit(False).alias("flagged"))
    kind = docs.schema[id_col].dataType.simpleString()
    scored = saved(rows.mapInArrow(_scoring(train(texts, given)), f"id {kind}, logit double, lang string, learn boolean, short boolean"), "scored")
    step = F.floor((F.least(F.greatest("logit", F.lit(-float(LIMIT))), F.lit(LIMIT - 0.5 / STEPS)) + LIMIT) * STEPS).cast("int")
    counted = saved(scored.filter("learn").join(known, F.col("id") == F.col("_lid")).withColumn("h", F.xxhash64("id")).groupBy(
        "lang", F.col("_label").cast("int").alias("label"), step.alias("step"), trained.alias("trained")).count(), "counts").collect()
    unseen = [r for r in counted if not r["trained"]]
    use = unseen if len({r["label"] for r in unseen}) == 2 else counted
    shift, thresholds = calibrate([(r["lang"], r["label"], r["step"], r["count"]) for r in use])
    score = 1 / (1 + F.exp(-F.least(F.greatest(F.col("logit") - shift, F.lit(-30.0)), F.lit(30.0))))
    own = docs.sparkSession.createDataFrame(list(thresholds.items()), "_lang string, _threshold double")
    found = scored.join(checked_broadcast(own, 64), F.col("lang") == F.col("_lang"), "left")
    found = found.select("id", score.alias("score"), F.coalesce("_threshold", F.lit(0.5)).alias("threshold"))
    return found.select("id", "score", "threshold", (F.col("score") >= F.col("threshold")).alias("flagged"))
