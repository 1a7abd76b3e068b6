"""Quality classification by co-training of two views.

The content view is a logistic model of hashed words and word shapes (their mean weight over the whole text) and of repetition. The metadata
view is a logistic model of what a page's record tells: language, source, size, line layout, packed size and
shares of kinds of characters. Each round both are trained, label the rows of a pool without labels, and hand the ones they are sure of
to the other view. Each view is then calibrated on held-back labelled rows, and so is their combination, which scores
all documents. The threshold keeps all but ``LOSS`` of the held-back good rows, and never rejects above 0.5.

Training takes bounded samples: the ``LABELLED`` labelled and ``POOL`` other rows with the smallest id hashes, as features.

Cases: null and empty texts have no words and score as such. Labels that are null or of unknown documents are left out;
without labels of both kinds every score is 1 and nothing is rejected. Repeated rows score alike. Null languages,
sources and ids are values of their own. An id with both labels counts as good. Ids may be of any type. An empty table gives an
empty result. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from webcat.llm.common import slices, text_or_empty

HASHED = 512  # dimensions of words, and as many of shapes
EXTRA = 3
LABELLED, POOL = 3000, 2000
ROUNDS = 3
SURE = 0.95
SHARE = 0.2  # of the pool that a view may label in a round
LOSS = 0.002
TABLE = 300_000
RUNS = ((re.compile(r"[^\W\d_]+"), None), (re.compile(r"\d+"), "0"))


def _letters(match: re.Match) -> str:
    word = match[0]
    if word.islower():
        return "a"
    return "A" if word.isupper() else "Aa"


def word_buckets(word: str) -> tuple[int, int]:
    """Of the lower-cased word, and of its shape: runs of letters and digits become single signs."""
    shape = RUNS[1][0].sub("0", RUNS[0][0].sub(_letters, word))
    return (zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % HASHED,
            HASHED + zlib.crc32(b"s" + shape.encode("utf-8", "surrogatepass")) % HASHED)


class Content:
    """Bucket numbers of words, with a table of those met so far."""

    def __init__(self) -> None:
        self.table: dict[str, tuple[int, int]] = {}

    def buckets(self, text: str) -> np.ndarray:
        words, table = text.split(), self.table
        if len(table) > TABLE:
            table.clear()
        for w in set(words):
            if w not in table:
                table[w] = word_buckets(w)
        return np.array([table[w] for w in words], np.int64).reshape(-1, 2)

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Bucket numbers, and three numbers more: the shares of words like the one before, of different words and of none."""
        b = self.buckets(text)
        n = len(b)
        if not n:
            return b, np.array([0, 0, 1], np.float32)
        same = (b[1:, 0] == b[:-1, 0]).mean() if n > 1 else 0.0
        return b, np.array([same, len(np.unique(b[:, 0])) / min(n, HASHED), 0], np.float32)


KINDS = np.zeros(256, np.int64)
KINDS[[*range(65, 91)]], KINDS[[*range(97, 123)]], KINDS[[*range(48, 58)]] = 1, 2, 3
KINDS[[9, 11, 12, 13, 32]], KINDS[10], KINDS[128:] = 4, 5, 6
META = 48


def metadata(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """``META`` numbers; shares are of bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(KINDS[np.frombuffer(raw, np.uint8)], minlength=7).astype(float)
    n, lines = max(len(raw), 1), text.split("\n")
    sizes = np.array([len(x) for x in lines], float)
    words = counts[4] + counts[5] + 1
    out = np.zeros(META)
    out[:7] = counts / n
    out[7:15] = (np.log1p(len(raw)), np.log1p(len(lines)), np.log1p(sizes.mean()), np.log1p(sizes.std()),
                 len(set(lines)) / len(lines), n / words / 10, min(counts[0] / words, 5), min(counts[1] / words, 10))
    out[15] = len(zlib.compress(raw, 1)) / n
    out[16 + zlib.crc32(f"l{lang}".encode("utf-8", "surrogatepass")) % 8] = 1
    out[24 + zlib.crc32(f"s{source}".encode("utf-8", "surrogatepass")) % 24] = 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 200) -> np.ndarray:
    """Weights and intercept; both kinds weigh equally. Full-batch Adam."""
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)) / len(y)
    x, y, weight = (a.astype(np.float32) for a in (x, y, weight))
    w, m, v = (np.zeros(x.shape[1] + 1, np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))) - y) * weight
        g = np.append(x.T @ error + penalty * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    content: np.ndarray
    meta: np.ndarray
    center: np.ndarray
    spread: np.ndarray
    calibration: list[np.ndarray]  # of the views
    joint: np.ndarray
    threshold: float = 0.5

    def views(self, content_logits: np.ndarray, meta: np.ndarray) -> np.ndarray:
        own = (content_logits, ((meta - self.center) / self.spread) @ self.meta[:-1] + self.meta[-1])
        return np.stack([np.clip(c[0] * x + c[1], -12, 12) for c, x in zip(self.calibration, own)], axis=1)

    def score(self, content_logits: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return _sigmoid(self.views(content_logits, meta) @ self.joint[:-1] + self.joint[-1])


def _sure(probability: np.ndarray) -> np.ndarray:
    """Places of the pool that a view is sure of, a limited share of either kind, the surest first."""
    most = max(1, int(SHARE * len(probability)))
    good, bad = np.argsort(-probability, kind="stable")[:most], np.argsort(probability, kind="stable")[:most]
    return np.concatenate((good[probability[good] > SURE], bad[probability[bad] < 1 - SURE]))


def cotrain(content: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_content: np.ndarray, pool_meta: np.ndarray) -> Model | None:
    """Rows with labels and a pool without; every fourth labelled row is held back for calibration."""
    held = np.arange(len(y)) % 4 == 3
    kept = ~held
    if len(set(y[kept])) < 2:
        return None
    if len(set(y[held])) < 2:
        held = kept
    center, spread = meta[kept].mean(axis=0), meta[kept].std(axis=0) + 1e-3
    scaled, pool_scaled = (meta - center) / spread, (pool_meta - center) / spread
    views, pools = (content, scaled), (pool_content, pool_scaled)
    penalties = (1e-6, 1e-3)
    given = [np.full(len(pool_content), -1.0), np.full(len(pool_content), -1.0)]  # pseudo-labels for each view
    for number in range(ROUNDS + 1):
        models = []
        for k in range(2):
            has = given[k] >= 0
            x = np.concatenate((views[k][kept], pools[k][has]))
            models.append(logistic(x, np.concatenate((y[kept], given[k][has])), penalties[k]))
        if number == ROUNDS or not len(pool_content):
            break
        for k in range(2):
            p = _sigmoid(pools[k] @ models[k][:-1] + models[k][-1])
            sure = _sure(p)
            given[1 - k][sure] = p[sure] > 0.5
    logits = [views[k][held] @ models[k][:-1] + models[k][-1] for k in range(2)]
    calibration = []
    for x in logits:
        fitted = logistic(x[:, None] / (x.std() + 1e-9), y[held], 1e-3)
        calibration.append(np.array([fitted[0] / (x.std() + 1e-9), fitted[1]]))
    model = Model(models[0], models[1], center, spread, calibration, np.zeros(3))
    both = model.views(logits[0], meta[held])
    model.joint = logistic(both, y[held], 1e-3)
    good = np.sort(model.score(logits[0], meta[held])[y[held] > 0])
    model.threshold = float(min(0.5, good[int(LOSS * len(good))]))
    return model


def _featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id hash, label, text, lang, source) -> features of the sample as bytes."""
    content = Content()
    for batch in slices(batches, 2):
        x, m = [], []
        for text, lang, source in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
            b, extra = content.features(text)
            counts = np.bincount(b.ravel(), minlength=2 * HASHED) / max(len(b), 1)
            x.append(np.concatenate((counts, extra)).astype(np.float32).tobytes())
            m.append(metadata(text, lang, source).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(x, pa.binary()), pa.array(m, pa.binary())], ["h", "label", "x", "m"]
        )


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> Model | None:
    """Train on the bounded samples; only features come to the driver."""
    known = labels.filter("quality IN (0, 1)").groupBy(F.col(id_col).alias("lid")).agg(F.max("quality").alias("label"))
    rows = docs.select(
        F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"), F.xxhash64(F.col(id_col)).alias("h"),
    )
    ids = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("h"))
    ids = ids.join(known, F.col("id") == F.col("lid"), "left")
    taken = []
    for wanted, most in ((F.col("label").isNotNull(), LABELLED), (F.col("label").isNull() & F.col("id").isNotNull(), POOL)):
        chosen = ids.filter(wanted).select("id", F.coalesce("label", F.lit(-1)).cast("int").alias("label"), "h").orderBy("h", "id").limit(most)
        taken += [(r["id"], r["label"]) for r in chosen.collect()]
    if not taken:
        return None
    chosen = docs.sparkSession.createDataFrame(sorted(set(taken)), StructType([
        StructField("cid", ids.schema["id"].dataType), StructField("label", IntegerType())]))
    picked = rows.join(F.broadcast(chosen), F.col("id") == F.col("cid")).select("h", "label", "text", "lang", "source")
    found = picked.mapInArrow(_featured, "h long, label int, x binary, m binary").dropDuplicates(["h"]).toArrow()
    order = np.argsort(found.column("h").to_numpy(), kind="stable")
    label = found.column("label").to_numpy()[order]
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), np.float32).reshape(-1, 2 * HASHED + EXTRA)[order]
    m = np.frombuffer(b"".join(found.column("m").to_pylist()), np.float32).reshape(-1, META)[order].astype(float)
    has = label >= 0
    return cotrain(x[has], m[has], label[has].astype(float), x[~has], m[~has]) if has.any() else None


def _scoring(model: Model, text_at: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = Content()
        weights, base = model.content[:-1], model.content[-1]
        for batch in slices(batches, text_at):
            logits, metas = [], []
            for text, lang, source in zip(*(batch.column(text_at + k).to_pylist() for k in range(3))):
                b, extra = content.features(text)
                logits.append(weights[b].sum() / max(len(b), 1) + extra @ weights[2 * HASHED:] + base)
                metas.append(metadata(text, lang, source))
            scores = model.score(np.array(logits), np.array(metas))
            kept = [batch.column(k) for k in range(text_at)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], [*batch.schema.names[:text_at], "score"])

    return run


def _scored(docs: DataFrame, labels: DataFrame, keep: list[str], id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(row, score, accepted): the kept columns as a struct."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    model = fit(docs, labels, id_col, text_col, lang_col, source_col)
    if model is None:
        return docs.select(row, F.lit(1.0).alias("score"), F.lit(True).alias("accepted"))
    rows = docs.select(row, text_or_empty(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"))
    scored = rows.mapInArrow(_scoring(model, 1), StructType([rows.schema["row"], StructField("score", DoubleType())]))
    return scored.withColumn("accepted", F.col("score") >= model.threshold)


def score(
    docs: DataFrame, labels: DataFrame, score_col: str = "quality_score", accepted_col: str = "accepted", keep: list[str] | None = None,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """The columns ``keep`` (all by default), the score that the row is of good quality and whether it is accepted.

    Columns of the input that are named as those two are replaced by them.
    """
    keep = docs.columns if keep is None else keep
    scored = _scored(docs, labels, keep, id_col, text_col, lang_col, source_col)
    kept = [F.col("row")[c].alias(c) for c in keep if c.lower() not in (score_col.lower(), accepted_col.lower())]
    return scored.select(*kept, F.col("score").alias(score_col), F.col("accepted").alias(accepted_col))


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """The input's rows and columns without the rows that the classifier rejects."""
    return _scored(docs, labels, docs.columns, id_col, text_col, lang_col, source_col).filter("accepted").select("row.*")
