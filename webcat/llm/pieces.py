"""SentencePiece encoding and decoding through tables of distinct marked words.

The library turns a space into a mark and puts one in front of the text. Where no piece of the vocabulary holds a mark
behind another character, no merge crosses from a word into the next mark, so a text's ids are those of
its marked words (marks and what follows up to the next mark) one after the other. Each task keeps a table of
the distinct marked words it has met; each is segmented and decoded once by the library, and its ids go back to
every position that holds it. The table is emptied at ``TABLE`` entries, which only costs time; words of over
``WORD`` characters are segmented where they stand. Nothing is shuffled.

Cases: a null or empty text has the end id only and decodes to an empty text. Repeated rows give repeated rows. The
input's other columns stay; ``ids`` and ``decoded`` must not be among them (a ValueError says so).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcat.llm.common import slices

MARK = "▁"
WORDS = re.compile(f"{MARK}+[^{MARK}]*")
TABLE = 400_000
WORD = 200


class Segmenter:
    """The table of one task."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search(f"[^{MARK}]{MARK}", n) for n in names):
            raise ValueError("pieces of this model cross marks; its texts cannot be cut at them")
        self.mark, self.end = self.model.piece_to_id(MARK), self.model.eos_id()
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.bounds, self.surface = array("i"), array("q", [0]), []

    def _learn(self, words: list[str]) -> None:
        # the library puts the first mark itself; a lone mark is a piece that it would not give for an empty text
        for word, ids in zip(words, self.model.encode([w[1:] for w in words], num_threads=1)):
            ids = ids or [self.mark]
            self.index[word] = len(self.surface)
            self.flat.extend(ids)
            self.bounds.append(len(self.flat))
            self.surface.append(" " + self.model.decode(ids))

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids with the end id, and the text decoded from them."""
        if not text:
            return np.array([self.end], np.int32), ""
        words = WORDS.findall(MARK + text.replace(" ", MARK))
        if len(self.index) > TABLE:
            self.clear()
        get = self.index.get
        new = [w for w in set(words) if w not in self.index]
        if new:
            self._learn(new)
        codes = np.fromiter(map(get, words), np.int64, len(words))
        bounds = np.frombuffer(self.bounds, np.int64)
        starts, sizes = bounds[codes], bounds[codes + 1] - bounds[codes]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        ids = np.append(np.frombuffer(self.flat, np.int32)[places], np.int32(self.end))
        del bounds  # a view would keep the table from growing
        surface = self.surface
        decoded = "".join([surface[c] for c in codes.tolist()])[1:]
        if any(len(w) > WORD for w in new):
            self.clear()
        return ids, decoded


def _encoder(model_file: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = None
        for batch in slices(batches, -1):
            segmenter = segmenter or Segmenter(model_file)
            done = [segmenter.encode(t or "") for t in batch.column(-1).to_pylist()]
            bounds = np.cumsum([0, *(len(ids) for ids, _ in done)])
            ids = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array(np.concatenate([i for i, _ in done]), pa.int32())
            )
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            names = [*batch.schema.names[:-1], "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([*kept, ids, pa.array([d for _, d in done], pa.string())], names)

    return run


def encode(docs: DataFrame, model_file: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of every row, with ``ids`` (an end id only) and ``decoded``; these
    replace columns of the input with such names."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("ids", "decoded")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text_col).cast("string").alias("text"))
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    coded = rows.mapInArrow(_encoder(model_file), T.StructType([rows.schema["row"], *added]))
    return coded.select(*[F.col("row")[c].alias(c) for c in keep], "ids", "decoded")
