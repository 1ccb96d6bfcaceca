"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

Every text is compressed in small blocks, once with a dictionary trained on
good documents and once with one trained on bad ones. Small blocks leave a
text little to copy from itself, so the sizes show how well each dictionary
knows it. The difference of the total sizes over their sum, on whole texts,
becomes a probability by a logistic curve fitted on labelled documents that
the dictionaries have not seen.

Defined results: a null or empty text has no blocks and the score of no
difference; repeated rows are scored each, texts with equal sizes alike; very
long texts are compressed whole; an empty table gives no rows and other columns
are not read; without labelled documents of both classes every score is the
share of the class seen (0.0 with none). The dictionaries learn from whole
texts, up to ``CLASS_BYTES`` of each class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revgraph.llm.common import pieces
from revgraph.llm.labelled import class_weights, labelled_sample, logistic, sigmoid

#: Bounds of what is learned from: documents a class, bytes of their whole texts a class, bytes of a dictionary.
PER_CLASS = 4096
CLASS_BYTES = 8 << 20
DICTIONARY_BYTES = 65536
BLOCK_BYTES = 128
LEVEL = 3
THRESHOLD = 0.7
#: One labelled document in so many fits the curve, the others the dictionaries.
CURVE_FOLD = 4


def blocks(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]


@dataclass
class Model:
    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    intercept: float = 0.0
    constant: float | None = None

    def differences(self, texts: list[str]) -> np.ndarray:
        """(bad size - good size) / (bad size + good size) of each text; 0 for an empty one."""
        if self.constant is not None:
            return np.zeros(len(texts))
        sizes = []
        for raw in (self.good, self.bad):
            compress = self._compressor(raw)
            sizes.append(np.asarray([sum(len(compress(b)) for b in blocks(t)) for t in texts], dtype=np.float64))
        return (sizes[1] - sizes[0]) / np.maximum(sizes[0] + sizes[1], 1)

    @staticmethod
    def _compressor(raw: bytes):
        if raw not in _compressors:
            known = zstandard.ZstdCompressionDict(raw)
            known.precompute_compress(level=LEVEL)
            _compressors[raw] = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
        return _compressors[raw].compress

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return np.full(len(difference), self.constant) if self.constant is not None else sigmoid(difference * self.slope + self.intercept)


_compressors: dict[bytes, zstandard.ZstdCompressor] = {}


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary, or the samples themselves where they are too few to train one."""
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-DICTIONARY_BYTES:].rjust(8, b" ")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Learn from the labelled documents that ``learn`` allows, at most ``per_class`` of each class."""
    sample, totals = labelled_sample(docs, labels, label, learn, per_class)
    sample = sample.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(CURVE_FOLD)))

    # Whole texts in order of a hash, as long as a class has room; one that alone exceeds the room is not learned from.
    size = F.octet_length("text").cast("long")
    order = Window.partitionBy("label").orderBy(F.xxhash64("text"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    room = sample.where((F.col("fold") != 0) & (size <= CLASS_BYTES)).withColumn("used", F.sum(size).over(order)).where(F.col("used") <= CLASS_BYTES)
    rows = room.select("doc_id", "label", "text").collect()  # at most CLASS_BYTES a class
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["text"]))
    by = {c: [b for r in rows if r["label"] == c for b in blocks(r["text"])] for c in (0, 1)}
    if not by[0] or not by[1]:
        return Model(constant=1.0 if by[1] else 0.0)
    model = Model(train_dictionary(by[1]), train_dictionary(by[0]))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                yield pa.RecordBatch.from_arrays([part.column("label").cast(pa.int32()), pa.array(model.differences(texts))], names=["label", "x"])

    seen = sample.where(F.col("fold") == 0).mapInArrow(measured, "label int, x double").collect()  # at most 2 * per_class numbers
    seen.sort()
    y, x = np.asarray([r["label"] for r in seen]), np.asarray([r["x"] for r in seen])
    if len(set(y.tolist())) < 2:
        return Model(constant=float(totals.get(1, 0) / max(1, sum(totals.values()))))
    scale = x.std() or 1.0
    w = logistic(((x - x.mean()) / scale)[:, None], y, class_weights(y, totals))
    model.slope, model.intercept = float(w[0] / scale), float(w[1] - w[0] * x.mean() / scale)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                p = model.probability(model.differences(texts))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, predicted int")
