"""Language identification with a blended-spectrum string kernel.

The kernel of two texts counts the character n-grams (2 to 4 letters, words
marked by their edges) that both hold, divided by the root of the product of
the texts' own counts. Nyström: landmark texts stand for the whole kernel;
their kernel matrix W turns kernel values into features K W^(-1/2), and a
ridge regression of each language against the rest is solved on a bounded
sample. A batch of texts is scored by two matrix products, presence times
landmark presence and kernel values times weights.

N-grams are hashed to ``PLACES``; of these, the ``COLUMNS`` that most
landmarks share (at least two) span the kernel.

Defined results: ``und`` with score 0.0 for a null text, one without a letter,
or when nothing could be learned; other texts get the language of the highest
value (ties: first in order of name); repeated rows are scored each. Whole texts
count, however long. An empty table gives no rows; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revgraph.llm.common import fold, pieces

#: Bounds of what is learned from: documents a language and in all, landmarks (one a language at least).
PER_LANGUAGE = 256
SAMPLE = 65536
LANDMARKS = 128
#: Every language is learned; a table with more than so many is refused.
LANGUAGES = 2048
SIZES = (2, 3, 4)
PLACES = 1 << 16
COLUMNS = 8192
RIDGE = 1e-3
#: Texts scored by one product.
ROWS = 64
#: Turns regression values into shares that add up to 1.
SHARPNESS = 8.0

_letter: np.ndarray | None = None


def _is_letter(codes: np.ndarray) -> np.ndarray:
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letter[codes]


def ngram_places(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all n-grams, the text each is from, and which texts hold a letter."""
    raw = [(" " + fold(t) + " ").encode("utf-32-le", "surrogatepass") for t in texts]
    codes = np.frombuffer(b"".join(raw), dtype="<u4")
    doc = np.repeat(np.arange(len(texts)), [len(r) // 4 for r in raw])
    letter = _is_letter(codes)
    has = np.zeros(len(texts), dtype=bool)
    has[doc[letter]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one edge mark behind each word
    keep[:-1] |= letter[1:] & ~letter[:-1]  # and one before it
    codes = np.where(letter, codes, 32)[keep].astype(np.uint64)
    doc = doc[keep]
    places, docs = [], []
    run = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(codes) < n:
            break
        run = run[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in SIZES:
            same = doc[n - 1 :] == doc[: len(doc) - n + 1]
            h = (run + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            places.append((h >> np.uint64(48)).astype(np.int64)[same])
            docs.append(doc[n - 1 :][same])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64), has
    return np.concatenate(places), np.concatenate(docs), has


@dataclass
class Model:
    languages: list[str]
    column: np.ndarray  # place -> column of the kernel, -1 for none
    landmarks: np.ndarray  # columns x landmarks, of length 1
    weights: np.ndarray  # landmarks x languages

    def presence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        places, docs, has = ngram_places(texts)
        at = self.column[places]
        ok = at >= 0
        out = np.zeros((len(texts), max(1, len(self.landmarks))), dtype=np.float32)
        out[docs[ok], at[ok]] = 1.0
        return out, has

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        present, has = self.presence(texts)
        kernel = present @ self.landmarks
        kernel /= np.sqrt(np.maximum(present.sum(axis=1), 1))[:, None]
        value = kernel.astype(np.float64) @ self.weights
        best = value.argmax(axis=1)
        share = np.exp(SHARPNESS * (value - value.max(axis=1, keepdims=True)))
        score = 1 / share.sum(axis=1)
        return [self.languages[b] if h else "und" for b, h in zip(best, has)], np.where(has, score, 0.0)


def _sample(docs: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, lang, places) of at most PER_LANGUAGE documents of each language, evenly fewer where these would be over SAMPLE."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"documents of more than {LANGUAGES} languages")
    per = max(1, min(PER_LANGUAGE, SAMPLE // max(1, len(counts))))
    languages = docs.sparkSession.createDataFrame([tuple(r) for r in counts], "lang string, _n long")
    # Few ids reach the window: a share of the hash range that is 8 standard deviations wider than needed.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) / float(1 << 52)
    near = known.select("doc_id", "lang").join(F.broadcast(languages), "lang").where(place <= (per + 8 * per**0.5) / F.col("_n"))
    order = Window.partitionBy("lang").orderBy(place, "doc_id")
    ids = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                places, where, _ = ngram_places(texts)
                pair = np.unique(where * PLACES + places)
                own = np.split((pair % PLACES).astype(np.int32), np.searchsorted(pair, np.arange(1, len(texts)) * PLACES))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("lang"), pa.array(own, pa.list_(pa.int32()))], names=["doc_id", "lang", "places"])

    rows = known.select("doc_id", "lang", F.col("text").cast("string").alias("text")).join(F.broadcast(ids.select("doc_id", "lang")), ["doc_id", "lang"])
    return rows.dropDuplicates(["lang", "text"]).select("doc_id", "lang", "text").mapInArrow(run, "doc_id long, lang string, places array<int>")


def fit(docs: DataFrame, learn: Column) -> Model:
    """Learn from text and lang of the documents that ``learn`` allows."""
    docs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sample = _sample(docs, learn).toArrow().combine_chunks()  # at most SAMPLE rows of at most PLACES 32-bit numbers
    lists = sample.column("places").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    cut, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    rows = [(lang, i, flat[a:b]) for lang, i, a, b in zip(sample.column("lang").to_pylist(), sample.column("doc_id").to_pylist(), cut, cut[1:]) if a < b]
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    languages = sorted({lang for lang, *_ in rows})
    none = np.full(PLACES, -1, dtype=np.int64)
    if not languages:
        return Model([], none, np.zeros((0, 0), np.float32), np.zeros((0, 0)))
    each = max(1, LANDMARKS // len(languages))
    which = {lang: k for k, lang in enumerate(languages)}
    label = np.asarray([which[lang] for lang, *_ in rows])
    size = np.bincount(label, minlength=len(languages))
    start = np.cumsum(size) - size
    marks = [i for a, n in zip(start.tolist(), size.tolist()) for i in range(a, a + min(each, n))]
    shared = np.zeros(PLACES, dtype=np.int64)
    for i in marks:
        shared[rows[i][2]] += 1
    order = np.lexsort((np.arange(PLACES), -shared))[:COLUMNS]
    columns = np.sort(order[shared[order] >= min(2, len(marks))])
    column = none.copy()
    column[columns] = np.arange(len(columns))

    def matrix(which: list[int]) -> np.ndarray:
        out = np.zeros((len(which), len(columns)), dtype=np.float32)
        for k, i in enumerate(which):
            at = column[rows[i][2]]
            out[k, at[at >= 0]] = 1.0
        return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))

    landmarks = matrix(marks).T.copy()
    own = (landmarks.T @ landmarks).astype(np.float64)
    value, vector = np.linalg.eigh(own)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
    gram, target = np.zeros((len(marks), len(marks))), np.zeros((len(marks), len(languages)))
    for a in range(0, len(rows), 512):
        part = label[a : a + 512]
        features = (matrix(list(range(a, a + len(part)))) @ landmarks).astype(np.float64) @ root
        weighted = features * (len(rows) / len(languages) / size[part])[:, None]
        gram += features.T @ weighted
        target += weighted.T @ np.eye(len(languages))[part]
    ridge = np.linalg.solve(gram + RIDGE * len(rows) * np.eye(len(marks)), target)
    return Model(languages, column, landmarks, root @ ridge)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                lang, score = [], []
                for a in range(0, len(texts), ROWS):
                    own, value = model.predict(texts[a : a + ROWS])
                    lang += own
                    score.append(value)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(np.concatenate(score))], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")
