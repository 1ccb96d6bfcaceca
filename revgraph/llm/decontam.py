"""Benchmark decontamination: training passages query a BM25 index of test items with block-max WAND.

Every document is cut into overlapping passages, long enough that an item
anywhere in it lies whole in one of them. The index holds for each block of
items the BM25 weights of its terms, divided by the item's own full score, and
for each term the blocks that hold it with the largest weight of each (no
table of all terms and blocks). As in WAND, an item's light terms (together
at most ``LIGHT`` of its score) are left out of the block maxima, since the
others must bring the rest: a passage looks at the items of a block only if
the maxima of its terms reach the threshold less ``LIGHT``, which refuses no
item that could score enough. All items that do are retrieved, by their exact
scores. A retrieved item counts as leaked if enough of the
word trigrams of its question and of its answer stand in the document.

The item's last sentence is its answer (the last third of its words if there
is only one sentence). The table of items is a benchmark, bounded by
``MAX_ITEMS``; a larger one is refused, never cut.

Defined results: an item or document without words neither leaks nor is
leaked; items shorter than three words are compared by all their words;
repeated items and documents are each reported; texts of any length are read
whole; an empty table gives no rows; other columns are not read, and ``clean``
hands them on whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revgraph.llm.common import WordBatch, pieces, window_hashes

K1, B = 1.2, 0.75
#: Share of an item's own BM25 score that a passage must reach.
THRESHOLD = 0.6
#: Share of the trigrams of the question, and of the answer, that must occur.
OVERLAP = 0.7
GRAM = 3
BLOCK = 8
LIGHT = 0.35
#: What the block maxima of a passage must come to.
LEAST = THRESHOLD - LIGHT - 1e-6
MAX_ITEMS = 200_000
#: Sums of block maxima held at a time, and block postings added up for them.
SUMS, POSTINGS = 1 << 20, 1 << 22
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def question_and_answer(text: str) -> tuple[str, str]:
    sentences = [s for s in _SENTENCE_END.split(text.strip()) if s]
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = text.split()
    cut = -(-2 * len(words) // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


def grams(h: np.ndarray) -> np.ndarray:
    """Distinct trigrams; of fewer than three words, one gram of them all."""
    return np.unique(window_hashes(h, min(GRAM, len(h)))) if len(h) else np.empty(0, np.uint64)


class ItemIndex:
    """BM25 weights of items by term, with block maxima, as shares of each item's full score."""

    def __init__(self, ids: list[int], texts: list[str]):
        words = WordBatch(texts)
        own = [words.hash[a:b] for a, b in zip(words.first, words.first[1:])]
        keep = [i for i, h in enumerate(own) if len(h)]
        own = [own[i] for i in keep]
        self.ids = np.asarray([ids[i] for i in keep], dtype=np.int64)
        texts = [texts[i] for i in keep]
        n = len(own)
        self.longest = max((len(h) for h in own), default=1)
        counts = [np.unique(h, return_counts=True) for h in own]
        self.terms, df = np.unique(np.concatenate([t for t, _ in counts]), return_counts=True) if n else (np.empty(0, np.uint64), np.empty(0))
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        mean = np.mean([len(h) for h in own]) if n else 1.0
        term, item, weight = [], [], []
        for i, (t, tf) in enumerate(counts):
            at = np.searchsorted(self.terms, t)
            w = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own[i]) / mean))
            term.append(at)
            item.append(np.full(len(at), i))
            weight.append(w / w.sum())
        term, item, weight = (np.concatenate(x) if n else np.empty(0, k) for x, k in ((term, np.int64), (item, np.int64), (weight, float)))
        self.blocks = max(1, -(-n // BLOCK))
        order = np.lexsort((item, term, item // BLOCK))
        self.term, self.item, self.weight = term[order].astype(np.int32), item[order].astype(np.int32), weight[order]
        self.cut = np.searchsorted(self.item // BLOCK, np.arange(self.blocks + 1))
        heavy = self._heavy(item, weight)
        place, at = np.unique(term[heavy] * self.blocks + item[heavy] // BLOCK, return_inverse=True)
        top = np.zeros(len(place))
        np.maximum.at(top, at, weight[heavy])
        self.top, self.top_block = top.astype(np.float32), (place % self.blocks).astype(np.int32)
        self.top_cut = np.searchsorted(place // self.blocks, np.arange(len(self.terms) + 2))  # the last but one: a word of no item
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.terms >> np.uint64(48)).astype(np.int64)] = True
        parts = [question_and_answer(t) for t in texts]
        self.question, self.answer = ([grams(WordBatch([p[k]]).hash) for p in parts] for k in (0, 1))

    @staticmethod
    def _heavy(item: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Which weights are not among an item's lightest that come to at most ``LIGHT`` together."""
        order = np.lexsort((weight, item))
        run = np.cumsum(weight[order])
        start = np.searchsorted(item[order], item[order])
        out = np.empty(len(item), dtype=bool)
        out[order] = run - (run[start] - weight[order][start]) > LIGHT
        return out

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Term of each word; ``len(terms)`` for a word of no item."""
        out = np.full(len(h), len(self.terms))
        hit = np.flatnonzero(self.maybe[(h >> np.uint64(48)).astype(np.int64)])
        at = np.searchsorted(self.terms, h[hit])
        at[at == len(self.terms)] = 0
        ok = self.terms[at] == h[hit]
        out[hit[ok]] = at[ok]
        return out

    def passages(self, words: WordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last word (exclusive) of every passage, and its text: twice the longest item, half overlapping."""
        step = self.longest
        n = np.maximum(1, -(-words.count // step) - 1) * (words.count > 0)
        doc = np.repeat(np.arange(words.size), n)
        k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        first = words.first[doc] + k * step
        return first, np.minimum(first + 2 * step, words.first[doc + 1]), doc

    def retrieve(self, words: WordBatch) -> list[tuple[int, int, float]]:
        """(text, item, score) of every item that some passage of the text scores at least ``THRESHOLD``."""
        term = self.lookup(words.hash)
        size = np.diff(self.top_cut)
        hit = np.flatnonzero(size[term])
        first, last, doc = self.passages(words)
        if not len(hit) or not len(first):
            return []
        a, b = np.searchsorted(hit, first), np.searchsorted(hit, last)
        best: dict[tuple[int, int], float] = {}
        for p in self._passages_of_note(term[hit], size, a, b):
            terms = np.unique(term[first[p] : last[p]])
            terms = terms[terms < len(self.terms)]
            for block in np.flatnonzero(self._sums(terms, np.zeros(len(terms), np.int64), 1)[0] >= LEAST):  # each word once now
                s = slice(self.cut[block], self.cut[block + 1])
                ok = np.isin(self.term[s], terms)
                score = np.bincount(self.item[s][ok] - block * BLOCK, weights=self.weight[s][ok], minlength=BLOCK)
                for i in np.flatnonzero(score >= THRESHOLD - 1e-9).tolist():
                    key = (int(doc[p]), int(block) * BLOCK + i)
                    best[key] = max(best.get(key, 0.0), float(score[i]))
        return [(d, i, s) for (d, i), s in sorted(best.items())]

    def _sums(self, terms: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Sums of block maxima, rows x blocks, over the terms of each row."""
        size = self.top_cut[terms + 1] - self.top_cut[terms]
        at = np.repeat(self.top_cut[terms] - np.cumsum(size) + size, size) + np.arange(size.sum())
        place = np.repeat(row, size) * self.blocks + self.top_block[at]
        return np.bincount(place, weights=self.top[at], minlength=rows * self.blocks).reshape(rows, self.blocks)

    def _passages_of_note(self, term: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[int]:
        """Passages (words ``a`` to ``b`` of ``term``) whose words, repeats counted, bring some block to ``LEAST``."""
        cost = np.append(0, np.cumsum(size[term]))
        cost = np.append(0, np.cumsum(cost[b] - cost[a]))
        lo = 0
        while lo < len(a):
            most = np.searchsorted(cost, cost[lo] + POSTINGS, "right") - 1
            hi = max(lo + 1, min(int(most), lo + SUMS // self.blocks))
            n = (b - a)[lo:hi]
            row = np.repeat(np.arange(hi - lo), n)
            at = np.repeat(a[lo:hi] - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield from (lo + np.flatnonzero((self._sums(term[at], row, hi - lo) >= LEAST).any(axis=1))).tolist()
            lo = hi

    def leaks(self, words: WordBatch) -> list[tuple[int, int, float, float, float]]:
        """(text, item, score, question overlap, answer overlap) of verified items."""
        out, have, last = [], None, -1
        for d, i, s in self.retrieve(words):
            if d != last:
                h = words.hash[words.first[d] : words.first[d + 1]]
                have, last = {}, d
            q, a = (self._share(h, g, have) for g in (self.question[i], self.answer[i]))
            if min(q, a) >= OVERLAP:
                out.append((d, i, s, q, a))
        return out

    @staticmethod
    def _share(h: np.ndarray, part: np.ndarray, have: dict) -> float:
        """Share of a part's grams found in the text; a part without words is no obstacle."""
        if not len(part):
            return 1.0
        best = 0.0
        for size in range(1, GRAM + 1):  # parts shorter than a gram are one gram of fewer words
            if size < GRAM and len(part) > 1:
                continue
            if size not in have:
                have[size] = np.unique(window_hashes(h, size)) if len(h) >= size else np.empty(0, np.uint64)
            best = max(best, float(np.isin(part, have[size]).mean()))
        return best


def item_index(items: DataFrame) -> ItemIndex:
    """Index of a benchmark table (item_id, text) of at most ``MAX_ITEMS`` rows."""
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise ValueError(f"a benchmark of more than {MAX_ITEMS} items must be split into several")
    rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
    return ItemIndex([-1 if r["item_id"] is None else r["item_id"] for r in rows], [r["text"] or "" for r in rows])


LEAKS = "doc_id long, item_id long, bm25_share double, question_overlap double, answer_overlap double"


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row for every document and test item that it leaks."""
    index = item_index(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                found = index.leaks(WordBatch(texts))
                if not found:
                    continue
                d, i, s, q, a = (np.asarray(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(d)), pa.array(index.ids[i]), pa.array(s), pa.array(q), pa.array(a)], names=["doc_id", "item_id", "bm25_share", "question_overlap", "answer_overlap"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, LEAKS)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that leak no item, all columns as they were."""
    index = item_index(items)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part, texts in pieces(named, f"c{at}"):
                keep = np.ones(len(texts), dtype=bool)
                keep[[f[0] for f in index.leaks(WordBatch(texts))]] = False
                yield part.filter(pa.array(keep)).rename_columns(batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
