"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine over a block-max inverted index.

Terms are words and the first four and five characters of longer words (so
that an inflected insult meets its stem). ``fit`` takes a bounded sample of
labelled examples of both classes, one of each group of near copies (else the
chance words of a text that is copied often would pass for signs of its
class), and indexes their whole vectors: every term, by its document frequency
in the whole corpus. A term that leans to toxic examples weighs more, by the
square root of its likelihood ratio; none is left out. Postings give the
scores of terms that few examples hold; for the common terms there is the
largest weight of each in each block of examples, and a search visits blocks
by these bounds and stops when no block left can change the k nearest. Texts
are searched some dozens at a time, so that a block meets all texts whose bound
reaches it in one product; those products screen in single precision, the
nearest are rescored in double, so cosines and ranking are exact. Block bounds
for the rare terms too were tried: the blocks that stay hold 70 to 85 % of all
postings, and bounding took longer than it saved. Votes are weighted by the
squared cosine; a logistic curve fitted on the examples, each scored without
itself, makes the score a probability.

What reaches the driver are the examples' vectors (8 bytes a term) and the
shingles that several examples of a class share, never texts; workers get the
vectors and lay the blocks out themselves.

Defined results: a null or empty text, and any text without a term, has no
neighbours and gets the score of zero votes; repeated rows are scored each;
without labelled examples of both classes every score is the share of the
class seen (0.0 with none); equal cosines rank by the example's id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revgraph.llm.common import WordBatch, pieces, release
from revgraph.llm.labelled import class_weights, labelled_sample, logistic, sigmoid

#: Labelled documents of a class that are learned from.
PER_CLASS = 4096
PREFIXES = (4, 5)
NEIGHBOURS = 16
#: Weight of the vote for "not toxic" that every text starts with.
PRIOR_VOTE = 0.25
BLOCK = 64
#: Share of the examples from which on a term is common.
COMMON = 0.06
#: Texts searched at a time: with 8,192 examples some 12 MB of scores.
TOGETHER = 64
#: More than single precision may be off in a sum of weights.
SLACK = 1e-5
THRESHOLD = 0.7


def terms_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts, and the text that each is from."""
    words = WordBatch(texts, PREFIXES)
    terms, docs = [words.hash], [words.doc]
    for k, (h, longer) in words.prefix.items():
        terms.append(h[longer] ^ np.uint64(k))
        docs.append(words.doc[longer])
    return np.concatenate(terms), np.concatenate(docs)


class Vocabulary:
    """Positions of the indexed terms, found from a table of where the terms of each run of top bits begin."""

    def __init__(self, terms: np.ndarray):
        self._lay_out(np.sort(np.ascontiguousarray(terms).view(np.uint64)))

    def __getstate__(self) -> np.ndarray:
        return self.terms

    def __setstate__(self, terms: np.ndarray) -> None:
        self._lay_out(terms)

    def _lay_out(self, terms: np.ndarray) -> None:
        self.terms = terms
        bits = min(22, max(8, 2 + len(terms).bit_length()))
        self.shift = np.uint64(64 - bits)
        top = (self.terms >> self.shift).astype(np.int64)
        self.start = np.searchsorted(top, np.arange((1 << bits) + 1)).astype(np.int32)

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, times) triples, sorted, for the indexed terms that occur."""
        terms, docs = terms_of(texts)
        top = (terms >> self.shift).astype(np.int64)
        at, end = self.start[top], self.start[top + 1]
        place = np.full(len(terms), -1, dtype=np.int64)
        left = np.flatnonzero(at < end)
        while len(left):
            same = self.terms[at[left]] == terms[left]
            place[left[same]] = at[left[same]]
            at[left] += 1
            left = left[~same & (at[left] < end[left])]
        ok = place >= 0
        size = max(1, len(self.terms))
        pair, times = np.unique(docs[ok] * size + place[ok], return_counts=True)
        return pair // size, pair % size, times


def vectors(vocabulary: Vocabulary, worth: np.ndarray, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its terms and their TF-IDF weights, of length 1."""
    doc, term, times = vocabulary.counts(texts)
    weight = (1 + np.log(times)) * worth[term]
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for a, b in zip(cut, cut[1:]):
        w = weight[a:b]
        out.append((term[a:b], w / np.sqrt((w * w).sum()) if b > a else w))
    return out


class BlockMaxIndex:
    """Inverted index over example vectors.

    Terms of few examples have postings, whose scores are summed in full.
    Terms of at least ``COMMON`` of the examples are kept as rows of blocks
    of examples, with their largest weight in each block: these bound what
    they can add, and only blocks that may hold one of the k nearest are scored.
    """

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], terms: int, common: float | None = None):
        # Examples led by the same term stand together, which keeps the bounds of blocks tight.
        lead = np.asarray([t[np.argmax(w)] for t, w in rows], dtype=np.int64)
        self.example = np.lexsort((np.arange(len(rows)), lead))
        sizes = np.asarray([len(rows[i][0]) for i in self.example], dtype=np.int64)
        place = np.uint16 if len(rows) < 1 << 16 else np.int32
        post = np.repeat(np.arange(len(rows), dtype=place), sizes)
        term = np.concatenate([rows[i][0] for i in self.example]).astype(np.int32) if len(rows) else np.empty(0, np.int32)
        weight = np.concatenate([rows[i][1] for i in self.example]) if len(rows) else np.empty(0, np.float32)
        self.blocks = -(-len(rows) // BLOCK)
        often = np.bincount(term, minlength=terms) >= max(2.0, (COMMON if common is None else common) * len(rows))
        #: Row of a common term, -1 for the others.
        self.row = np.where(often, np.cumsum(often) - 1, -1).astype(np.int32)
        own = often[term]
        self.common = post[own], self.row[term[own]], weight[own]
        post, weight, term = post[~own], weight[~own], term[~own]
        order = np.argsort(term, kind="stable")
        self.post, self.weight = post[order], weight[order]
        self.cut = np.searchsorted(term[order], np.arange(terms + 1)).astype(np.int32)
        self.dense = self.top = None  # laid out where they are needed first
        self.visited = 0

    def _lay_out(self) -> None:
        post, row, weight = self.common
        self.dense = np.zeros((self.blocks, BLOCK, int((self.row >= 0).sum())), dtype=weight.dtype)
        self.dense[post // BLOCK, post % BLOCK, row] = weight
        self.top = self.dense.max(axis=1)

    def __getstate__(self) -> dict:
        return {**vars(self), "dense": None, "top": None}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self._lay_out()
        self.common = None  # a worker needs the blocks only

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine above 0 (ties: smaller example) and their cosines."""
        return self.search_all([(terms, weights)], k)[0]

    def search_all(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for i in range(0, len(queries), TOGETHER):
            out += self._search(queries[i : i + TOGETHER], k)
        return out

    def _rare(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the postings of the query's rare terms add to every example."""
        first = self.cut[terms].astype(np.int64)
        n = self.cut[terms + 1] - first
        ends = np.cumsum(n)
        at = np.repeat(first - (ends - n), n)
        at += np.arange(len(at))
        return np.bincount(self.post[at], weights=self.weight[at] * np.repeat(weights, n), minlength=self.blocks * BLOCK)

    def _score(self, score: np.ndarray, rare: np.ndarray, single: np.ndarray, now: np.ndarray) -> None:
        """Score the blocks ``now`` of each text: runs of blocks that half of the texts need as one product for all of them."""
        many = 2 * now.sum(axis=0) >= len(now)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], many, [0]))))
        for a, z in zip(edges[::2].tolist(), edges[1::2].tolist()):
            at = slice(a * BLOCK, z * BLOCK)
            np.add(rare[:, at], single @ self.dense[a:z].reshape(-1, single.shape[1]).T, out=score[:, at])
            now[:, a:z] = True
        for i in np.flatnonzero(now.any(axis=0) & ~many).tolist():
            own, at = np.flatnonzero(now[:, i]), slice(i * BLOCK, (i + 1) * BLOCK)
            score[own, at] = rare[own, at] + single[own] @ self.dense[i].T

    def _search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        if self.dense is None:
            self._lay_out()
        n, size = len(queries), self.blocks * BLOCK
        rare, query = np.zeros((n, size)), np.zeros((n, self.dense.shape[2]))
        for own, sparse, (terms, weights) in zip(query, rare, queries):
            row = self.row[terms]
            own[row[row >= 0]] = weights[row >= 0]
            sparse[:] = self._rare(terms, weights)
        single, score = query.astype(self.dense.dtype), rare.astype(self.dense.dtype)
        more = single @ self.top.T + self.dense.dtype.type(SLACK)
        todo = more > SLACK
        bound = score.reshape(n, self.blocks, BLOCK).max(axis=2) + more + self.dense.dtype.type(SLACK) if self.blocks else more
        # Scores only grow: the k-th largest so far is a floor, whichever blocks are still to come.
        if self.blocks > 4:
            least = np.partition(np.where(todo, bound, 0), -4, axis=1)[:, -4]
            now = todo & (bound >= least[:, None])
            for i in np.flatnonzero(now.any(axis=0)).tolist():
                own, at = np.flatnonzero(now[:, i]), slice(i * BLOCK, (i + 1) * BLOCK)
                score[own, at] = rare[own, at] + single[own] @ self.dense[i].T
            todo &= ~now
            self.visited += int(now.sum())
        floor = self._floor(score, k)
        now = todo & (bound >= floor[:, None])
        self._score(score, rare, single, now)
        self.visited += int((now & todo).sum())
        floor = self._floor(score, k)
        found, wide = [], self.dense.reshape(size, -1)
        for j in range(n):
            hit = np.flatnonzero((score[j] >= floor[j] - 2 * SLACK) & (score[j] > 0))
            exact = rare[j, hit] + wide[hit].astype(np.float64) @ query[j]
            order = np.lexsort((self.example[hit], -exact))[:k]
            found.append((self.example[hit[order]], np.minimum(exact[order], 1.0)))
        return found

    @staticmethod
    def _floor(score: np.ndarray, k: int) -> np.ndarray:
        if score.shape[1] < k:
            return np.zeros(len(score))
        return np.maximum(0.0, np.partition(score, -k, axis=1)[:, -k])


@dataclass
class Model:
    vocabulary: Vocabulary
    worth: np.ndarray  # of each term: idf, times its weight by the likelihood ratio
    index: BlockMaxIndex
    ids: np.ndarray
    labels: np.ndarray
    curve: np.ndarray  # slope and intercept
    constant: float | None = None
    sent: Broadcast | None = None

    def __getstate__(self) -> dict:
        return {**vars(self), "sent": None}

    def send(self, spark: SparkSession) -> Broadcast:
        """The model on its way to the workers, once for all scans; the curve does not travel with it."""
        if self.sent is None:
            self.sent = spark.sparkContext.broadcast(self)  # 8 bytes for each term of at most 2 * per_class examples
        return self.sent

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]], own: np.ndarray | None = None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each vector the toxic share of the votes, the nearest examples and their cosines; ``own`` are examples that do not count."""
        if not len(self.ids):
            return [(0.0, np.empty(0, np.int64), np.empty(0))] * len(vectors)
        out = []
        for i, (near, cosine) in enumerate(self.index.search_all(vectors, NEIGHBOURS + (own is not None))):
            if own is not None:
                near, cosine = near[near != own[i]][:NEIGHBOURS], cosine[near != own[i]][:NEIGHBOURS]
            vote = cosine * cosine
            out.append((float((vote * self.labels[near]).sum() / (vote.sum() + PRIOR_VOTE)), near, cosine))
        return out


def probability(votes: np.ndarray, curve: np.ndarray, constant: float | None) -> np.ndarray:
    return np.full(len(votes), constant) if constant is not None else sigmoid(votes * curve[0] + curve[1])


def _term_counts(sample: DataFrame) -> DataFrame:
    """term, toxic, clean: documents of the sample that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                label = part.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
                terms, docs = terms_of(texts)
                order = np.lexsort((docs, terms))
                terms, docs = terms[order], docs[order]
                first = np.ones(len(terms), dtype=bool)
                first[1:] = (terms[1:] != terms[:-1]) | (docs[1:] != docs[:-1])
                terms, toxic = terms[first], label[docs[first]]
                own, at = np.unique(terms, return_index=True)
                if len(own):
                    n = np.diff(np.append(at, len(terms)))
                    bad = np.add.reduceat(toxic, at)
                    yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(bad), pa.array(n - bad)], names=["term", "toxic", "clean"])

    counts = sample.select("text", "label").mapInArrow(run, "term long, toxic long, clean long")
    return counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


#: Similarity of 5-word shingles from which on an example is a copy.
COPY = 0.8


def copies(shared: list[np.ndarray], sizes: list[int], labels: list[int]) -> list[int]:
    """Positions of the sets that a kept earlier set of the same label is a copy of; every one is checked in full.

    ``shared`` holds of each set of ``sizes`` shingles those that are also in
    another set. Of two sets with a similarity of ``COPY`` or more, each has one
    of the shingles they share among its rarest, so many as are more than a
    fifth; shingles of one set alone are its rarest.
    """
    every, times = np.unique(np.concatenate([np.empty(0, np.uint64), *shared]), return_counts=True)
    rank = np.empty(len(every), dtype=np.int32)
    rank[np.lexsort((every, times))] = np.arange(len(every), dtype=np.int32)
    holds: dict[int, list[int]] = {}
    gone, sets = [], {}
    for i, (own, n, label) in enumerate(zip(shared, sizes, labels)):
        place = np.sort(rank[np.searchsorted(every, own)])
        more = n - int(np.ceil(COPY * n - 1e-9)) + 1 - (n - len(place))
        rarest = [2 * p + label for p in place[: max(0, more)].tolist()]
        copy = False
        for j in sorted({j for p in rarest for j in holds.get(p, ())}):
            m = sizes[j]
            if min(n, m) >= COPY * max(n, m) - 1e-9:
                both = len(np.intersect1d(place, sets[j], assume_unique=True))
                if both >= COPY * (n + m - both) - 1e-9:
                    copy = True
                    break
        if copy:
            gone.append(i)
        elif rarest:
            sets[i] = place
            for p in rarest:
                holds.setdefault(p, []).append(i)
    return gone


def _shingles(texts: list[str]) -> list[np.ndarray]:
    words = WordBatch(texts)
    h, at = words.windows(5)
    cut = np.searchsorted(words.doc[at], np.arange(len(texts) + 1))
    return [np.unique(h[i:j]) for i, j in zip(cut, cut[1:])]


def _one_of_each(sample: DataFrame) -> DataFrame:
    """The sample without the documents that are near copies of a kept one of their label with a smaller id."""

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shingles of each text, under their label."""
        for batch in batches:
            for part, texts in pieces(batch):
                label = part.column("label").to_numpy().astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h ^ y for h, y in zip(_shingles(texts), label)]).view(np.int64))], names=["h"])

    columns, key = sample.columns, ["doc_id", "label", "row"]
    sample = sample.withColumn("row", F.xxhash64("text"))
    held = sample.select("label", "text").mapInArrow(single, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    several = np.sort(held.where("n > 1").select("h").toArrow().column("h").to_numpy().view(np.uint64))  # of at most 2 * per_class texts

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shingles that other texts of the label have too, and the number of all."""
        for batch in batches:
            for part, texts in pieces(batch):
                label, sets = part.column("label").to_numpy().astype(np.uint64), _shingles(texts)
                own = [(h ^ y)[np.isin(h ^ y, several, assume_unique=True)].view(np.int64) for h, y in zip(sets, label)]
                flat = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, own)]), pa.int32()), pa.array(np.concatenate(own)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in key), pa.array([len(h) for h in sets], pa.int32()), flat], names=[*key, "n", "shared"])

    kinds = [F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"), "row", "text"]
    found = sample.select(*kinds).mapInArrow(common, "doc_id long, label int, row long, n int, shared array<long>").where(F.size("shared") > 0).toArrow().combine_chunks()
    cut = np.concatenate(([0], np.cumsum(pc.list_value_length(found.column("shared")).to_numpy())))
    flat = pc.list_flatten(found.column("shared")).to_numpy().view(np.uint64)
    ids, y, row, n = (found.column(c).to_numpy() for c in (*key, "n"))
    order = np.lexsort((row, y, ids)).tolist()
    gone = copies([flat[cut[i] : cut[i + 1]] for i in order], n[order].tolist(), y[order].tolist())
    dropped = [(int(ids[i]), int(y[i]), int(row[i])) for i in (order[j] for j in gone)]
    marks = sample.sparkSession.createDataFrame(dropped, "doc_id long, label int, row long")
    return sample.join(F.broadcast(marks), key, "left_anti").select(*columns)


def _g2(a: Column, b: Column, na: int, nb: int) -> Column:
    """Likelihood ratio of a 2 x 2 table: a of na and b of nb hold the term."""
    n = na + nb
    parts = [(a, (a + b) * na / n), (F.lit(na) - a, (F.lit(n) - a - b) * na / n), (b, (a + b) * nb / n), (F.lit(nb) - b, (F.lit(n) - a - b) * nb / n)]
    total = F.lit(0.0)
    for seen, expected in parts:
        total = total + F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))
    return 2 * total


def corpus_frequencies(docs: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """Documents of the whole corpus that hold each indexed term, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(len(vocabulary.terms), dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, texts in pieces(batch):
                np.add.at(seen, vocabulary.counts(texts)[1], 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], rows))], names=["term", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row for each term of the examples
    at, n = found.column("term").to_numpy(), found.column("n").to_numpy()
    out = np.zeros(len(vocabulary.terms), dtype=np.int64)
    out[at[at >= 0]] = n[at >= 0]
    return out, int(n[at < 0].sum())


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Learn from the labelled documents that ``learn`` allows, at most ``per_class`` of each class."""
    sample, totals = labelled_sample(docs, labels, label, learn, per_class)
    sample = _one_of_each(sample)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    na, nb = sizes.get(1, 0), sizes.get(0, 0)
    none = Vocabulary(np.empty(0, np.uint64))
    if not na or not nb:
        return Model(none, np.empty(0), BlockMaxIndex([], 0), np.empty(0), np.empty(0), np.zeros(2), 1.0 if na else 0.0)
    lean = F.when(F.col("toxic") * nb > F.col("clean") * na, F.greatest(_g2(F.col("toxic"), F.col("clean"), na, nb), F.lit(0.0))).otherwise(F.lit(0.0))
    counts = _term_counts(sample).select("term", lean.alias("g2")).toArrow()
    vocabulary = Vocabulary(counts.column("term").to_numpy())
    g2 = counts.column("g2").to_numpy()[np.argsort(counts.column("term").to_numpy().view(np.uint64))]
    seen, rows = corpus_frequencies(docs, vocabulary)
    worth = (np.log((1 + rows) / (1 + seen)) + 1) * (1 + np.sqrt(g2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                found = vectors(vocabulary, worth, texts)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "label", "row")), pa.array([t.astype(np.int32) for t, _ in found], pa.list_(pa.int32())), pa.array([w.astype(np.float32) for _, w in found], pa.list_(pa.float32()))],
                    names=["doc_id", "label", "row", "terms", "weights"],
                )

    key = [F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"), F.xxhash64("text").alias("row")]
    sample = sample.select(*key, "text")
    examples = sample.mapInArrow(run, "doc_id long, label int, row long, terms array<int>, weights array<float>").toArrow().combine_chunks()  # at most 2 * per_class rows
    n = pc.list_value_length(examples.column("terms")).to_numpy()
    cut = np.concatenate(([0], np.cumsum(n)))
    terms, weights = (pc.list_flatten(examples.column(c)).to_numpy() for c in ("terms", "weights"))
    ids, y, row = (examples.column(c).to_numpy() for c in ("doc_id", "label", "row"))
    order = [i for i in np.lexsort((row, y, ids)).tolist() if n[i]]  # an example without a word has no neighbours
    index = BlockMaxIndex([(terms[cut[i] : cut[i + 1]], weights[cut[i] : cut[i + 1]]) for i in order], len(vocabulary.terms))
    model = Model(vocabulary, worth, index, ids[order].astype(np.int64), y[order].astype(np.int64), np.zeros(2))
    places = [(int(ids[i]), int(y[i]), int(row[i]), p) for p, i in enumerate(order)]
    del examples, terms, weights
    sent = model.send(docs.sparkSession)

    def score_examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each example by the others."""
        for batch in batches:
            for part, texts in pieces(batch):
                own = part.column("place").to_numpy()
                votes = [v for v, _, _ in sent.value.votes(vectors(sent.value.vocabulary, sent.value.worth, texts), own)]
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(votes, pa.float64())], names=["label", "vote"])
        release()

    known = sample.sparkSession.createDataFrame(places, "doc_id long, label int, row long, place int")
    scored = sample.join(F.broadcast(known), ["doc_id", "label", "row"], "left").select("label", F.coalesce("place", F.lit(-1)).alias("place"), "text")
    own = scored.mapInArrow(score_examples, "label int, vote double").toArrow()
    votes, marks = own.column("vote").to_numpy(), own.column("label").to_numpy().astype(np.int64)
    model.curve = logistic(votes[:, None], marks, class_weights(marks, totals))
    return model


SCORED = "doc_id long, score double, predicted int, evidence array<struct<doc_id:bigint,toxic:int,cosine:double>>"


def score(docs: DataFrame, model: Model, evidence: int = 3) -> DataFrame:
    """doc_id, score, predicted and the nearest examples of every document."""
    sent, curve, constant = model.send(docs.sparkSession), model.curve, model.constant

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                model = sent.value
                found = model.votes(vectors(model.vocabulary, model.worth, texts))
                near = [[{"doc_id": int(model.ids[e]), "toxic": int(model.labels[e]), "cosine": float(c)} for e, c in zip(own[:evidence], cosine)] for _, own, cosine in found]
                p = probability(np.asarray([v for v, _, _ in found]), curve, constant)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(near, pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())])))],
                    names=["doc_id", "score", "predicted", "evidence"],
                )
        release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCORED)


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic; all columns as they were."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    at = docs.columns.index("text")
    sent, curve, constant = model.send(docs.sparkSession), model.curve, model.constant

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part, texts in pieces(named, f"c{at}"):
                model = sent.value
                votes = np.asarray([v for v, _, _ in model.votes(vectors(model.vocabulary, model.worth, texts))])
                yield part.filter(pa.array(probability(votes, curve, constant) < THRESHOLD)).rename_columns(batch.schema.names)
        release()

    return docs.mapInArrow(run, docs.schema)
