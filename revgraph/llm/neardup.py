"""Near-duplicate texts: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

A text's shingles are its runs of five words (a shorter text is one shingle);
a shingle weighs its count times the mean inverse document frequency of its
words. Word frequencies come from all documents, in ``BUCKETS`` hash buckets,
so the table that tasks share has a fixed size. Weights are rounded down to a
grid of ``GRID`` in their logarithm, for sampling and verifying alike. Two
texts are linked if their weighted Jaccard similarity is at least
``SIMILARITY``, or the plain one is: rare words in the few places where copies
differ must not part texts that share four shingles in five.

Consistent weighted sampling takes the shingle that minimises a random value,
which is drawn from the shingle's own hash wherever it is small enough to win
in a text of some hundred shingles or more, however many; two texts agree on a sample with the probability of their weighted Jaccard
similarity. ``BANDS`` bands of ``ROWS`` samples make the candidates. Equal
texts are one class from the start and only their representative goes on.

Candidates are verified on whole texts, without listing the pairs of a large
bucket. In each round every member of a bucket is compared with one of its
texts, and verified links merge classes. In buckets that then still hold
several classes, the members outside the largest class are compared with all
the others: pair by pair in small buckets, in large ones as blocks of texts by
matrix products over their shared shingles, which emit only links that merge
classes. So every candidate pair is verified, refused or within one class.

Defined results: texts whose words are equal in order are copies; a null text
or one without a word is alone in its class; classes are named by their
smallest doc_id; rows that share a doc_id are told apart by their text, and
rows equal in both share a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revgraph.llm.common import WORD, WordBatch, bitmap, fold, in_bitmap, mix, pieces, stored, window_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
BUCKETS = 1 << 18
GRID = 0.1
LEVELS = 160
#: Sampling values that are not among a shingle's smallest are drawn from a table of so many rows.
POOL = 1 << 13
#: Weight levels of a band, each with sampling values of its own, and the share of the first band's that are drawn exactly.
BAND = 32
TAIL = 1 / 64
#: Sampling values that are drawn together.
DRAWN = 1 << 20
#: Rounds of comparing a bucket with one of its texts before its remaining classes are compared.
ROUNDS = 2
#: Buckets up to this size are compared pair by pair; texts of a block on either side.
SMALL = 16
BLOCK_A, BLOCK_B = 128, 512


def _weight(level: np.ndarray | int) -> np.ndarray:
    return np.exp(np.asarray(level) * GRID)


#: End of the time in which the points of the first band are drawn exactly.
_TAU = -np.log1p(-TAIL) / float(_weight(BAND - 1))


def sampling_table() -> np.ndarray:
    """First point after ``_TAU`` by weight level of the first band and random row, as the bits of 32-bit floats.

    The sampling value of a weight w is the first time of a point of weight
    at most w, of points that fall at rate one over times and weights: it is
    exponential with rate w, and the same for two weights unless the heavier
    has an earlier point.
    """
    rng = np.random.default_rng(20240229)
    rate = np.diff(_weight(np.arange(BAND)), prepend=0.0)
    first = np.minimum.accumulate(rng.exponential(size=(BAND, POOL)) / rate[:, None], axis=0)
    return (_TAU + first).astype(np.float32).view(np.uint32)


def _uniform(h: np.ndarray, step: int) -> np.ndarray:
    """Numbers between 0 and 1 from 64-bit hashes, others for each step."""
    key = mix(np.asarray([step + 1], dtype=np.uint64))
    return ((mix(h ^ key) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _first_points(h: np.ndarray, weight: np.ndarray, low: float, high: float, time: np.ndarray, end: np.ndarray | float, step: int) -> np.ndarray:
    """First times of points with a weight of ``low`` to ``weight``; infinite from ``end`` on.

    ``time`` is that of the first point below ``high``. Going on to the next
    point of less weight until one is light enough, all draws are the same
    for every weight.
    """
    out = np.full(len(h), np.inf)
    at, time, top = np.arange(len(h)), time.copy(), np.full(len(h), high)
    end = np.broadcast_to(end, len(h))
    while len(at):
        top = low + _uniform(h[at], step) * (top - low)
        alive = time < end[at]
        light = alive & (top <= weight[at])
        out[at[light]] = time[light]
        more = alive & ~light
        at, top, time = at[more], top[more], time[more]
        time = time - np.log(_uniform(h[at], step + 1)) / (top - low)
        step += 2
    return out


def _bits(time: np.ndarray) -> np.ndarray:
    return time.astype(np.float32).view(np.uint32).astype(np.uint64)


_TABLE: np.ndarray | None = None


def word_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold a word of each bucket, over all documents, and how many documents there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, texts in pieces(batch):
                words = WordBatch(texts)
                pair = np.unique(words.doc.astype(np.int64) * BUCKETS + bucket(words.hash))
                seen += np.bincount(pair % BUCKETS, minlength=BUCKETS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], rows))], names=["bucket", "n"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS + 1 rows
    out, rows = np.zeros(BUCKETS, dtype=np.int64), 0
    at, n = counts["bucket"].to_numpy(dtype=np.int64), counts["n"].to_numpy(dtype=np.int64)
    rows = int(n[at < 0].sum())
    out[at[at >= 0]] = n[at >= 0]
    return out, rows


def bucket(word: np.ndarray) -> np.ndarray:
    return (word >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    seen, rows = word_frequencies(docs)
    return (np.log((1 + rows) / (1 + seen)) + 1).astype(np.float32)


LINK = "a long, b long, similarity double, plain double, linked boolean"


class Shingles:
    """Distinct shingles of several texts with their weight levels, sorted by text and shingle."""

    def __init__(self, words: WordBatch, idf: np.ndarray):
        weight = idf[bucket(words.hash)].astype(np.float64)
        run = np.concatenate(([0.0], np.cumsum(weight)))
        h, at = words.windows(SHINGLE)
        doc, mean = words.doc[at], (run[at + SHINGLE] - run[at]) / SHINGLE
        short = np.flatnonzero((words.count > 0) & (words.count < SHINGLE))
        if len(short):
            a, b = words.first[short], words.first[short + 1]
            whole = np.asarray([window_hashes(words.hash[i:j], j - i)[0] for i, j in zip(a, b)], dtype=np.uint64)
            h, doc, mean = np.concatenate((h, whole)), np.concatenate((doc, short)), np.concatenate((mean, (run[b] - run[a]) / (b - a)))
        order = np.lexsort((h, doc))
        h, doc, mean = h[order], doc[order], mean[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(h)))
        self.hash, self.doc = h[at], doc[at]
        level = np.floor(np.log(np.maximum(mean[at] * times, 1.0)) / GRID + 1e-9)
        self.level = np.minimum(level, LEVELS - 1).astype(np.int64)
        self.cut = np.searchsorted(self.doc, np.arange(words.size + 1))

    def samples(self) -> np.ndarray:
        """texts x (BANDS * ROWS) samples; those of texts without shingles mean nothing."""
        global _TABLE
        if _TABLE is None:
            _TABLE = sampling_table()
        table, base = _TABLE.ravel(), np.minimum(self.level, BAND - 1) * POOL
        shift, low, high = np.uint64(64 - POOL.bit_length() + 1), np.uint64(0xFFFFFFFF), np.uint64(32)
        tail = np.uint64((round(1 / TAIL) - 1) << 40)
        full = np.flatnonzero(np.diff(self.cut) > 0)
        out = np.zeros((len(self.cut) - 1, BANDS * ROWS), dtype=np.uint64)
        if not len(full):
            return out
        odd = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
        starts, weight = self.cut[full], _weight(self.level)
        heavy = [np.flatnonzero(self.level >= b) for b in range(BAND, LEVELS, BAND)]
        together = max(1, min(BANDS * ROWS, DRAWN // len(self.hash)))
        for k in range(0, BANDS * ROWS, together):
            own_odd = odd[k : k + together]
            value, early = np.empty((len(own_odd), len(self.hash)), dtype=np.uint64), []
            for row, o in zip(value, own_odd):
                h = self.hash * o
                np.left_shift(table[base + (h >> shift).view(np.int64)], high, out=row, dtype=np.uint64)
                early.append(np.flatnonzero((h & tail) == 0))
                h >>= np.uint64(8)
                h &= low
                row |= h
            sample, early = np.repeat(np.arange(len(early)), [len(e) for e in early]), np.concatenate(early)
            own = mix(self.hash[early] * own_odd[sample] ^ own_odd[sample])
            top = float(_weight(BAND - 1))
            found = _first_points(own, weight[early], 0.0, top, -np.log1p(-TAIL * _uniform(own, 0)) / top, _TAU, 1)
            hit = np.isfinite(found)
            sample, early, found = sample[hit], early[hit], found[hit]
            value[sample, early] = (value[sample, early] & low) | (_bits(found) << high)
            for i, rows in enumerate(heavy, 1):
                if not len(rows):
                    break
                floor, top = float(_weight(BAND * i - 1)), float(_weight(BAND * (i + 1) - 1))
                own = (mix(self.hash[rows] * own_odd[:, None] ^ own_odd[:, None]) + mix(np.asarray([i], dtype=np.uint64))).ravel()
                so_far = value[:, rows].ravel()
                end = (so_far >> high).astype(np.uint32).view(np.float32)
                found = _first_points(own, np.tile(weight[rows], len(own_odd)), floor, top, -np.log(_uniform(own, 0)) / (top - floor), end, 1)
                value[:, rows] = np.minimum(so_far, (so_far & low) | (_bits(found) << high)).reshape(len(own_odd), -1)
            for row, at in zip(value, range(k, k + together)):
                out[full, at] = np.minimum.reduceat(row, starts)
        return out

    def bands(self) -> np.ndarray:
        """texts x BANDS keys."""
        s = self.samples().reshape(len(self.cut) - 1, BANDS, ROWS)
        key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(77)), s.shape[:2]).copy()
        for r in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C55) + s[:, :, r])
        return key


def similarity(a: Shingles, b: Shingles) -> tuple[np.ndarray, np.ndarray]:
    """Weighted and plain Jaccard similarity of text i of ``a`` and text i of ``b``."""
    n = len(a.cut) - 1
    h = np.concatenate((a.hash, b.hash))
    doc = np.concatenate((a.doc, b.doc))
    w = np.exp(np.concatenate((a.level, b.level)) * GRID)
    order = np.lexsort((h, doc))
    h, doc, w = h[order], doc[order], w[order]
    both = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1]))
    shared = np.bincount(doc[both], weights=np.minimum(w[both], w[both + 1]), minlength=n)
    total = np.bincount(doc, weights=w, minlength=n)
    common, all_ = np.bincount(doc[both], minlength=n).astype(float), np.bincount(doc, minlength=n)
    return (
        np.divide(shared, total - shared, out=np.zeros(n), where=total > 0),
        np.divide(common, all_ - common, out=np.zeros(n), where=all_ > 0),
    )


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, k1 and k2 (together 128 bits that stand for the text's words; null without any) and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                words = WordBatch(texts)
                keys = Shingles(words, idf).bands().view(np.int64)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, len(texts) * BANDS + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_halves(words), flat], names=["doc_id", "k1", "k2", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, k1 long, k2 long, bands array<long>")


def _halves(words: WordBatch) -> tuple[pa.Array, pa.Array]:
    keys = words.sequence_keys()
    none = np.asarray([k is None for k in keys])
    both = np.frombuffer(b"".join(k or bytes(16) for k in keys), dtype="<i8").reshape(-1, 2)
    return pa.array(both[:, 0].copy(), mask=none), pa.array(both[:, 1].copy(), mask=none)


def distinct_texts(signed: DataFrame) -> DataFrame:
    """node, k1, k2, rep (smallest doc_id), bands for each distinct text.

    A node is k1, or the next number where two texts have the same k1.
    """
    texts = signed.where(F.col("k1").isNotNull()).groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    place = F.row_number().over(Window.partitionBy("k1").orderBy("k2"))
    return texts.withColumn("node", F.col("k1") + place - 1)


def words_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and compressed words of the texts in ``wanted`` (node, k1, k2).

    The documents are read again and let through by a bitmap of fixed size, so
    texts that no pair needs are not shuffled.
    """
    places = bitmap(wanted.select(F.col("k1").alias("key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, sent = zstandard.ZstdCompressor(level=1), set()
        for batch in batches:
            for part, texts in pieces(batch):
                words = WordBatch(texts)
                keys = words.sequence_keys()
                k1 = np.frombuffer(b"".join(k or bytes(16) for k in keys), dtype="<i8").reshape(-1, 2)
                hit = [i for i in np.flatnonzero(in_bitmap(k1[:, 0].view(np.uint64), places)) if keys[i] is not None and keys[i] not in sent]
                hit = list({keys[i]: i for i in hit}.values())
                if not hit:
                    continue
                sent.update(keys[i] for i in hit)
                if len(sent) > 1 << 18:
                    sent.clear()
                packed = [pack.compress(" ".join(WORD.findall(fold(texts[i]))).encode("utf-8", "surrogatepass")) for i in hit]
                yield pa.RecordBatch.from_arrays([pa.array(k1[hit, 0].copy()), pa.array(k1[hit, 1].copy()), pa.array(packed, pa.binary())], names=["k1", "k2", "words"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "k1 long, k2 long, words binary")
    return found.join(wanted.select("node", "k1", "k2"), ["k1", "k2"]).groupBy("node").agg(F.first("words").alias("words"))


def verified(pairs: DataFrame, words: DataFrame, idf: np.ndarray) -> DataFrame:
    """a, b, weighted and plain similarity and linked (either is at least ``SIMILARITY``) for every pair of nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            open_ = zstandard.ZstdDecompressor()
            for part, a in pieces_of_words(batch, "wa", open_):
                b = [open_.decompress(x).decode("utf-8", "surrogatepass") for x in part.column("wb").to_pylist()]
                s, plain = similarity(Shingles(WordBatch(a), idf), Shingles(WordBatch(b), idf))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(s), pa.array(plain), pa.array(np.maximum(s, plain) >= SIMILARITY)], names=["a", "b", "similarity", "plain", "linked"])

    both = pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a").join(words.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b")
    return both.select("a", "b", "wa", "wb").mapInArrow(run, LINK)


def pieces_of_words(batch: pa.RecordBatch, column: str, open_: zstandard.ZstdDecompressor) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of about 256 kB of compressed words."""
    sizes = np.asarray([len(x) for x in batch.column(column).to_pylist()], dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // (1 << 18)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
    for i, j in zip(edges, edges[1:]):
        s = batch.slice(i, j - i)
        yield s, [open_.decompress(x).decode("utf-8", "surrogatepass") for x in s.column(column).to_pylist()]


def connected(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node of ``links`` (a, b).

    Each node points to its smallest neighbour, pointers are followed to their
    end, and the graph of the ends is treated the same until no link is left.
    """
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    mapping = None
    while not edges.isEmpty():
        up = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"), F.lit(True).alias("moved"))
        up = stored(up, "pointers")
        while True:
            two = up.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            up = stored(up.join(two, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root"), (F.coalesce("_r", "root") != F.col("root")).alias("moved")), "pointers")
            if up.where("moved").isEmpty():
                break
        up = up.select("node", "root")
        if mapping is None:
            mapping = up
        else:
            later = up.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            mapping = stored(mapping.join(later, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root")), "roots")
        one = up.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        other = up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stored(edges.join(one, "a").join(other, "b").where("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    if mapping is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    return mapping


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """key, node, root of the members of buckets in which more than one class is left."""
    m = stored(members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "members")
    mixed = m.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key")
    return stored(m.join(stored(mixed, "buckets"), "key"), "members")


def links(docs: DataFrame, texts: DataFrame, idf: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b, similarity, plain) between distinct texts, and the classes (node, root) they make.

    Links between texts of one class may be left out, links between classes never.
    """
    rows = texts.select("node", F.explode("bands").alias("key"))
    keys = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "buckets")
    members = stored(rows.join(keys, "key").distinct(), "members")
    wanted = members.select("node").distinct().join(texts.select("node", "k1", "k2"), "node")
    words = stored(words_of(docs, stored(wanted, "wanted")), "words")
    spark = docs.sparkSession
    done = spark.createDataFrame([], LINK)
    roots = spark.createDataFrame([], "node long, root long")
    left = members.withColumn("root", F.col("node"))
    for turn in range(ROUNDS):
        chosen = F.min_by(F.struct("node", "root"), F.xxhash64("node", F.lit(turn)) if turn else F.col("node"))
        pivots = stored(left.groupBy("key").agg(chosen.alias("p")).select("key", F.col("p.node").alias("n2"), F.col("p.root").alias("r2")), "pivots")
        pairs = _pairs(left.join(pivots, "key").where("root != r2"), done)
        if pairs.isEmpty():
            continue
        new = stored(verified(pairs, words, idf), "verified")
        done = done.unionByName(new)
        if not new.where("linked").isEmpty():
            roots = connected(done.where("linked"))
            left = _rooted(members, roots)
    sizes = stored(left.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    small = stored(left.join(sizes.where(F.col("n") <= SMALL).select("key"), "key"), "members")
    other = small.select("key", F.col("node").alias("n2"), F.col("root").alias("r2"))
    pairs = _pairs(small.join(other, "key").where("root < r2"), done)
    last = [verified(pairs, words, idf)] if not pairs.isEmpty() else []
    large = sizes.where(F.col("n") > SMALL).select("key")
    if not large.isEmpty():
        last.append(merging_links(stored(left.join(large, "key"), "members"), words, idf))
    for new in last:
        new = stored(new, "verified")
        if not new.where("linked").isEmpty():
            done = done.unionByName(new)
            roots = None
    return done.where("linked").drop("linked"), connected(done.where("linked")) if roots is None else roots


def _pairs(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Distinct pairs a < b of node and n2 that are not decided yet."""
    pairs = rows.select(F.least("node", "n2").alias("a"), F.greatest("node", "n2").alias("b")).distinct()
    return stored(pairs.join(done.select("a", "b"), ["a", "b"], "left_anti"), "pairs")


def merging_links(left: DataFrame, words: DataFrame, idf: np.ndarray) -> DataFrame:
    """Links between the classes of each bucket in ``left`` (key, node, root), found block by block.

    Texts outside a bucket's largest class meet all its texts. Both sides are
    dealt to blocks by hash, so a task holds ``BLOCK_A`` and ``BLOCK_B`` texts
    of a bucket, about, however large the bucket is.
    """
    shares = stored(left.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")), "shares")
    top = shares.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("top"), F.max("n").alias("most"), F.sum("n").alias("n"))
    top = top.select("key", "top", F.ceil((F.col("n") - F.col("most")) / BLOCK_A).cast("int").alias("na"), F.ceil(F.col("n") / BLOCK_B).cast("int").alias("nb"))
    rows = left.join(stored(top, "shares"), "key")
    own_a, own_b = F.pmod(F.xxhash64("node", F.lit("a")), F.col("na")).cast("int"), F.pmod(F.xxhash64("node", F.lit("b")), F.col("nb")).cast("int")
    a = rows.where("root != top").select("key", "node", "root", own_a.alias("ia"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("ib"), F.lit(True).alias("first"))
    b = rows.select("key", "node", "root", F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("ia"), own_b.alias("ib"), F.lit(False).alias("first"))

    def compare(t: pa.Table) -> pa.Table:
        open_ = zstandard.ZstdDecompressor()
        t = t.combine_chunks()
        first = t.column("first").to_numpy().astype(bool)
        node, root = t.column("node").to_numpy(), t.column("root").to_numpy()
        own = Shingles(WordBatch([open_.decompress(x).decode("utf-8", "surrogatepass") for x in t.column("words").to_pylist()]), idf)
        found = block_similarities(own, np.flatnonzero(first), np.flatnonzero(~first), root)
        parent: dict[int, int] = {}

        def end(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        out = []
        for i, j, s, plain in found:
            x, y = end(int(root[i])), end(int(root[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((min(node[i], node[j]), max(node[i], node[j]), s, plain, True))
        cols = list(zip(*out)) or [[]] * 5
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()))], names=["a", "b", "similarity", "plain", "linked"])

    both = a.unionByName(b).join(words, "node")
    return both.groupBy("key", "ia", "ib").applyInArrow(compare, LINK)


def block_similarities(own: Shingles, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> list[tuple[int, int, float, float]]:
    """(i, j, weighted, plain similarity) of the linked texts i of ``a`` and j of ``b`` with different roots.

    The smaller of two weights is a sum over weight steps that both reach, so
    one product of (text x shingle step) matrices gives all shared weights; the
    columns of lowest steps alone give the shared shingles.
    """
    n = len(own.cut) - 1
    w = np.exp(own.level * GRID)
    total = np.bincount(own.doc, weights=w, minlength=n)
    order = np.lexsort((own.level, own.hash))
    h, level, doc = own.hash[order], own.level[order], own.doc[order]
    new_h = np.append(True, h[1:] != h[:-1])
    new = new_h | np.append(True, level[1:] != level[:-1])
    step = np.cumsum(new) - 1  # one column for each weight of a shingle
    at = np.flatnonzero(new)
    value = np.exp(level[at] * GRID)
    value[1:] -= np.where(new_h[at[1:]], 0.0, np.exp(level[at[:-1]] * GRID))
    lowest = step[np.maximum.accumulate(np.where(new_h, np.arange(len(h)), 0))]
    reach = step - lowest + 1  # an entry is in the columns of all lower weights too
    col = np.repeat(lowest, reach) + np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach)
    row = np.repeat(doc, reach)
    shared = np.bincount(col, minlength=len(at)) > 1
    place = np.cumsum(shared) - 1
    keep = shared[col]
    col, row, value = place[col[keep]], row[keep], np.sqrt(value[shared])
    by = np.argsort(col, kind="stable")
    col, row = col[by], row[by]
    lowest_step = (new_h[at])[shared]
    both, common = np.zeros((len(a), len(b))), np.zeros((len(a), len(b)))
    for lo in range(0, len(value), 2048):
        i, j = np.searchsorted(col, (lo, lo + 2048))
        m = np.zeros((n, min(2048, len(value) - lo)), dtype=np.float32)
        m[row[i:j], col[i:j] - lo] = value[col[i:j]]
        both += m[a] @ m[b].T
        held = (m[:, lowest_step[lo : lo + 2048]] > 0).astype(np.float32)
        common += held[a] @ held[b].T
    size = np.diff(own.cut)
    least = SIMILARITY - 1e-3
    close = (both >= least * (total[a][:, None] + total[b][None, :] - both)) | (common >= least * (size[a][:, None] + size[b][None, :] - common))
    x, y = np.nonzero(close & (root[a][:, None] != root[b][None, :]))
    out = []
    for i, j in zip(a[x].tolist(), b[y].tolist()):
        s, plain = _similarity_of(own, i, j)
        if max(s, plain) >= SIMILARITY:
            out.append((i, j, s, plain))
    return out


def _similarity_of(own: Shingles, i: int, j: int) -> tuple[float, float]:
    a, b = slice(own.cut[i], own.cut[i + 1]), slice(own.cut[j], own.cut[j + 1])
    wa, wb = np.exp(own.level[a] * GRID), np.exp(own.level[b] * GRID)
    _, x, y = np.intersect1d(own.hash[a], own.hash[b], assume_unique=True, return_indices=True)
    shared = np.minimum(wa[x], wb[y]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared)), len(x) / (len(wa) + len(wb) - len(x))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), and k1, k2 of every document."""
    idf = inverse_frequencies(docs)
    signed = stored(signatures(docs, idf), "signatures")
    texts = stored(distinct_texts(signed), "texts")
    _, roots = links(docs, texts, idf)
    reps = texts.select("node", "k1", "k2", "rep").join(roots, "node")
    smallest = stored(reps.groupBy("root").agg(F.min("rep").alias("class_id")), "classes")
    joined = stored(reps.join(smallest, "root").select("k1", "k2", "class_id"), "classes")
    named = stored(texts.select("k1", "k2", "rep").join(joined, ["k1", "k2"], "left").select("k1", "k2", F.coalesce("class_id", "rep").alias("class_id")), "classes")
    rows = signed.select("doc_id", "k1", "k2")
    return rows.join(named, ["k1", "k2"], "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "k1", "k2")


def _row_keys(doc_id: pa.Array, k1: np.ndarray) -> np.ndarray:
    """One 64-bit value for each row's doc_id and words."""
    ids = doc_id.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    return mix(ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C55) ^ k1.view(np.uint64))


def _let_through(docs: DataFrame, places: np.ndarray, wanted: bool) -> DataFrame:
    """The rows of ``docs`` that the bitmap lets through, or the others, with their words' keys in ``__k1``, ``__k2``."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    names, at, own_id = docs.columns, docs.columns.index("text"), docs.columns.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part, texts in pieces(named, f"c{at}"):
                k1, k2 = _halves(WordBatch(texts))
                hit = in_bitmap(_row_keys(part.column(own_id), k1.fill_null(0).to_numpy(zero_copy_only=False)), places) & k1.is_valid().to_numpy(zero_copy_only=False)
                rows = pa.RecordBatch.from_arrays([*part.columns, k1, k2], names=[*names, "__k1", "__k2"])
                yield rows.filter(pa.array(hit == wanted))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__k1", T.LongType()), T.StructField("__k2", T.LongType())]))


def _gone_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _row_keys(batch.column("__d"), batch.column("__g1").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest doc_id; all columns as they were.

    Of rows equal in doc_id and words one stays, the first by a hash of all
    columns; rows without a doc_id or without words stay. A bitmap of fixed
    size keeps apart the rows that may have to go: only these are joined with
    the list of what goes, all others stay where they are.
    """
    columns = docs.columns
    own = ["doc_id", "class_id", "k1", "k2"]
    found = classes(docs).where("doc_id is not null and k1 is not null").groupBy(*own).agg(F.count(F.lit(1)).alias("n"))
    found = found.where("class_id != doc_id or n > 1")
    some = stored(found.select(F.col("doc_id").alias("__d"), F.col("k1").alias("__g1"), F.col("k2").alias("__g2"), (F.col("class_id") == F.col("doc_id")).alias("__one")), "gone")
    places = bitmap(some.mapInArrow(_gone_keys, "key long"))
    same = (F.col("doc_id").cast("long") == F.col("__d")) & (F.col("__k1") == F.col("__g1")) & (F.col("__k2") == F.col("__g2"))
    asked = _let_through(docs, places, True).join(some, same, "left").where(F.coalesce("__one", F.lit(True)))
    asked = stored(asked.drop("__k1", "__k2"), "asked")
    order = Window.partitionBy("__d", "__g1", "__g2").orderBy(F.xxhash64(F.to_json(F.struct(*columns))))
    first = asked.where("__one").withColumn("__n", F.row_number().over(order)).where("__n = 1")
    kept = asked.where("__one is null").select(*columns).unionByName(first.select(*columns))
    return _let_through(docs, places, False).drop("__k1", "__k2").unionByName(kept)
