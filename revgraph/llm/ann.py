"""Approximate nearest neighbours by largest inner product, with an adaptive dimension scan.

Vectors get one more component that makes all of them equally long, so the
largest inner product is the smallest distance. A random rotation spreads the
distance evenly over the components, and k-means lists (learned on a bounded
sample, every vector assigned) cut the space. A query probes the nearest lists
until they hold ``SHARE`` of all vectors. Within a list the components are
scanned in blocks of ``COLUMNS``: after each block a candidate is abandoned if
its distance so far, scaled up to all components, is beyond the distance of
the k-th neighbour known by more than a test at ``ERROR`` allows, and only the
candidates still alive are looked up in the next block. The nearest lists, with
``FIRST`` of all vectors, are scanned first and give each query its bound for
the others.

Survivors get the exact inner product of the original vectors, summed in
double precision in the order of the components.

Defined results: vectors that are null, zero, hold null or non-finite
components, have no id, or have another length than most (ties: the longer)
take no part; rows that share an id are one vector (the smallest in order of
components); equal scores rank by the smaller id; a query with fewer than k
candidates gets all of them; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revgraph.llm.common import stored

#: Share of all vectors in the lists that a query probes, and in those that it probes first.
SHARE, FIRST = 0.95, 0.1
#: Width of the hypothesis test that abandons a candidate.
ERROR = 0.85
COLUMNS = 8
#: Bounds: lists, sample vectors a list for learning, rounds of k-means, rows of a task on either side.
LISTS, SAMPLE_EACH, KMEANS_ROUNDS = 4096, 32, 10
BLOCK_VECTORS, BLOCK_QUERIES = 4096, 512
#: Pairs looked at one by one at a time.
PAIRS = 1 << 18


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part, one row for each id."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(x, lambda v: v != 0)
    df = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & fine)
    width = df.groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).limit(1)
    df = df.join(F.broadcast(width.select("width")), F.size("embedding") == F.col("width")).drop("width")
    return df.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


class Lists:
    """Rotation and list centres."""

    def __init__(self, sample: np.ndarray, longest: float, count: int):
        rng = np.random.default_rng(5)
        d = sample.shape[1] + 1
        self.longest = longest
        self.rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
        x = self.lift(sample)
        self.centres = x[rng.choice(len(x), min(count, len(x)), replace=False)]
        for _ in range(KMEANS_ROUNDS):
            own = self.nearest(x)
            n = np.bincount(own, minlength=len(self.centres))
            total = np.zeros_like(self.centres)
            np.add.at(total, own, x)
            self.centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], self.centres)

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Rotated vectors with the component that evens out lengths; a query's is 0."""
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0))
        return np.column_stack([x, more]) @ self.rotation

    def distances(self, x: np.ndarray) -> np.ndarray:
        return (x * x).sum(axis=1)[:, None] + (self.centres**2).sum(axis=1)[None, :] - 2 * x @ self.centres.T

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.distances(x[i : i + 4096]).argmin(axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.empty(0, np.int64)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def learn(vectors: DataFrame) -> Lists | None:
    """Lists for ``vectors`` (as ``usable`` gives them), from at most LISTS * SAMPLE_EACH of them."""
    stats = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v)).alias("longest")).first()
    if not stats["n"]:
        return None
    count = int(min(LISTS, max(1, stats["n"] // 8 if stats["n"] < 256 else 32, round(stats["n"] ** 0.5 / 4))))
    some = count * SAMPLE_EACH
    share = min(1.0, (some + 8 * some**0.5) / stats["n"])
    place = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 52)) / float(1 << 52)
    rows = vectors.where(place <= share).orderBy(place, "vec_id").limit(some).toArrow()
    return Lists(_matrix(rows.column("embedding")), float(stats["longest"]) ** 0.5 * (1 + 1e-9), count)


def assign(vectors: DataFrame, lists: Lists) -> DataFrame:
    """vec_id, embedding and the list of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = lists.nearest(lists.lift(_matrix(batch.column("embedding"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=["vec_id", "embedding", "list"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, embedding array<double>, list int")


def probes(queries: DataFrame, lists: Lists, sizes: np.ndarray, k: int) -> DataFrame:
    """vec_id, embedding, list and place (0 for the nearest lists, else 1) of the lists that each query probes."""
    least, first = max(SHARE * sizes.sum(), k + 1), max(FIRST * sizes.sum(), k + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = lists.distances(lists.lift(_matrix(batch.column("embedding")), query=True)).argsort(axis=1, kind="stable")
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            row, place = np.nonzero((before < least) & (sizes[order] > 0))
            own = order[row, place]
            rank = np.where(before[row, place] < first, 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(row)), batch.column("embedding").take(pa.array(row)), pa.array(own.astype(np.int32)), pa.array(rank.astype(np.int32))], names=["vec_id", "embedding", "list", "place"])

    return queries.select("vec_id", "embedding").mapInArrow(run, "vec_id long, embedding array<double>, list int, place int")


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in the order of the components: equal vectors get equal scores wherever they are."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def scan(q: np.ndarray, x: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Adaptive scan of lifted queries and vectors: surviving (query, vector) pairs in the order of the
    queries, their squared distances, and the number of products of components that it took.

    ``bound`` holds each query's squared distance to beat (infinite if none is known).
    """
    d, products = q.shape[1], 0
    if len(x) > k and not np.isfinite(bound).all():  # the distances to a first few vectors bound those to the others
        some = (q * q).sum(axis=1)[:, None] + (x[: 4 * k] ** 2).sum(axis=1)[None, :] - 2 * q @ x[: 4 * k].T
        products += some.size * d
        bound = np.minimum(bound, np.partition(some, k - 1, axis=1)[:, k - 1])
    bound = np.maximum(bound, 0)
    edges = [*range(0, d, COLUMNS), d]
    blocks = [np.ascontiguousarray(x[:, lo:hi]) for lo, hi in zip(edges, edges[1:])]
    norms = (blocks[0] ** 2).sum(axis=1)
    found = []
    for r in range(len(q)):
        live = values = None
        for b, lo, hi in zip(blocks, edges, edges[1:]):
            a = q[r, lo:hi]
            test = (1 + ERROR / hi**0.5) ** 2 if hi < d else 1.0
            limit = bound[r] * test * hi / d * (1 + 1e-9) + 1e-12
            if live is None:
                products += b.size
                part = np.maximum(norms - 2 * (b @ a) + a @ a, 0)
                live = np.flatnonzero(part <= limit)
                values = part[live]
            else:
                products += len(live) * (hi - lo)
                diff = b[live] - a
                values += np.einsum("ij,ij->i", diff, diff)
                ok = values <= limit
                live, values = live[ok], values[ok]
            if not len(live):
                break
        found.append((np.full(len(live), r), live, values))
    i, j, dist = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    return i, j, dist, products


FOUND = "query_id long, vec_id long, score double"


def _search(vectors: DataFrame, asked: DataFrame, lists: Lists, sizes: np.ndarray, k: int) -> DataFrame:
    """query_id, vec_id, score: for each query the k best of each block of each list in ``asked``, or all that beat its bound.

    ``asked`` has vec_id, embedding, list and bound. Both sides of a list are
    dealt to blocks, so a list of any size spreads over many tasks.
    """
    queries = {r["list"]: r["n"] for r in asked.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most LISTS rows
    blocks = F.create_map(*[F.lit(int(v)) for i, n in enumerate(sizes) for v in (i, max(1, -(-int(n) // BLOCK_VECTORS)))])
    shares = F.create_map(*[F.lit(int(v)) for i in range(len(sizes)) for v in (i, max(1, -(-queries.get(i, 0) // BLOCK_QUERIES)))])
    asked_lists = [int(i) for i in queries]
    nb, nq = blocks[F.col("list")], shares[F.col("list")]
    own_b, own_q = F.pmod(F.xxhash64("vec_id", F.lit("b")), nb).cast("int"), F.pmod(F.xxhash64("vec_id", F.lit("q")), nq).cast("int")
    side_b = vectors.where(F.col("list").isin(asked_lists)).select("vec_id", "embedding", "list", own_b.alias("b"), F.explode(F.sequence(F.lit(0), nq - 1)).alias("q"), F.lit(None).cast("double").alias("bound"))
    side_q = asked.select("vec_id", "embedding", "list", F.explode(F.sequence(F.lit(0), nb - 1)).alias("b"), own_q.alias("q"), "bound")

    def compare(t: pa.Table) -> pa.Table:
        is_query = t.column("bound").is_valid().to_numpy()
        ids, m = t.column("vec_id").to_numpy(), _matrix(t.column("embedding"))
        bound = t.column("bound").to_numpy()[is_query]
        qid, vid, qm, vm = ids[is_query], ids[~is_query], m[is_query], m[~is_query]
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(qid) and len(vid):
            lifted = lists.lift(vm)
            for at in range(0, len(qid), 64):
                s = slice(at, at + 64)
                i, j, dist, _ = scan(lists.lift(qm[s], query=True), lifted, bound[s], k + 1)
                ok = qid[s][i] != vid[j]
                i, j, dist = i[ok], j[ok], dist[ok]
                order = np.lexsort((dist, i))
                i, j, dist = i[order], j[order], dist[order]
                start = np.searchsorted(i, np.arange(len(qid[s])))
                kth = np.full(len(qid[s]), np.inf)
                n = np.bincount(i, minlength=len(kth))
                kth[n >= k] = dist[start[n >= k] + k - 1]
                near = dist <= kth[i] * (1 + 1e-9) + 1e-9  # ties stay until their exact scores are known
                i, j = i[near], j[near]
                score = np.concatenate([inner_products(qm[s][i[a : a + PAIRS]], vm[j[a : a + PAIRS]]) for a in range(0, len(i), PAIRS)]) if len(i) else np.empty(0)
                order = np.lexsort((vid[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                top = np.arange(len(i)) - np.searchsorted(i, i) < k
                out.append((qid[s][i[top]], vid[j[top]], score[top]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table([pa.array(c) for c in cols], names=["query_id", "vec_id", "score"])

    return side_q.unionByName(side_b).groupBy("list", "b", "q").applyInArrow(compare, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every vector that ``is_query`` (over vec_id) names."""
    rows = stored(usable(vectors), "vectors")
    lists = learn(rows)
    if lists is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    listed = stored(assign(rows, lists), "lists")
    sizes = np.zeros(len(lists.centres), dtype=np.int64)
    for r in listed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():  # at most LISTS rows
        sizes[r["list"]] = r["n"]
    asked = stored(probes(rows.where(is_query), lists, sizes, k), "probes")
    first = stored(_best(_search(listed, asked.where("place = 0").withColumn("bound", F.lit(float("inf"))), lists, sizes, k), k), "nearest")
    # The k-th score known bounds the squared distance: |q|^2 + longest^2 - 2 score.
    known = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("_s"))
    own = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v)
    rest = asked.where("place > 0").join(known, "vec_id", "left")
    rest = rest.withColumn("bound", F.coalesce((own + F.lit(lists.longest**2) - 2 * F.col("_s")) * (1 + 1e-12) + 1e-9, F.lit(float("inf")))).drop("_s")
    more = _search(listed, stored(rest, "probes"), lists, sizes, k)
    return _best(first.select("query_id", "vec_id", "score").unionByName(more), k).select("query_id", "rank", "vec_id", "score")
