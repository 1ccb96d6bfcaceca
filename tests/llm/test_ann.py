import numpy as np
import pyarrow.parquet as pq
import pytest

from revgraph.llm import ann, queries

SF = "/root/testdata/sf0.01"


def inner(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def best(vectors, q, k):
    """ids and scores of the k largest inner products, summed component by component."""
    scored = sorted(((-inner(vectors[q], x), i) for i, x in vectors.items() if i != q))[:k]
    return [(i, -s) for s, i in scored]


def test_recall_and_exact_scores(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet")
    vectors = dict(zip(t.column("vec_id").to_pylist(), t.column("embedding").to_pylist()))
    got = {}
    for r in sorted(queries.op5_ann(spark, SF).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r.rank))
    assert set(got) == {i for i in vectors if i % 20 == 0}
    hits = total = 0
    for q, own in got.items():
        want = best(vectors, q, 20)
        hits += len({i for i, _ in want} & {i for i, _, _ in own})
        total += 20
        assert [r for _, _, r in own] == list(range(1, 21))
        for i, s, _ in own:
            assert s == inner(vectors[q], vectors[i])
    assert hits / total >= 0.9


def test_ties_copies_and_hot_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 40)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 5)
    rng = np.random.default_rng(1)
    vectors = {i: [1.0, 2.0, 3.0] if i % 2 else rng.standard_normal(3).round(2).tolist() for i in range(400)}
    df = spark.createDataFrame([(i, x, 9) for i, x in vectors.items()], "vec_id long, embedding array<float>, rank int")
    exact = {i: [float(np.float32(v)) for v in x] for i, x in vectors.items()}
    monkeypatch.setattr(ann, "SHARE", 1.0)
    monkeypatch.setattr(ann, "ERROR", 1e6)  # then the search is exact
    from pyspark.sql import functions as F

    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 < 2, 7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert len(got) == 40
    for q, own in got.items():
        assert [(i, s) for _, i, s in sorted(own)] == best(exact, q, 7)


def test_vectors_that_take_no_part(spark):
    from pyspark.sql import functions as F

    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [-1.0, 0.0]), (1, [0.5, 0.5]), (9, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(df, F.col("vec_id") % 2 == 0, 5).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 8, -1.0), (8, 1, 1, -0.5), (8, 2, 0, -1.0)]
    assert ann.search(df.limit(0), F.lit(True)).count() == 0
    assert ann.search(df.where("vec_id = 0"), F.lit(True)).count() == 0


@pytest.mark.parametrize("columns, error", [(16, 2.1), (3, 2.1)])
def test_scan_keeps_all_within_the_bound(monkeypatch, columns, error):
    monkeypatch.setattr(ann, "COLUMNS", columns)
    monkeypatch.setattr(ann, "ERROR", error)
    rng = np.random.default_rng(0)
    q, x = rng.standard_normal((5, 33)), rng.standard_normal((400, 33))
    true = ((q[:, None, :] - x[None]) ** 2).sum(axis=2)
    i, j, dist, _ = ann.scan(q, x, np.full(5, np.inf), 10)
    assert dist == pytest.approx(true[i, j])
    kept = set(zip(i.tolist(), j.tolist()))
    near = {(a, int(b)) for a in range(5) for b in true[a].argsort()[:10]}
    assert len(near & kept) >= 0.95 * len(near) and len(kept) < 1000


def test_candidates_are_abandoned_early():
    """Products of components done on sf0.1 with the bounds that the first lists give, against those of all pairs."""
    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").sort_by("vec_id")
    x = np.asarray(t.column("embedding").to_pylist(), dtype=np.float64)
    queries_at = np.flatnonzero(t.column("vec_id").to_numpy() % 20 == 0)
    longest = (x * x).sum(axis=1).max() ** 0.5 * (1 + 1e-9)
    lists = ann.Lists(x[:352], longest, 11)
    lifted, asked, own = lists.lift(x), lists.lift(x[queries_at], query=True), lists.nearest(lists.lift(x))
    order = lists.distances(asked).argsort(axis=1, kind="stable")
    sizes = np.bincount(own, minlength=len(lists.centres))
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    done = hits = 0
    for r, at in enumerate(queries_at):
        first = np.flatnonzero(np.isin(own, order[r][before[r] < ann.FIRST * len(x)]))
        rest = np.flatnonzero(np.isin(own, order[r][(before[r] >= ann.FIRST * len(x)) & (before[r] < ann.SHARE * len(x))]))
        _, j, dist, n = ann.scan(asked[r : r + 1], lifted[first], np.array([np.inf]), 21)
        seen = dict(zip(first[j].tolist(), dist.tolist()))
        bound = sorted(v for i, v in seen.items() if i != at)[19]
        _, j, dist, m = ann.scan(asked[r : r + 1], lifted[rest], np.array([bound]), 21)
        seen.update(zip(rest[j].tolist(), dist.tolist()))
        done += n + m
        score = x @ x[at]
        score[at] = -np.inf
        best = sorted((v, i) for i, v in seen.items() if i != at)[:20]
        hits += len({i for _, i in best} & set(score.argsort()[-20:].tolist()))
    assert done <= 0.6 * len(queries_at) * x.shape[0] * lifted.shape[1]
    assert hits >= 0.95 * 20 * len(queries_at)
