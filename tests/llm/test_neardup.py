from collections import Counter

import numpy as np
import pytest

from revgraph.llm import neardup
from revgraph.llm.common import WORD, WordBatch, fold

RNG = np.random.default_rng(11)
VOCABULARY = [f"w{i}" for i in range(3000)]


def prose(n):
    return [VOCABULARY[i] for i in RNG.zipf(1.3, n) % len(VOCABULARY)]


def edited(words, times):
    words = list(words)
    for _ in range(times):
        words[int(RNG.integers(len(words)))] = f"new{int(RNG.integers(10**9))}"
    return words


def corpus():
    rows, base, passage = [], prose(150), prose(60)
    rows += [" ".join(edited(base, int(RNG.integers(0, 6)))) for _ in range(60)]  # a large group of near copies
    rows += [" ".join(passage + prose(60)) for _ in range(40)]  # a passage that many share
    for _ in range(40):
        p = prose(int(RNG.integers(20, 300)))
        rows += [" ".join(p), " ".join(edited(p, int(RNG.integers(1, 4))))]
    rows += ["one two three", "one two three", "One, two; THREE!", "one two four", "five", "FIVE", "", "", None, "...", None, "x " * 3000, "x " * 3001]
    return [(i, t) for i, t in enumerate(rows)]


def brute_force(rows, idf):
    """Classes by weighted or plain Jaccard similarity of all pairs, from the definition."""
    shingles = []
    for _, t in rows:
        words = WORD.findall(fold(t or ""))
        h = WordBatch([" ".join(words)]).hash
        w = [float(idf[b]) for b in neardup.bucket(h)]
        n = min(neardup.SHINGLE, len(words))
        times = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()
        mean = {tuple(words[i : i + n]): sum(w[i : i + n]) / n for i in range(len(words) - n + 1)} if n else {}
        shingles.append({s: np.exp(np.floor(np.log(max(c * mean[s], 1)) / neardup.GRID + 1e-9) * neardup.GRID) for s, c in times.items()})
    parent = list(range(len(rows)))

    def end(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(shingles):
        for j in range(i):
            b = shingles[j]
            if a and b and (a.keys() & b.keys()):
                shared = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
                plain = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
                if max(plain, shared / (sum(a.values()) + sum(b.values()) - shared)) >= neardup.SIMILARITY:
                    x, y = end(i), end(j)
                    parent[max(x, y)] = min(x, y)
    return [rows[end(i)][0] for i in range(len(rows))]


@pytest.mark.parametrize("small", [16, 3])
def test_classes_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "BLOCK_A", 8)
    monkeypatch.setattr(neardup, "BLOCK_B", 8)
    rows = corpus()
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, class_id string").repartition(5)
    want = brute_force(rows, neardup.inverse_frequencies(df))
    got = {r.doc_id: r.class_id for r in neardup.classes(df).collect()}
    assert [got[i] for i, _ in rows] == want
    assert len(set(want)) < len(rows) - 50


def test_block_products_equal_pairwise_similarity():
    texts = [" ".join(edited(p, 2)) for p in (prose(80), prose(30), ["a"] * 9 + prose(20)) for _ in range(5)]
    words = WordBatch(texts)
    idf = RNG.uniform(1, 10, neardup.BUCKETS).astype(np.float32)
    own = neardup.Shingles(words, idf)
    found = {(i, j): (s, plain) for i, j, s, plain in neardup.block_similarities(own, np.arange(7), np.arange(15), np.arange(15))}
    for i in range(7):
        for j in range(15):
            s = [float(x[0]) for x in neardup.similarity(neardup.Shingles(WordBatch([texts[i]]), idf), neardup.Shingles(WordBatch([texts[j]]), idf))]
            assert ((i, j) in found) == (i != j and max(s) >= neardup.SIMILARITY)
            assert (i, j) not in found or found[i, j] == pytest.approx(s)


def test_samples_agree_as_often_as_texts_are_similar():
    a, idf = prose(300), np.full(neardup.BUCKETS, 5.0, np.float32)
    texts = [" ".join(a), " ".join(edited(a, 12)), " ".join(prose(300))]
    own = neardup.Shingles(WordBatch(texts), idf)
    s = own.samples()
    true = neardup._similarity_of(own, 0, 1)[0]
    assert abs((s[0] == s[1]).mean() - true) < 0.15
    assert (s[0] == s[2]).mean() < 0.1


def _shingles(hashes, levels):
    own = neardup.Shingles.__new__(neardup.Shingles)
    order = [np.argsort(h) for h in hashes]
    own.hash = np.concatenate([h[o] for h, o in zip(hashes, order)])
    own.level = np.concatenate([v[o] for v, o in zip(levels, order)])
    own.doc = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    own.cut = np.cumsum([0, *map(len, hashes)])
    return own


@pytest.mark.parametrize("n", [3, 300, 30_000, 1_500_000])
def test_samples_agree_in_texts_of_any_length(n):
    """Shingles of edited places are rarer, hence heavier; some are repeated, hence much heavier."""
    rng = np.random.default_rng(n)
    h = rng.integers(0, 2**63, n + 2 * (n // 10 + 1)).astype(np.uint64) * np.uint64(2)
    level = rng.integers(14, 20, len(h))
    level[n:] = 25
    level[: n // 50] += 40
    e = n // 10 + 1
    own = _shingles([h[: n + e], np.concatenate((h[:n], h[n + e :]))], [level[: n + e], np.concatenate((level[:n], level[n + e :]))])
    w = np.exp(level * neardup.GRID)
    true = w[:n].sum() / w.sum()
    s = own.samples()
    assert abs((s[0] == s[1]).mean() - true) < 4 * (true * (1 - true) / s.shape[1]) ** 0.5 + 0.01


def test_sampling_follows_weights():
    rng = np.random.default_rng(1)
    for a, b in ((0, 0), (5, 25), (20, 31), (30, 33), (31, 70), (64, 66), (100, 140)):
        pair = [rng.integers(0, 2**63, 400).astype(np.uint64) for _ in range(2)]
        # One shingle against another, and against itself in another weight.
        many = _shingles([np.asarray([x, y]) for x, y in zip(*pair)], [np.asarray([a, b])] * 400)
        wins = many.samples() & np.uint64(0xFFFFFFFF)
        odd = neardup.mix(np.arange(1, neardup.BANDS * neardup.ROWS + 1, dtype=np.uint64)) | np.uint64(1)
        low = ((pair[0][:, None] * odd[None, :]) >> np.uint64(8)) & np.uint64(0xFFFFFFFF)
        assert abs((wins == low).mean() - 1 / (1 + np.exp((b - a) * neardup.GRID))) < 0.01
        one = [_shingles([np.asarray([x]) for x in pair[0]], [np.asarray([v])] * 400).samples() for v in (a, b)]
        assert abs((one[0] == one[1]).mean() - np.exp((a - b) * neardup.GRID)) < 0.01


def test_connected_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (7, 6), (4, 5), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20)]
    got = {r.node: r.root for r in neardup.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 12: 10, 6: 6, 7: 6, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20}
    chain = spark.range(1, 200).selectExpr("(id * 7919) % 1009 as a", "((id + 1) * 7919) % 1009 as b")
    assert neardup.connected(chain).select("root").distinct().count() == 1


def test_ids_that_repeat_or_are_missing(spark):
    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "x"), (1, "other words stand here now", "y"), (2, "A b c d e f g!", "z"), (None, "a b c d e f g", "n"), (3, None, "w"), (4, "", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, k1 string")
    kept = neardup.representatives(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.k1) for r in kept.collect()) == [(0, "n"), (1, "x"), (1, "y"), (3, "w"), (4, "w")]
    assert neardup.classes(df.limit(0)).count() == 0 and neardup.representatives(df.limit(0)).count() == 0
