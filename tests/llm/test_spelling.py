"""Spelling variants against every pair of words."""

import random
import zlib
from collections import Counter

import pytest
import regex

from revgraph.llm import spelling


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))


def brute(docs, least_count=5, least_length=6, damage=199):
    counts = Counter()
    for doc_id, text in docs:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    form = {}
    out = []
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        out.append((w, n, len(others)))
    rows = set()
    for w, n, k in out:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, k, words[form[w]] if form[w] else None))
    return rows


def got(spark, docs, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = [tuple(r) for r in spelling.variants(df, **kw).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def edit(rng, w, alphabet):
    i, kind = rng.randrange(len(w) + 1), rng.random()
    if kind < 0.34:
        return w[:i] + rng.choice(alphabet) + w[i:]
    return w[:i] + w[i + 1 :] if kind < 0.67 else w[:i] + rng.choice(alphabet) + w[i + 1 :]


@pytest.mark.parametrize("hot", [512, 3, 0])
def test_equals_every_pair(spark, hot):
    """Few letters, so that words have runs of one letter, near words by several edits, and hot grams."""
    rng = random.Random(hot)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))) for _ in range(60)]
    words += [edit(rng, rng.choice(words), "abé") for _ in range(120)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "bbbbbb", "bbbbbbb"]
    words += ["abcdef" * 20, "abcdef" * 19 + "abcdeg", "abcdef" * 20 + "x"]
    texts = []
    for w in words:
        texts += [w] * rng.choice([4, 5, 6, 30, 200])
    rng.shuffle(texts)
    docs = [(i, " ".join(texts[i::20])) for i in range(20)]
    want = brute(docs)
    assert len(want) > 50 and any(r[1] for r in want) and any(r[1] != r[2] for r in want if r[1])
    assert got(spark, docs, hot=hot) == want


def test_chain_of_forms(spark):
    docs = [(1, " ".join(["planet"] * 700 + ["planets"] * 130 + ["planetse"] * 25 + ["planetsee"] * 5))]
    rows = {r[0]: r for r in got(spark, docs, damage=None)}
    assert rows["planetsee"][1:3] == ("planetse", "planet") and rows["planets"][1:] == ("planet", "planet", 130, 2, 700)


def test_ties_and_damage(spark):
    """Equal counts: the smaller word in code-point order; case folds A-Z only."""
    docs = [(i, " ".join(["GardenÉ"] * 2 + ["gardens"] * 40 + ["gardene"] * 40 + ["gardené"] * 3)) for i in range(400)]
    assert got(spark, docs) == brute(docs)
    rows = {r[0]: r for r in got(spark, docs)}
    assert "gardenÉ" in rows and "gardené" in rows
    rows = {r[0]: r for r in got(spark, docs, damage=None)}
    assert rows["gardenÉ"][1] == "gardene" and rows["gardenÉ"][5] == rows["gardens"][3]


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    long = "wonderful wondreful " * 30_000
    docs = [(1, None), (2, ""), (None, "orange " * 9), (3, "orange " * 9), (3, "orange " * 9), (4, long), (5, "..,;123")]
    assert got(spark, docs) == brute(docs)
    names = "doc_id long, text string, word string, n long, len int, at int, gram string, a string, runs string, root string"
    wide = spark.createDataFrame([(*d, "x", 1, 2, 3, "y", "z", "r", "s") for d in docs], names)
    assert {tuple(r) for r in spelling.variants(wide).collect()} == brute(docs)
    assert got(spark, []) == set()


def test_hot_keys_send_few_rows(spark):
    """Two thousand words share their first half: no step makes a share of all their pairs."""
    words = [(f"{'q' * 12}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{'z' * 9}", 5) for i in range(2000)]
    voc = spark.createDataFrame(words, "word string, n long")
    pairs = {(r.a, r.b) for r in spelling.near_pairs(voc, hot=64).select("a", "b").collect()}
    names = [w for w, _ in words]
    assert pairs == {(a, b) for i, a in enumerate(sorted(names)) for b in sorted(names)[i + 1 :] if near(a, b)}
    rests = spelling._rests(spelling.chunks(voc), spelling.F.col("at"), False)
    assert rests.count() <= 2 * len(words) * 24
