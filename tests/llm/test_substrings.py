import numpy as np
import pytest

from revgraph.llm import substrings
from revgraph.llm.common import WORD, fold

RNG = np.random.default_rng(3)
VOCABULARY = [f"w{i}" for i in range(400)]


def prose(n):
    return [VOCABULARY[i] for i in RNG.integers(0, len(VOCABULARY), n)]


def brute_force(rows):
    """Marked words of each document, by comparing all runs of MIN_WORDS words."""
    docs = {(d, " ".join(w)): w for d, w in ((d, WORD.findall(fold(t or ""))) for d, t in rows)}
    where = {}
    for key, words in docs.items():
        for i in range(len(words) - substrings.MIN_WORDS + 1):
            where.setdefault(tuple(words[i : i + substrings.MIN_WORDS]), set()).add(key)
    out = {}
    for key, words in docs.items():
        marks = np.zeros(len(words), bool)
        for i in range(len(words) - substrings.MIN_WORDS + 1):
            if len(where[tuple(words[i : i + substrings.MIN_WORDS])]) > 1:
                marks[i : i + substrings.MIN_WORDS] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], marks, [0]))))
        for a, b in zip(edges[::2], edges[1::2]):
            out.setdefault(key[0], set()).add((int(a), int(b)))
    return out


def corpus():
    shared = [prose(n) for n in (49, 50, 51, 60, 75, 200)]
    rows = []
    for i in range(120):
        words = prose(int(RNG.integers(0, 120)))
        for p in RNG.choice(len(shared), 2):
            cut = shared[p][int(RNG.integers(0, 12)) :] if RNG.random() < 0.4 else shared[p]
            at = int(RNG.integers(0, len(words) + 1))
            words = words[:at] + cut + words[at:]
        rows.append((i, " ".join(words)))
    rows += [(200, "for " * 300), (201, "x " + "for " * 120), (202, "For, " * 60 + "end"), (203, "only " * 500), (204, None), (205, ""), (206, "short text")]
    rows += [(300, rows[0][1]), (300, rows[0][1]), (301, rows[0][1].upper()), (400, " ".join(shared[5]) + " " + " ".join(prose(30_000))), (None, " ".join(shared[4]))]
    return rows


def test_spans_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, start_word string").repartition(7)
    got = {}
    for r in substrings.repeated_spans(df).collect():
        got.setdefault(r.doc_id, set()).add((r.start_word, r.end_word))
        assert r.n_words == r.end_word - r.start_word >= substrings.MIN_WORDS
    assert got == brute_force(rows)
    assert 203 not in got and 206 not in got


def test_pieces_and_carried_rows_do_not_change_the_result(spark, monkeypatch):
    rows = corpus()[:80]
    monkeypatch.setattr(substrings, "PIECE", 2000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {}
        for r in substrings.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect():
            got.setdefault(r.doc_id, set()).add((r.start_word, r.end_word))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_force(rows)


@pytest.mark.parametrize("salts", [1, 5])
def test_hot_keys_are_settled_in_shares(spark, monkeypatch, salts):
    """Keys that many documents hold go through both steps, and few of their rows reach the second."""
    passage = prose(70)
    rows = corpus()[:60] + [(1000 + i, " ".join([*prose(i % 9), *passage[i % 3 :], *prose(i % 5)])) for i in range(300)]
    monkeypatch.setattr(substrings, "HOT", 4)
    monkeypatch.setattr(substrings, "SALTS", salts)
    monkeypatch.setattr(substrings, "PIECE", 2000)
    seen = []
    settled = substrings._with_hot_settled
    monkeypatch.setattr(substrings, "_with_hot_settled", lambda found: seen.append((found, settled(found))) or seen[-1][1])
    got = {}
    for r in substrings.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect():
        got.setdefault(r.doc_id, set()).add((r.start_word, r.end_word))
    assert got == brute_force(rows)
    before, after = (max(r["count"] for r in df.where("key is not null").groupBy("key").count().collect()) for df in seen[0])
    assert after <= max(salts, substrings.HOT) < before


def test_keys_of_some_hundred_documents_make_no_more_rows(spark, monkeypatch):
    """A run of words in 300 documents, in each between others: its suffixes stay whole, as shares of a few documents would save nothing."""
    run = prose(40)
    rows = [(i, " ".join([*prose(30), *run, *prose(30)])) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(5)]
    seen = []
    settled = substrings._with_hot_settled
    monkeypatch.setattr(substrings, "_with_hot_settled", lambda found: seen.append((found, settled(found))) or seen[-1][1])
    got = {}
    for r in substrings.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect():
        got.setdefault(r.doc_id, set()).add((r.start_word, r.end_word))
    assert got == brute_force(rows)
    before, after = (df.where("key is not null").count() for df in seen[0])
    assert after <= before


def test_no_rows(spark):
    assert substrings.repeated_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize(("spans", "left"), [([], "A, b c. D"), ([(1, 3)], "A, . D"), ([(0, 4)], ""), ([(0, 1), (3, 4)], ", b c. ")])
def test_words_of_spans_are_cut_out(spans, left):
    assert substrings.without_spans("A, b c. D", spans) == left
