import pickle

import numpy as np
import pyarrow.parquet as pq

from revgraph.llm import decontam, queries
from revgraph.llm.common import WORD, WordBatch, fold
from revgraph.llm.decontam import GRAM, LIGHT, OVERLAP, THRESHOLD, ItemIndex, question_and_answer

SF = "/root/testdata/sf0.001"
RNG = np.random.default_rng(4)
VOCABULARY = [f"w{i}" for i in range(300)]


def prose(n):
    return " ".join(VOCABULARY[i] for i in RNG.zipf(1.4, n) % 300)


def brute_force(index: ItemIndex, texts, items):
    """Every passage against every item, by the definition of the score and the overlaps."""
    weights = [dict() for _ in index.ids]
    for t, i, w in zip(index.term, index.item, index.weight):
        weights[i][int(index.terms[t])] = w
    out = set()
    for d, text in enumerate(texts):
        words = WordBatch([text])
        h = words.hash.tolist()
        own = WORD.findall(fold(text))
        have = {tuple(own[i : i + GRAM]) for i in range(len(own))}
        for i, item in enumerate(items):
            score = 0.0
            for a, b in zip(*index.passages(words)[:2]):
                score = max(score, sum(weights[i].get(x, 0.0) for x in set(h[a:b])))
            if score < THRESHOLD:
                continue
            parts = [WORD.findall(fold(p)) for p in question_and_answer(item)]
            shares = [np.mean([g in have for g in {tuple(p[k : k + GRAM]) for k in range(len(p) - GRAM + 1)}]) if len(p) >= GRAM else float(" ".join(p) in " ".join(own)) for p in parts]
            if min(shares) >= OVERLAP:
                out.add((d, i))
    return out


def test_leaks_equal_brute_force():
    items = [prose(int(RNG.integers(12, 50))) + ". " + prose(int(RNG.integers(4, 12))) + "." for _ in range(60)]
    index = ItemIndex(list(range(60)), items)
    texts = []
    for i in range(120):
        words = prose(int(RNG.integers(0, 400))).split()
        item = items[i % 60].split()
        if i % 3 == 1:
            item = [w if RNG.random() < 0.95 else "changed" for w in item]
        if i % 3 == 2:
            item = item[: len(item) // 2]  # only the question
        at = int(RNG.integers(0, len(words) + 1))
        texts.append(" ".join(words[:at] + item + words[at:]))
    got = {(d, i) for d, i, *_ in index.leaks(WordBatch(texts))}
    want = brute_force(index, texts, items)
    assert got == want and len(want) >= 60
    assert 0 < LIGHT < THRESHOLD


def test_all_planted_items_are_found_and_no_others(spark):
    docs, items = pq.read_table(f"{SF}/documents.parquet").to_pandas(), pq.read_table(f"{SF}/benchmark.parquet").to_pandas()
    want = {(d, i) for d, t in zip(docs.doc_id, docs.text) for i, x in zip(items.item_id, items.text) if x in t}
    got = {(r.doc_id, r.item_id) for r in queries.op9_decontamination(spark, SF).collect()}
    assert want and got == want


def test_edges(spark):
    items = spark.createDataFrame([(1, "What is the capital of France? It is Paris.", 0), (2, None, 0), (3, "", 0), (4, "one two", 0), (1, "What is the capital of France? It is Paris.", 0), (None, "seven more words are in this item here", 0)], "item_id long, text string, doc_id int")
    rows = [(1, "xx what is the capital of france it is paris yy", "a"), (2, None, "a"), (3, "", "a"), (4, "word " * 100_000 + "one two", "a"), (5, "What is the capital of France?", "a"), (1, "xx what is the capital of france it is paris yy", "a"), (None, "one two", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    found = sorted((r.doc_id or 0, r.item_id) for r in decontam.contamination(docs, items).collect())
    assert found == [(0, 4), (1, 1), (1, 1), (1, 1), (1, 1), (4, 4)]
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert decontam.contamination(docs, items.limit(0)).count() == 0 and decontam.clean(docs, items.limit(0)).count() == len(rows)
    assert decontam.contamination(docs.limit(0), items).count() == 0


def test_an_index_of_many_items_is_small_and_finds_them():
    """20,000 items over 40,000 words: a table of all terms and blocks would take 400 MB."""
    rng = np.random.default_rng(8)
    words = np.asarray([f"v{i}" for i in range(40_000)])
    items = [" ".join(words[np.minimum(rng.zipf(1.2, 32), 40_000) - 1]) + "." for _ in range(20_000)]
    index = ItemIndex(list(range(len(items))), items)
    assert len(pickle.dumps(index)) < 40_000_000
    texts = [" ".join(words[np.minimum(rng.zipf(1.2, 500), 40_000) - 1]) for _ in range(40)]
    for i in range(0, 40, 2):
        texts[i] += " " + items[i * 311]
    got = {(d, i) for d, i, *_ in index.leaks(WordBatch(texts))}
    assert {(i, i * 311) for i in range(0, 40, 2)} <= got
    assert all(_shares(items[i], texts[d]) for d, i in got)


def _shares(item, text):
    own, has = WORD.findall(item), WORD.findall(text)
    have = {tuple(has[k : k + GRAM]) for k in range(len(has))}
    return np.mean([tuple(own[k : k + GRAM]) in have for k in range(len(own) - GRAM + 1)]) >= OVERLAP / 2
