"""Language, quality and toxicity: held-out accuracy, exact search and edge cases."""

import zlib

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from revgraph.llm import langid, quality, queries, toxicity
from revgraph.llm.labelled import labelled_sample, logistic, sigmoid

SF = "/root/testdata/sf0.01"
EDGES = [(1, None, "c"), (2, "", "c"), (2, "", "c"), (3, "12 34 !!", "c"), (4, "word " * 100_000, "c"), (None, "the end", "c"), (5, "\x00é", "c")]
KINDS = "doc_id long, text string, score string"


def read(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pandas()


def edge_cases(spark):
    return spark.createDataFrame(EDGES, KINDS)


def test_language_held_out(spark):
    got = queries.op3_langid(spark, SF).toPandas().merge(read("documents"), on="doc_id")
    assert len(got) == len(read("documents"))
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_of_brute_force_kernel():
    """Predictions from batches equal those from kernel values counted pair by pair."""
    docs = read("documents").head(300)
    texts = docs.text.tolist()
    marks = texts[:20]
    places = [set(langid.ngram_places([t])[0].tolist()) for t in marks]
    shared = {p for own in places for p in own}
    columns = np.full(langid.PLACES, -1)
    columns[sorted(shared)] = np.arange(len(shared))
    presence = np.zeros((len(shared), 20), np.float32)
    for k, own in enumerate(places):
        presence[columns[sorted(own)], k] = 1
    model = langid.Model(["a", "b"], columns, presence, np.random.default_rng(0).standard_normal((20, 2)))
    lang, _ = model.predict(texts[20:60])
    for t, got in zip(texts[20:60], lang):
        own = set(langid.ngram_places([t])[0].tolist()) & shared
        kernel = np.asarray([len(own & p) for p in places]) / max(len(own), 1) ** 0.5
        assert got == "ab"[int((kernel @ model.weights).argmax())]


def test_hundreds_of_languages_are_all_learned(spark, monkeypatch):
    """Every language can be predicted, the rare ones too; more than the stated number are refused, not cut off."""
    words = [[f"{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}{chr(97 + k // 7 % 26)}{x}" for x in ("lo", "mi", "ra", "tu")] for k in range(300)]
    rows = [(3 * k + i, f"l{k:03}", " ".join(words[k][i:] + words[k] * 2)) for k in range(300) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.fit(docs, F.lit(True))
    assert len(model.languages) == 300 and model.landmarks.shape[1] >= 300
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    assert sum(got[i] == lang for i, lang, _ in rows) > 0.9 * len(rows)
    monkeypatch.setattr(langid, "SAMPLE", 400)  # fewer documents of each, but of every language
    assert len(langid.fit(docs, F.lit(True)).languages) == 300
    monkeypatch.setattr(langid, "LANGUAGES", 299)
    with pytest.raises(ValueError, match="299"):
        langid.fit(docs, F.lit(True))


def test_language_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r for r in langid.identify(edge_cases(spark), model).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0.0
    assert got[None].lang_pred == "en" and got[5].lang_pred in model.languages
    assert langid.identify(edge_cases(spark).limit(0), model).count() == 0
    nothing = langid.fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.identify(edge_cases(spark), nothing).collect()} == {"und"}


def test_letters_beyond_the_first_plane():
    """Emoji are no letters and mark no n-gram; letters of other planes are."""
    emoji, gothic = "\U0001f600\U0001f680 \U0001f600", "\U00010330\U00010331"
    assert langid.ngram_places([emoji, gothic, "ab"])[2].tolist() == [False, True, True]
    assert langid.ngram_places([f"ab{emoji}"])[0].tolist() == langid.ngram_places(["ab"])[0].tolist()
    marks = np.ones((1, 1), np.float32)
    model = langid.Model(["a", "b"], np.zeros(langid.PLACES, int), marks, np.asarray([[1.0, 0.0]]))
    lang, score = model.predict([emoji, gothic])
    assert lang == ["und", "a"] and score[0] == 0.0


def test_quality_held_out(spark):
    got = queries.op7_quality(spark, SF).toPandas().merge(read("labels"), on="doc_id")
    held = got[got.held_out]
    assert ((held.score >= 0.7) == (held.predicted == 1)).all()
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.95


def test_quality_difference_by_definition():
    import zstandard

    model = quality.Model(quality.train_dictionary([b"good words here " * 4] * 200), quality.train_dictionary([b"BAD!! $$$ " * 6] * 200), 10.0, 0.0)
    text = "good words here BAD!! " * 40
    raw = text.encode()
    sizes = []
    for d in (model.good, model.bad):
        z = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append(sum(len(z.compress(raw[i : i + 128])) for i in range(0, len(raw), 128)))
    assert model.differences([text, ""]).tolist() == pytest.approx([(sizes[1] - sizes[0]) / (sizes[0] + sizes[1]), 0.0])


def test_toxicity_held_out(spark):
    got = queries.op8_toxicity(spark, SF).toPandas().merge(read("labels"), on="doc_id")
    held = got[got.held_out]
    assert held[held.toxic == 0].predicted.mean() < 0.02
    assert held[held.toxic == 1].predicted.mean() > 0.6
    assert all(0 < e["cosine"] <= 1 + 1e-9 for own in got.evidence for e in own)


def test_toxicity_neighbours_are_those_of_whole_texts(spark, monkeypatch):
    """Every term and every example of both classes counts: neighbours equal those from dense vectors of all terms."""
    monkeypatch.setattr(toxicity, "_one_of_each", lambda sample: sample)
    docs, labels = read("documents"), read("labels")
    rows = docs.merge(labels, on="doc_id").drop_duplicates("text").groupby("toxic").head(40)
    asked = docs[~docs.doc_id.isin(labels.doc_id)].head(60)
    df = spark.createDataFrame([(int(i), t) for i, t in zip([*rows.doc_id, *asked.doc_id], [*rows.text, *asked.text])], "doc_id long, text string")
    marks = spark.createDataFrame([(int(i), int(y)) for i, y in zip(rows.doc_id, rows.toxic)], "doc_id long, toxic int")
    model = toxicity.fit(df, marks, F.lit(True))
    own = {int(i): t for i, t in zip(rows.doc_id, rows.text)}
    terms, _ = toxicity.terms_of(list(own.values()))
    assert len(model.ids) == len(own) and set(np.unique(terms)) == set(model.vocabulary.terms)

    def dense(text):
        h, n = np.unique(toxicity.terms_of([text])[0], return_counts=True)
        at = np.searchsorted(model.vocabulary.terms, h).clip(max=len(model.worth) - 1)
        known = model.vocabulary.terms[at] == h
        out = np.zeros(len(model.worth))
        out[at[known]] = (1 + np.log(n[known])) * model.worth[at[known]]
        return out / max(np.linalg.norm(out), 1e-300)

    examples = {i: dense(t) for i, t in own.items()}
    got = {r.doc_id: r.evidence for r in toxicity.score(df, model).collect()}
    for i, t in [*zip(asked.doc_id, asked.text), *zip(rows.doc_id, rows.text)]:
        v = dense(t)
        best = sorted((-float(v @ e) for e in examples.values()))[:3]
        assert [e.cosine for e in got[i]] == pytest.approx([-b for b in best if b < 0])
        assert all(e.cosine == pytest.approx(float(v @ examples[e.doc_id])) for e in got[i])
    assert all(got[i][0].cosine == pytest.approx(1) for i in own)
    assert {e.toxic for own in got.values() for e in own} == {0, 1}


@pytest.mark.parametrize("common", [0.01, 0.2, 1.0])
def test_block_max_search_over_common_terms(common):
    rng, rows = np.random.default_rng(5), []
    for _ in range(400):
        t = np.sort(rng.choice(200, 40, replace=False, p=(p := 1 / np.arange(1, 201)) / p.sum()))
        w = rng.random(40) * (1 + t / 20)
        rows.append((t, w / np.sqrt((w * w).sum())))
    index, dense = toxicity.BlockMaxIndex(rows, 200, common), np.zeros((400, 200))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    for t, w in rows[::23]:
        near, got = index.search(t, w, 16)
        cosine = dense[:, t] @ w
        assert got == pytest.approx(np.sort(cosine)[::-1][:16]) and cosine[near] == pytest.approx(got)


def test_texts_searched_together_share_products():
    """Blocks that half of the texts need are scored for all of them at once, terms of 8 % of the examples among them."""
    rng, rows = np.random.default_rng(7), []
    for i in range(640):
        t = np.append(np.sort(rng.choice(100, 20, replace=False)), 100 + i % 12)
        w = rng.random(21)
        rows.append((t, w / np.sqrt((w * w).sum())))
    index, dense = toxicity.BlockMaxIndex(rows, 112), np.zeros((640, 112))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    assert not len(index.post)
    for (near, got), (t, w) in zip(index.search_all(rows[::3], 16), rows[::3]):
        cosine = dense[:, t] @ w
        assert got == pytest.approx(np.sort(cosine)[::-1][:16]) and cosine[near] == pytest.approx(got)


def test_block_max_search_is_exact():
    rng = np.random.default_rng(2)
    terms, rows = 60, []
    for _ in range(500):
        t = np.sort(rng.choice(terms, rng.integers(1, 8), replace=False))
        w = rng.random(len(t))
        rows.append((t, w / np.sqrt((w * w).sum())))
    rows += rows[:30]  # ties
    index = toxicity.BlockMaxIndex(rows, terms)
    dense = np.zeros((len(rows), terms))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    for t, w in rows[::17]:
        q = np.zeros(terms)
        q[t] = w
        cosine = dense @ q
        order = np.lexsort((np.arange(len(rows)), -np.round(cosine, 12)))[:16]
        order = order[cosine[order] > 0]
        near, got = index.search(t, w, 16)
        assert got == pytest.approx(cosine[order])
        assert {i for i, c in zip(near, got) if c > got[-1] + 1e-9} == {i for i in order if cosine[i] > got[-1] + 1e-9}
    assert index.visited < 8 * len(rows[::17]) * index.blocks // 8


def test_classifiers_edges(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (0, None, None), (0, 7, 7), (1, 0, 0), (1, 1, 1)], labels.schema))
    for module, kind in ((quality, "quality"), (toxicity, "toxic")):
        model = module.fit(docs, odd, F.col("doc_id") % 3 != 1, per_class=64)
        got = module.score(edge_cases(spark), model).toPandas()
        assert len(got) == len(EDGES) and got.score.between(0, 1).all()
        assert got[got.doc_id == 2].score.nunique() == 1
        assert module.score(edge_cases(spark).limit(0), model).count() == 0
        one = module.fit(docs, labels.where(f"{kind} = 1"), F.lit(True), per_class=8)
        assert set(module.score(edge_cases(spark), one).toPandas().score) == {1.0}
        none = module.fit(docs, labels.limit(0), F.lit(True))
        assert set(module.score(edge_cases(spark), none).toPandas().score) == {0.0}
    kept = toxicity.keep(edge_cases(spark), toxicity.fit(docs, labels, F.lit(True), per_class=64))
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == len(EDGES)


def test_samples_are_bounded_and_logistic_fits(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    sample, totals = labelled_sample(docs, labels, "quality", F.lit(True), 20)
    n = pd.Series([r.label for r in sample.collect()]).value_counts()
    assert n.max() <= 20 and n.min() > 10 and totals == read("labels").quality.value_counts().to_dict()
    rng = np.random.default_rng(0)
    x = rng.standard_normal(20_000)
    y = (rng.random(20_000) < sigmoid(2 * x - 1)).astype(int)
    assert logistic(x[:, None], y, np.ones(len(x))) == pytest.approx([2, -1], abs=0.15)


def test_only_verified_copies_leave_the_examples(spark):
    rng = np.random.default_rng(4)
    words = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    passage, base, chain = words(40), words(200), words(100)
    rows = [(i, " ".join(passage + words(30)), i % 2) for i in range(100)]  # half the shingles shared, none a copy
    rows += [(100 + i, " ".join(base[:198] + words(2)), 1) for i in range(5)]  # copies of the first
    rows += [(110 + i, " ".join(chain[9 * i :] + words(9 * i)), 0) for i in range(6)]  # each like the next, the ends not
    rows += [(120, " ".join(base), 0), (121, "a b", 0), (122, "", 0), (123, "", 1), (7, " ".join(words(50)), 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)

    def shingles(text):
        w = text.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    kept = []
    for i, t, y in sorted(rows):
        own = shingles(t)
        if not any(y == z and own and len(own & s) >= 0.8 * len(own | s) for s, z in ((shingles(u), z) for _, u, z in kept)):
            kept.append((i, t, y))
    got = toxicity._one_of_each(df)
    assert got.columns == df.columns and sorted(map(tuple, got.select("doc_id", "text", "label").collect()), key=str) == sorted(kept, key=str)
    assert len([i for i, _, _ in kept if i < 100]) == 101 and {i for i, _, _ in kept if 100 <= i < 110} == {100}
    assert 1 < len([i for i, _, _ in kept if 110 <= i < 120]) < 6
    assert toxicity._one_of_each(df.limit(0)).count() == 0
