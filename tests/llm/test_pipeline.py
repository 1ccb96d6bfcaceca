"""The pipeline, stage by stage, against what each stage must do with its own input."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from revgraph.llm import neardup, packing, pii, toxicity
from revgraph.llm.common import crc32_of

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order(spark):
    """Run with nulls, empty and very long texts, repeated rows and an extra column added to the table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("clash"))
    odd = [(-1, None, None, None, None, "x"), (-2, "", "en", "s", 0, "x"), (-2, "", "en", "s", 0, "x"), (None, "just a text", "en", "s", 11, "x"), (-3, "long " * 50_000, "en", "s", 250_000, "x")]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    items = pq.read_table(f"{SF}/benchmark.parquet").column("text").to_pylist()
    before = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, SF), name)
        if name != "packing":
            assert out.columns == [*COLUMNS, "score"]
        rows = {(r["doc_id"], r["text"]) for r in docs.collect()}
        kept = {(r["doc_id"], r["text"]) for r in out.collect()} if name != "packing" else set()
        if name == "toxicity":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            scores = toxicity.score(docs, toxicity.fit(docs, labels, crc32_of() % 3 != 1))
            toxic = {r.doc_id for r in scores.where("predicted = 1").collect()}
            assert kept == {(d, t) for d, t in rows if d not in toxic} and len(kept) < len(rows)
        elif name == "near_dedup":
            want = {r.doc_id for r in neardup.classes(docs).collect() if r.class_id in (r.doc_id, None) or r.k1 is None}
            assert kept == {(d, t) for d, t in rows if d in want} and len(kept) < len(rows)
        elif name == "decontamination":
            assert kept == {(d, t) for d, t in rows if not any(x in (t or "") for x in items)} and len(kept) < len(rows)
        elif name == "pii":
            assert {(d, t and pii.reveal(t)) for d, t in kept} == rows and kept != rows
            assert all(r.n_chars == len(r.text) for r in out.collect() if r.text)
        else:
            enc = packing.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))
            want = []
            for r in docs.collect():
                ids = np.asarray(enc.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
                want += [(r.doc_id or 0, k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
            assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in out.collect()) == sorted(want)
        before[name] = len(rows)
        docs = out
    assert list(before) == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]


def test_run_is_registered(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in __spark_entry__.oracle_sql()
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 100


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs
