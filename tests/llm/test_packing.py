import zlib

import numpy as np
import public_tokenizers
import pytest

from revgraph.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
NASTY = ["It's Σίσυφος ΟΔΟΣ <|endoftext|>x.. a b\x1c ́e don't!!", "a" * 3000, "日本語テキスト", "", " \n\n ", "J̌ İ ª º 3.14, ...wow?!", "ÉCOLE ß. Ünï, x", "a.b,c;d:e!f?", "tail... and.,"]


def test_ids_equal_the_tokenizers():
    enc = packing.ChunkEncoder(PATH)
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()] + NASTY
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)] == want


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 200))
    counts = rng.integers(0, 6, capacity + 1) * (rng.random(capacity + 1) < 0.5)
    counts[0] = 0
    rows = packing.plan(counts)
    used = np.zeros_like(counts)
    full: dict[int, list[tuple[int, int]]] = {}
    for length, first, times, sequence, offset in rows:
        assert first == used[length]
        used[length] += times
        for k in range(times):
            full.setdefault(sequence + k, []).append((offset, length))
    assert (used == counts).all()
    for parts in full.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(full) == list(range(len(full)))


def test_exact_combinations_fill_sequences():
    counts = np.zeros(101, dtype=int)
    counts[[60, 25, 15, 50, 100, 40, 30]] = [4, 4, 4, 2, 1, 1, 2]
    assert max(s + t for _, _, t, s, _ in packing.plan(counts)) == -(-int((counts * np.arange(101)).sum()) // 100)


def test_documents_come_back_from_their_places(spark):
    rows = [(1, "the cat"), (1, "the cat"), (2, None), (3, ""), (4, "word " * 20_000), (None, "x y z"), (5, "a b c"), (6, "a b c")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, length string")
    got = packing.pack_documents(df, PATH).collect()
    enc = packing.ChunkEncoder(PATH)
    want = []
    for doc, text in rows:
        ids = enc.tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        for k, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            own = ids[at : at + packing.CAPACITY]
            want.append((doc, k, at, len(own), zlib.crc32(np.asarray(own, "<u4").tobytes())))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(want, key=key)
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert len(by) == -(-sum(w[3] for w in want) // packing.CAPACITY)
    assert packing.pack_documents(df.limit(0), PATH).count() == 0


def test_a_hot_length_is_numbered_in_shares(spark):
    pieces = spark.range(3000).selectExpr("id as doc_id", "0 as piece", "0L as start", "if(id < 2500, 7L, id % 50 + 1) as length", "0L as ids_crc32")
    got = packing.pack(pieces, 64, block=100).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 3000
    assert max(r.offset + r.length for r in got) <= 64
