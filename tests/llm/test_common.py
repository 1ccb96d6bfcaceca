import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from revgraph.llm import common
from revgraph.llm.common import WORD, WordBatch, bitmap, fold, in_bitmap, pieces, window_hashes

TEXTS = ["", "Éa bc, d_e “hi” ça… 12x y  ", None, "İstanbul ﬁ、日本 ok", "a a a", "x" * 3_000_000, "\x00 tab\tnew\nline", "word"]


def test_words_are_those_of_the_pattern():
    batch = pa.record_batch({"text": TEXTS})
    seen, done = {}, 0
    for part, texts in pieces(batch):
        words = WordBatch(texts, (4,))
        for i, t in enumerate(texts):
            own = WORD.findall(fold(t))
            h = words.hash[words.first[i] : words.first[i + 1]]
            p = words.prefix[4][0][words.first[i] : words.first[i + 1]]
            assert len(own) == len(h)
            for w, v, q in zip(own, h, p):
                assert seen.setdefault(w, v) == v
                assert seen.setdefault(("prefix", w[:4]), q) == q
        done += part.num_rows
    assert done == len(TEXTS)
    assert len(set(seen.values())) == len(seen)


def test_no_rows_and_keys_without_words():
    assert list(pieces(pa.record_batch({"text": pa.array([], pa.string())}))) == []
    keys = WordBatch(["", "A b", "a  B!", "b a"]).sequence_keys()
    assert keys[0] is None and keys[1] == keys[2] != keys[3]


def test_window_hashes_by_definition():
    h = common.mix(np.arange(60, dtype=np.uint64))
    for size in (1, 2, 3, 7, 31, 50):
        got = window_hashes(h, size)
        assert len(got) == 60 - size + 1
        again = window_hashes(h[5 : 5 + size], size)
        assert len(again) == 1 and again[0] == got[5]
    assert len(window_hashes(h, 61)) == 0


def test_bitmap_holds_its_keys(spark):
    keys = [-(1 << 63), -1, 0, 1, (1 << 63) - 1, 123456789 << 30]
    places = bitmap(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert in_bitmap(np.asarray(keys, dtype=np.int64).view(np.uint64), places).all()
    assert int(sum(bin(x).count("1") for x in places)) <= len(keys)
    full = bitmap(spark.range(5000).select(F.xxhash64("id").alias("key")), 13)
    assert len(full) == 1 << 7 and in_bitmap(np.asarray(keys, dtype=np.int64).view(np.uint64), full).shape == (6,)
    none = bitmap(spark.range(0).select(F.col("id").alias("key")))
    assert not in_bitmap(np.asarray(keys, dtype=np.int64).view(np.uint64), none).any()
