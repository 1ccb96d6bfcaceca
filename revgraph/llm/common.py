"""Shared helpers of the training-data operators: reading, scratch tables, word hashing, bitmaps.

Words. A word is a run of ASCII letters and digits or of code points from U+00C0
on, without the punctuation blocks U+2000-U+207F and U+3000-U+303F, in lower
case. ``WordBatch`` finds and hashes the words of many texts at once with numpy:
the bytes of a word give a polynomial modulo 2**64, read off one running sum.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revgraph import session

#: The same words as ``WordBatch`` finds, for one text.
WORD = re.compile("[0-9A-Za-z\u00c0-\u1fff\u2080-\u2fff\u3040-\U0010ffff]+")

#: Bytes of text hashed at a time: the arrays over one piece stay in tens of MB.
PIECE_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C55 | 1
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


#: Rows of text that Spark hands to a worker at a time. Its own default suits numbers: at some kB a row it takes
#: hundreds of MB on both sides.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def lean_batches(spark: SparkSession) -> None:
    """Hand texts to the workers in small batches, unless the deployment chose a size."""
    if not spark.sparkContext.getConf().contains(_BATCH) and int(spark.conf.get(_BATCH)) == 10_000:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def release() -> None:
    """Give back to the system what Arrow and the C library keep for later; for the end of a task that held much."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # in the GNU C library only
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lean_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: a lineage cut that survives lost executors."""
    lean_batches(df.sparkSession)
    return session.stored(df, name)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on every other."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def fold(text: str) -> str:
    """Lower case that keeps the number of characters."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch whose texts come to about ``size`` bytes, with the texts; a null text is empty."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // size
    cuts = np.flatnonzero(np.diff(part)) + 1 if len(part) else []
    edges = [0, *cuts, batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            s = batch.slice(a, b - a)
            yield s, [x or "" for x in s.column(column).to_pylist()]


_powers: tuple[np.ndarray, np.ndarray] | None = None


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        inv = pow(_BASE, -1, 1 << 64)
        a = np.full(size, _BASE, dtype=np.uint64)
        b = np.full(size, inv, dtype=np.uint64)
        a[0] = b[0] = 1
        _powers = np.multiply.accumulate(a), np.multiply.accumulate(b)
    return _powers


class WordBatch:
    """The words of several texts.

    ``first[i]:first[i + 1]`` are the words of text ``i``; ``hash`` holds one
    64-bit value for each word, ``doc`` the text that each word is from.
    """

    def __init__(self, texts: list[str], prefixes: tuple[int, ...] = ()):
        raw = [fold(t).encode("utf-8", "surrogatepass") for t in texts]
        buf = np.frombuffer(b" ".join(raw) + b"   ", dtype=np.uint8)
        n = len(buf)
        kind = _CLASS[buf]
        if buf.max(initial=0) >= 0x80:
            nxt = np.empty_like(buf)
            nxt[:-1], nxt[-1] = buf[1:], 32
            three = np.flatnonzero(((buf == 0xE2) & ((nxt == 0x80) | (nxt == 0x81))) | ((buf == 0xE3) & (nxt == 0x80)))
            for d in range(3):
                kind[three + d] = False
            two = np.flatnonzero(buf == 0xC2)
            kind[two] = kind[two + 1] = False
        edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        if len(kind) and kind[0]:
            edge = np.concatenate(([0], edge))
        start, end = edge[0::2], edge[1::2]
        power, inverse = _pow(n + 1)
        run = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:n], out=run[1:])
        self.hash = mix((run[end] - run[start]) * inverse[start])
        lengths = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
        at = np.concatenate(([0], np.cumsum(lengths)))
        self.first = np.searchsorted(start, at)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.size = len(texts)
        self.prefix = {}
        if prefixes:
            chars = np.flatnonzero((buf & 0xC0) != 0x80)
            c0 = np.searchsorted(chars, start)
            for k in prefixes:
                stop = np.minimum(chars[np.minimum(c0 + k, len(chars) - 1)], end)
                self.prefix[k] = mix((run[stop] - run[start]) * inverse[start] ^ np.uint64(k * _BASE % (1 << 64))), stop < end

    def sequence_keys(self) -> list[bytes | None]:
        """16 bytes for each text's word sequence; None for a text without words."""
        import xxhash

        data = self.hash.tobytes()
        return [xxhash.xxh3_128_digest(data[8 * a : 8 * b]) if b > a else None for a, b in zip(self.first, self.first[1:])]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words within one text, and the index of each run's first word."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        ok = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return window_hashes(self.hash, size)[ok], ok


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``h[i:i + size]`` for every i, by doubling: O(log size) passes."""
    n = len(h) - size + 1
    out, have, block, span, left = None, 0, h, 1, size
    while left:
        if left & 1:
            out = block if out is None else _join(out, block, have, span)
            have += span
        left >>= 1
        if left:
            block = _join(block, block, span, span)
            span *= 2
    return mix(out[:n])


def _join(a: np.ndarray, b: np.ndarray, shift: int, span: int) -> np.ndarray:
    """Polynomial hash of a run followed by the run of ``span`` values that starts ``shift`` later."""
    n = min(len(a), len(b) - shift)
    return a[:n] * np.uint64(pow(_BASE, span, 1 << 64)) + b[shift : shift + n]


_CLASS = np.zeros(256, dtype=bool)
_CLASS[ord("0") : ord("9") + 1] = _CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = True
_CLASS[0x80:] = True


#: A bitmap has at most 2**27 places: 16 MB, wherever it is sent.
MOST_BITS = 27


def bitmap(keys: DataFrame, most: int = MOST_BITS) -> np.ndarray:
    """A bitmap of 2**bits places with the place of every 64-bit ``key`` set.

    It has 16 places for each key, so one stranger in 16 is let through, but
    2**most at most; with more keys than that it only lets more strangers
    through. It reaches the driver as at most 2**most / 64 rows.
    """
    bits = min(most, max(12, (16 * keys.count() - 1).bit_length()))
    place = f"shiftrightunsigned(key, {64 - bits})"
    rows = (
        keys.select(F.expr(f"shiftright({place}, 6)").alias("word"), F.expr(f"shiftleft(1L, cast({place} & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def in_bitmap(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which of the uint64 ``keys`` may be in the bitmap."""
    bits = int(len(places)).bit_length() - 1 + 6
    at = keys >> np.uint64(64 - bits)
    return (places[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def crc32_of(doc_id: str = "doc_id"):
    """crc32 of the id written as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))
