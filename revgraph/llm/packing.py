"""Best-fit packing of tokenised documents by exact-complement hashing.

``token_pieces`` tokenises every document and cuts only those longer than a
sequence. ``plan`` packs a histogram of piece lengths: for the gap left by the
longest pieces it looks up, in indexes of single, pair and triple length sums,
combinations that fill it exactly, uses each as often as the counts allow, and
otherwise gives the longest piece that fits. ``pack`` numbers the pieces of
each length and reads their places off the plan.

Only the histogram (at most ``capacity`` counts) reaches the driver, and the
plan has a few rows for each step; every step uses up a length or closes a
group of sequences, so its size depends on ``capacity`` and not on the data.

Defined results: a null or empty text is one piece of the end token alone; a
text of exactly ``capacity`` tokens fills one sequence; equal rows are packed
each on its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revgraph.llm.common import pieces, stored

CAPACITY = 4096
END_ID = 1

#: Chunks of text whose ids a task remembers before it starts afresh.
REMEMBERED = 500_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _byte_letters() -> dict[int, str]:
    """How byte-level models write U+0080 to U+00FF: each UTF-8 byte as a printable character."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    letter = {b: chr(b) if b in own else chr(256 + others.index(b)) for b in range(256)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}


class ChunkEncoder:
    """Ids of whole texts, chunk by chunk between spaces, each distinct chunk encoded once.

    The tokenizer's pre-tokens never reach over white space, and a run of
    sentence marks behind a letter is a pre-token of its own, so the ids of a
    text are those of its chunks in order. A chunk of lower-case Latin-1
    letters is one pre-token that normalising leaves as it is; it goes
    straight to the tokenizer's model, any other through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {"": b""}

    @staticmethod
    def _chunks(text: str) -> list[str]:
        try:
            text.encode("latin-1")
            text = text.lower()  # as the tokenizer would; outside Latin-1 marks could combine otherwise
        except UnicodeEncodeError:
            pass
        return text.replace("\n", " ").split(" ")

    @staticmethod
    def _split(chunk: str) -> tuple[str, str]:
        core = chunk.rstrip(".,!?;:")
        return (core, chunk[len(core) :]) if core and core[-1].isalpha() else (chunk, "")

    def _learn(self, chunks: set[str]) -> None:
        parts = {c: self._split(c) for c in chunks}
        others = set()
        for part in {p for pair in parts.values() for p in pair}.difference(self.known):
            if part.isalpha() and part == part.lower() and max(part) < "\u0100":
                ids = [t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.letters))]
                self.known[part] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                others.add(part)
        rest = sorted(others)
        for part, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.known[part] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        for c, (core, tail) in parts.items():
            if tail:
                self.known[c] = self.known[core] + self.known[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > REMEMBERED:
            self.known = {"": b""}
        split = [self._chunks(t) for t in texts]
        self._learn(set().union(*split).difference(self.known))
        get = self.known.__getitem__
        return [b"".join(map(get, s)) for s in split]


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker process: what it has learned serves later tasks too."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every document, whole texts."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_encoder = encoder(tokenizer_path)
        for batch in batches:
            for part, texts in pieces(batch, size=4 << 20):
                rows = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), own_encoder.encode(texts)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        rows.append((doc, k, at // 4, len(own) // 4, zlib.crc32(own)))
                cols = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


class _Sums:
    """Which gaps one, two or three of the lengths still at hand fill exactly."""

    def __init__(self, counts: np.ndarray):
        self.n = counts
        self.fresh = False

    def use(self, length: int, times: int) -> None:
        self.n[length] -= times
        if self.n[length] == 0:
            self.fresh = False

    def _index(self) -> None:
        """Pair sums of the lengths at hand, as one table from sum to the number of pairs."""
        have = (self.n > 0).astype(np.float64)
        size = 2 * len(have)
        f = np.fft.rfft(have, size)
        self.pairs = np.rint(np.fft.irfft(f * f, size))[: len(have)] > 0
        self.fresh = True

    def pair(self, gap: int, top: int) -> tuple[int, int] | None:
        """Two lengths of sum ``gap``, the longer one as long as possible and at most ``top``."""
        a = np.arange(min(gap - 1, top), (gap - 1) // 2, -1)
        hit = np.flatnonzero((self.n[a] > 0) & (self.n[gap - a] > (a == gap - a)))
        return (int(a[hit[0]]), gap - int(a[hit[0]])) if len(hit) else None

    def fill(self, gap: int) -> tuple[int, ...] | None:
        if self.n[gap] > 0:
            return (gap,)
        found = self.pair(gap, gap)
        if found:
            return found
        if not self.fresh:
            self._index()
        first = np.flatnonzero((self.n[1 : gap - 1] > 0) & self.pairs[gap - np.arange(1, gap - 1)])[::-1] + 1
        for a in first.tolist():
            if 3 * a < gap:
                break
            self.n[a] -= 1
            rest = self.pair(gap - a, a)
            self.n[a] += 1
            if rest:
                return (a, *rest)
        return None


def plan(counts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Pack ``counts[length]`` pieces into sequences of ``len(counts) - 1`` tokens.

    Rows (length, first, times, sequence, offset): the pieces of that length
    numbered ``first`` to ``first + times - 1`` go to sequences ``sequence``,
    ``sequence + 1``, ... at ``offset``.
    """
    n = counts.astype(np.int64).copy()
    capacity = len(n) - 1
    sums = _Sums(n)
    used = np.zeros(capacity + 1, dtype=np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, times: int, sequence: int, offset: int) -> None:
        rows.append((length, int(used[length]), times, sequence, offset))
        used[length] += times
        sums.use(length, times)

    for longest in range(capacity, 0, -1):
        while n[longest] > 0:
            gap, parts = capacity - longest, (longest,)
            while gap:
                combo = sums.fill(gap) if _within(n, parts) else None
                if combo and _within(n, parts + combo):
                    parts += combo
                    gap = 0
                    break
                left = n[1 : gap + 1].copy()
                for p in parts:
                    if p <= gap:
                        left[p - 1] -= 1
                fits = np.flatnonzero(left > 0)
                if not len(fits):
                    break
                parts += (int(fits[-1]) + 1,)
                gap -= parts[-1]
            times = min(int(n[p]) // parts.count(p) for p in set(parts))
            offset = 0
            for p in parts:
                place(p, times, sequences, offset)
                offset += p
            sequences += times
    return rows


def _within(n: np.ndarray, parts: tuple[int, ...]) -> bool:
    return all(n[p] >= parts.count(p) for p in set(parts))


def pack(piece_table: DataFrame, capacity: int = CAPACITY, block: int = 1 << 20) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces with ``length``.

    Pieces of one length are numbered within hash shares of about ``block``
    rows; running totals over the shares make the numbers of the whole length,
    so a length that holds a third of all pieces is dealt to many tasks.
    """
    total = piece_table.count()
    shares = max(8, -(-total // block) * 8)
    df = piece_table.withColumn("_share", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(shares)).cast("int"))
    sizes = df.groupBy("length", "_share").agg(F.count(F.lit(1)).alias("_n"))
    sizes = stored(sizes, "length-shares")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    rows = np.asarray(sorted(plan(counts)), dtype=np.int64).reshape(-1, 5)
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_share").orderBy("doc_id", "piece", "ids_crc32")
    ranked = df.withColumn("_own", F.row_number().over(own)).join(base, ["length", "_share"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_own") - 1).drop("_share", "_own", "_base")
    names = [f.name for f in piece_table.schema.fields]
    schema = piece_table.schema.simpleString()[len("struct<") : -1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (rows[:, 0] << 44) + rows[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            sequence, offset = rows[at, 3] + rank - rows[at, 1], rows[at, 4]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return ranked.select(*names, "_rank").mapInArrow(place, f"{schema}, sequence_id:bigint, offset:bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack all documents: one row per piece with its place."""
    return pack(stored(token_pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
