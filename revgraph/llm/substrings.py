"""Passages that repeat across documents, by sparse suffix arrays.

A suffix is kept where it starts at a minimiser: the position whose run of
``GRAM`` words has the smallest hash among ``SPREAD`` positions in a row. The
choice depends on the words alone, so a passage of ``MIN_WORDS`` words keeps
the same first suffix wherever it stands, at most ``SPREAD - 1`` words from
its start, and with at least ``PREFIX`` words of it to the right.

The kept suffixes are brought into order by a hash of their first ``PREFIX``
words; neighbours with equal prefixes are candidates. A candidate match is
then extended to the left and to the right: each passage of ``MIN_WORDS``
words that has the suffix as its first is compared, as a hash of all its
words, with those of its neighbours. Passages found in two documents are
marked, and overlapping ones joined into maximal spans. The result is exact: a
word is marked if and only if some run of ``MIN_WORDS`` words around it stands
in another document too (up to collisions of 64-bit hashes).

What many rows share is settled early: each task, before and after the
shuffle, marks what it sees twice and hands on one copy of each passage. Keys
that more than ``HOT`` documents share are first settled in ``SALTS`` shares
each, and what these hand on meets by its whole passage.

Defined results: a null text, and one of fewer than ``MIN_WORDS`` words, has
no spans; documents without spans give no rows; rows equal in doc_id and words
are one document; words are those of ``revgraph.llm.common.WORD``; texts of
any length are read whole; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revgraph.llm.common import WORD, WordBatch, bitmap, fold, in_bitmap, pieces, stored, window_hashes

MIN_WORDS = 50
GRAM = 8
SPREAD = 20
PREFIX = MIN_WORDS - (SPREAD - 1)
#: Bytes of text whose passages are settled together.
PIECE = 1 << 20
#: Documents from which on a key is dealt out in shares, and their number. A share hands on one row for each passage
#: that it holds, in place of one for each suffix: it must hold many documents, else it hands on more than it got.
HOT, SALTS = 4096, 64

SUFFIX = "key long, doc_id long, text_key long, start int, passages array<long>"
MARK = "doc_id long, text_key long, first int, last int"


class Suffixes:
    """The kept suffixes of several texts: hash of the prefix, and the passages that each is first in.

    Suffix i is the first of the passages that start at words ``lo[i]`` to
    ``hi[i]`` (counted over all texts, inclusive).
    """

    def __init__(self, words: WordBatch):
        h, n = words.hash, len(words.hash)
        starts = np.flatnonzero(words.doc[: max(0, n - MIN_WORDS + 1)] == words.doc[MIN_WORDS - 1 :]) if n >= MIN_WORDS else np.empty(0, np.int64)
        self.passage = window_hashes(h, MIN_WORDS) if len(starts) else np.empty(0, np.uint64)
        if not len(starts):
            self.lo = self.hi = self.doc = np.empty(0, np.int64)
            self.key = np.empty(0, np.uint64)
            return
        bits = np.uint64(max(24, n.bit_length()))
        low = (np.uint64(1) << bits) - np.uint64(1)
        grams = window_hashes(h, GRAM)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # ties: the leftmost
        span = 1
        while 2 * span <= SPREAD:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = SPREAD - span
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        at = (least[starts] & low).astype(np.int64)
        new = np.append(True, (at[1:] != at[:-1]) | (words.doc[starts[1:]] != words.doc[starts[:-1]]))
        first = np.flatnonzero(new)
        self.lo, self.hi = starts[first], starts[np.append(first[1:], len(starts)) - 1]
        self.doc = words.doc[self.lo]
        self.key = window_hashes(h, PREFIX)[at[first]]


def settle(doc: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, passages: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
    """Marks of the passages that two documents among the rows hold, and which passages are open.

    Row i holds ``length[i]`` passages that start at words ``start[i]``, ... of
    document (doc[i], text[i]). Open is the first copy of each passage, and
    any copy of one not found in a second document yet.
    """
    row = np.repeat(np.arange(len(doc)), length)
    word = np.repeat(start, length) + np.arange(len(passages)) - np.repeat(np.cumsum(length) - length, length)
    order = np.argsort(passages, kind="stable")
    p, r = passages[order], row[order]
    new = np.append(True, p[1:] != p[:-1]) if len(p) else np.empty(0, bool)
    group = np.cumsum(new) - 1
    head = r[np.flatnonzero(new)][group] if len(p) else r
    other = (doc[r] != doc[head]) | (text[r] != text[head])
    twice = np.zeros(group[-1] + 1 if len(p) else 0, dtype=bool)
    twice[group[other]] = True
    still = np.zeros(len(passages), dtype=bool)
    still[order[new]] = True
    still[order[~twice[group]]] = True
    hit = order[twice[group]]
    r, word = row[hit], word[hit]
    by = np.lexsort((word, text[r], doc[r]))
    r, word = r[by], word[by]
    if len(r):
        cut = np.append(True, (doc[r[1:]] != doc[r[:-1]]) | (text[r[1:]] != text[r[:-1]]) | (word[1:] > word[:-1] + 1))
        a = np.flatnonzero(cut)
        z = np.append(a[1:], len(r)) - 1
    else:
        a = z = np.empty(0, np.int64)
    marks = pa.RecordBatch.from_arrays([pa.array(doc[r[a]]), pa.array(text[r[a]]), pa.array(word[a].astype(np.int32)), pa.array(word[z].astype(np.int32))], names=["doc_id", "text_key", "first", "last"])
    return marks, still


def _rows_with(still: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which rows of ``length[i]`` passages hold an open one."""
    return np.bincount(np.repeat(np.arange(len(length)), length), still, len(length)) > 0


def _prefix_counts(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in pieces(batch):
                s = Suffixes(WordBatch(texts))
                if len(s.key):
                    order = np.lexsort((s.doc, s.key))
                    key, doc = s.key[order], s.doc[order]
                    once = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))
                    own, n = np.unique(key[once], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], names=["key", "n"])

    return docs.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _candidates(docs: DataFrame, places: np.ndarray, hot: np.ndarray) -> DataFrame:
    """Suffixes whose prefix stands in several documents, whether in many, and marks of what is settled within a piece (key null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, size=PIECE):
                ids = part.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
                words = WordBatch(texts)
                s = Suffixes(words)
                some = np.flatnonzero(in_bitmap(s.key, places))
                if not len(some):
                    continue
                lo, hi, which = s.lo[some], s.hi[some], s.doc[some]
                length = hi - lo + 1
                at = np.repeat(lo, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                passages = s.passage[at].view(np.int64)
                keys = words.sequence_keys()
                text = np.asarray([int.from_bytes(keys[i][:8], "little", signed=True) for i in which])
                start = lo - words.first[which]
                marks, still = settle(ids[which], text, start, length, passages)
                if marks.num_rows:
                    yield _with_flag(_mark_rows(marks), np.zeros(marks.num_rows, dtype=bool))
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)).astype(np.int32)), pa.array(passages))
                rows = _suffix_rows(pa.array(s.key[some].view(np.int64)), pa.array(ids[which]), pa.array(text), pa.array(start.astype(np.int32)), lists)
                yield _with_flag(rows, in_bitmap(s.key[some], hot)).filter(pa.array(_rows_with(still, length)))

    return docs.mapInArrow(run, SUFFIX + ", hot boolean")


def _with_flag(rows: pa.RecordBatch, hot: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(hot)], names=[*rows.schema.names, "hot"])


def _suffix_rows(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=["key", "doc_id", "text_key", "start", "passages"])


def _mark_rows(marks: pa.RecordBatch) -> pa.RecordBatch:
    """Marks as rows of suffixes: no key, and the last word in the list."""
    n = marks.num_rows
    last = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32)), marks.column("last").cast(pa.int64()))
    return _suffix_rows(pa.nulls(n, pa.int64()), marks.column("doc_id"), marks.column("text_key"), marks.column("first"), last)


def _settled(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch | None, pa.Table, np.ndarray, np.ndarray]]:
    """Marks from suffixes in the order of their keys, the rows, their open passages, and the rows whose keys are complete.

    Of the last key's rows those with open passages are carried on to the next batch.
    """
    carried: pa.Table | None = None
    rest = None
    for batch in rows:
        t = pa.Table.from_batches([batch])
        t = t if carried is None else pa.concat_tables([carried, t]).combine_chunks()
        if not t.num_rows:
            continue
        key, doc, text, start = (t.column(c).to_numpy() for c in ("key", "doc_id", "text_key", "start"))
        lists = _lists(t)
        length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        marks, still = settle(doc, text, start.astype(np.int64), length, lists.flatten().to_numpy(zero_copy_only=False))
        last = key == key[-1]
        yield marks, t, still, ~last
        carried, rest = t.filter(pa.array(last & _rows_with(still, length))), (None, t, still, last)
    if rest is not None:
        yield rest


def _lists(t: pa.Table) -> pa.ListArray:
    lists = t.column("passages").combine_chunks()
    return lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists


def _compare_neighbours(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of the passages that two documents hold."""
    for marks, *_ in _settled(rows):
        if marks is not None and marks.num_rows:
            yield marks


def _settle_shares(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each share's open passages, one a row under a key of its own, and its marks (key null)."""
    for marks, t, still, complete in _settled(rows):
        if marks is not None and marks.num_rows:
            yield _mark_rows(marks)
        lists = _lists(t)
        length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(length)), length)
        at = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        some = np.flatnonzero(still & complete[row])
        if len(some):
            passages = pa.array(lists.flatten().to_numpy(zero_copy_only=False)[some])
            doc, text, start = (t.column(c).to_numpy()[row[some]] for c in ("doc_id", "text_key", "start"))
            one = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32)), passages)
            yield _suffix_rows(passages, pa.array(doc), pa.array(text), pa.array((start + at[some]).astype(np.int32)), one)


def _with_hot_settled(found: DataFrame) -> DataFrame:
    """``found`` with the rows of hot keys settled in shares, which hand on one copy of a passage that they hold twice.

    What is handed on goes by its passage, not by the hot key: passages of one key may differ where a shared one ends.
    """
    salt = F.pmod(F.xxhash64("doc_id", "text_key", "start"), F.lit(SALTS))
    shares = found.where("hot").drop("hot").withColumn("salt", salt).repartition("key", "salt").sortWithinPartitions("key", "salt").drop("salt")
    settled = shares.mapInArrow(_settle_shares, SUFFIX)
    return found.where("not hot").drop("hot").unionByName(stored(settled, "suffixes"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, span, start_word, end_word (exclusive), n_words of every maximal repeated span."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = stored(_prefix_counts(docs).where("n > 1"), "prefixes")
    hot = bitmap(shared.where(F.col("n") > HOT).select("key"))  # other keys that it lets through take both steps too, with the same result
    found = _with_hot_settled(stored(_candidates(docs, bitmap(shared.select("key")), hot), "suffixes"))
    within = found.where("key is null").select("doc_id", "text_key", F.col("start").alias("first"), F.col("passages")[0].cast("int").alias("last"))
    across = found.where("key is not null").repartition("key").sortWithinPartitions("key").mapInArrow(_compare_neighbours, MARK)
    ends = within.unionByName(across).groupBy("doc_id", "text_key", "first").agg((F.max("last") + MIN_WORDS).alias("end"))
    order = Window.partitionBy("doc_id", "text_key").orderBy("first")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = ends.withColumn("_new", F.coalesce((F.col("first") > before).cast("int"), F.lit(1)))
    cut = cut.withColumn("span", F.sum("_new").over(order).cast("int"))
    spans = cut.groupBy("doc_id", "text_key", "span").agg(F.min("first").alias("start_word"), F.max("end").alias("end_word"))
    real = F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id"))
    return spans.select(real.alias("doc_id"), "text_key", "span", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in WORD.finditer(fold(text))]
    out, last = [], 0
    for a, b in sorted(spans):
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join([*out, text[last:]])


