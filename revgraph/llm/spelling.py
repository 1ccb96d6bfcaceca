"""Spelling variants by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point turns one
into the other. Of two near words the shorter (or, at equal length, either)
contributes two disjoint chunks, its halves of ``q = length // 2`` code points;
the other its positional grams of that size. One edit touches one chunk at most,
so the other chunk stands in the longer word as a gram, at its own place or one
further on: a join on (length, place of the chunk, gram) within that shift finds
every pair, and an edit distance verifies it. Grams at other places meet no
chunk and are never sent, so a word of any length sends six grams at most.

Hot keys. A gram that more than ``HOT`` words share would pair all of them. Its
words are joined once more by the gram and the rest of the word with one code
point left out: two near words that share a chunk differ by one edit in the
rest, so they agree there, and a word sends as many rows as it has code points.
Nothing is capped, and no group is paired with itself.

Everything is DataFrame functions. A text is cut into words inside its row, and
counts are combined before the shuffle, so frequent words move once per task.

Defined results: null and empty texts have no words; a null id reads as an empty
one; repeated rows count each; ties of n go to the smaller word in code-point
order; an empty table gives no rows; only ``doc_id`` and ``text`` are read, so
other columns may have any name. A very long text becomes one array of its words
in one row. A run may be of any length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revgraph.functions.arrays import explode_nonempty
from revgraph.llm.common import stored

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A word's form occurs at least so many times as often as the word.
TIMES = 5
#: One occurrence in so many, by hash, loses a code point.
DAMAGE = 199
#: Words of one key from which on they are joined by the rest of the word as well.
HOT = 512


def lower_ascii(run: Column) -> Column:
    """Lower case of A-Z only. Of a run in ASCII that is its lower case, which Spark finds much faster."""
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def damaged(doc_id: Column, run: Column, every: int = DAMAGE) -> Column:
    """The run without one code point where the hash of ``<doc_id>:<run>`` is divisible by ``every``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int | None = DAMAGE) -> DataFrame:
    """``word, n``: the distinct words of all texts that are long and frequent enough."""
    gen, nonempty = explode_nonempty("runs", "run")
    runs = docs.select(F.col("doc_id"), F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), 0).alias("runs"))
    run = runs.select("doc_id", gen).where(nonempty).select("doc_id", lower_ascii(F.col("run")).alias("run"))
    word = run.select((damaged(F.col("doc_id"), F.col("run"), damage) if damage else F.col("run")).alias("word"))
    counts = word.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


KEY = ["len", "at", "gram"]


def chunks(vocabulary: DataFrame) -> DataFrame:
    """``len, at, gram, word, n``: each word's two disjoint chunks."""
    length, word = F.char_length("word"), F.col("word")
    q = F.floor(length / 2).cast("int")
    places = F.array(F.lit(0), q)
    own = vocabulary.select("word", "n", length.alias("len"), q.alias("q"), F.explode(places).alias("at"))
    return own.select("len", "at", F.substring(word, F.col("at") + 1, F.col("q")).alias("gram"), "word", "n")


def grams(vocabulary: DataFrame) -> DataFrame:
    """``len, at, gram, word, n``: each word's positional grams, under the length and place of the chunks that they can meet.

    Chunks of words of the same length stand where the gram does (a replaced
    code point shifts nothing); those of words shorter by one stand there or
    one before.
    """
    length, word = F.char_length("word"), F.col("word")
    places = []
    for shorter in (0, 1):
        q = F.floor((length - shorter) / 2).cast("int")
        for at in (F.lit(0), q):
            places += [F.struct((length - shorter).alias("len"), at.alias("at"), (at + shift).alias("from"), q.alias("q")) for shift in range(shorter + 1)]
    own = vocabulary.select("word", "n", F.explode(F.array(*places)).alias("p"))
    return own.select("p.len", "p.at", F.substring(word, F.col("p.from") + 1, F.col("p.q")).alias("gram"), "word", "n", F.col("p.from").alias("from"))


def _met(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Verified pairs of a chunk's word and a gram's word with equal keys."""
    left = a.select(*keys, F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = b.select(*keys, F.col("word").alias("b"), F.col("n").alias("n_b"))
    once = (F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b"))
    return left.join(right, keys).where(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b")


def _rests(rows: DataFrame, start: Column, shorter: bool) -> DataFrame:
    """The rows with ``rest``: what stands around the gram with one code point left out, and the place of the gap where it matters.

    A replaced code point is left out on both sides, at the same place; an
    inserted one on the longer side only (``shorter``: keep the rest whole).
    """
    around = F.concat(F.substring("word", F.lit(1), start), F.lit("\x00"), F.substring(F.col("word"), start + F.char_length("gram") + 1, F.char_length("word")))
    out = rows.withColumn("around", around)
    if shorter:
        return out.withColumn("rest", F.xxhash64("around"))
    gap = F.explode(F.sequence(F.lit(1), F.char_length("around"))).alias("gap")
    out = out.select(*out.columns, gap).where(F.substring("around", F.col("gap"), F.lit(1)) != "\x00")
    return out.withColumn("rest", F.xxhash64(F.concat(F.substring("around", F.lit(1), F.col("gap") - 1), F.expr("substring(around, gap + 1, char_length(around))"))))


def near_pairs(vocabulary: DataFrame, hot: int = HOT) -> DataFrame:
    """``a, n_a, b, n_b``: every two words that are one edit apart, once."""
    a, b = chunks(vocabulary), grams(vocabulary)
    full = stored(b.groupBy(*KEY).agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > hot).select(*KEY), "hot-grams")
    found = _met(a.join(full, KEY, "left_anti"), b.join(full, KEY, "left_anti"), KEY)
    if full.isEmpty():
        return found.distinct()
    # The same chunks and grams of hot keys, apart by the rest of the word.
    a, b = a.join(full, KEY, "left_semi"), b.join(full, KEY, "left_semi")
    same, longer = b.where(F.char_length("word") == F.col("len")), b.where(F.char_length("word") > F.col("len"))
    replaced = _met(_rests(a, F.col("at"), False), _rests(same, F.col("from"), False), [*KEY, "gap", "rest"])
    inserted = _met(_rests(a, F.col("at"), True), _rests(longer, F.col("from"), False), [*KEY, "rest"])
    return found.unionByName(replaced).unionByName(inserted).distinct()


def forms(vocabulary: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, n, n_near, form, form_n``: the most frequent near word, if it is ``times`` as frequent."""
    a = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n"))
    both = a.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    out = vocabulary.join(best, "word", "left")
    chosen = -F.col("best.less") >= times * F.col("n")
    return out.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, root`` of the words that have a form: the last word that forms lead to.

    Each form is ``times`` as frequent as its word, so a chain has at most
    log(most frequent / least frequent) steps; pointers double in every round.
    """
    hop = stored(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"), "n", "form_n"), "forms")
    ends = hop.agg(F.min("n").alias("low"), F.max("form_n").alias("high")).first()
    hop = hop.select("word", "root")
    if ends["low"] is None:
        return hop
    steps = int(math.log(ends["high"] / ends["low"], times) + 1e-9) + 1
    for _ in range(math.ceil(math.log2(steps + 1))):
        onward = hop.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        hop = stored(hop.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots")
    return hop


def variants(docs: DataFrame, damage: int | None = DAMAGE, hot: int = HOT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``."""
    vocabulary = stored(words(docs, damage=damage), "words")
    formed = stored(forms(vocabulary, near_pairs(vocabulary, hot)), "formed")
    out = formed.join(roots(formed), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
