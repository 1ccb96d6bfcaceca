"""A wiki revision corpus derived from the ``documents`` table.

The driver tables hold no wiki markup, so every page revision is built from
one document: four documents per page (``p = doc_id div 4``), two calendar
years, two revisions per year whose timestamps are shared by all pages, and
a markup tail with links to neighbouring pages, dangling targets, a file
link, a template, a heading and two categories (language and source).

So that every rule has rows that exercise it, the last digit of ``p`` sets:
2, 4 links that spell a title with ``_``; 3 namespace titles; 4 titles with
every character that export names rewrite; 5 later revisions under another
spelling of the title; 6 titles that end with ``:``; 7 equal timestamps of a
year's revisions; 8 pages without a category. One revision in five has no
username. The projection is narrow: the parquet scan reads only ``doc_id,
text, lang, source``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``documents`` table, read with its declared schema."""
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


#: Every character that an export profile rewrites.
SPECIAL = " (a+b) – c-d.e's/*’,&!#@$;%?=<>\\^[]{}~`\""


def corpus_revisions(docs: DataFrame) -> DataFrame:
    """Flat revisions ``(title, username, year, timestamp, text, doc_id, pos)``."""
    doc_id = F.col("doc_id")
    p = F.floor(doc_id / 4).cast("bigint")
    k = p % 10
    y = F.lit(2020) + doc_id % 2
    late = F.floor((doc_id % 4) / 2).cast("int")
    m = F.when(k == 7, 0).otherwise(late)
    s = lambda c: c.cast("string")
    plain = F.concat(F.lit("Page "), s(p))
    title = (
        F.when(k == 3, F.concat(F.lit("Talk:"), plain))
        .when(k == 4, F.concat(plain, F.lit(SPECIAL)))
        .when((k == 5) & (late == 1), F.concat(F.lit("PAGE_"), s(p)))
        .when(k == 6, F.concat(plain, F.lit(":")))
        .otherwise(plain)
    )
    tail = F.concat(
        F.when(k.isin(2, 4), " {{Infobox}} == See also == [[Page_").otherwise(" {{Infobox}} == See also == [[Page "), s(p + 1),
        F.lit("|next]] [[page "), s(p + 2),
        F.lit("#s]] [[Page "), s(2 * p),
        F.lit("]] [[File:x.jpg|thumb]] [[Ghost "), s(p % 3),
        F.lit("]]"),
        F.when(k == 8, "").otherwise(F.concat(F.lit(" [[Category:"), F.col("lang"), F.lit("|k]] [[Category:"), F.col("source"), F.lit("]]"))),
    )
    return docs.select(
        title.alias("title"),
        F.when(doc_id % 5 != 0, F.concat(F.lit("user"), s(doc_id % 7))).alias("username"),
        s(y).alias("year"),
        F.concat(s(y), F.lit("-"), F.lpad(s(1 + m), 2, "0"), F.lit("-01T00:00:00Z")).alias("timestamp"),
        F.concat(F.col("text"), tail).alias("text"),
        doc_id,
        doc_id.alias("pos"),
    )


def wiki_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_revisions(documents(spark, sf_dir))


def wiki_dump(spark: SparkSession, sf_dir: str, revisions: DataFrame | None = None) -> DataFrame:
    """The corpus in dump shape: one row per page with its revisions.

    A page holds exactly four revisions by construction (``doc_id div 4``),
    so the per-page list is bounded; revisions are ordered by timestamp, then document.
    """
    rev = wiki_revisions(spark, sf_dir) if revisions is None else revisions
    revision = F.struct("timestamp", "pos", F.struct("username").alias("contributor"), "text")
    pages = rev.groupBy("title").agg(F.sort_array(F.collect_list(revision)).alias("revision"))
    return pages.select("title", F.transform("revision", lambda r: F.struct(r["timestamp"].alias("timestamp"), r["contributor"].alias("contributor"), r["text"].alias("text"))).alias("revision"))


#: Code points that XML 1.0 has no way to write.
NOT_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]"


def xml_text(text: Column) -> Column:
    """``text`` as XML content."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return F.regexp_replace(text, NOT_XML, " ")


def odd_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML lines, one page a document with its whole text, of which some cannot be read: by the last
    digit of ``doc_id`` 7 has a bare ``&`` in its title, 8 no title, 9 a bare ``&`` behind its text."""
    d = documents(spark, sf_dir).select("doc_id", "text", (F.col("doc_id") % 10).alias("k"))
    title = F.concat(F.lit("Odd "), F.when(F.col("k") == 7, "& ").otherwise(""), F.col("doc_id").cast("string"))
    head = F.when(F.col("k") == 8, "").otherwise(F.concat(F.lit("<title>"), title, F.lit("</title>")))
    text = F.concat(xml_text(F.coalesce("text", F.lit(""))), F.when(F.col("k") == 9, " & b").otherwise(""))
    return d.select(F.concat(F.lit("<page>"), head, F.lit("<revision><timestamp>2020-01-01T00:00:00Z</timestamp><text>"), text, F.lit("</text></revision></page>")).alias("value"))
