"""From dump pages to the latest revision of each page in each year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revgraph.functions.text import revision_year, title_key


def flatten_revisions(pages: DataFrame) -> DataFrame:
    """One row per revision: ``title, username, year, timestamp, text, pos``.

    ``pos`` is the revision's position inside its page (ties on timestamp are
    broken by it); a missing ``<text>`` becomes ``""``.
    """
    rev = pages.select("title", F.posexplode("revision").alias("pos", "r"))
    return rev.select(
        "title",
        F.col("r.contributor.username").alias("username"),
        revision_year(F.col("r.timestamp")).alias("year"),
        F.col("r.timestamp").alias("timestamp"),
        F.coalesce(F.col("r.text"), F.lit("")).alias("text"),
        "pos",
    )


def latest_per_year(revisions: DataFrame) -> DataFrame:
    """The latest revision of each page in each calendar year.

    The page key is the lower-cased title with ``_`` for space, so titles
    differing only in case or in space/underscore are one page. ISO-8601
    timestamps order as text; on equal timestamps the later position wins.
    ``row_number() = 1`` lets Spark keep only the top row per key on the map
    side before the single shuffle on ``(title_key, year)``; the output stays
    hash-partitioned on those columns for later per-page work.
    """
    # A page without a title cannot be stored or linked to. Stating the
    # filter here (instead of letting a later join infer it on one side only)
    # keeps every consumer's plan identical up to the shuffle, so Spark reuses
    # that one exchange.
    others = [c for c in revisions.columns if c not in ("title", "pos")]
    has_pos = "pos" in revisions.columns
    keyed = revisions.select(
        F.lower("title").alias("title"), title_key("title").alias("title_key"), *others, *(["pos"] if has_pos else [])
    ).filter(F.col("title_key").isNotNull() & F.col("year").isNotNull())
    order = [F.col("timestamp").desc_nulls_last()] + ([F.col("pos").desc()] if has_pos else [])
    w = Window.partitionBy("title_key", "year").orderBy(*order)
    ranked = keyed.select("title", "title_key", *others, F.row_number().over(w).alias("_rn"))
    return ranked.filter(F.col("_rn") == 1).select("title", "title_key", *others)


def latest_per_piece(revisions: DataFrame) -> DataFrame:
    """The latest revision of each page, or unnamed piece of one, per year and block of a parsed dump.

    A revision that waits for its title counts for its block: all of a block's
    are of the one page open at its start. Namespace pages go, rejected rows
    all stay. Keeping blocks apart lets the window start on the map side and
    keeps a page with a long history spread over the blocks that hold it.
    """
    kept = revisions.where(F.col("title").isNull() | F.col("reject_reason").isNotNull() | ~F.col("title").rlike(":[^:]"))
    own = F.when(F.col("reject_reason").isNotNull(), F.col("row"))
    w = Window.partitionBy("file", "block", title_key("title"), own, "year").orderBy(F.col("timestamp").desc_nulls_last(), F.col("row").desc())
    return kept.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def distinct_years(revisions: DataFrame) -> DataFrame:
    """A2: the calendar years present, in order."""
    return revisions.select("year").distinct().orderBy("year")


def main_titles(pages: DataFrame, col: str = "title") -> DataFrame:
    """Keep titles without a namespace prefix.

    A title is dropped when a ``:`` is followed by a non-``:`` character
    (``a:b``, ``:b``); ``foo``, ``foo:`` and ``::`` are kept.
    """
    return pages.filter(~F.coalesce(F.col(col).rlike(":[^:]"), F.lit(False)))


def page_counts(pages: DataFrame) -> DataFrame:
    """A4: number of pages per year."""
    return pages.groupBy("year").agg(F.count(F.lit(1)).alias("n_pages"))
