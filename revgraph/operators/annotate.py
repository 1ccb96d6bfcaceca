"""Per-page annotation: links, categories and word counts.

After ``latest_per_year`` each page is one row, so all annotation is a
narrow projection of that row: no aggregation, join or further shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revgraph.functions.arrays import explode_nonempty, value_counts
from revgraph.functions.text import (
    clean_words,
    extract_categories,
    extract_links,
    remove_stop_words,
    tokenize,
    words_from_kept,
)

KEY = ["title_key", "year"]


def page_features(latest: DataFrame) -> DataFrame:
    """Links and categories of each latest revision."""
    return latest.select(
        "title_key",
        "title",
        "year",
        extract_links("text").alias("links"),
        extract_categories("text").alias("categories"),
    )


def page_words(latest: DataFrame) -> DataFrame:
    """E7 per page: ``title_key, title, year, words`` (array, in text order)."""
    return clean_words(latest.select("title_key", "title", "year", "text"), "text", "words").drop("text")


def annotate(latest: DataFrame) -> DataFrame:
    """Year-pages: ``title_key, title, year, links, categories, wordcount``.

    ``wordcount`` (A3 + A9) is counted inside the row by sorting the page's
    words; a page's map can never be larger than its own text.
    """
    cols = ["title_key", "title", "year", "links", "categories"]
    feats = latest.select(
        "title_key",
        "title",
        "year",
        extract_links("text").alias("links"),
        extract_categories("text").alias("categories"),
        tokenize("text").alias("_tokens"),
    )
    kept = remove_stop_words(feats, "_tokens", "_kept")
    return value_counts(kept, words_from_kept("_kept"), "wordcount", keep=cols)


def word_count(latest: DataFrame) -> DataFrame:
    """A3: ``title_key, title, year, word, n`` with ``n`` the occurrences."""
    tokens = latest.select("title_key", "title", "year", tokenize("text").alias("_tokens"))
    kept = remove_stop_words(tokens, "_tokens", "_kept")
    counted = value_counts(kept, words_from_kept("_kept"), "wordcount", keep=["title_key", "title", "year"])
    gen, nonempty = explode_nonempty("wordcount", "word", "n")
    return counted.select("title_key", "title", "year", gen).filter(nonempty)


def word_maps(counts: DataFrame) -> DataFrame:
    """A9 from a long count table: a page's counts as ``map<word, n>``.

    One page's map has at most as many entries as the page has tokens, so
    the group is bounded by a single page.
    """
    return counts.groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("wordcount"))
