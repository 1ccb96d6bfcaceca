"""Category graph.

A node is one (page, year, category); two nodes are linked when they share
category and year, so each (category, year) is a clique. The clique is kept
as its member table plus counts: all pairs would grow with the square of the
largest category. Pair-level questions are joins on membership whose output
grows with the pages asked about, not with the square of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revgraph.functions.arrays import explode_nonempty
from revgraph.operators.links import own_exchange

GROUP = ["category", "year"]


def category_nodes(pages: DataFrame, include_uncategorised: bool = False) -> DataFrame:
    """``title, year, category``; one row per distinct category of a page.

    With ``include_uncategorised`` a page without categories becomes a node
    of category ``""`` (and all such pages one clique), as the original job
    did; by default they are left out, as is an empty category name.
    """
    cats = F.col("categories")
    if include_uncategorised:
        cats = F.when(F.size(cats) > 0, cats).otherwise(F.array(F.lit("")))
    gen, nonempty = explode_nonempty(cats, "category")
    nodes = pages.select("title", "year", gen).filter(nonempty)
    if not include_uncategorised:
        nodes = nodes.filter(F.col("category") != "")
    return nodes


def category_cliques(nodes: DataFrame) -> DataFrame:
    """J6 in compact form: per (category, year) its size and number of undirected edges."""
    n = F.count(F.lit(1))
    return nodes.groupBy(*GROUP).agg(n.alias("n_pages")).withColumn(
        "n_pairs", (F.col("n_pages") * (F.col("n_pages") - 1) / 2).cast("bigint")
    )


def category_link_count(cliques: DataFrame) -> DataFrame:
    """The ``count(p)`` of the linking statement: every node once per partner."""
    return cliques.agg(F.coalesce(F.sum(2 * F.col("n_pairs")), F.lit(0)).cast("bigint").alias("link_count"))


def category_degree(nodes: DataFrame, cliques: DataFrame) -> DataFrame:
    """Degree of each category node: members of its clique minus itself.

    The cliques get an exchange of their own, so a category that holds a large
    share of all pages is split by the adaptive skew join.
    """
    return nodes.join(own_exchange(cliques.select(*GROUP, "n_pages"), *GROUP), GROUP).select(
        "title", "year", "category", (F.col("n_pages") - 1).alias("degree")
    )


def category_partners(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Partners of the given ``(title, year)`` pages: ``title, year, category, partner``.

    Output size is the sum of the clique sizes of the pages asked for: meant
    for a few pages; with the whole node table it would be all pairs.
    """
    asked = pages.select("title", "year").distinct().join(nodes, ["title", "year"])
    others = nodes.select(F.col("title").alias("partner"), *GROUP)
    return asked.join(others, GROUP).filter(F.col("partner") != F.col("title")).select(
        "title", "year", "category", "partner"
    )


def category_linked(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Shared categories of given page pairs ``(a, b, year)``: ``a, b, year, category``."""
    na = nodes.select(F.col("title").alias("a"), "year", "category")
    nb = nodes.select(F.col("title").alias("b"), "year", "category")
    return pairs.select("a", "b", "year").filter(F.col("a") != F.col("b")).join(na, ["a", "year"]).join(
        nb, ["b", "year", "category"]
    ).select("a", "b", "year", "category")
