"""Graph maintenance (A7): bring stored graphs up to date with pages stored since.

Stored pages never change, so a new page touches only two kinds of edges: its
own, and those of stored pages that already link to it and weigh 0 for want of
a target. Only these are walked for weights, and only the pages at their ends
are read for links and words. A stub whose page has come becomes a page node,
under every spelling; a category's clique is counted anew if a new page is in it.

Rows are replaced by year and key (``replace_rows``), nodes last: a page counts
as known when it has a node, so an update that died runs again in full and puts
the same rows in the same places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revgraph.functions.names import WORD_EDGE_NAME, edge_name
from revgraph.functions.text import title_key
from revgraph.operators.categories import GROUP, category_cliques, category_nodes
from revgraph.operators.links import edges, link_weights, own_exchange, with_title_key, word_weights
from revgraph.operators.links import all_nodes as own_nodes
from revgraph.session import stored
from revgraph.sources.store import read_graph, replace_rows

PAGE_KEY = ["title_key", "year"]


def known_keys(nodes: DataFrame) -> DataFrame:
    """``title_key, year`` of the pages that the node table knows."""
    return nodes.where(~F.col("is_stub")).select(title_key("title").alias("title_key"), "year").distinct()


def unknown_pages(pages: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pages that the node table does not know yet."""
    return with_title_key(pages).join(known_keys(nodes), PAGE_KEY, "left_anti")


def touched_edges(added: DataFrame, stored_edges: DataFrame) -> DataFrame:
    """``src, src_key, year, dst, dst_key``: the new pages' own edges and the stored ones whose target they are."""
    columns = ["src", "src_key", "year", "dst", "dst_key"]
    keyed = stored_edges.select("src", title_key("src").alias("src_key"), "year", "dst", title_key("dst").alias("dst_key"))
    new = own_exchange(added.select(F.col("title_key").alias("dst_key"), "year"), "dst_key", "year")
    incoming = keyed.join(new, ["dst_key", "year"], "left_semi").select(*columns)
    # An update that died may have stored edges of pages that are still unknown: they are the same rows.
    return edges(added).select(*columns).unionByName(incoming).distinct()


def ends_of(edge_keys: DataFrame, pages: DataFrame) -> DataFrame:
    """The pages at either end of the given edges."""
    keys = edge_keys.select(F.col("src_key").alias("title_key"), "year").unionByName(edge_keys.select(F.col("dst_key").alias("title_key"), "year"))
    return pages.join(keys.distinct(), PAGE_KEY, "left_semi")


def changed_nodes(added: DataFrame, nodes: DataFrame) -> DataFrame:
    """``title, year, is_stub`` of the new pages, their targets and the stubs that have found their page."""
    keys = added.select(*PAGE_KEY)
    found = nodes.where("is_stub").select("title", "year", title_key("title").alias("title_key")).join(keys, PAGE_KEY, "left_semi")
    titles = own_nodes(added).select("title", "year").unionByName(found.select("title", "year")).distinct()
    known = known_keys(nodes).unionByName(keys).distinct().withColumn("held", F.lit(True))
    keyed = titles.withColumn("title_key", title_key("title")).join(known, PAGE_KEY, "left")
    return keyed.select("title", "year", F.col("held").isNull().alias("is_stub"))


def update_tables(spark: SparkSession, pages: DataFrame, path: str, include_uncategorised: bool = False) -> int:
    """Bring the five tables under ``path`` up to date with ``pages``; returns the number of new pages."""
    g = read_graph(spark, path)
    keys = stored(unknown_pages(pages.select("title", *[c for c in ("title_key", "year") if c in pages.columns]), g["nodes"]).select(*PAGE_KEY), "new-pages")
    years = sorted(r["year"] for r in keys.select("year").distinct().collect())
    if not years:
        return 0
    within = F.col("year").isin(years)
    pages, g = with_title_key(pages).where(within), {name: df.where(within) for name, df in g.items()}
    added = stored(pages.drop("wordcount").join(keys, PAGE_KEY, "left_semi"), "added")

    touched = stored(touched_edges(added, g["edges"]), "touched-edges")
    ends = stored(ends_of(touched, pages.select(*PAGE_KEY, "links", "wordcount")), "touched-pages")
    replace_rows(spark, path, "edges", link_weights(touched, ends).withColumn("name", edge_name("src", "dst", "year")), years)
    replace_rows(spark, path, "word_edges", word_weights(touched, ends).withColumn("name", F.lit(WORD_EDGE_NAME)), years)

    categories = category_nodes(added, include_uncategorised)
    replace_rows(spark, path, "category_nodes", categories, years)
    groups = own_exchange(categories.select(*GROUP).distinct(), *GROUP)
    members = read_graph(spark, path, ["category_nodes"])["category_nodes"].where(within).join(groups, GROUP, "left_semi")
    replace_rows(spark, path, "cliques", category_cliques(members), years)

    replace_rows(spark, path, "nodes", changed_nodes(added, g["nodes"]), years)
    return keys.count()

