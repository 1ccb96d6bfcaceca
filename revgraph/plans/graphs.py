"""End-to-end plans: dump -> year-page store -> graphs.

Steps are lazy DataFrames. Materialised are the store (the lineage cut between
ingest and graph building, as in the original jobs), the latest revisions of a
dump while they wait for titles and for the store's keys, and pages that a
graph plan reads several times, all in the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revgraph.functions.names import WORD_EDGE_NAME, edge_name
from revgraph.operators.annotate import annotate
from revgraph.operators.categories import category_cliques, category_nodes
from revgraph.operators.links import all_nodes, link_edges, walked_rows, word_edges
from revgraph.operators.revisions import latest_per_piece, latest_per_year, main_titles
from revgraph.plans.maintenance import update_tables
from revgraph.session import size_shuffle_for, stored
from revgraph.sources.dump import REJECT, parse_revisions, read_chunks, split_ends, with_titles
from revgraph.sources.store import clustered, committed, compat_pages, graph_stored, new_batch, read_graph, read_pages, unstored, write_batch, write_graph, write_json_by_year


@dataclass
class Graph:
    nodes: DataFrame
    edges: DataFrame


@dataclass
class CategoryGraph:
    nodes: DataFrame
    cliques: DataFrame


def build_pages(revisions: DataFrame, only_main: bool = True, in_order: bool = False) -> DataFrame:
    """Flat revisions -> year-pages (latest revision, annotated), if asked in the order of the store.

    The namespace test gives the same answer for every revision of a page
    key (case and space/underscore do not change whether a ``:`` is followed
    by another character), so it runs before the shuffle: revisions of
    talk, user and other namespace pages are never moved.
    """
    if only_main:
        revisions = main_titles(revisions)
    latest = latest_per_year(revisions)
    return annotate(clustered(latest) if in_order else latest)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: written as Parquet to the shared checkpoint folder, so later plans still prune columns."""
    return stored(df, "pages")


def _store_latest(latest: DataFrame, store_path: str, fmt: str, batch: str, rejects: int = 0) -> None:
    """Add the pages of stored latest revisions that the store lacks, as one batch.

    Pages already stored are dropped on the window's own key, and the rest is
    put in the store's order, before any text work.
    """
    pages = annotate(clustered(unstored(latest, store_path, fmt)))
    write_batch(pages, store_path, batch, fmt, rejects=rejects, in_order=True)


def store_revisions(revisions: DataFrame, store_path: str, fmt: str = "parquet", batch: str | None = None) -> None:
    """Add the pages of ``revisions`` that are not stored yet.

    The latest revisions are stored in between, so neither finding their
    years nor a lost executor reads the revisions again.
    """
    latest = stored(latest_per_year(main_titles(revisions)), "latest")
    _store_latest(latest, store_path, fmt, batch or new_batch())


def ingest_chunks(chunks: DataFrame, store_path: str, fmt: str = "parquet", batch: str | None = None) -> int:
    """Dump text in revision-sized chunks -> year-page store; returns the number of rejected revisions.

    Each page is cut down to its latest revision per year and block before its
    title is known everywhere: revisions at a block's start wait under the
    block's name, then get the title of the page open there. What could not be
    read goes to ``<store>_rejects/batch=<name>``, as JSON.

    A named ``batch`` may be run again after a failure at any step: its folders
    are overwritten until its commit, the last step, and after it nothing is
    done but to return the number that the commit recorded.
    """
    spark, batch = chunks.sparkSession, batch or new_batch()
    done = committed(spark, store_path, batch)
    if done:
        return done["rejects"]
    pieces = stored(latest_per_piece(parse_revisions(chunks)), "pieces")
    revisions = with_titles(*split_ends(pieces))
    rejects = stored(revisions.where("reject_reason IS NOT NULL").select(*REJECT), "rejects")
    n = rejects.count()
    if n:
        rejects.write.mode("overwrite").json(f"{store_path.rstrip('/')}_rejects/batch={batch}")
    good = revisions.where("reject_reason IS NULL").withColumn("pos", F.struct("block", "row"))
    latest = stored(latest_per_year(main_titles(good.select("title", "username", "year", "timestamp", "text", "pos"))), "latest")
    _store_latest(latest, store_path, fmt, batch, n)
    return n


def ingest(spark: SparkSession, dump_paths, store_path: str, fmt: str = "parquet") -> int:
    """The first job: every dump file in one pass, first write wins per (year, page); returns the rejects' number."""
    return ingest_chunks(read_chunks(spark, dump_paths), store_path, fmt)


def export_pages(spark: SparkSession, store_path: str, out_path: str, fmt: str = "parquet") -> None:
    """The store as JSON rows ``Title, Year, Links, Categories, Wordcount``, by year."""
    write_json_by_year(compat_pages(read_pages(spark, store_path, fmt)), out_path)


def link_graph(pages: DataFrame) -> Graph:
    """G1: nodes and shared-link edges with their names."""
    e = link_edges(pages).withColumn("name", edge_name("src", "dst", "year"))
    return Graph(all_nodes(pages), e)


def word_graph(pages: DataFrame) -> Graph:
    """Nodes and word-similarity edges."""
    e = word_edges(pages).withColumn("name", F.lit(WORD_EDGE_NAME))
    return Graph(all_nodes(pages), e)


def category_graph(pages: DataFrame, include_uncategorised: bool = False) -> CategoryGraph:
    """Category nodes and their cliques."""
    nodes = category_nodes(pages, include_uncategorised)
    return CategoryGraph(nodes, category_cliques(nodes))


#: Bytes of a walked item row in a shuffle: two titles, a year, an item and its count.
WALKED_ROW_BYTES = 120


def graph_tables(pages: DataFrame, include_uncategorised: bool = False) -> dict[str, DataFrame]:
    """Every table of the graph store."""
    lg, wg, cg = link_graph(pages), word_graph(pages), category_graph(pages, include_uncategorised)
    return {"nodes": lg.nodes, "edges": lg.edges, "word_edges": wg.edges, "category_nodes": cg.nodes, "cliques": cg.cliques}


def build_graphs(
    spark: SparkSession, store_path: str, graph_path: str, fmt: str = "parquet", include_uncategorised: bool = False, mode: str = "overwrite"
) -> None:
    """The graph jobs over a stored year-page table, written as graph tables.

    ``mode="merge"`` brings tables that are there already up to date: only
    edges that pages stored since touch are walked (``plans.maintenance``).
    The widest shuffle is that of the word walks; unless the deployment set a
    number of shuffle partitions, it follows from the rows they read.
    """
    pages = read_pages(spark, store_path, fmt)
    if mode == "merge":
        if graph_stored(spark, graph_path):
            update_tables(spark, pages, graph_path, include_uncategorised)
            return
        mode = "overwrite"
    size_shuffle_for(spark, lambda: walked_rows(pages, F.size("wordcount")).first()["rows"] * WALKED_ROW_BYTES)
    write_graph(graph_tables(pages, include_uncategorised), graph_path, mode=mode)


def load_graphs(spark: SparkSession, graph_path: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return read_graph(spark, graph_path, fmt=fmt)
