"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the whole ``documents`` table of ``sf_dir`` and derives the
wiki corpus from it (``sources.corpus``), so its work grows with the data.
Computed columns carry the same names as in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revgraph.functions.arrays import explode_nonempty
from revgraph.functions.names import edge_name, graph_safe_name, node_variable
from revgraph.functions.text import array_to_text, strip_markup, wordcount_text
from revgraph.operators import (
    all_nodes,
    category_cliques,
    category_components,
    category_degree,
    category_link_count,
    category_linked,
    category_nodes,
    category_partners,
    distinct_years,
    edges,
    flatten_revisions,
    graph_endpoints,
    latest_per_year,
    link_edges,
    main_titles,
    page_counts,
    page_words,
    paths,
    resolve_links,
    strongest_word_edges,
    stub_nodes,
    word_count,
    word_edges,
)
from revgraph.plans.graphs import build_graphs, build_pages, checkpointed, graph_tables, load_graphs, store_revisions
from revgraph.plans.views import ask, run_sample
from revgraph.session import scratch_path
from revgraph.sources.corpus import odd_dump, wiki_dump, wiki_revisions
from revgraph.sources.dump import read_revisions, rejected_revisions, write_dump
from revgraph.sources.store import compact, compat_pages, find_pages, pages_where, read_graph, read_pages, vacuum, write_graph, write_pages

REVISION_COLUMNS = ["title", "username", "year", "timestamp", "text"]


def _latest(spark, sf):
    return latest_per_year(wiki_revisions(spark, sf))


def _pages(spark, sf):
    return build_pages(wiki_revisions(spark, sf))


def _graph_pages(spark, sf, words: bool = False):
    """Year-pages for graph building, cut from their lineage once.

    A graph plan reads the pages several times (edges, targets, items); a
    reliable checkpoint in the shared checkpoint folder stands in for the
    stored page table of the two-job flow. Link graphs do not need the word
    maps, so they are not computed for them.
    """
    pages = build_pages(wiki_revisions(spark, sf))
    return checkpointed(pages if words else pages.drop("wordcount"))


def _n_words(wordcount) -> F.Column:
    return F.aggregate(F.map_values(wordcount), F.lit(0).cast("bigint"), lambda a, x: a + x)


# --------------------------------------------------------------- revisions

def q_flatten_revisions(spark, sf):
    return flatten_revisions(wiki_dump(spark, sf)).select(*REVISION_COLUMNS)


def q_xml_round_trip(spark, sf):
    path = scratch_path(spark, "dump")
    write_dump(wiki_dump(spark, sf), path)
    return read_revisions(spark, path).select(*REVISION_COLUMNS)


def q_rejected_revisions(spark, sf):
    """Dump text of which some revisions and page heads cannot be read: each is reported with its reason."""
    path = scratch_path(spark, "odd-dump")
    odd_dump(spark, sf).write.text(path)
    return rejected_revisions(spark, path).select("title", "timestamp", "record", "reject_reason")


def q_latest_per_year(spark, sf):
    return _latest(spark, sf).select("title", "year", "timestamp", "text")


def q_distinct_years(spark, sf):
    return distinct_years(wiki_revisions(spark, sf))


def q_main_titles(spark, sf):
    return main_titles(_latest(spark, sf)).select("title", "year")


def q_page_counts(spark, sf):
    return page_counts(_pages(spark, sf))


# --------------------------------------------------------------- text

def q_extract_links(spark, sf):
    gen, nonempty = explode_nonempty("links", "link")
    return _pages(spark, sf).select("title", "year", gen).filter(nonempty)


def q_extract_categories(spark, sf):
    gen, nonempty = explode_nonempty("categories", "category")
    return _pages(spark, sf).select("title", "year", gen).filter(nonempty)


def q_strip_markup(spark, sf):
    return _latest(spark, sf).select("title", "year", strip_markup("text").alias("stripped"))


def q_clean_words(spark, sf):
    w = page_words(main_titles(_latest(spark, sf)))
    return w.select("title", "year", F.array_join("words", " ").alias("words"), F.size("words").alias("n_words"))


def q_word_count(spark, sf):
    return word_count(main_titles(_latest(spark, sf))).select("title", "year", "word", "n")


def q_page_features(spark, sf):
    p = _pages(spark, sf)
    return p.select(
        "title",
        "year",
        F.size("links").alias("n_links"),
        F.size("categories").alias("n_categories"),
        F.size("wordcount").alias("n_distinct_words"),
        _n_words("wordcount").alias("n_words"),
    )


def q_word_count_text(spark, sf):
    return _pages(spark, sf).select("title", "year", wordcount_text("wordcount").alias("wordcount_text"))


def q_title_key(spark, sf):
    return _pages(spark, sf).select("title", "year", "title_key")


# --------------------------------------------------------------- store

def _store_view(pages: DataFrame) -> DataFrame:
    return pages.select(
        "title",
        "year",
        array_to_text("links").alias("links_text"),
        array_to_text("categories").alias("categories_text"),
        wordcount_text("wordcount").alias("wordcount_text"),
    )


def q_pages_round_trip(spark, sf):
    path = scratch_path(spark, "pages")
    write_pages(build_pages(wiki_revisions(spark, sf), in_order=True), path, mode="overwrite", in_order=True)
    return _store_view(read_pages(spark, path))


def q_pages_first_write_wins(spark, sf):
    """Store year 2020 first, then pages built from January revisions only.

    The second write must add the 2021 pages and leave every 2020 page as
    first written.
    """
    path = scratch_path(spark, "pages")
    rev = wiki_revisions(spark, sf)
    store_revisions(rev.filter(F.col("year") == "2020"), path)
    store_revisions(rev.filter(F.substring("timestamp", 6, 2) == "01"), path)
    stored = read_pages(spark, path)
    return stored.select(
        "title", "year", _n_words("wordcount").alias("n_words"),
        array_to_text("links").alias("links_text"), array_to_text("categories").alias("categories_text"),
    )


def q_pages_where(spark, sf):
    """S6/P5 over a written store: a whole year, and every year of one title in another spelling."""
    path = scratch_path(spark, "pages")
    write_pages(build_pages(wiki_revisions(spark, sf), in_order=True), path, mode="overwrite", in_order=True)
    cols = ["title", "year", F.size("links").alias("n_links")]
    year = pages_where(read_pages(spark, path), year="2021").select(F.lit("year").alias("asked"), *cols)
    return year.unionByName(find_pages(spark, path, "pAgE_5").select(F.lit("title").alias("asked"), *cols))


def q_store_compaction(spark, sf):
    """Six deliveries as six batches, folded into one, one more delivery, folded again; replaced folders removed."""
    path = scratch_path(spark, "pages")
    rev = wiki_revisions(spark, sf)
    part = F.floor(F.col("doc_id") / 4) % 7
    for i in range(7):
        store_revisions(rev.filter(part == i), path, batch=f"delivery-{i}")
        if i >= 5:
            compact(spark, path)
    vacuum(spark, path)
    return _store_view(read_pages(spark, path))


def q_compat_pages(spark, sf):
    c = compat_pages(_pages(spark, sf))
    return c.select("Title", "Year", *[array_to_text(x).alias(x) for x in ("Links", "Categories", "Wordcount")])


def q_streaming_ingest(spark, sf):
    """Two dump deliveries through the ingest stream: January revisions, then
    February ones. The second run processes only the new files and, as every
    (year, page) is already stored, keeps the January versions."""
    from revgraph.streaming import ingest_stream

    base = scratch_path(spark, "stream")
    rev = wiki_revisions(spark, sf)
    month = F.substring("timestamp", 6, 2)
    store, checkpoint, files = f"{base}/store", f"{base}/checkpoint", f"{base}/dumps/*/part-*"
    for i, m in enumerate(["01", "02"]):
        write_dump(wiki_dump(spark, sf, rev.filter(month == m)), f"{base}/dumps/{i}")
        ingest_stream(spark, files, store, checkpoint).awaitTermination()
    stored = read_pages(spark, store)
    return stored.select(
        "title", "year", _n_words("wordcount").alias("n_words"),
        array_to_text("links").alias("links_text"), array_to_text("categories").alias("categories_text"),
    )


# --------------------------------------------------------------- link graph

def q_resolve_links(spark, sf):
    return resolve_links(_pages(spark, sf)).select("src", "dst", "year", "dst_found")


def q_stub_nodes(spark, sf):
    return stub_nodes(_pages(spark, sf))


def q_all_nodes(spark, sf):
    return all_nodes(_pages(spark, sf))


def q_graph_endpoints(spark, sf):
    p = _graph_pages(spark, sf)
    return graph_endpoints(all_nodes(p), edges(p))


def q_link_edges(spark, sf):
    return link_edges(_graph_pages(spark, sf))


def q_word_edges(spark, sf):
    e = word_edges(_graph_pages(spark, sf, words=True))
    return e.select("src", "dst", "year", F.round("weight", 6).alias("weight"))


def q_edge_name(spark, sf):
    e = edges(_pages(spark, sf))
    return e.select("src", "dst", "year", edge_name("src", "dst", "year").alias("name"))


def q_graph_safe_name(spark, sf):
    n = all_nodes(_pages(spark, sf))
    return n.select(
        "title",
        "year",
        node_variable("title", "link").alias("link_name"),
        node_variable("title", "word").alias("word_name"),
        graph_safe_name("title", "word_edge").alias("word_edge_text"),
        graph_safe_name("title", "category").alias("category_text"),
        graph_safe_name("title", "category_label").alias("category_label"),
        node_variable("title", "category_page").alias("category_page"),
    )


def _graph_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Every column of every graph table, in one shape."""
    none, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    shapes = {
        "nodes": ("title", none, none, F.col("is_stub").cast("double"), number),
        "edges": ("src", F.col("dst"), F.col("name"), F.col("weight").cast("double"), number),
        "word_edges": ("src", F.col("dst"), F.col("name"), F.round("weight", 6), number),
        "category_nodes": ("title", F.col("category"), none, number, number),
        "cliques": ("category", none, none, F.col("n_pages").cast("double"), F.col("n_pairs").cast("double")),
    }
    out = None
    for name, df in tables.items():
        a, b, edge, x, y = shapes[name]
        rows = df.select(F.lit(name).alias("tbl"), "year", F.col(a).alias("a"), b.alias("b"), edge.alias("name"), x.alias("x"), y.alias("y"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_graph_round_trip(spark, sf):
    path = scratch_path(spark, "graph")
    write_graph(graph_tables(_graph_pages(spark, sf, words=True)), path)
    return _graph_rows(read_graph(spark, path))


def q_graph_merge(spark, sf):
    """Two thirds of January's pages, stored and made into graphs; then the others, to which many of the first
    link, merged in, and once more with nothing new."""
    base = scratch_path(spark, "graph")
    january = wiki_revisions(spark, sf).filter(F.substring("timestamp", 6, 2) == "01")
    late = F.floor(F.col("doc_id") / 4) % 3 == 1
    for delivery in (january.filter(~late), january.filter(late), january.limit(0)):
        store_revisions(delivery, f"{base}/store")
        build_graphs(spark, f"{base}/store", f"{base}/graph", mode="merge")
    return _graph_rows(load_graphs(spark, f"{base}/graph"))


def _views(spark, sf):
    """Nodes and edges for questions that ask for no weights."""
    p = _graph_pages(spark, sf)
    return {"nodes": all_nodes(p), "edges": edges(p).select("src", "dst", "year")}


def q_out_degree(spark, sf):
    return run_sample(spark, "out_degree", _views(spark, sf))


def q_neighbours(spark, sf):
    return run_sample(spark, "neighbours", _views(spark, sf))


def q_top_edges(spark, sf):
    return run_sample(spark, "top_edges", {"edges": link_edges(_graph_pages(spark, sf))}, k=10)


def q_top_word_edges(spark, sf):
    """The strongest word edges, found without walking those that cannot be among them."""
    return strongest_word_edges(_graph_pages(spark, sf, words=True), 10)[0].select("year", "rank", "src", "dst", "weight")


def q_link_paths(spark, sf):
    """Pages up to four links away from page 1, and those that reach page 5 by up to two."""
    p = _graph_pages(spark, sf)
    e = edges(p).select("src", "dst", "year")
    page = lambda n: p.where(F.col("title_key") == f"page_{n}").select("title_key", "year")
    out = paths(e, page(1), 4).withColumn("direction", F.lit("out"))
    return out.unionByName(paths(e, page(5), 2, "in").withColumn("direction", F.lit("in")))


def q_stored_graph_question(spark, sf):
    """Graph tables written, opened as views and asked in SQL."""
    path = scratch_path(spark, "graph")
    write_graph(graph_tables(_graph_pages(spark, sf, words=True)), path)
    return ask(spark, path, """
        SELECT n.year, n.is_stub, COUNT(DISTINCT n.title) AS n_targets, COUNT(e.src) AS n_links
        FROM {nodes} n JOIN {edges} e ON e.dst = n.title AND e.year = n.year GROUP BY n.year, n.is_stub""")


# --------------------------------------------------------------- categories

def q_category_nodes(spark, sf):
    return category_nodes(_pages(spark, sf)).select("title", "year", "category")


def q_category_nodes_all(spark, sf):
    """With the pages that have no category, as nodes of category ``""``, and what their cliques come to."""
    nodes = category_nodes(_pages(spark, sf), include_uncategorised=True)
    return category_degree(nodes, category_cliques(nodes))


def q_category_edges(spark, sf):
    return category_cliques(category_nodes(_pages(spark, sf)))


def q_category_link_count(spark, sf):
    return category_link_count(category_cliques(category_nodes(_pages(spark, sf))))


def q_category_degree(spark, sf):
    nodes = category_nodes(_pages(spark, sf))
    return category_degree(nodes, category_cliques(nodes))


def q_category_partners(spark, sf):
    """Who shares a category with pages 1 and 20."""
    nodes = checkpointed(category_nodes(_pages(spark, sf)))
    asked = nodes.where(F.col("title").isin("page 1", "page 20")).select("title", "year")
    return category_partners(nodes, asked)


def q_category_linked(spark, sf):
    """The categories that the two ends of each link share."""
    p = _graph_pages(spark, sf)
    pairs = edges(p).select(F.col("src").alias("a"), F.col("dst").alias("b"), "year")
    return category_linked(category_nodes(p), pairs)


def q_category_components(spark, sf):
    """Components by all memberships of pages in categories, and by an eighth of them, which leaves more than one."""
    nodes = checkpointed(category_nodes(_pages(spark, sf)))
    some = nodes.where(F.substring(F.md5(F.concat("title", F.lit(" "), "category").cast("binary")), 1, 1).isin("0", "1"))
    both = category_components(nodes).withColumn("of", F.lit("all"))
    return both.unionByName(category_components(some).withColumn("of", F.lit("some")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flatten_revisions": q_flatten_revisions,
    "xml_round_trip": q_xml_round_trip,
    "rejected_revisions": q_rejected_revisions,
    "latest_per_year": q_latest_per_year,
    "distinct_years": q_distinct_years,
    "main_titles": q_main_titles,
    "page_counts": q_page_counts,
    "extract_links": q_extract_links,
    "extract_categories": q_extract_categories,
    "strip_markup": q_strip_markup,
    "clean_words": q_clean_words,
    "word_count": q_word_count,
    "page_features": q_page_features,
    "word_count_text": q_word_count_text,
    "title_key": q_title_key,
    "pages_round_trip": q_pages_round_trip,
    "pages_first_write_wins": q_pages_first_write_wins,
    "pages_where": q_pages_where,
    "store_compaction": q_store_compaction,
    "compat_pages": q_compat_pages,
    "streaming_ingest": q_streaming_ingest,
    "resolve_links": q_resolve_links,
    "stub_nodes": q_stub_nodes,
    "all_nodes": q_all_nodes,
    "graph_endpoints": q_graph_endpoints,
    "link_edges": q_link_edges,
    "word_edges": q_word_edges,
    "edge_name": q_edge_name,
    "graph_safe_name": q_graph_safe_name,
    "graph_round_trip": q_graph_round_trip,
    "graph_merge": q_graph_merge,
    "out_degree": q_out_degree,
    "neighbours": q_neighbours,
    "top_edges": q_top_edges,
    "top_word_edges": q_top_word_edges,
    "link_paths": q_link_paths,
    "stored_graph_question": q_stored_graph_question,
    "category_nodes": q_category_nodes,
    "category_nodes_all": q_category_nodes_all,
    "category_edges": q_category_edges,
    "category_link_count": q_category_link_count,
    "category_degree": q_category_degree,
    "category_partners": q_category_partners,
    "category_linked": q_category_linked,
    "category_components": q_category_components,
}
