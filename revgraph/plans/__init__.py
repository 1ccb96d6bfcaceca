from revgraph.plans.graphs import (
    CategoryGraph,
    Graph,
    build_graphs,
    build_pages,
    category_graph,
    checkpointed,
    export_pages,
    graph_tables,
    ingest,
    ingest_chunks,
    link_graph,
    load_graphs,
    store_revisions,
    word_graph,
)
from revgraph.plans.maintenance import update_tables
from revgraph.plans.views import SAMPLES, ask, register_graph_views, run_sample

__all__ = [
    "SAMPLES",
    "CategoryGraph",
    "Graph",
    "ask",
    "build_graphs",
    "build_pages",
    "category_graph",
    "checkpointed",
    "export_pages",
    "graph_tables",
    "ingest",
    "ingest_chunks",
    "link_graph",
    "load_graphs",
    "register_graph_views",
    "run_sample",
    "store_revisions",
    "update_tables",
    "word_graph",
]
