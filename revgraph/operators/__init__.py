from revgraph.operators.annotate import annotate, page_features, page_words, word_count, word_maps
from revgraph.operators.categories import (
    category_cliques,
    category_degree,
    category_link_count,
    category_linked,
    category_nodes,
    category_partners,
)
from revgraph.operators.links import (
    all_nodes,
    edges,
    graph_endpoints,
    link_edges,
    resolve_links,
    stub_nodes,
    walked_rows,
    word_edges,
)
from revgraph.operators.reach import category_components, paths, strongest_word_edges
from revgraph.operators.revisions import distinct_years, flatten_revisions, latest_per_piece, latest_per_year, main_titles, page_counts

__all__ = [
    "all_nodes",
    "annotate",
    "category_cliques",
    "category_components",
    "category_degree",
    "category_link_count",
    "category_linked",
    "category_nodes",
    "category_partners",
    "distinct_years",
    "edges",
    "flatten_revisions",
    "graph_endpoints",
    "latest_per_piece",
    "latest_per_year",
    "link_edges",
    "main_titles",
    "page_counts",
    "page_features",
    "page_words",
    "paths",
    "resolve_links",
    "strongest_word_edges",
    "stub_nodes",
    "walked_rows",
    "word_count",
    "word_edges",
    "word_maps",
]
