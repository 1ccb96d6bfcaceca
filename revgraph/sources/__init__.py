from revgraph.sources.corpus import corpus_revisions, documents, odd_dump, wiki_dump, wiki_revisions
from revgraph.sources.dump import read_revisions, rejected_revisions, write_dump
from revgraph.sources.store import compact, compat_pages, find_pages, pages_where, read_graph, read_pages, vacuum, write_graph, write_pages

__all__ = [
    "compact",
    "compat_pages",
    "corpus_revisions",
    "documents",
    "find_pages",
    "odd_dump",
    "pages_where",
    "read_graph",
    "read_pages",
    "read_revisions",
    "rejected_revisions",
    "vacuum",
    "wiki_dump",
    "wiki_revisions",
    "write_dump",
    "write_graph",
    "write_pages",
]
