from revgraph.functions.names import edge_name, graph_safe_name, node_variable
from revgraph.functions.stopwords import ENGLISH_STOP_WORDS
from revgraph.functions.text import (
    array_to_text,
    clean_words,
    extract_categories,
    extract_links,
    remove_stop_words,
    revision_year,
    strip_chars,
    strip_markup,
    title_key,
    tokenize,
    wordcount_text,
    words_from_kept,
)

__all__ = [
    "ENGLISH_STOP_WORDS",
    "array_to_text",
    "clean_words",
    "edge_name",
    "extract_categories",
    "extract_links",
    "graph_safe_name",
    "node_variable",
    "remove_stop_words",
    "revision_year",
    "strip_chars",
    "strip_markup",
    "title_key",
    "tokenize",
    "wordcount_text",
    "words_from_kept",
]
