"""Identifier-safe names for graph export (E9) and edge names.

These never serve as keys: the raw title is the key everywhere. They only
reproduce the names a graph-database export would use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters each export profile rewrites, in the original
# order. Every character becomes "_" unless listed in the profile's special
# replacements; a character listed in "keep" is left as is.
LINK_CHARS = [" ", "(", ")", "-", "–", ".", "'", "/", "*", "’", ",", "&", "+"]
WORD_CHARS = [" ", "(", ")", "-", "–", ".", "'", "/", "*", "’", ",", "&", "+", "!", "#", "@", "$", ";", "%",
              "?", "=", "<", ">", "\\", "^", "[", "]", "{", "}", "\""]
WORD_EDGE_CHARS = [" ", "(", ")", "-", "–", ".", "'", "/", "*", "’", ",", "&", "+", "!", "#", "@", "$", ";",
                   "%", "?", "=", "<", ">", "\\", "^", "[", "]", "{", "}", "~", "`", "\""]
WORD_SPECIAL = {"+": "plus_", "@": "at", "-": "__", "=": "equal_"}

PROFILES = {
    # page and link names of the shared-link graph
    "link": {"chars": LINK_CHARS, "special": {"+": "plus_"}, "keep": ""},
    # page and link names of the word graph
    "word": {"chars": WORD_CHARS, "special": WORD_SPECIAL, "keep": ""},
    # from/to text of resolved word-graph edges
    "word_edge": {"chars": WORD_EDGE_CHARS, "special": WORD_SPECIAL, "keep": ""},
    # category label of the category graph
    "category_label": {"chars": WORD_CHARS, "special": WORD_SPECIAL, "keep": ""},
    # title and category text of category nodes
    "category": {"chars": WORD_CHARS, "special": {**WORD_SPECIAL, "+": "plus"}, "keep": ""},
    # node variable of category nodes: "=" is left alone
    "category_page": {"chars": WORD_CHARS, "special": WORD_SPECIAL, "keep": "="},
}


def graph_safe_name(text, profile: str = "link") -> Column:
    """Rewrite the profile's characters; replacements never contain a
    rewritten character, so one ``translate`` plus a few ``replace`` calls
    equal the sequential rewrite."""
    spec = PROFILES[profile]
    col = F.col(text) if isinstance(text, str) else text
    plain = "".join(c for c in spec["chars"] if c not in spec["special"] and c not in spec["keep"])
    out = F.translate(col, plain, "_" * len(plain))
    for ch, rep in spec["special"].items():
        if ch not in spec["keep"]:
            out = F.replace(out, F.lit(ch), F.lit(rep))
    return out


def node_variable(title, profile: str = "link") -> Column:
    """Node variable name: ``_`` + rewritten title."""
    col = F.col(title) if isinstance(title, str) else title
    return F.concat(F.lit("_"), graph_safe_name(col, profile))


def edge_name(src, dst, year) -> Column:
    """``<src with _ for space>_TO_<link node variable of dst><year>``."""
    s = F.col(src) if isinstance(src, str) else src
    d = F.col(dst) if isinstance(dst, str) else dst
    y = F.col(year) if isinstance(year, str) else year
    return F.concat(F.translate(s, " ", "_"), F.lit("_TO_"), node_variable(d, "link"), y)


# Word-graph edges carry a constant name.
WORD_EDGE_NAME = "has_link_to"
