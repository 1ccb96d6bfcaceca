"""DuckDB SQL oracles for the registered queries.

Each string runs on DuckDB with the driver's parquet tables registered as
views (only ``documents`` is used). The SQL is written independently of
the Spark plans: list comprehensions instead of higher-order functions, list
intersection instead of the long-table overlap join, brute-force self-joins
for category pairs, and sequential ``replace`` calls for export names.
"""

from __future__ import annotations

from revgraph.functions.stopwords import ENGLISH_STOP_WORDS
from revgraph.functions.text import CATEGORY_PATTERN, LINK_PATTERN, MARKUP_PATTERN, STRIPPED_CHARS


def lit(s: str) -> str:
    """A DuckDB string literal; newlines are spliced in with chr(10)."""
    parts = [("'" + p.replace("'", "''") + "'") for p in s.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")" if len(parts) > 1 else parts[0]


STOP = "[" + ", ".join(lit(w) for w in ENGLISH_STOP_WORDS) + "]"

# The corpus of sources.corpus, written once more in SQL.
SPECIAL = " (a+b) – c-d.e's/*’,&!#@$;%?=<>\\^[]{}~`\""

CORPUS = f"""
corpus AS (
  SELECT CASE WHEN p % 10 = 3 THEN 'Talk:Page ' || p WHEN p % 10 = 4 THEN 'Page ' || p || {lit(SPECIAL)}
              WHEN p % 10 = 5 AND late = 1 THEN 'PAGE_' || p WHEN p % 10 = 6 THEN 'Page ' || p || ':'
              ELSE 'Page ' || p END AS title,
         CASE WHEN doc_id % 5 <> 0 THEN 'user' || (doc_id % 7) END AS username,
         y || '-' || lpad(CAST(1 + CASE WHEN p % 10 = 7 THEN 0 ELSE late END AS VARCHAR), 2, '0') || '-01T00:00:00Z' AS ts,
         text || ' {{{{Infobox}}}} == See also == [[Page' || CASE WHEN p % 10 IN (2, 4) THEN '_' ELSE ' ' END || (p + 1)
           || '|next]] [[page ' || (p + 2) || '#s]] [[Page ' || (2 * p) || ']] [[File:x.jpg|thumb]] [[Ghost ' || (p % 3)
           || ']]' || CASE WHEN p % 10 = 8 THEN '' ELSE ' [[Category:' || lang || '|k]] [[Category:' || source || ']]' END AS text,
         doc_id
  FROM (SELECT doc_id, CAST(floor(doc_id / 4) AS BIGINT) AS p, 2020 + doc_id % 2 AS y,
               CAST(floor((doc_id % 4) / 2) AS INT) AS late, text, lang, source
        FROM documents) d
),
rev AS (
  SELECT title, username, split_part(ts, '-', 1) AS year, ts, text, doc_id FROM corpus
)"""

LINKS = f"""list_sort(list_distinct([lower(x) FOR x IN
  [split_part(split_part(split_part(w, '|', 1), '#', 1), ':', 1)
   FOR w IN regexp_extract_all(text, {lit(LINK_PATTERN)}, 1)]
  IF x <> 'category' AND x <> '']))"""

CATEGORIES = f"""list_sort(list_distinct([regexp_replace(w, '\\|[^|]*$', '')
  FOR w IN regexp_extract_all(text, {lit(CATEGORY_PATTERN)}, 1)]))"""

WORDS = f"""[w FOR w IN string_split(translate(regexp_replace(
  coalesce(array_to_string([t FOR t IN string_split(lower(text), ' ') IF NOT list_contains({STOP}, t)], ' '), ''),
  {lit(MARKUP_PATTERN)}, '', 'g'), {lit(STRIPPED_CHARS)}, {lit(' ' * len(STRIPPED_CHARS))}), ' ') IF w <> '']"""


def latest(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT lower(title) AS title, replace(lower(title), ' ', '_') AS title_key, year, ts, text
  FROM (SELECT *, row_number() OVER (PARTITION BY replace(lower(title), ' ', '_'), year ORDER BY ts DESC, doc_id DESC) AS rn
        FROM {source}) t
  WHERE rn = 1
)"""


def pages(name: str, source: str) -> str:
    """Year-pages from a latest-revision CTE: links, categories, words."""
    return f"""
{name} AS (
  SELECT title_key, title, year, {LINKS} AS links, {CATEGORIES} AS categories, {WORDS} AS words
  FROM {source}
  WHERE NOT regexp_matches(title, ':[^:]')
)"""


def counts(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT title_key, title, year, word, count(*) AS n
  FROM (SELECT title_key, title, year, unnest(words) AS word FROM {source}) u
  GROUP BY ALL
)"""


BASE = (
    "WITH" + CORPUS + ","
    + latest("latest", "rev") + ","
    + pages("pg", "latest") + ","
    + counts("wc", "pg") + ","
    + """
edges AS (
  SELECT title AS src, title_key AS src_key, year, dst, replace(dst, ' ', '_') AS dst_key
  FROM (SELECT title, title_key, year, unnest(links) AS dst FROM pg) u
),
nodes AS (
  SELECT title, year, false AS is_stub FROM pg
  UNION ALL
  SELECT DISTINCT e.dst AS title, e.year,
         NOT EXISTS (SELECT 1 FROM pg WHERE pg.title_key = e.dst_key AND pg.year = e.year) AS is_stub
  FROM edges e
  WHERE NOT EXISTS (SELECT 1 FROM pg WHERE pg.title = e.dst AND pg.year = e.year)
),
link_w AS (
  SELECT e.src, e.dst, e.year,
         CAST(coalesce(len(list_intersect(s.links, t.links)), 0) AS BIGINT) AS weight
  FROM edges e
  JOIN pg s ON s.title_key = e.src_key AND s.year = e.year
  LEFT JOIN pg t ON t.title_key = e.dst_key AND t.year = e.year
),
word_w AS (
  SELECT e.src, e.dst, e.year,
         sum(CAST(least(a.n, b.n) AS DOUBLE) / CAST(greatest(a.n, b.n) AS DOUBLE)) AS weight
  FROM edges e
  JOIN wc a ON a.title_key = e.src_key AND a.year = e.year
  JOIN wc b ON b.title_key = e.dst_key AND b.year = e.year AND b.word = a.word
  GROUP BY ALL
),
cat_nodes AS (
  SELECT title, year, category FROM (SELECT title, year, unnest(categories) AS category FROM pg) u
  WHERE category <> ''
)
"""
)


# What each export profile rewrites, in the original order, and
# into what; written out here so that a wrong table in the engine shows.
_SHORT = " ()-–.'/*’,&+"
_LONG = " ()-–.'/*’,&+!#@$;%?=<>\\^[]{}\""
_LONGEST = " ()-–.'/*’,&+!#@$;%?=<>\\^[]{}~`\""
REWRITES = {
    "link": [(c, "plus_" if c == "+" else "_") for c in _SHORT],
    "word": [(c, {"+": "plus_", "@": "at", "-": "__", "=": "equal_"}.get(c, "_")) for c in _LONG],
    "word_edge": [(c, {"+": "plus_", "@": "at", "-": "__", "=": "equal_"}.get(c, "_")) for c in _LONGEST],
    "category_label": [(c, {"+": "plus_", "@": "at", "-": "__", "=": "equal_"}.get(c, "_")) for c in _LONG],
    "category": [(c, {"+": "plus", "@": "at", "-": "__", "=": "equal_"}.get(c, "_")) for c in _LONG],
    "category_page": [(c, {"+": "plus_", "@": "at", "-": "__"}.get(c, "_")) for c in _LONG if c != "="],
}


def _sql_safe(expr: str, profile: str) -> str:
    for ch, new in REWRITES[profile]:
        expr = f"replace({expr}, {lit(ch)}, {lit(new)})"
    return expr


def _text(expr: str) -> str:
    return f"coalesce(array_to_string({expr}, ','), '')"


def _wordcount_text(source: str, alias: str) -> str:
    return f"""(SELECT coalesce(string_agg(word || ':' || n, ',' ORDER BY word || ':' || n), '')
                FROM wc WHERE wc.title_key = {alias}.title_key AND wc.year = {alias}.year)"""


FIRST_WRITE_WINS = (
    "WITH" + CORPUS + ","
    + latest("latest_all", "rev") + ","
    + pages("pg_all", "latest_all") + ","
    + latest("latest_jan", "(SELECT * FROM rev WHERE substr(ts, 6, 2) = '01')") + ","
    + pages("pg_jan", "latest_jan") + ","
    + """
stored AS (
  SELECT * FROM pg_all WHERE year = '2020'
  UNION ALL
  SELECT * FROM pg_jan j
  WHERE NOT EXISTS (SELECT 1 FROM pg_all a WHERE a.year = '2020' AND a.title_key = j.title_key AND a.year = j.year)
)
SELECT title, year, CAST(len(words) AS BIGINT) AS n_words,
       """ + _text("links") + " AS links_text, " + _text("categories") + """ AS categories_text
FROM stored
"""
)

STREAMING_INGEST = (
    "WITH" + CORPUS + ","
    + latest("latest_jan", "(SELECT * FROM rev WHERE substr(ts, 6, 2) = '01')") + ","
    + pages("pg_jan", "latest_jan")
    + """
SELECT title, year, CAST(len(words) AS BIGINT) AS n_words,
       """ + _text("links") + " AS links_text, " + _text("categories") + """ AS categories_text
FROM pg_jan
"""
)

EDGE_NAME = "replace(src, ' ', '_') || '_TO_' || '_' || " + _sql_safe("dst", "link") + " || year"


def _graph_of(pg: str, tag: str) -> str:
    """Edges with weights and nodes of one set of pages."""
    return f"""
e_{tag} AS (
  SELECT title AS src, title_key AS src_key, links, year, dst, replace(dst, ' ', '_') AS dst_key
  FROM (SELECT title, title_key, year, links, unnest(links) AS dst FROM {pg}) u
),
w_{tag} AS (
  SELECT e.src, e.dst, e.year, CAST(coalesce(len(list_intersect(e.links, t.links)), 0) AS DOUBLE) AS weight
  FROM e_{tag} e LEFT JOIN {pg} t ON t.title_key = e.dst_key AND t.year = e.year
),
n_{tag} AS (
  SELECT t.title, t.year, NOT EXISTS (SELECT 1 FROM {pg} p WHERE p.title_key = replace(t.title, ' ', '_') AND p.year = t.year) AS is_stub
  FROM (SELECT title, year FROM {pg} UNION SELECT dst, year FROM e_{tag}) t
)"""


# Every graph table of the pages in a common table expression ``pg``.
GRAPH_ROWS = f"""
        SELECT 'nodes' AS tbl, year, title AS a, NULL AS b, NULL AS name, CAST(is_stub AS DOUBLE) AS x, NULL AS y FROM nodes
        UNION ALL SELECT 'edges', year, src, dst, {EDGE_NAME}, weight, NULL FROM link_w
        UNION ALL SELECT 'word_edges', e.year, e.src, e.dst, 'has_link_to', round(coalesce(w.weight, 0.0), 6), NULL
          FROM edges e LEFT JOIN word_w w ON w.src = e.src AND w.dst = e.dst AND w.year = e.year
        UNION ALL SELECT 'category_nodes', year, title, category, NULL, NULL, NULL FROM cat_nodes
        UNION ALL SELECT 'cliques', year, category, NULL, NULL, count(*), (count(*) * (count(*) - 1)) / 2 FROM cat_nodes GROUP BY year, category"""

# The graphs of January's pages, built at once.
GRAPH_MERGE = BASE.replace(latest("latest", "rev"), latest("latest", "(SELECT * FROM rev WHERE substr(ts, 6, 2) = '01')")) + GRAPH_ROWS

FLAT = "WITH" + CORPUS + "\nSELECT title, username, year, ts AS \"timestamp\", text FROM rev"

SQL: dict[str, str] = {
    "flatten_revisions": FLAT,
    "xml_round_trip": FLAT,
    "rejected_revisions": r"""SELECT CASE WHEN doc_id % 10 = 9 THEN 'Odd ' || doc_id END AS title,
        '2020-01-01T00:00:00Z' AS "timestamp",
        CASE WHEN doc_id % 10 = 9 THEN '<revision><timestamp>2020-01-01T00:00:00Z</timestamp><text>'
            || regexp_replace(replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]', ' ', 'g')
            || ' & b</text></revision>' END AS record,
        CASE WHEN doc_id % 10 = 9 THEN 'malformed revision' ELSE 'page without a readable title' END AS reject_reason
        FROM documents WHERE doc_id % 10 IN (7, 8, 9)""",
    "latest_per_year": BASE + 'SELECT title, year, ts AS "timestamp", text FROM latest',
    "distinct_years": "WITH" + CORPUS + "\nSELECT DISTINCT year FROM rev",
    "main_titles": BASE + "SELECT title, year FROM latest WHERE NOT regexp_matches(title, ':[^:]')",
    "page_counts": BASE + "SELECT year, count(*) AS n_pages FROM pg GROUP BY year",
    "extract_links": BASE + "SELECT title, year, unnest(links) AS link FROM pg",
    "extract_categories": BASE + "SELECT title, year, unnest(categories) AS category FROM pg",
    "strip_markup": BASE + f"SELECT title, year, regexp_replace(text, {lit(MARKUP_PATTERN)}, '', 'g') AS stripped FROM latest",
    "clean_words": BASE + "SELECT title, year, coalesce(array_to_string(words, ' '), '') AS words, "
                          "CAST(len(words) AS INT) AS n_words FROM pg",
    "word_count": BASE + "SELECT title, year, word, n FROM wc",
    "page_features": BASE + """SELECT title, year, CAST(len(links) AS INT) AS n_links,
        CAST(len(categories) AS INT) AS n_categories,
        CAST(len(list_distinct(words)) AS INT) AS n_distinct_words,
        CAST(len(words) AS BIGINT) AS n_words FROM pg""",
    "word_count_text": BASE + "SELECT title, year, " + _wordcount_text("wc", "pg") + " AS wordcount_text FROM pg",
    "title_key": BASE + "SELECT title, year, title_key FROM pg",
    "pages_round_trip": BASE + "SELECT title, year, " + _text("links") + " AS links_text, "
                        + _text("categories") + " AS categories_text, "
                        + _wordcount_text("wc", "pg") + " AS wordcount_text FROM pg",
    "pages_first_write_wins": FIRST_WRITE_WINS,
    "pages_where": BASE + """SELECT 'year' AS asked, title, year, CAST(len(links) AS INT) AS n_links FROM pg WHERE year = '2021'
        UNION ALL SELECT 'title' AS asked, title, year, CAST(len(links) AS INT) AS n_links FROM pg WHERE title_key = 'page_5'""",
    "store_compaction": BASE + "SELECT title, year, " + _text("links") + " AS links_text, "
                        + _text("categories") + " AS categories_text, " + _wordcount_text("wc", "pg") + " AS wordcount_text FROM pg",
    "compat_pages": BASE + 'SELECT title AS "Title", year AS "Year", ' + _text("links") + ' AS "Links", '
                    + _text("categories") + ' AS "Categories", ' + _wordcount_text("wc", "pg") + ' AS "Wordcount" FROM pg',
    "streaming_ingest": STREAMING_INGEST,
    "resolve_links": BASE + """SELECT e.src, e.dst, e.year,
        EXISTS (SELECT 1 FROM pg t WHERE t.title_key = e.dst_key AND t.year = e.year) AS dst_found FROM edges e""",
    "stub_nodes": BASE + "SELECT title, year FROM nodes WHERE is_stub",
    "all_nodes": BASE + "SELECT title, year, is_stub FROM nodes",
    "graph_endpoints": BASE + """SELECT e.src, e.dst, e.year, s.is_stub AS src_is_stub, d.is_stub AS dst_is_stub
        FROM edges e JOIN nodes s ON s.title = e.src AND s.year = e.year
        JOIN nodes d ON d.title = e.dst AND d.year = e.year""",
    "link_edges": BASE + "SELECT src, dst, year, weight FROM link_w",
    "word_edges": BASE + """SELECT e.src, e.dst, e.year, round(coalesce(w.weight, 0.0), 6) AS weight
        FROM edges e LEFT JOIN word_w w ON w.src = e.src AND w.dst = e.dst AND w.year = e.year""",
    "edge_name": BASE + "SELECT src, dst, year, " + EDGE_NAME + " AS name FROM edges",
    "graph_safe_name": BASE + "SELECT title, year, '_' || " + _sql_safe("title", "link") + " AS link_name, "
                       + "'_' || " + _sql_safe("title", "word") + " AS word_name, "
                       + _sql_safe("title", "word_edge") + " AS word_edge_text, "
                       + _sql_safe("title", "category") + " AS category_text, "
                       + _sql_safe("title", "category_label") + " AS category_label, "
                       + "'_' || " + _sql_safe("title", "category_page") + " AS category_page FROM nodes",
    "graph_round_trip": BASE + GRAPH_ROWS,
    "graph_merge": GRAPH_MERGE,
    "out_degree": BASE + """SELECT n.title, n.year, count(e.dst) AS out_degree
        FROM nodes n LEFT JOIN link_w e ON e.src = n.title AND e.year = n.year GROUP BY n.title, n.year""",
    "neighbours": BASE + """SELECT DISTINCT title, year, neighbour FROM (
        SELECT src AS title, year, dst AS neighbour FROM link_w
        UNION ALL SELECT dst AS title, year, src AS neighbour FROM link_w) t""",
    "top_edges": BASE + """SELECT year, "rank", src, dst, weight FROM (
        SELECT year, src, dst, weight,
               CAST(row_number() OVER (PARTITION BY year ORDER BY weight DESC, src, dst) AS INT) AS "rank"
        FROM link_w) t WHERE "rank" <= 10""",
    "top_word_edges": BASE + """SELECT year, "rank", src, dst, weight FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY weight DESC, src, dst) AS INT) AS "rank"
        FROM (SELECT e.src, e.dst, e.year, round(coalesce(w.weight, 0.0), 6) AS weight
              FROM edges e LEFT JOIN word_w w ON w.src = e.src AND w.dst = e.dst AND w.year = e.year) r) t WHERE "rank" <= 10""",
    "link_paths": BASE.replace("WITH", "WITH RECURSIVE", 1) + """, out_walk AS (
          SELECT title_key, year, 0 AS hops FROM pg WHERE title_key = 'page_1'
          UNION SELECT e.dst_key, e.year, w.hops + 1 FROM out_walk w JOIN edges e ON e.src_key = w.title_key AND e.year = w.year WHERE w.hops < 4),
        in_walk AS (
          SELECT title_key, year, 0 AS hops FROM pg WHERE title_key = 'page_5'
          UNION SELECT e.src_key, e.year, w.hops + 1 FROM in_walk w JOIN edges e ON e.dst_key = w.title_key AND e.year = w.year WHERE w.hops < 2)
        SELECT title_key, year, CAST(min(hops) AS INT) AS hops, 'out' AS direction FROM out_walk GROUP BY title_key, year
        UNION ALL SELECT title_key, year, CAST(min(hops) AS INT), 'in' FROM in_walk GROUP BY title_key, year""",
    "stored_graph_question": BASE + """SELECT n.year, n.is_stub, count(DISTINCT n.title) AS n_targets, count(*) AS n_links
        FROM nodes n JOIN edges e ON e.dst = n.title AND e.year = n.year GROUP BY ALL""",
    "category_partners": BASE + """SELECT a.title, a.year, a.category, b.title AS partner FROM cat_nodes a JOIN cat_nodes b
        ON a.category = b.category AND a.year = b.year AND a.title <> b.title WHERE a.title IN ('page 1', 'page 20')""",
    "category_linked": BASE + """SELECT e.src AS a, e.dst AS b, e.year, x.category FROM edges e
        JOIN cat_nodes x ON x.title = e.src AND x.year = e.year
        JOIN cat_nodes y ON y.title = e.dst AND y.year = e.year AND y.category = x.category WHERE e.src <> e.dst""",
    "category_components": BASE.replace("WITH", "WITH RECURSIVE", 1) + """, member AS (
          SELECT 'all' AS of, title, year, category FROM cat_nodes
          UNION ALL SELECT 'some', title, year, category FROM cat_nodes WHERE substr(md5(title || ' ' || category), 1, 1) IN ('0', '1')),
        reach AS (
          SELECT of, title, year, title AS other FROM member
          UNION SELECT r.of, r.title, r.year, b.title FROM reach r
          JOIN member a ON a.of = r.of AND a.title = r.other AND a.year = r.year JOIN member b ON b.of = a.of AND b.category = a.category AND b.year = a.year)
        SELECT of, title, year, min(other) AS component FROM reach GROUP BY of, title, year""",
    "category_nodes": BASE + "SELECT title, year, category FROM cat_nodes",
    "category_nodes_all": BASE + """, every AS (
          SELECT title, year, category FROM cat_nodes
          UNION ALL SELECT title, year, '' AS category FROM pg WHERE len(categories) = 0)
        SELECT a.title, a.year, a.category, count(b.title) AS degree FROM every a LEFT JOIN every b
        ON a.category = b.category AND a.year = b.year AND a.title <> b.title GROUP BY ALL""",
    "category_edges": BASE + """SELECT g.category, g.year, g.n_pages, coalesce(p.n_pairs, 0) AS n_pairs
        FROM (SELECT category, year, count(*) AS n_pages FROM cat_nodes GROUP BY ALL) g
        LEFT JOIN (SELECT a.category, a.year, count(*) AS n_pairs FROM cat_nodes a JOIN cat_nodes b
                   ON a.category = b.category AND a.year = b.year AND a.title < b.title GROUP BY ALL) p
        ON p.category = g.category AND p.year = g.year""",
    "category_link_count": BASE + """SELECT count(*) AS link_count FROM cat_nodes a JOIN cat_nodes b
        ON a.category = b.category AND a.year = b.year AND a.title <> b.title""",
    "category_degree": BASE + """SELECT a.title, a.year, a.category, count(b.title) AS degree
        FROM cat_nodes a LEFT JOIN cat_nodes b
        ON a.category = b.category AND a.year = b.year AND a.title <> b.title GROUP BY ALL""",
}
