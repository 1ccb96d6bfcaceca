"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# Turn by turn, the template's marks add a fixed number of characters, an escape one more.
_OP10 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), named AS (
  SELECT conv_id, turn, text,
         CASE role WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant' WHEN 'model' THEN 'assistant' ELSE role END AS role,
         length(text) + length(regexp_replace(text, '[^~]', '', 'g'))
           + len(regexp_extract_all(text, '\[/?INST\]|\[/?ROLE[ \]]|</?s>|</?SYS>>')) AS body
  FROM rows
), sized AS (
  SELECT *, CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
                 ELSE 16 + length(role) + length(regexp_replace(role, '[^~\]]', '', 'g'))
                      + len(regexp_extract_all(role, '\[/?INST\]|\[/?ROLE[ \]]|</?s>|</?SYS>>')) END AS marks
  FROM named
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(body + marks)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_WORD = r"[0-9a-z\x{C0}-\x{1FFF}\x{2080}-\x{2FFF}\x{3040}-\x{10FFFF}]+"

# Every run of 50 words of every document, compared as text.
_OP6 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '{_WORD}') AS words FROM documents),
runs AS (
  SELECT doc_id, i - 1 AS first, array_to_string(words[i:i + 49], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50) u
),
marked AS (
  SELECT doc_id, first FROM runs
  WHERE run IN (SELECT run FROM runs GROUP BY run HAVING count(DISTINCT doc_id) > 1)
),
cut AS (
  SELECT doc_id, first,
         CASE WHEN first <= max(first + 50) OVER (PARTITION BY doc_id ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              THEN 0 ELSE 1 END AS new
  FROM marked
),
spans AS (SELECT doc_id, first, sum(new) OVER (PARTITION BY doc_id ORDER BY first ROWS UNBOUNDED PRECEDING) AS span FROM cut)
SELECT doc_id, CAST(span AS INT) AS span, CAST(min(first) AS INT) AS start_word, CAST(max(first) + 50 AS INT) AS end_word,
       CAST(max(first) + 50 - min(first) AS INT) AS n_words
FROM spans GROUP BY doc_id, span
"""

# Every passage of every document against every item: no index, no bounds.
_OP9 = rf"""
WITH items AS (
  SELECT item_id, text, regexp_extract_all(lower(text), '{_WORD}') AS words FROM benchmark
),
own AS (SELECT *, len(words) AS n FROM items WHERE len(words) > 0),
size AS (SELECT count(*) AS items, avg(n) AS mean, max(n) AS longest FROM own),
tf AS (SELECT item_id, n, term, count(*) AS tf FROM (SELECT item_id, n, unnest(words) AS term FROM own) u GROUP BY ALL),
weight AS (
  SELECT item_id, term,
         ln(1 + (items - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean)) AS w
  FROM (SELECT *, count(*) OVER (PARTITION BY term) AS df FROM tf) t, size
),
share AS (SELECT item_id, term, w / sum(w) OVER (PARTITION BY item_id) AS share FROM weight),
docs AS (SELECT doc_id, regexp_extract_all(lower(text), '{_WORD}') AS words FROM documents),
passages AS (
  SELECT doc_id, k, list_distinct(words[k * longest + 1 : k * longest + 2 * longest]) AS terms
  FROM (SELECT doc_id, words, longest, unnest(range(greatest(1, CAST(ceil(len(words) / longest) AS INT) - 1))) AS k
        FROM docs, size WHERE len(words) > 0) p
),
scored AS (
  SELECT doc_id, item_id, max(score) AS score
  FROM (SELECT p.doc_id, p.k, s.item_id, sum(s.share) AS score
        FROM (SELECT doc_id, k, unnest(terms) AS term FROM passages) p JOIN share s USING (term) GROUP BY ALL) x
  GROUP BY ALL HAVING max(score) >= 0.6 - 1e-9
),
sentences AS (
  SELECT item_id, [x FOR x IN string_split(regexp_replace(trim(text), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) IF x <> ''] AS s,
         string_split_regex(trim(text), '\s+') AS t
  FROM own
),
parts AS (
  SELECT item_id, 'q' AS part, CASE WHEN len(s) > 1 THEN array_to_string(s[:-2], ' ') ELSE array_to_string(t[:CAST(ceil(2 * len(t) / 3) AS INT)], ' ') END AS text FROM sentences
  UNION ALL
  SELECT item_id, 'a', CASE WHEN len(s) > 1 THEN s[-1] ELSE array_to_string(t[CAST(ceil(2 * len(t) / 3) AS INT) + 1:], ' ') END FROM sentences
),
part_words AS (SELECT item_id, part, regexp_extract_all(lower(text), '{_WORD}') AS words FROM parts),
part_grams AS (
  SELECT item_id, part, list_distinct([array_to_string(words[i:i + least(3, len(words)) - 1], ' ')
         FOR i IN range(1, len(words) - least(3, len(words)) + 2)]) AS grams
  FROM part_words WHERE len(words) > 0
),
held AS (
  SELECT doc_id, list_distinct(flatten([[array_to_string(words[i:i + g - 1], ' ') FOR i IN range(1, len(words) - g + 2)] FOR g IN [1, 2, 3]])) AS grams
  FROM docs WHERE doc_id IN (SELECT doc_id FROM scored)
),
overlap AS (
  SELECT s.doc_id, s.item_id, any_value(s.score) AS score,
         coalesce(max(len(list_intersect(g.grams, h.grams)) / len(g.grams)) FILTER (g.part = 'q'), 1.0) AS q,
         coalesce(max(len(list_intersect(g.grams, h.grams)) / len(g.grams)) FILTER (g.part = 'a'), 1.0) AS a
  FROM scored s JOIN held h USING (doc_id) LEFT JOIN part_grams g USING (item_id) GROUP BY ALL
)
SELECT doc_id, item_id, round(score, 6) AS bm25_share, round(q, 6) AS question_overlap, round(a, 6) AS answer_overlap
FROM overlap WHERE q >= 0.7 AND a >= 0.7
"""

# The CRC-32 table, and the checksum of a list of bytes.
_CRC_TABLE = "crc AS (SELECT [list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, (a & 1) * 3988292384)) FOR x IN range(256)] AS t)"


def _crc32(octets: str) -> str:
    return f"xor(list_reduce([4294967295] || {octets}, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"


# Every word with one code point left out at every place: no chunks, no grams.
_OP11 = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) r
  GROUP BY ALL
),
octets AS (
  SELECT run, k, flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END
                          FOR c IN string_split(id || ':' || run, '')]) AS o FROM runs
),
hashed AS (SELECT run, k, {_crc32('o')} AS h FROM octets, crc),
vocabulary AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, k FROM hashed) w
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
),
less AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary) v
),
near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT v.word, l.word FROM vocabulary v JOIN less l ON v.word = l.rest
  UNION SELECT l.word, v.word FROM vocabulary v JOIN less l ON v.word = l.rest
),
best AS (
  SELECT x.word, count(*) AS n_near, max(o.n) AS most, min(x.other) FILTER (o.n = x.top) AS first_best
  FROM (SELECT near.*, max(v.n) OVER (PARTITION BY near.word) AS top FROM near JOIN vocabulary v ON v.word = near.other) x
  JOIN vocabulary o ON o.word = x.other GROUP BY x.word
),
formed AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 5 * v.n THEN b.first_best END AS form,
         CASE WHEN b.most >= 5 * v.n THEN b.most END AS form_n
  FROM vocabulary v LEFT JOIN best b USING (word)
),
walk AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON f.word = w.at WHERE f.form IS NOT NULL
),
root AS (SELECT w.word, w.at AS root FROM walk w JOIN formed f ON f.word = w.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN root USING (word)
"""

# Every rule on every URL.
_OP12 = r"""
WITH cut AS (
  SELECT page_id, coalesce(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS low,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), judged AS (
  SELECT s.*,
         (SELECT arg_max({'rule': rule_host || rule_path, 'verdict': verdict}, length(rule_host || rule_path)) FROM rules
          WHERE (s.host = rule_host OR ends_with(s.host, '.' || rule_host)) AND starts_with(s.path, rule_path)) AS found,
         regexp_matches(low, '^[a-z][a-z0-9+.\-]*://([^/?#]*\.)?(cheap-pills|[^/?#]*-pills|[^/?#]*-casino|casino|[^/?#]*-poker|poker|viagra|porn|xxx|ads|adserver|doubleclick)\.')
           OR regexp_matches(low, '/(adclick|banners/click|affiliate/redirect)([^a-z0-9_.%\-]|$)') AS bad,
         regexp_matches(low, '^[a-z][a-z0-9+.\-]*://([^/?#]*\.)?[^/?#]*\.edu/') AS good
  FROM split s
)
SELECT page_id, host, path, found.rule AS rule, coalesce(found.verdict, CASE WHEN bad AND NOT good THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""

# Prefixes as text, every node against all nodes below it.
_OP13 = rf"""
WITH {_CRC_TABLE},
own AS (
  SELECT conv_id, digest, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
  FROM (SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
               md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL) t
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("[unicode(c) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM own) c, crc
),
parts AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.digest, o.size FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, o.pos, o.digest, o.size FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
),
placed AS (SELECT conv_id, digest, size, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM parts),
paths AS (
  SELECT conv_id, depth, size, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
),
nodes AS (
  SELECT key, any_value(depth) AS depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN any_value(depth) > 0 THEN left(key, length(key) - 32) END AS parent
  FROM paths GROUP BY key
),
kids AS (SELECT parent AS key, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT DISTINCT a.key AS top, b.key FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND a.depth <= b.depth
),
sums AS (
  SELECT b.top AS key, sum((n.n_convs - 1) * n.size) AS saved_tokens, count(*) FILTER (k.key IS NULL) AS n_leaves
  FROM below b JOIN nodes n ON n.key = b.key LEFT JOIN kids k ON k.key = b.key GROUP BY b.top
),
ends AS (
  SELECT key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(key, depth) AS key FROM paths GROUP BY conv_id) e GROUP BY key
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.key = n.parent LEFT JOIN kids k ON k.key = n.key JOIN sums s ON s.key = n.key LEFT JOIN ends e ON e.key = n.key
"""

SQL = {
    "op6_substrings": _OP6,
    "op9_decontamination": _OP9,
    "op10_chat_format": _OP10,
    "op11_spelling": _OP11,
    "op12_url_filter": _OP12,
    "op13_prefix_trie": _OP13,
}
