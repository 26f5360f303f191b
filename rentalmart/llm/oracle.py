"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

# Words of the lower-cased text (A-Z only), shingles of four words, links, least id reachable.
NGRAM_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b
  WHERE 100 * common >= 85 * (m.n + n.n - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS node FROM documents
  UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""

# Lines with a word, and the sites that carry them in documents that are no copies.
LINE_DEDUP = r"""
WITH split AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS lines, doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS copy
  FROM documents),
places AS (SELECT doc_id, source, copy, lines, unnest(range(1, len(lines) + 1)) AS k FROM split),
worded AS (
  SELECT doc_id, source, copy, k, trim(lines[k], ' ') AS line FROM places
  WHERE regexp_matches(lines[k], '[^\x20\x09-\x0D]')),
spread AS (
  SELECT line, min(struct_pack(doc_id := doc_id, k := k)) AS first
  FROM worded GROUP BY line HAVING count(DISTINCT source) FILTER (NOT coalesce(copy, false)) >= 10),
gone AS (
  SELECT doc_id, list(k) AS ks FROM worded JOIN spread USING (line)
  WHERE (first).doc_id != doc_id OR (first).k != k GROUP BY doc_id)
SELECT s.doc_id,
       array_to_string([lines[k] for k in range(1, len(lines) + 1) if ks IS NULL OR NOT list_contains(ks, k)], chr(10)) AS text,
       CAST(len(lines) AS INTEGER) AS n_lines, CAST(coalesce(len(ks), 0) AS INTEGER) AS n_removed
FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id
"""

# Leaves, levels (pairs of neighbours) per language and over the subroots, paths, folded roots.
MERKLE_MANIFEST = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars, concat(
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-')) AS head, coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents),
leaves AS (
  SELECT doc_id, lang,
    sha256(concat(head, coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-'), tail)) AS leaf,
    sha256(concat(head, coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-'), tail)) AS other,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 7 = 0 AS tampered
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
levels AS (
  SELECT lang, 0 AS height, rank, leaf AS digest, n FROM placed
  UNION ALL
  SELECT lang, height + 1, rank // 2, sha256(string_agg(digest, '' ORDER BY rank)), (any_value(n) + 1) // 2
  FROM levels WHERE n > 1 GROUP BY lang, height, rank // 2),
subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n_trees
  FROM levels WHERE n = 1),
tops AS (
  SELECT 0 AS height, place AS rank, subroot AS digest, n_trees AS n FROM subroots
  UNION ALL
  SELECT height + 1, rank // 2, sha256(string_agg(digest, '' ORDER BY rank)), (any_value(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY height, rank // 2),
inner_steps AS (
  SELECT p.doc_id, p.leaf, p.rank, 0 AS part, a.height, a.rank % 2 AS digit, coalesce(b.digest, '') AS sibling
  FROM placed p JOIN levels a ON a.lang IS NOT DISTINCT FROM p.lang AND a.rank = p.rank >> a.height AND a.n > 1
  LEFT JOIN levels b ON b.lang IS NOT DISTINCT FROM a.lang AND b.height = a.height AND b.rank = xor(a.rank, 1)),
outer_steps AS (
  SELECT s.lang, a.height, a.rank % 2 AS digit, coalesce(b.digest, '') AS sibling
  FROM subroots s JOIN tops a ON a.rank = s.place >> a.height AND a.n > 1
  LEFT JOIN tops b ON b.height = a.height AND b.rank = xor(a.rank, 1)),
steps AS (
  SELECT doc_id, leaf, rank, part, height, digit, sibling FROM inner_steps
  UNION ALL
  SELECT p.doc_id, p.leaf, p.rank, 1, o.height, o.digit, o.sibling
  FROM placed p JOIN outer_steps o ON o.lang IS NOT DISTINCT FROM p.lang),
paths AS (
  SELECT doc_id, leaf, rank, string_agg(sibling, '' ORDER BY part, height) AS siblings,
         list(CAST(digit AS VARCHAR) || sibling ORDER BY part, height) AS path
  FROM steps GROUP BY doc_id, leaf, rank),
folds AS (
  SELECT p.doc_id, p.lang, p.leaf, sha256(coalesce(siblings, '')) AS proof_sha256,
    list_reduce(list_prepend(CASE WHEN tampered AND p.doc_id IS NOT NULL THEN other ELSE p.leaf END, coalesce(path, [])),
      lambda d, s: sha256(CASE WHEN s[1] = '0' THEN d || s[2:] ELSE s[2:] || d END)) AS folded_root
  FROM placed p LEFT JOIN paths q ON q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.leaf = p.leaf AND q.rank = p.rank)
SELECT f.doc_id, f.leaf, s.subroot, t.digest AS root, f.proof_sha256, f.folded_root, f.folded_root = t.digest AS verified
FROM folds f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang JOIN tops t ON t.n = 1
"""

# Texts without white space, grouped as they are.
EXACT_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS same
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER stay AS keep_id, count(*) OVER (PARTITION BY same) AS group_size,
       row_number() OVER stay = 1 AS kept, sha256(same) AS text_sha256
FROM texts WINDOW stay AS (PARTITION BY same ORDER BY n DESC, doc_id NULLS LAST)
"""

# Per text the set of filters that it fails; per part, order and step what that means.
FILTER_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
marks AS (
  SELECT doc_id AS label_id, max(CAST(coalesce(quality = 1, false) AS INTEGER)) AS good,
         max(CAST(coalesce(toxic = 1, false) AS INTEGER)) AS toxic
  FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, concat(
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
    CASE WHEN 100 * (strlen(t) - strlen(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN doc_id > first_id THEN 'E' ELSE '' END) AS failed
  FROM texts LEFT JOIN marks ON label_id = doc_id),
sets AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, filter_order[k:k] AS letter, filter_order[1:k - 1] AS before
  FROM orders, range(1, 6) AS r(k)),
counted AS (
  SELECT part, filter_order, step, letter, n, good, toxic, contains(failed, letter) AS fails,
         translate(failed, before, '') != failed AS gone, failed = letter AS sole
  FROM sets, steps),
found AS (
  SELECT part, filter_order, step, any_value(letter) AS letter,
         CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (gone AND fails), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (sole), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS BIGINT) AS toxic_lost
  FROM counted GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM found
"""

ORACLE = {"op2_ngram_join": NGRAM_JOIN, "op8_line_dedup": LINE_DEDUP, "op11_merkle_manifest": MERKLE_MANIFEST,
          "op12_exact_dedup": EXACT_DEDUP, "op13_filter_audit": FILTER_AUDIT}
