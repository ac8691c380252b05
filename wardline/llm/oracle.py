"""DuckDB SQL with the meaning of the queries that SQL can express."""

from __future__ import annotations

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TOPICS = "ads|adserver|tracker|casino|poker|betting|porn|xxx|adult|bets|pills|spam|escort|viagra|torrent|warez|phishing"

OP2 = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
cut AS (SELECT page_id, regexp_extract(r, '^([^/?#]*)', 1) AS h, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
parts AS (SELECT page_id, {_FOLD.format('h')} AS host, path FROM cut),
rules(rule, rule_host, rule_path, verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
  ('net/fr/', 'net', '/fr/', 'block')),
urls AS (SELECT DISTINCT host, path FROM parts),
best AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path)
SELECT p.page_id, p.host, p.path, b.rule,
       coalesce(b.verdict, CASE WHEN regexp_matches(p.host || p.path, '(?i)(^|[^a-z0-9])({_TOPICS})($|[^a-z0-9])')
                                THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN best b USING (host, path)
"""

OP6 = f"""
WITH t AS (SELECT doc_id, sha256({_FOLD.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t
"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP4 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_FOLD.format("coalesce(text, '')"))} AS words FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
    ELSE list_transform(range(1, greatest(len(words) - 2, 2)), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS s FROM w),
classes AS (SELECT min(doc_id) AS id, any_value(s) AS s, len(any_value(s)) AS n FROM sets WHERE len(s) > 0
            GROUP BY md5(array_to_string(list_sort(s), chr(10)))),
items AS (SELECT id, n, hash(unnest(s)) AS h FROM classes),
rare AS (SELECT h, count(*) AS f FROM items GROUP BY h),
ranked AS (SELECT id, n, items.h, row_number() OVER (PARTITION BY id ORDER BY f, items.h) AS k FROM items JOIN rare USING (h)),
prefix AS (SELECT id, n, h FROM ranked WHERE k <= n * 15 // 100 + 1),
pairs AS (SELECT DISTINCT a.id AS x, b.id AS y FROM prefix a JOIN prefix b ON a.h = b.h AND a.id < b.id
          AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 85),
shared AS (SELECT x, y, a.n AS na, b.n AS nb, len(list_intersect(a.s, b.s)) AS c
           FROM pairs JOIN classes a ON a.id = x JOIN classes b ON b.id = y),
links AS (SELECT x, y FROM shared WHERE 100 * c >= 85 * (na + nb - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT id, id AS root FROM classes UNION SELECT y, root FROM reach JOIN both_ways ON x = id),
roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
named AS (SELECT sets.doc_id, len(s) AS n_shingles,
          CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY md5(array_to_string(list_sort(s), chr(10)))) END AS id FROM sets)
SELECT doc_id, n_shingles, coalesce(root, doc_id) AS component_id FROM named LEFT JOIN roots USING (id)
"""

OP9 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13),
windows AS (SELECT doc_id, i, md5_number(array_to_string(words[i:i + 12], ' ')) AS h FROM starts),
marked AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) < doc_id AS late FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM marked WHERE late),
lists AS (SELECT doc_id, list(k) AS ks, count(*) AS n FROM gone GROUP BY doc_id),
each_word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM w),
kept AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.k) AS text FROM each_word e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.k = g.k GROUP BY e.doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN lists ON w.doc_id = lists.doc_id LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

# crc32 over bytes: a table of 256 remainders, then one step a byte.
OP11 = f"""
WITH RECURSIVE remainders AS (SELECT b, b AS c, 0 AS k FROM range(256) r(b) UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM remainders WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS steps FROM remainders WHERE k = 8),
texts AS (
  SELECT 'd' AS side, doc_id, {_FOLD.format("coalesce(text, '')")} AS text FROM documents UNION ALL
  SELECT 'b', NULL, {_FOLD.format("coalesce(text, '')")} FROM benchmark),
words AS (SELECT side, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (
  SELECT side, doc_id, unnest(w) AS f FROM words UNION ALL
  SELECT side, doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
each AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM runs)),
hashed AS (
  SELECT f, xor(4294967295, list_reduce(list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295)) % 10000 AS bucket FROM each, crc),
counts AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM runs JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * ((SELECT sum(s) FROM counts) + 10000))::DOUBLE / ((s + 1) * ((SELECT sum(t) FROM counts) + 10000))::DOUBLE))::BIGINT AS gain FROM counts),
sums AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total FROM runs JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id),
scored AS (
  SELECT w.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
    ('0x' || substr(sha256('7:' || w.doc_id::VARCHAR), 1, 8))::BIGINT AS h
  FROM words w LEFT JOIN sums USING (doc_id) WHERE side = 'd'),
noisy AS (SELECT doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 25 * count(*) OVER () // 100 AS drawn FROM noisy WHERE n_words >= 20)
SELECT n.doc_id, n_features, weight, score, rank FROM noisy n LEFT JOIN (SELECT doc_id, rank FROM ranked WHERE rank <= drawn) USING (doc_id)
"""

OP13 = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || doc_id::VARCHAR) AS x FROM documents),
numbers AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
         ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM units),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(u[1:i], ''), '') AS prefix, coalesce(array_to_string(u[i + 1:j], ''), '') AS middle,
         coalesce(array_to_string(u[j + 1:n], ''), '') AS suffix FROM cuts)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form != 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

SQL = {"op11_importance_resampling": OP11, "op13_fill_in_middle": OP13, "op2_url_filter": OP2, "op4_ngram_jaccard": OP4, "op6_exact_dedup": OP6, "op9_substring_dedup": OP9}
