"""SQL that gives the registered queries' results, where SQL can."""

from __future__ import annotations

from wattlake.llm.licences import COVER, TEMPLATES

# Order by a hash of the id, spelled as in mixing.uniform.
_MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
quality AS (SELECT doc_id AS labelled, min(quality) AS q FROM labels GROUP BY doc_id),
weighed AS (
  SELECT s.*, CASE q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS quality
  FROM sized s LEFT JOIN quality ON doc_id = labelled),
sources AS (
  SELECT source, source_size, 3 * source_size AS cap,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
lines AS (
  SELECT *, row_number() OVER o AS place, cap::DOUBLE / w AS ratio,
         (sum(source_size) OVER ())::BIGINT
           - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
         (sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS heft
  FROM sources WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST)),
opened AS (SELECT * FROM lines WHERE rest::DOUBLE / heft <= ratio ORDER BY place LIMIT 1),
targets AS (
  SELECT l.source, l.source_size,
         CASE WHEN l.place < o.place THEN l.cap::DOUBLE ELSE (o.rest * l.w)::DOUBLE / o.heft END AS target
  FROM lines l, opened o),
budgets AS (
  SELECT *, floor(target + 0.5)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN least(3, floor(target + 0.5)::BIGINT // source_size) ELSE 0 END::BIGINT AS epochs
  FROM targets),
keyed AS (
  SELECT d.doc_id, d.size, d.quality, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest, d.source,
         -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / d.quality AS key
  FROM weighed d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM keyed),
cut AS (SELECT *, greatest(0, least(size, rest - ahead))::BIGINT AS extra FROM placed)
SELECT doc_id, size, source_size, target, epochs * size + extra AS taken, epochs, extra, quality FROM cut
"""

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[ROLE\]|\[/ROLE\]|\[/TURN\]')) AS marks,
         len(regexp_extract_all(role, '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[ROLE\]|\[/ROLE\]|\[/TURN\]')) AS role_marks
  FROM turns),
rendered AS (
  SELECT *, length(text) + marks
      + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17 ELSE 24 + length(role) + role_marks END AS chars
  FROM sized)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       count(*) FILTER (WHERE marks > 0)::BIGINT AS escaped
FROM rendered GROUP BY conv_id
"""

# Words as in tokens: a-z after folding, digits, and all outside ASCII.
WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_JACCARD = rf"""
WITH RECURSIVE worded AS (SELECT doc_id, {WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM worded WHERE len(w) > 0),
classes AS (SELECT s, min(doc_id) AS rep, count(*) AS weight, len(s) AS n FROM sets GROUP BY s),
items AS (SELECT rep, n, weight, unnest(s) AS g FROM classes),
linked AS (
  SELECT a.rep AS a, b.rep AS b, any_value(b.weight) AS weight
  FROM items a JOIN items b ON a.g = b.g AND a.rep <> b.rep
  GROUP BY a.rep, b.rep HAVING count(*) >= 0.8 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9),
reach(node, seen) AS (
  SELECT rep, rep FROM classes
  UNION SELECT r.node, l.b FROM reach r JOIN linked l ON r.seen = l.a),
least AS (SELECT node, min(seen) AS class_id FROM reach GROUP BY node),
links AS (SELECT a, sum(weight)::BIGINT AS n FROM linked GROUP BY a)
SELECT s.doc_id, l.class_id, (coalesce(k.n, 0) + c.weight - 1)::BIGINT AS n_links, (c.weight - 1)::BIGINT AS n_copies
FROM sets s JOIN classes c ON s.s = c.s JOIN least l ON l.node = c.rep LEFT JOIN links k ON k.a = c.rep
UNION ALL SELECT doc_id, doc_id, 0::BIGINT, 0::BIGINT FROM worded WHERE len(w) = 0
"""

_PLACES = "\n  UNION ALL ".join(
    f"""SELECT doc_id, {str(t.base).lower()} AS base, '{t.label}' AS label, p - {t.key_at} AS start,
    (SELECT count(*) FROM range(0, {len(t.words)}) r(j)
     WHERE p - {t.key_at} + j >= 0 AND w[p - {t.key_at} + j + 1] = {t.words}[j + 1]) / {len(t.words)} AS share
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - {len(t.key_words) - 1})) AS p FROM worded WHERE list_contains(w, '{t.key_words[-1]}'))
  WHERE w[p + 1:p + {len(t.key_words)}] = {t.key_words}"""
    for t in TEMPLATES
)

_LICENCES = f"""
WITH worded AS MATERIALIZED (SELECT doc_id, {WORDS} AS w FROM documents),
places AS ({_PLACES}),
kept AS (SELECT * FROM places WHERE base OR share >= {COVER}),
found AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
         max(start) FILTER (WHERE base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM worded d LEFT JOIN found f ON d.doc_id = f.doc_id
"""

_LINES = rf"""
WITH RECURSIVE cut AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, pos, l[pos + 1] AS line FROM (SELECT doc_id, l, unnest(range(0, len(l))) AS pos FROM cut)
  WHERE regexp_matches(l[pos + 1], '[^	

 ]')),
entries AS (SELECT line, min(struct_pack(doc_id := doc_id, pos := pos)) AS first FROM lines GROUP BY line),
sets AS MATERIALIZED (
  SELECT line, row_number() OVER (ORDER BY line) AS id, CASE WHEN length(line) < 5 THEN [line]
         ELSE list_distinct(list_transform(range(1, length(line) - 3), lambda i: substr(line, i, 5))) END AS s
  FROM entries),
items AS MATERIALIZED (SELECT id, len(s) AS n, unnest(s) AS g FROM sets),
-- Lines that share 0.8 share one of their rarest shingles, about a fifth of each line's.
common AS (SELECT g, count(*) AS df FROM items GROUP BY g),
ranked AS (SELECT id, n, g, row_number() OVER (PARTITION BY id ORDER BY df, g) AS r FROM items JOIN common USING (g)),
rare AS (SELECT id, n, g FROM ranked WHERE r <= n - ceil(0.8 * n - 1e-9) + 1),
met AS (SELECT DISTINCT a.id AS a, b.id AS b FROM rare a JOIN rare b ON a.g = b.g AND a.id < b.id AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
counted AS (
  SELECT a.line AS a, b.line AS b, len(list_intersect(a.s, b.s)) AS c, len(a.s) + len(b.s) AS total
  FROM met JOIN sets a ON met.a = a.id JOIN sets b ON met.b = b.id),
half AS MATERIALIZED (SELECT a, b FROM counted WHERE c >= 0.8 * (total - c) - 1e-9),
linked AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach(node, seen) AS (SELECT a, a FROM linked UNION SELECT r.node, l.b FROM reach r JOIN linked l ON r.seen = l.a),
kept AS (SELECT node, min(e.first) AS kept FROM reach r JOIN entries e ON e.line = r.seen GROUP BY node),
verdict AS (
  SELECT l.doc_id, l.pos, coalesce(k.kept, e.first) AS kept
  FROM lines l JOIN entries e ON l.line = e.line LEFT JOIN kept k ON k.node = l.line),
marked AS (SELECT *, kept = struct_pack(doc_id := doc_id, pos := pos) AS keep FROM verdict)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE keep)::BIGINT AS n_kept,
       coalesce(list(pos::INTEGER ORDER BY pos) FILTER (WHERE NOT keep), []) AS removed,
       coalesce(list(kept.doc_id ORDER BY pos) FILTER (WHERE NOT keep), []) AS kept_in,
       coalesce(list(kept.pos::INTEGER ORDER BY pos) FILTER (WHERE NOT keep), []) AS kept_at
FROM marked GROUP BY doc_id
"""

# Unsigned CRC-32 of an id's decimal digits: each byte is mixed in and shifted out by bits.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s % 2 = 1 THEN xor(s // 2, 3988292384::BIGINT) ELSE s // 2 END), 4294967295::BIGINT)"""

# Every place and every later place of its word at most a quarter of the text away is a
# pair; pairs of one distance in a row are a stretch with that period, but a run only if
# no smaller period covers it.
_RUNS = rf"""
WITH worded AS MATERIALIZED (
  SELECT doc_id, {_CRC} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
planted AS (
  SELECT doc_id, len(w)::BIGINT AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN
           list_transform(range(0, len(w)), lambda i: CASE WHEN i < (h // 10) % len(w) THEN w[i + 1] ELSE
             w[((h // 10) % len(w) + (i - (h // 10) % len(w)) % (1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8))) + 1] END)
         ELSE w END AS w
  FROM worded),
placed AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM planted),
pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM placed a
  JOIN placed b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
rowed AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pairs),
stretches AS (
  SELECT doc_id, min(i) AS s, count(*) + q AS l, q FROM rowed GROUP BY doc_id, q, part HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches r WHERE NOT EXISTS (
    SELECT 1 FROM stretches o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.l >= r.s + r.l)),
told AS (
  SELECT doc_id, count(*)::BIGINT AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS told,
         min(struct_pack(shorter := -l, start := s, period := q)) AS best
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS text
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i WHERE g.i IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(t.n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, (-best.shorter)::BIGINT AS length,
       best.period::BIGINT AS period, (1000 * -best.shorter // best.period)::BIGINT AS exponent_milli,
       sha256(coalesce(told, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM planted d LEFT JOIN told t ON d.doc_id = t.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

_COPIES = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS s
  FROM worded WHERE len(w) > 0),
classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS g FROM classes),
linked AS (
  SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.g = b.g AND a.rep <> b.rep
  GROUP BY a.rep, b.rep HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(node, seen) AS (SELECT rep, rep FROM classes UNION SELECT r.node, l.b FROM reach r JOIN linked l ON r.seen = l.a),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, c.n::BIGINT AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN classes c ON s.s = c.s JOIN least l ON l.node = c.rep
UNION ALL SELECT doc_id, 0::BIGINT, doc_id, true FROM worded WHERE len(w) = 0
"""

# Levels as lists, each built from the one below; a path is the sibling of each level.
_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
_UP = "list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], '')))"
_MERKLE = f"""
WITH RECURSIVE hashed AS MATERIALIZED (
  SELECT doc_id, lang, {_LEAF.format(n='n_chars')} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN {_LEAF.format(n='(n_chars + 1)')} ELSE {_LEAF.format(n='n_chars')} END AS presented
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM hashed),
trees(tree, level, nodes) AS (
  SELECT tree, 0, list(leaf ORDER BY spot) FROM leaves GROUP BY tree
  UNION ALL SELECT tree, level + 1, {_UP} FROM trees WHERE len(nodes) > 1),
heights AS MATERIALIZED (SELECT tree, max(level) AS height, max_by(nodes[1], level) AS subroot FROM trees GROUP BY tree),
over(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY tree) FROM heights
  UNION ALL SELECT level + 1, {_UP} FROM over WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM over WHERE len(nodes) = 1),
steps AS (
  SELECT l.tree, l.spot, t.level, (l.spot >> t.level) % 2 = 1 AS first, t.nodes[xor(l.spot >> t.level, 1) + 1] AS hash
  FROM leaves l JOIN trees t ON l.tree = t.tree AND len(t.nodes) > 1
  UNION ALL
  SELECT l.tree, l.spot, h.height + o.level, (l.tree >> o.level) % 2 = 1, o.nodes[xor(l.tree >> o.level, 1) + 1]
  FROM leaves l JOIN heights h ON l.tree = h.tree JOIN over o ON len(o.nodes) > 1),
paths AS MATERIALIZED (
  SELECT tree, spot, list(struct_pack(first := first, hash := coalesce(hash, '')) ORDER BY level) AS path,
         string_agg(coalesce(hash, ''), '' ORDER BY level) AS told FROM steps GROUP BY tree, spot),
climbs(tree, spot, done, node) AS (
  SELECT tree, spot, 0, presented FROM leaves
  UNION ALL
  SELECT c.tree, c.spot, done + 1, sha256(CASE WHEN path[done + 1].first THEN path[done + 1].hash || node ELSE node || path[done + 1].hash END)
  FROM climbs c JOIN paths p ON c.tree = p.tree AND c.spot = p.spot WHERE done < len(path)),
folded AS (SELECT tree, spot, max_by(node, done) AS folded_root FROM climbs GROUP BY tree, spot)
SELECT l.doc_id, l.leaf, h.subroot, r.root, sha256(coalesce(p.told, '')) AS proof_sha256, f.folded_root, f.folded_root = r.root AS verified
FROM leaves l JOIN heights h ON l.tree = h.tree CROSS JOIN root r
JOIN folded f ON f.tree = l.tree AND f.spot = l.spot LEFT JOIN paths p ON p.tree = l.tree AND p.spot = l.spot
"""

ORACLE: dict[str, str] = {
    "op1_jaccard_join": _JACCARD,
    "op4_mix_sources": _MIX,
    "op6_chat_format": _CHAT,
    "op7_licence_scan": _LICENCES,
    "op9_line_dedup": _LINES,
    "op11_periodic_runs": _RUNS,
    "op12_near_dedup": _COPIES,
    "op13_merkle_manifest": _MERKLE,
}
