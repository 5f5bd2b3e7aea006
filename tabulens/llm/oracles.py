"""SQL counterparts of the operators that SQL can express."""

from __future__ import annotations

#: Rebuilt conversations as lists of turns, nodes as their prefixes. CRC-32 comes from its table.
PREFIX_TRIE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, text) AS turns FROM turns GROUP BY conv_id),
sized AS (
  SELECT conv_id, turns, xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM own, crc),
paths AS (
  SELECT s.conv_id, list_concat(coalesce(b.turns, [])[1:s.h], s.turns[s.h + 1:]) AS path
  FROM sized s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 5),
members AS (SELECT conv_id, path[1:d] AS node, d, len(path) = d AS ends FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)),
nodes AS (
  SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_ AS (SELECT n.*, coalesce(c.n, 0) AS n_children, (n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE strlen(n.node[-1].text) END AS own_saved FROM nodes n LEFT JOIN children c ON c.node = n.node),
up AS (SELECT node[1:a] AS node, own_saved, n_children = 0 AS leaf FROM (SELECT *, unnest(range(depth + 1)) AS a FROM full_)),
sums AS (SELECT node, sum(own_saved)::BIGINT AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM up GROUP BY node)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM full_ f JOIN sums s ON s.node = f.node LEFT JOIN full_ p ON f.depth > 0 AND p.node = f.node[1:f.depth - 1]
"""

#: Targets from the level that caps leave, van der Corput points as reversed bits, blocks of the hashed order.
MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS place
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][number % 3 + 1] AS weight, sum(source_size) OVER ()::BIGINT AS total FROM per),
levels AS (
  SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
    / (sum(weight) OVER (ORDER BY 3 * source_size / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level FROM weighed),
level AS (SELECT max(level) AS level, least(2048, greatest(16, any_value(total) >> 20)) AS block FROM levels),
needs AS (
  SELECT w.*, block, least(3.0::DOUBLE * source_size, weight * level) AS target, floor(least(3.0::DOUBLE * source_size, weight * level))::BIGINT AS want, (source_size + block - 1) // block AS blocks FROM weighed w, level),
slots_of AS (
  SELECT *, CASE WHEN source_size > 0 THEN want // source_size * blocks + (want % source_size + block - 1) // block ELSE 0 END AS need FROM needs),
sources AS (SELECT *, (sum(need) OVER (ORDER BY number) - need)::BIGINT AS first, (sum(need) OVER ())::BIGINT AS n FROM slots_of),
points AS (
  SELECT slot, floor((list_sum(list_transform(range(40), lambda k: ((slot >> k) & 1) << (39 - k))))::DOUBLE * n::DOUBLE / 1099511627776.0::DOUBLE)::BIGINT AS spot
  FROM (SELECT unnest(range(max(n))) AS slot, max(n) AS n FROM sources)),
ranked AS (
  SELECT number, need, row_number() OVER (PARTITION BY number ORDER BY slot) - 1 AS rank FROM points JOIN sources ON spot >= first AND spot < first + need),
drawn AS (
  SELECT number, rank FROM ranked WHERE rank < need
  UNION ALL SELECT number, unnest(range(n, need)) FROM (SELECT s.number, s.need, count(r.number) AS n FROM sources s LEFT JOIN ranked r ON r.number = s.number GROUP BY ALL)),
blocks_taken AS (
  SELECT number, rank % blocks AS of, least(block, source_size - rank % blocks * block, want - (rank // blocks * source_size + rank % blocks * block)) AS words FROM drawn JOIN sources USING (number)),
placed AS (
  SELECT z.*, s.number, s.source_size, s.target, s.block, (sum(size) OVER (PARTITION BY s.number ORDER BY place, z.doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized z JOIN sources s ON z.source IS NOT DISTINCT FROM s.source),
parts AS (SELECT *, unnest(range(start // block, (start + greatest(size, 1) - 1) // block + 1)) AS of FROM placed),
cut AS (SELECT *, greatest(start, of * block) - of * block AS off, least(start + size, (of + 1) * block) - greatest(start, of * block) AS length FROM parts)
SELECT c.doc_id, c.size, c.source_size, c.target, coalesce(sum(least(greatest(t.words - off, 0), length)), 0)::BIGINT AS taken
FROM cut c LEFT JOIN blocks_taken t ON t.number = c.number AND t.of = c.of GROUP BY c.doc_id, c.size, c.source_size, c.target, c.number, c.start
"""

#: All n-grams of up to five words that occur 100 times or more in a language.
COLLOCATIONS = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM worded GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (SELECT lang, w[i:i + k - 1] AS g, k FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, g, any_value(k) AS k, count(*)::HUGEINT AS a FROM grams GROUP BY lang, g HAVING count(*) >= 100),
cuts AS (SELECT lang, g, k, a, unnest(range(1, k)) AS c FROM f WHERE k >= 2),
scored AS (
  SELECT x.lang, x.g, x.a, x.c, l.a AS l, r.a AS r, t.n, 1000 * x.a * t.n // (l.a * r.a) AS score
  FROM cuts x JOIN f l ON l.lang = x.lang AND l.g = x.g[1:c] JOIN f r ON r.lang = x.lang AND r.g = x.g[c + 1:] JOIN totals t ON t.lang = x.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
spans AS (SELECT lang, g, k, a, unnest(range(1, k)) AS i FROM f WHERE k > 2),
inside AS (SELECT lang, g[i:i + m - 1] AS g, max(a) AS longer FROM spans, (SELECT unnest(range(2, 5)) AS m) WHERE m < k AND i + m - 1 <= k GROUP BY 1, 2),
kept AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN inside s ON s.lang = b.lang AND s.g = b.g WHERE s.longer IS NULL OR 100 * s.longer < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""

ORACLES = {"op11_prefix_trie": PREFIX_TRIE, "op12_mixing": MIXING, "op13_collocations": COLLOCATIONS}
