"""SQL that returns the same rows, for the queries that SQL can express."""

from __future__ import annotations

# The words of a text: runs of anything but 0x20 and 0x09-0x0D.
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^ \t\n\x0B\f\r]+')"

OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
v AS (SELECT g.doc_id, g.i, array_to_string(d.w[g.i:g.i + 12], ' ') AS k FROM g JOIN d USING (doc_id)),
m AS (SELECT k, min(doc_id) AS first FROM v GROUP BY k),
r AS (SELECT DISTINCT v.doc_id, unnest(range(v.i, v.i + 13)) AS p FROM v JOIN m USING (k) WHERE v.doc_id > m.first),
x AS (SELECT doc_id, list(p) AS gone FROM r GROUP BY doc_id),
c AS (SELECT d.doc_id, d.w, coalesce(x.gone, []) AS gone FROM d LEFT JOIN x USING (doc_id)),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at FROM d WHERE len(w) > 0),
k AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.at) AS kept
      FROM p ANTI JOIN r ON p.doc_id = r.doc_id AND p.at = r.p GROUP BY p.doc_id)
SELECT c.doc_id, len(c.w) AS n_words, len(c.gone) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM c LEFT JOIN k USING (doc_id)
"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)),
r AS (SELECT a AS doc_id, a AS seen FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


# Five bits of a SHA-1 at a time: a group of five hex digits holds four letters.
OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, strlen(t) AS n, sha1(t) AS x FROM p),
b AS (SELECT page_id, n, x, [('0x' || substr(x, CAST(5 * i + 1 AS INT), 5))::BIGINT FOR i IN range(0, 8)] AS g FROM h),
d AS (SELECT page_id, n, x, array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((g[CAST(k // 4 + 1 AS INT)] >> CAST(15 - 5 * (k % 4) AS INT)) & 31) + 1 AS INT), 1)
        FOR k IN range(0, 32)], '') AS payload_digest FROM b),
f AS (SELECT x, min(page_id) AS first FROM d GROUP BY x)
SELECT d.page_id, d.n AS payload_bytes, d.payload_digest,
  CASE WHEN d.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN d.page_id <> f.first THEN f.first END AS refers_to
FROM d JOIN f USING (x)
"""

# A text grows by one for each backslash, < and [ that is escaped; a run of one role has one opening and one end.
OP4 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g')) AS n,
    length(role) + length(regexp_replace(role, '[^\\<\[\n]', '', 'g')) AS r,
    role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS goes_on
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN goes_on THEN n + 10 ELSE n + r + 24 END)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

# CRC-32 of an ASCII text {0}, by the table of its 256 bytes.
_CRC_TABLE = """crc AS (SELECT list(list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, b) ORDER BY b) AS c FROM range(256) AS r(b))"""
_CRC = """xor(list_reduce([ascii(substr({0}, CAST(k AS INT), 1))::BIGINT FOR k IN range(1, length({0}) + 1)],
    lambda x, b: xor(x >> 8, crc.c[CAST((xor(x, b) & 255) + 1 AS INT)]), 4294967295), 4294967295)"""

# Prefixes are named by the hashes of their turns, one after another.
OP11 = f"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id, turn, length(coalesce(text, '')) AS n, substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS k
      FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, conv_id - conv_id % 100 AS head, conv_id::VARCHAR AS id, list(k ORDER BY turn NULLS FIRST, k) AS k, list(n ORDER BY turn NULLS FIRST, k) AS n FROM t GROUP BY conv_id),
h AS (SELECT o.*, CAST({_CRC.format("o.id")} % 6 AS INT) AS h FROM o, crc),
b AS (SELECT h.conv_id, coalesce(f.k[1:h.h], []) || h.k[h.h + 1:] AS k, coalesce(f.n[1:h.h], []) || h.n[h.h + 1:] AS n FROM h LEFT JOIN o f ON f.conv_id = h.head),
m AS (SELECT conv_id, len(k) AS most, d, array_to_string(k[1:d], '') AS node, CASE WHEN d > 0 THEN array_to_string(k[1:d - 1], '') END AS up, CASE WHEN d > 0 THEN n[d] ELSE 0 END AS size
      FROM (SELECT conv_id, k, n, CAST(unnest(range(0, len(k) + 1)) AS INT) AS d FROM b)),
g AS (SELECT node, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (most = d), '')) AS ends FROM m GROUP BY node, d),
c AS (SELECT up AS node, count(*) AS n FROM g WHERE up IS NOT NULL GROUP BY up),
s AS (SELECT g.node, (c.n IS NULL)::INT AS leaf, (g.n_convs - 1) * g.size AS saved, unnest(range(0, g.d + 1)) AS a FROM g LEFT JOIN c USING (node)),
a AS (SELECT substr(node, 1, CAST(32 * a AS INT)) AS node, sum(leaf) AS leaves, sum(saved) AS saved FROM s GROUP BY ALL)
SELECT g.conv_id, g.d::BIGINT AS depth, p.conv_id AS parent_conv_id, g.n_convs, coalesce(c.n, 0) AS n_children,
  a.leaves::BIGINT AS n_leaves, a.saved::BIGINT AS saved_tokens, g.ends AS ends_sha256
FROM g JOIN a USING (node) LEFT JOIN c USING (node) LEFT JOIN g p ON p.node = g.up
"""


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"


# A tree per source, one over their subroots; a leaf then climbs both, level by level.
OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
q AS (SELECT doc_id, source, {" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))} AS head, text, coalesce(doc_id::VARCHAR, '') AS id FROM documents),
x AS (SELECT doc_id, source, sha256(head || {_field("text")}) AS leaf,
      CASE WHEN doc_id IS NOT NULL AND {_CRC.format("id")} % 2 = 0 THEN sha256(head || {_field("replace(text, chr(10), '')")}) ELSE sha256(head || {_field("text")}) END AS now FROM q, crc),
z AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS i FROM x),
low AS (SELECT g, 0 AS l, i, leaf AS d, count(*) OVER (PARTITION BY g) AS m FROM z
        UNION ALL SELECT g, any_value(l) + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (any_value(m) + 2) // 3 FROM low WHERE m > 1 GROUP BY g, i // 3),
sub AS (SELECT g, l, d FROM low WHERE m = 1),
top AS (SELECT 0 AS l, g AS i, d, (SELECT count(*) FROM sub) AS m FROM sub
        UNION ALL SELECT any_value(l) + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (any_value(m) + 2) // 3 FROM top WHERE m > 1 GROUP BY i // 3),
-- Group -1 is the tree over the subroots.
nodes AS (SELECT g, l, i, d, m FROM low UNION ALL SELECT -1, l, i, d, m FROM top),
runs AS (SELECT g, l, i // 3 AS r, list(d ORDER BY i) AS ds FROM nodes WHERE m > 1 GROUP BY ALL),
climb AS (SELECT doc_id, leaf, now AS d, '' AS proof, g AS own, g, 0 AS l, i FROM z
  UNION ALL
  SELECT c.doc_id, c.leaf,
    CASE WHEN r.ds IS NULL THEN c.d ELSE sha256(array_to_string(r.ds[:c.i % 3], '') || c.d || array_to_string(r.ds[c.i % 3 + 2:], '')) END,
    CASE WHEN r.ds IS NULL THEN c.proof ELSE c.proof || array_to_string(r.ds[:c.i % 3], '') || array_to_string(r.ds[c.i % 3 + 2:], '') END,
    c.own, CASE WHEN r.ds IS NULL THEN CASE WHEN c.g = -1 THEN -2 ELSE -1 END ELSE c.g END,
    CASE WHEN r.ds IS NULL THEN 0 ELSE c.l + 1 END, CASE WHEN r.ds IS NULL THEN c.g ELSE c.i // 3 END
  FROM climb c LEFT JOIN runs r ON r.g = c.g AND r.l = c.l AND r.r = c.i // 3 WHERE c.g > -2)
SELECT c.doc_id, c.leaf, s.d AS subroot, t.d AS root, sha256(c.proof) AS proof_sha256, c.d AS folded_root, c.d = t.d AS verified
FROM climb c JOIN sub s ON s.g = c.own, (SELECT d FROM top WHERE m = 1) t WHERE c.g = -2
"""


def all_oracles() -> dict[str, str]:
    return {
        "op3_warc": OP3,
        "op4_chat_formatting": OP4,
        "op6_substring_dedup": OP6,
        "op10_ngram_jaccard_join": OP10,
        "op11_conversation_prefix_trie": OP11,
        "op12_merkle_manifest": OP12,
    }
