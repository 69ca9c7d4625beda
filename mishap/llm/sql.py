"""SQL that some queries must agree with."""

from __future__ import annotations

WORDS_SQL = """docs AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents)"""

COMPONENTS_SQL = """reach(a, b) AS (SELECT a, b FROM links UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)"""

SUBSTRING_SQL = f"""WITH {WORDS_SQL},
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k
            FROM docs, unnest(range(1, len(ws) - 48)) AS t(i)),
least AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, j FROM windows JOIN least USING (k),
         unnest(range(i, i + 50)) AS t(j) WHERE m < doc_id),
numbered AS (SELECT doc_id, j, ws[j] AS word FROM docs, unnest(range(1, len(ws) + 1)) AS t(j)),
kept AS (SELECT * FROM numbered ANTI JOIN gone USING (doc_id, j)),
left_over AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS body
              FROM kept GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM docs LEFT JOIN left_over USING (doc_id)"""

JACCARD_SQL = f"""WITH RECURSIVE lowered AS (SELECT doc_id,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
{WORDS_SQL.replace("FROM documents", "FROM lowered")},
sets AS (SELECT doc_id, CASE WHEN len(ws) >= 3
    THEN list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)])
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS grams FROM docs),
grams AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS c
           FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM shared WHERE 100 * c >= 90 * (n + m - c)),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
{COMPONENTS_SQL}
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles,
       CAST(least(doc_id, coalesce(least_id, doc_id)) AS BIGINT) AS component_id
FROM sets LEFT JOIN (SELECT a, min(b) AS least_id FROM reach GROUP BY a) ON a = doc_id"""

VECTORS_SQL = f"""WITH RECURSIVE usable AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v
    FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
          ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id < y.vec_id
          WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
{COMPONENTS_SQL},
found AS (SELECT a AS vec_id, min(b) AS least_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
       least(vec_id, coalesce(least_id, vec_id)) AS component_id,
       vec_id <= coalesce(least_id, vec_id) AS kept
FROM embeddings LEFT JOIN found USING (vec_id) LEFT JOIN counts USING (vec_id)"""


def _hashed(*parts: str) -> str:
    return f"sha256({' || '.join(parts)})"


_FIELDS = [
    f"coalesce(strlen({c}) || ':' || {c}, '-')"
    for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST({} AS VARCHAR)", "text")
]
_LEAF = _hashed(*_FIELDS).format("n_chars", "n_chars")
_TAMPERED = _hashed(*_FIELDS).format("(n_chars + 1)", "(n_chars + 1)")

# The table of crc32 follows from its polynomial; a text's bytes are then folded one by one.
MERKLE_SQL = f"""WITH RECURSIVE crc AS (SELECT list(list_reduce([n] || range(8)::BIGINT[],
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY n) AS t
    FROM range(256) AS r(n)),
leaves AS (SELECT doc_id, lang, {_LEAF} AS leaf,
    CASE WHEN xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: xor(c // 256, t[1 + xor(c, b) % 256])),
        4294967295) % 7 = 0 AND n_chars IS NOT NULL THEN {_TAMPERED} ELSE {_LEAF} END AS seen
    FROM documents, crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g FROM leaves),
nodes(g, l, i, h, n) AS (SELECT g, 0, i, leaf, count(*) OVER (PARTITION BY g) FROM placed UNION ALL
  SELECT g, any_value(l) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value(n + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY g, i // 2),
subroots AS (SELECT g, l, h FROM nodes WHERE n = 1),
tops(l, i, h, n) AS (SELECT 0, g - 1, h, count(*) OVER () FROM subroots UNION ALL
  SELECT any_value(l) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value(n + 1) // 2
  FROM tops WHERE n > 1 GROUP BY i // 2),
steps AS (SELECT g, l, i, h FROM nodes WHERE n > 1 UNION ALL
  SELECT s.g, s.l + t.l, t.i, t.h FROM tops t, subroots s WHERE t.n > 1),
fold(doc_id, g, l, leaf, i, seen, proof) AS (SELECT doc_id, g, 0, leaf, i, seen, '' FROM placed UNION ALL
  SELECT f.doc_id, f.g, f.l + 1, f.leaf,
    CASE WHEN f.l + 1 = r.l THEN f.g - 1 ELSE f.i // 2 END,
    CASE WHEN s.h IS NULL THEN sha256(f.seen) WHEN f.i % 2 = 0 THEN sha256(f.seen || s.h)
         ELSE sha256(s.h || f.seen) END, f.proof || coalesce(s.h, '')
  FROM fold f JOIN subroots r ON r.g = f.g LEFT JOIN steps s ON s.g = f.g AND s.l = f.l AND s.i = xor(f.i, 1)
  WHERE f.l < r.l + (SELECT max(l) FROM tops))
SELECT f.doc_id, f.leaf, r.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256,
       f.seen AS folded_root, f.seen = t.h AS verified
FROM fold f JOIN subroots r ON r.g = f.g JOIN tops t ON t.n = 1 WHERE f.l = r.l + t.l"""

DIVERGENCE_SQL = """WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang,
    coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
uses AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM uses GROUP BY ALL HAVING count(DISTINCT d) >= 30),
sized AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM uses JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
langs AS (SELECT lang, sum(c) AS n FROM counts GROUP BY ALL),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (1000000000 * (coalesce(c.c, 0) + 5)::HUGEINT) // (coalesce(t.n, 0) + 5 * v) AS p
  FROM groups g JOIN kept k USING (lang) JOIN sized USING (lang)
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
wholes AS (SELECT lang, term, 1 + (1000000000 * (sum(c) + 5)::HUGEINT) // (any_value(n) + 5 * any_value(v)) AS q
  FROM counts JOIN langs USING (lang) JOIN sized USING (lang) GROUP BY lang, term),
pairs AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN shares x ON x.lang = g.lang AND x.source = g.source
  LEFT JOIN shares y ON y.lang = h.lang AND y.source = h.source AND y.term = x.term GROUP BY ALL),
words AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value
  FROM shares JOIN wholes USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (FROM pairs UNION ALL FROM words))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50"""

_CONTROLS = [
    "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|endoftext|>",
]


def _escapes(text: str) -> str:
    """How many backslashes escaping adds: one per backslash and per control string (none overlap)."""
    found = [f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in ["\\", *_CONTROLS]]
    return " + ".join(found)


CHAT_SQL = f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
    (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(text) + {sum(map(len, _CONTROLS[:3]))} + {_escapes("role")} + {_escapes("text")})
       AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""
