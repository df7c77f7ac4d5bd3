"""SQL twins of the joins over texts and of the operators on conversations."""

#: CRC-32 of the ASCII string {s}.
_CRC = r"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length({s}) + 1), lambda i: CAST(ascii(substring({s}, CAST(i AS INTEGER), 1)) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
        lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END)), CAST(4294967295 AS BIGINT))"""

PARITY_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS shingles FROM d),
n AS (SELECT doc_id, len(shingles) AS n FROM s),
t AS (SELECT doc_id, n, unnest(shingles) AS shingle FROM s JOIN n USING (doc_id)),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n) AS m, any_value(b.n) AS n
  FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY ALL),
e AS (SELECT a, b FROM c WHERE 100 * common >= 90 * (m + n - common)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT n.doc_id, n.n AS n_shingles, min(r.root) AS component_id FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY ALL"""

PREFIX_TRIE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, """ + _CRC.format(s="CAST(conv_id AS VARCHAR)") + r""" % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT k.conv_id, 0 AS own, t.pos, t.role, t.text FROM k JOIN t ON t.conv_id = k.base AND t.pos <= k.h
  UNION ALL
  SELECT k.conv_id, 1, t.pos, t.role, t.text FROM k JOIN t ON t.conv_id = k.conv_id AND t.pos > k.h),
s AS (
  SELECT k.conv_id, coalesce(list({'r': r.role, 't': r.text} ORDER BY own, pos) FILTER (r.conv_id IS NOT NULL), []) AS turns
  FROM k LEFT JOIN r ON r.conv_id = k.conv_id GROUP BY k.conv_id),
p AS (SELECT conv_id, turns, unnest(generate_series(0, len(turns))) AS depth FROM s),
n AS (
  SELECT turns[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
  FROM p GROUP BY ALL),
c AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.node[-1].t, '[^\x20\x09-\x0D]+')) END AS own
  FROM n LEFT JOIN c ON c.node = n.node AND c.depth = n.depth),
u AS (
  SELECT node[1:up] AS node, up AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved_tokens
  FROM (SELECT node, n_children, own, unnest(generate_series(0, depth)) AS up FROM m) GROUP BY ALL)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN u ON u.node = m.node AND u.depth = m.depth
LEFT JOIN n q ON m.depth > 0 AND q.depth = m.depth - 1 AND q.node = m.node[1:m.depth - 1]"""

#: Keeps by grammar state: (role initial, state after it).
KEEPS = [[("s", 1), ("u", 2), ("", 0)], [("u", 2), ("", 1)], [("a", 3), ("", 2)], [("u", 2), ("", 3)]]
EXPECTED = (2, 2, 3, 2)


def _step(q: int) -> str:
    """Least (cost, edits) of the edits of one row in state ``q``, from those of the rows behind it."""
    after = EXPECTED[q]
    kept = " ".join(f"WHEN '{i}' THEN f{to}" for i, to in KEEPS[q])
    initials = ", ".join(repr(i) for i, _ in KEEPS[q])
    return (f"list_min(list_filter([{{'c': f{q}.c + 3, 's': 'D' || f{q}.s}}, "
            f"CASE WHEN fault NOT IN ('b', 'd') AND initial IN ({initials}) "
            f"THEN {{'c': (CASE initial {kept} END).c + stump, 's': 'K' || (CASE initial {kept} END).s}} END, "
            f"CASE WHEN fault NOT IN ('b', 'd') THEN {{'c': f{after}.c + 2 + stump, 's': 'R' || f{after}.s}} END], lambda x: x IS NOT NULL)) AS e{q}")


def _inserts(q: int) -> str:
    """The same with up to two insertions before the row."""
    after, then = EXPECTED[q], EXPECTED[EXPECTED[q]]
    return f"list_min([e{q}, {{'c': e{after}.c + 2, 's': 'I' || e{after}.s}}, {{'c': e{then}.c + 4, 's': 'II' || e{then}.s}}]) AS f{q}"


STRUCTURE_REPAIR = r"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS spot FROM conversations),
k AS (SELECT *, """ + _CRC.format(s="spot") + r""" % 20 AS kind FROM o),
d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM k WHERE kind > 0),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, substring(role, 1, 1) AS initial FROM d),
r AS (
  SELECT *, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
                 WHEN right(body, 1) IN ('.', '!', '?') THEN 'o' ELSE 't' END AS fault,
         coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au'), false) AS bad FROM n),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (bad) AS illegal, count(*) AS n
  FROM r GROUP BY conv_id),
f(conv_id, pos, f0, f1, f2, f3) AS (
  SELECT conv_id, n + 1, {'c': 0, 's': ''}, {'c': 4, 's': 'II'}, {'c': 2, 's': 'I'}, {'c': 0, 's': ''} FROM g
  UNION ALL
  SELECT conv_id, pos, """ + ", ".join(map(_inserts, range(4))) + r"""
  FROM (SELECT conv_id, pos, """ + ", ".join(map(_step, range(4))) + r"""
        FROM (SELECT f.conv_id, r.pos, f0, f1, f2, f3, r.initial, r.fault, CASE r.fault WHEN 't' THEN 1 ELSE 0 END AS stump
              FROM f JOIN r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.pos = f.pos - 1))),
best AS (SELECT conv_id, f0.c AS cost, f0.s AS audit FROM f WHERE pos = 1),
w(conv_id, nth, pos, state, body) AS (
  SELECT conv_id, 1, 0, 0, CAST([] AS VARCHAR[]) FROM best
  UNION ALL
  SELECT conv_id, nth + 1, pos, after,
         CASE letter WHEN 'D' THEN body WHEN 'K' THEN list_append(body, role || ':' || text)
              ELSE list_append(body, CASE after WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE letter WHEN 'R' THEN text ELSE '' END) END
  FROM (SELECT w.conv_id, w.nth, w.pos + (letter <> 'I')::INTEGER AS pos, letter, role, text, w.body,
               CASE WHEN letter = 'D' THEN state WHEN letter = 'K' THEN CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE state END
                    WHEN state = 2 THEN 3 ELSE 2 END AS after
        FROM (SELECT w.*, substring(audit, nth, 1) AS letter FROM w JOIN best ON best.conv_id IS NOT DISTINCT FROM w.conv_id WHERE nth <= length(audit)) w
        LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND letter <> 'I' AND r.pos = w.pos + 1)),
said AS (
  SELECT w.conv_id, sha256(array_to_string(w.body, chr(10))) AS sha FROM w JOIN best ON best.conv_id IS NOT DISTINCT FROM w.conv_id
  WHERE w.nth = length(audit) + 1)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM i.conv_id"""
