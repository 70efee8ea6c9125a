"""DuckDB SQL for the operators' queries that SQL can express."""

OP3 = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS i, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.i, q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.x, v.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v ON q.i <> v.i WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
f AS (SELECT doc_id, unnest(s) AS h FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM f a JOIN f b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, top) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.top FROM r JOIN e ON e.a = r.id)
SELECT n.doc_id, n.n AS n_shingles, t.top AS component_id, n.doc_id = t.top AS kept
FROM n JOIN (SELECT id, min(top) AS top FROM r GROUP BY id) t ON t.id = n.doc_id
"""

OP8 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
u AS (
  SELECT vec_id, label, x, sqrt(list_sum(list_transform(x, lambda y: y * y))) AS n FROM v
  WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.n > 0 AND b.n > 0
  WHERE list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2])) / (a.n * b.n) >= 0.98),
r(id, top) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.top FROM r JOIN l ON l.a = r.id)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, t.top AS component_id, v.vec_id = t.top AS kept
FROM v JOIN (SELECT id, min(top) AS top FROM r GROUP BY id) t ON t.id = v.vec_id
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100
      THEN 'plain' WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(u[greatest(a, b) + 1:], '') AS s FROM x)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
    AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

OP12 = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))),
t AS (SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens, turn >> 8 AS block FROM r),
f AS (SELECT * FROM t WHERE role = 'system' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) = 1),
e AS (
  SELECT conv_id, block, 2 AS kind, turn, role, text, tokens FROM t
  UNION ALL SELECT f.conv_id, l.block, 0, f.turn, f.role, f.text, f.tokens FROM f JOIN (SELECT DISTINCT conv_id, block FROM t) l
    ON l.conv_id = f.conv_id AND l.block > f.block
  UNION ALL SELECT conv_id, block + 1, 1, turn, role, text, tokens FROM t WHERE turn & 255 >= 254),
s AS (
  SELECT *, row_number() OVER o AS pos, sum(tokens) OVER o AS upto, sum(CASE kind WHEN 2 THEN tokens ELSE 0 END) OVER o AS stop,
    greatest(384 - coalesce(max(CASE role WHEN 'system' THEN tokens END) OVER (PARTITION BY conv_id, block), 0), 1) AS room,
    length(replace(text, '<|', '<||')) + length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<|', '<||')) + 24 AS chars
  FROM e WINDOW o AS (PARTITION BY conv_id, block ORDER BY kind, turn, role, text ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, CASE kind WHEN 2 THEN 2 * ((stop - tokens) // room) + CAST((stop - tokens) // room <> (stop - 1) // room AS INT) END AS span FROM s),
b AS (
  SELECT *, lead(pos) OVER (PARTITION BY conv_id, block ORDER BY pos) AS next FROM
  (SELECT *, lag(upto) OVER w AS gone FROM g WINDOW w AS (PARTITION BY conv_id, block ORDER BY pos)
   QUALIFY span IS NOT NULL AND span IS DISTINCT FROM lag(span) OVER w)),
h AS (SELECT conv_id, block, min(pos) AS head FROM g WHERE role = 'system' GROUP BY ALL),
c AS (
  SELECT g.conv_id, sum(g.chars) AS chars, count(DISTINCT (b.block, b.pos)) AS n FROM g JOIN b ON b.conv_id = g.conv_id AND b.block = g.block
    LEFT JOIN h ON h.conv_id = g.conv_id AND h.block = g.block
  WHERE (g.pos >= b.pos AND g.pos < coalesce(b.next, g.pos + 1)) OR (g.pos < b.pos AND (g.pos = h.head OR (g.pos >= b.pos - 2 AND g.upto - g.tokens >= b.gone - 128)))
  GROUP BY g.conv_id)
SELECT r.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE role WHEN 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(any_value(c.chars) AS BIGINT) AS formatted_chars, CAST(any_value(c.n) AS BIGINT) AS n_windows
FROM r JOIN c ON c.conv_id = r.conv_id GROUP BY r.conv_id
"""


def _repair_sql() -> str:
    """Edits row by row: for each state the least (cost, audit) so far, as nine digits and letters, so that text order decides."""
    def add(v: str, cost: str, letter: str) -> str:
        return f"printf('%09d', CAST({v}[1:9] AS INT) + {cost}) || {v}[10:] || '{letter}'"

    insert = "s0, s1, least(s2, " + ", ".join(add(v, "5", "I") for v in ("s0", "s1", "s3")) + ") AS s2, least(s3, " + add("s2", "5", "I") + ") AS s3"
    gone = {s: add(s, "2", "D") for s in ("s0", "s1", "s2", "s3")}

    def able(v: str, cost: str, letter: str, when: str = "TRUE") -> str:
        return f"CASE WHEN NOT gone AND {when} THEN {add(v, cost, letter)} END"

    two = [gone["s2"], *[able(v, "1 + bad", "R") for v in ("s0", "s1", "s3")], *[able(v, "bad", "K", "init = 'u'") for v in ("s0", "s1", "s3")]]
    three = [gone["s3"], able("s2", "1 + bad", "R"), able("s2", "bad", "K", "init = 'a'")]
    step = (f"{gone['s0']} AS s0, least({gone['s1']}, {able('s0', 'bad', 'K', chr(39).join(['init = ', 's', '']))}) AS s1, "
            f"least({', '.join(two)}) AS s2, least({', '.join(three)}) AS s3")
    return rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
z AS (
  SELECT *, xor(4294967295, list_reduce(list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT)), lambda c, x:
      xor(c >> 8, list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(c & 255, x))),
    CAST(4294967295 AS BIGINT))) % 20 AS fate FROM k),
d AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM z WHERE fate <> 0),
o AS (
  SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    role[1:1] AS init, lag(role[1:1]) OVER w AS prev, regexp_replace(text, '[ 	-
]+$', '') AS seen FROM d
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
f AS (
  SELECT *, seen = '' AS blank, seen <> '' AND again AS dup, seen <> '' AND NOT again AND NOT regexp_matches(seen, '[.!?]$') AS cut,
    seen = '' OR again AS gone, CASE WHEN seen <> '' AND NOT again AND NOT regexp_matches(seen, '[.!?]$') THEN 5 ELSE 0 END AS bad FROM o),
v(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, 0, '000000000', CAST(NULL AS VARCHAR), '000000005I', '000000010II' FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, least(s3, {add('s2', '5', 'I')}) FROM (
    SELECT conv_id, i, {insert} FROM (SELECT v.conv_id, f.i, {step} FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i + 1))),
l AS (SELECT conv_id, least(s0, s3) AS best FROM v QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
a AS (SELECT conv_id, CAST(best[1:9] AS BIGINT) AS cost, best[10:] AS audit, length(replace(best[10:], 'D', '')) % 2 AS odd FROM l),
e AS (
  SELECT conv_id, odd, p, audit[p:p] AS letter, p - length(regexp_replace(audit[1:p], '[^I]', '', 'g')) AS i,
    p - length(regexp_replace(audit[1:p], '[^D]', '', 'g')) AS place FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM a)),
g AS (
  SELECT e.conv_id, string_agg(CASE WHEN letter = 'K' THEN f.role WHEN (place - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE letter WHEN 'I' THEN '' ELSE f.text END, chr(10) ORDER BY p) AS whole
  FROM e LEFT JOIN f ON letter <> 'I' AND f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i WHERE letter <> 'D' GROUP BY e.conv_id),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (prev IS NOT NULL AND prev || init NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM a LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM a.conv_id
"""


ORACLES = {"op3_impact_topk": OP3, "op4_minhash": OP4, "op8_cover_tree": OP8,
           "op11_fill_middle": OP11, "op12_chat_windows": OP12, "op13_repair": _repair_sql()}
