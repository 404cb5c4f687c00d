"""SQL that gives the same rows as the queries, where SQL can say what they do."""

from carrel.llm.decontaminate import LOWER, UPPER

WORDS = rf"""regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE = {
    "op2_source_mix": r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, [3e0, 1e0, 2e0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         2e0 * source_size AS most, 1.5e0 * sum(source_size) OVER () AS share
  FROM totals),
levels AS (
  SELECT *, most / weight AS ratio,
         (share - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
         / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size,
         CASE WHEN ratio <= level THEN most ELSE weight * max(CASE WHEN ratio > level THEN level END) OVER () END AS target
  FROM levels),
asked AS (SELECT round(sum(target) / 8)::BIGINT AS seats, sum(target) AS total FROM targets),
ranked AS (
  SELECT source, seats, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS place
  FROM targets, asked, UNNEST(range(0, (target * seats / total)::BIGINT + 2)) AS u(k) WHERE target > 0),
quotas AS (SELECT source, count(*) AS seats FROM ranked WHERE place <= seats GROUP BY source),
placed AS (
  SELECT *, ('0x' || substr(md5(doc_id || ':7'), 1, 15))::BIGINT AS place,
         ('0x' || substr(md5(doc_id || ':7'), 1, 15))::BIGINT
         % greatest(1, ceil((SELECT sum(size) FROM sizes) / 500000e0)::BIGINT) AS shard
  FROM sizes),
cells AS (SELECT source, shard, sum(size) AS cell FROM placed GROUP BY ALL),
within AS (
  SELECT c.source, shard, q.seats, row_number() OVER (PARTITION BY c.source ORDER BY cell / (2 * k + 1) DESC, shard, k) AS place
  FROM (SELECT *, sum(cell) OVER (PARTITION BY source) AS whole FROM cells) AS c
  JOIN quotas AS q ON c.source IS NOT DISTINCT FROM q.source,
       UNNEST(range(0, (cell * q.seats / whole)::BIGINT + 2)) AS u(k) WHERE cell > 0),
given AS (SELECT source, shard, count(*) AS quota FROM within WHERE place <= seats GROUP BY ALL),
blocks AS (
  SELECT c.source, c.shard, ceil(cell / 8)::BIGINT AS n, least(coalesce(quota, 0), 2 * ceil(cell / 8)::BIGINT) AS quota,
         ('0x' || substr(md5(coalesce(c.source, '') || ':' || c.shard || ':8'), 1, 15))::BIGINT
         % greatest(ceil(cell / 8)::BIGINT, 1) AS start
  FROM cells AS c LEFT JOIN given AS g ON c.source IS NOT DISTINCT FROM g.source AND c.shard = g.shard),
runs AS (
  SELECT *, CASE WHEN n > 0 THEN quota // n ELSE 0 END AS times, CASE WHEN n > 0 THEN quota % n ELSE 0 END AS extra FROM blocks),
laid AS (
  SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS z FROM placed)
SELECT doc_id, size, source_size, target,
       (times * size
        + greatest(0, least(z, least(start + extra, n) * 8) - greatest(z - size, start * 8)) * (extra > 0)::INT
        + greatest(0, least(z, (start + extra - n) * 8) - (z - size)) * (extra > 0)::INT)::BIGINT AS taken
FROM laid AS d
JOIN runs AS r ON d.source IS NOT DISTINCT FROM r.source AND d.shard = r.shard
JOIN targets AS t ON d.source IS NOT DISTINCT FROM t.source
""",
    "op5_suffix_dedup": """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
windows AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 800)) AS w FROM d, UNNEST(range(0, greatest(n - 399, 0))) AS u(p)),
repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
starts AS (SELECT doc_id, p FROM windows SEMI JOIN repeated USING (w)),
marked AS (
  SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400 THEN 0 ELSE 1 END AS first FROM starts),
numbered AS (SELECT *, sum(first) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked),
spans AS (SELECT doc_id, span, min(p) AS a, max(p) + 400 AS z FROM numbered GROUP BY ALL),
pieces AS (
  SELECT doc_id, a AS place, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS b, a AS e FROM spans
  UNION ALL SELECT d.doc_id, any_value(n) + 1, coalesce(max(z), 0), any_value(n) FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * b + 1, 2 * (e - b)), '' ORDER BY place) AS rest FROM pieces JOIN d USING (doc_id) GROUP BY doc_id),
removed AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(kept.rest)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
""",
    "op7_decontamination": f"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
items AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE len({WORDS}) > 0),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p + 1:p + 10], ' ') AS gram
  FROM items, UNNEST(range(0, greatest(len(w) - 10, 0) + 1)) AS u(p)),
windows AS (
  SELECT doc_id, p, n, array_to_string(w[p + 1:p + n], ' ') AS gram
  FROM docs, (SELECT DISTINCT n FROM grams), UNNEST(range(0, greatest(len(w) - n + 1, 0))) AS u(p)),
hits AS (SELECT doc_id, p, n, item_id FROM windows JOIN grams USING (n, gram)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, UNNEST(range(p, p + n)) AS u(q) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op10_line_templates": r"""
WITH lines AS (
  SELECT doc_id, line - 1 AS line, body, list_transform(regexp_extract_all(body, '[^ \t\n\x0B\f\r]+'),
         lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '' ELSE x END) AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS body, generate_subscripts(string_split(text, chr(10)), 1) AS line
        FROM documents WHERE text IS NOT NULL)),
leaves AS (SELECT *, len(w) AS k, array_to_string(w[1:3], ' ') AS lead FROM lines WHERE len(w) > 0),
tokens AS (SELECT doc_id, line, k, lead, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM leaves),
often AS (SELECT k, lead, p, t FROM tokens WHERE t <> '' GROUP BY ALL HAVING count(*) >= 4),
masked AS (
  SELECT doc_id, line, k, lead, string_agg(CASE WHEN often.t IS NULL THEN '' ELSE tokens.t END, ' ' ORDER BY p) AS shape,
         count(often.t) AS fixed
  FROM tokens LEFT JOIN often USING (k, lead, p, t) GROUP BY ALL),
kept AS (SELECT * FROM masked WHERE fixed >= 0.5 * k),
recurring AS (SELECT k, lead, shape FROM kept GROUP BY ALL HAVING count(DISTINCT doc_id) >= 4),
whole AS (
  SELECT doc_id, line, len(w) AS k, trim(translate(body, chr(9) || chr(11) || chr(12) || chr(13), '    '), ' ') AS same
  FROM lines WHERE len(w) > 0),
again AS (SELECT same FROM whole GROUP BY same HAVING count(DISTINCT doc_id) >= CASE WHEN max(k) >= 20 THEN 2 ELSE 4 END),
gone AS (
  SELECT doc_id, line FROM kept SEMI JOIN recurring USING (k, lead, shape)
  UNION SELECT doc_id, line FROM whole SEMI JOIN again USING (same)),
left_over AS (
  SELECT doc_id, string_agg(body, chr(10) ORDER BY line) AS body FROM lines ANTI JOIN gone USING (doc_id, line) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id),
dropped AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(counts.n, 0)::BIGINT AS n_lines, coalesce(dropped.n, 0)::BIGINT AS n_dropped,
       sha256(coalesce(left_over.body, '')) AS kept_sha256
FROM documents LEFT JOIN counts USING (doc_id) LEFT JOIN dropped USING (doc_id) LEFT JOIN left_over USING (doc_id)
""",
}

#: Ways over one turn: state in front, turns put in first, what then happens to the turn, state behind.
_NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
_NEW = ["u", "u", "a", "u"]
_NAME = {"u": "user", "a": "assistant"}


def _ways():
    """SQL rows (front, letters, cost, put in, initial, renamed to, behind); up to two turns are put in."""
    rows = []
    for front in range(4):
        state, put = front, []
        for _ in range(3):
            letters, lines = "I" * len(put), "".join(f"{_NAME[p]}:\n" for p in put).replace("\n", "' || chr(10) || '")
            ways = [("D", 3, "NULL", "NULL", state), ("R", 2, "NULL", f"'{_NAME[_NEW[state]]}'", _NEXT[state][_NEW[state]])]
            ways += [("K", 0, f"'{initial}'", "NULL", after) for initial, after in _NEXT[state].items()]
            ways += [("K", 0, "''", "NULL", state)]
            for letter, cost, initial, name, behind in ways:
                rows.append(f"({front}, '{letters}{letter}', {cost + 2 * len(put)}, '{lines}', {initial}, {name}, {behind})")
            put.append(_NEW[state])
            state = _NEXT[state][_NEW[state]]
    return ",\n  ".join(rows)


ORACLE["op11_auction_repair"] = rf"""
WITH RECURSIVE steps AS (
  SELECT n, list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, n::BIGINT) AS c
  FROM range(256) AS r(n)),
lookup AS (SELECT list(c::BIGINT ORDER BY n) AS t FROM steps),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce(list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i::INT, 1))::BIGINT),
            lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM named, lookup),
rows_ AS (
  SELECT coalesce('=' || conv_id, '') AS c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
  FROM rows_),
faults AS (
  SELECT c, turn, role, text, i, left(role, 1) AS initial,
         lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before,
         CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY c),
ways(front, letters, cost, put, initial, name, behind) AS (VALUES
  {_ways()}),
walked AS (
  SELECT c, 0::BIGINT AS i, 0 AS state, struct_pack(cost := 0::BIGINT, audit := '', lines := '') AS best FROM counts
  UNION ALL
  SELECT c, i, state, min(best) FROM (
    SELECT w.c, f.i, v.behind AS state,
           struct_pack(cost := w.best.cost + v.cost + CASE WHEN f.fault = 'truncated' AND right(v.letters, 1) <> 'D' THEN 1 ELSE 0 END,
                       audit := w.best.audit || v.letters,
                       lines := w.best.lines || v.put || CASE WHEN right(v.letters, 1) = 'D' THEN ''
                                ELSE coalesce(v.name, f.role) || ':' || f.text || chr(10) END) AS best
    FROM walked AS w JOIN faults AS f ON f.c = w.c AND f.i = w.i + 1
    JOIN ways AS v ON v.front = w.state AND (v.initial IS NULL OR v.initial = f.initial)
      AND (right(v.letters, 1) = 'D' OR f.fault NOT IN ('blank', 'duplicate'))) GROUP BY c, i, state),
ended AS (
  SELECT w.c, min(struct_pack(cost := best.cost + p.cost, audit := best.audit || p.letters, lines := best.lines || p.put)) AS best
  FROM walked AS w JOIN counts AS n ON w.c = n.c AND w.i = n.n
  JOIN (VALUES (0, '', 0, ''), (1, 'II', 4, 'user:' || chr(10) || 'assistant:' || chr(10)), (2, 'I', 2, 'assistant:' || chr(10)),
        (3, '', 0, '')) AS p(state, letters, cost, put) ON p.state = w.state
  GROUP BY w.c)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit,
       sha256(CASE WHEN coalesce(best.lines, '') = '' THEN '' ELSE left(best.lines, length(best.lines) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counts AS n ON n.c = coalesce('=' || o.conv_id, '') LEFT JOIN ended AS e ON e.c = n.c
"""


def _framed(column):
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


_LEAF = " || ".join(map(_framed, ("doc_id", "source", "lang", "n_chars")))

ORACLE["op12_merkle_manifest"] = rf"""
WITH RECURSIVE steps AS (
  SELECT n, list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, n::BIGINT) AS c
  FROM range(256) AS r(n)),
lookup AS (SELECT list(c::BIGINT ORDER BY n) AS t FROM steps),
cut AS (
  SELECT *, CASE WHEN xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT),
            lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 2 = 0
            THEN replace(text, chr(10), '') ELSE text END AS other
  FROM documents, lookup),
leaves AS (
  SELECT doc_id, source, sha256({_LEAF} || {_framed("text")}) AS leaf, sha256({_LEAF} || {_framed("other")}) AS tampered FROM cut),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves),
up AS (
  SELECT tree, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM up WHERE n > 1 GROUP BY tree, pos // 3),
tops AS (SELECT tree, node AS subroot, level AS height FROM up WHERE n = 1),
over_ AS (
  SELECT 0 AS level, tree AS pos, subroot AS node, count(*) OVER () AS n FROM tops
  UNION ALL
  SELECT any_value(level) + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM over_ WHERE n > 1 GROUP BY pos // 3),
root AS (SELECT node AS root, level AS height FROM over_ WHERE n = 1),
every AS (
  SELECT u.tree, u.level, u.pos, u.node FROM up AS u JOIN tops USING (tree) WHERE u.level < height
  UNION ALL
  SELECT tree, t.height + level, o.pos, o.node FROM tops AS t, over_ AS o, root AS r WHERE level < r.height),
ways AS (
  SELECT row_number() OVER () AS id, p.*, subroot, height, pos AS spot FROM placed AS p JOIN tops USING (tree)),
walked AS (
  SELECT id, tree, height, 0 AS level, CASE WHEN height = 0 THEN tree ELSE spot END AS spot, tampered AS own, '' AS proof FROM ways
  UNION ALL
  SELECT id, tree, height, level + 1, CASE WHEN level + 1 = height THEN tree ELSE spot // 3 END, own, proof FROM (
    SELECT w.id, w.tree, w.height, w.level, w.spot,
           sha256(string_agg(CASE WHEN e.pos = w.spot THEN w.own ELSE e.node END, '' ORDER BY e.pos)) AS own,
           w.proof || coalesce(string_agg(e.node, '' ORDER BY e.pos) FILTER (e.pos <> w.spot), '') AS proof
    FROM walked AS w JOIN every AS e ON e.tree = w.tree AND e.level = w.level AND e.pos // 3 = w.spot // 3
    GROUP BY w.id, w.tree, w.height, w.level, w.spot, w.own, w.proof)),
done AS (SELECT w.* FROM walked AS w, root AS r WHERE w.level = w.height + r.height)
SELECT doc_id, leaf, subroot, root, sha256(d.proof) AS proof_sha256, d.own AS folded_root, d.own = root AS verified
FROM ways AS w JOIN done AS d ON d.id = w.id, root
"""

ORACLE["op13_lattice_groups"] = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS n, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
good AS (
  SELECT * FROM vectors WHERE label IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v) AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.n AS a, b.n AS b FROM good AS a JOIN good AS b ON a.label = b.label AND a.n <> b.n AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reached AS (
  SELECT n, n AS m FROM vectors
  UNION
  SELECT r.n, l.b FROM reached AS r JOIN links AS l ON l.a = r.m)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.n) AS n_links, c.component_id,
       v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM vectors AS v JOIN (SELECT r.n, min(o.vec_id) AS component_id FROM reached AS r JOIN vectors AS o ON o.n = r.m GROUP BY r.n) AS c ON c.n = v.n
"""
