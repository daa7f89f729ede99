"""DuckDB twins of the queries that SQL can express, over whole tables."""

from __future__ import annotations

from railwatch.llm.sharding import PRIME, round_keys

_WORDS = r"'[^\x20\x09-\x0D]+'"

# 1.5 times all words, weights 5, 2, 1, at most twice a source.
_OP9 = f"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS}))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS point
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM sizes GROUP BY source
), capped AS (SELECT *, (source_size * 2)::DOUBLE AS cap FROM sources
), levels AS (
  SELECT *, cap / w AS ratio,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0.0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0.0)) AS level
  FROM capped WINDOW before AS (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), found AS (SELECT arg_min(level, (ratio, n)) AS level FROM levels WHERE level * w <= cap
), targets AS (
  SELECT source, source_size, least(cap, coalesce(f.level * w, cap)) AS target FROM levels l LEFT JOIN found f ON true
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), points AS (
  SELECT s.source, s.point, sum(s.size) AS n, any_value(b.target - b.whole * b.source_size) AS budget
  FROM sizes s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source GROUP BY s.source, s.point
), running AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY point) AS through FROM points
), chosen AS (
  SELECT source, point FROM (SELECT *, row_number() OVER (PARTITION BY source, through > budget ORDER BY point) AS k FROM running)
  WHERE budget > 0 AND (through <= budget OR (k = 1 AND through - budget < budget - (through - n)))
)
SELECT s.doc_id, s.size, b.source_size, b.target, s.size * (b.whole + (c.point IS NOT NULL)::BIGINT) AS taken
FROM sizes s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source AND s.point = c.point
"""


def _op5(shards: int = 40, seed: int = 20240229) -> str:
    sides = []
    for i, key in enumerate(round_keys(seed)):
        moved, still, size = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
        x = f"(({still} + {key}) % {PRIME})"
        f = f"((({x} * {x}) % {PRIME} * 16807 + {key}) % {PRIME})"
        sides.append((moved, f"({moved} + {f}) % {size}"))

    def turn(source: str) -> str:
        out = f"SELECT k, (v // b)::BIGINT AS l, v % b AS r, a, b, n FROM ({source})"
        for moved, f in sides:
            new = {"l": "l", "r": "r", moved: f}
            out = f"SELECT k, {new['l']} AS l, {new['r']} AS r, a, b, n FROM ({out})"
        return f"SELECT k, l * b + r AS v, a, b, n FROM ({out})"

    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(x ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, j: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS x
    FROM range(256) r(i))
), docs AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
    xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) AS text_crc32
  FROM documents, crc_table
), bounds AS (
  SELECT n, greatest(1, floor(sqrt(n))::BIGINT) AS a, greatest(1, ((n + greatest(1, floor(sqrt(n))::BIGINT) - 1) // greatest(1, floor(sqrt(n))::BIGINT))) AS b
  FROM (SELECT count(*) AS n FROM documents)
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS k FROM docs
), start AS (SELECT k, k AS v, a, b, n FROM numbered, bounds
), walk AS (
  {turn("SELECT * FROM start")}
  UNION ALL
  {turn("SELECT * FROM walk WHERE v >= n")}
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (v % {shards})::INTEGER AS shard, (v // {shards})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM numbered JOIN walk USING (k) WHERE v < n
"""


_OP3 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM (SELECT DISTINCT * FROM whole WHERE vec_id % 50 = 0) q JOIN (SELECT DISTINCT * FROM whole) c ON q.vec_id <> c.vec_id
), best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM best WHERE rank <= 5
"""


# The CRC of a string as DuckDB has none: a table of 256 remainders, folded over the bytes.
_CRC_TABLE = """crc_table AS (
  SELECT list(x ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, j: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS x
    FROM range(256) r(i))
)"""


def _crc(text: str) -> str:
    return f"""xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda z: ('0x' || z)::BIGINT),
      lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)))"""


# A run of four periods holds two steps between multiples of its period: such pairs of text and period are the candidates.
_OP11 = f"""
WITH {_CRC_TABLE}, docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w, {_crc("doc_id::VARCHAR")} AS h FROM documents, crc_table
), placed AS (
  SELECT doc_id, w, len(w) AS n, h, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM docs
), damaged AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
    list_transform(range(n), lambda i: w[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END) + 1]) END AS w
  FROM placed
), periods AS (SELECT doc_id, n, w, unnest(range(1, n // 4 + 1)) AS q FROM damaged
), steps AS (
  SELECT doc_id, n, w, q FROM periods
  WHERE len(list_filter(range(n // q - 2), lambda k: w[k * q + 1] = w[(k + 1) * q + 1] AND w[k * q + 1] = w[(k + 2) * q + 1])) > 0
), gaps AS (
  SELECT doc_id, n, q, [-1::BIGINT] || list_filter(range(n - q), lambda i: w[i + 1] <> w[i + q + 1]) || [n - q] AS m FROM steps
), stretches AS (
  SELECT doc_id, q, unnest(m[:-2]) + 1 AS start, unnest(list_transform(range(1, len(m)), lambda k: m[k + 1] - m[k] - 1)) + q AS length FROM gaps
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= 6 AND length >= 4 * q GROUP BY doc_id, start, length
), listed AS (
  SELECT doc_id, count(*) AS n_runs, list({{'s': start, 'l': length, 'p': period}} ORDER BY start, period) AS r,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text
  FROM runs GROUP BY doc_id
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS k FROM runs) WHERE k = 1
)
SELECT d.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length, b.period::BIGINT AS period,
  ((1000 * b.length) // b.period)::BIGINT AS exponent_milli, sha256(coalesce(l.text, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN l.r IS NULL THEN d.w ELSE list_transform(
    list_filter(range(d.n), lambda i: len(list_filter(l.r, lambda x: i >= x.s + x.p AND i < x.s + x.l)) = 0), lambda i: d.w[i + 1]) END, ' ')) AS collapsed_sha256
FROM damaged d LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id)
"""


_OP12 = """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), rows AS (
  SELECT doc_id, unnest(range(len(lines))) AS k, unnest(lines) AS line FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM rows
), often AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (SELECT k.*, o.key IS NOT NULL AS gone FROM keyed k LEFT JOIN often o ON k.key = o.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _op13() -> str:
    edit = lambda cost, letter, line, then: f"{{'c': {cost} + {then}.c, 'a': '{letter}' || {then}.a, 'r': {line} || {then}.r}}"
    row = "role || ':' || text || chr(10)"
    grown = {0: ("s2", "user"), 1: ("s2", "user"), 2: ("s3", "assistant"), 3: ("s2", "user")}
    kept = {0: [("s", "s1"), ("u", "s2")], 1: [("u", "s2")], 2: [("a", "s3")], 3: [("u", "s2")]}
    none = "NULL"
    own = []
    for state in range(4):
        then, name = grown[state]
        keep = "CASE" + "".join(f" WHEN NOT forced AND left(role, 1) = '{x}' THEN {edit('cut', 'K', row, to)}" for x, to in kept[state]) + f" ELSE {none} END"
        role = f"CASE WHEN NOT forced THEN {edit('2 + cut', 'R', chr(39) + name + ':' + chr(39) + ' || text || chr(10)', then)} ELSE {none} END"
        delete = edit("3", "D", "''", f"s{state}")
        own.append(f"list_sort(list_filter([{delete}, {keep}, {role}], lambda x: x IS NOT NULL))[1] AS b{state}")
    put = lambda name, then: edit("2", "I", f"'{name}:' || chr(10)", then)
    least = lambda x, y: f"list_sort([{x}, {y}])[1]"
    return f"""
WITH RECURSIVE {_CRC_TABLE}, kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM kinds, (VALUES (1), (2)) copies(copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM damaged
), faults AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) || left(role, 1) AS two FROM placed
), steps AS (SELECT *, fault IN ('blank', 'duplicate') AS forced, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut FROM faults
), walk AS (
  SELECT conv_id, n AS k, {{'c': 0, 'a': '', 'r': ''}} AS s0, {{'c': 4, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS s1,
    {{'c': 2, 'a': 'I', 'r': 'assistant:' || chr(10)}} AS s2, {{'c': 0, 'a': '', 'r': ''}} AS s3 FROM steps WHERE k = n
  UNION ALL
  SELECT conv_id, k - 1 AS k, {least("b0", put("user", "m2"))} AS s0, {least("b1", put("user", "m2"))} AS s1, m2 AS s2, m3 AS s3 FROM (
    SELECT *, {least("b2", put("assistant", "b3"))} AS m2, {least("b3", put("user", "b2"))} AS m3 FROM (
      SELECT w.conv_id, w.k, {", ".join(own)} FROM walk w JOIN steps s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.k = s.k))
), ends AS (SELECT conv_id, s0 FROM walk WHERE k = 0
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE two NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(s0.c, 0)::BIGINT AS cost, coalesce(s0.a, '') AS audit,
  sha256(coalesce(s0.r[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON c.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN ends e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


ORACLES = {
    "op3_ball_tree_top_k": _OP3, "op5_feistel_shards": _op5(), "op9_mix_sources": _OP9,
    "op11_branching_runs": _OP11, "op12_cuckoo_line_dedup": _OP12, "op13_conversation_repair": _op13(),
}
