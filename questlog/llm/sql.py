"""DuckDB SQL of the queries whose results SQL can express."""

from __future__ import annotations

from questlog.llm import chat, egojoin, quartiles, turns, winnow


def _escaped(column: str) -> str:
    """Of a column, what chat.escape makes of it."""
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


CHAT = rf"""
WITH said AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(chat.START + chat.TEXT + chat.END)} + length({_escaped("role")}) + length({_escaped("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

WINDOWS = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL
), docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS w FROM documents
), starts AS (
  SELECT item, w, least(len(w), {winnow.WINDOW}) AS k, unnest(range(1, len(w) - least(len(w), {winnow.WINDOW}) + 2)) AS i FROM items WHERE len(w) > 0
), windows AS MATERIALIZED (
  SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS said FROM starts
), runs AS (
  SELECT row_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
), found AS MATERIALIZED (
  SELECT row_id, i, k, item FROM (SELECT row_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS said FROM runs) JOIN windows USING (k, said)
), hits AS (
  SELECT row_id, count(DISTINCT place) AS n_hit FROM (SELECT row_id, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT row_id, i, k FROM found)) GROUP BY row_id
), named AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT row_id, item FROM found) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row_id) LEFT JOIN named USING (row_id)
"""

COSINE = f"""
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= {egojoin.THRESHOLD} ELSE false END
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, coalesce(vec_id <= coalesce(low, vec_id), false) AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) counts ON vec_id = counts.a
  LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) lows ON vec_id = lows.a
"""

_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST(range(8) AS BIGINT[])), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _then(state: str, edit: str, cost: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"


def _or_insert(to: str, *states: str) -> str:
    return f"list_min([{', '.join([to, *(_then(x, 'I', str(turns.INSERT)) for x in states)])}])"


def _takes(to: str, letter: str, states: tuple[str, ...]) -> str:
    """The least edits that lead to a state: the row is deleted, or becomes that letter."""
    taken = ", ".join(f"CASE WHEN fault IN ('blank', 'duplicate') THEN NULL WHEN kind = '{letter}' THEN {_then(x, 'K', 'm')} " + (f"ELSE {_then(x, 'R', 'm + 1')} " if letter != "s" else "") + "END" for x in states)
    return f"list_min([{_then(to, 'D', '2')}, {taken}])"


#: Edits go row by row over the four states of the grammar, each with its least cost and audit.
REPAIR = f"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), fates AS MATERIALIZED (SELECT k, {_CRC} % 20 AS fate FROM (SELECT DISTINCT k FROM base)
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM base JOIN fates USING (k) WHERE fate <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text), copy) AS n, rtrim(text, {_SPACES}) AS bare, left(role, 1) AS kind FROM damaged
), marked AS MATERIALIZED (
  SELECT conv_id, turn, role, text, n, kind, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    coalesce(lag(kind) OVER (PARTITION BY conv_id ORDER BY n) || kind NOT IN ('su', 'ua', 'au'), false) AS bad FROM numbered
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, {{'c': CAST(0 AS BIGINT), 'a': ''}} AS s0, {{'c': CAST(1000000000000 AS BIGINT), 'a': ''}} AS s1, {{'c': CAST(5 AS BIGINT), 'a': 'I'}} AS s2, {{'c': CAST(10 AS BIGINT), 'a': 'II'}} AS s3 FROM (SELECT DISTINCT conv_id FROM marked)
  UNION ALL
  SELECT conv_id, n, s0, s1, s2, {_or_insert('t3', 's2')} AS s3 FROM (
    SELECT conv_id, n, t0 AS s0, t1 AS s1, {_or_insert('t2', 't0', 't1', 't3')} AS s2, t3 FROM (
      SELECT conv_id, n, {_then('s0', 'D', '2')} AS t0, {_takes('s1', 's', ('s0',))} AS t1, {_takes('s2', 'u', ('s0', 's1', 's3'))} AS t2, {_takes('s3', 'a', ('s2',))} AS t3
      FROM (SELECT w.conv_id, m.n, s0, s1, s2, s3, fault, kind, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS m FROM walk w JOIN marked m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND m.n = w.n + 1)
    )
  )
), least AS (
  SELECT walk.conv_id, list_min([s0, s3]) AS x FROM walk JOIN (SELECT conv_id, count(*) AS n FROM marked GROUP BY 1) rows_ ON walk.n = rows_.n AND walk.conv_id IS NOT DISTINCT FROM rows_.conv_id
), letters AS (
  SELECT conv_id, x.a AS a, unnest(range(1, length(x.a) + 1)) AS j, length(regexp_replace(x.a, 'D', '', 'g')) % 2 AS odd FROM least
), places AS (
  SELECT conv_id, j, a[j] AS e, length(regexp_replace(a[1:j], 'I', '', 'g')) AS n, (length(regexp_replace(a[1:j], 'D', '', 'g')) + odd) % 2 AS first FROM letters
), lines AS (
  SELECT p.conv_id, j, CASE WHEN e = 'K' THEN role WHEN first = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END AS line
  FROM places p LEFT JOIN marked m ON p.conv_id IS NOT DISTINCT FROM m.conv_id AND p.n = m.n WHERE e <> 'D'
), texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS said FROM lines GROUP BY 1
), faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal FROM marked GROUP BY 1
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(x.c, 0) AS cost, coalesce(x.a, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN faults f ON o.conv_id IS NOT DISTINCT FROM f.conv_id
  LEFT JOIN least l ON o.conv_id IS NOT DISTINCT FROM l.conv_id LEFT JOIN texts t ON o.conv_id IS NOT DISTINCT FROM t.conv_id
"""

_TRIPLETS = ", ".join(f"(w[i] * {quartiles.MULTIPLIERS[0]} + w[i + {j}] * {quartiles.MULTIPLIERS[1]} + w[i + {k}] * {quartiles.MULTIPLIERS[2]} + {n * quartiles.PAIR}) % 65536 // 256" for n, (j, k) in enumerate(quartiles.PAIRS))
_DOUBLINGS = "CAST(length(bin(bytes)) - 1 AS BIGINT)"
_STEPS = "CASE abs(x - y) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 6 END"


def _like(a: str, b: str) -> str:
    """Likeness of two rows of prints: steps between buckets against those of all pairs of buckets."""
    steps = f"list_sum(list_transform(range(1, 257), lambda i: list_extract([0, 1, 2, 6], 1 + abs({a}.codes[i] - {b}.codes[i]))))"
    chance = "list_sum([" + ", ".join(f"{(0, 1, 2, 6)[abs(x - y)]} * {a}.h[{x + 1}] * {b}.h[{y + 1}]" for x in range(4) for y in range(4) if x != y) + "])"
    return f"CASE WHEN {a}.print = {b}.print THEN CAST(1.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) - least(CAST(1.0 AS DOUBLE), CASE WHEN {chance} = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(256 * {steps} AS DOUBLE) / CAST({chance} AS DOUBLE) END + CAST(abs({a}.len - {b}.len) AS DOUBLE) / CAST({quartiles.LENGTHS} AS DOUBLE)) END"


QUARTILES = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS n, doc_id, coalesce(text, '') AS text FROM documents
), pairs AS (
  SELECT a.n, a.doc_id, a.text, b.n AS m, a.text[1 : length(a.text) - length(a.text) // 4] || b.text[1 : length(a.text) // 4] AS other
  FROM docs a JOIN docs b ON b.n = a.n % (SELECT count(*) FROM docs) + 1
), texts AS (
  SELECT n, false AS edited, text FROM pairs UNION ALL SELECT n, true, other FROM pairs
), spelt AS MATERIALIZED (
  SELECT n, edited, strlen(text) AS bytes, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS w FROM texts
), filled AS (
  SELECT n, edited, CASE WHEN bytes BETWEEN 1 AND 4 THEN list_resize(w, 5, 0) ELSE w END AS w FROM spelt
), counts AS (
  SELECT n, edited, bucket, count(*) AS c FROM (SELECT n, edited, unnest([{_TRIPLETS}]) AS bucket FROM (SELECT n, edited, w, unnest(range(1, len(w) - 3)) AS i FROM filled)) GROUP BY ALL
), full_ AS (
  SELECT n, edited, b.bucket, coalesce(c, 0) AS c FROM (SELECT n, edited, unnest(range(256)) AS bucket FROM spelt) b LEFT JOIN counts USING (n, edited, bucket)
), quarters AS (
  SELECT n, edited, list(c ORDER BY bucket) AS c, list(c ORDER BY c) AS s FROM full_ GROUP BY 1, 2
), coded AS (
  SELECT n, edited, list_transform(c, lambda x: CAST(x > s[64] AS INT) + CAST(x > s[128] AS INT) + CAST(x > s[192] AS INT)) AS codes FROM quarters
), prints AS MATERIALIZED (
  SELECT n, edited, codes, len, list_transform(range(4), lambda k: len(list_filter(codes, lambda x: x = k))) AS h,
    lower(format('{{:02x}}', len)) || array_to_string(list_transform(range(128), lambda i: '0123456789abcdef'[CAST(codes[2 * i + 1] * 4 + codes[2 * i + 2] + 1 AS BIGINT)]), '') AS print
  FROM coded JOIN (SELECT n, edited, CASE WHEN bytes = 0 THEN 0 ELSE 1 + 4 * {_DOUBLINGS} + (((bytes << 2) >> {_DOUBLINGS}) & 3) END AS len FROM spelt) USING (n, edited)
)
SELECT p.doc_id, length(p.text) AS n_chars, sha256(p.other) AS edited_sha256, a.print AS fingerprint, e.print AS edited_fingerprint, {_like('a', 'e')} AS near_edited, {_like('a', 'b')} AS near_next
FROM pairs p JOIN prints a ON a.n = p.n AND NOT a.edited JOIN prints e ON e.n = p.n AND e.edited JOIN prints b ON b.n = p.m AND NOT b.edited
"""

ORACLE_SQL: dict[str, str] = {
    "op12_conversation_repair": REPAIR,
    "op13_document_fingerprints": QUARTILES,
    "op3_chat_formatting": CHAT,
    "op5_benchmark_decontamination": WINDOWS,
    "op6_embedding_near_dedup": COSINE,
}
