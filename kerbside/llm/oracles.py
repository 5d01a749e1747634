"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from kerbside.llm.quality_rules import RULES, STOP_WORDS


def _quality() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words.split()}))
    languages = ", ".join(f"'{name}'" for name in STOP_WORDS)
    breaks = []
    for r in RULES:
        tests = []
        if r.low is not None:
            tests.append(f"100 * {r.part} < {r.low} * {r.whole}")
        if r.high is not None:
            tests.append(f"100 * {r.part} > {r.high} * {r.whole}")
        test = "(" + " OR ".join(tests) + ")" + (f" AND lang IN ({languages})" if r.languages else "")
        breaks.append(f"coalesce({test}, false) AS breaks_{r.name}")
    broken = " OR ".join(f"breaks_{r.name}" for r in RULES)
    return rf"""
WITH split AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
lined AS (
  SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM split),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
counts AS (
  SELECT l.doc_id, lang, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: x IN ({stop})))::BIGINT AS n_stop_words
  FROM lined l LEFT JOIN covered c ON l.doc_id = c.doc_id),
judged AS (
  SELECT * EXCLUDE (lang), (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, {", ".join(breaks)}
  FROM counts)
SELECT *, (NOT base_failed AND NOT ({broken})) AS kept FROM judged"""


_CONTAMINATION = r"""
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
docs AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM folded),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(13, len(words)) AS size, list_slice(words, i, i + 12) AS w
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, i, list_slice(words, i, i + size - 1) AS w
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, sizes)),
hits AS (SELECT d.doc_id, d.i, d.size, m.item FROM doc_windows d JOIN item_windows m ON d.size = m.size AND d.w = m.w),
spots AS (SELECT DISTINCT doc_id, i, size FROM hits),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM spots) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256,
  (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words)) AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""


# States of the pattern of roles: nothing yet, after the system turn, after a user turn, after a pair.
_WANTS = ("user", "user", "assistant", "user")
_AFTER = (2, 2, 3, 2)


def _repair() -> str:
    """The edits as a recursion over rows that keeps, for each state, the cheapest edits, of these the least in ASCII order."""
    inserts = []
    for q in range(4):
        at, lines = q, ""
        for k in range(4):
            inserts.append(f"({q}, {at}, {2 * k}, '{'I' * k}', '{lines}')")
            lines, at = f"{lines}{_WANTS[at]}:|", _AFTER[at]
    rerole = ", ".join(f"({q}, NULL, {_AFTER[q]}, 2, 'R', '{_WANTS[q]}')" for q in range(4))
    delete = ", ".join(f"({q}, NULL, {q}, 3, 'D', NULL)" for q in range(4))
    keep = "(0, 's', 1, 0, 'K', NULL), (0, 'u', 2, 0, 'K', NULL), (1, 'u', 2, 0, 'K', NULL), (3, 'u', 2, 0, 'K', NULL), (2, 'a', 3, 0, 'K', NULL)"
    return rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda x: ascii(x)::BIGINT)),
      lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda a, i: xor(a >> 1, (a & 1) * 3988292384))) AS crc
  FROM conversations),
kinds AS (SELECT * EXCLUDE crc, xor(crc, 4294967295) % 20 AS kind FROM named),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM kinds WHERE kind <> 0)),
ids AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (
  SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text)) AS n
  FROM damaged d JOIN ids i ON d.conv_id IS NOT DISTINCT FROM i.conv_id),
judged AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY n) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY n) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'fine' END AS fault
  FROM placed),
ins(q, q2, cost, audit, lines) AS (VALUES {", ".join(inserts)}),
edits(q, initial, q2, cost, edit, wants) AS (VALUES {keep}, {rerole}, {delete}),
best AS (
  SELECT c, 0::BIGINT AS n, 0 AS q, struct_pack(cost := 0::BIGINT, audit := '', lines := '') AS b FROM ids
  UNION ALL
  SELECT d.c, d.n + 1, e.q2, min(struct_pack(
    cost := d.b.cost + i.cost + e.cost + CASE WHEN e.edit <> 'D' AND r.fault = 'truncated' THEN 1 ELSE 0 END,
    audit := d.b.audit || i.audit || e.edit,
    lines := d.b.lines || replace(i.lines, '|', chr(10)) || CASE WHEN e.edit = 'D' THEN '' ELSE coalesce(e.wants, r.role) || ':' || r.text || chr(10) END))
  FROM best d JOIN ins i ON i.q = d.q JOIN edits e ON e.q = i.q2 JOIN judged r ON r.c = d.c AND r.n = d.n + 1
  WHERE (e.edit = 'D' OR r.fault IN ('fine', 'truncated')) AND (e.initial IS NULL OR e.initial = r.initial)
  GROUP BY d.c, d.n + 1, e.q2),
sums AS (
  SELECT i.c, i.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(r.c) AS n
  FROM ids i LEFT JOIN judged r ON r.c = i.c GROUP BY i.c, i.conv_id),
ends AS (
  SELECT s.c, min(struct_pack(cost := b.cost + i.cost, audit := b.audit || i.audit, lines := b.lines || replace(i.lines, '|', chr(10)))) AS b
  FROM sums s JOIN best d ON d.c = s.c AND d.n = s.n JOIN ins i ON i.q = d.q AND i.q2 IN (0, 3) GROUP BY s.c)
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, b.cost AS cost, b.audit AS audit,
  sha256(substr(b.lines, 1, greatest(length(b.lines) - 1, 0))) AS repaired_sha256
FROM sums JOIN ends USING (c)"""


def _clustering(k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, salt: str = "2:") -> str:
    """Rounds as a chain of common table expressions; floors of negative sums are taken by the remainder."""
    ctes = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
axes AS MATERIALIZED (SELECT r, vec_id, unnest(v) AS x, unnest(range({size})) AS d FROM kept),
c0 AS MATERIALIZED (
  SELECT i::INT AS i, unnest(v) AS x, unnest(range({size})) AS d
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('{salt}' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS i FROM kept) WHERE i < {k})"""]
    for n in range(rounds + 1):
        ctes.append(f"""a{n} AS MATERIALIZED (
  SELECT r, min(struct_pack(distance := distance, i := i)) AS best FROM (
    SELECT r, i, sum((a.x - c.x) * (a.x - c.x))::BIGINT AS distance FROM axes a JOIN c{n} c USING (d) GROUP BY r, i) GROUP BY r)""")
        if n < rounds:
            ctes.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT c.i, c.d, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (
    SELECT best.i AS i, d, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
    FROM a{n} JOIN axes USING (r) GROUP BY 1, 2) m ON m.i = c.i AND m.d = c.d)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, best.i AS cluster, best.distance AS distance, sum(best.distance) OVER (PARTITION BY best.i)::BIGINT AS cluster_inertia,
  sum(best.distance) OVER ()::BIGINT AS inertia, h.centroid_sha256
FROM a{rounds} JOIN kept USING (r)
JOIN (SELECT i, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY i) h ON h.i = best.i"""


ORACLES = {
    "op1_quality_rules": _quality(),
    "op2_decontamination": _CONTAMINATION,
    "op12_conversation_repair": _repair(),
    "op13_clustering": _clustering(),
}
