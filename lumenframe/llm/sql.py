"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

from lumenframe.llm.infill import SENTINELS
from lumenframe.llm.secrets import ACCESS, ALLOW, ASSIGN, ASSIGN_LEAST, CLASSES, HEX, KINDS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"


_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_lowered("text")}, {_WORDS}) AS w FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_lowered("text")}, {_WORDS}) AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p : p + size - 1], ' ') AS said
  FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p
        FROM i WHERE len(w) > 0)
), places AS (
  SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS said
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
        FROM d CROSS JOIN (SELECT DISTINCT size FROM windows))
), hits AS (
  SELECT doc_id, item_id, p, size FROM places JOIN windows USING (size, said)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS place FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(pattern: str, group: int) -> str:
    """Structs of start, end and value of each match, from the pieces between them."""
    p = _quoted(pattern)
    return f"""list_transform(range(1, len(regexp_extract_all(t, {p})) + 1), lambda k: {{
      'start': list_sum(list_transform(string_split_regex(t, {p})[1:k], lambda x: len(x)))
        + coalesce(list_sum(list_transform(regexp_extract_all(t, {p})[1:k - 1], lambda x: len(x))), 0),
      'size': len(regexp_extract_all(t, {p})[k]), 'value': regexp_extract_all(t, {p}, {group})[k]}})"""


def _spans(source: str, kind: str) -> str:
    rank = KINDS.index(kind)
    return f"list_transform({source}, lambda m: {{'start': m.start, 'rank': {rank}, 'end': m.start + m.size}})"


def _entropy(cls) -> str:
    runs = _matches(f"{cls.members}{{{cls.window},}}", 0)
    known = " OR ".join(f"regexp_matches(m.value, {_quoted('(?i)' + a)})" for a in ALLOW)
    parts = "string_split(r.value, '/')"
    tokens = f"""list_filter(list_transform(range(1, len({parts}) + 1), lambda k: {{
      'start': r.start + coalesce(list_sum(list_transform({parts}[1:k - 1], lambda x: len(x) + 1)), 0),
      'size': len({parts}[k]), 'value': {parts}[k]}}), lambda m: m.size >= {cls.window} AND NOT ({known}))"""
    runs = f"""flatten(list_transform({runs}, lambda r:
      CASE WHEN len(list_filter([r], lambda m: {known})) > 0 THEN {tokens} ELSE [r] END))"""
    hot = f"""list_filter(range(0, len(m.value) - {cls.window} + 1), lambda s:
      list_aggregate(string_split(m.value[s + 1 : s + {cls.window}], ''), 'entropy') >= {cls.bits})"""
    found = f"""list_transform({runs}, lambda m: {{'at': m.start, 'hot': {hot}}})"""
    return f"""list_transform(list_filter({found}, lambda p: len(p.hot) > 0), lambda p: {{
      'start': p.at + p.hot[1], 'rank': {KINDS.index(cls.kind)}, 'end': p.at + p.hot[-1] + {cls.window}}})"""


def _text(spans: str) -> str:
    kinds = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    said = f"list_transform({spans}, lambda s: {kinds}[s.rank + 1] || ':' || s.start || ':' || s.end)"
    return f"coalesce(array_to_string({said}, ','), '')"


_HEX, _ACCESS = HEX.split(")", 1)[1].removesuffix("+"), ACCESS
_MORE = ", ".join(f"{_entropy(c)} AS e{k}" for k, c in enumerate(CLASSES))
_FURTHER = """lambda s: len(list_filter(range(CAST(s.start AS BIGINT), CAST(s."end" AS BIGINT)), lambda k:
  len(list_filter(base, lambda b: b.start <= k AND k < b.end)) = 0)) > 0"""

SECRETS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
b AS (
  SELECT doc_id, t, list_sort(list_concat(
    {_spans(f"list_filter({_matches(ASSIGN, 2)}, lambda m: len(m.value) >= {ASSIGN_LEAST})", "assign")},
    {_spans(_matches(_ACCESS, 0), "access")},
    {_spans(_matches(_HEX, 0), "hex")})) AS base
  FROM d
), e AS (SELECT doc_id, base, {_MORE} FROM b),
a AS (
  SELECT doc_id, base,
    list_sort(list_concat(base, {", ".join(f"list_filter(e{k}, {_FURTHER})" for k in range(len(CLASSES)))})) AS every
  FROM e
)
SELECT doc_id,
  {", ".join(f"CAST(len(list_filter(base, lambda s: s.rank = {k})) AS BIGINT) AS n_{KINDS[k]}" for k in range(3))},
  sha256({_text("base")}) AS base_sha256, {_text("every")} AS spans
FROM a
"""


def _field(value: str) -> str:
    said = f"CAST({value} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({said})) AS VARCHAR) || ':' || {said}, '-')"


def _leaf(text: str) -> str:
    return "sha256(concat(" + ", ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + "))"


def _crc32(text: str) -> str:
    """The checksum bit by bit; DuckDB has no function for it."""
    step = "lambda c, k: xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"list_reduce(list_concat([xor(c, x)], [0, 0, 0, 0, 0, 0, 0, 0]), {step})"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, x: {byte}), 4294967295)"


_UP = "CAST((pos - pos % 3) / 3 AS BIGINT)"

MERKLE_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS pos,
         count(*) OVER (PARTITION BY source) AS total
  FROM (SELECT doc_id, source, {_leaf("text")} AS leaf,
               CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")}
                    ELSE {_leaf("text")} END AS now
        FROM documents)
), nodes AS (
  SELECT 0 AS level, source, pos, total, leaf AS node FROM leaves
  UNION ALL (
    SELECT level + 1, source, {_UP}, CAST(ceil(total / 3) AS BIGINT), sha256(string_agg(node, '' ORDER BY pos))
    FROM nodes WHERE total > 1 GROUP BY level, source, total, {_UP})
), tops AS (
  SELECT source, node AS subroot, CAST(row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS BIGINT) AS pos,
         count(*) OVER () AS total
  FROM nodes WHERE total = 1
), upper_nodes AS (
  SELECT 0 AS level, pos, total, subroot AS node FROM tops
  UNION ALL (
    SELECT level + 1, {_UP}, CAST(ceil(total / 3) AS BIGINT), sha256(string_agg(node, '' ORDER BY pos))
    FROM upper_nodes WHERE total > 1 GROUP BY level, total, {_UP})
), every AS MATERIALIZED (
  SELECT level, source, false AS upper, pos, total, node FROM nodes
  UNION ALL SELECT level, NULL, true, pos, total, node FROM upper_nodes
), beside AS MATERIALIZED (
  SELECT n.upper, n.source, n.level, n.pos,
         coalesce(string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos < n.pos), '') AS before,
         coalesce(string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos > n.pos), '') AS after
  FROM every n JOIN every s ON n.upper = s.upper AND n.level = s.level AND n.source IS NOT DISTINCT FROM s.source
    AND n.pos - n.pos % 3 = s.pos - s.pos % 3
  WHERE n.total > 1 GROUP BY n.upper, n.source, n.level, n.pos
), path AS (
  SELECT doc_id, leaf, source, false AS upper, 0 AS level, pos, now, '' AS proof, total FROM leaves
  UNION ALL (
    SELECT p.doc_id, p.leaf, p.source,
      p.upper OR p.total = 1, CASE WHEN p.total = 1 THEN 0 ELSE p.level + 1 END,
      CASE WHEN p.total = 1 THEN t.pos ELSE CAST((p.pos - p.pos % 3) / 3 AS BIGINT) END,
      CASE WHEN p.total = 1 THEN p.now ELSE sha256(b.before || p.now || b.after) END,
      CASE WHEN p.total = 1 THEN p.proof ELSE p.proof || b.before || b.after END,
      CASE WHEN p.total = 1 THEN t.total ELSE CAST(ceil(p.total / 3) AS BIGINT) END
    FROM path p LEFT JOIN tops t ON p.source IS NOT DISTINCT FROM t.source
    LEFT JOIN beside b ON b.upper = p.upper AND b.level = p.level AND b.pos = p.pos
      AND (p.upper OR b.source IS NOT DISTINCT FROM p.source)
    WHERE p.total > 1 OR NOT p.upper)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, now AS folded_root, now = root AS verified
FROM path p JOIN tops t ON p.source IS NOT DISTINCT FROM t.source
CROSS JOIN (SELECT node AS root FROM upper_nodes WHERE total = 1)
WHERE p.upper AND p.total = 1
"""

_P, _S, _M = SENTINELS
_HASH = "sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))"


def _hash_part(k: int) -> str:
    return f"CAST('0x' || substr({_HASH}, {8 * k + 1}, 8) AS BIGINT)"


INFILL_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
         {", ".join(f"{_hash_part(k)} AS h{k + 1}" for k in range(4))}
  FROM documents
), cut AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
         greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '{_P}') OR contains(t, '{_S}') OR contains(t, '{_M}') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid,
         array_to_string(u[b + 1:n], '') AS suf
  FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('{_P}', pre, '{_S}', suf, '{_M}', mid)
         ELSE concat('{_S}', suf, '{_P}', pre, '{_M}', mid) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
