"""DuckDB SQL for the operators that SQL can express."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

_NUMBER = "cast('0x' || substr(sha256({0}), 1, 8) as bigint)"
ORACLE_SQL["op4_mixing"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, cast(sum(size) AS bigint) AS source_size FROM d GROUP BY source),
p AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
rounds(i, words, unit) AS (
  SELECT 0, cast(sum(source_size) AS bigint), cast(sum(w) AS bigint) FROM p
  UNION ALL
  SELECT i + 1, words2, unit2 FROM (
    SELECT r.i, r.words, r.unit,
      (SELECT cast(sum(source_size) - 3 * coalesce(sum(source_size) FILTER (WHERE w * r.words / r.unit > 3 * source_size), 0) AS bigint) FROM p) AS words2,
      (SELECT cast(sum(w) FILTER (WHERE w * r.words / r.unit <= 3 * source_size) AS bigint) FROM p) AS unit2
    FROM rounds r) WHERE unit2 > 0 AND (words2 <> words OR unit2 <> unit) AND i < 1000),
last AS (SELECT words, unit FROM rounds ORDER BY i DESC LIMIT 1),
t AS (SELECT source, source_size, least(w * words / unit, cast(3 * source_size AS double)) AS target FROM p, last),
k AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::double END AS rate,
    {_NUMBER.format("'11:' || coalesce('s' || d.source, 'n')")} / 4294967296.0::double AS u,
    row_number() OVER (PARTITION BY d.source ORDER BY length(bin(size)), {_NUMBER.format("cast(doc_id as varchar)")} % 64, size, doc_id) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, cast(floor(rate) + floor(k * (rate - floor(rate)) + u) - floor((k - 1) * (rate - floor(rate)) + u) AS bigint) AS n_copies FROM k)
SELECT doc_id, cast(size AS bigint) AS size, source_size, target, cast(size * n_copies AS bigint) AS taken, n_copies FROM c
"""

ORACLE_SQL["op10_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
win AS (SELECT doc_id, p, sha256(array_to_string(w[p:p + 49], ' ')) AS t
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS p FROM d)),
start AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY t) AS least FROM win) WHERE least < doc_id),
mark AS (SELECT word.*, max(start.p) OVER (PARTITION BY word.doc_id ORDER BY word.p) AS last
  FROM word LEFT JOIN start ON word.doc_id = start.doc_id AND word.p = start.p),
kept AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE last >= p - 49) AS n_removed,
    string_agg(word, ' ' ORDER BY p) FILTER (WHERE last IS NULL OR last < p - 49) AS t
  FROM mark GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, byte by byte and bit by bit (the reversed polynomial EDB88320)."""
    step = ("list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, "
            "xor(c, k))")
    codes = f"list_transform(string_split({text}, ''), lambda x: cast(ascii(x) AS bigint))"
    return f"xor(4294967295::bigint, list_reduce({codes}, lambda c, k: {step}, 4294967295::bigint))"


def _least_audits() -> str:
    """The four states' least (cost, audit) before a row, as text that sorts: eight digits of cost, then the audit."""
    def more(state: str, cost: int, letters: str, also: str = "0") -> str:
        return f"lpad(cast(cast(substr({state}, 1, 8) AS bigint) + {cost} + {also} AS varchar), 8, '0') || '{letters}' || substr({state}, 9)"

    out = []
    for m in range(4):
        rerole = 3 if m == 2 else 2
        kept = {0: "CASE i WHEN 's' THEN b1 WHEN 'u' THEN b2 END", 2: "CASE i WHEN 'a' THEN b3 END"}.get(m, "CASE i WHEN 'u' THEN b2 END")
        stay = [f"CASE WHEN NOT d THEN {more(f'({kept})', 0, 'K', 'x')} END", f"CASE WHEN NOT d THEN {more(f'b{rerole}', 3, 'R', 'x')} END"]
        out.append(f"least({more(f'b{m}', 4, 'D')}, {', '.join(stay)}) AS m{m}")
    ways = [("m0", more("m2", 3, "I"), more("m3", 6, "II")), ("m1", more("m2", 3, "I"), more("m3", 6, "II")),
            ("m2", more("m3", 3, "I")), ("m3", more("m2", 3, "I"))]
    last = ", ".join(f"least({', '.join(w)}) AS a{p}" for p, w in enumerate(ways))
    return f"SELECT g, n, {last} FROM (SELECT g, n, {', '.join(out)} FROM step)"


_SPACES = r"\x20\x09-\x0D"
ORACLE_SQL["op11_conversation_repair"] = rf"""
WITH RECURSIVE hurt AS (
  SELECT conv_id, turn, CASE WHEN act = 4 THEN 'user' ELSE role END AS role,
    CASE act WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, unnest(CASE WHEN act = 3 THEN [3, 3] ELSE [act] END) AS act
    FROM (SELECT *, {_crc32("coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' ')")} % 20 AS act FROM conversations)
    WHERE act <> 0)),
o AS (SELECT coalesce('=' || conv_id, '') AS g, turn, role, text, substr(role, 1, 1) AS i,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n FROM hurt),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_SPACES}]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][{_SPACES}]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(i) OVER (PARTITION BY g ORDER BY n) || i AS pair FROM o),
c AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS size FROM f GROUP BY g),
least_of(g, n, a0, a1, a2, a3) AS (
  SELECT g, size + 1, '00000000', '00000006II', '00000003I', '00000000' FROM c
  UNION ALL
  SELECT * FROM (WITH step AS (SELECT b.g, f.n, b.a0 AS b0, b.a1 AS b1, b.a2 AS b2, b.a3 AS b3, f.i,
      fault IN ('blank', 'duplicate') AS d, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS x
    FROM least_of b JOIN f ON f.g = b.g AND f.n = b.n - 1)
  {_least_audits()})),
best AS (SELECT g, cast(substr(a0, 1, 8) AS bigint) AS cost, substr(a0, 9) AS audit FROM least_of WHERE n = 1),
edits(g, k, n, last, piece) AS (
  SELECT g, 0::bigint, 0::bigint, '', NULL::varchar FROM best
  UNION ALL
  SELECT g, k + 1, CASE WHEN letter = 'I' THEN n ELSE n + 1 END, CASE WHEN letter = 'D' THEN last ELSE substr(new, 1, 1) END,
    CASE WHEN letter <> 'D' THEN new || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END END
  FROM (SELECT e.g, e.k, e.n, e.last, substr(audit, e.k + 1, 1) AS letter, f.text,
      CASE WHEN substr(audit, e.k + 1, 1) = 'K' THEN f.role WHEN e.last = 'u' THEN 'assistant' ELSE 'user' END AS new
    FROM edits e JOIN best ON best.g = e.g LEFT JOIN f ON f.g = e.g AND f.n = e.n + 1 WHERE e.k < length(audit))),
said AS (SELECT g, string_agg(piece, chr(10) ORDER BY k) AS t FROM edits GROUP BY g)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS g FROM conversations) ids
LEFT JOIN c ON c.g = ids.g LEFT JOIN best ON best.g = ids.g LEFT JOIN said ON said.g = ids.g
"""


def _leaf(text: str) -> str:
    value = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(cast({0} AS varchar))) || ':' || {0} END"
    return f"sha256({' || '.join(value.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


ORACLE_SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, {_leaf('text')} AS leaf, {_leaf('changed')} AS changed FROM (
    SELECT *, CASE WHEN {_crc32("coalesce(cast(doc_id AS varchar), ' ')")} % 2 = 0 AND doc_id IS NOT NULL
      THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents)),
p AS (SELECT *, coalesce('=' || source, '') AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
tree(g, lvl, pos, h, size) AS (
  SELECT g, 0, pos, leaf, count(*) OVER (PARTITION BY g) FROM p
  UNION ALL
  SELECT g, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value(size + 2) // 3 FROM tree WHERE size > 1 GROUP BY g, lvl, pos // 3),
sub AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos FROM tree WHERE size = 1),
top(lvl, pos, h, size) AS (
  SELECT 0, pos, subroot, count(*) OVER () FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value(size + 2) // 3 FROM top WHERE size > 1 GROUP BY lvl, pos // 3),
nodes AS (SELECT g, lvl, pos, h FROM tree WHERE size > 1 UNION ALL SELECT '^', lvl, pos, h FROM top WHERE size > 1),
steps AS (SELECT a.g, a.lvl, a.pos, a.g AS g2, a.lvl + 1 AS lvl2, a.pos // 3 AS pos2, true AS up,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.g = b.g AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 GROUP BY a.g, a.lvl, a.pos
  UNION ALL SELECT tree.g, lvl, 0, '^', 0, sub.pos, false, '', '' FROM tree JOIN sub ON sub.g = tree.g WHERE size = 1),
way(doc_id, leaf, source_key, g, lvl, pos, proof, folded) AS (
  SELECT doc_id, leaf, g, g, 0, pos, '', changed FROM p
  UNION ALL
  SELECT doc_id, leaf, source_key, g2, lvl2, pos2, proof || l || r, CASE WHEN up THEN sha256(l || folded || r) ELSE folded END
  FROM way JOIN steps ON steps.g = way.g AND steps.lvl = way.lvl AND steps.pos = way.pos),
ends AS (SELECT doc_id, leaf, source_key AS g, proof, folded FROM way WHERE g = '^' AND lvl = (SELECT max(lvl) FROM top))
SELECT doc_id, CASE WHEN ends.g <> '' THEN substr(ends.g, 2) END AS source, leaf, subroot, root, sha256(proof) AS proof_sha256,
  folded AS folded_root, folded = root AS verified
FROM ends JOIN sub ON sub.g = ends.g, (SELECT h AS root FROM top WHERE size = 1)
"""
