"""SQL forms of the operators that have one."""

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT vec_id, e FROM v WHERE vec_id IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_aggregate(list_transform(e, lambda x: abs(x)), 'max') > 0
), link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT l.v, r.root FROM reach r JOIN link l ON l.u = r.vec_id
)
SELECT v.vec_id, (SELECT count(*) FROM link l WHERE l.u = v.vec_id) AS n_links, r.root AS component_id, r.root = v.vec_id AS kept
FROM v JOIN (SELECT vec_id, min(root) AS root FROM reach GROUP BY 1) r USING (vec_id)
"""

OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d
), g AS (
  SELECT r, p, array_to_string(w[p:p+4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS p FROM w)
), twice AS (
  SELECT r, p FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), rep AS (
  SELECT r, count(DISTINCT p + k) AS n FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY r
), l AS (
  SELECT r, host, doc_id, t, l, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS norm,
    len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words
  FROM (SELECT r, host, doc_id, t, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), texts AS (
  SELECT host, count(DISTINCT t) AS n_host FROM d GROUP BY host
), often AS (
  SELECT host, norm, count(DISTINCT t) AS n, min(doc_id) AS first_doc FROM l GROUP BY host, norm
), limits AS (
  SELECT o.* FROM often o JOIN texts USING (host) WHERE n > 10 AND n > 0.01 * n_host
), taken AS (
  SELECT r, sum(words) AS removed FROM l JOIN limits f ON l.host = f.host AND l.norm = f.norm
  WHERE l.doc_id IS DISTINCT FROM f.first_doc GROUP BY r
), base AS (
  SELECT d.doc_id, d.r, len(w.w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce((SELECT count(*) - count(DISTINCT l) FROM l WHERE l.r = d.r), 0) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, coalesce(taken.removed, 0) AS removed
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN taken USING (r)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, CAST(removed AS BIGINT) AS n_removed_words,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (n_words - removed < 10 OR n_words - removed < 0.3 * n_words) AS kept
FROM base
"""

OP10 = """
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT r, p, md5(substr(h, 2 * p + 1, 200)) AS s FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM d)
), late AS (
  SELECT r, p FROM s QUALIFY row_number() OVER (PARTITION BY s ORDER BY r, p) > 1
), marked AS (
  SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM late
), spans AS (
  SELECT r, min(p) AS a, max(p) + 100 AS b
  FROM (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS i FROM marked) GROUP BY r, i
), pieces AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans
), cut AS (
  SELECT r, sum(b - a) AS gone, count(*) AS n, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM pieces JOIN d USING (r) GROUP BY r
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters: each byte is taken in, then eight bits are shifted out."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda b: [ascii(b), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = "CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    return f"xor(list_reduce(list_prepend(4294967295, list_transform({steps}, lambda x: CAST(x AS BIGINT))), lambda c, x: {crc}), 4294967295)"


def _leaf(text: str) -> str:
    def field(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END"

    return "sha256(" + " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP13 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, lang IS NOT NULL AS known, coalesce(lang, '') AS g, {_leaf("text")} AS leaf,
    CASE WHEN text IS NOT NULL AND {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
      THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS forged
  FROM documents
), p AS (
  SELECT *, row_number() OVER (PARTITION BY known, g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY known, g) AS n FROM d
), nodes AS (
  SELECT 0 AS lvl, known, g, i, n, leaf AS h FROM p
  UNION ALL
  SELECT lvl + 1, known, g, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY lvl, known, g, i // 8, n
), sub AS (
  SELECT known, g, h, row_number() OVER (ORDER BY known, g) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS lvl, i, n, h FROM sub
  UNION ALL
  SELECT lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lvl, i // 8, n
), runs AS (
  SELECT lvl, known, g, i // 8 AS b, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
), top_runs AS (
  SELECT lvl, i // 8 AS b, list(h ORDER BY i) AS hs FROM top WHERE n > 1 GROUP BY ALL
), up AS (
  SELECT r, known, g, 0 AS lvl, i, coalesce(forged, leaf) AS node, '' AS proof FROM p
  UNION ALL
  SELECT r, u.known, u.g, u.lvl + 1, i // 8,
    sha256(array_to_string(hs[1 : i % 8], '') || node || array_to_string(hs[i % 8 + 2 :], '')),
    proof || array_to_string(hs[1 : i % 8], '') || array_to_string(hs[i % 8 + 2 :], '')
  FROM up u JOIN runs s ON s.lvl = u.lvl AND s.known = u.known AND s.g = u.g AND s.b = u.i // 8
), on_top AS (
  SELECT r, 0 AS lvl, s.i, node, proof FROM up JOIN sub s USING (known, g) QUALIFY row_number() OVER (PARTITION BY r ORDER BY lvl DESC) = 1
), over AS (
  SELECT * FROM on_top
  UNION ALL
  SELECT r, o.lvl + 1, i // 8,
    sha256(array_to_string(hs[1 : i % 8], '') || node || array_to_string(hs[i % 8 + 2 :], '')),
    proof || array_to_string(hs[1 : i % 8], '') || array_to_string(hs[i % 8 + 2 :], '')
  FROM over o JOIN top_runs s ON s.lvl = o.lvl AND s.b = o.i // 8
), done AS (
  SELECT r, node, proof FROM over QUALIFY row_number() OVER (PARTITION BY r ORDER BY lvl DESC) = 1
)
SELECT doc_id, leaf, sub.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = t.h AS verified,
  lang, CAST(p.i AS BIGINT) AS leaf_index
FROM p JOIN done USING (r) JOIN sub USING (known, g), (SELECT h FROM top WHERE n = 1) t
"""


def _time(rate: float, slope: float, done: float, start: float) -> str:
    rest = f"(u - {done})"
    return f"{rest} * 2.0 / (sqrt({rest} * {2 * slope} + {rate * rate}) + {rate}) + {start}"


OP12 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, source IS NULL AS unknown, coalesce(source, '') AS s,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS mark
  FROM documents
), s AS (
  SELECT unknown, s, CAST(sum(size) AS BIGINT) AS words, (row_number() OVER (ORDER BY unknown, s) - 1) % 3 AS k FROM d GROUP BY unknown, s
), w AS (
  SELECT *, CAST(CASE k WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w FROM s
), t AS (
  SELECT sum(words) AS total, sum(w) AS weight FROM w
), fill(rest, shared) AS (
  SELECT CAST(total AS DOUBLE), weight FROM t
  UNION
  SELECT CAST(max(total) - sum(CASE WHEN w * rest / shared > 3 * words THEN 3 * words ELSE 0 END) AS DOUBLE),
    sum(CASE WHEN w * rest / shared > 3 * words THEN 0 ELSE w END)
  FROM fill, w, t GROUP BY rest, shared
), level AS (
  SELECT rest, shared FROM fill ORDER BY rest / shared DESC LIMIT 1
), g AS (
  SELECT unknown, s, k, words, CASE WHEN w * rest / shared > 3 * words THEN CAST(3 * words AS DOUBLE) ELSE w * rest / shared END AS target FROM w, level
), o AS (
  SELECT d.*, k, words, target, CAST(floor(target + 0.5) AS BIGINT) AS budget,
    coalesce(sum(size) OVER (PARTITION BY d.unknown, d.s ORDER BY mark ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN g ON g.unknown = d.unknown AND g.s = d.s
), p AS (
  SELECT *, list_filter(list_transform([0, 1, 2], lambda e: least(size, budget - (e * words + before))), lambda x: x > 0) AS plays,
    CASE WHEN target > 0 THEN before / target END AS u
  FROM o
)
SELECT doc_id, CAST(size AS BIGINT) AS size, words AS source_size, target, CAST(coalesce(list_sum(plays), 0) AS BIGINT) AS taken, source,
  CAST(len(plays) AS INTEGER) AS n_plays,
  CASE WHEN len(plays) > 0 THEN least(1.0, CASE k
    WHEN 0 THEN CASE WHEN u < 0.375 THEN {_time(0.5, 1.0, 0.0, 0.0)} ELSE {_time(1.0, 1.0, 0.375, 0.5)} END
    WHEN 1 THEN CASE WHEN u < 0.5 THEN {_time(1.0, 0.0, 0.0, 0.0)} ELSE {_time(1.0, 0.0, 0.5, 0.5)} END
    ELSE CASE WHEN u < 0.625 THEN {_time(1.5, -1.0, 0.0, 0.0)} ELSE {_time(1.0, -1.0, 0.625, 0.5)} END END) END AS first_at
FROM p
"""


_BLANK = r"[\x20\x09-\x0D]"


def _edit(cost: str, letter: str, line: str, then: str) -> str:
    """Least way on after one edit: its cost, its letter and its line come before those of ``then``."""
    return f"{{'cost': {cost} + {then}.cost, 'audit': '{letter}' || {then}.audit, 'rest': {line} || {then}.rest}}"


def _turn(state: str, follows: str, keeps: str) -> str:
    role = {"a": "'assistant'", "u": "'user'"}[follows]
    extra = "CASE WHEN cut THEN 3 ELSE 0 END"
    keep = "CASE " + " ".join(
        f"WHEN left(role, 1) = '{k}' AND NOT gone THEN {_edit(extra, 'K', 'role || chr(58) || text || chr(10)', 'b.' + k)}" for k in keeps
    ) + " END"
    reroled = f"CASE WHEN NOT gone THEN {_edit('3 + ' + extra, 'R', role + ' || chr(58) || text || chr(10)', 'b.' + follows)} END"
    return f"list_min([{_edit('4', 'D', repr(''), 'b.' + state)}, {keep}, {reroled}])"


def _put(follows: str, then: str) -> str:
    role = {"a": "'assistant:'", "u": "'user:'"}[follows]
    return _edit("3", "I", f"{role} || chr(10)", then)


OP11 = rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key,
    coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations
), k AS (
  SELECT *, {_crc32("key")} % 20 AS kind FROM c
), dam AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM k, (SELECT unnest([0, 1]) AS time) WHERE kind <> 0 AND (time = 0 OR kind = 3)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    NOT regexp_matches(text, '{_BLANK.replace("[", "[^")}') AS blank,
    NOT regexp_matches(text, '[.!?]{_BLANK}*\z') AS cut
  FROM dam
), f AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS twice,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
  FROM o
), t AS (
  SELECT conv_id, i, n, role, text, blank OR twice AS gone, cut AND NOT blank AND NOT twice AS cut FROM f
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE twice) AS duplicate, count(*) FILTER (WHERE cut AND NOT blank AND NOT twice) AS truncated,
    count(*) FILTER (WHERE i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n
  FROM f GROUP BY conv_id
), walk AS (
  SELECT conv_id, n AS i, {{'o': {{'cost': 0, 'audit': '', 'rest': ''}}, 's': {{'cost': 6, 'audit': 'II', 'rest': 'user:' || chr(10) || 'assistant:' || chr(10)}},
    'u': {{'cost': 3, 'audit': 'I', 'rest': 'assistant:' || chr(10)}}, 'a': {{'cost': 0, 'audit': '', 'rest': ''}}}} AS b
  FROM facts
  UNION ALL
  SELECT conv_id, i, {{'o': list_min([p.o, {_put("u", "p.u")}, {_put("u", _put("a", "p.a"))}]),
    's': list_min([p.s, {_put("u", "p.u")}, {_put("u", _put("a", "p.a"))}]), 'u': list_min([p.u, {_put("a", "p.a")}]), 'a': list_min([p.a, {_put("u", "p.u")}])}}
  FROM (
    SELECT w.conv_id, w.i - 1 AS i, {{'o': {_turn("o", "u", "su")}, 's': {_turn("s", "u", "u")}, 'u': {_turn("u", "a", "a")}, 'a': {_turn("a", "u", "u")}}} AS p
    FROM walk w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i
  )
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b.o.cost, 0) AS BIGINT) AS cost,
  coalesce(b.o.audit, '') AS audit, sha256(coalesce(left(b.o.rest, length(b.o.rest) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN walk ON walk.conv_id IS NOT DISTINCT FROM a.conv_id AND walk.i = 0
"""
