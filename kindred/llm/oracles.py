"""SQL twins of the queries that SQL can state."""

from __future__ import annotations

from kindred.llm.host_reputation import DEVIATIONS, LEAST_SPREAD, LIMIT, MOST_SPREAD, TWO_LABEL_SUFFIXES
from kindred.llm.mixing import MOST, SEED

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
A_Z = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(A_Z)} AS w FROM documents),
s AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM s JOIN reach USING (doc_id) GROUP BY s.doc_id, len(s.s)
"""

OP2 = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, count(*) AS n,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM d GROUP BY source),
lv AS (
  SELECT *, CAST(sum(s) OVER () - coalesce(sum({MOST} * s) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / CAST(sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM src WINDOW r AS (ORDER BY {MOST} * s / weight, source NULLS LAST)),
held AS (SELECT *, level * weight >= {MOST} * s AS held FROM lv),
plan AS (
  SELECT *, CASE WHEN held THEN CAST({MOST} * s AS DOUBLE)
    ELSE (SELECT arg_min(level, {MOST} * s / weight) FROM held WHERE NOT held) * weight END AS target FROM held),
parts AS (
  SELECT *, floor(CASE WHEN s > 0 THEN target / s ELSE 0 END + 1e-12) AS whole FROM plan),
drawn AS (
  SELECT d.*, p.s, p.target, p.whole, greatest(p.target - p.whole * p.s, 0) AS remaining,
    greatest(CASE WHEN p.s > 0 THEN p.target / p.s ELSE 0 END - p.whole, 0) AS fraction, p.s / p.n AS mean,
    (CAST(('0x' || substr(md5(d.doc_id || ':{SEED}'), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source),
ranked AS (
  SELECT *, CASE WHEN fraction > 0 THEN
    (u / (1 - u)) / (fraction / (1 - fraction) * CASE WHEN size > 0 THEN sqrt(mean / size) ELSE 1 END) END AS q FROM drawn),
summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM ranked)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target,
  CAST(size * (whole + CASE WHEN fraction > 0 AND (upto < remaining
    OR (upto >= remaining AND upto - size < remaining AND upto - remaining <= remaining - (upto - size))) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""

OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (
  SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    1 + ((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31)]), '') AS payload_digest,
  CASE WHEN f IS NULL OR f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f <> page_id OR page_id IS NULL THEN f END AS refers_to
FROM d
"""

_TWO = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)


def _strength(units: str, parent: str, on: str) -> str:
    return f"""
  SELECT (1 - rho) / rho AS m FROM (
    SELECT least(greatest(coalesce(CASE WHEN below > 0 THEN (spread - p * (1 - p) * (k - 1)) / below END, {LEAST_SPREAD}), {LEAST_SPREAD}), {MOST_SPREAD}) AS rho
    FROM (SELECT *, p * (1 - p) * (total - squares / total - (k - 1)) AS below FROM (
      SELECT count(*) AS k, sum(u.n) AS total, sum(u.n * u.n) AS squares, sum(u.bad) / sum(u.n) AS p,
        sum(u.n * pow(u.bad / u.n - p.bad / greatest(p.n, 1), 2)) AS spread
      FROM {units} u JOIN {parent} p ON {on} WHERE u.n > 0)))"""


OP8 = rf"""
WITH x AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
sp AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM x),
known AS (
  SELECT doc_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
hosts0 AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM sp LEFT JOIN known ON page_id = doc_id GROUP BY host),
hosts1 AS (
  SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS parts FROM hosts0),
hosts2 AS (
  SELECT *, CASE WHEN array_to_string(parts[-2:], '.') IN ({_TWO}) THEN array_to_string(parts[-2:], '.') ELSE parts[-1] END AS suffix FROM hosts1),
hosts AS (
  SELECT host, n, bad, suffix, CASE WHEN len(parts) <= len(string_split(suffix, '.')) + 1 THEN array_to_string(parts, '.')
    ELSE array_to_string(parts[-(len(string_split(suffix, '.')) + 1):], '.') END AS domain FROM hosts2),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
root AS (SELECT sum(n) AS n, sum(bad) AS bad FROM suffixes),
ms AS ({_strength("suffixes", "root", "true")}),
md AS ({_strength("domains", "suffixes", "u.suffix = p.suffix")}),
mh AS ({_strength("hosts", "domains", "u.domain = p.domain")}),
ps AS (SELECT suffix, (s.bad + m * ((r.bad + 0.5) / (r.n + 1))) / (s.n + m) AS rate FROM suffixes s, root r, ms),
pd AS (SELECT domain, suffix, (d.bad + m * rate) / (d.n + m) AS rate FROM domains d JOIN ps USING (suffix), md),
ph AS (SELECT host, (h.bad + m * rate) / (h.n + m) AS rate, h.n + m AS weight FROM hosts h JOIN pd USING (domain, suffix), mh),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
told AS (
  SELECT page_id, sp.host, path, rate - {DEVIATIONS} * sqrt(rate * (1 - rate) / (weight + 1)) AS bound,
    (SELECT arg_max({{'rule': h || p, 'verdict': verdict}}, length(h || p)) FROM rules
     WHERE (sp.host = h OR ends_with(sp.host, '.' || h)) AND starts_with(path, p)) AS r
  FROM sp JOIN ph ON sp.host = ph.host)
SELECT page_id, host, path, r.rule AS rule,
  coalesce(r.verdict, CASE WHEN bound > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict FROM told
"""

OP9 = r"""
WITH d AS (
  SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
    len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+')) AS pieces FROM documents WHERE doc_id IS NOT NULL)
SELECT source, lang, 'words-1' AS version, count(*) AS docs, CAST(sum(words - 1) AS BIGINT) AS tokens FROM d WHERE words >= 20 GROUP BY source, lang
UNION ALL
SELECT source, lang, 'pieces-1', count(*), CAST(sum(pieces) AS BIGINT) FROM d GROUP BY source, lang
"""

OP10 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT doc_id, list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) AS s FROM d WHERE len(w) >= 5),
its AS (SELECT item_id, list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) AS s FROM i WHERE len(w) >= 5),
ic AS (SELECT item_id, x, count(*) AS c FROM (SELECT item_id, unnest(s) AS x FROM its) GROUP BY ALL),
met AS (SELECT DISTINCT doc_id, item_id FROM (SELECT doc_id, unnest(s) AS x FROM ds) JOIN ic USING (x)),
win AS (
  SELECT doc_id, item_id, len(its.s) AS ni, ds.s AS s, its.s AS item, unnest(range(0, greatest(len(ds.s) - len(its.s), 0) + 1)) AS start
  FROM met JOIN ds USING (doc_id) JOIN its USING (item_id)),
ws AS (SELECT doc_id, item_id, ni, start, s[start + 1:start + ni] AS v FROM win),
wc AS (SELECT doc_id, item_id, ni, start, len(v) AS nv, x, count(*) AS c FROM (SELECT *, unnest(v) AS x FROM ws) GROUP BY ALL),
com AS (SELECT doc_id, item_id, start, ni, nv, sum(least(wc.c, ic.c)) AS common FROM wc JOIN ic USING (item_id, x) GROUP BY ALL)
SELECT doc_id, item_id, round(max(common / (ni + nv - common)), 6) AS similarity FROM com
WHERE 175 * common >= 75 * (ni + nv) GROUP BY doc_id, item_id
"""


# Vectors as integers, in one row a component; a round assigns and moves.
_OP11_ASSIGN = """
{name}_d AS MATERIALIZED (
  SELECT vec_id, cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance
  FROM v JOIN {before} c USING (k) GROUP BY ALL),
{name}_a AS MATERIALIZED (
  SELECT vec_id, cluster, distance FROM {name}_d
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)"""
_OP11_MOVE = """,
{name}_s AS (SELECT cluster, k, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM {name}_a JOIN v USING (vec_id) GROUP BY ALL),
{name} AS MATERIALIZED (
  SELECT cluster, k, CAST(CASE WHEN n IS NULL THEN x ELSE (s - (((s % n) + n) % n)) // n END AS BIGINT) AS x
  FROM {before} LEFT JOIN {name}_s USING (cluster, k))"""
OP11 = (
    r"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda y: CAST(floor(256 * CAST(y AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y) AND abs(y) < 524288)) = 64),
v AS MATERIALIZED (SELECT vec_id, k, e[k] AS x FROM kept, (SELECT unnest(range(1, 65)) AS k)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster FROM kept QUALIFY cluster < 40),
c0 AS MATERIALIZED (SELECT cluster, k, x FROM f JOIN v USING (vec_id)),"""
    + ",".join((_OP11_ASSIGN + _OP11_MOVE).format(name=f"c{i}", before=f"c{i - 1}") for i in range(1, 6))
    + ","
    + _OP11_ASSIGN.format(name="c6", before="c5")
    + r""",
g AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM c6_a GROUP BY cluster),
h AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY k)) AS centroid_sha256 FROM c5 GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, cluster_inertia,
  (SELECT CAST(sum(distance) AS BIGINT) FROM c6_a) AS inertia, centroid_sha256
FROM c6_a JOIN g USING (cluster) JOIN h USING (cluster)
"""
)


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _way(state: str, cost: str, letter: str, turn: str | None = None) -> str:
    text = f"{state}.t" if turn is None else f"{state}.t || chr(10) || {turn}"
    return f"{{'c': {state}.c + {cost}, 'x': {state}.x || '{letter}', 't': {text}}}"


def _kept(state: str, initial: str) -> str:
    return _way(state, f"CASE WHEN r.i = '{initial}' THEN r.k ELSE 1000000000 END", "K", "r.role || ':' || r.text")


def _rerole(state: str, role: str) -> str:
    return _way(state, "r.k + 1", "R", f"'{role}:' || r.text")


# A step of the fold: each state (e nothing, s system, u user, a assistant) holds its least (cost, audit, text).
_OP13_ROW = (
    "{'e': " + _way("z.e", "2", "D")
    + ", 's': " + _least(_way("z.s", "2", "D"), _kept("z.e", "s"))
    + ", 'u': " + _least(_way("z.u", "2", "D"), *(f(f"z.{q}", v) for q in "esa" for f, v in ((_kept, "u"), (_rerole, "user"))))
    + ", 'a': " + _least(_way("z.a", "2", "D"), _kept("z.u", "a"), _rerole("z.u", "assistant")) + "}"
)
_OP13_USER = "{'e': z.e, 's': z.s, 'u': " + _least("z.u", *(_way(f"z.{q}", "5", "I", "'user:'") for q in "esa")) + ", 'a': z.a}"
_OP13_BOTH = "{'e': z.e, 's': z.s, 'u': z.u, 'a': " + _least("z.a", _way("z.u", "5", "I", "'assistant:'")) + "}"
_NONE = "{'c': CAST(4000000000 AS BIGINT), 'x': '', 't': ''}"
OP13 = (
    r"""
WITH raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
crc AS (
  SELECT *, xor(list_reduce(list_transform(string_split(key, ''), lambda y: CAST(ascii(y) AS BIGINT)),
      lambda c, b: list_reduce(range(0, 8), lambda v, n: xor(v >> 1, (v & 1) * 3988292384), xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS f
  FROM raw),
dmg AS (
  SELECT conv_id, turn, role AS role0, sha256(text) AS text0, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM crc WHERE f <> 0),
pos AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role0, text0, copy) AS n, left(role, 1) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid FROM dmg),
flt AS (
  SELECT *, CASE WHEN solid = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd'
    WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(i) OVER (PARTITION BY conv_id ORDER BY n) || i AS pair FROM pos),
conv AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    list({'i': i, 'role': role, 'text': text, 'k': CAST(CASE fault WHEN 't' THEN 5 WHEN '' THEN 0 ELSE 1000000000 END AS BIGINT)} ORDER BY n) AS rs
  FROM flt GROUP BY conv_id),
folded AS (
  SELECT *, list_reduce(rs, lambda z0, r: list_transform([list_transform([list_transform([z0], lambda z: """
    + _OP13_ROW + ")[1]], lambda z: " + _OP13_USER + ")[1]], lambda z: " + _OP13_BOTH + ")[1], {'e': {'c': CAST(0 AS BIGINT), 'x': '', 't': ''}, 's': " + _NONE
    + ", 'u': {'c': CAST(5 AS BIGINT), 'x': 'I', 't': chr(10) || 'user:'}, 'a': {'c': CAST(10 AS BIGINT), 'x': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}}) AS z FROM conv),"
    + r"""
best AS (SELECT *, list_sort([z.e, z.a])[1] AS w FROM folded)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(w.c, 0) AS cost, coalesce(w.x, '') AS audit, sha256(coalesce(substr(w.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
"""
)


def all_sql() -> dict[str, str]:
    return {
        "op1_jaccard_join": OP1,
        "op2_source_mix": OP2,
        "op4_warc_store": OP4,
        "op8_host_reputation": OP8,
        "op9_token_rollups": OP9,
        "op10_decontaminate": OP10,
        "op11_centroid_clusters": OP11,
        "op13_turn_repair": OP13,
    }
