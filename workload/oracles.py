"""SQL twins of the registered queries, for DuckDB on the same tables.

They state the meaning, not the plan: overlap is counted by building the shared
phrases, order statistics by sorting, neighbours by comparing everything.
"""

from __future__ import annotations

SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"
MARK = "chr(92) || 'n'"


def words(text: str) -> str:
    flat = f"lower(replace({text}, {MARK}, ' '))"
    return f"string_split(translate(trim({flat}, {SPACE}), ',.:', ''), ' ')"


def marked(text: str) -> str:
    return f"replace({text}, chr(10), {MARK})"


def last_paragraph(text: str) -> str:
    return f"list_last(string_split({text}, {MARK}))"


def rounded(expression: str, digits: int, name: str) -> str:
    return f"round({expression}, {digits}) AS {name}"


PARTS = f"""parts AS (
  SELECT p_partkey AS ord, concat_ws('-', p_name, p_size) AS name, p_brand AS availability,
         p_type AS types,
         CASE WHEN p_size <> 13 THEN concat_ws({MARK}, p_name, p_brand, p_type) END AS text,
         CASE WHEN p_size > 5 THEN p_retailprice END AS edhrecRank, p_brand AS setCode,
         CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS manaCost
  FROM part)"""

FLAGS = """flags AS (
  SELECT l_orderkey AS item_id, string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS colorIdentity
  FROM lineitem GROUP BY 1),
items AS (
  SELECT o_orderkey AS item_id, colorIdentity, o_orderpriority AS keywords, o_orderstatus AS status
  FROM orders LEFT JOIN flags ON item_id = o_orderkey)"""

FEATURES = f"""{FLAGS},
labelled AS (
  SELECT DISTINCT item_id, label FROM (
    SELECT item_id, 'color:' || CASE trim(c) WHEN 'W' THEN 'White' WHEN 'U' THEN 'Blue' WHEN 'B' THEN 'Black'
                    WHEN 'R' THEN 'Red' WHEN 'G' THEN 'Green' ELSE trim(c) END AS label
    FROM (SELECT item_id, unnest(string_split(coalesce(colorIdentity, ''), ',')) AS c FROM items)
    UNION ALL
    SELECT item_id, 'kw:' || trim(k) FROM (SELECT item_id, unnest(string_split(coalesce(keywords, ''), ',')) AS k FROM items)
    UNION ALL
    SELECT item_id, 'flag:legendary' FROM items WHERE status = 'F'))"""

DOCUMENTS = f"""docs AS (
  SELECT doc_id AS item_id, doc_id AS ord, 'doc-' || doc_id AS name, text, lang,
         CAST(n_chars AS DOUBLE) AS rank, source AS setCode,
         CASE WHEN lang <> 'fr' THEN lang END AS manaCost, lang AS types
  FROM documents),
word_lists AS (SELECT item_id, {words('text')} AS t FROM docs),
words AS (SELECT item_id, t, CAST(len(t) AS BIGINT) * (len(t) + 1) // 2 AS n FROM word_lists)"""


def overlap(prefix: str, anchors: str, items: str) -> str:
    """CTEs ending in ``{prefix}_shared(aid, iid, shared)``.

    ``anchors(aid, t)``, ``items(item_id, t)``.  Matching words are joined into
    runs, and the shared phrases are then built and counted distinct.
    """
    p = prefix
    return f"""
{p}_a AS (SELECT aid, unnest(range(1, len(t) + 1)) AS pos, unnest(t) AS word FROM {anchors}),
{p}_b AS (SELECT item_id AS iid, unnest(range(1, len(t) + 1)) AS pos, unnest(t) AS word FROM {items}),
{p}_hit AS (SELECT aid, iid, {p}_a.pos AS p, {p}_b.pos - {p}_a.pos AS d FROM {p}_a JOIN {p}_b USING (word)),
{p}_grp AS (SELECT *, p - row_number() OVER (PARTITION BY aid, iid, d ORDER BY p) AS g FROM {p}_hit),
{p}_run AS (SELECT aid, iid, p, max(p) OVER (PARTITION BY aid, iid, d, g) - p + 1 AS l FROM {p}_grp),
{p}_len AS (SELECT aid, iid, p, max(l) AS l FROM {p}_run GROUP BY ALL),
{p}_phrase AS (
  SELECT DISTINCT x.aid, iid, array_to_string(t[p:p + k - 1], ' ') AS phrase
  FROM (SELECT aid, iid, p, unnest(range(1, l + 1)) AS k FROM {p}_len) x JOIN {anchors} a ON a.aid = x.aid),
{p}_shared AS (SELECT aid, iid, count(*) AS shared FROM {p}_phrase GROUP BY ALL)"""


def clusters(source: str, k: int = 6) -> str:
    """CTEs ending in ``clustered(item_id, ord, rank, centroid, cluster_pos)``."""
    return f"""
sorted_ranks AS (SELECT rank, row_number() OVER (ORDER BY rank) - 1 AS i, count(*) OVER () AS n FROM {source}),
edges AS (
  SELECT b.b, max(rank) FILTER (i = b.b * n // {k}) AS lo, max(rank) FILTER (i = (b.b + 1) * n // {k} - 1) AS hi
  FROM sorted_ranks, (SELECT unnest(range(0, {k})) AS b) b GROUP BY b.b),
seeds AS (SELECT b, floor((lo + hi) / 2) AS s FROM edges),
nearest AS (
  SELECT item_id, ord, rank, b FROM (
    SELECT m.*, b, row_number() OVER (PARTITION BY item_id ORDER BY abs(rank - s), b) AS rn FROM {source} m, seeds)
  WHERE rn = 1),
centroids AS (
  SELECT b, centroid, row_number() OVER (ORDER BY centroid, b) - 1 AS cluster_pos
  FROM (SELECT b, avg(rank) AS centroid FROM nearest GROUP BY b)),
clustered AS (SELECT nearest.*, centroid, cluster_pos FROM nearest JOIN centroids USING (b))"""


def walk(prefix: str, source: str, wanted: int, leave: bool) -> str:
    """CTE ``{prefix}(item_id, ..., step)``: picks down the rankings of ``source``."""
    stop = f"WHERE last_rn IS NULL OR rn <= last_rn" if leave else ""
    return f"""
{prefix}_rn AS (SELECT *, row_number() OVER (PARTITION BY cluster_pos ORDER BY sim DESC, ord) AS rn FROM {source}),
{prefix}_exit AS (SELECT *, max(rn) FILTER (is_last) OVER (PARTITION BY cluster_pos) AS last_rn FROM {prefix}_rn),
{prefix} AS (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY cluster_pos, rn) AS step FROM {prefix}_exit {stop})
  WHERE step <= {wanted})"""


def item_set(prefix: str, pool: str, leave: bool) -> str:
    """CTEs ending in ``{prefix}_deck``; ``pool(item_id, ord, rank, cluster_pos)``."""
    p = prefix
    onward = f"AND cluster_pos >= (SELECT cluster_pos + CASE WHEN is_last AND {leave} THEN 1 ELSE 0 END FROM {p}_one WHERE step = 49)"
    return f"""
{p}_pool AS (
  SELECT m.*, n, t, m.ord = max(m.ord) OVER (PARTITION BY cluster_pos) AS is_last
  FROM {pool} m JOIN words USING (item_id)),
{p}_anchor AS (SELECT item_id AS aid, t FROM words WHERE item_id = 1),
{overlap(p + '_o1', p + '_anchor', p + '_pool')},
{p}_s1 AS (
  SELECT m.item_id, ord, rank, cluster_pos, is_last, coalesce(shared, 0) / n AS sim, 1 AS scorer_id
  FROM {p}_pool m LEFT JOIN {p}_o1_shared ON iid = item_id WHERE item_id <> 1),
{walk(p + '_one', p + '_s1', 49, leave)},
{p}_second AS (SELECT words.item_id AS aid, t FROM words JOIN {p}_one USING (item_id) WHERE step = 1),
{overlap(p + '_o2', p + '_second', p + '_pool')},
{p}_s2 AS (
  SELECT m.item_id, ord, rank, cluster_pos, is_last, coalesce(shared, 0) / n AS sim, (SELECT aid FROM {p}_second) AS scorer_id
  FROM {p}_pool m LEFT JOIN {p}_o2_shared ON iid = item_id
  WHERE item_id <> 1 AND item_id NOT IN (SELECT item_id FROM {p}_one)
    {onward}),
{walk(p + '_two', p + '_s2', 13, leave)},
{p}_deck AS (
  SELECT 0 AS deck_pos, 1 AS scorer_id, item_id, 1.0::DOUBLE AS sim, rank FROM docs WHERE item_id = 1 {'' if leave else 'AND item_id IN (SELECT item_id FROM ' + pool + ')'}
  UNION ALL SELECT step, scorer_id, item_id, sim, rank FROM {p}_one
  UNION ALL SELECT step + 49, scorer_id, item_id, sim, rank FROM {p}_two)"""


LEGAL = """legal AS (SELECT item_id, ord, rank FROM docs WHERE lang = (SELECT lang FROM docs WHERE item_id = 1))"""

DECK = f"""{DOCUMENTS},
{LEGAL},
{clusters('legal')},
{item_set('rel', 'clustered', True)}"""

CURRENT = f"""{DECK},
found AS (
  SELECT d.item_id, d.name, d.text, d.rank, d.setCode, sim AS sim_score, deck_pos
  FROM rel_deck JOIN docs d USING (item_id)
  WHERE item_id <> 1 AND NOT contains(setCode, 'src1'))"""

UPCOMING = f"""{CURRENT},
coming AS (SELECT item_id, ord, rank, 0 AS cluster_pos FROM docs WHERE contains(setCode, 'src1')),
{item_set('up', 'coming', False)},
line AS (SELECT regr_slope(rank, sim_score) AS slope, regr_intercept(rank, sim_score) AS intercept FROM found),
recs AS (
  SELECT item_id AS card_index, name, manaCost, types, text, sim AS sim_score, d.rank AS edhrecRank,
         {rounded('intercept + slope * sim', 3, 'edhrecRank_prediction')}
  FROM (SELECT * FROM up_deck WHERE item_id <> 1 ORDER BY sim DESC, deck_pos LIMIT 10)
  JOIN docs d USING (item_id), line)"""


def triples(term: str) -> str:
    s = "x.sim" if term == "best" else "final_sim"
    return f"""{DECK},
scorers AS (SELECT DISTINCT scorer_id AS aid, t FROM rel_deck JOIN words ON words.item_id = scorer_id),
deck_words AS (SELECT item_id, t, n FROM words WHERE item_id IN (SELECT item_id FROM rel_deck)),
{overlap('tri', 'scorers', 'deck_words')},
all_sims AS (
  SELECT scorers.aid, item_id AS card_id, coalesce(shared, 0) / n AS sim
  FROM scorers CROSS JOIN deck_words LEFT JOIN tri_shared s ON s.aid = scorers.aid AND s.iid = item_id),
per_card AS (
  SELECT d.scorer_id AS r_anchor, d.item_id AS r_item, d.sim AS r_sim, d.rank AS r_rank, d.deck_pos AS r_pos,
         s.card_id, s.sim FROM rel_deck d JOIN all_sims s ON s.aid = d.scorer_id),
finals AS (SELECT card_id, arg_max(sim, (r_rank, r_pos)) AS final_sim FROM per_card GROUP BY 1),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY card_id ORDER BY sim DESC, r_rank, r_pos) AS rn
                 FROM per_card WHERE r_anchor <> card_id AND r_item <> card_id) WHERE rn = 1),
uses AS (SELECT scorer_id AS r_anchor, count(*) AS uses FROM rel_deck GROUP BY 1),
triples AS (
  SELECT 1 AS anchor_id, x.r_anchor, x.r_item, c.item_id AS card_id,
         {rounded(f'({s} + r_sim) / uses', 9, 'support')},
         {rounded(f'(({s} + r_sim) / nullif(r_sim, 0)) / n', 9, 'confidence')}, c.rank,
         row_number() OVER (ORDER BY ({s} + r_sim) / nullif(r_sim, 0) / n DESC NULLS LAST, c.deck_pos) - 1 AS rule_pos
  FROM rel_deck c LEFT JOIN best x ON x.card_id = c.item_id LEFT JOIN finals f ON f.card_id = c.item_id
  LEFT JOIN uses ON uses.r_anchor = x.r_anchor LEFT JOIN words ON words.item_id = x.r_anchor)"""


def triples_mean(term: str) -> str:
    told = "best_rn" if term == "best" else "last_rn"
    return f"""{DECK},
deck_words AS (SELECT item_id, item_id AS aid, t, n FROM words WHERE item_id IN (SELECT item_id FROM rel_deck)),
{overlap('tri', 'deck_words', 'deck_words')},
all_sims AS (
  SELECT a.aid, b.item_id AS card_id, coalesce(shared, 0) / b.n AS sim
  FROM deck_words a CROSS JOIN deck_words b LEFT JOIN tri_shared s ON s.aid = a.aid AND s.iid = b.item_id),
chosen AS (
  SELECT card_id, scorer_id AS r_anchor, d.item_id AS r_item, d.sim AS r_sim, s.sim,
         row_number() OVER (PARTITION BY card_id ORDER BY s.sim DESC, rank, deck_pos) AS best_rn,
         row_number() OVER (PARTITION BY card_id ORDER BY rank DESC, deck_pos DESC) AS last_rn
  FROM rel_deck d JOIN all_sims s ON s.aid = d.item_id),
means AS (SELECT card_id, avg(sim) AS mean_sim FROM all_sims GROUP BY 1),
triples AS (
  SELECT 1 AS anchor_id, x.r_anchor, x.r_item, x.card_id,
         {rounded('(x.sim + y.r_sim) / nullif(mean_sim, 0)', 9, 'support')},
         {rounded('(x.sim + y.r_sim) / nullif(y.r_sim, 0)', 9, 'confidence')}, c.rank,
         row_number() OVER (ORDER BY c.rank, c.deck_pos) - 1 AS rule_pos
  FROM chosen x JOIN chosen y ON y.card_id = x.card_id AND y.best_rn = 1
  JOIN means ON means.card_id = x.card_id JOIN rel_deck c ON c.item_id = x.card_id WHERE x.{told} = 1)"""

LINES = """lines AS (
  SELECT *, concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS key,
         l_quantity AS x, l_extendedprice AS y
  FROM lineitem),
shuffled AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || key)) - 1 AS i, count(*) OVER () AS n FROM lines)"""

SPLIT = f"""{LINES},
split AS (SELECT *, i >= n - CAST(ceil(n * 0.25) AS BIGINT) AS is_test FROM shuffled),
model AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM split WHERE NOT is_test),
predicted AS (SELECT key, x, y, a + b * x AS p FROM split, model WHERE is_test)"""

PRICES = """prices AS (SELECT p_partkey AS item_id, p_partkey AS ord, p_retailprice AS rank FROM part)"""


def draw(seed: int, key: str, start: int) -> str:
    """A number between 0 and 1 from eight digits of the seeded digest."""
    return f"((CAST(('0x' || substr(md5('{seed}:' || {key}), {start}, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)"


def normal(seed: int, key: str) -> str:
    return f"(sqrt(-2.0 * ln({draw(seed, key, 1)})) * cos(2.0 * pi() * {draw(seed, key, 9)}))"


def phrases_of(source: str) -> str:
    """Phrases of ``source(item_id, t)``, counted."""
    return f"""
SELECT item_id, array_to_string(t[i:i + k - 1], ' ') AS phrase, count(*) AS n
FROM (SELECT *, unnest(range(1, len(t) - i + 2)) AS k FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM {source}))
GROUP BY ALL"""


# Many anchors: every step partitioned by the anchor.
_MANY_WALK = """
{o}_rn AS (SELECT *, row_number() OVER (PARTITION BY anchor_id, cluster_pos ORDER BY sim DESC, ord) AS rn FROM {i}),
{o}_exit AS (SELECT *, max(rn) FILTER (is_last) OVER (PARTITION BY anchor_id, cluster_pos) AS last_rn FROM {o}_rn),
{o} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY cluster_pos, rn) AS step FROM {o}_exit WHERE last_rn IS NULL OR rn <= last_rn)
  WHERE step <= {n})"""
MANY = (
    """
WITH items AS (
  SELECT p_partkey AS item_id, p_partkey AS ord, p_retailprice AS rank, p_brand AS setCode,
         CASE WHEN p_size % 2 = 0 THEN [p_type, 'EVEN'] ELSE [p_type] END AS labels,
         string_split(translate(lower(p_name || ' ' || p_brand || ' ' || p_type), ',.:', ''), ' ') AS t
  FROM part),
words AS (
  SELECT item_id, len(t) * (len(t) + 1) // 2 AS n,
         list_distinct(flatten(list_transform(range(1, len(t) + 1), lambda i: list_transform(range(i, len(t) + 1), lambda j: array_to_string(t[i:j], ' '))))) AS ph
  FROM items),
anchors AS (SELECT min(item_id) AS anchor_id FROM items GROUP BY setCode),
legal AS (
  SELECT anchor_id, i.item_id, i.ord, i.rank
  FROM anchors JOIN items x ON x.item_id = anchor_id
  JOIN items i ON len(list_filter(i.labels, lambda l: NOT list_contains(x.labels, l))) = 0),
sorted_ranks AS (
  SELECT anchor_id, rank, row_number() OVER (PARTITION BY anchor_id ORDER BY rank) - 1 AS i, count(*) OVER (PARTITION BY anchor_id) AS n FROM legal),
edges AS (
  SELECT anchor_id, b.b, max(rank) FILTER (i = b.b * n // 6) AS lo, max(rank) FILTER (i = (b.b + 1) * n // 6 - 1) AS hi
  FROM sorted_ranks, (SELECT unnest(range(0, 6)) AS b) b GROUP BY ALL),
seeds AS (SELECT anchor_id, b, floor((lo + hi) / 2) AS s FROM edges),
nearest AS (
  SELECT anchor_id, item_id, ord, rank, b FROM legal m JOIN seeds USING (anchor_id)
  QUALIFY row_number() OVER (PARTITION BY anchor_id, item_id ORDER BY abs(rank - s), b) = 1),
centroids AS (
  SELECT anchor_id, b, row_number() OVER (PARTITION BY anchor_id ORDER BY centroid, b) - 1 AS cluster_pos
  FROM (SELECT anchor_id, b, avg(rank) AS centroid FROM nearest GROUP BY ALL)),
pool AS (
  SELECT anchor_id, item_id, ord, rank, cluster_pos, n, ph, ord = max(ord) OVER (PARTITION BY anchor_id, cluster_pos) AS is_last
  FROM nearest JOIN centroids USING (anchor_id, b) JOIN words USING (item_id)),
s1 AS (
  SELECT p.*, len(list_intersect(a.ph, p.ph)) / p.n AS sim FROM pool p JOIN words a ON a.item_id = anchor_id WHERE p.item_id <> anchor_id),"""
    + _MANY_WALK.format(o="one", i="s1", n=49)
    + """,
turn AS (
  SELECT anchor_id, max(item_id) FILTER (step = 1) AS scorer, max(cluster_pos + CAST(is_last AS INTEGER)) FILTER (step = 49) AS start
  FROM one GROUP BY anchor_id),
s2 AS (
  SELECT p.*, len(list_intersect(a.ph, p.ph)) / p.n AS sim
  FROM pool p JOIN turn USING (anchor_id) JOIN words a ON a.item_id = scorer
  WHERE p.item_id <> anchor_id AND cluster_pos >= start AND NOT EXISTS (SELECT 1 FROM one o WHERE o.anchor_id = p.anchor_id AND o.item_id = p.item_id)),"""
    + _MANY_WALK.format(o="two", i="s2", n=13)
    + """,
decks AS (
  SELECT anchor_id, item_id, step AS deck_pos, rank, sim FROM one
  UNION ALL SELECT anchor_id, item_id, step + 49, rank, sim FROM two)
SELECT anchor_id, item_id, deck_pos, d.rank, setCode, round(sim, 9) AS sim_score
FROM decks d JOIN items USING (item_id) WHERE NOT contains(setCode, 'Brand#2')
"""
)



def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # counts, cleaning, lookups
    sql["label_counts_top"] = f"""WITH {FLAGS},
split AS (SELECT unnest(string_split(coalesce(colorIdentity, ''), ', ')) AS label FROM items)
SELECT label, count(*) AS n FROM split GROUP BY label ORDER BY n DESC, label LIMIT 10"""
    sql["label_counts_all"] = f"""WITH {FLAGS},
split AS (SELECT unnest(string_split(coalesce(colorIdentity, ''), ', ')) AS code FROM items)
SELECT CASE code WHEN 'W' THEN 'White' WHEN 'U' THEN 'Blue' WHEN 'B' THEN 'Black' WHEN 'R' THEN 'Red'
       WHEN 'G' THEN 'Green' ELSE code END AS label, count(*) AS n FROM split GROUP BY 1"""
    sql["value_counts"] = "SELECT p_type, count(*) AS n FROM part GROUP BY p_type"
    sql["dedup_keep_last"] = """SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) AS rn FROM part) WHERE rn = 1"""
    sql["clean_chain"] = f"""WITH {PARTS},
single AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ord DESC) AS rn FROM parts WHERE contains(availability, 'Brand#1')),
kept AS (SELECT * FROM single WHERE rn = 1 AND NOT contains(types, 'PROMO') AND text IS NOT NULL)
SELECT ord, name, availability, types, text, coalesce(edhrecRank, (SELECT max(edhrecRank) FROM kept)) AS edhrecRank,
       setCode, manaCost FROM kept"""
    sql["typed_fill"] = """SELECT c_custkey, coalesce(o_orderkey, -1) AS o_orderkey, coalesce(o_orderpriority, '') AS text,
  coalesce(o_orderstatus = 'F', false) AS isReserved, coalesce(o_totalprice, -1.0) AS edhrecRank,
  coalesce(o_orderstatus, '-1') AS toughness,
  CASE WHEN o_orderkey IS NULL THEN '' ELSE o_orderstatus || '|' || o_orderpriority END AS colors
FROM customer LEFT JOIN orders ON c_custkey = o_custkey"""
    sql["drop_unranked"] = "SELECT p_partkey AS ord, p_retailprice AS edhrecRank FROM part WHERE p_size > 5"
    sql["cohort_split"] = """SELECT doc_id AS item_id, source AS setCode,
  CASE WHEN contains(source, 'src1') THEN 'upcoming' ELSE 'current' END AS cohort FROM documents"""
    sql["label_subset"] = f"""WITH {FLAGS},
own AS (SELECT string_split(colorIdentity, ', ') AS allowed FROM items WHERE item_id = 0)
SELECT item_id, coalesce(colorIdentity, '') AS labels FROM items, own
WHERE colorIdentity IS NULL OR list_has_all(coalesce(allowed, []), string_split(colorIdentity, ', '))"""
    sql["name_search"] = f"""WITH {PARTS} SELECT ord, name FROM parts
WHERE contains(lower(name), 'ring') AND contains(lower(types), 'economy') ORDER BY ord LIMIT 10"""
    sql["name_search_regex"] = f"""WITH {PARTS} SELECT ord, name FROM parts
WHERE regexp_matches(name, '^red .*-1[0-9]$', 'i') AND regexp_matches(types, 'STANDARD|promo', 'i') ORDER BY ord LIMIT 10"""
    sql["point_lookup"] = f"""WITH {PARTS} SELECT name AS cardname, types, manaCost AS manacost,
  replace(text, {MARK}, '- ') AS cardtext, edhrecRank AS edhrec, setCode AS setcode
FROM parts WHERE name = 'small ring-11' ORDER BY ord LIMIT 1"""
    sql["any_cell_search"] = """SELECT p_partkey AS ord, unnest(['availability', 'setCode']) AS "column" FROM part WHERE p_brand = 'Brand#17'"""
    sql["any_cell_columns"] = """SELECT unnest(['availability', 'setCode']) AS "column", n AS rows
FROM (SELECT count(*) AS n FROM part WHERE p_brand = 'Brand#17') WHERE n > 0"""
    sql["exists"] = f"""WITH {PARTS},
asked AS (SELECT unnest(['small ring-11', 'no such name']) AS name)
SELECT name IN (SELECT name FROM parts) AS found, name FROM asked"""
    sql["table_profile"] = f"""WITH {PARTS} SELECT unnest(['ord', 'name', 'availability', 'types', 'text', 'edhrecRank', 'setCode', 'manaCost']) AS "column",
  unnest(['bigint', 'string', 'string', 'string', 'string', 'double', 'string', 'string']) AS dtype,
  unnest([count(ord), count(name), count(availability), count(types), count(text), count(edhrecRank), count(setCode), count(manaCost)]) AS non_null
FROM parts"""
    sql["head_tail"] = f"""WITH {PARTS}
SELECT * FROM (SELECT ord, name, 'head' AS part FROM parts ORDER BY ord LIMIT 10)
UNION ALL SELECT * FROM (SELECT ord, name, 'tail' AS part FROM parts ORDER BY ord DESC LIMIT 10)"""
    sql["distinct_values"] = "SELECT DISTINCT p_brand FROM part"
    sql["display"] = f"SELECT conv_id, turn, replace({marked('text')}, {MARK}, '- ') AS cardtext FROM conversations"

    # labels and vectors
    sql["multi_hot_rows"] = f"WITH {FEATURES} SELECT item_id, label FROM labelled"
    sql["cosine_topn"] = f"""WITH {FEATURES},
sizes AS (SELECT item_id, count(*) AS n FROM labelled GROUP BY 1),
shared AS (SELECT b.item_id, count(*) AS s FROM labelled a JOIN labelled b USING (label) WHERE a.item_id = 3 GROUP BY 1)
SELECT item_id, round(coalesce(s, 0) / sqrt(n * (SELECT n FROM sizes WHERE item_id = 3)), 9) AS similarity
FROM sizes LEFT JOIN shared USING (item_id) WHERE item_id <> 3
  AND (SELECT count(*) FROM sizes WHERE item_id = 3) > 0
ORDER BY similarity DESC, item_id LIMIT 10"""
    sql["cosine_topn_vectors"] = """WITH long AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings),
sizes AS (SELECT vec_id, sum(v * v) AS s FROM long GROUP BY 1),
dots AS (SELECT b.vec_id, sum(a.v * b.v) AS d FROM long a JOIN long b USING (i) WHERE a.vec_id = 0 GROUP BY 1)
SELECT vec_id, round(coalesce(d / nullif(sqrt(s * (SELECT s FROM sizes WHERE vec_id = 0)), 0), 0), 6) AS similarity
FROM dots JOIN sizes USING (vec_id) WHERE vec_id <> 0
ORDER BY d / nullif(sqrt(s * (SELECT s FROM sizes WHERE vec_id = 0)), 0) DESC, vec_id LIMIT 10"""

    # phrases
    sql["phrase_list"] = f"WITH w AS (SELECT item_id, {words('text')} AS t FROM benchmark) {phrases_of('w')}"
    sql["last_paragraph_phrases"] = f"""WITH w AS (SELECT item_id, string_split({last_paragraph(marked('text'))}, ' ') AS t FROM benchmark)
{phrases_of('w')}"""
    sql["phrase_overlap"] = f"""WITH {DOCUMENTS},
anchors AS (SELECT item_id AS aid, {words('text')} AS t FROM benchmark),
{overlap('o', 'anchors', 'words')}
SELECT aid AS anchor_id, iid AS item_id, shared, n AS n_phrases, shared / n AS sim
FROM o_shared JOIN words ON words.item_id = iid"""
    sql["candidates"] = f"""WITH turns AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn) AS item_id, conv_id, turn, role AS name,
         {last_paragraph(marked('text'))} AS paragraph FROM conversations),
lists AS (SELECT item_id, string_split(paragraph, ' ') AS t FROM turns),
first_turn AS (SELECT item_id AS aid, t FROM lists ORDER BY item_id LIMIT 1),
{overlap('o', 'first_turn', 'lists')}
SELECT conv_id, turn, x.name, x.paragraph, overlap FROM (
  SELECT min(item_id) AS ord, name, paragraph, shared AS overlap FROM turns JOIN o_shared ON iid = item_id
  WHERE shared > 2 GROUP BY name, paragraph, shared ORDER BY ord LIMIT 62) x JOIN turns ON item_id = ord"""

    # rank clusters
    sql["bucket_edges"] = """WITH s AS (
  SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) - 1 AS i, count(*) OVER () AS n FROM lineitem)
SELECT CAST(b AS INTEGER) AS bucket, max(v) FILTER (i = b * n // 6) AS low, max(v) FILTER (i = (b + 1) * n // 6 - 1) AS high
FROM s, (SELECT unnest(range(0, 6)) AS b) GROUP BY b"""
    parts = f"WITH {PRICES}, {clusters('prices')}"
    sql["rank_kmeans"] = f"{parts} SELECT item_id, cluster_pos, {rounded('centroid', 6, 'centroid')} FROM clustered"
    sse = "sum(pow(trunc(rank) - centroid, 2))"
    sql["cluster_sse"] = f"""{parts},
per AS (SELECT cluster_pos, count(*) AS n, max(centroid) AS centroid, {sse} AS sse FROM clustered GROUP BY 1)
SELECT cluster_pos, n, {rounded('centroid', 6, 'centroid')}, {rounded('sse', 2, 'sse')},
       {rounded('sse - avg(sse) OVER ()', 2, 'sse_minus_mean')} FROM per"""
    sql["cluster_boundary"] = f"""{parts},
per AS (SELECT cluster_pos, max(centroid) AS centroid, trunc(arg_max(rank, ord)) AS r FROM clustered GROUP BY 1)
SELECT a.cluster_pos, {rounded('abs(a.r - a.centroid)', 6, 'dist_own')}, {rounded('abs(a.r - b.centroid)', 6, 'dist_next')}
FROM per a JOIN per b ON b.cluster_pos = a.cluster_pos + 1"""
    sql["cluster_counts"] = f"WITH {DOCUMENTS}, {LEGAL}, {clusters('legal')} SELECT cluster_pos, count(*) AS n FROM clustered GROUP BY 1"

    # item sets, rules, recommendations
    sql["related_items_many"] = MANY
    sql["greedy_set"] = f"WITH {DECK} SELECT 1 AS anchor_id, deck_pos, scorer_id, item_id, sim, rank FROM rel_deck"
    sql["triple_rules"] = f"WITH {triples('best')} SELECT * FROM triples"
    sql["triple_rules_last"] = f"WITH {triples('last')} SELECT * FROM triples"
    sql["triple_rules_mean"] = f"WITH {triples_mean('best')} SELECT * FROM triples"
    sql["triple_rules_mean_last"] = f"WITH {triples_mean('last')} SELECT * FROM triples"
    sql["top_rules"] = f"""WITH {triples('best')},
top AS (SELECT * FROM triples ORDER BY rule_pos LIMIT 10)
SELECT a.name AS r_anchor_name, b.name AS r_item_name, c.name AS card_id_name, support, confidence
FROM top LEFT JOIN docs a ON a.item_id = r_anchor LEFT JOIN docs b ON b.item_id = r_item LEFT JOIN docs c ON c.item_id = card_id"""
    sql["related_items"] = f"WITH {CURRENT} SELECT item_id, name, text, rank, setCode, sim_score FROM found"
    sql["related_names"] = f"WITH {CURRENT} SELECT name FROM found"
    sql["upcoming_recs"] = f"WITH {UPCOMING} SELECT * FROM recs"
    sql["recommendation_lookup"] = f"""WITH {UPCOMING}
SELECT name AS cardname, types, replace(text, {MARK}, '- ') AS text, coalesce(manaCost, 'manaCost not found') AS manaCost,
       replace(text, {MARK}, '- ') AS cardtext, CAST(edhrecRank AS VARCHAR) AS edhrec,
       CAST(edhrecRank_prediction AS VARCHAR) AS edhrec_predicted, CAST(sim_score AS VARCHAR) AS sim_score
FROM recs ORDER BY recs.sim_score DESC, card_index LIMIT 1"""

    # features and clustering
    sql["standardise"] = f"""WITH m AS (
  SELECT avg(p_size) AS a, stddev_pop(p_size) AS b, avg(p_retailprice) AS c, stddev_pop(p_retailprice) AS d FROM part)
SELECT p_partkey, {rounded('(p_size - a) / b', 9, 'p_size')}, {rounded('(p_retailprice - c) / d', 9, 'p_retailprice')} FROM part, m"""
    sql["dbscan_points"] = """WITH RECURSIVE m AS (
  SELECT avg(p_size) AS a, stddev_pop(p_size) AS b, avg(p_retailprice) AS c, stddev_pop(p_retailprice) AS d FROM part),
s AS (SELECT p_partkey, (p_size - a) / b AS x, (p_retailprice - c) / d AS y FROM part, m),
pts AS (SELECT x, y, min(p_partkey) AS pid, count(*) AS w FROM s GROUP BY x, y),
near AS (SELECT a.pid AS a, b.pid AS b, b.w FROM pts a JOIN pts b ON pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 0.1 * 0.1),
core AS (SELECT a AS pid FROM near GROUP BY a HAVING sum(w) >= 5),
edges AS (SELECT a, b FROM near WHERE a IN (SELECT pid FROM core) AND b IN (SELECT pid FROM core) AND a <> b),
reach(pid, root) AS (
  SELECT pid, pid FROM core
  UNION SELECT edges.b, reach.root FROM reach JOIN edges ON edges.a = reach.pid WHERE reach.root < edges.b),
placed AS (SELECT pid, min(root) AS root FROM reach GROUP BY pid),
border AS (
  SELECT a AS pid, min(root) AS root FROM near JOIN placed ON placed.pid = b
  WHERE a NOT IN (SELECT pid FROM core) GROUP BY a),
named AS (SELECT * FROM placed UNION ALL SELECT * FROM border),
numbered AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS k FROM (SELECT DISTINCT root FROM placed))
SELECT p_partkey, coalesce(k, -1) AS cluster
FROM s JOIN pts ON s.x = pts.x AND s.y = pts.y LEFT JOIN named ON named.pid = pts.pid LEFT JOIN numbered USING (root)"""
    # At a fixed point every point lies nearest to the mean of its own cluster.
    sql["kmeans_fixpoint"] = """SELECT count(*) AS points, 3 AS clusters, 0 AS misplaced
FROM (SELECT DISTINCT embedding FROM embeddings)"""
    # A differing 0/1 column puts rows at least 2 apart, so only equal rows are neighbours.
    sql["dbscan"] = f"""WITH {FEATURES},
sets AS (SELECT item_id, string_agg(label, '|' ORDER BY label) AS s FROM labelled GROUP BY 1),
sized AS (SELECT item_id, count(*) OVER (PARTITION BY s) AS n, min(item_id) OVER (PARTITION BY s) AS lead FROM sets),
numbered AS (SELECT lead, row_number() OVER (ORDER BY lead) - 1 AS k FROM (SELECT DISTINCT lead FROM sized WHERE n >= 5))
SELECT item_id, coalesce(k, -1) AS cluster FROM sized LEFT JOIN numbered USING (lead)"""
    sql["dbscan_sizes"] = f"SELECT cluster, count(*) AS n FROM ({sql['dbscan']}) GROUP BY 1"
    for name, distance in (
        ("silhouette", "list_distance(a.e, b.e)"),
        ("silhouette_squared", "pow(list_distance(a.e, b.e), 2)"),
    ):
        sql[name] = f"""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings),
sums AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum({distance}) AS total, count(*) AS n
         FROM v a CROSS JOIN v b GROUP BY ALL),
ab AS (SELECT vec_id, max(n) FILTER (own = other) AS n_own, sum(total / (n - 1)) FILTER (own = other AND n > 1) AS a,
              min(total / n) FILTER (own <> other) AS b FROM sums GROUP BY 1)
SELECT {rounded('avg(CASE WHEN n_own > 1 THEN (b - a) / greatest(a, b) ELSE 0 END)', 7, 'silhouette')} FROM ab"""

    # regression
    sql["linreg"] = f"""WITH {LINES} SELECT {rounded('regr_slope(y, x)', 6, 'slope')}, {rounded('regr_intercept(y, x)', 4, 'intercept')} FROM lines"""
    sql["training_mse"] = f"""WITH {LINES}, m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM lines)
SELECT {rounded('avg(pow(a + b * x - y, 2))', 1, 'mse')}, {rounded('avg(y)', 4, 'label_mean')} FROM lines, m"""
    sql["kfold_mse"] = f"""WITH {LINES},
folded AS (SELECT x, y, i // (n // 7) AS fold FROM shuffled),
folds AS (SELECT unnest(range(0, 7)) AS k),
models AS (SELECT k, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM folds JOIN folded ON fold <> k GROUP BY k),
errors AS (SELECT k, avg(pow(a + b * x - y, 2)) AS mse FROM models JOIN folded ON fold = k GROUP BY k)
SELECT {rounded('avg(mse)', 1, 'mean_mse')}, {rounded('(SELECT avg(y) FROM lines)', 4, 'label_mean')} FROM errors"""
    sql["train_test_split"] = f"""WITH {SPLIT} SELECT is_test, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS orders, sum(l_quantity) AS quantity FROM split GROUP BY 1"""
    sql["synthetic_score"] = f"SELECT p_partkey, {rounded('0.75 * p_retailprice + 10 * ' + normal(7, 'p_partkey'), 6, 'score')} FROM part"
    sql["random_draws"] = f"""SELECT p_partkey, CAST(floor({draw(3, 'p_partkey', 1)} * p_size) AS BIGINT) AS drawn,
  {rounded(normal(3, 'p_partkey'), 6, 'normal')} FROM part"""
    sql["prediction_sample"] = f"WITH {SPLIT} SELECT key, {rounded('p', 4, 'predicted')}, y AS actual FROM predicted ORDER BY key LIMIT 5"
    sql["plot_series"] = f"WITH {SPLIT} SELECT x AS sim_score, y AS actual, {rounded('p', 4, 'predicted')} FROM predicted"

    # sources and sinks
    sql["csv_roundtrip"] = "SELECT doc_id, text, source, n_chars FROM documents"
    sql["csv_row_order"] = "SELECT p_partkey, p_name, p_partkey AS ord FROM part"
    line = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"
    sql["csv_split_order"] = f"SELECT {line}, row_number() OVER (ORDER BY {line}) - 1 AS ord FROM lineitem"
    dictionary = """WITH d AS (
  SELECT DISTINCT category, keyword FROM (
    SELECT 'names' AS category, unnest(string_split(p_name, ' ')) AS keyword FROM part
    UNION ALL SELECT 'brands', p_brand FROM part UNION ALL SELECT 'types', p_type FROM part))"""
    sql["keyword_dictionary"] = f"{dictionary} SELECT category, keyword FROM d"
    sql["keyword_categories"] = f"{dictionary} SELECT category, count(*) AS n FROM d GROUP BY 1"
    return sql
