"""DuckDB SQL twins of the named jobs in ``plans/standins.py``.

Each statement reads the pre-registered driver views and returns the same
columns (same names) as its Spark job. Jobs without a short SQL form
(k-means fits) have no entry here.
"""

from __future__ import annotations

from ..constants import SENTIMENT_CLASSES, US_STATES
from ..functions.phonetic import metaphone
from ..sources.testbed import (TOPIC_A, TOPIC_B, TOY_BOOSTERS, TOY_ENDINGS, TOY_IDIOMS, TOY_LEXICON, TOY_MARKS, TOY_NEGATIONS, TRACK_WORDS,
                               TRACK_WORDS_CAPTURE)

LEX = "lex(token, valence) AS (VALUES " + ", ".join(f"('{t}', {v!r})" for t, v in TOY_LEXICON) + ")"

POSTS = """posts AS (
  SELECT d.doc_id AS id, e.ts AS created_at, d.lang, d.text AS full_text, e.user_id,
         c.text AS user_description, u.c_name || ', ' || n.n_name AS user_location
  FROM documents d JOIN events e ON e.event_id = d.doc_id
  LEFT JOIN (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, role, text) AS text FROM conversations GROUP BY conv_id) c
    ON c.conv_id = e.user_id
  LEFT JOIN customer u ON u.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = u.c_nationkey)"""


def _class_case(c: str) -> str:
    parts = " ".join(f"WHEN {c} >= {lo!r}::DOUBLE AND {c} < {hi!r}::DOUBLE THEN '{name}'"
                     for name, lo, hi in SENTIMENT_CLASSES)
    return f"CASE {parts} ELSE '0' END"


def _scores(src: str, text: str, key: str = "id", name: str = "s") -> str:
    return f"""(SELECT t.{key} AS sid, sum(l.valence::DECIMAL(18,6))::DOUBLE AS {name}
   FROM (SELECT {key}, unnest(string_split_regex(lower(coalesce({text}, '')), '[^a-z]+')) AS token FROM {src}) t
   JOIN lex l ON t.token = l.token GROUP BY t.{key})"""


def _compound(s: str) -> str:
    return f"coalesce(round({s} / sqrt({s} * {s} + 15), 4), 0.0)"


def _strip(t: str) -> str:
    return f"regexp_replace({t}, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')"


def _rules(src: str, key: str, text: str, p: str, lex: str = "lex", idioms=()) -> str:
    """Common table expressions ``<p>_...`` of the rule scorer; ``<p>_out(rid, compound, pos, neg)``.
    ``idioms``: phrases of up to three words."""
    boo = ", ".join(f"('{w}', {v!r}::DOUBLE)" for w, v in TOY_BOOSTERS)
    neg = ", ".join(f"('{w}')" for w in TOY_NEGATIONS)
    steps, cur = [], f"{p}_v0"
    for d, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
        sc = f"(CASE WHEN v < 0 THEN -coalesce(s{d}, 0.0) ELSE coalesce(s{d}, 0.0) END)"
        caps = f"s{d} IS NOT NULL AND capdiff AND u{d}"
        sc = f"((CASE WHEN {caps} THEN CASE WHEN v > 0 THEN {sc} + 0.733::DOUBLE ELSE {sc} - 0.733::DOUBLE END ELSE {sc} END) * {damp!r}::DOUBLE)"
        negated = f"(coalesce(g{d}, false) OR contains(p{d}, 'n''t'))"
        stress = {1: "", 2: f"WHEN p2 = 'never' AND p1 IN ('so', 'this') THEN (v + {sc}) * 1.5::DOUBLE",
                  3: f"WHEN (p3 = 'never' AND p2 IN ('so', 'this')) OR p1 IN ('so', 'this') THEN (v + {sc}) * 1.25::DOUBLE"}[d]
        steps.append(f"""{p}_v{d} AS (SELECT * REPLACE (CASE WHEN p{d} IS NOT NULL AND l{d} IS NULL
  THEN CASE {stress} WHEN {negated} THEN (v + {sc}) * (-0.74)::DOUBLE ELSE v + {sc} END ELSE v END AS v) FROM {cur})""")
        cur = f"{p}_v{d}"
    if idioms:
        around = [["p2", "p1", "w"], ["p1", "w", "f1"], ["w", "f1", "f2"], ["p1", "w"], ["w", "f1"]]
        cases = "".join(f" WHEN {' AND '.join(f'{a} IS NOT NULL' for a in x)} AND {chr(32).join([' || chr(32) || '.join(x)])} = {ph!r} THEN {val!r}::DOUBLE"
                        for x in around for ph, val in idioms if len(ph.split()) == len(x))
        steps.append(f"{p}_id AS (SELECT * REPLACE (CASE{cases} ELSE v END AS v) FROM {cur})")
        cur = f"{p}_id"
    steps.append(f"""{p}_le AS (SELECT * REPLACE (CASE WHEN p1 = 'least' AND l1 IS NULL AND coalesce(p2, '') NOT IN ('at', 'very')
  THEN v * (-0.74)::DOUBLE ELSE v END AS v) FROM {cur})""")
    cur = f"{p}_le"
    lags = ", ".join(f"lag(w, {d}) OVER o AS p{d}, lag(up, {d}) OVER o AS u{d}, lag(val, {d}) OVER o AS l{d}, "
                     f"lag(sc, {d}) OVER o AS s{d}, lag(ng, {d}) OVER o AS g{d}" for d in (1, 2, 3))
    return f"""{p}_in AS (SELECT {key} AS rid, coalesce({text}, '') AS t FROM {src}),
{p}_raw AS (SELECT rid, t, list_filter(list_transform(list_filter(string_split_regex(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> ''),
   lambda x: CASE WHEN length({_strip('x')}) <= 2 THEN x ELSE {_strip('x')} END), lambda x: length(x) > 1) AS ws FROM {p}_in),
{p}_tok AS (SELECT rid, unnest(ws) AS own, unnest(generate_series(1, len(ws))) AS i FROM {p}_raw),
{p}_low AS (SELECT rid, i, lower(own) AS w, upper(own) = own AND lower(own) <> own AS up FROM {p}_tok),
{p}_info AS (SELECT k.*, x.valence::DOUBLE AS val, b.scalar AS sc, n.token IS NOT NULL AS ng FROM {p}_low k
   LEFT JOIN {lex} x ON x.token = k.w LEFT JOIN (VALUES {boo}) b(token, scalar) ON b.token = k.w
   LEFT JOIN (VALUES {neg}) n(token) ON n.token = k.w),
{p}_ctx AS (SELECT rid, i, w, up, val, sc, {lags}, lead(w, 1) OVER o AS f1, lead(w, 2) OVER o AS f2, bool_or(up) OVER r AND NOT bool_and(up) OVER r AS capdiff,
   min(CASE WHEN w = 'but' THEN i END) OVER r AS but FROM {p}_info
   WINDOW o AS (PARTITION BY rid ORDER BY i), r AS (PARTITION BY rid)),
{p}_v0 AS (SELECT *, CASE WHEN capdiff AND up THEN CASE WHEN val > 0 THEN val + 0.733::DOUBLE ELSE val - 0.733::DOUBLE END ELSE val END AS v
   FROM {p}_ctx WHERE val IS NOT NULL),
{", ".join(steps)},
{p}_w AS (SELECT rid, (CASE WHEN sc IS NOT NULL OR (w = 'kind' AND f1 = 'of') THEN 0.0 WHEN but IS NULL OR i = but THEN v WHEN i < but THEN v * 0.5::DOUBLE
   ELSE v * 1.5::DOUBLE END)::DECIMAL(20,10) AS v FROM {cur}),
{p}_sum AS (SELECT rid, sum(v)::DOUBLE AS s, coalesce(sum(CASE WHEN v > 0 THEN v + 1 END), 0)::DOUBLE AS ps,
   coalesce(sum(CASE WHEN v < 0 THEN v - 1 END), 0)::DOUBLE AS ns, count(*) FILTER (v <> 0) AS h FROM {p}_w GROUP BY rid),
{p}_all AS (SELECT r.rid, len(ws) AS n, coalesce(s, 0.0) AS s, coalesce(ps, 0.0) AS ps, coalesce(ns, 0.0) AS ns, coalesce(h, 0) AS h,
   least(length(t) - length(replace(t, '!', '')), 4) * 0.292::DOUBLE + CASE WHEN length(t) - length(replace(t, '?', '')) <= 1 THEN 0.0::DOUBLE
   WHEN length(t) - length(replace(t, '?', '')) <= 3 THEN (length(t) - length(replace(t, '?', ''))) * 0.18::DOUBLE ELSE 0.96::DOUBLE END AS pu
   FROM {p}_raw r LEFT JOIN {p}_sum z ON z.rid = r.rid),
{p}_fin AS (SELECT rid, n, CASE WHEN s > 0 THEN s + pu WHEN s < 0 THEN s - pu ELSE s END AS s,
   CASE WHEN ps > abs(ns) THEN ps + pu ELSE ps END AS ps, CASE WHEN ps < abs(ns) THEN ns - pu ELSE ns END AS ns, (n - h)::DOUBLE AS neu FROM {p}_all),
{p}_out AS (SELECT rid, CASE WHEN n > 0 THEN round(least(1.0, greatest(-1.0, s / sqrt(s * s + 15))), 4) ELSE 0.0 END AS compound,
   CASE WHEN ps + abs(ns) + neu > 0 THEN round(abs(ps / (ps + abs(ns) + neu))::DECIMAL(20,10), 3)::DOUBLE ELSE 0.0 END AS pos,
   CASE WHEN ps + abs(ns) + neu > 0 THEN round(abs(ns / (ps + abs(ns) + neu))::DECIMAL(20,10), 3)::DOUBLE ELSE 0.0 END AS neg FROM {p}_fin)"""


def _first_state(src: str) -> str:
    return f"""(SELECT p.id, arg_min(n.n_name, n.n_nationkey) AS state
   FROM {src} p JOIN nation n ON p.user_location <> '' AND contains(p.user_location, n.n_name) GROUP BY p.id)"""


LABELLED = f"""WITH {POSTS}, {LEX},
en AS (SELECT * FROM posts WHERE lang = 'en'),
located AS (SELECT en.*, st.state FROM en JOIN {_first_state('en')} st USING (id)),
sc AS {_scores('located', 'full_text')},
scored AS (SELECT located.*, {_compound('sc.s')} AS compound FROM located LEFT JOIN sc ON sc.sid = located.id),
nz AS (SELECT * FROM scored WHERE compound <> 0),
cl AS (SELECT *, regexp_matches(full_text, '(?i){TOPIC_A}') AS ta, regexp_matches(full_text, '(?i){TOPIC_B}') AS tb,
              {_class_case('compound')} AS cls FROM nz),
lab AS (SELECT *, (CASE WHEN ta AND tb THEN 'TB' WHEN ta AND NOT tb THEN 'T' WHEN NOT ta AND tb THEN 'B'
                        WHEN NOT ta AND NOT tb THEN 'N' END) || cls AS label FROM cl)"""

STATES = "states AS (SELECT n_nationkey AS ord, n_name AS name FROM nation)"


def _kw_regex(words) -> str:
    alt = "|".join(words)
    return rf"(?i)(^|[^\p{{L}}\p{{N}}_])({alt})([^\p{{L}}\p{{N}}_]|$)"


MESSAGES = r"""msgs AS (SELECT event_id AS id, CASE event_type
   WHEN 'view' THEN '{"id":' || event_id || ',"in_reply_to_status_id":null,"text":"view k' ||
                    regexp_replace(props, '[^0-9]', '', 'g') || ' by user' || user_id || '"}'
   WHEN 'error' THEN '{"delete":{"status":{"id":' || event_id || ',"user_id":' || user_id || '}}}'
   WHEN 'signup' THEN '{"limit":{"track":' || user_id || '}}'
   WHEN 'purchase' THEN '{"warning":{"code":"FALLING_BEHIND","message":"queue ' || user_id || '"}}'
   ELSE '{"event":"' || event_type || '","id":' || event_id || '}' END AS value FROM events),
routed AS (SELECT id, value, CASE WHEN contains(value, 'in_reply_to_status') THEN 'status'
   WHEN contains(value, 'delete') THEN 'delete' WHEN contains(value, 'limit') THEN 'limit'
   WHEN contains(value, 'warning') THEN 'warning' ELSE 'ignored' END AS kind FROM msgs)"""

FEATS = """feats AS (SELECT event_id, value AS f_value, user_id::DOUBLE AS f_user, hour(ts)::DOUBLE AS f_hour FROM events),
z AS (SELECT event_id,
   CASE WHEN stddev_pop(f_value) OVER () = 0 THEN 0.0 ELSE (f_value - avg(f_value) OVER ()) / stddev_pop(f_value) OVER () END AS f_value,
   CASE WHEN stddev_pop(f_user) OVER () = 0 THEN 0.0 ELSE (f_user - avg(f_user) OVER ()) / stddev_pop(f_user) OVER () END AS f_user,
   CASE WHEN stddev_pop(f_hour) OVER () = 0 THEN 0.0 ELSE (f_hour - avg(f_hour) OVER ()) / stddev_pop(f_hour) OVER () END AS f_hour
   FROM feats)"""

ELBOW = """WITH mm AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
rep AS (SELECT l.l_quantity AS x, k.range::INT AS k FROM lineitem l CROSS JOIN range(1, 11) k),
binned AS (SELECT k, least(floor((x - mm.lo) / (CASE WHEN mm.hi = mm.lo THEN 1.0 ELSE mm.hi - mm.lo END) * k), k - 1) AS bin, x
           FROM rep, mm),
sse AS (SELECT k, sum(ss) AS sse FROM (SELECT k, bin, var_pop(x) * count(x) AS ss FROM binned GROUP BY k, bin) GROUP BY k),
nrm AS (SELECT k, sse, (k - min(k) OVER ()) / (max(k) OVER () - min(k) OVER ()) AS x,
               (sse - min(sse) OVER ()) / (max(sse) OVER () - min(sse) OVER ()) AS yn,
               row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM sse),
dd AS (SELECT *, (1.0 - yn) - x AS d FROM nrm),
ext AS (SELECT *, lag(d) OVER (ORDER BY k) AS dp, lead(d) OVER (ORDER BY k) AS dn FROM dd),
fl AS (SELECT *, d >= coalesce(dp, d) AND d >= coalesce(dn, d) AS is_max,
                 d <= coalesce(dp, d) AND d <= coalesce(dn, d) AS is_min FROM ext),
run AS (SELECT *, max(CASE WHEN is_max THEN i END) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS lm,
                  max(CASE WHEN is_min THEN i END) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS ln,
                  last_value(CASE WHEN is_max THEN d - 1.0 / (n - 1) END IGNORE NULLS)
                    OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS thr_max FROM fl),
fire AS (SELECT *, lm IS NOT NULL AND dn IS NOT NULL AND
                dn < (CASE WHEN ln IS NOT NULL AND ln >= lm THEN 0.0 ELSE thr_max END) AS f FROM run),
knee AS (SELECT lm AS ki FROM fire WHERE f ORDER BY i LIMIT 1)
SELECT k, round(sse, 2) AS sse, coalesce(i = (SELECT ki FROM knee), false) AS is_elbow FROM fire"""


def oracle_sql() -> dict[str, str]:
    q = {}
    q["label_counts_by_state"] = f"""{LABELLED}
SELECT state, label, count(user_id) AS n FROM lab WHERE state IS NOT NULL AND label IS NOT NULL GROUP BY state, label"""

    q["flatten_props"] = """SELECT event_id AS id, date_trunc('second', ts) AS created_at, event_type AS lang,
  user_id AS user_id, NULL::VARCHAR AS user_location, json_extract(props, '$.k')::BIGINT AS props_k,
  NULL::VARCHAR AS props_absent, NULL::VARCHAR AS lang_deeper FROM events"""

    q["first_text"] = """WITH c AS (SELECT conv_id,
    arg_max(text, turn) FILTER (role = 'assistant') AS reply, string_agg(text, chr(10) ORDER BY turn, text) FILTER (role = 'user') AS said
  FROM conversations GROUP BY conv_id)
SELECT e.event_id AS id, strlen(coalesce(c.reply, c.said, d.text)) AS n_bytes, md5(coalesce(c.reply, c.said, d.text)) AS text_md5
FROM events e LEFT JOIN c ON c.conv_id = e.user_id LEFT JOIN documents d ON d.doc_id = e.event_id"""
    q["schema_drift"] = """WITH e AS (SELECT count(*) AS n, count(*) FILTER (event_type = 'view') AS views,
    count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (json_extract(props, '$.k') IS NULL) AS odd FROM events)
SELECT 'user-id' AS path, 'string' AS declared, 'bigint' AS found, 'changed' AS drift FROM e WHERE n > 0
UNION ALL SELECT 'props-absent', 'string', NULL, 'missing' FROM e WHERE n > 0
UNION ALL SELECT 'place-name', 'string', NULL, 'missing' FROM e WHERE n > 0
UNION ALL SELECT 'score', 'double', 'variant', 'changed' FROM e WHERE views > 0 AND errors > 0
UNION ALL SELECT 'flags-kept', NULL, 'boolean', 'new' FROM e WHERE views > 0
UNION ALL SELECT 'created_at', NULL, 'string', 'new' FROM e WHERE n > 0"""
    q["store_between_times"] = """SELECT event_id AS id, date_trunc('second', ts) AS created_at, event_type AS lang, user_id FROM events
WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-04 23:00:00' AND date_trunc('second', ts) < TIMESTAMP '2024-01-20 12:00:00'"""

    q["preview_posts"] = f"""WITH {POSTS} SELECT id, lang, user_location FROM posts WHERE lang = 'en' ORDER BY id LIMIT 5"""

    q["between_times"] = """SELECT event_id, ts, user_id FROM events
WHERE ts > TIMESTAMP '2024-01-04 23:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'"""

    q["keep_lang"] = "SELECT doc_id, lang, source FROM documents WHERE lang = 'en'"

    q["track_keywords"] = f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{_kw_regex(TRACK_WORDS)}')"
    q["track_keywords_ref"] = ("SELECT doc_id FROM documents WHERE regexp_matches(text || CASE lang WHEN 'en' THEN ' @JoeBiden!' "
                               "WHEN 'de' THEN ' a trumpet' ELSE '' END, '"
                               + _kw_regex(["biden", "trump", "JoeBiden", "realDonaldTrump"]) + "')")

    q["topic_flags"] = f"""WITH {POSTS} SELECT id,
  regexp_matches(full_text, '(?i){TOPIC_A}') AS full_text_topic_a, regexp_matches(full_text, '(?i){TOPIC_B}') AS full_text_topic_b,
  regexp_matches(user_description, '(?i){TOPIC_A}') AS user_description_topic_a,
  regexp_matches(user_description, '(?i){TOPIC_B}') AS user_description_topic_b FROM posts"""

    sent = f"""WITH {POSTS}, {LEX},
s1 AS {_scores('posts', 'full_text', name='s')},
s2 AS {_scores('posts', 'user_description', name='s')}
SELECT p.id, {_compound('s1.s')} AS full_text_sentiment_compound,
       {_compound('s2.s')} AS user_description_sentiment_compound
FROM posts p LEFT JOIN s1 ON s1.sid = p.id LEFT JOIN s2 ON s2.sid = p.id"""
    q["sentiment_scores"] = sent
    q["drop_zero"] = f"SELECT * FROM ({sent}) WHERE full_text_sentiment_compound <> 0"

    q["sentiment_struct"] = f"""WITH {LEX},
docs AS (SELECT doc_id AS id, text FROM documents),
toks AS (SELECT id, unnest(string_split_regex(lower(coalesce(text, '')), '[^a-z]+')) AS token FROM docs),
agg AS (SELECT t.id, count(*) FILTER (WHERE t.token <> '') AS n_tok,
          sum(l.valence::DECIMAL(18,6))::DOUBLE AS s,
          coalesce(sum(CASE WHEN l.valence > 0 THEN l.valence::DECIMAL(18,6) + 1 END), 0)::DOUBLE AS ps,
          coalesce(sum(CASE WHEN l.valence < 0 THEN l.valence::DECIMAL(18,6) - 1 END), 0)::DOUBLE AS ns,
          count(l.token) FILTER (WHERE l.valence <> 0) AS hits
        FROM toks t LEFT JOIN lex l ON t.token = l.token GROUP BY t.id),
tot AS (SELECT id, s, ps, ns, (n_tok - hits)::DOUBLE AS neu, ps + abs(ns) + (n_tok - hits) AS total FROM agg)
SELECT id, CASE WHEN total > 0 THEN round(abs(ns / total)::DECIMAL(20,10), 3)::DOUBLE ELSE 0.0 END AS neg,
           CASE WHEN total > 0 THEN round(abs(neu / total)::DECIMAL(20,10), 3)::DOUBLE ELSE 0.0 END AS neu,
           CASE WHEN total > 0 THEN round(abs(ps / total)::DECIMAL(20,10), 3)::DOUBLE ELSE 0.0 END AS pos,
           {_compound('s')} AS compound FROM tot"""

    q["sentiment_rules_posts"] = f"""WITH {POSTS}, {LEX}, {_rules('posts', 'id', 'full_text', 'a')},
{_rules('posts', 'id', 'user_description', 'b')}
SELECT p.id, a.compound AS full_text_sentiment_compound, a.pos AS full_text_pos, a.neg AS full_text_neg,
  b.compound AS user_description_sentiment_compound FROM posts p JOIN a_out a ON a.rid = p.id JOIN b_out b ON b.rid = p.id"""
    q["sentiment_turns"] = f"""WITH {LEX}, t AS (SELECT row_number() OVER () AS rid, conv_id, text FROM conversations),
s AS {_scores('t', 'text', 'rid')}, {_rules('t', 'rid', 'text', 'a')}
SELECT t.conv_id, {_compound('s.s')} AS turn_text_sentiment_compound, a.compound AS turn_text_sentiment_rules
FROM t LEFT JOIN s ON s.sid = t.rid JOIN a_out a ON a.rid = t.rid"""

    marked = ", ".join(f"('{t}', {v!r})" for t, v in [*TOY_LEXICON, *TOY_MARKS, ("kind", 1.5)])
    endings = " ".join(f"WHEN '{lang}' THEN '{e}'" for lang, e in TOY_ENDINGS.items())
    ended = f"""WITH lex(token, valence) AS (VALUES {marked}),
docs AS (SELECT doc_id AS id, text || CASE lang {endings} ELSE '' END AS text FROM documents)"""
    q["sentiment_idioms"] = f"""{ended}, {_rules('docs', 'id', 'text', 'a', idioms=TOY_IDIOMS)}
SELECT d.id, a.compound AS text_sentiment_compound, a.pos, a.neg FROM docs d JOIN a_out a ON a.rid = d.id"""
    q["sentiment_marks"] = f"""{ended},
toks AS (SELECT id, unnest(string_split_regex(lower(coalesce(text, '')), '[^a-z]+')) AS token FROM docs UNION ALL
  SELECT id, token FROM (SELECT id, unnest(string_split_regex(lower(coalesce(text, '')), '[ \\t\\n\\x0B\\f\\r]+')) AS token FROM docs)
  WHERE NOT regexp_full_match(token, '[a-z]*')),
s AS (SELECT id, sum(valence::DECIMAL(18,6))::DOUBLE AS s FROM toks JOIN lex USING (token) GROUP BY id)
SELECT id, {_compound('s')} AS text_sentiment_compound FROM docs LEFT JOIN s USING (id)"""

    q["classes_labels"] = f"""{LABELLED} SELECT id, cls AS full_text_sentiment_compound_class, label FROM lab"""
    q["topic_subsets"] = f"""{LABELLED} SELECT id, 'a_only' AS subset FROM lab WHERE ta AND NOT tb
UNION ALL SELECT id, 'b_only' AS subset FROM lab WHERE NOT ta AND tb"""

    us = ", ".join(f"({i}, '{n}', '{a}', '{metaphone(n)}')" for i, (n, a) in enumerate(US_STATES))
    q["state_matches_alt"] = f"""WITH us(ord, name, abbr, code) AS (VALUES {us}),
p AS (SELECT c_custkey AS id, c_name || ', ' || CASE c_custkey % 3 WHEN 0 THEN name WHEN 1 THEN abbr ELSE code END AS user_location
  FROM customer JOIN us ON c_custkey % 50 = ord)
SELECT id, user_location, name AS state, ord AS place FROM p JOIN us
  ON contains(user_location, name) OR contains(user_location, abbr) OR contains(user_location, code)"""

    q["state_first"] = f"""WITH {POSTS} SELECT p.id, st.state FROM posts p LEFT JOIN {_first_state('posts')} st USING (id)"""
    matches = f"""WITH {POSTS} SELECT p.id, n.n_name AS state FROM posts p JOIN nation n
ON p.user_location <> '' AND contains(p.user_location, n.n_name)"""
    q["state_matches"] = matches
    q["state_matches_join"] = matches

    q["gazetteer_state"] = f"""WITH {POSTS},
gz AS (SELECT c.c_name AS city, n.n_name AS state, c.c_acctbal::DOUBLE AS lat, c.c_nationkey::DOUBLE AS lon
       FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       UNION ALL SELECT n.n_name, r.r_name, n.n_nationkey::DOUBLE, n.n_regionkey::DOUBLE
       FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
w AS (SELECT id, list_filter(string_split_regex(coalesce(user_location, ''), '[\\s,;/|]+'), lambda x: x <> '') AS words
      FROM posts WHERE user_location IS NOT NULL AND user_location <> ''),
g0 AS (SELECT id, words, unnest(generate_series(1, len(words))) AS pos FROM w),
g AS (SELECT g0.id, g0.pos::INT AS pos, n.range::INT AS n,
             array_to_string(list_slice(g0.words, g0.pos, g0.pos + n.range - 1), ' ') AS gram
      FROM g0 CROSS JOIN range(1, (SELECT max(len(string_split_regex(city, '[\\s,;/|]+'))) + 1 FROM gz)) n WHERE g0.pos + n.range - 1 <= len(g0.words)),
best AS (SELECT g.id, arg_min(struct_pack(st := gz.state, la := gz.lat, lo := gz.lon),
                              struct_pack(p := g.pos, nn := -g.n, st := gz.state, la := gz.lat, lo := gz.lon)) AS b
         FROM g JOIN gz ON g.gram = gz.city GROUP BY g.id)
SELECT p.id, best.b.st AS state2, best.b.la AS lat, best.b.lo AS lon FROM posts p LEFT JOIN best USING (id)"""

    q["state_from_address"] = """SELECT c.c_custkey AS id,
  nullif(regexp_extract(CASE WHEN c.c_mktsegment = 'BUILDING' THEN n.n_name || ', United States'
    ELSE concat_ws(', ', c.c_name, c.c_mktsegment, n.n_name, 'United States') END, ', .*, (.*), United States', 1), '') AS state
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

    ss = f"""{LABELLED}, {STATES},
agg AS (SELECT state, count(compound) AS compound_count, avg(compound) AS compound_mean,
        stddev_samp(compound) AS compound_std FROM lab WHERE state IS NOT NULL GROUP BY state)
SELECT s.ord, s.name, a.compound_count, a.compound_mean, a.compound_std FROM states s LEFT JOIN agg a ON s.name = a.state"""
    q["state_sentiment"] = ss
    q["state_sentiment_mainland"] = f"SELECT * FROM ({ss}) WHERE NOT coalesce(name IN ('NATION_0', 'NATION_1'), false)"

    maj = f"""{LABELLED}, {STATES},
cnt AS (SELECT state, label, count(user_id) AS c FROM lab WHERE state IS NOT NULL AND label IS NOT NULL GROUP BY state, label),
mx AS (SELECT state, arg_min(label, struct_pack(a := -c, b := label)) AS cluster_max_label FROM cnt GROUP BY state)"""
    q["majority_label"] = f"""{maj}
SELECT s.ord, s.name, m.cluster_max_label FROM states s LEFT JOIN mx m ON s.name = m.state"""

    q["describe_by_state"] = f"""{LABELLED}
SELECT state, count(compound) AS c_count, avg(compound) AS c_mean, stddev_samp(compound) AS c_std,
  min(compound) AS c_min, quantile_cont(compound, 0.25) AS c_p25, quantile_cont(compound, 0.5) AS c_p50,
  quantile_cont(compound, 0.75) AS c_p75, max(compound) AS c_max FROM lab WHERE state IS NOT NULL GROUP BY state"""

    q["describe_prices"] = """WITH p AS (SELECT l_returnflag, l_linestatus, l_extendedprice::DOUBLE AS x FROM lineitem)
SELECT l_returnflag, l_linestatus, count(x) AS c_count, avg(x) AS c_mean, stddev_samp(x) AS c_std, min(x) AS c_min,
  quantile_cont(x, 0.25) AS c_p25, quantile_cont(x, 0.5) AS c_p50, quantile_cont(x, 0.75) AS c_p75, max(x) AS c_max
FROM p WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY ALL"""

    q["value_counts_label"] = f"""{LABELLED} SELECT label, count(*) AS n FROM lab WHERE label IS NOT NULL GROUP BY label"""
    q["n_unique_label"] = f"""{LABELLED} SELECT count(DISTINCT label) AS n_unique FROM lab"""

    q["histogram_compound"] = f"""{LABELLED},
sub AS (SELECT 0 AS sub, compound AS x FROM lab UNION ALL SELECT 1, compound FROM lab WHERE coalesce(ta AND NOT tb, false)
        UNION ALL SELECT 2, compound FROM lab WHERE coalesce(NOT ta AND tb, false)),
r0 AS (SELECT sub, min(x) AS lo0, max(x) AS hi0 FROM sub WHERE x IS NOT NULL GROUP BY sub),
rng AS (SELECT sub, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0),
cnt AS (SELECT s.sub, least(floor((s.x - r.lo) / (r.hi - r.lo) * 20), 19)::INT AS bin, count(*) AS n
        FROM sub s JOIN rng r USING (sub) WHERE s.x IS NOT NULL GROUP BY ALL),
grid AS (SELECT r.sub, r.lo, r.hi, b.range::INT AS bin FROM rng r CROSS JOIN range(20) b)
SELECT CASE g.sub WHEN 0 THEN 'all' WHEN 1 THEN 'a_only' ELSE 'b_only' END AS subset, g.bin,
  g.lo + g.bin * ((g.hi - g.lo) / 20) AS lo_edge, g.lo + (g.bin + 1) * ((g.hi - g.lo) / 20) AS hi_edge,
  coalesce(c.n, 0) AS n FROM grid g LEFT JOIN cnt c USING (sub, bin)"""

    q["ratios"] = f"""WITH {POSTS}, st AS {_first_state('posts')}
SELECT count(*) AS n_rows, round_even(100.0::DOUBLE * count(*) FILTER (WHERE lang IS DISTINCT FROM 'en') / count(*), 0) AS pct_non_lang,
  count(user_description) / count(*) AS share_place, count(st.state) / count(*) AS share_state
FROM posts p LEFT JOIN st USING (id)"""

    q["retention"] = f"""{LABELLED}
SELECT (SELECT count(*) FROM posts) AS n_initial, (SELECT count(*) FROM lab) AS n_final,
  100.0::DOUBLE * (SELECT count(*) FROM lab) / (SELECT count(*) FROM posts) AS pct_kept"""

    q["shape_posts"] = f"WITH {POSTS} SELECT count(*) AS n_rows, 7 AS n_cols FROM posts"

    q["states_with_posts"] = f"""{LABELLED}, {STATES}
SELECT ord, name FROM states WHERE name IN (SELECT state FROM lab WHERE state IS NOT NULL)"""
    q["states_without_posts"] = f"""{LABELLED}, {STATES}
SELECT ord, name FROM states WHERE name NOT IN (SELECT state FROM lab WHERE state IS NOT NULL)"""

    q["union_states"] = """SELECT n_nationkey AS ord, n_name AS name, n_regionkey AS region FROM nation
UNION ALL SELECT r_regionkey, r_name, r_regionkey FROM region"""

    q["hist_paths"] = f"""{LABELLED}, {STATES}
SELECT s.ord, s.name, CASE WHEN s.name IN (SELECT state FROM lab WHERE state IS NOT NULL)
  THEN 'image/hist_label/hist_label_' || s.name || '.jpg' ELSE 'No data' END AS hist_label FROM states s"""

    q["map_feed"] = f"""{maj},
f AS (SELECT s.ord::VARCHAR AS ord, s.name, coalesce(m.cluster_max_label, 'No data') AS cluster_max_label
      FROM states s LEFT JOIN mx m ON s.name = m.state)
SELECT *, (SELECT count(DISTINCT cluster_max_label) FROM f) AS n_fill FROM f"""

    ring = "'[[[0,0],[' || ord || ',0],[' || ord || ',1.5],[0,0]],[[0.1,0.1],[0.2,0.1],[0.2,0.2],[0.1,0.1]]]'"
    q["map_feed_geojson"] = f"""{maj.replace("WHERE state IS NOT NULL AND label", "WHERE state <> 'NATION_0' AND label")},
f AS (SELECT s.ord, s.name, coalesce(m.cluster_max_label, 'No data') AS fill FROM states s LEFT JOIN mx m ON s.name = m.state)
SELECT name, '{{"type":"Feature","geometry":' || CASE ord % 4 WHEN 0 THEN '{{"type":"Point","coordinates":[' || ord || ',-0.5]}}'
    WHEN 1 THEN '{{"type":"Polygon","coordinates":' || {ring} || '}}'
    WHEN 2 THEN '{{"type":"MultiPolygon","coordinates":[' || {ring} || ',[[[5,5],[6,5],[6,6],[5,5]]]]}}' ELSE 'null' END
  || ',"properties":{{"ord":"' || ord || '","name":"' || name || '","cluster_max_label":"' || fill || '","n_fill":'
  || (SELECT count(DISTINCT fill) FROM f) || '}}}}' AS feature FROM f"""

    q["standardize_events"] = f"WITH {FEATS} SELECT * FROM z"
    q["kmeans_events"] = f"""WITH RECURSIVE {FEATS},
x AS MATERIALIZED (SELECT event_id, f_value AS a, f_user AS b, f_hour AS c FROM z),
seeds AS (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY md5(event_id::VARCHAR || ':20:' || r::VARCHAR), a, b, c) AS j, a, b, c
  FROM x, (SELECT unnest(generate_series(0, 9)) AS r)),
it AS (
  SELECT 0 AS step, r, true AS moving, j, a, b, c FROM seeds WHERE j <= 4
  UNION ALL
  SELECT step, r, sum((a - oa) * (a - oa) + (b - ob) * (b - ob) + (c - oc) * (c - oc)) OVER (PARTITION BY r) > 1e-4::DOUBLE, j, a, b, c FROM (
    SELECT o.step + 1 AS step, o.r, o.j, o.a AS oa, o.b AS ob, o.c AS oc, coalesce(n.a, o.a) AS a, coalesce(n.b, o.b) AS b, coalesce(n.c, o.c) AS c
    FROM it o LEFT JOIN (
      SELECT r, j, avg(a) AS a, avg(b) AS b, avg(c) AS c FROM (
        SELECT m.r, x.event_id, any_value(x.a) AS a, any_value(x.b) AS b, any_value(x.c) AS c,
          arg_min(m.j, (x.a - m.a) * (x.a - m.a) + (x.b - m.b) * (x.b - m.b) + (x.c - m.c) * (x.c - m.c)) AS j
        FROM x, it m WHERE m.moving GROUP BY m.r, x.event_id) GROUP BY r, j) n ON n.r = o.r AND n.j = o.j
    WHERE o.moving AND o.step < 300)),
fin AS (SELECT * FROM it QUALIFY step = max(step) OVER (PARTITION BY r)),
cost AS (
  SELECT r, sum(d) AS cost FROM (
    SELECT f.r, x.event_id, min((x.a - f.a) * (x.a - f.a) + (x.b - f.b) * (x.b - f.b) + (x.c - f.c) * (x.c - f.c)) AS d
    FROM x, fin f GROUP BY f.r, x.event_id) GROUP BY r),
best AS (
  SELECT row_number() OVER (ORDER BY a, b, c) - 1 AS k, a, b, c FROM fin
  WHERE r = (SELECT min(r) FROM cost WHERE cost <= (SELECT min(cost) FROM cost) * (1 + 1e-12)))
SELECT x.event_id, CAST(arg_min(k, (x.a - best.a) * (x.a - best.a) + (x.b - best.b) * (x.b - best.b) + (x.c - best.c) * (x.c - best.c)) AS INTEGER) AS cluster
FROM x, best GROUP BY x.event_id"""
    q["assign_clusters"] = f"""WITH {FEATS},
c(cid, cv, cu, ch) AS (VALUES (0, -1.0, -1.0, 0.0), (1, -1.0, 1.0, 0.5), (2, 1.0, -1.0, -0.5), (3, 1.0, 1.0, 0.0)),
d AS (SELECT z.event_id, c.cid, (z.f_value - c.cv) * (z.f_value - c.cv) + (z.f_user - c.cu) * (z.f_user - c.cu)
        + (z.f_hour - c.ch) * (z.f_hour - c.ch) AS dist FROM z, c)
SELECT event_id, arg_min(cid, struct_pack(a := dist, b := cid))::INT AS cluster FROM d GROUP BY event_id"""
    q["sse_k1"] = f"""WITH {FEATS}
SELECT 1 AS k, round(var_pop(f_value) * count(f_value) + var_pop(f_user) * count(f_user)
  + var_pop(f_hour) * count(f_hour), 4) AS sse FROM z"""
    q["elbow_lineitem"] = ELBOW

    q["route_messages"] = f"WITH {MESSAGES} SELECT id, kind FROM routed"
    q["delete_notices"] = f"""WITH {MESSAGES} SELECT json_extract(value, '$.delete.status.id')::BIGINT AS status_id,
  json_extract(value, '$.delete.status.user_id')::BIGINT AS user_id FROM routed WHERE kind = 'delete'"""
    q["missed_counter"] = f"""WITH {MESSAGES} SELECT max(json_extract(value, '$.limit.track')::BIGINT) AS missed,
  count(*) AS n_notices FROM routed WHERE kind = 'limit'"""
    q["warning_messages"] = f"""WITH {MESSAGES} SELECT id, coalesce(json_extract_string(value, '$.warning.message'),
  json_extract_string(value, '$.warnings.message')) AS message FROM routed WHERE kind = 'warning'"""
    q["capture_filter"] = f"""WITH {MESSAGES} SELECT id FROM routed WHERE kind = 'status'
  AND regexp_matches(json_extract_string(value, '$.text'), '{_kw_regex(TRACK_WORDS_CAPTURE)}')"""
    q["stream_message_totals"] = f"""WITH {MESSAGES} SELECT kind, count(*) AS n,
  max(CASE WHEN kind = 'limit' THEN json_extract(value, '$.limit.track')::BIGINT END) AS missed FROM routed GROUP BY kind"""
    q["stream_capture_rolling"] = """WITH c AS (SELECT 3 * count(*) // 4 AS nb FROM events WHERE event_type = 'view')
SELECT k AS number, least(200, nb - 200 * k) AS n FROM (SELECT unnest(generate_series(0, nb // 200)) AS k, nb FROM c) WHERE nb > 200 * k"""
    return q
