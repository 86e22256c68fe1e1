"""DuckDB twins of the registered queries that SQL can express."""

PREFERENCES = """
WITH t AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS items
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
l AS (
  SELECT conv_id, items, list_filter(generate_series(1, len(items)), lambda i: items[i].role = 'assistant') AS places FROM t),
c AS (
  SELECT *, list_transform(places, lambda i: items[i]) AS answers, coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS next
  FROM l WHERE len(places) > 0),
e AS (SELECT conv_id, next, items, unnest(places) AS place, unnest(generate_series(1, len(places))) AS answer_no FROM c),
p AS (
  SELECT a.conv_id AS pair_id, CAST(a.answer_no AS INTEGER) AS answer_no, a.items AS chosen,
         list_concat(a.items[1:place - 1], [b.answers[(a.answer_no - 1) % len(b.answers) + 1]], a.items[place + 1:]) AS rejected
  FROM e a JOIN c b ON a.next = b.conv_id),
n AS (
  SELECT *, coalesce(list_min(list_filter(generate_series(1, least(len(chosen), len(rejected))),
                                          lambda i: chosen[i] IS DISTINCT FROM rejected[i])) - 1,
                     least(len(chosen), len(rejected))) AS k
  FROM p),
r AS (
  SELECT pair_id, answer_no, k, chosen[1:k] AS shared, chosen[k + 1:] AS a, rejected[k + 1:] AS b FROM n),
s AS (
  SELECT pair_id, answer_no, k,
    list_transform(shared, lambda x: '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || '<|end|>' || chr(10)) AS p,
    list_transform(a, lambda x: '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || '<|end|>' || chr(10)) AS a, a AS turns_a,
    list_transform(b, lambda x: '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || '<|end|>' || chr(10)) AS b, b AS turns_b
  FROM r)
SELECT pair_id, answer_no, CAST(k AS INTEGER) AS prompt_turns, array_to_string(p, '') AS prompt,
  array_to_string(a, '') AS chosen_text,
  array_to_string(list_transform(list_filter(generate_series(1, len(a)), lambda i: turns_a[i].role = 'assistant'),
    lambda i: CAST(coalesce(list_sum(list_transform(a[1:i - 1], lambda y: length(y))), 0) + 14 AS BIGINT) || '-'
      || CAST(list_sum(list_transform(a[1:i], lambda y: length(y))) - 1 AS BIGINT)), ',') AS chosen_mask,
  array_to_string(b, '') AS rejected_text,
  array_to_string(list_transform(list_filter(generate_series(1, len(b)), lambda i: turns_b[i].role = 'assistant'),
    lambda i: CAST(coalesce(list_sum(list_transform(b[1:i - 1], lambda y: length(y))), 0) + 14 AS BIGINT) || '-'
      || CAST(list_sum(list_transform(b[1:i], lambda y: length(y))) - 1 AS BIGINT)), ',') AS rejected_mask
FROM s
"""

URL_PARTS = """
  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest"""

URL_RULES = rf"""
WITH u AS (SELECT page_id, url, {URL_PARTS} FROM pages),
v AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '') AS args
  FROM u),
w AS (
  SELECT *, list_sort(list_distinct(list_concat(
      list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
      list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'p:' || x),
      list_transform(list_filter(list_transform(string_split(args, '&'), lambda x: regexp_extract(x, '^[^=]*')), lambda x: x <> ''), lambda x: 'q:' || x)))) AS tokens
  FROM v),
labelled AS (
  SELECT tokens, (toxic = 1 OR quality = 0) AS bad FROM w JOIN labels ON page_id = doc_id
  WHERE len(tokens) > 0 AND (toxic = 1 OR quality = 0) IS NOT NULL),
sets AS (
  SELECT list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS tokens, bad
  FROM (SELECT tokens, bad, unnest(generate_series(1, (1 << len(tokens)) - 1)) AS mask FROM labelled)),
rules AS (
  SELECT tokens FROM sets GROUP BY tokens
  HAVING count(*) FILTER (bad) >= greatest(5, ceil(0.002 * (SELECT count(*) FROM labelled)))
     AND count(*) FILTER (bad) >= 0.5 * count(*)),
hits AS (SELECT DISTINCT url FROM w, rules WHERE list_has_all(w.tokens, rules.tokens)),
e AS (
  SELECT page_id, url, host, path, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM w)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN hits.url IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  hits.url IS NOT NULL AS mined
FROM e LEFT JOIN hits ON e.url = hits.url
"""


def _repeated(length: int, key: str) -> str:
    """Whether the window of ``length`` words at a place occurs twice in its text."""
    return f"(i + {length - 1} <= n AND count(*) OVER (PARTITION BY doc_id, {key}, i + {length - 1} <= n) > 1)"


QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM d),
h1 AS (SELECT *, hash(word) AS a FROM p),
h2 AS (SELECT *, hash(a, lead(a, 1) OVER o) AS a2 FROM h1 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h4 AS (SELECT *, hash(a2, lead(a2, 2) OVER o) AS a4 FROM h2 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h5 AS (SELECT *, hash(a4, lead(a, 4) OVER o) AS a5 FROM h4 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h10 AS (SELECT *, hash(a5, lead(a5, 5) OVER o) AS a10 FROM h5 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h20 AS (SELECT *, hash(a10, lead(a10, 10) OVER o) AS a20 FROM h10 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h40 AS (SELECT *, hash(a20, lead(a20, 20) OVER o) AS a40 FROM h20 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h51 AS (SELECT *, hash(a40, lead(a40, 11) OVER o) AS a51 FROM h40 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, {_repeated(5, "a5")} AS r5, {_repeated(10, "a10")} AS r10, {_repeated(51, "a51")} AS r51 FROM h51),
c AS (
  SELECT doc_id, r51, max(r5) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c5,
    max(r10) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS c10
  FROM r),
s AS (SELECT doc_id, count(*) FILTER (c5) AS n5, count(*) FILTER (c10) AS n10, bool_or(r51) AS long FROM c GROUP BY doc_id),
b AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d)
SELECT b.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n5, 0) AS n_repeat_words, coalesce(n10, 0) AS n_covered_words,
  (n_words < 10 OR 100 * coalesce(n5, 0) > 20 * n_words) AS base_failed,
  (NOT (n_words < 10 OR 100 * coalesce(n5, 0) > 20 * n_words) AND coalesce(n10, 0) <= CAST(0.1 AS DOUBLE) * n_words AND NOT coalesce(long, false)) AS kept
FROM b LEFT JOIN s ON b.doc_id = s.doc_id
"""

LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RANKED = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
q AS (
  SELECT item_id, text, unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
qt AS (SELECT item_id, text, term, count(*) AS times FROM q GROUP BY ALL),
s AS (SELECT count(*) AS n, sum(len(words))::BIGINT AS total FROM d WHERE len(words) > 0),
t AS (SELECT row, doc_id, len(words) AS size, unnest(words) AS term FROM d),
p AS (SELECT row, doc_id, size, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM p, s GROUP BY term, n),
r AS (
  SELECT item_id, text, row, doc_id,
    CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * n) // total)))) AS BIGINT) AS score
  FROM qt JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, text, row, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20
"""

LEAKS = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, coalesce(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents),
i AS (SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
k AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size,
    unnest(list_transform(generate_series(1, len(words) - least(len(words), 10) + 1),
      lambda x: array_to_string(words[x:x + least(len(words), 10) - 1], ' '))) AS gram
  FROM i WHERE len(words) > 0),
g AS (
  SELECT row, z.size, unnest(generate_series(1, len(words) - z.size + 1)) AS pos, words
  FROM d, (SELECT DISTINCT size FROM k) z WHERE len(words) >= z.size),
h AS (SELECT g.row, g.pos, g.size, k.item_id FROM (SELECT row, size, pos, array_to_string(words[pos:pos + size - 1], ' ') AS gram FROM g) g JOIN k USING (gram, size)),
c AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(generate_series(pos, pos + size - 1)) AS place FROM h) GROUP BY row),
m AS (SELECT row, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS items FROM h WHERE item_id IS NOT NULL GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (row) LEFT JOIN m USING (row)
"""

SQL: dict[str, str] = {"op2_preference_pairs": PREFERENCES, "op8_url_rules": URL_RULES, "op9_suffix_repeats": QUALITY, "op11_ranked_search": RANKED, "op13_benchmark_automaton": LEAKS}
