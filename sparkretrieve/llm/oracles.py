"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from sparkretrieve.llm import sharding, url_filter
from sparkretrieve.llm.queries import SHARDS, SLOTS, URL_RULES

# White space and letters of the contracts.
_WS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP7 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP8 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k
  FROM documents),
keyed AS (SELECT *, translate(trim(line, {_WS}), '{_UP}', '{_LOW}') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT keyed.*, (repeated.key IS NOT NULL AND doc_id <> keeper) AS gone
  FROM keyed LEFT JOIN repeated ON keyed.key = repeated.key)
SELECT doc_id, count(*) AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _op2() -> str:
    order, folds, step = url_filter.MAX_ORDER, url_filter.HELD_OUT_FOLDS, url_filter.BIN
    fits = [(text, action, f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))")
            for action, text in sorted(URL_RULES, key=lambda r: -len(r[1]))
            for h, p in [(text[:text.index("/")], text[text.index("/"):])]]
    rule = " ".join(f"WHEN {f} THEN '{t}'" for t, _, f in fits)
    action = " ".join(f"WHEN {f} THEN '{a}'" for _, a, f in fits)
    levels = []
    for j in range(order + 1):
        even = "(1.0::DOUBLE / (count(*) OVER c))"
        la, lr = (even, even) if j == 0 else ("lo.pa", "lo.pr")
        join = "" if j == 0 else f"JOIN p{j - 1} lo ON lo.g = substr(l.g, 2)"
        levels.append(f"""
l{j} AS (SELECT substr(gram, {order + 1 - j}) AS g, sum(a)::DOUBLE AS a, sum(r)::DOUBLE AS r
  FROM counts GROUP BY 1),
q{j} AS (SELECT l.g, a, r, sum(a) OVER c AS na, sum(r) OVER c AS nr,
    (count(*) FILTER (WHERE a > 0) OVER c)::DOUBLE AS ta, (count(*) FILTER (WHERE r > 0) OVER c)::DOUBLE AS tr,
    {la}::DOUBLE AS la, {lr}::DOUBLE AS lr
  FROM l{j} l {join} WINDOW c AS (PARTITION BY substr(l.g, 1, {j}))),
p{j} AS (SELECT g, CASE WHEN na + ta > 0 THEN (a + ta * la) / (na + ta) ELSE la END AS pa,
    CASE WHEN nr + tr > 0 THEN (r + tr * lr) / (nr + tr) ELSE lr END AS pr FROM q{j}),""")
    return f"""
WITH u AS (
  SELECT coalesce(url, '') AS url, count(*) AS copies,
         CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages GROUP BY coalesce(url, ''), 3),
parts AS (
  SELECT url, copies, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UP}', '{_LOW}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         ('0x' || substr(md5(url), 1, 8))::BIGINT % {folds} = 0 AS held_out
  FROM u),
urls AS (SELECT *, CASE {rule} END AS rule, CASE {action} END AS action FROM parts),
chars AS (SELECT url, action, held_out, copies, repeat(chr(2), {order}) || url || chr(3) AS s FROM urls),
grams AS (
  SELECT url, action, held_out, copies, substr(s, k, {order + 1}) AS gram
  FROM (SELECT *, unnest(range(1, length(s) - {order} + 1)) AS k FROM chars)),
counts AS (
  SELECT gram, sum(CASE WHEN action = 'allow' AND NOT held_out THEN copies ELSE 0 END) AS a,
         sum(CASE WHEN action = 'block' AND NOT held_out THEN copies ELSE 0 END) AS r
  FROM grams GROUP BY gram),{"".join(levels)}
deltas AS (SELECT g AS gram, round((ln(pa) - ln(pr)) * 1e6)::BIGINT AS delta FROM p{order}),
scored AS (
  SELECT url, action, held_out, copies, sum(delta)::BIGINT AS total, count(*) AS n,
         floor(sum(delta)::DOUBLE / (count(*) * {step}))::BIGINT AS bin
  FROM grams JOIN deltas USING (gram) GROUP BY url, action, held_out, copies),
bins AS (
  SELECT bin, sum(CASE WHEN action = 'allow' THEN copies ELSE 0 END)::DOUBLE AS a,
         sum(CASE WHEN action = 'block' THEN copies ELSE 0 END)::DOUBLE AS r
  FROM scored WHERE action IS NOT NULL AND held_out GROUP BY bin),
steps AS (
  SELECT bin, (sum(a) OVER o) - a AS lost, (sum(r) OVER ()) - (sum(r) OVER o) + r AS let,
         sum(a) OVER () AS na, sum(r) OVER () AS nr FROM bins WINDOW o AS (ORDER BY bin)),
best AS (
  SELECT bin AS threshold FROM steps WHERE na > 0 AND nr > 0
  ORDER BY lost / na + let / nr, abs(bin), bin LIMIT 1)
SELECT p.page_id, host, path, urls.rule,
       coalesce(urls.action, CASE WHEN bin >= coalesce((SELECT threshold FROM best), bin)
                             THEN 'allow' ELSE 'block' END) AS verdict,
       total::DOUBLE / n / 1e6::DOUBLE AS score
FROM pages p JOIN urls ON urls.url = coalesce(p.url, '') JOIN scored ON scored.url = urls.url
"""


def _op4() -> str:
    names = ", ".join(f"'{s}'" for s in SHARDS)
    slots = ", ".join(str(k + 1) for k in sharding.lookup_table(SHARDS, SLOTS))
    return f"""
WITH placed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot
  FROM documents)
SELECT doc_id, slot, ([{names}])[([{slots}])[slot + 1]] AS shard FROM placed
"""


OP12 = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM d)
  GROUP BY lang, term HAVING count(*) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
found AS (
  SELECT lang, source, term, count(*) AS n
  FROM (SELECT lang, source, unnest(words) AS term FROM d) JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, v, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total,
         sum(coalesce(n, 0)) OVER (PARTITION BY lang, term) AS n_lang, sum(coalesce(n, 0)) OVER (PARTITION BY lang) AS total_lang
  FROM groups JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN found USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 1)) // (total + v)::BIGINT AS p,
         (1 + (1000000000 * (n_lang + 1)) // (total_lang + v))::BIGINT AS q
  FROM cells),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "binary")::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


OP13 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> original THEN original END AS refers_to
FROM f
"""


ORACLES: dict[str, str] = {
    "op2_url_filter": _op2(),
    "op4_maglev_sharding": _op4(),
    "op7_exact_dedup": OP7,
    "op8_line_dedup": OP8,
    "op12_source_divergence": OP12,
    "op13_warc": OP13,
}
