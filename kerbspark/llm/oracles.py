"""SQL for the rows of those operators' queries that SQL can express."""

from .common import LOWER, UPPER
from .license_texts import TEMPLATES

_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _jump(name: str, shards: int) -> str:
    return f"""{name}(rid, k, b, j) AS (SELECT rid, CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END, -1::BIGINT, 0::BIGINT FROM d
 UNION ALL SELECT rid, k2, j, CAST(floor((j + 1) * (2147483648.0::DOUBLE / ((k2 // 8589934592)::DOUBLE + 1))) AS BIGINT) FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM {name} WHERE j < {shards}))"""


OP1 = f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
h AS (SELECT rid, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM d),
c AS (SELECT rid, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS crc FROM h, t),
{_jump("s8", 8)}, {_jump("s9", 9)},
a AS (SELECT d.doc_id, strlen(d.text) + 1 AS size, c.crc, CAST(x.b AS INTEGER) AS shard, CAST(y.b AS INTEGER) AS grown FROM d JOIN c USING (rid) JOIN s8 x ON x.rid = d.rid AND x.j >= 8 JOIN s9 y ON y.rid = d.rid AND y.j >= 9)
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY (coalesce(doc_id, 0) % 1024 + size % 1024 + crc % 1024) % 1024, doc_id NULLS FIRST, size, crc) - 1 AS slot, grown AS grown_shard FROM a"""


def _shingles(table: str, key: str) -> str:
    words = _WORDS.format(_LOW)
    return f"""SELECT DISTINCT {key} AS id, CASE WHEN n < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
 FROM (SELECT {key}, w, len(w) AS n, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM (SELECT {key}, {words} AS w FROM {table} WHERE {key} IS NOT NULL) WHERE len(w) > 0)"""


_ITEM_WORDS = _WORDS.format(_LOW)
#: Items of one to four words are one shingle, found wherever a document has these words one after the other.
OP4 = f"""WITH q AS ({_shingles("benchmark", "item_id")}), d AS ({_shingles("documents", "doc_id")}), n AS (SELECT id, count(*) AS n FROM q GROUP BY 1),
i AS (SELECT DISTINCT item_id, len(w) AS k, array_to_string(w, ' ') AS s FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) BETWEEN 1 AND 4),
r AS (SELECT DISTINCT doc_id AS id, k, array_to_string(w[j:j + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL) CROSS JOIN (SELECT DISTINCT k FROM i) WHERE len(w) >= k)),
f AS (SELECT d.id AS doc_id, q.id AS item_id, s FROM d JOIN q USING (s) UNION SELECT r.id, i.item_id, s FROM r JOIN i USING (k, s))
SELECT doc_id, item_id, n.n AS n_item, count(*) AS n_shared, count(*) / n.n AS containment FROM f JOIN n ON n.id = item_id GROUP BY 1, 2, 3 HAVING 100 * count(*) >= 75 * n.n"""

OP5 = r"""WITH p AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '""" + UPPER + "', '" + LOWER + r"""') AS host, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rhost, rpath, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(v, length(rhost || rpath)) AS v FROM h LEFT JOIN r ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY 1, 2, 3)
SELECT h.page_id, h.host, h.path, rule, coalesce(v, 'allow') AS verdict FROM h JOIN m ON m.page_id = h.page_id AND m.host = h.host AND m.path = h.path"""

OP7 = r"""WITH b AS (SELECT page_id AS p, url, md5(coalesce(html, '')) AS digest FROM pages),
r AS (SELECT p * 2 AS record_id, p, 'response' AS kind, url, TIMESTAMP '2024-01-01' + INTERVAL (p) MINUTE AS ts, '"' || digest[1:12] || '"' AS etag, digest FROM b
 UNION ALL SELECT p * 2 + 1, p, 'revisit', url || '#again', TIMESTAMP '2024-01-01' + INTERVAL (p + 120) MINUTE, CASE WHEN p % 15 = 0 THEN '"other"' WHEN p % 21 = 0 THEN NULL ELSE '"' || digest[1:12] || '"' END, CASE WHEN p % 21 != 0 THEN digest END FROM b WHERE p % 3 = 0),
u AS (SELECT *, strftime(TIMESTAMP '2024-01-01' + INTERVAL (p % 1000) MINUTE, '%Y-%m-%d %H:%M:%S') AS changed, regexp_replace(url, '(?s)#.*$', '') AS bare FROM r),
s AS (SELECT *, lower(regexp_extract(bare, '(?s)^(.*?)://', 1)) AS scheme, lower(regexp_extract(bare, '(?s)^.*?://([^/?]*)', 1)) AS host, regexp_extract(bare, '(?s)^.*?://[^/?]*(.*)$', 1) AS rest FROM u),
c AS (SELECT *, scheme || '://' || regexp_replace(CASE WHEN scheme = 'http' THEN regexp_replace(host, ':80$', '') WHEN scheme = 'https' THEN regexp_replace(host, ':443$', '') ELSE host END, '\.+$', '') || CASE WHEN starts_with(rest, '/') THEN '' ELSE '/' END || rest AS canonical_url FROM s),
l AS (SELECT *, last_value(CASE WHEN kind = 'response' THEN {'id': record_id, 'etag': etag, 'digest': digest, 'changed': changed, 'date': strftime(ts, '%Y-%m-%d %H:%M:%S')} END IGNORE NULLS) OVER (PARTITION BY canonical_url ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS src FROM c),
v AS (SELECT *, CASE WHEN kind = 'response' THEN 'response' WHEN src IS NULL THEN 'no_response' WHEN coalesce(etag != src.etag, false) OR coalesce(digest != src.digest, false) OR changed != src.changed THEN 'mismatch' ELSE 'resolved' END AS status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date FROM l)
SELECT record_id, p AS page_id, kind, canonical_url, CASE WHEN kind = 'revisit' THEN src.id END AS source_id, status,
 CASE WHEN kind = 'response' THEN 'content-type=text/html;date=' || date || ';etag=' || etag WHEN status = 'resolved' THEN 'content-type=text/html;date=' || date || ';etag=' || src.etag || ';expires=0' ELSE 'content-type=text/plain;date=' || date || ';expires=0' END AS headers FROM v"""



def _similar(percent: int, more: str) -> str:
    return f"""WITH RECURSIVE d AS ({_shingles("documents", "doc_id")}), n AS (SELECT id, count(*) AS n FROM d GROUP BY 1),
l AS (SELECT x.id AS a, y.id AS b FROM d x JOIN d y USING (s) JOIN n p ON p.id = x.id JOIN n q ON q.id = y.id WHERE x.id != y.id GROUP BY x.id, y.id, p.n, q.n HAVING 100 * count(*) >= {percent} * (p.n + q.n - count(*))),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), m AS (SELECT a, min(b) AS b FROM r GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(m.b, doc_id)) AS component_id{more} FROM documents LEFT JOIN n ON n.id = doc_id LEFT JOIN m ON m.a = doc_id"""


OP10 = _similar(75, ", doc_id = least(doc_id, coalesce(m.b, doc_id)) AS kept")
OP11 = _similar(80, "")

_ALNUM = r"regexp_extract_all(lower({}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TEXTS = ", ".join("('{}', '{}', '{}')".format(label, name, text.replace("'", "''")) for label, named in TEMPLATES.items() for name, text in named.items())

OP8 = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_ALNUM.format("coalesce(text, '')")} AS w FROM documents),
x(label, template, body) AS (VALUES {_TEXTS}), y AS (SELECT label, template, {_ALNUM.format("body")} AS w FROM x),
g AS (SELECT label, template, len(w) AS size, unnest(range(len(w) - 2)) AS t, w FROM y), h AS (SELECT label, template, size, t, w[t + 1] AS a, w[t + 2] AS b, w[t + 3] AS c FROM g),
p AS (SELECT rid, unnest(range(len(w))) AS i, w FROM d), r AS (SELECT rid, i, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM p),
o AS (SELECT rid, i, CASE WHEN a = 'mit' AND b = 'license' THEN 'mit' WHEN a = 'apache' AND b = 'license' THEN 'apache' WHEN a = 'general' AND b = 'public' AND c = 'license' THEN 'gpl' END AS label FROM r),
base AS (SELECT rid, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM o WHERE label IS NOT NULL GROUP BY 1),
v AS (SELECT rid, label, template, size, i - t AS diagonal, list(DISTINCT t) AS ts, min(i) AS lo, max(i) AS hi FROM r JOIN h USING (a, b, c) GROUP BY ALL),
j AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) > 4 THEN 1 ELSE 0 END AS jump FROM v), k AS (SELECT *, sum(jump) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span FROM j),
s AS (SELECT rid, label, template, size, span, flatten(list(ts)) AS ts, min(lo) AS lo, max(hi) AS hi FROM k GROUP BY ALL),
m AS (SELECT rid, label, lo, hi + 2 AS hi, size, len(list_distinct(flatten(list_transform(ts, lambda t: [t, t + 1, t + 2])))) AS matched FROM s),
f AS (SELECT *, matched / size AS score FROM m WHERE matched / size >= 0.8 AND hi + 1 - lo <= 2 * size + 4),
q AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM f AS e WHERE e.rid = f.rid AND e.matched > f.matched AND 2 * (least(e.hi, f.hi) - greatest(e.lo, f.lo) + 1) > f.hi - f.lo + 1)),
best AS (SELECT rid, max(score) AS score FROM q GROUP BY 1),
names AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM q UNION SELECT rid, label FROM o WHERE label IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(base.labels, '') AS base_labels, coalesce(names.labels, '') AS labels, CAST(coalesce(best.score, CASE WHEN n > 0 THEN 0.5 ELSE 0 END) AS DOUBLE) AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN names USING (rid) LEFT JOIN best USING (rid)"""

_STRATUM = "CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END"
_RULES = "['symbols_per_word', 'marks_per_word', 'repeated_words', 'repeated_lines', 'capital_letters', 'same_words']"

OP3 = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, lang, t, {_WORDS.format("t")} AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l FROM d),
g AS (SELECT rid, unnest(list_transform(range(1, len(w) - 1), lambda i: {{'i': i, 'g': w[i:i + 2]}})) AS s FROM w), h AS (SELECT rid, s.i AS i, count(*) OVER (PARTITION BY rid, s.g) AS c FROM g),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM h WHERE c > 1) GROUP BY 1),
f AS (SELECT w.rid, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks, length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS n_upper,
 len(list_distinct(w)) AS n_distinct, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r ON r.rid = w.rid),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {_STRATUM} AS stratum,
 [coalesce(n_symbols / nullif(n_words, 0), 0), coalesce(n_marks / nullif(n_words, 0), 0), coalesce(n_repeat_words / nullif(n_words, 0), 0), coalesce(n_dup_lines / nullif(n_lines, 0), 0), coalesce(n_upper / nullif(word_chars, 0), 0), 1 - coalesce(n_distinct / nullif(n_words, 0), 0)] AS x FROM f),
m AS (SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY 1),
e AS (SELECT stratum, good, unnest(range(1, 7)) AS no, x FROM v JOIN m USING (doc_id)), y AS (SELECT stratum, good, no, x[no] AS x FROM e),
k AS (SELECT no, i / CASE WHEN no < 3 THEN 20 ELSE 50 END AS cutoff FROM (SELECT unnest(range(1, 7)) AS no), (SELECT unnest(range(1, 60)) AS i) WHERE i < CASE WHEN no < 3 THEN 60 ELSE 50 END),
n AS (SELECT stratum, count(*) AS n FROM v JOIN m USING (doc_id) WHERE good GROUP BY 1), b AS (SELECT stratum, n, 0.03 / 6 AS p, 0.05 / ((SELECT count(*) FROM n) * 6) AS level FROM n),
q AS (SELECT stratum, level, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p))) OVER (PARTITION BY stratum ORDER BY i) AS total FROM (SELECT *, unnest(range(0, CAST(floor(n * p) AS BIGINT) + 1)) AS i FROM b)),
a AS (SELECT stratum, max(i) AS allowed FROM q WHERE total <= level GROUP BY 1),
c AS (SELECT stratum, y.no, cutoff, allowed, count(*) FILTER (good AND x > cutoff) AS rejected, count(*) FILTER (NOT good AND x > cutoff) AS bad FROM y JOIN a USING (stratum) JOIN k ON k.no = y.no GROUP BY 1, 2, 3, 4),
z AS (SELECT stratum, no, arg_max(cutoff, (bad - 50 * rejected) * 1000 + cutoff) AS cutoff FROM c WHERE rejected <= allowed AND bad > 50 * rejected GROUP BY 1, 2),
j AS (SELECT v.rid, string_agg({_RULES}[no], ',' ORDER BY no) AS failed FROM v JOIN z ON z.stratum = v.stratum AND v.x[z.no] > z.cutoff GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed IS NULL AS kept, coalesce(failed, '') AS failed_rules FROM v LEFT JOIN j ON j.rid = v.rid"""

SQL = {"op1_jump_shards": OP1, "op3_risk_rules": OP3, "op4_leaks": OP4, "op5_url_ranges": OP5, "op7_warc_revisits": OP7, "op8_license_diagonals": OP8, "op10_setsketch": OP10, "op11_heavy_light": OP11}
