"""DuckDB SQL with the results that the registered queries must equal, over the same tables."""

_BLANK = r"[\x20\x09-\x0D]"

EXACT_DEDUP = rf"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         sha256(regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g')) AS text_sha256 FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, first_value(cp) OVER w AS keep_cp,
         count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY cp DESC, doc_id ASC NULLS LAST))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND cp = keep_cp AS kept, text_sha256 FROM r
"""

SOURCE_MIX = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (('0x' || md5('20:' || coalesce(doc_id::VARCHAR, '~'))[1:13])::BIGINT + 0.5) / 4503599627370496.0 AS u FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
c AS (SELECT *, source_size * 3.0::DOUBLE AS cap, sum(source_size) OVER ()::DOUBLE AS total FROM s),
l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT level FROM l WHERE level * w <= cap ORDER BY cap / w, source NULLS LAST LIMIT 1) * w, cap))::DOUBLE AS target FROM l),
k AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN source_size > 0 THEN least(3.0, target / source_size) ELSE 0 END AS want
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, floor(want + 1e-9)::BIGINT AS whole, greatest(want - floor(want + 1e-9), 0) AS p FROM k),
r AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS need,
         CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds FROM q),
x AS (
  SELECT *, CASE WHEN odds IS NOT NULL THEN sum(size) OVER (PARTITION BY source, odds IS NULL ORDER BY odds, doc_id NULLS LAST
                                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS upto FROM r)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       CASE WHEN size > 0 THEN size * (whole + CASE WHEN odds IS NOT NULL AND upto - size / 2 <= need THEN 1 ELSE 0 END) ELSE 0 END::BIGINT AS taken
FROM x
"""

WARC = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (
  SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN NOT (payload_bytes < 100 OR page_id IS NOT DISTINCT FROM first_id) THEN first_id END AS refers_to,
       true AS verified FROM f
"""

LINE_DEDUP = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, r, len(lines) AS n_lines, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3),
m AS (SELECT k.*, g.key IS NOT NULL AND k.doc_id IS DISTINCT FROM g.last AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT any_value(doc_id) AS doc_id, any_value(n_lines)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT r, i, dw.n, item FROM dw JOIN bw USING (n, win)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
s AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)
"""

URL_FILTERS = r"""
WITH c AS (
  SELECT page_id, url,
         nullif(regexp_replace(regexp_replace(lower(regexp_replace(regexp_extract(url, '^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)', 1), '^.*@', '')),
                ':[0-9]*$', ''), '[.]$', '') , '') AS host,
         regexp_extract(url, '^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)', 2) AS path,
         DATE '2023-01-01' + (('0x' || md5(page_id::VARCHAR)[1:7])::BIGINT % 730)::INT AS day FROM pages),
k AS (
  SELECT *, string_split(host, '.') AS labels, string_split(regexp_replace(path, '/+$', ''), '/') AS segs, string_split(path, '/') AS parts FROM c WHERE host IS NOT NULL),
keys AS (
  SELECT page_id, day, 'd:' || array_to_string(labels[i:], '.') AS entry FROM (SELECT *, unnest(generate_series(1, len(labels))) AS i FROM k)
  UNION
  SELECT page_id, day, 'u:' || host || array_to_string(segs[:i], '/') FROM (SELECT *, unnest(generate_series(1, len(segs))) AS i FROM k)),
ent AS (
  SELECT DISTINCT entry FROM keys WHERE entry LIKE 'd:%.%'
  UNION SELECT DISTINCT 'u:' || host || '/' || parts[2] FROM k WHERE len(parts) > 1),
x AS (SELECT list, entry, ('0x' || md5(list || ':' || entry)[1:7])::BIGINT AS x FROM ent, (SELECT unnest(['adult', 'allow', 'spam']) AS list)),
y AS (
  SELECT list, entry, x, floor((x / 7) % 600)::INT AS b, floor((x / 11) % 200 + 30)::INT AS s FROM x WHERE x % (CASE WHEN list = 'allow' THEN 6 ELSE 3 END) = 0),
iv AS (
  SELECT list, entry, DATE '2023-01-01' + b AS f, CASE WHEN x % 5 > 1 THEN DATE '2023-01-01' + (b + s) END AS t FROM y
  UNION ALL SELECT list, entry, DATE '2023-01-01' + (b + s + 40), NULL FROM y WHERE x % 5 > 3),
h AS (SELECT page_id, list, keys.entry FROM keys JOIN iv ON keys.entry = iv.entry AND day >= f AND (t IS NULL OR day < t)),
g AS (
  SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) FILTER (list <> 'allow') AS blocked, string_agg(DISTINCT list, ',' ORDER BY list) FILTER (list = 'allow') AS allowed,
         count(DISTINCT entry) AS n FROM h GROUP BY page_id)
SELECT c.page_id, host, day::VARCHAR AS fetch_day, coalesce(blocked, '') AS blocked_by, coalesce(allowed, '') AS allowed_by, coalesce(n, 0)::BIGINT AS n_entries,
       CASE WHEN allowed IS NOT NULL THEN 'allow' WHEN blocked IS NOT NULL THEN 'block' ELSE 'none' END AS verdict
FROM c LEFT JOIN g USING (page_id)
"""


def _centroids(k: int = 40, rounds: int = 5) -> str:
    """K-means over whole numbers, one pair of CTEs a round."""
    ctes = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
x AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
f AS (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM v),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM f WHERE c < {k})"""]
    near = "SELECT r, min(d * 1000 + c) % 1000 AS c, min(d) AS d FROM (SELECT r, c, sum((x.x - m.x) * (x.x - m.x))::BIGINT AS d FROM x JOIN c{n} m USING (i) GROUP BY r, c) GROUP BY r"
    for n in range(rounds):
        ctes.append(f"""a{n} AS MATERIALIZED ({near.format(n=n)}),
s{n} AS (SELECT c, i, sum(x)::BIGINT AS t, count(*) AS n FROM x JOIN a{n} USING (r) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (SELECT c, i, coalesce((t - ((t % n) + n) % n) // n, x) AS x FROM c{n} LEFT JOIN s{n} USING (c, i))""")
    ctes.append(f"a{rounds} AS MATERIALIZED ({near.format(n=rounds)})")
    ctes.append(f"h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN h USING (c)
"""


CENTROIDS = _centroids()


def _crc_table() -> list[int]:
    """CRC-32 of the 16 values of half a byte."""
    out = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ 0xEDB88320 * (c & 1)
        out.append(c)
    return out


_BYTES = "flatten(list_transform(range(1, length(s) + 1), lambda i: CASE WHEN unicode(s[i]) < 128 THEN [unicode(s[i])] ELSE [195, unicode(s[i]) - 64] END))"
def _crc_step() -> str:
    """The checksum ``c`` after byte ``b``, half a byte at a time."""
    half = "xor({c} >> 4, {t}[(xor({c}, {b}) & 15) + 1])"
    return half.format(t=_crc_table(), b="(b >> 4)", c="(" + half.format(t=_crc_table(), b="b", c="c") + ")")


SPELLING = rf"""
WITH RECURSIVE r AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents),
g AS (SELECT id, w, count(*) AS n FROM r WHERE length(w) >= 7 GROUP BY id, w),
b AS (SELECT w, n, {_BYTES.replace("s[i]", "(id || ':' || w)[i]").replace("length(s)", "length(id || ':' || w)")} AS bytes FROM g),
h AS (
  SELECT w, n, xor(list_reduce(bytes, lambda c, b: CRC_STEP, 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM b),
t AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM t WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS gone FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (
  SELECT x.word, y.word AS other FROM d x JOIN d y ON x.i = y.i AND x.gone = y.gone AND x.word <> y.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.gone = v.word
  UNION SELECT v.word, d.word FROM d JOIN v ON d.gone = v.word),
o AS (
  SELECT p.word, v.n, p.other, u.n AS other_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY u.n DESC, p.other) AS k
  FROM p JOIN v ON v.word = p.word JOIN v u ON u.word = p.other),
f AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * v.n THEN other END AS form, CASE WHEN other_n >= 10 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN (FROM o WHERE k = 1) o USING (word)),
q AS (
  SELECT word, word AS tip, 0 AS steps FROM f
  UNION ALL SELECT q.word, f.form, steps + 1 FROM q JOIN f ON q.tip = f.word WHERE f.form IS NOT NULL),
z AS (SELECT word, arg_max(tip, steps) AS root FROM q GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM f JOIN z USING (word)
""".replace("CRC_STEP", _crc_step())


JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[i:i + 2], ' ') AS gram
  FROM (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n, md5(string_agg(gram, chr(10) ORDER BY gram)) AS digest FROM s GROUP BY r),
k AS MATERIALIZED (SELECT digest, min(r) AS c, any_value(n) AS n FROM n GROUP BY digest),
f AS MATERIALIZED (SELECT gram, count(*) AS f FROM s JOIN k ON s.r = k.c GROUP BY gram),
p AS MATERIALIZED (
  SELECT c, gram FROM (SELECT c, n, s.gram, row_number() OVER (PARTITION BY c ORDER BY f, s.gram) AS k FROM k JOIN s ON s.r = k.c JOIN f USING (gram))
  WHERE k <= n - ceil(n * 90 / 100.0) + 1),
x AS MATERIALIZED (SELECT DISTINCT p.c AS a, q.c AS b FROM p JOIN p q ON p.gram = q.gram AND p.c < q.c),
o AS (SELECT a, b, count(*) AS o FROM x JOIN s sa ON sa.r = a JOIN s sb ON sb.r = b AND sb.gram = sa.gram GROUP BY a, b),
l AS MATERIALIZED (
  SELECT a, b FROM o JOIN k ka ON ka.c = a JOIN k kb ON kb.c = b WHERE 100 * o >= 90 * (ka.n + kb.n - o)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT c AS a, c AS b FROM k UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
g AS (SELECT a AS c, min(b) AS root FROM reach GROUP BY a),
m AS (SELECT n.r, n.n, root, min(doc_id) OVER (PARTITION BY root) AS component_id FROM n JOIN k USING (digest) JOIN g ON g.c = k.c JOIN d ON d.r = n.r)
SELECT doc_id, coalesce(m.n, 0)::BIGINT AS n_shingles, CASE WHEN m.r IS NULL THEN doc_id ELSE component_id END AS component_id
FROM d LEFT JOIN m USING (r)
"""
