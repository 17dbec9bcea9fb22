"""DuckDB SQL for those contract queries that SQL can express on whole tables."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0) x),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM shingle a JOIN shingle b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
    SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * same >= 75 * (x.n + y.n - same)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.low AS component_id
FROM doc d LEFT JOIN size s ON s.doc_id = d.doc_id JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

OP6 = r"""
WITH doc AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest FROM documents),
src AS (
    SELECT source, n, 3 * n AS cap, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM doc GROUP BY source) x),
total AS (SELECT CAST(sum(n) AS BIGINT) AS t FROM src),
filled AS (
    SELECT *, w * (t - coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              > cap * sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped
    FROM src, total),
target AS (
    SELECT source, n AS source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE)
           ELSE CAST(w * (t - (SELECT coalesce(sum(cap), 0) FROM filled WHERE capped)) AS DOUBLE) / (SELECT sum(w) FROM filled WHERE NOT capped) END AS target
    FROM filled),
queue AS (
    SELECT d.*, source_size, target, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY digest, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS done
    FROM doc d JOIN target g ON d.source IS NOT DISTINCT FROM g.source),
copy AS (
    SELECT source, digest, size, pass, CAST(done + pass * source_size AS DOUBLE) / target AS finish FROM queue, (SELECT unnest(range(3)) AS pass) p WHERE size > 0),
line AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, digest, pass, size ROWS UNBOUNDED PRECEDING) AS served FROM copy),
last AS (SELECT max(finish) AS f FROM line, total WHERE 2 * served - size <= 2 * t)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
       size * (CAST(CAST(done AS DOUBLE) / target <= f AS BIGINT) + CAST(CAST(done + source_size AS DOUBLE) / target <= f AS BIGINT) + CAST(CAST(done + 2 * source_size AS DOUBLE) / target <= f AS BIGINT)) END AS taken
FROM queue, last
"""

OP9 = f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windowed AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50) x),
low AS (SELECT h, min(doc_id) AS first FROM windowed GROUP BY h),
gone AS (
    SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, i FROM windowed JOIN low USING (h) WHERE first < doc_id) x, (SELECT unnest(range(50)) AS k) y),
word AS (SELECT doc_id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM doc),
kept AS (
    SELECT word.doc_id, count(gone.i) AS n_removed, string_agg(CASE WHEN gone.i IS NULL THEN word.w END, ' ' ORDER BY word.i) AS text
    FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i GROUP BY word.doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM doc d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

#: Rules of the URL query as (host, path, rule, verdict), written out apart from the query.
_URL_RULES = "(VALUES ('com', '/en/', 'com/en/', 'block'), ('example.com', '/en/7', 'example.com/en/7', 'allow'), ('net', '/de/', 'net/de/', 'allow'), ('example.net', '/de/8', 'example.net/de/8', 'block'), ('org', '/es/', 'org/es/', 'block')) r(rhost, rpath, rule, says)"
_ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_HREF = r"""(?i)href\s*=\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s>]+)"""

#: Visits are a series over steps along edges, 0.85 a step; 200 steps leave less than 1e-14.
OP2 = rf"""
WITH RECURSIVE page AS (
    SELECT row_number() OVER () AS k, page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
part AS (
    SELECT k, page_id, html, {_ASCII.format("regexp_extract(coalesce(rest, ''), '^[^/?#]*')")} AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM page),
fit AS (
    SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS says
    FROM part JOIN {_URL_RULES} ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY k),
judged AS (SELECT part.*, rule, says FROM part LEFT JOIN fit USING (k)),
seed AS (
    SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS x FROM (
        SELECT 'trust' AS kind, host, count(*) FILTER (WHERE says = 'allow') / count(*) AS n FROM judged WHERE host <> '' GROUP BY host
        UNION ALL SELECT 'distrust', host, count(*) FILTER (WHERE says = 'block') / count(*) FROM judged WHERE host <> '' GROUP BY host) s WHERE n > 0),
href AS (
    SELECT host AS src, {_ASCII.format(f"unnest(regexp_extract_all(html, '{_HREF}', 1))")} AS dst FROM judged),
link AS (SELECT src, dst, count(*) AS n FROM href WHERE src <> '' AND src <> dst GROUP BY src, dst),
edge AS (
    SELECT 'trust' AS kind, src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM link
    UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM link),
visit AS (
    SELECT 0 AS step, kind, host, x FROM seed
    UNION ALL
    SELECT step + 1, v.kind, dst, sum(0.85 * x * share) FROM visit v JOIN edge e ON e.kind = v.kind AND src = host WHERE step < 200 GROUP BY step, v.kind, dst),
score AS (SELECT kind, host, sum(x) / sum(sum(x)) OVER (PARTITION BY kind) AS x FROM visit GROUP BY kind, host)
SELECT page_id, j.host, path, rule, coalesce(says, CASE WHEN coalesce(d.x, 0) > 0.5 * (coalesce(t.x, 0) + coalesce(d.x, 0)) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN score t ON t.kind = 'trust' AND t.host = j.host LEFT JOIN score d ON d.kind = 'distrust' AND d.host = j.host
"""

#: Windows as long as an item that hold a shingle of it, their weighted overlap, and the best window of each document and item.
OP7 = f"""
WITH item AS (SELECT row_number() OVER () AS k, item_id, {_LOWER_WORDS} AS w FROM benchmark),
theirs AS (SELECT k, item_id, w, len(w) AS n, least(len(w), 5) AS z, len(w) - least(len(w), 5) + 1 AS bag FROM item WHERE len(w) > 0),
owned AS (
    SELECT k, z, n, bag, h, count(*) AS c FROM (SELECT k, z, n, bag, array_to_string(w[i:i + z - 1], ' ') AS h FROM (SELECT *, unnest(range(1, bag + 1)) AS i FROM theirs) x) y GROUP BY k, z, n, bag, h),
doc AS (SELECT row_number() OVER () AS d, doc_id, {_LOWER_WORDS} AS w FROM documents),
place AS (
    SELECT d, len(w) AS m, z, i, array_to_string(w[i:i + z - 1], ' ') AS h
    FROM (SELECT d, w, z, unnest(range(1, len(w) - z + 2)) AS i FROM doc, (SELECT DISTINCT z FROM owned) s WHERE len(w) >= z) x),
hit AS (SELECT d, m, k, p.z, n, bag, i, h, c FROM place p JOIN owned o USING (z, h)),
held AS (
    SELECT d, k, bag, s, least(bag, m - z + 1) AS own, h, least(count(*), min(c)) AS same
    FROM (SELECT *, unnest(range(greatest(1, i - bag + 1), least(i, greatest(m - n + 1, 1)) + 1)) AS s FROM hit) x GROUP BY d, k, bag, s, m, z, h),
score AS (SELECT d, k, s, CAST(sum(same) AS BIGINT) AS same, min(own + bag) AS bags FROM held GROUP BY d, k, s HAVING 4 * sum(same) >= 3 * (min(own + bag) - sum(same))),
best AS (SELECT d, k, arg_max(struct_pack(s := s, x := same / (bags - same)), struct_pack(x := same / (bags - same), s := -s)) AS b FROM score GROUP BY d, k)
SELECT doc_id, item_id, b.s - 1 AS start_word, b.x AS similarity FROM best JOIN doc USING (d) JOIN theirs USING (k)
"""

ORACLES = {"op1_ngram_jaccard_join": OP1, "op2_url_filters": OP2, "op6_source_mixing": OP6, "op7_benchmark_decontamination": OP7, "op9_substring_dedup": OP9}
