"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from riskline.llm import licenses, quality, urlfilter

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLAIN = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def quality_sql() -> str:
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') t, coalesce(source, chr(1)) host,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) i FROM d WHERE len(w) >= 3)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) p FROM rep) GROUP BY 1),
raw AS (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) line FROM d),
ln AS (SELECT doc_id, host, t, line, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) n FROM raw
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) n FROM ln GROUP BY 1),
hosts AS (SELECT host, count(DISTINCT t) c FROM d GROUP BY 1),
often AS MATERIALIZED (SELECT host, n FROM (SELECT host, n, count(DISTINCT t) c FROM ln GROUP BY 1, 2) f JOIN hosts h USING (host)
          WHERE f.c >= {quality.MIN_DOCS} AND (f.c >= {quality.MIN_SHARE} * h.c OR f.c >= {quality.ENOUGH_DOCS})),
held AS MATERIALIZED (SELECT DISTINCT host, n, t FROM ln JOIN often USING (host, n)),
texts AS MATERIALIZED (SELECT row_number() OVER () id, t, regexp_extract_all(translate(t, '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') w
          FROM (SELECT DISTINCT t FROM held)),
sh AS MATERIALIZED (SELECT DISTINCT id, array_to_string(w[i:i+4], ' ') s
       FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) i FROM texts)),
sn AS (SELECT id, count(*) n FROM sh GROUP BY 1),
pr AS (SELECT a.id a, b.id b, count(*) n FROM sh a JOIN sh b USING (s) WHERE a.id < b.id GROUP BY 1, 2),
lk AS MATERIALIZED (SELECT a, b FROM pr JOIN sn x ON x.id = a JOIN sn y ON y.id = b WHERE 100 * pr.n >= {round(100 * quality.GROUP_SIMILARITY)} * (x.n + y.n - pr.n)),
sy AS MATERIALIZED (SELECT a, b FROM lk UNION ALL SELECT b, a FROM lk),
reach(id, x) AS (SELECT id, id FROM texts UNION SELECT reach.id, sy.b FROM reach JOIN sy ON reach.x = sy.a),
grp AS (SELECT t, min(x) g FROM reach JOIN texts USING (id) GROUP BY t),
freq AS (SELECT host, n, count(DISTINCT g) c FROM held JOIN grp USING (t) GROUP BY 1, 2),
boil AS (SELECT f.host, f.n FROM freq f JOIN hosts h USING (host) WHERE f.c >= {quality.MIN_DOCS}
         AND (f.c >= {quality.MIN_SHARE} * h.c OR f.c >= {quality.ENOUGH_DOCS})),
gone AS (SELECT doc_id, sum(len(string_split(n, ' '))) g FROM ln JOIN boil USING (host, n) GROUP BY 1),
b AS (SELECT d.doc_id, len(w) n_words, length(array_to_string(w, '')) word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols,
             coalesce(dup.n, 0) n_dup_lines, coalesce(cov.n, 0) n_repeat_words,
             len(w) - coalesce(g, 0)::BIGINT n_words_left
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)
           AND n_words_left >= {quality.MIN_LEFT} * n_words AS kept,
       n_words_left FROM b"""


def decontamination_sql() -> str:
    return rf"""
WITH iw AS (SELECT item_id, {PLAIN} w FROM benchmark),
its AS (SELECT DISTINCT item_id, array_to_string(w[i:i+4], ' ') s
        FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) i FROM iw WHERE len(w) >= 5)
        UNION SELECT item_id, array_to_string(w, ' ') FROM iw WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT item_id, count(*) n_item FROM its GROUP BY 1),
dw AS (SELECT doc_id, {PLAIN} w FROM documents),
ks AS (SELECT 5 k UNION SELECT len(w) FROM iw WHERE len(w) BETWEEN 1 AND 4),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+k-1], ' ') s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) i FROM dw, ks WHERE len(w) >= k)),
m AS (SELECT doc_id, item_id, count(*) n_shared FROM ds JOIN its USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared, round(n_shared / n_item, 6) containment
FROM m JOIN n USING (item_id) WHERE 4 * n_shared >= 3 * n_item"""


def license_sql() -> str:
    rows = []
    for t, (label, text, base) in enumerate([(*x, True) for x in licenses.BASE]
                                            + [(*x, False) for x in licenses.TEMPLATES]):
        w = text.split()
        n = len(w) - licenses.K + 1
        slack = 0 if base else max(1, len(w) // 6)
        rows += [f"({t},'{label}',{str(base).lower()},{n},{slack},'{' '.join(w[q:q + licenses.K])}',{q})"
                 for q in range(n)]
    tell = [f"({t},{x})" for t, sets in licenses.telling_places().items() for x in sets]
    found = f"(base AND cover = 1 OR NOT base AND cover >= {licenses.MIN_COVER} AND told)"
    names = "coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER ({})), ','), '')"
    return rf"""
WITH t(template, label, base, n_grams, slack, gram, q) AS (VALUES {', '.join(rows)}),
tell(template, places) AS (VALUES {', '.join(tell)}),
d AS MATERIALIZED (SELECT row_number() OVER () row, doc_id, {PLAIN} w FROM documents),
g AS (SELECT row, i - 1 p, w[i] || ' ' || w[i+1] || ' ' || w[i+2] gram
      FROM (SELECT row, w, unnest(range(1, len(w) - 1)) i FROM d WHERE len(w) >= 3)),
v AS (SELECT row, template, label, base, n_grams, slack, p - q diagonal, q FROM g JOIN t USING (gram)),
o AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER x > slack, true)::INT new FROM v
      WINDOW x AS (PARTITION BY row, template ORDER BY diagonal, q)),
s AS (SELECT *, sum(new) OVER (PARTITION BY row, template ORDER BY diagonal, q) span FROM o),
e AS MATERIALIZED (SELECT row, template, label, base, span, min(diagonal) first_word, list(DISTINCT q) places,
             count(DISTINCT q) / n_grams cover FROM s GROUP BY row, template, label, base, n_grams, span),
missed AS (SELECT DISTINCT row, template, span FROM e JOIN tell USING (template) WHERE NOT list_has_any(tell.places, e.places)),
c AS (SELECT e.*, missed.row IS NULL told FROM e LEFT JOIN missed USING (row, template, span)),
h AS (SELECT row, count(*) FILTER (base AND cover = 1) n_base,
             min(first_word) FILTER (base AND cover = 1) first_word,
             max(first_word) FILTER (base AND cover = 1) last_word,
             {names.format('base AND cover = 1')} base_labels, {names.format(found)} labels,
             round(max(cover), 6) score FROM c GROUP BY 1)
SELECT doc_id, len(w) n_words, coalesce(n_base, 0) n_base, first_word, last_word,
       coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, coalesce(score, 0.0) score
FROM d LEFT JOIN h USING (row)"""


WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def substring_sql() -> str:
    words = WORDS.format("coalesce(text, '')")
    return rf"""
WITH d AS (SELECT doc_id, {words} w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) i FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) m FROM win GROUP BY 1),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) p FROM win JOIN f USING (g) WHERE m < doc_id),
kept AS (SELECT doc_id, count(*) n, string_agg(w[p], ' ' ORDER BY p) t
         FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) p FROM d) a ANTI JOIN cov USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(w) n_words, len(w) - coalesce(n, 0) n_removed, sha256(coalesce(t, '')) kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def near_duplicate_sql() -> str:
    words = WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, {words} w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) i FROM d WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) n FROM sh GROUP BY 1),
pr AS (SELECT a.doc_id a, b.doc_id b, count(*) n FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
ln AS (SELECT a, b FROM pr JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * pr.n >= 75 * (x.n + y.n - pr.n)),
sy AS (SELECT a, b FROM ln UNION ALL SELECT b, a FROM ln),
r(d, x) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.d, sy.b FROM r JOIN sy ON r.x = sy.a),
m AS (SELECT d doc_id, min(x) component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) n_shingles, component_id, doc_id = component_id kept
FROM d JOIN m USING (doc_id) LEFT JOIN c USING (doc_id)"""


def url_sql() -> str:
    fits = [(k, h, p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')")
            for k, h, p in sorted(urlfilter.RULES, key=lambda r: -len(r[1] + r[2]))]
    rule = " ".join(f"WHEN {c} THEN '{h}{p}'" for _, h, p, c in fits)
    verdict = " ".join(f"WHEN {c} THEN '{k}'" for k, _, _, c in fits)
    labels = ", ".join(f"'{x}'" for x in urlfilter.LISTED_LABELS)
    return rf"""
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path,
             regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) query FROM r),
q AS (SELECT *, list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '{urlfilter.TRACKING}'))) ps FROM p),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
                || regexp_replace(path, '/+$', '') || CASE WHEN len(ps) > 0 THEN '?' || array_to_string(ps, '&') ELSE '' END END canonical FROM q),
l AS (SELECT DISTINCT canonical FROM c WHERE list_has_any(string_split(host, '.'), [{labels}]) AND canonical IS NOT NULL)
SELECT page_id, host, path, CASE {rule} END AS rule,
       coalesce(CASE {verdict} END, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       l.canonical IS NOT NULL AS listed
FROM c LEFT JOIN l ON c.canonical = l.canonical"""


def warc_sql() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') t, sha1(coalesce(html, '')) h FROM pages),
f AS (SELECT h, max(page_id) m FROM p GROUP BY 1),
b AS (SELECT page_id, strlen(t) payload_bytes, m, array_to_string(list_transform(range(0, 32), lambda k:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ((('0x' || substr(h, 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))::BIGINT) & 31)::INT, 1)), '') payload_digest
      FROM p JOIN f USING (h))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END record_type,
       CASE WHEN page_id <> m THEN m END refers_to FROM b"""


def cluster_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Lloyd's rounds written out, each an exact distance of all vectors to all centroids."""
    parts = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
x AS MATERIALIZED (SELECT row, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM v),
s AS (SELECT row, row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c FROM v),
c0 AS MATERIALIZED (SELECT c, i, x AS y FROM s JOIN x USING (row) WHERE c < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
d{r} AS (SELECT row, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d FROM x JOIN c{r} USING (i) GROUP BY row, c),
a{r} AS MATERIALIZED (SELECT row, c, d FROM d{r}
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1)""")
        if r < rounds:
            parts.append(f"""
m{r} AS (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{r} USING (row) GROUP BY c, i),
c{r + 1} AS MATERIALIZED (
  SELECT o.c, o.i, CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS y
  FROM c{r} o LEFT JOIN m{r} USING (c, i))""")
    return f"""WITH {",".join(parts)},
h AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN v USING (row) JOIN h USING (c)"""


def collocation_sql() -> str:
    return r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, p FROM (
    SELECT lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
w AS MATERIALIZED (
  SELECT lang, piece, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM (
    SELECT lang, piece, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces)),
g AS MATERIALIZED (
  SELECT lang, w AS w1, lead(w, 1) OVER s AS w2, lead(w, 2) OVER s AS w3 FROM w
  WINDOW s AS (PARTITION BY piece ORDER BY i)),
f1 AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
longer AS (
  SELECT lang, w1, w2, max(f) AS f FROM (
    SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY lang, w1, w2),
cuts AS (
  SELECT c.lang, concat_ws(' ', c.w1, c.w2) AS phrase, 1 AS k, c.f AS a, x.f AS l, y.f AS r
  FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
  LEFT JOIN longer g ON g.lang = c.lang AND g.w1 = c.w1 AND g.w2 = c.w2
  WHERE c.f >= 10 AND coalesce(100 * g.f < 50 * c.f, true)
  UNION ALL
  SELECT c.lang, concat_ws(' ', c.w1, c.w2, c.w3), 1, c.f, x.f, y.f
  FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1
  JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, concat_ws(' ', c.w1, c.w2, c.w3), 2, c.f, x.f, y.f
  FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2
  JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3),
scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
