"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from cohortlens.llm import quality_rules as Q

# Words are the runs between the six white space characters of ASCII.
_BREAKS = r"[ \t-\r]"
_WORDS = f"list_filter(string_split_regex(coalesce(text, ''), '{_BREAKS}+'), lambda x: x <> '')"


def _quality_rules() -> str:
    """Measures by counting, levels by the exact binomial tail."""
    names = list(Q.RULES)
    levels = ", ".join(f"({i}, {', '.join(repr(float(Q.RULES[r][i])) for r in names)})" for i in range(Q.LEVELS))
    rejects = " OR ".join(f"h.{r} > c.{r}" for r in names)
    failed = ", ".join(f"CASE WHEN m.{r} > c.{r} THEN '{r}' END" for r in names)
    a = Q.ALPHA
    least = f"ceil(ln({Q.DELTA}) / ln(1 - {a}))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
t AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d),
tc AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i] || chr(31) || w[i + 1] || chr(31) || w[i + 2]) AS c FROM t),
rw AS (SELECT r, count(DISTINCT i + k) AS n FROM tc, (VALUES (0), (1), (2)) v(k) WHERE c > 1 GROUP BY r),
l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
      FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^ \\t-\\r]') GROUP BY r),
b AS (SELECT d.r, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
      CAST(length(regexp_replace(text, '{_BREAKS}', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rw.n, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
      length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
      length(regexp_replace(text, '[^!]', '', 'g')) AS shouts FROM d LEFT JOIN rw USING (r) LEFT JOIN l USING (r)),
m AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
      n_symbols / greatest(n_words, 1) AS symbols_per_word, n_dup_lines / greatest(n_lines, 1) AS duplicate_lines,
      n_repeat_words / greatest(n_words, 1) AS repeated_words, upper / greatest(letters, 1) AS capitals,
      shouts / greatest(n_words, 1) AS shouting FROM b),
c(level, {', '.join(names)}) AS (VALUES {levels}),
y AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
h AS (SELECT m.*, y.quality FROM m JOIN y USING (doc_id) WHERE NOT base_failed),
k AS (SELECT stratum, level, count(*) FILTER (WHERE quality = 1) AS n, count(*) FILTER (WHERE quality = 1 AND ({rejects})) AS good,
      count(*) FILTER (WHERE quality = 0 AND ({rejects})) AS bad FROM h, c GROUP BY stratum, level),
s AS (SELECT *, count(*) OVER () / {Q.LEVELS} AS strata FROM k WHERE n >= {least}),
p AS (SELECT *, good <= {a} * n AND list_sum(list_transform(range(0, good + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1)
      - lgamma(n - j + 1) + j * ln({a}) + (n - j) * ln(1 - {a})))) <= {Q.DELTA} / strata AS ok FROM s),
f AS (SELECT *, bool_and(ok) OVER (PARTITION BY stratum ORDER BY level) AS accepted FROM p),
u AS (SELECT stratum, min(level) AS level FROM (SELECT *, max(bad) OVER (PARTITION BY stratum) AS most FROM f WHERE accepted)
      WHERE bad >= {Q.NEARLY} * most GROUP BY stratum),
o AS (SELECT m.*, concat_ws(',', {failed}) AS failed_rules FROM m LEFT JOIN u USING (stratum) LEFT JOIN c USING (level))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM o"""


def _jaccard_join(n: int = 3, percent: int = 90) -> str:
    """All pairs with a common shingle; components by reachability."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = _WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{upper}', '{upper.lower()}')")
    joined = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {words} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: {joined}) END) AS g FROM d),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM i JOIN z a ON a.doc_id = x JOIN z b ON b.doc_id = y WHERE 100 * c >= {percent} * (a.n + b.n - c)),
t AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(x, y) AS (SELECT x, y FROM t UNION SELECT r.x, t.y FROM r JOIN t ON r.y = t.x)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id
FROM d LEFT JOIN z USING (doc_id) LEFT JOIN r ON r.x = d.doc_id GROUP BY d.doc_id, z.n"""


def _divergence(least: int = 10, top: int = 10) -> str:
    """Every pair of sources over every kept term."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = lambda n, total: f"1 + (1000000000 * (CAST({n} AS HUGEINT) + 2)) // ({total} + 2 * v)"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
     regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS MATERIALIZED (SELECT i, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM o GROUP BY 1, 2 HAVING count(DISTINCT i) >= {least}),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY 1, 2, 3),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2),
g AS MATERIALIZED (SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d)
     LEFT JOIN t USING (lang, source) LEFT JOIN v USING (lang)),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {share('coalesce(n, 0)', 'total')} AS p
     FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
q AS (SELECT lang, term, {share('n', 'total')} AS q FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY 1, 2)
      JOIN (SELECT lang, sum(total) AS total, max(v) AS v FROM g GROUP BY 1) USING (lang)),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, 'pair' AS part, 0 AS most FROM pairs UNION ALL SELECT *, 'term', {top} FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank
FROM r QUALIFY part = 'pair' OR rank <= most"""


def _warc() -> str:
    """Base 32 from the hexadecimal digest: five digits make four letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    at = lambda shift: f"substr('{letters}', 1 + ((x >> {shift}) & 31), 1)"
    digits = "list_transform(range(8), lambda i: CAST('0x' || substr(h, CAST(1 + 5 * i AS INT), 5) AS INT))"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS head FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform({digits}, lambda x: {' || '.join(at(s) for s in (15, 10, 5, 0))}), '') AS payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to FROM d"""


def _centroids(clusters: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """Every distance to every centroid, round by round."""
    steps, assign = [], """
a{r} AS MATERIALIZED (SELECT i, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM
     (SELECT v.i, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance FROM x v JOIN c{r} c USING (j) GROUP BY 1, 2) GROUP BY i)"""
    for r in range(rounds):
        steps.append(assign.format(r=r) + f""",
m{r} AS (SELECT a.cluster, v.j, sum(v.x) AS total, count(*) AS n FROM x v JOIN a{r} a USING (i) GROUP BY 1, 2),
c{r + 1} AS MATERIALIZED (SELECT cluster, j, CASE WHEN n IS NULL THEN x ELSE (total - ((total % n) + n) % n) // n END AS x
     FROM c{r} LEFT JOIN m{r} USING (cluster, j))""")
    steps.append(assign.format(r=rounds))
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS HUGEINT)) AS v
     FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (SELECT i, unnest(range({dims})) AS j, unnest(v) AS x FROM k),
c0 AS MATERIALIZED (SELECT cluster, unnest(range({dims})) AS j, unnest(v) AS x FROM
     (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS cluster FROM k WHERE vec_id IS NOT NULL QUALIFY cluster < {clusters})),
{','.join(steps)},
h AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT k.vec_id, CAST(a.cluster AS INT) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN k USING (i) JOIN h USING (cluster)"""


ORACLES: dict[str, str] = {
    "op1_quality_rules": _quality_rules(),
    "op7_jaccard_join": _jaccard_join(),
    "op11_source_divergence": _divergence(),
    "op12_warc": _warc(),
    "op13_centroid_clusters": _centroids(),
}
