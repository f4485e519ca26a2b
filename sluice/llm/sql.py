"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, n, w[i:i + n - 1] AS win FROM bi),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
dw AS (SELECT doc_id, n, i, w[i:i + n - 1] AS win FROM di),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id, ',' ORDER BY item_id)) AS s FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(s, sha256('')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""

OP5 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.v, v.v), lambda z: z[1] * z[2])) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.v) = len(v.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
x AS (SELECT p.page_id, p.h, first, list_transform(range(0, 8), lambda i: CAST(('0x' || substr(sha1(p.h), 5 * i + 1, 5)) AS BIGINT)) AS parts FROM p JOIN f ON p.h = f.h)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
 array_to_string(list_transform(parts, lambda n: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n >> 15) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n >> 10) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n >> 5) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', n % 32 + 1, 1)), '') AS payload_digest,
 CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM x
"""


#: Kinds apart from the operator's own rules, the base ones as the contract has them:
#: pattern, group that is measured, least length.
_KINDS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
    "private_key": (
        r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+){0,16}-----END [A-Z ]{0,30}PRIVATE KEY-----|(?:[ \t\r\n]*(?:Proc-Type|DEK-Info):[^\r\n]*){0,4}"
        r"(?:[ \t\r\n\\]*[A-Za-z0-9+/=]{16}[A-Za-z0-9+/=\r\n\\]*)*(?:[ \t]+[A-Za-z0-9+/]+={1,2})?)",
        0, 1,
    ),
    "github": (r"gh[oprsu]_[A-Za-z0-9]{36}", 0, 1),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    "stripe": (r"sk_live_[A-Za-z0-9]{16,}", 0, 1),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
}


def _secrets() -> str:
    kinds = []
    for k, (kind, (pattern, group, least)) in enumerate(_KINDS.items()):
        p = "'" + pattern.replace("'", "''") + "'"
        kinds.append(f"SELECT doc_id, {k} AS k, '{kind}' AS kind, {least} AS least, regexp_split_to_array(t, {p}) AS g, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {group}) AS e FROM d")
    base = 3
    written = "kind || ':' || s || ':' || e"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({' UNION ALL '.join(kinds)}),
i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM f),
p AS (SELECT doc_id, k, kind, len(m[i]) AS n, len(e[i]) AS en, least, CAST(list_sum(list_transform(g[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS s FROM i),
q AS (SELECT doc_id, k, kind, s, s + n AS e FROM p WHERE en >= least),
a AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
 string_agg({written}, ',' ORDER BY s, k) FILTER (k < {base}) AS base, string_agg({written}, ',' ORDER BY s, k) AS spans FROM q GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.doc_id = d.doc_id
"""


OP9 = _secrets()

OP10 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [1] ELSE range(1, len(w) - 1) END) AS i FROM d),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS x FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id > b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(m.b, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.a = d.doc_id
"""


def _leaf(text: str) -> str:
    spelt = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(spelt)})"


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII letters, a bit at a time."""
    byte = "list_reduce(range(0, 8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(a, x))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT)), lambda a, x: {byte}, CAST(4294967295 AS BIGINT)), 4294967295)"


OP11 = f"""
WITH RECURSIVE d AS (SELECT *, {_leaf("text")} AS leaf, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS offered FROM documents),
t AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS t FROM (SELECT DISTINCT source FROM documents)),
l AS (SELECT doc_id, t, leaf, offered, row_number() OVER (PARTITION BY t ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY t) AS n FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
s(t, level, pos, n, digest) AS (SELECT t, 0, pos, n, leaf FROM l UNION ALL SELECT t, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM s WHERE n > 1 GROUP BY t, level, pos // 3, n),
r AS (SELECT t, level AS height, digest AS subroot FROM s WHERE n = 1),
u(level, pos, n, digest) AS (SELECT 0, t, (SELECT count(*) FROM r), subroot FROM r UNION ALL SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY level, pos // 3, n),
top AS (SELECT level AS summit, digest AS root FROM u WHERE n = 1),
g AS (SELECT t, level, pos // 3 AS up, list(digest ORDER BY pos) AS run FROM (SELECT * FROM s UNION ALL SELECT -1, * FROM u) GROUP BY t, level, pos // 3),
k AS (SELECT doc_id, t, pos, height, summit, unnest(range(0, height + summit)) AS k FROM l JOIN r USING (t), top),
w AS (SELECT doc_id, k, CASE WHEN k < height THEN t ELSE -1 END AS tree, CASE WHEN k < height THEN k ELSE k - height END AS level, CASE WHEN k < height THEN pos // CAST(pow(3, k) AS BIGINT) ELSE t // CAST(pow(3, k - height) AS BIGINT) END AS node FROM k),
p AS (SELECT doc_id, k, array_to_string(run[1:(node % 3)], '') AS before, array_to_string(run[(node % 3) + 2:], '') AS after FROM w JOIN g ON g.t = w.tree AND g.level = w.level AND g.up = w.node // 3),
f(doc_id, k, digest) AS (SELECT doc_id, 0, offered FROM l UNION ALL SELECT f.doc_id, f.k + 1, sha256(before || digest || after) FROM f JOIN p ON p.doc_id = f.doc_id AND p.k = f.k),
h AS (SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY k)) AS proof FROM p GROUP BY doc_id),
e AS (SELECT doc_id, arg_max(digest, k) AS folded FROM f GROUP BY doc_id)
SELECT l.doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM l JOIN r USING (t) JOIN e ON e.doc_id = l.doc_id LEFT JOIN h ON h.doc_id = l.doc_id, top
"""


def _codes() -> str:
    far = "list_sum(list_transform(list_zip(x.s, c.s), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(5):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p, CAST(arg_min(e, d * 256 + e) AS INTEGER) AS e, min(d) AS d FROM (SELECT x.vec_id, x.p, c.e, CAST({far} AS BIGINT) AS d FROM x JOIN c{r} c ON c.p = x.p) GROUP BY vec_id, p)")
        if r < 4:
            steps.append(f"m{r} AS (SELECT p, e, i, CAST(floor(sum(s[i]) / count(*)) AS BIGINT) AS m FROM (SELECT x.p, a.e, x.s, unnest(range(1, len(x.s) + 1)) AS i FROM x JOIN a{r} a ON a.vec_id = x.vec_id AND a.p = x.p) GROUP BY p, e, i)")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(n.s, c.s) AS s FROM c{r} c LEFT JOIN (SELECT p, e, list(m ORDER BY i) AS s FROM m{r} GROUP BY p, e) n ON n.p = c.p AND n.e = c.e)")
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS s FROM (SELECT *, unnest(range(0, 4)) AS p FROM v)),
c0 AS MATERIALIZED (SELECT p, e, s FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM x) WHERE e < 256),
{", ".join(steps)},
b AS (SELECT sha256(string_agg(array_to_string(s, ','), ',' ORDER BY p, e)) AS digest FROM c4),
o AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY vec_id)
SELECT o.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256 FROM o JOIN v ON v.vec_id = o.vec_id, b
"""


OP12 = _codes()

OP13 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [1] ELSE range(1, len(w) - 2) END) AS i FROM d),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS x FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id > b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.a = d.doc_id
"""
