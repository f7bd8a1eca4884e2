"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op7_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY n DESC, doc_id) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d
"""

ORACLE["op9_url_filter"] = r"""
WITH rules(rhost, rpath, rverdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (
  SELECT page_id, row_number() OVER () AS k,
         CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT page_id, k,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fit AS (
  SELECT k, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY k ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS n
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM fit WHERE n = 1) f ON u.k = f.k
"""

ORACLE["op8_minhash_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x for x in string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+') if x <> ''] AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
           WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
           ELSE [array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM both_ JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

ORACLE["op5_warc"] = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d,
         row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id) AS k,
         first_value(page_id) OVER (PARTITION BY coalesce(html, '') ORDER BY page_id) AS first_id
  FROM pages)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND k > 1 THEN first_id END AS refers_to, true AS verified
FROM p
"""


def _merkle() -> str:
    """The manifest in SQL, its levels written out (8^8 rows of a language, 8^4 languages)."""
    low, high = 8, 4
    field = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    crc = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''),
             lambda c: ascii(c)::BIGINT)), lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda y, z: xor(y >> 1, CASE WHEN y % 2 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295)"""

    def level(name: str, before: str) -> list[str]:
        run = "(PARTITION BY t, i // 8 ORDER BY i ROWS BETWEEN"
        return [
            f"{name}p AS (SELECT t, i, coalesce(string_agg(h, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
            f" coalesce(string_agg(h, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r,"
            f" count(*) OVER (PARTITION BY t) > 1 AS more FROM {before})",
            f"{name} AS (SELECT t, i // 8 AS i, CASE WHEN any_value(c) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h"
            f" FROM (SELECT *, count(*) OVER (PARTITION BY t) AS c FROM {before}) GROUP BY t, i // 8)"]

    ctes = [f"""d AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, {leaf('text')} AS leaf,
         {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS low, {crc} % 3 = 0 AS bad
  FROM documents)""", "e AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id) - 1 AS i FROM d)",
            "a0 AS (SELECT t, i, leaf AS h FROM e)"]
    for k in range(low):
        ctes += level(f"a{k + 1}", f"a{k}")
    ctes.append(f"b0 AS (SELECT 0 AS t, t AS i, h FROM a{low})")
    for k in range(high):
        ctes += level(f"b{k + 1}", f"b{k}")
    steps = [(f"a{k + 1}p", f"p.t = f.t AND p.i = f.i // {8 ** k}") for k in range(low)]
    steps += [(f"b{k + 1}p", f"p.i = f.t // {8 ** k}") for k in range(high)]
    ctes.append("f0 AS (SELECT doc_id, leaf, t, i, CASE WHEN bad THEN low ELSE leaf END AS h, '' AS s FROM e)")
    for k, (table, on) in enumerate(steps):
        ctes.append(f"f{k + 1} AS (SELECT doc_id, leaf, f.t, f.i, CASE WHEN more THEN sha256(l || h || r) ELSE h END AS h,"
                    f" CASE WHEN more THEN s || l || r ELSE s END AS s FROM f{k} f JOIN {table} p ON {on})")
    return ("WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(s) AS proof_sha256, f.h AS folded_root, f.h = top.h AS verified
FROM f{low + high} f JOIN a{low} sub ON sub.t = f.t CROSS JOIN b{high} top""")


ORACLE["op11_merkle_manifest"] = _merkle()

ORACLE["op12_line_dedup"] = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, count(DISTINCT doc_id) AS docs, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key),
m AS (SELECT k.*, coalesce(docs >= 3 AND doc_id <> last, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid
"""

ORACLE["op13_lexical_search"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
s AS (SELECT count(*) AS docs, sum(len(ws))::BIGINT AS total FROM d WHERE len(ws) > 0),
w AS (SELECT doc_id, rid, len(ws) AS n, unnest(ws) AS term FROM d),
tf AS (SELECT rid, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM w GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (
  SELECT item_id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
qt AS (SELECT item_id, term, count(*) AS often FROM q GROUP BY item_id, term),
part AS (
  SELECT item_id, doc_id, rid,
         often * floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
         * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))) AS p
  FROM qt JOIN df USING (term) JOIN tf USING (term) CROSS JOIN s),
sums AS (SELECT item_id, any_value(doc_id) AS doc_id, sum(p)::BIGINT AS score FROM part GROUP BY item_id, rid),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM sums WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""
