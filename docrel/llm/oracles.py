"""DuckDB SQL for the queries that SQL can express.

The quality network, fingerprints by XXH64, chunk boundaries by XXH64 and edit matching have none.
"""

from __future__ import annotations

from docrel.llm import mixing, secrets, sharding, url_filter

OP1 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (SELECT vec_id, label, x, sqrt(list_sum(list_transform(x, lambda c: c * c))) AS norm FROM v WHERE label IS NOT NULL AND len(x) > 0
  AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.x) = len(b.x)
  WHERE list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.93),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), many AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = least.a LEFT JOIN many ON vec_id = many.a
"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), t AS (SELECT h, max(page_id) AS top FROM p GROUP BY h),
d AS (SELECT p.page_id, h, top, list_transform(range(0, 8), lambda i: CAST('0x' || substr(sha1(h), 5 * i + 1, 5) AS BIGINT)) AS parts FROM p JOIN t USING (h))
SELECT page_id, strlen(h) AS payload_bytes,
  array_to_string(list_transform(parts, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 10) % 32 + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 5) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v % 32 + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM d
"""

KIND_SQL = "hits_{k} AS (SELECT key, regexp_extract_all(body, '{p}') AS hits, string_split_regex(body, '{p}') AS gaps FROM t)"


def _quoted(pattern: str) -> str:
    return pattern.replace(r"\x20", " ").replace("'", "''")


def op4() -> str:
    """Spans from the pieces between matches; gains from the trained table as a literal list."""
    table = secrets.train_reference(secrets.labelled_samples())
    n = len(secrets.SYMBOLS)
    patterns = {"assign": secrets.ASSIGN, "access": secrets.ACCESS, "hex": "[0-9a-f]{16,}", "random": secrets.TOKEN}
    parts = [KIND_SQL.format(k=k, p=_quoted(p)) for k, p in patterns.items()]
    for rank, k in enumerate(patterns):
        parts.append(f"""spans_{k} AS (SELECT key, {rank} AS rank, '{k}' AS kind, hits[i] AS token,
          list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda g: length(g))), 0) AS start
          FROM (SELECT key, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM hits_{k}))""")
    head = _quoted(secrets.ASSIGN_HEAD)
    parts.append(f"""base AS (SELECT key, rank, kind, CAST(start AS BIGINT) AS start, CAST(start + length(token) AS BIGINT) AS stop FROM (
        SELECT * FROM spans_assign WHERE length(regexp_replace(token, '{head}', '')) >= 12 UNION ALL SELECT * FROM spans_access WHERE length(token) >= 18
        UNION ALL SELECT * FROM spans_hex))""")
    parts.append(f"""scored AS (SELECT key, rank, kind, start, stop FROM (SELECT key, rank, kind, CAST(start AS BIGINT) AS start, CAST(start + length(token) AS BIGINT) AS stop, length(token) AS n,
        regexp_replace(regexp_replace(token, '[0-9]', '0', 'g'), '[^A-Za-z0]', '_', 'g') AS s FROM spans_random)
        WHERE list_sum(list_transform(range(1, n), lambda i: CAST({table} AS INTEGER[])[(instr('{secrets.SYMBOLS}', s[i]) - 1) * {n} + instr('{secrets.SYMBOLS}', s[i + 1])])) >= {secrets.MARGIN} * (n - 1))""")
    parts.append("extra AS (SELECT * FROM scored s WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.key IS NOT DISTINCT FROM s.key AND b.start < s.stop AND s.start < b.stop))")
    parts.append("""digest AS (SELECT key, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
        coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank), '') AS listed FROM base GROUP BY key)""")
    parts.append("""every AS (SELECT key, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS listed FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY key)""")
    return f"""WITH t AS (SELECT doc_id AS key, coalesce(text, '') AS body FROM documents), {", ".join(parts)}
      SELECT key AS doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(digest.listed, '')) AS base_sha256,
      coalesce(every.listed, '') AS spans FROM t LEFT JOIN digest USING (key) LEFT JOIN every USING (key)"""


def op6() -> str:
    """Raking as a recursive query: one step a marginal, three a round."""
    values = lambda name, m: ", ".join(f"('{name}', '{k}', CAST({v} AS DOUBLE))" for k, v in m.items())
    named = lambda c, m: f"CASE WHEN {c} IN ({', '.join(repr(k) for k in m if k != mixing.OTHER)}) THEN {c} ELSE 'other' END"
    steps = 3 * mixing.ROUNDS
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS body, {named("source", mixing.SOURCES)} AS source, {named("lang", mixing.LANGS)} AS lang FROM documents),
placed AS (SELECT doc_id, source, lang, CASE WHEN length(body) - length(replace(body, '|', '')) >= 5 THEN 'tabular' WHEN regexp_matches(body, '[0-9]{{3}}') THEN 'figures'
   WHEN length(body) >= 2000 THEN 'long' ELSE 'short' END AS topic, greatest(len(regexp_extract_all(body, '[^ \\x09-\\x0D]+')), 1) AS tokens FROM d),
target AS (SELECT * FROM (VALUES {values("s", mixing.SOURCES)}, {values("l", mixing.LANGS)}, {values("t", mixing.TOPICS)}) x(dim, name, share)),
cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS n FROM placed GROUP BY ALL),
present AS (SELECT dim, name, share / sum(share) OVER (PARTITION BY dim) AS share FROM target WHERE (dim = 's' AND name IN (SELECT source FROM cells))
   OR (dim = 'l' AND name IN (SELECT lang FROM cells)) OR (dim = 't' AND name IN (SELECT topic FROM cells))),
shares AS (SELECT source, lang, topic, n, s.share AS ss, l.share AS ls, t.share AS ts FROM cells JOIN present s ON s.dim = 's' AND s.name = source
   JOIN present l ON l.dim = 'l' AND l.name = lang JOIN present t ON t.dim = 't' AND t.name = topic),
rake AS (SELECT 0 AS step, source, lang, topic, n, ss, ls, ts, n AS w FROM shares UNION ALL
  SELECT step + 1, source, lang, topic, n, ss, ls, ts, CASE step % 3 WHEN 0 THEN w * (ss / sum(w) OVER (PARTITION BY source)) WHEN 1 THEN w * (ls / sum(w) OVER (PARTITION BY lang))
    ELSE w * (ts / sum(w) OVER (PARTITION BY topic)) END FROM rake WHERE step < {steps}),
factors AS (SELECT source, lang, topic, w / (n / sum(n) OVER ()) AS factor FROM rake WHERE step = {steps}),
scaled AS (SELECT *, factor / max(factor) OVER () AS p FROM factors)
SELECT doc_id, source, lang, topic, CAST(tokens AS BIGINT) AS tokens, round(factor, 6) AS factor, round(p, 6) AS probability,
  CAST('0x' || substr(md5('20:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) / 281474976710656.0 < p AS kept
FROM placed JOIN scaled USING (source, lang, topic)
"""


def op7() -> str:
    """Pages of these tables have no redirects or canonical links, so the method's verdict is allow."""
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in url_filter.RULES)
    rest = "substr(url, instr(url, '://') + 3)"
    return f"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN translate(regexp_extract({rest}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  CASE WHEN instr(url, '://') > 0 THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
r AS (SELECT * FROM (VALUES {rules}) x(verdict, rhost, rpath)),
names AS (SELECT DISTINCT host, path FROM p),
best AS (SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM names JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best ON best.host = p.host AND best.path = p.path
"""


def op10(shards: int = 16) -> str:
    """CRC-32 by table over the bytes in hexadecimal; the jump as a recursive query over distinct keys."""
    return f"""
WITH RECURSIVE poly AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce([CAST(n AS UBIGINT)] || [CAST(0 AS UBIGINT) FOR x IN range(8)],
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(CAST(3988292384 AS UBIGINT), a >> 1) ELSE a >> 1 END) AS c FROM range(256) r(n))),
d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, size, CAST(xor(list_reduce([CAST(4294967295 AS UBIGINT)] || list_transform(range(0, CAST(size AS BIGINT) - 1), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS UBIGINT)),
    lambda a, b: xor(t[CAST(xor(a, b) & 255 AS BIGINT) + 1], a >> 8)), CAST(4294967295 AS UBIGINT)) AS BIGINT) AS crc,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k FROM d, poly),
jump AS (SELECT DISTINCT k, n, CAST(k AS HUGEINT) AS state, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j FROM c, (VALUES ({shards}), ({shards + 1})) x(n) UNION ALL
  SELECT k, n, next, j, CAST(floor((j + 1) * (2147483648.0::DOUBLE / CAST((next >> 33) + 1 AS DOUBLE))) AS BIGINT) FROM (
    SELECT *, (state * {int(sharding.STEP)} + 1) % 18446744073709551616 AS next FROM jump WHERE j < n)),
places AS (SELECT k, n, max(b) AS shard FROM jump WHERE j >= n GROUP BY k, n)
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, CAST(one.shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY one.shard ORDER BY c.k >> 55, crc >> 27, crc, c.k, doc_id NULLS FIRST, size) - 1 AS slot, CAST(more.shard AS INTEGER) AS grown_shard
FROM c JOIN places one ON one.k = c.k AND one.n = {shards} JOIN places more ON more.k = c.k AND more.n = {shards + 1}
"""


def oracles() -> dict[str, str]:
    return {"op1_embedding_dedup": OP1, "op4_secrets": op4(), "op5_warc": OP5, "op6_mixing": op6(), "op7_url_filter": op7(), "op10_sharding": op10()}
