"""DuckDB SQL for the operators that SQL can express.

SimHash (XXH64), the PII permutation, the learnt toxicity model and the
pipeline built on them have none; the tests hold those against brute-force
versions.
"""

from __future__ import annotations

# The CRC-32 of UTF-8 bytes, byte by byte over a table made by its rule.
_CRC = """
  crc_table AS (
    SELECT list(v ORDER BY i) AS tab FROM (
      SELECT i, list_reduce([i::UBIGINT] || list_transform(range(8), lambda x: 0::UBIGINT),
                            lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS v
      FROM range(256) t(i)))
"""

_OP1 = f"""
WITH {_CRC.strip()},
  raw AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents),
  d AS (
    SELECT doc_id, n + 1 AS size,
      (xor(list_reduce([4294967295::UBIGINT] || list_transform(regexp_extract_all(x, '..'), lambda h: ('0x' || h)::UBIGINT),
         lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255)::INT + 1])), 4294967295::UBIGINT))::BIGINT AS text_crc32
    FROM raw, crc_table),
  s AS (
    SELECT d.*, i, 1.0 / -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '\\N') || '#' || i), 1, 13))::BIGINT + 0.5)
                            / 4503599627370496.0) AS score
    FROM d, range(17) t(i)),
  p AS (
    SELECT doc_id, size, text_crc32,
      arg_max(i, score) FILTER (WHERE i < 16)::INT AS shard, arg_max(i, score)::INT AS grown_shard
    FROM s GROUP BY ALL)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY substr(md5(coalesce(doc_id::VARCHAR, '\\N') || '|' || size || '|'
    || text_crc32 || '|0'), 1, 3), doc_id, size, text_crc32) - 1 AS slot,
  grown_shard
FROM p
"""

_WORDS = r"""regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_OP2 = f"""
WITH items AS (SELECT item_id, {_WORDS.format(t='text')} AS w FROM benchmark),
  item_windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
    FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0),
  docs AS (SELECT doc_id, {_WORDS.format(t='text')} AS w FROM documents),
  doc_windows AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM docs, (SELECT DISTINCT n FROM item_windows) l, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) t(i)),
  hits AS (SELECT doc_id, i, d.n, item_id FROM doc_windows d JOIN item_windows USING (g, n)),
  hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) t(p) GROUP BY doc_id),
  hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
  d AS (
    SELECT page_id, strlen(h) AS payload_bytes,
      array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(x, (k // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INT + 1, 1)), '') AS payload_digest
    FROM p),
  g AS (SELECT payload_digest, max(page_id) AS response FROM d GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM d JOIN g USING (payload_digest)
"""

_OP5 = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
  links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
  reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
  c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
  n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

_OP6 = """
WITH l AS (
    SELECT doc_id, source, s AS line, p FROM (
      SELECT doc_id, source, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS p
      FROM documents)),
  bad AS (SELECT trim(line, ' ') AS t FROM l WHERE trim(line, ' ') <> '' GROUP BY ALL HAVING count(DISTINCT source) >= 5)
SELECT doc_id, count(*) AS n_lines, count(b.t) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE b.t IS NULL), '') AS text
FROM l LEFT JOIN bad b ON trim(l.line, ' ') = b.t GROUP BY doc_id
"""

_OP7 = """
WITH RECURSIVE c AS (SELECT source, count(*) AS n_rows, sqrt(count(*)) AS w FROM documents GROUP BY source),
  s AS (SELECT source, row_number() OVER (ORDER BY source) AS i,
          greatest(1, floor(w / sum(w) OVER () * greatest(1000, 64 * count(*) OVER ()) + 0.5))::BIGINT AS n FROM c),
  n AS (SELECT list(n ORDER BY i) AS n, sum(n)::BIGINT AS period FROM s),
  edf(t, k, pick, n, period) AS (
    SELECT -1::BIGINT, list_transform(n, lambda x: 0::BIGINT), NULL::STRUCT(d BIGINT, m BIGINT, i BIGINT, r BIGINT), n, period FROM n
    UNION ALL
    SELECT t + 1, list_transform(k, lambda x, i: CASE WHEN i = best.i THEN x + 1 ELSE x END), best, n, period FROM (
      SELECT t, k, n, period, list_min(list_filter(list_transform(n, lambda x, i:
          {'d': ((k[i] + 1) * period + x - 1) // x,
           'm': -x, 'i': i, 'r': k[i] * period // x}),
        lambda y: y.r <= t + 1 AND k[y.i] < n[y.i])) AS best
      FROM edf WHERE t < period - 1)),
  sched AS (
    SELECT s.source, s.n, e.pick.r AS release, e.pick.d AS deadline, e.t AS slot,
      row_number() OVER (PARTITION BY s.source ORDER BY e.t) - 1 AS k
    FROM edf e JOIN s ON s.i = e.pick.i WHERE e.t >= 0),
  numbered AS (
    SELECT doc_id, source, row_number() OVER (PARTITION BY source
      ORDER BY substr(md5(coalesce(doc_id::VARCHAR, '\\N') || '|0'), 1, 3), doc_id) - 1 AS r FROM documents),
  blocks AS (SELECT doc_id, source, r // 16 AS block, r % 16 AS in_block FROM numbered)
SELECT doc_id, b.source, block, in_block, block // x.n * period + release AS release, block // x.n * period + deadline AS deadline,
  block // x.n * period + slot AS slot, dense_rank() OVER (ORDER BY block // x.n * period + slot) - 1 AS position
FROM blocks b JOIN sched x ON x.source = b.source AND x.k = b.block % x.n, n
"""

_OP8 = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
  h AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
  r(v, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                          ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
  best AS (
    SELECT page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS said
    FROM h LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
    GROUP BY page_id, host, path)
SELECT page_id, host, path, rule,
  coalesce(said, CASE WHEN regexp_matches(host, '(^|[.-])(spam|casino|bets|adult)([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict,
  regexp_matches(host, '(^|[.-])(spam|casino|bets|adult)([.-]|$)') AS listed
FROM best
"""

# The levels of all trees from the leaves up ('' above the languages), then every leaf's way up with its siblings.
_H = "CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v} END"
_LEAF = "sha256(" + " || ".join(_H.format(v=v) for v in ("doc_id", "source", "lang", "n_chars")) + " || " + _H + ")"
_OP11 = f"""
WITH RECURSIVE {_CRC.strip()},
  d AS (
    SELECT doc_id, coalesce('=' || lang, '') AS g, {_LEAF.format(v='text')} AS leaf,
      {_LEAF.format(v="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS low,
      xor(list_reduce([4294967295::UBIGINT] || list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::UBIGINT),
        lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255)::INT + 1])), 4294967295::UBIGINT) AS crc
    FROM documents, crc_table),
  l AS (
    SELECT doc_id, g, leaf, CASE WHEN crc % 3 = 0 THEN low ELSE leaf END AS tampered,
      row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY g) AS n FROM d),
  tree(g, h, i, digest, n) AS (
    SELECT g, 0::BIGINT, r, leaf, n FROM l
    UNION ALL
    SELECT g, h + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i)), max((n + 7) // 8) FROM tree WHERE n > 1 GROUP BY g, h, i // 8),
  subs AS (SELECT g, h, digest, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n FROM tree WHERE n = 1),
  top(h, i, digest, n) AS (
    SELECT 0::BIGINT, r, digest, n FROM subs
    UNION ALL
    SELECT h + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i)), max((n + 7) // 8) FROM top WHERE n > 1 GROUP BY h, i // 8),
  -- one space of levels for each language: its own tree, then the tree above from its height on
  nodes AS (
    SELECT g, h, i, digest FROM tree WHERE n > 1
    UNION ALL SELECT s.g, s.h + t.h, t.i, t.digest FROM subs s, top t WHERE t.n > 1),
  sib AS (
    SELECT g, h, i // 8 AS run, list(digest ORDER BY i) AS kids FROM nodes GROUP BY ALL),
  up(g, r, h, i, own, path, folded) AS (
    SELECT g, r, 0::BIGINT, r, leaf, '', tampered FROM l
    UNION ALL
    SELECT u.g, u.r, u.h + 1, CASE WHEN u.h + 1 = s.h THEN s.r ELSE u.i // 8 END, u.own,
      u.path || array_to_string(k.kids[1:(u.i % 8)] || k.kids[(u.i % 8 + 2):], ''),
      sha256(array_to_string(k.kids[1:(u.i % 8)] || [u.folded] || k.kids[(u.i % 8 + 2):], ''))
    FROM (SELECT u.g, u.r, u.h, CASE WHEN u.h = s.h THEN s.r ELSE u.i END AS i, u.own, u.path, u.folded FROM up u JOIN subs s USING (g)) u
      JOIN sib k ON k.g = u.g AND k.h = u.h AND k.run = u.i // 8 JOIN subs s ON s.g = u.g),
  done AS (SELECT g, r, arg_max(path, h) AS path, arg_max(folded, h) AS folded FROM up GROUP BY g, r)
SELECT doc_id, leaf, s.digest AS subroot, top.digest AS root, sha256(path) AS proof_sha256, folded AS folded_root,
  folded = top.digest AS verified
FROM l JOIN done USING (g, r) JOIN subs s USING (g), top WHERE top.n = 1
"""

_FAR = "list_sum(list_transform(range(1, len({a}) + 1), lambda j: ({a}[j] - {b}[j]) * ({a}[j] - {b}[j])))::BIGINT"


def _assign(n: int) -> str:
    """The nearest entry of codebook c<n> for every part."""
    return f"""
  f{n} AS (SELECT rid, p.p, c.i, {_FAR.format(a='p.x', b='c.x')} AS far FROM parts p JOIN c{n} c ON c.p = p.p),
  a{n} AS (SELECT rid, p, arg_min(i, (far, i)) AS i, min(far) AS far FROM f{n} GROUP BY rid, p)"""


def _means(n: int) -> str:
    """Codebook c<n + 1>: floored means of the parts assigned in round n."""
    return f"""
  s{n} AS (
    SELECT a.p, a.i, j, sum(p.x[j])::HUGEINT AS s, count(*)::HUGEINT AS n
    FROM a{n} a JOIN parts p ON p.rid = a.rid AND p.p = a.p, unnest(range(1, len(p.x) + 1)) t(j) GROUP BY ALL),
  m{n} AS (SELECT p, i, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS x FROM s{n} GROUP BY p, i),
  c{n + 1} AS (SELECT p, i, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN m{n} m USING (p, i))"""


_OP13 = f"""
WITH v AS (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS rid, vec_id, label,
      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  parts AS (SELECT rid, p, x[p * (len(x) // 16) + 1:(p + 1) * (len(x) // 16)] AS x FROM v, unnest(range(16)) t(p)),
  c0 AS (SELECT p, rid AS i, x FROM parts WHERE rid < 64),{_assign(0)},{_means(0)},{_assign(1)},{_means(1)},{_assign(2)},
  books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, i)) AS codebooks_sha256 FROM c2),
  coded AS (
    SELECT rid, string_agg(lower(lpad(to_hex(i), 2, '0')), '' ORDER BY p) AS code, sum(far)::BIGINT AS error FROM a2 GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN v USING (rid), books
"""

ORACLE: dict[str, str] = {
    "op1_sharding": _OP1,
    "op2_decontamination": _OP2,
    "op4_warc": _OP4,
    "op5_embedding_graph": _OP5,
    "op6_line_dedup": _OP6,
    "op7_mixing": _OP7,
    "op8_url_cascade": _OP8,
    "op11_merkle": _OP11,
    "op13_vector_codes": _OP13,
}
