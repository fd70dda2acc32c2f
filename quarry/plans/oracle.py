"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans, straight from each query's
definition, over the same pre-registered table views.
"""

from __future__ import annotations

from quarry.functions.scalars import ADDRESS_PATTERN, REPORT_FORMAT, STATIC_RANGES
from quarry.plans.catalog import (GROUP_WINDOW_N, LINE_WINDOW_N, SUM_HAVING_THRESHOLD, TOP_GROUPS, TOP_TYPES,
                                  TOP_WORDS, TYPE_WINDOW_N, WINDOW_SUM_N)

LINES = """lines AS (
  SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS line_no,
         unnest(string_split(text, chr(10))) AS line
  FROM documents)"""

CLEAN_WORDS = ("list_filter(regexp_split_to_array(regexp_replace(lower({x}), '[^a-z0-9 ]', '', 'g'), ' +'), "
               "lambda t: t <> '')")

PAIRS = "list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1])"

EVENT_EDGES = """edges AS (
  SELECT user_id AS src, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS dst FROM events
  WHERE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL)"""

EVENT_ORD = "ev AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS ord FROM events)"


def _bucket_sql(x: str) -> str:
    whens = " ".join(
        f"WHEN substr({x}, 1, 1) IN ({', '.join(repr(c) for c in chars)}) THEN {b}"
        for b, chars in enumerate(STATIC_RANGES))
    return f"(CASE {whens} ELSE 0 END)"


_SENT_BIGRAMS = f"""
  sent AS (SELECT {{key}} unnest(regexp_split_to_array(lower({{src}}), '[.!?\\n]')) AS s FROM {{tbl}}),
  sw AS (SELECT {{key}} list_filter(regexp_split_to_array(s, '\\W+'), lambda t: t <> '') AS w FROM sent),
  sb AS (SELECT {{key}} unnest({PAIRS.format(w='w')}) AS bigram FROM sw)"""


def _line_window_top(item_sql: str, item: str, n: int, k: int) -> str:
    return f"""
WITH {LINES},
  o AS (SELECT *, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS ord FROM lines),
  ok AS (SELECT ord // {n} AS window_id FROM o GROUP BY 1 HAVING count(*) = {n}),
  {item_sql},
  c AS (SELECT window_id, {item}, count(*) AS n FROM items
        WHERE window_id IN (SELECT window_id FROM ok) GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY n DESC, {item}) AS rank FROM c)
SELECT CAST(window_id AS BIGINT) AS window_id, {item}, n, rank FROM r WHERE rank <= {k}
"""


def _group_parts(group: str = "user_id", n: int = GROUP_WINDOW_N) -> str:
    return f"""{EVENT_ORD},
  ok AS (SELECT ord // {n} AS window_id FROM ev GROUP BY 1 HAVING count(*) = {n}),
  p AS (SELECT ord // {n} AS window_id, {group}, count(*) AS n, max(value) AS max_value,
               first(ord ORDER BY value DESC, ord) AS best_ord,
               first(event_id ORDER BY value DESC, ord) AS top_item
        FROM ev GROUP BY 1, 2)"""


def _cumulative(group: str, n: int, k: int) -> str:
    return f"""
WITH {_group_parts(group, n)},
  g AS (SELECT {group}, min(window_id) AS f FROM p GROUP BY 1),
  grid AS (SELECT {group}, unnest(range(f, (SELECT max(window_id) FROM ok) + 1)) AS window_id FROM g),
  c AS (SELECT grid.window_id, grid.{group}, CAST(sum(p.n) AS BIGINT) AS n, max(p.max_value) AS max_value,
               first(p.top_item ORDER BY p.max_value DESC, p.best_ord) AS top_item
        FROM grid JOIN p ON p.{group} = grid.{group} AND p.window_id <= grid.window_id
        GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY n DESC, {group}) AS rank FROM c)
SELECT CAST(window_id AS BIGINT) AS window_id, rank, {group}, n, max_value, top_item
FROM r WHERE rank <= {k}"""


ORACLE: dict[str, str] = {
    "word_count": r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""",

    "word_count_pig": r"""
SELECT word, count(word) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[ ",()*\n]+')) AS word FROM documents)
WHERE regexp_full_match(word, '\w+') GROUP BY word ORDER BY n DESC, word""",

    "word_count_java_split": f"""
WITH {LINES},
  toks AS (SELECT unnest(CASE WHEN line = '' THEN ['']
                              WHEN regexp_full_match(line, '\\s+') THEN []::VARCHAR[]
                              ELSE regexp_split_to_array(regexp_replace(line, '\\s+$', ''), '\\s+') END) AS word
           FROM lines)
SELECT word, count(*) AS n FROM toks GROUP BY word ORDER BY n, word""",

    "word_count_lower_top10": rf"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM documents)
WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT {TOP_WORDS}""",

    "token_total": r"""
SELECT CAST(count(*) AS BIGINT) AS total
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> ''""",

    "bigram_count": f"""
WITH {LINES},
  w AS (SELECT {CLEAN_WORDS.format(x='line')} AS w FROM lines)
SELECT bigram, count(*) AS n FROM (SELECT unnest({PAIRS.format(w='w')}) AS bigram FROM w) GROUP BY bigram""",

    "bigram_representative": f"""
WITH {LINES},
  w AS (SELECT {CLEAN_WORDS.format(x='line')} AS w FROM lines),
  c AS (SELECT bigram, count(*) AS n FROM (SELECT unnest({PAIRS.format(w='w')}) AS bigram FROM w) GROUP BY bigram)
SELECT n, min(bigram) AS bigram FROM c GROUP BY n ORDER BY n""",

    "bigram_sentence": "WITH" + _SENT_BIGRAMS.format(key="", src="text", tbl="documents") + """
SELECT bigram, count(*) AS n FROM sb GROUP BY bigram""",

    "bigram_cross_line": f"""
WITH {LINES},
  w AS (SELECT doc_id, line_no, {CLEAN_WORDS.format(x='line')} AS w FROM lines),
  ne AS (SELECT doc_id, line_no, w[1] AS first, w[-1] AS last FROM w WHERE len(w) > 0),
  p AS (SELECT last, lead(first) OVER (PARTITION BY doc_id ORDER BY line_no) AS nxt FROM ne)
SELECT last || ' ' || nxt AS bigram, count(*) AS n FROM p WHERE nxt IS NOT NULL GROUP BY 1""",

    "two_line_records": f"""
WITH {LINES}
SELECT doc_id, CAST(line_no // 2 + 1 AS BIGINT) AS rec_no, string_agg(line, '' ORDER BY line_no) AS record
FROM lines GROUP BY doc_id, line_no // 2""",

    "json_path_count": """
SELECT json_extract_string(props, '$.k') AS tag, count(*) AS n FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1 ORDER BY n, tag""",

    "multiline_json_count": """
SELECT json_extract_string(props, '$.k') AS tag, count(*) AS n FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1 ORDER BY n, tag""",

    "delimited_header_sum_having": f"""
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders GROUP BY o_custkey
HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) > {SUM_HAVING_THRESHOLD}
ORDER BY total_price DESC, o_custkey""",

    # 18-digit limbs summed by position, then carried upwards: exact for tokens of any length
    "integer_total": r"""
WITH RECURSIVE t AS (SELECT tok FROM (SELECT unnest(regexp_split_to_array(text, '\W+')) AS tok FROM documents)
                     WHERE regexp_full_match(tok, '[0-9]+')),
  l AS (SELECT i, CAST(substr(tok, greatest(length(tok) - 18 * (i + 1), 0) + 1,
                              least(18, length(tok) - 18 * i)) AS HUGEINT) AS limb
        FROM t, unnest(range(0, (length(tok) + 17) // 18)) r(i)),
  s AS (SELECT i, sum(limb) AS s FROM l GROUP BY i),
  c(i, carry, digits) AS (
    SELECT 0::BIGINT, 0::HUGEINT, ''
    UNION ALL
    SELECT c.i + 1, (c.carry + coalesce(s.s, 0)) // 1000000000000000000,
           lpad(CAST((c.carry + coalesce(s.s, 0)) % 1000000000000000000 AS VARCHAR), 18, '0') || c.digits
    FROM c LEFT JOIN s ON s.i = c.i WHERE c.i <= (SELECT max(i) FROM s))
SELECT coalesce(nullif(ltrim(CAST(carry AS VARCHAR) || digits, '0'), ''), '0') AS total
FROM c ORDER BY i DESC LIMIT 1""",

    "header_skip_sum_having": f"""
WITH r AS (SELECT o_custkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM r WHERE rn > 1 GROUP BY o_custkey
HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) > {SUM_HAVING_THRESHOLD}
ORDER BY total_price DESC, o_custkey""",

    "distinct_pairs_per_source": """
SELECT source, count(source) AS n
FROM (SELECT DISTINCT l_suppkey AS source, l_partkey AS dest FROM lineitem WHERE l_returnflag = 'R')
GROUP BY source ORDER BY n DESC, source""",

    "address_extract": f"""
WITH a AS (SELECT event_id, concat_ws('.', CAST(user_id AS VARCHAR), json_extract_string(props, '$.k'),
                                     event_type, CAST(event_id % 256 AS VARCHAR)) AS address FROM events)
SELECT event_id, address, nullif(regexp_extract(address, '{ADDRESS_PATTERN}', 0), '') AS host FROM a""",

    "filtered_join_count": """
SELECT l.l_suppkey AS source, count(*) AS n
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'F' GROUP BY 1""",

    "filtered_join_count_sorted": """
WITH c AS (SELECT l.l_suppkey AS source, count(*) AS n
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           WHERE o.o_orderstatus = 'F' GROUP BY 1)
SELECT source, n, row_number() OVER (ORDER BY n DESC, source) AS rank FROM c""",

    "count_max_argmax": """
SELECT o_orderpriority AS language, count(*) AS n, max(o_totalprice) AS max_value,
       first(o_orderkey ORDER BY o_totalprice DESC, o_orderkey) AS top_item
FROM orders GROUP BY 1 ORDER BY n DESC, language""",

    "fixed_width_report": f"""
WITH s AS (SELECT o_orderpriority AS language, count(*) AS n, max(o_totalprice) AS max_value,
                  first(o_orderkey ORDER BY o_totalprice DESC, o_orderkey) AS top_item
           FROM orders GROUP BY 1)
SELECT printf('{REPORT_FORMAT}', language, n, CAST(top_item AS VARCHAR),
              CAST(CAST(max_value AS DECIMAL(18,2)) AS VARCHAR)) AS line FROM s""",

    "outlier_3sigma": """
WITH p AS (SELECT user_id AS ticker, year(ts) AS year, event_id, value AS price FROM events),
  s AS (SELECT *, avg(price) OVER w AS m, stddev_pop(price) OVER w AS sd
        FROM p WINDOW w AS (PARTITION BY ticker, year)),
  l AS (SELECT ticker, year, event_id, price,
               CASE WHEN price < m - 3 * sd THEN 'low' WHEN price > m + 3 * sd THEN 'high' ELSE 'flat' END AS label
        FROM s)
SELECT * FROM l WHERE label <> 'flat'""",

    "xor_checksum": """
WITH b AS (SELECT doc_id, string_split(rtrim(regexp_replace(hex(encode(text)), '(..)', '\\1,', 'g'), ','), ',') AS hx
           FROM documents),
  x AS (SELECT doc_id, bit_xor(CAST(('0x' || h) AS INTEGER)) AS v
        FROM (SELECT doc_id, unnest(hx) AS h FROM b) GROUP BY doc_id)
SELECT doc_id, CAST(CASE WHEN v >= 128 THEN v - 256 ELSE v END AS INTEGER) AS checksum FROM x""",

    "total_order_sort": """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS value,
       row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR), o_orderpriority) AS rank
FROM orders""",

    "static_range_buckets": rf"""
WITH w AS (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS key FROM documents)
SELECT {_bucket_sql('key')} AS bucket, count(*) AS n FROM w WHERE key <> '' GROUP BY 1""",

    "static_range_sorted": f"""
WITH {LINES},
  t AS (SELECT doc_id, line_no,
               list_filter(regexp_split_to_array(line, '[ \\t\\n\\r\\f]+'), lambda x: x <> '') AS t FROM lines),
  kv AS (SELECT doc_id, line_no, t[1] AS key, coalesce(t[2], '') AS value FROM t WHERE len(t) >= 1)
SELECT doc_id, line_no, key, value, {_bucket_sql('key')} AS bucket,
       row_number() OVER (PARTITION BY {_bucket_sql('key')} ORDER BY key, value, doc_id, line_no) AS rank_in_bucket
FROM kv""",

    "neighbour_sets": f"""
WITH {EVENT_EDGES},
  nb AS (SELECT DISTINCT least(src, dst) AS node, greatest(src, dst) AS neighbour FROM edges)
SELECT node, neighbour, count(*) OVER (PARTITION BY node) AS n_neighbours FROM nb""",

    "two_hop_links": f"""
WITH {EVENT_EDGES},
  e AS (SELECT DISTINCT src AS s, dst AS d FROM edges)
SELECT DISTINCT e1.s AS a, e2.d AS c FROM e e1 JOIN e e2 ON e1.d = e2.s WHERE e2.d <> e1.s""",

    "common_neighbours": f"""
WITH {EVENT_EDGES}
SELECT p.src, p.dst, count(r.x) AS common
FROM (SELECT DISTINCT src, dst FROM edges WHERE src IS NOT NULL AND dst IS NOT NULL) p
  LEFT JOIN edges l ON l.src = p.src
  LEFT JOIN (SELECT DISTINCT src AS v, dst AS x FROM edges) r ON r.v = p.dst AND r.x = l.dst
GROUP BY p.src, p.dst""",

    "triangle_count": f"""
WITH {EVENT_EDGES},
  ce AS (SELECT DISTINCT least(src, dst) AS lo, greatest(src, dst) AS hi FROM edges WHERE src <> dst)
SELECT count(*) AS triangles
FROM ce e1 JOIN ce e2 ON e1.hi = e2.lo JOIN ce e3 ON e3.lo = e1.lo AND e3.hi = e2.hi""",

    "count_window_sum": f"""
WITH {EVENT_ORD}
SELECT CAST(ord // {WINDOW_SUM_N} AS BIGINT) AS window_id,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM ev GROUP BY 1 HAVING count(*) = {WINDOW_SUM_N}""",

    "count_window_running_sum": f"""
WITH {EVENT_ORD},
  w AS (SELECT ord // {WINDOW_SUM_N} AS window_id, sum(CAST(value AS DECIMAL(18,2))) AS s
        FROM ev GROUP BY 1 HAVING count(*) = {WINDOW_SUM_N})
SELECT CAST(window_id AS BIGINT) AS window_id,
       CAST(sum(s) OVER (ORDER BY window_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
         AS running_total
FROM w""",

    "count_window_word_top10": _line_window_top(
        r"""items AS (SELECT window_id, word FROM (
        SELECT ord // %d AS window_id, unnest(regexp_split_to_array(line, '\W+')) AS word FROM o)
        WHERE word <> '')""" % LINE_WINDOW_N, "word", LINE_WINDOW_N, TOP_WORDS),

    "count_window_bigram_top10": _line_window_top(
        r"""items AS (
    SELECT window_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram
    FROM (SELECT window_id, list_filter(regexp_split_to_array(s, '\W+'), lambda t: t <> '') AS w
          FROM (SELECT ord // %d AS window_id, unnest(regexp_split_to_array(lower(line), '[.!?\n]')) AS s
                FROM o)))""" % LINE_WINDOW_N, "bigram", LINE_WINDOW_N, TOP_WORDS),

    "count_window_group_top7": f"""
WITH {_group_parts()},
  r AS (SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY n DESC, user_id) AS rank
        FROM p WHERE window_id IN (SELECT window_id FROM ok))
SELECT CAST(window_id AS BIGINT) AS window_id, rank, user_id, n, max_value, top_item
FROM r WHERE rank <= {TOP_GROUPS}""",

    "cumulative_group_top7": _cumulative("user_id", GROUP_WINDOW_N, TOP_GROUPS),
    "cumulative_type_top3": _cumulative("event_type", TYPE_WINDOW_N, TOP_TYPES),

    "file_two_line_records": f"""
WITH {LINES},
  o AS (SELECT lang, line, row_number() OVER (PARTITION BY lang ORDER BY doc_id, line_no) - 1 AS i
        FROM lines JOIN documents USING (doc_id))
SELECT lang, CAST(i // 2 + 1 AS BIGINT) AS rec_no, string_agg(line, '' ORDER BY i) AS record
FROM o GROUP BY lang, i // 2""",

    "file_csv_outliers": """
WITH p AS (SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(year(ts) AS VARCHAR) AS year,
                  strftime(ts, '%Y-%m-%d %H:%M:%S') AS date, value AS price FROM events),
  s AS (SELECT *, avg(price) OVER w AS m, stddev_pop(price) OVER w AS sd
        FROM p WINDOW w AS (PARTITION BY ticker, year)),
  l AS (SELECT ticker, year, date, price,
               CASE WHEN price < m - 3 * sd THEN 'low' WHEN price > m + 3 * sd THEN 'high' ELSE 'flat' END AS label
        FROM s)
SELECT * FROM l WHERE label <> 'flat'""",

    "file_hashtags": """
SELECT '"' || tag || '"' AS tag, count(*) AS n
FROM (SELECT unnest([json_extract_string(props, '$.k'), event_type]) AS tag FROM events WHERE event_id % 10 <> 0)
WHERE tag IS NOT NULL GROUP BY 1""",
}

ORACLE["file_static_ranges"] = f"""
WITH r AS ({ORACLE["static_range_sorted"]})
SELECT CAST(bucket AS INTEGER) AS bucket, row_number() OVER (PARTITION BY bucket ORDER BY key) - 1 AS place, key FROM r"""
ORACLE["distinct_over_periods"] = """
SELECT l_suppkey, count(DISTINCT l_partkey) >= 75 AS reaches FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY l_suppkey"""
ORACLE["file_bad_records"] = """
SELECT 'tag' AS kind, tag AS text, count(*) AS n
FROM (SELECT unnest([json_extract_string(props, '$.k'), event_type]) AS tag FROM events WHERE event_id % 10 <> 0)
WHERE tag IS NOT NULL GROUP BY tag
UNION ALL SELECT 'bad record', '{' || chr(10) || '{ broken ' || event_type || chr(10) || '}', count(*)
FROM events WHERE event_id % 10 = 0 GROUP BY event_type
UNION ALL SELECT 'observed', 'objects', count(*) FROM events
UNION ALL SELECT 'observed', 'malformed', count(*) FROM events WHERE event_id % 10 = 0"""
ORACLE["file_word_count"] = ORACLE["word_count"]
ORACLE["file_total_order"] = ORACLE["total_order_sort"]
ORACLE["file_tuple_sink"] = f"""
WITH c AS ({ORACLE["word_count_java_split"]})
SELECT '(' || CAST(n AS VARCHAR) || ',' || word || ')' AS line FROM c"""

ORACLE["outlier_3sigma_join"] = ORACLE["outlier_3sigma"]
# Alternative plans of the same queries share their oracle.
ORACLE["bigram_cross_line_lines"] = ORACLE["bigram_cross_line"]
ORACLE["bigram_count_two_round"] = ORACLE["bigram_count"]
ORACLE["token_total_two_round"] = ORACLE["token_total"]
ORACLE["two_line_records_grouped"] = ORACLE["two_line_records"]
ORACLE["triangle_count_by_id"] = ORACLE["triangle_count"]

# The streaming queries end in the same state as their batch counterparts.
from quarry.streaming.jobs import STREAM_ORACLE_OF  # noqa: E402

for _stream, _batch in STREAM_ORACLE_OF.items():
    ORACLE[_stream] = ORACLE[_batch]
