"""DuckDB SQL for every query in ``catalog``.

The SQL recomputes everything from the raw tables with its own arithmetic --
CRC-32 bit by bit, the 128-bit generator as four 32-bit limbs in a recursive
CTE, split points by ``row_number``.  It shares the generator's constants and the
queries' parameters with the Spark side, no code that computes.
Binary values are compared as upper-case hex strings, sums as decimal text.
"""

from __future__ import annotations

from sortproof.functions.lcg import LCG_A, LCG_C
from sortproof.plans import params as Q

M32 = 0xFFFFFFFF

# --- fixed values: published generator state after 10^10 steps ----------------
SKIP_1E10_STATE = 0xE377CEDF9C14E6C9996B6682A78A1C00
# -----------------------------------------------------------------------------


def crc32_hex(h: str) -> str:
    """CRC-32 of the bytes spelled by the hex string expression ``h``."""
    return (
        "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, "
        f"list_transform(range(length({h})//2), lambda i: ('0x'||substr({h},2*i+1,2))::BIGINT)), "
        "lambda acc, x: xor(acc >> 8, list_reduce(list_prepend(xor(acc, x) & 255, "
        "range(8)::BIGINT[]), lambda t, j: CASE WHEN (t & 1) = 1 "
        "THEN xor(3988292384::BIGINT, t >> 1) ELSE t >> 1 END))))")


def _limbs(x: int):
    return [(x >> (32 * i)) & M32 for i in range(4)]


def _lcg_step_exprs():
    a, c = _limbs(LCG_A), _limbs(LCG_C)
    x = ["x0", "x1", "x2", "x3"]
    cols = []
    for k in range(4):
        terms = [f"{x[j]}*{a[k - j]}" for j in range(k + 1)] + [str(c[k])]
        if k:
            terms.append(f"({cols[k - 1]} >> 32)")
        cols.append("(" + " + ".join(terms) + ")")
    return [f"({col} & {M32})" for col in cols]


def lcg_cte(first_row: int, last_row_sql: str, seed_state: int = 0) -> str:
    """``lcg(n, x0..x3, s)``: state limbs and 32-digit hex ``s`` of records
    ``first_row .. last_row_sql``; ``seed_state`` is the state after
    ``first_row`` steps."""
    s = _limbs(seed_state)
    steps = _lcg_step_exprs()
    return f"""lcg_raw(n, x0, x1, x2, x3) AS (
  SELECT {first_row - 1}::BIGINT, {s[0]}::HUGEINT, {s[1]}::HUGEINT, {s[2]}::HUGEINT, {s[3]}::HUGEINT
  UNION ALL
  SELECT n + 1, {steps[0]}, {steps[1]}, {steps[2]}, {steps[3]} FROM lcg_raw
  WHERE n < ({last_row_sql})
),
lcg AS (
  SELECT n, x0, x1, x2, x3,
         lpad(hex(x3::BIGINT), 8, '0') || lpad(hex(x2::BIGINT), 8, '0') ||
         lpad(hex(x1::BIGINT), 8, '0') || lpad(hex(x0::BIGINT), 8, '0') AS s
  FROM lcg_raw WHERE n >= {first_row}
)"""


def _filler(first_digit: int, digits: int) -> str:
    lo, hi = first_digit + 1, first_digit + digits
    return (f"array_to_string(list_transform(range({lo}, {hi + 1}), "
            f"lambda i: repeat(substr(s, i, 1), 4)), '')")


ROW_HEX = "lpad(hex(n), 32, '0')"
BINARY_VALUE_HEX = (f"('0011' || hex({ROW_HEX}) || '8899AABB' || hex({_filler(20, 12)}) "
                    "|| 'CCDDEEFF')")
ASCII_VALUE_HEX = (f"hex('  ' || {ROW_HEX} || '  ' || {_filler(19, 13)} || chr(13) || chr(10))")


def _ascii_key() -> str:
    hi = "(x3 * 4294967296 + x2)"
    lo = "(x1 * 4294967296 + x0)"
    parts = [f"chr((32 + ({hi} // {95 ** i}) % 95)::INTEGER)" for i in range(8)]
    parts += [f"chr((32 + ({lo} // {95 ** i}) % 95)::INTEGER)" for i in range(2)]
    return " || ".join(parts)


KEY_HEX = "upper(substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 20))"
ORDER_VALUE = ("rpad(concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority), "
               "90, ' ')")
EVENT_KEY_HEX = "upper(substr(md5(CAST(user_id AS VARCHAR)), 1, 20))"
EVENT_VALUE = ("rpad(concat_ws('|', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), "
               "event_type), 90, ' ')")
LINE_KEY_HEX = ("upper(substr(md5(CAST(l_orderkey AS VARCHAR) || '|' || "
                "CAST(l_linenumber AS VARCHAR)), 1, 20))")
LINE_VALUE = ("rpad(concat_ws('|', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), "
              "l_returnflag), 90, ' ')")

ORDER_RECS = f"""recs AS (
  SELECT o_orderkey, {KEY_HEX} AS key, {ORDER_VALUE} AS value FROM orders
)"""
EVENT_RECS = f"""recs AS (
  SELECT event_type AS file, event_id AS pos, {EVENT_KEY_HEX} AS key,
         {EVENT_VALUE} AS value FROM events
)"""
LINE_RECS = f"""recs AS (
  SELECT l_orderkey, l_linenumber, {LINE_KEY_HEX} AS key, {LINE_VALUE} AS value FROM lineitem
)"""


def spaced(h: str) -> str:
    return f"rtrim(regexp_replace(lower({h}), '(..)', '\\1 ', 'g'))"


def prefix_pid(method: str, p: int = Q.P) -> str:
    if method == "prefix7":
        per = ((1 << 56) - 1) // p
        return f"least({p - 1}, ('0x' || substr(key, 1, 14))::BIGINT // {per})"
    per = -(-(1 << 24) // p)
    return f"least({p - 1}, ('0x' || substr(key, 1, 6))::BIGINT // {per})"


def _sample_cte() -> str:
    b, k, z = Q.BLOCK_ROWS, Q.SAMPLE_BLOCKS, Q.SAMPLE_SIZE
    return f"""sp AS (
  SELECT nb, least({k}, nb) AS samples
  FROM (SELECT (count(*) + {b - 1}) // {b} AS nb FROM orders)
),
sample AS (
  SELECT o_orderkey // {b} AS block, o_orderkey AS pos, {KEY_HEX} AS key
  FROM orders, sp
  WHERE (o_orderkey // {b}) IN (SELECT i * nb // samples FROM sp, range(0, {k}) r(i) WHERE i < samples)
    AND o_orderkey % {b} < greatest(1, {z} // samples)
)"""


def _splits_cte(p: int = Q.P) -> str:
    return f"""ranked AS (
  SELECT key, row_number() OVER (ORDER BY key) - 1 AS rn, count(*) OVER () AS n FROM sample
),
splits AS (
  SELECT i AS idx, key FROM ranked, range(1, {p}) t(i)
  WHERE rn = (2 * n * i + {p}) // {2 * p}
)"""


def _sampled_pid_recs() -> str:
    return f"""{ORDER_RECS},
{_sample_cte()},
{_splits_cte()},
pr AS (
  SELECT r.*, (SELECT count(*) FROM splits s WHERE s.key <= r.key)::INTEGER AS pid FROM recs r
)"""


def _pid_recs(method: str) -> str:
    if method == "sampled":
        return _sampled_pid_recs()
    return f"""{ORDER_RECS},
pr AS (SELECT r.*, ({prefix_pid(method)})::INTEGER AS pid FROM recs r)"""


def _gen_from_orders(offset: int, seed: int) -> str:
    return lcg_cte(offset, f"SELECT max(o_orderkey) + {offset} FROM orders", seed)


def _sum_str(expr: str) -> str:
    return f"CAST(CAST(sum({expr}) AS HUGEINT) AS VARCHAR)"


RECORD_CRC = crc32_hex("key || hex(value)")
KEY_CRC = crc32_hex("key")


def oracle_sql() -> dict:
    p = Q.P
    sql = {}
    sql["range_splits"] = f"""
WITH t AS (SELECT count(*)::BIGINT AS n FROM orders)
SELECT s::INTEGER AS split, ((n * s + {p - 1}) // {p})::BIGINT AS first_row,
       (((n * (s + 1) + {p - 1}) // {p}) - ((n * s + {p - 1}) // {p}))::BIGINT AS row_count
FROM t, range(0, {p}) r(s)"""

    gen0 = _gen_from_orders(0, 0)
    sql["gen_lcg"] = f"""
WITH RECURSIVE {gen0}
SELECT o_orderkey AS row, s AS state FROM orders JOIN lcg ON n = o_orderkey"""
    sql["gen_binary"] = f"""
WITH RECURSIVE {gen0}
SELECT o_orderkey AS row, substr(s, 1, 20) AS key_hex, {BINARY_VALUE_HEX} AS value_hex
FROM orders JOIN lcg ON n = o_orderkey"""
    sql["gen_ascii"] = f"""
WITH RECURSIVE {gen0}
SELECT o_orderkey AS row, {_ascii_key()} AS key_text, {ASCII_VALUE_HEX} AS value_hex
FROM orders JOIN lcg ON n = o_orderkey"""
    off = Q.GEN_OFFSET
    sql["gen_offset"] = f"""
WITH RECURSIVE {_gen_from_orders(off, SKIP_1E10_STATE)}
SELECT n AS row, substr(s, 1, 20) AS key_hex, {BINARY_VALUE_HEX} AS value_hex
FROM orders JOIN lcg ON n = o_orderkey + {off}"""
    sql["gen_checksum"] = f"""
WITH RECURSIVE {gen0},
g AS (SELECT substr(s, 1, 20) || {BINARY_VALUE_HEX} AS rec
      FROM orders JOIN lcg ON n = o_orderkey)
SELECT count(*)::BIGINT AS rows, {_sum_str(crc32_hex('rec'))} AS checksum FROM g"""

    sql["record_fields"] = f"""
WITH {ORDER_RECS}
SELECT o_orderkey, key AS key_hex, value AS value_text, 100 AS rec_length,
       10 AS key_length, 90 AS value_length FROM recs"""
    sql["row_hex"] = """
SELECT o_orderkey, lpad(hex(o_orderkey), 32, '0') AS row_hex FROM orders"""
    sql["parse_counts"] = f"""
WITH t AS (
  SELECT p_partkey, CAST(p_partkey AS VARCHAR) || CASE p_partkey % 8
    WHEN 0 THEN '' WHEN 1 THEN 'k' WHEN 2 THEN 'm' WHEN 3 THEN 'b' WHEN 4 THEN 't'
    WHEN 5 THEN 'K' WHEN 6 THEN 'T' ELSE 'x' END AS text FROM part
), u AS (
  SELECT p_partkey, text,
         regexp_extract(lower(text), '^([0-9]+)([kmbt]?)$', 1) AS digits,
         regexp_extract(lower(text), '^([0-9]+)([kmbt]?)$', 2) AS suffix FROM t
)
SELECT p_partkey, text,
       CASE WHEN digits = '' THEN NULL ELSE digits::BIGINT * CASE suffix
         WHEN 'k' THEN 1000 WHEN 'm' THEN 1000000 WHEN 'b' THEN 1000000000
         WHEN 't' THEN 1000000000000 ELSE 1 END END AS count,
       CASE WHEN regexp_full_match(text, '[0-9]+') THEN text::BIGINT END AS plain
FROM u"""
    sql["format_sizes"] = """
WITH t AS (
  SELECT o_orderkey, (floor(o_totalprice)::BIGINT * CAST(10 ** (o_orderkey % 10) AS BIGINT))
         AS size FROM orders
)
SELECT o_orderkey, size,
  CASE WHEN size > 1000000000000 THEN CAST(size // 1000000000000 AS VARCHAR) || 'TB'
       WHEN size > 1000000000 THEN CAST(size // 1000000000 AS VARCHAR) || 'GB'
       WHEN size > 1000000 THEN CAST(size // 1000000 AS VARCHAR) || 'MB'
       WHEN size > 1000 THEN CAST(size // 1000 AS VARCHAR) || 'KB'
       ELSE CAST(size AS VARCHAR) || 'B' END AS text
FROM t"""
    sql["key_bytes"] = f"""
WITH {ORDER_RECS}
SELECT o_orderkey, idx::INTEGER AS idx,
       (CASE WHEN idx < 10 THEN ('0x' || substr(key, 2 * idx + 1, 2))::INTEGER ELSE 0 END)::INTEGER
       AS byte
FROM recs, range(0, 12) t(idx)"""
    sql["crc_record"] = f"""
WITH {ORDER_RECS}
SELECT o_orderkey, {RECORD_CRC}::BIGINT AS crc FROM recs"""
    sql["crc_key"] = f"""
WITH {ORDER_RECS}
SELECT o_orderkey, {KEY_CRC}::BIGINT AS crc FROM recs"""

    for method in ("prefix7", "prefix3"):
        sql[f"{method}_partition"] = f"""
WITH {_pid_recs(method)}
SELECT pid, count(*)::BIGINT AS rows, min(key) AS min_key, max(key) AS max_key
FROM pr GROUP BY pid"""

    sql["block_sample"] = f"""
WITH {_sample_cte()}
SELECT block::BIGINT AS block, pos::BIGINT AS pos, key FROM sample"""
    sql["split_points"] = f"""
WITH {_sample_cte()},
{_splits_cte()}
SELECT idx::INTEGER AS idx, key FROM splits"""
    sql["range_partition"] = f"""
WITH {_sampled_pid_recs()}
SELECT pid, count(*)::BIGINT AS rows FROM pr GROUP BY pid"""

    for method in ("sampled", "prefix3", "prefix7"):
        sql[f"sort_{method}"] = f"""
WITH {_pid_recs(method)}
SELECT o_orderkey, key AS key_hex, pid,
       (row_number() OVER (PARTITION BY pid ORDER BY key) - 1)::BIGINT AS pos
FROM pr"""
    sql["global_position"] = f"""
WITH {ORDER_RECS}
SELECT o_orderkey, (row_number() OVER (ORDER BY key) - 1)::BIGINT AS global_pos FROM recs"""
    sql["sort_range_global"] = sql["global_position"]
    sql["sort_tie_breaker"] = f"""
WITH {LINE_RECS},
pr AS (SELECT r.*, ({prefix_pid('prefix7')})::INTEGER AS pid FROM recs r)
SELECT l_orderkey, l_linenumber, key AS key_hex, pid,
       (row_number() OVER (PARTITION BY pid ORDER BY key, l_orderkey, l_linenumber) - 1)::BIGINT
       AS pos
FROM pr"""
    sql["sort_ties_summary"] = f"""
WITH {LINE_RECS},
pr AS (SELECT r.*, ({prefix_pid('prefix7')})::INTEGER AS pid FROM recs r)
SELECT pid, count(*)::BIGINT AS rows, count(DISTINCT key)::BIGINT AS distinct_keys,
       min(key) AS first_key, max(key) AS last_key, {_sum_str(RECORD_CRC)} AS checksum
FROM pr GROUP BY pid"""

    sql["file_bounds"] = f"""
WITH {EVENT_RECS}
SELECT file, arg_min(key, pos) AS first_key, arg_max(key, pos) AS last_key,
       count(*)::BIGINT AS rows FROM recs GROUP BY file"""
    mis = f"""lagged AS (
  SELECT file, pos, key, lag(key) OVER (PARTITION BY file ORDER BY pos) AS prev_key FROM recs
),
mis AS (
  SELECT file, pos, prev_key, key,
         'misorder in ' || file || ' between ' || {spaced('prev_key')} || ' and ' ||
         {spaced('key')} AS detail
  FROM lagged WHERE key < prev_key
)"""
    sql["misorder_in_file"] = f"""
WITH {EVENT_RECS},
{mis}
SELECT file, pos::BIGINT AS pos, prev_key, key, detail FROM mis"""
    bounds = """bounds AS (
  SELECT file, arg_min(key, pos) AS first_key, arg_max(key, pos) AS last_key FROM recs GROUP BY file
),
bt AS (
  SELECT file, lag(file) OVER (ORDER BY file) AS prev_file,
         lag(last_key) OVER (ORDER BY file) AS prev_last_key, first_key, last_key FROM bounds
)"""
    sql["boundary_check"] = f"""
WITH {EVENT_RECS},
{bounds}
SELECT file, prev_file, prev_last_key, first_key, last_key,
       (coalesce(first_key < prev_last_key, false) OR last_key < first_key) AS bad FROM bt"""
    sql["checksum_per_file"] = f"""
WITH {EVENT_RECS}
SELECT file, count(*)::BIGINT AS rows, {_sum_str(RECORD_CRC)} AS checksum
FROM recs GROUP BY file"""
    sql["checksum_total"] = f"""
WITH {ORDER_RECS}
SELECT count(*)::BIGINT AS rows, {_sum_str(RECORD_CRC)} AS checksum,
       lower(hex(CAST(sum({RECORD_CRC}) AS HUGEINT))) AS checksum_hex FROM recs"""
    psum = f"""ps AS (
  SELECT pid, count(*)::BIGINT AS rows, min(key) AS first_key, max(key) AS last_key,
         {_sum_str(RECORD_CRC)} AS checksum FROM pr GROUP BY pid
)"""
    sql["partition_summary"] = f"""
WITH {_pid_recs('prefix7')},
{psum}
SELECT pid, rows, first_key, last_key, checksum FROM ps"""
    sql["partition_checks"] = f"""
WITH {_pid_recs('prefix7')},
{psum}
SELECT pid, first_key <= last_key AS first_le_last,
       coalesce(lag(last_key) OVER (ORDER BY pid) <= first_key, true) AS prev_le_first FROM ps"""
    spaced_detail = (f"'bad key partitioning:' || chr(10) || '  file ' || "
                     f"CASE WHEN coalesce(first_key < prev_last_key, false) THEN prev_file || "
                     f"':end key ' || {spaced('prev_last_key')} || chr(10) || '  file ' || file || "
                     f"':begin key ' || {spaced('first_key')} ELSE file || ':begin key ' || "
                     f"{spaced('first_key')} || chr(10) || '  file ' || file || ':end key ' || "
                     f"{spaced('last_key')} END")
    sql["validate_report"] = f"""
WITH {EVENT_RECS},
{mis},
{bounds},
errs AS (
  SELECT 'error' AS kind, file, detail FROM mis
  UNION ALL
  SELECT 'error' AS kind, file, {spaced_detail} AS detail FROM bt
  WHERE coalesce(first_key < prev_last_key, false) OR last_key < first_key
)
SELECT kind, file, detail FROM errs
UNION ALL
SELECT 'checksum', NULL, h FROM (SELECT lower(hex(CAST(sum({RECORD_CRC}) AS HUGEINT))) AS h FROM recs)
WHERE NOT EXISTS (SELECT 1 FROM errs)"""
    sql["validate_sorted"] = f"""
WITH {_pid_recs('prefix7')},
{psum},
bad AS (
  SELECT pid FROM (SELECT pid, first_key, lag(last_key) OVER (ORDER BY pid) AS pl FROM ps)
  WHERE first_key < pl
)
SELECT 'checksum' AS kind, CAST(NULL AS VARCHAR) AS file, h AS detail
FROM (SELECT lower(hex(CAST(sum({RECORD_CRC}) AS HUGEINT))) AS h FROM pr)
WHERE NOT EXISTS (SELECT 1 FROM bad)"""
    sql["checksum_compare"] = f"""
WITH {ORDER_RECS},
t AS (SELECT count(*)::BIGINT AS rows, {_sum_str(RECORD_CRC)} AS checksum FROM recs)
SELECT rows AS rows_before, checksum AS checksum_before, rows AS rows_after,
       checksum AS checksum_after, true AS equal FROM t"""

    sql["fixed_scan_roundtrip"] = f"""
WITH {ORDER_RECS}
SELECT key AS key_hex, value AS value_text FROM recs"""
    sql["file_order"] = f"""
WITH {_pid_recs('prefix7')}
SELECT pid AS file_no, (row_number() OVER (PARTITION BY pid ORDER BY key) - 1)::BIGINT AS pos,
       key AS key_hex FROM pr"""
    sql["dataset_inventory"] = f"""
WITH {_pid_recs('prefix7')}
SELECT 'part-' || lpad(CAST(i AS VARCHAR), 10, '0') AS file_name,
       (count(pid) * 100)::BIGINT AS bytes, count(pid)::BIGINT AS records, 0::BIGINT AS remainder
FROM range(0, {Q.P}) t(i) LEFT JOIN pr ON pid = i GROUP BY i"""
    sql["gen_sorted_report"] = f"""
WITH RECURSIVE {gen0},
g AS (SELECT substr(s, 1, 20) || {BINARY_VALUE_HEX} AS rec
      FROM orders JOIN lcg ON n = o_orderkey)
SELECT 'checksum' AS kind, CAST(NULL AS VARCHAR) AS file,
       lower(hex(CAST(sum({crc32_hex('rec')}) AS HUGEINT))) AS detail FROM g"""
    b, k, z = Q.BLOCK_ROWS, Q.SAMPLE_BLOCKS, Q.SAMPLE_SIZE
    sql["file_block_sample"] = f"""
WITH {_pid_recs('prefix7')},
pp AS (SELECT pid, key, row_number() OVER (PARTITION BY pid ORDER BY key) - 1 AS pos FROM pr),
fc AS (SELECT pid, (count(*) + {b - 1}) // {b} AS nb FROM pr GROUP BY pid),
fb AS (
  SELECT pid, nb,
         coalesce(sum(nb) OVER (ORDER BY pid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS first_block, sum(nb) OVER () AS total FROM fc
),
sp AS (SELECT pid, first_block, total, least({k}, total) AS samples FROM fb)
SELECT pp.pid AS file_no, (pp.pos // {b})::BIGINT AS block, pp.pos::BIGINT AS pos, pp.key AS key_hex
FROM pp JOIN sp USING (pid)
WHERE (first_block + pp.pos // {b}) IN (SELECT i * total // samples FROM sp, range(0, {k}) r(i) WHERE i < samples)
  AND pp.pos % {b} < least({b}, greatest(1, {z} // samples))"""
    sql["key_byte_list"] = f"""
WITH {ORDER_RECS}
SELECT o_orderkey, array_to_string(list_transform(range(10),
         lambda i: CAST(('0x' || substr(key, 2 * i + 1, 2))::INTEGER AS VARCHAR)), ',') AS bytes
FROM recs"""
    sql["file_bounds_agg"] = sql["file_bounds"]
    sql["split_points_store"] = sql["split_points"]
    db, dz = Q.DOC_BLOCK_ROWS, Q.DOC_SAMPLE_SIZE
    doc_pid = f"""docs AS (SELECT doc_id, encode(text) AS key FROM documents),
sp AS (
  SELECT nb, least({k}, nb) AS samples
  FROM (SELECT (count(*) + {db - 1}) // {db} AS nb FROM documents)
),
sample AS (
  SELECT key FROM docs, sp
  WHERE (doc_id // {db}) IN (SELECT i * nb // samples FROM sp, range(0, {k}) r(i) WHERE i < samples)
    AND doc_id % {db} < greatest(1, {dz} // samples)
),
{_splits_cte()},
pr AS (
  SELECT d.*, (SELECT count(*) FROM splits s WHERE s.key <= d.key)::INTEGER AS pid FROM docs d
),
pp AS (
  SELECT doc_id, key, pid,
         (row_number() OVER (PARTITION BY pid ORDER BY key, doc_id) - 1)::BIGINT AS pos FROM pr
)"""
    sql["sort_documents"] = f"""
WITH {doc_pid}
SELECT doc_id, pid, pos FROM pp"""
    sql["documents_summary"] = f"""
WITH {doc_pid}
SELECT pid, count(*)::BIGINT AS rows, count(DISTINCT key)::BIGINT AS distinct_texts,
       arg_min(doc_id, pos) AS first_doc, arg_max(doc_id, pos) AS last_doc
FROM pp GROUP BY pid"""
    sql["global_position_files"] = f"""
WITH {ORDER_RECS}
SELECT key AS key_hex, (row_number() OVER (ORDER BY key) - 1)::BIGINT AS global_pos FROM recs"""
    sql["validate_report_window"] = sql["validate_report"]
    sql["misorder_scan"] = sql["misorder_in_file"]
    sql["sort_hot_keys"] = """
SELECT count(*)::BIGINT AS rows, count(DISTINCT l_returnflag)::BIGINT AS keys, true AS ordered,
       true AS hot_key_split FROM lineitem"""
    sql["sort_hot_ties"] = """
SELECT l_orderkey, l_linenumber, (row_number() OVER (
         ORDER BY substr(md5(l_returnflag), 1, 20), l_orderkey, l_linenumber) - 1)::BIGINT AS global_pos
FROM lineitem"""
    sql["range_partition_urls"] = f"""
WITH ranked AS (
  SELECT encode(url) AS key, row_number() OVER (ORDER BY encode(url)) - 1 AS rn, count(*) OVER () AS n FROM pages
),
splits AS (
  SELECT i AS idx, key FROM ranked, range(1, {Q.URL_P}) t(i) WHERE rn = (2 * n * i + {Q.URL_P}) // {2 * Q.URL_P}
)
SELECT page_id, (SELECT count(*) FROM splits s WHERE s.key <= encode(url))::INTEGER AS pid FROM pages"""
    sql["parse_edges"] = """
WITH t AS (
  SELECT p_partkey, repeat('9', (15 + p_partkey % 30)::INTEGER) || CASE p_partkey % 4
           WHEN 0 THEN '' WHEN 1 THEN 'k' WHEN 2 THEN 't' ELSE ' ' END AS text,
         (1 + p_partkey % 34)::INTEGER AS n FROM part
), u AS (
  SELECT p_partkey, text, n, try_cast(regexp_extract(text, '^([0-9]+)([kmbt]?)$', 1) AS HUGEINT) AS base,
         CASE right(text, 1) WHEN 'k' THEN 1000 WHEN 't' THEN 1000000000000 ELSE 1 END AS mult FROM t
)
SELECT p_partkey, text,
       CASE WHEN base < 9223372036854775808 AND base::DOUBLE * mult < 9.2e18 THEN (base * mult)::BIGINT END AS count,
       CASE WHEN regexp_full_match(text, '[0-9]{1,38}') THEN text END AS plain,
       CASE WHEN n <= 31 THEN CAST((1::HUGEINT << (4 * n)) - 1 AS VARCHAR) END AS hex_value
FROM u"""
    sql["truncated_tail"] = "SELECT count(*)::BIGINT AS rows, true AS raised FROM orders"
    sql["output_refused"] = """
SELECT count(*)::BIGINT AS rows, true AS without_path, true AS existing_output FROM orders"""
    sql["report_file"] = f"""
WITH {ORDER_RECS}
SELECT 'checksum' AS kind, lower(hex(CAST(sum({RECORD_CRC}) AS HUGEINT))) AS detail FROM recs"""
    sql["too_few_keys"] = """
SELECT count(*)::BIGINT AS keys, true AS raised FROM orders"""
    sql["default_partitions"] = f"""
WITH {_pid_recs('prefix7')}
SELECT sum((c + {b - 1}) // {b})::BIGINT AS splits FROM (SELECT count(*) AS c FROM pr GROUP BY pid)"""
    sql["validate_raises"] = f"""
WITH {EVENT_RECS},
{mis},
{bounds}
SELECT (SELECT count(*) FROM recs)::BIGINT AS rows,
       (EXISTS (SELECT 1 FROM mis) OR EXISTS (SELECT 1 FROM bt
         WHERE coalesce(first_key < prev_last_key, false) OR last_key < first_key)) AS raised"""
    sql["empty_dataset"] = """
SELECT count(*)::BIGINT AS written, 0::BIGINT AS read, 0::BIGINT AS none_matching, '0' AS checksum_hex
FROM orders WHERE o_orderkey < 0"""
    sql["key_range"] = f"""
WITH {ORDER_RECS}
SELECT key AS key_hex, value AS value_text FROM recs
WHERE key >= '{Q.KEY_FROM.upper()}' AND key <= '{Q.KEY_TO.upper()}'"""
    sql["key_lookup"] = f"""
WITH {ORDER_RECS}
SELECT key AS key_hex, value AS value_text FROM recs
WHERE key IN (SELECT upper(substr(md5(CAST(c_custkey AS VARCHAR)), 1, 20)) FROM customer)"""
    sql["split_points_sketch"] = f"""
SELECT i::INTEGER AS idx, ((2 * n * i + {p}) // {2 * p})::BIGINT AS target, true AS within_bound,
       true AS bound_below_a_twentieth
FROM (SELECT count(*) AS n FROM lineitem), range(1, {p}) t(i)"""
    sql["hot_keys"] = f"""
SELECT concat_ws('|', lang, source) AS key, count(*)::BIGINT AS rows FROM documents
GROUP BY ALL HAVING count(*) > {Q.HOT_SHARE} * (SELECT count(*) FROM documents)"""
    changed = f"""{ORDER_RECS},
changed AS (
  SELECT o_orderkey, key, CASE WHEN o_orderkey % 1013 = 7 THEN rpad(CAST(o_orderkey AS VARCHAR), 90, ' ')
    ELSE value END AS value FROM recs WHERE o_orderkey % 1009 <> 5
),
old AS (SELECT key, value FROM recs),
new AS (SELECT key, value FROM changed UNION ALL SELECT key, value FROM changed WHERE o_orderkey % 1019 = 9),
d AS (
  SELECT 'before' AS side, * FROM (FROM old EXCEPT ALL FROM new)
  UNION ALL SELECT 'after', * FROM (FROM new EXCEPT ALL FROM old)
)"""
    sql["changed_rows"] = f"""
WITH {changed}
SELECT side, key AS key_hex, value AS value_text, count(*)::BIGINT AS copies FROM d GROUP BY ALL"""
    sql["changed_rows_tree"] = sql["changed_rows"]
    byte = "('0x' || substr(key, 1, 2))::BIGINT"
    sql["differing_ranges"] = f"""
WITH {changed},
n AS (
  SELECT leaf, sum(x)::BIGINT AS rows_before, sum(y)::BIGINT AS rows_after
  FROM (SELECT {byte} AS leaf, 1 AS x, 0 AS y FROM old UNION ALL SELECT {byte}, 0, 1 FROM new) GROUP BY leaf
)
SELECT leaf, CASE WHEN leaf > 0 THEN printf('%02X', leaf) END AS lo_hex,
       CASE WHEN leaf < 255 THEN printf('%02X', leaf + 1) END AS hi_hex, rows_before, rows_after
FROM n WHERE leaf IN (SELECT {byte} FROM d)"""
    sql["validate_incremental"] = f"""
WITH o AS (SELECT * FROM (WITH {ORDER_RECS} SELECT * FROM recs)),
recs AS (
  SELECT chr(97 + (o_orderkey % 3)::INTEGER) || '/part-' || lpad(CAST(pid AS VARCHAR), 10, '0') AS file, key, value,
         row_number() OVER (PARTITION BY o_orderkey % 3, pid
                            ORDER BY CASE WHEN o_orderkey % 3 = 2 THEN o_orderkey END, key) AS pos
  FROM (SELECT *, {prefix_pid("prefix7", 2)} AS pid FROM o)
),
""" + sql["validate_report"].removeprefix(f"\nWITH {EVENT_RECS},\n")
    sql["inversions"] = f"""
WITH {EVENT_RECS},
inv AS (
  SELECT a.file, count(*) AS n FROM recs a JOIN recs b ON a.file = b.file AND a.pos < b.pos AND a.key > b.key
  GROUP BY a.file
)
SELECT r.file, count(*)::BIGINT AS rows, CAST(coalesce(any_value(inv.n), 0) AS VARCHAR) AS inversions
FROM recs r LEFT JOIN inv ON r.file = inv.file GROUP BY r.file"""
    return {k: v.strip() for k, v in sql.items()}
